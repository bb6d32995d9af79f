"""Pretraining mixtures, bounded by planned samples or by tokens."""

from collections.abc import Mapping, Sequence
from datetime import date

from pyspark.sql import DataFrame, functions as F

from sluice.functions.bpe import Vocabulary, token_count
from sluice.functions.order import shuffled
from sluice.functions.text import estimated_tokens, long_enough, non_blank, strip
from sluice.operators import mixture
from sluice.operators.budget import BudgetSource, coupled_budgets, take_budgets
from sluice.operators.cut import keep
from sluice.operators.draw import draw
from sluice.operators.lots import Part
from sluice.operators.sinks import budget_name
from sluice.operators.split import SPLIT_SEED_OFFSET, permutation_boundary, split_column, take_skip_boundary
from sluice.operators.stage import Stage
from sluice.operators.stats import require_rows
from sluice.plans.corpus import Corpus
from sluice.sources.tables import Source, tagged_text

# The source labels and shares of the mixtures, validation share, seed and token budget, and
# the fields of a record that tell the second source's share.
PRIMARY, SECONDARY = "fineweb-edu", "open-web-math"
SECONDARY_SHARE = 0.01
SUBSETS = ("sample-10BT", "sample-100BT", "sample-350BT", "full")
SAMPLE_SOURCES = (
    Source(PRIMARY, path=PRIMARY, subset=SUBSETS[0], split="train"),
    Source(SECONDARY, path=SECONDARY, split="train"),
)
BUDGET_SOURCES = (
    Source(
        "fineweb_edu",
        path="smollm-corpus",
        subset="fineweb-edu-dedup",
        split="train",
        predicate="language IS NULL OR language = 'en'",
        optional={"language": "string"},
        ratio=0.99,
    ),
    Source("open_web_math", path="open-web-math", split="train", ratio=0.01),
)
VAL_RATIO = 0.02
SEED = 42
TARGET_TOKENS = 3_000_000_000
SIZE = "tiny"
WITH_SECONDARY_FIELD, SHARE_FIELD = "include_math", "math_ratio_of_pretrain"


def pretrain_by_samples(
    primary: DataFrame,
    secondary: DataFrame,
    ids: tuple[str, ...],
    stage: Stage,
    size: str = SIZE,
    total_tokens: int | None = None,
    with_secondary: bool = True,
    secondary_share: float = SECONDARY_SHARE,
    seed: int = SEED,
    val_ratio: float = VAL_RATIO,
    labels: tuple[str, str] = (PRIMARY, SECONDARY),
    subset: str = SUBSETS[0],
    name_prefix: str = "pretrain",
    day: date | None = None,
    input_rows: tuple[int, int] | None = None,
) -> Corpus:
    """Two sources cut to the samples that their token budgets plan for, then split by a permutation.

    Both sources have ``ids`` and ``text``. Each has its own seed, so that equal ids are drawn apart.
    ``subset`` is recorded: the one that the primary source was opened with. ``input_rows``, the numbers of
    rows of the sources, are counted if they are not given.
    """
    total = mixture.preset_tokens(size) if total_tokens is None else total_tokens
    budgets = mixture.two_source_budget(total, secondary_share, with_secondary)
    plans = (
        mixture.planned_samples(budgets[0], mixture.PRIMARY_TOKENS_PER_SAMPLE),
        mixture.planned_samples(budgets[1], mixture.SECONDARY_TOKENS_PER_SAMPLE),
    )
    usable = lambda rows: rows.where(non_blank(F.col("text"))).select(*ids, "text")
    drawn, drawn_ids, samples = {}, [], {}
    for offset, (label, rows, planned) in enumerate(zip(labels, (primary, secondary), plans)):
        samples[label] = 0
        if planned == 0:
            continue
        source_rows = input_rows[offset] if input_rows else rows.count()
        sample = draw(usable(rows), ids, planned, seed + offset, source_rows, stage, f"samples/{offset}")
        samples[label] = sample.count
        drawn[label] = rows, sample.ends
        drawn_ids.append(sample.ids.withColumn("source", F.lit(label)))
    require_rows(sum(samples.values()))
    train_end = permutation_boundary(
        _concatenated(drawn_ids), shuffled(seed + SPLIT_SEED_OFFSET, "source", *ids), val_ratio, sum(samples.values())
    )
    names = ("pretrain_train", "pretrain_val")

    def rows_of(part: Part) -> DataFrame:
        texts = [
            keep(usable(part(rows)), ends).select(*ids, strip(F.col("text")).alias("text"), F.lit(label).alias("source"))
            for label, (rows, ends) in drawn.items()
        ]
        return _concatenated(texts).withColumn("split", split_column(train_end, *names))

    share = secondary_share if with_secondary else 0.0
    figures = {
        "model_size": size,
        "total_tokens": total,
        "token_ratios": {labels[0]: 1.0 - share, labels[1]: share},
        WITH_SECONDARY_FIELD: with_secondary,
        SHARE_FIELD: share,
        "samples_per_source": samples,
        "val_split": val_ratio,
        "subset": subset,
        "seed": seed,
        "name": budget_name(name_prefix, size, total, sum(samples.values()), day or date.today()),
    }
    types = (
        f"model_size string, total_tokens long, token_ratios map<string,double>, {WITH_SECONDARY_FIELD} boolean, "
        f"{SHARE_FIELD} double, samples_per_source map<string,long>, val_split double, "
        "subset string, seed long, name string"
    )
    all_ends = (*[end for _, ends in drawn.values() for end in ends.values()], train_end)
    count = sum(samples.values())
    return Corpus(rows_of(lambda rows: rows), names, figures, types, row_count=count, rows_of=rows_of, ends=all_ends)


def accepted_text(rows: DataFrame, source: Source, position: str) -> DataFrame:
    """(position, text, source) of the rows that pass the source's predicate and are long enough."""
    return tagged_text(rows, source, position).where(long_enough(F.col("text")))


def pretrain_by_tokens(
    inputs: Mapping[str, DataFrame],
    position: str,
    stage: Stage,
    total_tokens: int = TARGET_TOKENS,
    sources: Sequence[Source] = BUDGET_SOURCES,
    seed: int = SEED,
    val_ratio: float = VAL_RATIO,
    vocabulary: Vocabulary | None = None,
) -> Corpus:
    """Sources in their order, each read by position up to its token budget, then split.

    ``inputs`` has the rows of each source by its name. Reading stops where a budget is met. Budgets are in
    estimated tokens, or in exact ones of a ``vocabulary``.
    """
    text = F.col("text")
    weight = token_count(text, vocabulary) if vocabulary else estimated_tokens(text)
    targets = mixture.source_targets(total_tokens, {s.name: s.ratio for s in sources})
    mixed = [
        BudgetSource(s.name, inputs[s.name], accepted_text(inputs[s.name], s, position), targets[s.name])
        for s in sources
    ]
    cuts = coupled_budgets(mixed, total_tokens, position, weight, stage)
    ends = {name: cut.boundary for name, cut in cuts.items()}
    count = sum(end.rows for end in ends.values())
    require_rows(count)
    kept_ids = _concatenated(
        [cut.kept_pairs().withColumn("source", F.lit(name)) for name, cut in cuts.items()]
    )
    val_end = take_skip_boundary(kept_ids, shuffled(seed, "source", position), val_ratio, count)
    names = ("train", "validation")
    rows = take_budgets(mixed, cuts, [position, "text", "source"]).withColumn(
        "split", split_column(val_end, names[1], names[0])
    )
    figures = {
        "target_tokens": total_tokens,
        "total_tokens": sum(end.weight for end in ends.values()),
        "tokens_per_source": {name: end.weight for name, end in ends.items()},
        "examples_per_source": {name: end.rows for name, end in ends.items()},
        "val_split": val_ratio,
        "seed": seed,
    }
    types = (
        "target_tokens long, total_tokens long, tokens_per_source map<string,long>, "
        "examples_per_source map<string,long>, val_split double, seed long"
    )
    return Corpus(rows, names, figures, types, row_count=count)


def _concatenated(frames: list[DataFrame]) -> DataFrame:
    mixed = frames[0]
    for frame in frames[1:]:
        mixed = mixed.unionByName(frame)
    return mixed
