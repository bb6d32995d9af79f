"""Chat-formatted instruct corpora with exact token counts."""

from pyspark.sql import DataFrame, Observation, functions as F

from sluice.functions.bpe import Vocabulary, token_count
from sluice.functions.order import shuffled
from sluice.functions.text import chat, non_empty, or_empty, strip
from sluice.operators.cut import keep
from sluice.operators.draw import draw
from sluice.operators.lots import LOTS, Part, read_lots, write_lots
from sluice.operators.sinks import thousands_name
from sluice.operators.split import SPLIT_SEED_OFFSET, permutation_boundary, permuted_split, split_column
from sluice.operators.stage import Stage
from sluice.operators.stats import require_rows, retention_measures, token_measures
from sluice.plans.corpus import Corpus

# Sequence cap, validation share, seed, target rows, the formats' names, and what
# joins the turns of capped rows (a backslash and the letter n).
MAX_TOKENS = 508
VAL_RATIO = 0.02
SEED = 42
TARGET_ROWS = 1_000_000
PAIRS_FORMAT, CAPPED_FORMAT = "v2_streaming", "v1_instruct"
SEPARATOR = "\\n"


def instruct_corpus(
    pairs: DataFrame,
    ids: tuple[str, ...],
    vocabulary: Vocabulary,
    stage: Stage,
    target_rows: int = TARGET_ROWS,
    seed: int = SEED,
    val_ratio: float = VAL_RATIO,
    input_rows: int | None = None,
) -> Corpus:
    """The first ``target_rows`` usable (prompt, text) pairs of a seeded order, formatted, counted and split.

    Only rows that are kept are formatted and counted, each once. ``input_rows``, the number of pairs, is
    counted if it is not given, which evaluates a join once more.
    """
    usable = lambda rows: rows.where(non_empty(F.col("prompt"), F.col("text"))).select(*ids, "prompt", "text")
    source_rows = pairs.count() if input_rows is None else input_rows
    drawn = draw(usable(pairs), ids, target_rows, seed, source_rows, stage, "instruct")
    require_rows(drawn.count)
    train_end = permutation_boundary(
        drawn.ids, shuffled(seed + SPLIT_SEED_OFFSET, *ids), val_ratio, drawn.count
    )

    def rows_of(part: Part) -> DataFrame:
        return (
            keep(usable(part(pairs)), drawn.ends)
            .select(*ids, strip(F.col("prompt")).alias("prompt"), strip(F.col("text")).alias("text"))
            .withColumn("formattedconversation", chat(F.col("prompt"), F.col("text")))
            .withColumn("tokencount", token_count(F.col("formattedconversation"), vocabulary))
            .withColumn("split", split_column(train_end, "train", "val"))
        )

    figures = {"target_rows": target_rows, "val_split": val_ratio, "seed": seed, "format_version": PAIRS_FORMAT}
    types = "target_rows long, val_split double, seed long, format_version string"
    ends = (*drawn.ends.values(), train_end)
    return Corpus(rows_of(lambda rows: rows), ("train", "val"), figures, types, vocabulary, "tokencount", drawn.count, rows_of, ends)


def counted_instructions(instructions: DataFrame, vocabulary: Vocabulary, separator: str = SEPARATOR) -> DataFrame:
    """Instructions with their formatted text and its tokens."""
    formatted = chat(
        strip(or_empty(F.col("instruction"))), strip(or_empty(F.col("response"))), separator
    )
    return instructions.withColumn("formattedconversation", formatted).withColumn(
        "tokencount", token_count(F.col("formattedconversation"), vocabulary)
    )


def count_in_lots(
    instructions: DataFrame, vocabulary: Vocabulary, path: str, separator: str = SEPARATOR, lots: int = LOTS,
    max_lots: int | None = None,
) -> bool:
    """Write counted instructions to ``path`` lot by lot, from where an earlier run stopped; False if ``max_lots`` ended it
    before. All are kept, as the statistics are of all."""
    plan = {"separator": separator, "columns": instructions.columns}
    rows_of = lambda part: counted_instructions(part(instructions), vocabulary, separator)
    return write_lots(instructions.sparkSession, rows_of, path, plan, lots, "tokencount", max_lots=max_lots)


def capped_instruct_corpus(
    instructions: DataFrame,
    ids: tuple[str, ...],
    vocabulary: Vocabulary,
    stage: Stage,
    max_tokens: int = MAX_TOKENS,
    seed: int = SEED,
    val_ratio: float = VAL_RATIO,
    separator: str = SEPARATOR,
    name_prefix: str = "instruct",
    input_rows: int | None = None,
    counted_path: str | None = None,
    lots: int = LOTS,
) -> Corpus:
    """Instructions whose formatted text has fewer than ``max_tokens`` tokens, in permuted order.

    All input columns stay. The turns are joined by a backslash and the letter n, not by a line break.
    The rows under the cap are staged where they are ranked, as the size of the split depends on their
    number; the same pass observes the statistics of all. ``input_rows``, at least the number of
    instructions, sets the width of the shuffle that ranks them. With ``counted_path`` instructions that are read from
    files are counted lot by lot, and a run that died goes on after the last lot that is there (``count_in_lots``).
    """
    if counted_path:
        count_in_lots(instructions, vocabulary, counted_path, separator, lots)
        like = counted_instructions(instructions, vocabulary, separator)
        counted = read_lots(instructions.sparkSession, counted_path, like)
    else:
        counted = counted_instructions(instructions, vocabulary, separator)
    under = F.col("tokencount") < max_tokens
    measures = retention_measures(under) + token_measures(F.when(under, F.col("tokencount")))
    seen = Observation()
    rows = permuted_split(
        counted.observe(seen, *measures).where(under), *ids, val_ratio=val_ratio, seed=seed, stage=stage,
        rows_known=input_rows,
    )
    require_rows(len(rows.take(1)), "rows remaining after filtering")  # without rows nothing may be observed
    stats = seen.get
    count = stats["filtered_rows"]
    figures = {
        "original_rows": stats["original_rows"],
        "filtered_rows": count,
        "retained_percent": stats["retained_percent"],
        "min_tokens": stats["min_tokens"],
        "max_tokens": stats["max_tokens"],
        "max_seq_len_filter": max_tokens,
        "val_split": val_ratio,
        "seed": seed,
        "format_version": CAPPED_FORMAT,
        "name": thousands_name(name_prefix, stats["samples"], stats["total_tokens"]),
    }
    types = (
        "original_rows long, filtered_rows long, retained_percent double, min_tokens long, max_tokens long, "
        "max_seq_len_filter long, val_split double, seed long, format_version string, name string"
    )
    return Corpus(rows, ("train", "val"), figures, types, vocabulary, "tokencount", count)
