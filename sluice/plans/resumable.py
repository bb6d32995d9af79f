"""The token-budget mix, taken in steps: a job that dies goes on after its last finished step.

Sources are taken in their order and each by position, a range of positions a step. A range is as wide as its
rows lie dense, so the number of steps follows the rows however positions are spread (``next_range``). A step weighs the rows of its range, cuts them where the source's target or the overall total is met,
writes what it keeps to a folder named by the step, and then a progress record with the totals so far, where to go on
and where each source ends. A step that was interrupted left no record; it is run again and overwrites its folder. A
restart reads the latest record, found by a pointer, and looks at no source that it has looked at before.
"""

from collections.abc import Mapping, Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession, functions as F

from sluice.functions.bpe import Vocabulary, token_count
from sluice.functions.order import by_position, shuffled
from sluice.functions.text import estimated_tokens
from sluice.operators import mixture, sinks
from sluice.operators.budget import WEIGHT, position_span
from sluice.operators.cut import find_boundaries
from sluice.operators.split import split_column, take_skip_boundary
from sluice.operators.stage import Stage
from sluice.operators.stats import require_rows
from sluice.plans.corpus import Corpus
from sluice.plans.pretrain import BUDGET_SOURCES, SEED, TARGET_TOKENS, VAL_RATIO, accepted_text
from sluice.sources.tables import Source, is_folder

STEP_ROWS = 1_000_000
# How many times as wide a range is counted at most where one was too narrow; how far a step's rows may be off.
GROWTH, OVERFULL = 64, 2
ROWS_FOLDER = "rows"
TOTALS_SCHEMA = "source string, tokens long, samples long, next_position long, last_position long"


@dataclass
class Progress:
    """What has been taken so far, by source, the position at which each source goes on, and its last one."""

    step: int
    tokens: dict[str, int]
    examples: dict[str, int]
    next_positions: dict[str, int]
    last_positions: dict[str, int]


def progress(spark: SparkSession, path: str) -> Progress:
    """The state after the last finished step; it has a few numbers for each configured source."""
    last = sinks.latest_progress(spark, path)
    if last is None:
        return Progress(-1, {}, {}, {}, {})
    totals = last["progress"]
    by_source = (totals["tokens_per_source"], totals["examples_per_source"], last["next_positions"], last["last_positions"])
    return Progress(last["step"], *[dict(m) for m in by_source])


def next_range(scan: DataFrame, position: str, start: int, high: int, width: int, step_rows: int) -> tuple[int, int]:
    """(first, last) of the range to take next. It holds about ``step_rows``, at least half and at most twice as many,
    unless it reaches ``high``.

    A range ``width`` wide is counted, and a wider one as its density demands, or part of it taken if it is too full.
    Only positions are read, and files that lie outside a range by their statistics are not.
    """
    place, before = F.col(position), -1
    while True:
        end = min(high, start + width - 1)
        within = scan.where(place.between(start, end))
        first, rows = within.agg(F.min(place), F.count("*")).first()
        if rows > OVERFULL * step_rows:
            cut = find_boundaries(within.select(position), by_position(position), step_rows, span=(first, end), rows_known=rows)
            return first, cut[""].last[0]
        if OVERFULL * rows >= step_rows or end == high:
            return (first if rows else start), end
        width *= min(GROWTH, step_rows // rows + 1) if rows > max(before, 0) else GROWTH
        before = rows


def take_by_tokens(
    inputs: Mapping[str, DataFrame],
    position: str,
    path: str,
    total_tokens: int = TARGET_TOKENS,
    sources: Sequence[Source] = BUDGET_SOURCES,
    step_rows: int = STEP_ROWS,
    vocabulary: Vocabulary | None = None,
    max_steps: int | None = None,
) -> bool:
    """Take rows into ``path`` from where the last run stopped until the budgets are met; False if ``max_steps``
    ended it before.

    Targets, total and the rule at their ends are those of ``pretrain_by_tokens``, as long as every run is given
    the same ones.
    """
    spark = next(iter(inputs.values())).sparkSession
    targets = mixture.source_targets(total_tokens, {s.name: s.ratio for s in sources})
    now, steps = progress(spark, path), 0
    for index, source in enumerate(sources):
        earlier = sum(now.tokens.get(s.name, 0) for s in sources[:index])
        if index and earlier >= total_tokens:
            break
        if source.name in now.last_positions:
            low, high = now.next_positions[source.name], now.last_positions[source.name]
        elif (span := position_span(inputs[source.name], position)) is None:
            continue
        else:
            low, high = span
        target, width = max(1, min(targets[source.name], total_tokens - earlier)), step_rows
        while (start := now.next_positions.get(source.name, low)) <= high and now.tokens.get(source.name, 0) < target:
            if steps == max_steps:
                return False
            first, end = next_range(inputs[source.name], position, start, high, width, step_rows)
            now = _step(spark, inputs[source.name], source, position, path, (first, end), high, target, vocabulary, now)
            width, steps = end - first + 1, steps + 1
    return True


def _step(
    spark: SparkSession, scan: DataFrame, source: Source, position: str, path: str, span: tuple[int, int],
    high: int, target: int, vocabulary: Vocabulary | None, before: Progress,
) -> Progress:
    text, name, step = F.col("text"), source.name, before.step + 1
    weight = token_count(text, vocabulary) if vocabulary else estimated_tokens(text)
    rows = accepted_text(scan, source, position).where(F.col(position).between(*span))
    with Stage(spark) as stage:
        weights = stage.write(rows.select(F.col(position).cast("long"), weight.cast("long").alias(WEIGHT)), "weights", narrow=True)
        left = target - before.tokens.get(name, 0)
        ends = find_boundaries(weights.rows, by_position(position), left, weight=WEIGHT, span=span, rows_known=weights.count)
        taken_rows, taken_tokens = (ends[""].rows, ends[""].weight) if ends else (0, 0)
        if taken_rows:
            kept = rows.where(ends[""].keeps()).select(F.col(position).cast("long"), "text", "source")
            kept.write.mode("overwrite").parquet(f"{path}/{ROWS_FOLDER}/step={step}")
    now = Progress(
        step,
        before.tokens | {name: before.tokens.get(name, 0) + taken_tokens},
        before.examples | {name: before.examples.get(name, 0) + taken_rows},
        before.next_positions | {name: span[1] + 1},
        before.last_positions | {name: high},
    )
    fields = (now.tokens, now.examples, now.next_positions, now.last_positions)
    totals = [(source, *[field[source] for field in fields]) for source in now.tokens]
    sinks.write_progress(spark.createDataFrame(totals, TOTALS_SCHEMA), path, step)
    return now


def taken_rows(spark: SparkSession, path: str, position: str) -> DataFrame:
    """(position, text, source) of all finished steps."""
    schema, folder = f"{position} long, text string, source string, step long", f"{path}/{ROWS_FOLDER}"
    if not is_folder(spark, folder):
        return spark.createDataFrame([], schema).drop("step")
    done = progress(spark, path).step
    return spark.read.schema(schema).parquet(folder).where(F.col("step") <= done).drop("step")


def taken_corpus(
    spark: SparkSession, path: str, position: str, stage: Stage, total_tokens: int = TARGET_TOKENS, seed: int = SEED,
    val_ratio: float = VAL_RATIO,
) -> Corpus:
    """What has been taken, split like ``pretrain_by_tokens``; ``save`` and ``save_shards`` publish it."""
    now = progress(spark, path)
    count = sum(now.examples.values())
    require_rows(count)
    rows = taken_rows(spark, path, position)
    ids = stage.write(rows.select("source", position), "taken", narrow=True)
    val_end = take_skip_boundary(ids.rows, shuffled(seed, "source", position), val_ratio, ids.count)
    names = ("train", "validation")
    tokens = {name: n for name, n in now.tokens.items() if now.examples[name]}
    figures = {
        "target_tokens": total_tokens,
        "total_tokens": sum(tokens.values()),
        "tokens_per_source": tokens,
        "examples_per_source": {name: now.examples[name] for name in tokens},
        "val_split": val_ratio,
        "seed": seed,
    }
    types = (
        "target_tokens long, total_tokens long, tokens_per_source map<string,long>, "
        "examples_per_source map<string,long>, val_split double, seed long"
    )
    return Corpus(rows.withColumn("split", split_column(val_end, names[1], names[0])), names, figures, types, row_count=count)
