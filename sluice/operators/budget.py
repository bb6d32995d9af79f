"""Token budgets over rows in their given order, reading no further than the budget reaches.

A budget of a few billion tokens is a thin prefix of a large source. ``stage_prefix`` probes a short range
of positions, estimates from its density how far the budget reaches, and reads on from there; the range
condition is pushed to the scan, so files clustered by position are skipped beyond it (positions that do
not follow the files cost a whole scan per probe, two or three in all).
"""

from collections.abc import Mapping, Sequence
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame, functions as F, types as T

from sluice.functions.order import by_position
from sluice.operators.cut import Boundary, find_boundaries
from sluice.operators.stage import Stage

PROBE_POSITIONS = 1_000_000
PROBE_FRACTION = 4096
HEADROOM = 1.25
WEIGHT = "weight"


@dataclass(frozen=True)
class BudgetCut:
    """Where a source's budget ends, and the staged (position, weight) pairs of the rows read for it."""

    boundary: Boundary
    pairs: DataFrame

    def kept_pairs(self) -> DataFrame:
        return self.pairs.where(self.boundary.keeps())


@dataclass(frozen=True)
class BudgetSource:
    """A source of a mixture in budget order: its scan, the rows accepted from it, its target in tokens."""

    name: str
    scan: DataFrame
    rows: DataFrame
    target: int


def position_span(rows: DataFrame, position: str) -> tuple[int, int] | None:
    """First and last position; give it the unfiltered scan, so that only this column is read.

    A row without a position is refused: it would be written, but not counted.
    """
    low, high, without = rows.agg(F.min(position), F.max(position), F.count_if(F.col(position).isNull())).first()
    if without:
        raise ValueError(f"{without} rows have no {position}")
    return None if low is None else (low, high)


def stage_prefix(
    rows: DataFrame,
    position: str,
    weight: Column,
    target: int,
    stage: Stage,
    name: str,
    span: tuple[int, int],
    probe: int | None = None,
) -> tuple[DataFrame, int, tuple[int, int]]:
    """(position, weight) of a prefix of the rows that holds at least ``target``, or of all rows.

    Only rows in the range are weighed, each once. Returns the staged pairs, their number and the range of
    positions read.
    """
    low, high = span
    schema = T.StructType([T.StructField(position, T.LongType()), T.StructField(WEIGHT, T.LongType())])
    width = probe or max(PROBE_POSITIONS, (high - low) // PROBE_FRACTION)
    start, reached, count, parts = low, 0, 0, []
    while start <= high and (reached < target or not parts):
        end = min(high, start + width - 1)
        parts.append(f"{name}/{len(parts)}")
        part = stage.write(
            rows.where(F.col(position).between(start, end)).select(
                F.col(position).cast("long"), weight.cast("long").alias(WEIGHT)
            ),
            parts[-1],
            [F.coalesce(F.sum(WEIGHT), F.lit(0)).alias("weight")],
            narrow=True,
        )
        count += part.count
        reached += part.figures["weight"]
        start = end + 1
        missing = (target - reached) * (start - low)
        width = max(width, int(HEADROOM * missing / reached) + 1 if reached else 4 * width)
    return stage.read(schema, *parts), count, (low, start - 1)


def coupled_budgets(
    sources: Sequence[BudgetSource],
    total: int,
    position: str,
    weight: Column,
    stage: Stage,
    **search,
) -> dict[str, BudgetCut]:
    """The cut of each source, in order, under its own target and the total.

    A source takes rows until its target is reached or the total is spent; the row that reaches either is
    kept, so an earlier source's excess shrinks a later one. A source opened while some budget is left
    yields its first row even for a target of 0, and the first source is always opened. Weights are at
    least 1. A source without rows (or not opened) has no cut.
    """
    order, found, spent = by_position(position), {}, 0
    for index, source in enumerate(sources):
        if index and spent >= total:
            break
        span = position_span(source.scan, position)
        if span is None:
            continue
        target = max(1, min(source.target, total - spent))
        pairs, count, span = stage_prefix(
            source.rows, position, weight, target, stage, f"weights/{source.name}", span
        )
        boundary = find_boundaries(
            pairs, order, target, weight=WEIGHT, span=span, rows_known=count, **search
        ).get("")
        if boundary is not None:
            found[source.name] = BudgetCut(boundary, pairs)
            spent += boundary.weight
    return found


def take_budgets(
    sources: Sequence[BudgetSource], cuts: Mapping[str, BudgetCut], columns: Sequence[str]
) -> DataFrame:
    """The kept rows of all sources with their ``source_order``; nothing is shuffled."""
    kept = [
        s.rows.where(cuts[s.name].boundary.keeps() if s.name in cuts else F.lit(False)).select(
            *columns, F.lit(i).alias("source_order")
        )
        for i, s in enumerate(sources)
    ]
    return reduce(DataFrame.unionByName, kept)
