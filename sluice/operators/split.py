"""Train and validation splits of exact size, by a seeded permutation, as one column."""

from math import trunc

from pyspark.sql import DataFrame, functions as F

from sluice.functions.order import Order, shuffled
from sluice.operators.cut import Boundary, find_boundaries, inside, share_of_total
from sluice.operators.rank import ranked_by_hash
from sluice.operators.stage import Stage

# Fixed value: the permutation split draws from the run's seed plus this.
SPLIT_SEED_OFFSET = 10


def permutation_sizes(rows: int, val_ratio: float) -> tuple[int, int]:
    """(train, val) of the permutation split: train is rounded down."""
    train = trunc(rows * (1 - val_ratio))
    return train, rows - train


def take_skip_sizes(rows: int, val_ratio: float) -> tuple[int, int]:
    """(train, val) of the take/skip split: val is rounded down."""
    val = trunc(rows * val_ratio)
    return rows - val, val


def permutation_boundary(
    ids: DataFrame, order: Order, val_ratio: float, rows_known: int | None = None
) -> Boundary | None:
    """End of the train part of the order; None without rows."""
    return find_boundaries(ids, order, share_of_total(1 - val_ratio), rows_known=rows_known).get("")


def take_skip_boundary(
    ids: DataFrame, order: Order, val_ratio: float, rows_known: int | None = None
) -> Boundary | None:
    """End of the validation part, which comes first in the order; None without rows."""
    return find_boundaries(ids, order, share_of_total(val_ratio), rows_known=rows_known).get("")


def split_column(boundary: Boundary | None, first: str, rest: str):
    """``first`` up to the boundary, ``rest`` after it."""
    before = boundary.keeps() if boundary else F.lit(False)
    return F.when(before, F.lit(first)).otherwise(F.lit(rest))


def permutation_split(
    rows: DataFrame,
    *ids: str,
    val_ratio: float,
    seed: int,
    names: tuple[str, str] = ("train", "val"),
    stage: Stage | None = None,
) -> DataFrame:
    """``rows`` with a ``split`` column; whatever columns give the input order are kept.

    The search reads the ids up to three times. With a ``stage`` they are written once: for ids that are
    expensive, or not the same on every evaluation.
    """
    order = shuffled(seed + SPLIT_SEED_OFFSET, *ids)
    boundary = permutation_boundary(*_searched(rows, ids, stage, order, val_ratio))
    return rows.withColumn("split", split_column(boundary, *names))


def permuted_split(
    rows: DataFrame,
    *ids: str,
    val_ratio: float,
    seed: int,
    stage: Stage,
    names: tuple[str, str] = ("train", "val"),
    partitions: int | None = None,
    rows_known: int | None = None,
) -> DataFrame:
    """``rows`` in permuted order: a ``permuted`` rank from 0 and the ``split`` it falls into.

    Ranking the rows moves their text once; they are staged on the way. ``rows_known``, an upper bound of
    their number, sets the width of that shuffle.
    """
    in_order, total = ranked_by_hash(rows, shuffled(seed, *ids), stage, "permuted", partitions, rows_known)
    train, _ = permutation_sizes(total, val_ratio)
    return in_order.withColumn(
        "split", F.when(F.col("permuted") < train, F.lit(names[0])).otherwise(F.lit(names[1]))
    )


def _searched(rows: DataFrame, ids: tuple[str, ...], stage: Stage | None, order: Order, val_ratio: float) -> tuple:
    if stage is None:
        return rows.select(*ids), order, val_ratio
    staged = stage.write(rows.select(*ids), f"split-{order.seed}", narrow=True)
    return staged.rows, order, val_ratio, staged.count


def take_skip_split(
    rows: DataFrame,
    *ids: str,
    val_ratio: float,
    seed: int,
    names: tuple[str, str] = ("train", "validation"),
    stage: Stage | None = None,
) -> DataFrame:
    """The first part of the seeded order is the validation set, the rest is the train set; ``stage`` as above."""
    order = shuffled(seed, *ids)
    boundary = take_skip_boundary(*_searched(rows, ids, stage, order, val_ratio))
    return rows.withColumn("split", split_column(boundary, names[1], names[0]))


def take(rows: DataFrame, order: Order, n: int) -> DataFrame:
    """The first ``n`` rows of the order."""
    return rows.where(inside(find_boundaries(rows, order, n)))


def skip(rows: DataFrame, order: Order, n: int) -> DataFrame:
    """All but the first ``n`` rows of the order."""
    return rows.where(~inside(find_boundaries(rows, order, n)))
