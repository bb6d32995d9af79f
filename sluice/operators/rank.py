"""Dense global positions without a single-task window.

Rows are brought together in parts that follow each other in the order, numbered inside their part, and
staged; the sizes of the parts, one number for each, give the offsets.
"""

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession, Window, functions as F

from sluice.functions.order import Order
from sluice.operators.stage import Stage
from sluice.sources.tables import single_source_splits

INDEX_BITS = 33
ROWS_PER_PARTITION = 200_000
# 16^4 parts, and 16^5 for more partitions than those would fill evenly. An offset takes a hundred bytes or
# two once it is broadcast as a hashed relation, keyed by text.
PART_DIGITS, MANY_PARTITIONS = 4, 8192


def partitions_for(spark: SparkSession, rows_known: int | None) -> int | None:
    """Partitions that keep a shuffle of so many rows of text within memory; None if the session's suffice."""
    wanted = (rows_known or 0) // ROWS_PER_PARTITION
    return wanted if wanted > int(spark.conf.get("spark.sql.shuffle.partitions")) else None


def width(rows: DataFrame, rows_known: int | None = None) -> int | None:
    """Partitions for moving the rows with their text; None if the session's suffice.

    By their number if it is known, otherwise by the size of the one source that they are read from, a
    partition for each of its scan splits.
    """
    if rows_known is not None:
        return partitions_for(rows.sparkSession, rows_known)
    splits = single_source_splits(rows)
    return splits if splits and splits > int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions")) else None


def ranked(
    rows: DataFrame,
    keys: Sequence[Column],
    stage: Stage,
    name: str,
    partitions: int | None = None,
    rows_known: int | None = None,
) -> tuple[DataFrame, int]:
    """``rows`` with a column ``name``: their 0-based place in the order of ``keys``; and the number of rows.

    Without ``partitions`` the shuffle is as wide as the rows need. The keys are unique, so Spark's range partitioning balances whatever their spread. It samples the keys
    first, which evaluates the rows twice: stage expensive ones.
    """
    partitions = partitions or width(rows, rows_known)
    in_order = rows.repartitionByRange(*([partitions] if partitions else []), *keys)
    # The upper bits of a place are those of the partition.
    return _placed(in_order.sortWithinPartitions(*keys), F.shiftright("_place", INDEX_BITS), stage, name)


def ranked_by_hash(
    rows: DataFrame,
    order: Order,
    stage: Stage,
    name: str,
    partitions: int | None = None,
    rows_known: int | None = None,
) -> tuple[DataFrame, int]:
    """``ranked`` for a seeded order, whose hashes lie evenly: nothing is sampled, the rows are evaluated once.

    A part is the rows whose hashes begin alike; sorted by the hash they follow each other in a partition.
    """
    partitions = partitions or width(rows, rows_known)
    digits = PART_DIGITS + ((partitions or 0) > MANY_PARTITIONS)
    part = F.substring(order.hash_text(), 1, digits)
    together = rows.repartition(*([partitions] if partitions else []), part)
    return _placed(together.sortWithinPartitions(*order.keys()), part, stage, name)


def _placed(in_parts: DataFrame, part: Column, stage: Stage, name: str) -> tuple[DataFrame, int]:
    # monotonically_increasing_id holds the partition in its upper bits and the row's index below them.
    staged = stage.write(in_parts.withColumn("_place", F.monotonically_increasing_id()), name)
    sizes = staged.rows.groupBy(part.alias("_part")).agg(
        F.count("*").alias("_size"), F.min("_place").alias("_first")
    )
    earlier = Window.partitionBy(F.lit(0)).orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    offsets = sizes.select(
        "_part", (F.coalesce(F.sum("_size").over(earlier), F.lit(0)) - F.col("_first")).alias("_offset")
    )
    placed = (
        staged.rows.withColumn("_part", part)
        .join(F.broadcast(offsets), "_part")
        .withColumn(name, F.col("_place") + F.col("_offset"))
        .drop("_part", "_place", "_offset")
    )
    return placed, staged.count
