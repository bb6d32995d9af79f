"""Shards along a Hilbert curve over several metadata dimensions, for files that prune in all of them.

1. Each dimension is quantised at its own quantiles into 2 ** BITS cells, numbers and strings by their whole value, so
   that cells keep the order and a file's smallest and largest value are close in every dimension. The quantiles of
   strings are read off their order by a range shuffle, as strings that share a long beginning have no number of their own.
2. The cells' place on the Hilbert curve orders the rows; neighbours on it are neighbours in all dimensions.
3. The order is cut into runs of equal numbers of rows. Ties, also a third of all rows in one cell, are told apart by
   the text's hash, the id and the row, so that a cell is cut like any other part of the order.

Only narrow rows are ordered, by a range shuffle; texts move once, in ``write_shards``.

Cases: a null value lies in the first cell; a null text has size 1 and the checksum of nothing; repeated rows take a
slot each; an empty table gives an empty one; other columns are ignored, whatever their names.
"""

from collections.abc import Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F, types as T
from pyspark.sql.functions import arrow_udf

from sluice.operators.rank import ranked
from sluice.operators.stage import Stage

SHARDS = 8
BITS = 4
#: Rows in a part of the order.
PART_ROWS = 1_000_000


def curve_index(cells: np.ndarray, bits: int = BITS) -> np.ndarray:
    """Places on the Hilbert curve of points (rows) with coordinates (columns) of ``bits`` bits.

    From the highest bit down, the bit of each coordinate says which half of the current cube the point is in. The
    curve runs through the sub-cubes in Gray code order, and each is entered turned: lower bits are mirrored in the
    first coordinate or swapped with it, so that the end of one piece of the curve touches the start of the next.
    """
    x = cells.T.astype(np.int64).copy()
    dimensions = len(x)
    for level in range(bits - 1, 0, -1):
        low = (1 << level) - 1
        for d in range(dimensions):
            inside = (x[d] >> level) & 1 == 1
            swap = np.where(inside, 0, (x[0] ^ x[d]) & low)
            x[0] = np.where(inside, x[0] ^ low, x[0] ^ swap)
            x[d] ^= swap
    for d in range(1, dimensions):
        x[d] ^= x[d - 1]
    turned = np.zeros(x.shape[1], np.int64)
    for level in range(bits - 1, 0, -1):
        turned ^= np.where((x[-1] >> level) & 1 == 1, (1 << level) - 1, 0)
    x ^= turned
    out = np.zeros(x.shape[1], np.int64)
    for level in range(bits - 1, -1, -1):
        for d in range(dimensions):
            out = out << 1 | (x[d] >> level) & 1
    return out


def place_on_curve(cells: Sequence[Column], bits: int = BITS) -> Column:
    def index(points: pa.Array) -> pa.Array:
        return pa.array(curve_index(points.flatten().to_numpy(zero_copy_only=False).reshape(len(points), -1), bits))

    return arrow_udf(index, "long")(F.array(*cells))


def string_cuts(values: DataFrame, dimension: str, row: str, shares: Sequence[float], stage: Stage, count: int) -> list[str]:
    """The strings at so many shares of their order; ties, also a third of all rows, are told apart by the row."""
    own = values.where(F.col(dimension).isNotNull()).select(dimension, row)
    placed, n = ranked(own, [F.col(dimension), F.col(row)], stage, f"place_{dimension}", partitions=max(2, -(-count // PART_ROWS)))
    places = sorted({min(n - 1, int(n * share)) for share in shares}) if n else []
    return [r[0] for r in placed.where(F.col(f"place_{dimension}").isin(places)).select(dimension).orderBy(dimension).collect()]


def quantised(rows: DataFrame, dimensions: Sequence[str], row: str, stage: Stage, count: int, bits: int = BITS) -> DataFrame:
    """``rows`` with a column ``cell_<i>`` for each dimension. The cut points are 2 ** bits - 1 values a dimension."""
    shares = [i / (1 << bits) for i in range(1, 1 << bits)]
    strings = [d for d in dimensions if isinstance(rows.schema[d].dataType, T.StringType)]
    numbers = [d for d in dimensions if d not in strings]
    wanted = F.array(*[F.lit(s) for s in shares])
    found = rows.agg(F.lit(0), *[F.percentile_approx(F.col(d).cast("double"), wanted, 10_000).alias(d) for d in numbers]).first()
    cuts = {d: found[d] or [] for d in numbers} | {d: string_cuts(rows, d, row, shares, stage, count) for d in strings}
    cells = {}
    for i, d in enumerate(dimensions):
        value = F.col(d) if d in strings else F.col(d).cast("double")
        cell = F.size(F.filter(F.array(*[F.lit(c) for c in cuts[d]]), lambda c: c < value)) if cuts[d] else F.lit(0)
        cells[f"cell_{i}"] = F.coalesce(F.when(value.isNotNull(), cell), F.lit(0)).cast("long")
    return rows.withColumns(cells)


def shards(
    docs: DataFrame, stage: Stage, dimensions: Sequence[str] = ("lang", "source", "size"), id_col: str = "doc_id", text_col: str = "text",
    n_shards: int = SHARDS, bits: int = BITS,
) -> DataFrame:
    """(id, size, text_crc32, curve, shard, slot) of every row, the shards' numbers of rows at most one apart.

    ``dimensions`` are columns of ``docs``, or ``size``: the text's UTF-8 bytes plus one.
    """
    text = F.coalesce(F.col(text_col), F.lit(""))
    size = (F.octet_length(text) + 1).cast("long")
    own = [(size if d == "size" else F.col(d)).alias(f"d{i}") for i, d in enumerate(dimensions)]
    narrow = docs.select(
        F.col(id_col).alias("id"), size.alias("size"), F.crc32(text.cast("binary")).alias("text_crc32"), F.xxhash64(text).alias("tie"), *own,
        F.monotonically_increasing_id().alias("row"),
    )
    rows = stage.write(narrow, "rows", narrow=True)
    in_cells = quantised(rows.rows, [f"d{i}" for i in range(len(dimensions))], "row", stage, rows.count, bits)
    curve = place_on_curve([F.col(f"cell_{i}") for i in range(len(dimensions))], bits)
    placed = stage.write(in_cells.withColumn("curve", curve).select("id", "size", "text_crc32", "tie", "row", "curve"), "curve", narrow=True).rows
    parts = max(1, -(-rows.count // PART_ROWS))
    order, count = ranked(placed, [F.col(c) for c in ("curve", "tie", "id", "row")], stage, "place", partitions=max(parts, 2))
    exact = F.expr(f"cast(place * {n_shards} div {max(count, 1)} as int)")
    first = F.expr(f"(shard * {count} + {n_shards - 1}) div {n_shards}")
    return order.withColumn("shard", exact).withColumn("slot", F.col("place") - first).select(
        F.col("id").alias(id_col), "size", "text_crc32", "curve", "shard", "slot"
    )


def write_shards(docs: DataFrame, places: DataFrame, path: str, id_col: str = "doc_id", parts: int = 32) -> None:
    """The rows of ``docs``, whose ids are unique, in a folder for each shard, in the order of the curve.

    A range shuffle by (shard, slot) into ``parts`` makes each file a stretch of the curve, so that its statistics
    are narrow in every dimension.
    """
    rows = docs.select(F.struct("*").alias("_row"), F.col(id_col).alias("_id"))
    placed = rows.join(places.select(F.col(id_col).alias("_i"), F.col("shard").alias("_shard"), F.col("slot").alias("_slot")), F.col("_id").eqNullSafe(F.col("_i")))
    in_order = placed.repartitionByRange(parts, "_shard", "_slot").sortWithinPartitions("_shard", "_slot")
    own = [F.col(f"_row.`{c}`").alias(c) for c in docs.columns if c != "shard"]
    in_order.select(*own, F.col("_shard").alias("shard")).write.partitionBy("shard").mode("overwrite").parquet(path)
