"""Exact prefix cuts of any number of groups: boundaries that stay a table.

``find_boundaries`` brings one boundary of each group to the driver and puts them into a filter, which suits the sources
of a mixture. Here a group may be anything with a key, a conversation or a web host, and there may be millions. Limits
come as a table or an expression, boundaries leave as a table, and the search of all groups runs together: a histogram by
(group, bucket of the order), the bucket of each group in which its running sum reaches the limit, again inside buckets
that still hold many rows, and an order of the few rows that are left. A group that holds a third of all rows is searched by
its buckets, like any other, and no group's rows meet in one task.

The driver learns how many groups are left at each depth, and nothing else.
"""

from functools import reduce

from pyspark.sql import Column, DataFrame, Window, functions as F, types as T

from sluice.functions.order import Order
from sluice.operators.cut import BUCKET_BITS, GROUP, WEIGHT, WINDOW_ROWS, LimitOf, _crossing, _histogram, _present, _span
from sluice.operators.stage import Stage

#: Boundaries that are sent to every executor; a boundary takes some hundred bytes. More are joined by shuffling.
BROADCAST_ROWS = 100_000
LIMIT = "limit"
OF_GROUP = (LIMIT, "total_rows", "total_weight")
AT = ("bucket", "before_weight", "before_rows", "bucket_rows")


def boundary_table(
    rows: DataFrame,
    order: Order,
    limit: int | DataFrame | LimitOf,
    group: str,
    stage: Stage,
    name: str = "boundaries",
    weight: str | None = None,
    rows_known: int | None = None,
    bucket_bits: int = BUCKET_BITS,
    window_rows: int = WINDOW_ROWS,
) -> tuple[DataFrame, int]:
    """(group, whole, last, kept_rows, kept_weight, total_rows, total_weight) of each group, and their number.

    A row is kept iff the weights before it in its group sum to less than the group's limit, so the row that reaches it
    is kept. ``limit`` is one number, a table of (group, limit), where groups without a row have a limit of 0, or an
    expression of the group's total weight. Rows without a group are in none; one without a place in the order is refused,
    and so are two rows at one place, if a boundary falls there. ``whole`` groups are kept whole; without it and without
    ``last`` nothing is kept. Weights are longs that are not negative, 1 per row if there is no ``weight``. Rows known to be
    no more than ``window_rows`` are put in order without a search.
    """
    weights = F.col(weight).cast("long") if weight else F.lit(1).cast("long")
    ids = [_present(c).alias(c) for c in order.ids]
    narrow = rows.where(F.col(group).isNotNull()).select(F.col(group).alias(GROUP), *ids, weights.alias(WEIGHT))
    if rows_known is not None and rows_known <= window_rows:
        table = stage.write(_ordered(narrow, order, limit, group).withColumnRenamed(GROUP, group), f"{name}/table", narrow=True)
        return table.rows, table.count
    last_type = narrow.select(_keys(order).alias("last")).schema["last"].dataType
    depths = order.buckets(_span(narrow, order, None), bucket_bits)
    _, bucket = next(depths)
    measures = [F.count_if(F.col("bucket_rows") > window_rows).alias("wide"), F.count("bucket").alias("searched")]
    found = stage.write(_first_search(narrow, bucket, limit, group), f"{name}/0", measures, narrow=True)
    done, depth = [_all_or_nothing(found.rows.where("bucket IS NULL"), last_type)], 0
    while found.figures["searched"]:
        few, searches = found.figures["searched"] <= BROADCAST_ROWS, found.rows.where("bucket IS NOT NULL")
        done.append(_last_rows(_inside(narrow, bucket, searches.where(F.col("bucket_rows") <= window_rows), few), order))
        if not found.figures["wide"]:
            break
        within = _inside(narrow, bucket, searches.where(F.col("bucket_rows") > window_rows), few)
        finer, depth = next(depths, None), depth + 1
        if finer is None:
            raise ValueError(f"the order by {order.ids} is not unique in {found.figures['wide']} groups")
        _, bucket = finer
        found = stage.write(_next_search(within, bucket), f"{name}/{depth}", measures, narrow=True)
    table = stage.write(reduce(DataFrame.unionByName, done).withColumnRenamed(GROUP, group), f"{name}/table", narrow=True)
    return table.rows, table.count


def keep_by_table(rows: DataFrame, boundaries: DataFrame, count: int, order: Order, group: str) -> DataFrame:
    """The rows inside their group's boundary; groups without one are dropped.

    A table of at most ``BROADCAST_ROWS`` goes to every executor, so rows stay where they are. A larger one is joined by
    the group; a group that holds most rows is split by the adaptive skew join.
    """
    ends = boundaries.select(F.col(group).alias("_group"), F.col("whole").alias("_whole"), F.col("last").alias("_last"))
    ends = F.broadcast(ends) if count <= BROADCAST_ROWS else ends
    inside = F.col("_whole") | F.coalesce(_keys(order) <= F.col("_last"), F.lit(False))
    return rows.join(ends, (rows[group] == F.col("_group")) & inside).drop("_group", "_whole", "_last")


def _keys(order: Order) -> Column:
    return F.struct(*[k.alias(f"k{i}") for i, k in enumerate(order.keys())])


def _first_search(narrow: DataFrame, bucket: Column, limit: int | DataFrame | LimitOf, group: str) -> DataFrame:
    """Each group's limit and totals, and the bucket in which its running sum reaches the limit; null if none does."""
    limited = _limited(_histogram(narrow, bucket), limit, group)
    of_group = [F.max(c).alias(c) for c in OF_GROUP]
    return limited.groupBy(GROUP).agg(*of_group, F.max(_crossing(F.col(LIMIT))).alias("at")).select(GROUP, *OF_GROUP, "at.*")


def _limited(rows: DataFrame, limit: int | DataFrame | LimitOf, group: str) -> DataFrame:
    """Rows that have their group's ``total_weight`` with its limit."""
    if isinstance(limit, DataFrame):
        limits = limit.select(F.col(group).alias(GROUP), F.col(LIMIT).cast("long").alias(LIMIT))
        return rows.join(limits, GROUP, "left").withColumn(LIMIT, F.coalesce(LIMIT, F.lit(0).cast("long")))
    return rows.withColumn(LIMIT, limit(F.col("total_weight")) if callable(limit) else F.lit(limit).cast("long"))


def _ordered(narrow: DataFrame, order: Order, limit: int | DataFrame | LimitOf, group: str) -> DataFrame:
    """The boundaries of rows that are few as a whole."""
    of_group = Window.partitionBy(GROUP)
    in_order = of_group.orderBy(*order.keys())
    totals = narrow.select(
        GROUP, WEIGHT, _keys(order).alias("keys"), F.row_number().over(in_order).alias("place"),
        F.sum(WEIGHT).over(in_order.rowsBetween(Window.unboundedPreceding, 0)).alias("running"),
        (_keys(order) == F.lead(_keys(order)).over(in_order)).alias("tied"),
        F.count("*").over(of_group).alias("total_rows"), F.sum(WEIGHT).over(of_group).alias("total_weight"),
    )
    at = F.max(F.when(_reached(), F.struct("place", "running", "keys", "tied"))).alias("at")
    found = _limited(totals, limit, group).groupBy(GROUP).agg(*[F.max(c).alias(c) for c in OF_GROUP], at)
    whole = F.col("at").isNull() & (F.col(LIMIT) > 0)
    kept = lambda reached, total: F.coalesce(F.col(reached).cast("long"), F.when(whole, F.col(total)), F.lit(0).cast("long"))
    return found.select(
        GROUP, whole.alias("whole"), F.when(F.col("at.tied"), _refused(order, "at.keys")).otherwise(F.col("at.keys")).alias("last"),
        kept("at.place", "total_rows").alias("kept_rows"), kept("at.running", "total_weight").alias("kept_weight"), "total_rows", "total_weight",
    )


def _reached() -> Column:
    """Whether the running sum reaches the limit with this row."""
    return (F.col("running") >= F.col(LIMIT)) & (F.col("running") - F.col(WEIGHT) < F.col(LIMIT))


def _refused(order: Order, keys: str) -> Column:
    return F.raise_error(F.concat(F.lit(f"the order by {order.ids} is not unique at "), F.to_json(keys)))


def _next_search(within: DataFrame, bucket: Column) -> DataFrame:
    """The same inside the bucket of each group, by the next bits of the order."""
    finer = within.drop("bucket", "bucket_rows").groupBy(GROUP, bucket.alias("bucket")).agg(
        *[F.first(c).alias(c) for c in OF_GROUP],
        *[F.first(f"before_{c}").alias(f"earlier_{c}") for c in ("weight", "rows")],
        F.sum(WEIGHT).alias("bucket_weight"),
        F.count("*").alias("bucket_rows"),
    )
    earlier = Window.partitionBy(GROUP).orderBy("bucket").rowsBetween(Window.unboundedPreceding, -1)
    before = lambda c: F.col(f"earlier_{c}") + F.coalesce(F.sum(f"bucket_{c}").over(earlier), F.lit(0))
    running = finer.withColumns({"before_weight": before("weight"), "before_rows": before("rows")})
    return running.where(_crossing(F.col(LIMIT)).isNotNull()).select(GROUP, *OF_GROUP, *AT)


def _all_or_nothing(groups: DataFrame, last_type: T.DataType) -> DataFrame:
    """The boundary of groups in which no row reaches the limit: after all rows, or before all if the limit is 0."""
    whole = F.col(LIMIT) > 0
    kept = lambda total: F.when(whole, F.col(total)).otherwise(F.lit(0).cast("long"))
    return groups.select(
        GROUP, whole.alias("whole"), F.lit(None).cast(last_type).alias("last"), kept("total_rows").alias("kept_rows"),
        kept("total_weight").alias("kept_weight"), "total_rows", "total_weight",
    )


def _inside(narrow: DataFrame, bucket: Column, searches: DataFrame, few: bool) -> DataFrame:
    """The rows of the bucket that each group's search has come to, with the search. Shuffled by (group, bucket), a
    large group's rows go to as many tasks as it has buckets."""
    known = searches.withColumnsRenamed({GROUP: "_g", "bucket": "_b"})
    known = F.broadcast(known) if few else known
    joined = narrow.withColumn("bucket", bucket).join(known, (F.col(GROUP) == F.col("_g")) & (F.col("bucket") == F.col("_b")))
    return joined.drop("_g", "_b")


def _last_rows(within: DataFrame, order: Order) -> DataFrame:
    """The boundary of groups whose search has come to few rows, which are put in order."""
    in_order = Window.partitionBy(GROUP).orderBy(*order.keys())
    running = F.col("before_weight") + F.sum(WEIGHT).over(in_order.rowsBetween(Window.unboundedPreceding, 0))
    ordered = within.select(
        "*", _keys(order).alias("keys"), F.row_number().over(in_order).alias("place"), running.alias("running"),
        (_keys(order) == F.lead(_keys(order)).over(in_order)).alias("tied"),
    )
    return ordered.where(_reached()).select(
        GROUP, F.lit(False).alias("whole"), F.when(F.col("tied"), _refused(order, "keys")).otherwise(F.col("keys")).alias("last"),
        (F.col("before_rows") + F.col("place")).alias("kept_rows"), F.col("running").alias("kept_weight"), "total_rows", "total_weight",
    )
