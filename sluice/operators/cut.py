"""Exact prefix cuts: the first rows of each group in a total order, up to a number of rows or a sum of weights.

A window over the group would sort it in one task, and a limit of millions of rows would gather them in
one. Instead the end of the prefix is searched: a histogram of the order's leading bits (partially
aggregated, 2^12 to 2^16 buckets per group) shows the bucket in which the running sum reaches the limit.
If that bucket is still large it is searched again by its next bits, however the values are spread; the
few rows left are ordered by a window. What comes back is one boundary per group, so the cut itself is a
plain filter: no row with its text is shuffled, joined or sorted.
"""

from collections.abc import Callable, Mapping
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Row, Window, functions as F

from sluice.functions.order import Order

# Few buckets keep the partial aggregate of a scan task small; more of them pay off only for rows known
# to be many, which come from a stage table of large splits.
BUCKET_BITS = 12
MOST_BUCKET_BITS = 16
WINDOW_ROWS = 500_000
# Boundaries return to the driver and go into the filter as literals, so groups must be few.
MAX_GROUPS = 10_000

# Columns of the search; ids keep their names beside them.
GROUP, WEIGHT = "_cut_group", "_cut_weight"

LimitOf = Callable[[Column], Column]


@dataclass(frozen=True)
class Boundary:
    """Where a group's prefix ends: the keys of its last row, and what the prefix holds."""

    order: Order
    last: tuple | None
    whole: bool
    rows: int
    weight: int
    total_rows: int
    total_weight: int

    def keeps(self) -> Column:
        if self.whole:
            return F.lit(True)
        if self.last is None:
            return F.lit(False)
        return self.order.key() <= self.order.literal(self.last)


@dataclass
class _Search:
    """A group whose boundary lies in one bucket: its limit, what comes before the bucket, its size."""

    limit: int
    depth: int
    bucket: int | str
    before_weight: int
    before_rows: int
    bucket_rows: int
    total_rows: int
    total_weight: int

    @property
    def first(self) -> int:
        return self.bucket << self.depth

    @property
    def last(self) -> int:
        return self.first + (1 << self.depth) - 1

    @property
    def left(self) -> int:
        return self.limit - self.before_weight


def share_of_total(share: float) -> LimitOf:
    """``int(total * share)``, rounded towards zero as Python does."""
    return lambda total: (total.cast("double") * F.lit(float(share))).cast("long")


def find_boundaries(
    rows: DataFrame,
    order: Order,
    limit: int | Mapping[str, int] | LimitOf,
    *,
    weight: str | None = None,
    group: str | None = None,
    span: tuple[int, int] | None = None,
    rows_known: int | None = None,
    bucket_bits: int | None = None,
    window_rows: int = WINDOW_ROWS,
) -> dict[str, Boundary]:
    """The boundary of each group's prefix; a row is kept iff the weights before it sum to less than the limit.

    So the row that reaches the limit is kept. ``weight`` names a column of non-negative longs, 1 per row
    if None. ``limit`` is one number, a number per group, or an expression of the group's total weight.
    ``group`` names a column with few values (the sources of a mixture): one boundary per value returns to
    the driver, and rows without a group are in none. Without it the only key of the result is "". More than
    ``MAX_GROUPS`` groups are refused, and so is a row without a place in the order: its id is null.

    Stage an expensive weight first: the rows are read twice or three times, on the narrow columns of this
    search only. ``span`` and ``rows_known`` (first and last position, number of rows) save a job each: few
    rows are ordered without a search.
    """
    narrow = (rows.where(F.col(group).isNotNull()) if group else rows).select(
        (F.col(group).cast("string") if group else F.lit("")).alias(GROUP),
        *[F.col(c) for c in order.ids],
        (F.col(weight).cast("long") if weight else F.lit(1).cast("long")).alias(WEIGHT),
    )
    # Only the first look at the rows checks them: later ones push the range of a bucket to the scan.
    checked = narrow.withColumns({c: _present(c) for c in order.ids})
    if rows_known is not None and rows_known <= window_rows:
        return _ordered_boundaries(checked, order, _limit_column(limit))
    bucket_bits = bucket_bits or _bucket_bits(rows_known, window_rows)
    depths = order.buckets(_span(narrow, order, span), bucket_bits)
    found, searches = _search(checked, order, next(depths), _limit_column(limit))
    while wide := {g: s for g, s in searches.items() if s.bucket_rows > window_rows}:
        finer = next(depths, None)
        if finer is None:
            raise ValueError(f"the order by {order.ids} is not unique in {sorted(wide)}")
        searches |= _narrow_down(narrow, order, finer, wide)
    return found | _bucket_boundaries(narrow, order, searches)


def _present(column: str) -> Column:
    """The column, refusing nulls: such a row would be kept or dropped, but not counted."""
    return F.coalesce(F.col(column), F.raise_error(F.lit(f"the order has a row without {column}")))


def _few(per_group: DataFrame) -> list[Row]:
    """One row per group, if the groups are few."""
    rows = per_group.limit(MAX_GROUPS + 1).collect()
    if len(rows) > MAX_GROUPS:
        raise ValueError(f"a cut by group takes at most {MAX_GROUPS} groups")
    return rows


def keep(rows: DataFrame, boundaries: Mapping[str, Boundary], group: str | None = None) -> DataFrame:
    """The rows inside their group's boundary; groups without one are dropped."""
    return rows.where(inside(boundaries, group))


def inside(boundaries: Mapping[str, Boundary], group: str | None = None) -> Column:
    """Predicate of ``keep``; with a position order its end reaches the scan."""
    if group is None:
        return boundaries[""].keeps() if boundaries else F.lit(False)
    whole = [g for g, b in boundaries.items() if b.whole]
    lasts = {g: b for g, b in boundaries.items() if b.last is not None}
    kept = F.col(group).isin(whole)
    if not lasts:
        return kept
    order = next(iter(lasts.values())).order
    kept = kept | (order.key() <= _lookup(group, {g: order.literal(b.last) for g, b in lasts.items()}))
    if whole or order.seeded:
        return kept
    return kept & (order.key() <= max(b.last[0] for b in lasts.values()))


def _lookup(group: str, values: Mapping[str, Column]) -> Column:
    """The value of the row's group from a literal map; null for other groups."""
    pairs = [item for g, v in values.items() for item in (F.lit(g), v)]
    return F.try_element_at(F.create_map(*pairs), F.col(group))


def _limit_column(limit: int | Mapping[str, int] | LimitOf) -> Column:
    if callable(limit):
        return limit(F.col("total_weight"))
    if isinstance(limit, Mapping):
        limits = {g: F.lit(v).cast("long") for g, v in limit.items()}
        return F.coalesce(_lookup(GROUP, limits), F.lit(0)) if limits else F.lit(0).cast("long")
    return F.lit(limit).cast("long")


def _in_buckets(order: Order, searches: Mapping[str, _Search]) -> Column:
    """Rows in the bucket that their group's search has come to."""
    if order.seeded:
        return order.hash_text().startswith(_lookup(GROUP, {g: F.lit(s.bucket) for g, s in searches.items()}))
    return F.col(order.ids[0]).between(
        _lookup(GROUP, {g: F.lit(s.first) for g, s in searches.items()}),
        _lookup(GROUP, {g: F.lit(s.last) for g, s in searches.items()}),
    )


def _span(narrow: DataFrame, order: Order, span: tuple[int, int] | None) -> tuple[int, int]:
    if span is None and not order.seeded:
        span = narrow.agg(F.min(order.ids[0]), F.max(order.ids[0])).first()
    return (0, 0) if span is None or span[0] is None else (span[0], span[1])


def _bucket_bits(rows_known: int | None, window_rows: int) -> int:
    """Enough buckets to leave about a quarter of ``window_rows`` in each, if the rows lie evenly."""
    if rows_known is None:
        return BUCKET_BITS
    return max(BUCKET_BITS, min(MOST_BUCKET_BITS, (4 * rows_known // window_rows).bit_length()))


def _histogram(narrow: DataFrame, bucket: Column) -> DataFrame:
    """Weight and rows per bucket, with the running totals before each bucket and those of the group."""
    buckets = narrow.groupBy(GROUP, bucket.alias("bucket")).agg(
        F.sum(WEIGHT).alias("bucket_weight"), F.count("*").alias("bucket_rows")
    )
    of_group = Window.partitionBy(GROUP)
    earlier = of_group.orderBy("bucket").rowsBetween(Window.unboundedPreceding, -1)
    return buckets.select(
        "*",
        F.coalesce(F.sum("bucket_weight").over(earlier), F.lit(0)).alias("before_weight"),
        F.coalesce(F.sum("bucket_rows").over(earlier), F.lit(0)).alias("before_rows"),
        F.sum("bucket_weight").over(of_group).alias("total_weight"),
        F.sum("bucket_rows").over(of_group).alias("total_rows"),
    )


def _crossing(limit: Column) -> Column:
    """Set on the one bucket in which the running sum reaches the limit."""
    before = F.col("before_weight")
    return F.when(
        (before < limit) & (before + F.col("bucket_weight") >= limit),
        F.struct("bucket", "before_weight", "before_rows", "bucket_rows"),
    )


def _search(
    narrow: DataFrame, order: Order, buckets: tuple[int, Column], limit: Column
) -> tuple[dict[str, Boundary], dict[str, _Search]]:
    """First histogram: groups that are kept whole or not at all, and the bucket of the others."""
    depth, bucket = buckets
    per_group = _per_group(_histogram(narrow, bucket).withColumn("limit", limit), _crossing(F.col("limit")))
    found, searches = {}, {}
    for r in _few(per_group):
        if r.at is None:
            found[r[GROUP]] = _all_or_nothing(order, r)
        else:
            searches[r[GROUP]] = _Search(
                r.limit, depth, r.at.bucket, r.at.before_weight, r.at.before_rows, r.at.bucket_rows,
                r.total_rows, r.total_weight,
            )
    return found, searches


def _per_group(rows: DataFrame, at: Column) -> DataFrame:
    """One row per group: its limit and totals, and the ``at`` of the one row where that is set."""
    totals = [F.max(c).alias(c) for c in ("limit", "total_rows", "total_weight")]
    return rows.groupBy(GROUP).agg(*totals, F.max(at).alias("at"))


def _all_or_nothing(order: Order, r: Row) -> Boundary:
    """The boundary of a group in which no row reaches the limit."""
    if r.limit > 0:
        return Boundary(order, None, True, r.total_rows, r.total_weight, r.total_rows, r.total_weight)
    return Boundary(order, None, False, 0, 0, r.total_rows, r.total_weight)


def _narrow_down(
    narrow: DataFrame, order: Order, buckets: tuple[int, Column], wide: Mapping[str, _Search]
) -> dict[str, _Search]:
    """Search the bucket of each group again, by the next bits of the order."""
    depth, bucket = buckets
    rows = narrow.where(_in_buckets(order, wide))
    left = _limit_column({g: s.left for g, s in wide.items()})
    at = _histogram(rows, bucket).select(GROUP, _crossing(left).alias("at")).where("at is not null")
    closer = {}
    for r in at.collect():
        s = wide[r[GROUP]]
        closer[r[GROUP]] = _Search(
            s.limit, depth, r.at.bucket, s.before_weight + r.at.before_weight,
            s.before_rows + r.at.before_rows, r.at.bucket_rows, s.total_rows, s.total_weight,
        )
    return closer


def _ordered(rows: DataFrame, order: Order, limit: Column) -> list[Row]:
    """Order the rows of each group (a bounded number) and find the row that reaches the limit."""
    of_group = Window.partitionBy(GROUP)
    in_order = of_group.orderBy(*order.keys())
    running = in_order.rowsBetween(Window.unboundedPreceding, 0)
    ordered = rows.select(
        GROUP,
        WEIGHT,
        F.struct(*[k.alias(f"k{i}") for i, k in enumerate(order.keys())]).alias("keys"),
        F.row_number().over(in_order).alias("rank"),
        F.sum(WEIGHT).over(running).alias("weight"),
        (order.key() == F.lead(order.key()).over(in_order)).alias("tied"),
        F.sum(WEIGHT).over(of_group).alias("total_weight"),
        F.count("*").over(of_group).alias("total_rows"),
    ).withColumn("limit", limit)
    reached = (F.col("weight") >= F.col("limit")) & (F.col("weight") - F.col(WEIGHT) < F.col("limit"))
    return _few(_per_group(ordered, F.when(reached, F.struct("rank", "weight", "tied", "keys"))))


def _last_row(order: Order, r: Row) -> tuple:
    if r.at.tied:
        raise ValueError(f"the order by {order.ids} is not unique at {tuple(r.at['keys'])}")
    return tuple(r.at["keys"])


def _ordered_boundaries(narrow: DataFrame, order: Order, limit: Column) -> dict[str, Boundary]:
    """Boundaries of groups that are small as a whole."""
    found = {}
    for r in _ordered(narrow, order, limit):
        if r.at is None:
            found[r[GROUP]] = _all_or_nothing(order, r)
        else:
            found[r[GROUP]] = Boundary(
                order, _last_row(order, r), False, r.at["rank"], r.at.weight, r.total_rows, r.total_weight
            )
    return found


def _bucket_boundaries(
    narrow: DataFrame, order: Order, searches: Mapping[str, _Search]
) -> dict[str, Boundary]:
    """Boundaries inside the buckets that the search has come to."""
    if not searches:
        return {}
    found, left = {}, _limit_column({g: s.left for g, s in searches.items()})
    for r in _ordered(narrow.where(_in_buckets(order, searches)), order, left):
        s = searches[r[GROUP]]
        found[r[GROUP]] = Boundary(
            order, _last_row(order, r), False, s.before_rows + r.at["rank"], s.before_weight + r.at.weight,
            s.total_rows, s.total_weight,
        )
    return found
