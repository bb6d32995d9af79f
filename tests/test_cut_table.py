"""Boundaries of many groups against a window over each group."""

import pytest
from pyspark.sql import Window, functions as F

from sluice.functions.order import by_position, shuffled
from sluice.operators import cut_table as C
from sluice.operators.cut import share_of_total

SMALL = {"bucket_bits": 2, "window_rows": 3}


def windowed(rows, order, limit, weight="w"):
    """The rows whose earlier weights in the group are below the limit."""
    earlier = Window.partitionBy("g").orderBy(*order.keys()).rowsBetween(Window.unboundedPreceding, -1)
    whole = Window.partitionBy("g")
    before = F.coalesce(F.sum(weight).over(earlier), F.lit(0))
    return rows.where("g IS NOT NULL").withColumns({"before": before, "total": F.sum(weight).over(whole)}).where(F.col("before") < limit(F.col("total")))


def ids(rows):
    return sorted(r["id"] for r in rows.select("id").collect())


def generated(spark, n, groups, step=1):
    """A third of the rows in group 0, the others over ``groups``; some in none; weights of 0 too."""
    group = F.when(F.col("id") % 3 == 0, 0).when(F.col("id") % 101 == 0, None).otherwise(F.xxhash64("id") % groups)
    return spark.range(n).select((F.col("id") * step - n).alias("id"), group.alias("g"), (F.xxhash64(F.lit(7), "id") % 5 + 4).alias("w"), F.lit("x").alias("limit"))


@pytest.mark.parametrize("order", [by_position("id"), shuffled(3, "id")], ids=["position", "hash"])
@pytest.mark.parametrize("search", [{}, SMALL, {"rows_known": 400}], ids=["one look", "many looks", "few rows"])
@pytest.mark.parametrize("step", [1, 2**40])
def test_cuts_equal_a_window(spark, stage, order, search, step):
    rows = generated(spark, 400, 9, step)
    for limit in (share_of_total(0.4), lambda total: F.lit(11), lambda total: F.lit(0)):
        table, count = C.boundary_table(rows, order, limit, "g", stage, weight="w", **search)
        kept = C.keep_by_table(rows, table, count, order, "g")
        assert ids(kept) == ids(windowed(rows, order, limit))
        assert kept.columns == rows.columns
        sums = kept.groupBy("g").agg(F.count("*").alias("n"), F.sum("w").alias("s"))
        figures = table.join(sums, "g", "left").na.fill(0)
        assert figures.where("n <> kept_rows OR s <> kept_weight").count() == 0
        stage.close()


def test_limits_from_a_table(spark, stage):
    rows = generated(spark, 300, 5)
    limits = spark.createDataFrame([(0, 100), (1, 0), (2, 10**9), (77, 3)], "g long, limit long")
    order = by_position("id")
    table, count = C.boundary_table(rows, order, limits, "g", stage, weight="w", **SMALL)
    kept = ids(C.keep_by_table(rows, table, count, order, "g"))
    chosen = {r["g"]: r["limit"] for r in limits.collect()}
    by_group = F.coalesce(*[F.when(F.col("g") == g, v) for g, v in chosen.items()], F.lit(0))
    assert kept == ids(windowed(rows, order, lambda total: by_group))
    assert table.where("g = 77").count() == 0


def test_a_million_groups(spark, stage, monkeypatch):
    """None of them comes to the driver, and boundaries meet their rows by a shuffle."""
    rows = spark.range(3_000_000).select("id", F.when(F.col("id") < 10**6, 0).otherwise(F.col("id") % 10**6).alias("g"), (F.col("id") % 7 + 1).alias("w"))
    order, limit = by_position("id"), share_of_total(0.5)
    collect = type(rows).collect

    def few(frame):
        found = collect(frame)
        assert len(found) <= 1
        return found

    monkeypatch.setattr(type(rows), "collect", few)
    table, count = C.boundary_table(rows, order, limit, "g", stage, weight="w", window_rows=100_000)
    assert count == 10**6
    kept = C.keep_by_table(rows, table, count, order, "g").select("id")
    expected = windowed(rows, order, limit).select("id")
    assert kept.agg(F.count("*"), F.sum(F.xxhash64("id").cast("decimal(38,0)"))).first() == expected.agg(F.count("*"), F.sum(F.xxhash64("id").cast("decimal(38,0)"))).first()


def test_refusals(spark, stage):
    tied = spark.createDataFrame([(1, 1, 1), (1, 1, 1), (2, 1, 1)], "id long, g long, w long")
    for known in (None, 3):
        with pytest.raises(Exception, match="not unique"):
            C.boundary_table(tied, by_position("id"), 1, "g", stage, f"tied-{known}", rows_known=known)
    for repeated in ([(5, 1, 1)] * 9, [(5, 1, 1)] * 9 + [(2**40, 1, 1)]):
        with pytest.raises(Exception, match="not unique"):
            C.boundary_table(spark.createDataFrame(repeated, "id long, g long, w long"), by_position("id"), 3, "g", stage, "again", **SMALL)
    with pytest.raises(Exception, match="without id"):
        C.boundary_table(spark.createDataFrame([(None, 1, 1)], "id long, g long, w long"), by_position("id"), 1, "g", stage, "null")


def test_no_rows(spark, stage):
    rows = spark.createDataFrame([], "id long, g string, w long")
    for order in (by_position("id"), shuffled(1, "id")):
        table, count = C.boundary_table(rows, order, 5, "g", stage, f"empty-{order.seeded}")
        assert count == 0 and C.keep_by_table(rows, table, count, order, "g").count() == 0
