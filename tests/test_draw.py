import hashlib

import pytest
from pyspark.sql import functions as F

from sluice.operators import draw as drawing
from tests.plans import physical_plan


@pytest.mark.parametrize(
    ("n", "every"), [(30, 1), (30, 5), (30, 40), (200, 1), (500, 3), (0, 1), (9, 10**6)]
)
def test_draws_are_the_beginning_of_the_order(spark, stage, n, every):
    source = spark.range(400).withColumn("text", F.concat(F.lit("t"), "id"))
    usable = source.where(F.col("id") % every == 0)
    drawn = drawing.draw(usable, ("id",), n, 42, source.count(), stage, "d")
    order = sorted(range(0, 400, every), key=lambda i: hashlib.md5(f"42:{i}".encode()).hexdigest())
    assert sorted(r["id"] for r in drawn.rows.collect()) == sorted(order[:n])
    assert sorted(r["id"] for r in drawn.ids.collect()) == sorted(order[:n])
    assert drawn.count == min(n, len(order))
    assert all(r["text"] == f"t{r['id']}" for r in drawn.rows.collect())


def test_a_small_draw_reads_rows_where_they_lie(spark, stage):
    source = spark.range(1000).withColumn("text", F.lit("t"))
    drawn = drawing.draw(source, ("id",), 20, 1, 1000, stage, "d")
    plan = physical_plan(drawn.rows)
    assert "Range" in plan and "FileScan" not in plan and "Exchange" not in plan
    staged = spark.read.parquet(f"{stage.path}/d/0")
    assert staged.columns == ["id"] and 20 <= staged.count() < 100


@pytest.mark.parametrize(("n", "every"), [(1, 1), (1, 50), (3, 100)])
def test_a_rare_draw_stages_few_rows(spark, stage, n, every):
    source = spark.range(20_000).withColumn("text", F.lit("t"))
    for seed in range(8):
        name = f"d-{n}-{every}-{seed}"
        drawn = drawing.draw(source.where(F.col("id") % every == 0), ("id",), n, seed, 20_000, stage, name)
        order = sorted(range(0, 20_000, every), key=lambda i: hashlib.md5(f"{seed}:{i}".encode()).hexdigest())
        assert sorted(r["id"] for r in drawn.rows.collect()) == sorted(order[:n])
        assert spark.read.option("recursiveFileLookup", True).parquet(f"{stage.path}/{name}").count() <= 200


def test_a_share_below_all_hashes_grows(spark, stage):
    drawn = drawing.draw(spark.range(300), ("id",), 1, 1, 10**12, stage, "d")
    assert drawn.count == 1


@pytest.mark.parametrize("n", [1, 10, 100, 130, 400, 500])
def test_ids_only_are_staged(spark, stage, monkeypatch, n):
    """At any share, whether the draw ends in the beginning of the order or needs all of it."""
    staged, write = [], type(stage).write

    def seen(self, rows, *rest, **options):
        staged.append((rows.columns, options.get("narrow", False)))
        return write(self, rows, *rest, **options)

    monkeypatch.setattr(type(stage), "write", seen)
    rows = spark.range(500).withColumn("text", F.lit("t"))
    drawn = drawing.draw(rows, ("id",), n, 1, 500, stage, "draw")
    assert all(s == (["id"], True) for s in staged) and len(staged) == 1
    order = sorted(range(500), key=lambda i: hashlib.md5(f"1:{i}".encode()).hexdigest())
    assert sorted(r["id"] for r in drawn.rows.collect()) == sorted(order[:n])


def test_no_rows(spark, stage):
    drawn = drawing.draw(spark.range(0), ("id",), 20, 1, 0, stage, "d")
    assert drawn.count == 0 and drawn.rows.count() == 0
