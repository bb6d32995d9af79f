import random

import pytest
from pyspark.sql import functions as F

from sluice.functions.text import estimated_tokens
from sluice.operators.budget import BudgetSource, coupled_budgets, position_span, stage_prefix, take_budgets
from tests.plans import physical_plan


def source(spark, weights):
    return spark.createDataFrame([(i, w) for i, w in enumerate(weights)], "pos long, tokens long")


def walk(mixture, total):
    """Rows kept per source by going through the sources row by row."""
    kept, spent = [], 0
    for index, (weights, target) in enumerate(mixture):
        kept.append(0)
        if index and spent >= total:
            continue
        own = 0
        for weight in weights:
            kept[-1] += 1
            own += weight
            spent += weight
            if own >= target or spent >= total:
                break
    return kept


def cut(spark, mixture, total, stage, **search):
    rows = [source(spark, weights) for weights, _ in mixture]
    sources = [BudgetSource(f"s{i}", r, r, t) for i, (r, (_, t)) in enumerate(zip(rows, mixture))]
    cuts = coupled_budgets(sources, total, "pos", F.col("tokens"), stage, **search)
    taken = take_budgets(sources, cuts, ["pos", "tokens"]).groupBy("source_order").count().collect()
    counts = {r["source_order"]: r["count"] for r in taken}
    assert {name: c.boundary.rows for name, c in cuts.items() if c.boundary.rows} == {
        f"s{i}": n for i, n in counts.items()
    }
    return [counts.get(i, 0) for i in range(len(mixture))]


@pytest.mark.parametrize(
    ("mixture", "total", "expected"),
    [
        ([([7, 7], 7), ([1] * 4, 3)], 10, [1, 3]),
        ([([5, 4], 7), ([1] * 3, 3)], 10, [2, 1]),
        ([([2], 7), ([1] * 5, 3)], 10, [1, 3]),
        ([([12], 7), ([1], 3)], 10, [1, 0]),
        ([([4] * 3, 0), ([1] * 3, 2)], 10, [1, 2]),
        ([([], 5), ([3, 3], 5)], 10, [0, 2]),
    ],
)
def test_coupled_budgets(spark, stage, mixture, total, expected):
    assert walk(mixture, total) == expected
    assert cut(spark, mixture, total, stage) == expected


def test_random_mixtures_equal_a_walk(spark, stage):
    rng = random.Random(4)
    for trial in range(4):
        mixture = [
            ([rng.randint(1, 9) for _ in range(rng.randint(1, 30))], rng.randint(0, 60))
            for _ in range(rng.randint(2, 3))
        ]
        total = rng.randint(1, 120)
        assert cut(spark, mixture, total, stage, bucket_bits=2, window_rows=3) == walk(mixture, total)


def test_reading_stops_near_the_budget(spark, stage):
    rows = source(spark, [2] * 1000)
    pairs, count, (low, high) = stage_prefix(rows, "pos", F.col("tokens"), 300, stage, "p", (0, 999), probe=20)
    assert low == 0 and 149 <= high < 400
    assert pairs.count() == count == high + 1 and pairs.agg(F.sum("weight")).first()[0] >= 300


def test_reading_goes_on_through_empty_ranges(spark, stage):
    rows = source(spark, [1] * 500).where("pos < 2 or pos > 480")
    pairs, _, span = stage_prefix(rows, "pos", F.col("tokens"), 10, stage, "p", (0, 499), probe=5)
    assert pairs.count() >= 10 and span[1] >= 488
    everything, count, span = stage_prefix(rows, "pos", F.col("tokens"), 10**6, stage, "q", (0, 499), probe=5)
    assert everything.count() == rows.count() == count and span == (0, 499)


def test_the_range_read_reaches_the_scan(spark, stage, sf_dir):
    rows = spark.read.parquet(f"{sf_dir}/documents.parquet").select(
        "doc_id", estimated_tokens(F.col("text")).alias("tokens")
    )
    plan = physical_plan(rows.where(F.col("doc_id").between(0, 9)).hint("rebalance"))
    assert "GreaterThanOrEqual(doc_id,0)" in plan and "LessThanOrEqual(doc_id,9)" in plan
    span = position_span(rows, "doc_id")
    pairs, count, _ = stage_prefix(rows, "doc_id", F.col("tokens"), 500, stage, "p", span, probe=10)
    assert count == pairs.count() < rows.count()
