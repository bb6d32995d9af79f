import random

import pytest
from pyspark.sql import functions as F

from sluice.operators import mixture, stats


@pytest.mark.parametrize(
    ("share", "with_secondary", "samples"),
    [(0.01, True, (9900, 63)), (0.0, True, (10000, 0)), (1.0, True, (0, 6250)), (0.5, False, (10000, 0))],
)
def test_sample_plan(spark, share, with_secondary, samples):
    total = mixture.preset_tokens("tiny")
    primary, secondary = mixture.two_source_budget(total, share, with_secondary)
    assert primary + secondary == total
    planned = (
        mixture.planned_samples(primary, mixture.PRIMARY_TOKENS_PER_SAMPLE),
        mixture.planned_samples(secondary, mixture.SECONDARY_TOKENS_PER_SAMPLE),
    )
    assert planned == samples
    plans = spark.createDataFrame(
        [(total, share, with_secondary)], "total_tokens long, secondary_share double, with_secondary boolean"
    )
    row = mixture.sample_plan(plans).first()
    assert (row["primary_samples"], row["secondary_samples"]) == samples


def test_plan_table_equals_driver_arithmetic(spark):
    rng = random.Random(1)
    cases = [(rng.randint(1, 10**10), rng.random(), rng.random() < 0.8) for _ in range(50)]
    plans = spark.createDataFrame(cases, "total_tokens long, secondary_share double, with_secondary boolean")
    for r in mixture.sample_plan(plans).collect():
        budget = mixture.two_source_budget(r["total_tokens"], r["secondary_share"], r["with_secondary"])
        assert budget == (r["primary_tokens"], r["secondary_tokens"])
        assert r["primary_samples"] == mixture.planned_samples(budget[0], 500)
        assert r["secondary_samples"] == mixture.planned_samples(budget[1], 800)


def test_presets():
    assert mixture.preset_tokens("xxl") == 40_000_000_000
    assert mixture.preset_tokens("unknown") == mixture.preset_tokens("tiny") == 5_000_000
    assert mixture.source_targets(3_000_000_000, {"a": 0.99, "b": 0.01}) == {"a": 2_970_000_000, "b": 30_000_000}


@pytest.mark.parametrize("share", [-0.1, 1.1])
def test_shares_outside_the_unit_interval_are_refused(share):
    with pytest.raises(ValueError):
        mixture.two_source_budget(100, share)


def test_achieved_shares(spark):
    plan = mixture.plan_table(spark, 100, {"a": 0.9, "b": 0.1, "c": 0.0})
    totals = spark.createDataFrame([("a", 3, 60), ("b", 1, 20)], "source string, samples long, tokens long")
    found = {r["source"]: r for r in mixture.achieved_shares(plan, totals).collect()}
    assert found["a"]["achieved_share"] == 0.75 and found["a"]["planned_tokens"] == 90
    assert (found["c"]["samples"], found["c"]["achieved_share"]) == (0, 0.0)
    empty = mixture.achieved_shares(plan, totals.where("samples > 9")).collect()
    assert {r["achieved_share"] for r in empty} == {0.0}


def counts(spark, values):
    return spark.createDataFrame([(v,) for v in values], "tokencount long")


def test_token_stats(spark):
    assert stats.token_stats(counts(spark, [3, 5, 10])).first() == (3, 18, 6.0, 3, 10)
    assert stats.token_stats(counts(spark, [])).first() == (0, 0, 0.0, None, None)


def test_retention_is_strict(spark):
    kept = stats.retention(counts(spark, [507, 508, 1]), F.col("tokencount") < 508)
    assert kept.first() == (3, 2, 2 / 3 * 100)
    assert stats.retention(counts(spark, []), F.col("tokencount") < 508).first() == (0, 0, 0.0)


def test_source_totals_and_record(spark):
    rows = spark.createDataFrame([("a", 1), ("b", 5), ("a", 2)], "source string, n long")
    totals = stats.source_totals(rows, F.col("n"))
    assert {tuple(r) for r in totals.collect()} == {("a", 2, 3), ("b", 1, 5)}
    overall = stats.source_totals_with_overall(rows, F.col("n"))
    assert {tuple(r) for r in overall.collect()} == {("a", 2, 3), ("b", 1, 5), (None, 3, 8)}
    record = stats.progress_record(totals).first()
    assert record["tokens_per_source"] == {"a": 3, "b": 5} and record["examples_per_source"] == {"a": 2, "b": 1}
    assert (record["total_tokens"], record["examples_collected"]) == (8, 3)
    nothing = stats.progress_record(totals.where("samples > 9")).first()
    assert (nothing["total_tokens"], nothing["tokens_per_source"]) == (0, {})


def test_no_rows_is_an_error():
    stats.require_rows(1)
    with pytest.raises(ValueError, match="no rows collected"):
        stats.require_rows(0)
