import hashlib

import pytest
from pyspark.sql import functions as F

from sluice.functions.order import by_position, shuffled
from sluice.operators import split
from sluice.operators.stats import split_sizes
from tests.plans import physical_plan


def rows_of(spark, n, partitions=3):
    return spark.range(n).withColumn("text", F.concat(F.lit("t"), "id")).repartition(partitions)


def hashed(seed, n):
    return sorted(range(n), key=lambda i: (hashlib.md5(f"{seed}:{i}".encode()).hexdigest(), i))


def members(rows, name):
    return sorted(r["id"] for r in rows.where(F.col("split") == name).collect())


def test_the_two_rules_round_differently():
    assert split.permutation_sizes(60, 0.02) == (58, 2)
    assert split.take_skip_sizes(60, 0.02) == (59, 1)
    for v in (0.0, 1.0):
        assert split.permutation_sizes(10, v) == split.take_skip_sizes(10, v) == (round(10 * (1 - v)), round(10 * v))


@pytest.mark.parametrize("partitions", [1, 7])
def test_permutation_split(spark, partitions):
    rows = split.permutation_split(rows_of(spark, 60, partitions), "id", val_ratio=0.1, seed=42)
    order, (train, _) = hashed(52, 60), split.permutation_sizes(60, 0.1)
    assert members(rows, "train") == sorted(order[:train])
    assert members(rows, "val") == sorted(order[train:])


@pytest.mark.parametrize("partitions", [1, 7])
def test_take_skip_split(spark, partitions):
    rows = split.take_skip_split(rows_of(spark, 60, partitions), "id", val_ratio=0.1, seed=42)
    order = hashed(42, 60)
    assert members(rows, "validation") == sorted(order[:6])
    assert members(rows, "train") == sorted(order[6:])


@pytest.mark.parametrize("partitions", [None, 1, 13])
def test_permuted_split_carries_the_permutation(spark, stage, partitions):
    rows = split.permuted_split(
        rows_of(spark, 60), "id", val_ratio=0.1, seed=7, stage=stage, partitions=partitions
    )
    assert [r["id"] for r in rows.orderBy("permuted").collect()] == hashed(7, 60)
    train = split.permutation_sizes(60, 0.1)[0]
    assert {r["split"] for r in rows.where(F.col("permuted") < train).collect()} == {"train"}
    assert {r["split"] for r in rows.where(F.col("permuted") >= train).collect()} == {"val"}
    assert all(r["text"] == f"t{r['id']}" for r in rows.collect())


@pytest.mark.parametrize(("v", "sizes"), [(0.0, {"train": 10}), (1.0, {"val": 10})])
def test_one_split_may_be_empty(spark, v, sizes):
    rows = split.permutation_split(rows_of(spark, 10), "id", val_ratio=v, seed=1)
    assert {r["split"]: r["samples"] for r in split_sizes(rows).collect()} == sizes
    other = "train" if v else "val"
    assert rows.where(F.col("split") == other).schema == rows.schema


def test_splits_of_no_rows(spark, stage):
    rows = rows_of(spark, 0)
    assert split.permutation_split(rows, "id", val_ratio=0.1, seed=1).count() == 0
    assert split.take_skip_split(rows, "id", val_ratio=0.1, seed=1).count() == 0
    assert split.permuted_split(rows, "id", val_ratio=0.1, seed=1, stage=stage).count() == 0


def test_take_and_skip_are_complements(spark):
    rows = rows_of(spark, 40)
    for order in (by_position("id"), shuffled(3, "id")):
        first, rest = split.take(rows, order, 13), split.skip(rows, order, 13)
        assert first.count() == 13
        assert sorted(r["id"] for r in first.union(rest).collect()) == list(range(40))


def test_splitting_moves_no_rows(spark, sf_dir):
    rows = spark.read.parquet(f"{sf_dir}/documents.parquet")
    plan = physical_plan(split.permutation_split(rows, "doc_id", val_ratio=0.02, seed=42))
    assert "Exchange" not in plan and "Join" not in plan and "Window" not in plan
