"""The best of each query against scoring every row, with ties, huge numbers, small blocks and clustered rows."""

import math
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from sluice.llm import topk as T

SCHEMA = "vec_id long, embedding array<double>, x long, row string, block double"


def brute_force(rows, k=5, scale=256, every=50):
    taken = []
    for number, (vec_id, vector, *_) in enumerate(rows):
        if vector is not None and all(c is not None and math.isfinite(c) for c in vector):
            taken.append((number, vec_id, [max(-T.LONG, min(T.LONG - 1, math.floor(c * scale))) for c in vector]))
    out = []
    for own, query_id, q in taken:
        if query_id is None or query_id % every:
            continue
        scores = [(-max(-T.LONG, min(T.LONG - 1, sum(a * b for a, b in zip(q, x)))), vec_id is None, vec_id or 0, vec_id) for i, vec_id, x in taken if i != own]
        for rank, (score, _, _, vec_id) in enumerate(sorted(scores, key=lambda s: s[:3])[:k], start=1):
            out.append((query_id, rank, vec_id, -score))
    return sorted(out, key=repr)


def found_in(rows, spark, stage, **settings):
    vectors = spark.createDataFrame(rows, SCHEMA).repartition(4)
    return sorted((tuple(r) for r in T.top_k(vectors, stage, **settings).collect()), key=repr)


def rows_of(vectors, first=0):
    return [(first + i, v, 0, "r", 0.0) for i, v in enumerate(vectors)]


def generated(seed, n=400, width=6, clusters=0):
    rng = np.random.default_rng(seed)
    vectors = rng.normal(size=(n, width))
    if clusters:
        vectors = rng.normal(size=(clusters, width))[rng.integers(clusters, size=n)] * 5 + vectors / 10
    return vectors.tolist()


ODD = [
    (50, None, 1, None, None), (100, [1.0, None], 1, None, None), (150, [math.nan], 1, None, None), (200, [1.0, math.inf], 1, None, None),
    (250, [], 1, None, None), (300, [0.5], 1, None, None), (350, [0.5] * 9, 1, None, None), (None, [2.0] * 6, 1, None, None), (None, None, None, None, None),
]


@pytest.mark.parametrize("settings", [{}, {"least_blocks": 1}, {"block_cells": 60, "least_blocks": 2}, {"k": 1}, {"k": 600}])
def test_against_all_rows(spark, stage, settings):
    rows = rows_of(generated(1)) + ODD
    assert found_in(rows, spark, stage, **settings) == brute_force(rows, **({"k": settings["k"]} if "k" in settings else {}))


def test_ties_and_repeated_rows(spark, stage):
    rng = random.Random(3)
    rows = rows_of([[rng.choice([0.0, 1.0]) for _ in range(3)] for _ in range(300)])
    rows += rows[:120] + [(0, rows[0][1], 1, "other", 2.0)] * 3 + [(1000 + i, [1.0, 1.0, 1.0], 0, "", 0.0) for i in range(200)]
    assert found_in(rows, spark, stage) == brute_force(rows)


def test_numbers_beyond_doubles(spark, stage):
    rows = rows_of(generated(5, 120, 4)) + [(600, [2.0**45, 1.0, 1.0, 1.0], 0, "", 0.0), (500, [1e300, -1e300, 2.0**50, 3.0], 0, "", 0.0), (501, [2.0**52, 2.0**52, -1.0, 1e18], 0, "", 0.0)]
    assert found_in(rows, spark, stage) == brute_force(rows)


@pytest.mark.parametrize("rows", [[], [(0, [1.0], 0, "", 0.0)], [(0, [], 0, "", 0.0), (50, [], 0, "", 0.0)], [(0, None, 0, "", 0.0)]])
def test_few_rows(spark, stage, rows):
    assert found_in(rows, spark, stage) == brute_force(rows)


def test_query_set(spark, stage):
    rows = rows_of(generated(7, 90))
    assert found_in(rows, spark, stage, is_query=F.col("id") % 30 == 0, scale=10) == brute_force(rows, scale=10, every=30)


def test_threshold_stops(monkeypatch):
    """A query reads the lists no further than its threshold demands, and a bound spares it whole blocks."""
    x = np.random.default_rng(9).integers(0, 1000, size=(4000, 3))
    block = T.Block(list(range(4000)), np.arange(4000), x)
    scored = []
    monkeypatch.setattr(T, "_products", lambda a, b, plain=T._products: scored.append(b.shape[1:]) or plain(a, b))
    queries = np.array([[100, 90, 80]])
    ((places, scores),) = block.search(queries, np.array([-1]), [None], 5)
    everything = sorted((-int(s), i) for i, s in enumerate(x @ queries[0]))[:5]
    assert [(-s, block.ids[p]) for p, s in zip(places, scores)] == everything
    assert sum(shape[0] for shape in scored if shape) < 2500
    scored.clear()
    assert list(block.search(queries, np.array([-1]), [scores[0] * 100], 5)) == [([], [])]
    assert scored == [()]  # one threshold, no row
