"""The curve's own properties, and shards against their law."""

import itertools
import zlib

import numpy as np
import pytest

from sluice.llm import hilbert as H


@pytest.mark.parametrize("dimensions,bits", [(1, 4), (2, 1), (2, 4), (3, 3), (4, 2)])
def test_curve(dimensions, bits):
    points = np.array(list(itertools.product(range(1 << bits), repeat=dimensions)))
    index = H.curve_index(points, bits)
    assert sorted(index) == list(range(len(points)))  # each cell once
    path = points[np.argsort(index)]
    assert (np.abs(np.diff(path, axis=0)).sum(axis=1) == 1).all()  # always to a neighbouring cell


def rows_of(n):
    rng = np.random.default_rng(n)
    rows = [(i, "é" * int(rng.integers(0, 90)), ["en", "de", None][i % 3], f"src{int(rng.integers(20))}", i) for i in range(n)]
    rows += [(n + i, "the same", "en", "hot", 0) for i in range(n // 2)]
    return rows + [(0, rows[0][1], "en", "src1", 0)] * 3 + [(None, None, None, None, None), (None, "", "", "", 1)]


SCHEMA = "doc_id long, text string, lang string, source string, shard long"


@pytest.mark.parametrize("n", [3, 500])
def test_shards(spark, stage, n):
    rows = rows_of(n)
    docs = spark.createDataFrame(rows, SCHEMA).repartition(4)
    found = H.shards(docs, stage).collect()
    assert sorted(((r["doc_id"], r["size"], r["text_crc32"]) for r in found), key=repr) == sorted(
        ((i, len((t or "").encode()) + 1, zlib.crc32((t or "").encode())) for i, t, *_ in rows), key=repr
    )
    by_shard = {s: sorted(r["slot"] for r in found if r["shard"] == s) for s in range(8)}
    assert {r["shard"] for r in found} <= set(range(8))
    sizes = [len(v) for v in by_shard.values()]
    assert max(sizes) - min(sizes) <= 1
    assert all(slots == list(range(len(slots))) for slots in by_shard.values())
    in_order = sorted(found, key=lambda r: (r["shard"], r["slot"]))
    assert [r["curve"] for r in in_order] == sorted(r["curve"] for r in found)


def test_strings_of_one_beginning(spark, stage):
    """Quantiles of whole strings: 16 hosts of one long beginning, one of them a third of all rows, lie in order in cells."""
    hosts = [f"https://www.example.org/a/very/long/beginning/{i:02}" for i in range(16)]
    names = [hosts[i % 16] for i in range(480)] + [hosts[5]] * 240 + [None] * 9
    rows = spark.createDataFrame([(i, n) for i, n in enumerate(names)], "row long, d0 string").repartition(3)
    cells = {(r["d0"], r["cell_0"]) for r in H.quantised(rows, ["d0"], "row", stage, len(names)).collect()}
    by_host = dict(cells)
    assert len(by_host) == len(cells) == 17 and by_host[None] == 0
    in_order = [by_host[h] for h in hosts]
    assert in_order == sorted(in_order) and len(set(in_order)) >= 10


@pytest.mark.parametrize("n", [1, 40, 700])
def test_quantiles(spark, stage, n):
    """No cell holds more than its share of distinct values and one value more."""
    rng = np.random.default_rng(n)
    values = [f"{int(v):05}" for v in rng.permutation(n)]
    rows = spark.createDataFrame([(i, v, float(v)) for i, v in enumerate(values)], "row long, d0 string, d1 double").repartition(3)
    found = H.quantised(rows, ["d0", "d1"], "row", stage, n).collect()
    for cell, value in (("cell_0", "d0"), ("cell_1", "d1")):
        in_order = [r[cell] for r in sorted(found, key=lambda r: r[value])]
        assert in_order == sorted(in_order)
        assert max(in_order.count(c) for c in set(in_order)) <= -(-n // 16) + 1


def test_empty(spark, stage):
    assert H.shards(spark.createDataFrame([], SCHEMA), stage).collect() == []


def test_files_prune(spark, stage, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    places = H.shards(docs, stage)
    H.write_shards(docs, places, f"{stage.path}/shards")
    back = spark.read.parquet(f"{stage.path}/shards")
    assert {(r["doc_id"], r["shard"]) for r in back.select("doc_id", "shard").collect()} == {(r["doc_id"], r["shard"]) for r in places.collect()}
    # Fewer shards hold a language than rows dealt at random would.
    held = back.select("shard", "lang").distinct().count()
    assert held < docs.select("lang").distinct().count() * H.SHARDS
