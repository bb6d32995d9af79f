"""Held-out accuracy on the given labels, and the trees against a walk node by node."""

import zlib

import numpy as np

from sluice.llm import quality_model as M


def data(n=3000, seed=1):
    rng = np.random.default_rng(seed)
    rows = rng.normal(size=(n, len(M.FEATURES)))
    rows[:, 3] = rng.integers(0, 3, n)
    labels = ((rows[:, 0] > 0.3) ^ (rows[:, 3] == 1)).astype(float)
    return rows, labels


def test_trees_learn_interactions():
    rows, labels = data()
    model = M.fit(rows[:2000], labels[:2000])
    assert (((model.scores(rows[2000:]) > 0.5) == labels[2000:]).mean()) > 0.97


def test_flat_walk():
    rows, labels = data(400)
    model = M.fit(rows, labels, trees=7, depth=3)
    for row, score in zip(rows[:50], model.scores(rows[:50])):
        total = model.base
        for t in range(7):
            node = 0
            while node < 7:
                node = 2 * node + 1 + int(row[model.feature[t, node]] > model.threshold[t, node])
            total += model.leaf[t, node - 7]
        assert abs(1 / (1 + np.exp(-total)) - score) < 1e-12


def test_thresholds_part_as_bins_do():
    rows, labels = data(1000)
    model = M.fit(rows, labels, trees=1, depth=1)
    left = rows[:, model.feature[0, 0]] <= model.threshold[0, 0]
    p = labels.mean()
    for side, leaf in ((left, model.leaf[0, 0]), (~left, model.leaf[0, 1])):
        expected = -M.RATE * (p - labels[side]).sum() / (side.sum() * p * (1 - p) + M.SHRINK)
        assert abs(leaf - expected) < 1e-9


def test_one_kind_of_label():
    rows, labels = data(50)
    for value, wanted in ((1.0, 1.0), (0.0, 0.0)):
        scores = M.fit(rows, np.full(50, value)).scores(rows)
        assert np.abs(scores - wanted).max() < 1e-4
    assert (M.fit(rows[:0], labels[:0]).scores(rows) == 0.5).all()


def test_measures_are_finite():
    for text in ("", " ", "a", "a b", "a b c d e", "A!! " * 5000, "\n\n", "é" * 5000, "1 2 3\n1 2 3\n", "\x00"):
        assert len(M.measures(text)) == len(M.FEATURES) and np.isfinite(M.measures(text)).all()


def test_held_out(spark, stage):
    docs, labels = (spark.read.parquet(f"/root/testdata/sf0.01/{t}.parquet") for t in ("documents", "labels"))
    found = {r["doc_id"]: r for r in M.quality(docs, labels, stage).collect()}
    assert len(found) == docs.count()
    hits = total = 0
    for r in labels.collect():
        own = found[r["doc_id"]]
        assert own["held_out"] == (zlib.crc32(str(r["doc_id"]).encode()) % 5 == 0) and 0 <= own["score"] <= 1
        if own["held_out"]:
            hits += own["predicted"] == r["quality"]
            total += 1
    assert hits / total >= 0.95


def test_labels_and_ids_are_no_inputs(spark, stage):
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    labels = spark.read.parquet("/root/testdata/sf0.001/labels.parquet")
    rows = M.statistics(docs)
    x, y = M.training_rows(rows, labels, "doc_id", "quality")
    held = {r["id"] for r in rows.collect() if zlib.crc32(str(r["id"]).encode()) % 5 == 0}
    assert len(x) == len(y) == sum(r["doc_id"] not in held for r in labels.collect())
    assert len(M.training_rows(rows, labels, "doc_id", "quality", sample_rows=20)[1]) <= 20


def test_odd_rows(spark, stage):
    docs = spark.createDataFrame([(1, None, "s"), (1, "", "s"), (None, "x", None), (2, "a b", "s")], "doc_id long, text string, statistics string")
    labels = spark.createDataFrame([(1, 1), (2, None), (None, 0), (9, 1)], "doc_id long, quality int")
    found = M.quality(docs, labels, stage).collect()
    assert len(found) == 4 and all(r["predicted"] == (1 if r["score"] >= 0.3 else 0) for r in found)
    assert M.quality(docs.limit(0), labels.limit(0), stage).collect() == []
