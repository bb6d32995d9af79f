"""The pipeline against brute force, stage by stage and whole."""

import numpy as np
import pytest

import corpus_pipeline as P
from sluice.llm import packing, simhash
from tests.llm import test_decontaminate as contaminated, test_packing as packs, test_quality_rules as rules, test_simhash as near
from sluice.llm.queries import token_vocabulary

NAMES = "doc_id text lang source n_chars".split()
SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"


def prose(rng, n):
    syllables = np.array("the an er on re he in ed nd ha at en es of or nt ea ti to it st io le is ou ar as de".split())
    return " ".join("".join(rng.choice(syllables, int(rng.integers(1, 4)))) for _ in range(n))


def corpus():
    rng = np.random.default_rng(11)
    items = [(i, prose(rng, 45)) for i in range(6)]
    passage = prose(rng, 70)
    texts = [prose(rng, int(rng.integers(30, 160))) + ("\n" + passage if i % 9 == 0 else "") + ". é end" for i in range(60)]
    texts += [texts[3], texts[4] + " x", texts[4].replace("the", "thé", 1), "short", None, "", "same words here " * 40, "A### B$$$ c&&& " * 30]
    texts += [prose(rng, 60) + " " + items[1][1] + " " + prose(rng, 40), items[2][1], prose(rng, 400) + " " + " ".join(items[3][1].split()[:14])]
    rows = [(i, t, "en", f"src{i % 3}", len(t or "")) for i, t in enumerate(texts)]
    return rows + [rows[5], (None, texts[7], None, None, None)], items


@pytest.fixture(scope="module")
def folder(spark, tmp_path_factory):
    rows, items = corpus()
    path = str(tmp_path_factory.mktemp("pipeline"))
    spark.createDataFrame(rows, SCHEMA).repartition(4).write.parquet(f"{path}/documents.parquet")
    spark.createDataFrame(items, "item_id long, text string").write.parquet(f"{path}/benchmark.parquet")
    return path


def by_rules(rows):
    def kept(text):
        n, chars, symbols, lines, dup, again, capitals = rules.plain(text)
        return not (
            n < 10 or 100 * again > 20 * n or 100 * symbols > 25 * n or 100 * dup > 50 * lines or chars < 2 * n or chars > 20 * n or 100 * capitals > 50 * chars
        )

    return [r for r in rows if kept(r[1])]


def one_of_each(rows):
    roots = near.plain_classes([near.plain_fingerprint(r[1]) for r in rows])
    first = {}
    for r, root in zip(rows, roots):
        if root not in first or (r[0] is None, r[0] or 0) < (first[root][0] is None, first[root][0] or 0):
            first[root] = r
    return list(first.values())


def cut(rows):
    raws = [r[1].encode() for r in rows]
    seen = {}
    for raw in raws:
        for i in range(len(raw) - 199):
            seen[raw[i : i + 200]] = seen.get(raw[i : i + 200], 0) + 1
    out = []
    for r, raw in zip(rows, raws):
        gone = np.zeros(len(raw), bool)
        for i in range(len(raw) - 199):
            if seen[raw[i : i + 200]] > 1:
                gone[i : i + 200] = True
        text, at = "", 0
        for c in r[1]:
            size = len(c.encode())
            text += "" if gone[at : at + size].all() else c
            at += size
        out.append((r[0], text, r[2], r[3], len(text)))
    return out


def clean(rows, items):
    out = []
    for r in rows:
        words, hit, _ = contaminated.plain(r[1], items)
        if not hit or 20 * len(hit) < len(words):
            out.append(r)
    return out


def test_stages(spark, folder):
    rows, items = corpus()
    steps = [by_rules, one_of_each, cut, lambda rows: clean(rows, items)]
    docs, sizes = spark.read.parquet(f"{folder}/documents.parquet"), [len(rows)]
    for (name, step), plain in zip(P.STAGES, steps):
        found, rows = step(spark, docs, folder), plain(rows)
        assert found.columns == NAMES, name
        assert sorted(map(tuple, found.collect()), key=repr) == sorted(rows, key=repr), name
        docs = spark.createDataFrame(rows, SCHEMA)
        sizes.append(len(rows))
    assert sizes[0] > sizes[1] > sizes[2] == sizes[3] > sizes[4] > 40
    encoder = packing.Encoder(token_vocabulary())
    out = P.run(spark, folder).collect()
    used = packs.check(out, encoder, {r[0]: r[1] for r in rows}, packing.LIMIT)
    assert used == -(-sum(r["length"] for r in out) // packing.LIMIT)


def test_many_items(spark, stage, folder):
    from sluice.llm import decontaminate

    rows, items = corpus()
    docs, benchmark = (spark.read.parquet(f"{folder}/{t}.parquet") for t in ("documents", "benchmark"))
    found = decontaminate.clean(docs, benchmark, stage, part_bytes=400)
    assert sorted(map(tuple, found.collect()), key=repr) == sorted(clean(rows, items), key=repr)


def test_empty(spark, tmp_path):
    spark.createDataFrame([], SCHEMA).write.parquet(f"{tmp_path}/documents.parquet")
    spark.createDataFrame([], "item_id long, text string").write.parquet(f"{tmp_path}/benchmark.parquet")
    assert P.run(spark, str(tmp_path)).collect() == []


def test_null_only_classes_keep_one(spark, stage):
    docs = spark.createDataFrame([(None, "a b c d e f", "x")] * 2 + [(None, "u v w x y z", None)], "doc_id long, text string, root string")
    assert sorted(r["text"] for r in simhash.one_of_each(docs, stage).collect()) == ["a b c d e f", "u v w x y z"]
