"""Hits against brute force over all windows."""

import hashlib
import re

import numpy as np
import pytest

from sluice.llm import decontaminate as D

WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def plain_words(text):
    return WORD.findall("".join(c.lower() if "A" <= c <= "Z" else c for c in text or ""))


def plain(text, items, window=13):
    words, hit, found = plain_words(text), set(), set()
    for item, own in items:
        own = plain_words(own)
        size = min(window, len(own))
        windows = {tuple(own[i : i + size]) for i in range(len(own) - size + 1)} if own else set()
        for i in range(len(words) - size + 1):
            if tuple(words[i : i + size]) in windows:
                hit |= set(range(i, i + size))
                found.add(item)
    return words, hit, found


def rows_of(seed, n=60):
    rng = np.random.default_rng(seed)
    vocabulary = ["a", "b", "Cé", "d1", "ñ"]
    sentence = lambda k: " ".join(rng.choice(vocabulary, k))
    items = [(i, sentence(int(rng.integers(1, 40)))) for i in range(12)] + [(20, "..."), (21, ""), (22, None), (1, "one more text of item one b b b b b b b b b b a")]
    items += [(30 + i, " ".join(f"w{x}" for x in rng.integers(0, 4000, 40))) for i in range(4)]
    docs = []
    for i in range(n):
        text = "".join(str(x) for x in rng.choice(["\n", "; ", " — ", " "], 1)) + sentence(int(rng.integers(0, 50)))
        if i % 3 == 0:
            own = items[int(rng.integers(16, 20))][1].split()
            at = int(rng.integers(0, 20))
            text += ", " + ",\t".join(w.upper() for w in own[at : at + int(rng.integers(8, 20))]) + "! " + text
        docs.append((i, text))
    return items, docs + [(98, None), (99, ""), (0, docs[0][1]), (None, docs[3][1])]


@pytest.mark.parametrize("part_bytes", [D.PART_BYTES, 300])
def test_against_windows(spark, stage, part_bytes):
    items, docs = rows_of(1)
    frame = spark.createDataFrame([(i, t, "x") for i, t in docs], "doc_id long, text string, words string").repartition(3)
    benchmark = spark.createDataFrame(items, "item_id long, text string")
    found = D.contamination(frame, benchmark, stage, part_bytes=part_bytes)
    counted = D.figures(found).collect()
    expected = []
    for i, text in docs:
        words, hit, names = plain(text, items)
        listed = ",".join(sorted(map(str, names)))
        expected.append((i, len(words), len(hit), len(names), hashlib.sha256(listed.encode()).hexdigest(), bool(hit) and 20 * len(hit) >= len(words)))
    assert any(r[5] for r in expected) and not all(r[5] for r in expected)
    assert sorted(map(tuple, counted), key=repr) == sorted(expected, key=repr)
    texts = {i: t for i, t in docs if i is not None}
    for row in found.collect():
        if row["doc_id"] is None or not row["spans"]:
            continue
        text = texts[row["doc_id"]]
        words, hit, _ = plain(text, items)
        inside = [w for s in row["spans"] for w in plain_words(text[s["start"] : s["end"]])]
        assert inside == [words[k] for k in sorted(hit)]


def test_shared_passages_are_looked_up_once(monkeypatch):
    """Items of one template take no more look-ups for a document that holds it than a single one."""
    rng = np.random.default_rng(5)
    template = " ".join(f"t{x}" for x in rng.integers(0, 500, 60))
    text = " ".join([template] * 20)
    results, sizes = [], []
    for n in (1, 400):
        items = [(str(i), f"{template} own{i} words{i}") for i in range(n)]
        known = D.build(items, D.WINDOW)
        runs, groups = D.runs_in(D.words_of(text), known, D.WINDOW)
        results.append(runs)
        sizes.append(len(groups))
        assert frozenset().union(*(known.groups[g] for g in groups)) == {i for i, _ in items}
        assert len(known.windows) <= 48 + 4 * n
    assert results[0] == results[1] and sizes == [1, 1]


def test_short_items_as_long_as_a_seed():
    """An item of seven words is a window of its own, also where a longer item has it as a seed."""
    long = " ".join(f"w{i}" for i in range(20))
    items = [("short", " ".join(f"w{i}" for i in range(7))), ("long", long), ("one", "w3")]
    scan = D.scanner(items, D.WINDOW)
    for text in ("w0 w1 w2 w3 w4 w5 w6 x", long, "x w3", " ".join(f"w{i}" for i in range(12)), "w2 w1 w0"):
        words, hit, found = plain(text, items)
        row = scan(text)
        assert sorted(k for r in row["words"] for k in range(r["start"], r["end"])) == sorted(hit) and row["items"] == sorted(found)


def test_a_worker_keeps_its_scanner():
    import pickle

    pickled = pickle.dumps([("a", "b c")])
    assert D._worker_scanner(pickled, 13) is D._worker_scanner(pickled, 13) is not D._worker_scanner(pickled, 5)


def test_empty(spark, stage):
    docs = spark.createDataFrame([], "doc_id long, text string")
    items = spark.createDataFrame([], "item_id long, text string")
    some = spark.createDataFrame([(1, "a b")], "doc_id long, text string")
    assert D.figures(D.contamination(docs, items, stage)).collect() == []
    assert D.figures(D.contamination(some, items, stage)).first()["n_hit"] == 0


def test_null_item_is_not_listed(spark, stage):
    docs = spark.createDataFrame([(1, "a b c")], "doc_id long, text string")
    items = spark.createDataFrame([(None, "b")], "item_id long, text string")
    row = D.figures(D.contamination(docs, items, stage)).first()
    assert (row["n_hit"], row["n_items"], row["contaminated"]) == (1, 0, True)


def test_blocks_that_begin_alike():
    """Seeds end after some bytes, within a word too: blocks and short items that share them are told apart."""
    stem = "common " * 4
    items = [("a", stem + "x1 x2 x3 x4 x5 x6 x7 x8 x9 x10"), ("b", stem + "y1 y2 y3 y4 y5 y6 y7 y8 y9 y10"), ("c", stem + "x1"), ("d", stem + "x1 x2 x3")]
    items += [("e", "w" * 5000 + "1"), ("f", "w" * 5000 + "2 z"), ("g", "w" * 30)]
    scan = D.scanner(items, D.WINDOW)
    assert len(max(D.build(items, D.WINDOW).automaton.keys(), key=len)) <= D.SEED_BYTES
    texts = [t for _, t in items] + [stem, stem * 3, stem + "x1 x2 y3", "q " + stem + "y1 y2 y3 y4 y5 y6 y7 y8 y9", stem + "x1 x2", "w" * 5000, "w" * 29 + " " + "w" * 31]
    for text in texts + [" ".join(texts)]:
        words, hit, found = plain(text, items)
        row = scan(text)
        assert sorted(k for r in row["words"] for k in range(r["start"], r["end"])) == sorted(hit) and row["items"] == sorted(found)


def test_digests_that_agree_in_one_half():
    known = D.Phrases(np.array([[1, 5], [1, 7], [1, 9], [4, 5]], np.uint64), np.array([10, 11, 12, 13], np.int32))
    asked = np.array([[1, 9], [1, 5], [1, 6], [4, 5], [4, 9], [9, 9], [0, 5], [1, 7]], np.uint64)
    assert known.find(bytearray(asked.tobytes())).tolist() == [12, 10, -1, 13, -1, -1, -1, 11]
    assert known.find(bytearray()).tolist() == []


def test_memory_of_many_items():
    """Windows take 20 bytes and blocks at most ``SEED_BYTES`` nodes, whatever the items' words."""
    rng = np.random.default_rng(3)
    items = [(str(i), " ".join(f"word{x}" for x in rng.integers(0, 10**6, 60))) for i in range(2000)]
    known = D.build(items, D.WINDOW)
    arrays = sum(a.nbytes for p in (known.windows, known.blocks) for a in (p.high, p.low, p.numbers))
    nodes = known.automaton.get_stats()["nodes_count"]
    blocks = 2000 * 8
    assert len(known.windows) == 2000 * 48 and arrays <= 24 * (len(known.windows) + len(known.blocks)) and nodes <= D.SEED_BYTES * blocks + 1
