"""Measurements against plain Python, policies and ablations against the rows."""

import re

import pytest

from sluice.llm import quality_rules as Q

TEXTS = [
    None, "", " \t\n\x0b\f\r", "one", "a b c d e f g h i j", "x y z w v " * 3, "Ä# ß $ %<> |",
    "a\n\n b \nb\n b \n\na\nc", "aa " * 30, "THE CAPITALS ARE LOUD " * 2 + "and 9 more words follow here to fill it up",
    "p q r s t u v w x y p q r s t u", "\x1c \x85 words   go on with these and those and some of them",
    "w " * 20000, " ".join(map(str, range(20000))), "ééééééééééééééééééééééééééééé " * 12 + "\U0001F600",
]


def plain(text):
    text = text or ""
    words = re.findall(r"[^\x20\x09-\x0D]+", text)
    lines = [x for x in text.split("\n") if re.search(r"[^\x20\x09-\x0D]", x)]
    windows = [tuple(words[i : i + 5]) for i in range(len(words) - 4)]
    seen = {}
    for w in windows:
        seen[w] = seen.get(w, 0) + 1
    hit = {k for i, w in enumerate(windows) if seen[w] > 1 for k in range(i, i + 5)}
    return (
        len(words), sum(map(len, words)), sum(c in "#*$%&|<>" for c in text), len(lines), len(lines) - len(set(lines)), len(hit),
        sum("A" <= c <= "Z" for c in text),
    )


def test_measurements(spark):
    rows = [(i, t, "m") for i, t in enumerate(TEXTS)] + [(4, TEXTS[4], None), (None, "a", None)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, n_words string")
    found = Q.judged(Q.ledger(docs)).collect()
    assert sorted((tuple(r)[:8] for r in found), key=repr) == sorted(((i, *plain(t)) for i, t, _ in rows), key=repr)
    for r in found:
        assert r["base_failed"] == (r["n_words"] < 10 or 100 * r["n_repeat_words"] > 20 * r["n_words"])
        assert r["kept"] == (r["failures"] == 0) and (not r["kept"] or not r["base_failed"])


def test_filtered_keeps_columns(spark):
    text = "these are ten plain words of a text that stays"
    docs = spark.createDataFrame([(1, text, 5), (2, None, 5), (3, "aa " * 30, None)], "doc_id long, text string, failures int")
    assert [tuple(r) for r in Q.filtered(docs).collect()] == [(1, text, 5)]


def test_policies_and_ablations(spark):
    docs = spark.createDataFrame(list(enumerate(TEXTS)), "doc_id long, text string")
    rows = Q.ledger(docs).cache()
    kept = Q.verdicts(rows, [Q.BASE, Q.WEB]).collect()
    for r in kept:
        assert r["kept_base_v1"] == (r["failures"] & 3 == 0) and r["kept_web_v1"] == (r["failures"] == 0)
    for r in Q.ablations(rows, [Q.BASE, Q.WEB]).collect():
        policy = {"base": Q.BASE, "web": Q.WEB}[r["policy"]]
        bit = 1 << [x.name for x in Q.RULES].index(r["rule"])
        sets = [k["failures"] & policy.mask for k in kept]
        assert tuple(r)[3:] == (
            sum(s != 0 for s in sets), sum(s & bit != 0 for s in sets), sum(s == bit for s in sets), sum(s in (0, bit) for s in sets)
        )


def test_empty(spark):
    docs = spark.createDataFrame([], "doc_id long, text string")
    assert Q.ledger(docs).collect() == [] and Q.ablations(Q.ledger(docs), [Q.WEB]).collect() == []
