"""Phrases against counting all of them, with hot words, ties, and every word in a slice or buffer of its own."""

import re
from collections import Counter, defaultdict

import pyarrow as pa
import pytest

from sluice.llm import collocations as C

SCHEMA = "doc_id long, text string, lang string, prefix string, words long"


def brute_force(rows, most_words=3, min_count=10, top=2000):
    counts, n = defaultdict(Counter), Counter()
    for _, text, lang, *_ in rows:
        lang = lang if lang is not None else "und"
        lower = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")
        for piece in re.split(r"[.,;:!?\x0A-\x0D]", lower):
            words = re.findall(r"[^\x20\x09]+", piece)
            n[lang] += len(words)
            for k in range(1, most_words + 1):
                counts[lang].update(tuple(words[i : i + k]) for i in range(len(words) - k + 1))
    out = []
    for lang, f in counts.items():
        found = {p: a for p, a in f.items() if len(p) > 1 and a >= min_count}
        longest = Counter()
        for p, a in found.items():
            for size in range(2, len(p)):
                for i in range(len(p) - size + 1):
                    longest[p[i : i + size]] = max(longest[p[i : i + size]], a)
        rows = []
        for p, a in found.items():
            if 100 * longest[p] >= 50 * a:
                continue
            cuts = [(1_000_000 * a * a // (f[p[:k]] * f[p[k:]]), k, f[p[:k]], f[p[k:]]) for k in range(1, len(p))]
            score, _, left, right = min(cuts)
            rows.append((-score, -a, " ".join(p).encode(), left, right))
        for rank, (score, a, phrase, left, right) in enumerate(sorted(rows)[:top], start=1):
            out.append((lang, rank, phrase.decode(), -a, left, right, n[lang], -score))
    return sorted(out)


def found_in(rows, spark, stage, **settings):
    docs = spark.createDataFrame(rows, SCHEMA).repartition(5)
    return sorted(tuple(r) for r in C.collocations(docs, stage, **settings).collect())


def generated(seed, n=200):
    import random

    rng = random.Random(seed)
    vocabulary = ["the", "of", "New", "York", "é", "a.b", "x", "\x1c", " ", "ÉTÉ", *[f"w{i}" for i in range(12)]]
    rows = []
    for i in range(n):
        words = [rng.choice(vocabulary[: rng.randint(2, len(vocabulary))]) for _ in range(rng.randint(0, 60))]
        text = "".join(w + rng.choice([" ", " ", " ", "\t", "  ", ", ", ".", "\r\n", "\x0b"]) for w in words)
        rows.append((i, text, rng.choice(["en", "de", None, "und"]), "p", i))
    rows += [(i, "the the the the, the new york times", "en", None, None) for i in range(40)]
    return rows + [(None, None, None, None, None), (1, "", "fr", "", 0), (2, " . ,", "fr", "", 0), (3, "one", "es", "", 0)]


@pytest.mark.parametrize("seed", [1, 2])
def test_phrases(spark, stage, seed):
    rows = generated(seed)
    expected = brute_force(rows)
    assert len(expected) > 15
    assert found_in(rows, spark, stage) == expected


@pytest.mark.parametrize("settings", [{"top": 7}, {"min_count": 3}, {"most_words": 4, "min_count": 4}, {"most_words": 2}])
def test_settings(spark, stage, settings):
    rows = generated(3)
    assert found_in(rows, spark, stage, **settings) == brute_force(rows, **settings)


def test_small_buffers_and_heavy_prefixes(monkeypatch):
    rows = generated(4, 40)
    for size in (1, 7, 50, 1 << 20):
        monkeypatch.setattr(C, "FLUSH_BYTES", size)
        # Plain functions in this process: a worker would not see the setting.
        for level in range(5):
            assert counted(rows, level) == counted_plainly(rows, level)


def counted(rows, level):
    class Docs:
        def mapInArrow(self, work, ddl):
            batch = pa.record_batch({"lang": [r[2] or "und" for r in rows], "text": pa.array([(r[1] or "").encode() for r in rows], pa.binary())})
            return list(work(iter([batch])))

    out, buckets = Counter(), {}
    for batch in C.stripes(Docs(), level, 5, heavy={("en", b"the"), ("en", b"the the")}):
        for r in batch.to_pylist():
            entries = C.Entries.read(r["stripes"])
            for label, word, count in zip(entries.labels.take(pa.array(entries.of)).to_pylist(), entries.words.to_pylist(), entries.counts.tolist()):
                size, name = label.split(b":", 1)
                out[name[: int(size)].decode(), name[int(size) :], word] += count
                # An extension of a prefix always goes to the same bucket.
                assert buckets.setdefault((label, word), r["bucket"]) == r["bucket"] < 5
    return out


def counted_plainly(rows, level):
    out = Counter()
    for _, text, lang, *_ in rows:
        for piece in re.split(r"[.,;:!?\x0A-\x0D]", "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")):
            words = [w.encode() for w in re.findall(r"[^\x20\x09]+", piece)]
            for i in range(len(words) - level + (0 if level == 0 else 1)):
                after = words[i + level] if i + level < len(words) else C.END
                out[lang or "und", b" ".join(words[i : i + level]), after] += 1
    return out


def test_score_beyond_64_bits(spark):
    big = 10**12
    row = spark.createDataFrame([(big, big + 1, big + 7)], "a long, l1 long, r1 long").select(C._score(1)).first()
    assert row[0] == 1_000_000 * big * big // ((big + 1) * (big + 7))


def test_empty(spark, stage):
    assert found_in([], spark, stage) == []
    assert found_in([(1, None, None, None, None)], spark, stage) == []
