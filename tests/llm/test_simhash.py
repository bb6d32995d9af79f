"""SimHash classes against brute force over all pairs."""

import numpy as np
import pytest
import xxhash

from sluice.llm import simhash as S

U64 = 1 << 64


def plain_fingerprint(text, k=4):
    words = [w for w in "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "").translate({i: " " for i in (9, 10, 11, 12, 13)}).split(" ") if w]
    if not words:
        return 0
    shingles = [" ".join(words[i : i + k]) for i in range(max(1, len(words) - k + 1))]
    hashes = [xxhash.xxh64_intdigest(s.encode(), 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def plain_classes(points):
    """Smallest index reachable over pairs within the radius."""
    label = list(range(len(points)))

    def root(i):
        while label[i] != i:
            i = label[i]
        return i

    for i, a in enumerate(points):
        for j in range(i):
            if bin(a ^ points[j]).count("1") <= S.RADIUS:
                x, y = root(i), root(j)
                label[max(x, y)] = min(x, y)
    return [root(i) for i in range(len(points))]


def chained(rng, n):
    """Fingerprints of which many lie some bits apart."""
    points = [int(rng.integers(0, U64, dtype=np.uint64))]
    while len(points) < n:
        base = points[int(rng.integers(len(points)))] if rng.random() < 0.7 else int(rng.integers(0, U64, dtype=np.uint64))
        for bit in rng.choice(64, int(rng.integers(0, 7)), replace=False):
            base ^= 1 << int(bit)
        points.append(base)
    return points


@pytest.mark.parametrize("text", ["", "one", "A b  C\td\ne", "ÄÖ ä x y z X Y q", "a b c d a b c d a b c d", "\x1c x\x85y z w v"])
def test_fingerprint(text):
    assert S.simhash(text) % U64 == plain_fingerprint(text)


def test_tree_links():
    rng = np.random.default_rng(3)
    points = chained(rng, 700)
    for home in (np.ones(700, bool), rng.random(700) < 0.5):
        pairs = S.tree_links(np.array(points, np.uint64), home, leaf=16)
        forest = S._Forest(700)
        for a, b in pairs:
            forest.join(a, b)
        for i in range(700):
            for j in range(i):
                if (home[i] or home[j]) and bin(points[i] ^ points[j]).count("1") <= S.RADIUS:
                    assert forest.root(i) == forest.root(j)


def test_tables():
    assert S.tables_for(1000) == (5, 1) and S.tables_for(10**8) == (6, 2) and S.tables_for(10**15) == (8, 4)
    for blocks, agree in S.TABLES:
        assert blocks - agree == S.RADIUS  # so many differing bits leave the other blocks alike
        assert len({m % U64 for m in S.block_masks(blocks, agree)}) == len(S.block_masks(blocks, agree))


@pytest.mark.parametrize("shard_rows", [4, 4096])
def test_classes(spark, stage, shard_rows):
    points = chained(np.random.default_rng(5), 500)
    signed = [p - U64 if p >> 63 else p for p in points]
    rows = spark.createDataFrame([(1000 + i, p) for i, p in enumerate(signed)], "doc_id long, fingerprint long")
    found = {r[0]: r[1] for r in S.node_classes(rows, "doc_id", stage, shard_rows).collect()}
    assert [found[p] for p in signed] == [1000 + r for r in plain_classes(points)]


@pytest.mark.parametrize("splits", [2, 3])
def test_hot_block_split_again(spark, stage, monkeypatch, splits):
    monkeypatch.setattr(S, "SPLITS", splits)
    rng = np.random.default_rng(8)
    masks = [m % U64 for m in S.block_masks(5, 1)]
    pairs = []
    for base in rng.integers(0, U64, 2000, dtype=np.uint64).tolist():
        base &= ~masks[0]
        flips = [1 << int(rng.choice([b for b in range(64) if m >> b & 1])) for m in masks[1:]]
        pairs.append((base, base ^ sum(flips)))
    signed = [[p - U64 if p >> 63 else p for p in pair] for pair in pairs]
    nodes = spark.createDataFrame([(p,) for p in {p for pair in signed for p in pair}], "fp long")
    found = {frozenset(r) for r in S.links(nodes, nodes.count(), stage, shard_rows=64).collect()}
    assert {frozenset(pair) for pair in signed} <= found


def test_shards_that_stay_large(spark, stage):
    rng = np.random.default_rng(9)
    center = int(rng.integers(0, U64, dtype=np.uint64))
    flips = [rng.choice(64, int(rng.integers(0, 8)), replace=False).tolist() for _ in range(600)]
    points = sorted({center ^ sum(1 << b for b in f) for f in flips})
    signed = [p - U64 if p >> 63 else p for p in points]
    nodes = spark.createDataFrame([(p,) for p in signed], "fp long")
    limits = {"shard_rows": 20, "block_rows": 30}
    rows = S.shards(nodes, len(points), stage, "shards", **limits)
    assert rows.groupBy("choice", "part", "shells").count().agg({"count": "max"}).first()[0] <= 4 * 30
    roots = {r[0]: r[1] for r in S.components(S.links(nodes, len(points), stage, **limits), stage).collect()}
    found = [roots.get(p, p) for p in signed]
    expected = plain_classes(points)
    assert len(set(zip(found, expected))) == len(set(found)) == len(set(expected))


def test_finer_tables_agree(spark, stage):
    points = chained(np.random.default_rng(6), 400)
    nodes = spark.createDataFrame([(p - U64 if p >> 63 else p,) for p in set(points)], "fp long")
    roots = []
    for count in (400, 10**8, 10**10):
        edges = S.links(nodes, count, stage, f"links-{count}")
        roots.append({tuple(r) for r in S.components(edges, stage, f"classes-{count}").collect()})
    assert roots[0] == roots[1] == roots[2] and roots[0]


def test_documents(spark, stage):
    texts = ["the cat sat on the mat " * 30, "the cat sat on the mat " * 30 + "x", "THE CAT SAT ON THE MAT " * 30, None, "", "  \n", "word", "other", "a b c", "q " * 4000]
    rows = [(i, t, "f") for i, t in enumerate(texts)] + [(0, texts[0], "f"), (None, "word", "f"), (None, "alone here", None)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, fingerprint string")
    found = S.near_duplicates(docs, stage).collect()
    points = [plain_fingerprint(t) for _, t, _ in rows]
    ids = [r[0] for r in rows]
    roots = plain_classes(points)
    expected = []
    for (i, _, _), p, root in zip(rows, points, roots):
        same = [ids[j] for j in range(len(rows)) if roots[j] == root and ids[j] is not None]
        expected.append((i, f"{p:016x}", min(same, default=None)))
    assert sorted(map(tuple, found), key=repr) == sorted(expected, key=repr)


def test_no_documents(spark, stage):
    docs = spark.createDataFrame([], "doc_id long, text string")
    assert S.near_duplicates(docs, stage).collect() == []


def test_hot_cluster_leaves_a_forest():
    center = np.uint64(0x0123456789ABCDEF)
    flips = [np.uint64(1 << a | 1 << b) for a in range(64) for b in range(a)]
    points = np.array([center, *(center ^ f for f in flips)], np.uint64)
    assert len(S.tree_links(points, np.ones(len(points), bool))) == len(points) - 1
