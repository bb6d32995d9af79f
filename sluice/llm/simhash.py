"""Near-duplicates by SimHash: fingerprints linked within a Hamming distance, searched by vantage-point trees.

1. ``fingerprints``: 64 bits a text, the majority of the bits of its shingles' hashes.
2. Equal fingerprints are one node. ``links`` deals the nodes to shards: fingerprints at most ``radius`` bits apart
   agree in some choice of ``agree`` out of ``blocks`` blocks of bits, so each such choice is a table and its bits a
   shard. A shard of more than ``shard_rows`` nodes is partitioned by Hamming distance to a vantage point of its
   own, in shells; a node near the inner boundary of its shell is also a query of the next shell inwards, as the
   triangle bound demands, and one that is only a query also of the next shell outwards. That is repeated with
   further vantage points; shards that stay large are compared block by block.
3. Within a shard a vantage-point tree finds all pairs within the radius, and a spanning forest of them leaves it:
   never all pairs of a group.
4. ``components`` joins the links to classes by the large-star and small-star rounds, staged round by round.

A vantage-point tree alone prunes little here: distances of unrelated fingerprints crowd around 32 of 64 bits, so the
bounds would send a query to most shards. Hence the shards are dealt by blocks first.

Cases: a null or empty text has no words and fingerprint zero, linked like any other; a text of fewer words than a
shingle is one shingle; repeated rows each return a row; a null id is never the smallest of a class, and a class
of null ids has a null one; an empty table gives an empty one; other columns are ignored.
"""

from collections.abc import Iterator
from itertools import accumulate, combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, Window, functions as F

from sluice.llm.common import per_text, text_key
from sluice.operators.stage import Stage

BITS = 64
SHINGLE_WORDS = 4
RADIUS = 4
SEED = 42
LEAF = 48
#: Nodes of a shard that one vantage-point tree takes without being partitioned further, and the partitions tried.
SHARD_ROWS = 4096
SPLITS = 3
#: Rows of a shard, its queries included, that one task takes after that; more are cut into blocks.
BLOCK_ROWS = 65_536
#: Blocks of a fingerprint and how many of them agree for a radius of four, coarse tables first.
TABLES = ((5, 1), (6, 2), (7, 3), (8, 4))
#: The mean shard of a choice of tables may hold so many nodes.
MEAN_SHARD = 512
SHELL = 2 * RADIUS


def simhash(text: str, words_in_shingle: int = SHINGLE_WORDS) -> int:
    """The fingerprint as a signed 64-bit number."""
    words = text.encode("utf-8", "replace").lower().split()  # of bytes: A-Z and the six blanks only
    if not words:
        return 0
    joined, size = b" ".join(words), min(words_in_shingle, len(words))
    starts = list(accumulate((len(w) + 1 for w in words), initial=0))
    digest = xxhash.xxh64_digest
    hashes = b"".join([digest(joined[a : b - 1], SEED) for a, b in zip(starts, starts[size:])])
    bits = np.unpackbits(np.frombuffer(hashes, np.uint8).reshape(-1, 8), axis=1)
    ones = bits.sum(axis=0, dtype=np.int64) * 2 > len(bits)
    return int.from_bytes(np.packbits(ones).tobytes(), "big", signed=True)


def fingerprints(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", words_in_shingle: int = SHINGLE_WORDS) -> DataFrame:
    """(id, fingerprint long) of every row."""
    fingerprint = per_text(lambda: lambda text: simhash(text, words_in_shingle), pa.int64(), "long")
    return docs.select(id_col, fingerprint(F.col(text_col)).alias("fingerprint"))


def hex_digits(fingerprint: Column) -> Column:
    return F.lpad(F.lower(F.hex(fingerprint)), 16, "0")


# Pairs within one shard


def _apart(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    return np.bitwise_count(a ^ b)


class _Forest:
    """Which rows are already connected."""

    def __init__(self, size: int):
        self.up = list(range(size))

    def root(self, i: int) -> int:
        while self.up[i] != i:
            self.up[i] = i = self.up[self.up[i]]
        return i

    def join(self, i: int, j: int) -> bool:
        a, b = self.root(i), self.root(j)
        self.up[max(a, b)] = min(a, b)
        return a != b


def tree_links(points: np.ndarray, home: np.ndarray, radius: int = RADIUS, leaf: int = LEAF) -> list[tuple[int, int]]:
    """Index pairs that connect what the pairs within the radius connect; of each, a point's ``home`` is here.

    ``points`` are unsigned 64-bit fingerprints. Points at home make up the tree; all points query it. A node holds
    a vantage point and the median distance to it; a query goes to the near side if its distance less the radius
    does not exceed the median, to the far side if its distance plus the radius does.
    """
    forest, found = _Forest(len(points)), []

    def match(queries: np.ndarray, members: np.ndarray) -> None:
        for at in range(0, len(queries), 4096):
            some = queries[at : at + 4096]
            near = _apart(points[some][:, None], points[members][None, :]) <= radius
            near &= some[:, None] != members[None, :]
            rows = np.flatnonzero(near.any(axis=1))
            if not len(rows):
                continue
            near = near[rows]
            join(some[rows], members[near.argmax(axis=1)])
            # Two members with a common query are in one class.
            a, b = np.nonzero(np.triu(near.T.astype(np.int32) @ near.astype(np.int32), 1))
            join(members[a], members[b])

    def join(left: np.ndarray, right: np.ndarray) -> None:
        found.extend((a, b) for a, b in zip(left.tolist(), right.tolist()) if forest.join(a, b))

    todo = [(np.flatnonzero(home), np.arange(len(points)))]
    while todo:
        members, queries = todo.pop()
        if not len(members) or not len(queries):
            continue
        if len(members) <= leaf:
            match(queries, members)
            continue
        vantage = points[members[0]]
        inner = _apart(points[members], vantage)
        median = int(np.median(inner))
        near_side = inner <= median
        if near_side.all():  # no cut by this vantage point: cut in halves, which both get every query
            half = len(members) // 2
            todo += [(members[:half], queries), (members[half:], queries)]
            continue
        reach = _apart(points[queries], vantage).astype(np.int64)
        todo.append((members[near_side], queries[reach - radius <= median]))
        todo.append((members[~near_side], queries[reach + radius > median]))
    return found


def _shard_links(leaf: int = LEAF):
    """Links of shards whose rows follow each other; a shard may go on in the next batch."""
    edges = pa.schema([("a", pa.int64()), ("b", pa.int64())])

    def links_of(points: np.ndarray, home: np.ndarray) -> pa.RecordBatch | None:
        if len(points) < 2:
            return None
        pairs = tree_links(points.view(np.uint64), home, RADIUS, leaf)
        if not pairs:
            return None
        ends = points[np.array(pairs)]
        return pa.RecordBatch.from_arrays([pa.array(ends.min(axis=1)), pa.array(ends.max(axis=1))], schema=edges)

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kept: list[np.ndarray] = []
        last = None
        for batch in batches:
            shard = np.stack([batch.column(c).to_numpy(zero_copy_only=False) for c in ("choice", "part", "shells")])
            rows = np.stack([batch.column("fp").to_numpy(zero_copy_only=False), batch.column("home").to_numpy(zero_copy_only=False)])
            cuts = [0, *(np.flatnonzero((shard[:, 1:] != shard[:, :-1]).any(axis=0)) + 1), shard.shape[1]]
            for start, end in zip(cuts, cuts[1:]):
                if start == end:
                    continue
                if kept and tuple(shard[:, start]) != last:
                    whole = np.concatenate(kept, axis=1)
                    kept = []
                    if (out := links_of(np.ascontiguousarray(whole[0]), whole[1] == 1)) is not None:
                        yield out
                last = tuple(shard[:, start])
                kept.append(rows[:, start:end])
        if kept:
            whole = np.concatenate(kept, axis=1)
            if (out := links_of(np.ascontiguousarray(whole[0]), whole[1] == 1)) is not None:
                yield out

    return work


# Shards


def tables_for(nodes: int) -> tuple[int, int]:
    """The coarsest blocks and agreements whose mean shard is small enough."""
    fits = (t for t in TABLES if nodes <= MEAN_SHARD << (BITS * t[1] // t[0]))
    return next(fits, TABLES[-1])


def block_masks(blocks: int, agree: int) -> list[int]:
    """Signed masks of the bits that agree, one for each choice of blocks."""
    edges = [BITS * i // blocks for i in range(blocks + 1)]
    block = [(1 << b) - (1 << a) for a, b in zip(edges, edges[1:])]
    masks = [sum(block[i] for i in choice) for choice in combinations(range(blocks), agree)]
    return [m - (1 << BITS) if m >> (BITS - 1) else m for m in masks]


def _split(rows: DataFrame, shard_rows: int) -> DataFrame:
    """Large shards by Hamming distance to the shard's vantage point, in shells; small ones as they are.

    Two nodes within the radius lie in one shell or in neighbouring ones; the outer of them is then within the
    radius of the boundary, and goes to the inner shell as a query. If the inner one is a query already, which queries
    do not find, it also goes to the outer shell, where the other is at home.
    """
    shard = ["choice", "part", "shells"]
    large = rows.groupBy(*shard).agg(F.sum("home").alias("_n"), F.max(F.struct(F.xxhash64("fp"), "fp"))["fp"].alias("_v"))
    large = large.where(F.col("_n") > shard_rows).drop("_n")
    away = F.bit_count(F.col("fp").bitwiseXOR(F.col("_v")))
    shell = F.floor(away / SHELL).cast("int")
    inwards = (away % SHELL < RADIUS) & (shell > 0)
    outwards = (away % SHELL >= SHELL - RADIUS) & (F.col("home") == 0)
    places = F.when(F.col("_v").isNull(), F.array(F.struct(F.lit(0).alias("s"), F.col("home").alias("h")))).otherwise(
        F.filter(
            F.array(
                F.struct((shell + 1).alias("s"), F.col("home").alias("h")),
                F.when(inwards, F.struct(shell.alias("s"), F.lit(0).alias("h"))),
                F.when(outwards, F.struct((shell + 2).alias("s"), F.lit(0).alias("h"))),
            ),
            lambda p: p.isNotNull(),
        )
    )
    return rows.join(large, shard, "left").select(
        "fp", "choice", "part", F.col("shells"), F.explode(places).alias("p")
    ).select("fp", "choice", "part", (F.col("shells") * 16 + F.col("p.s")).alias("shells"), F.col("p.h").alias("home"))


def _blocks(rows: DataFrame, block_rows: int) -> DataFrame:
    """Shards of too many rows as pairs of blocks: members of the one, queries of the other.

    Two members meet in one pair of blocks, a member and a query too. So nothing is lost, and no task grows; the work
    of such a shard grows with the square of its rows.
    """
    shard = ["choice", "part", "shells"]
    large = rows.groupBy(*shard).agg(F.count("*").alias("_n")).where(F.col("_n") > block_rows)
    large = large.select(*shard, F.ceil(F.col("_n") / block_rows).alias("_k"))
    if large.isEmpty():
        return rows
    own = F.pmod(F.xxhash64("fp"), F.col("_k"))
    each = F.sequence(F.lit(0).cast("long"), F.col("_k") - 1)
    pair = lambda member, query: (F.col("shells") + 1) * (1 << 40) + member * (1 << 20) + query
    queries = F.transform(F.filter(each, lambda i: (F.col("home") == 0) | (i > own)), lambda i: F.struct(pair(i, own).alias("s"), F.lit(0).alias("h")))
    members = F.transform(F.filter(each, lambda j: F.col("home") == 1), lambda j: F.struct(pair(own, j).alias("s"), F.lit(1).alias("h")))
    places = F.when(F.col("_k").isNull(), F.array(F.struct(F.col("shells").alias("s"), F.col("home").alias("h")))).otherwise(F.concat(queries, members))
    return rows.join(large, shard, "left").select("fp", "choice", "part", F.explode(places).alias("p")).select(
        "fp", "choice", "part", F.col("p.s").alias("shells"), F.col("p.h").alias("home")
    )


def shards(nodes: DataFrame, count: int, stage: Stage, name: str = "links", shard_rows: int = SHARD_ROWS, block_rows: int = BLOCK_ROWS) -> DataFrame:
    """(fp, choice, part, shells, home): the rows of every shard, in which tasks look for pairs."""
    masks = block_masks(*tables_for(count))
    choices = F.array(*[F.struct(F.lit(i).alias("choice"), F.col("fp").bitwiseAND(F.lit(m)).alias("part")) for i, m in enumerate(masks)])
    rows = nodes.select("fp", F.explode(choices).alias("c")).select(
        "fp", "c.*", F.lit(0).cast("long").alias("shells"), F.lit(1).alias("home")
    )
    for level in range(SPLITS):
        sizes = rows.groupBy("choice", "part", "shells").agg(F.sum("home").alias("n"))
        if sizes.where(F.col("n") > shard_rows).isEmpty():
            if level == 0:
                return rows
            break
        rows = stage.write(_split(rows, shard_rows), f"{name}-split-{level}").rows
    return _blocks(rows, block_rows)


def links(
    nodes: DataFrame, count: int, stage: Stage, name: str = "links", shard_rows: int = SHARD_ROWS, block_rows: int = BLOCK_ROWS
) -> DataFrame:
    """(a, b): links that connect what pairs of ``nodes`` (fp) within the radius connect."""
    shard = ["choice", "part", "shells"]
    together = shards(nodes, count, stage, name, shard_rows, block_rows).repartition(*shard).sortWithinPartitions(*shard)
    return together.mapInArrow(_shard_links(), "a long, b long")


# Classes


def components(edges: DataFrame, stage: Stage, name: str = "classes") -> DataFrame:
    """(node, root): the smallest node that each node of the undirected ``edges`` (a, b) reaches."""
    ends = F.sum(F.xxhash64("a", "b").cast("decimal(38,0)")).alias("ends")
    now = stage.write(edges.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).where("a <> b").distinct(), f"{name}-0", [ends], narrow=True)
    turn = 0
    while True:
        both = now.rows.unionByName(now.rows.select(F.col("b").alias("a"), F.col("a").alias("b")))
        least = both.groupBy("a").agg(F.least("a", F.min("b")).alias("m"))
        large = both.join(least, "a").where("b > a").select(F.col("b").alias("a"), F.col("m").alias("b")).where("a <> b").distinct()
        large = stage.write(large, f"{name}-{turn}-large", narrow=True).rows
        least = large.groupBy("a").agg(F.min("b").alias("m"))
        small = large.join(least, "a")
        small = small.select(F.col("b").alias("a"), F.col("m").alias("b")).unionByName(least.select("a", F.col("m").alias("b")))
        turn += 1
        after = stage.write(small.where("a <> b").distinct(), f"{name}-{turn}", [ends], narrow=True)
        if (after.count, after.figures["ends"]) == (now.count, now.figures["ends"]):
            return after.rows.select(F.col("a").alias("node"), F.col("b").alias("root"))
        now = after


def near_duplicates(
    docs: DataFrame, stage: Stage, id_col: str = "doc_id", text_col: str = "text", words_in_shingle: int = SHINGLE_WORDS, shard_rows: int = SHARD_ROWS
) -> DataFrame:
    """(id, fingerprint as 16 hexadecimal digits, component_id): the smallest id that each row reaches by links."""
    rows = stage.write(fingerprints(docs, id_col, text_col, words_in_shingle), "fingerprints", narrow=True).rows
    classes = node_classes(rows, id_col, stage, shard_rows)
    return rows.join(classes, "fingerprint").select(id_col, hex_digits(F.col("fingerprint")).alias("fingerprint"), "component_id")


def node_roots(rows: DataFrame, id_col: str, stage: Stage, shard_rows: int = SHARD_ROWS) -> DataFrame:
    """(fp, least_id, root) of the distinct fingerprints of staged (id, fingerprint) rows."""
    nodes = stage.write(rows.groupBy(F.col("fingerprint").alias("fp")).agg(F.min(id_col).alias("least_id")), "nodes")
    roots = components(links(nodes.rows.select("fp"), nodes.count, stage, shard_rows=shard_rows), stage)
    return nodes.rows.join(roots, F.col("fp") == F.col("node"), "left").withColumn("root", F.coalesce("root", "fp"))


def node_classes(rows: DataFrame, id_col: str, stage: Stage, shard_rows: int = SHARD_ROWS) -> DataFrame:
    """(fingerprint, component_id) of staged (id, fingerprint) rows."""
    rooted = node_roots(rows, id_col, stage, shard_rows)
    smallest = rooted.groupBy("root").agg(F.min("least_id").alias("component_id"))
    return rooted.join(smallest, "root").select(F.col("fp").alias("fingerprint"), "component_id")


def one_of_each(docs: DataFrame, stage: Stage, id_col: str = "doc_id", text_col: str = "text", words_in_shingle: int = SHINGLE_WORDS) -> DataFrame:
    """The rows of ``docs`` that stand for their class: of each, the row with the smallest id, one of equal ones.

    What stays is decided on narrow rows, with partial aggregation; texts move once, to meet the decisions.
    """
    narrow = docs.select(id_col, text_col).withColumn("key", text_key(F.col(text_col)))
    fingerprint = per_text(lambda: lambda text: simhash(text, words_in_shingle), pa.int64(), "long")
    narrow = narrow.select(F.col(id_col).alias("id"), "key", fingerprint(F.col(text_col)).alias("fingerprint"))
    rows = stage.write(narrow, "fingerprints", narrow=True).rows
    roots = node_roots(rows, "id", stage).select(F.col("fp").alias("fingerprint"), "root")
    first = F.min(F.struct(F.col("id").isNull().alias("no_id"), "id", "key")).alias("first")
    kept = rows.join(roots, "fingerprint").groupBy("root").agg(first).select(_name(F.col("first.id")).alias("_id"), F.col("first.key").alias("_key"))
    whole = docs.select(F.struct("*").alias("_row"), _name(F.col(id_col)).alias("_id"), text_key(F.col(text_col)).alias("_key"))
    turn = F.row_number().over(Window.partitionBy("_id", "_key").orderBy(F.lit(0)))
    return whole.join(kept, ["_id", "_key"]).withColumn("_turn", turn).where("_turn = 1").select("_row.*")


def _name(id_: Column) -> Column:
    return F.coalesce(id_.cast("string"), F.lit(""))
