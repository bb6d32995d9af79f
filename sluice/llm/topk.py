"""Exact top-k inner products by the threshold algorithm over sorted lists, one for each dimension.

1. Components become integers, rows are dealt evenly to blocks of at most ``BLOCK_CELLS`` components.
2. In a block each dimension is a sorted list; a query reads a list from its top where its component is positive and
   from its bottom where it is negative. A row is seen at the depth at which the first list holds it (``depths``), and
   is then scored in whole. After each depth the scores of all rows not seen are at most the threshold, the score of
   the values just read. A query stops when the threshold is below its kth score, a tie being read on.
3. A query first searches the block in which it lies itself. Its kth score there is a bound that it takes to all other
   blocks: it stops there as soon as the threshold cannot reach the bound, often before it reads anything.
4. The best of all blocks are the result.

Queries of a block go through the lists together, doubling the rows seen at each step, so scores are matrix products.
They meet a block one batch at a time; what a task holds is one block, whatever the number of queries. In many dimensions
without structure no threshold algorithm stops early: then all rows are seen and the work is that of scoring them.

Arithmetic is exact: products of doubles while all sums stay below 2 ** 53, of integers beyond; a component beyond 64
bits counts as the nearest number of 64 bits, and so does a score.

Cases: a vector that is null or holds a null or non-finite component takes no part; missing components of shorter vectors,
all of an empty one, count as 0; ties go to the smaller id, a null id last; repeated rows are rows of their own, each a
query and a candidate of the others; a null id is no query; an empty table gives an empty one; other columns are
ignored, whatever their names.
"""

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window, functions as F

from sluice.llm.common import matrix
from sluice.operators.stage import Stage

TOP = 5
SCALE = 256
QUERY_EVERY = 50
BLOCK_CELLS = 1 << 22
LEAST_BLOCKS = 24
#: Scores that a step holds at once.
STEP_CELLS = 1 << 21
FIRST_ROWS = 64
EXACT = 1 << 53
LONG = 1 << 63
HITS_DDL = "query_row long, query_id long, vec_id long, score long, kth long"
HITS = pa.schema([("query_row", pa.int64()), ("query_id", pa.int64()), ("vec_id", pa.int64()), ("score", pa.int64()), ("kth", pa.int64())])


def quantised(vectors: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding", scale: int = SCALE) -> DataFrame:
    """(id, x, row) of the rows that take part: x the floors of the scaled components, row a number of its own."""
    number = lambda c: c.cast("double")
    finite = F.forall(vector_col, lambda c: F.coalesce(~F.isnan(number(c)) & (F.abs(number(c)) < float("inf")), F.lit(False)))
    x = F.transform(vector_col, lambda c: F.floor(number(c) * scale))
    return vectors.where(F.col(vector_col).isNotNull() & finite).select(F.col(id_col).cast("long").alias("id"), x.alias("x"), F.monotonically_increasing_id().alias("row"))


def _products(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """a @ b of whole numbers, clipped to 64 bits: of doubles that no sum takes beyond 2 ** 53, or of integers."""
    return np.clip(a @ b, -LONG, LONG - 1) if a.dtype == object else (a @ b).astype(np.int64)


def _largest(x: np.ndarray) -> int:
    return max(-int(x.min(initial=0)), int(x.max(initial=0)))


class Block:
    """Rows of one block as sorted lists."""

    def __init__(self, ids: list[int | None], rows: np.ndarray, x: np.ndarray):
        n, width = x.shape
        order = np.argsort(x, axis=0, kind="stable")
        places = np.empty_like(order)
        np.put_along_axis(places, order, np.arange(n)[:, None], axis=0)
        # Each list is read from both ends, as some queries do the one and some the other.
        depths = np.minimum(places, n - 1 - places).min(axis=1) if width else np.zeros(n, np.int64)
        seen = np.argsort(depths, kind="stable")
        self.depths, self.rows, self.ids = depths[seen], rows[seen], [ids[i] for i in seen.tolist()]
        self.largest = _largest(x)
        self.whole = (x[seen], np.take_along_axis(x, order, axis=0))
        self.real = tuple(part.astype(np.float64) for part in self.whole)
        # The rows in the order in which they win ties: by id, nulls last.
        self.by_id = np.array(sorted(range(n), key=lambda i: (self.ids[i] is None, self.ids[i] or 0)), np.int64)
        self.tie = np.empty(n, np.int64)
        self.tie[self.by_id] = np.arange(n)

    def search(self, queries: np.ndarray, own: np.ndarray, bounds: list[int | None], k: int) -> Iterator[tuple[list[int], list[int]]]:
        """For each query the places of its best rows here, best first, and their scores; only such as reach its bound.

        ``own`` holds the queries' own rows, which are no candidates of theirs; ``bounds`` the scores to reach, or None.
        """
        n, width = len(self.rows), queries.shape[1]
        most = _largest(queries) * self.largest * width
        if most < EXACT and self.largest < EXACT:
            rows, lists = self.real
        else:
            rows, lists = (part.astype(np.int64 if most < LONG // 4 else object) for part in self.whole)
        queries = queries.astype(rows.dtype)
        # A score and the row's place among ties as one number; a larger one is better.
        kind = np.int64 if most * n < LONG // 4 else object
        best = [np.zeros(0, kind) for _ in bounds]
        floors = np.array([-LONG if b is None else b for b in bounds], object if rows.dtype == object else np.int64)
        active, seen, step = np.arange(len(queries)), 0, FIRST_ROWS
        while seen < n:
            # No row that is still unseen lies before this depth in any list, from either end.
            depth = int(self.depths[seen])
            threshold = self._threshold(queries[active], lists[n - 1 - depth], lists[depth])
            # A row that ties with the kth may have a smaller id, so only a threshold below it ends the search.
            active = active[threshold >= floors[active]]
            if not len(active):
                break
            end = min(n, seen + step)
            at_once = max(1, STEP_CELLS // (end - seen))
            for some in (active[i : i + at_once] for i in range(0, len(active), at_once)):
                scores = _products(queries[some], rows[seen:end].T)
                reach = (scores >= floors[some][:, None]) & (self.rows[seen:end] != own[some][:, None])
                for i in np.flatnonzero(reach.any(axis=1)).tolist():
                    here, query = np.flatnonzero(reach[i]), some[i]
                    found = scores[i, here].astype(kind) * n + (n - 1 - self.tie[seen + here])
                    ranked = np.sort(np.concatenate([best[query], found]))[-k:]
                    best[query] = ranked
                    if len(ranked) == k:
                        floors[query] = max(floors[query], ranked[0] // n)
            seen, step = end, 2 * end
        for ranked in best:
            numbers = [int(v) for v in ranked[::-1]]
            yield [int(self.by_id[n - 1 - v % n]) for v in numbers], [v // n for v in numbers]

    @staticmethod
    def _threshold(queries: np.ndarray, high: np.ndarray, low: np.ndarray) -> np.ndarray:
        """The most that a row can score whose components lie between ``low`` and ``high``."""
        return _products(np.hstack([np.maximum(queries, 0), np.minimum(queries, 0)]), np.concatenate([high, low]))


def _hits(batches: Iterator[pa.RecordBatch], k: int) -> Iterator[pa.RecordBatch]:
    """Blocks one after the other: first a block's candidates, then its queries, in batches."""
    held, block, number = [], None, None
    for batch in batches:
        blocks, asks = batch["block"].to_numpy(), batch["asks"].to_numpy(zero_copy_only=False)
        cuts = np.flatnonzero(np.concatenate(([True], (blocks[1:] != blocks[:-1]) | (asks[1:] != asks[:-1]))))
        for a, b in zip(cuts.tolist(), [*cuts[1:].tolist(), len(blocks)]):
            part = batch.slice(a, b - a)
            if blocks[a] != number:
                held, block, number = [], None, blocks[a]
            if not asks[a]:
                held.append(part)
            elif held or block:
                if block is None:
                    together = pa.Table.from_batches(held).combine_chunks().to_batches()[0]
                    block, held = Block(together["id"].to_pylist(), together["row"].to_numpy(), matrix(together["x"])), []
                yield _found(block, part, k)


def _found(block: Block, asking: pa.RecordBatch, k: int) -> pa.RecordBatch:
    width = block.whole[0].shape[1]
    # What a query has beyond the block's width meets zeros.
    queries = matrix(asking["x"], width)[:, :width]
    found = list(block.search(queries, asking["row"].to_numpy(), asking["bound"].to_pylist(), k))
    of = pa.array(np.repeat(np.arange(len(found)), [len(places) for places, _ in found]))
    return pa.RecordBatch.from_arrays(
        [
            asking["row"].take(of),
            asking["id"].take(of),
            pa.array([block.ids[p] for places, _ in found for p in places], pa.int64()),
            pa.array([s for _, scores in found for s in scores], pa.int64()),
            pa.array([scores[-1] if len(scores) == k else None for _, scores in found for _ in scores], pa.int64()),
        ],
        schema=HITS,
    )


def top_k(
    vectors: DataFrame, stage: Stage, is_query: Column | None = None, id_col: str = "vec_id", vector_col: str = "embedding", k: int = TOP,
    scale: int = SCALE, block_cells: int = BLOCK_CELLS, least_blocks: int = LEAST_BLOCKS,
) -> DataFrame:
    """(query_id, rank, vec_id, score) of the ``k`` best rows of each query. ``is_query`` is a condition on ``id``."""
    is_query = F.col("id") % QUERY_EVERY == 0 if is_query is None else is_query
    rows = stage.write(quantised(vectors, id_col, vector_col, scale), "rows", [F.coalesce(F.max(F.size("x")), F.lit(0)).alias("width")])
    blocks = max(least_blocks, -(-rows.count * max(1, rows.figures["width"]) // block_cells))
    dealt = rows.rows.withColumn("block", F.pmod(F.xxhash64("row"), F.lit(blocks)))
    candidates = dealt.select("block", F.lit(False).alias("asks"), "row", "id", "x", F.lit(None).cast("long").alias("bound"))
    queries = dealt.where(is_query)

    def hits(asking: DataFrame, name: str) -> DataFrame:
        both = candidates.unionByName(asking.select("block", F.lit(True).alias("asks"), "row", "id", "x", "bound"))
        ordered = both.repartition(blocks, "block").sortWithinPartitions("block", "asks")
        return stage.write(ordered.mapInArrow(lambda batches: _hits(batches, k), HITS_DDL), name).rows

    near = hits(queries.withColumn("bound", F.lit(None).cast("long")), "near")
    bounds = near.groupBy(F.col("query_row").alias("row")).agg(F.max("kth").alias("bound"))
    others = F.filter(F.sequence(F.lit(0).cast("long"), F.lit(blocks - 1).cast("long")), lambda b: b != F.col("block"))
    far = queries.join(bounds, "row", "left").select(F.explode(others).alias("block"), "row", "id", "x", "bound")
    found = near.unionByName(hits(far, "far"))
    order = Window.partitionBy("query_row").orderBy(F.desc("score"), F.asc_nulls_last("vec_id"))
    ranked = found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)
    return ranked.select("query_id", "rank", "vec_id", "score")
