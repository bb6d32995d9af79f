"""Whitening of embeddings by Golub-Kahan-Lanczos bidiagonalisation of the centred rows.

1. Entries become integers, so that counts, sums and centred rows ``n * x - S`` are exact; the centred matrix X, in
   doubles, is staged in blocks of rows.
2. ``bidiagonalised``: from a unit vector v on, products Xv and Xᵀu alternate, one scan of the blocks for both: each
   block takes its part of u = Xw, and of Xᵀu. A left vector is never stored: it is u = Xw, with w known, so its product with
   another left vector Xz is that of w with XᵀXz, and the left side is orthogonalised in full without moving a row. Both sides
   are orthogonalised twice, and a scan is repeated where the left side cancelled most of its digits.
3. The small bidiagonal matrix's singular values and right vectors give components and deviations. Steps end when the
   wanted components have converged to rounding, or with the dimensions. Where the vectors reached so far span an invariant
   subspace (equal eigenvalues, too few rows), another vector orthogonal to them goes on.
4. ``whitened``: rows are projected on the components, over the root of their variance.

A deviation's relative error is about 1e-16 times the squared ratio of the largest one to it.

What the driver holds are vectors of one entry for each dimension and step; a scan brings it one such vector, summed by
Spark. Vectors of the rows stay where they are.

Cases: rows whose vector is null or holds a null or non-finite entry, or one of 2 ** 56 or more, are dropped; a missing
entry of a shorter vector counts as 0; components without variance (equal rows, fewer rows than dimensions) are left
out, so rows that are all equal return nothing; repeated rows count and return each; a null id stays null; a deviation
beyond 64 bits is null; an empty table gives an empty one; other columns are ignored, whatever their names.
"""

from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from sluice.llm.common import matrix
from sluice.operators.stage import Stage

COMPONENTS = 32
SCALE, SHIFT = 64, 1_000_000
LIMIT = 2.0**56
#: Numbers in a block of the centred matrix.
BLOCK_CELLS = 1 << 17
#: Of the largest singular value: what counts as converged, and what as no variance.
CONVERGED, NOTHING = 1e-15, 1e-11
#: Of the squared length: a left vector that keeps less in being orthogonalised is scanned again, so many times in all.
CANCELLED, SCANS = 1e-4, 3
SEED = 7
OUT_DDL = "id long, component int, n long, deviation long, whitened double, explained double, identity_error double"
LONG = 1 << 63

Product = Callable[[np.ndarray], np.ndarray]


def quantised(vectors: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding", scale: int = SCALE, shift: int = SHIFT) -> DataFrame:
    """(id, x) of the rows that take part."""
    number = lambda c: c.cast("double")
    fits = F.forall(vector_col, lambda c: F.coalesce(~F.isnan(number(c)) & (F.abs(number(c)) < LIMIT), F.lit(False)))
    x = F.transform(vector_col, lambda c: F.floor(number(c) * scale) + F.lit(shift).cast("long"))
    return vectors.where(F.col(vector_col).isNotNull() & fits).select(F.col(id_col).cast("long").alias("id"), x.alias("x"))


def _summed(rows: DataFrame, part: Callable[[pa.RecordBatch], np.ndarray], kind: type) -> np.ndarray:
    """The sum of an array of numbers over all batches: one array a task, added by Spark."""
    ddl = "at long, value " + ("long" if kind is np.int64 else "double")

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = None
        for batch in batches:
            if batch.num_rows:
                own = part(batch)
                total = own if total is None else total + own
        if total is not None:
            yield pa.record_batch([pa.array(np.arange(total.size)), pa.array(total.ravel().astype(kind))], names=["at", "value"])

    sums = rows.mapInArrow(work, ddl).groupBy("at").agg(F.sum("value").alias("value")).orderBy("at").toArrow()
    return sums["value"].to_numpy()


@dataclass(frozen=True)
class Centre:
    """The number of rows, and the sum of each dimension."""

    n: int
    sums: list[int]

    def rows(self, x: pa.Array) -> np.ndarray:
        """``n * x - S`` of each row, exactly: as 64-bit integers, or Python's where they do not suffice."""
        x = matrix(x, len(self.sums), SHIFT)
        largest = max(int(x.max(initial=0)), -int(x.min(initial=0)))
        if self.n * largest + max(map(abs, self.sums), default=0) < LONG:
            return self.n * x - np.array(self.sums, np.int64)
        return self.n * x.astype(object) - np.array(self.sums, object)


def centre(rows: DataFrame, n: int, width: int) -> Centre:
    def halves(batch: pa.RecordBatch) -> np.ndarray:
        x = matrix(batch["x"], width, SHIFT)
        return np.concatenate([(x >> 32).sum(axis=0), (x & 0xFFFFFFFF).sum(axis=0)])

    sums = [int(v) for v in _summed(rows, halves, np.int64)] or [0] * 2 * width
    return Centre(n, [(high << 32) + low for high, low in zip(sums[:width], sums[width:])])


def centred_blocks(rows: DataFrame, middle: Centre) -> DataFrame:
    """(cells): the rows of X, many to a block, as doubles."""
    width = len(middle.sums)

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        at_once = max(1, BLOCK_CELLS // max(1, width))
        for batch in batches:
            for first in range(0, batch.num_rows, at_once):
                x = middle.rows(batch["x"].slice(first, at_once)).astype(np.float64) / middle.n
                yield pa.record_batch([pa.array([np.ascontiguousarray(x).tobytes()], pa.binary())], names=["cells"])

    return rows.select("x").mapInArrow(work, "cells binary")


def _blocks(batch: pa.RecordBatch, width: int) -> Iterator[np.ndarray]:
    for cells in batch["cells"]:
        yield np.frombuffer(cells.as_buffer(), np.float64).reshape(-1, width)


def gram_product(blocks: DataFrame, width: int) -> Product:
    """w to Xᵀ(Xw), one scan."""

    def product(w: np.ndarray) -> np.ndarray:
        def part(batch: pa.RecordBatch) -> np.ndarray:
            return sum(x.T @ (x @ w) for x in _blocks(batch, width))

        return _summed(blocks, part, np.float64)

    return product


def _without(vector: np.ndarray, basis: list[np.ndarray]) -> np.ndarray:
    """What is left of a vector orthogonal to a basis; twice, as once leaves rounding of what it took away."""
    if basis:
        rows = np.array(basis)
        for _ in range(2):
            vector = vector - rows.T @ (rows @ vector)
    return vector


def bidiagonalised(product: Product, width: int, wanted: int, length: float) -> tuple[np.ndarray, np.ndarray]:
    """(singular values, right vectors as rows) of X, largest first, at least ``wanted`` of them if X has so many.

    ``product`` is w to XᵀXw, ``length`` the root of the sum of X's squares.
    """
    random = np.random.default_rng(SEED)

    def fresh() -> np.ndarray:
        left = _without(random.normal(size=width), right)
        return left / np.linalg.norm(left)

    right, lefts, images, diagonal, above = [], [], [], [], []  # v, w of u = Xw, Xᵀu
    v = fresh()
    while True:
        w, size = v, 0.0
        for _ in range(SCANS):
            image = product(w)
            before = float(w @ image)
            if lefts:
                for _ in range(2):
                    taken = np.array(lefts) @ image
                    w, image = w - taken @ np.array(lefts), image - taken @ np.array(images)
            after = float(w @ image)
            if after > CANCELLED * before:
                size = np.sqrt(after)
                break
        # What cancels again and again is rounding: Xv lies in the span of the left vectors.
        w, image = (w / size, image / size) if size > 1e-14 * length else (np.zeros(width), np.zeros(width))
        right.append(v)
        lefts.append(w)
        images.append(image)
        diagonal.append(size if image.any() else 0.0)
        values, vectors, rest, goes_on = _decomposed(diagonal, above, right, image)
        if len(right) == width or (np.abs(rest[:wanted]) <= CONVERGED * values[0]).all() and len(right) >= wanted and goes_on is not None:
            return values, vectors
        if goes_on is None:
            above.append(0.0)
            v = fresh()
        else:
            above.append(float(np.linalg.norm(goes_on)))
            v = goes_on / above[-1]


def _decomposed(diagonal: list[float], above: list[float], right: list[np.ndarray], image: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray | None]:
    """Singular values and right vectors so far, how far each is from converged, and what Xᵀu adds to the space, if anything."""
    left, values, small = np.linalg.svd(np.diag(diagonal) + np.diag(above, 1))
    new = _without(image, right)
    added = float(np.linalg.norm(new))
    ended = added <= 1e-14 * values[0] or len(right) == len(image)
    return values, small @ np.array(right), added * left[-1], None if ended else new


@dataclass(frozen=True)
class Fit:
    """Components as rows, their variances, and the variance of all dimensions together."""

    middle: Centre
    components: np.ndarray
    variances: np.ndarray
    trace: float

    def whiten(self, exact: np.ndarray) -> np.ndarray:
        """Whitened coordinates of rows ``n * x - S``."""
        return exact.astype(np.float64) / self.middle.n @ (self.components / np.sqrt(self.variances)[:, None]).T


def fit(rows: DataFrame, n: int, width: int, stage: Stage, components: int = COMPONENTS) -> Fit:
    middle = centre(rows, n, width)
    blocks = stage.write(centred_blocks(rows, middle), "centred").rows
    squares = _summed(blocks, lambda batch: np.array([sum(float((x * x).sum()) for x in _blocks(batch, width))]), np.float64)
    square = float(squares.sum())
    if square == 0:
        return Fit(middle, np.zeros((0, width)), np.zeros(0), 0.0)
    values, vectors = bidiagonalised(gram_product(blocks, width), width, min(components, width), np.sqrt(square))
    kept = np.flatnonzero(values[:components] > NOTHING * values[0])
    vectors = vectors[kept]
    signs = np.sign(vectors[np.arange(len(kept)), np.abs(vectors).argmax(axis=1)])
    return Fit(middle, vectors * signs[:, None], values[kept] ** 2 / n, square / n)


def identity_error(rows: DataFrame, found: Fit) -> float:
    """The largest entry of the whitened rows' covariance minus the identity; they are centred before it is taken."""
    k = len(found.variances)

    def part(batch: pa.RecordBatch) -> np.ndarray:
        z = found.whiten(found.middle.rows(batch["x"]))
        return z.T @ z

    return float(np.abs(_summed(rows, part, np.float64).reshape(k, k) / found.middle.n - np.eye(k)).max())


def whitened(vectors: DataFrame, stage: Stage, id_col: str = "vec_id", vector_col: str = "embedding", components: int = COMPONENTS) -> DataFrame:
    """(id, component, n, deviation, whitened, explained, identity_error), a row for each row and component."""
    staged = stage.write(quantised(vectors, id_col, vector_col), "rows", [F.coalesce(F.max(F.size("x")), F.lit(0)).alias("width")])
    rows, width = staged.rows, staged.figures["width"]
    empty = vectors.sparkSession.createDataFrame([], OUT_DDL).withColumnRenamed("id", id_col)
    if not staged.count or not width:
        return empty
    found = fit(rows, staged.count, width, stage, components)
    k = len(found.variances)
    if not k:
        return empty
    error, explained = identity_error(rows, found), found.variances / found.trace
    at_once = max(1, BLOCK_CELLS // max(width, k))

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for first in range(0, batch.num_rows, at_once):
                part = batch.slice(first, at_once)
                exact, m = found.middle.rows(part["x"]), part.num_rows
                largest = max(int(exact.max()), -int(exact.min()))
                whole = exact if largest**2 * width < LONG else exact.astype(object)
                deviations = [int(d) if d < LONG else None for d in (whole * whole).sum(axis=1)]
                of = pa.array(np.repeat(np.arange(m), k))
                yield pa.record_batch(
                    [
                        part["id"].take(of),
                        pa.array(np.tile(np.arange(1, k + 1, dtype=np.int32), m)),
                        pa.array(np.full(m * k, found.middle.n)),
                        pa.array(deviations, pa.int64()).take(of),
                        pa.array(found.whiten(exact).ravel()),
                        pa.array(np.tile(explained, m)),
                        pa.array(np.full(m * k, error)),
                    ],
                    names=["id", "component", "n", "deviation", "whitened", "explained", "identity_error"],
                )

    return rows.mapInArrow(work, OUT_DDL).withColumnRenamed("id", id_col)
