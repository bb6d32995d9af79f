"""Components, deviations and whitened rows against numpy's eigenvectors of the exact covariance."""

import math
from fractions import Fraction

import numpy as np
import pytest

from sluice.llm import whitening as W

SCHEMA = "vec_id long, embedding array<float>, id long, x string, n double"


def expected(rows, components=32):
    """(x of the rows that take part, covariance by exact fractions)."""
    taken = [(i, [math.floor(64 * float(np.float32(c))) + 1_000_000 for c in v]) for i, v, *_ in rows if v is not None and all(c is not None and math.isfinite(c) for c in v)]
    width = max((len(x) for _, x in taken), default=0)
    taken = [(i, x + [1_000_000] * (width - len(x))) for i, x in taken]
    n = len(taken)
    sums = [sum(col) for col in zip(*(x for _, x in taken))]
    centred = [[n * a - s for a, s in zip(x, sums)] for _, x in taken]
    covariance = [[float(Fraction(sum(r[a] * r[b] for r in centred), n**3)) for b in range(width)] for a in range(width)]
    return [i for i, _ in taken], centred, np.array(covariance).reshape(width, width)


def check(found, rows, components=32):
    ids, centred, covariance = expected(rows)
    n = len(ids)
    values = np.linalg.eigvalsh(covariance)[::-1]
    k = min(components, int((values > 1e-9 * values[0]).sum()))
    assert sorted({r["component"] for r in found}) == list(range(1, k + 1))
    assert len(found) == n * k
    assert sorted((r["vec_id"] for r in found), key=repr) == sorted((i for i in ids for _ in range(k)), key=repr)
    assert {r["n"] for r in found} == {n}
    deviations = sorted(sum(c * c for c in row) for row in centred)
    assert sorted(r["deviation"] for r in found if r["component"] == 1) == deviations
    explained = {r["component"]: r["explained"] for r in found}
    np.testing.assert_allclose([explained[c] for c in range(1, k + 1)], values[:k] / values.sum(), rtol=1e-9)
    (error,) = {r["identity_error"] for r in found}
    assert error < 1e-9
    # By row: the order of a Spark result is not given, but squares of whitened coordinates add up to a known distance.
    x = np.array(centred, float) / n
    basis = np.linalg.eigh(covariance)
    top = basis.eigenvectors[:, ::-1][:, :k]
    z = x @ top / np.sqrt(values[:k])
    own = {}
    for r in found:
        own.setdefault((r["vec_id"], r["deviation"]), []).append((r["component"], r["whitened"]))
    distinct = {(i, sum(c * c for c in row)): row_z for i, row, row_z in zip(ids, centred, z)}
    gaps = np.abs(np.diff(values[: k + 1])) / values[0] if len(values) > k else np.append(np.abs(np.diff(values[:k])) / values[0], 1)
    alone = [c for c in range(k) if gaps[c] > 1e-6 and (c == 0 or gaps[c - 1] > 1e-6)]
    signs = {}
    for key, row_z in distinct.items():
        mine = dict(own[key])
        for c in alone:
            if abs(row_z[c]) > 1e-6:
                signs.setdefault(c, set()).add(bool(mine[c + 1] * row_z[c] > 0))
                assert abs(abs(mine[c + 1]) - abs(row_z[c])) < 1e-6
    assert all(len(s) == 1 for s in signs.values())


def found_in(rows, spark, stage, **settings):
    return W.whitened(spark.createDataFrame(rows, SCHEMA).repartition(4), stage, **settings).collect()


def rows_of(x):
    return [(i, [float(c) for c in v], 0, "x", 0.0) for i, v in enumerate(x)]


def generated(seed, n, width, spread=0.0):
    rng = np.random.default_rng(seed)
    return rng.normal(size=(n, width)) @ rng.normal(size=(width, width)) * 10.0 ** (-spread * np.arange(width) / width) + rng.normal(size=width) * 50


ODD = [(50, None, 1, None, None), (51, [1.0, None], 1, None, None), (52, [math.nan], 1, None, None), (53, [math.inf], 1, None, None), (None, [1.0, 2.0], 0, None, None)]


@pytest.mark.parametrize("n,width,components", [(200, 5, 32), (200, 36, 32), (200, 20, 3), (8, 12, 32)])
def test_components(spark, stage, n, width, components):
    rows = rows_of(generated(n + width, n, width)) + ODD
    check(found_in(rows, spark, stage, components=components), rows, components)


def test_repeated_rows_and_shorter_vectors(spark, stage):
    rows = rows_of(generated(3, 60, 6))
    rows += rows[:20] + [rows[0]] * 30 + [(1000, [], 0, "", 0.0), (1001, [3.0], 0, "", 0.0)]
    check(found_in(rows, spark, stage), rows)


def test_equal_eigenvalues(spark, stage):
    """Axes of equal variance span one invariant subspace after a step: others have to be found."""
    rows = rows_of(np.concatenate([sign * 4.0 * np.eye(8) for sign in (1, -1)]))
    found = found_in(rows, spark, stage)
    assert len(found) == 16 * 8
    assert max(r["identity_error"] for r in found) < 1e-9
    assert {round(r["explained"], 12) for r in found} == {0.125}


@pytest.mark.parametrize("rows", [[], [(1, None, 0, "", 0.0)], [(1, [], 0, "", 0.0)], [(1, [2.0], 0, "", 0.0)] * 5])
def test_no_variance(spark, stage, rows):
    assert found_in(rows, spark, stage) == []


def test_far_from_the_origin(spark, stage):
    """Sums of squares of such numbers would lose the variance; what is centred first does not."""
    rows = rows_of(generated(8, 150, 4) + 2.0**22)
    check(found_in(rows, spark, stage), rows)


def test_wide_range_of_variances():
    """Singular values over four powers of ten, each to many digits."""
    rng = np.random.default_rng(4)
    q, _ = np.linalg.qr(rng.normal(size=(500, 12)))
    p, _ = np.linalg.qr(rng.normal(size=(12, 12)))
    values = 10.0 ** -np.linspace(0, 4, 12)
    x = q * values @ p
    found, vectors = W.bidiagonalised(lambda w: x.T @ (x @ w), 12, 12, np.linalg.norm(x))
    np.testing.assert_allclose(found, values, rtol=1e-8)
    np.testing.assert_allclose(np.abs(vectors @ p.T), np.eye(12), atol=1e-8)
    assert np.abs(vectors @ vectors.T - np.eye(12)).max() < 1e-13


@pytest.mark.parametrize("rows,width", [(3, 9), (9, 30), (30, 9)])
def test_few_rows_and_repeated_values(rows, width):
    """Steps go on past an invariant subspace, and rounding does not pass for a direction."""
    rng = np.random.default_rng(rows)
    q, _ = np.linalg.qr(rng.normal(size=(max(rows, width), max(rows, width))))
    x = rng.normal(size=(rows, width)) * 100
    repeated = q[:, :width][:rows] if rows > width else q[:rows, :width]
    for matrix in (x, x - x.mean(axis=0), repeated, np.repeat(x[:1], rows, axis=0)):
        found, vectors = W.bidiagonalised(lambda w: matrix.T @ (matrix @ w), width, width, np.linalg.norm(matrix))
        values = np.linalg.svd(matrix, compute_uv=False)
        np.testing.assert_allclose(found[: len(values)], values, atol=1e-10 * values[0])
        assert found[len(values) :].max(initial=0) < 1e-10 * values[0]
        assert np.abs(vectors @ vectors.T - np.eye(width)).max() < 1e-12


def test_stops_when_converged():
    """Few steps suffice for few components of a steep spectrum in many dimensions."""
    rng = np.random.default_rng(5)
    x = rng.normal(size=(400, 200)) * 0.5 ** np.arange(200)
    steps = []
    values, _ = W.bidiagonalised(lambda w: steps.append(1) or x.T @ (x @ w), 200, 3, np.linalg.norm(x))
    np.testing.assert_allclose(values[:3], np.linalg.svd(x, compute_uv=False)[:3], rtol=1e-12)
    assert len(steps) < 60


def test_numbers_beyond_64_bits(spark, stage):
    rows = [(i, [2.0**50 * (i % 3), float(i)], 0, "", 0.0) for i in range(9)]
    found = W.whitened(spark.createDataFrame([(i, v) for i, v, *_ in rows], "vec_id long, embedding array<double>"), stage).collect()
    assert {r["deviation"] for r in found} <= {None} | {r["deviation"] for r in found if r["vec_id"] % 3 == 1}
    assert max(r["identity_error"] for r in found) < 1e-4
