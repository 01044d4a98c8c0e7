"""Whitened vectors against a dense eigensolver and exact integers, and their edge rows."""

import numpy as np
import pytest

from tidemark.llm import queries, whitening
from tidemark.llm.common import table

SF_DIR = "/root/testdata/sf0.001"


def plain(vectors, components=4):
    """Rows from a dense covariance; vectors: id -> entries."""
    x = {i: np.array([int(np.floor(256 * float(c))) for c in v], object) for i, v in vectors}
    fit = np.array(sorted({tuple(v) for v in x.values()}), object)
    n, s = len(fit), fit.sum(0)
    centred = (n * fit - s).astype(float) / n
    values, vecs = np.linalg.eigh(centred.T @ centred / n)
    values, vecs = values[::-1], vecs[:, ::-1]
    trace = values.sum()
    return n, s, values, vecs, trace, x


def check(rows, vectors, components=4):
    n, s, values, vecs, trace, x = plain(vectors)
    count = min(components, int((values > 1e-12 * trace).sum()))
    assert len(rows) == len(vectors) * count
    signs = np.zeros(len(values))
    for r in rows:
        k = r.component - 1
        want = float((((n * x[r.vec_id] - s).astype(float) / n) @ vecs[:, k]) / np.sqrt(values[k]))
        if not signs[k] and abs(want) > 1e-3:
            signs[k] = np.sign(want) * np.sign(r.whitened)
        assert abs(want * (signs[k] or 1) - r.whitened) < 1e-7
        assert r.n == n and r.deviation == sum(int(v) ** 2 for v in n * x[r.vec_id] - s)
        assert abs(r.explained - values[k] / trace) < 1e-9 and r.identity_error < 1e-9
        assert r.residual <= 1e-11 * values[0]


def test_query(spark):
    rows = queries.QUERIES["op12_jacobi_davidson"](spark, SF_DIR).collect()
    vectors = [(r.vec_id, r.embedding) for r in table(spark, SF_DIR, "embeddings").select("vec_id", "embedding").collect()]
    check(rows, vectors)


@pytest.mark.parametrize("dimension", [1, 2, 3, 5, 7, 40, 150])
def test_solver(dimension):
    draw = np.random.default_rng(dimension)
    x = draw.standard_normal((2 * dimension + 3, dimension)) * np.linspace(1, 2, dimension)
    a = np.cov(x.T, bias=True).reshape(dimension, dimension)
    pairs = whitening.jacobi_davidson(lambda v: a @ v, dimension, 4)
    values = np.linalg.eigvalsh(a)[::-1][:4]
    assert np.allclose(pairs.values, values, rtol=1e-13) and (pairs.residuals <= 1e-12 * values[0]).all()
    assert np.allclose(pairs.vectors.T @ pairs.vectors, np.eye(len(values)), atol=1e-13)


@pytest.mark.parametrize("values", [[5, 5, 5, 5, 5, 1, 1, 0, 0, 0.0], [3] + [0] * 9, [1] * 8, list(10.0 ** -np.arange(20))])
def test_solver_on_ties_and_null_spaces(values):
    a = np.diag(np.array(values, float))
    pairs = whitening.jacobi_davidson(lambda v: a @ v, len(values), 4)
    assert np.allclose(pairs.values, sorted(values, reverse=True)[:4], atol=1e-13)


def test_inner_solver():
    draw = np.random.default_rng(2)
    q, _ = np.linalg.qr(draw.standard_normal((12, 12)))
    a = q @ np.diag(np.linspace(-3, 4, 12)) @ q.T  # indefinite
    right = draw.standard_normal((12, 3))
    assert np.allclose(a @ whitening.minres(lambda v: a @ v, right, 40, 1e-12), right, atol=1e-8)


def rows_of(spark, vectors, kind="float"):
    return spark.createDataFrame(vectors, f"vec_id long, embedding array<{kind}>")


def test_edges(spark):
    """Nulls, entries that are null or not finite, repeated rows and vectors, null ids, clashing columns."""
    good = [(i, [float(v) for v in np.random.default_rng(i).integers(-8, 8, 6) / 16]) for i in range(40)]
    bad = [(90, None), (91, [1.0, None, 0.0, 0.0, 0.0, 0.0]), (92, [float("nan")] * 6), (93, [float("inf")] * 6)]
    again = [(3, good[3][1]), (50, good[4][1]), (50, [-0.0, 0.0, 0.0, 0.0, 0.0, 0.0])]
    docs = rows_of(spark, good + bad, "double").selectExpr("*", "1 AS x", "2 AS component")
    check(whitening.whiten(docs).collect(), good)
    found = whitening.whiten(rows_of(spark, good + bad + again[:2])).collect()
    assert len(found) == 4 * 42 and {r.n for r in found} == {len({tuple(v) for _, v in good})}
    nameless = whitening.whiten(rows_of(spark, good[:10] + [(None, good[11][1])])).collect()
    assert sum(r.vec_id is None for r in nameless) == 4


def test_dimensions_apart_and_without_variance(spark):
    two = [(i, [i / 7, (i * i % 5) / 3]) for i in range(12)]
    three = [(100 + i, [i / 4, (i * 3 % 7) / 2, -i / 9]) for i in range(9)]
    found = whitening.whiten(rows_of(spark, two + three + [(7000, []), (7001, [4.0] * 5)])).collect()
    check([r for r in found if r.vec_id < 100], two)
    check([r for r in found if r.vec_id >= 100], three)
    assert whitening.whiten(rows_of(spark, [(1, [2.0, 3.0]), (2, [2.0, 3.0])])).collect() == []
    assert whitening.whiten(rows_of(spark, [])).collect() == []


def test_deviations_beyond_64_bits(spark):
    rows = [(1, [1e12, 0.0]), (2, [0.0, 1.0]), (3, [1.0, 0.5]), (4, [0.5, 0.25])]
    found = whitening.whiten(rows_of(spark, rows, "double")).collect()
    assert len(found) == 4 * len({r.component for r in found}) and {r.deviation for r in found if r.vec_id == 1} == {None}
