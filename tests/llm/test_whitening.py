"""Whitening: each numerical step against numpy, the operator against a plain computation, and edge cases."""

import math

import numpy as np
import pytest
from pyspark.sql import types as T

from precinct.llm import queries, whitening

VECTORS = T.StructType(
    [
        T.StructField("vec_id", T.LongType()),
        T.StructField("embedding", T.ArrayType(T.FloatType())),
        T.StructField("label", T.IntegerType()),
    ]
)


def bad_rows():
    return [
        (900, None, 1), (901, [], 1), (902, [1.0, None, 2.0], 1), (903, [float("nan"), 0.0, 1.0], 1),
        (904, [float("inf"), 0.0, 1.0], 1), (905, [3.0e38, 0.0, 1.0], 1), (906, [1.0, 2.0], 1),
    ]


def plain(rows, most=4):
    """(n, {vec_id: (deviation, whitened up to sign)}, explained) by the definition, in Python integers and numpy."""
    kept = [(i, tuple(math.floor(256 * float(np.float32(c))) for c in e)) for i, e in rows]
    fit = sorted({x for _, x in kept})
    n, sums = len(fit), [sum(c) for c in zip(*fit)]
    centred = np.array([[(n * v - s) / n for v, s in zip(x, sums)] for x in fit])
    values, vectors = np.linalg.eigh(centred.T @ centred / n)
    values, vectors = values[::-1], vectors[:, ::-1]
    out = {}
    for i, x in kept:
        off = [n * v - s for v, s in zip(x, sums)]
        own = [float(np.dot(off, vectors[:, k]) / n / math.sqrt(values[k])) for k in range(min(most, len(sums)))]
        out.setdefault(i, []).append((sum(v * v for v in off), own))
    return n, out, values / values.sum()


@pytest.mark.parametrize("shape", [(300, 64), (40, 64), (200, 7), (50, 1), (2, 3)])
def test_directions_are_singular_vectors(shape):
    a = np.random.default_rng(shape[0]).normal(size=shape) * np.geomspace(1, 1e-5, shape[1])
    directions, squares = whitening.principal_directions(whitening.triangle(a), 4)
    _, s, vt = np.linalg.svd(a, full_matrices=False)
    k = len(squares)
    assert k == min(4, *shape)
    assert np.allclose(squares, s[:k] ** 2, rtol=1e-12, atol=0)
    assert np.allclose(np.abs(np.sum(directions * vt[:k].T, axis=0)), 1, atol=1e-12)


def test_small_singular_values_are_relatively_accurate():
    """A graded bidiagonal matrix: a normal eigensolver of B'B loses the small values, dqds does not."""
    diagonal, above = np.geomspace(1, 1e-12, 12), np.geomspace(0.5, 1e-12, 11)
    got = whitening.squared_singular_values(diagonal, above)
    assert np.isclose(np.prod(np.sqrt(got) / np.geomspace(1, 1e-12, 12)), 1, rtol=1e-12)
    full = np.diag(diagonal) + np.diag(above, 1)
    assert np.allclose(np.sqrt(got)[:4], np.linalg.svd(full, compute_uv=False)[:4], rtol=1e-13)


@pytest.mark.parametrize("values", [[2.0, 2.0, 2.0, 1.0, 1.0], [3.0, 3.0 - 1e-15, 3.0 - 2e-15, 1.0, 0.0], [1.0] * 6])
def test_equal_values_get_orthogonal_directions(values):
    turn, _ = np.linalg.qr(np.random.default_rng(3).normal(size=(len(values), len(values))))
    for a in (np.diag(values) @ turn, np.diag(values)):
        directions, squares = whitening.principal_directions(whitening.triangle(a), 4)
        assert np.allclose(directions.T @ directions, np.eye(len(squares)), atol=1e-12)
        assert np.allclose(a.T @ (a @ directions), directions * squares, atol=1e-12)


def test_equals_the_plain_computation(spark):
    rng = np.random.default_rng(5)
    rows = [(i, (rng.normal(size=3) * [3, 1, 0.3] - 0.2).astype(np.float32).tolist(), None) for i in range(200)]
    rows += [(300 + i, rows[i][1], 7) for i in range(40)] + [(5, rows[5][1], 1), (None, rows[6][1], 1)]
    df = spark.createDataFrame(rows + bad_rows(), VECTORS).repartition(5)
    df = df.selectExpr("*", "1 AS x", "2 AS n", "3 AS length", "'a' AS component")
    model, fit_list = whitening.fit(df)
    got = whitening.whiten(df, model, "vec_id").collect()
    n, wanted, explained = plain([(r[0], r[1]) for r in rows])
    assert model.n == n == fit_list.count() == 200
    assert len(got) == 3 * len(rows)
    signs = {}
    for r in got:
        deviation, own = wanted[r["vec_id"]][0]
        k = r["component"] - 1
        assert (r["n"], r["deviation"]) == (n, deviation)
        assert np.isclose(r["explained"], explained[k], rtol=1e-12)
        sign = signs.setdefault(k, 1 if r["whitened"] * own[k] > 0 else -1)
        assert np.isclose(r["whitened"], sign * own[k], rtol=1e-9, atol=1e-12)
    assert whitening.identity_error(fit_list, model) < 1e-12


def test_tree_of_triangles_is_one_triangle(spark, monkeypatch):
    monkeypatch.setattr(whitening, "FAN", 2)
    rng = np.random.default_rng(6)
    rows = [(i, rng.normal(size=6).astype(np.float32).tolist(), 0) for i in range(300)]
    model, fit_list = whitening.fit(spark.createDataFrame(rows, VECTORS).repartition(7))
    _, _, explained = plain([(r[0], r[1]) for r in rows])
    assert np.allclose(model.eigenvalues / model.trace, explained[:4], rtol=1e-12)
    assert whitening.identity_error(fit_list, model) < 1e-12


def test_nothing_and_equal_vectors(spark):
    empty = spark.createDataFrame([], VECTORS)
    assert whitening.fit(empty)[0] is None
    assert whitening.whiten(empty, None, "vec_id").collect() == []
    same = spark.createDataFrame([(i, [1.0, 2.0, 3.0], 1) for i in range(9)], VECTORS)
    model, fit_list = whitening.fit(same)
    assert model.n == 1 and not len(model.eigenvalues)
    assert whitening.whiten(same, model, "vec_id").count() == 0
    assert whitening.identity_error(fit_list, model) == 0.0


def test_deviation_beyond_a_long_is_null():
    model = whitening.Whitening(1 << 40, [5, 7], np.zeros((2, 0)), np.zeros(0), 1.0)
    assert model.deviation(np.array([[1 << 50, 0], [0, 0]])) == [None, 5 * 5 + 7 * 7]
    exact = whitening.Whitening(3, [4, 5], np.zeros((2, 0)), np.zeros(0), 1.0)
    assert exact.deviation(np.array([[1, -2]])) == [(3 - 4) ** 2 + (-6 - 5) ** 2]


def test_query_keeps_its_contract(spark, folder):
    got = queries.QUERIES["op11_whitening"](spark, folder)
    assert got.columns == ["vec_id", "component", "n", "deviation", "whitened", "explained", "identity_error"]
    table = spark.read.parquet(f"{folder}/embeddings.parquet").collect()
    n, wanted, explained = plain([(r["vec_id"], r["embedding"]) for r in table])
    rows = got.collect()
    assert len(rows) == 4 * len(table) and {r["component"] for r in rows} == {1, 2, 3, 4}
    for r in rows:
        deviation, own = wanted[r["vec_id"]][0]
        assert (r["n"], r["deviation"]) == (n, deviation)
        assert np.isclose(abs(r["whitened"]), abs(own[r["component"] - 1]), rtol=1e-7, atol=1e-9)
        assert np.isclose(r["explained"], explained[r["component"] - 1], rtol=1e-9) and r["identity_error"] < 1e-9
