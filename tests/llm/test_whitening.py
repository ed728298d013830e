import math

import numpy as np
import pytest

from llm_odd import SF_DIR
from navlake.llm import queries, whitening

VECTORS = "vec_id long, embedding array<float>, label int"


def symmetric(values, seed=0):
    q, _ = np.linalg.qr(np.random.default_rng(seed).standard_normal((len(values), len(values))))
    return (q * np.array(values, dtype=float)) @ q.T


@pytest.mark.parametrize("values", [
    [9, 7, 5, 3, 2, 1, 0.5, 0.1], list(range(60, 0, -1)), [5, 5, 5, 1, 1], [1.0000001, 1.0, 0.9999999, 0.5], [3, 0, 0, 0],
    [1e9, 1e3, 10, 1e-4], [2], [1] * 30 + [0.5] * 30, [1e-300, 1e-301],
])
def test_eigenpairs_by_slices(values):
    v = symmetric(values, len(values))
    found, vectors = whitening.largest(v, len(values))
    want = [x for x in sorted(values, reverse=True) if x > 1e-11 * max(values)]
    assert np.allclose(found, want, rtol=1e-7, atol=1e-13 * max(values))
    assert np.allclose(vectors.T @ vectors, np.eye(len(want)), atol=1e-9)
    assert np.abs(v @ vectors - vectors * found).max() < 1e-12 * max(values)


def test_counts_by_inertia():
    v = symmetric([9, 7, 5, 5, 2, -1])
    form = whitening.tridiagonal(v)
    assert [whitening.count_above(form, s) for s in (10, 8, 6, 4, 0, -2)] == [0, 1, 2, 4, 5, 6]
    assert whitening.largest(np.zeros((3, 3)), 2)[1].shape == (3, 0)


def brute_force(rows, components=4):
    """Rows by vec_id and component, and the eigenvalues, from plain arrays."""
    usable = [(i, v) for i, v in rows if v and all(c is not None and math.isfinite(c) for c in v)]
    x = np.array([[math.floor(256 * float(np.float32(c))) for c in v] for _, v in usable])
    fit = np.unique(x, axis=0)
    n, sums = len(fit), fit.sum(axis=0)
    centred = fit - sums / n
    values, vectors = np.linalg.eigh(centred.T @ centred / n)
    values, vectors = values[::-1][:components], vectors[:, ::-1][:, :components]
    whitened = (x - sums / n) @ vectors / np.sqrt(values)
    deviations = [sum(int(n * a - s) ** 2 for a, s in zip(row, sums)) for row in x.tolist()]
    return usable, n, deviations, whitened, values / np.trace(centred.T @ centred / n)


def compare(got, rows):
    usable, n, deviations, whitened, explained = brute_force(rows)
    assert len(got) == 4 * len(usable)
    by_id = {}
    for r in got:
        by_id.setdefault(r["vec_id"], {})[r["component"]] = r
    signs = None
    for (vec_id, _), deviation, row in zip(usable, deviations, whitened):
        mine = [by_id[vec_id][k] for k in (1, 2, 3, 4)]
        assert all(r["n"] == n and r["deviation"] == deviation for r in mine)
        values = np.array([r["whitened"] for r in mine])
        if signs is None:
            signs = np.sign(values) * np.sign(row)
        assert np.allclose(values * signs, row, atol=1e-8)
        assert np.allclose([r["explained"] for r in mine], explained, rtol=1e-9)
        assert mine[0]["identity_error"] < 1e-9


def test_query_against_brute_force(spark):
    rows = [(r["vec_id"], r["embedding"]) for r in spark.read.parquet(f"{SF_DIR}/embeddings.parquet").collect()]
    compare(queries.QUERIES["op11_whitening"](spark, SF_DIR).collect(), rows)


def planted(spark, more=()):
    rng = np.random.default_rng(4)
    base = rng.normal(size=(60, 6)) * [3, 2, 1, 0.5, 0.2, 0.1]
    rows = [(i, [float(np.float32(c)) for c in v]) for i, v in enumerate(base)]
    rows += [(1000 + i, rows[0][1]) for i in range(200)]  # a hot vector counts once
    rows += list(more)
    return rows, spark.createDataFrame([(i, v, 0) for i, v in rows], VECTORS)


def test_unusable_rows_and_hot_copies(spark):
    odd = [(500, None), (501, []), (502, [1.0, None, 0.0, 0.0, 0.0, 0.0]), (503, [float("nan")] * 6),
           (504, [float("inf")] + [0.0] * 5)]
    rows, frame = planted(spark, odd)
    fitted = whitening.fit_whitening(frame)
    assert fitted.n == 60
    compare(whitening.digest(whitening.whiten(frame, fitted), fitted).collect(), rows)


def test_reruns_agree_and_other_lengths_are_left_out(spark):
    rows, frame = planted(spark, [(600, [1.0, 2.0]), (601, [3.0] * 7), (None, [0.5] * 6), (None, [0.5] * 6)])
    clash = frame.selectExpr("*", "'x' as deviation", "'x' as whitened", "'x' as v", "'x' as n", "'x' as d", "'x' as x")
    one, two = whitening.fit_whitening(clash), whitening.fit_whitening(clash.repartition(7))
    assert np.array_equal(one.values, two.values) and np.array_equal(one.vectors, two.vectors)
    out = whitening.digest(whitening.whiten(clash, one), one).collect()
    assert len(out) == 4 * 262 and sum(r["vec_id"] is None for r in out) == 8
    assert {600, 601}.isdisjoint(r["vec_id"] for r in out)


def test_few_vectors_and_empty_table(spark):
    one = spark.createDataFrame([(1, [1.0, 2.0], 0), (2, [1.0, 2.0], 0)], VECTORS)
    fitted = whitening.fit_whitening(one)
    assert fitted.n == 1 and whitening.digest(whitening.whiten(one, fitted), fitted).isEmpty()
    line = spark.createDataFrame([(1, [1.0, 2.0], 0), (2, [3.0, 6.0], 0)], VECTORS)
    fitted = whitening.fit_whitening(line)
    rows = whitening.digest(whitening.whiten(line, fitted), fitted).collect()
    assert sorted(abs(r["whitened"]) for r in rows) == pytest.approx([1.0, 1.0])
    none = line.where("vec_id > 5")
    assert whitening.fit_whitening(none) is None
    assert whitening.digest(whitening.whiten(none, None), None).isEmpty()


def test_deviation_beyond_a_long_is_null(spark):
    big = spark.createDataFrame([(1, [1e16, 0.0]), (2, [-1e16, 0.0]), (3, [0.0, 1.0])], "vec_id long, embedding array<double>")
    fitted = whitening.fit_whitening(big)
    assert fitted.n == 3
    rows = {r["vec_id"]: r for r in whitening.whiten(big, fitted).collect()}
    assert rows[1]["deviation"] is None and rows[3]["deviation"] == (3 * 256 - 256) ** 2
