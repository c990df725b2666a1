"""Whitening against a plain version on exact integers."""

from fractions import Fraction

import numpy as np
import pytest

from lakemill.llm import queries, whitening

VECTORS = "vec_id long, vector array<double>"


def plain(vectors, components=8):
    """n, the rows' exact deviations, and V with its eigenvalues and components, of vectors that count."""
    x = [[int(np.floor(1024 * np.float64(c))) + 100_000 for c in v] for v in vectors]
    n, sums = len(x), [sum(c) for c in zip(*x)]
    deviations = [sum((n * c - s) ** 2 for c, s in zip(row, sums)) for row in x]
    centred = np.array([[float(Fraction(n * c - s, n)) for c, s in zip(row, sums)] for row in x])
    v = sum(np.outer(r, r) for r in centred) / n
    e, u = np.linalg.eigh(v)
    return n, deviations, centred, v, e[::-1][:components], u[:, ::-1].T[:components]


def held(got, ids, vectors, k):
    n, deviations, centred, v, e, u = plain(vectors, k)
    assert len(got) == n * k
    by = {(r["vec_id"], r["component"]): r for r in got}
    assert sorted(by) == sorted((i, c) for i in ids for c in range(1, k + 1))
    for i, d in zip(ids, deviations):
        assert by[i, 1]["n"] == n and by[i, 1]["deviation"] == d
    for c in range(1, k + 1):
        z = np.array([by[i, c]["whitened"] for i in ids])
        want = centred @ u[c - 1] / np.sqrt(e[c - 1])
        want *= np.sign(want @ z)
        assert np.allclose(z, want, rtol=1e-7, atol=1e-7)
        assert by[ids[0], c]["explained"] == pytest.approx(e[c - 1] / np.trace(v), rel=1e-9)
    z = np.array([[by[i, c]["whitened"] for c in range(1, k + 1)] for i in ids])
    assert len({r["identity_error"] for r in got}) == 1
    assert got[0]["identity_error"] == pytest.approx(np.abs(np.cov(z.T, bias=True) - np.eye(k)).max(), abs=1e-9)
    assert got[0]["identity_error"] < 1e-9


def test_table_equals_plain_version(spark, sf):
    rows = spark.read.parquet(f"{sf}/embeddings.parquet").collect()
    held(queries.op12_whitening(spark, sf).collect(), [r[0] for r in rows], [r[1] for r in rows], 8)


@pytest.mark.parametrize("parts", [1, 7])
def test_odd_rows_are_left_out(spark, monkeypatch, parts):
    monkeypatch.setattr(whitening, "TOGETHER", 50)
    rng = np.random.default_rng(parts)
    good = [(k, (rng.normal(size=12) * 3 ** np.arange(12) / 50).tolist()) for k in range(90)]
    bad = [(500, None), (501, []), (502, [1.0] * 11 + [None]), (503, [1.0] * 11 + [float("nan")]), (504, [float("-inf")] * 12), (505, [1.0] * 5), (506, [1e300] * 12)]
    df = spark.createDataFrame(good + bad, VECTORS).selectExpr("*", "1 AS n", "'x' AS whitened").repartition(parts)
    held(whitening.whiten(df).collect(), [i for i, _ in good], [v for _, v in good], 8)


def test_fewer_components_than_asked_for(spark):
    flat = [(k, [float(k % 7), 2.0 * (k % 7), 5.0, float(k % 3)]) for k in range(60)]
    df = spark.createDataFrame(flat, VECTORS).repartition(3)
    held(whitening.whiten(df).collect(), [i for i, _ in flat], [v for _, v in flat], 2)
    same = spark.createDataFrame([(k, [1.0, 2.0]) for k in range(9)], VECTORS)
    assert whitening.whiten(same).count() == 0
    assert whitening.whiten(spark.createDataFrame([], VECTORS)).count() == 0
    assert whitening.whiten(spark.createDataFrame([(1, None), (2, [])], VECTORS)).count() == 0
    assert whitening.whiten(spark.createDataFrame([(1, [3.0, 4.0])], VECTORS)).count() == 0


def test_repeated_and_null_ids_and_large_entries(spark):
    rows = [(None, [1e15, 1.0]), (1, [-1e15, 2.0]), (1, [3.0, 9.0])]
    got = whitening.whiten(spark.createDataFrame(rows, VECTORS)).collect()
    assert len(got) == 3 * len({r["component"] for r in got}) and [r["deviation"] for r in got].count(None) == 2
    big = [(k, [float((-1) ** k * 3e9 * k), float(k)]) for k in range(20)]
    n, deviations, *_ = plain([v for _, v in big])
    got = {r["vec_id"]: r["deviation"] for r in whitening.whiten(spark.createDataFrame(big, VECTORS)).collect()}
    assert got == {k: d if d < 2**63 else None for k, d in enumerate(deviations)}


def test_ints_and_tied_lengths(spark):
    rows = [(1, [1, 2]), (2, [2, 5]), (3, [1, 2, 3]), (4, [7, 5, 1])]
    got = whitening.whiten(spark.createDataFrame(rows, "vec_id int, vector array<int>")).collect()
    assert {r["vec_id"] for r in got} == {3, 4}
