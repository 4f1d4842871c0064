"""Whitening against a plain eigenvalue solver and exact integers."""

import math
import random
from pathlib import Path

import numpy as np
import pytest

from cumulo.llm import whitening
from cumulo.llm.queries import QUERIES

SMALL = Path("/root/testdata/sf0.001")


def matrix_of(values, seed=0):
    draw = np.random.default_rng(seed)
    turn = np.linalg.qr(draw.standard_normal((len(values), len(values))))[0]
    out = turn * np.array(values, float) @ turn.T
    return (out + out.T) / 2


@pytest.mark.parametrize(
    "values",
    [
        [3.0],
        [2.0, 1.0, 1.0, 0.5],
        [1.0] * 10 + [2.0] * 20,
        [1e6] * 3 + [1e-3] * 40,
        [5.0] * 3 + [0.0] * 20,
        list(np.logspace(8, -4, 60)),
        [1 + 1e-7 * i for i in range(30)],
    ],
)
def test_pairs_against_plain_solver(values):
    matrix = matrix_of(values)
    found, vectors = whitening.leading_pairs(matrix, 8)
    plain = np.sort(np.linalg.eigvalsh(matrix))[::-1][:8]
    assert np.allclose(found, plain, atol=1e-13 * plain[0], rtol=0)
    assert np.allclose(vectors.T @ vectors, np.eye(len(found)), atol=1e-12)
    assert np.abs(matrix @ vectors - vectors * found).max() <= 1e-13 * plain[0]


def test_inertia_counts():
    matrix = matrix_of([-3, -1, 0.5, 2, 2, 7], seed=3)
    shifts = np.array([-4, -2, 0, 1, 3, 8.0])
    assert whitening.inertia(*whitening.tridiagonal(matrix), shifts).tolist() == [6, 5, 4, 3, 1, 0]


def plain(rows, components=8):
    """Row by row, with whole numbers and a plain solver."""
    good = [(i, v) for i, v in rows if v and all(c is not None and math.isfinite(c) for c in v)]
    x = [[math.floor(1024 * c) + 100_000 for c in v] for _, v in good]
    n, sums = len(x), [sum(c) for c in zip(*x)]
    far = [sum((n * c - s) ** 2 for c, s in zip(r, sums)) for r in x]
    apart = np.array([[float(c) - s / n for c, s in zip(r, sums)] for r in x])
    matrix = apart.T @ apart / n
    values, vectors = np.linalg.eigh(matrix)
    values, vectors = values[::-1][:components], vectors[:, ::-1][:, :components]
    out = {}
    for (i, _), d, r in zip(good, far, apart):
        for k in range(len(values)):
            out[i, k + 1] = (n, d, r @ vectors[:, k] / math.sqrt(values[k]), values[k] / np.trace(matrix))
    return out


def check(found, rows):
    want = plain(rows)
    assert len(found) == len(want)
    signs = {}
    for r in found:
        n, far, value, share = want[r["vec_id"], r["component"]]
        assert (r["n"], r["deviation"]) == (n, far)
        assert r["explained"] == pytest.approx(share, rel=1e-9)
        assert r["identity_error"] < 1e-9
        if abs(value) > 1e-6:
            sign = signs.setdefault(r["component"], 1 if r["whitened"] * value > 0 else -1)
            assert r["whitened"] * sign == pytest.approx(value, abs=1e-7)


def test_against_plain(spark):
    draw = random.Random(1)
    rows = [(i, [draw.gauss(0, 1 + k) for k in range(11)]) for i in range(300)]
    rows += [(900, None), (901, [None] * 11), (902, [float("nan")] + [1.0] * 10), (903, [float("-inf")] * 11)]
    rows += [(904, rows[3][1]), (905, [-0.0] * 11)]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<float>").repartition(5)
    exact = [(r["vec_id"], r["embedding"]) for r in df.collect()]
    check(whitening.whiten(df).collect(), exact)


@pytest.mark.skipif(not SMALL.exists(), reason="no test tables")
def test_registered_against_plain(spark):
    rows = [(r["vec_id"], r["embedding"]) for r in spark.read.parquet(f"{SMALL}/embeddings.parquet").collect()]
    found = QUERIES["op13_contour_whitening"](spark, str(SMALL))
    assert dict(found.dtypes)["deviation"] == "bigint"
    check(found.collect(), rows)


def test_odd_rows(spark):
    schema = "vec_id long, embedding array<double>, component int, whitened string, _place int"
    empty = whitening.whiten(spark.createDataFrame([], schema))
    assert empty.count() == 0
    same = spark.createDataFrame([(1, [1.0, 2.0], 9, "x", 3), (None, [1.0, 2.0], 9, "x", 3), (1, [1.0, 2.0], 9, "x", 3)], schema)
    found = whitening.whiten(same)
    assert found.columns == empty.columns and found.dtypes == empty.dtypes
    got = [tuple(r)[:6] for r in found.collect()]
    assert sorted(got, key=repr) == sorted([(i, c, 3, 0, None, None) for i in (1, 1, None) for c in (1, 2)], key=repr)
    mixed = [(1, [1.0, 2.0]), (2, [3.0]), (3, [3.0, 1.0]), (4, []), (5, [0.0, 7.0])]
    found = whitening.whiten(spark.createDataFrame(mixed, "vec_id long, embedding array<double>"))
    assert {r["vec_id"] for r in found.collect()} == {1, 3, 5}


def test_large_entries(spark):
    rows = [(i, [1e300 * (-1) ** i, float(i)]) for i in range(4)] + [(7, [3e9, 1.0])]
    found = whitening.whiten(spark.createDataFrame(rows, "vec_id long, embedding array<double>")).collect()
    assert {r["vec_id"] for r in found} == {0, 1, 2, 3, 7}
    n, x = 5, [math.floor(3e9 * 1024) + 100_000, 101_024]
    wide = [(1 << 62) + 100_000, -(1 << 62) + 100_000]
    assert whitening.whole(np.array([[1e300, -1e300]])).tolist() == [wide]
    sums = [2 * wide[0] + 2 * wide[1] + x[0], sum(1024 * i + 100_000 for i in range(4)) + x[1]]
    far = sum((n * c - s) ** 2 for c, s in zip(x, sums))
    assert {int(r["deviation"]) for r in found if r["vec_id"] == 7} == {far}
