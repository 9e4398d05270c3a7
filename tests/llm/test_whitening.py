"""Whitening against exact fractions and plain numpy; edge cases."""

import math
from fractions import Fraction

import numpy as np
import pytest

from chartloom.llm import whitening
from chartloom.llm.catalog import QUERIES

FOLDER = "/root/testdata/sf0.01"


def brute(rows):
    """{id: (deviation, projections)}, n, shares of variance; rows of (id, whole vector)."""
    xs = [(i, tuple(math.floor(256 * float(c)) for c in v)) for i, v in rows]
    fit = sorted({x for _, x in xs})
    n, d = len(fit), len(fit[0])
    sums = [sum(x[k] for x in fit) for k in range(d)]
    c = np.array([[float(Fraction(n * x[k] - sums[k], n)) for k in range(d)] for x in fit])
    v = c.T @ c / n
    values, vectors = np.linalg.eigh(v)
    values, vectors = values[::-1], vectors[:, ::-1]
    out = {}
    for i, x in xs:
        far = sum((n * a - s) ** 2 for a, s in zip(x, sums))
        z = np.array([float(Fraction(n * a - s, n)) for a, s in zip(x, sums)])
        out[i] = far, [float(z @ vectors[:, k] / math.sqrt(values[k])) for k in range(4) if k < d and values[k] > 1e-9 * values[0]]
    return out, n, values / v.trace()


def check(got, rows, times=1):
    expected, n, shares = brute(rows)
    signs = {}
    assert len(got) == sum(len(expected[i][1]) for i, _ in rows)
    for r in got:
        far, z = expected[r.vec_id]
        assert r.deviation == far and r.n == n
        other = z[r.component - 1]
        if abs(other) > 1e-6:
            assert signs.setdefault(r.component, np.sign(other * r.whitened)) == np.sign(other * r.whitened)
        assert abs(abs(r.whitened) - abs(other)) < 1e-6 * max(1, abs(other))
        assert abs(r.explained - shares[r.component - 1]) <= 1e-9 * shares[r.component - 1]
        assert 0 <= r.identity_error < 1e-9


def test_table(spark):
    df = QUERIES["op13_whitening"](spark, FOLDER)
    assert [(f.name, f.dataType.simpleString()) for f in df.schema.fields] == [
        ("vec_id", "bigint"), ("component", "int"), ("n", "bigint"), ("deviation", "bigint"), ("whitened", "double"),
        ("explained", "double"), ("identity_error", "double")]
    rows = [(r.vec_id, r.embedding) for r in spark.read.parquet(f"{FOLDER}/embeddings.parquet").collect()]
    check(df.collect(), [(i, v) for i, v in rows if v is not None and all(c is not None and math.isfinite(c) for c in v)])


def test_edges(spark):
    nan, inf = float("nan"), float("inf")
    pick = np.random.default_rng(3)
    good = [(i, [float(c) for c in pick.normal(size=5) * [9, 4, 2, 1, 0.1]]) for i in range(80)] + [(90, [-0.0, 0.0, 1.0, 2.0, 3.0])]
    hot = [(100 + i, good[0][1]) for i in range(200)]  # one vector, once in the fit list
    bad = [(1, None), (2, [nan] + [1.0] * 4), (3, [inf] + [1.0] * 4), (4, [None] + [1.0] * 4), (5, []), (6, [1.0, 2.0]), (7, [1e30] + [0.0] * 4)]
    rows = good + hot
    df = spark.createDataFrame(
        [(i, v, "x", 3) for i, v in rows] + [(1000 + i, v, "x", 3) for i, v in bad], "vec_id long, embedding array<double>, x string, n int")
    check(whitening.whiten(df.repartition(7)).collect(), rows)
    none = spark.createDataFrame([(None, [1.0, 2.0]), (None, [1.0, 2.0]), (4, [3.0, 1.0]), (5, [3.0, 5.0])], "vec_id long, embedding array<float>")
    got = whitening.whiten(none).collect()
    assert sorted((r.vec_id is None, r.component) for r in got) == [(False, 1)] * 2 + [(False, 2)] * 2 + [(True, 1)] * 2 + [(True, 2)] * 2
    assert {r.n for r in got} == {3}
    for nothing in (df.limit(0), df.where("vec_id >= 1000 and vec_id <> 1006"), df.where("vec_id = 3"), df.where("vec_id = 1005")):
        assert whitening.whiten(nothing).count() == 0


@pytest.mark.parametrize("size", [3, 1 << 23, 1 << 40, 1 << 58])
def test_sums_stay_exact_at_any_size(spark, size):
    pick = np.random.default_rng(size % 97)
    x = pick.integers(-size, size, (500, 3))
    sums = whitening.whole_sum(x)
    assert sums == [sum(int(v) for v in x[:, k]) for k in range(3)]
    v = whitening.centred(x, 500, sums)
    plain = [[500 * int(a) - s for a, s in zip(row, sums)] for row in x]
    assert [[int(a) for a in row] for row in v] == plain
    assert whitening.square_sums(v) == [sum(row[k] ** 2 for row in plain) for k in range(3)]
    fit = spark.createDataFrame([([int(a) for a in row],) for row in x.tolist()], "x array<long>").repartition(3)
    assert whitening.sums_of(fit, 3) == sums
    got = whitening.squares_of(fit, 500, sums)
    assert got == {(a, b): sum((row[a] + (row[b] if a != b else 0)) ** 2 for row in plain) for a in range(3) for b in range(a, 3)}
