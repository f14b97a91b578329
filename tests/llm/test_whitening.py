"""Whitening and its exact characteristic polynomial against plain Python and NumPy."""

import math
from fractions import Fraction

import numpy as np
import pytest

from demandflow.llm import charpoly, whitening
from demandflow.llm.queries import QUERIES
from tests.llm.conftest import SF


def integers(v):
    return tuple(max(-2**63, min(2**63 - 1, math.floor(256 * float(c)))) for c in v)


def usable(v):
    return v is not None and all(c is not None and math.isfinite(c) for c in v)


def polynomial(m):
    """Faddeev-LeVerrier over fractions."""
    d = len(m)
    b, out = [[Fraction(0)] * d for _ in range(d)], [Fraction(1)]
    for k in range(1, d + 1):
        b = [[sum(m[i][t] * b[t][j] for t in range(d)) + (out[-1] if i == j else 0) for j in range(d)] for i in range(d)]
        out.append(-sum(m[i][t] * b[t][i] for i in range(d) for t in range(d)) / k)
    return [int(c) for c in out]


def solved(m, count):
    trace = sum(int(m[i, i]) for i in range(len(m)))
    primes = charpoly.primes_for(len(m), trace)
    p = charpoly.chinese(charpoly.charpoly_mod(m, primes), primes, len(m))
    full = list(p)
    while p[-1] == 0:
        p = p[:-1]
    once = charpoly.square_free(p, primes)
    roots = charpoly.largest_roots(once, trace, count)
    return full, p, once, roots, charpoly.refine(once, roots)


@pytest.mark.parametrize("d", [1, 2, 3, 6, 9])
def test_polynomial_is_exact(d):
    rng = np.random.default_rng(d)
    for rank in {1, d}:
        x = rng.integers(-9, 10, (rank, d)).astype(object)
        m = x.T.dot(x)
        if sum(m.diagonal()):
            assert solved(m, 5)[0] == polynomial(m.tolist())


def test_equal_and_nearly_equal_eigenvalues():
    # orthogonal columns of length 15, so that the eigenvalues are known
    q = np.array([[5, -2, 14], [10, 11, -2], [10, -10, -5]], dtype=object)
    assert (q.T.dot(q) == 225 * np.eye(3, dtype=int)).all()
    big = 10**30
    for values in ([big + 1, big, 7], [big, big, 7], [5, 5, 5], [9, 0, 0], [big, 3, 3]):
        m = q.dot(np.diag(np.array(values, dtype=object))).dot(q.T)
        _, p, once, roots, gaps = solved(m, 4)
        found = []
        for r, gap in zip(roots, gaps, strict=True):
            times = charpoly.roots_above(p, r.lo, r.s) - charpoly.roots_above(p, r.hi, r.s)
            mu = (r.low() + r.high()) / 2
            for v in charpoly.null_space(m, mu, gap, times):
                found.append((mu, v))
        want = sorted([225 * v for v in values if v], reverse=True)
        assert len(found) == len(want)
        vectors = np.array([v for _, v in found])
        assert np.abs(vectors @ vectors.T - np.eye(len(found))).max() < 1e-15
        for (mu, v), w in zip(found, want, strict=True):
            assert abs(mu - w) < Fraction(1, 10**20) * w
            space = [k for k in range(3) if 225 * values[k] == w]
            assert abs(sum(float(np.dot(v, q[:, k].astype(float) / 15)) ** 2 for k in space) - 1) < 1e-14


def expected(rows, count=4):
    """{(id, component): (n, deviation, |whitened| by known sign, explained)} for one dimension."""
    x = [(i, integers(v)) for i, v in rows if usable(v)]
    fit = sorted({v for _, v in x})
    n, s = len(fit), [sum(c) for c in zip(*fit, strict=True)]
    centred = np.array([[float(Fraction(c * n - t, n)) for c, t in zip(v, s, strict=True)] for v in fit])
    values, vectors = np.linalg.eigh(centred.T @ centred / n)
    order = np.argsort(-values)[:count]
    out = []
    for i, v in x:
        dev = sum((n * c - t) ** 2 for c, t in zip(v, s, strict=True))
        y = np.array([float(Fraction(c * n - t, n)) for c, t in zip(v, s, strict=True)])
        for k, o in enumerate(order):
            if values[o] > 1e-9:
                out.append((i, k + 1, n, dev, abs(y @ vectors[:, o]) / math.sqrt(values[o]), values[o] / values.sum()))
    return out


def test_query_matches_numpy(spark):
    got = QUERIES["op11_whitening"](spark, SF).collect()
    rows = [(r["vec_id"], r["embedding"]) for r in spark.read.parquet(f"{SF}/embeddings.parquet").collect()]
    want = expected(rows)
    key = lambda t: (t[0], t[1])
    got = sorted(((r["vec_id"], r["component"], r["n"], r["deviation"], abs(r["whitened"]), r["explained"]) for r in got), key=key)
    want = sorted(want, key=key)
    assert [g[:4] for g in got] == [w[:4] for w in want]
    assert np.allclose([g[4:] for g in got], [w[4:] for w in want], rtol=1e-8, atol=1e-9)


def test_awkward_vectors(spark, scratch):
    nan, inf = float("nan"), float("inf")
    rows = [(1, [0.5, -0.25, 1.0]), (1, [0.5, -0.25, 1.0]), (2, [0.1, 0.7, -0.0]), (None, [3.0, 0.0, 0.2]), (4, [-1.5, 2.0, 0.0]),
            (5, None), (6, [None, 1.0, 1.0]), (7, [nan, 1.0, 1.0]), (8, [1.0, inf, 1.0]), (9, []), (10, [0.9, 0.9, 0.9]),
            (11, [1.0, 2.0]), (12, [1.001, 2.001]), (13, [4.0])]
    frame = spark.createDataFrame([(*r, k, "q") for k, r in enumerate(rows)], "vec_id long, embedding array<double>, component int, row string")
    got = whitening.whiten(frame, scratch).collect()
    of = lambda d: [(i, v) for i, v in rows if v is not None and len(v) == d]
    want = expected(of(3))
    mine = [(r["row"]["vec_id"], r["component"], r["n"], r["deviation"], abs(r["whitened"]), r["explained"]) for r in got if len(r["row"]["embedding"]) == 3]
    key = lambda t: (t[0] or 0, t[1])
    for g, w in zip(sorted(mine, key=key), sorted(want, key=key), strict=True):
        assert g[:4] == w[:4] and np.allclose(g[4:], w[4:])
    assert all(r["row"]["row"] == "q" and r["identity_error"] < 1e-9 for r in got)
    # equal integer vectors are one point; single points have no component
    assert {len(r["row"]["embedding"]) for r in got} == {3}
    empty = whitening.whiten(frame.limit(0), scratch)
    assert empty.count() == 0 and "whitened" in empty.columns


def test_numbers_beyond_64_bits(spark, scratch):
    rows = [(1, [1e30, 0.0]), (2, [-1e30, 1e15]), (3, [0.0, 5.0]), (4, [7e14, -3e15])]
    frame = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    got = whitening.whiten(frame, scratch).collect()
    want = {(w[0], w[1]): w for w in expected(rows)}
    assert len(got) == len(want)
    for r in got:
        w = want[r["row"]["vec_id"], r["component"]]
        assert int(r["deviation_digits"]) == w[3] and r["deviation"] == (w[3] if w[3] < 2**63 else None)
        assert r["identity_error"] < 1e-4
