"""Whitening against an eigensolver and exact arithmetic of fractions."""

import math
import random
from fractions import Fraction

import numpy as np
import pytest
from pyspark.sql import functions as F

from ledger.llm import whitening as w
from ledger.llm.queries import QUERIES

SF = "/root/testdata/sf0.001"
SCHEMA = "vec_id bigint, embedding array<float>, label int, x string, component int"


def vectors(spark, rows: list[tuple]):
    return spark.createDataFrame([(i, v, 0, "own", 9) for i, v in rows], SCHEMA)


def check(rows: list, vectors_by_row: list[tuple], components: int = 16) -> None:
    """``rows`` of the operator against the contract."""
    x = {i: np.array([math.floor(64 * float(np.float32(c))) + 1_000_000 for c in v], object) for i, v in vectors_by_row}
    fit = sorted({tuple(v) for v in x.values()})
    n, d = len(fit), len(fit[0])
    sums = [sum(v[j] for v in fit) for j in range(d)]
    centred = np.array([[float(Fraction(n * v[j] - sums[j], n)) for j in range(d)] for v in fit])
    cov = centred.T @ centred / n
    values, basis = np.linalg.eigh(cov)
    values, basis = values[::-1], basis[:, ::-1]
    count = min(components, d)
    assert len(rows) == len(vectors_by_row) * count
    by = {}
    for r in rows:
        assert r.n == n and r.deviation == sum((n * x[r.vec_id][j] - sums[j]) ** 2 for j in range(d))
        assert r.explained == pytest.approx(values[r.component - 1] / values.sum(), rel=1e-6, abs=1e-12)
        by.setdefault(r.component, {})[r.vec_id] = r.whitened
    for k, got in by.items():
        if values[k - 1] < 1e-9 * values[0]:
            assert set(got.values()) == {None}
            continue
        want = {i: float((np.array([float(Fraction(n * v[j] - sums[j], n)) for j in range(d)]) @ basis[:, k - 1]) / math.sqrt(values[k - 1])) for i, v in x.items()}
        lonely = all(abs(values[k - 1] - values[j]) > 1e-6 * values[0] for j in range(d) if j != k - 1)
        if lonely:
            sign = 1 if sum(got[i] * want[i] for i in x) > 0 else -1
            assert all(got[i] * sign == pytest.approx(want[i], abs=1e-6) for i in x)
    assert all(r.identity_error is None or r.identity_error < 1e-9 for r in rows)


def test_odd_rows(spark):
    nan, inf = float("nan"), float("inf")
    good = [(1, [0.5, 1.0, -2.0]), (2, [0.5, 1.0, -2.0]), (3, [3.0, 0.1, 0.25]), (4, [-1.0, 2.5, 0.75]), (5, [0.0, 0.0, 0.0]), (6, [1.25, -3.5, 9.0])]
    bad = [(7, None), (8, [1.0, None, 2.0]), (9, [nan, 1.0, 1.0]), (10, [inf, 0.0, 0.0]), (11, [-inf, 0.0, 0.0]), (12, [1.0, 2.0]), (13, [])]
    rows = w.whiten(vectors(spark, good + bad)).collect()
    check(rows, good)
    again = w.whiten(vectors(spark, [*good, (None, [3.0, 0.1, 0.25]), (1, [0.5, 1.0, -2.0])])).collect()
    assert len(again) == len(rows) + 6
    assert sorted({(r.component, r.explained) for r in again}) == sorted({(r.component, r.explained) for r in rows})


def test_nothing_to_fit(spark):
    assert w.whiten(vectors(spark, [])).collect() == []
    assert w.whiten(vectors(spark, [(1, None), (2, [])])).collect() == []
    rows = w.whiten(vectors(spark, [(1, [1.0, 2.0]), (2, [1.0, 2.0])])).collect()
    assert [(r.component, r.n, r.deviation, r.whitened, r.explained, r.identity_error) for r in rows] == [(k, 1, 0, None, None, None) for k in (1, 2)] * 2


def test_equal_and_missing_eigenvalues(spark):
    """A symmetric set: four equal eigenvalues, and two dimensions that never vary."""
    rows = [(2 * i + s, [float(4 * (1 - 2 * s)) if j == i else 1.0 * (j > 3) for j in range(6)]) for i in range(4) for s in (0, 1)]
    got = w.whiten(vectors(spark, rows)).collect()
    check(got, rows)
    assert {r.component for r in got if r.whitened is None} == {5, 6}


def test_huge_entries(spark):
    rows = [(1, [1e30, 1.0]), (2, [0.0, 2.0]), (3, [-1e30, 7.0])]
    got = w.whiten(vectors(spark, rows)).collect()
    assert {(r.vec_id, r.deviation) for r in got if r.vec_id == 1} == {(1, None)}
    exact = (3 * w.LIMIT) ** 2 + (3 * 64 - 640) ** 2
    assert {r.deviation_digits for r in got if r.vec_id == 1} == {str(exact)}
    assert all(r.identity_error < 1e-9 for r in got)


def test_given_embeddings(spark):
    rows = [(r.vec_id, r.embedding) for r in spark.read.parquet(f"{SF}/embeddings.parquet").collect()]
    check(QUERIES["op11_embedding_whitening"](spark, SF).collect(), rows)


def test_polynomial_and_roots():
    """Against products of known roots, moved by a unimodular change of basis; pivots that vanish included."""
    rng = random.Random(4)
    for _ in range(25):
        d = rng.randint(1, 7)
        rank = rng.randint(1, d)
        a = np.array([[rng.randint(-3, 3) for _ in range(rank)] for _ in range(d)], object)
        m = (a @ a.T).tolist()
        p, (q,) = 2_147_483_647, w.polynomial_modulo(m, [2_147_483_647]).tolist()
        for t in range(d + 1):
            minor = [[(t if i == j else 0) - m[i][j] for j in range(d)] for i in range(d)]
            assert sum(c * t ** k for k, c in enumerate(q)) % p == determinant(minor) % p
        coefficients = [c - p if c > p // 2 else c for c in q]
        found, bits = w.largest_roots(coefficients, d)
        values = np.linalg.eigvalsh(np.array(m, float))[::-1]
        mine = [r / (1 << bits) for r, k in found for _ in range(k)]
        assert np.allclose(mine, values[:len(mine)], atol=1e-9) and np.allclose(values[len(mine):], 0, atol=1e-8)


def determinant(m: list[list[int]]) -> int:
    m, out = [[Fraction(v) for v in row] for row in m], Fraction(1)
    for k in range(len(m)):
        r = next((i for i in range(k, len(m)) if m[i][k]), None)
        if r is None:
            return 0
        if r != k:
            m[k], m[r], out = m[r], m[k], -out
        out *= m[k][k]
        for i in range(k + 1, len(m)):
            f = m[i][k] / m[k][k]
            m[i] = [x - f * y for x, y in zip(m[i], m[k], strict=True)]
    return int(out)


def test_moments_of_wide_numbers():
    rng = random.Random(9)
    for top in (1 << 10, 1 << 25, 1 << 40, 1 << 62):
        rows = np.array([[rng.randrange(-top, top) for _ in range(3)] for _ in range(50)], np.int64)
        wide = rows.astype(object)
        assert (w._products(rows) == wide.T @ wide).all()


def test_filter_of_vectors(spark):
    rows = vectors(spark, [(1, [1.0]), (2, [float("nan")]), (3, [None]), (4, None)])
    assert [r.vec_id for r in rows.filter(w.usable(F.col("embedding"))).collect()] == [1]
