import numpy as np
import pytest
from pyspark.sql import functions as F

from paylens.llm import bidiagonal as B
from paylens.llm import whiten as M

SCHEMA = "vec_id long, embedding array<float>, label int, n int, component string, x string, size int"


def table(spark, rows, partitions=3):
    return spark.createDataFrame([(i, v, 0, 1, "clash", "y", 3) for i, v in rows], SCHEMA).repartition(partitions)


def compare(got, rows, components=32):
    """Against the eigenvectors of the covariance, as numpy has them."""
    rows = [(i, [int(np.floor(float(np.float32(c)) * 64)) + 1_000_000 for c in v]) for i, v in rows]
    x = np.array([v for _, v in rows], np.int64)
    n, d = x.shape
    y = x - x.mean(axis=0)
    values, axes = np.linalg.eigh(y.T @ y / n)
    values, axes = values[::-1], axes[:, ::-1]
    k = min(components, d)
    assert len(got) == n * k and all(r.n == n for r in got)
    moved = (n * x - x.sum(axis=0)).astype(object)
    deviations = {i: int((m * m).sum()) for (i, _), m in zip(rows, moved)}
    assert all(r.deviation == deviations[r.vec_id] for r in got)
    z = {(r.vec_id, r.component): r.whitened for r in got}
    for c in range(k):
        live = values[c] > values[0] * 1e-20 and n > c + 1
        assert all(r.explained == pytest.approx(max(values[c], 0) / values.sum(), rel=1e-9, abs=1e-12) for r in got if r.component == c + 1)
        if live:
            want = y @ axes[:, c] / np.sqrt(values[c])
            have = np.array([z[i, c + 1] for i, _ in rows])
            assert min(np.abs(want - have).max(), np.abs(want + have).max()) < 1e-7
    assert {r.identity_error for r in got}.issubset({got[0].identity_error}) and got[0].identity_error < 1e-9


def test_query_equals_numpy(spark, sf_dir):
    from paylens.llm.queries import op12_whiten
    rows = [(r.vec_id, r.embedding) for r in spark.read.parquet(f"{sf_dir}/embeddings.parquet").collect()]
    compare(op12_whiten(spark, sf_dir).collect(), rows)


@pytest.mark.parametrize("partitions", [1, 20])
def test_small_variances_and_few_dimensions(spark, partitions):
    rng = np.random.default_rng(1)
    axes, _ = np.linalg.qr(rng.normal(size=(6, 6)))
    rows = [(i, (v * [3000, 300, 30, 9, 3, 1] @ axes + 700).tolist()) for i, v in enumerate(rng.normal(size=(300, 6)))]
    compare(M.whiten(table(spark, rows, partitions)).collect(), rows)
    compare(M.whiten(table(spark, rows, partitions), components=2).collect(), rows, 2)


def test_odd_rows(spark):
    nan, inf = float("nan"), float("inf")
    bad = [(1, [1.0, None]), (2, None), (3, []), (4, [nan, 1.0]), (5, [inf, 1.0])]
    rows = [(None, [9.0, 9.0]), (6, [-1.0, 3.5]), (6, [-1.0, 3.5]), (2**60 + 1, [0.0, 1.0]), (7, [1.0, 1.0]), (7, [2.0, -1.0])]
    got = M.whiten(table(spark, bad + rows)).collect()
    assert len(got) == 12 and {r.n for r in got} == {6} and {r.vec_id for r in got} == {None, 6, 7, 2**60 + 1}
    assert got[0].identity_error < 1e-12
    assert M.whiten(table(spark, bad)).collect() == [] and M.whiten(table(spark, [])).collect() == []


def test_lists_without_variance(spark):
    one = M.whiten(table(spark, [(1, [1.0, 2.0, 3.0])])).collect()
    assert [(r.component, r.n, r.deviation, r.whitened, r.explained, r.identity_error) for r in one] == [
        (c, 1, 0, None, 0.0, None) for c in (1, 2, 3)]
    rng = np.random.default_rng(2)
    few = [(i, rng.normal(size=8).tolist()) for i in range(4)]
    got = M.whiten(table(spark, few)).collect()
    assert {r.component for r in got if r.whitened is not None} == {1, 2, 3} and len(got) == 32
    assert got[0].identity_error < 1e-9
    equal = M.whiten(table(spark, [(i, [5.0, v, v]) for i, v in enumerate([1.0, 2.0, 4.0])])).collect()
    assert {r.component for r in equal if r.whitened is not None} == {1}
    assert sorted(r.explained for r in equal)[-1] == pytest.approx(1)


def test_lengths_are_lists_of_their_own(spark):
    rng = np.random.default_rng(3)
    short, long = ([(i, rng.normal(size=d).tolist()) for i in range(s, s + 40)] for s, d in ((0, 3), (100, 5)))
    got = M.whiten(table(spark, short + long)).collect()
    compare([r for r in got if r.vec_id < 100], short)
    compare([r for r in got if r.vec_id >= 100], long)


def test_large_deviations_are_exact():
    x = np.array([[2**30, 5], [-2**30, 7], [3, 2**31]], np.int64)
    model = M.Model(3, x.sum(axis=0), 0, *[np.zeros(0)] * 3)
    assert model.deviations(x) == [sum((3 * int(a) - int(s)) ** 2 for a, s in zip(r, x.sum(axis=0))) for r in x]


def matrices():
    rng = np.random.default_rng(0)
    q, _ = np.linalg.qr(rng.normal(size=(50, 50)))
    w = np.diag(np.abs(np.arange(-10, 11)) + 2.0) + np.diag(np.ones(20), 1) + np.diag(np.ones(20), -1)
    return {
        "random": rng.normal(size=(300, 64)), "low rank": rng.normal(size=(50, 3)) @ rng.normal(size=(3, 20)), "identity": np.eye(30),
        "repeated": np.repeat(rng.normal(size=(300, 8)), 2, axis=1), "constant": np.hstack([rng.normal(size=(99, 8)), np.zeros((99, 4))]),
        "graded": rng.normal(size=(99, 40)) * np.logspace(0, -12, 40), "equal blocks": np.kron(np.eye(4), rng.normal(size=(8, 8))),
        "one": np.array([[-3.0]]), "zero": np.zeros((5, 5)), "pairs": np.linalg.cholesky(w).T, "nearly equal": (q * (1 + 1e-13 * rng.normal(size=50))) @ q.T,
    }


@pytest.mark.parametrize("name", matrices())
def test_singular_values_and_vectors(name):
    a = matrices()[name]
    r = np.linalg.qr(a, mode="r")
    s, v = B.right_singular(r)
    want = np.linalg.svd(r, compute_uv=False)
    assert np.abs(s - want).max() <= 1e-14 * max(want[0], 1)
    assert np.abs(v.T @ v - np.eye(len(s))).max() < 1e-10
    assert np.abs(r.T @ (r @ v) - v * s**2).max() <= 1e-13 * max(want[0], 1) ** 2


def test_small_singular_values_keep_their_digits():
    """Of a bidiagonal matrix whose entries span twelve decades, as rational arithmetic has them."""
    from fractions import Fraction

    d, f = [1.0, 1e-3, 1e-6, 1e-9], [0.5, 2e-4, 3e-7]
    value = B.dqds(np.array(d) ** 2, np.array(f) ** 2)[-1]
    q, e = [Fraction(x) ** 2 for x in d], [Fraction(x) ** 2 for x in f]

    def below(shift):
        """Number of eigenvalues under the shift: negative pivots of the exact transform."""
        at, n = q[0] - shift, 0
        for i in range(len(e)):
            n += at + e[i] < 0
            at = at * q[i + 1] / (at + e[i]) - shift
        return n + (at < 0)

    assert below(Fraction(value) * (1 - Fraction(1, 10**13))) == 0 and below(Fraction(value) * (1 + Fraction(1, 10**13))) == 1


def test_bidiagonal_form_keeps_the_product():
    a = np.random.default_rng(7).normal(size=(9, 9))
    d, f, v = B.bidiagonalise(a)
    b = np.diag(d) + np.diag(f, 1)
    assert np.allclose(v @ b.T @ b @ v.T, a.T @ a, atol=1e-12)
