from __future__ import annotations

import numpy as np
import pytest
from pyspark.sql import functions as F

from corpuscope.llm import whitening as W
from corpuscope.llm.queries import QUERIES, fixed_point


def test_factor_of_full_and_low_rank():
    rng = np.random.default_rng(1)
    for size, rank in ((1, 1), (5, 5), (12, 7), (30, 30), (6, 0)):
        m = rng.normal(size=(size, rank)) * 10.0 ** rng.uniform(-3, 3, size=(size, 1))
        a = m @ m.T
        lower, order = W.pivoted_cholesky(a)
        assert lower.shape == (size, rank)
        assert np.allclose(lower @ lower.T, a[np.ix_(order, order)], rtol=1e-12, atol=1e-12 * np.abs(a).max(initial=1))
        assert np.allclose(np.triu(lower, 1), 0)


def test_rounds_hold_every_pair_once():
    for count in (0, 1, 2, 5, 8):
        met = [tuple(sorted(pair)) for p, q in W.rounds(count) for pair in zip(p.tolist(), q.tolist())]
        assert sorted(met) == [(a, b) for a in range(count) for b in range(a + 1, count)]
        assert all(len(set(p) | set(q)) == 2 * len(p) for p, q in W.rounds(count))


def test_eigen_against_the_library():
    rng = np.random.default_rng(2)
    m = rng.normal(size=(400, 40)) * np.geomspace(1, 1e-4, 40)
    a = m.T @ m
    values, vectors = W.eigen(a)
    assert np.allclose(values, np.linalg.eigvalsh(a)[::-1], rtol=1e-9)
    assert np.abs(vectors.T @ vectors - np.eye(40)).max() < 1e-13
    assert np.abs(a @ vectors - vectors * values).max() < 1e-13 * values[0]
    values, vectors = W.eigen(np.diag([2.0, 5.0, 5.0, 0.0]))  # ties, and a rank that is not full
    assert values.tolist() == pytest.approx([5, 5, 2]) and np.allclose(np.abs(vectors).sum(0), 1)


def usable(v):
    return v is not None and all(c is not None and np.isfinite(c) and abs(c) <= 2.0**40 for c in v)


def check(rows, table, components=16):
    """The query's rows against exact integers and the library's eigenvectors, for vectors of one length."""
    kept = [(i, np.array([int(np.floor(64 * float(c))) + 1000000 for c in v], dtype=object)) for i, v in table if usable(v)]
    distinct = np.array(sorted({tuple(x) for _, x in kept}), dtype=object)
    n, sums = len(distinct), distinct.sum(0)
    centred = np.array([[(n * c - s) / n for c, s in zip(x, sums)] for x in distinct], dtype=float)
    cov = centred.T @ centred / n
    values, vectors = np.linalg.eigh(cov)
    values, vectors = values[::-1], vectors[:, ::-1]
    rank = int((values > 1e-9 * values[0]).sum())
    want = min(components, rank)
    assert len(rows) == len(kept) * want
    by_id = {}
    for r in rows:
        by_id.setdefault(r.vec_id, {}).setdefault(r.component, []).append(r)
    for i, x in kept:
        assert sorted(by_id[i]) == list(range(1, want + 1))
        own = np.array([(n * c - s) / n for c, s in zip(x, sums)], dtype=float)
        for k, repeated in by_id[i].items():
            for r in repeated:
                assert r.n == n and r.deviation == sum((n * c - s) ** 2 for c, s in zip(x, sums))
                assert r.explained == pytest.approx(values[k - 1] / np.trace(cov), rel=1e-9)
                assert r.identity_error < 1e-9
    white = np.array([[by_id[i][k][0].whitened for k in range(1, want + 1)] for i, _ in kept])
    own = np.array([[(n * c - s) / n for c, s in zip(x, sums)] for _, x in kept], dtype=float)
    expected = own @ vectors[:, :want] / np.sqrt(values[:want])
    signs = np.sign((expected * white).sum(0))
    assert np.abs(white - signs * expected).max() < 1e-6


def write(spark, folder, table, kind="float"):
    frame = spark.createDataFrame([(i, v, 1, "x", "y") for i, v in table], f"vec_id long, embedding array<{kind}>, label int, row string, x string")
    frame.write.parquet(f"{folder}/embeddings.parquet")


def test_the_query_against_exact_integers(spark, tmp_path):
    rng = np.random.default_rng(3)
    table = [(i, rng.normal(size=20).astype("f4").tolist()) for i in range(150)]
    table += [(200 + i, table[7][1]) for i in range(60)] + [(7, table[7][1])]  # copies weigh nothing; a repeated row stays
    bad = [*table[1][1][:-1]]
    table += [(300, None), (301, bad + [None]), (302, bad + [float("nan")]), (303, bad + [float("-inf")])]
    write(spark, tmp_path, table)
    check(QUERIES["op13_whitening"](spark, str(tmp_path)).collect(), table)


def test_large_entries_are_exact(spark, tmp_path):
    rng = np.random.default_rng(4)
    table = [(i, (rng.normal(size=3) * 1e5).tolist()) for i in range(50)] + [(90, [1e300, 0.0, 0.0])]
    write(spark, tmp_path, table, "double")
    check(QUERIES["op13_whitening"](spark, str(tmp_path)).collect(), table)


def test_deviation_beyond_a_long():
    fit = W.Fit(10**9, np.array([0, 0]), [10**9 - 1, -5], np.zeros(2))
    x = np.array([[3 * 10**6, -7], [0, 0]])
    want = [sum((10**9 * c - s) ** 2 for c, s in zip(row, fit.sums)) for row in x.tolist()]
    assert [int(v) for v in fit.deviation(x).to_pylist()] == want


def test_odd_and_empty_tables(spark, tmp_path):
    def rows(name, table):
        write(spark, tmp_path / name, table)
        return QUERIES["op13_whitening"](spark, str(tmp_path / name)).collect()

    assert rows("none", []) == [] and rows("null", [(1, None), (2, [])]) == []
    assert rows("equal", [(1, [1.0, 2.0]), (2, [1.0, 2.0])]) == []  # no variance, no component
    assert [r.component for r in rows("line", [(1, [1.0, 2.0]), (2, [2.0, 4.0]), (None, [3.0, 6.0])])] == [1, 1, 1]
    # Each length is a table of its own.
    two = rows("two", [(1, [1.0]), (2, [2.0]), (3, [0.0, 0.0]), (4, [0.0, 1.0]), (5, [1.0, 3.0])])
    assert sorted((r.vec_id, r.component, r.n) for r in two) == [(1, 1, 2), (2, 1, 2)] + [(i, k, 3) for i in (3, 4, 5) for k in (1, 2)]


def test_fixed_point(spark):
    frame = spark.createDataFrame([([0.5, -0.001, 0.0],), ([None],), (None,)], "v array<float>")
    assert [r[0] for r in frame.select(fixed_point(F.col("v"))).collect()] == [[1000032, 999999, 1000000], None, None]
