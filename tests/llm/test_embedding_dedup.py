from __future__ import annotations

import numpy as np
import pytest

from checks.compare import connect, difference
from corpuscope.llm import embedding_dedup as E
from corpuscope.llm.oracle import ORACLE
from corpuscope.llm.queries import QUERIES

SCHEMA = "vec_id long, embedding array<{}>, label int, row string, v string, part string, id long, component long"


def frame(spark, table, kind="float"):
    return spark.createDataFrame([(i, v, label, "r", "v", "p", 1, 2) for i, v, label in table], SCHEMA.format(kind))


def brute(table):
    """(n_links, component) of each row by all pairs."""
    def fine(row):
        i, v, label = row
        return i is not None and label is not None and v and all(c is not None and np.isfinite(c) for c in v) and any(v)

    n = len(table)
    near = [[] for _ in range(n)]
    units = [np.array(v, float) / np.linalg.norm(np.array(v, float)) if fine((i, v, label)) else None for i, v, label in table]
    for a in range(n):
        for b in range(n):
            if a != b and units[a] is not None and units[b] is not None and table[a][2] == table[b][2] and len(units[a]) == len(units[b]):
                if units[a] @ units[b] >= 0.93:
                    near[a].append(b)
    root = [row[0] for row in table]
    changed = True
    while changed:
        changed = False
        for a in range(n):
            for b in near[a]:
                if root[b] < root[a]:
                    root[a], changed = root[b], True
    return sorted(((table[a][0], len(near[a]), root[a]) for a in range(n)), key=str)


def got(df):
    rows = df.collect()
    assert all(r.kept == (r.row.vec_id is None or r.row.vec_id == r.component_id) for r in rows)
    return sorted(((r.row.vec_id, r.n_links, r.component_id) for r in rows), key=str)


def clusters(seed, dims, spread, count, size):
    """Vectors about random centres, many of them close to the threshold, in two groups."""
    rng = np.random.default_rng(seed)
    table = []
    for c in range(count):
        centre = rng.normal(size=dims)
        for _ in range(rng.integers(1, size)):
            table.append((len(table), (centre + rng.normal(size=dims) * rng.uniform(0, spread)).astype("f4").tolist(), int(rng.integers(2))))
    return table


def test_bounds_hold_and_links_are_all_found():
    rng = np.random.default_rng(1)
    some = 0
    for dims in (1, 3, 16, 64, 1500):
        base = rng.normal(size=(60, dims)) * 10.0 ** rng.uniform(-3, 3, size=(60, dims if dims < 4 else 1))
        a, b = E.Tile(base[:40]), E.Tile(np.vstack([base[30:], base[:30] + rng.normal(size=(30, dims)) * 0.3 * np.abs(base[:30])]))
        exact = a.units @ b.units.T
        coarse = (a.bytes * a.scale[:, None]) @ (b.bytes * b.scale[:, None]).T
        assert (np.abs(exact - coarse) <= np.outer(a.coarse, b.error) + a.error[:, None] + 1e-12).all()
        i, j, open_ = E.linked(a, slice(0, 40), b, slice(0, 60), 0.93)
        assert set(zip(i.tolist(), j.tolist())) == set(zip(*[x.tolist() for x in np.nonzero(exact >= 0.93)]))
        some += open_
    assert some  # the band between the bounds is met, and not all pairs are in it
    assert some < 5 * 40 * 60 / 4


def test_only_pairs_near_the_threshold_are_recomputed():
    rng = np.random.default_rng(2)
    tile = E.Tile(rng.normal(size=(500, 64)))
    assert E.linked(tile, slice(0, 500), tile, slice(0, 500), 0.93)[2] == 0


def test_extreme_sizes_of_vectors():
    tile = E.Tile(np.array([[1e300, 1e300], [1e-310, 1e-310], [5e-324, 0.0]]))
    assert np.allclose(np.linalg.norm(tile.units, axis=1), 1)
    assert E.linked(tile, slice(0, 3), tile, slice(0, 3), 0.93)[0].tolist() == [0, 0, 1, 1, 2]


def test_roots_of_ties():
    root = E.join_roots(np.arange(8), np.array([5, 3, 3, 6]), np.array([7, 5, 4, 1]))
    assert root.tolist() == [0, 1, 2, 3, 3, 3, 1, 3]
    assert E.join_roots(root, np.array([7]), np.array([6])).tolist() == [0, 1, 2, 1, 1, 1, 1, 1]


@pytest.mark.parametrize("tile", [3, 50, 2048])
def test_rows_against_all_pairs(spark, tile):
    table = clusters(4, 8, 0.45, 40, 9)
    first = table[5][1]
    table += [(1000 + k, first, table[5][2]) for k in range(30)] + [(7, first, table[5][2])]  # copies, and a key that repeats
    table += [(2000, [-c for c in first], table[5][2]), (2001, [2 * c for c in first], table[5][2])]
    want = brute(table)
    assert sum(n > 0 for _, n, _ in want) > 100 and len({c for _, _, c in want}) > 20
    assert got(E.near_duplicates(frame(spark, table), tile=tile)) == want


def test_blocks_of_a_tile(spark, monkeypatch):
    monkeypatch.setattr(E, "BLOCK", 7)
    monkeypatch.setattr(E, "EXACT", 3)
    monkeypatch.setattr(E, "RECOMPUTED", 40)
    table = clusters(5, 8, 0.45, 30, 7)
    vectors = np.array([v for _, v, _ in table])
    ones = np.ones(len(table), dtype=np.int64)
    count, root = E.compare(E.Tile(vectors), E.Tile(vectors), True, ones, ones, 0.93)
    want = {i: (n, c) for i, n, c in brute([(i, v, 1) for i, v, _ in table])}
    assert {k: (int(n), int(r)) for k, (n, r) in enumerate(zip(count, root))} == want


def test_double_vectors(spark):
    table = clusters(6, 5, 0.4, 12, 6)
    assert got(E.near_duplicates(frame(spark, table, "double"), tile=10)) == brute(table)


def test_hot_classes_are_told_by_broadcast(spark):
    table = [(k, [1.0, 0.0, 0.1], 1) for k in range(1500)] + [(2000 + k, [float(k), 1.0, 0.0], 1) for k in range(600)]
    table += [(5000 + k, [float(k), 1.0, 0.0], 1) for k in range(600)]
    assert got(E.near_duplicates(frame(spark, table))) == brute_fast(table)


def brute_fast(table):
    units = np.array([v for _, v, _ in table], float)
    units /= np.linalg.norm(units, axis=1, keepdims=True)
    near = units @ units.T >= 0.93
    counts = near.sum(1) - 1
    root = np.array([i for i, _, _ in table])
    while True:
        down = np.where(near, root[None, :], 1 << 60).min(1)
        if (down == root).all():
            return sorted(((i, int(n), int(r)) for (i, _, _), n, r in zip(table, counts, root)), key=str)
        root = down


def test_odd_and_empty_tables(spark, tmp_path):
    v = [1.0, 2.0, 3.0]
    table = [
        (1, v, 1), (2, v, 1), (2, v, 1), (3, v, None), (4, v, None), (None, v, 1), (5, None, 1), (6, [], 1), (7, [0.0, 0.0], 1), (8, [0.0, 0.0], 1),
        (9, [1.0, None, 3.0], 1), (10, [float("nan"), 2.0, 3.0], 1), (11, [float("inf"), 2.0, 3.0], 1), (12, [1.0, 2.0], 1), (13, v, 2), (14, [-0.0, 1.0], 3),
        (15, [0.0, 1.0], 3), (1, v, 1),
    ]
    want = brute(table)
    assert got(E.near_duplicates(frame(spark, table))) == want
    assert got(E.near_duplicates(frame(spark, []))) == []
    assert sorted(map(str, (r.vec_id for r in E.representatives(frame(spark, table)).collect()))) == sorted(
        map(str, [1, 1, 3, 4, None, 5, 6, 7, 8, 9, 10, 11, 12, 13, 14])
    )
    for name, rows in (("odd", table), ("near", clusters(8, 6, 0.5, 20, 8))):
        frame(spark, rows).write.parquet(f"{tmp_path}/{name}/embeddings.parquet")
        con = connect(f"{tmp_path}/{name}")
        assert difference(QUERIES["op12_embedding_dedup"](spark, f"{tmp_path}/{name}"), con, ORACLE["op12_embedding_dedup"]) is None
