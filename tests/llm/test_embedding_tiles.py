"""Tiled comparison against all pairs."""

import math

import numpy as np
import pytest

from patronage.llm import embedding_tiles as E

VECS = "vec_id long, embedding array<double>, label int"


def slow(rows, least):
    """(n_links, component_id, kept) of each row by comparing all pairs."""
    def fine(v):
        return v is not None and len(v) and all(x is not None and math.isfinite(x) for x in v) and any(v)
    unit = [None if not fine(v) else np.array(v, float) / np.abs(np.array(v, float)).max() for _, v, _ in rows]
    unit = [None if u is None else u / math.sqrt(u @ u) for u in unit]
    n, near = len(rows), [[] for _ in rows]
    for i in range(n):
        for j in range(n):
            if i != j and unit[i] is not None and unit[j] is not None and len(unit[i]) == len(unit[j]) \
                    and rows[i][2] is not None and rows[i][2] == rows[j][2] and unit[i] @ unit[j] >= least:
                near[i].append(j)
    out = []
    for i in range(n):
        seen, todo = {i}, [i]
        while todo:
            new = [j for j in near[todo.pop()] if j not in seen]
            seen.update(new)
            todo += new
        c = min((rows[j][0] for j in seen if rows[j][0] is not None), default=None)
        out.append((rows[i][0], len(near[i]), c, rows[i][0] == c))
    return sorted(out, key=str)


def clusters(seed, n, d, labels):
    rng = np.random.default_rng(seed)
    x = rng.normal(size=(n, d)) * np.linspace(2, 0.2, d)
    for i in range(0, n - 8, 9):  # near copies and chains
        for k in range(1, 6):
            x[i + k] = x[i + k - 1] + rng.normal(size=d) * 0.08 * rng.random() * np.linalg.norm(x[i]) / math.sqrt(d) * 2
    return [(i, x[i].tolist(), int(rng.integers(labels))) for i in range(n)]


@pytest.mark.parametrize("least,tile,d", [(0.98, 16, 12), (0.9, 7, 40), (0.999, 4096, 3)])
def test_equal_to_all_pairs(spark, least, tile, d):
    rows = clusters(tile, 260, d, 2)
    rows = [(i, v, 0 if i % 3 else k) for i, v, k in rows]
    rows += [(1000 + i, rows[i][1], rows[i][2]) for i in range(0, 60, 2)]  # exact copies
    got = E.near_duplicates(spark.createDataFrame(rows, VECS), least, tile=tile).collect()
    assert sorted(map(tuple, got), key=str) == slow(rows, least)
    assert sum(r["n_links"] for r in got) > 100


def test_defined_results(spark):
    nan, inf = float("nan"), float("inf")
    rows = [(1, [1.0, 0.0], 1), (2, [1.0, 0.0], 1), (2, [1.0, 0.0], 1), (3, [1.0, 0.0], 2), (4, [1.0, 0.0], None),
            (5, None, 1), (6, [], 1), (7, [0.0, 0.0], 1), (8, [1.0, None], 1), (9, [nan, 1.0], 1), (10, [inf, 1.0], 1),
            (None, [2.0, 0.0], 1), (11, [1.0, 0.0, 0.0], 1), (12, [1e300, 1e290], 1), (13, [1e-300, 0.0], 1),
            (None, [0.0, 5.0], 1), (None, None, 1), (14, [-1.0, 0.0], 1), (15, [1.0, -0.0], 1), (16, [9.0, 1.0, 1.0], 1),
            (17, [9.0, 1.0, 1.0], 1), (18, [3.0], 1), (19, [2.0], 1)]
    v = spark.createDataFrame(rows, VECS).selectExpr("*", "1 key", "'a' cell", "2 vec", "3 n", "4 kept", "5 kind")
    assert sorted(map(tuple, E.near_duplicates(v).collect()), key=str) == slow(rows, 0.98)
    assert E.near_duplicates(v.limit(0)).collect() == []
    assert sorted(map(tuple, E.near_duplicates(v.where("vec_id between 4 and 6")).collect())) == [
        (4, 0, 4, True), (5, 0, 5, True), (6, 0, 6, True)]


def test_threshold_itself(spark):
    c, s = 0.98, math.sqrt(1 - 0.98 ** 2)
    for e, want in ((1e-6, 1), (-1e-6, 0)):
        a = math.acos(0.98) - e
        rows = [(1, [1.0, 0.0], 1), (2, [math.cos(a), math.sin(a)], 1), (3, [-s, -c], 1)]
        got = {r["vec_id"]: r["n_links"] for r in E.near_duplicates(spark.createDataFrame(rows, VECS)).collect()}
        assert got == {1: want, 2: want, 3: 0}


def test_bound_never_loses_a_pair():
    rng = np.random.default_rng(3)
    x = rng.normal(size=(300, 24)) * np.linspace(3, 0.1, 24)
    x[150:] = x[:150] + rng.normal(size=(150, 24)) * 0.1
    m = E.units(x)
    turn = np.linalg.eigh(m.T @ m)[1][:, ::-1]
    for turned in (None, turn):
        t = E.Tile(x, turned)
        for least in (0.5, 0.9, 0.98):
            mask = np.zeros((300, 300), bool)
            for at in range(0, 300, 64):
                i, j, close = E.alike(t, t, slice(at, at + 64), least)
                mask[np.ix_(i, j)] = close
            assert (mask == (m @ m.T >= least)).all()


def test_a_dense_group_gives_a_forest(spark):
    rng = np.random.default_rng(1)
    x = np.ones((400, 16)) + rng.normal(size=(400, 16)) * 0.01
    t, one = E.Tile(x, None), np.ones(400, np.int64)
    la, _, forest = E.meet(t, t, one, one, 0.98, True)
    assert (la == 399).all() and len(forest) == 399
    rows = [(i, v.tolist(), 1) for i, v in enumerate(x)]
    got = E.near_duplicates(spark.createDataFrame(rows, VECS), tile=50).collect()
    assert {(r["n_links"], r["component_id"]) for r in got} == {(399, 0)} and sum(r["kept"] for r in got) == 1
