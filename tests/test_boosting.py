"""Boosted trees: splits against a search of all, growth against a plain recursion."""

import itertools
import pickle

import numpy as np
import pytest
from pyspark import RDD
from pyspark.sql import functions as F

from patronage.config import CATEGORICAL_FEATURES
from patronage.operators import boosting as B
from patronage.operators import models as MD
from patronage.operators.panel import NUMERIC_FEATURES


def binned(seed, n=400, missing=0.1):
    """Bins of two numbers and a category, with slopes and curvatures."""
    rng = np.random.default_rng(seed)
    binning = B.Binning(["x", "y"], ["c"], [np.arange(6.0), np.arange(3.0)], [list("abcde")])
    bins = np.stack([rng.integers(0, s - 1, n) for s in binning.sizes], axis=1)
    gone = rng.random((n, 3)) < missing
    bins = np.where(gone, binning.sizes - 1, bins).astype(np.uint8)
    g = rng.normal(size=n) + (bins[:, 0] > 3) - (bins[:, 2] % 2) + (bins[:, 1] == 4)
    return binning, bins, g, rng.uniform(0.5, 1.5, n)


def histogram(binning, bins, g, h):
    sizes = binning.sizes
    flat = bins + np.cumsum(sizes) - sizes
    out = np.zeros((sizes.sum(), 3))
    for j, w in enumerate((g, h, np.ones(len(g)))):
        np.add.at(out[:, j], flat.ravel(), np.repeat(w, bins.shape[1]))
    return out


def gain(g, h, left, l2):
    def part(m):
        return g[m].sum() ** 2 / (h[m].sum() + l2)
    return part(left) + part(~left) - part(np.ones(len(g), bool))


def all_splits(binning, bins, g, h, s):
    """(gain, feature, rows that go left) of every split that the settings allow."""
    for f, size in enumerate(binning.sizes):
        b = bins[:, f]
        if f < 2:
            sides = [(b <= k) & (b < size - 1) | (b == size - 1) & m for k in range(size - 1) for m in (False, True)]
            l2 = s.l2
        else:
            there = [k for k in range(size) if (b == k).any()]
            there.sort(key=lambda k: (g[b == k].sum() / (h[b == k].sum() + s.smooth), k))
            sides = [np.isin(b, there[:k]) for k in range(1, len(there))]
            l2 = s.l2 + s.level_l2
        for left in sides:
            if min(left.sum(), (~left).sum()) >= s.min_leaf:
                yield gain(g, h, left, l2), f, left


@pytest.mark.parametrize("seed", range(12))
def test_a_split_equals_the_search_of_all(seed):
    binning, bins, g, h = binned(seed, missing=(0.0, 0.3)[seed % 2])
    s = B.Settings(min_leaf=(1, 40)[seed % 3 == 0], l2=1.0, smooth=2.0, level_l2=3.0)
    got = B.best_splits(histogram(binning, bins, g, h)[None], binning, s, np.ones(3, bool))[0]
    want = max(all_splits(binning, bins, g, h, s), key=lambda x: x[0])
    assert got[0] == pytest.approx(want[0])
    left = got[2][bins[:, got[1]]]
    assert gain(g, h, left, s.l2 + (s.level_l2 if got[1] == 2 else 0)) == pytest.approx(want[0])
    assert got[3] == pytest.approx(np.array([[g[m].sum(), h[m].sum(), m.sum()] for m in (left, ~left)]))


def test_a_category_split_is_the_best_of_all_subsets():
    for seed in range(8):
        binning, bins, g, h = binned(seed)
        s = B.Settings(min_leaf=1, l2=0.0, smooth=0.0, level_l2=0.0)
        got = B.best_splits(histogram(binning, bins, g, h)[None], binning, s, np.array([False, False, True]))[0]
        best = max(gain(g, h, np.isin(bins[:, 2], some), 0.0) for k in range(1, 6) for some in itertools.combinations(range(6), k))
        assert got[0] == pytest.approx(best)


def test_missing_values_go_to_the_side_that_fits_them():
    binning = B.Binning(["x"], [], [np.array([0.0])], [])
    for side in (0, 1):
        bins = np.repeat([[0], [1], [2]], 50, axis=0).astype(np.uint8)
        g = np.where(bins[:, 0] == 2, (1.0, -1.0)[side], np.where(bins[:, 0] == 0, 1.0, -1.0))
        _, _, left, _ = B.best_splits(histogram(binning, bins, g, np.ones(150))[None], binning, B.Settings(min_leaf=5), np.ones(1, bool))[0]
        assert left.tolist() == [True, False, side == 0]


def plain_tree(binning, bins, g, h, s):
    """Best-first growth by searching all splits of all leaves: (gain, feature) in order."""
    def best(rows):
        found = [x for x in all_splits(binning, bins[rows], g[rows], h[rows], s) if x[0] > 0]
        return max(found, key=lambda x: x[0]) if found else None
    leaves, out = [(np.arange(len(g)), best(np.arange(len(g))))], []
    while len(leaves) < s.leaves:
        can = [k for k, x in enumerate(leaves) if x[1]]
        if not can:
            break
        k = max(can, key=lambda k: leaves[k][1][0])
        rows, (gained, f, left) = leaves.pop(k)
        out.append((round(gained, 6), f))
        leaves += [(r, best(r)) for r in (rows[left], rows[~left])]
    value = np.zeros(len(g))
    for rows, _ in leaves:
        value[rows] = -s.rate * g[rows].sum() / (h[rows].sum() + s.l2)
    return out, value if out else np.zeros(len(g))


@pytest.mark.parametrize("leaves,min_leaf", [(8, 10), (31, 5), (3, 1), (31, 120), (2, 1)])
def test_growth_equals_a_plain_recursion(leaves, min_leaf):
    binning, bins, g, h = binned(leaves, 600)
    s = B.Settings(loss="squared", leaves=leaves, min_leaf=min_leaf, row_share=1.0, smooth=2.0, level_l2=3.0)
    growing, tree = B.Growing(s, binning, np.ones(3, bool)), None
    while tree is None:
        at = B.leaves_of(growing.splits, bins, np.arange(len(g)))
        growing.take(np.array([histogram(binning, bins[at[n]], g[at[n]], h[at[n]]) for n in growing.wanted]))
        tree = growing.choose()
    want, value = plain_tree(binning, bins, g, h, s)
    assert [(round(x.gain, 6), x.feature) for x in tree.splits] == want
    assert tree.score(bins) == pytest.approx(value)


def test_slopes_are_the_derivatives_of_the_loss():
    y, f = np.array([0.0, 3.0, 10.0]), np.array([0.3, -0.5, 1.2])
    for loss in ("tweedie", "squared"):
        s = B.Settings(loss=loss)
        g, h = s.slopes(y, f)
        for i in range(3):
            def at(d):
                return s.deviance(y[i:i + 1], f[i:i + 1] + d) / 2
            e = 1e-4
            assert g[i] == pytest.approx((at(e) - at(-e)) / (2 * e), rel=1e-5)
            assert h[i] == pytest.approx((at(e) - 2 * at(0) + at(-e)) / e ** 2, rel=1e-4)


def panel(spark, n, seed, levels=80):
    rng = np.random.default_rng(seed)
    rows = []
    for i in range(n):
        k = int(rng.integers(levels))
        x = rng.random()
        mean = np.exp(1.5 * x + (k % 4) * 0.5)
        rows.append((i, float(x) if rng.random() > 0.05 else None, f"c{k}", float(rng.gamma(20, mean / 20)) if rng.random() < 0.9 else 0.0))
    return spark.createDataFrame(rows, "customer_unique_id long, x double, c string, target double")


def test_spread_rows_give_the_trees_of_one_partition(spark, monkeypatch):
    train, valid = panel(spark, 1500, 1).repartition(6), panel(spark, 500, 2)
    s = [B.Settings(loss=x, rate=0.2, max_rounds=6, min_leaf=20, patience=3) for x in ("tweedie", "squared")]
    one = B.boost(train, valid, s, ["x"], ["c"], ["customer_unique_id"])
    monkeypatch.setattr(B, "BLOCK", 300)
    monkeypatch.setattr(B, "DIRECT", 2)  # sums are added in two steps
    monkeypatch.setattr(B, "KEEP", 2)    # scores are written and read again
    monkeypatch.setattr(B, "REMEMBERED", 1)
    many = B.boost(train, valid, s, ["x"], ["c"], ["customer_unique_id"])
    for a, b in zip(one, many, strict=True):
        assert a.rounds == b.rounds > 0
        for x, y in zip(a.trees, b.trees, strict=True):
            assert [(z.feature, z.left_bins.tolist()) for z in x.splits] == [(z.feature, z.left_bins.tolist()) for z in y.splits]
            assert list(x.values.values()) == pytest.approx(list(y.values.values()))


def test_a_pass_over_spread_rows_works_no_tree_out_again(spark, monkeypatch):
    """Blocks take in each tree once, so a pass costs the same in whichever worker a block comes to."""
    sent, passed = [], B.passed
    monkeypatch.setattr(B, "passed", lambda blocks, fit, asks, *a: (sent.extend(len(x.trees) for x in asks), passed(blocks, fit, asks, *a))[1])
    monkeypatch.setattr(B, "BLOCK", 300)
    s = [B.Settings(rate=0.2, max_rounds=5, min_leaf=20), B.Settings(loss="squared", rate=0.2, max_rounds=3, min_leaf=20)]
    made = B.boost(panel(spark, 1500, 1).repartition(6), None, s, ["x"], ["c"], ["customer_unique_id"])
    assert [m.rounds for m in made] == [5, 3] and len(sent) > 5 and max(sent) == 0


@pytest.mark.parametrize("seed", range(4))
def test_rows_of_wanted_leaves(seed):
    rng = np.random.default_rng(seed)
    bins, splits, leaves = rng.integers(0, 6, (300, 3)).astype(np.uint8), [], [0]
    for k in range(8):
        node = leaves.pop(int(rng.integers(len(leaves))))
        splits.append(B.Split(node, int(rng.integers(3)), 1.0, rng.random(6) < 0.5, 2 * k + 1, 2 * k + 2, np.zeros((2, 3))))
        leaves += [2 * k + 1, 2 * k + 2]
    rows = np.flatnonzero(rng.random(300) < 0.8)
    every = B.leaves_of(splits, bins, rows)
    for wanted in ([0], leaves[:1], leaves[1::2], leaves):
        got = B.rows_of(splits if wanted != [0] else [], wanted, bins, rows)
        assert all(got[n].tolist() == (every[n] if n else rows).tolist() for n in wanted)


def test_the_driver_gets_splits_and_not_sums(spark, monkeypatch):
    """The sums of a leaf, 24 bytes a bin, stay in the tasks, however many partitions there are."""
    train, valid = panel(spark, 3000, 1, levels=1200).repartition(6), panel(spark, 500, 2)
    got, collect = [], RDD.collect
    monkeypatch.setattr(RDD, "collect", lambda self: (got.append(collect(self)), got[-1])[1])
    monkeypatch.setattr(B, "BLOCK", 300)
    s = [B.Settings(loss=x, rate=0.2, max_rounds=3, min_leaf=20, patience=3) for x in ("tweedie", "squared")]
    assert B.boost(train, valid, s, ["x"], ["c"], ["customer_unique_id"])[0].rounds > 0
    bins = B.Binning.fit(train, ["x"], ["c"]).sizes.sum()
    assert got and max(len(pickle.dumps(x)) for x in got) < bins * 24


def test_partitions_are_no_more_than_cores(spark, monkeypatch):
    monkeypatch.setattr(B, "BLOCK", 10)
    train = panel(spark, 1000, 6).repartition(30)
    binning = B.Binning.fit(train, ["x"], ["c"])
    blocks = B.blocks_of(train, False, binning, ["customer_unique_id"], "target", [0.0])
    assert 1 < blocks.getNumPartitions() <= max(2, spark.sparkContext.defaultParallelism)
    assert blocks.map(lambda b: len(b.y)).sum() == 1000


@pytest.mark.parametrize("loss", ["tweedie", "squared"])
def test_boosting_takes_many_levels_and_stops_at_the_best_round(spark, loss):
    def wide(df):
        cols = {f: F.lit(1.0) for f in NUMERIC_FEATURES} | {f: F.lit("same") for f in CATEGORICAL_FEATURES} | {"origin": F.lit(1)}
        return df.withColumns(cols | {NUMERIC_FEATURES[0]: F.col("x"), CATEGORICAL_FEATURES[0]: F.col("c")})
    train, valid, test = (wide(panel(spark, n, seed, k)) for n, seed, k in ((1500, 1, 80), (500, 2, 80), (500, 3, 90)))
    m = MD.fit_boosted(train, valid, rate=0.3, max_rounds=30, patience=10, min_leaf=20)[loss]
    assert 0 < m.rounds <= 30 and all(len(t.values) <= 31 for t in m.trees)
    got = m.transform(test).select("prediction", "target", "c").toPandas()
    assert np.isfinite(got["prediction"]).all() and (loss == "squared" or (got["prediction"] > 0).all())
    got = got[got["c"].str[1:].astype(int) < 80]  # the others are levels that train lacks
    assert np.corrcoef(got["prediction"], got["target"])[0, 1] > 0.4
    assert ((got["prediction"] - got["target"]) ** 2).mean() < got["target"].var()
    rows = MD.feature_importances(spark, m).collect()
    assert {r["feature"] for r in rows[:2]} == {NUMERIC_FEATURES[0], CATEGORICAL_FEATURES[0]}
    assert sum(r["splits"] for r in rows) == sum(len(t.splits) for t in m.trees)
    assert sum(r["gain_pct"] for r in rows) == pytest.approx(100)


def test_a_model_comes_back_from_its_tables(spark):
    train = panel(spark, 800, 4)
    m = B.boost(train, None, [B.Settings(rate=0.2, max_rounds=5, min_leaf=20)], ["x"], ["c"], ["customer_unique_id"])[0]
    assert m.rounds == 5
    back = B.BoostedModel.read(m.tables(spark))
    a, b = (x.transform(train, "p").orderBy("customer_unique_id").select("p").toPandas()["p"] for x in (m, back))
    assert (a == b).all() and back.importances() == m.importances()
    assert pickle.loads(pickle.dumps(m)).rounds == 5


def test_nothing_to_learn_from(spark):
    train = panel(spark, 50, 5)
    s = [B.Settings(max_rounds=4), B.Settings(loss="squared", max_rounds=4, min_leaf=5)]
    none = B.boost(train.limit(0), None, s, ["x"], ["c"], ["customer_unique_id"])
    assert [m.rounds for m in none] == [0, 0]
    same = B.boost(train.withColumns({"x": F.lit(None).cast("double"), "c": F.lit(None).cast("string")}), None, s, ["x"], ["c"],
                   ["customer_unique_id"])
    assert [m.rounds for m in same] == [0, 0]
    assert same[1].transform(train).select("prediction").distinct().count() == 1
    assert none[0].transform(train.limit(0)).collect() == []
