import random

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from patronage.functions.special import hyp2f1, lgamma, log_gamma
from patronage.operators.likelihood import bgnbd_terms
from patronage.operators.models import bgnbd_loglik
from patronage.plans.ranking import global_rank, group_quantiles, grouped_prefix, rank_bin
from patronage.plans.replicates import bootstrap, draws, key_hashes, replicate_sums, replicate_weights
from patronage.plans.sequence import lag_within


def test_global_rank_matches_sort_and_is_partition_invariant(spark):
    rnd = random.Random(7)
    rows = [(i, float(rnd.randint(0, 20))) for i in range(2000)]
    df = spark.createDataFrame(rows, "k long, v double")
    expected = {k: i + 1 for i, (k, v) in enumerate(sorted(rows, key=lambda r: (-r[1], r[0])))}
    for n in (1, 8):
        r = global_rank(df, [F.col("v").desc(), F.col("k").asc()], "rank", n_parts=n)
        assert {x["k"]: x["rank"] for x in r.collect()} == expected


def test_rows_are_exchanged_once_by_range(spark, monkeypatch):
    from patronage.plans import ranking
    written, real = [], ranking.materialize

    def seen(df):
        written.append(df._jdf.queryExecution().executedPlan().toString().lower())
        return real(df)
    monkeypatch.setattr(ranking, "materialize", seen)
    df = spark.range(1000).withColumn("v", F.col("id") % 7)
    order = [F.col("v").asc(), F.col("id").asc()]
    made = [global_rank(df, order, "r"), lag_within(df, "v", ["id"], "id", "p"), grouped_prefix(df, ["v"], [F.col("id").asc()], {"c": "id"})]
    for plan in written:
        assert plan.count("exchange ") == plan.count("exchange rangepartitioning") == 1 and "window" not in plan
    assert len(written) == len(made) == 3
    for out in made:  # what follows reads the written ranges; only the table of ranges is in one partition
        out.collect()
        assert "rangepartitioning" not in out._jdf.queryExecution().executedPlan().toString().lower()
    assert not spark.sparkContext._jsc.getPersistentRDDs()


def test_rank_bins_match_qcut_on_ranks(spark):
    import numpy as np
    for n in (7, 10, 11, 13):
        ranks = np.arange(1, n + 1)
        edges = np.percentile(ranks, np.linspace(0, 100, 6))
        expected = [max(1, int(np.searchsorted(edges, r, side="left"))) for r in ranks]
        df = spark.createDataFrame([(int(r), n) for r in ranks], "r long, n long")
        got = [x[0] for x in df.orderBy("r").select(rank_bin("r", "n", 5)).collect()]
        assert got == expected, (n, got, expected)


def test_lag_within_matches_window_lag_with_hot_key(spark):
    rnd = random.Random(3)
    rows = [(0 if rnd.random() < 0.5 else rnd.randint(1, 30), rnd.randint(0, 10_000), i) for i in range(3000)]
    df = spark.createDataFrame(rows, "key long, t long, id long")
    w = Window.partitionBy("key").orderBy("t", "id")
    exp = {r["id"]: r["p"] for r in df.withColumn("p", F.lag("t").over(w)).collect()}
    got = {r["id"]: r["p"] for r in lag_within(df, "key", ["t", "id"], "t", "p", n_parts=6).collect()}
    assert got == exp


def test_special_functions(spark):
    import math
    df = spark.createDataFrame([(0.3,), (1.0,), (2.5,), (17.2,)], "z double")
    for r in df.select("z", lgamma(F.col("z")).alias("g")).collect():
        assert abs(r["g"] - math.lgamma(r["z"])) < 1e-9
        assert abs(float(log_gamma(r["z"])) - math.lgamma(r["z"])) < 1e-9
    z = np.array([1e-6, 0.3, 0.6, 0.98, 0.995, 0.999, 0.9999])
    assert np.allclose(hyp2f1(1.0, 1.0, 2.0, z), -np.log1p(-z) / z, rtol=1e-9, atol=0)
    assert np.allclose(hyp2f1(2.5, 0.7, 0.7, z), (1 - z) ** -2.5, rtol=1e-9, atol=0)


def test_ties_take_one_row_in_quantiles(spark):
    rows = spark.range(40_000).select(F.lit("g").alias("g"), F.when(F.col("id") % 20 == 0, F.col("id"))
                                      .otherwise(F.lit(0)).cast("double").alias("v"))
    got = {r["p"]: r["quantile"] for r in group_quantiles(rows, "g", "v", [0.0, 0.5, 0.951, 0.99, 1.0]).collect()}
    v = np.where(np.arange(40_000) % 20 == 0, np.arange(40_000), 0)
    assert got == {p: float(np.quantile(v, p)) for p in got}


def test_poisson_weights_moments():
    rng = np.random.default_rng(1)
    w = draws(rng.integers(0, 1 << 28, 2000), rng.integers(0, 1 << 28, 2000), 200, 0)
    assert abs(w.mean() - 1) < 0.01 and abs(w.var() - 1) < 0.02 and abs((w == 0).mean() - 0.3679) < 0.01
    rows = np.corrcoef(w[:, :50].T) - np.eye(50)
    assert abs(rows).max() < 0.12   # replicates do not go together


def test_weights_agree_between_numpy_and_catalyst(spark):
    keys = spark.range(300).select(F.concat(F.lit("c"), "id").alias("key"))
    got = {(r["key"], r["replicate"]): r["w"] for r in replicate_weights(keys, "key", 20, 5).collect()}
    pdf = keys.withColumns(key_hashes("key")).toPandas()
    w = draws(pdf["__h1"].to_numpy(), pdf["__h2"].to_numpy(), 20, 5)
    assert got == {(k, b + 1): int(w[i, b]) for i, k in enumerate(pdf["key"]) for b in range(20) if w[i, b]}


def test_replicate_sums_equal_sums_over_weighted_rows(spark, monkeypatch):
    from patronage.plans import replicates
    monkeypatch.setattr(replicates, "CELLS", 64)
    df = spark.range(500).selectExpr("concat('c', id) key", "if(id % 3 = 0, 'a', null) g", "cast(id % 7 as int) bin",
                                     "cast(id % 11 as double) - 3 y").repartition(5)
    w = replicate_weights(df, "key", 12, 9)
    want = {(r["g"], r["bin"], r["replicate"]): (r["w"], r["wy"]) for r in w.groupBy("g", "bin", "replicate").agg(
        F.sum("w").alias("w"), F.sum(F.col("w") * F.col("y")).alias("wy")).collect()}
    got = {(r["g"], r["bin"], r["replicate"]): (r["w"], r["wy"])
           for r in replicate_sums(df, ["g", "bin"], "key", {"w": "1D", "wy": "y"}, 12, 9).collect() if r["w"]}
    assert got == want
    assert replicate_sums(df.limit(0), ["g"], "key", {"w": "1D"}, 3, 0).collect() == []


def test_bootstrap_against_brute_force(spark, monkeypatch):
    """Ties that lie across chunks and ranges, negative targets, a score that most rows share."""
    from patronage.plans import replicates
    monkeypatch.setattr(replicates, "CELLS", 40)
    rng = np.random.default_rng(3)
    n, n_boot = 400, 8
    y = np.where(rng.random(n) < 0.7, 0.0, rng.integers(-2, 6, n))
    p = np.where(rng.random(n) < 0.6, 1.0, rng.integers(0, 30, n) / 2)
    df = spark.createDataFrame([("m", f"k{i:04d}", float(y[i]), float(p[i])) for i in range(n)]
                               + [("one class", f"k{i:04d}", 0.0, float(p[i])) for i in range(n)],
                               "model string, key string, y double, p double").repartition(4)
    got = {r["replicate"]: r for r in bootstrap(df, n_boot, 7, 0.1).collect()}
    pdf = df.where("model = 'm'").withColumns(key_hashes("key")).toPandas().sort_values("key")
    w = draws(pdf["__h1"].to_numpy(), pdf["__h2"].to_numpy(), n_boot, 7).astype(int)
    assert sorted(got) == list(range(1, n_boot + 1))
    for b in range(n_boot):
        at = np.repeat(np.arange(n), w[:, b])
        yy, pp = y[at], p[at]
        up = pp[yy > 0][:, None] - pp[yy <= 0][None, :]
        order = np.lexsort((at, -pp))
        top = yy[order][:max(int(len(at) * 0.1), 1)].sum()
        r = got[b + 1]
        assert r["model"] == "m"
        assert abs(r["auc"] - ((up > 0) + (up == 0) / 2).mean()) < 1e-9
        assert abs(r["spearman"] - np.corrcoef(pd.Series(yy).rank(), pd.Series(pp).rank())[0, 1]) < 1e-9
        assert abs(r["top_capture"] - 100 * top / max(yy.sum(), 1e-9)) < 1e-6
    assert bootstrap(df.limit(0), n_boot, 7, 0.1).count() == 0


def test_weights_equal_plain_integer_arithmetic():
    from patronage.plans.replicates import LIMITS, PRIME, REPLICATE_STEP, SEED_STEP
    h1, h2 = [0, 1, (1 << 28) - 1, 123_456_789], [(1 << 28) - 1, 0, 77, 200_000_001]
    for seed in (0, 7, -3):
        got = draws(np.array(h1), np.array(h2), 500, seed)
        want = [[sum(pow(pow(a + b * REPLICATE_STEP + seed * SEED_STEP, 5, PRIME) + c, 5, PRIME) >= t for t in LIMITS)
                 for b in range(1, 501)] for a, c in zip(h1, h2, strict=True)]
        assert (got == np.array(want)).all()


@pytest.mark.parametrize("ties", [False, True])
def test_bootstrap_moves_rows_and_not_rows_times_replicates(spark, monkeypatch, ties):
    """Every customer returns: each row is written once, and its ranks in all replicates are right over several ranges."""
    from patronage.plans import replicates
    written, write = [], replicates.materialize
    monkeypatch.setattr(replicates, "materialize", lambda df: (written.append(write(df)), written[-1])[1])
    monkeypatch.setattr(replicates, "RANGE", 700, raising=False)
    rng = np.random.default_rng(5)
    n, n_boot = 2000, 60
    y, p = (rng.choice([-2.0, -1.0, 1.0, 2.0], n), rng.integers(0, 6, n).astype(float)) if ties else (rng.normal(size=n), rng.normal(size=n))
    keys = [f"k{i:04d}" for i in range(n)] + [None]  # without key a row has no weight
    df = spark.createDataFrame([("m", k, float(y[i % n]), float(p[i % n])) for i, k in enumerate(keys)] +
                               [("none positive", keys[0], -1.0, 2.0)], "model string, key string, y double, p double")
    got = {r["replicate"]: r["spearman"] for r in bootstrap(df, n_boot, 2, 0.1).collect() if r["model"] == "m"}
    assert max(w.count() for w in written) < 2 * n + 3 * 6 * n_boot
    pdf = df.where("model = 'm' and key is not null").withColumns(key_hashes("key")).toPandas().sort_values("key")
    w = draws(pdf["__h1"].to_numpy(), pdf["__h2"].to_numpy(), n_boot, 2).astype(int)
    assert len(got) == n_boot
    for b in range(n_boot):
        at = np.repeat(np.arange(n), w[:, b])
        assert got[b + 1] == pytest.approx(np.corrcoef(pd.Series(y[at]).rank(), pd.Series(p[at]).rank())[0, 1], abs=1e-9)


def test_bgnbd_likelihood_catalyst_equals_numpy(spark):
    import numpy as np
    rows = [(0, 0.0, 30.0), (1, 10.0, 50.0), (4, 100.0, 300.0), (12, 250.0, 260.0)]
    df = spark.createDataFrame(rows, "frequency long, recency double, T double")
    th = (0.8, 10.0, 1.7, 2.5)
    got = [r[0] for r in df.select(bgnbd_loglik(*th)).collect()]
    x, tx, T = (np.array([r[i] for r in rows], dtype=float) for i in range(3))
    exp = bgnbd_terms(x, tx, T, *th)[0]
    assert np.allclose(got, exp, atol=1e-9)


def test_grouped_prefix_matches_window(spark):
    rnd = random.Random(11)
    rows = [(0 if rnd.random() < 0.6 else rnd.randint(1, 5), rnd.randint(0, 50), i, rnd.randint(0, 3)) for i in range(2000)]
    df = spark.createDataFrame(rows, "g long, o long, id long, x long")
    w = Window.partitionBy("g").orderBy("o", "id").rowsBetween(Window.unboundedPreceding, -1)
    exp = {r["id"]: r["c"] for r in df.withColumn("c", F.coalesce(F.sum("x").over(w), F.lit(0))).collect()}
    got = {r["id"]: r["c"] for r in grouped_prefix(df, ["g"], [F.col("o").asc(), F.col("id").asc()], {"c": "x"},
                                                   n_parts=7).collect()}
    assert got == exp


def test_group_quantiles_match_numpy(spark):
    import numpy as np
    from patronage.plans.ranking import group_quantiles
    rnd = random.Random(5)
    rows = [("a" if rnd.random() < 0.7 else "b", float(rnd.randint(0, 40))) for _ in range(999)]
    df = spark.createDataFrame(rows, "g string, v double")
    got = {(r["g"], r["p"]): r["quantile"] for r in group_quantiles(df, "g", "v", [0.25, 0.5, 0.99], n_parts=5).collect()}
    for g in ("a", "b"):
        vals = np.array([v for k, v in rows if k == g])
        for p in (0.25, 0.5, 0.99):
            assert abs(got[(g, p)] - np.percentile(vals, 100 * p)) < 1e-9


def test_rank_and_lag_with_aqe_coalesced_ranges(spark):
    old = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", "64")
    try:
        rnd = random.Random(9)
        rows = [(i, float(rnd.randint(0, 15)), rnd.randint(0, 3)) for i in range(1500)]
        df = spark.createDataFrame(rows, "k long, v double, g long")
        expected = {k: i + 1 for i, (k, v, g) in enumerate(sorted(rows, key=lambda r: (r[1], r[0])))}
        got = {x["k"]: x["r"] for x in global_rank(df, [F.col("v").asc(), F.col("k").asc()], "r").collect()}
        assert got == expected
        w = Window.partitionBy("g").orderBy("v", "k")
        exp = {r["k"]: r["p"] for r in df.withColumn("p", F.lag("v").over(w)).collect()}
        lag = {r["k"]: r["p"] for r in lag_within(df, "g", ["v", "k"], "v", "p").collect()}
        assert lag == exp
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", old)
