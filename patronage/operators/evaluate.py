"""Evaluation and ROI for a zero-heavy target (EVA1-EVA10, ROI1-ROI4, SRT4, RNK4).

Input is a long score frame ``(model, key, y, p)``: every model is evaluated
in the same grouped plan (the reference loops per model). Ranks come from
the two-pass global rank; AUC is the Mann-Whitney statistic on mid-ranks;
bootstrap CIs use hash-seeded Poisson(1) weights, all replicates summed in one
pass over the sorted rows (``plans/replicates.py``).
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from patronage.config import BREAKEVEN_UPLIFTS, CHANNEL_COSTS, GRID_UPLIFTS, TOP_FRACTION
from patronage.plans.joins import with_one_row
from patronage.plans.ranking import global_rank, grouped_prefix, rank_bin
from patronage.plans.replicates import bootstrap, replicate_sums
from patronage.session import materialize

KEY = "key"
#: Compared models and the score column of each; the strategies that target by score.
MODELS = {"Boosted trees, Tweedie": "pred_gbm", "Boosted trees, L2": "pred_gbt_l2", "BG/NBD + Gamma-Gamma": "pred_bgnbd",
          "BG/NBD x observed AOV": "pred_bgnbd_empirical", "Historical-spend sort": "monetary"}
STRATEGIES = ("Boosted trees, Tweedie", "BG/NBD x observed AOV", "Historical-spend sort")


def scores_long(df: DataFrame, key: str, y: str, preds: dict[str, str]) -> DataFrame:
    """Unpivot score columns into ``(model, key, y, p)``."""
    parts = None
    for name, col in preds.items():
        part = df.select(F.lit(name).alias("model"), F.col(key).alias(KEY), F.col(y).cast("double").alias("y"),
                         F.col(col).cast("double").alias("p"))
        parts = part if parts is None else parts.unionByName(part)
    return parts


def _with_model_ranks(scores: DataFrame, order, col: str) -> DataFrame:
    """Rank within model: a global rank over (model, order..., key) minus the model's offset."""
    ranked = global_rank(scores, [F.col("model").asc(), *order, F.col(KEY).asc()], "__g")
    first = ranked.groupBy("model").agg(F.min("__g").alias("__m0"))     # one row per model
    return ranked.join(F.broadcast(first), "model").withColumn(col, F.col("__g") - F.col("__m0") + 1) \
        .drop("__g", "__m0")


def _mid_ranks(counts: DataFrame, value: str) -> DataFrame:
    """Mid-ranks of distinct values with their number ``n``: the count below a
    value (``below``) plus half of its own and a half (``mid``)."""
    return grouped_prefix(counts, ["model"], [F.col(value).asc()], {"below": "n"}) \
        .withColumn("mid", F.col("below") + (F.col("n") + 1) / 2.0)


def _top_sums(values: DataFrame, scores: DataFrame, sizes: DataFrame, sums: dict[str, str]) -> DataFrame:
    """(model, k, sums...) of the k rows with the highest scores (ties by key).

    ``values`` has each distinct score with n, below and the sums of its rows:
    scores above the cut count whole; only the rows that share the score at the
    cut are ordered, by key."""
    v = values.join(F.broadcast(sizes.select("model", "size", "k")), "model") \
        .withColumn("above", F.col("size") - F.col("below") - F.col("n"))
    sure = v.groupBy("model").agg(F.max("k").alias("k"), *[
        F.sum(F.when(F.col("above") + F.col("n") <= F.col("k"), F.col(c)).otherwise(0)).alias(f"__s_{c}") for c in sums])
    cut = v.where("above < k and above + n > k").select("model", "p", (F.col("k") - F.col("above")).alias("__left"))  # a row a model
    tied = scores.join(F.broadcast(cut), ["model", "p"])
    nth = grouped_prefix(tied.withColumn("__1", F.lit(1)), ["model"], [F.col(KEY).asc()], {"__nth": "__1"})
    some = nth.where("__nth < __left").groupBy("model").agg(*[F.sum(F.expr(e)).alias(f"__t_{c}") for c, e in sums.items()])
    return sure.join(some, "model", "left").select("model", "k", *[
        (F.col(f"__s_{c}") + F.coalesce(f"__t_{c}", F.lit(0))).alias(c) for c in sums])


def point_metrics(scores: DataFrame, fraction: float = TOP_FRACTION) -> DataFrame:
    """EVA1-EVA4 per model: MAE, RMSE, totals, positives, AUC, Spearman,
    top-fraction capture and lift.

    Sorts distinct scores and distinct targets with their counts, once each. What
    a rank statistic needs of rows with the most frequent target (0) follows from
    the counts of a score; other rows are joined with both of their mid-ranks.
    """
    scores = materialize(scores.select("model", KEY, "y", "p"))
    other = F.col("y") != 0
    values = scores.groupBy("model", "p").agg(
        F.count(F.lit(1)).alias("n"), F.count_if(F.col("y") > 0).alias("pos"), F.count_if(other).alias("moved"), F.sum("y").alias("top"))
    values = materialize(_mid_ranks(values, "p"))
    targets = materialize(_mid_ranks(scores.groupBy("model", "y").agg(F.count(F.lit(1)).alias("n")), "y"))
    none = targets.where("y = 0").select("model", F.col("mid").alias("a0"))  # a row a model
    per = scores.groupBy("model").agg(
        F.count(F.lit(1)).alias("size"),
        F.avg(F.abs(F.col("p") - F.col("y"))).alias("mae"),
        F.sqrt(F.avg(F.pow(F.col("p") - F.col("y"), 2))).alias("rmse"),
        F.sum("p").alias("predicted_total"),
        F.sum("y").alias("actual_total"),
        F.count_if(F.col("y") > 0).alias("n_positives"))
    per = materialize(per.withColumn("k", F.greatest(F.floor(F.lit(fraction) * F.col("size")), F.lit(1))))
    middle = (F.col("size") + 1) / 2
    sizes = F.broadcast(per.select("model", "size"))  # a row a model

    def spread(d: DataFrame, out: str) -> DataFrame:
        return d.join(sizes, "model").groupBy("model").agg(F.sum(F.col("n") * F.pow(F.col("mid") - middle, 2)).alias(out))
    by_score = values.join(sizes, "model").groupBy("model").agg(
        F.sum(F.col("mid") * F.col("pos")).alias("rpos"),
        F.sum((F.col("mid") - middle) * (F.col("n") - F.col("moved"))).alias("b0"))
    moved = scores.where(other).join(values.select("model", "p", F.col("mid").alias("b")), ["model", "p"]) \
        .join(targets.select("model", "y", F.col("mid").alias("a")), ["model", "y"]).join(sizes, "model") \
        .groupBy("model").agg(F.sum((F.col("a") - middle) * (F.col("b") - middle)).alias("ab"))
    one = per.join(by_score, "model").join(spread(values, "vp"), "model").join(spread(targets, "vy"), "model") \
        .join(none, "model", "left").join(moved, "model", "left") \
        .join(_top_sums(values, scores, per, {"top": "y"}).drop("k"), "model")
    P = F.col("n_positives").cast("double")
    N = (F.col("size") - F.col("n_positives")).cast("double")
    auc = F.when((P > 0) & (N > 0), (F.col("rpos") - P * (P + 1) / 2) / (P * N))
    together = F.coalesce((F.col("a0") - middle) * F.col("b0"), F.lit(0.0)) + F.coalesce("ab", F.lit(0.0))
    cap = F.lit(100.0) * F.col("top") / F.greatest(F.col("actual_total"), F.lit(1e-9))
    return one.select("model", F.col("size").alias("n"), "mae", "rmse", "predicted_total", "actual_total", "n_positives",
                      auc.alias("auc"), F.try_divide(together, F.nullif(F.sqrt(F.col("vp") * F.col("vy")), F.lit(0.0))).alias("spearman"),
                      cap.alias("top_capture"), (cap / (100.0 * fraction)).alias("top_lift"))


def ci_verdicts(lo: str, hi: str, null_value: float, prefix: str) -> dict:
    """EVA6: beats (lo > null), loses (hi < null), verdict, width."""
    return {
        f"{prefix}_beats": F.col(lo) > null_value,
        f"{prefix}_loses": F.col(hi) < null_value,
        f"{prefix}_verdict": F.when(F.col(lo) > null_value, "yes").when(F.col(hi) < null_value, "WORSE").otherwise("no"),
        f"{prefix}_width": F.col(hi) - F.col(lo),
    }


def bootstrap_metrics(scores: DataFrame, n_boot: int = 1000, seed: int = 0,
                      fraction: float = TOP_FRACTION) -> DataFrame:
    """EVA5: per model and replicate, weighted AUC, Spearman and top capture.

    Replicates with one class only are dropped (as the reference skips them).
    The rows are sorted once; all replicates are summed together.
    """
    return bootstrap(scores, n_boot, seed, fraction)


def percentile_ci(boot: DataFrame, metrics=("auc", "spearman", "top_capture")) -> DataFrame:
    """2.5 / 97.5 % percentile interval per model (exact, linear interpolation)."""
    aggs = []
    for m in metrics:
        aggs.append(F.percentile(F.col(m), F.lit(0.025)).alias(f"{m}_lo"))
        aggs.append(F.percentile(F.col(m), F.lit(0.975)).alias(f"{m}_hi"))
    return boot.groupBy("model").agg(*aggs)


def model_comparison(scores: DataFrame, n_boot: int = 1000, seed: int = 0,
                     fraction: float = TOP_FRACTION) -> DataFrame:
    """EVA10: one row per model — MAE, RMSE, AUC/Spearman/top capture with CIs, lift, verdict."""
    pt = point_metrics(scores, fraction)
    ci = percentile_ci(bootstrap_metrics(scores, n_boot, seed, fraction))
    t = pt.join(ci, "model", "left")
    t = t.withColumns(ci_verdicts("auc_lo", "auc_hi", 0.5, "auc"))
    return t.select("model", "mae", "rmse", "auc", "auc_lo", "auc_hi", "spearman", "spearman_lo", "spearman_hi",
                    "top_capture", "top_capture_lo", "top_capture_hi", "top_lift",
                    F.col("auc_beats").alias("beats_random"), F.col("auc_verdict").alias("verdict_vs_random"),
                    "n_positives", "predicted_total", "actual_total")


def quantile_calibration(scores: DataFrame, n_bins: int = 5) -> DataFrame:
    """EVA7: bins by rank of the score (desc, key tie-break; Q1 = top) →
    customers, mean predicted/actual, total, returned, return rate, % revenue, ratio."""
    r = _with_model_ranks(scores, [F.col("p").desc()], "rank")
    n = r.groupBy("model").agg(F.count(F.lit(1)).alias("__n"))
    r = r.join(F.broadcast(n), "model").withColumn("bin", F.concat(F.lit("Q"), rank_bin("rank", "__n", n_bins)))
    out = r.groupBy("model", "bin").agg(
        F.count(F.lit(1)).alias("customers"), F.avg("p").alias("mean_predicted"), F.avg("y").alias("mean_actual"),
        F.sum("y").alias("total_actual"), F.count_if(F.col("y") > 0).alias("n_returned"))
    tot = out.groupBy("model").agg(F.sum("total_actual").alias("__tot"))
    out = out.join(F.broadcast(tot), "model")
    return out.select(
        "model", "bin", "customers", "mean_predicted", "mean_actual", "total_actual", "n_returned",
        (F.lit(100.0) * F.col("n_returned") / F.col("customers")).alias("return_rate"),
        (F.lit(100.0) * F.col("total_actual") / F.greatest(F.col("__tot"), F.lit(1e-9))).alias("pct_of_actual_revenue"),
        F.try_divide(F.col("mean_predicted"), F.nullif(F.col("mean_actual"), F.lit(0.0))).alias("calibration_ratio"))


def calibration_bands(scores: DataFrame, n_bins: int = 5, n_boot: int = 400, seed: int = 0) -> DataFrame:
    """EVA8: per bin, bootstrap 95 % bands of mean actual and return rate. Each
    task sums all replicates of a bin together: tasks x bins x replicates are shuffled."""
    r = _with_model_ranks(scores, [F.col("p").desc()], "rank")
    n = r.groupBy("model").agg(F.count(F.lit(1)).alias("__n"))
    r = r.join(F.broadcast(n), "model").withColumn("bin", F.concat(F.lit("Q"), rank_bin("rank", "__n", n_bins)))
    per = replicate_sums(r, ["model", "bin"], KEY, {"w": "1D", "wy": "y", "wpos": "if(y > 0, 1D, 0D)"}, n_boot, seed) \
        .where("w > 0").select("model", "bin", (F.col("wy") / F.col("w")).alias("m"),
                               (F.lit(100.0) * F.col("wpos") / F.col("w")).alias("rr"))
    return per.groupBy("model", "bin").agg(
        F.percentile("m", F.lit(0.025)).alias("actual_lo"), F.percentile("m", F.lit(0.975)).alias("actual_hi"),
        F.percentile("rr", F.lit(0.025)).alias("return_rate_lo"), F.percentile("rr", F.lit(0.975)).alias("return_rate_hi"))


def baseline_comparison(test: DataFrame, train: DataFrame, y: str = "target") -> DataFrame:
    """EVA9: MAE / RMSE of predicting zero and predicting the train mean."""
    mean = train.agg(F.avg(y).alias("__m"))
    t = with_one_row(test.select(F.col(y).cast("double").alias("y")), mean)
    one = t.agg(F.avg(F.abs(F.col("y"))).alias("mae0"), F.sqrt(F.avg(F.col("y") * F.col("y"))).alias("rmse0"),
                F.avg(F.abs(F.col("__m") - F.col("y"))).alias("mae1"),
                F.sqrt(F.avg(F.pow(F.col("__m") - F.col("y"), 2))).alias("rmse1"))
    rows = [F.struct(F.lit("predict zero").alias("baseline"), F.col("mae0").alias("MAE"), F.col("rmse0").alias("RMSE")),
            F.struct(F.lit("predict train mean").alias("baseline"), F.col("mae1").alias("MAE"),
                     F.col("rmse1").alias("RMSE"))]
    return one.select(F.explode(F.array(*rows)).alias("r")).select("r.*")


# --- ROI --------------------------------------------------------------------

def target_top(scores: DataFrame, fraction: float = TOP_FRACTION) -> DataFrame:
    """ROI1 + SRT4: per model, the top max(floor(n·f), 1) by score (ties: key
    asc). Distinct scores are sorted, and rows only where they tie at the cut."""
    scores = materialize(scores.select("model", KEY, "p", "y"))
    values = scores.groupBy("model", "p").agg(F.count(F.lit(1)).alias("n"), F.sum("y").alias("revenue_in_group"),
                                              F.count_if(F.col("y") > 0).alias("n_returners"))
    sizes = scores.groupBy("model").agg(F.count(F.lit(1)).alias("size"), F.sum("y").alias("revenue_total")) \
        .withColumn("k", F.greatest(F.floor(F.col("size") * fraction), F.lit(1)))
    sizes = materialize(sizes)
    top = _top_sums(materialize(_mid_ranks(values, "p")), scores, sizes,
                    {"revenue_in_group": "y", "n_returners": "cast(y > 0 as long)"})
    res = top.join(sizes.select("model", "revenue_total"), "model")
    cap = F.lit(100.0) * F.col("revenue_in_group") / F.greatest(F.col("revenue_total"), F.lit(1e-9))
    return res.select("model", F.lit(fraction).alias("fraction"), F.col("k").cast("long").alias("n_targeted"),
                      "revenue_in_group", "revenue_total", "n_returners", cap.alias("capture_pct"),
                      (cap / (100.0 * fraction)).alias("lift"))


def _channels_array():
    return F.array(*[F.struct(F.lit(n).alias("name"), F.lit(c).alias("cost")) for n, c in CHANNEL_COSTS])


def breakeven_table(targeting: DataFrame, uplifts=BREAKEVEN_UPLIFTS) -> DataFrame:
    """ROI2: break-even cost per contact by uplift, with the viable channels."""
    ups = F.array(*[F.struct(F.lit(u).alias("u"), F.lit(f"{100 * u:.0f}%").alias("label")) for u in uplifts])
    t = targeting.select("model", "revenue_in_group", "n_targeted", F.explode(ups).alias("x"))
    be = F.col("revenue_in_group") * F.col("x.u") / F.greatest(F.col("n_targeted"), F.lit(1))
    t = t.withColumn("breakeven_cost_per_contact", be)
    viable = F.array_join(F.transform(F.filter(_channels_array(), lambda c: c["cost"] <= F.col("breakeven_cost_per_contact")),
                                      lambda c: c["name"]), ", ")
    return t.select("model", F.col("x.label").alias("incremental_uplift"),
                    (F.col("revenue_in_group") * F.col("x.u")).alias("incremental_revenue"),
                    "breakeven_cost_per_contact",
                    F.when(viable == "", "NONE").otherwise(viable).alias("viable_channels"))


def channel_grid(targeting: DataFrame, uplifts=GRID_UPLIFTS) -> DataFrame:
    """ROI3: net R$ per channel × uplift (wide on the fixed uplift list) and a verdict."""
    t = targeting.select("model", "revenue_in_group", "n_targeted", F.explode(_channels_array()).alias("c"))
    cols = {f"net_at_{100 * u:.0f}pct": F.col("revenue_in_group") * u - F.col("n_targeted") * F.col("c.cost")
            for u in uplifts}
    out = t.select("model", F.col("c.name").alias("channel"), F.col("c.cost").alias("cost_per_contact"),
                   (F.col("n_targeted") * F.col("c.cost")).alias("campaign_cost"),
                   *[v.alias(k) for k, v in cols.items()])
    mid = f"net_at_{100 * uplifts[len(uplifts) // 2]:.0f}pct"
    return out.withColumn("verdict", F.when(F.col(mid) > 0, "profitable").otherwise("net-negative"))


def compare_strategies(scores: DataFrame, fraction: float = TOP_FRACTION, n_boot: int = 500,
                       seed: int = 0) -> DataFrame:
    """ROI4: captured revenue per strategy with a bootstrap CI, plus the
    closed-form random-targeting row."""
    pt = target_top(scores, fraction)
    boot = bootstrap(scores, n_boot, seed, fraction, ranks=False)
    ci = boot.groupBy("model").agg(F.percentile("top_capture", F.lit(0.025)).alias("capture_lo"),
                                   F.percentile("top_capture", F.lit(0.975)).alias("capture_hi"))
    s = pt.join(ci, "model", "left").select(
        F.col("model").alias("strategy"), F.col("n_targeted").alias("customers_targeted"),
        F.col("n_returners").alias("returners_reached"), F.col("revenue_in_group").alias("revenue_captured"),
        "capture_pct", "capture_lo", "capture_hi", "lift")
    # Every strategy scores the same customers; take the counts of the first
    # strategy by name (a global aggregate, deterministic).
    per_model = scores.groupBy("model").agg(F.count(F.lit(1)).alias("n"), F.count_if(F.col("y") > 0).alias("pos"),
                                            F.sum("y").alias("tot"))
    one_model = per_model.agg(F.min_by(F.struct("n", "pos", "tot"), F.col("model")).alias("s")).select("s.*")
    rnd = one_model.select(
        F.lit("Random targeting").alias("strategy"), F.floor(F.col("n") * fraction).cast("long").alias("customers_targeted"),
        F.round(F.col("pos") * fraction).cast("long").alias("returners_reached"),
        (F.col("tot") * fraction).alias("revenue_captured"), F.lit(100.0 * fraction).alias("capture_pct"),
        F.lit(None).cast("double").alias("capture_lo"), F.lit(None).cast("double").alias("capture_hi"),
        F.lit(1.0).alias("lift"))
    return s.unionByName(rnd)


def score_percentile(scores: DataFrame, probes: DataFrame) -> DataFrame:
    """RNK4: for each probe ``(probe_id, value)``, % of scores strictly below it.

    The distinct values of scores and probes are sorted with the number of
    scores at each (none for a probe's own value); running sums give the scores
    below. Ties take one row, whatever their number.
    """
    pr = probes.select(F.col("probe_id").cast("string").alias("probe_id"), F.col("value").cast("double").alias("v"))
    counts = scores.select(F.col("p").cast("double").alias("v"), F.lit(1).alias("c")) \
        .unionByName(pr.select("v", F.lit(0).alias("c"))).groupBy("v").agg(F.sum("c").alias("c")) \
        .withColumn("__all", F.lit(0))
    below = grouped_prefix(counts, ["__all"], [F.col("v").asc()], {"__below": "c"}).select("v", "__below")
    n = scores.agg(F.count(F.lit(1)).alias("__n"))
    return with_one_row(pr.join(below, "v"), n).select(
        "probe_id", F.col("v").alias("value"), F.col("__below").alias("scores_below"),
        (F.lit(100.0) * F.col("__below") / F.col("__n")).alias("percentile"))
