"""Models (MOD1-MOD11): BG/NBD + Gamma-Gamma, Tweedie and L2 models, importances, what-if.

Probabilistic models: the per-customer summary is compressed to
``(x, t_x, T) → weight`` by a distributed groupBy and fitted in ``likelihood``,
one job a pass.
Boosted models are in ``boosting``; the linear companion is Spark ML's GLM.
"""

from __future__ import annotations

import math
from dataclasses import dataclass, field

from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.feature import Imputer, OneHotEncoder, StandardScaler, StringIndexer, VectorAssembler
from pyspark.ml.regression import GeneralizedLinearRegression
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from patronage.config import BGNBD_PENALIZER, CATEGORICAL_FEATURES, CUSTOMER_KEY, TWEEDIE_POWER
from patronage.functions.columns import safe_corr
from patronage.functions.special import hyp2f1, lgamma, rising_log_sum
from patronage.operators.boosting import BoostedModel, Settings, boost
from patronage.operators.likelihood import bgnbd_terms, fit, gamma_gamma_terms
from patronage.operators.panel import NUMERIC_FEATURES, lifetimes_summary, observed_aov
from patronage.plans.joins import with_one_row
from patronage.session import materialize, ship_package

# ---------------------------------------------------------------------------
# BG/NBD (Fader, Hardie & Lee 2005) and Gamma-Gamma (Fader & Hardie 2013)
# ---------------------------------------------------------------------------

def bgnbd_loglik(r: float, alpha: float, a: float, b: float) -> Column:
    """Per-row log-likelihood over columns frequency (x), recency (t_x), T."""
    x = F.col("frequency")
    tx, T = F.col("recency"), F.col("T")
    a1a2 = rising_log_sum(x, (r, 1), (b, 1), (a + b, -1)) + r * math.log(alpha)
    a3 = -(F.lit(r) + x) * F.log(F.lit(alpha) + T)
    a4 = math.log(a) - F.log(F.lit(b) + x - 1) - (F.lit(r) + x) * F.log(F.lit(alpha) + tx)
    m = F.greatest(a3, a4)
    lse = m + F.log(F.exp(a3 - m) + F.exp(a4 - m))
    return a1a2 + F.when(x > 0, lse).otherwise(a3)


def gamma_gamma_loglik(p: float, q: float, v: float) -> Column:
    x, m = F.col("frequency").cast("double"), F.col("monetary_value")
    px = x * p
    return (lgamma(px + q) - lgamma(px) - math.lgamma(q) + q * math.log(v) + (px - 1) * F.log(m)
            + px * F.log(x) - (px + q) * F.log(x * m + v))


def expected_counts(x, tx, T, params: dict, t: float):
    """MOD2 for arrays: E[# purchases in (T, T+t] | x, t_x, T] (closed form with ₂F₁)."""
    import numpy as np
    r, alpha, a, b = params["r"], params["alpha"], params["a"], params["b"]
    if abs(a - 1) < 1e-6:
        a = 1 + 1e-6
    hyp = hyp2f1(r + x, b + x, a + b - 1 + x, t / (alpha + T + t))
    grown = 1 - np.power((alpha + T) / (alpha + T + t), r + x) * hyp
    alive = np.where(x > 0, a / np.where(x > 0, b + x - 1, 1) * np.power((alpha + T) / (alpha + tx), r + x), 0)
    return (a + b - 1 + x) / (a - 1) * grown / (1 + alive)


def expected_purchases(summary: DataFrame, params: dict, t: float) -> DataFrame:
    """MOD2: the summary with ``expected_purchases``. The count depends on
    (frequency, recency, T) alone, so it is worked out once for each of their
    values and joined back."""
    ship_package(summary.sparkSession)
    keys = ["frequency", "recency", "T"]

    def part(batches):
        import numpy as np
        for pdf in batches:
            args = [pdf[k].to_numpy(dtype=np.float64) for k in keys]
            yield pdf.assign(expected_purchases=expected_counts(*args, params, t))
    values = summary.select(*keys).distinct()
    schema = T.StructType([*values.schema.fields, T.StructField("expected_purchases", T.DoubleType())])
    return summary.join(values.mapInPandas(part, schema), keys)


def mean_spend_status(q: float | None) -> tuple[bool, str]:
    """MOD4: whether the Gamma-Gamma mean p·v / (q − 1) exists, and a remark."""
    state = "unfitted" if q is None else "defined" if q > 1 else "undefined"
    remark = {"unfitted": "no Gamma-Gamma parameters", "defined": "mean spend defined", "undefined": "mean spend undefined"}
    return state == "defined", remark[state] + ("" if q is None else f": shape q = {q:.4f}, needed above 1")


@dataclass
class ProbabilisticFit:
    params: dict
    gg_fitted: bool
    gg_valid: bool
    note: str
    predictions: DataFrame          # per customer: expected purchases/value, both predictions
    diagnostics: DataFrame = field(default=None)

    def params_frame(self, spark) -> DataFrame:
        """SNK4: fitted parameters and standard errors as a one-row table."""
        names = ["r", "alpha", "a", "b", "gg_p", "gg_q", "gg_v"]
        keys = names + [f"{k}_se" for k in names]
        row = [float(self.params[k]) if math.isfinite(self.params.get(k, math.nan)) else None for k in keys]
        schema = ", ".join(f"{k} double" for k in keys) + ", gg_fitted boolean, gg_valid boolean, note string"
        return spark.createDataFrame([tuple(row) + (self.gg_fitted, self.gg_valid, self.note)], schema)


def gamma_gamma_assumption(summary: DataFrame) -> DataFrame:
    """AGG32: corr(frequency, monetary) on repeat customers, with the verdict."""
    sub = summary.where((F.col("frequency") > 0) & (F.col("monetary_value") > 0))
    one = sub.agg(F.count(F.lit(1)).alias("n"), safe_corr("frequency", "monetary_value").alias("r"))
    ar = F.abs(F.col("r"))
    return one.select("n", F.when(F.col("n") >= 30, F.col("r")).alias("corr"),
                      F.when(F.col("n") < 30, "untestable").when(ar < 0.1, "OK").when(ar > 0.3, "VIOLATED")
                      .otherwise("marginal").alias("verdict"))


def fit_bgnbd(summary: DataFrame, penalizer: float = BGNBD_PENALIZER) -> dict:
    """MOD1: r, α, a, b from (frequency, recency, T), and their standard errors (``r_se`` ...).

    Time is measured in units of the longest T while fitting, so that the
    penalty on α does not depend on the unit of the data; α is scaled back.
    """
    longest = summary.agg(F.max("T").alias("m")).first()["m"]
    unit = float(longest) if longest else 1.0
    comp = materialize(summary.groupBy("frequency", "recency", "T").agg(F.count(F.lit(1)).alias("w"))
                       .select("frequency", (F.col("recency") / unit).alias("recency"), (F.col("T") / unit).alias("T"), "w"))
    found = fit(comp, bgnbd_terms, ["frequency", "recency", "T"], "w", 4, penalizer)
    scale = {"r": 1.0, "alpha": unit, "a": 1.0, "b": 1.0}
    params = {k: float(v) * f for (k, f), v in zip(scale.items(), found.theta, strict=True)}
    return params | {f"{k}_se": float(v) * f for (k, f), v in zip(scale.items(), found.errors, strict=True)}


def mean_spend(p: float, q: float, v: float) -> Column:
    """The Gamma-Gamma model's expected value of a purchase."""
    x = F.col("frequency").cast("double")
    return F.lit(p) * (F.lit(v) + x * F.col("monetary_value")) / (F.lit(p) * x + q - 1)


def predictions(summary: DataFrame, orders: DataFrame, origin: str, params: dict, exp_value: Column,
                horizon_days: int) -> DataFrame:
    """MOD2, MOD5, JOI17: expected purchases and value per customer of the
    summary, and their product with the fitted and with the observed value
    (aligned by customer; missing → the mean)."""
    aov = observed_aov(orders, origin)
    mean_aov = summary.join(aov, CUSTOMER_KEY, "left").agg(F.avg("observed_aov").alias("__maov"))
    summary = expected_purchases(summary, params, float(horizon_days))
    return (with_one_row(summary.join(aov, CUSTOMER_KEY, "left"), mean_aov)
            .withColumn("expected_value", exp_value)
            .withColumn("pred_bgnbd", F.col("expected_purchases") * F.col("expected_value"))
            .withColumn("pred_bgnbd_empirical",
                        F.col("expected_purchases") * F.coalesce(F.col("observed_aov"), F.col("__maov")))
            .select(CUSTOMER_KEY, "frequency", "recency", "T", "monetary_value", "expected_purchases",
                    "expected_value", "pred_bgnbd", "pred_bgnbd_empirical"))


def diagnostics(pred: DataFrame, note: str) -> DataFrame:
    """MOD6 of predictions."""
    return pred.agg(
        F.count(F.lit(1)).alias("n_customers"),
        F.count_if(F.col("frequency") > 0).alias("n_frequency_gt0"),
        (F.lit(100.0) * F.count_if(F.col("frequency") > 0) / F.count(F.lit(1))).alias("pct_frequency_gt0"),
        F.min("expected_purchases").alias("expected_purchases_min"),
        F.max("expected_purchases").alias("expected_purchases_max"),
        F.min("expected_value").alias("expected_value_min"),
        F.count_if(F.col("expected_value") < 0).alias("n_negative_expected_value"),
        F.count_if(F.col("pred_bgnbd") < 0).alias("n_negative_predictions"),
    ).withColumn("gg_validity_note", F.lit(note))


def fit_probabilistic(orders: DataFrame, origin: str, horizon_days: int = 90,
                      penalizer: float = BGNBD_PENALIZER, min_repeat: int = 50) -> ProbabilisticFit:
    """MOD1-MOD6 at one origin."""
    summary = materialize(lifetimes_summary(orders, origin))
    params = fit_bgnbd(summary, penalizer)

    gg = summary.where((F.col("frequency") > 0) & (F.col("monetary_value") > 0))
    gg_comp = materialize(gg.groupBy("frequency", "monetary_value").agg(F.count(F.lit(1)).alias("w")))
    n_gg = gg_comp.agg(F.coalesce(F.sum("w"), F.lit(0)).alias("n")).first()["n"]
    gg_fitted = False
    if n_gg >= min_repeat:
        found = fit(gg_comp, gamma_gamma_terms, ["frequency", "monetary_value"], "w", 3, penalizer)
        p, q, v = (float(x) for x in found.theta)
        params.update({"gg_p": p, "gg_q": q, "gg_v": v})
        params.update({f"gg_{k}_se": float(e) for k, e in zip("pqv", found.errors, strict=True)})
        gg_fitted = True
        exp_value = mean_spend(p, q, v)
    else:
        mean_m = gg.agg(F.avg("monetary_value").alias("__mm"))
        summary = with_one_row(summary, mean_m)
        exp_value = F.col("__mm")
    valid, note = mean_spend_status(params.get("gg_q"))
    pred = predictions(summary, orders, origin, params, exp_value, horizon_days)
    diag = diagnostics(pred, note)
    return ProbabilisticFit(params, gg_fitted, valid, note, pred, diag)


# ---------------------------------------------------------------------------
# Regression models on the panel (Spark ML)
# ---------------------------------------------------------------------------

def _prep(panel: DataFrame) -> DataFrame:
    """Nulls become a missing indicator + a value; categoricals keep null as
    their own level via the indexer."""
    cols = {}
    for c in NUMERIC_FEATURES:
        cols[f"{c}__missing"] = F.col(c).isNull().cast("double")
        cols[c] = F.col(c).cast("double")
    return panel.withColumns(cols).fillna("__null__", subset=list(CATEGORICAL_FEATURES))


def feature_pipeline() -> list:
    """FEA8 for the GLM: levels learned on train (unseen → the 'keep' slot),
    medians imputed from train."""
    stages = [StringIndexer(inputCol=c, outputCol=f"{c}__idx", handleInvalid="keep") for c in CATEGORICAL_FEATURES]
    imputed = [f"{c}__imp" for c in NUMERIC_FEATURES]
    stages.append(Imputer(inputCols=list(NUMERIC_FEATURES), outputCols=imputed, strategy="median"))
    cat_cols = [f"{c}__oh" for c in CATEGORICAL_FEATURES]
    stages.append(OneHotEncoder(inputCols=[f"{c}__idx" for c in CATEGORICAL_FEATURES], outputCols=cat_cols,
                                handleInvalid="keep"))
    miss = [f"{c}__missing" for c in NUMERIC_FEATURES]
    stages.append(VectorAssembler(inputCols=imputed + miss + cat_cols, outputCol="features", handleInvalid="keep"))
    return stages


@dataclass
class ScaledModel:
    """A fitted pipeline whose label was divided by ``scale``; predictions are scaled back."""
    pipeline: object
    scale: float

    def transform(self, df: DataFrame, out: str = "prediction") -> DataFrame:
        return self.pipeline.transform(_prep(df)).withColumn(out, F.col("prediction") * self.scale)


def fit_tweedie_glm(train: DataFrame, power: float = TWEEDIE_POWER, reg: float = 1e-3, max_iter: int = 50):
    """A log-link Tweedie GLM on the stacked train panel, a linear companion of MOD7.

    Spark solves its normal equations on the driver, so it takes at most 4,096
    features after one-hot coding; the boosted models have no such bound.

    Fit on y / c (c = mean positive target) with standardised features: with a
    log link that only moves the intercept, and it keeps IRLS weights in range.
    """
    c = train.agg(F.avg(F.when(F.col("target") > 0, F.col("target")))).first()[0] or 1.0
    glm = GeneralizedLinearRegression(family="tweedie", variancePower=power, linkPower=0.0, labelCol="__y",
                                      featuresCol="scaled", predictionCol="prediction", maxIter=max_iter,
                                      regParam=reg)
    rows = _prep(train).withColumn("__y", F.col("target") / c)
    stages = feature_pipeline() + [StandardScaler(inputCol="features", outputCol="scaled", withMean=False)]
    prepared = Pipeline(stages=stages).fit(rows)
    # Each of the solver's passes reads its rows again: written features are coded once.
    fitted = glm.fit(materialize(prepared.transform(rows).select("scaled", "__y")))
    return ScaledModel(PipelineModel([*prepared.stages, fitted]), float(c))


def fit_boosted(train: DataFrame, valid: DataFrame | None, **settings) -> dict[str, BoostedModel]:
    """MOD7 (``tweedie``) and MOD8 (``squared``) on the panel, grown in the same passes."""
    losses = ("tweedie", "squared")
    made = boost(train, valid, [Settings(loss=x, **settings) for x in losses], list(NUMERIC_FEATURES),
                 list(CATEGORICAL_FEATURES), [CUSTOMER_KEY, "origin"])
    return dict(zip(losses, made, strict=True))


def feature_importances(spark, model: BoostedModel) -> DataFrame:
    """MOD9 / SRT5: gain with % share and number of splits, sorted descending."""
    df = spark.createDataFrame(model.importances(), "feature string, gain double, splits long")
    tot = df.agg(F.sum("gain").alias("__t"))
    return with_one_row(df, tot).withColumn("gain_pct", F.try_divide(F.lit(100.0) * F.col("gain"),
                                                                    F.nullif(F.col("__t"), F.lit(0.0)))) \
        .drop("__t").orderBy(F.desc("gain"), "feature")
