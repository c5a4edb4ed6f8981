"""Probabilistic and boosted models on generated customers."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from patronage.config import CATEGORICAL_FEATURES
from patronage.operators import models as MD
from patronage.operators.panel import NUMERIC_FEATURES


def customers(n=6000, r=0.9, alpha=60.0, a=0.9, b=2.5, seed=1):
    """BG/NBD draws: purchase times until a drop-out, whole days."""
    rng = np.random.default_rng(seed)
    rows = []
    for i in range(n):
        lam, p, T, t, x, last = rng.gamma(r, 1 / alpha), rng.beta(a, b), float(rng.integers(200, 500)), 0.0, 0, 0.0
        while True:
            t += rng.exponential(1 / lam)
            if t > T:
                break
            x, last = x + 1, t
            if rng.random() < p:
                break
        rows.append((i, x, last, T))
    return rows


def test_bgnbd_parameters_are_recovered_in_any_unit(spark):
    days = spark.createDataFrame(customers(), "id long, frequency long, recency double, T double")
    fit = MD.fit_bgnbd(days, penalizer=0.0)
    assert fit["r"] == pytest.approx(0.9, rel=0.2) and fit["alpha"] == pytest.approx(60, rel=0.25)
    assert fit["a"] / (fit["a"] + fit["b"]) == pytest.approx(0.9 / 3.4, rel=0.2)
    a = MD.fit_bgnbd(days)
    weeks = MD.fit_bgnbd(days.withColumns({c: F.col(c) / 7 for c in ("recency", "T")}))
    assert weeks["alpha"] * 7 == pytest.approx(a["alpha"], rel=1e-4)
    for k in ("r", "a", "b"):
        assert weeks[k] == pytest.approx(a[k], rel=1e-4)


def test_expected_purchases_are_worked_out_once_for_equal_customers(spark):
    params = {"r": 0.7, "alpha": 300.0, "a": 0.3, "b": 1.2}
    rows = spark.createDataFrame([(i, i % 3, 10.0 * (i % 3), 100.0) for i in range(30)],
                                 "id long, frequency long, recency double, T double")
    got = {r["id"]: r["expected_purchases"] for r in MD.expected_purchases(rows, params, 90.0).collect()}
    assert len(got) == 30 and len({round(v, 12) for v in got.values()}) == 3
    # small steps of time add up: the derivative of the mean at 0 is the current rate if alive
    tiny = MD.expected_counts(np.array([2.0]), np.array([20.0]), np.array([100.0]), params, 1e-4)[0]
    assert 0 < tiny < 1e-4 * (0.7 + 2) / 400


def test_solver_passes_do_not_read_the_panel_again(spark):
    rng = np.random.default_rng(3)
    rows = [(i, float(rng.random()), f"c{rng.integers(4)}", float(rng.gamma(2.0)) if rng.random() < 0.7 else 0.0) for i in range(300)]
    cols = {f: F.lit(1.0) for f in NUMERIC_FEATURES} | {f: F.lit("same") for f in CATEGORICAL_FEATURES}
    train = spark.createDataFrame(rows, "customer_unique_id long, x double, c string, target double") \
        .withColumns(cols | {NUMERIC_FEATURES[0]: F.col("x"), CATEGORICAL_FEATURES[0]: F.col("c")}).drop("x", "c")

    def reads(passes):
        seen = spark.sparkContext.accumulator(0)

        def run(batches, total=seen):
            for b in batches:
                total.add(b.num_rows)
                yield b
        model = MD.fit_tweedie_glm(train.mapInArrow(run, train.schema), max_iter=passes)
        n = seen.value
        assert np.isfinite(model.transform(train).select("prediction").toPandas()["prediction"]).all()
        return n
    assert reads(1) == reads(5)
