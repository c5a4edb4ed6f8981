from datetime import datetime

from pyspark.sql import functions as F

from patronage.config import TESTDATA_PARAMS
from patronage.operators import evaluate as EV
from patronage.operators.models import mean_spend_status
from patronage.operators.panel import build_panel, check_window_order

from helpers import orders_frame


def _scores(spark, ys, ps):
    rows = [("m", i, float(y), float(p)) for i, (y, p) in enumerate(zip(ys, ps))]
    return spark.createDataFrame(rows, "model string, key long, y double, p double")


def test_auc_edge_cases(spark):
    ys = [0, 0, 1, 1, 0, 5]
    assert EV.point_metrics(_scores(spark, ys, [1] * 6)).first()["auc"] == 0.5
    assert EV.point_metrics(_scores(spark, ys, ys)).first()["auc"] == 1.0
    assert EV.point_metrics(_scores(spark, ys, [-y for y in ys])).first()["auc"] == 0.0
    # hand-computed with ties: pos scores {2, 3, 3}, neg scores {1, 3, 4}
    ys2, ps2 = [1, 1, 1, 0, 0, 0], [2, 3, 3, 1, 3, 4]
    # pairs: (2: beats 1) = 1; (3: beats 1, ties 3) = 1.5 each → (1 + 1.5 + 1.5) / 9
    assert abs(EV.point_metrics(_scores(spark, ys2, ps2)).first()["auc"] - 4 / 9) < 1e-12


def test_top_k_floor_and_ties(spark):
    s = _scores(spark, [1, 2, 3], [5, 5, 5])
    r = EV.target_top(s, 0.1).first()
    assert r["n_targeted"] == 1 and r["revenue_in_group"] == 1.0   # k = 1, smallest key wins the tie


def test_validity_gate():
    assert [mean_spend_status(q)[0] for q in (None, 0.5, 1.0, 1.5)] == [False, False, False, True]
    assert "1.5000" in mean_spend_status(1.5)[1]


def test_window_order_guard():
    import pytest
    bad = TESTDATA_PARAMS.with_(train_origins=("2000-01-01",))
    with pytest.raises(ValueError):
        check_window_order(bad)
    check_window_order(TESTDATA_PARAMS)


def test_event_time_masking(spark):
    o = TESTDATA_PARAMS.test_origin
    org = datetime.fromisoformat(o)
    before, on, after = datetime(2000, 5, 1), org, datetime(2000, 6, 15)
    rows = [
        (1, 1, "2000-04-01 00:00:00", 10.0, {"order_delivered_customer_date": before, "delivery_days": 30.0,
                                             "review_creation_date": before}),
        (2, 2, "2000-04-01 00:00:00", 10.0, {"order_delivered_customer_date": on, "delivery_days": 61.0,
                                             "review_creation_date": on}),
        (3, 3, "2000-05-20 00:00:00", 10.0, {"order_delivered_customer_date": after, "delivery_days": 26.0,
                                             "review_creation_date": after}),
        (4, 4, "2000-05-20 00:00:00", 10.0),
    ]
    p = build_panel(orders_frame(spark, rows), TESTDATA_PARAMS).where(F.col("split") == "test")
    got = {r["customer_unique_id"]: (r["avg_delivery_days"], r["n_delivered"], r["avg_review"]) for r in p.collect()}
    assert got[1] == (30.0, 1, 5.0)
    assert got[2] == (None, 0, None)
    assert got[3] == (None, 0, None)
    assert got[4] == (None, 0, None)


def test_validation_origin_is_optional(spark):
    from patronage.operators.panel import origin_splits
    p = TESTDATA_PARAMS.with_(valid_origin=None)
    check_window_order(p)
    assert [s for s, _ in origin_splits(p)] == ["train"] * 4 + ["test"]
