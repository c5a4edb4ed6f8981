import itertools

from pyspark.sql import functions as F

from patronage.config import SEGMENTS
from patronage.operators import cohorts as CO
from patronage.operators import metrics as ME
from patronage.operators import rfm as RF

from helpers import orders_frame


def _expected_segment(R, Fq, M):
    rep = Fq >= 2
    if rep and R == 4 and M == 3:
        return "Champions"
    if rep and R >= 3:
        return "Loyal"
    if rep and R == 1 and M == 3:
        return "Can't Lose"
    if rep and R <= 2:
        return "At Risk"
    if not rep and R == 4 and M == 3:
        return "Big Spender (One-Off)"
    if not rep and R == 4:
        return "New"
    if not rep and R == 3 and M >= 2:
        return "Promising"
    if not rep and R >= 2:
        return "Hibernating"
    if not rep and R == 1:
        return "Lost"
    return "Needs Attention"


def test_all_36_score_combinations(spark):
    rows = list(itertools.product([1, 2, 3, 4], [1, 2, 3], [1, 2, 3]))
    df = spark.createDataFrame(rows, "R int, F int, M int")
    got = {(r["R"], r["F"], r["M"]): r["segment"] for r in RF.assign_segments(df).collect()}
    for k, v in got.items():
        assert v == _expected_segment(*k)
    assert "Needs Attention" not in got.values()


def test_score_cut_points_exact(spark):
    rfm = spark.createDataFrame(
        [(1, 90.0, 1, 100.0), (2, 180.0, 2, 300.0), (3, 365.0, 3, 99.999), (4, 365.0001, 1, 0.0)],
        "customer_unique_id int, recency double, frequency int, monetary double")
    th = spark.createDataFrame([(100.0, 100.0, 300.0, 90, 180, 365)],
                               "aov double, monetary_cut_low double, monetary_cut_high double, recency_cut_1 int, "
                               "recency_cut_2 int, recency_cut_3 int")
    got = {r[0]: (r["R"], r["F"], r["M"], r["rfm_score"]) for r in RF.score_rfm(rfm, th).collect()}
    assert got[1] == (4, 1, 2, "412")
    assert got[2] == (3, 2, 3, "323")
    assert got[3] == (2, 3, 1, "231")
    assert got[4][0] == 1


def test_frequency_counts_days_and_genuine_gaps(spark):
    o = orders_frame(spark, [
        (1, 1, "2020-01-01 23:00:00", 10.0), (2, 1, "2020-01-02 01:00:00", 10.0),
        (3, 2, "2020-01-01 10:00:00", 5.0), (4, 2, "2020-01-02 10:00:00", 5.0),
        (5, 3, "2020-01-01 10:00:00", 1.0), (6, 3, "2020-01-01 10:00:00", 1.0)])
    rfm = {r["customer_unique_id"]: r for r in RF.build_rfm(o).collect()}
    assert rfm[1]["frequency"] == 2 and rfm[1]["n_orders"] == 2
    assert rfm[3]["frequency"] == 1 and rfm[3]["split_basket"]
    curve = {r["within_days"]: r for r in RF.repurchase_curve(o, (1, 30)).collect()}
    # gaps: 2/24 day (not genuine), 1.0 day (genuine), 0 (not genuine)
    assert abs(curve[1]["pct_all_gaps"] - 100.0) < 1e-9
    assert abs(curve[1]["pct_genuine_repurchases"] - 100.0) < 1e-9


def test_empty_segments_kept_and_shares_sum(spark):
    o = orders_frame(spark, [(1, 1, "2020-01-01 00:00:00", 10.0), (2, 2, "2020-06-01 00:00:00", 30.0),
                             (3, 2, "2020-06-20 00:00:00", 30.0)])
    seg, summ, _ = RF.run_rfm(o)
    rows = summ.collect()
    assert len(rows) == len(SEGMENTS)
    assert abs(sum(r["pct_customers"] for r in rows) - 100.0) < 1e-9
    assert abs(sum(r["pct_revenue"] for r in rows) - 100.0) < 1e-9
    assert sum(r["customers"] for r in rows) == seg.count()


def test_headline_metrics_empty_is_zero(spark):
    o = orders_frame(spark, [(1, 1, "2020-01-01 00:00:00", 10.0)]).where(F.lit(False))
    r = ME.headline_metrics(o).first().asDict()
    assert all(v == 0 for v in r.values())


def test_null_state_dropped_from_breakdown(spark):
    o = orders_frame(spark, [(1, 1, "2020-01-01 00:00:00", 10.0, {"customer_state": None}),
                             (2, 2, "2020-01-01 00:00:00", 10.0)])
    states = [r["customer_state"] for r in ME.state_breakdown(o).collect()]
    assert states == ["S"]


def test_cohort_traps(spark):
    o = orders_frame(spark, [
        (1, 1, "2020-01-05 00:00:00", 10.0), (2, 1, "2020-01-20 00:00:00", 10.0),   # repeat in month 0
        (3, 1, "2020-03-05 00:00:00", 10.0),                                       # month 2 (month 1 empty)
        (4, 2, "2020-04-01 00:00:00", 10.0)])                                      # young cohort
    ret = {(str(r["cohort_month"]), r["month_index"]) for r in CO.retention_matrix(o).collect()}
    assert ("2020-01-01", 1) not in ret and ("2020-01-01", 2) in ret
    cum = {(str(r["cohort_month"]), r["month_index"]): r["pct"] for r in CO.cumulative_repeat_matrix(o).collect()}
    assert cum[("2020-01-01", 2)] == 100.0 and 0 not in {k[1] for k in cum}
    summ = {str(r["cohort_month"]): r for r in CO.cohort_summary(o).collect()}
    assert summ["2020-04-01"]["repeat_by_m3"] is None
