import os

import pytest

SF = "/root/testdata/sf0.001"


@pytest.mark.skipif(not os.path.isdir(SF), reason="driver test data not present")
def test_three_entry_points(spark):
    from patronage.config import TESTDATA_PARAMS
    from patronage.runs import run_analytics, run_etl, run_training
    from patronage.session import scratch_path
    from patronage.sources.testdata import canonical_tables

    etl = run_etl(spark, canonical_tables(spark, SF), TESTDATA_PARAMS, scratch_path(spark, "runs-test"))
    assert etl.published is True
    assert etl.report.count() == 31
    an = run_analytics(etl.transactions, etl.orders, TESTDATA_PARAMS, scratch_path(spark, "runs-analytics"))
    assert an["segment_summary"].count() == 10
    few = TESTDATA_PARAMS.with_(n_boot=20, n_boot_strategies=20)
    tr = run_training(etl.orders, few, max_rounds=10)
    assert {r["strategy"] for r in tr["strategies"].collect()} >= {"Boosted trees, Tweedie", "Historical-spend sort"}
    assert tr["export_scores"].count() == tr["scores"].count()
    assert tr["comparison"].count() == 5
    assert tr["channels"].count() == 5
