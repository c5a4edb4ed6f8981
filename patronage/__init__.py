"""patronage — Spark-native customer analytics.

Every operator is a ``DataFrame -> DataFrame`` function whose work runs as a
Spark plan: cleaning with a row ledger, order marts, KPIs, RFM segments,
cohorts, concentration, leakage-guarded panels, models, evaluation and ROI.
"""

from patronage.config import Params, TESTDATA_PARAMS

__all__ = ["Params", "TESTDATA_PARAMS"]
