"""Parameters of the analytics, with the reference's defaults.

Fixed values below must equal the reference's for identical results:
business constants, cut points, rule names, channel costs.
"""

from __future__ import annotations

from dataclasses import dataclass, replace

# ---------------------------------------------------------------------------
# Fixed values (must match the reference)
# ---------------------------------------------------------------------------

CUSTOMER_KEY = "customer_unique_id"
REVENUE_ORDER_STATUSES = ("delivered",)
ANALYSIS_START = "2017-01-01"
ANALYSIS_END = "2018-08-31"
RECENCY_BINS_DAYS = (90, 180, 365)
FREQUENCY_BINS = (1, 2)
MONETARY_AOV_MULTIPLES = (1.0, 3.0)
REPURCHASE_DAYS = (30, 60, 90, 120, 180, 270, 365)
HORIZON_DAYS = 90
TRAIN_ORIGINS = ("2017-06-01", "2017-08-01", "2017-10-01", "2017-12-01")
VALID_ORIGIN = "2018-03-01"
TEST_ORIGIN = "2018-06-01"
TOP_FRACTION = 0.10
N_BOOT = 1000
N_BOOT_BANDS = 400
N_BOOT_STRATEGIES = 500
CATEGORICAL_FEATURES = ("top_category", "customer_state", "payment_type")

# Segment rules: (name, action text), in priority order; the last is the catch-all.
SEGMENTS = (
    ("Champions", "repeat buyer, bought recently, top-tier spend"),
    ("Loyal", "repeat buyer still within the active repurchase window"),
    ("Can't Lose", "high-value repeat buyer who has gone silent >1yr"),
    ("At Risk", "repeat buyer silent 180-365d — highest intervention value"),
    ("Big Spender (One-Off)", "single high-value purchase, still recent"),
    ("New", "first purchase within the last 90 days"),
    ("Promising", "single purchase 90-180d ago with above-average value"),
    ("Hibernating", "single purchase 180-365d ago"),
    ("Lost", "no purchase in over a year"),
    ("Needs Attention", "does not fit a cleaner rule"),
)

# Cost per contact by channel (R$), in the reference's order.
CHANNEL_COSTS = (
    ("Email (own list)", 0.02),
    ("Push notification", 0.05),
    ("SMS", 0.30),
    ("Paid social retargeting", 1.50),
    ("Direct mail", 4.00),
)
BREAKEVEN_UPLIFTS = (0.02, 0.05, 0.10, 0.20)
GRID_UPLIFTS = (0.05, 0.10, 0.20)

# Date-range presets of the dashboard (days back from the last order).
DATE_PRESETS = (("Last 3 months", 90), ("Last 6 months", 182), ("Last 12 months", 365))

# Boosting settings.
TWEEDIE_POWER = 1.5
LEARNING_RATE = 0.03
MIN_LEAF = 200
MAX_ROUNDS = 600
MAX_LEAVES = 31
LEAF_L2 = 1.0
SAMPLED_SHARE = 0.8
EARLY_STOPPING = 50
BGNBD_PENALIZER = 0.01


@dataclass(frozen=True)
class Params:
    """Every tunable knob, defaulting to the reference's values."""

    revenue_statuses: tuple[str, ...] = REVENUE_ORDER_STATUSES
    window_start: str = ANALYSIS_START
    window_end: str = ANALYSIS_END
    recency_cuts: tuple[int, ...] = RECENCY_BINS_DAYS
    frequency_cuts: tuple[int, ...] = FREQUENCY_BINS
    monetary_multiples: tuple[float, ...] = MONETARY_AOV_MULTIPLES
    horizon_days: int = HORIZON_DAYS
    train_origins: tuple[str, ...] = TRAIN_ORIGINS
    valid_origin: str | None = VALID_ORIGIN
    test_origin: str = TEST_ORIGIN
    top_fraction: float = TOP_FRACTION
    n_boot: int = N_BOOT
    n_boot_bands: int = N_BOOT_BANDS
    n_boot_strategies: int = N_BOOT_STRATEGIES
    seed: int = 0

    def with_(self, **kw) -> "Params":
        return replace(self, **kw)


# The driver's TPC-H-ish data spans 1995-2001; the reference window shifted
# by 18 years lands inside it (see FIXTURES.md §3).
TESTDATA_PARAMS = Params(
    revenue_statuses=("F",),
    window_start="1999-01-01",
    window_end="2000-08-31",
    train_origins=("1999-06-01", "1999-08-01", "1999-10-01", "1999-12-01"),
    valid_origin="2000-03-01",
    test_origin="2000-06-01",
)
