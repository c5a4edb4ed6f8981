"""Column expressions shared by the operators.

All of them stay inside Catalyst (no Python UDF), so they codegen.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

__all__ = [
    "ntz", "days_between", "month_start", "month_index", "add_days",
    "safe_div", "pct", "first_by_time", "null_safe_gt", "cumulative_flags", "safe_corr",
]

MICROS_PER_DAY = 86_400_000_000.0


def ntz(value: str) -> Column:
    """A timezone-free timestamp literal (``'2017-01-01'`` → 2017-01-01 00:00)."""
    return F.lit(value).cast("timestamp_ntz")


def _c(x) -> Column:
    return F.col(x) if isinstance(x, str) else x


def _micro_of_day(ts: Column) -> Column:
    secs = F.date_part(F.lit("SECOND"), ts) * F.lit(1_000_000)          # decimal seconds incl. micros
    return (F.hour(ts).cast("long") * 3_600_000_000 + F.minute(ts).cast("long") * 60_000_000
            + secs.cast("long"))


def days_between(start, end) -> Column:
    """Elapsed days as a double (``end - start``), microsecond exact.

    Computed from calendar fields of the timezone-free timestamps (whole days
    by ``datediff`` plus microseconds of day), so the result does not depend
    on the session time zone (``timestamp_diff`` casts NTZ through it)."""
    a, b = _c(start), _c(end)
    micros = F.datediff(F.to_date(b), F.to_date(a)).cast("long") * 86_400_000_000 + (_micro_of_day(b) - _micro_of_day(a))
    return micros / F.lit(MICROS_PER_DAY)


def add_days(ts, n) -> Column:
    n = F.lit(n) if isinstance(n, int) else _c(n)
    return F.timestamp_add("DAY", n, _c(ts))


def month_start(ts) -> Column:
    """First day of the month, as a DATE (not ``date_trunc``: that yields LTZ)."""
    return F.trunc(_c(ts), "MM")


def month_index(later, earlier) -> Column:
    """Whole calendar months between two dates/timestamps."""
    a, b = _c(later), _c(earlier)
    return (F.year(a) - F.year(b)) * 12 + (F.month(a) - F.month(b))


def safe_div(a, b) -> Column:
    """a / b, null when b is 0 or null (pandas ``replace(0, nan)``)."""
    return F.try_divide(_c(a), F.nullif(_c(b), F.lit(0)))


def pct(part, whole) -> Column:
    return F.lit(100.0) * safe_div(part, whole)


def first_by_time(value, *order) -> Column:
    """Value of the earliest row by ``order`` among rows where value is set."""
    v = _c(value)
    return F.min_by(v, F.when(v.isNotNull(), F.struct(*[_c(o) for o in order])))


def null_safe_gt(a, b) -> Column:
    """``a > b`` where a null side counts as False (pandas comparison rule)."""
    return F.coalesce(_c(a) > _c(b), F.lit(False))


def cumulative_flags(conditions: list[Column]) -> Column:
    """Index (1-based) of the first failing condition, 0 when all hold.

    Each condition is a *keep* predicate; a null predicate counts as failing.
    Used by the ledger: step k's survivors are rows whose index is 0 or > k.
    """
    expr = F.lit(0)
    for i in reversed(range(len(conditions))):
        expr = F.when(~F.coalesce(conditions[i], F.lit(False)), F.lit(i + 1)).otherwise(expr)
    return expr


def safe_corr(a, b) -> Column:
    """Pearson correlation (aggregate), null when either side is constant.

    ``corr`` raises DIVIDE_BY_ZERO under ANSI mode for a constant column."""
    x, y = _c(a).cast("double"), _c(b).cast("double")
    return F.try_divide(F.covar_samp(x, y), F.stddev_samp(x) * F.stddev_samp(y))
