"""Cleaning with an audited row ledger (FIL1-FIL9, FIL12).

Each table is read once and written once cleaned. Exact duplicates collapse with
their multiplicity, then key duplicates (keep-first in an explicit total order per
key), then row predicates drop rows. Rows are written as they come, moved once, by
their key, in parts that fit a task's memory, and sorted there; what has keys too
frequent for one task is exchanged twice and partially aggregates map-side, so a hot key never lands whole
in one task. The counts of all these steps, and of nulls left in
required columns, are observed while the table is written: they ride on the
stage that writes, whose tasks count once however often they are tried. Marts,
ledger and checks read the written tables.
"""

from __future__ import annotations

from collections.abc import Callable
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass, field
from functools import reduce

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.window import Window

from patronage.config import Params
from patronage.functions.columns import add_days, ntz
from patronage.plans.joins import dimension_join, parts_of
from patronage.session import materialize
from patronage.sources.specs import TABLES_BY_NAME

#: Buckets of keys whose rows are counted to find those too frequent for one task.
BUCKETS = 1 << 16
#: Rows of a bucket that one task may have in any case.
FEW = 1 << 14

LEDGER_SCHEMA = "step_id int, table_name string, reason string, rows_before long, rows_after long"


@dataclass
class Ledger:
    """Counts of the cleaning steps, and of nulls left in each clean table's required columns."""

    rows: list[tuple[int, str, str, int, int]] = field(default_factory=list)
    nulls: dict[str, dict[str, int]] = field(default_factory=dict)

    def add(self, step_id: int, table: str, reason: str, before: int, after: int) -> None:
        self.rows.append((step_id, table, reason, before, after))

    def steps(self, base: int, table: str, counts: list[int], reasons: list[str], notes: int = 0) -> None:
        """Steps from each count to the next; the last ``notes`` are values that
        changed: their rows before are their rows after."""
        for i, reason in enumerate(reasons):
            note = i >= len(reasons) - notes
            self.add(base + i, table, reason, counts[i + 1] if note else counts[i], counts[i + 1])

    def frame(self) -> DataFrame:
        """FIL12: ``(step_id, table, reason, before, after, dropped, pct)``; pct 0 on empty input."""
        df = SparkSession.active().createDataFrame(sorted(self.rows), LEDGER_SCHEMA)
        return df.select(
            "*", (F.col("rows_before") - F.col("rows_after")).alias("dropped"),
            F.when(F.col("rows_before") > 0,
                   F.lit(100.0) * (F.col("rows_before") - F.col("rows_after")) / F.col("rows_before"))
             .otherwise(F.lit(0.0)).alias("pct"),
        )


def keep_first(df: DataFrame, key: list[str], order: list[str]) -> DataFrame:
    """FIL1+FIL2: one row per key — the first in the explicit total order
    (``order`` ascending, nulls first), which also removes exact duplicates.

    A partial aggregation (min of a struct), so duplicated hot keys are
    collapsed on the map side before the shuffle.
    """
    rest = [c for c in df.columns if c not in key]
    order_rest = order + [c for c in rest if c not in order]
    packed = F.struct(*[F.col(c).alias(f"_{i}") for i, c in enumerate(order_rest)])
    out = df.groupBy(*key).agg(F.min(packed).alias("__r"))
    return out.select(*key, *[F.col(f"__r._{i}").alias(c) for i, c in enumerate(order_rest)]).select(*df.columns)


def _holds(p: Column) -> Column:
    return F.coalesce(p, F.lit(False))


def observed(df: DataFrame, **metrics: Column) -> tuple[DataFrame, Callable[[], dict[str, int]]]:
    """The frame with aggregates of its rows, and what returns them once it has
    been written. To stand in the stage that writes, with no exchange above it: a
    task of an earlier stage that is run again would count twice."""
    seen = Observation()
    out = df.observe(seen, *[F.coalesce(m, F.lit(0)).alias(n) for n, m in metrics.items()])
    return out, lambda: {n: int(v) for n, v in seen.get.items()}


def _collapsed(raw: DataFrame, key: list[str] | None, order: list[str]) -> DataFrame:
    """One row per distinct row, or per key its first, with __n, the rows it
    stands for, and __d, the distinct ones among them.

    With a key the rows are exchanged once, by it, into parts of bounded size, and counted
    there in one sort. The buckets of keys that have more rows than two such parts are
    exchanged by all that a row holds and then by the key, with sums before each."""
    if not key:
        return _added_up(raw, key, order)
    raw = materialize(raw)
    n = raw.count()
    parts, code = parts_of(raw, n), F.pmod(F.xxhash64(*key), F.lit(BUCKETS))
    sizes = raw.groupBy(code.alias("code")).agg(F.count(F.lit(1)).alias("n"))
    large = [r["code"] for r in sizes.where(F.col("n") > max(2 * n // parts, FEW)).collect()]  # fewer than there are parts
    dealt = (raw.where(~code.isin(large)) if large else raw).repartition(parts, *key)
    out = _last_in_reverse(dealt, key, order)
    return out.unionByName(_added_up(raw.where(code.isin(large)), key, order)) if large else out


def _last_in_reverse(dealt: DataFrame, key: list[str], order: list[str]) -> DataFrame:
    """What ``_collapsed`` returns, for rows dealt out by the key: a key's rows are sorted from
    last to first, so that the first one's row number and dense rank are __n and __d. One
    sort and a scan, without an exchange; -0.0 is 0.0, as where rows are grouped."""
    flat = dealt.withColumns({f.name: F.col(f.name) + F.lit(0.0).cast(f.dataType) for f in dealt.schema.fields
                              if isinstance(f.dataType, (T.DoubleType, T.FloatType))})
    rest = order + [c for c in dealt.columns if c not in key and c not in order]
    w = Window.partitionBy(*key).orderBy(*[F.col(c).desc_nulls_last() for c in rest])
    numbered = flat.withColumns({"__n": F.row_number().over(w).cast("long"), "__d": F.dense_rank().over(w).cast("long"),
                                 "__later": F.lead(F.lit(1)).over(w)})
    return numbered.where(F.col("__later").isNull()).drop("__later")


def _added_up(raw: DataFrame, key: list[str] | None, order: list[str]) -> DataFrame:
    """What ``_collapsed`` returns: sums by what a row holds, then by its key. Both add
    up in each task first."""
    distinct = raw.groupBy(*raw.columns).agg(F.count(F.lit(1)).alias("__n"))
    if not key:
        return distinct.withColumn("__d", F.lit(1))
    rest = [c for c in raw.columns if c not in key]
    order_rest = order + [c for c in rest if c not in order]
    packed = F.struct(*[F.col(c).alias(f"_{i}") for i, c in enumerate(order_rest)])
    one = distinct.groupBy(*key).agg(F.min(packed).alias("__r"), F.sum("__n").alias("__n"), F.count(F.lit(1)).alias("__d"))
    return one.select(*key, *[F.col(f"__r._{i}").alias(c) for i, c in enumerate(order_rest)], "__n", "__d") \
        .select(*raw.columns, "__n", "__d")


def _written(step_base: int, table: str, raw: DataFrame, ledger: Ledger, key: list[str] | None = None,
             order: list[str] = (), preds: list[Column] = (), reasons: list[str] = (), key_reason: str | None = None,
             notes: list[Column] = (), note_reasons: list[str] = (), change: Callable[[DataFrame], DataFrame] = lambda d: d) -> DataFrame:
    """Generic cleaner: dedup (exact, then by key), predicates, notes, a change of
    values; written, with the ledger's steps and the nulls left observed on the way."""
    keeps, acc = [], F.lit(True)
    for p in preds:
        acc = acc & _holds(p)
        keeps.append(F.count_if(acc))
    counts = [F.sum("__n"), F.sum("__d"), *([F.count(F.lit(1))] if key else []), *keeps, *[F.count_if(acc & _holds(n)) for n in notes]]
    base, stepped = observed(_collapsed(raw, key, list(order)), **{f"c{i}": c for i, c in enumerate(counts)})
    kept = change(base.where(acc).drop("__n", "__d"))
    made, gaps = _with_nulls(table, kept)
    out = materialize(made)
    got = stepped()
    ledger.steps(step_base, table, [got[f"c{i}"] for i in range(len(counts))],
                 ["exact duplicate rows", *([key_reason] if key else []), *reasons, *note_reasons], len(notes))
    ledger.nulls[table] = gaps()
    return out


def _with_nulls(table: str, df: DataFrame) -> tuple[DataFrame, Callable[[], dict[str, int]]]:
    """The frame, with the nulls in the table's required columns observed."""
    required = [c for c in TABLES_BY_NAME[table].required if c in df.columns]
    out, got = observed(df, **{f"n{i}": F.count_if(F.col(c).isNull()) for i, c in enumerate(required)}) if required else (df, dict)
    return out, lambda: dict(zip(required, got().values(), strict=True))


# --- per-table cleaners ----------------------------------------------------

def clean_customers(df: DataFrame, ledger: Ledger) -> DataFrame:
    return _written(100, "customers", df, ledger,
                    preds=[F.col("customer_id").isNotNull() & F.col("customer_unique_id").isNotNull()],
                    reasons=["null customer_unique_id"])


def clean_orders(df: DataFrame, ledger: Ledger, params: Params) -> DataFrame:
    ts = F.col("order_purchase_timestamp")
    deliv = F.col("order_delivered_customer_date")
    statuses = list(params.revenue_statuses)
    preds = [
        F.col("order_status").isin(statuses),
        ts.isNotNull(),
        (ts >= ntz(params.window_start)) & (ts <= add_days(ntz(params.window_end), 1)),
        deliv.isNull() | (deliv >= ts),
    ]
    reasons = [f"status not in {statuses}", "null purchase timestamp",
               f"outside analysis window {params.window_start}..{params.window_end}",
               "delivered before purchased"]
    return _written(200, "orders", df, ledger, ["order_id"], [c for c in df.columns if c != "order_id"], preds, reasons,
                    "duplicate order_id")


def clean_order_items(df: DataFrame, ledger: Ledger) -> DataFrame:
    order = ["product_id", "seller_id", "shipping_limit_date", "price", "freight_value"]
    preds = [F.col("price").isNotNull() & F.col("product_id").isNotNull() & F.col("order_id").isNotNull(),
             F.col("price") > 0]
    # FIL8: clip negative freight to 0 and fill nulls with 0 (a value change, not a row change).
    return _written(300, "order_items", df, ledger, ["order_id", "order_item_id"], order, preds,
                    ["null price or product_id", "price <= 0"], "duplicate (order_id, order_item_id)",
                    [F.col("freight_value") < 0], ["negative freight clipped to 0"],
                    lambda d: d.withColumn("freight_value", F.greatest(F.coalesce("freight_value", F.lit(0.0)), F.lit(0.0))))


def clean_order_payments(df: DataFrame, ledger: Ledger) -> DataFrame:
    return _written(400, "order_payments", df, ledger, ["order_id", "payment_sequential"],
                    ["payment_type", "payment_installments", "payment_value"],
                    [F.col("payment_value").isNotNull()], ["null payment_value"], "duplicate (order_id, payment_sequential)")


def collapse_reviews(df: DataFrame) -> DataFrame:
    """AGG2: one row per order: mean score, count, latest creation date."""
    return df.groupBy("order_id").agg(
        F.avg("review_score").alias("review_score"),
        F.count(F.lit(1)).alias("n_reviews"),
        F.max("review_creation_date").alias("review_creation_date"))


def clean_order_reviews(df: DataFrame, ledger: Ledger) -> DataFrame:
    fine = _written(500, "order_reviews", df, ledger, preds=[F.col("review_score").isNotNull() & F.col("order_id").isNotNull()],
                    reasons=["null review_score"])
    before = ledger_after(ledger, 501)
    made, rows = observed(collapse_reviews(fine), rows=F.count(F.lit(1)))
    made, gaps = _with_nulls("order_reviews", made)
    out = materialize(made)
    ledger.add(502, "order_reviews", "collapsed to mean score per order", before, rows()["rows"])
    ledger.nulls["order_reviews"] = gaps()
    return out


def ledger_after(ledger: Ledger, step_id: int) -> int:
    """Rows after a step."""
    return next(r[4] for r in ledger.rows if r[0] == step_id)


def dedup_translation(df: DataFrame) -> DataFrame:
    """One English name per category (first = smallest English name)."""
    return keep_first(df, ["product_category_name"], ["product_category_name_english"])


def clean_products(df: DataFrame, ledger: Ledger, translation: DataFrame) -> DataFrame:
    """FIL9 + JOI7: null category → 'unknown'; English name when translated, else original."""
    filled = _written(600, "products", df, ledger, ["product_id"], [c for c in df.columns if c != "product_id"],
                      key_reason="duplicate product_id", notes=[F.col("product_category_name").isNull()],
                      note_reasons=["null category -> 'unknown'"],
                      change=lambda d: d.withColumn("product_category_name", F.coalesce("product_category_name", F.lit("unknown"))))
    joined = dimension_join(filled, dedup_translation(translation), "product_category_name", "left")
    joined, kept = observed(joined, none=F.count_if(F.col("product_category_name_english").isNull()))
    made = joined.withColumn(
        "product_category", F.coalesce(F.col("product_category_name_english"), F.col("product_category_name"))
    ).drop("product_category_name_english")
    made, gaps = _with_nulls("products", made)
    out = materialize(made)
    n = kept()["none"]
    ledger.add(650, "products", "no EN translation -> kept PT name", n, n)
    ledger.nulls["products"] = gaps()
    return out


def clean_sellers(df: DataFrame, ledger: Ledger) -> DataFrame:
    return _written(700, "sellers", df, ledger, ["seller_id"], [c for c in df.columns if c != "seller_id"],
                    key_reason="duplicate seller_id")


def clean_translation(df: DataFrame, ledger: Ledger) -> DataFrame:
    made, gaps = _with_nulls("category_translation", dedup_translation(df))
    out = materialize(made)
    ledger.nulls["category_translation"] = gaps()
    return out


def clean_all(raw: dict[str, DataFrame], params: Params, ledger: Ledger | None = None) -> tuple[dict[str, DataFrame], Ledger]:
    """Run every cleaner, several tables at a time. Geolocation is profiled only, never joined."""
    ledger = ledger or Ledger()
    work = {
        "orders": lambda: clean_orders(raw["orders"], ledger, params),
        "order_items": lambda: clean_order_items(raw["order_items"], ledger),
        "order_payments": lambda: clean_order_payments(raw["order_payments"], ledger),
        "order_reviews": lambda: clean_order_reviews(raw["order_reviews"], ledger),
        "customers": lambda: clean_customers(raw["customers"], ledger),
        "products": lambda: clean_products(raw["products"], ledger, raw["category_translation"]),
        "sellers": lambda: clean_sellers(raw["sellers"], ledger),
        "category_translation": lambda: clean_translation(raw["category_translation"], ledger),
    }
    with ThreadPoolExecutor(len(work)) as pool:
        made = {name: pool.submit(run) for name, run in work.items()}
    return {name: f.result() for name, f in made.items()}, ledger
