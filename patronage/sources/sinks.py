"""Sinks: partitioned marts with a staged publish, slim exports, meta table,
model bundle (SNK1-SNK4)."""

from __future__ import annotations

import time

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from patronage.config import CUSTOMER_KEY
from patronage.plans.joins import with_one_row

ORDER_COLS = ("order_id", CUSTOMER_KEY, "order_purchase_timestamp", "order_month", "order_revenue", "n_items",
              "review_score", "delivered_late", "delivery_days", "customer_state", "top_category", "payment_type")
RFM_COLS = (CUSTOMER_KEY, "segment", "R", "F", "M", "recency", "frequency", "monetary", "avg_order_value",
            "n_orders", "is_repeat", "customer_state", "top_category", "tenure", "avg_review")
CLV_COLS = (CUSTOMER_KEY, "actual_90d_spend", "pred_gbm", "pred_bgnbd", "pred_bgnbd_empirical", "recency",
            "frequency", "monetary", "tenure", "aov", "customer_state", "top_category")


KEYS = ("order_id", CUSTOMER_KEY)


def _fs(spark: SparkSession, path: str):
    jvm = spark.sparkContext._jvm
    hpath = jvm.org.apache.hadoop.fs.Path(path)
    return hpath.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), hpath


def write_mart(df: DataFrame, path: str, partition_by: str | None = "order_month",
               sort_within: list[str] | None = None, spread: int = 4) -> None:
    """SNK1: overwrite a parquet mart, partitioned (prunable) and sorted within files.

    Rows of a partition go to ``spread`` tasks at most (a large month is not one
    task's), and the sort begins with the partition column, so the writer keeps
    its order and each task writes one file a partition."""
    sort = [c for c in sort_within or [] if c in df.columns]
    out = df
    if partition_by:
        salt = F.pmod(F.xxhash64(*(sort or df.columns)), F.lit(spread))
        out = df.repartition(F.col(partition_by), salt)
        sort = [partition_by, *sort]
    if sort:
        out = out.sortWithinPartitions(*sort)
    w = out.write.mode("overwrite")
    (w.partitionBy(partition_by) if partition_by else w).parquet(path)


MARK = "_PUBLISHED"


def publish(spark: SparkSession, tables: dict[str, DataFrame], root: str, report: DataFrame | None = None) -> bool:
    """Write tables to a new version folder under ``root``; a marker file
    publishes it, only when the quality report (if given) has no FAIL. Earlier
    versions stay as they were until then, so readers never meet a half-written
    table."""
    version = f"{root.rstrip('/')}/v{time.time_ns():020d}"
    for name, df in tables.items():
        sort = [c for c in ("customer_unique_id", "order_purchase_timestamp") if c in df.columns]
        by_month = "order_month" in df.columns and "order_purchase_timestamp" in df.columns
        write_mart(df, f"{version}/{name}", "order_month" if by_month else None, sort)
    if report is not None and report.where(F.col("status") == "FAIL").limit(1).count() > 0:
        return False
    fs, mark = _fs(spark, f"{version}/{MARK}")
    fs.create(mark, False).close()
    return True


def publish_if_clean(spark: SparkSession, marts: dict[str, DataFrame], report: DataFrame, root: str) -> bool:
    """The marts, published unless the quality report has a FAIL."""
    return publish(spark, marts, root, report)


def published(spark: SparkSession, root: str, name: str) -> DataFrame:
    """A mart of the newest published version."""
    fs, base = _fs(spark, root)
    found = [str(s.getPath()) for s in fs.listStatus(base)]
    marked = [v for v in found if fs.exists(_fs(spark, f"{v}/{MARK}")[1])]
    if not marked:
        raise FileNotFoundError(f"nothing is published under {root}")
    return spark.read.parquet(f"{max(marked)}/{name}")


def shrink(df: DataFrame, columns: tuple[str, ...]) -> DataFrame:
    """SNK2: fixed column list; doubles → float, counts → int, keys as they are
    (parquet dictionary encoding handles the repeated strings). A listed column
    that the frame lacks is an error."""
    if missing := [c for c in columns if c not in df.columns]:
        raise ValueError(f"the export needs columns that are not there: {', '.join(missing)}")
    cols = []
    for c in columns:
        t = df.schema[c].dataType
        if c in KEYS:
            cols.append(F.col(c))
            continue
        if isinstance(t, T.DoubleType):
            cols.append(F.col(c).cast("float").alias(c))
        elif isinstance(t, T.LongType):
            cols.append(F.col(c).cast("int").alias(c))
        else:
            cols.append(F.col(c))
    return df.select(*cols)


def meta_table(orders: DataFrame, thresholds: DataFrame, snapshot: DataFrame) -> DataFrame:
    """SNK3: key/value text table (aov, cuts, snapshot, totals) built from
    one-row aggregates and unpivoted — nothing collected."""
    tot = orders.agg(F.sum("order_revenue").alias("rev"), F.count_distinct(CUSTOMER_KEY).alias("nc"),
                     F.count(F.lit(1)).alias("no"))
    one = with_one_row(with_one_row(thresholds, snapshot), tot)
    kv = [
        ("aov", F.format_string("%.6f", "aov")),
        ("monetary_cut_low", F.format_string("%.6f", "monetary_cut_low")),
        ("monetary_cut_high", F.format_string("%.6f", "monetary_cut_high")),
        ("recency_cuts", F.concat_ws(",", F.col("recency_cut_1").cast("string"), F.col("recency_cut_2").cast("string"),
                                     F.col("recency_cut_3").cast("string"))),
        ("snapshot_date", F.date_format("snapshot", "yyyy-MM-dd")),
        ("total_revenue", F.format_string("%.6f", "rev")),
        ("n_customers", F.col("nc").cast("string")),
        ("n_orders", F.col("no").cast("string")),
    ]
    rows = [F.struct(F.lit(k).alias("key"), v.alias("value")) for k, v in kv]
    return one.select(F.explode(F.array(*rows)).alias("r")).select("r.*")


def read_meta(meta: DataFrame) -> dict[str, str]:
    """SNK3 reader: the (tiny, fixed-size) meta table as a dict."""
    return {r["key"]: r["value"] for r in meta.collect()}


def contents(df: DataFrame, name: str) -> DataFrame:
    """(table_name, column_name, n_rows, n_values, checksum) of each column that
    holds a value: what a written table contains, whatever the order of its rows.
    The checksum adds numbers (also those written as text) and, for all else, the
    first 32 bits of the text's MD5."""
    def number(c: str) -> Column:
        text = F.col(f"`{c}`").cast("string")
        return F.coalesce(text.try_cast("double"), F.conv(F.substring(F.md5(text), 1, 8), 16, 10).cast("double"))
    one = df.agg(F.count(F.lit(1)).alias("n_rows"), F.array(*[
        F.struct(F.lit(c).alias("column_name"), F.count(F.col(f"`{c}`")).alias("n_values"), F.sum(number(c)).alias("checksum"))
        for c in df.columns]).alias("cols"))
    return one.select(F.lit(name).alias("table_name"), "n_rows", F.explode("cols").alias("c")) \
        .where("c.n_values > 0").select("table_name", "c.column_name", "n_rows", "c.n_values", "c.checksum")
