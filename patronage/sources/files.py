"""SRC1-SRC4: declared CSV scans, the named table set, table profiles, parquet scans."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from patronage.sources.specs import TABLES, TableSpec


def load_table(spark: SparkSession, spec: TableSpec, root: str, fmt: str = "csv") -> DataFrame:
    """SRC1: scan one table with its declared schema; a missing file fails fast."""
    path = f"{root.rstrip('/')}/{spec.filename}"
    if fmt == "csv":
        return (spark.read.schema(spec.schema)
                .option("header", True).option("multiLine", spec.line_breaks)
                .option("quote", '"').option("escape", '"')
                .option("mode", "FAILFAST")
                .option("timestampNTZFormat", "yyyy-MM-dd HH:mm:ss")
                .csv(path))
    return spark.read.schema(spec.schema).parquet(path)


def load_all(spark: SparkSession, root: str, fmt: str = "csv",
             register_views: bool = True) -> dict[str, DataFrame]:
    """SRC2: every spec, lazily; optionally registered as temp views."""
    out = {}
    for spec in TABLES:
        df = load_table(spark, spec, root, fmt)
        if register_views:
            df.createOrReplaceTempView(spec.name)
        out[spec.name] = df
    return out


def read_parquet(spark: SparkSession, path: str, columns: list[str] | None = None) -> DataFrame:
    """SRC4: parquet scan; selecting columns up front makes the pruning explicit."""
    df = spark.read.parquet(path)
    return df.select(*columns) if columns else df


#: Longer values are told apart by their SHA-256, so that a column of texts moves digests.
LONG_VALUE = 64
_PLAIN = (T.StringType, T.IntegralType, T.DecimalType, T.BooleanType, T.DateType, T.TimestampNTZType, T.TimestampType)


def _value_key(col: Column, kind: T.DataType) -> Column:
    """A text that is equal for equal values only; null for null."""
    if isinstance(kind, T.FractionalType) and not isinstance(kind, T.DecimalType):
        text = (col + F.lit(0.0).cast(kind)).cast("string")          # -0.0 is 0.0
    elif isinstance(kind, _PLAIN):
        text = col.cast("string")
    else:
        text = F.hex(col) if isinstance(kind, T.BinaryType) else F.to_json(col, {"ignoreNullFields": "false"})
    return F.when(F.length(text) > LONG_VALUE, F.sha2(text, 256)).otherwise(text)


def profile(tables: dict[str, DataFrame], primary_keys: dict[str, tuple[str, ...]] | None = None) -> DataFrame:
    """SRC3: one row per (table, column): type, rows, nulls, null %, distinct values,
    plus the table's duplicate primary-key count.

    A single scan and one exchange a table for all columns together: a row's values go
    out as (column, value) and are counted in each task before they move; the counts
    by column are a few rows. An empty table has its columns with zero rows.
    """
    primary_keys = primary_keys or {}
    parts = []
    for name, df in tables.items():
        fields = df.schema.fields
        pk = [k for k in primary_keys.get(name, ()) if k in df.columns]
        keys = [_value_key(F.col(f"`{f.name}`"), f.dataType) for f in fields]
        if pk:
            pk_type = T.StructType([df.schema[k] for k in pk])
            keys.append(_value_key(F.struct(*pk), pk_type))
        values = df.select(F.explode(F.array(*[F.struct(F.lit(i).alias("i"), k.alias("v"))
                                               for i, k in enumerate(keys)])).alias("c")).select("c.i", "c.v")
        counts = values.groupBy("i", "v").agg(F.count(F.lit(1)).alias("n")).groupBy("i").agg(
            F.sum("n").alias("rows"), F.sum(F.when(F.col("v").isNull(), F.col("n")).otherwise(0)).alias("nulls"),
            F.count("v").alias("distinct"))
        one = counts.agg(F.map_from_entries(F.collect_list(F.struct("i", F.struct("rows", "nulls", "distinct")))).alias("m"))
        of = lambda i, what: F.coalesce(F.try_element_at("m", F.lit(i))[what], F.lit(0).cast("long"))
        rows = [F.struct(F.lit(f.name).alias("column_name"), F.lit(f.dataType.simpleString()).alias("dtype"),
                         of(i, "nulls").alias("n_null"), of(i, "distinct").alias("n_distinct"))
                for i, f in enumerate(fields)]
        dup = of(0, "rows") - of(len(fields), "distinct") if pk else F.lit(None).cast("long")
        parts.append(
            one.select(F.lit(name).alias("table_name"), of(0, "rows").alias("n_rows"),
                       dup.alias("pk_duplicates"), F.explode(F.array(*rows)).alias("c"))
            .select("table_name", "c.column_name", "c.dtype", "n_rows", "c.n_null",
                    (F.lit(100.0) * F.col("c.n_null") / F.nullif(F.col("n_rows"), F.lit(0))).alias("null_pct"),
                    "c.n_distinct", "pk_duplicates"))
    return reduce(DataFrame.unionByName, parts)
