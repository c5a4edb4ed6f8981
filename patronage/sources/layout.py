"""Marts laid out by key (SNK1, SRT1, SRC4): what groups or joins by the key reads them without an exchange.

The rows are exchanged once, when the table is written: one bucket a task,
sorted by the key and the columns after it. A bucket is read by one task, so the
layout is for keys of a measured size: where the largest key has more rows than
an average bucket (a customer with a third of all orders), the table is written
plain, and the exchange of the reader, which adds up in each task first, stays.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from patronage.session import materialize, scratch_path


def largest_share(df: DataFrame, key: str) -> float:
    """The share of the rows that the most frequent key has (null is a key); 0 for no rows."""
    sizes = df.groupBy(key).agg(F.count(F.lit(1)).alias("n"))
    return sizes.agg(F.coalesce(F.try_divide(F.max("n").cast("double"), F.sum("n")), F.lit(0.0))).first()[0]


def bucketed(df: DataFrame, key: str, after: list[str], buckets: int | None = None, path: str | None = None) -> DataFrame:
    """The rows as a table bucketed by ``key``, sorted by it and ``after``, or as a plain
    one where a key is too frequent for that. ``buckets`` is by default the session's
    number of shuffle partitions. No rows, nulls and repeated rows are kept as they are."""
    spark = df.sparkSession
    n = buckets or int(spark.conf.get("spark.sql.shuffle.partitions"))
    df = materialize(df)
    if largest_share(df, key) * n > 1:
        return df
    name = f"by_key_{uuid.uuid4().hex}"
    df.repartition(n, key).write.format("parquet").bucketBy(n, key).sortBy(key, *after) \
        .option("path", path or scratch_path(spark, name)).saveAsTable(name)
    return spark.table(name)
