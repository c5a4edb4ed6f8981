"""Small helpers shared by the corpus operators."""

from __future__ import annotations

from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession

from patronage.session import ship_package

#: White space between words: space, and tab to carriage return.
SPACE = r"[\x20\x09-\x0D]"
#: A word is a run of anything else.
WORD = r"[^\x20\x09-\x0D]+"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def batches_of(spark: SparkSession, rows: int = 500) -> None:
    """Make ready for Python workers: they get this package, and few rows at
    once (whole texts can be long: 10,000 rows would not bound their memory)."""
    ship_package(spark)
    key = "spark.sql.execution.arrow.maxRecordsPerBatch"
    if int(spark.conf.get(key, "10000")) > rows:
        spark.conf.set(key, str(rows))


@contextmanager
def rows_at_once(spark: SparkSession, rows: int) -> Iterator[None]:
    """For what is written inside, Python workers get so many rows at once; then the setting is as before."""
    key = "spark.sql.execution.arrow.maxRecordsPerBatch"
    before = spark.conf.get(key, "10000")
    spark.conf.set(key, str(min(rows, int(before))))
    try:
        yield
    finally:
        spark.conf.set(key, before)
