"""Session construction and the shared scratch location."""

from __future__ import annotations

import os
import tempfile
import uuid
import zipfile
from pathlib import Path

from pyspark.sql import SparkSession

DEFAULT_CONF = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    "spark.ui.enabled": "false",
}


def get_session(master: str | None = None, shuffle_partitions: int | None = None,
                app_name: str = "patronage", extra: dict | None = None) -> SparkSession:
    """Build (or reuse) a session with the settings every operator assumes.

    On a cluster ``master`` stays ``None`` so spark-submit decides; tests pass
    ``local[*]``.
    """
    b = SparkSession.builder.appName(app_name)
    if master:
        b = b.master(master)
    conf = dict(DEFAULT_CONF)
    if shuffle_partitions:
        conf["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    conf.update(extra or {})
    for k, v in conf.items():
        b = b.config(k, v)
    spark = b.getOrCreate()
    spark.conf.set("spark.sql.session.timeZone", "UTC")
    return spark


def _is_local(spark: SparkSession) -> bool:
    """Driver and executors are one process, so a local folder is shared."""
    return spark.sparkContext.master.split("[")[0] == "local"


def checkpoint_dir(spark: SparkSession) -> str:
    """The shared folder for checkpoints and staged tables.

    Read from ``spark.checkpoint.dir`` (the cluster names it). Only a local
    master may leave it unset — as unit tests do — and gets a private folder; on
    a cluster executors would write to their own disks, so that is an error.
    """
    sc = spark.sparkContext
    current = sc.getCheckpointDir()
    if current:
        return current
    conf_dir = spark.conf.get("spark.checkpoint.dir", None)
    if not conf_dir:
        if not _is_local(spark):
            raise RuntimeError("set spark.checkpoint.dir to a folder that driver and executors share")
        conf_dir = tempfile.mkdtemp(prefix="patronage-ckpt-")
    sc.setCheckpointDir(conf_dir)
    return sc.getCheckpointDir() or conf_dir


def scratch_path(spark: SparkSession, name: str) -> str:
    """A sub-path of the shared folder, private to this application."""
    base = checkpoint_dir(spark).rstrip("/")
    return f"{base}/{name}-{spark.sparkContext.applicationId}"


def materialize(df):
    """Cut lineage by writing a parquet table in the shared checkpoint folder
    and reading it back.

    One computation of the plan (an eager ``checkpoint()`` of an unpersisted
    frame computes it twice: once for the count, once for the write). The
    written copy survives executor loss, and keeps the logical plan small where
    a frame is re-joined with itself (ranks, bootstrap, model inputs).
    """
    spark = df.sparkSession
    path = scratch_path(spark, f"table-{uuid.uuid4().hex}")
    df.write.mode("overwrite").parquet(path)
    return spark.read.schema(df.schema).parquet(path)


_SHIPPED: set[str] = set()


def ship_package(spark: SparkSession) -> None:
    """Send this package to the Python workers, once per application, so that
    functions run in them wherever the driver was started from."""
    app = spark.sparkContext.applicationId
    if app in _SHIPPED:
        return
    root = Path(__file__).resolve().parent
    path = os.path.join(tempfile.mkdtemp(prefix="patronage-code-"), f"{root.name}-code.zip")
    with zipfile.ZipFile(path, "w") as z:
        for f in sorted(root.rglob("*.py")):
            z.write(f, f.relative_to(root.parent))
    spark.sparkContext.addPyFile(path)
    _SHIPPED.add(app)
