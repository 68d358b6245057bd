"""Session helpers: the runtime settings the plans rely on and a shared work folder."""

from __future__ import annotations

import re
import tempfile
import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

RUNTIME_CONF = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
}


def apply_runtime_conf(spark: SparkSession) -> SparkSession:
    """Set the runtime options the plans rely on; none needs a new session."""
    for name, value in RUNTIME_CONF.items():
        spark.conf.set(name, value)
    return spark


def shared_dir(spark: SparkSession) -> str:
    """The folder every executor can reach, from ``spark.checkpoint.dir``.

    Where the setting is missing (a local test session) a temporary folder is
    used; a cluster has to name a shared one.
    """
    root = spark.conf.get("spark.checkpoint.dir", None)
    if root:
        return root
    if not re.fullmatch(r"local(\[.*\])?", spark.sparkContext.master):
        raise ValueError("set spark.checkpoint.dir to a folder all executors can reach")
    root = tempfile.mkdtemp(prefix="letterloom-")
    spark.conf.set("spark.checkpoint.dir", root)
    return root


def work_path(spark: SparkSession, label: str) -> str:
    """A fresh path below the shared folder."""
    return f"{shared_dir(spark).rstrip('/')}/letterloom/{label}-{uuid.uuid4().hex}"


def ensure_checkpoint_dir(spark: SparkSession) -> None:
    """Make ``DataFrame.checkpoint`` usable without replacing a folder already set."""
    if spark.sparkContext.getCheckpointDir() is None:
        spark.sparkContext.setCheckpointDir(shared_dir(spark))


def forget(frame: DataFrame) -> None:
    """Remove the files of a checkpointed frame; neither it nor what is made from it can be read afterwards."""
    saved = frame._jdf.queryExecution().analyzed().rdd().getCheckpointFile()
    if saved.isDefined():
        context = frame.sparkSession.sparkContext
        path = context._jvm.org.apache.hadoop.fs.Path(saved.get())
        path.getFileSystem(context._jsc.hadoopConfiguration()).delete(path, True)


def stage(df: DataFrame, label: str, *counts: Column) -> DataFrame:
    """Count rows as they pass, and keep later filters above this point.

    Catalyst moves a filter below the projections under it and repeats their
    expressions there, Python functions included. It does not move one below
    observed metrics, so costly columns are evaluated once.
    """
    return df.observe(f"{label}-{uuid.uuid4().hex}", F.count(F.lit(1)).alias("rows"), *counts)
