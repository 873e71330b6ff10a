"""Session settings the engine is designed for, and small helpers which need the live session."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

SETTINGS = {
    "spark.sql.session.timeZone": "UTC",
    # Re-plan at run time: split skewed join partitions, merge small ones, switch to broadcast
    # when a side turns out to be small.
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    # A method over 8000 bytes of bytecode is never JIT-compiled; plans with hundreds of feeds run
    # faster as split projections than as one such method.
    "spark.sql.codegen.hugeMethodLimit": "8000",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    # Recording the Python call site of every column costs more than building the column, which
    # shows once a plan holds thousands of conditions.
    "spark.python.sql.dataFrameDebugging.enabled": "false",
}


def configure(builder: SparkSession.Builder) -> SparkSession.Builder:
    for key, value in SETTINGS.items():
        builder = builder.config(key, value)
    return builder


def _own_folder(spark: SparkSession) -> str:
    """A local folder where driver and executors are one process; a cluster must name a shared one."""
    master = spark.sparkContext.master
    if not (master == "local" or master.startswith("local[")):
        raise ValueError("Set spark.checkpoint.dir to a folder that all executors share.")
    return tempfile.mkdtemp(prefix="postsieve-")


def checkpoint(df: DataFrame) -> DataFrame:
    """Cut the lineage of ``df`` in the reliable folder the cluster names.

    ``spark.checkpoint.dir`` decides where; only without a cluster (tests) a folder is made here.
    """
    context = df.sparkSession.sparkContext
    if context.getCheckpointDir() is None:
        named = df.sparkSession.conf.get("spark.checkpoint.dir", None)
        context.setCheckpointDir(named or _own_folder(df.sparkSession))
    return df.checkpoint(eager=True)


_checked: set[str] = set()


def check_pattern(java_pattern: str) -> str:
    """Raise ``ValueError`` while the plan is built if Java rejects the pattern.

    A pattern which fails at run time would fail every feed that shares the pass.
    """
    if java_pattern in _checked:
        return java_pattern
    spark = SparkSession.getActiveSession()
    if spark is not None:
        try:
            spark.sparkContext._jvm.java.util.regex.Pattern.compile(java_pattern)
        except Exception as error:
            raise ValueError(f"Invalid regular expression: {java_pattern}") from error
        _checked.add(java_pattern)
    return java_pattern


def shared_folder(spark: SparkSession, purpose: str) -> str:
    """A fresh folder every executor can reach, for results one query hands to the next.

    It lies below ``spark.checkpoint.dir``; only without a cluster (tests) is it a local one.
    """
    base = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if base is None:
        base = _own_folder(spark)
    return f"{base.rstrip('/')}/{purpose}-{uuid.uuid4().hex}"
