"""Where the outputs of micro-batches are stored, and which batches count.

A micro-batch may run again after a failure.  Each batch therefore owns a ``batch_id`` folder in every
output and replaces it as a whole, also by nothing.  An observation counts the rows as they are written.  Once all outputs of a batch are written, the log
of batches says so: readers that ask it see all outputs of a batch or none.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from postsieve.sources.snapshots import Snapshots


def _replace(rows: DataFrame, path: str, batch_id: int, seen: Observation | None = None) -> None:
    if seen is not None:
        # On top of the plan: below a shuffle that turns out empty, nothing would be observed.
        rows = rows.observe(seen, F.count(F.lit(1)).alias("rows"))
    rows.write.mode("overwrite").parquet(f"{path.rstrip('/')}/batch_id={batch_id}")


def write_matches(matches: DataFrame, path: str, batch_id: int | None = None, seen: Observation | None = None) -> None:
    """Parquet in a folder of the batch and sorted by feed, or without a batch partitioned by feed.

    A batch comes every half minute and may hold thousands of feeds; folders for each would be
    millions of small files a day, while sorted files are pruned by their statistics.  Rebalancing
    by feed lets the adaptive planner split the rows of a large feed over several files.
    """
    rows = matches.hint("rebalance", "algorithm_id")
    if batch_id is None:
        rows.write.partitionBy("algorithm_id").mode("append").parquet(path)
    else:
        _replace(rows.sortWithinPartitions("algorithm_id"), path, batch_id, seen)


def write_deletes(deletes: DataFrame, path: str, batch_id: int | None = None, seen: Observation | None = None) -> None:
    log = deletes.select("did", "collection", "rkey", "time_us")
    if batch_id is None:
        log.write.mode("append").parquet(path)
    else:
        _replace(log, path, batch_id, seen)


def write_rejects(rejects: DataFrame, path: str, batch_id: int, seen: Observation | None = None) -> None:
    """``raw`` messages as they came, with the ``reason``."""
    _replace(rejects.select("raw", "reason"), path, batch_id, seen)


def write_responses(responses: DataFrame, path: str, batch_id: int, seen: Observation | None = None) -> None:
    """One row per feed in one file per batch."""
    _replace(responses.coalesce(1), path, batch_id, seen)


def write_metrics(metrics: DataFrame, path: str, batch_id: int) -> None:
    """One row per batch."""
    _replace(metrics.coalesce(1), path, batch_id)


def read_batch(spark: SparkSession, path: str, batch_id: int) -> DataFrame:
    """``algorithm_id`` and ``uri`` of the matches stored for a batch; no other batch is listed."""
    return spark.read.schema("uri string, algorithm_id long").parquet(f"{path.rstrip('/')}/batch_id={batch_id}")


class CommittedBatches:
    """The log of batches below ``path``: batches run one after the other, so an entry is the last one.

    An entry also names the query, which is the same as long as its checkpoint is.  A job that starts
    from an empty checkpoint writes its batches from 0 on again, and only those count from then on.
    """

    def __init__(self, spark: SparkSession, path: str):
        self.table = Snapshots(spark, path)

    def holds(self, query: str | None, batch_id: int) -> bool:
        """Whether the query has stored all outputs of the batch."""
        _, entry = self.table.latest()
        return query is not None and entry.get("query") == query and batch_id <= entry["batch"]

    def add(self, query: str | None, batch_id: int) -> None:
        self.table.change(lambda entry: {"query": query, "batch": batch_id})
        self.table.clean(lambda entry: [])

    def read(self, path: str) -> DataFrame:
        """The rows of an output whose batches are stored whole; the batch is a partition column."""
        _, entry = self.table.latest()
        rows = self.table.spark.read.option("basePath", path).parquet(path)
        return rows.where(F.col("batch_id") <= entry.get("batch", -1))
