"""Match counts and responses per feed."""

from __future__ import annotations

from collections.abc import Iterable

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_schema

from postsieve.plans.match import Feed

ERROR_TYPE = T.StructType(
    [
        T.StructField("error_type", T.StringType()),
        T.StructField("error_message", T.StringType()),
        T.StructField("error_stack_trace", T.ArrayType(T.StringType())),
        T.StructField("algorithm_id", T.LongType()),
    ]
)
FEED_TYPE = T.StructType(
    [
        T.StructField("algorithm_id", T.LongType()),
        T.StructField("compute_environment", T.StringType()),
        T.StructField("error", ERROR_TYPE),
    ]
)


def match_counts(matched: DataFrame) -> DataFrame:
    """Matches per feed."""
    return matched.groupBy("algorithm_id").agg(F.count(F.lit(1)).alias("matches"))


def window_counts(events: DataFrame, time: Column, width: str) -> DataFrame:
    """Records per time window."""
    return events.groupBy(F.window(time, width).alias("w")).agg(F.count(F.lit(1)).alias("records")).select(
        F.col("w.start").alias("window_start"), "records"
    )


def feed_table(spark: SparkSession, feeds: Iterable[Feed]) -> DataFrame:
    """Feeds as a local relation: as many rows as there are compiled feeds."""
    rows = [
        {"algorithm_id": f.algorithm_id, "compute_environment": f.environment, "error": f.error} for f in feeds
    ]
    return spark.createDataFrame(pa.Table.from_pylist(rows, schema=to_arrow_schema(FEED_TYPE)))


def responses(
    matches: DataFrame,
    feeds: DataFrame,
    batch: str = "batch_no",
    compute_time: Column | None = None,
) -> DataFrame:
    """One row per batch and feed with its ``matches``; a feed without any match has one empty row.

    ``matches`` holds ``algorithm_id``, the batch column and the match columns; ``feeds`` comes from
    :func:`feed_table`, whose size is that of the plan itself and which is therefore broadcast.
    Batches are of limited length by construction, hence so is every collected array, and the
    batches of a popular feed stay spread out.
    """
    payload = [c for c in matches.columns if c not in ("algorithm_id", batch)]
    grouped = matches.groupBy("algorithm_id", batch).agg(F.collect_list(F.struct(*payload)).alias("matches"))
    answered = grouped.join(F.broadcast(feeds), "algorithm_id")
    silent = feeds.join(matches.select("algorithm_id").distinct(), "algorithm_id", "left_anti")
    empty = F.array().cast(grouped.schema["matches"].dataType)
    silent = silent.withColumns({batch: F.lit(None).cast(grouped.schema[batch].dataType), "matches": empty})
    at = F.current_timestamp() if compute_time is None else compute_time
    return answered.unionByName(silent).select(
        "algorithm_id",
        at.alias("compute_time"),
        F.expr("uuid()").alias("uuid"),
        "compute_environment",
        batch,
        "matches",
        "error",
    )


def batch_responses(counts: DataFrame, feeds: DataFrame, compute_time: Column | None = None) -> DataFrame:
    """One row per feed of a micro-batch: its match count, or the reason why it did not run.

    ``counts`` comes from :func:`match_counts`.  The matches themselves stay in the match sink, under
    the same batch and feed, so no row grows with a feed's popularity.
    """
    at = F.current_timestamp() if compute_time is None else compute_time
    return feeds.join(counts, "algorithm_id", "left").select(
        "algorithm_id",
        at.alias("compute_time"),
        F.expr("uuid()").alias("uuid"),
        "compute_environment",
        F.coalesce("matches", F.lit(0).cast("long")).alias("match_count"),
        "error",
    )
