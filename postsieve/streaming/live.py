"""The live job: events in, matches out, feeds compiled once per micro-batch."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from postsieve.operators.builtin import DEFAULT_REGISTRY
from postsieve.operators.registry import Registry
from postsieve.plans.attach import Catalog
from postsieve.plans.match import Feed, compile_feeds, match_feeds, project_matches
from postsieve.plans.responses import batch_responses, feed_table, match_counts
from postsieve.sources import posts as P
from postsieve.sources.replays import ProcessedEvents, fresh_events
from postsieve.sources.sinks import (
    CommittedBatches,
    read_batch,
    write_deletes,
    write_matches,
    write_metrics,
    write_rejects,
    write_responses,
)

# Fixed value: a batch is flushed at least this often.
FLUSH_INTERVAL = "30 seconds"


@dataclass(frozen=True)
class FeedSet:
    """Manifests and conditions as read from a bundle."""

    manifests: dict[int, dict | None]
    conditions: dict[int, dict]


def event_stream(
    spark: SparkSession,
    path: str,
    max_files_per_trigger: int = 1000,
    collection: str | None = None,
    max_chars: int | None = None,
    rejects: bool = False,
) -> DataFrame:
    """Validated and parsed events from a folder of JSON-lines files, however late they are.

    Other sources (for instance Kafka) plug in by passing their own streaming frame with a ``raw``
    column to :func:`prepare_stream`.  Replayed events are recognised by :func:`run_live`.
    """
    raw = (
        spark.readStream.format("text")
        .option("maxFilesPerTrigger", max_files_per_trigger)
        .load(path)
        .withColumnRenamed("value", "raw")
    )
    return prepare_stream(raw, collection, max_chars, rejects)


def prepare_stream(
    raw: DataFrame, collection: str | None = None, max_chars: int | None = None, rejects: bool = False
) -> DataFrame:
    """Parsed events.  With ``rejects``, messages that are no events stay, with their ``reason``, for
    the quarantine of :func:`run_live`."""
    judge = P.judge_events if rejects else P.validate_events
    events = P.parse_events(judge(raw, max_chars=max_chars))
    if collection is None:
        return events
    wanted = F.col("collection") == collection
    return events.where(wanted | F.col("reason").isNotNull() if rejects else wanted)


def process_batch(
    events: DataFrame,
    feeds: FeedSet,
    catalog: Catalog = Catalog(),
    registry: Registry = DEFAULT_REGISTRY,
    compiled: list[Feed] | None = None,
) -> tuple[DataFrame, DataFrame]:
    """(matches, deletes) of a batch of parsed events: the same function for streams and tables."""
    creates, deletes = P.split_operations(events)
    compiled = compile_batch(events, feeds, catalog, registry) if compiled is None else compiled
    matched = match_feeds(creates, compiled, catalog)
    return project_matches(matched, P.post_view(creates), "algorithm_id"), deletes


def compile_batch(events: DataFrame, feeds: FeedSet, catalog: Catalog, registry: Registry) -> list[Feed]:
    return compile_feeds(feeds.manifests, feeds.conditions, P.post_view(events), registry, catalog)


def run_live(
    events: DataFrame,
    load_feeds: Callable[[], FeedSet],
    matches_path: str,
    deletes_path: str,
    checkpoint_location: str,
    catalog: Catalog | Callable[[], Catalog] = Catalog(),
    registry: Registry = DEFAULT_REGISTRY,
    available_now: bool = False,
    responses_path: str | None = None,
    rejects_path: str | None = None,
    metrics_path: str | None = None,
) -> StreamingQuery:
    """Start the live job.  ``load_feeds`` is asked once per micro-batch, so edits take effect; so is
    ``catalog`` if it is a function, so that refreshed assets do.

    With a ``responses_path``, each batch stores a response for every feed: its number of matches, or
    the error that keeps it from running.  With a ``rejects_path``, it stores the messages that carry a
    ``reason`` (:func:`prepare_stream` with ``rejects``; without the path they are left out); a reject
    has no key, so one that is read again is stored again.  With a ``metrics_path``, it stores a row of
    counts (:data:`METRICS`), observed while the outputs are written and not by reading them again.

    All outputs replace the folder of their batch, so a batch that runs twice is stored once, and a
    batch whose outputs are all there isn't run again.  ``<checkpoint>-batches`` says which those are:
    readers who go through :func:`committed_batches` see all outputs of a batch or none.
    The keys of processed events are stored beside the stream's state; an event that is read again
    in a later batch is left out, and none is left out for being late.  The parsed batch is kept in
    memory (spilling to disk) while its outputs are written.
    """
    store = ProcessedEvents(events.sparkSession, f"{checkpoint_location.rstrip('/')}-keys")
    done = committed_batches(events.sparkSession, checkpoint_location)
    judged = "reason" in events.columns
    if rejects_path is not None and not judged:
        raise ValueError("rejects are stored from events with a reason: use prepare_stream(..., rejects=True)")

    def handle(read: DataFrame, batch_id: int) -> None:
        spark = read.sparkSession
        query = spark.sparkContext.getLocalProperty("sql.streaming.queryId")
        if done.holds(query, batch_id):
            return
        read = read.persist()
        good = read.where("reason IS NULL").drop("reason") if judged else read
        batch = fresh_events(good, store, batch_id).persist()
        try:
            feeds, tables = load_feeds(), catalog() if callable(catalog) else catalog
            compiled = compile_batch(batch, feeds, tables, registry)
            matches, deletes = process_batch(batch, feeds, tables, registry, compiled)
            seen = {name: Observation() for name in ("matches", "deletes")}
            write_matches(matches, matches_path, batch_id, seen["matches"])
            write_deletes(deletes, deletes_path, batch_id, seen["deletes"])
            if rejects_path is not None:
                seen["rejects"] = Observation()
                write_rejects(read.where("reason IS NOT NULL"), rejects_path, batch_id, seen["rejects"])
            if responses_path is not None:
                seen["responses"] = Observation()
                counts = match_counts(read_batch(spark, matches_path, batch_id))
                answers = batch_responses(counts, feed_table(spark, compiled))
                write_responses(answers, responses_path, batch_id, seen["responses"])
            if metrics_path is not None:
                write_metrics(_metrics(read, batch, seen), metrics_path, batch_id)
            store.add(batch, batch_id)
            done.add(query, batch_id)
        finally:
            batch.unpersist()
            read.unpersist()

    writer = events.writeStream.foreachBatch(handle).option("checkpointLocation", checkpoint_location)
    trigger = {"availableNow": True} if available_now else {"processingTime": FLUSH_INTERVAL}
    return writer.trigger(**trigger).start()


def committed_batches(spark: SparkSession, checkpoint_location: str) -> CommittedBatches:
    """Which batches of the job with this checkpoint are stored whole."""
    return CommittedBatches(spark, f"{checkpoint_location.rstrip('/')}-batches")


#: Counts of a batch: messages read, those seen before, events, with text, distinct authors (a
#: HyperLogLog estimate), and rows of each output (NULL for one that isn't stored).
METRICS = ("records", "replayed", "events", "texts", "authors", "matches", "deletes", "rejects", "responses")


def _metrics(read: DataFrame, batch: DataFrame, seen: dict[str, Observation]) -> DataFrame:
    """One row of :data:`METRICS`; both frames are cached, the other counts were observed."""
    rejected = F.col("reason").isNotNull() if "reason" in read.columns else F.lit(False)
    records = read.agg(F.count(F.lit(1)).alias("records"), F.count_if(rejected).alias("__rejected"))
    events = batch.agg(
        F.count(F.lit(1)).alias("events"),
        F.count_if(F.coalesce(F.col("record.text"), F.lit("")) != "").alias("texts"),
        F.approx_count_distinct("did").alias("authors"),
    )
    # Two frames of one row each.
    row = records.first().asDict() | events.first().asDict()
    row["replayed"] = row["records"] - row["__rejected"] - row["events"]
    row |= {name: o.get["rows"] for name, o in seen.items()}
    values = [tuple(row.get(name) for name in METRICS)]
    return batch.sparkSession.createDataFrame(values, ", ".join(f"{name} long" for name in METRICS))
