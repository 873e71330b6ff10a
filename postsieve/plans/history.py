"""Reading history backwards: replay ranges, slices, backtest and backfill."""

from __future__ import annotations

import functools
from collections.abc import Callable
from dataclasses import dataclass, replace
from datetime import datetime, timezone

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from postsieve.operators.builtin import DEFAULT_REGISTRY
from postsieve.operators.leaf import PostView
from postsieve.operators.registry import Registry
from postsieve.plans.attach import Catalog
from postsieve.plans.match import flag_posts
from postsieve.plans.positions import with_positions, with_running_totals
from postsieve.session import checkpoint, shared_folder

SLICE_US = 60_000_000
DAY_US = 24 * 3_600 * 1_000_000
BACKTEST_BATCH = 1000
BACKFILL_BATCH = 2000
MAX_MATCHES = 500

#: Adds the boolean column MATCHED to posts; a plain condition stands for itself.
MATCHED = "__matched"
Flag = Column | Callable[[DataFrame], DataFrame]


def flagged(posts: DataFrame, matched: Flag) -> DataFrame:
    return posts.withColumn(MATCHED, matched) if isinstance(matched, Column) else matched(posts)


def default_range(now_us: int) -> tuple[int, int]:
    """The last day up to a minute ago."""
    return now_us - DAY_US, now_us - SLICE_US


def replay_range(
    posts: DataFrame,
    start_us: int,
    end_us: int,
    max_chars: int | None = None,
    include_start: bool = True,
    date_column: str | None = None,
) -> DataFrame:
    """Created posts of a time range, of at most ``max_chars`` characters of raw JSON if given.

    Nothing when the range is empty.  The bounds are plain comparisons and reach the scan; with a
    ``date_column`` (the UTC date a table of posts is partitioned by) they also prune partitions.
    """
    if start_us >= end_us:
        return posts.where(F.lit(False))
    if date_column is not None:
        first, last = (datetime.fromtimestamp(us // 1_000_000, timezone.utc).date() for us in (start_us, end_us))
        posts = posts.where(F.col(date_column).between(F.lit(first), F.lit(last)))
    time = F.col("time_us")
    kept = posts.where((time >= start_us) if include_start else (time > start_us)).where(time <= end_us)
    if "operation" in posts.columns:
        kept = kept.where(F.col("operation") == "create")
    if max_chars is not None and "raw" in posts.columns:
        kept = kept.where(F.length("raw") <= max_chars)
    return kept


def slice_number(time_us: Column, end_us: int, slice_us: int = SLICE_US) -> Column:
    """0 for the newest slice.  A slice is open at its start and closed at its end, so an event on
    an edge belongs to one slice only."""
    return F.floor((F.lit(end_us) - time_us) / slice_us).cast("long")


def reverse_slices(posts: DataFrame, start_us: int, end_us: int, slice_us: int = SLICE_US) -> DataFrame:
    """Created posts of (start, end] with ``slice_no``, in crawl order: newest slice first,
    ascending time inside a slice."""
    kept = replay_range(posts, start_us, end_us, include_start=False)
    return kept.withColumn("slice_no", slice_number(F.col("time_us"), end_us, slice_us)).orderBy("slice_no", "time_us")


@dataclass(frozen=True)
class Crawl:
    """How far a crawl goes: batches of ``batch_size`` until ``max_matches`` is reached.

    None, the default, is the whole range: a crawl ends early only if asked.  ``MAX_MATCHES`` is usual.
    """

    start_us: int
    end_us: int
    slice_us: int = SLICE_US
    batch_size: int = BACKTEST_BATCH
    max_matches: int | None = None
    # The number of newest slices looked at first; see narrow_crawl.
    first_look: int = 60
    date_column: str | None = None
    max_chars: int | None = None

    def window(self, posts: DataFrame) -> DataFrame:
        return replay_range(posts, self.start_us, self.end_us, self.max_chars, False, self.date_column)


def narrow_crawl(posts: DataFrame, matched: Flag, crawl: Crawl, growth: int = 4) -> Crawl:
    """Move the start of a crawl forward to where it certainly has come to its end.

    Counts are taken over the newest ``first_look`` slices and, while the limit is not reached, over
    ``growth`` times as many, and so on.  A filter with many matches reads minutes of history; one
    with few reads it all, a third of it twice.  The batch that reaches the limit stays whole.
    """
    if crawl.max_matches is None:
        return crawl
    span = crawl.first_look * crawl.slice_us
    wanted = None  # records the window must hold, once the limit has been reached
    while crawl.end_us - span > crawl.start_us:
        shorter = replace(crawl, start_us=crawl.end_us - span)
        seen = flagged(shorter.window(posts), matched).agg(
            F.count(F.lit(1)).alias("records"), F.count_if(MATCHED).alias("matches")
        ).first()
        if wanted is None and seen.matches >= crawl.max_matches:
            wanted = seen.records + crawl.batch_size
        if wanted is not None and seen.records >= wanted:
            return shorter
        span *= growth
    return crawl


def look_back(posts: DataFrame, matched: Flag, crawl: Crawl, columns: list[Column], growth: int = 4) -> DataFrame:
    """The flagged posts of as much of a crawl's newest part as it needs, ``columns`` of each.

    The first look takes ``first_look`` slices.  While the limit isn't reached, the next one takes
    what lies between it and ``growth`` times as far back, and nothing newer: the answers of a look
    are stored, and its counts are added to those before.  So a post is filtered once.
    """
    looks, records, matches, wanted = [], 0, 0, None
    newest, span = crawl.end_us, crawl.first_look * crawl.slice_us
    while True:
        oldest = crawl.start_us if crawl.max_matches is None else max(crawl.start_us, crawl.end_us - span)
        look = replace(crawl, start_us=oldest, end_us=newest)
        looks.append(checkpoint(flagged(look.window(posts), matched).select(*columns)))
        seen = looks[-1].agg(F.count(F.lit(1)).alias("records"), F.count_if("matched").alias("matches")).first()
        records, matches = records + seen.records, matches + seen.matches
        if wanted is None and crawl.max_matches is not None and matches >= crawl.max_matches:
            wanted = records + crawl.batch_size
        if oldest <= crawl.start_us or (wanted is not None and records >= wanted):
            return functools.reduce(DataFrame.unionByName, looks)
        newest, span = oldest, span * growth


def crawl_batches(
    posts: DataFrame, matched: Flag, crawl: Crawl, key: tuple[str, ...], whole: bool = False
) -> DataFrame:
    """Key, ``matched`` and ``batch_no`` of the posts a crawl may have to look at.

    Only posts of the crawl's window are filtered; an answer that takes joins is looked for step by
    step and stored (``look_back``).  Per-slice counts show how far back the crawl has to go; only the
    posts of those slices are ranked.  A crawl that finds its matches in the newest slices never sorts
    the rest of history.  With ``whole``, matching posts carry their row along as ``post``, others NULL.
    """
    columns = [
        slice_number(F.col("time_us"), crawl.end_us, crawl.slice_us).alias("slice_no"),
        F.col("time_us"),
        *[F.col(k) for k in key],
        F.col(MATCHED).alias("matched"),
        *([F.when(F.col(MATCHED), F.struct(*posts.columns)).alias("post")] if whole else []),
    ]
    if isinstance(matched, Column):
        narrow = flagged(crawl.window(posts), matched).select(*columns)
    else:
        narrow = look_back(posts, matched, crawl, columns)
    slices = narrow.groupBy("slice_no").agg(
        F.count(F.lit(1)).alias("records"), F.count_if("matched").alias("matches")
    )
    # One row per slice.
    totals = checkpoint(
        with_running_totals(slices, "slice_no", {"all_records": "records", "all_matches": "matches"})
    )
    # The batch which reaches the limit ends less than one batch after the slice which reaches it.
    limit = F.lit(crawl.max_matches).cast("long")
    enough = F.min(F.when(F.col("all_matches") >= limit, F.col("all_records")))
    horizon = totals.agg((F.coalesce(enough, F.max("all_records")) + crawl.batch_size).alias("n")).first().n
    needed = totals.where(F.col("all_records") - F.col("records") < F.lit(horizon))
    reached = narrow.where(F.col("slice_no") <= F.lit(needed.agg(F.max("slice_no").alias("n")).first().n))
    ranked = with_positions(reached, "slice_no", "time_us", *key, "matched")
    batch = F.floor(F.col("position") / crawl.batch_size).alias("batch_no")
    return ranked.select(*key, "matched", batch, *(["post"] if whole else []))


def crawl_progress(batches: DataFrame, max_matches: int | None) -> DataFrame:
    """``batch_no, batch_records, batch_matches, record_count, match_count`` up to the batch which
    reaches ``max_matches`` (None: all); the counts are running totals."""
    per_batch = batches.groupBy("batch_no").agg(
        F.count(F.lit(1)).alias("batch_records"), F.count_if("matched").alias("batch_matches")
    )
    totals = with_running_totals(
        per_batch, "batch_no", {"record_count": "batch_records", "match_count": "batch_matches"}
    )
    return totals if max_matches is None else totals.where(F.col("match_count") - F.col("batch_matches") < max_matches)


def backtest_progress(posts: DataFrame, matched: Flag, crawl: Crawl, key: tuple[str, ...]) -> DataFrame:
    return crawl_progress(crawl_batches(posts, matched, crawl, key), crawl.max_matches)


def crawl_matches(batches: DataFrame, crawl: Crawl) -> DataFrame:
    """Matching posts of the ``batches`` (``whole``) a crawl goes through, with their ``batch_no``.

    Rows were carried along, so posts that repeat a key, or have none, are reported once each.
    """
    last = crawl_progress(batches, crawl.max_matches).agg(F.max("batch_no")).scalar()
    return batches.where("matched").where(F.col("batch_no") <= last).select("post.*", "batch_no")


def run_backtest(
    posts: DataFrame,
    condition: dict,
    view: PostView,
    crawl: Crawl,
    catalog: Catalog = Catalog(),
    registry: Registry = DEFAULT_REGISTRY,
) -> tuple[DataFrame, DataFrame]:
    """(progress per batch, matching posts) of one filter over history.

    Models see each distinct input once, however many looks it is in: what they say is kept, for
    this run or in the folder the catalog names.
    """
    if catalog.scorers and catalog.keep is None:
        catalog = replace(catalog, keep=shared_folder(posts.sparkSession, "scores"))

    def matched(window: DataFrame) -> DataFrame:
        return flag_posts(window, condition, view, catalog, registry, MATCHED)

    batches = crawl_batches(posts, matched, crawl, view.key, whole=True)
    return crawl_progress(batches, crawl.max_matches), crawl_matches(batches, crawl)


def run_backfill(
    posts: DataFrame,
    condition: dict,
    view: PostView,
    crawl: Crawl,
    catalog: Catalog = Catalog(),
    registry: Registry = DEFAULT_REGISTRY,
) -> DataFrame:
    """Matching posts of a backfill crawl (see ``sources.sinks.write_matches`` to store them)."""
    return run_backtest(posts, condition, view, crawl, catalog, registry)[1]
