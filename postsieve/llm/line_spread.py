"""Boilerplate lines by the number of sites that have them, in SQL functions alone.

Each line's sites are counted in a HyperLogLog sketch, built before the shuffle and merged after
it.  Lines whose estimate is so near the threshold that the sketch could be wrong get an exact
distinct count; the others are decided by the sketch.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from postsieve.llm.common import checkpoint

#: 2^12 registers: a standard error of 1.6 %; ``MARGIN`` is six of them and one site more.
REGISTERS = 12
MARGIN = 0.1
#: Keys (a long and an integer) of so many lines are broadcast; more are joined by a shuffle.
KEYS = 500_000


def stripped(line: Column) -> Column:
    return F.btrim(line, F.lit(" \t\r"))


def lines(docs: DataFrame) -> DataFrame:
    """``doc_id``, ``text_key``, ``pos``, ``site`` and the key (``h``, ``n``) of each line not blank."""
    text = F.coalesce(docs["text"].cast("string"), F.lit(""))
    rows = docs.select(
        docs["doc_id"].cast("long").alias("doc_id"),
        F.xxhash64(text).alias("text_key"),
        docs["source"].cast("string").alias("site"),
        F.posexplode(F.split(text, "\n")).alias("pos", "line"),
    ).withColumn("line", stripped(F.col("line")))
    key = F.xxhash64("line").alias("h"), F.length("line").alias("n")
    return rows.where("line <> ''").select("doc_id", "text_key", "pos", "site", *key)


def boilerplate(docs: DataFrame, sites: int) -> DataFrame:
    """Keys (``h``, ``n``) of the lines that ``sites`` sites or more have."""
    seen = lines(docs).where("site IS NOT NULL").select("h", "n", "site")
    counted = seen.groupBy("h", "n").agg(F.hll_sketch_agg("site", F.lit(REGISTERS)).alias("sketch"))
    counted = counted.select("h", "n", F.hll_sketch_estimate("sketch").alias("about"))
    low, high = sites * (1 - MARGIN) - 1, sites * (1 + MARGIN) + 1
    spread = checkpoint(counted.where(F.col("about") >= low))
    sure = spread.where(F.col("about") > high).select("h", "n")
    near = spread.where(F.col("about") <= high).select("h", "n")
    exact = with_keys(seen, near, one_each=True).groupBy("h", "n").agg(F.count("*").alias("c"))
    return checkpoint(sure.unionByName(exact.where(F.col("c") >= sites).select("h", "n")))


def with_keys(rows: DataFrame, keys: DataFrame, one_each: bool = False) -> DataFrame:
    """The ``rows`` whose line is among ``keys`` (stored, unique); each once if ``one_each``.

    Few keys are broadcast, by their counted number, and rows are not shuffled.  Many are joined by
    a shuffle: there equal rows collapse in each task before it, or the adaptive planner splits the
    partition of a line that a third of the rows share.
    """
    if keys.count() <= KEYS:
        kept = rows.join(F.broadcast(keys), ["h", "n"], "left_semi")
        return kept.distinct() if one_each else kept
    return (rows.distinct() if one_each else rows).join(keys, ["h", "n"], "left_semi")


def remove_boilerplate(docs: DataFrame, sites: int = 5) -> DataFrame:
    """``doc_id``, ``source``, ``n_lines``, ``removed`` (positions), ``text`` (lines left) of each row.

    Lines end at line feeds and are compared without blanks at either end; blank lines are never
    removed.  A site is a ``source``; rows without one count for none but lose their lines too.
    NULL and empty texts are one blank line.  Lines are told apart by a 64-bit hash and their
    length.  Repeated rows have the same lines removed; an empty table gives no rows.
    """
    found = lines(docs).select("doc_id", "text_key", "pos", "h", "n")
    found = with_keys(found, boilerplate(docs, sites))
    # A set of positions in one text, however often the row is repeated.
    found = found.groupBy("doc_id", "text_key").agg(F.array_sort(F.collect_set("pos")).alias("removed"))
    found = found.withColumnRenamed("doc_id", "id").withColumnRenamed("text_key", "key")
    text = F.coalesce(docs["text"].cast("string"), F.lit(""))
    rows = docs.select(
        docs["doc_id"].cast("long").alias("doc_id"),
        docs["source"].cast("string").alias("source"),
        text.alias("whole"),
        F.xxhash64(text).alias("text_key"),
    )
    same = rows["doc_id"].eqNullSafe(found["id"]) & (rows["text_key"] == found["key"])
    joined = rows.join(found, same, "left").withColumn("every", F.split("whole", "\n"))
    # A set difference of positions: linear, however many lines of a long text go.
    places = F.array_except(F.sequence(F.lit(0), F.size("every") - 1), F.col("removed"))
    left = F.transform(places, lambda i: F.get("every", i))
    return joined.select(
        "doc_id",
        "source",
        F.size("every").cast("long").alias("n_lines"),
        F.coalesce("removed", F.array().cast("array<int>")).alias("removed"),
        F.when(F.col("removed").isNull(), F.col("whole")).otherwise(F.array_join(left, "\n")).alias("text"),
    )
