"""Mixing sources to target weights by Poisson replication, in SQL functions alone.

Each source's repetition rate is its target share of the corpus over its present size.  A document
stays as often as a Poisson number with that mean says, found by inverting the distribution at a
uniform number hashed from seed and id; so a decision needs no other document and comes out the
same on every run.  Copies are dealt over partitions and sorted by another hash: a global shuffle.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from postsieve.llm.common import checkpoint

#: Rates above are split into equal parts, each with a number of its own; sums of Poisson numbers
#: are Poisson, and exp(-rate) stays far from 0.
PART = 8.0
#: Terms of the distribution; the rest is below 1e-30 for a mean of 8.
TERMS = 64
#: Rates of so many sources (512 bytes each) are broadcast; more are joined by a shuffle, whose hot
#: partitions the adaptive planner splits.
SOURCES = 20_000


def uniform(*parts: Column) -> Column:
    """52 bits of an MD5 digest as a number in [0, 1)."""
    digest = F.md5(F.concat_ws(":", *parts).cast("binary"))
    return F.conv(F.substring(digest, 1, 13), 16, 10).cast("long") / F.lit(float(1 << 52))


def distribution(mean: Column) -> Column:
    """Array of P(X <= k), k from 0 to ``TERMS - 1``, for a Poisson number with ``mean``."""
    start = F.struct(F.exp(-mean).alias("p"), F.array(F.exp(-mean)).alias("sums"))

    def step(state, k):
        p = state["p"] * mean / k
        return F.struct(p.alias("p"), F.concat(state["sums"], F.array(F.element_at(state["sums"], -1) + p)).alias("sums"))

    return F.aggregate(F.sequence(F.lit(1), F.lit(TERMS - 1)), start, step, lambda state: state["sums"])


def rates(docs: DataFrame, weights: DataFrame | None = None, size: float = 1.0) -> DataFrame:
    """``source``, ``rate``, ``parts``, ``sums``: how often each source is to be repeated.

    A document's size is its characters and one more.  ``weights`` has ``source`` and ``weight``
    (NULL or missing: 0; negative: 0); without it all sources weigh the same.  ``size`` is the size
    of the result over that of ``docs``.
    """
    chars = F.coalesce(F.length(docs["text"].cast("string")), F.lit(0)) + 1
    sizes = docs.select(docs["source"].cast("string").alias("source"), chars.cast("long").alias("chars"))
    sizes = sizes.groupBy("source").agg(F.sum("chars").alias("chars"))
    if weights is None:
        sizes = sizes.withColumn("weight", F.lit(1.0))
    else:
        own = weights.groupBy(weights["source"].cast("string").alias("w")).agg(F.sum("weight").alias("weight"))
        sizes = sizes.join(own, sizes["source"].eqNullSafe(own["w"]), "left").drop("w")
        sizes = sizes.withColumn("weight", F.greatest(F.coalesce("weight", F.lit(0.0)), F.lit(0.0)))
    whole = sizes.agg(F.sum("chars").alias("all_chars"), F.sum("weight").alias("all_weight"))
    rated = sizes.crossJoin(F.broadcast(whole))  # one row
    share = F.col("weight") / F.nullif("all_weight", F.lit(0.0))
    rate = F.coalesce(F.col("all_chars") * share * F.lit(float(size)) / F.col("chars"), F.lit(0.0))
    rated = rated.select("source", rate.alias("rate"))
    rated = rated.withColumn("parts", F.greatest(F.ceil(F.col("rate") / PART), F.lit(1)))
    return rated.withColumn("sums", distribution(F.col("rate") / F.col("parts")))


def mix(docs: DataFrame, weights: DataFrame | None = None, size: float = 1.0, seed: int = 0) -> DataFrame:
    """The copies of ``docs``: ``doc`` (the row, all columns), ``copy`` (from 1), ``copies``, ``place``.

    Needs ``doc_id``, ``text``, ``source``.  Rows come in the order of ``place`` within partitions,
    dealt by it.  Equal ids of a source are repeated equally often.  NULL ids hash like an empty
    text; NULL sources are a source of their own; NULL texts have no characters.  Sources without
    weight go, as their target says; an empty table gives no rows.
    """
    rated = checkpoint(rates(docs, weights, size).withColumnRenamed("source", "__source"))
    if rated.count() <= SOURCES:
        rated = F.broadcast(rated)
    rows = docs.select(
        F.struct(*[docs[c] for c in docs.columns]).alias("doc"),
        F.coalesce(docs["doc_id"].cast("string"), F.lit("")).alias("key"),
        docs["source"].cast("string").alias("source"),
    )
    rows = rows.join(rated, rows["source"].eqNullSafe(rated["__source"]))
    numbers = F.transform(
        F.sequence(F.lit(1).cast("long"), F.col("parts")),
        lambda part: uniform(F.lit(f"{seed}"), F.col("key"), part.cast("string")),
    )
    # Sums are in order, so those at or below a number are a count.
    copies = F.aggregate(
        numbers, F.lit(0), lambda total, u: total + F.size(F.filter("sums", lambda s: s <= u))
    )
    rows = rows.select("doc", "key", copies.alias("copies")).where("copies > 0")
    rows = rows.select("doc", "key", "copies", F.explode(F.sequence(F.lit(1), "copies")).alias("copy"))
    place = F.md5(F.concat_ws(":", F.lit(f"{seed}"), F.lit("place"), "key", F.col("copy").cast("string")).cast("binary"))
    rows = rows.select("doc", F.col("copy").cast("long"), F.col("copies").cast("long"), place.alias("place"))
    return rows.repartition("place").sortWithinPartitions("place")


def mixed(docs: DataFrame, weights: DataFrame | None = None, size: float = 1.0, seed: int = 0) -> DataFrame:
    """As ``mix``, with the columns of ``docs`` alone."""
    return mix(docs, weights, size, seed).select("doc.*")
