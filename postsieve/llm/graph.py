"""Connected components of links, in Spark over the whole graph and in numpy inside one block."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from postsieve.llm.common import checkpoint


def components(edges: DataFrame) -> DataFrame:
    """``id``, ``component`` for every node that isn't the smallest of its component.

    ``edges`` has two long columns, ``a`` and ``b``; NULL ends and loops mean nothing.  Rounds of
    large-star and small-star (Kiveris et al., 2014: "Connected components in MapReduce and
    beyond") hang every node below the smallest one; each round is a grouping by minimum and a
    join with its result, so no neighbourhood is ever held in one task.
    """
    high, low = F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")
    stars = checkpoint(edges.where("a <> b").select(high, low).distinct())
    before = None
    while True:
        both = stars.unionByName(stars.select(F.col("b").alias("a"), F.col("a").alias("b")))
        least = both.groupBy("a").agg(F.min("b").alias("m"))
        large = both.where("b > a").join(least.select("a", F.least("a", "m").alias("m")), "a")
        large = checkpoint(large.select(F.col("b").alias("a"), F.col("m").alias("b")).distinct())
        least = large.groupBy("a").agg(F.min("b").alias("m"))
        small = large.join(least, "a")
        up = F.explode(F.array(F.struct("a", F.col("m").alias("b")), F.struct(F.col("b").alias("a"), F.col("m").alias("b"))))
        stars = checkpoint(small.select(up.alias("e")).select("e.a", "e.b").where("a > b").distinct())
        after = stars.agg(F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first()
        if after == before:
            return stars.select(F.col("a").alias("id"), F.col("b").alias("component"))
        before = after


def forest(n: int, a, b):
    """For ``n`` local nodes and the links ``a[i]``-``b[i]`` the smallest node of each component."""
    import numpy as np

    label = np.arange(n)
    while len(a):
        low = np.minimum(label[a], label[b])
        changed = (label[a] != low) | (label[b] != low)
        if not changed.any():
            break
        np.minimum.at(label, label[a], low)
        np.minimum.at(label, label[b], low)
        while True:
            jumped = label[label]
            if (jumped == label).all():
                break
            label = jumped
    return label
