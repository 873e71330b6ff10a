"""Global row numbers and running totals without a single-task sort."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from postsieve.session import checkpoint

_ROW_BITS = 33  # monotonically_increasing_id keeps the row number of a partition in these bits


def with_positions(df: DataFrame, *order: Column | str, name: str = "position") -> DataFrame:
    """Add the 0-based rank of each row in ``order``, which must be a total order.

    Rows are range-partitioned on the order itself, so a crowded value range (one busy minute, one
    hot source) is spread over as many partitions as it needs.  The sorted rows are checkpointed
    once, because partition bounds are sampled and must be the same for both uses below.  Only the
    per-partition counts are then summed up: one row per partition.
    """
    ordered = df.repartitionByRange(*order).sortWithinPartitions(*order)
    stored = checkpoint(ordered).withColumn("__id", F.monotonically_increasing_id())
    stored = stored.withColumn("__part", F.shiftright("__id", _ROW_BITS))
    counts = stored.groupBy("__part").agg(F.count(F.lit(1)).alias("__rows"))
    before = F.sum("__rows").over(W.orderBy("__part").rowsBetween(W.unboundedPreceding, -1))
    offsets = counts.select("__part", F.coalesce(before, F.lit(0)).alias("__offset"))
    in_partition = F.col("__id").bitwiseAND((1 << _ROW_BITS) - 1)
    # The offsets table has as many rows as the sort has partitions.
    return stored.join(F.broadcast(offsets), "__part").select(
        *df.columns, (F.col("__offset") + in_partition).alias(name)
    )


def with_running_totals(
    df: DataFrame, index: str, totals: dict[str, str], block: int = 10_000
) -> DataFrame:
    """Add inclusive running totals along the integer column ``index`` (unique per row).

    ``totals`` maps a new column to the column it sums.  Totals are taken inside blocks of
    ``block`` consecutive indexes and blocks are chained by their sums, so the one unpartitioned
    window sees a ``block``-th of the rows.
    """
    blocks = df.withColumn("__block", F.floor(F.col(index) / block))
    sums = blocks.groupBy("__block").agg(*[F.sum(v).alias(f"__sum_{k}") for k, v in totals.items()])
    earlier = W.orderBy("__block").rowsBetween(W.unboundedPreceding, -1)
    offsets = sums.select(
        "__block", *[F.coalesce(F.sum(f"__sum_{k}").over(earlier), F.lit(0)).alias(f"__off_{k}") for k in totals]
    )
    inside = W.partitionBy("__block").orderBy(index).rowsBetween(W.unboundedPreceding, 0)
    return (
        blocks.join(offsets, "__block")
        .withColumns({k: F.sum(v).over(inside) + F.col(f"__off_{k}") for k, v in totals.items()})
        .select(*df.columns, *totals)
    )


def split_even(df: DataFrame, k: int, *order: Column | str, name: str = "part") -> DataFrame:
    """Cut the ordered rows into ``k`` runs of equal length, the first ones longer by one row.

    Like ``ntile(k)`` (parts count from 1), but no task sees more than its share of the rows.
    """
    if k <= 0:
        raise ValueError("k must be a positive integer.")
    ranked = with_positions(df, *order, name="__position")
    total = ranked.agg(F.count(F.lit(1)).alias("n")).scalar()
    ranked = ranked.withColumn("__n", total)
    ranked = ranked.withColumns(
        {"__base": F.floor(F.col("__n") / k), "__extra": F.col("__n") % k}
    )
    long_part = F.col("__base") + 1
    in_long = F.col("__position") < F.col("__extra") * long_part
    part = F.when(in_long, F.floor(F.col("__position") / long_part)).otherwise(
        F.col("__extra") + F.floor((F.col("__position") - F.col("__extra") * long_part) / F.greatest("__base", F.lit(1)))
    )
    checked = F.when(F.col("__n") < k, F.raise_error(F.lit("k cannot be greater than the number of elements.")))
    return ranked.select(*df.columns, F.coalesce(checked.cast("long"), part + 1).cast("int").alias(name))
