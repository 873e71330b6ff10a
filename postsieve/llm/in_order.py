"""Rows in the order of their ids, each with the one after it, without a sort in one task."""

from __future__ import annotations

from bisect import bisect_right
from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from postsieve.llm.common import typed

#: Ranges at most; their first keys are held by the driver and sent along, as range partitioning does.
RANGES = 100_000
Rows = Iterator[tuple[int | None, str, bool]]


def in_order(docs: DataFrame, ranges: int, run: Callable[[Rows], Iterator[pa.RecordBatch]], kind: str) -> DataFrame:
    """What ``run`` makes of the rows (id, text, is a guest) of each range of ``docs`` in their order.

    Rows come by ``doc_id``, NULL first, rows of one id by their text's hash and text; a NULL text is
    an empty one.  After its own rows each range gets one guest, the first row of the next range (the
    last range the first of all), so that every row meets its successor.  Rows of the same id and
    text lie in one range.  Ranges are found over ids and hashes alone; a text is shuffled once, and
    the guests, one a range, besides.  ``kind`` is the type of the rows ``run`` gives.  It must give
    none for none: an empty table has no ranges.
    """
    rows = typed(docs, doc_id="long", text="string").withColumn("text", F.coalesce("text", F.lit("")))
    rows = rows.select("doc_id", F.xxhash64("text").alias("tie"), "text")
    order = [F.col("doc_id").asc_nulls_first(), F.col("tie")]

    def first_key(batches):
        for batch in batches:
            if batch.num_rows:
                yield batch.slice(0, 1)
                return

    bounds = rows.select("doc_id", "tie").repartitionByRange(max(1, min(ranges, RANGES)), *order)
    bounds = bounds.sortWithinPartitions(*order).mapInArrow(first_key, "doc_id long, tie long")
    heads = sorted((r["doc_id"] is not None, r["doc_id"] or 0, r["tie"]) for r in bounds.collect())
    count = len(heads)

    def deal(batches):
        guests: dict[int, tuple] = {}
        for batch in batches:
            keys = zip(batch.column(0).to_pylist(), batch.column(1).to_pylist())
            parts = []
            for at, (key, tie) in enumerate(keys):
                whole = (key is not None, key or 0, tie)
                part = bisect_right(heads, whole) - 1
                parts.append(part)
                if heads[part] == whole:
                    text = batch.column(2)[at].as_py()
                    if part not in guests or text < guests[part][2]:
                        guests[part] = (key, tie, text)
            own = pa.array([False] * len(parts), pa.bool_())
            yield pa.RecordBatch.from_arrays([pa.array(parts, pa.int32()), own, *batch.columns], ["part", "guest", "doc_id", "tie", "text"])
        for part, (key, tie, text) in guests.items():
            row = [[(part - 1) % count], [True], [key], [tie], [text]]
            types = [pa.int32(), pa.bool_(), pa.int64(), pa.int64(), pa.string()]
            yield pa.RecordBatch.from_arrays([pa.array(v, t) for v, t in zip(row, types)], ["part", "guest", "doc_id", "tie", "text"])

    def ranged(batches):
        def each():
            for batch in batches:
                guests, keys = batch.column(0).to_pylist(), batch.column(1).to_pylist()
                for guest, key, text in zip(guests, keys, batch.column(2)):
                    yield key, text.as_py(), guest
                    if guest:  # several tasks may have sent the same one
                        return

        yield from run(each())

    dealt = rows.mapInArrow(deal, "part int, guest boolean, doc_id long, tie long, text string")
    placed = dealt.repartitionById(max(1, count), "part").sortWithinPartitions("guest", *order, "text")
    return placed.select("guest", "doc_id", "text").mapInArrow(ranged, kind)
