"""Near-duplicates by SimHash with bit-sliced comparison.

Fingerprints are grouped so that any two within the radius share a group: 64 bits are cut into
``radius + s`` blocks, and for every choice of ``s`` blocks the fingerprints equal on these blocks
form a group (two within the radius differ in at most ``radius`` blocks, so some choice is equal).
``s`` grows with the number of fingerprints, so groups stay as small at any size.  Groups over
``GROUP`` are dealt into parts, and pairs of parts are compared in tasks of their own.

Inside a task the right side is stored as 64 bit planes, 64 fingerprints to a machine word.  Each
plane, combined with a query's bit, gives 64 differences at once, which carry-save adders count;
words in which every count is over the radius are abandoned after each few planes.
"""

from __future__ import annotations

import itertools
import math

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from postsieve.llm.common import checkpoint, typed
from postsieve.llm.graph import components, forest

BITS = 64
#: Fingerprints of one side of a task.
GROUP = 2048
#: Planes between two looks at which words can be abandoned.
STEP = 8


def fingerprint(text: str | None, width: int = 4, seed: int = 42) -> int:
    """SimHash over ``width``-word shingles with repeats: a bit is 1 if set in over half the hashes.

    ASCII letters are lower-cased; words lie between ASCII white space.  Fewer words than ``width``
    are one shingle; a text without words (NULL, empty) has fingerprint 0.
    """
    import numpy as np
    import xxhash

    words = (text or "").encode("utf-8", "surrogatepass").lower().split()
    if not words:
        return 0
    joined, ends = b" ".join(words), list(itertools.accumulate([len(w) + 1 for w in words]))
    count = max(1, len(words) - width + 1)
    starts = [0, *ends[: count - 1]]
    stops = ends[min(width, len(words)) - 1 :]
    digest = xxhash.xxh64_intdigest
    totals = np.zeros(BITS, np.int64)
    for first in range(0, count, 1 << 16):
        spans = zip(starts[first : first + (1 << 16)], stops[first : first + (1 << 16)])
        hashes = np.array([digest(joined[a : b - 1], seed) for a, b in spans], "<u8")
        bits = np.unpackbits(hashes.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
        totals += np.add.reduce(bits, axis=0, dtype=np.int32)
    return int(np.packbits(totals * 2 > count, bitorder="little").view("<u8")[0])


def fingerprints(docs: DataFrame, width: int = 4, seed: int = 42) -> DataFrame:
    """``doc_id``, ``fp`` (the fingerprint's 64 bits as a long) of every row of ``docs``."""

    def run(batches):
        import numpy as np

        for batch in batches:
            found = [fingerprint(t.as_py(), width, seed) for t in batch.column(1)]
            fp = pa.array(np.array(found, np.uint64).view(np.int64))
            yield pa.RecordBatch.from_arrays([batch.column(0), fp], ["doc_id", "fp"])

    return typed(docs, doc_id="long", text="string").mapInArrow(run, "doc_id long, fp long")


def group_keys(count: int, radius: int) -> list[Column]:
    """For each table a column that is equal for any two fingerprints the table must bring together.

    ``count`` distinct fingerprints give groups of about half of ``GROUP`` if bits are even.
    """
    need = max(0, math.ceil(math.log2(max(1, count) / (GROUP // 2))))
    shared = 1
    while shared < 5 and BITS * shared // (radius + shared) < need:
        shared += 1
    blocks = radius + shared
    edges = [BITS * i // blocks for i in range(blocks + 1)]
    keys = []
    for table, chosen in enumerate(itertools.combinations(range(blocks), shared)):
        parts, left = [], need
        for i in chosen:
            size = min(left, edges[i + 1] - edges[i])
            left -= size
            parts.append(F.shiftrightunsigned("fp", edges[i]).bitwiseAND(F.lit((1 << size) - 1)))
        keys.append(F.struct(F.lit(table).alias("t"), F.xxhash64(*parts).alias("key")))
    return keys


def close_pairs(left, right, radius: int):
    """Index arrays of the pairs of ``left`` and ``right`` (uint64) that differ in few enough bits."""
    import numpy as np

    if radius > 6:
        raise ValueError("three-bit counters hold a radius of 6 at most")
    words = -(-len(right) // 64)
    padded = np.zeros(words * 64, np.uint64)
    padded[: len(right)] = right
    lanes = np.unpackbits(padded.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
    planes = np.packbits(lanes.T.copy(), axis=1, bitorder="little").view("<u8")
    spare = np.zeros(words * 64, np.uint8)
    spare[len(right) :] = 1
    spare = np.packbits(spare, bitorder="little").view("<u8")
    signs = np.unpackbits(left.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
    signs = (np.uint64(0) - signs.astype(np.uint64)).T.copy()
    found_a, found_b = [], []
    for first in range(0, len(left), 256):
        size = min(256, len(left) - first)
        q = np.repeat(np.arange(first, first + size), words)
        w = np.tile(np.arange(words), size)
        ones, twos, fours = (np.zeros(len(q), np.uint64) for _ in range(3))
        over = spare[w]
        for plane in range(0, BITS, STEP):
            for p in range(plane, plane + STEP):
                carry = planes[p][w] ^ signs[p][q]
                ones, carry = ones ^ carry, ones & carry
                twos, carry = twos ^ carry, twos & carry
                fours, carry = fours ^ carry, fours & carry
                over |= carry
            alive = ~(over | above((ones, twos, fours), radius))
            keep = np.flatnonzero(alive)
            if len(keep) < len(q):
                q, w, over, alive = q[keep], w[keep], over[keep], alive[keep]
                ones, twos, fours = ones[keep], twos[keep], fours[keep]
            if not len(q):
                break
        if len(q):
            bits = np.unpackbits(alive.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
            row, lane = np.nonzero(bits)
            found_a.append(q[row])
            found_b.append(w[row] * 64 + lane)
    none = np.zeros(0, np.int64)
    return np.concatenate([none, *found_a]), np.concatenate([none, *found_b])


def above(counters, radius: int):
    """The lanes whose count is over ``radius``; ``counters`` hold the counts' bits, the lowest first."""
    import numpy as np

    more, equal = np.zeros_like(counters[0]), ~np.zeros_like(counters[0])
    if radius >> len(counters):
        return more
    for bit, plane in reversed(list(enumerate(counters))):
        if radius >> bit & 1:
            equal = equal & plane
        else:
            more = more | (equal & plane)
            equal = equal & ~plane
    return more


def links(distinct: DataFrame, radius: int) -> DataFrame:
    """Links ``a``, ``b`` between the distinct fingerprints ``fp`` that join all within ``radius``.

    A task gives a spanning forest of the pairs it finds, never the pairs themselves, so its output
    is bounded by its input; together they have the components that all pairs have.
    """
    keys = group_keys(distinct.count(), radius)
    rows = distinct.select("fp", F.explode(F.array(*keys)).alias("k")).select("fp", "k.t", "k.key")
    sizes = rows.groupBy("t", "key").agg(F.ceil(F.count("*") / GROUP).alias("parts"))
    # A group of one has nothing to compare, and is left out before the join.
    sizes = sizes.join(rows.groupBy("t", "key").count().where("count > 1"), ["t", "key"], "left_semi")
    part = F.pmod(F.xxhash64("fp", F.lit(7)), F.col("parts"))
    pairs = F.transform(
        F.sequence(F.lit(0).cast("long"), F.col("parts") - 1),
        lambda other: F.struct(F.least("part", other).alias("i"), F.greatest("part", other).alias("j")),
    )
    dealt = (
        rows.join(sizes, ["t", "key"])
        .withColumn("part", part)
        .select("t", "key", "fp", "part", F.explode(pairs).alias("p"))
        .select("t", "key", "p.i", "p.j", "part", "fp")
    )

    def compare(table):
        import numpy as np

        fp = table["fp"].to_numpy().view(np.uint64)
        part, i, j = table["part"].to_numpy(), table["i"][0].as_py(), table["j"][0].as_py()
        left, right = np.flatnonzero(part == i), np.flatnonzero(part == j)
        a, b = close_pairs(fp[left], fp[right], radius)
        label = forest(len(fp), left[a], right[b])
        child = np.flatnonzero(label != np.arange(len(fp)))
        ends = [pa.array(fp[x].view(np.int64)) for x in (child, label[child])]
        return pa.table(ends, ["a", "b"])

    return dealt.groupBy("t", "key", "i", "j").applyInArrow(compare, "a long, b long")


def near_duplicates(docs: DataFrame, radius: int = 4, width: int = 4, seed: int = 42) -> DataFrame:
    """``doc_id``, ``fingerprint`` (16 hex digits), ``component_id`` for every row of ``docs``.

    Documents link if their fingerprints differ in ``radius`` bits or fewer; ``component_id`` is
    the smallest id reachable.  Empty and NULL texts have fingerprint 0 and link like any other.
    Repeated rows give repeated rows.  Rows without an id are in their component like others, but
    never name it (NULL if it has no id at all).  An empty table gives no rows; other columns are
    not read.
    """
    rows = checkpoint(fingerprints(docs, width, seed))
    distinct = checkpoint(rows.groupBy("fp").agg(F.min("doc_id").alias("first")))
    found = components(links(distinct.select("fp"), radius))
    tied = distinct.join(found.withColumnRenamed("id", "fp"), "fp", "left")
    tied = tied.withColumn("component", F.coalesce("component", "fp"))
    names = tied.groupBy("component").agg(F.min("first").alias("component_id"))
    named = tied.join(names, "component").select("fp", "component_id")
    return rows.join(named, "fp").select(
        "doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id"
    )


def keep_one(docs: DataFrame, radius: int = 4, width: int = 4, seed: int = 42) -> DataFrame:
    """The rows of ``docs`` that name their component, with all columns as they are.

    Of repeated rows with such an id one stays; rows without an id stay.
    """
    return keep_named(docs, near_duplicates(docs, radius, width, seed))


def keep_named(docs: DataFrame, found: DataFrame) -> DataFrame:
    """The rows of ``docs`` whose ``doc_id`` is its own ``component_id`` in ``found``, as in ``keep_one``."""
    named = checkpoint(found.where("doc_id = component_id").groupBy("doc_id").agg(F.count("*").alias("n")))
    ids = named.select(F.col("doc_id").alias("__kept_id"))
    kept = docs.join(ids, docs["doc_id"].cast("long") == ids["__kept_id"], "left_semi")
    if named.where("n > 1").limit(1).count():
        kept = kept.dropDuplicates(["doc_id"])
    return kept.unionByName(docs.where(docs["doc_id"].isNull()))
