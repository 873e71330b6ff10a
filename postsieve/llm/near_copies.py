"""Near copies by the similarity of shingle sets: SimHash finds candidates, the sets decide.

A text's set of word shingles gets a SimHash of 256 bits.  Tables of a few bits each, chosen at
random, bring together fingerprints that agree on a table's bits; inside a group those of like size
within ``RADIUS`` are candidates.  They are compared bit-sliced, as in ``simhash``: a plane holds one
bit of 64 fingerprints, and a tree of carry-save adders counts 64 differences at once, with as many
counter planes as ``RADIUS`` needs.  The number of tables follows from their bits, so that a pair just
at the similarity asked for is in no group with a chance of ``MISSED``; more similar ones are missed
less.  Candidates become components, and inside a component the exact Jaccard similarity of the
shingle sets decides which texts are linked.
"""

from __future__ import annotations

import itertools
import math
import random

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from postsieve.llm.common import checkpoint, typed
from postsieve.llm.graph import components, forest
from postsieve.llm.simhash import above, keep_named

PLANES = ("p0", "p1", "p2", "p3")
BITS = 64 * len(PLANES)
#: Chance that no table brings together a pair just at the similarity asked for.
MISSED = 0.001
#: Bits in which candidates differ: pairs at 0.8 differ in 39 on average (48 if very short), others in 128.
RADIUS = 72
#: Of the first 64 bits alone, looked at before the rest.
FIRST = 24
#: Words of one comparison, of 64 pairs each.
BLOCK = 4096
#: Pairs whose whole fingerprints are compared at a time.
PAIRS = 1 << 14
#: Fingerprints of a group on average at most; groups of over twice as many are dealt into parts.
GROUP = 4096
#: Shingles and texts of one part of a component, and of a bundle of small components.
GRAMS, TEXTS = 2_000_000, 1024

KIND = "key long, size int, " + ", ".join(f"{p} long" for p in PLANES)


def shingles(text: str | None, width: int = 5, seed: int = 42):
    """Sorted distinct 64-bit hashes of the ``width``-word shingles; words as in ``simhash``."""
    import numpy as np
    import xxhash

    words = (text or "").encode("utf-8", "surrogatepass").lower().split()
    if not words:
        return np.zeros(0, np.uint64)
    joined, ends = b" ".join(words), list(itertools.accumulate([len(w) + 1 for w in words]))
    count = max(1, len(words) - width + 1)
    digest = xxhash.xxh64_intdigest
    spans = zip([0, *ends[: count - 1]], ends[min(width, len(words)) - 1 :])
    return np.unique(np.fromiter((digest(joined[a : b - 1], seed) for a, b in spans), np.uint64, count))


def fingerprint(grams) -> list[int]:
    """256 bits of a shingle set: a bit is 1 if set in over half the hashes."""
    import numpy as np

    totals = np.zeros(BITS, np.int64)
    for first in range(0, len(grams), 1 << 14):
        mixed, columns = grams[first : first + (1 << 14)], []
        for _ in PLANES:  # the finalizer of SplitMix64, again and again
            mixed = (mixed ^ (mixed >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
            mixed = (mixed ^ (mixed >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
            mixed = mixed ^ (mixed >> np.uint64(31))
            columns.append(mixed)
        bits = np.unpackbits(np.stack(columns, axis=1).view(np.uint8), axis=1, bitorder="little")
        totals += np.add.reduce(bits, axis=0, dtype=np.int32)
    return np.packbits(totals * 2 > len(grams), bitorder="little").view("<i8").tolist()


def set_key(grams) -> int:
    """Equal for equal sets; a 64-bit hash as a signed long."""
    import xxhash

    digest = xxhash.xxh64_intdigest(grams.tobytes(), 7)
    return digest - (1 << 64) if digest >> 63 else digest


def described(texts: DataFrame, width: int, whole: bool = False) -> DataFrame:
    """``key``, ``size``, the fingerprint, and what else stands beside ``text``; ``whole``: the set."""
    others = [f for f in texts.schema if f.name != "text"]
    kind = ", ".join([KIND, *(f"{f.name} {f.dataType.simpleString()}" for f in others)]) + (", grams array<long>" if whole else "")

    def run(batches):
        import numpy as np

        for batch in batches:
            at = batch.schema.get_field_index("text")
            for first in range(0, len(batch), 256):
                part = batch.slice(first, 256)
                sets = [shingles(t.as_py(), width) for t in part.column(at)]
                prints = np.array([fingerprint(s) for s in sets], np.int64).reshape(-1, len(PLANES))
                columns = [pa.array([set_key(s) for s in sets], pa.int64()), pa.array([len(s) for s in sets], pa.int32())]
                columns += [pa.array(prints[:, i]) for i in range(len(PLANES))]
                columns += [part.column(i) for i in range(part.num_columns) if i != at]
                names = ["key", "size", *PLANES, *(f.name for f in others)]
                if whole:
                    columns.append(pa.array([s.view(np.int64) for s in sets], pa.list_(pa.int64())))
                    names.append("grams")
                yield pa.RecordBatch.from_arrays(columns, names)

    return texts.mapInArrow(run, kind)


def tables(count: int, least: float, seed: int = 42) -> list[list[int]]:
    """The bits of each table for ``count`` fingerprints."""
    need = max(0, math.ceil(math.log2(max(1, count) / GROUP)))
    differ = math.acos(2 * least / (1 + least)) / math.pi  # of a bit, for sets of one size
    met = (1 - differ) ** need
    number = 1 if met == 1 else math.ceil(math.log(MISSED) / math.log1p(-met))
    rng = random.Random(seed)
    return [rng.sample(range(BITS), need) for _ in range(number)]


def sliced(planes):
    """Bit planes of fingerprints: row ``b`` holds their bit ``b``, 64 to a word (zeros fill the last)."""
    import numpy as np

    padded = np.zeros((-(-len(planes) // 64) * 64, planes.shape[1]), np.uint64)
    padded[: len(planes)] = planes
    lanes = np.unpackbits(padded.view(np.uint8), axis=1, bitorder="little")
    return np.packbits(lanes.T.copy(), axis=1, bitorder="little").view("<u8")


def counted(slices):
    """In how many ``slices`` (first axis) each lane is set: the bits of the counts, the lowest first.

    Carry-save adders take three slices of one weight to one of that weight and one of the next.
    """
    import numpy as np

    weights = [[slices]]
    for k, parts in enumerate(weights):  # grows while it is walked through
        rows = np.concatenate(parts) if len(parts) > 1 else parts[0]
        while len(rows) > 1:
            if k + 1 == len(weights):
                weights.append([])
            third = len(rows) // 3
            if third:
                a, b, c = rows[:third], rows[third : 2 * third], rows[2 * third : 3 * third]
                odd = a ^ b
                weights[k + 1].append((a & b) | (odd & c))
                rows = np.concatenate([odd ^ c, rows[3 * third :]])
            else:
                weights[k + 1].append(rows[:1] & rows[1:])
                rows = rows[:1] ^ rows[1:]
        weights[k] = rows[0]
    return weights


def lanes_of(words):
    """Row and lane of each bit set in rows of ``words``."""
    import numpy as np

    return np.nonzero(np.unpackbits(words.view(np.uint8), axis=1, bitorder="little"))


def close_pairs(left, right, least: float, same: bool):
    """Index arrays of the candidates among ``left`` and ``right``: pairs of sizes and planes.

    Sizes whose ratio is under ``least`` can't be similar.  With ``same``, each pair is given once.
    Pairs that differ in over ``FIRST`` of the first 64 bits are abandoned; the others are dealt to
    lanes of their own, for all bits.
    """
    import numpy as np

    orders = [np.argsort(sizes, kind="stable") for sizes, _ in (left, right)]
    (na, a), (nb, b) = [(sizes[o], planes[o]) for (sizes, planes), o in zip((left, right), orders)]
    found = [np.zeros((0, 2), np.int64)]
    across = sliced(b[:, :1])
    signs = np.unpackbits(a[:, :1].copy().view(np.uint8), axis=1, bitorder="little")
    signs = np.uint64(0) - signs.T.astype(np.uint64)
    first = 0
    while first < len(na):
        # As many queries as make, with the words of like size, a block that stays in the cache.
        low = first if same else int(np.searchsorted(nb, math.floor(na[first] * least), "left"))
        high = int(np.searchsorted(nb, math.ceil(na[first] / least), "right"))
        last = min(len(na), first + max(1, min(256, BLOCK // max(1, (high - low) // 64 + 1))))
        high = int(np.searchsorted(nb, math.ceil(na[last - 1] / least), "right"))
        start, stop = low // 64, -(-high // 64)
        first, here = last, first
        if start >= stop:
            continue
        counters = counted(across[:, None, start:stop] ^ signs[:, here:last, None])
        i, j = lanes_of(~above(counters, FIRST))
        i, j = i + here, j + start * 64
        inside = j < len(nb)
        i, j = i[inside], j[inside]
        fit = (np.minimum(na[i], nb[j]) >= least * np.maximum(na[i], nb[j]) - 1e-9) & ((i < j) | (not same))
        i, j = i[fit], j[fit]
        for k in range(0, len(i), PAIRS):
            x, y = i[k : k + PAIRS], j[k : k + PAIRS]
            _, ok = lanes_of(~above(counted(sliced(a[x] ^ b[y])), RADIUS)[None])
            ok = ok[ok < len(x)]
            found.append(np.stack([orders[0][x[ok]], orders[1][y[ok]]], axis=1))
    pairs = np.concatenate(found)
    return pairs[:, 0], pairs[:, 1]


def similar_pairs(grams, i, j, least: float):
    """The links among the candidates whose sets are similar, without those that join nothing new."""
    import numpy as np

    parent, kept = list(range(len(grams))), []

    def top(x):
        while parent[x] != x:
            parent[x] = parent[parent[x]]
            x = parent[x]
        return x

    for a, b in zip(i.tolist(), j.tolist()):
        x, y = top(a), top(b)
        if x == y:
            continue
        both = len(np.intersect1d(grams[a], grams[b], assume_unique=True))
        if both >= least * (len(grams[a]) + len(grams[b]) - both) - 1e-9:
            parent[x] = y
            kept.append((a, b))
    return kept


def columns_of(table):
    """Sizes and planes of an Arrow table."""
    import numpy as np

    return table["size"].to_numpy(), np.stack([table[p].to_numpy() for p in PLANES], axis=1).view(np.uint64)


def parted(rows: DataFrame) -> DataFrame:
    """``rows`` of ``parts`` parts, once for each pair of parts ``i``, ``j`` with their own ``part``."""
    part = F.pmod(F.xxhash64("key", F.lit(7)), F.col("parts"))
    pairs = F.transform(
        F.sequence(F.lit(0).cast("long"), F.col("parts") - 1),
        lambda other: F.struct(F.least("part", other).alias("i"), F.greatest("part", other).alias("j")),
    )
    return rows.withColumn("part", part).withColumn("p", F.explode(pairs)).select("*", "p.i", "p.j").drop("p", "parts")


def candidates(distinct: DataFrame, least: float) -> DataFrame:
    """Links ``a``, ``b`` that join all candidates: a spanning forest of each group."""
    chosen = tables(distinct.count(), least)

    def grouped(batch):
        import numpy as np

        planes = columns_of(batch)[1]
        for number, bits in enumerate(chosen):
            group = np.full(len(planes), number << 40, np.int64)
            for place, bit in enumerate(bits):
                group |= ((planes[:, bit // 64] >> np.uint64(bit % 64)) & np.uint64(1)).astype(np.int64) << place
            yield group

    def count(batches):
        import numpy as np

        for batch in batches:
            for group in grouped(batch):
                values, counts = np.unique(group, return_counts=True)
                yield pa.RecordBatch.from_arrays([pa.array(values), pa.array(counts.astype(np.int64))], ["g", "n"])

    def deal(batches):
        for batch in batches:
            for group in grouped(batch):
                yield pa.RecordBatch.from_arrays([pa.array(group), *batch.columns], ["g", *batch.schema.names])

    large = distinct.mapInArrow(count, "g long, n long").groupBy("g").agg(F.sum("n").alias("n"))
    large = large.where(F.col("n") > 2 * GROUP).select("g", F.ceil(F.col("n") / GROUP).alias("parts"))
    rows = distinct.mapInArrow(deal, f"g long, {KIND}").join(F.broadcast(large), "g", "left")
    rows = parted(rows.withColumn("parts", F.coalesce("parts", F.lit(1).cast("long"))))

    def compare(table):
        import numpy as np

        key, (size, planes) = table["key"].to_numpy(), columns_of(table)
        part, i, j = table["part"].to_numpy(), table["i"][0].as_py(), table["j"][0].as_py()
        left, right = np.flatnonzero(part == i), np.flatnonzero(part == j)
        a, b = close_pairs((size[left], planes[left]), (size[right], planes[right]), least, i == j)
        label = forest(len(key), left[a], right[b])
        child = np.flatnonzero(label != np.arange(len(key)))
        return pa.table([pa.array(key[child]), pa.array(key[label[child]])], ["a", "b"])

    return rows.groupBy("g", "i", "j").applyInArrow(compare, "a long, b long")


def verified(sets: DataFrame, least: float) -> DataFrame:
    """Links ``a``, ``b`` between the ``sets`` of one ``component`` that are similar.

    Small components share a task; one of many texts is dealt into parts, so none has to fit a task.
    """
    sizes = sets.groupBy("component").agg(F.count("*").alias("n"), F.sum("size").alias("grams"))
    sizes = checkpoint(sizes.select("component", "grams", F.ceil(F.greatest(F.col("n") / TEXTS, F.col("grams") / GRAMS)).alias("parts")))
    total = sizes.agg(F.sum("grams")).first()[0] or 0
    bundles = max(int(sets.sparkSession.conf.get("spark.sql.shuffle.partitions")), math.ceil(4 * total / GRAMS))
    large = sizes.where("parts > 1").select("component", "parts")
    rows = sets.join(F.broadcast(large), "component", "left").withColumn("large", F.col("parts").isNotNull())
    rows = rows.withColumn("bundle", F.when(F.col("large"), F.col("component")).otherwise(F.pmod(F.xxhash64("component"), F.lit(bundles))))
    rows = parted(rows.withColumn("parts", F.coalesce("parts", F.lit(1).cast("long"))))

    def compare(table):
        import numpy as np

        component, part, key = (table[c].to_numpy() for c in ("component", "part", "key"))
        (size, planes), i, j = columns_of(table), table["i"][0].as_py(), table["j"][0].as_py()
        order = np.argsort(component, kind="stable")
        found = []
        for rows in np.split(order, np.flatnonzero(np.diff(component[order])) + 1):
            left, right = rows[part[rows] == i], rows[part[rows] == j]
            a, b = close_pairs((size[left], planes[left]), (size[right], planes[right]), least, i == j)
            local = {int(r): k for k, r in enumerate(rows)}
            grams = [table["grams"][int(r)].values.to_numpy() for r in rows]
            a, b = (np.array([local[int(r)] for r in x], np.int64) for x in (left[a], right[b]))
            found += [(key[rows[x]], key[rows[y]]) for x, y in similar_pairs(grams, a, b, least)]
        return pa.table([pa.array([p[k] for p in found], pa.int64()) for k in (0, 1)], ["a", "b"])

    return rows.groupBy("large", "bundle", "i", "j").applyInArrow(compare, "a long, b long")


def near_copies(docs: DataFrame, least: float = 0.8, width: int = 5) -> DataFrame:
    """``doc_id``, ``component_id`` for every row of ``docs``.

    Documents link if the Jaccard similarity of their sets of ``width``-word shingles is ``least`` or
    more; ``component_id`` is the smallest id reachable.  Texts without words link to each other.
    Rows without an id are in their component like others, but never name it.
    """
    texts = typed(docs, doc_id="long", text="string")
    rows = checkpoint(described(texts, width))
    distinct = checkpoint(rows.groupBy("key", "size", *PLANES).agg(F.min("doc_id").alias("first")))
    prints = distinct.where("size > 0").select("key", "size", *PLANES)
    tied = components(candidates(prints, least))
    tied = checkpoint(tied.unionByName(tied.select(F.col("component").alias("id"), "component").distinct()).withColumnRenamed("id", "key"))
    wanted = distinct.join(tied, "key", "left_semi").where("first IS NOT NULL").select(F.col("first").alias("doc_id")).distinct()
    again = texts.join(wanted, "doc_id", "left_semi").unionByName(texts.where("doc_id IS NULL")).select("text").distinct()
    sets = checkpoint(described(again, width, whole=True).join(tied, "key"))
    found = components(verified(sets, least)).withColumnRenamed("id", "key")
    named = distinct.select("key", "first").join(found, "key", "left").withColumn("component", F.coalesce("component", "key"))
    names = named.groupBy("component").agg(F.min("first").alias("component_id"))
    return rows.select("doc_id", "key").join(named.join(names, "component").select("key", "component_id"), "key").drop("key")


def keep_one(docs: DataFrame, least: float = 0.8, width: int = 5) -> DataFrame:
    """The rows of ``docs`` that name their component of near copies, with all columns as they are.

    Of repeated rows with such an id one stays; rows without an id stay.
    """
    return keep_named(docs, near_copies(docs, least, width))
