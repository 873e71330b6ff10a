"""Exact substring dedup: repeated token windows, found by rolling hashes counted in Spark.

A window is ``width`` consecutive words of one document.  Its Rabin-Karp hash is a polynomial in
the 64-bit hashes of its words modulo 2^64 (then mixed, which loses nothing), so two different
windows agree with probability 2^-64; over ``n`` different windows a false repeat is to be expected
at about ``n^2 / 2^65`` (0.0005 for 140 million).

1. Documents are packed into compressed chunks, written once to the shared folder.
2. Each chunk gives its distinct hashes, sorted, cut into buckets by their first bits and coded as
   differences, each with the first document that has it.
3. A bucket (about ``BUCKET`` hashes; their number grows with the corpus) finds the smallest
   document of each hash and answers each chunk with one bit a hash: an earlier document has it.
4. Chunks meet their answers, mark the words of repeated windows and merge them into intervals.

A window that thousands of documents share is one entry for each chunk, whatever its count.
"""

from __future__ import annotations

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from postsieve.llm.common import checkpoint, typed, written

#: Bytes of words in a chunk; a longer document is a chunk of its own.
CHUNK = 4_000_000
#: Hashes in a bucket, about.
BUCKET = 1_500_000
_BASE = 0x9E3779B97F4A7C15
_MASK = (1 << 64) - 1
#: Rows without an id come after all others, and are not earlier than one another.
_NO_ID = (1 << 63) - 1


class _Words(dict):
    """64-bit hashes of words, each computed once."""

    def __missing__(self, word):
        import xxhash

        value = self[word] = xxhash.xxh64_intdigest(word)
        return value


_HASHES = _Words()


def rolling(hashes, width: int):
    """Polynomial hash of every ``width`` consecutive numbers, by doubling the length."""
    import numpy as np

    def power(k):
        return np.uint64(pow(_BASE, k, 1 << 64))

    total, length, block, size = None, 0, hashes, 1
    while True:
        if width & size:
            if total is None:
                total, length = block, size
            else:  # the bits so far stand in front
                n = max(0, len(hashes) - length - size + 1)
                total = total[:n] * power(size) + block[length : length + n]
                length += size
        if size * 2 > width:
            break
        block = block[: max(0, len(block) - size)] * power(size) + block[size:]
        size *= 2
    x = total
    x = (x ^ (x >> np.uint64(33))) * np.uint64(0xFF51AFD7ED558CCD)
    x = (x ^ (x >> np.uint64(33))) * np.uint64(0xC4CEB9FE1A85EC53)
    return x ^ (x >> np.uint64(33))


class Chunk:
    """The documents of a chunk and their distinct window hashes."""

    def __init__(self, ids: bytes, packed: bytes, size: int, width: int):
        import numpy as np

        self.ids = np.frombuffer(ids, "<i8")
        texts = pa.decompress(packed, size, codec="zstd", asbytes=True).split(b"\n")
        self.words = [t.split() for t in texts]
        lengths = np.array([len(w) for w in self.words])
        self.edges = np.concatenate([[0], np.cumsum(lengths)])
        if len(_HASHES) > 400_000:
            _HASHES.clear()
        look = _HASHES.__getitem__
        hashes = np.fromiter((look(w) for words in self.words for w in words), np.uint64, int(self.edges[-1]))
        counts = np.maximum(0, lengths - width + 1)
        #: Where each window starts, and whose it is.
        self.owner = np.repeat(np.arange(len(lengths)), counts)
        before = np.repeat(self.edges[:-1] - np.concatenate([[0], np.cumsum(counts)[:-1]]), counts)
        self.starts = np.arange(len(self.owner)) + before
        values = rolling(hashes, width)[self.starts] if len(self.starts) else np.zeros(0, np.uint64)
        order = np.argsort(values, kind="stable")
        values = values[order]
        new = np.ones(len(values), bool)
        new[1:] = values[1:] != values[:-1]
        self.keys = values[new]
        # Documents lie in the order of their ids, so the first window has the smallest.
        self.first = self.ids[self.owner[order[new]]]
        self.entry = np.empty(len(values), np.int64)
        self.entry[order] = np.cumsum(new) - 1


def pack(docs: DataFrame) -> DataFrame:
    """Chunks of documents: ``chunk``, ``ids``, ``packed``, ``size``, ``windows`` (words, at most)."""

    def run(batches):
        import numpy as np
        from pyspark import TaskContext

        number = TaskContext.get().partitionId() << 32
        held, size = [], 0

        def chunk():
            held.sort()
            text = b"\n".join(t for _, t in held)
            ids = np.array([i for i, _ in held], "<i8").tobytes()
            words = text.count(b" ") + len(held)
            packed = pa.Codec("zstd", 3).compress(text, asbytes=True)
            row = [[number], [ids], [packed], [len(text)], [words]]
            names = ["chunk", "ids", "packed", "size", "words"]
            return pa.RecordBatch.from_arrays([pa.array(c) for c in row], names)

        for batch in batches:
            for key, text in zip(batch.column(0).to_pylist(), batch.column(1)):
                words = b" ".join((text.as_py() or "").encode("utf-8", "surrogatepass").split())
                if held and size + len(words) > CHUNK:
                    yield chunk()
                    held, size, number = [], 0, number + 1
                held.append((_NO_ID if key is None else key, words))
                size += len(words) + 1
        if held:
            yield chunk()

    kind = "chunk long, ids binary, packed binary, size long, words long"
    return typed(docs, doc_id="long", text="string").mapInArrow(run, kind)


def buckets(chunks: DataFrame, bits: int, width: int) -> DataFrame:
    """For each chunk and bucket the hashes as differences, and the first document of each."""

    def run(batches):
        import numpy as np

        for batch in batches:
            for row in batch.to_pylist():
                c = Chunk(row["ids"], row["packed"], row["size"], width)
                edges = (np.arange(1 << bits, dtype=np.uint64) << np.uint64(64 - bits)) if bits else [np.uint64(0)]
                cuts = np.concatenate([np.searchsorted(c.keys, edges), [len(c.keys)]])
                for k in np.flatnonzero(np.diff(cuts)):
                    keys, first = c.keys[cuts[k] : cuts[k + 1]], c.first[cuts[k] : cuts[k + 1]]
                    steps = np.diff(keys, prepend=np.uint64(0) if bits == 0 else edges[k])
                    room = 6 if int(steps.max()) < 1 << 48 else 8
                    coded = steps.view(np.uint8).reshape(-1, 8)[:, :room].tobytes()
                    ids, places = np.unique(first, return_inverse=True)
                    kind = "<u2" if len(ids) < 1 << 16 else "<u4"
                    columns = [[k], [row["chunk"]], [coded], [room], [ids.tobytes()], [places.astype(kind).tobytes()]]
                    names = ["bucket", "chunk", "keys", "room", "ids", "places"]
                    yield pa.RecordBatch.from_arrays([pa.array(x) for x in columns], names)

    kind = "bucket long, chunk long, keys binary, room long, ids binary, places binary"
    return chunks.select("chunk", "ids", "packed", "size").mapInArrow(run, kind)


def answers(table: pa.Table) -> pa.Table:
    """One bucket of all chunks: for each chunk a bit a hash, set if an earlier document has it."""
    import numpy as np

    keys, firsts, sizes = [], [], []
    for row in table.to_pylist():
        room = row["room"]
        count = len(row["keys"]) // room
        steps = np.zeros((count, 8), np.uint8)
        steps[:, :room] = np.frombuffer(row["keys"], np.uint8).reshape(-1, room)
        keys.append(np.cumsum(steps.reshape(-1).view("<u8"), dtype=np.uint64))
        ids, kind = np.frombuffer(row["ids"], "<i8"), "<u2" if len(row["places"]) == 2 * count else "<u4"
        firsts.append(ids[np.frombuffer(row["places"], kind)])
        sizes.append(count)
    key, first = np.concatenate(keys), np.concatenate(firsts)
    order = np.argsort(key, kind="stable")
    starts = np.flatnonzero(np.concatenate([[True], np.diff(key[order]) != 0]))
    least = np.minimum.reduceat(first[order], starts)
    earlier = np.empty(len(key), bool)
    earlier[order] = np.repeat(least, np.diff(np.append(starts, len(key)))) < first[order]
    parts = np.split(earlier, np.cumsum(sizes)[:-1])
    keep = [i for i, bits in enumerate(parts) if bits.any()]
    return pa.table(
        {
            "chunk": table["chunk"].take(pa.array(keep, pa.int64())),
            "bucket": table["bucket"].take(pa.array(keep, pa.int64())),
            "bits": pa.array([np.packbits(parts[i], bitorder="little").tobytes() for i in keep], pa.binary()),
        }
    )


def remove_repeats(docs: DataFrame, width: int = 13) -> DataFrame:
    """``doc_id``, ``n_words``, ``spans`` (word intervals removed, end exclusive), ``kept`` (words left).

    Words lie between ASCII white space and stay as they are.  A word goes if a window over it is
    also, word for word, in a document with a smaller id; all windows are judged on the input.
    Documents shorter than a window keep all; NULL and empty texts have no words and keep an empty
    text; repeated rows with one id don't count against each other; rows without an id count as
    later than all others and not against each other.  An empty table gives no rows.
    """
    chunks = written(pack(docs), "chunks")
    words = chunks.agg(F.sum("words")).first()[0] or 0
    bits = max(0, (words // BUCKET).bit_length())
    kind = "chunk long, bucket long, bits binary"
    told = buckets(chunks, bits, width).groupBy("bucket").applyInArrow(answers, kind)
    told = checkpoint(told.groupBy("chunk").agg(F.collect_list(F.struct("bucket", "bits")).alias("told")))

    def run(batches):
        import numpy as np

        for batch in batches:
            for row in batch.to_pylist():
                c = Chunk(row["ids"], row["packed"], row["size"], width)
                earlier = np.zeros(len(c.keys), bool)
                for answer in row["told"] or []:
                    low = np.uint64(answer["bucket"] << (64 - bits)) if bits else np.uint64(0)
                    start = int(np.searchsorted(c.keys, low))
                    flags = np.unpackbits(np.frombuffer(answer["bits"], np.uint8), bitorder="little")
                    stop = min(len(c.keys), start + len(flags))
                    earlier[start:stop] |= flags[: stop - start].astype(bool)
                gone = earlier[c.entry] | (c.first[c.entry] < c.ids[c.owner])
                marks = np.zeros(int(c.edges[-1]) + 1, np.int64)
                np.add.at(marks, c.starts[gone], 1)
                np.add.at(marks, c.starts[gone] + width, -1)
                covered = np.cumsum(marks[:-1]) > 0
                ids, counts, spans, kept = [], [], [], []
                for k, own in enumerate(c.words):
                    mask = covered[c.edges[k] : c.edges[k + 1]]
                    turns = np.flatnonzero(np.diff(np.concatenate([[False], mask, [False]]))).reshape(-1, 2)
                    left, at = [], 0
                    for a, b in turns.tolist():
                        left += own[at:a]
                        at = b
                    left += own[at:]
                    ids.append(None if c.ids[k] == _NO_ID else int(c.ids[k]))
                    counts.append(len(own))
                    spans.append([{"start": a, "end": b} for a, b in turns.tolist()])
                    kept.append(b" ".join(left).decode("utf-8", "surrogatepass"))
                span = pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64())]))
                yield pa.RecordBatch.from_arrays(
                    [pa.array(ids, pa.int64()), pa.array(counts, pa.int64()), pa.array(spans, span), pa.array(kept, pa.string())],
                    ["doc_id", "n_words", "spans", "kept"],
                )

    kind = "doc_id long, n_words long, spans array<struct<start: long, end: long>>, kept string"
    return chunks.join(told, "chunk", "left").mapInArrow(run, kind)
