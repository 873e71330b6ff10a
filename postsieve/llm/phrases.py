"""Phrases by set-oriented mining (SETM): occurrence relations joined by piece and adjacent position.

The relation of length ``k`` lists which group (word sequence) stands at each place of each piece,
in the order of the places.  It is stored in chunks of about ``CHUNK`` bytes of text: an array of
the chunk's own group numbers, with marks between pieces, and a table of these groups.  A length is

1. counted: every chunk gives its groups with their counts, and Spark sums them over all chunks;
2. cut to the frequent groups, by a semi-join of the chunks' groups with the counted ones; places of
   other groups become gaps, and the relation is stored anew;
3. extended: the relation is merge-joined with itself by piece and adjacent position.  Both sides
   are sorted alike, so the join is a walk along the array; a place goes on only if the groups at
   it and at the next place are frequent, since a phrase is never more frequent than its parts.

A group that is frequent within its chunk needs no join.  For the others a chunk asks a Bloom filter
of the counted groups, up to ``FILTER`` of them (64 MB), and a shuffled semi-join beyond.  The few
groups a filter lets through wrongly change nothing: only counted groups become phrases.

Chunks are stored as checkpoints, which are read row by row: their values are large, and a columnar
reader would hold many at once.  Words are strings for the first length alone; then 64-bit hashes
stand for the frequent words, after a check that no two of these share one (else all is hashed anew
with another seed).
"""

from __future__ import annotations

import itertools
from functools import reduce

import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from postsieve.llm.common import checkpoint, typed, written
from postsieve.llm.periodic_runs import _Numbers, spread_bits

#: Bytes of text in a chunk; texts are cut between pieces, a longer piece is a chunk of its own.
CHUNK = 8_000_000
#: Rows of groups handed over at once.
ROWS = 1 << 15
#: Groups in a Bloom filter at most, of 16 bits or more each.
FILTER = 1 << 25
#: Rows one task ranks, about.
RANKED = 200_000
#: No UTF-8 text holds this byte: it marks the end of a piece.
_MARK = b"\xff"
#: ASCII letters in lower case, and what ends a piece.
_TABLE = bytes(0xFF if chr(b) in ".,;:!?\n\v\f\r" else b + 32 if 65 <= b <= 90 else b for b in range(256))



def _zip(data: bytes) -> bytes:
    return pa.Codec("zstd", 1).compress(data, asbytes=True)


def _unzip(row: dict, name: str) -> bytes:
    return pa.decompress(row[name], row[f"{name}_size"], codec="zstd", asbytes=True)


def _batch(names: str, columns: list) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([c if isinstance(c, pa.Array) else pa.array(c) for c in columns], names.split())


def pieces_of(text: bytes) -> list[bytes]:
    """``text`` with its pieces marked, cut between pieces into parts of about ``CHUNK`` bytes."""
    text, parts, start = text.translate(_TABLE), [], 0
    while len(text) - start > CHUNK:
        end = text.find(_MARK, start + CHUNK)
        if end < 0:
            break
        parts.append(text[start:end])
        start = end + 1
    return [*parts, text[start:]]


class _Held:
    """Texts of one language on their way into a chunk: the numbers of their words, 0 for a mark."""

    def __init__(self):
        self.numbers, self.arrays, self.size = _Numbers({_MARK: 0}), [], 0

    def add(self, part: bytes) -> None:
        import numpy as np

        tokens = part.replace(_MARK, b" \xff ").split()
        self.arrays.append(np.fromiter(map(self.numbers.__getitem__, tokens), np.int32, len(tokens)))
        self.arrays.append(np.zeros(1, np.int32))
        self.size += len(part) + 1

    def row(self, number: int, lang: str) -> pa.RecordBatch:
        import numpy as np

        relation = (np.concatenate(self.arrays) - 1).astype("<i4").tobytes()
        words = b"\n".join(list(self.numbers)[1:])
        names = "chunk lang n_words relation relation_size words words_size"
        n_words = sum(int((a > 0).sum()) for a in self.arrays)
        rest = [[n_words], [_zip(relation)], [len(relation)], [_zip(words)], [len(words)]]
        return _batch(names, [[number], pa.array([lang], pa.string()), *rest])


def word_relation(docs: DataFrame) -> DataFrame:
    """Chunks of the words of one language each: the relation, and the words it counts on."""

    def run(batches):
        from pyspark import TaskContext

        number, held, total = TaskContext.get().partitionId() << 32, {}, 0
        for batch in batches:
            for lang, text in zip(batch.column(0).to_pylist(), batch.column(1)):
                for part in pieces_of(text.as_py() or b""):
                    held.setdefault(lang, _Held()).add(part)
                    total += len(part) + 1
                    # Many languages share a task's memory: the largest goes first.
                    most = max(held, key=lambda x: held[x].size) if total > 4 * CHUNK else lang
                    if most != lang or held[most].size >= CHUNK:
                        full = held.pop(most)
                        total -= full.size
                        yield full.row(number, most)
                        number += 1
        for lang, rest in held.items():
            yield rest.row(number, lang)
            number += 1

    kind = "chunk long, lang string, n_words long, relation binary, relation_size long, words binary, words_size long"
    return typed(docs, lang="string", text="binary").mapInArrow(run, kind)


def _rows(batches):
    """The rows of batches, one at a time: their values are large."""
    for batch in batches:
        for i in range(batch.num_rows):
            yield batch.slice(i, 1).to_pylist()[0]


def _relation(row: dict, length: int, seed: int):
    """(groups by place, -1 for none; the counts of the groups; their words, a hash each)."""
    import numpy as np
    import xxhash

    relation = np.frombuffer(_unzip(row, "relation"), "<i4")
    if length == 1:
        words = _unzip(row, "words").split(b"\n")
        front = (row["lang"] or "").encode("utf-8", "surrogatepass") + b"\n"
        table = np.array([[xxhash.xxh64_intdigest(front + w, seed) for w in words]], np.uint64).view(np.int64)
        counts = np.bincount(relation + 1, minlength=len(words) + 1)[1:]
        # Without any word the list of words holds an empty one.
        return relation, counts[counts > 0], table[:, counts > 0]
    table = np.frombuffer(row["table"], "<i8").reshape(length - 1, -1)
    left, right = relation[:-1], relation[1:]
    goes_on = (left >= 0) & (right >= 0)
    pairs = left[goes_on].astype(np.int64) * table.shape[1] + right[goes_on]
    found, slots, counts = np.unique(pairs, return_inverse=True, return_counts=True)
    longer = np.full(max(0, len(relation) - 1), -1, np.int32)
    longer[goes_on] = slots
    first, last = np.divmod(found, max(1, table.shape[1]))
    return longer, counts, np.concatenate([table[:, first], table[-1:, last]])


def groups_of(chunks: DataFrame, length: int, seed: int) -> DataFrame:
    """A row for each group of each chunk: ``chunk``, ``slot`` (its number there), ``n`` and its words
    ``w1``, ``w2`` ...; for single words ``lang`` and ``word`` too."""
    names = [f"w{i + 1}" for i in range(length)]

    def run(batches):
        import numpy as np

        for row in _rows(batches):
            _, counts, table = _relation(row, length, seed)
            if len(counts):
                columns = [np.full(len(counts), row["chunk"]), np.arange(len(counts)), counts.astype(np.int32), *table]
                found = _batch(" ".join(["chunk slot n", *names]), columns)
                if length == 1:
                    words, same = _unzip(row, "words").split(b"\n"), [row["lang"]] * len(counts)
                    found = found.append_column("lang", pa.array(same, pa.string())).append_column("word", pa.array(words, pa.binary()))
                for first in range(0, found.num_rows, ROWS):
                    yield found.slice(first, ROWS)

    kind = "chunk long, slot long, n int, " + ", ".join(f"{w} long" for w in names)
    return chunks.mapInArrow(run, kind + (", lang string, word binary" if length == 1 else ""))


def frequent(groups: DataFrame, by: list[str], least: int, name: str) -> DataFrame:
    """The groups that occur ``least`` times over all chunks, with their count ``a``, stored."""
    return written(groups.groupBy(*by).agg(F.sum("n").alias("a")).where(F.col("a") >= least), name)


def _places(table, size: int):
    """Three places of each group in a filter of ``size`` bits, a power of two."""
    import numpy as np

    mixed = spread_bits(table[0])
    for column in table[1:]:
        mixed = spread_bits(mixed ^ column.astype(np.uint64))
    return [(mixed >> np.uint64(shift) & np.uint64(size - 1)).astype(np.int64) for shift in (0, 17, 34)]


def bloom_filter(counted: DataFrame, length: int):
    """The counted groups as a filter (bytes), or None if they are more than ``FILTER``."""
    import numpy as np

    count = counted.count()
    if count > FILTER:
        return None
    size = 1 << max(10, (16 * count).bit_length())

    def run(batches):
        for batch in batches:
            table = [c.to_numpy().view(np.uint64) for c in batch.columns]
            yield _batch("places", [[np.concatenate(_places(table, size)).astype("<i4").tobytes()]])

    names, bits = [f"w{i + 1}" for i in range(length)], np.zeros(size // 8, np.uint8)
    for row in counted.select(*names).mapInArrow(run, "places binary").toLocalIterator():
        at = np.frombuffer(row["places"], "<i4")
        np.bitwise_or.at(bits, at >> 3, np.uint8(128) >> (at & 7).astype(np.uint8))
    return bits.tobytes()


def told(groups: DataFrame, counted: DataFrame, by: list[str], least: int) -> DataFrame:
    """The frequent groups of each chunk that it can't tell by itself: a list its own table bounds."""
    found = groups.where(F.col("n") < least).join(counted.select(*by), by, "left_semi")
    return found.groupBy("chunk").agg(F.collect_list("slot").alias("told"))


def pruned(chunks: DataFrame, groups: DataFrame, counted: DataFrame, by: list[str], length: int, least: int, seed: int) -> DataFrame:
    """The relation with gaps for all groups that aren't frequent."""
    context = chunks.sparkSession.sparkContext
    bits = bloom_filter(counted, length)
    shared = None if bits is None else context.broadcast(bits)
    if shared is None:
        chunks = chunks.join(told(groups, counted, by, least), "chunk", "left")

    def run(batches):
        import numpy as np

        for row in _rows(batches):
            relation, counts, table = _relation(row, length, seed)
            keeps = counts >= least
            if shared is not None:
                held = np.frombuffer(shared.value, np.uint8)
                ones = [held[at >> 3] >> (7 - (at & 7)).astype(np.uint8) & 1 for at in _places(table.view(np.uint64), len(held) * 8)]
                keeps |= (ones[0] & ones[1] & ones[2]).astype(bool)
            elif row["told"]:
                keeps[row["told"]] = True
            number = np.append(np.where(keeps, np.cumsum(keeps) - 1, -1), -1).astype("<i4")
            data, words = number[relation].tobytes(), table[:, keeps].astype("<i8").tobytes()
            yield _batch("chunk relation relation_size table", [[row["chunk"]], [_zip(data)], [len(data)], [words]])

    return chunks.mapInArrow(run, "chunk long, relation binary, relation_size long, table binary")


def parted(counted: DataFrame, shorter: DataFrame, length: int) -> DataFrame:
    """Groups with their words and the counts of their first and last parts, by the length of the part."""
    by = [f"w{i + 1}" for i in range(length)]
    first = shorter.select(
        *by[:-1], "lang", F.col("words").alias("front"), F.concat("firsts", F.array("a")).alias("firsts")
    )
    last = shorter.select(
        *[F.col(old).alias(new) for old, new in zip(by, by[1:])],
        F.slice("words", -1, 1).alias("back"), F.concat("lasts", F.array("a")).alias("lasts"),
    )
    rows = counted.join(first, by[:-1]).join(last, by[1:])
    return rows.select(*by, "lang", F.concat("front", "back").alias("words"), "a", "firsts", "lasts")


def lowest_cut(scale: int = 1_000_000):
    """``score``, ``k``, ``l``, ``r`` of a group's lowest-scoring cut, ties to the shortest first part."""
    def exact(c):
        return c.cast("decimal(19,0)")

    def cut(l, k):
        r = F.get("lasts", F.size("lasts") - 1 - k)
        # Numbers of up to 38 digits; a quotient is never over ``scale``.
        score = F.call_function("div", exact(F.col("a")) * exact(F.col("a")) * F.lit(scale).cast("decimal(19,0)"), exact(l) * exact(r))
        return F.struct(score.alias("score"), k.alias("k"), l.alias("l"), r.alias("r"))

    return F.array_min(F.transform("firsts", cut))


def first_rows(rows: DataFrame, group: str, order: list, count: int) -> DataFrame:
    """The first ``count`` rows of each group with their ``rank``.

    A group is dealt into parts of about ``RANKED`` rows by hash, each part keeps its first ones, and
    so on until a group's rows are few: no task sees a group whole, however large.
    """
    while True:
        sizes = rows.groupBy(group).count().agg(F.max("count")).first()[0] or 0
        parts = -(-sizes // RANKED)
        window = Window.partitionBy(group, *(["part"] if parts > 1 else [])).orderBy(*order)
        dealt = rows.withColumn("part", F.pmod(F.xxhash64("words"), F.lit(max(1, parts))))
        kept = dealt.withColumn("rank", F.row_number().over(window)).where(F.col("rank") <= count)
        if parts <= 1:
            return kept.drop("part")
        smaller = checkpoint(kept.drop("part", "rank"))
        if parts * count >= sizes:  # parts this small can't shrink further
            window = Window.partitionBy(group).orderBy(*order)
            return smaller.withColumn("rank", F.row_number().over(window)).where(F.col("rank") <= count)
        rows = smaller


def mine_phrases(docs: DataFrame, longest: int = 3, least: int = 10, inside: int = 50, count: int = 2000) -> DataFrame:
    """The first ``count`` phrases of each language: ``lang``, ``rank``, ``words`` (UTF-8 bytes), ``a``,
    ``k`` (words before the cut), ``l``, ``r``, ``n``, ``score``.

    ASCII letters are lower-cased; texts are cut into pieces at ``.,;:!?`` and line ends, and those
    into words at blanks and tabs.  A phrase has 2 to ``longest`` words of one piece and occurs
    ``least`` times (``a``, overlaps included) in its language (``lang``; NULL is ``und``), which has
    ``n`` words.  A cut into a first and a last part, which occur ``l`` and ``r`` times, scores
    ``a * a / (l * r)`` in millionths; a phrase has its lowest cut's score.  A phrase goes if one that
    contains it occurs ``inside`` percent as often or more.  Phrases are ordered by score and ``a``,
    falling, then by their words joined by blanks, as bytes.

    NULL and empty texts have no words; repeated rows count each; ``doc_id`` and other columns are
    not read; an empty table gives no rows.
    """
    if longest < 2:
        raise ValueError("a phrase has two words at least")
    rows = docs.select(F.coalesce(docs["lang"].cast("string"), F.lit("und")).alias("lang"), docs["text"].alias("text"))
    by = ["lang", "word", "w1"]
    chunks = checkpoint(word_relation(rows))
    totals = chunks.groupBy("lang").agg(F.sum("n_words").alias("n"))
    for seed in itertools.count():
        groups = groups_of(chunks, 1, seed)
        counted = frequent(groups, by, least, "frequent-1")
        if counted.groupBy("w1").count().where("count > 1").isEmpty():
            break
    nothing = F.array().cast("array<bigint>")
    shorter = counted.select("w1", "lang", F.array("word").alias("words"), "a", nothing.alias("firsts"), nothing.alias("lasts"))
    candidates = []
    for length in range(2, longest + 1):
        chunks = checkpoint(pruned(chunks, groups, counted, by, length - 1, least, seed))
        groups, by = groups_of(chunks, length, seed), [f"w{i + 1}" for i in range(length)]
        counted = frequent(groups, by, least, f"frequent-{length}")
        longer = written(parted(counted, shorter, length), f"phrases-{length}")
        if length > 2:
            candidates.append(_outermost(shorter, longer, length, inside))
        shorter = longer
    columns = ["lang", "words", "a", "firsts", "lasts"]
    candidates = reduce(DataFrame.unionByName, [c.select(*columns) for c in [*candidates, shorter]])
    scored = candidates.withColumn("cut", lowest_cut()).withColumn("cut", F.struct("cut.score", (F.col("cut.k") + 1).alias("k"), "cut.l", "cut.r"))
    scored = scored.select("lang", _joined("words").alias("words"), "a", "cut.*")
    order = [F.desc("score"), F.desc("a"), F.asc("words")]
    best = first_rows(checkpoint(scored), "lang", order, count)
    columns = ["lang", F.col("rank").cast("long").alias("rank"), "words", "a", "k", "l", "r", "n", "score"]
    return best.join(totals, "lang").select(*columns)


def _joined(words: str):
    """Words joined by blanks, as bytes."""
    return F.reduce(
        F.slice(words, 2, F.greatest(F.size(words) - 1, F.lit(0))), F.get(words, 0),
        lambda text, word: F.concat(text, F.lit(" ").cast("binary"), word),
    )


def _outermost(shorter: DataFrame, longer: DataFrame, length: int, inside: int) -> DataFrame:
    """``shorter`` without the phrases inside one of ``length`` words that occurs ``inside`` percent as often.

    A still longer phrase occurs no more often than one a word longer, so that length decides.
    """
    by = [f"w{i + 1}" for i in range(length)]
    halves = F.array(*[F.struct(*[F.col(w).alias(name) for name, w in zip(by, part)]) for part in (by[:-1], by[1:])])
    parts = longer.select(F.explode(halves).alias("part"), F.col("a").alias("around"))
    most = parts.groupBy(*[F.col(f"part.{w}").alias(w) for w in by[:-1]]).agg(F.max("around").alias("around"))
    rows = shorter.join(most, by[:-1], "left")
    gone = F.col("around").cast("decimal(19,0)") * 100 >= F.col("a").cast("decimal(19,0)") * inside
    return rows.where(~F.coalesce(gone, F.lit(False)))
