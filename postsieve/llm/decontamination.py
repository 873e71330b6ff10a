"""Benchmark decontamination: rare word seeds, then Smith-Waterman alignment of what they hit.

A seed is a run of an item's words so rare that chance would put it in the corpus less than
``CHANCE`` times, judged by how often each of its words occurs in all documents; the shortest such
run at each position is taken.  An item without any such run is a seed as a whole, so that exact
copies of it are found however common or few its words.  Rarity comes from single words, so a passage that leaked into
thousands of documents still has its seeds.  Every document is scanned for seeds, and the words
around hits are aligned with the item; the alignment's score over the item's length decides.

The benchmark is a stated query set.  It goes to the tasks in blocks of bounded size, and each
block meets all documents; documents are never shuffled or joined.
"""

from __future__ import annotations

from itertools import repeat

import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from postsieve.llm.common import typed

#: Chance hits of a seed in the whole corpus, at most.
CHANCE = 1.0
#: Characters of benchmark text that tasks hold at once.
BLOCK_CHARS = 8_000_000
LONGEST_SEED = 12
_BASE = 0x9E3779B97F4A7C15

_WORD = regex.compile(r"[\p{L}\p{M}\p{N}]+")


def words_of(text: str | None) -> list[str]:
    """Lower-cased runs of letters, marks and digits."""
    return _WORD.findall(text.lower()) if text else []


def align(item, passage):
    """Smith-Waterman over words: score (match 1, mismatch -1, gap -1) and the end of the best.

    Both are integer arrays; negative numbers equal nothing.  Of equal scores the first end wins.
    """
    import numpy as np

    steps = np.arange(1, len(passage) + 1)
    row = np.zeros(len(passage) + 1, np.int32)
    best, end = 0, 0
    for word in item:
        reached = np.maximum(row[:-1] + np.where((passage == word) & (passage >= 0), 1, -1), row[1:] - 1)
        reached = np.maximum(reached, 0)
        # A gap in the item costs 1 a word: the running maximum of score plus position.
        row = np.concatenate([[0], np.maximum.accumulate(reached + steps) - steps])
        k = int(row.argmax())
        if row[k] > best:
            best, end = int(row[k]), k
    return best, end


class Items:
    """A block of items, their vocabulary, and after ``choose_seeds`` their seeds by hash."""

    def __init__(self, rows: list[tuple[int | None, str | None]]):
        import numpy as np

        self.vocabulary: dict[str, int] = {}
        #: Items of the same words are aligned once; ``ids`` lists who they are.
        self.ids, self.items = [], []
        known: dict[bytes, int] = {}
        for key, text in rows:
            words = words_of(text)
            if words:
                numbers = np.array([self.vocabulary.setdefault(w, len(self.vocabulary)) for w in words], np.int64)
                place = known.setdefault(numbers.tobytes(), len(self.items))
                if place == len(self.items):
                    self.items.append(numbers)
                    self.ids.append([])
                self.ids[place].append(key)

    def numbers(self, text: str | None):
        import numpy as np

        return np.fromiter(map(self.vocabulary.get, words_of(text), repeat(-1)), np.int64)

    def choose_seeds(self, counts, total: int) -> None:
        """``counts``: occurrences in the corpus of each word of the vocabulary; ``total``: of all words."""
        import numpy as np

        share = np.log((np.asarray(counts) + 1) / (total + len(counts) + 1))
        room = np.log(CHANCE / max(1, total))
        found: dict[int, list[tuple[int, int, int]]] = {}
        for k, item in enumerate(self.items):
            whole, has_seed = 0, False
            for start in range(len(item)):
                whole = (whole * _BASE + int(item[start]) + 1) % (1 << 64)
                value, chance = 0, 0.0
                for n, word in enumerate(item[start : start + LONGEST_SEED].tolist(), 1):
                    value = (value * _BASE + word + 1) % (1 << 64)
                    chance += share[word]
                    if n >= 2 and chance <= room:
                        found.setdefault(n, []).append((value, k, start))
                        has_seed = True
                        break
            if not has_seed:
                found.setdefault(len(item), []).append((whole, k, 0))
        self.seeds = {}
        for n, rows in found.items():
            rows.sort()
            values = np.array([r[0] for r in rows], np.uint64)
            self.seeds[n] = (values, np.array([r[1] for r in rows]), np.array([r[2] for r in rows]))

    def hits(self, numbers):
        """Arrays ``(position, item, position in item)`` of all seeds in ``numbers``."""
        import numpy as np

        position, item, at = [], [], []
        starts = np.flatnonzero(numbers >= 0)
        value = numbers[starts].astype(np.uint64) + np.uint64(1)
        for n in range(1, max(self.seeds, default=0) + 1):
            if n > 1:
                inside = starts + n - 1 < len(numbers)
                starts, value = starts[inside], value[inside]
                following = numbers[starts + n - 1]
                known = following >= 0
                starts, following = starts[known], following[known]
                value = value[known] * np.uint64(_BASE) + following.astype(np.uint64) + np.uint64(1)
            if n in self.seeds:
                values, items, places = self.seeds[n]
                low, high = np.searchsorted(values, value), np.searchsorted(values, value, "right")
                for k in np.flatnonzero(high > low):
                    for s in range(low[k], high[k]):
                        position.append(starts[k])
                        item.append(items[s])
                        at.append(places[s])
        return np.array(position, np.int64), np.array(item, np.int64), np.array(at, np.int64)

    def passages(self, numbers, hits, least: float, cache: dict):
        """``(item index, score, first word, words)``: the best alignment with each item hit."""
        import numpy as np

        position, item, at = hits
        best: dict[int, tuple[float, int, int]] = {}
        origin = position - at
        order = np.lexsort((origin, item))
        first = 0
        while first < len(order):
            k = item[order[first]]
            size, last = len(self.items[k]), first
            while (
                last + 1 < len(order)
                and item[order[last + 1]] == k
                and origin[order[last + 1]] - origin[order[last]] <= size
            ):
                last += 1
            start = max(0, int(origin[order[first]]) - size // 2)
            passage = numbers[start : int(origin[order[last]]) + size + size // 2]
            key = (int(k), passage.tobytes())
            if key not in cache:
                if len(cache) > 5000:
                    cache.clear()
                score, end = align(self.items[k], passage)
                score, length = score / size, 0
                if score >= least:
                    length = align(self.items[k][::-1], passage[:end][::-1])[1]
                cache[key] = (score, end, length)
            score, end, length = cache[key]
            if score >= least and (k not in best or score > best[k][0]):
                best[k] = (score, start + end - length, length)
            first = last + 1
        return [(int(k), *found) for k, found in sorted(best.items())]


class Scanner:
    """Finds the items in texts, a batch at a time."""

    def __init__(self, items: Items, least: float):
        self.items, self.least, self.cache = items, least, {}

    def scan(self, texts):
        """For each text the list of its passages."""
        import numpy as np

        texts = [self.items.numbers(t) for t in texts]
        # One scan for all: between texts stands a number that belongs to no word.
        edges = np.cumsum([0] + [len(t) + 1 for t in texts])
        joined = np.full(int(edges[-1]), -1, np.int64)
        for start, numbers in zip(edges, texts):
            joined[start : start + len(numbers)] = numbers
        position, item, at = self.items.hits(joined)
        row = np.searchsorted(edges, position, "right") - 1
        found = [[] for _ in texts]
        for r in np.unique(row):
            own = row == r
            hits = (position[own] - edges[r], item[own], at[own])
            found[r] = self.items.passages(texts[r], hits, self.least, self.cache)
        return found


def _blocks(docs: DataFrame, benchmark: DataFrame):
    """Blocks of items with their seeds chosen from word counts over all ``docs``."""
    import numpy as np

    items = typed(benchmark, item_id="long", text="string").where("text IS NOT NULL")
    size = items.agg(F.sum(F.length("text"))).first()[0] or 0
    count = -(-size // BLOCK_CHARS)
    for k in range(count):
        block = items.where(F.pmod(F.xxhash64("item_id", "text"), F.lit(count)) == k)
        rows = sorted((tuple(r) for r in block.collect()), key=lambda r: (r[0] is None, r[0] or 0, r[1]))
        chosen = Items(rows)
        if not chosen.items:
            continue
        shared = docs.sparkSession.sparkContext.broadcast(chosen)

        def occurrences(batches, shared=shared):
            own = shared.value
            totals, every = np.zeros(len(own.vocabulary), np.int64), 0
            for batch in batches:
                for text in batch.column(0):
                    numbers = own.numbers(text.as_py())
                    every += len(numbers)
                    totals += np.bincount(numbers[numbers >= 0], minlength=len(totals))
            used = np.flatnonzero(totals)
            yield pa.RecordBatch.from_arrays(
                [pa.array([-1, *used], pa.int64()), pa.array([every, *totals[used]], pa.int64())], ["word", "n"]
            )

        counted = typed(docs, text="string").mapInArrow(occurrences, "word long, n long")
        # One row for each word of the block at most.
        found = {r["word"]: r["n"] for r in counted.groupBy("word").agg(F.sum("n").alias("n")).collect()}
        chosen.choose_seeds([found.get(i, 0) for i in range(len(chosen.vocabulary))], found.get(-1, 0))
        yield docs.sparkSession.sparkContext.broadcast(chosen)


def contaminated(docs: DataFrame, benchmark: DataFrame, least: float = 0.5) -> DataFrame:
    """``doc_id``, ``item_id``, ``score``, ``first_word``, ``n_words`` of each item in each document.

    ``score`` is the best local alignment over the item's words (1: an exact copy), ``least`` or
    more; ``first_word`` and ``n_words`` say where it lies in the document's words.  Of equal
    alignments the first counts.  NULL and empty texts on either side match nothing; equal items
    and repeated rows are all reported; ids may be NULL; empty tables give no rows.  Of an item whose
    words are all so common that no run of twelve is rare, or that is a single word, exact copies are
    found, edited ones not; an item of one common word is thus found wherever that word stands.
    """
    kind = "doc_id long, item_id long, score double, first_word long, n_words long"
    found = None
    for shared in _blocks(docs, benchmark):

        def run(batches, shared=shared):
            scanner = Scanner(shared.value, least)
            for batch in batches:
                rows = []
                ids = batch.column(0)
                for k, passages in enumerate(scanner.scan(batch.column(1).to_pylist())):
                    for item, score, first, length in passages:
                        for name in scanner.items.ids[item]:
                            rows.append((ids[k].as_py(), name, score, first, length))
                columns = list(zip(*rows)) or [[]] * 5
                kinds = [pa.int64(), pa.int64(), pa.float64(), pa.int64(), pa.int64()]
                yield pa.RecordBatch.from_arrays(
                    [pa.array(c, t) for c, t in zip(columns, kinds)],
                    ["doc_id", "item_id", "score", "first_word", "n_words"],
                )

        part = typed(docs, doc_id="long", text="string").mapInArrow(run, kind)
        found = part if found is None else found.unionByName(part)
    return docs.sparkSession.createDataFrame([], kind) if found is None else found


def keep_clean(docs: DataFrame, benchmark: DataFrame, least: float = 0.5) -> DataFrame:
    """The rows of ``docs``, all columns as they are, in whose text no item is found."""
    place = docs.columns.index("text")
    for shared in _blocks(docs, benchmark):

        def run(batches, shared=shared):
            scanner = Scanner(shared.value, least)
            for batch in batches:
                found = scanner.scan(batch.column(place).to_pylist())
                yield batch.filter(pa.array([not f for f in found], pa.bool_()))

        docs = docs.mapInArrow(run, docs.schema)
    return docs
