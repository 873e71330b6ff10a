"""Periodic runs of words: suffix classes united by falling LCP over ordered position sets.

A run of period ``q`` is a stretch in which words ``q`` apart are identical, ``q`` is the smallest
such number and no neighbouring word extends it; it counts from ``least`` words and ``times``
periods on.  If a run starts at ``i``, suffixes ``i`` and ``i + q`` agree on its length less ``q``
words, and no suffix between the two agrees with them as far (that would be a smaller period).

So the suffixes of a document are sorted, neighbours are joined in the order of their falling LCP
(Kruskal), and each class keeps its positions in order: a small class is put into a large one, and
positions that become adjacent at a distance within the LCP seed a run.  The seed whose previous
words differ is the run's start, its distance the period, distance and LCP together the length.

A run's seed agrees on ``reach`` words at least (16 for 24 words and three periods).  Only windows
of that many words which their own document repeats are sorted and united; equal windows have equal
hashes, so none is missed, and classes are made of the words themselves.
"""

from __future__ import annotations

from bisect import bisect_left, insort

import pyarrow as pa
from pyspark.sql import DataFrame

from postsieve.llm.common import typed
from postsieve.llm.substrings import rolling

#: Words worked on together; a longer document is taken alone.
BLOCK = 1 << 20


class _Numbers(dict):
    """Consecutive numbers of words."""

    def __missing__(self, word):
        value = self[word] = len(self)
        return value


def reach(least: int, times: int) -> int:
    """The fewest words on which the suffixes at a run's start and one period on agree."""
    return min(max(least - q, (times - 1) * q) for q in range(1, least + 1))


def spread_bits(x):
    """A one-to-one mixing of 64-bit numbers."""
    import numpy as np

    x = x.astype(np.uint64) + np.uint64(0x9E3779B97F4A7C15)
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def repeated_windows(words, edges, width: int):
    """Starts of the windows that occur again in their document (some others by chance)."""
    import numpy as np

    lengths = np.diff(edges)
    counts = np.maximum(0, lengths - width + 1)
    if not counts.any():
        return np.zeros(0, np.int64)
    owner = np.repeat(np.arange(len(lengths)), counts)
    starts = np.arange(len(owner)) + np.repeat(edges[:-1] - np.cumsum(counts) + counts, counts)
    keys = rolling(spread_bits(words), width)[starts] ^ spread_bits(owner)
    order = np.argsort(keys)
    same = keys[order[1:]] == keys[order[:-1]]
    twice = np.zeros(len(keys), bool)
    twice[order[1:][same]] = True
    twice[order[:-1][same]] = True
    return starts[twice]


def suffix_order(text):
    """(order of the suffixes of ``text``, ranks by their first 1, 2, 4 ... numbers).

    Equal ranks of a level mean equal windows.  Every suffix differs from all others before it ends.
    Only suffixes that aren't told apart yet are ranked further.
    """
    import numpy as np

    n = len(text)
    order = np.argsort(text, kind="stable")
    new = np.concatenate([[True], text[order[1:]] != text[order[:-1]]])
    rank = np.empty(n, np.int64)
    rank[order] = np.maximum.accumulate(np.where(new, np.arange(n), 0))
    levels, size = [rank.astype(np.int32)], 1
    # Suffixes in the order of their ranks, without those whose rank is theirs alone.
    open_ = order[~(new & np.append(new[1:], True))]
    while len(open_):
        after = rank[np.minimum(open_ + size, n - 1)]
        by = np.lexsort((after, rank[open_]))
        open_, after = open_[by], after[by]
        group = rank[open_]
        first = np.concatenate([[True], group[1:] != group[:-1]])
        new = first | np.concatenate([[True], after[1:] != after[:-1]])
        index = np.arange(len(open_))
        inside = np.maximum.accumulate(np.where(new, index, 0)) - np.maximum.accumulate(np.where(first, index, 0))
        rank = rank.copy()
        rank[open_] = group + inside
        open_ = open_[~(new & np.append(new[1:], True))]
        size *= 2
        levels.append(rank.astype(np.int32))
    order = np.empty(n, np.int64)
    order[rank] = np.arange(n)
    return order, levels


def common_lengths(levels, a, b):
    """How many numbers the suffixes ``a`` and ``b`` share, from the ranks of windows by doubling."""
    import numpy as np

    shared = np.zeros(len(a), np.int64)
    last = len(levels[0]) - 1
    for k in range(len(levels) - 1, -1, -1):
        rank = levels[k]
        equal = rank[np.minimum(a + shared, last)] == rank[np.minimum(b + shared, last)]
        shared += equal.astype(np.int64) << k
    return shared


def adjacent_pairs(a, b, shared, least: int, times: int):
    """Kruskal over the links ``a``-``b`` of positions, in the order of falling ``shared``.

    Gives (left, right, shared) of the positions that become neighbours in a class and are close
    and alike enough for a run.
    """
    parent, members, seeds = {}, {}, []

    def top(x):
        while parent[x] != x:
            parent[x] = x = parent[parent[x]]
        return x

    for x in {*a, *b}:
        parent[x], members[x] = x, [x]
    for x, y, agreed in zip(a, b, shared):
        x, y = top(x), top(y)
        if len(members[x]) < len(members[y]):
            x, y = y, x
        parent[y] = x
        large, small = members[x], members.pop(y)
        most = agreed // (times - 1)
        for i, at in enumerate(small):
            k = bisect_left(large, at)
            # Neighbours of the same class before are not new.
            if k:
                left = large[k - 1]
                if at - left <= most and (i == 0 or small[i - 1] < left):
                    seeds.append((left, at, agreed))
            if k < len(large):
                right = large[k]
                if right - at <= most and (i + 1 == len(small) or right < small[i + 1]):
                    seeds.append((at, right, agreed))
        if len(small) * 16 < len(large) + 128:
            for at in small:
                insort(large, at)
        else:
            members[x] = sorted(large + small)
    return [s for s in seeds if s[1] - s[0] + s[2] >= least]


def find_runs(words, edges, least: int = 24, times: int = 3):
    """Runs of the documents ``words[edges[k]:edges[k + 1]]``: arrays of place, length and period,
    by place and period; ``words`` are numbers and places count from the first word of all."""
    import numpy as np

    nothing = np.zeros((0, 3), np.int64)
    width = reach(least, times)
    starts = repeated_windows(words, edges, width)
    if not len(starts):
        return nothing
    # The text that suffixes at these windows can agree on, and the word after it.
    owner = np.repeat(np.arange(len(edges) - 1), np.diff(edges))
    turns = np.zeros(len(words) + 1, np.int64)
    np.add.at(turns, starts, 1)
    np.add.at(turns, np.minimum(starts + width + 1, edges[owner[starts] + 1]), -1)
    kept = np.flatnonzero(np.cumsum(turns[:-1]))
    last = np.concatenate([(np.diff(kept) > 1) | (np.diff(owner[kept]) > 0), [True]])
    # Stretches lie one after another, each with an end of its own that equals nothing else.
    gap = np.cumsum(last) - last
    text = np.empty(len(kept) + int(last.sum()), np.int64)
    place = np.full(len(text), -1, np.int64)
    slot = np.arange(len(kept)) + gap
    # A word is told apart from the same word of another document.
    pairs = owner[kept] * (int(words.max()) + 1) + words[kept]
    text[slot], place[slot] = np.unique(pairs, return_inverse=True)[1], kept
    text[slot[last] + 1] = len(kept) + np.arange(int(last.sum()))
    order, levels = suffix_order(text)
    a, b = order[:-1], order[1:]
    coarse = levels[min(len(levels) - 1, width.bit_length() - 1)]
    near = coarse[a] == coarse[b]
    a, b = a[near], b[near]
    shared = common_lengths(levels, a, b)
    by = np.argsort(-shared, kind="stable")
    by = by[shared[by] >= width]
    seeds = adjacent_pairs(place[a[by]].tolist(), place[b[by]].tolist(), shared[by].tolist(), least, times)
    if not seeds:
        return nothing
    left, right, agreed = np.array(seeds, np.int64).T
    before = np.maximum(left - 1, 0)
    leftmost = (left == edges[owner[left]]) | (words[before] != words[np.maximum(right - 1, 0)])
    found = np.stack([left, right - left + agreed, right - left], 1)[leftmost]
    return found[np.lexsort((found[:, 2], found[:, 0]))]


def periodic_runs(docs: DataFrame, least: int = 24, times: int = 3) -> DataFrame:
    """``doc_id``, ``n_words``, ``runs`` (start, length, period by start, then period) and
    ``collapsed`` of every row of ``docs``.

    Words lie between ASCII white space and stay as they are; they are numbered from 0.
    ``collapsed`` are the words that no run contains after its first period, joined by one blank.
    NULL and empty texts have no words, no runs and an empty text.  Repeated rows and rows without
    an id are answered each for themselves; other columns are not read; an empty table gives no
    rows.  ``times`` must be 2 or more.  A document is worked on in one task; memory grows with the
    longest document, not with their number.
    """
    if times < 2 or least < 2:
        raise ValueError("a run repeats at least once")

    def answer(keys, texts):
        import numpy as np

        edges = np.concatenate([[0], np.cumsum([len(t) for t in texts])]).astype(np.int64)
        numbers = _Numbers()
        words = np.fromiter((numbers[w] for t in texts for w in t), np.int64, int(edges[-1]))
        found = find_runs(words, edges, least, times)
        whose = np.searchsorted(edges, found[:, 0], "right") - 1
        cuts = np.searchsorted(whose, np.arange(len(texts) + 1))
        runs, left = [], []
        for k, own in enumerate(texts):
            mine = [(s - int(edges[k]), n, q) for s, n, q in found[cuts[k] : cuts[k + 1]].tolist()]
            runs.append([{"start": s, "length": n, "period": q} for s, n, q in mine])
            if mine:
                gone = np.zeros(len(own) + 1, np.int64)
                for s, n, q in mine:
                    gone[s + q] += 1
                    gone[s + n] -= 1
                own = [own[i] for i in np.flatnonzero(np.cumsum(gone[:-1]) == 0).tolist()]
            left.append(b" ".join(own))
        run = pa.struct([("start", pa.int64()), ("length", pa.int64()), ("period", pa.int64())])
        return pa.RecordBatch.from_arrays(
            [pa.array(keys, pa.int64()), pa.array(np.diff(edges)), pa.array(runs, pa.list_(run)), pa.array(left, pa.binary())],
            ["doc_id", "n_words", "runs", "collapsed"],
        )

    def run(batches):
        keys, texts, size = [], [], 0
        for batch in batches:
            for key, text in zip(batch.column(0).to_pylist(), batch.column(1)):
                words = (text.as_py() or b"").split()
                if keys and size + len(words) > BLOCK:
                    yield answer(keys, texts)
                    keys, texts, size = [], [], 0
                keys.append(key)
                texts.append(words)
                size += len(words)
        if keys:
            yield answer(keys, texts)

    kind = "doc_id long, n_words long, runs array<struct<start: long, length: long, period: long>>, collapsed binary"
    found = typed(docs, doc_id="long", text="binary").mapInArrow(run, kind)
    return found.withColumn("collapsed", found["collapsed"].cast("string"))
