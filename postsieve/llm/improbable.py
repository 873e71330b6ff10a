"""Document fingerprints of statistically improbable features (Roussev's similarity digests).

1. Every window of ``width`` bytes has an entropy; counts over the whole corpus say how rare each
   entropy is, and the rarer a window's entropy, the earlier it ranks.
2. A sliding span of ``span`` windows gives a point to its first-ranking window (the leftmost of
   equals).  Windows with ``popular`` points are features.
3. Features are hashed into a chain of Bloom filters of 2048 bits, 160 features each, five bits a
   feature; each feature of a document counts once, in the order of its first place.
4. Two chains are compared by the bits their filters share, as a share of the bits they could share
   beyond those expected by chance.

Entropies are sums of whole numbers, so equal windows rank equally wherever they stand.  Sums are
slid: a window's counts change by the byte that leaves and the one that enters, and how often each
occurs in the window is counted for all places at once, one comparison a distance.
"""

from __future__ import annotations

import base64
import math

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from postsieve.llm.common import typed
from postsieve.llm.periodic_runs import spread_bits

#: Bits of a filter, features it holds, bits a feature sets.
BITS, FEATURES, HASHES = 2048, 160, 5
#: Entropies are told apart in so many steps.
STEPS = 1000
#: A text with fewer features takes less popular windows too.
FEW = 16
#: Share of the possible overlap beyond chance that is still taken for chance.
NOISE = 0.1
#: Bytes worked on at once.
BLOCK = 1 << 18
_PLACES = 20  # bits of a place in a block


def entropy_steps(data, width: int):
    """For every window of the bytes ``data`` its entropy in steps from 0 to ``STEPS``."""
    import numpy as np

    n = len(data) - width + 1
    if n <= 0:
        return np.zeros(0, np.int32)
    weight = np.array([round(c * math.log2(c) * 65536) if c else 0 for c in range(width + 1)], np.int32)
    gain = np.diff(weight)
    # How often a place's byte comes again within a window's length, after it and before it.
    after, before = np.zeros(len(data), np.uint8), np.zeros(len(data), np.uint8)
    for k in range(1, width):
        same = (data[:-k] == data[k:]).view(np.uint8)
        after[:-k] += same
        before[k:] += same
    sums = np.empty(n, np.int32)
    sums[0] = weight[np.bincount(data[:width])].sum()
    sums[1:] = gain[before[width:]] - gain[after[: n - 1]]
    np.cumsum(sums, out=sums)
    most = int(weight[width])
    return ((most - sums).astype(np.int64) * STEPS // most).astype(np.int32)


def _joined(texts: list[bytes], gap: int):
    """Texts in one array, ``gap`` zeros after each, with their starts and ends."""
    import numpy as np

    lengths = np.array([len(t) for t in texts], np.int64)
    starts = np.cumsum(lengths + gap) - lengths - gap
    return np.frombuffer(bytes(gap).join([*texts, b""]), np.uint8), starts, starts + lengths


def _between(starts, ends, n: int):
    """A mask of ``n`` places, set from each start to before its end."""
    import numpy as np

    turns = np.zeros(n + 1, np.int64)
    np.add.at(turns, np.minimum(starts, n), 1)
    np.add.at(turns, np.minimum(ends, n), -1)
    return np.cumsum(turns[:-1]) > 0


def _parts(text: bytes, width: int) -> list[bytes]:
    """A text in parts of ``BLOCK`` windows; each window is in one of them."""
    return [text[a : a + BLOCK + width - 1] for a in range(0, len(text), BLOCK)]


def rarity(docs: DataFrame, width: int = 32) -> tuple[list[int], int]:
    """(rank of each entropy step, the rarest first; number of windows) over all texts of ``docs``.

    Steps of equal counts rank by their entropy.  No more than ``STEPS + 1`` counts reach the driver.
    """

    def run(batches):
        import numpy as np

        total = np.zeros(STEPS + 1, np.int64)

        def count(texts):
            data, starts, ends = _joined(texts, 0)
            steps, has = entropy_steps(data, width), ends - starts >= width
            inside = _between(starts[has], ends[has] - width + 1, len(steps))
            total[:] += np.bincount(steps[inside], minlength=STEPS + 1)

        for batch in batches:
            held, size = [], 0
            for text in batch.column(0):
                for part in _parts(text.as_py() or b"", width):
                    held.append(part)
                    size += len(part)
                    if size >= BLOCK:
                        count(held)
                        held, size = [], 0
            count(held)
        found = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(found), pa.array(total[found])], ["step", "n"])

    counted = typed(docs, text="binary").mapInArrow(run, "step long, n long").groupBy("step").agg(F.sum("n").alias("n"))
    counts = {r["step"]: r["n"] for r in counted.collect()}
    ranks = [0] * (STEPS + 1)
    for rank, step in enumerate(sorted(range(STEPS + 1), key=lambda step: (counts.get(step, 0), step))):
        ranks[step] = rank
    return ranks, sum(counts.values())


class Digester:
    """Fingerprints texts by the ranks of a corpus."""

    def __init__(self, ranks: list[int], width: int = 32, span: int = 32, popular: int = 8):
        import numpy as np

        self.ranks, self.width, self.span, self.popular = np.array(ranks, np.uint32), width, span, popular

    def points(self, data, starts, ends):
        """How many spans each window ranks first in; texts lie ``span`` bytes or more apart."""
        import numpy as np

        steps, has = entropy_steps(data, self.width), ends - starts >= self.width
        n, starts, ends = len(steps), starts[has], ends[has] - self.width + 1
        keys = (self.ranks[steps] << np.uint32(_PLACES)) | np.arange(n, dtype=np.uint32)
        keys[~_between(starts, ends, n)] = 0xFFFFFFFF
        low, size = np.concatenate([keys, np.full(self.span - 1, 0xFFFFFFFF, np.uint32)]), 1
        while size < self.span:
            step = min(size, self.span - size)
            low = np.minimum(low[:-step], low[step:])
            size += step
        # A text with fewer windows than a span has one span.
        spans = _between(starts, np.maximum(starts, ends - self.span) + 1, n)
        first = low[spans] & np.uint32((1 << _PLACES) - 1)
        return np.minimum(np.bincount(first, minlength=n), 255).astype(np.uint8)

    def long_points(self, text: bytes):
        """``points`` of one text, in blocks that overlap by a span."""
        import numpy as np

        n, margin = len(text) - self.width + 1, self.span - 1
        found = np.zeros(n, np.uint8)
        for a in range(0, n, BLOCK):
            b, low = min(n, a + BLOCK), max(0, a - margin)
            part = text[low : min(n, b + margin) + self.width - 1]
            data, starts, ends = _joined([part], self.span)
            found[a:b] = self.points(data, starts, ends)[a - low : b - low]
        return found

    def chosen(self, points):
        """Places of the features: popular windows, and less popular ones where those are few."""
        import numpy as np

        least = self.popular
        found = np.flatnonzero(points >= least)
        while len(found) < FEW and least > 1:
            least //= 2
            found = np.flatnonzero(points >= least)
        return found

    def hashes(self, data, places):
        """64-bit hashes of the windows at ``places``."""
        import numpy as np

        rows = np.zeros((len(places), -(-self.width // 8) * 8), np.uint8)
        rows[:, : self.width] = data[places[:, None] + np.arange(self.width)]
        mixed = np.full(len(places), self.width, np.uint64)
        for column in rows.view("<u8").T:
            mixed = spread_bits(mixed ^ column)
        return mixed

    def fingerprints(self, texts: list[bytes]) -> list[str]:
        found, held, size = [], [], 0
        for text in texts:
            if held and size + len(text) > BLOCK:
                found += self._block(held)
                held, size = [], 0
            if len(text) > BLOCK:
                found += self._block([text])
            else:
                held.append(text)
                size += len(text) + self.span + self.width
        return found + self._block(held)

    def _block(self, texts: list[bytes]) -> list[str]:
        import numpy as np

        if not texts:
            return []
        data, starts, ends = _joined(texts, max(self.span, self.width))
        points = self.long_points(texts[0]) if len(texts[0]) > BLOCK else self.points(data, starts, ends)
        places = []
        for a, b in zip(starts.tolist(), ends.tolist()):
            if b - a >= self.width:
                places.append(a + self.chosen(points[a : b - self.width + 1]))
            else:  # shorter than a window: the text is the feature, if there is any
                places.append(np.full(int(b > a), a, np.int64))
        hashes = self.hashes(data, np.concatenate(places))
        cuts = np.cumsum([0, *map(len, places)])
        return [fingerprint_of(hashes[a:b]) for a, b in zip(cuts[:-1], cuts[1:])]


def fingerprint_of(hashes) -> str:
    """The chain of filters of features in their order: their number, a point, the filters in base64."""
    import numpy as np

    first = np.sort(np.unique(hashes, return_index=True)[1])
    hashes = hashes[first]
    filters = -(-len(hashes) // FEATURES)
    bits = np.zeros(filters * BITS, np.uint8)
    for k in range(HASHES):
        bits[np.arange(len(hashes)) // FEATURES * BITS + (hashes >> np.uint64(11 * k) & np.uint64(BITS - 1)).astype(np.int64)] = 1
    return f"{len(hashes)}.{base64.b64encode(np.packbits(bits).tobytes()).decode()}"


def filters_of(fingerprint: str):
    """The filters of a fingerprint, 64 bits to a number, and how many features each holds."""
    import numpy as np

    features, _, coded = fingerprint.partition(".")
    filters = np.frombuffer(base64.b64decode(coded), np.uint8).view(np.uint64).reshape(-1, BITS // 64)
    counts = np.full(len(filters), FEATURES)
    if len(counts):
        counts[-1] = int(features) - FEATURES * (len(counts) - 1)
    return filters, counts


def likeness(one: str, other: str) -> float:
    """0 to 1: how much of the smaller chain of filters the other holds; 1 for equal fingerprints.

    Each filter meets its best partner; filters count by their features.  Two texts without any
    feature are alike, one without is like no other.
    """
    if one == other:
        return 1.0
    a, b = filters_of(one), filters_of(other)
    if not len(a[0]) or not len(b[0]):
        return 0.0
    if len(a[0]) > len(b[0]):
        a, b = b, a
    if len(a[0]) == len(b[0]):
        return (_held(*a, b[0]) + _held(*b, a[0])) / 2
    return _held(*a, b[0])


def _held(filters, counts, others) -> float:
    import numpy as np

    sizes, total = np.bitwise_count(others).sum(1, dtype=np.int64), 0.0
    for first in range(0, len(filters), 16):
        some = filters[first : first + 16]
        own = np.bitwise_count(some).sum(1, dtype=np.int64)[:, None]
        best = np.zeros(len(some))
        for start in range(0, len(others), 1024):
            part, size = others[start : start + 1024], sizes[None, start : start + 1024]
            shared = np.bitwise_count(some[:, None] & part[None]).sum(2, dtype=np.int64)
            chance, most = own * size / BITS, np.minimum(own, size)
            low = chance + NOISE * (most - chance)
            # Where a full filter leaves nothing beyond chance, only all bits count.
            room = np.where(most > low, most - low, 1.0)
            best = np.maximum(best, np.where(shared == most, 1.0, (shared - low) / room).max(1))
        total += float((np.maximum(best, 0.0) * counts[first : first + 16]).sum())
    return total / float(counts.sum())


def fingerprints(docs: DataFrame, ranks: list[int], width: int = 32, span: int = 32, popular: int = 8) -> DataFrame:
    """``doc_id``, ``fingerprint`` of every row of ``docs``, by the ``ranks`` of ``rarity``.

    Equal texts have equal fingerprints.  NULL and empty texts have no feature (``0.``); a text
    shorter than a window is one feature.  Repeated rows and rows without an id are answered each;
    other columns are not read; an empty table gives no rows.  Long texts are worked on in blocks.
    """

    def run(batches):
        digester = Digester(ranks, width, span, popular)
        for batch in batches:
            texts = [t.as_py() or b"" for t in batch.column(1)]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(digester.fingerprints(texts), pa.string())], ["doc_id", "fingerprint"])

    return typed(docs, doc_id="long", text="binary").mapInArrow(run, "doc_id long, fingerprint string")


def compared(one: str | Column, other: str | Column) -> Column:
    """The likeness of two columns of fingerprints; NULL where one is."""

    @F.pandas_udf("double")
    def compare(a, b):
        return a.combine(b, lambda x, y: None if x is None or y is None else likeness(x, y))

    return compare(one, other)
