"""Token ids as flat binary files with 64-bit document offsets.

A shard is three files: ``*.ids`` holds the ids of its documents one after another, as unsigned
16- or 32-bit little-endian integers; ``*.docs`` the document ids as signed 64-bit integers;
``*.offsets`` one unsigned 64-bit integer more than documents: the place of each document's first
id in the whole corpus, then the shard's end.  ``manifest.json`` names the shards in order.

Every task writes the ids of one partition.  The lengths of the partitions (one number each) are
summed up front to back, which gives each shard its base; then the offsets are written.
"""

from __future__ import annotations

import array
import json
import os
import re
import zlib
from collections.abc import Callable, Iterator

import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from postsieve.llm.common import child, open_folder, put_file, typed

#: Stands for a NULL document id in the ``*.docs`` file.
NULL_ID = -(2**63)

#: A normalizer and a pre-tokenizer, as a tokenizer file spells them, that ``PART`` cuts like.
RULES = (
    {
        "type": "Sequence",
        "normalizers": [
            {"type": "NFC"},
            {"type": "Replace", "pattern": {"Regex": r"\s+"}, "content": " "},
            {"type": "Lowercase"},
        ],
    },
    {
        "type": "Sequence",
        "pretokenizers": [
            {
                "type": "Split",
                "pattern": {"Regex": r"'s|'t|'re|'ve|'m|'ll|'d|[\p{L}]+|[\p{N}]|[^\s\p{L}\p{N}]+"},
                "behavior": "Removed",
                "invert": True,
            },
            {"type": "ByteLevel", "add_prefix_space": False, "trim_offsets": True, "use_regex": False},
        ],
    },
)
#: Latin letters (to U+017F but for one whose lower case is two characters), digits and ASCII marks.
#: Others may compose, and the apostrophe may start a suffix.
PLAIN = "A-Za-z\u00c0-\u00d6\u00d8-\u00f6\u00f8-\u012f\u0131-\u017f0-9!-&(-/:-@\\[-`{-~"
#: The parts that ``RULES`` cut a lower-case word of ``PLAIN`` characters into.
PART = "[a-z\u00df-\u00f6\u00f8-\u017f]+|[0-9]|[!-&(-/:-@\\[-`{-~]+"

_WORDS: dict[str, "WordEncoder"] = {}


class WordEncoder:
    """Encodes texts with a tokenizer file, each distinct piece between ASCII white space once.

    Good for tokenizers whose pieces never reach over white space and which drop it; the encoder
    tests this on a sample sentence and otherwise gives whole texts to the tokenizer.  Words are told
    apart by Arrow, for many texts at a time.  If the file's rules are ``RULES``, words of plain
    characters are cut where those rules cut them, and only their distinct parts are encoded.  New
    pieces are encoded together, ``JOINED`` in a call.  The ids of parts are told apart by those that
    end a word, others by a mark between pieces that has an id of its own.
    """

    #: Pieces remembered; when half as many are new, the half before them is forgotten.
    LIMIT = 690_000
    JOINED = 100
    #: Marks to choose from; a piece that holds the chosen one is encoded by itself.
    MARKS = "~^`|\\#"
    #: Bytes of text whose words are told apart together.
    CHUNK = 1 << 22

    def __init__(self, path: str):
        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
        os.environ.setdefault("RAYON_NUM_THREADS", "1")
        import numpy as np
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.width = 2 if self.tokenizer.get_vocab_size(with_added_tokens=True) <= 1 << 16 else 4
        parts = ["It's", "one,", "two;", "don't", "Ünïté", "3.14", "<|x|>", "'s", "..."]
        apart = [i for p in parts for i in self.ids(p)]
        self.by_word = apart == self.ids(" \n".join(parts))
        alone = [(mark, self.ids(mark)) for mark in self.MARKS]
        self.mark, self.mark_id = next(((m, ids[0]) for m, ids in alone if len(ids) == 1), (None, None))
        with open(path, encoding="utf-8") as f:
            rules = json.load(f)
        #: Found in texts before any rule.
        self.added = [t["content"] for t in rules.get("added_tokens") or ()]
        inside = any(re.fullmatch(PART, text.lower()) for text in self.added)
        self.by_part = (rules.get("normalizer"), rules.get("pre_tokenizer")) == RULES and not inside
        self.part, self.ends = re.compile(PART), None
        suffix = rules["model"].get("end_of_word_suffix")
        if self.by_part and suffix and not re.fullmatch(PART, suffix):
            vocab = self.tokenizer.get_vocab(with_added_tokens=True)
            self.ends = np.zeros(max(vocab.values()) + 1, bool)
            self.ends[[i for text, i in vocab.items() if text.endswith(suffix)]] = True
        self.cache: dict[bytes, bytes] = {}
        self.older: dict[bytes, bytes] = {}

    def ids(self, text: str) -> list[int]:
        return self.tokenizer.encode(text, add_special_tokens=False).ids

    def pack(self, ids: list[int]) -> bytes:
        return array.array("H" if self.width == 2 else "I", ids).tobytes()

    def learn(self, words: list[bytes]) -> None:
        """Put the ids of ``words`` into the cache."""
        parts, together, mark = [], [], self.mark
        for word in words:
            text = word.decode("utf-8", "replace")
            if self.ends is not None and self.part.fullmatch(text):
                parts.append((word, text))
            elif mark is None or mark in text:
                self.cache[word] = self.pack(self.ids(text))
            else:
                together.append((word, text))
        self.learn_together(parts, " ", lambda found: split_after(found, self.ends, self.width))
        self.learn_together(together, f" {mark} ", lambda found: split_ids(found, self.mark_id, self.width))

    def learn_together(self, words: list[tuple[bytes, str]], between: str, split: Callable[[bytes], list[bytes]]) -> None:
        for first in range(0, len(words), self.JOINED):
            some = words[first : first + self.JOINED]
            found = self.pack(self.tokenizer.encode_batch_fast([between.join([t for _, t in some])], add_special_tokens=False)[0].ids)
            cut = split(found)
            if len(cut) == len(some):
                self.cache.update(zip([w for w, _ in some], cut))
            else:  # a piece holds the mark's id after all, or has no last id
                self.cache.update((w, self.pack(self.ids(t))) for w, t in some)

    def cut(self, words: pa.Array) -> pa.Array:
        """Lists of parts of ``words`` whose ids, one after another, are those of the word."""
        if not self.by_part:
            return pc.ascii_split_whitespace(words)
        plain = pc.match_substring_regex(words, f"^[{PLAIN}]*$")
        for text in self.added:
            plain = pc.and_not(plain, pc.match_substring(words, text))
        low = pc.utf8_lower(pc.if_else(plain, words, ""))
        return pc.ascii_split_whitespace(pc.if_else(plain, pc.replace_substring_regex(low, PART, r"\0 "), words))

    def look_up(self, words: list[bytes]) -> list[bytes]:
        """The ids of each of the distinct ``words``."""
        found = list(map(self.cache.get, words))
        new = [w for w, ids in zip(words, found) if ids is None]
        if len(self.cache) + len(new) > self.LIMIT // 2:
            self.older, self.cache = self.cache, {}
        older = self.older
        self.cache.update((w, older[w]) for w in new if w in older)
        self.learn([w for w in new if w not in older])
        get = self.cache.__getitem__
        return [get(w) if ids is None else ids for w, ids in zip(words, found)]

    def encode_short(self, texts: pa.Array, end: bytes = b"") -> tuple[pa.Buffer, list[int]]:
        """The ids of all ``texts`` with ``end`` after each, and the bytes each took."""
        import numpy as np

        lists = pc.ascii_split_whitespace(texts)
        words = lists.flatten().dictionary_encode()
        cuts = self.cut(words.dictionary)
        parts = cuts.flatten().dictionary_encode()
        table = self.look_up(parts.dictionary.cast(pa.binary()).to_numpy(zero_copy_only=False).tolist())
        # The ids of every distinct word, and of the end; then of every word, and of the end after each text.
        stops, size = cuts.offsets.to_numpy(), len(words.dictionary)
        data, offsets = taken(pa.array(table, pa.large_binary()), parts.indices)
        stops = np.append(offsets[stops], offsets[stops[-1]] + len(end))
        known = pa.LargeBinaryArray.from_buffers(
            pa.large_binary(), size + 1, [None, pa.py_buffer(stops), pa.py_buffer(data.to_pybytes() + end)]
        )
        stops = lists.offsets.to_numpy()[1:]
        data, offsets = taken(known, pa.array(np.insert(words.indices.to_numpy(), stops, size)))
        return data, np.diff(offsets[stops + np.arange(1, len(stops) + 1)], prepend=0).tolist()

    def encode_column(self, texts: pa.Array, end: bytes) -> Iterator[tuple[bytes | pa.Buffer, list[int]]]:
        """The ids of ``texts`` with ``end`` after each, in pieces, and the bytes of each text that ends there."""
        import numpy as np

        sizes = pc.binary_length(texts).to_numpy()
        sums, first = np.cumsum(sizes), 0
        while first < len(sizes):
            if not self.by_word or sizes[first] > self.CHUNK:
                length = len(end)
                for piece in self.encode(texts[first].as_py()):
                    length += len(piece)
                    yield piece, []
                yield end, [length]
                first += 1
                continue
            before = sums[first] - sizes[first]
            stop = int(np.searchsorted(sums, before + self.CHUNK, "right"))
            yield self.encode_short(texts.slice(first, stop - first), end)
            first = stop

    def encode(self, text: str) -> Iterator[bytes]:
        """The ids of ``text`` as bytes, in pieces."""
        if not self.by_word:
            yield self.pack(self.ids(text))
            return
        for part in slices(text):
            raw = pa.array([part.encode("utf-8", "surrogatepass")], pa.binary())
            yield self.encode_short(raw.view(pa.string()))[0].to_pybytes()


def taken(table: pa.LargeBinaryArray, indices: pa.Array):
    """Rows of ``table`` one after another: all their bytes, and where each starts."""
    import numpy as np

    rows = table.take(indices)
    _, offsets, data = rows.buffers()
    return data or pa.py_buffer(b""), np.frombuffer(offsets, np.int64)[: len(rows) + 1]


def split_ids(packed: bytes, mark: int, width: int) -> list[bytes]:
    """Packed ids cut at every ``mark``."""
    import numpy as np

    at = np.flatnonzero(np.frombuffer(packed, f"<u{width}") == mark) * width
    return [packed[a:b] for a, b in zip([0, *(at + width).tolist()], [*at.tolist(), len(packed)])]


def split_after(packed: bytes, ends, width: int) -> list[bytes]:
    """Packed ids cut after every id for which ``ends`` holds."""
    import numpy as np

    at = ((np.flatnonzero(ends[np.frombuffer(packed, f"<u{width}")]) + 1) * width).tolist()
    return [packed[a:b] for a, b in zip([0, *at], at)]


def encoder(path: str) -> WordEncoder:
    """One encoder a worker, kept from task to task."""
    if path not in _WORDS:
        _WORDS[path] = WordEncoder(path)
    return _WORDS[path]


def slices(text: str, size: int = 1 << 20) -> Iterator[str]:
    """``text`` in order, cut only at ASCII white space."""
    blank, start = re.compile(r"[ \t-\r]"), 0
    while len(text) - start > size:
        found = blank.search(text, start + size)
        if not found:
            break
        yield text[start : found.start()]
        start = found.start()
    yield text[start:]


def write_token_files(
    docs: DataFrame, folder: str, tokenizer: str, end_id: int, order_by_id: bool = True
) -> str:
    """Write the ids of all ``docs`` (``doc_id``, ``text``) below ``folder``; return the manifest's path.

    Each document is its text's ids and ``end_id``.  NULL and empty texts are ``end_id`` alone.
    With ``order_by_id`` the documents lie in ascending ``doc_id`` order, NULL ids first, rows of
    one id by their texts' hash and text, so repeated rows all stay.  Without it they lie as the
    partitions of ``docs`` hold them, so a shuffled corpus stays shuffled.  An empty table gives
    a manifest without shards.  Other columns are not read.
    """
    import numpy as np

    rows = typed(docs, doc_id="long", text="string").withColumn("text", F.coalesce("text", F.lit("")))
    if order_by_id:
        hashed = rows.withColumn("tie", F.xxhash64("text"))
        rows = (
            hashed.repartitionByRange(F.col("doc_id").asc_nulls_first(), F.col("tie"))
            .sortWithinPartitions(F.col("doc_id").asc_nulls_first(), "tie", "text")
            .drop("tie")
        )

    def ids(batches):
        words = encoder(tokenizer)
        system, path = open_folder(folder)
        context = TaskContext.get()
        name = f"shard-{context.partitionId():06d}-{context.taskAttemptId()}"
        end = end_id.to_bytes(words.width, "little")
        keys, lengths = [], []

        def pieces():
            for batch in batches:
                keys.extend(NULL_ID if key is None else key for key in batch.column(0).to_pylist())
                for piece, sizes in words.encode_column(batch.column(1), end):
                    lengths.extend(size // words.width for size in sizes)
                    yield piece

        put_file(system, child(path, f"{name}.ids"), pieces())
        put_file(system, child(path, f"{name}.docs"), [np.array(keys, "<i8").tobytes()])
        put_file(system, child(path, f"{name}.lengths"), [np.array(lengths, "<u8").tobytes()])
        yield pa.RecordBatch.from_pydict(
            {
                "part": pa.array([context.partitionId()], pa.int64()),
                "name": [name],
                "docs": pa.array([len(keys)], pa.int64()),
                "ids": pa.array([sum(lengths)], pa.int64()),
                "width": pa.array([words.width], pa.int64()),
            }
        )

    kind = "part long, name string, docs long, ids long, width long"
    # One row a partition, whatever the number of documents.
    parts = sorted(rows.mapInArrow(ids, kind).where("docs > 0").collect())
    shards, base = [], 0
    for part in parts:
        shards.append({"name": part["name"], "base": base, "docs": part["docs"], "ids": part["ids"]})
        base += part["ids"]

    def offsets(batches):
        system, path = open_folder(folder)
        for batch in batches:
            for k in batch.column(0).to_pylist():
                name = child(path, shards[k]["name"])
                with system.open_input_file(f"{name}.lengths") as f:
                    lengths = np.frombuffer(f.read(), "<u8")
                places = np.concatenate([[0], np.cumsum(lengths)]).astype("<u8") + np.uint64(shards[k]["base"])
                put_file(system, f"{name}.offsets", [places.astype("<u8").tobytes()])
            yield batch

    spark = docs.sparkSession
    if shards:
        spark.range(0, len(shards), 1, len(shards)).mapInArrow(offsets, "id long").count()
    system, path = open_folder(folder)
    width = parts[0]["width"] if parts else 2
    text = json.dumps({"width": width, "end_id": end_id, "ids": base, "shards": shards})
    put_file(system, child(path, "manifest.json"), [text.encode()])
    return child(folder, "manifest.json")


def read_token_files(spark: SparkSession, folder: str) -> DataFrame:
    """A row per document of the files below ``folder``: its id, place, length and checksum.

    ``doc_id``, ``start`` (ids of all documents before it), ``n_tokens``, ``ids_crc32`` (unsigned
    CRC-32 of its ids as little-endian 32-bit integers), ``shard``.  Files on a mounted file system
    are memory-mapped, others are read shard by shard.
    """
    import numpy as np

    system, path = open_folder(folder)
    with system.open_input_file(child(path, "manifest.json")) as f:
        manifest = json.loads(f.read())
    shards, width = manifest["shards"], manifest["width"]

    def documents(batches):
        from pyarrow import fs

        system, path = open_folder(folder)
        kind = f"<u{width}"

        def opened(name, dtype):
            if isinstance(system, fs.LocalFileSystem):
                return np.memmap(child(path, name), dtype, "r")
            with system.open_input_file(child(path, name)) as f:
                return np.frombuffer(f.read(), dtype)

        for batch in batches:
            for k in batch.column(0).to_pylist():
                name, base = shards[k]["name"], shards[k]["base"]
                ids = opened(f"{name}.ids", kind)
                keys, places = opened(f"{name}.docs", "<i8"), opened(f"{name}.offsets", "<u8")
                for first in range(0, len(keys), 10_000):
                    some = keys[first : first + 10_000]
                    start = places[first : first + len(some) + 1].astype(np.int64)
                    sums = [crc(ids[a - base : b - base]) for a, b in zip(start[:-1], start[1:])]
                    yield pa.RecordBatch.from_pydict(
                        {
                            "doc_id": pa.array(np.array(some, np.int64), mask=np.array(some == NULL_ID)),
                            "start": pa.array(start[:-1]),
                            "n_tokens": pa.array(np.diff(start)),
                            "ids_crc32": pa.array(sums, pa.int64()),
                            "shard": pa.array([k] * len(some), pa.int32()),
                        }
                    )

    def crc(ids, size=1 << 20):
        value = 0
        for first in range(0, len(ids), size):
            value = zlib.crc32(ids[first : first + size].astype("<u4").tobytes(), value)
        return value

    kind = "doc_id long, start long, n_tokens long, ids_crc32 long, shard int"
    slots = spark.range(0, len(shards), 1, max(1, len(shards)))
    return slots.mapInArrow(documents, kind)


def read_document(folder: str, start: int, n_tokens: int) -> list[int]:
    """The ids of one document, given its place, straight from the files."""
    import numpy as np

    system, path = open_folder(folder)
    with system.open_input_file(child(path, "manifest.json")) as f:
        manifest = json.loads(f.read())
    for shard in manifest["shards"]:
        if shard["base"] <= start < shard["base"] + shard["ids"]:
            with system.open_input_file(child(path, f"{shard['name']}.ids")) as f:
                f.seek((start - shard["base"]) * manifest["width"])
                return np.frombuffer(f.read(n_tokens * manifest["width"]), f"<u{manifest['width']}").tolist()
    raise KeyError(start)
