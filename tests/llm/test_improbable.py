"""Fingerprints of improbable features against their definition, and rows with their successors."""

import base64
import hashlib
import math
import random
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from postsieve.llm import improbable, queries
from postsieve.llm.improbable import Digester, compared, entropy_steps, filters_of, fingerprints, likeness, rarity
from postsieve.llm.in_order import in_order
from postsieve.llm.periodic_runs import spread_bits


def step(window):
    weight = {c: round(c * math.log2(c) * 65536) for c in range(1, len(window) + 1)}
    most = weight[len(window)]
    return (most - sum(weight[c] for c in Counter(window).values())) * 1000 // most


def brute_ranks(texts, width):
    counts = Counter(step(t[i : i + width]) for t in texts for i in range(len(t) - width + 1))
    order = sorted(range(1001), key=lambda s: (counts[s], s))
    return [order.index(s) for s in range(1001)], sum(counts.values())


def brute_fingerprint(text, ranks, width, span, popular):
    windows = [text[i : i + width] for i in range(len(text) - width + 1)]
    keys = [(ranks[step(w)], i) for i, w in enumerate(windows)]
    points = Counter(min(keys[j : j + span])[1] for j in range(max(1, len(keys) - span + 1))) if keys else {}
    least = popular
    while least > 1 and sum(p >= least for p in points.values()) < 16:
        least //= 2
    chosen = [windows[i] for i in sorted(points) if points[i] >= least]
    if not windows and text:
        chosen = [text + bytes(width - len(text))]
    filters, seen = [], []
    for w in chosen:
        h = width
        for k in range(0, width, 8):
            column = int.from_bytes(w[k : k + 8].ljust(8, b"\0"), "little")
            h = int(spread_bits(np.array([h ^ column], np.uint64))[0])
        if h in seen:
            continue
        if len(seen) % 160 == 0:
            filters.append([0] * 2048)
        seen.append(h)
        for k in range(5):
            filters[-1][h >> 11 * k & 2047] = 1
    return f"{len(seen)}." + base64.b64encode(np.packbits(np.array(filters, np.uint8)).tobytes()).decode()


def prose(rng, n):
    return " ".join("".join(rng.choice("etaoinshrdlu") for _ in range(rng.randint(1, 8))) for _ in range(n))


@pytest.fixture(scope="module")
def texts():
    rng = random.Random(8)
    found = [prose(rng, rng.randint(0, 120)) for _ in range(40)] + ["a" * 90, "abc", "x" * 31, "y" * 32, "z" * 33, "", "naïve é " * 9]
    return found + [found[3], prose(rng, 2500), "ab" * 400]


@pytest.mark.parametrize("width, span, popular", [(32, 32, 8), (12, 20, 4)])
def test_fingerprints_by_definition(spark, texts, width, span, popular):
    docs = spark.createDataFrame([(i, t, 1) for i, t in enumerate([*texts, None])], "doc_id long, text string, step int").repartition(3)
    encoded = [t.encode() for t in texts]
    ranks, windows = rarity(docs, width)
    assert (ranks, windows) == brute_ranks(encoded, width)
    got = {r["doc_id"]: r["fingerprint"] for r in fingerprints(docs, ranks, width, span, popular).collect()}
    assert got == {i: brute_fingerprint(t, ranks, width, span, popular) for i, t in enumerate([*encoded, b""])}


def test_blocks_change_nothing(monkeypatch, texts):
    ranks = brute_ranks([t.encode() for t in texts], 32)[0]
    digester, encoded = Digester(ranks), [t.encode() for t in texts]
    whole = digester.fingerprints(encoded)
    for block in (64, 100, 1000):
        monkeypatch.setattr(improbable, "BLOCK", block)
        assert digester.fingerprints(encoded) == whole


def test_parts_hold_each_window_once(monkeypatch, texts):
    monkeypatch.setattr(improbable, "BLOCK", 50)
    text = texts[-2].encode()
    parts = improbable._parts(text, 32)
    assert [p[i : i + 32] for p in parts for i in range(len(p) - 31)][: len(text) - 31] == [text[i : i + 32] for i in range(len(text) - 31)]
    assert sum(max(0, len(p) - 31) for p in parts) == len(text) - 31


def test_entropy_of_any_bytes():
    rng = np.random.default_rng(1)
    data = rng.integers(0, 4, 500).astype(np.uint8)
    for width in (1 + 1, 8, 64):
        assert entropy_steps(data, width).tolist() == [step(data[i : i + width].tobytes()) for i in range(500 - width + 1)]
    assert len(entropy_steps(data[:5], 8)) == 0


def test_likeness(texts):
    encoded = [t.encode() for t in texts]
    digester = Digester(brute_ranks(encoded, 32)[0])
    long = texts[-2]
    a, same, edited, other, front, empty = digester.fingerprints(
        [t.encode() for t in (long, long, long[: len(long) * 3 // 4] + prose(random.Random(1), 600), prose(random.Random(2), 2500), long[:3000], "")]
    )
    assert likeness(a, same) == 1 == likeness(empty, empty) and likeness(a, empty) == 0 == likeness(empty, a)
    assert 0.6 < likeness(a, edited) < 0.95 and likeness(a, edited) == likeness(edited, a)
    assert likeness(a, other) < 0.1 and likeness(front, a) > 0.5
    filters, counts = filters_of(a)
    assert len(filters) > 2 and counts.sum() == int(a.split(".")[0]) and (counts[:-1] == 160).all()
    # Full filters share all bits of one another, and are alike for that alone.
    full = "160." + base64.b64encode(b"\xff" * 256).decode()
    assert likeness(full, "5." + base64.b64encode(b"\x01" * 256).decode()) == 1


def test_compared_columns(spark):
    rows = spark.createDataFrame([("0.", "0."), ("0.", None), (None, None)], "a string, b string")
    assert [r[0] for r in rows.select(compared("a", "b")).collect()] == [1.0, None, None]


def pairing():
    """One row for each, with what follows it."""

    def successors(rows):
        held, found = None, []
        for key, text, guest in rows:
            if held is not None:
                found.append((*held, text))
            held = None if guest else (key, text)
        if found:
            columns = [pa.array([f[i] for f in found], t) for i, t in enumerate([pa.int64(), pa.string(), pa.string()])]
            yield pa.RecordBatch.from_arrays(columns, ["doc_id", "text", "after"])

    return successors


@pytest.mark.parametrize("ranges", [1, 4, 50])
def test_every_row_meets_its_successor(spark, ranges):
    rng = random.Random(ranges)
    rows = [(rng.randrange(-50, 200), f"t{i}") for i in range(150)] + [(None, "n1"), (None, None), (None, None), (7, "seven"), (7, "seven")]
    rows += [(99, f"same id {i}") for i in range(60)]
    docs = spark.createDataFrame([(*r, 1, True, 2) for r in rows], "doc_id long, text string, part int, guest boolean, tie int").repartition(6)
    got = [tuple(r) for r in in_order(docs, ranges, pairing(), "doc_id long, text string, after string").collect()]
    hashed = docs.select("doc_id", F.coalesce("text", F.lit("")).alias("text")).withColumn("h", F.xxhash64("text")).collect()
    ordered = [(r[0], r[1]) for r in sorted(hashed, key=lambda r: (r[0] is not None, r[0] or 0, r[2], r[1]))]
    expected = [(*a, b[1]) for a, b in zip(ordered, [*ordered[1:], ordered[0]])]
    assert sorted(got, key=repr) == sorted(expected, key=repr)


def test_one_row_and_none(spark):
    docs = spark.createDataFrame([(5, "only")], "doc_id long, text string")
    kind = "doc_id long, text string, after string"
    assert [tuple(r) for r in in_order(docs, 4, pairing(), kind).collect()] == [(5, "only", "only")]
    assert in_order(docs.limit(0), 4, pairing(), kind).count() == 0


def test_query(spark):
    folder = "/root/testdata/sf0.001"
    table = sorted(map(tuple, spark.read.parquet(f"{folder}/documents.parquet").select("doc_id", "text").collect()))
    encoded = [(t or "").encode() for _, t in table]
    ranks, _ = rarity(spark.read.parquet(f"{folder}/documents.parquet"))
    got = {r["doc_id"]: r for r in queries.QUERIES["op11_fingerprints"](spark, folder).collect()}
    assert len(got) == len(table)
    prints = Digester(ranks).fingerprints(encoded)
    for i, (key, text) in enumerate(table):
        text, after = text or "", table[(i + 1) % len(table)][1] or ""
        edited = (text[: len(text) - len(text) // 4] + after[: len(text) // 4]).encode()
        r = got[key]
        assert (r["n_chars"], r["edited_sha256"]) == (len(text), hashlib.sha256(edited).hexdigest())
        assert r["fingerprint"] == prints[i] and r["edited_fingerprint"] == Digester(ranks).fingerprints([edited])[0]
        assert r["near_edited"] == likeness(r["fingerprint"], r["edited_fingerprint"])
        assert r["near_next"] == likeness(r["fingerprint"], prints[(i + 1) % len(table)])
    long = [r for r in got.values() if r["n_chars"] > 400]
    assert sum(r["near_edited"] > 0.5 > r["near_next"] for r in long) > 0.97 * len(long)
