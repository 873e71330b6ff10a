"""Periodic runs against their definition, and the query's digests against plain Python."""

import hashlib
import random
import re
import zlib
from fractions import Fraction

import numpy as np
import pytest

from postsieve.llm import queries
from postsieve.llm.periodic_runs import find_runs, periodic_runs, reach


def brute(words, least=24, times=3):
    found = []
    for q in range(1, len(words) // times + 1):
        i = 0
        while i + q < len(words):
            j = i
            while j + q < len(words) and words[j] == words[j + q]:
                j += 1
            n, own = j - i + q, words[i : j + q]
            if j > i and n >= max(least, times * q):
                if not any(own[p:] == own[:-p] for p in range(1, q)):
                    found.append((i, n, q))
            i = j + 1
    return sorted(found, key=lambda r: (r[0], r[2]))


def loops(rng):
    text = []
    for _ in range(rng.randint(0, 5)):
        unit = [rng.randrange(rng.randint(1, 3)) for _ in range(rng.randint(1, 9))]
        text += (unit * 9)[: rng.randint(1, 60)] + [rng.randrange(4) for _ in range(rng.randint(0, 6))]
    return text


@pytest.mark.parametrize("least, times", [(24, 3), (6, 2), (10, 3), (8, 4)])
def test_runs_of_random_words(least, times):
    rng = random.Random(least)
    for _ in range(150):
        docs = [loops(rng) for _ in range(rng.randint(1, 5))]
        edges = np.concatenate([[0], np.cumsum([len(d) for d in docs])]).astype(np.int64)
        got = find_runs(np.array([w for d in docs for w in d], np.int64), edges, least, times)
        expected = [(s + int(edges[k]), n, q) for k, d in enumerate(docs) for s, n, q in brute(d, least, times)]
        assert [tuple(r) for r in got.tolist()] == expected


def test_reach():
    assert reach(24, 3) == 16
    # Nothing shorter agrees at the start of any run that counts.
    for least, times in [(24, 3), (7, 2), (30, 5)]:
        assert reach(least, times) == min(max(least, times * q) - q for q in range(1, 200))


def test_long_loops_stay_fast():
    for words in ([7] * 200_000, list(range(7)) * 30_000):
        got = find_runs(np.array(words, np.int64), np.array([0, len(words)]))
        assert got.tolist() == [[0, len(words), 1 if words[1] == 7 else 7]]


def test_rows_with_nothing_and_twice(spark):
    loop = " ".join(["é", "b c"] * 20)
    rows = [(1, f" x\t{loop}\n", "a"), (1, f" x\t{loop}\n", "a"), (None, loop, "b"), (2, "", "c"), (3, None, None), (4, "a b", "d")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, runs string")
    got = sorted((r["doc_id"] or 0, r["n_words"], [tuple(x) for x in r["runs"]], r["collapsed"]) for r in periodic_runs(docs).collect())
    # "x" is before the run, whose first period stays.
    assert got == [
        (0, 40, [(0, 40, 2)], "é b c"), (1, 41, [(1, 40, 2)], "x é b c"), (1, 41, [(1, 40, 2)], "x é b c"),
        (2, 0, [], ""), (3, 0, [], ""), (4, 2, [], "a b"),
    ]
    assert periodic_runs(docs.limit(0)).count() == 0
    with pytest.raises(ValueError):
        periodic_runs(docs, times=1)


def test_query_brute_force(spark):
    folder = "/root/testdata/sf0.001"
    table = {r["doc_id"]: r["text"] for r in spark.read.parquet(f"{folder}/documents.parquet").collect()}
    got = {r["doc_id"]: r for r in queries.QUERIES["op12_runs"](spark, folder).collect()}
    assert got.keys() == table.keys()
    seen = 0
    for key, text in table.items():
        words = re.findall(r"[^\x20\x09-\x0D]+", text or "")
        n, h = len(words), zlib.crc32(str(key).encode())
        if n > 1500:
            continue
        g = h // 10
        if h % 10 == 0 and n:
            a = g % n
            p = 1 + (n - a) // (3 + g % 8)
            words = [words[i] if i < a else words[a + (i - a) % p] for i in range(n)]
        runs = brute(words)
        gone = {i for s, length, q in runs for i in range(s + q, s + length)}
        best = min(runs, key=lambda r: (-Fraction(r[1], r[2]), r[0], r[2]), default=None)
        listed = "".join(f"{s},{length},{q}\n" for s, length, q in runs)
        left = " ".join(w for i, w in enumerate(words) if i not in gone)
        row = got[key]
        assert (row["n_runs"], row["start"], row["length"], row["period"]) == (len(runs), *(best or (None,) * 3))
        assert row["exponent_milli"] == (best and 1000 * best[1] // best[2])
        assert row["runs_sha256"] == hashlib.sha256(listed.encode()).hexdigest()
        assert row["collapsed_sha256"] == hashlib.sha256(left.encode()).hexdigest()
        seen += bool(runs)
    assert seen > 5
