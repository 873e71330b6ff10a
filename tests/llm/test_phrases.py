"""Phrase mining against plain counting, and its arithmetic, ranking and cutting by themselves."""

import random
import re
from collections import Counter

import pytest
from pyspark.sql import functions as F

from postsieve.llm import phrases
from postsieve.llm.phrases import first_rows, lowest_cut, mine_phrases, pieces_of


def brute(rows, longest, least, inside, count):
    """``rows``: (lang, text)."""
    counts, totals = {}, Counter()
    for lang, text in rows:
        lang = "und" if lang is None else lang
        lowered = re.sub("[A-Z]", lambda m: m.group().lower(), text or "")
        for piece in re.split(r"[.,;:!?\x0A-\x0D]", lowered):
            words = re.findall(r"[^\x20\x09]+", piece)
            totals[lang] += len(words)
            for k in range(1, longest + 1):
                for i in range(len(words) - k + 1):
                    counts.setdefault(lang, Counter())[tuple(words[i : i + k])] += 1
    found = []
    for lang, f in counts.items():
        chosen = {p: a for p, a in f.items() if len(p) > 1 and a >= least}
        gone = set()
        for p, a in chosen.items():
            for i in range(len(p)):
                for j in range(i + 2, len(p) + 1):
                    if j - i < len(p) and 100 * a >= inside * chosen.get(p[i:j], 0):
                        gone.add(p[i:j])
        scored = []
        for p, a in chosen.items():
            score, k = min((1_000_000 * a * a // (f[p[:k]] * f[p[k:]]), k) for k in range(1, len(p)))
            if p not in gone:
                scored.append((-score, -a, " ".join(p).encode(), f[p[:k]], f[p[k:]], k))
        for rank, (score, a, phrase, l, r, k) in enumerate(sorted(scored)[:count], 1):
            found.append((lang, rank, phrase, -a, k, l, r, totals[lang], -score))
    return sorted(found)


def sample(rng, n):
    words = ["a", "A", "b", "Ünï", "ñ", "c", "don't", "\x00", "日本"]
    return "".join(rng.choice(words) + rng.choice([" ", " ", " ", "\t ", ". ", ",", "\n", "\x0b"]) for _ in range(n))


@pytest.mark.parametrize("filtered", [True, False])
def test_brute_force(spark, monkeypatch, filtered):
    """With the Bloom filter, and with the semi-join that is taken beyond its size."""
    if not filtered:
        monkeypatch.setattr(phrases, "FILTER", 0)
    rng = random.Random(11)
    rows = [(rng.choice(["en", "fr", "und", None]), sample(rng, rng.randint(0, 200))) for _ in range(60)]
    rows += [("en", None), (None, ""), ("fr", "..!"), ("xx", "one"), rows[3], rows[3], ("de", "la " * 400)]
    docs = spark.createDataFrame([(*r, 1, "x") for r in rows], "lang string, text string, n long, chunk string").repartition(5)
    for longest, least, inside, count in [(3, 10, 50, 2000), (2, 3, 50, 7), (4, 5, 80, 30), (3, 10, 100, 3)]:
        got = [(*r[:2], bytes(r[2]), *r[3:]) for r in mine_phrases(docs, longest, least, inside, count).collect()]
        assert sorted(got) == brute(rows, longest, least, inside, count)


def test_empty_table(spark):
    assert mine_phrases(spark.createDataFrame([], "doc_id long, lang string, text string")).count() == 0


def test_pieces_are_cut_between_them(monkeypatch):
    rng = random.Random(2)
    text = sample(rng, 3000).encode()
    whole = pieces_of(text)
    assert len(whole) == 1
    monkeypatch.setattr(phrases, "CHUNK", 100)
    parts = pieces_of(text)
    assert len(parts) > 20 and b"\xff".join(parts) == whole[0]
    assert pieces_of(b"x" * 1000) == [b"x" * 1000]


def test_exact_scores(spark):
    """Products beyond 64 bits are floored exactly, and ties go to the shortest first part."""
    big = 9_007_199_254_740_993
    rows = [(big, [big + 2, big + 4], [big + 6, big + 8]), (3, [7, 3], [3, 7]), (10**13, [10**13], [10**13])]
    frame = spark.createDataFrame(rows, "a long, firsts array<long>, lasts array<long>").select("*", lowest_cut().alias("cut"))
    for r in frame.collect():
        cuts = [(10**6 * r["a"] ** 2 // (l * r["lasts"][-1 - k]), k, l, r["lasts"][-1 - k]) for k, l in enumerate(r["firsts"])]
        assert tuple(r["cut"]) == min(cuts)


def test_ranks_in_parts(spark, monkeypatch):
    rows = spark.range(5000).select(
        F.when(F.col("id") % 10 == 0, "b").otherwise("a").alias("g"), (F.col("id") * 7919 % 1000).alias("v"),
        F.col("id").cast("string").cast("binary").alias("words"),
    )
    order = [F.desc("v"), F.asc("words")]
    whole = sorted(map(tuple, first_rows(rows, "g", order, 20).collect()))
    monkeypatch.setattr(phrases, "RANKED", 100)
    assert sorted(map(tuple, first_rows(rows, "g", order, 20).collect())) == whole and len(whole) == 40
    # Parts no larger than what they keep: ranked at once.
    monkeypatch.setattr(phrases, "RANKED", 10)
    assert sorted(map(tuple, first_rows(rows, "g", order, 20).collect())) == whole
