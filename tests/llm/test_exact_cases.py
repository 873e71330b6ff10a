"""Items without rare runs, and vectors of several lengths."""

import math
import random

from postsieve.llm.decontamination import contaminated, keep_clean, words_of
from postsieve.llm.embedding_links import link_vectors


def test_items_without_a_rare_run_are_found_exactly(spark):
    rng = random.Random(4)
    common = ["the", "of", "and"]
    texts = [" ".join(rng.choice(common) for _ in range(400)) for _ in range(20)]
    texts += ["前の 日本語の長い文 後の", "日本語の長い文", "x 日本語の長い文字 y", "", None, "the of and the of and the of and the of and the of and end"]
    items = ["日本語の長い文", "and and of", "the of and the of and the of and the of and the of and", "の", ""]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    benchmark = spark.createDataFrame(list(enumerate(items)), "item_id long, text string")
    exact = set()
    for i, text in enumerate(texts):
        words = words_of(text)
        for k, item in enumerate(map(words_of, items)):
            if item and any(words[j : j + len(item)] == item for j in range(len(words))):
                exact.add((i, k))
    rows = contaminated(docs, benchmark).collect()
    found = {(r["doc_id"], r["item_id"]) for r in rows}
    assert exact <= found and {(20, 0), (21, 0)} == {f for f in found if f[1] == 0}
    # Where an item stands exactly its whole is aligned.
    assert all(r["score"] == 1 for r in rows if (r["doc_id"], r["item_id"]) in exact)
    clean = {r["doc_id"] for r in keep_clean(docs, benchmark).collect()}
    assert clean == set(range(len(texts))) - {i for i, _ in found}


def cosine(a, b):
    return sum(x * y for x, y in zip(a, b)) / math.sqrt(sum(x * x for x in a)) / math.sqrt(sum(y * y for y in b))


def test_vectors_of_every_length(spark):
    rng = random.Random(2)
    vectors = [[1.0], [3.0], [-2.0], [1.0, 0.0], [1.0, 0.0], [1.0, 0.1], [0.0, 1.0], [], None, [0.0, 0.0]]
    for n in (3, 9, 20):
        base = [[rng.gauss(0, 1) for _ in range(n)] for _ in range(12)]
        vectors += base + [[x + rng.gauss(0, 0.15) for x in v] for v in base for _ in range(2)]
    frame = spark.createDataFrame(list(enumerate(vectors)), "vec_id long, embedding array<double>")
    real = [i for i, v in enumerate(vectors) if v and any(v)]
    links = {i: [j for j in real if j != i and len(vectors[i]) == len(vectors[j]) and cosine(vectors[i], vectors[j]) >= 0.95] for i in real}
    component = {}
    for i in range(len(vectors)):
        seen, todo = {i}, [i]
        while todo:
            todo = [j for k in todo for j in links.get(k, []) if j not in seen]
            seen.update(todo)
        component[i] = min(seen)
    got = {r["vec_id"]: (r["n_links"], r["component_id"]) for r in link_vectors(frame).collect()}
    assert got == {i: (len(links.get(i, [])), component[i]) for i in range(len(vectors))}
    assert sum(n for n, _ in got.values()) > 40
