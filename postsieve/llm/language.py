"""Language identification with a string kernel.

A text is the set of its character n-grams (lower case, n from 1 to 3, hashed to 16 bits).  The
blended-spectrum presence kernel of two texts is the size of their common set over the geometric
mean of both sizes.  One-versus-rest kernel ridge regression is solved in the space that landmark
texts span (Nyström), and whole batches are scored with two matrix products: n-gram presence times
landmarks gives kernel values, kernel values times dual weights gives one score a language.
"""

from __future__ import annotations

from dataclasses import dataclass

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from postsieve.llm.common import typed

BUCKETS = 1 << 16
UNKNOWN = "und"
#: Texts to a matrix product.
BATCH = 128


def has_letter(text: str | None) -> bool:
    return text is not None and any(map(str.isalpha, text))


def presence(text: str, longest: int = 3, size: int = 1 << 20):
    """Sorted bucket numbers of the n-grams in the whole ``text``, n from 1 to ``longest``."""
    import numpy as np

    seen = np.zeros(BUCKETS, bool)
    lower = text.lower()
    for first in range(0, max(1, len(lower)), size):
        part = lower[first : first + size + longest - 1]
        codes = np.frombuffer(part.encode("utf-32-le", "surrogatepass"), "<u4").astype(np.uint64)
        gram = np.zeros(len(codes), np.uint64)
        for n in range(1, longest + 1):
            if len(codes) < n:
                break
            gram = gram[: len(codes) - n + 1] * np.uint64(0x1000193) + codes[n - 1 :] + np.uint64(1)
            mixed = (gram + np.uint64(n)) * np.uint64(0x9E3779B97F4A7C15)
            seen[(mixed >> np.uint64(48)).astype(np.int64)] = True
    return np.flatnonzero(seen)


@dataclass
class LanguageModel:
    """Landmarks' n-grams (column of each bucket or -1, presence matrix, set sizes), dual weights."""

    languages: list[str]
    column: object
    landmarks: object
    roots: object
    weights: object

    def kernel(self, sets):
        import numpy as np

        seen = np.zeros((len(sets), self.landmarks.shape[0]), np.float32)
        for row, found in enumerate(sets):
            known = self.column[found]
            seen[row, known[known >= 0]] = 1
        sizes = np.sqrt(np.maximum(1, [len(s) for s in sets]))
        return (seen @ self.landmarks) / self.roots / sizes[:, None]

    def scores(self, sets):
        return self.kernel(sets) @ self.weights


def fit(sets: list, labels: list[str], landmarks: int, ridge: float) -> LanguageModel | None:
    """Kernel ridge regression on ``sets``; every k-th of each language is a landmark."""
    import numpy as np

    languages = sorted(set(labels))
    if not languages:
        return None
    share = max(1, landmarks // len(languages))
    chosen = [i for name in languages for i in [k for k, x in enumerate(labels) if x == name][:share]]
    used = np.unique(np.concatenate([sets[i] for i in chosen]))
    column = np.full(BUCKETS, -1, np.int32)
    column[used] = np.arange(len(used))
    matrix = np.zeros((len(used), len(chosen)), np.float32)
    for k, i in enumerate(chosen):
        matrix[column[sets[i]], k] = 1
    roots = np.sqrt([max(1, len(sets[i])) for i in chosen])
    model = LanguageModel(languages, column, matrix, roots, None)
    rows = [model.kernel(sets[i : i + BATCH]) for i in range(0, len(sets), BATCH)]
    k_nm, k_mm = np.concatenate(rows), model.kernel([sets[i] for i in chosen])
    target = np.where(np.array(labels)[:, None] == np.array(languages)[None, :], 1.0, 0.0)
    # Every language weighs the same, however many rows it has.
    weight = np.array([1 / labels.count(x) for x in labels])[:, None]
    left = k_nm.T @ (k_nm * weight) + ridge * k_mm + 1e-9 * np.eye(len(chosen))
    model.weights = np.linalg.solve(left, k_nm.T @ (target * weight))
    return model


def held_out(doc_id="doc_id"):
    """True for rows never learnt from: crc32 of the id as text divisible by 5, or no id."""
    return F.coalesce(F.crc32(F.col(doc_id).cast("string").cast("binary")) % 5 == 0, F.lit(True))


def train(docs: DataFrame, sample: int = 1600, landmarks: int = 160, ridge: float = 1e-4) -> LanguageModel | None:
    """Learn from ``text`` and non-NULL ``lang`` of rows that aren't held out.

    At most ``sample`` texts over all languages, equally many of each as far as there are, chosen
    by a hash of ``doc_id``; their n-gram sets are all that reaches the driver.  None without any.
    """
    rows = typed(docs, doc_id="long", text="string", lang="string")
    known = rows.where(F.col("lang").isNotNull() & F.col("text").isNotNull() & ~held_out())
    count = known.select("lang").distinct().count()
    if not count:
        return None
    order = Window.partitionBy("lang").orderBy(F.xxhash64("doc_id"), "doc_id")
    ids = known.select("doc_id", "lang").withColumn("n", F.row_number().over(order))
    ids = ids.where(F.col("n") <= max(1, sample // count)).select("doc_id", "lang").distinct()
    chosen = known.join(F.broadcast(ids), ["doc_id", "lang"], "left_semi")

    def sets(batches):
        import numpy as np

        for batch in batches:
            for key, text, lang in zip(*[c.to_pylist() for c in batch.columns]):
                if has_letter(text):
                    found = presence(text).astype("<u2").tobytes()
                    yield pa.RecordBatch.from_pydict({"doc_id": [key], "lang": [lang], "grams": [found]})

    found = chosen.select("doc_id", "text", "lang").mapInArrow(sets, "doc_id long, lang string, grams binary")
    import numpy as np

    got = sorted(found.collect(), key=lambda r: (r["lang"], r["doc_id"], r["grams"]))
    return fit([np.frombuffer(r["grams"], "<u2") for r in got], [r["lang"] for r in got], landmarks, ridge)


def predict_texts(model: LanguageModel | None, texts: list[str | None]):
    """Language and score (0 to 1) of each text; ``und`` and 0 without letters or without a model."""
    import numpy as np

    names, scores = [UNKNOWN] * len(texts), [0.0] * len(texts)
    if model is None:
        return names, scores
    rows = [i for i, t in enumerate(texts) if has_letter(t)]
    for first in range(0, len(rows), BATCH):
        some = rows[first : first + BATCH]
        found = model.scores([presence(texts[i]) for i in some])
        best = found.argmax(axis=1)
        for i, k, value in zip(some, best, found[np.arange(len(some)), best]):
            names[i], scores[i] = model.languages[k], float(min(1.0, max(0.0, value)))
    return names, scores


def identify(docs: DataFrame, model: LanguageModel | None) -> DataFrame:
    """``doc_id``, ``held_out``, ``lang_pred``, ``score`` for every row of ``docs``.

    The prediction reads ``text`` alone.  NULL, empty and letterless texts are ``und`` with score
    0; ties go to the first language by name; repeated rows give equal rows; an empty table none.
    """
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def run(batches):
        for batch in batches:
            names, scores = predict_texts(shared.value, batch.column(1).to_pylist())
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(names), pa.array(scores, pa.float64())], ["doc_id", "lang_pred", "score"]
            )

    rows = typed(docs, doc_id="long", text="string")
    found = rows.mapInArrow(run, "doc_id long, lang_pred string, score double")
    return found.select("doc_id", held_out().alias("held_out"), "lang_pred", "score")


def keep_identified(docs: DataFrame, model: LanguageModel | None, least: float = 0.1) -> DataFrame:
    """The rows of ``docs``, all columns as they are, whose language is known with ``least`` score.

    A text in letters no landmark has scores 0.  NULL, empty and letterless texts go; without a model everything with a letter stays.
    """
    shared, place = docs.sparkSession.sparkContext.broadcast(model), docs.columns.index("text")

    def run(batches):
        for batch in batches:
            texts = batch.column(place).to_pylist()
            if shared.value is None:
                keep = [has_letter(t) for t in texts]
            else:
                names, scores = predict_texts(shared.value, texts)
                keep = [n != UNKNOWN and s >= least for n, s in zip(names, scores)]
            yield batch.filter(pa.array(keep, pa.bool_()))

    return docs.mapInArrow(run, docs.schema)
