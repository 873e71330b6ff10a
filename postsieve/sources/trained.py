"""Default scorers made with Spark ML, for use where no pretrained model is plugged in."""

from __future__ import annotations

from pyspark.ml import Pipeline
from pyspark.ml.classification import LogisticRegression
from pyspark.ml.feature import HashingTF, Normalizer, RegexTokenizer
from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from postsieve.sources.scores import Scorer

_WORD = r"[\p{L}\p{N}_]+"


def _features(size: int) -> list:
    return [
        RegexTokenizer(inputCol="input", outputCol="words", pattern=_WORD, gaps=False),
        HashingTF(inputCol="words", outputCol="counts", numFeatures=size),
        Normalizer(inputCol="counts", outputCol="features"),
    ]


def hashing_embedder(size: int = 256) -> Scorer:
    """Texts to unit vectors of hashed word counts; equal texts get equal vectors."""

    def transform(inputs: DataFrame) -> DataFrame:
        # None of the three stages learns from data, so fitting runs no job.
        vectors = Pipeline(stages=_features(size)).fit(inputs).transform(inputs)
        return vectors.select("input_key", vector_to_array("features", "float32").alias("embedding"))

    return Scorer(transform=transform)


def train_text_classifier(
    examples: DataFrame, names: dict[int, str], size: int = 1 << 14, iterations: int = 20
) -> Scorer:
    """Logistic regression over hashed words.  ``examples`` has ``text`` and ``label`` (0, 1, ...)."""
    training = examples.select(F.col("text").alias("input"), F.col("label").cast("double").alias("label"))
    stages = [*_features(size), LogisticRegression(maxIter=iterations, regParam=0.01)]
    model = Pipeline(stages=stages).fit(training)
    ordered = [names[i] for i in range(len(names))]

    def transform(inputs: DataFrame) -> DataFrame:
        scored = model.transform(inputs).select("input_key", vector_to_array("probability").alias("p"))
        labels = F.array(*[F.lit(n) for n in ordered])
        return scored.select("input_key", F.map_from_arrays(labels, F.col("p")).alias("scores"))

    return Scorer(transform=transform)
