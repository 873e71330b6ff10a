"""Stored model results, and scoring only what is not stored yet."""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass

import pandas as pd
from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from postsieve.operators.labels import TEXT_OPERATORS
from postsieve.operators.models import rename_labels
from postsieve.sources.score_store import ScoreStore

#: Display labels of the text models.
LABELS = {text_model.model: text_model.labels for text_model in TEXT_OPERATORS.values()}


@dataclass(frozen=True)
class Scorer:
    """A model hook.

    ``predict`` maps a Series of inputs (texts or URLs) to a Series of results of the stored type.
    It runs inside executors on Arrow batches; heavy state is best loaded lazily by ``predict``
    itself.  ``predict_labels`` is the same for zero-shot models: it is also given the labels to tell
    apart, and whether several may hold at once.  Every set of labels has calls of its own.

    ``transform`` is the alternative for Spark ML pipelines: it maps a DataFrame ``(input_key, input)``
    to ``(input_key, <result>)``; for zero-shot models it has ``labels`` and ``multi_label`` too.
    """

    predict: Callable[[pd.Series], pd.Series] | None = None
    transform: Callable[[DataFrame], DataFrame] | None = None
    predict_labels: Callable[[pd.Series, tuple[str, ...], bool], pd.Series] | None = None

    def answers(self, labels: tuple[str, ...]) -> bool:
        """Whether it can be asked about ``labels`` (none: about inputs alone)."""
        asked = self.predict_labels if labels else self.predict
        return self.transform is not None or asked is not None


def distinct_inputs(inputs: DataFrame) -> DataFrame:
    """One row per input.  Copies collapse before the shuffle, so a text that makes up a third of
    all posts reaches a reducer once per upstream task."""
    return inputs.select("input_key", "input").distinct()


def missing_inputs(inputs: DataFrame, stored: DataFrame | None) -> DataFrame:
    """Distinct inputs without a stored result."""
    wanted = distinct_inputs(inputs)
    return wanted if stored is None else wanted.join(stored.select("input_key"), "input_key", "left_anti")


def score_inputs(
    inputs: DataFrame, scorer: Scorer, result: T.StructField, labels: tuple[str, ...] = (), multi_label: bool = False
) -> DataFrame:
    """Run the scorer over ``(input_key, input)``, asking about ``labels`` if there are any."""
    if scorer.transform is not None:
        if labels:
            asked = {"labels": F.array(*map(F.lit, labels)), "multi_label": F.lit(multi_label)}
            inputs = inputs.withColumns(asked)
        return scorer.transform(inputs).select("input_key", F.col(result.name).cast(result.dataType))
    asking = scorer.predict_labels
    predict = (lambda texts: asking(texts, labels, multi_label)) if labels else scorer.predict
    name = result.name

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            yield pd.DataFrame({"input_key": batch["input_key"], name: predict(batch["input"])})

    schema = T.StructType([T.StructField("input_key", T.StringType()), result])
    return inputs.select("input_key", "input").mapInPandas(run, schema)


def display_labels(fresh: DataFrame, model: str, result: T.StructField) -> DataFrame:
    """Scores by the names under which feeds ask for them, if ``model`` has such names."""
    names = LABELS.get(model)
    if not names or not isinstance(result.dataType, T.MapType):
        return fresh
    return fresh.withColumn(result.name, rename_labels(F.col(result.name), names))


def complete_scores(
    model: str,
    stored: DataFrame | None,
    result: T.StructField,
    inputs: DataFrame | None = None,
    scorer: Scorer | None = None,
    store: ScoreStore | None = None,
    labels: tuple[str, ...] = (),
) -> DataFrame:
    """Results of ``model`` by ``input_key``: those stored, and new ones for inputs without.

    One row an input: a key that was stored twice (by two batches, or by a retried write) counts
    once.  New results of a text model get its display labels; with a ``store`` they are kept there
    before they are used, and only what it lacks is scored.  At least one of ``stored`` and
    ``scorer`` (with its ``inputs``) must be given.
    """
    if stored is None:
        known = None
    else:
        known = stored.where(F.col("model") == model).select("input_key", result.name)
        known = known.dropDuplicates(["input_key"])
    if scorer is None or inputs is None:
        return known
    missing = missing_inputs(inputs, known)

    def score(some: DataFrame) -> DataFrame:
        return display_labels(score_inputs(some, scorer, result, labels), model, result)

    fresh = score(missing) if store is None else store.complete(model, missing, score)
    return fresh if known is None else known.unionByName(fresh)


def store_missing_scores(
    path: str, model: str, inputs: DataFrame, scorer: Scorer, result: T.StructField
) -> DataFrame:
    """Score what the store at ``path`` lacks, keep it there, and return the model's results.

    Storing results first means that neither a lost executor nor a second reader makes the model run
    again; see ``ScoreStore`` for retries and several writers.
    """
    store = ScoreStore(inputs.sparkSession, path, result)
    complete_scores(model, None, result, inputs, scorer, store)
    return store.read(model).withColumn("model", F.lit(model))


def read_scores(spark: SparkSession, path: str, result: T.StructField) -> DataFrame:
    """A stored score table; an absent or empty one reads as no rows."""
    key, model = T.StructField("input_key", T.StringType()), T.StructField("model", T.StringType())
    schema = T.StructType([key, result, model])
    try:
        return spark.read.schema(schema).parquet(path)
    except AnalysisException as error:
        if error.getCondition() != "PATH_NOT_FOUND":
            raise
        return spark.createDataFrame([], schema)
