"""Kept model results, and crawls that add up their looks."""

import pandas as pd
from pyspark.sql import functions as F

from postsieve import Catalog, PostView
from postsieve.operators import labels as L
from postsieve.plans.attach import TEXT_RESULT
from postsieve.plans.history import Crawl, run_backfill, run_backtest
from postsieve.plans.match import filter_posts
from postsieve.sources.score_store import ScoreStore
from postsieve.sources.scores import Scorer, score_inputs
from tests.posts import ids, posts, view

MODEL = L.SENTIMENT.model


def counting(spark):
    calls = spark.sparkContext.accumulator(0)

    def predict(texts: pd.Series) -> pd.Series:
        calls.add(len(texts))
        return texts.map(lambda t: {"Positive": float(len(t) % 2)})

    return calls, Scorer(predict)


def frame(spark, keys):
    return spark.createDataFrame([(k, "x" * len(k)) for k in keys], "input_key string, input string")


def test_results_are_kept_once(spark, tmp_path):
    calls, scorer = counting(spark)
    store = ScoreStore(spark, str(tmp_path), TEXT_RESULT, buckets=4, merge_at=3)

    def score(some):
        return score_inputs(some, scorer, TEXT_RESULT)

    names = [f"k{i}" for i in range(40)]
    for first in range(0, 40, 5):  # each write repeats part of the one before
        got = store.complete("m", frame(spark, names[max(0, first - 3) : first + 5]), score)
        assert sorted(r.input_key for r in got.collect()) == sorted(names[max(0, first - 3) : first + 5])
    assert calls.value == 40
    assert sorted(r.input_key for r in store.read("m").collect()) == sorted(names) and store.read("other").count() == 0
    # Buckets have been merged, and a look-up reads those of its inputs alone.
    entry = store.table.latest()[1]
    assert all(len(sets) < 3 for sets in entry["m"].values())
    buckets = store.buckets_of(frame(spark, names[:1]))
    assert len(buckets) == 1 and store.sets(entry, "m", buckets) == entry["m"][str(buckets[0])]
    assert store.complete("m", frame(spark, []), score).count() == 0 and calls.value == 40


def test_two_writers_of_the_same_inputs(spark, tmp_path):
    """The second commits after the first: nothing is stored twice, nothing is scored again."""
    calls, scorer = counting(spark)
    one, two = (ScoreStore(spark, str(tmp_path), TEXT_RESULT, buckets=4) for _ in range(2))

    def score(some):
        return score_inputs(some, scorer, TEXT_RESULT)

    def late(some):
        if one.table.latest()[0] == 0:
            one.complete("m", frame(spark, ["a", "b"]), score)
        return score(some)

    got = two.complete("m", frame(spark, ["b", "c"]), late)
    assert sorted(r.input_key for r in got.collect()) == ["b", "c"]
    assert sorted(r.input_key for r in one.read("m").collect()) == ["a", "b", "c"]
    assert calls.value == 4  # "b" by both, as they ran at once


def test_filter_keeps_what_it_scores(spark, tmp_path):
    calls, scorer = counting(spark)
    df = posts(spark, [{"text": t} for t in ["a", "bb", "bb", "ccc"]])
    catalog = Catalog(scorers={MODEL: scorer}, keep=str(tmp_path))
    for _ in range(2):
        assert ids(filter_posts(df, {"sentiment_analysis": ["Positive", ">", 0.5]}, view(df), catalog)) == [0, 3]
    assert calls.value == 3


def history(spark, n=4000):
    df = spark.range(n).select(F.col("id").alias("time_us"), F.lit("d").alias("did"), F.col("id").cast("string").alias("rkey"), F.repeat(F.lit("x"), (F.col("id") % 97).cast("int")).alias("text"))
    return df.select("time_us", "did", "rkey", F.struct("text").alias("record"))


def test_backtest_scores_each_text_once(spark):
    """Looks add up: the model sees each text of the looks once, and the answer is that of one look."""
    calls, scorer = counting(spark)
    df = history(spark)
    condition, shape = {"sentiment_analysis": ["Positive", ">", 0.5]}, PostView(df.schema, ("did", "rkey"))
    found = {}
    for first_look in (2, 1000):
        calls.value = 0
        crawl = Crawl(0, 3999, 10, 100, 600, first_look=first_look)
        progress, matches = run_backtest(df, condition, shape, crawl, Catalog(scorers={MODEL: scorer}))
        found[first_look] = sorted(map(tuple, progress.collect())), sorted((r.time_us, r.batch_no) for r in matches.collect())
        assert calls.value == 97
    assert found[2] == found[1000] and found[2][0][-1][-1] >= 600 > found[2][0][-1][-1] - 100


def test_crawl_without_limit_takes_all(spark):
    calls, scorer = counting(spark)
    df = history(spark, 3000)
    catalog = Catalog(scorers={MODEL: scorer})
    matches = run_backfill(df, {"sentiment_analysis": ["Positive", ">", 0.5]}, PostView(df.schema, ("did", "rkey")), Crawl(-1, 2999, 10, first_look=3), catalog)
    assert matches.count() == sum(n % 97 % 2 for n in range(3000)) > 500 and calls.value == 97
