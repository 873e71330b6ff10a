"""Zero-shot scorers which know what they are asked, and posts without any score."""

import pandas as pd
import pytest
from pyspark.sql import functions as F

from postsieve import Catalog, Scorer, audit_nodes, compile_feeds, filter_posts, match_feeds
from postsieve.operators import labels as L
from tests.posts import ids, posts, view
from tests.test_feeds import image, stored_scores

CATS, DOGS = {"text_arbitrary": ["cats", ">", 0.5]}, {"text_arbitrary": ["dogs", ">", 0.5]}


def asking(calls):
    def predict(texts: pd.Series, labels: tuple, multi_label: bool) -> pd.Series:
        assert labels[1] == f"not_{labels[0]}" and multi_label is False
        calls.add(len(texts))
        found = [float(labels[0] in text) for text in texts]
        return pd.Series([{labels[0]: f, labels[1]: 1 - f} for f in found])

    return predict


def test_two_categories_in_one_filter(spark, tmp_path):
    df = posts(spark, [{"text": t} for t in ("cats", "dogs", "cats and dogs", "cats", "none of them")] + [{}])
    calls = spark.sparkContext.accumulator(0)
    cat = Catalog(scorers={L.ZERO_SHOT_TEXT_MODEL: Scorer(predict_labels=asking(calls))}, keep=str(tmp_path))
    assert ids(filter_posts(df, {"or": [CATS, DOGS]}, view(df), cat)) == [0, 1, 2, 3]
    assert calls.value == 10  # five different texts ("none" for the missing one), asked twice each
    assert ids(filter_posts(df, {"and": [CATS, DOGS]}, view(df), cat)) == [2]
    assert calls.value == 10
    none = {"and": [{"text_arbitrary": ["cats", "<", 0.5]}, {"text_arbitrary": ["dogs", "<", 0.5]}]}
    feeds = compile_feeds({1: {"filter": CATS}, 2: {"filter": none}}, {}, view(df), catalog=cat)
    got = match_feeds(df, feeds, cat).select("algorithm_id", "rkey").collect()
    assert sorted((r.algorithm_id, int(r.rkey)) for r in got) == [(1, 0), (1, 2), (1, 3), (2, 4), (2, 5)]


def test_images_by_category(spark):
    embeds = [{"$type": "app.bsky.embed.images", "images": [image(c)]} for c in ("cats", "dogs")]
    df = posts(spark, [{"text": "x", "embed": e} for e in embeds])

    def predict(urls, labels, multi_label):
        return urls.map(lambda u: [float(labels[0] in u), 0.0])

    cat = Catalog(scorers={L.ZERO_SHOT_IMAGE_MODEL: Scorer(predict_labels=predict)})
    conditions = [{"image_arbitrary": [c, ">", 0.5]} for c in ("cats", "dogs")]
    assert [ids(filter_posts(df, c, view(df), cat)) for c in conditions] == [[0], [1]]


def test_transform_is_told_the_labels(spark):
    df = posts(spark, [{"text": "cats"}, {"text": "dogs"}])

    def transform(inputs):
        first = F.get("labels", F.lit(0))
        hit = F.contains("input", first).cast("double")
        return inputs.select("input_key", F.create_map(first, F.when(F.col("multi_label"), 0.0).otherwise(hit)).alias("scores"))

    cat = Catalog(scorers={L.ZERO_SHOT_TEXT_MODEL: Scorer(transform=transform)})
    assert ids(filter_posts(df, DOGS, view(df), cat)) == [1]


def test_scorers_of_the_other_kind_are_refused(spark):
    df = posts(spark, [{"text": "a"}])
    plain, asked = Scorer(lambda t: t), Scorer(predict_labels=lambda t, labels, multi: t)
    with pytest.raises(ValueError, match="takes no labels"):
        filter_posts(df, CATS, view(df), Catalog(scorers={L.ZERO_SHOT_TEXT_MODEL: plain}))
    with pytest.raises(ValueError, match="needs labels"):
        filter_posts(df, {"toxicity_analysis": ["Toxic", ">", 0]}, view(df), Catalog(scorers={L.TOXICITY.model: asked}))


@pytest.mark.parametrize("unscored, low, high", [("false", [1], [0]), ("zero", [1, 2, 3], [0])])
def test_posts_without_scores(spark, unscored, low, high):
    df = posts(spark, [{"text": "a"}, {"text": "b"}, {"text": "new"}, {}])
    scores = stored_scores(spark, L.TOXICITY.model, {"a": {"Toxic": 0.9}, "b": {"Insult": 0.9}})
    images = spark.createDataFrame([], "model string, input_key string, probs array<double>")
    cat = Catalog(scores=scores, image_scores=images, unscored=unscored)
    at_most, above = {"toxicity_analysis": ["Toxic", "<=", 0.2]}, {"toxicity_analysis": ["Toxic", ">", 0.2]}
    assert ids(filter_posts(df, at_most, view(df), cat)) == low
    assert ids(filter_posts(df, {"no_nsfw": [0.2]}, view(df), cat)) == low
    assert ids(filter_posts(df, above, view(df), cat)) == high
    assert ids(filter_posts(df, {"or": [at_most, above]}, view(df), cat, staged=False)) == sorted(low + high)
    answers = audit_nodes(df, at_most, view(df), cat)
    assert answers.count() == 4


def test_posts_without_scores_can_be_an_error(spark):
    df = posts(spark, [{"text": "a"}, {"text": "new"}])
    scores = stored_scores(spark, L.TOXICITY.model, {"a": {"Toxic": 0.9}})
    condition = {"toxicity_analysis": ["Toxic", "<=", 0.2]}
    with pytest.raises(Exception, match="without a result of model"):
        filter_posts(df, condition, view(df), Catalog(scores=scores, unscored="raise")).collect()
    with pytest.raises(ValueError, match="unscored"):
        Catalog(unscored="maybe")


@pytest.mark.parametrize("unscored, expected", [("false", [0]), ("zero", [0, 1])])
def test_similarity_without_a_vector(spark, unscored, expected):
    from postsieve.functions.keys import score_key

    df = posts(spark, [{"text": "x"}, {"text": "unknown"}])
    rows = spark.createDataFrame([("anchor", [1.0, 0.0]), ("x", [0.0, 1.0])], "t string, embedding array<float>")
    stored = rows.select(F.lit("m").alias("model"), score_key("m", F.col("t")).alias("input_key"), "embedding")
    condition = {"text_similarity": ["text", {"model_name": "m", "anchor_text": "anchor"}, "<", 0.5]}
    cat = Catalog(embeddings=stored, unscored=unscored)
    assert ids(filter_posts(df, condition, view(df), cat)) == expected
