"""Predicates over model scores: text classifiers, zero-shot, images and embedding similarity.

A builder only states which scores it waits for; ``postsieve.plans.attach`` joins them in.
"""

from __future__ import annotations

from collections.abc import Callable
from typing import Any

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

from postsieve.functions.compare import compare
from postsieve.functions.field import Field
from postsieve.functions.keys import zero_shot_labels, zero_shot_suffix
from postsieve.operators import labels
from postsieve.operators.entities import entity_excludes
from postsieve.operators.leaf import (
    COST_MODEL,
    ImageScoreNeed,
    Leaf,
    PostView,
    SimilarityNeed,
    TextScoreNeed,
)


def category_score(scores: Column, category: str) -> Column:
    """The probability of ``category``, 0 where the model did not report it (or there are no scores)."""
    return F.coalesce(F.try_element_at(scores, F.lit(category)), F.lit(0.0))


def rename_labels(scores: Column, labels_map: dict[str, str]) -> Column:
    """Model labels to display labels; a label without a display name keeps its own."""
    names = F.create_map(*[F.lit(x) for pair in labels_map.items() for x in pair])
    return F.transform_keys(scores, lambda k, _: F.coalesce(F.try_element_at(names, k), k))


def _threshold(score: Column, comparator: str, threshold: Any) -> Column:
    return compare(Field(score, T.DoubleType()), comparator, threshold)


def _known(found: Column, test: Column) -> Column:
    """What has not been scored passes no test, neither for high scores nor for low ones."""
    return found.isNotNull() & test


def text_classifier(model: str) -> Callable[..., Leaf]:
    def build(view: PostView, category: str, comparator: str, threshold: Any) -> Leaf:
        need = TextScoreNeed(model)
        return _text_leaf(need, category, comparator, threshold)

    return build


def _text_leaf(need: TextScoreNeed, category: str, comparator: str, threshold: Any) -> Leaf:
    found = F.col(need.column)
    score = category_score(found, category)
    return Leaf(_known(found, _threshold(score, comparator, threshold)), COST_MODEL, (need,), score)


def text_arbitrary(view: PostView, category: str, comparator: str, threshold: Any) -> Leaf:
    need = TextScoreNeed(labels.ZERO_SHOT_TEXT_MODEL, zero_shot_suffix(category), "none", zero_shot_labels(category))
    return _text_leaf(need, category, comparator, threshold)


def text_similarity(view: PostView, attribute: str, model_params: dict, comparator: str, threshold: Any) -> Leaf:
    need = SimilarityNeed(model_params["model_name"], attribute, model_params["anchor_text"])
    score = F.col(need.column)
    test = _known(score, _threshold(score, comparator, threshold))
    return Leaf(test, COST_MODEL, (need,), F.coalesce(score, F.lit(0.0)))


def _image(view: PostView, need: ImageScoreNeed, comparator: str, threshold: Any) -> Leaf:
    """TRUE without images, FALSE when no image could be scored, else the best image decides."""
    score = F.col(need.column)
    decided = (
        F.when(F.size(view.shared_image_urls()) <= 0, F.lit(True))
        .when(score.isNull(), F.lit(False))
        .otherwise(_threshold(score, comparator, threshold))
    )
    return Leaf(decided, COST_MODEL, (need,), F.coalesce(score, F.lit(0.0)))


def image_nsfw(view: PostView, category: str, comparator: str, threshold: Any) -> Leaf:
    # The model reports (safe, not safe); any other category reads the first of the two.
    position = 1 if category == "NSFW" else 0
    return _image(view, ImageScoreNeed(labels.NSFW_IMAGE_MODEL, category, position), comparator, threshold)


def image_arbitrary(view: PostView, category: str, comparator: str, threshold: Any) -> Leaf:
    return _image(view, ImageScoreNeed(labels.ZERO_SHOT_IMAGE_MODEL, category, labels=zero_shot_labels(category)), comparator, threshold)


def no_nsfw(view: PostView, threshold: Any) -> Leaf:
    """No adult label, not toxic and no adult image."""
    parts = [
        entity_excludes(view, "labels", list(labels.ADULT_LABELS)),
        text_classifier(labels.TOXICITY.model)(view, "Toxic", "<=", threshold),
        image_nsfw(view, "NSFW", "<=", threshold),
    ]
    combined = parts[0].predicate & parts[1].predicate & parts[2].predicate
    return Leaf(combined, COST_MODEL, tuple(n for p in parts for n in p.needs))
