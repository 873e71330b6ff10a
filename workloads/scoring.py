"""Queries for model-score predicates, embedding similarity and the default scorers."""

from __future__ import annotations

from dataclasses import replace

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from postsieve.functions.keys import score_key, zero_shot_suffix
from postsieve.operators import labels as L
from postsieve.operators.leaf import ImageScoreNeed
from postsieve.operators.models import category_score, rename_labels
from postsieve.plans.attach import TEXT_RESULT, Catalog, max_image_score
from postsieve.plans.match import filter_posts
from postsieve.session import shared_folder
from postsieve.sources.scores import Scorer, missing_inputs, store_missing_scores
from postsieve.sources.trained import hashing_embedder, train_text_classifier
from workloads import bindings as B
from workloads.registry import query

_FIRST = "(SELECT text, min(doc_id) AS first_id FROM documents GROUP BY text)"
_LABELLED = "(SELECT text, max(toxic) AS toxic, max(quality) AS quality FROM documents JOIN labels USING (doc_id) GROUP BY text)"


def _ids(posts: DataFrame, condition: dict, catalog: Catalog, *key: str, staged: bool = True) -> DataFrame:
    return filter_posts(posts, condition, B.view(posts, *key), catalog, staged=staged).select(*key)


def _rule_query(operator: str, category: str, comparator: str, threshold: float, sql_comparator: str) -> None:
    model = L.TEXT_OPERATORS[operator]
    j = list(model.labels.values()).index(category)

    @query(
        operator,
        f"""SELECT doc_id FROM documents JOIN {_FIRST} f USING (text)
            WHERE ((first_id * 7 + {j} * 13) % 100) / 100.0::DOUBLE {sql_comparator} {threshold}""",
    )
    def run(spark: SparkSession, folder: str) -> DataFrame:
        catalog = Catalog(scores=B.rule_scores(spark, folder, model))
        return _ids(B.documents(spark, folder), {operator: [category, comparator, threshold]}, catalog, "doc_id")


_rule_query("content_moderation", "harassment", ">=", 0.6, ">=")
_rule_query("emotion_sentiment_analysis", "Joy", ">", 0.75, ">")
_rule_query("financial_sentiment_analysis", "Negative", "<", 0.3, "<")
_rule_query("sentiment_analysis", "Positive", ">=", 0.5, ">=")
_rule_query("topic_analysis", "Sports", "<=", 0.2, "<=")


@query("language_analysis", "SELECT doc_id FROM documents JOIN (SELECT text, min(lang) AS l FROM documents GROUP BY text) t USING (text) WHERE l = 'fr'")
def language_analysis(spark: SparkSession, folder: str) -> DataFrame:
    catalog = Catalog(scores=B.language_scores(spark, folder, L.LANGUAGE))
    return _ids(B.documents(spark, folder), {"language_analysis": ["French", ">", 0.5]}, catalog, "doc_id")


def _toxicity(spark: SparkSession, folder: str) -> Catalog:
    return Catalog(scores=B.toxicity_scores(spark, folder, L.TOXICITY.model))


@query("toxicity_analysis", f"SELECT doc_id FROM documents JOIN {_LABELLED} s USING (text) WHERE toxic > 0.5")
def toxicity_analysis(spark: SparkSession, folder: str) -> DataFrame:
    return _ids(B.documents(spark, folder), {"toxicity_analysis": ["Toxic", ">", 0.5]}, _toxicity(spark, folder), "doc_id")


@query(
    "score_threshold",
    f"SELECT doc_id FROM documents LEFT JOIN {_LABELLED} s USING (text) WHERE coalesce(quality, 0) <= 0.5",
)
def score_threshold(spark: SparkSession, folder: str) -> DataFrame:
    """A category of a stored score which not every text has."""
    return _ids(B.documents(spark, folder), {"toxicity_analysis": ["Quality", "<=", "0.5"]}, _toxicity(spark, folder), "doc_id")


@query(
    "category_score",
    f"SELECT doc_id, coalesce(toxic, 0)::DOUBLE AS toxic FROM documents JOIN {_LABELLED} s USING (text)",
)
def category(spark: SparkSession, folder: str) -> DataFrame:
    """Model labels renamed to display labels, then one category picked."""
    model = L.TOXICITY.model
    d = B.table(spark, folder, "documents").withColumn("input_key", score_key(model, F.col("text")))
    raw = B.toxicity_scores(spark, folder, model).withColumn(
        "scores", F.create_map(F.lit("toxic"), F.element_at("scores", "Toxic"), F.lit("threat"), F.lit(0.5))
    )
    shown = raw.select("input_key", rename_labels(F.col("scores"), L.TOXICITY.labels).alias("scores"))
    return d.join(shown, "input_key").select("doc_id", category_score(F.col("scores"), "Toxic").alias("toxic"))


@query(
    "score_missing",
    f"""SELECT sha256('{L.TOXICITY.model}:' || text) AS input_key, length(text) AS n FROM (SELECT DISTINCT text FROM documents) d
        WHERE text NOT IN (SELECT text FROM documents JOIN labels USING (doc_id))""",
)
def score_missing(spark: SparkSession, folder: str) -> DataFrame:
    model = L.TOXICITY.model
    d = B.table(spark, folder, "documents")
    inputs = d.select(score_key(model, F.col("text")).alias("input_key"), F.col("text").alias("input"))
    missing = missing_inputs(inputs, B.toxicity_scores(spark, folder, model))
    return missing.select("input_key", F.length("input").cast("long").alias("n"))


@query(
    "score_store_retry",
    """SELECT DISTINCT sha256('lengths:' || text) AS input_key, length(text) % 100 / 100.0::DOUBLE AS score FROM documents""",
)
def score_store_retry(spark: SparkSession, folder: str) -> DataFrame:
    """Texts scored into a store by two writes that overlap, the second of them repeated."""
    d = B.table(spark, folder, "documents").withColumn("input_key", score_key("lengths", F.col("text")))

    def predict(inputs: DataFrame) -> DataFrame:
        score = F.length("input") % 100 / F.lit(100.0)
        return inputs.select("input_key", F.create_map(F.lit("length"), score).alias("scores"))

    path, scorer = shared_folder(spark, "scores"), Scorer(transform=predict)
    for part in (d.where("doc_id % 3 > 0"), d, d):
        inputs = part.select("input_key", F.col("text").alias("input"))
        kept = store_missing_scores(path, "lengths", inputs, scorer, TEXT_RESULT)
    return kept.select("input_key", F.col("scores")["length"].alias("score"))


@query("text_arbitrary", f"SELECT doc_id FROM documents JOIN {_FIRST} f USING (text) WHERE ((first_id * 7) % 100) / 100.0::DOUBLE >= 0.8")
def text_arbitrary(spark: SparkSession, folder: str) -> DataFrame:
    model, name = L.ZERO_SHOT_TEXT_MODEL, "cooking"
    stored = B.zero_shot_scores(spark, folder, model, name, zero_shot_suffix(name))
    return _ids(B.documents(spark, folder), {"text_arbitrary": [name, ">=", 0.8]}, Catalog(scores=stored), "doc_id")


_IMAGES = """(SELECT conv_id, turn, (length(text) * (1 + 6 * n) % 100) / 100.0::DOUBLE AS p
              FROM conversations JOIN (VALUES (0), (1)) i(n) ON role = 'assistant' OR (role = 'user' AND n = 0))"""


def _image_query(operator: str, category_name: str, comparator: str, threshold: float, model: str, position: int) -> None:
    @query(
        operator,
        f"""SELECT c.conv_id, c.turn FROM conversations c
            LEFT JOIN (SELECT conv_id, turn, max(p) AS p FROM {_IMAGES} t WHERE turn <> 4 GROUP BY ALL) s USING (conv_id, turn)
            WHERE role = 'system' OR p {comparator} {threshold}""",
    )
    def run(spark: SparkSession, folder: str) -> DataFrame:
        catalog = Catalog(image_scores=B.image_scores(spark, folder, model, category_name, position))
        posts = B.turns(spark, folder)
        return _ids(posts, {operator: [category_name, comparator, threshold]}, catalog, "conv_id", "turn")


_image_query("image_nsfw", "NSFW", "<=", 0.4, L.NSFW_IMAGE_MODEL, 1)
_image_query("image_arbitrary", "a dog", ">", 0.7, L.ZERO_SHOT_IMAGE_MODEL, 0)


@query("image_max_score", f"SELECT conv_id, max(p) AS best FROM {_IMAGES} t GROUP BY conv_id")
def image_max_score(spark: SparkSession, folder: str) -> DataFrame:
    """Highest image score of whole conversations, however many images one has."""
    need = ImageScoreNeed(L.ZERO_SHOT_IMAGE_MODEL, "a dog")
    scored = B.turn_images(spark, folder).select("conv_id", F.array("p").alias("probs"))
    return max_image_score(scored, ("conv_id",), need).withColumnRenamed(need.column, "best")


@query(
    "no_nsfw",
    f"""SELECT doc_id FROM documents LEFT JOIN labels USING (doc_id) LEFT JOIN {_LABELLED} s USING (text)
        WHERE coalesce(labels.toxic, 0) = 0 AND coalesce(s.toxic, 0) <= 0.4
          AND (n_chars < 2000 OR (doc_id % 100) / 100.0::DOUBLE <= 0.4)""",
)
def no_nsfw(spark: SparkSession, folder: str) -> DataFrame:
    """Documents without a score count as harmless: score 0."""
    return _harmless(spark, folder, "zero")


@query(
    "no_nsfw_scored",
    f"""SELECT doc_id FROM documents LEFT JOIN labels USING (doc_id) JOIN {_LABELLED} s USING (text)
        WHERE coalesce(labels.toxic, 0) = 0 AND coalesce(s.toxic, 0) <= 0.4
          AND (n_chars < 2000 OR (doc_id % 100) / 100.0::DOUBLE <= 0.4)""",
)
def no_nsfw_scored(spark: SparkSession, folder: str) -> DataFrame:
    """Only documents whose text has been scored can be harmless."""
    return _harmless(spark, folder, "false")


def _harmless(spark: SparkSession, folder: str, unscored: str) -> DataFrame:
    """Documents of 2000 characters and more carry one image."""
    posts = B.labelled_documents(spark, folder)
    link = F.when(F.length("record.text") >= 2000, F.concat(F.lit("img"), F.col("doc_id").cast("string")))
    image = F.struct(F.struct(F.struct(link.alias("$link")).alias("ref")).alias("image"))
    embed = F.struct(F.lit("app.bsky.embed.images").alias("$type"), F.array(image).alias("images"))
    posts = posts.withColumn("record", F.col("record").withField("embed", embed))
    urls = posts.select("doc_id", F.explode(B.view(posts, "doc_id").image_urls()).alias("url"))
    p = (F.col("doc_id") % 100) / F.lit(100.0)
    stored = urls.select(
        F.lit(L.NSFW_IMAGE_MODEL).alias("model"),
        score_key(L.NSFW_IMAGE_MODEL, F.col("url"), "NSFW").alias("input_key"),
        F.array(1 - p, p).alias("probs"),
    )
    catalog = replace(_toxicity(spark, folder), image_scores=stored, unscored=unscored)
    return _ids(posts, {"no_nsfw": [0.4]}, catalog, "doc_id")


@query(
    "text_similarity",
    """SELECT vec_id FROM embeddings, (SELECT embedding AS anchor FROM embeddings WHERE vec_id = 0) a
       WHERE list_cosine_similarity(embedding::DOUBLE[], anchor::DOUBLE[]) >= 0.3""",
)
def text_similarity(spark: SparkSession, folder: str) -> DataFrame:
    e = B.table(spark, folder, "embeddings")
    text = F.concat(F.lit("text "), F.col("vec_id").cast("string"))
    posts = e.select("vec_id", F.lit("x").alias("did"), F.struct(text.alias("text")).alias("record"))
    stored = e.select(F.lit("mini").alias("model"), score_key("mini", text).alias("input_key"), "embedding")
    condition = {"text_similarity": ["text", {"model_name": "mini", "anchor_text": "text 0"}, ">=", 0.3]}
    return _ids(posts, condition, Catalog(embeddings=stored), "vec_id")


_STAGED = {
    "or": [
        {"attribute_compare": ["lang", "==", "de"]},
        {
            "and": [
                {"attribute_compare": ["n_chars", ">", 2000]},
                {"or": [{"entity_matches": ["hashtags", ["src3"]]}, {"sentiment_analysis": ["Neutral", ">", 0.7]}]},
            ]
        },
    ]
}


@query(
    "staged_filter",
    f"""SELECT doc_id FROM documents JOIN {_FIRST} f USING (text)
        WHERE lang = 'de' OR (n_chars > 2000 AND (source = 'src3' OR ((first_id * 7 + 26) % 100) / 100.0::DOUBLE > 0.7))""",
)
def staged_filter(spark: SparkSession, folder: str) -> DataFrame:
    """A model leaf below an OR: only undecided documents meet the scores."""
    catalog = Catalog(scores=B.rule_scores(spark, folder, L.SENTIMENT))
    return _ids(B.documents(spark, folder), _STAGED, catalog, "doc_id")


@query("embed_text")
def embed_text(spark: SparkSession, folder: str) -> DataFrame:
    d = B.table(spark, folder, "documents").select(
        score_key("hashing", F.col("text")).alias("input_key"), F.col("text").alias("input")
    )
    return hashing_embedder(64).transform(missing_inputs(d, None))


@query("train_scorer")
def train_scorer(spark: SparkSession, folder: str) -> DataFrame:
    """Train on the labelled documents, score all distinct texts."""
    d = B.table(spark, folder, "documents")
    known = d.join(B.table(spark, folder, "labels"), "doc_id").select("text", F.col("toxic").alias("label"))
    scorer = train_text_classifier(known, {0: "OK", 1: "Toxic"})
    inputs = d.select(score_key("own", F.col("text")).alias("input_key"), F.col("text").alias("input"))
    return scorer.transform(missing_inputs(inputs, None)).select(
        "input_key", category_score(F.col("scores"), "Toxic").alias("toxic")
    )


@query(
    "embed_text_facts",
    r"""SELECT doc_id, count(*) OVER (PARTITION BY text) AS copies, 64 AS size,
               CASE WHEN regexp_matches(text, '[\p{L}\p{N}_]') THEN 1 ELSE 0 END::DOUBLE AS norm
        FROM documents WHERE text IS NOT NULL""",
)
def embed_text_facts(spark: SparkSession, folder: str) -> DataFrame:
    """Equal texts share one vector, every text has one, and vectors of texts with words have length 1."""
    d = B.table(spark, folder, "documents").where("text IS NOT NULL")
    d = d.select("doc_id", score_key("hashing", F.col("text")).alias("input_key"), F.col("text").alias("input"))
    vectors = hashing_embedder(64).transform(missing_inputs(d.select("input_key", "input"), None))
    squares = F.aggregate("embedding", F.lit(0.0), lambda total, x: total + x.cast("double") * x.cast("double"))
    facts = vectors.select("input_key", F.size("embedding").alias("size"), F.round(F.sqrt(squares), 3).alias("norm"))
    facts = facts.join(d.groupBy("input_key").agg(F.count("*").alias("copies")), "input_key")
    return d.join(facts, "input_key").select("doc_id", "copies", "size", "norm")


@query(
    "train_scorer_learns",
    """SELECT toxic, count(*) AS documents, true AS learned
       FROM documents JOIN labels USING (doc_id) GROUP BY toxic""",
)
def train_scorer_learns(spark: SparkSession, folder: str) -> DataFrame:
    """Of the labelled documents of each kind the trained scorer puts nine in ten or more on their side."""
    d = B.table(spark, folder, "documents").join(B.table(spark, folder, "labels"), "doc_id")
    d = d.select(score_key("own", F.col("text")).alias("input_key"), F.col("text").alias("input"), "toxic")
    scorer = train_text_classifier(d.select(F.col("input").alias("text"), F.col("toxic").alias("label")), {0: "OK", 1: "Toxic"})
    scored = scorer.transform(missing_inputs(d.select("input_key", "input"), None))
    scored = scored.select("input_key", category_score(F.col("scores"), "Toxic").alias("score"))
    right = ((F.col("score") >= 0.5) == (F.col("toxic") == 1)).cast("double")
    return d.join(scored, "input_key").groupBy("toxic").agg(
        F.count("*").alias("documents"), (F.avg(right) >= 0.9).alias("learned")
    )
