"""Joins which bring set membership, model scores and similarities to the posts that need them.

Posts are never multiplied: every side joined here is unique on its join key.  Members of sets are
counted first: up to ``MEMBERS`` are broadcast, and up to ``INLINE_LIMIT`` values that posts hold in lists
become literals, so that whole posts aren't shuffled for them.  Other sides are broadcast by the
adaptive planner when their measured size is small; otherwise it splits the partitions of a hot author
or a hot text.
"""

from __future__ import annotations

import functools
from collections.abc import Iterable
from dataclasses import dataclass, field, replace

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from postsieve.functions.keys import image_key, score_key
from postsieve.functions.vectors import cosine, norm
from postsieve.operators import entities
from postsieve.operators.leaf import (
    ImageScoreNeed,
    Need,
    PostView,
    SetNeed,
    SimilarityNeed,
    TextScoreNeed,
)
from postsieve.sources.score_store import ScoreStore
from postsieve.sources.scores import Scorer, complete_scores

#: Pairs of a set and a member that are broadcast at most, some 100 bytes each.
MEMBERS = 200_000

_MEMBER_OF = "__member_of"
_KEY = "__key"

# The result columns of the three kinds of stored model results.
TEXT_RESULT = T.StructField("scores", T.MapType(T.StringType(), T.DoubleType()))
IMAGE_RESULT = T.StructField("probs", T.ArrayType(T.DoubleType()))
VECTOR_RESULT = T.StructField("embedding", T.ArrayType(T.FloatType()))


UNSCORED = ("false", "zero", "raise")


@dataclass(frozen=True)
class Catalog:
    """Side tables a filter may refer to.

    assets        asset_type, asset_key, did            members of lists, packs, audiences, follows
    handles       handle, did
    scores        model, input_key, scores map<string,double>     text models
    image_scores  model, input_key, probs array<double>
    embeddings    model, input_key, embedding array<float>
    scorers       model -> scorer for inputs that have no stored result yet
    keep          folder below which new results are kept, so that no model sees an input twice
    unscored      what a text without any result does: ``"false"`` passes no test, ``"zero"`` has
                  score 0 for everything, ``"raise"`` ends the job
    """

    assets: DataFrame | None = None
    handles: DataFrame | None = None
    scores: DataFrame | None = None
    image_scores: DataFrame | None = None
    embeddings: DataFrame | None = None
    scorers: dict[str, Scorer] = field(default_factory=dict)
    keep: str | None = None
    unscored: str = "false"

    def __post_init__(self):
        if self.unscored not in UNSCORED:
            raise ValueError(f"unscored must be one of {', '.join(UNSCORED)}")

    def known(self, found: Column, zero: Column, need: TextScoreNeed | SimilarityNeed) -> Column:
        """A result, or what stands for it where there is none."""
        if self.unscored == "raise":
            message = F.lit(f"A text without a result of model '{need.model}'")
            return F.when(found.isNotNull(), found).otherwise(F.raise_error(message).cast(need.result))
        return F.coalesce(found, zero) if self.unscored == "zero" else found

    def store(self, spark: SparkSession, result: T.StructField) -> ScoreStore | None:
        """Where new results of a type are kept."""
        return None if self.keep is None else ScoreStore(spark, f"{self.keep.rstrip('/')}/{result.name}", result)

    def with_tables(self, **tables: DataFrame) -> Catalog:
        return replace(self, **tables)


def check_needs(needs: Iterable[Need], catalog: Catalog) -> None:
    """Raise ``ValueError`` if the catalog lacks what a filter refers to."""
    for need in needs:
        if isinstance(need, SetNeed):
            if need.assets and catalog.assets is None:
                raise ValueError("The filter refers to assets, but the catalog has none.")
            if need.handles and catalog.handles is None:
                raise ValueError("The filter refers to handles, but the catalog has none.")
            continue
        stored = {
            TextScoreNeed: catalog.scores,
            ImageScoreNeed: catalog.image_scores,
            SimilarityNeed: catalog.embeddings,
        }[type(need)]
        if stored is None and need.model not in catalog.scorers:
            raise ValueError(f"No stored results and no scorer for model '{need.model}'")
        scorer, labels = catalog.scorers.get(need.model), getattr(need, "labels", ())
        if scorer is not None and not scorer.answers(labels):
            raise ValueError(f"The scorer for model '{need.model}' {'takes no' if labels else 'needs'} labels")


def attach(posts: DataFrame, view: PostView, needs: Iterable[Need], catalog: Catalog) -> DataFrame:
    """``posts`` with one column per need (named ``need.column``)."""
    needs = [n for n in dict.fromkeys(needs) if n.column not in posts.columns]
    check_needs(needs, catalog)
    _declare_shared(view, needs)
    posts = view.with_shared(posts)
    images = [n for n in needs if isinstance(n, ImageScoreNeed)]
    if images:
        posts = _attach_image_scores(posts, view, images, catalog)
    sets = [n for n in needs if isinstance(n, SetNeed)]
    for on in dict.fromkeys(n.on for n in sets):
        posts = _attach_sets(posts, view, on, [n for n in sets if n.on == on], catalog)
    # All keys are computed before the first join, so that no text has to travel through one.
    keys = {_key_of(n): _input_key(view, n) for n in needs if isinstance(n, (TextScoreNeed, SimilarityNeed))}
    posts = posts.withColumns(keys) if keys else posts
    for need in needs:
        if isinstance(need, TextScoreNeed):
            posts = _attach_text_scores(posts, view, need, catalog)
        elif isinstance(need, SimilarityNeed):
            posts = _attach_similarity(posts, view, need, catalog)
    return posts.drop(*keys)


def _key_of(need: Need) -> str:
    return need.column + "_key"


def _input_text(view: PostView, need: TextScoreNeed | SimilarityNeed) -> Column:
    if isinstance(need, SimilarityNeed):
        attribute = view.record.child(need.attribute)
        return F.lit("") if attribute.is_missing else F.coalesce(attribute.col.cast("string"), F.lit(""))
    text = F.coalesce(view.shared_text(), F.lit(""))
    return F.when(text == "", F.lit(need.empty_text)).otherwise(text) if need.empty_text else text


def _input_key(view: PostView, need: TextScoreNeed | SimilarityNeed) -> Column:
    suffix = need.suffix if isinstance(need, TextScoreNeed) else ""
    return score_key(need.model, _input_text(view, need), suffix)


def lookup(
    rows: DataFrame, table: DataFrame, key: str, how: str = "left", spread_by: tuple[str, ...] = ()
) -> DataFrame:
    """Join (``left``, ``left_semi``, ``left_anti``) with a table that is unique on the string ``key``.

    A third of the rows may share one key.  The adaptive planner splits such a partition, but only
    if both sides were shuffled for this very join; a table which has just been grouped by ``key``
    would be read in place.  A checksum of the key as second join key asks for that shuffle.  Rows
    without a key match nothing and are dealt out by their columns ``spread_by``.
    """
    spread = "__spread"
    own = F.coalesce(F.crc32(key), F.xxhash64(*spread_by)) if spread_by else F.crc32(key)
    left = rows.withColumn(spread, own)
    return left.join(table.withColumn(spread, F.crc32(key)), [key, spread], how).drop(spread)


def _list_key(values: Column) -> Column:
    """Equal for equal lists of strings; NULL for an empty one.

    What is found out about a list holds for every row that has it.  So fanned-out values come back
    by their list and not by the key of a post, which edits and replays repeat and which may be NULL.
    """
    return F.when(F.size(values) > 0, F.sha2(F.to_json(values), 256))


def _declare_shared(view: PostView, needs: Iterable[Need]) -> None:
    """Make the view compute what the joins below read, before any of them runs."""
    for need in needs:
        if isinstance(need, SetNeed) and need.on != "did":
            view.shared_entities(need.on)
        elif isinstance(need, TextScoreNeed):
            view.shared_text()
        elif isinstance(need, ImageScoreNeed):
            view.shared_image_urls()


def _union(frames: list[DataFrame]) -> DataFrame:
    return functools.reduce(DataFrame.unionByName, frames)


def _literal_rows(spark: SparkSession, rows: list[tuple], *names: str) -> DataFrame:
    """Constants of the filter as a local relation, whose exact size the planner knows."""
    columns = list(zip(*rows))
    return spark.createDataFrame(pa.table({n: pa.array(c, pa.string()) for n, c in zip(names, columns)}))


def set_members(spark, needs: list[SetNeed], catalog: Catalog, lower: bool) -> DataFrame:
    """``(set_name, value)`` for all sets at once; list conditions of all feeds share one scan."""
    frames = []
    assets = [(n.column, t, k) for n in needs for t, k in n.assets]
    handles = [(n.column, h) for n in needs for h in n.handles]
    literals = [(n.column, v) for n in needs for v in n.literals]
    if assets:
        wanted = _literal_rows(spark, assets, "set_name", "asset_type", "asset_key")
        frames.append(
            catalog.assets.join(wanted, ["asset_type", "asset_key"]).select("set_name", F.col("did").alias("value"))
        )
    if handles:
        wanted = _literal_rows(spark, handles, "set_name", "handle")
        frames.append(catalog.handles.join(wanted, "handle").select("set_name", F.col("did").alias("value")))
    if literals:
        frames.append(_literal_rows(spark, literals, "set_name", "value"))
    members = _union(frames).where(F.col("value").isNotNull())
    return members.withColumn("value", F.lower("value")) if lower else members


def _listed(posts: DataFrame, values: Column, name: str) -> tuple[DataFrame, DataFrame]:
    """``posts`` with the key of their list, and the elements ``name`` of every distinct list."""
    keyed = posts.withColumn(_KEY, _list_key(values))
    return keyed, keyed.select(_KEY, F.explode(values).alias(name)).distinct()


def attach_memberships(
    posts: DataFrame, view: PostView, on: str, needs: list[SetNeed], catalog: Catalog, name: str
) -> DataFrame:
    """``posts`` with the array ``name`` of those ``needs`` (their columns' names) whose sets a post is in."""
    members = set_members(posts.sparkSession, needs, catalog, lower=on != "did")
    if on == "did":
        # At most one array element per condition of the filter, however large the sets are.
        by_value = members.groupBy(F.col("value").alias(_KEY)).agg(F.collect_set("set_name").alias(_MEMBER_OF))
        keyed = posts.withColumn(_KEY, view.did)
        if _are_few(members):
            marked = keyed.join(F.broadcast(by_value), _KEY, "left").drop(_KEY)
        else:
            marked = lookup(keyed, by_value, _KEY).drop(_KEY)
    elif (literal := _literal_sets(members, needs)) is not None:
        own = view.shared_entities(on)
        names = [F.when(_meets(own, values), F.lit(column)) for column, values in literal.items()]
        marked = posts.withColumn(_MEMBER_OF, F.array_compact(F.array(*names).cast("array<string>")))
    else:
        keyed, values = _listed(posts, view.shared_entities(on), "value")
        hits = values.join(members, "value").groupBy(_KEY).agg(F.collect_set("set_name").alias(_MEMBER_OF))
        marked = lookup(keyed, hits, _KEY, spread_by=view.key).drop(_KEY)
    return marked.withColumnRenamed(_MEMBER_OF, name)


def _are_few(members: DataFrame) -> bool:
    """Whether members may be broadcast, by their counted number: their table's size says little.
    Sessions that turn automatic broadcasts off get none."""
    allowed = members.sparkSession.conf.get("spark.sql.autoBroadcastJoinThreshold")
    return not allowed.startswith("-") and members.count() <= MEMBERS


def _literal_sets(members: DataFrame, needs: list[SetNeed]) -> dict[str, list[str]] | None:
    """The values of each set, or None if there are more than ``INLINE_LIMIT`` in all."""
    most = entities.INLINE_LIMIT
    if sum(len(n.literals) for n in needs) > most:
        return None
    found = members.select("set_name", "value").limit(most + 1).collect()
    if len(found) > most:
        return None
    sets: dict[str, set[str]] = {}
    for row in found:
        sets.setdefault(row["set_name"], set()).add(row["value"])
    return {name: sorted(values) for name, values in sets.items()}


def _meets(own: Column, values: list[str]) -> Column:
    return F.coalesce(F.arrays_overlap(own, F.array(*[F.lit(v) for v in values])), F.lit(False))


def _attach_sets(posts, view: PostView, on: str, needs: list[SetNeed], catalog: Catalog) -> DataFrame:
    marked = attach_memberships(posts, view, on, needs, catalog, _MEMBER_OF)
    flags = {
        n.column: F.coalesce(F.array_contains(_MEMBER_OF, n.column), F.lit(False)) for n in needs
    }
    return marked.withColumns(flags).drop(_MEMBER_OF)


def keep_members(posts: DataFrame, view: PostView, need: SetNeed, negated: bool, catalog: Catalog) -> DataFrame:
    """A membership test which must hold for every result, as a semi or anti join."""
    how = "left_anti" if negated else "left_semi"
    check_needs([need], catalog)
    _declare_shared(view, [need])
    posts = view.with_shared(posts)
    members = set_members(posts.sparkSession, [need], catalog, lower=need.on != "did")
    if need.on == "did":
        members = F.broadcast(members) if _are_few(members) else members
        return posts.join(members, posts[view.did_column] == members["value"], how)
    literal = _literal_sets(members, [need])
    if literal is not None:
        inside = _meets(view.shared_entities(need.on), literal.get(need.column, [])) if literal else F.lit(False)
        return posts.where(~inside if negated else inside)
    keyed, values = _listed(posts, view.shared_entities(need.on), "value")
    hits = values.join(members, "value", "left_semi").select(_KEY).distinct()
    return lookup(keyed, hits, _KEY, how, spread_by=view.key).drop(_KEY)


def _attach_text_scores(posts, view: PostView, need: TextScoreNeed, catalog: Catalog) -> DataFrame:
    key = _key_of(need)
    scorer = catalog.scorers.get(need.model)
    inputs = posts.select(F.col(key).alias("input_key"), _input_text(view, need).alias("input")) if scorer else None
    scores = complete_scores(need.model, catalog.scores, TEXT_RESULT, inputs, scorer, catalog.store(posts.sparkSession, TEXT_RESULT), need.labels)
    found = scores.select(F.col("input_key").alias(key), F.col("scores").alias(need.column))
    nothing = F.create_map().cast(TEXT_RESULT.dataType)
    return lookup(posts, found, key).withColumn(need.column, catalog.known(F.col(need.column), nothing, need))


def _attach_image_scores(posts, view: PostView, needs: list[ImageScoreNeed], catalog: Catalog) -> DataFrame:
    """The best score of each distinct list of images, for all needs in one look-up."""
    keyed, urls = _listed(posts, view.shared_image_urls(), "input")
    best = []
    for need in needs:
        images = urls.withColumn("input_key", image_key(need.model, F.col("input"), need.category))
        scorer = catalog.scorers.get(need.model)
        inputs = images.select("input_key", "input") if scorer else None
        scores = complete_scores(need.model, catalog.image_scores, IMAGE_RESULT, inputs, scorer, catalog.store(posts.sparkSession, IMAGE_RESULT), need.labels)
        found = max_image_score(lookup(images, scores, "input_key"), (_KEY,), need)
        others = [F.lit(None).cast("double").alias(n.column) for n in needs if n is not need]
        best.append(found.select("*", *others))
    columns = [F.max(n.column).alias(n.column) for n in needs]
    return lookup(keyed, _union(best).groupBy(_KEY).agg(*columns), _KEY, spread_by=view.key).drop(_KEY)


def max_image_score(scored_images: DataFrame, key: tuple[str, ...], need: ImageScoreNeed) -> DataFrame:
    """Highest probability per ``key``; partial maxima are taken before anything is shuffled."""
    return scored_images.groupBy(*key).agg(
        F.max(F.get("probs", F.lit(need.position))).alias(need.column)
    )


def _attach_similarity(posts, view: PostView, need: SimilarityNeed, catalog: Catalog) -> DataFrame:
    key = _key_of(need)
    scorer = catalog.scorers.get(need.model)
    anchor_key = score_key(need.model, F.lit(need.anchor))
    inputs = anchor_input = None
    if scorer:
        inputs = posts.select(F.col(key).alias("input_key"), _input_text(view, need).alias("input"))
        anchor = posts.sparkSession.range(1)
        anchor_input = anchor.select(anchor_key.alias("input_key"), F.lit(need.anchor).alias("input"))
    # The anchor has a plan of its own: finding one vector must not score all texts.
    anchors = complete_scores(need.model, catalog.embeddings, VECTOR_RESULT, anchor_input, scorer, catalog.store(posts.sparkSession, VECTOR_RESULT))
    one = anchors.where(F.col("input_key") == anchor_key).agg(F.any_value("embedding").alias("v"))
    anchor_vector = one.select(F.struct("v", norm(F.col("v")).alias("norm"))).scalar()
    stored = complete_scores(need.model, catalog.embeddings, VECTOR_RESULT, inputs, scorer, catalog.store(posts.sparkSession, VECTOR_RESULT))
    found = stored.select(F.col("input_key").alias(key), "embedding")
    joined = lookup(posts, found, key).withColumn("__anchor", anchor_vector)
    similarity = F.coalesce(cosine(F.col("embedding"), F.col("__anchor.v"), F.col("__anchor.norm")), F.lit(0.0))
    similarity = catalog.known(F.when(F.col("embedding").isNotNull(), similarity), F.lit(0.0), need)
    # Without the anchor's vector every answer would be a guess.
    lacking = F.raise_error(F.lit(f"No vector for the anchor text under model '{need.model}'")).cast("double")
    similarity = F.when(F.col("__anchor.v").isNull(), lacking).otherwise(similarity)
    return joined.withColumn(need.column, similarity).drop("embedding", "__anchor")
