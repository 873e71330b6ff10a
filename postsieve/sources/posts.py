"""Posts from raw JSON events: schema, parsing, validation and routing."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from postsieve.functions.field import field, resolve
from postsieve.operators.leaf import PostView

_STRING = T.StringType()


def _struct(**fields: T.DataType) -> T.StructType:
    """A struct type; ``type_`` and ``link_`` stand for the names ``$type`` and ``$link``."""
    renamed = {"type_": "$type", "link_": "$link"}
    return T.StructType([T.StructField(renamed.get(k, k), v) for k, v in fields.items()])


def _ddl(dtype: T.DataType) -> str:
    """Type text with every field name quoted."""
    if isinstance(dtype, T.StructType):
        return "struct<" + ", ".join(f"`{f.name}`: {_ddl(f.dataType)}" for f in dtype.fields) + ">"
    if isinstance(dtype, T.ArrayType):
        return f"array<{_ddl(dtype.elementType)}>"
    return dtype.simpleString()


_LINK_REF = _struct(ref=_struct(link_=_STRING))

# The parts of the post schema the built-in operators read.
RECORD_TYPE = _struct(
    text=_STRING,
    createdAt=_STRING,
    langs=T.ArrayType(_STRING),
    tags=T.ArrayType(_STRING),
    labels=_struct(values=T.ArrayType(_struct(val=_STRING))),
    reply=_struct(parent=_struct(uri=_STRING), root=_struct(uri=_STRING)),
    facets=T.ArrayType(
        _struct(features=T.ArrayType(_struct(type_=_STRING, tag=_STRING, did=_STRING, uri=_STRING)))
    ),
    embed=_struct(
        type_=_STRING,
        images=T.ArrayType(_struct(alt=_STRING, image=_LINK_REF)),
        external=_struct(uri=_STRING, title=_STRING, description=_STRING),
        media=_struct(
            type_=_STRING,
            images=T.ArrayType(_struct(image=_LINK_REF)),
            external=_struct(thumb=_LINK_REF),
        ),
    ),
)
# Message size limit and the two accepted spellings of a creation time (the fraction
POST_COLLECTION = "app.bsky.feed.post"
CREATED_AT_FORMAT = "yyyy-M-d'T'H:m:s[.SSSSSS]'Z'"
CREATED_AT_PATTERN = r"^\d{4}-\d{1,2}-\d{1,2}T\d{1,2}:\d{1,2}:\d{1,2}(\.\d{1,6})?Z$"
CREATED_AT_OUTPUT = "yyyy-MM-dd'T'HH:mm:ss.SSSSSS'Z'"


def read_events(spark: SparkSession, path: str) -> DataFrame:
    """JSON lines as a single ``raw`` column."""
    return spark.read.text(path).withColumnRenamed("value", "raw")


def _decoded(events: DataFrame, raw: str) -> DataFrame:
    """``events`` with the JSON of ``raw`` as variant ``__json`` (NULL if it cannot be decoded).

    """
    return _once(events, F.try_parse_json(raw).alias("__json"))


def _once(df: DataFrame, *columns: Column) -> DataFrame:
    """Add costly columns that are computed once per row.

    They come out of a generator: filters on them stay above it, instead of being pushed below and
    computing them again for every condition.
    """
    return df.select("*", F.inline(F.array(F.struct(*columns))))


def quarantine(events: DataFrame, raw: str = "raw") -> tuple[DataFrame, DataFrame]:
    """(decodable rows, undecodable rows)."""
    decodable = F.try_parse_json(raw).isNotNull()
    return events.where(decodable), events.where(~decodable)


def oversize(events: DataFrame, max_chars: int, raw: str = "raw") -> DataFrame:
    """What a limit of ``max_chars`` removes, with ``reason``, for the quarantine."""
    return events.where(F.length(raw) > max_chars).withColumn("reason", F.lit(f"longer than {max_chars} characters"))


def parse_events(events: DataFrame, raw: str = "raw") -> DataFrame:
    """Envelope columns, typed ``record``, ``body`` (variant, for arbitrary paths) and ``raw``."""
    others = [c for c in events.columns if c != raw]

    def at(path: str, dtype: str) -> Column:
        return F.try_variant_get("__json", path, dtype)

    return _decoded(events, raw).select(
        *others,
        at("$.did", "string").alias("did"),
        at("$.time_us", "bigint").alias("time_us"),
        *[at(f"$.commit.{name}", "string").alias(name) for name in ("operation", "collection", "rkey", "cid")],
        at("$.commit.record", _ddl(RECORD_TYPE)).alias("record"),
        at("$.commit.record", "variant").alias("body"),
        F.col(raw).alias("raw"),
    )


def post_view(posts: DataFrame, key: tuple[str, ...] = ("did", "rkey")) -> PostView:
    body = "body" if "body" in posts.columns else None
    return PostView(posts.schema, key, body_column=body)


def validate_events(
    events: DataFrame, now: Column | None = None, raw: str = "raw", max_chars: int | None = None
) -> DataFrame:
    """Drop malformed events, and those over ``max_chars`` if given; correct creation times.

    See :func:`judge_events`, which keeps them with the reason.
    """
    return judge_events(events, now, raw, max_chars).where("reason IS NULL").drop("reason")


def judge_events(
    events: DataFrame, now: Column | None = None, raw: str = "raw", max_chars: int | None = None
) -> DataFrame:
    """All events with ``reason``: why an event is rejected, NULL if it is well-formed.

    A creation time which cannot be read or lies after ``now`` becomes ``now``; an absent one stays
    absent.  The correction is made in the ``raw`` JSON, at ``commit.record.createdAt`` alone: in its
    text where that time is certainly the only one, else in the decoded message.  Rejected messages
    stay as they came, and those over ``max_chars`` are not decoded.
    """
    now = F.current_timestamp() if now is None else now

    def is_object(path: str) -> Column:
        """An object, or nothing at all, at ``path``."""
        found = F.try_variant_get("__json", path, "variant")
        return found.isNull() | F.schema_of_variant(found).startswith("OBJECT")

    too_long = F.lit(False) if max_chars is None else F.coalesce(F.length(raw) > max_chars, F.lit(False))
    decoded = _once(events, F.try_parse_json(F.when(~too_long, F.col(raw))).alias("__json"))
    found = F.try_variant_get("__json", "$.commit.record.createdAt", "variant")
    text = F.try_variant_get("__json", "$.commit.record.createdAt", "string")
    read = _once(decoded, found.alias("__found"), text.alias("__created"))
    created = F.col("__created")
    # A creation time was found, so the levels above it are objects.
    shaped = F.col("__found").isNotNull() | (is_object("$") & is_object("$.commit") & is_object("$.commit.record"))
    # Anything that counts as empty is left as it is; other non-strings are malformed.
    readable = (
        created.isNull() | created.isin("", "0", "0.0", "false") | (F.schema_of_variant("__found") == "STRING")
    )
    reason = (
        F.when(too_long, f"longer than {max_chars} characters")
        .when(F.col("__json").isNull(), "not JSON")
        .when(~F.coalesce(shaped, F.lit(False)), "not an event")
        .when(~F.coalesce(readable, F.lit(False)), "creation time is no text")
    )
    # The pattern keeps the date parser, whose failures are slow, away from most unreadable times.
    at = F.when(created.rlike(CREATED_AT_PATTERN), F.try_to_timestamp(created, F.lit(CREATED_AT_FORMAT)))
    is_wrong = created.isNotNull() & (created != "") & F.coalesce(at > now, F.lit(True))
    corrected = F.date_format(now, CREATED_AT_OUTPUT)
    fixed, standing = F.col(raw), F.lit(False)
    for gap in ("", " "):
        label = f'"createdAt":{gap}"'
        old = F.concat(F.lit(label), created, F.lit('"'))
        standing = standing | F.contains(F.col(raw), old)
        fixed = F.replace(fixed, old, F.concat(F.lit(label), corrected, F.lit('"')))
    # A name written with escapes would not be counted.
    name = '"createdAt"'
    named = (F.length(raw) - F.length(F.replace(F.col(raw), F.lit(name), F.lit("")))) / len(name)
    is_only = standing & (named == 1) & ~F.contains(F.col(raw), F.lit("\\u00"))
    fixed = F.when(is_only, fixed).otherwise(_with_created("__json", corrected))
    return (
        _once(read, reason.alias("reason"))
        .withColumn(raw, F.when(F.col("reason").isNull() & is_wrong, fixed).otherwise(F.col(raw)))
        .drop("__json", "__found", "__created")
    )


def _with_created(message: str, created: Column) -> Column:
    """The JSON text of the variant ``message`` with ``created`` at ``commit.record.createdAt``."""

    def put(path: str, name: str, value: Column) -> Column:
        fields = F.try_variant_get(message, path, "map<string,variant>")
        others = F.map_filter(fields, lambda k, _: k != name)
        return F.to_variant_object(F.map_concat(others, F.create_map(F.lit(name), value)))

    text = F.parse_json(F.concat(F.lit('"'), created, F.lit('"')))
    record = put("$.commit.record", "createdAt", text)
    return F.to_json(put("$", "commit", put("$.commit", "record", record)))


def split_operations(posts: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(creates, deletes); other operations are dropped."""
    return posts.where(F.col("operation") == "create"), posts.where(F.col("operation") == "delete")


def deduplicate(posts: DataFrame, key: tuple[str, ...] = ("did", "rkey")) -> DataFrame:
    """One row per key, for replays which read an event twice."""
    return posts.dropDuplicates(list(key))


def apply_deletes(
    stored: DataFrame, deletes: DataFrame, key: tuple[str, ...] = ("did", "rkey"), time: str | None = "time_us"
) -> DataFrame:
    """Stored rows whose post has not been deleted since: no delete of the key is as late as the row.

    A post created anew under its key after a delete stays.  Only the latest delete of a key matters,
    so deletes are grouped before the join, and a key that was deleted often meets a row once.  Rows
    without a time go with any delete of their key, as do all rows with a delete without a time; with
    ``time`` None, for tables that hold none, all do.
    """
    if time is None:
        return stored.join(deletes.select(*key), list(key), "left_anti")
    always = F.max(F.when(F.col(time).isNull(), True)).alias("__always")
    latest = deletes.groupBy(*key).agg(F.max(time).alias("__deleted"), always).alias("deletes")
    same = [F.col(f"stored.{k}") == F.col(f"deletes.{k}") for k in key]
    later = F.coalesce(F.col(f"stored.{time}") > F.col("deletes.__deleted"), F.lit(False))
    gone = F.coalesce(F.col("deletes.__always"), F.lit(False)) | ~later
    return stored.alias("stored").join(latest, [*same, gone], "left_anti")
