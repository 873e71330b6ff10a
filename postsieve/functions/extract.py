"""Derived values of a post: text, links, entities and image URLs.

Every function takes the post body as a :class:`Field` and returns a ``Column`` holding an array
(or string) that is never NULL.  A part which the body's schema lacks costs nothing: it drops out
while the plan is built.
"""

from __future__ import annotations

import re
from collections.abc import Callable

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

from postsieve.functions.field import Field, resolve

# Type names of the post schema.
FACET_LINK = "app.bsky.richtext.facet#link"
FACET_TAG = "app.bsky.richtext.facet#tag"
FACET_MENTION = "app.bsky.richtext.facet#mention"
EMBED_IMAGES = "app.bsky.embed.images"
EMBED_RECORD_WITH_MEDIA = "app.bsky.embed.recordWithMedia"
# Fixed value: where the thumbnail of a post image is served.
IMAGE_URL_FORMAT = "https://cdn.bsky.app/img/feed_thumbnail/plain/%s/%s@jpeg"

_STRINGS = T.ArrayType(T.StringType())


def _no_strings() -> Column:
    return F.array().cast(_STRINGS)


def _string_array(value: Field) -> Column:
    """``value`` as an array of non-null strings."""
    if isinstance(value.dtype, T.VariantType):
        value = Field(F.try_variant_get(value.col, "$", "array<string>"), _STRINGS)
    if not isinstance(value.dtype, T.ArrayType):
        return _no_strings()
    strings = F.coalesce(value.col.cast(_STRINGS), _no_strings())
    # A literal array of one known column needs no lambda beyond this null test.
    return F.filter(strings, lambda x: x.isNotNull())


def _as_string(value: Field) -> Column:
    if isinstance(value.dtype, T.VariantType):
        return F.try_variant_get(value.col, "$", "string")
    return value.col.cast("string")


def _features(record: Field) -> Field | None:
    features = resolve(record, "facets[*].features[*]")
    element = features.dtype.elementType
    return features if isinstance(element, (T.StructType, T.VariantType, T.MapType)) else None


def _facet_values(record: Field, facet_type: str, accessor: str) -> Column:
    features = _features(record)
    if features is None:
        return _no_strings()
    element = features.dtype.elementType

    def of_type(x: Column) -> Column:
        return F.coalesce(_as_string(Field(x, element).child("$type")) == facet_type, F.lit(False))

    values = F.transform(
        F.filter(features.col, of_type), lambda x: _as_string(Field(x, element).child(accessor))
    )
    return F.filter(values, lambda x: x.isNotNull() & (x != ""))


def _one_or_none(value: Field) -> Column:
    """``[value]``, or ``[]`` when it is missing or empty."""
    if value.is_missing:
        return _no_strings()
    text = _as_string(value)
    return F.when(text.isNotNull() & (text != ""), F.array(text)).otherwise(_no_strings())


def _join_arrays(*arrays: Column) -> Column:
    return arrays[0] if len(arrays) == 1 else F.concat(*arrays)


def all_text(record: Field) -> Column:
    """Post text, image alt texts and link preview title/description, joined with line breaks."""
    single = [record.child("text")]
    trailing = [resolve(record, "embed.external.title"), resolve(record, "embed.external.description")]
    alts = resolve(record, "embed.images[*].alt")

    def or_null(value: Field) -> Column:
        return F.nullif(_as_string(value), F.lit(""))

    head = [or_null(v) for v in single if not v.is_missing]
    tail = [or_null(v) for v in trailing if not v.is_missing]
    middle = []
    if not record.child("embed").is_missing and not resolve(record, "embed.images").is_missing:
        middle = [F.nullif(F.array_join(F.filter(_string_array(alts), lambda x: x != ""), "\n"), F.lit(""))]
    parts = head + middle + tail
    return F.concat_ws("\n", *parts) if parts else F.lit("")


def links(record: Field) -> Column:
    """External URI first, then the URIs of link facets, in order."""
    return F.concat(
        _one_or_none(resolve(record, "embed.external.uri")), _facet_values(record, FACET_LINK, "uri")
    )


def url_domain(url: Column) -> Column:
    """Lower-cased network location without a leading ``www.``; ``''`` without a scheme or ``//``."""
    location = F.regexp_extract(F.coalesce(url, F.lit("")), r"^\s*(?:[a-zA-Z][a-zA-Z0-9+.\-]*:)?//([^/?#]*)", 1)
    return F.regexp_replace(F.lower(location), r"^www\.", "")


def hashtags(record: Field) -> Column:
    both = F.concat(_facet_values(record, FACET_TAG, "tag"), _string_array(record.child("tags")))
    return F.array_distinct(F.transform(both, F.lower))


def mentions(record: Field) -> Column:
    return F.array_distinct(_facet_values(record, FACET_MENTION, "did"))


def urls(record: Field) -> Column:
    return F.array_distinct(links(record))


def langs(record: Field) -> Column:
    return F.array_distinct(_string_array(record.child("langs")))


def labels(record: Field) -> Column:
    return F.array_distinct(_string_array(resolve(record, "labels.values[*].val")))


def domains(record: Field) -> Column:
    return F.array_distinct(F.transform(links(record), url_domain))


# Fixed value: stands in the address of an image without a reference.
NO_REFERENCE = "None"

ENTITY_GETTERS: dict[str, Callable[[Field], Column]] = {
    "hashtags": hashtags,
    "mentions": mentions,
    "urls": urls,
    "langs": langs,
    "labels": labels,
    "domains": domains,
}


def image_urls(record: Field, did: Column) -> Column:
    """One thumbnail URL per image of an image post, or of the media of a quote with images."""
    embed_type = resolve(record, "embed.$type")
    if embed_type.is_missing:
        return _no_strings()
    media_type = resolve(record, "embed.media.$type")
    # An image of a quote's media without a reference of its own takes the link card's thumbnail;
    # without that either, it keeps an address that no score is found for.
    thumb = resolve(record, "embed.media.external.thumb.ref.$link")
    direct = _image_cids(resolve(record, "embed.images[*]"), None)
    nested = _image_cids(resolve(record, "embed.media.images[*]"), thumb)
    kind = _as_string(embed_type)
    is_nested = (kind == EMBED_RECORD_WITH_MEDIA) & (
        F.lit(False) if media_type.is_missing else _as_string(media_type) == EMBED_IMAGES
    )
    cids = F.when(kind == EMBED_IMAGES, direct).when(is_nested, nested).otherwise(_no_strings())
    return F.transform(cids, lambda cid: F.format_string(IMAGE_URL_FORMAT, did, cid))


def _image_cids(images: Field, fallback: Field | None) -> Column:
    element = images.dtype.elementType
    if not isinstance(element, (T.StructType, T.VariantType, T.MapType)):
        return _no_strings()

    def cid(x: Column) -> Column:
        own = _as_string(resolve(Field(x, element), "image.ref.$link"))
        if fallback is None:
            return own
        others = [] if fallback.is_missing else [F.nullif(_as_string(fallback), F.lit(""))]
        return F.coalesce(F.nullif(own, F.lit("")), *others, F.lit(NO_REFERENCE))

    return F.filter(F.transform(images.col, cid), lambda x: x.isNotNull() & (x != ""))


def post_uri(did: Column, collection: Column, rkey: Column) -> Column:
    return F.format_string("at://%s/%s/%s", did, collection, rkey)


def clean_key(name: str) -> str:
    """Every character other than ASCII letters, ``_`` and ``/`` becomes ``-``."""
    return re.sub(r"[^A-Za-z_/]", "-", name)


def clean_schema(value: Field, omit: frozenset[str] = frozenset()) -> Field:
    """Rename nested keys with :func:`clean_key` and drop those listed in ``omit``.

    Works on the schema: the result selects and renames, and no value is inspected at run time
    other than the keys of maps.  If two keys become equal the last one wins.
    """
    dtype = value.dtype
    if isinstance(dtype, T.StructType):
        kept: dict[str, Field] = {}
        for f in dtype.fields:
            name = clean_key(f.name)
            if name not in omit:
                kept[name] = clean_schema(Field(value.col.getField(f.name), f.dataType), omit)
        rebuilt = F.struct(*[v.col.alias(k) for k, v in kept.items()])
        new_type = T.StructType([T.StructField(k, v.dtype) for k, v in kept.items()])
        return Field(F.when(value.col.isNotNull(), rebuilt), new_type)
    if isinstance(dtype, T.ArrayType):
        inner = clean_schema(Field(F.lit(None), dtype.elementType), omit)
        if inner.dtype == dtype.elementType:
            return value
        col = F.transform(value.col, lambda x: clean_schema(Field(x, dtype.elementType), omit).col)
        return Field(col, T.ArrayType(inner.dtype))
    if isinstance(dtype, T.MapType) and isinstance(dtype.keyType, T.StringType):
        entries = F.transform(
            F.map_entries(value.col),
            lambda e: F.struct(
                F.regexp_replace(e["key"], r"[^A-Za-z_/]", "-").alias("key"),
                clean_schema(Field(e["value"], dtype.valueType), omit).col.alias("value"),
            ),
        )
        if omit:
            entries = F.filter(entries, lambda e: ~e["key"].isin(sorted(omit)))
        inner = clean_schema(Field(F.lit(None), dtype.valueType), omit)
        keys = F.transform(entries, lambda e: e["key"])
        # Of entries whose keys have become equal, the last one stays.
        entries = F.filter(
            entries, lambda e, i: ~F.array_contains(F.slice(keys, i + 2, F.size(keys)), e["key"])
        )
        return Field(F.map_from_entries(entries), T.MapType(T.StringType(), inner.dtype))
    return value
