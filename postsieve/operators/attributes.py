"""Attribute, constant, post-type and embed-type predicates."""

from __future__ import annotations

from typing import Any

from pyspark.sql import functions as F
from pyspark.sql import types as T

from postsieve.functions.extract import url_domain
from postsieve.functions.compare import compare, compare_constant, normalise_threshold
from postsieve.functions.field import has_wildcard
from postsieve.operators.leaf import COST_ARRAY, COST_CONSTANT, COST_SCALAR, Atoms, Leaf, PostView

# Embed type names of the post schema.
EMBED_TYPES = {
    "image": "app.bsky.embed.images",
    "link": "app.bsky.embed.external",
    "post": "app.bsky.embed.record",
    "image_group": "app.bsky.embed.recordWithMedia",
    "video": "app.bsky.embed.video",
    "gif": "",
}
# Fixed value: the host whose links are animated pictures.
GIF_DOMAIN = "media.tenor.com"


def attribute_compare(view: PostView, path: str, comparator: str, value: Any) -> Leaf:
    own = view.shared_path(path)
    atoms = None
    if comparator == "==" and isinstance(value, str) and value and isinstance(own.dtype, T.StringType):
        if not normalise_threshold(value)[0]:
            atoms = Atoms(f"field:{path}", lambda: F.array(own.col), (value,))
    return Leaf(compare(own, comparator, value), COST_ARRAY if has_wildcard(path) else COST_SCALAR, atoms=atoms)


def param_compare(view: PostView, constant: Any, comparator: str, value: Any) -> Leaf:
    return Leaf(compare_constant(constant, comparator, value), COST_CONSTANT)


def post_type(view: PostView, comparator: str, names: list[str]) -> Leaf:
    """``quote``, ``reply``, or ``not`` = none of the types asked about."""
    tests = []
    if "quote" in names:
        tests.append(compare(view.shared_path("embed.$type"), "==", EMBED_TYPES["post"]))
    if "reply" in names:
        tests.append(compare(view.shared_path("reply"), "!=", None))
    wanted = F.lit(False)
    for test in tests:
        wanted = wanted | test
    if "not" in names:
        other = F.lit(True)
        for test in tests:
            other = other & ~test
        wanted = wanted | other
    if comparator in ("in", "=="):
        return Leaf(wanted)
    if comparator in ("not_in", "!="):
        return Leaf(~wanted)
    raise ValueError(f"Unknown comparator '{comparator}'")


def embed_type(view: PostView, comparator: str, name: str) -> Leaf:
    if name not in EMBED_TYPES:
        raise ValueError(f"Unknown embed type '{name}'")
    own = view.shared_path("embed.$type")
    if name in ("gif", "link"):
        is_gif = F.exists(view.shared_entities("urls"), lambda u: url_domain(u) == GIF_DOMAIN)
        is_link = compare(own, "==", EMBED_TYPES["link"])
        if name == "gif":
            return Leaf(is_gif if comparator == "==" else ~is_gif, COST_ARRAY)
        # The negated form also leaves gifs out: it is not the complement.
        return Leaf((is_link if comparator == "==" else ~is_link) & ~is_gif, COST_ARRAY)
    media = view.shared_path("embed.media.$type")
    if name == "video":
        is_type = compare(own, "==", EMBED_TYPES["video"]) | compare(media, "==", EMBED_TYPES["video"])
    elif name == "image_group":
        is_type = compare(own, "!=", None) & compare(media, "==", EMBED_TYPES["image"])
    else:
        return Leaf(compare(own, comparator, EMBED_TYPES[name]))
    if comparator in ("==", "in"):
        return Leaf(is_type)
    if comparator in ("!=", "not_in"):
        return Leaf(~is_type)
    # An ordering comparison reads the type name where it holds and '' elsewhere.
    limit = EMBED_TYPES[name]
    return Leaf(
        F.when(is_type, F.lit(compare_constant(limit, comparator, limit))).otherwise(
            F.lit(compare_constant("", comparator, limit))
        )
    )
