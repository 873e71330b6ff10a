"""What an operator of a feed filter turns into when the plan is built."""

from __future__ import annotations

import functools
import hashlib
import json
from collections.abc import Callable
from dataclasses import dataclass, field as dc_field
from typing import Any

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from postsieve.functions import extract
from postsieve.functions.field import Field, field, has_wildcard, resolve

# Evaluation order inside a connective: cheap tests first.
COST_CONSTANT, COST_SCALAR, COST_ARRAY, COST_REGEX, COST_SET, COST_MODEL = range(6)


def column_name(prefix: str, *identity: Any) -> str:
    digest = hashlib.sha1(json.dumps(identity, sort_keys=True, default=str).encode()).hexdigest()
    return f"__{prefix}_{digest[:12]}"


@dataclass(frozen=True)
class SetNeed:
    """Membership of ``value`` in a set which lives in a side table (or is a long literal list).

    ``on`` names the value tested: ``did`` for the author, or an entity type for "any of these".
    ``assets`` are (type, key) pairs whose members form the set together with ``handles``
    (resolved through the handle table) and ``literals``.
    """

    on: str
    assets: tuple[tuple[str, str], ...] = ()
    handles: tuple[str, ...] = ()
    literals: tuple[str, ...] = ()

    @property
    def column(self) -> str:
        return column_name("in", self.on, self.assets, self.handles, self.literals)


@dataclass(frozen=True)
class TextScoreNeed:
    """Label probabilities of a text model, stored under ``sha256(model:text[:suffix])``.

    ``labels`` are what a zero-shot model is asked to tell apart.
    """

    model: str
    suffix: str = ""
    empty_text: str = ""
    labels: tuple[str, ...] = ()

    @property
    def column(self) -> str:
        return column_name("scores", self.model, self.suffix, self.empty_text)

    @property
    def result(self) -> str:
        return "map<string,double>"


@dataclass(frozen=True)
class ImageScoreNeed:
    """Highest probability of ``category`` over a post's images; NULL when none has a score."""

    model: str
    category: str
    position: int = 0
    labels: tuple[str, ...] = ()

    @property
    def column(self) -> str:
        return column_name("image", self.model, self.category, self.position)


@dataclass(frozen=True)
class SimilarityNeed:
    """Cosine similarity between a text attribute and an anchor text under one embedding model."""

    model: str
    attribute: str
    anchor: str

    @property
    def column(self) -> str:
        return column_name("cosine", self.model, self.attribute, self.anchor)

    @property
    def result(self) -> str:
        return "double"


Need = SetNeed | TextScoreNeed | ImageScoreNeed | SimilarityNeed


@dataclass(frozen=True)
class Atoms:
    """How an index of feeds finds the posts of a leaf: by what they have at ``place``.

    ``source`` gives an array of a post's own values there.  The leaf holds for a post which has one of
    ``values``, or, given a ``pattern``, for one which has one of them and whose ``text`` matches.
    """

    place: str
    source: Callable[[], Column]
    values: tuple[str, ...]
    text: Callable[[], Column] | None = None
    pattern: str | None = None


@dataclass(frozen=True)
class Leaf:
    """A two-valued predicate, the columns it waits for, and its score for an audit.

    A ``test`` given as a function is built when it is first asked for: of thousands of feeds, an index
    looks most conditions up and never needs their columns.
    """

    test: Column | bool | Callable[[], Column]
    cost: int = COST_SCALAR
    needs: tuple[Need, ...] = ()
    score: Column | None = None
    # Set when the leaf is nothing but a membership test, so that it can run as a semi/anti join.
    membership: SetNeed | None = None
    negated: bool = False
    # What an index of feeds can look up; of the leaf without its negation.
    atoms: Atoms | None = None

    @functools.cached_property
    def predicate(self) -> Column | bool:
        return self.test() if callable(self.test) else self.test

    def negate(self) -> Leaf:
        flipped = not self.test if isinstance(self.test, bool) else lambda: ~self.predicate
        return Leaf(flipped, self.cost, self.needs, None, self.membership, not self.negated, self.atoms)


@dataclass(frozen=True)
class PostView:
    """Which columns of a DataFrame play which part of a post.

    ``key`` identifies a row; joins which fan a post out (entities, images) come back on it.
    ``body`` is the root of user-given paths: the variant column of raw JSON posts, else the record.

    The ``shared_*`` methods are for operators.  They return a reference to a column which
    :meth:`with_shared` computes once per post, so that hundreds of conditions on hashtags, on the
    post text or on one JSON path do not each derive them again.
    """

    schema: T.StructType
    key: tuple[str, ...] = ("did", "rkey")
    record_column: str = "record"
    body_column: str | None = None
    did_column: str = "did"
    missing_text: str = "None"
    _shared: dict[str, Column] = dc_field(default_factory=dict, compare=False, repr=False)
    _paths: dict[str, Field] = dc_field(default_factory=dict, compare=False, repr=False)

    @property
    def record(self) -> Field:
        return field(self.schema, self.record_column)

    @property
    def body(self) -> Field:
        return field(self.schema, self.body_column or self.record_column)

    @property
    def did(self) -> Column:
        return F.col(self.did_column)

    def path(self, path: str) -> Field:
        return resolve(self.body, path)

    def all_text(self) -> Column:
        return extract.all_text(self.record)

    def image_urls(self) -> Column:
        return extract.image_urls(self.record, self.did)

    def entities(self, kind: str) -> Column:
        return extract.ENTITY_GETTERS[kind](self.record)

    def shared_path(self, path: str) -> Field:
        """Plain struct access is left in place, where it is pruned and pushed down to the scan."""
        if path not in self._paths:
            found = self.path(path)
            if has_wildcard(path) or isinstance(found.dtype, T.VariantType):
                found = Field(self._share(column_name("path", path), lambda: found.col), found.dtype)
            self._paths[path] = found
        return self._paths[path]

    def shared_entities(self, kind: str) -> Column:
        return self._share(f"__entity_{kind}", lambda: self.entities(kind))

    def shared_text(self) -> Column:
        return self._share("__text", self.all_text)

    def shared_image_urls(self) -> Column:
        return self._share("__image_urls", self.image_urls)

    def _share(self, name: str, build: Callable[[], Column]) -> Column:
        if name not in self._shared:
            self._shared[name] = build()
        return F.col(name)

    def with_shared(self, posts: DataFrame) -> DataFrame:
        """``posts`` with the columns which compiled operators refer to."""
        added = {n: c for n, c in self._shared.items() if n not in posts.columns}
        return posts.withColumns(added) if added else posts
