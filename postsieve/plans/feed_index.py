"""An inverted index from what posts have (tags, words, authors, fields) to the feeds that ask for it.

A pass over thousands of feeds that tests each feed on each post grows with posts times feeds.  Here
a post looks up its own values: each finds the conditions which hold because of it, these find the
feeds which cannot match without them, and only the trees of those are worked out.  Conditions that
can't be looked up (ranges, arbitrary patterns) are tested on every post, each distinct one once.

The index is data in the plan, not code: tables of constants as large as the manifests themselves.
No row is shuffled for it.
"""

from __future__ import annotations

import functools
import json
import zlib
from collections import defaultdict
from dataclasses import dataclass, field
from typing import Any

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from postsieve.operators.leaf import Atoms, PostView, SetNeed
from postsieve.plans.attach import Catalog, attach_memberships
from postsieve.plans.tree import Node

# Ends of a program: the feed matches, or doesn't.
MATCH, NO_MATCH = -1, -2
# How often a condition is taken to hold; the rarest way to a feed is the one that leads to it.
_COMMON = {"plain": 1000, "field": 100, "entities:langs": 100, "members": 10}
# Conditions tested on every post which share one array expression.
PLAIN_PER_ARRAY = 100

Shape = Any  # True | False | (slot, negated) | ("and" | "or", [shapes])


@dataclass
class FeedIndex:
    """The tables of the index.  A slot is a distinct condition without its negation."""

    ids: list[int] = field(default_factory=list)
    programs: list[list[list[int]]] = field(default_factory=list)
    #: Feeds by the slot that leads to them, and feeds which nothing leads to.
    led: dict[int, list[int]] = field(default_factory=lambda: defaultdict(list))
    always: list[int] = field(default_factory=list)
    slots: dict[Any, int] = field(default_factory=dict)
    common: list[int] = field(default_factory=list)
    plain: dict[int, Column] = field(default_factory=dict)
    places: dict[str, Atoms] = field(default_factory=dict)
    postings: dict[str, dict[str, list[int]]] = field(default_factory=lambda: defaultdict(lambda: defaultdict(list)))
    patterns: dict[str, dict[int, str]] = field(default_factory=lambda: defaultdict(dict))
    needs: dict[str, list[SetNeed]] = field(default_factory=lambda: defaultdict(list))

    def add(self, algorithm_id: int, tree: Node) -> None:
        shape = self._shape(tree)
        if shape is False:
            return
        number = len(self.ids)
        self.ids.append(int(algorithm_id))
        self.programs.append(program(shape))
        leading = self._leading(shape)
        for slot in leading or ():
            self.led[slot].append(number)
        if leading is None:
            self.always.append(number)

    def _shape(self, node: Node) -> Shape:
        """The tree over slots, without constants."""
        if node.leaf is not None:
            return self._slot(node)
        absorbing = node.connective == "or"
        parts = []
        for child in sorted(node.children, key=lambda c: c.cost):
            shape = self._shape(child)
            if isinstance(shape, bool):
                if shape is absorbing:
                    return absorbing
                continue
            parts.append(shape)
        if not parts:
            return not absorbing
        return parts[0] if len(parts) == 1 else (node.connective, parts)

    def _slot(self, node: Node) -> Shape:
        leaf = node.leaf
        if isinstance(leaf.test, bool):
            return leaf.test
        if leaf.membership is not None:
            on, name = leaf.membership.on, leaf.membership.column
            atoms = Atoms(f"members:{on}", functools.partial(F.col, members_column(on)), (name,))
        else:
            atoms = leaf.atoms
        key = ("plain", node.key) if atoms is None else (atoms.place, atoms.values, atoms.pattern)
        if key not in self.slots:
            slot = self.slots[key] = len(self.slots)
            kind = "plain" if atoms is None else atoms.place
            share = _COMMON.get(kind) or _COMMON.get(kind.split(":")[0])
            self.common.append(share or len(atoms.values))
            if atoms is None:
                self.plain[slot] = leaf.predicate
                return slot, False
            self.places.setdefault(atoms.place, atoms)
            for value in atoms.values:
                self.postings[atoms.place][value].append(slot)
            if atoms.pattern is not None:
                self.patterns[atoms.place][slot] = atoms.pattern
            if leaf.membership is not None:
                self.needs[leaf.membership.on].append(leaf.membership)
        return self.slots[key], leaf.negated and atoms is not None

    def _leading(self, shape: Shape) -> set[int] | None:
        """Slots of which at least one holds wherever the tree does; None if there are none such."""
        if shape is True:
            return None
        if isinstance(shape[0], int):
            return None if shape[1] else {shape[0]}
        ways = [self._leading(part) for part in shape[1]]
        if shape[0] == "or":
            return None if None in ways else set().union(*ways)
        known = [w for w in ways if w is not None]
        return min(known, key=lambda w: sum(self.common[s] for s in w), default=None)


def members_column(on: str) -> str:
    return f"__members_{on}"


def program(shape: Shape) -> list[list[int]]:
    """``[place, slot, negated, next if it holds, next if not]`` for each leaf in order.

    Every step leads forward, so one run over the list works out the tree, and what a decided branch
    leaves over is skipped.
    """
    if shape is True:
        return [[0, -1, 1, MATCH, MATCH]]
    steps: list[list[int]] = []

    def size(part: Shape) -> int:
        return 1 if isinstance(part[0], int) else sum(size(p) for p in part[1])

    def emit(part: Shape, yes: int, no: int) -> None:
        if isinstance(part[0], int):
            steps.append([len(steps), part[0], int(part[1]), yes, no])
            return
        for i, child in enumerate(part[1]):
            if i == len(part[1]) - 1:
                emit(child, yes, no)
            elif part[0] == "and":
                emit(child, len(steps) + size(child), no)
            else:
                emit(child, yes, len(steps) + size(child))

    emit(shape, MATCH, NO_MATCH)
    return steps


def _table(values: Any, dtype: str) -> Column:
    """A constant table.  As JSON it is one call to Spark, and is read once, when the plan is optimised."""
    return F.from_json(F.lit(json.dumps({"t": values})), f"t {dtype}")["t"]


def _buckets(postings: dict[str, list[int]]) -> list[dict[str, list[int]] | None]:
    """A hash table: few entries a bucket, whatever the number of values."""
    buckets: list[dict[str, list[int]] | None] = [None] * (1 << (2 * len(postings)).bit_length())
    for value, slots in postings.items():
        at = zlib.crc32(value.encode()) % len(buckets)
        buckets[at] = (buckets[at] or {}) | {value: slots}
    return buckets


def _holding(index: FeedIndex, place: str) -> Column:
    """Slots which hold because of what a post has at ``place``."""
    atoms, buckets = index.places[place], _buckets(index.postings[place])
    table = _table(buckets, "array<map<string,array<int>>>")

    def of(value: Column) -> Column:
        bucket = F.pmod(F.crc32(value), F.lit(len(buckets))).cast("int")
        return F.try_element_at(F.get(table, bucket), value)

    found = F.filter(F.transform(atoms.source(), of), lambda slots: slots.isNotNull())
    slots = F.array_distinct(F.flatten(found))
    if place in index.patterns:
        patterns, text = index.patterns[place], atoms.text()
        listed = _table([patterns.get(s) for s in range(len(index.slots))], "array<string>")
        slots = F.filter(slots, lambda slot: F.rlike(text, F.get(listed, slot)))
    return F.coalesce(slots, _none())


def _none() -> Column:
    return F.array().cast("array<int>")


def match_indexed(
    posts: DataFrame, trees: dict[int, Node], view: PostView, catalog: Catalog = Catalog()
) -> DataFrame:
    """``posts`` columns plus ``algorithm_id``: one row per post and tree (without models) that matches.

    The same rows as testing every tree on every post.  A post costs its own values, the distinct
    conditions that can't be looked up, and the trees it may match.
    """
    index = FeedIndex()
    for algorithm_id, tree in trees.items():
        index.add(algorithm_id, tree)
    columns = posts.columns
    if not index.ids:
        return posts.select(*columns, F.lit(None).cast("long").alias("algorithm_id")).where(F.lit(False))
    for on in index.needs:
        if on != "did":
            view.shared_entities(on)
    posts = view.with_shared(posts)
    for on, needs in index.needs.items():
        posts = attach_memberships(posts, view, on, list(dict.fromkeys(needs)), catalog, members_column(on))

    tested = [F.when(p, F.lit(slot)) for slot, p in index.plain.items()]
    chunks = [tested[k : k + PLAIN_PER_ARRAY] for k in range(0, len(tested), PLAIN_PER_ARRAY)]
    holding = [_holding(index, place) for place in index.places] + [F.array_compact(F.array(*c)) for c in chunks]
    # Out of a generator, or the look-ups would run again for every feed that reads their result.
    holds = F.concat(_none(), *holding).alias("__holds")
    posts = posts.select("*", F.inline(F.array(F.struct(holds))))
    led = _table([index.led.get(s, []) for s in range(len(index.slots))], "array<array<int>>")
    open_to = F.flatten(F.transform("__holds", lambda slot: F.get(led, slot)))
    open_to = F.array_distinct(F.concat(open_to, _table(index.always, "array<int>")))
    programs = _table(index.programs, "array<array<array<int>>>")

    def run(at: Column, step: Column) -> Column:
        holds = F.array_contains("__holds", step[1])
        return F.when(at != step[0], at).when(holds != (step[2] == 1), step[3]).otherwise(step[4])

    matched = F.filter(open_to, lambda feed: F.aggregate(F.get(programs, feed), F.lit(0), run) == MATCH)
    ids = _table(index.ids, "array<bigint>")
    return posts.select(*columns, F.explode(matched).alias("__feed")).select(
        *columns, F.get(ids, F.col("__feed")).alias("algorithm_id")
    )
