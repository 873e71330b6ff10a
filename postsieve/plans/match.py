"""Matching posts against one filter, or against many feeds in one pass."""

from __future__ import annotations

import functools
import json
import traceback
from collections.abc import Iterable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from postsieve.operators.builtin import DEFAULT_REGISTRY
from postsieve.operators.leaf import COST_MODEL, PostView
from postsieve.operators.registry import Registry
from postsieve.plans.attach import Catalog, attach, check_needs, keep_members
from postsieve.plans.feed_index import match_indexed
from postsieve.plans.tree import (
    Node,
    as_column,
    as_sql,
    compile_tree,
    environment,
    is_operable,
    rehydrate,
    render,
    render_sql,
    with_models_as,
)

# How many feeds share one array expression; more go into further arrays of the same pass.
FEEDS_PER_ARRAY = 100
# Fixed value: how many feeds are tested on every post at most; more are looked up.
FEEDS_PER_PASS = 1000


def filter_posts(
    posts: DataFrame,
    condition: dict,
    view: PostView,
    catalog: Catalog = Catalog(),
    registry: Registry = DEFAULT_REGISTRY,
    staged: bool = True,
) -> DataFrame:
    """The posts which satisfy ``condition``, with their own columns.

    Parts of a top-level AND run first and separately: plain predicates as a filter which reaches
    the scan, author sets as semi or anti joins.  What needs a model runs last and, in ``staged``
    mode, only on posts which the rest of the tree leaves undecided.
    """
    tree = compile_tree(condition, view, registry)
    columns = posts.columns
    posts = view.with_shared(posts)
    remaining: list[Node] = []
    joins: list[Node] = []
    for node in sorted(_conjuncts(tree), key=lambda n: n.cost):
        if not node.needs:
            posts = posts.where(as_column(render(node)))
        elif node.leaf is not None and node.leaf.membership is not None:
            joins.append(node)
        else:
            remaining.append(node)
    for node in joins:
        posts = keep_members(posts, view, node.leaf.membership, node.leaf.negated, catalog)
    if not remaining:
        return posts.select(*columns)
    rest = remaining[0] if len(remaining) == 1 else Node({}, "0", "and", tuple(remaining))
    set_needs = [n for n in _needs_below(rest, COST_MODEL)]
    if rest.cost < COST_MODEL:
        return attach(posts, view, set_needs, catalog).where(as_column(render(rest))).select(*columns)
    posts = attach(posts, view, set_needs, catalog)
    if not staged:
        return attach(posts, view, rest.needs, catalog).where(as_column(render(rest))).select(*columns)
    upper, lower = render(rest, with_models_as(True)), render(rest, with_models_as(False))
    if upper is False:
        return posts.where(F.lit(False)).select(*columns)
    undecided = posts.where(as_column(upper) & ~as_column(lower))
    matched = attach(undecided, view, rest.needs, catalog).where(as_column(render(rest))).select(*columns)
    if lower is False:
        return matched
    return posts.where(as_column(lower)).select(*columns).unionByName(matched)


def flag_posts(
    posts: DataFrame,
    condition: dict,
    view: PostView,
    catalog: Catalog = Catalog(),
    registry: Registry = DEFAULT_REGISTRY,
    name: str = "matched",
) -> DataFrame:
    """All ``posts``, each once, with the answer of ``condition`` as boolean column ``name``.

    Models see only the posts which the rest of the tree leaves undecided.
    """
    tree = compile_tree(condition, view, registry)
    columns = posts.columns
    posts = attach(view.with_shared(posts), view, _needs_below(tree, COST_MODEL), catalog)
    if tree.cost < COST_MODEL:
        return posts.select(*columns, as_column(render(tree)).alias(name))
    upper, lower = (as_column(render(tree, with_models_as(v))) for v in (True, False))
    undecided = upper & ~lower
    scored = attach(posts.where(undecided), view, tree.needs, catalog)
    decided = posts.where(~undecided).select(*columns, lower.alias(name))
    return decided.unionByName(scored.select(*columns, as_column(render(tree)).alias(name)))


def _conjuncts(node: Node) -> list[Node]:
    if node.connective == "and":
        return [c for child in node.children for c in _conjuncts(child)]
    return [node]


def _needs_below(node: Node, cost: int) -> list:
    return list(dict.fromkeys(n for leaf in node.leaves() if leaf.leaf.cost < cost for n in leaf.leaf.needs))


@dataclass(frozen=True)
class Feed:
    """A feed ready to run, or the reason why it is not.  Feeds compiled together share a view."""

    algorithm_id: int
    tree: Node | None
    view: PostView
    environment: str = "cpu"
    operable: bool = True
    error: dict | None = None


def compile_feeds(
    manifests: dict[int, dict | None],
    conditions: dict[int, dict],
    view: PostView,
    registry: Registry = DEFAULT_REGISTRY,
    catalog: Catalog | None = None,
) -> list[Feed]:
    """Compile every manifest on its own; a broken one never affects the others.

    Null manifests are skipped.  A feed with an unknown operator runs but matches nothing.  Given
    the ``catalog``, a feed which needs a table that is not there counts as broken.
    """
    feeds = []
    built: dict = {}
    for algorithm_id, manifest in manifests.items():
        if not manifest:
            continue
        try:
            full = rehydrate(manifest, conditions)
            if not is_operable(full, registry):
                feeds.append(Feed(algorithm_id, None, view, environment(full, registry), operable=False))
                continue
            tree = compile_tree(full["filter"], view, registry, built=built)
            if catalog is not None:
                check_needs(tree.needs, catalog)
            feeds.append(Feed(algorithm_id, tree, view, environment(full, registry)))
        except Exception as error:  # noqa: BLE001 - reported in the feed's response
            details = {
                "error_type": type(error).__name__,
                "error_message": str(error),
                "error_stack_trace": traceback.format_exception(error),
                "algorithm_id": algorithm_id,
            }
            feeds.append(Feed(algorithm_id, None, view, "none", operable=False, error=details))
    return feeds


def match_feeds(
    posts: DataFrame, feeds: list[Feed], catalog: Catalog = Catalog(), feeds_per_pass: int = FEEDS_PER_PASS
) -> DataFrame:
    """``posts`` columns plus ``algorithm_id``: one row per post and feed it matches.

    Up to ``feeds_per_pass`` feeds are tested on every post.  A condition used by several feeds is
    evaluated once, as a boolean column.  Feeds with model leaves contribute their model-free lower
    bound to that pass; a second pass scores only the posts which some such feed leaves undecided.

    More feeds go through an index (:mod:`postsieve.plans.feed_index`) in one pass, those with model
    leaves in passes of ``feeds_per_pass``.
    """
    live = [f for f in feeds if f.tree is not None]
    if len(live) > feeds_per_pass:
        plain = {f.algorithm_id: f.tree for f in live if f.tree.cost < COST_MODEL}
        rest = [f for f in live if f.tree.cost >= COST_MODEL]
        starts = range(0, len(rest), feeds_per_pass)
        passes = [match_feeds(posts, rest[i : i + feeds_per_pass], catalog, feeds_per_pass) for i in starts]
        return functools.reduce(DataFrame.unionByName, [match_indexed(posts, plain, live[0].view, catalog), *passes])
    trees = {f.algorithm_id: f.tree for f in live}
    cheap = {i: t for i, t in trees.items() if t.cost < COST_MODEL}
    costly = {i: t for i, t in trees.items() if t.cost >= COST_MODEL}
    columns = posts.columns
    if not trees:
        return posts.select(*columns, F.lit(None).cast("long").alias("algorithm_id")).where(F.lit(False))
    view = live[0].view
    posts = view.with_shared(posts)
    posts = attach(posts, view, [n for t in trees.values() for n in _needs_below(t, COST_MODEL)], catalog)
    leaves = _NamedLeaves(trees.values())
    posts = posts.withColumns(leaves.plain) if leaves.plain else posts

    decided = {i: render_sql(t, leaves.value) for i, t in cheap.items()}
    decided.update({i: render_sql(t, leaves.bound(False)) for i, t in costly.items()})
    result = _explode_matches(posts, decided, columns)
    if not costly:
        return result
    open_for = {
        i: f"({as_sql(render_sql(t, leaves.bound(True)))} AND NOT {as_sql(decided[i])})" for i, t in costly.items()
    }
    undecided = posts.where(F.expr(" OR ".join(open_for.values())))
    scored = attach(undecided, view, [n for t in costly.values() for n in t.needs], catalog)
    scored = scored.withColumns(leaves.model) if leaves.model else scored
    full = {i: f"({open_for[i]} AND {as_sql(render_sql(t, leaves.value))})" for i, t in costly.items()}
    return result.unionByName(_explode_matches(scored, full, columns))


class _NamedLeaves:
    """Every distinct leaf of some trees as a named boolean column.

    A leaf used by many feeds is evaluated once.  One used by a single feed is folded back into
    that feed's expression by the optimizer, and there is skipped when the feed is already decided.
    """

    def __init__(self, trees: Iterable[Node]):
        self._names: dict[str, str] = {}
        self.plain: dict[str, Column] = {}
        self.model: dict[str, Column] = {}
        for node in (n for t in trees for n in t.leaves()):
            if node.key in self._names or isinstance(node.leaf.predicate, bool):
                continue
            name = self._names[node.key] = f"__leaf_{len(self._names)}"
            (self.model if node.leaf.cost == COST_MODEL else self.plain)[name] = node.leaf.predicate

    def value(self, node: Node) -> str | bool:
        return self._names.get(node.key, node.leaf.predicate)

    def bound(self, model_value: bool):
        return lambda node: model_value if node.leaf.cost == COST_MODEL else self.value(node)


def _explode_matches(posts: DataFrame, predicates: dict[int, str | bool], columns: list[str]) -> DataFrame:
    """One row per post and feed whose predicate (SQL over leaf columns) holds."""
    ids = [f"CASE WHEN {as_sql(p)} THEN {int(i)}L END" for i, p in predicates.items() if p is not False]
    chunks = [ids[k : k + FEEDS_PER_ARRAY] for k in range(0, len(ids), FEEDS_PER_ARRAY)]
    if not chunks:
        return posts.select(*columns, F.lit(None).cast("long").alias("algorithm_id")).where(F.lit(False))
    arrays = [F.expr(f"array_compact(array({', '.join(chunk)}))") for chunk in chunks]
    matched = arrays[0] if len(arrays) == 1 else F.concat(*arrays)
    return posts.select(*columns, F.explode(matched).alias("algorithm_id"))


def project_matches(matched: DataFrame, view: PostView, *keep: str) -> DataFrame:
    """The columns reported for a match.  Needs ``collection``, ``rkey`` and ``cid`` columns."""
    from postsieve.functions.extract import post_uri

    record = view.record

    def text_at(path: str) -> Column:
        from postsieve.functions.field import resolve

        found = resolve(record, path)
        return F.lit(None).cast("string") if found.is_missing else found.col.cast("string")

    raw = F.col("raw") if "raw" in matched.columns else F.to_json(record.col)
    return matched.select(
        *keep,
        post_uri(view.did, F.col("collection"), F.col("rkey")).alias("uri"),
        F.col("cid"),
        view.did.alias("author"),
        text_at("reply.parent.uri").alias("reply_parent"),
        text_at("reply.root.uri").alias("reply_root"),
        text_at("createdAt").alias("bluesky_created_at"),
        raw.alias("raw_record"),
    )


def parse_bundle(bundle: str) -> tuple[dict[int, dict], dict[int, dict | None]]:
    """``[unused, conditions, manifests]`` with string keys -> (conditions, manifests)."""
    _, conditions, manifests = json.loads(bundle)
    return {int(k): v for k, v in conditions.items()}, {int(k): v for k, v in manifests.items()}
