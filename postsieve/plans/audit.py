"""Evaluate every node of a filter for given posts, without short-circuiting."""

from __future__ import annotations

import json

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from postsieve.operators.builtin import DEFAULT_REGISTRY
from postsieve.operators.leaf import PostView
from postsieve.operators.registry import Registry
from postsieve.plans.attach import Catalog, attach
from postsieve.plans.tree import Node, as_column, compile_tree, operators_of, render


def _evaluated(posts: DataFrame, tree: Node, view: PostView, catalog: Catalog):
    """Posts with each distinct leaf as a column, and the (result, score) columns of a node."""
    posts = attach(view.with_shared(posts), view, tree.needs, catalog)
    result_of: dict[str, str] = {}
    columns: dict[str, Column] = {}
    for node in tree.leaves():
        if node.key not in result_of:
            result_of[node.key] = f"__result_{len(result_of)}"
            result = as_column(node.leaf.predicate)
            columns[result_of[node.key]] = result
            score = node.leaf.score if node.leaf.score is not None else result.cast("double")
            columns[result_of[node.key] + "_score"] = score

    def result(node: Node) -> Column:
        return as_column(render(node, lambda n: F.col(result_of[n.key])))

    def score(node: Node) -> Column:
        if node.leaf is None:
            return F.lit(None).cast("double")
        return F.col(result_of[node.key] + "_score")

    return posts.withColumns(columns), result, score


def audit_nodes(
    posts: DataFrame,
    condition: dict,
    view: PostView,
    catalog: Catalog = Catalog(),
    registry: Registry = DEFAULT_REGISTRY,
) -> DataFrame:
    """One row per post and node: key columns, ``node_path``, ``op``, ``condition``, ``score``, ``result``.

    A leaf's score is its model score, or its result as 0/1; AND/OR nodes have none.
    """
    tree = compile_tree(condition, view, registry)
    evaluated, result, score = _evaluated(posts, tree, view, catalog)
    rows = [
        F.struct(
            F.lit(node.path).alias("node_path"),
            F.lit(node.connective or min(operators_of(node.condition))).alias("op"),
            F.lit(json.dumps(node.condition, ensure_ascii=False)).alias("condition"),
            score(node).alias("score"),
            result(node).alias("result"),
        )
        for node in tree.nodes()
    ]
    return evaluated.select(*view.key, F.inline(F.array(*rows)))


def audit_trees(
    posts: DataFrame,
    condition: dict,
    view: PostView,
    catalog: Catalog = Catalog(),
    registry: Registry = DEFAULT_REGISTRY,
) -> DataFrame:
    """One row per post with the audit as JSON which mirrors the filter."""
    tree = compile_tree(condition, view, registry)
    evaluated, result, score = _evaluated(posts, tree, view, catalog)

    def as_json(node: Node) -> Column:
        scores = F.concat(F.lit("["), score(node).cast("string"), F.lit("]")) if node.leaf else F.lit("[]")
        parts = [
            F.lit('{"condition":' + json.dumps(node.condition, ensure_ascii=False) + ',"scores":'),
            F.coalesce(scores, F.lit("[null]")),
            F.lit(',"result":['),
            result(node).cast("string"),
            F.lit("]"),
        ]
        if node.children:
            parts += [
                F.lit(',"sub_audit":['),
                F.concat_ws(",", *[as_json(child) for child in node.children]),
                F.lit("]"),
            ]
        return F.concat(*parts, F.lit("}"))

    return evaluated.select(*view.key, result(tree).alias("result"), as_json(tree).alias("audit"))
