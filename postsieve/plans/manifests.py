"""Feed manifests as a table: flattening, usage, operability and environment.

``manifests`` has ``algorithm_id`` and ``manifest`` (JSON); ``conditions`` has ``condition_id``,
``operator_name``, ``condition_parameters`` (JSON) and ``algorithm_component_id``.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from postsieve.operators.builtin import DEFAULT_REGISTRY
from postsieve.operators.registry import Registry


def _nesting(json_text: Column) -> Column:
    """How deep square brackets nest: an upper bound for the levels of AND/OR lists."""
    unquoted = F.regexp_replace(json_text, r'"(?:\\.|[^"\\])*"', "")
    brackets = F.split(F.regexp_replace(unquoted, r"[^\[\]]", ""), "")
    state = F.aggregate(
        brackets,
        F.struct(F.lit(0).alias("depth"), F.lit(0).alias("deepest")),
        lambda s, c: F.struct(
            (s["depth"] + F.when(c == "[", 1).when(c == "]", -1).otherwise(0)).alias("depth"),
            F.greatest(s["deepest"], s["depth"] + F.when(c == "[", 1).otherwise(0)).alias("deepest"),
        ),
    )
    return state["deepest"]


def _levels(df: DataFrame, json_text: Column) -> int:
    return df.agg(F.max(_nesting(json_text))).first()[0] or 0


def _open_lists(nodes: DataFrame, levels: int) -> DataFrame:
    """Replace each AND/OR node by its children, ``levels`` times; leaves pass through."""
    for _ in range(levels):
        all_of = F.try_variant_get("node", "$.and", "array<variant>")
        any_of = F.try_variant_get("node", "$.or", "array<variant>")
        opened = nodes.select(
            "*",
            F.coalesce(all_of, any_of).alias("children"),
            F.when(all_of.isNotNull(), "and").when(any_of.isNotNull(), "or").alias("own"),
        )
        children = F.coalesce("children", F.array("node"))
        kept = [c for c in nodes.columns if c not in ("node", "node_path", "connective")]
        nodes = opened.select(*kept, "node_path", "connective", "own", F.posexplode(children).alias("at", "node"))
        nodes = nodes.select(
            *kept,
            F.when(F.col("own").isNull(), F.col("node_path"))
            .otherwise(F.concat_ws(".", "node_path", F.col("at").cast("string")))
            .alias("node_path"),
            F.coalesce("own", "connective").alias("connective"),
            "node",
        )
    return nodes


def _inline_leaves(nodes: DataFrame) -> DataFrame:
    """One row per operator key of a leaf object."""
    entries = F.map_entries(F.try_variant_get("node", "$", "map<string,variant>"))
    keys = F.filter(entries, lambda e: e["key"] != "metadata")
    return nodes.select("algorithm_id", "node_path", "connective", F.explode(keys).alias("leaf")).select(
        "algorithm_id",
        "node_path",
        "connective",
        F.col("leaf.key").alias("op"),
        F.to_json("leaf.value").alias("params"),
        F.lit(False).alias("missing"),
    )


def manifest_leaves(manifests: DataFrame, conditions: DataFrame) -> DataFrame:
    """``algorithm_id, node_path, connective, op, params, missing``: one row per leaf.

    Ids are replaced by their conditions; a component condition is opened like a subtree; an id
    without a condition gives a ``missing`` row.  Null manifests give nothing.
    """
    text = F.col("manifest")
    parsed = F.try_variant_get(F.try_parse_json(text), "$.filter", "variant")
    roots = manifests.where(text.isNotNull()).select(
        "algorithm_id",
        F.lit("0").alias("node_path"),
        F.lit(None).cast("string").alias("connective"),
        parsed.alias("node"),
    )
    nodes = _open_lists(roots.where(F.col("node").isNotNull()), _levels(manifests, text))
    is_id = F.schema_of_variant("node") == "BIGINT"
    inline = _inline_leaves(nodes.where(~is_id))

    ids = nodes.where(is_id).select(
        "algorithm_id", "node_path", "connective", F.try_variant_get("node", "$", "long").alias("condition_id")
    )
    found = ids.join(conditions, "condition_id", "left")
    is_component = F.coalesce(F.col("algorithm_component_id"), F.lit(0)) != 0
    plain = found.where(~is_component).select(
        "algorithm_id",
        "node_path",
        "connective",
        F.col("operator_name").alias("op"),
        F.col("condition_parameters").alias("params"),
        F.col("operator_name").isNull().alias("missing"),
    )
    components = conditions.where(is_component)
    subtrees = found.where(is_component).select(
        "algorithm_id", "node_path", "connective", F.try_parse_json("condition_parameters").alias("node")
    )
    opened = _open_lists(subtrees, _levels(components, F.col("condition_parameters")))
    return inline.unionByName(plain).unionByName(_inline_leaves(opened))


def operator_usage(leaves: DataFrame) -> DataFrame:
    return leaves.groupBy("op").agg(F.count(F.lit(1)).alias("uses"))


def manifest_status(leaves: DataFrame, registry: Registry = DEFAULT_REGISTRY) -> DataFrame:
    """``algorithm_id, operable, environment`` per manifest with at least one leaf."""
    known = F.col("op").isin(sorted(registry.names)) & ~F.col("missing")
    costly = F.col("op").isin(sorted(registry.model_names))
    return leaves.groupBy("algorithm_id").agg(
        F.bool_and(F.coalesce(known, F.lit(False))).alias("operable"),
        F.when(F.bool_or(F.coalesce(costly, F.lit(False))), "gpu").otherwise("cpu").alias("environment"),
    )
