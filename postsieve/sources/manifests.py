"""Manifest bundles: ``[unused, conditions, manifests]`` with ids as string keys."""

from __future__ import annotations

import json

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def bundle_tables(bundles: DataFrame, column: str = "bundle") -> tuple[DataFrame, DataFrame]:
    """(conditions, manifests) of bundles given as JSON text; null manifests are skipped."""
    parsed = F.try_parse_json(column)

    def entries(position: int):
        as_map = F.try_variant_get(parsed, f"$[{position}]", "map<string,variant>")
        return bundles.select(F.explode(as_map).alias("id", "v"))

    def text(path: str):
        return F.try_variant_get("v", path, "string")

    conditions = entries(1).select(
        F.col("id").cast("long").alias("condition_id"),
        text("$.operator_name").alias("operator_name"),
        F.to_json(F.try_variant_get("v", "$.condition_parameters", "variant")).alias("condition_parameters"),
        F.try_variant_get("v", "$.algorithm_component_id", "long").alias("algorithm_component_id"),
    )
    manifests = entries(2).where(~F.is_variant_null("v")).select(
        F.col("id").cast("long").alias("algorithm_id"), F.to_json("v").alias("manifest")
    )
    return conditions, manifests


def load_bundle(spark: SparkSession, path: str) -> tuple[DataFrame, DataFrame]:
    bundles = spark.read.text(path, wholetext=True).withColumnRenamed("value", "bundle")
    return bundle_tables(bundles)


def manifest_dicts(conditions: DataFrame, manifests: DataFrame) -> tuple[dict, dict]:
    """Both tables as Python dicts, which is what compiling feeds into a plan needs.

    These are query texts, not data: rows are streamed to the driver partition by partition.
    """
    by_id = {
        r.condition_id: {
            "operator_name": r.operator_name,
            "condition_parameters": json.loads(r.condition_parameters),
            "algorithm_component_id": r.algorithm_component_id,
        }
        for r in conditions.toLocalIterator()
    }
    return by_id, {r.algorithm_id: json.loads(r.manifest) for r in manifests.toLocalIterator()}
