"""Keys under which assets and model results are stored and found again."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def parameter_string(parameters: dict) -> str:
    """``{"b": 2, "a": 1}`` -> ``"a:1__b:2"``."""
    return "__".join(f"{k}:{parameters[k]}" for k in sorted(parameters))


def asset_key(asset_type: str, parameters: dict) -> str:
    return f"{asset_type}__{parameter_string(parameters)}"


def parameter_string_column(parameters: Column) -> Column:
    """:func:`parameter_string` over a ``map<string,string>`` column."""
    entries = F.array_sort(F.map_entries(parameters))
    return F.array_join(F.transform(entries, lambda e: F.concat(e["key"], F.lit(":"), e["value"])), "__")


def asset_key_column(asset_type: Column, parameters: Column) -> Column:
    return F.concat(asset_type, F.lit("__"), parameter_string_column(parameters))


def score_key(model: str, text: Column, suffix: str = "") -> Column:
    """``sha256(model:text[:suffix])`` in hex."""
    parts = [F.lit(model + ":"), F.coalesce(text, F.lit(""))]
    if suffix:
        parts.append(F.lit(":" + suffix))
    # The outer coalesce never applies, but tells the planner that a key is never NULL; otherwise a
    # join would hash every text once more just to test for that.
    return F.coalesce(F.sha2(F.concat(*parts), 256), F.lit(""))


def image_key(model: str, url: Column, category: str) -> Column:
    return score_key(model, url, category)


def zero_shot_labels(category: str) -> tuple[str, str]:
    """What a zero-shot model is asked to tell apart."""
    return category, f"not_{category}"


def zero_shot_suffix(category: str) -> str:
    """The part of a zero-shot key which names the two labels and the multi-label flag."""
    return f"{'|'.join(zero_shot_labels(category))}:False"
