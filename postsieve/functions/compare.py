"""Two-valued comparison of a field with a constant.

Every predicate built here is TRUE or FALSE, never NULL, so it can be negated and combined freely.
A missing value (NULL, or an empty string) counts as ``0`` when the threshold reads as a number
and as ``''`` otherwise.  Strings are never turned into numbers: a string under a numeric threshold
is unequal to it and out of order with it.

Null handling is written as ``x IS NOT NULL AND x > t`` (or ``x IS NULL OR ...``) rather than with
``coalesce`` so that the comparison itself still reaches the Parquet scan as a pushed filter.
"""

from __future__ import annotations

import math
import operator
from collections.abc import Callable
from typing import Any

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

from postsieve.functions.field import Field

ORDERING: dict[str, Callable[[Any, Any], Any]] = {
    ">=": operator.ge,
    "<=": operator.le,
    ">": operator.gt,
    "<": operator.lt,
}
COMPARATORS = ("==", "!=", ">=", "<=", ">", "<", "in", "not_in")


def compare(value: Field, comparator: str, threshold: Any) -> Column:
    """``value comparator threshold`` for every row."""
    if comparator not in COMPARATORS:
        raise ValueError(f"Unknown comparator '{comparator}'")
    if comparator == "!=":
        return ~compare(value, "==", threshold)
    if comparator == "not_in":
        return ~compare(value, "in", threshold)
    if isinstance(value.dtype, T.ArrayType):
        return _any_element(value, comparator, threshold)
    if isinstance(value.dtype, T.VariantType):
        return _scalar(value, comparator, threshold) | _variant_elements(value, comparator, threshold)
    return _scalar(value, comparator, threshold)


def compare_constant(value: Any, comparator: str, threshold: Any) -> bool:
    """The same comparison with a constant on the left, decided while the plan is built."""
    if comparator not in COMPARATORS:
        raise ValueError(f"Unknown comparator '{comparator}'")
    if comparator in ("!=", "not_in"):
        return not compare_constant(value, "==" if comparator == "!=" else "in", threshold)
    if isinstance(value, list):
        return any(compare_constant(v, comparator, threshold) for v in value or [None])
    if comparator == "in" and isinstance(threshold, list) and threshold != [None]:
        return any(_same(_blank_to(value, ""), t) for t in threshold)
    numeric, limit = normalise_threshold(threshold)
    return _decide(_blank_to(value, 0 if numeric else ""), "==" if comparator == "in" else comparator, limit)


def normalise_threshold(threshold: Any) -> tuple[bool, Any]:
    """``(is_numeric, value)`` with numeric-like text cast to float and blanks replaced."""
    if isinstance(threshold, (int, float)):
        return True, threshold
    if threshold is None or threshold == [None] or threshold == "":
        return False, ""
    if isinstance(threshold, str):
        try:
            return True, float(threshold)
        except ValueError:
            return False, threshold
    return False, threshold


def _blank_to(value: Any, blank: Any) -> Any:
    return blank if value is None or value == "" or value == [None] else value


def _same(left: Any, right: Any) -> bool:
    return isinstance(left, str) == isinstance(right, str) and left == right


def _decide(left: Any, comparator: str, limit: Any) -> bool:
    if comparator == "==" or limit == "":
        return _same(left, limit)
    if isinstance(left, str) != isinstance(limit, str):
        return False
    return ORDERING[comparator](left, limit)


def _scalar(value: Field, comparator: str, threshold: Any) -> Column:
    if comparator == "in":
        if isinstance(threshold, list) and threshold != [None]:
            return _one_of(value, threshold)
        comparator = "=="
    numeric, limit = normalise_threshold(threshold)
    if isinstance(limit, (list, dict)):
        if comparator == "==":
            return F.lit(False)
        raise ValueError(f"'{comparator}' needs a single value to compare with")
    if limit == "":
        comparator = "=="
    if numeric and math.isnan(limit):
        return F.lit(False)
    if_missing = _decide(0 if numeric else "", comparator, limit)
    if value.is_missing:
        return F.lit(if_missing)
    absent, present = _numeric(value, comparator, limit) if numeric else _textual(value, comparator, limit)
    if present is None:
        return absent if if_missing else F.lit(False)
    return (absent | present) if if_missing else (~absent & present)


def _numeric(value: Field, comparator: str, limit: float) -> tuple[Column, Column | None]:
    """(value is missing, present value satisfies); the latter is None when no value of the type can."""
    col, dtype = value.col, value.dtype
    if isinstance(dtype, T.BooleanType):
        return col.isNull(), _native(col.cast("double"), comparator, float(limit))
    if isinstance(dtype, T.IntegralType):
        return col.isNull(), _whole_number(col, comparator, limit)
    if isinstance(dtype, T.NumericType):
        ordered = _native(col, comparator, limit)
        if comparator in (">", ">=") and isinstance(dtype, (T.FloatType, T.DoubleType)):
            ordered = ordered & ~F.isnan(col)  # Spark sorts NaN above everything
        return col.isNull(), ordered
    if isinstance(dtype, T.StringType):
        return col.isNull() | (col == ""), None
    if isinstance(dtype, T.VariantType):
        as_text = F.try_variant_get(col, "$", "string")
        as_number = F.try_variant_get(col, "$", "double")
        ordered = F.coalesce(_native(as_number, comparator, float(limit)), F.lit(False))
        return as_text.isNull() | (as_text == ""), ordered & ~_is_variant_text(col)
    return col.isNull(), None


def _whole_number(col: Column, comparator: str, limit: float) -> Column | None:
    """Compare an integer column with an integer literal, so no cast hides it from the scan."""
    if math.isinf(limit):
        return F.lit(_decide(0.0, comparator, limit))
    if float(limit).is_integer():
        return _native(col, comparator, int(limit))
    if comparator == "==":
        return None
    rounded = math.floor(limit) if comparator in (">", "<=") else math.ceil(limit)
    return _native(col, comparator, rounded)


def _textual(value: Field, comparator: str, limit: str) -> tuple[Column, Column | None]:
    col, dtype = value.col, value.dtype
    if isinstance(dtype, T.StringType):
        return col.isNull(), _native(col, comparator, limit)
    if isinstance(dtype, T.VariantType):
        as_text = F.try_variant_get(col, "$", "string")
        ordered = F.coalesce(_native(as_text, comparator, limit), F.lit(False))
        return as_text.isNull(), ordered & _is_variant_text(col)
    if isinstance(dtype, (T.DateType, T.TimestampType, T.TimestampNTZType)):
        return col.isNull(), _native(col.cast("string"), comparator, limit)
    return col.isNull(), None


def _native(col: Column, comparator: str, limit: Any) -> Column:
    return col == F.lit(limit) if comparator == "==" else ORDERING[comparator](col, F.lit(limit))


def _one_of(value: Field, listed: list) -> Column:
    """Membership in a list; a missing value belongs only if ``''`` is listed."""
    texts = sorted({t for t in listed if isinstance(t, str)})
    numbers = sorted({float(t) for t in listed if isinstance(t, (int, float)) and t == t})
    # Whole numbers stay whole: beyond 2^53 neighbours share one float.
    whole = {int(t) for t in listed if isinstance(t, int) or (isinstance(t, float) and t.is_integer())}
    whole = sorted(n for n in whole if -(2**63) <= n < 2**63)
    blank_listed = "" in texts
    if value.is_missing:
        return F.lit(blank_listed)
    col, dtype = value.col, value.dtype
    if isinstance(dtype, T.StringType):
        absent, inside = col.isNull(), _isin(col, texts)
    elif isinstance(dtype, T.BooleanType):
        absent, inside = col.isNull(), _isin(col.cast("double"), numbers)
    elif isinstance(dtype, T.IntegralType):
        absent, inside = col.isNull(), _isin(col, whole)
    elif isinstance(dtype, T.NumericType):
        absent, inside = col.isNull(), _isin(col, numbers)
    elif isinstance(dtype, T.VariantType):
        as_text = F.try_variant_get(col, "$", "string")
        as_number = F.try_variant_get(col, "$", "double")
        absent = as_text.isNull()
        exact = F.schema_of_variant(col).startswith("BIGINT")
        as_whole = F.when(exact, F.try_variant_get(col, "$", "bigint"))
        is_number = F.when(exact, _isin(as_whole, whole)).otherwise(_isin(as_number, numbers))
        inside = F.coalesce(
            F.when(_is_variant_text(col), _isin(as_text, texts)).otherwise(is_number),
            F.lit(False),
        )
    else:
        absent, inside = col.isNull(), F.lit(False)
    return (absent | inside) if blank_listed else (~absent & inside)


def _isin(col: Column, values: list) -> Column:
    return col.isin(values) if values else F.lit(False)


def _is_variant_text(col: Column) -> Column:
    return F.schema_of_variant(col) == "STRING"


def _any_element(value: Field, comparator: str, threshold: Any) -> Column:
    """Array values: some element satisfies the comparison; an empty array acts as one missing value."""
    element = value.dtype.elementType
    array = F.coalesce(value.col, F.lit(None).cast(value.dtype))
    if_empty = compare_constant(None, comparator, threshold)
    found = _contains(value, threshold) if comparator == "==" else None
    if found is None:
        found = F.coalesce(
            F.exists(array, lambda x: _scalar(Field(x, element), comparator, threshold)), F.lit(False)
        )
    return (found | (F.coalesce(F.size(array), F.lit(0)) <= 0)) if if_empty else found


def _contains(value: Field, threshold: Any) -> Column | None:
    """``array_contains`` (compiled, no lambda) wherever no blank element could equal the threshold."""
    numeric, limit = normalise_threshold(threshold)
    element = value.dtype.elementType
    if isinstance(limit, (list, dict)) or limit == "" or (numeric and (limit == 0 or math.isnan(limit))):
        return None
    if isinstance(element, T.StringType) and not numeric:
        return F.coalesce(F.array_contains(value.col, F.lit(limit)), F.lit(False))
    if isinstance(element, T.DoubleType) and numeric:
        return F.coalesce(F.array_contains(value.col, F.lit(float(limit))), F.lit(False))
    return None


def _variant_elements(value: Field, comparator: str, threshold: Any) -> Column:
    """A JSON array found at a plain path is compared element-wise, like a typed array."""
    elements = F.try_variant_get(value.col, "$", "array<variant>")
    return F.coalesce(
        F.exists(elements, lambda x: _scalar(Field(x, T.VariantType()), comparator, threshold)),
        F.lit(False),
    )
