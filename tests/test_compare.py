import math

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from postsieve.functions.compare import COMPARATORS, compare, compare_constant, normalise_threshold
from postsieve.functions.field import Field

# value, comparator, threshold, expected
CASES = [
    (5, "==", 5, True),
    (5, "==", 4, False),
    (None, "==", "", True),
    ("", "==", None, True),
    ("foo", "==", None, False),
    (5, "!=", 4, True),
    (5, "!=", 5, False),
    (None, "!=", "", False),
    ("x", "!=", None, True),
    (5, ">=", 5, True),
    (4, ">=", None, False),
    (None, ">=", 4, False),
    ("", ">=", "", True),
    (5, "<=", 5, True),
    (5, "<=", None, False),
    (None, "<=", 5, True),
    (0.2, "<=", "0.7", True),
    (6, ">", 5, True),
    (5, ">", 5, False),
    (5, ">", None, False),
    (5, "<", None, False),
    (1, "in", [1, 2, 3], True),
    (None, "in", ["", "x"], True),
    (None, "in", ["x"], False),
    ("a", "in", ["x", "y"], False),
    (1, "not_in", [1, 2, 3], False),
    ("a", "not_in", ["x", "y"], True),
    (None, "not_in", ["", "a"], False),
    ("", "not_in", ["", "a"], False),
    (3, "in", [3, "", "x"], True),
    (None, "==", None, True),
    ("abc", "!=", "", True),
    (2, "!=", "", True),
    # numeric-like thresholds are numbers, strings are never coerced
    (None, "==", 0, True),
    ("", "==", "0.0", True),
    ("1.1", ">", 0, False),
    ("5", "==", 5, False),
    ("5", "!=", 5, True),
    ("2024", "==", "2024", False),
    (4, ">=", "4", True),
    (3, "==", "foo", False),
    (3, "<", "foo", False),
    ("", "<", "foo", True),
    ("bar", "<", "foo", True),
    (7, "<", 7.5, True),
    (7, ">", 6.5, True),
    (7, ">=", 7.5, False),
    (-7, "<=", -6.5, True),
    (-7, ">", -7.5, True),
    (7, "==", 7.5, False),
    (7, "in", 7, True),
    (7, "in", "7", True),
    (None, "in", 0, True),
    (True, "==", 1, True),
    (False, "<", True, True),
    (7, "==", float("nan"), False),
    (7, "!=", float("nan"), True),
    (7, "<", float("inf"), True),
    (7, "in", [], False),
    (7, "in", ["7"], False),
]


def columns_for(value):
    """The types a value may be stored with."""
    if isinstance(value, bool):
        return {"b": (T.BooleanType(), value)}
    if isinstance(value, int):
        return {"l": (T.LongType(), value), "d": (T.DoubleType(), float(value)), "i": (T.IntegerType(), value)}
    if isinstance(value, float):
        return {"d": (T.DoubleType(), value)}
    if isinstance(value, str):
        return {"s": (T.StringType(), value)}
    return {k: (t, None) for k, t in {"l": T.LongType(), "d": T.DoubleType(), "s": T.StringType(), "b": T.BooleanType(), "n": T.NullType()}.items()}


def test_scalar_cases_for_every_storage_type(spark):
    import json

    names, columns, expected = [], [], []
    for value, comparator, threshold, want in CASES:
        for kind, (dtype, stored) in columns_for(value).items():
            field = Field(F.lit(stored).cast(dtype) if kind != "n" else F.lit(None), dtype)
            names.append((value, comparator, threshold, kind))
            columns.append(compare(field, comparator, threshold))
            expected.append(want)
        variant = F.parse_json(F.lit(json.dumps(value)))
        names.append((value, comparator, threshold, "variant"))
        columns.append(compare(Field(variant, T.VariantType()), comparator, threshold))
        expected.append(want)
        assert compare_constant(value, comparator, threshold) is want, (value, comparator, threshold)
    row = spark.range(1).select(*[c.alias(f"c{i}") for i, c in enumerate(columns)]).first()
    wrong = [(n, got, want) for n, got, want in zip(names, row, expected) if got is not want]
    assert wrong == []


def test_array_cases(spark):
    strings, numbers = T.ArrayType(T.StringType()), T.ArrayType(T.DoubleType())
    cases = [
        (["a", None], strings, "==", "", True),
        (["b", ""], strings, "==", "", True),
        (["a"], strings, "==", "", False),
        (["a", None], strings, "!=", "", False),
        ([1.0, None], numbers, "==", 0, True),
        ([1.0], numbers, "==", 0, False),
        ([], numbers, "==", 0, True),
        ([], strings, "==", "x", False),
        (["x", "y"], strings, "==", "x", True),
        (["x", None], strings, "==", "z", False),
        (["x", "y"], strings, "!=", "x", False),
        (["x", "y"], strings, "in", ["y", "q"], True),
        (["x", "y"], strings, "not_in", ["y", "q"], False),
        ([1.0, 9.0], numbers, ">", 5, True),
        ([1.0, 2.0], numbers, ">", 5, False),
        (None, strings, "==", "", True),
        (None, strings, "==", "x", False),
    ]
    columns = [
        compare(Field((F.array(*[F.lit(x) for x in v]) if v is not None else F.lit(None)).cast(t), t), op, th)
        for v, t, op, th, _ in cases
    ]
    row = spark.range(1).select(*[c.alias(f"c{i}") for i, c in enumerate(columns)]).first()
    assert [(c, g) for c, g in zip(cases, row) if g is not c[4]] == []


def test_nan_is_not_above_everything(spark):
    field = Field(F.lit(float("nan")), T.DoubleType())
    row = spark.range(1).select(*[compare(field, op, 5).alias(f"c{i}") for i, op in enumerate((">", ">=", "==", "<"))]).first()
    assert list(row) == [False] * 4


def test_thresholds():
    assert normalise_threshold("3.14") == (True, 3.14)
    assert normalise_threshold(None) == (False, "")
    assert normalise_threshold([None]) == (False, "")
    assert normalise_threshold("foo") == (False, "foo")
    assert math.isinf(normalise_threshold("inf")[1])


def test_unknown_comparator(spark):
    with pytest.raises(ValueError, match="Unknown comparator 'abcd'"):
        compare(Field(F.lit(5), T.IntegerType()), "abcd", 5)


@pytest.mark.parametrize("comparator", COMPARATORS)
def test_never_null(spark, comparator):
    threshold = ["a", 1] if "in" in comparator else "a"
    types = [T.StringType(), T.LongType(), T.DoubleType(), T.BooleanType(), T.ArrayType(T.StringType())]
    columns = [compare(Field(F.lit(None).cast(t), t), comparator, threshold) for t in types]
    row = spark.range(1).select(*[c.alias(f"c{i}") for i, c in enumerate(columns)]).first()
    assert None not in list(row)
