"""Typed columns and the path selector.

A ``Field`` pairs a Spark ``Column`` with its data type.  Knowing the type while the plan is
being built lets a path such as ``embed.images[*].alt`` become plain struct and array accessors
(which Catalyst prunes down to the Parquet scan) when the column is typed, and variant accessors
when it is not.
"""

from __future__ import annotations

import re
from dataclasses import dataclass

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

WILDCARD = "*"
_STEP = re.compile(r"\[([^\]]*)\]|([^.\[\]]+)")


@dataclass(frozen=True)
class Field:
    col: Column
    dtype: T.DataType

    @property
    def is_missing(self) -> bool:
        """True when the schema already tells that the value can never be there."""
        return isinstance(self.dtype, T.NullType)

    def child(self, name: str) -> Field:
        if isinstance(self.dtype, T.StructType):
            if name in self.dtype.fieldNames():
                return Field(self.col.getField(name), self.dtype[name].dataType)
        elif isinstance(self.dtype, T.MapType) and isinstance(self.dtype.keyType, T.StringType):
            return Field(F.try_element_at(self.col, F.lit(name)), self.dtype.valueType)
        elif isinstance(self.dtype, T.VariantType):
            return self._variant_step(_variant_key(name))
        return missing()

    def item(self, index: int) -> Field:
        if isinstance(self.dtype, T.ArrayType):
            return Field(F.get(self.col, F.lit(index)), self.dtype.elementType)
        if isinstance(self.dtype, T.VariantType):
            return self._variant_step(f"[{index}]")
        return missing()

    def _variant_step(self, suffix: str) -> Field:
        return Field(F.try_variant_get(self.col, f"${suffix}", "variant"), T.VariantType())

    def elements(self) -> Field:
        """The values a wildcard visits, as a never-null array."""
        if isinstance(self.dtype, T.ArrayType):
            return Field(F.coalesce(self.col, _empty(self.dtype.elementType)), self.dtype)
        if isinstance(self.dtype, T.MapType):
            item = self.dtype.valueType
            return Field(F.coalesce(F.map_values(self.col), _empty(item)), T.ArrayType(item))
        if isinstance(self.dtype, T.StructType):
            return Field(F.to_variant_object(self.col), T.VariantType()).elements()
        if isinstance(self.dtype, T.VariantType):
            as_array = F.try_variant_get(self.col, "$", "array<variant>")
            as_object = F.map_values(F.try_variant_get(self.col, "$", "map<string,variant>"))
            return Field(
                F.coalesce(as_array, as_object, _empty(T.VariantType())),
                T.ArrayType(T.VariantType()),
            )
        return Field(_empty(T.StringType()), T.ArrayType(T.StringType()))


def missing() -> Field:
    return Field(F.lit(None), T.NullType())


def field(schema: T.StructType, name: str) -> Field:
    """The top-level column ``name``, or a missing field when the schema lacks it."""
    return Field(F.col(f"`{name}`"), schema[name].dataType) if name in schema.fieldNames() else missing()


def split_path(path: str) -> list[str]:
    """``a.b[0].*`` -> ``["a", "b", "0", "*"]``."""
    return [bracket or plain for bracket, plain in _STEP.findall(path) if bracket or plain]


def has_wildcard(path: str) -> bool:
    return WILDCARD in path


def resolve(root: Field, path: str) -> Field:
    """Resolve ``path`` below ``root``.

    Without a wildcard the result has the type found there.  With one it is an array holding every
    value reached (never null, empty when nothing was).  Paths which do not exist give NULL.
    """
    return _walk(root, split_path(path))


def _walk(at: Field, steps: list[str]) -> Field:
    if not steps:
        return at
    if WILDCARD in steps:
        cut = steps.index(WILDCARD)
        return _walk_each(_walk(at, steps[:cut]).elements(), steps[cut + 1 :])
    if isinstance(at.dtype, T.VariantType):
        whole = "".join(f"[{s}]" if s.isdigit() else _variant_key(s) for s in steps)
        return at._variant_step(whole)
    step = steps[0]
    return _walk(at.item(int(step)) if step.isdigit() else at.child(step), steps[1:])


def _walk_each(array: Field, rest: list[str]) -> Field:
    element = array.dtype.elementType
    reached = _walk(Field(F.lit(None), element), rest).dtype if rest else element
    if isinstance(reached, T.NullType):
        return Field(_empty(T.StringType()), T.ArrayType(T.StringType()))
    values = array.col
    if rest:
        values = F.transform(values, lambda x: _walk(Field(x, element), rest).col)
        if WILDCARD in rest:
            return Field(F.flatten(values), reached)
    return Field(F.filter(values, lambda x: x.isNotNull()), T.ArrayType(reached))


def _variant_key(name: str) -> str:
    return f'["{name}"]' if "'" in name else f"['{name}']"


def _empty(element: T.DataType) -> Column:
    if isinstance(element, T.VariantType):
        # An empty array literal cannot be cast to variants; cut one down instead.
        return F.slice(F.array(F.parse_json(F.lit("null"))), 1, 0)
    return F.array().cast(T.ArrayType(element))
