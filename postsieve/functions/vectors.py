"""Vector arithmetic on ``array<float>`` columns."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def dot(a: Column, b: Column) -> Column:
    products = F.zip_with(a, b, lambda x, y: x.cast("double") * y.cast("double"))
    return F.aggregate(products, F.lit(0.0), lambda total, x: total + x)


def norm(a: Column) -> Column:
    return F.sqrt(F.aggregate(a, F.lit(0.0), lambda total, x: total + x.cast("double") * x.cast("double")))


def cosine(a: Column, b: Column, norm_of_b: Column | None = None) -> Column:
    """Cosine similarity in double precision; 0 when either vector has length zero.

    Pass ``norm_of_b`` when many vectors meet the same ``b``.
    """
    lengths = norm(a) * (norm(b) if norm_of_b is None else norm_of_b)
    return F.when(lengths == 0, F.lit(0.0)).otherwise(dot(a, b) / lengths)
