"""Vector expressions on array columns, computed in double."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def dot(a: Column, b: Column) -> Column:
    products = F.zip_with(a, b, lambda x, y: x.cast("double") * y.cast("double"))
    return F.aggregate(products, F.lit(0.0), lambda total, x: total + x)


def l2_normalise(vector: Column) -> Column:
    """Unit-length copy; a zero vector gives NULL elements."""
    # bound as the one element of an array, the length is computed once, not for every element
    length = F.array(F.sqrt(dot(vector, vector)))
    return F.transform(length, lambda n: F.transform(vector, lambda x: F.try_divide(x.cast("double"), n)))[0]
