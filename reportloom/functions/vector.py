"""Vector expressions on ``array<float>`` columns, computed in double."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def is_finite(vector: Column) -> Column:
    """Whether the vector is present and has no null, NaN or infinite component."""
    ok = F.forall(
        vector,
        lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < F.lit(float("inf"))),
    )
    return F.coalesce(ok, F.lit(False))


def distance(a: Column, b: Column) -> Column:
    """Euclidean distance."""

    def squared(x: Column, y: Column) -> Column:
        diff = x.cast("double") - y.cast("double")
        return diff * diff

    return F.sqrt(F.aggregate(F.zip_with(a, b, squared), F.lit(0.0), lambda s, x: s + x))


def unit(vector: Column) -> Column:
    """The vector divided by its length; a zero vector stays zero."""
    norm = F.sqrt(F.aggregate(vector, F.lit(0.0), lambda s, x: s + x * x))
    return F.when(norm > 0, F.transform(vector, lambda x: x / norm)).otherwise(vector)
