"""Column functions over array vectors, in double precision."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def as_double(vector: Column) -> Column:
    return vector.cast("array<double>")


def inner_product(a: Column, b: Column) -> Column:
    return F.aggregate(F.zip_with(as_double(a), as_double(b), lambda x, y: x * y), F.lit(0.0), lambda s, x: s + x)


def l2_normalize(vector: Column) -> Column:
    """The vector over its length; a zero vector is an error."""
    norm = F.sqrt(inner_product(vector, vector))
    return F.when(norm == 0, F.raise_error(F.lit("zero vector")).cast("array<double>")).otherwise(F.transform(as_double(vector), lambda x: x / norm))


def fused_score(score: Column, evidence: Column, weight: float) -> Column:
    """score + weight * min(evidence, 10)."""
    if weight < 0:
        raise ValueError("the graph weight must not be negative")
    return score + F.lit(float(weight)) * F.least(F.coalesce(evidence.cast("double"), F.lit(0.0)), F.lit(10.0))
