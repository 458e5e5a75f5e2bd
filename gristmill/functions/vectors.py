"""Column functions on array<double> vectors."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

#: No vector is divided by less.
LEAST_NORM = 1e-8


def rounded(x: Column, digits: int) -> Column:
    """Nearest multiple of 10^-digits of the scaled number, as SQL engines on doubles have it.

    ``F.round`` takes the shortest decimal form instead, so a number that was rounded before and now ends in 5 may go the other way.
    """
    scale = float(10**digits)
    return F.round(x * F.lit(scale)) / F.lit(scale)


def dot(a: Column, b: Column) -> Column:
    return F.aggregate(F.zip_with(a, b, lambda x, y: x.cast("double") * y.cast("double")), F.lit(0.0), lambda s, x: s + x)


def norm(a: Column) -> Column:
    return F.sqrt(dot(a, a))


def normalised(a: Column) -> Column:
    length = F.greatest(norm(a), F.lit(LEAST_NORM))
    return F.transform(a, lambda x: x.cast("double") / length)


def truncated(a: Column, dim: int) -> Column:
    """The first ``dim`` components, scaled to length 1 again."""
    return normalised(F.slice(a, 1, dim))


def distance(a: Column, b: Column) -> Column:
    return F.sqrt(F.aggregate(F.zip_with(a, b, lambda x, y: F.pow(x.cast("double") - y.cast("double"), F.lit(2.0))), F.lit(0.0), lambda s, x: s + x))
