"""vector arithmetic on ``array<float>`` columns, in double precision."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

#: Similarities equal to this many decimals are ties, broken by id.  Summation order differs between
#: executors and block sizes in the last bits; rounding keeps rankings independent of the partitioning.
SCORE_DIGITS = 9


def dot(a: Column, b: Column) -> Column:
    products = F.zip_with(a, b, lambda x, y: x.cast("double") * y.cast("double"))
    return F.aggregate(products, F.lit(0.0), lambda total, x: total + x)


def norm(a: Column) -> Column:
    squares = F.transform(a, lambda x: x.cast("double") * x.cast("double"))
    return F.sqrt(F.aggregate(squares, F.lit(0.0), lambda total, x: total + x))


def cosine_similarity(a: Column, b: Column) -> Column:
    """1 minus the cosine distance, rounded to ``SCORE_DIGITS``; NaN when either vector has no length."""
    length = norm(a) * norm(b)
    return F.when(length > 0, F.round(dot(a, b) / length, SCORE_DIGITS)).otherwise(F.lit(float("nan")))


def l2_normalise(a: Column) -> Column:
    """Vector of length 1; a zero vector stays as it is."""
    length = norm(a)
    scaled = F.transform(a, lambda x: (x.cast("double") / length).cast("float"))
    return F.when(length > 0, scaled).otherwise(a)
