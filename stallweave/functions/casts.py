"""Tolerant casts with the numeric-text rules of the source SQL dialect.

Text becomes an integer by rounding half away from zero (``'3.7'`` is 4, ``'1e3'`` is 1000); a double rounds
half to even; anything unreadable or out of range is NULL.  Spark's own ``try_cast`` gives NULL for
``'12.0'`` and truncates doubles, hence the detour.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

_INTEGRAL = {"int", "bigint"}
_FRACTIONAL = {"float", "double"}


def text_to_integral(c: Column, target: str) -> Column:
    """Numeric text to ``int``/``bigint``: plain digits directly, other forms by way of a decimal.

    20 integer digits leave room for every BIGINT.
    """
    return F.coalesce(c.try_cast(target), F.round(c.try_cast("decimal(38,18)")).try_cast(target))


def text_to_fractional(c: Column, target: str) -> Column:
    """Numeric text to ``float``/``double``; Java's type suffixes (``'1d'``, ``'2f'``) are not numbers here."""
    suffixed = F.lower(F.right(F.rtrim(c), F.lit(1))).isin("d", "f") & c.rlike(r"[0-9.][dDfF]\s*$")
    return F.when(~suffixed, c.try_cast(target))


def double_to_integral(c: Column, target: str) -> Column:
    return F.rint(c).try_cast(target)


def tolerant(c: Column, source: T.DataType, target: str) -> Column:
    """Cast that yields NULL instead of failing, chosen by the source type."""
    if isinstance(source, T.StringType):
        if target in _INTEGRAL:
            return text_to_integral(c, target)
        if target in _FRACTIONAL:
            return text_to_fractional(c, target)
    elif target in _INTEGRAL and isinstance(source, (T.DoubleType, T.FloatType)):
        return double_to_integral(c, target)
    elif target in _INTEGRAL and isinstance(source, T.DecimalType):
        return F.round(c).try_cast(target)
    return c.try_cast(target)


def text_to(c: Column, target: str) -> Column:
    """Tolerant cast of a text column."""
    return tolerant(c, T.StringType(), target)


def try_cast_cols(df: DataFrame, types: dict[str, str]) -> DataFrame:
    """Cast the named columns in place, bad values to NULL."""
    return df.withColumns({name: tolerant(F.col(name), df.schema[name].dataType, to) for name, to in types.items()})


def int_or_zero(c: Column) -> Column:
    """whole part of a count, 0 for anything unreadable."""
    return F.coalesce(c.try_cast("decimal(38,18)").try_cast("int"), F.lit(0))
