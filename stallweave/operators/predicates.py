"""Projections and predicates."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Fixed value: upper end of the price slider, which means "no upper limit".
PRICE_CEILING = 2_000_000


def select_as(df: DataFrame, mapping: Mapping[str, str | Column]) -> DataFrame:
    """Select and rename, ``{output: input}``."""
    return df.select(*[(F.col(c) if isinstance(c, str) else c).alias(name) for name, c in mapping.items()])


def with_exprs(df: DataFrame, **exprs: Column) -> DataFrame:
    """All columns plus computed ones."""
    return df.select("*", *[c.alias(name) for name, c in exprs.items()])


def require_key(df: DataFrame, key: str) -> DataFrame:
    """Rows whose raw key is present."""
    return df.where(F.col(key).isNotNull())


def leaves(df: DataFrame, key: str = "category_id") -> DataFrame:
    """Leaf rows with a key."""
    return df.where(F.col("is_leaf") & F.col(key).isNotNull())


def min_support(df: DataFrame, support: str, least: int, *present: str) -> DataFrame:
    """Enough observations, and the named measures known."""
    return df.where(reduce(lambda a, b: a & b, [F.col(c).isNotNull() for c in present], F.col(support) >= least))


def ilike_contains(c: Column, keyword: str | Column) -> Column:
    """Case-insensitive contains; ``%`` and ``_`` typed by the user stay wildcards."""
    if isinstance(keyword, Column):
        return F.call_function("ilike", c, F.concat(F.lit("%"), keyword, F.lit("%")))
    return c.ilike(f"%{keyword}%")


def build_filter(
    min_price: float | None = None,
    max_price: float | None = None,
    min_rating: float | None = None,
    category_keyword: str | None = None,
) -> Column:
    """Conjunction of the filters that are set."""
    parts = [F.lit(True)]
    if min_price is not None:
        parts.append(F.col("price") >= min_price)
    if max_price is not None:
        parts.append(F.col("price") <= max_price)
    if min_rating is not None:
        parts.append(F.col("rating_average") >= min_rating)
    if category_keyword:
        parts.append(ilike_contains(F.col("category_name"), category_keyword))
    return reduce(lambda a, b: a & b, parts)


def normalise_filters(requests: DataFrame) -> DataFrame:
    """P10: slider end positions and blank keywords mean "no filter"."""
    return requests.withColumns(
        {
            "min_price": F.when(F.col("min_price") > 0, F.col("min_price")),
            "max_price": F.when(F.col("max_price") < PRICE_CEILING, F.col("max_price")),
            "min_rating": F.when(F.col("min_rating") > 0, F.col("min_rating")),
            "category_keyword": F.nullif(F.trim("category_keyword"), F.lit("")),
        }
    )


def override_ids(leaf_ids: DataFrame, ids: Sequence[int], key: str = "category_id") -> DataFrame:
    """Exactly the ids named for this run, instead of the rotation."""
    wanted = leaf_ids.sparkSession.createDataFrame([(i,) for i in ids], f"{key} BIGINT")
    return leaf_ids.join(wanted, key, "left_semi")


def any_identity(df: DataFrame, *columns: str) -> DataFrame:
    """Rows with at least one of the identifying columns."""
    return df.where(reduce(lambda a, b: a | b, [F.col(c).isNotNull() for c in columns]))
