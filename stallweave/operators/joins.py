"""Left joins, key checks and the category hierarchy.

No join carries a broadcast hint.  Spark broadcasts a side only when its measured size is below
``spark.sql.autoBroadcastJoinThreshold``; beyond that the sort-merge join runs and adaptive execution splits
a skewed key on the fact side.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from stallweave.session import materialise


def left_using(left: DataFrame, right: DataFrame, keys: str | Sequence[str]) -> DataFrame:
    """LEFT JOIN … USING, one copy of the key."""
    return left.join(right, keys, "left")


def with_default(left: DataFrame, state: DataFrame, key: str, value: str, default: Column) -> DataFrame:
    """Lookup with a default for keys without an entry."""
    return left.join(state.select(key, value), key, "left").withColumn(value, F.coalesce(F.col(value), default))


def with_category(df: DataFrame, categories: DataFrame, **columns: str) -> DataFrame:
    """Category attributes ``{output: dimension column}`` next to every row."""
    attributes = categories.select("category_id", *[F.col(src).alias(out) for out, src in columns.items()])
    return left_using(df, attributes, "category_id")


def check_fk(child: DataFrame, column: str, parent: DataFrame, key: str, name: str) -> DataFrame:
    """Foreign key values without a parent and the number of rows that use them.

    Counting per value first means one row per value meets the parent, however hot a value is.
    """
    used = child.where(F.col(column).isNotNull()).groupBy(F.col(column).cast("bigint").alias("missing_key")).agg(
        F.count("*").alias("row_count")
    )
    known = parent.select(F.col(key).cast("bigint").alias("missing_key"))
    return used.join(known, "missing_key", "left_anti").select(F.lit(name).alias("relation"), "missing_key", "row_count")


def check_pk(df: DataFrame, key: str | Sequence[str], name: str) -> DataFrame:
    """Key values that occur more than once."""
    keys = [key] if isinstance(key, str) else list(key)
    text = F.concat_ws("|", *[F.col(k).cast("string") for k in keys])
    return (
        df.groupBy(*keys).agg(F.count("*").alias("row_count")).where("row_count > 1")
        .select(F.lit(name).alias("relation"), text.alias("duplicate_key"), "row_count")
    )


def require_unique(df: DataFrame, key: str) -> DataFrame:
    """The same rows, after checking that a join on ``key`` cannot multiply the other side."""
    if not check_pk(df.where(F.col(key).isNotNull()), key, key).isEmpty():
        raise ValueError(f"{key} is not unique: a left join would multiply rows")
    return df


def with_parent(categories: DataFrame) -> DataFrame:
    """Every category with its parent's name and level."""
    parent = categories.select(
        F.col("category_id").alias("parent_category_id"),
        F.col("category_name").alias("parent_name"),
        F.col("category_level").alias("parent_level"),
    )
    return left_using(categories, parent, "parent_category_id")


def ancestors(categories: DataFrame, of: Column | str = "true") -> DataFrame:
    """``(category_id, ancestor_id, distance)`` for every known ancestor of the categories for which ``of`` holds.

    Pointer doubling: every category's ancestor at distance m, met with itself, gives those at 2 m, so a chain of n levels takes
    log2(n) rounds of at most one row a category.  The pairs asked for grow along these: all up to distance m, met with
    the ancestors at m, give those from m + 1 to 2 m.  A category has one parent, hence every pair is made once, and pairs of
    categories that nobody asks for are not made.  Each round is written once, so neither the plan nor a lost executor repeats
    earlier ones.  A category that is its own ancestor is a cycle and an error: no way is longer than there are edges.
    """
    known = categories.select(F.col("category_id").alias("ancestor_id"))
    edges = categories.where("parent_category_id IS NOT NULL").select("category_id", F.col("parent_category_id").alias("ancestor_id"))
    onward = lambda at: at.select(F.col("category_id").alias("ancestor_id"), F.col("ancestor_id").alias("next_id"))
    at = [materialise(edges.join(known, "ancestor_id", "left_semi").select("category_id", "ancestor_id"), "ancestors-at-1")]
    length = at[0].count()
    while True:
        far = 2 ** len(at)
        step = at[-1].join(onward(at[-1]), "ancestor_id").select("category_id", F.col("next_id").alias("ancestor_id"))
        step = materialise(step, f"ancestors-at-{far}")
        some = step.first()
        if some is None:
            break
        if far > length:
            raise ValueError(f"category {some['ancestor_id']} is its own ancestor: cycle")
        at.append(step)
    rounds = [at[0].where(of).withColumn("distance", F.lit(1))]
    for k, step in enumerate(at):
        reach = reduce(DataFrame.unionByName, rounds)
        further = reach.join(onward(step), "ancestor_id").select(
            "category_id", F.col("next_id").alias("ancestor_id"), (F.col("distance") + F.lit(2**k)).alias("distance")
        )
        rounds.append(materialise(further, f"ancestors-{2 ** (k + 1)}"))
    return reduce(DataFrame.unionByName, rounds)


def foreign_keys(child: DataFrame, name: str, columns: dict[str, str]) -> DataFrame:
    """(target, relation, key) for every non-null foreign key of a child, opened from one scan; ``{column: target}``."""
    entry = lambda column, target: F.struct(
        F.lit(target).alias("target"), F.lit(f"{name}.{column}").alias("relation"), F.col(column).cast("bigint").alias("key")
    )
    opened = child.select(F.explode(F.array(*[entry(c, t) for c, t in columns.items()])).alias("fk"))
    return opened.select("fk.*").where("key IS NOT NULL")


def unmatched_keys(used: Sequence[DataFrame], parents: dict[str, DataFrame]) -> DataFrame:
    """(relation, missing_key, row_count) over any number of relationships at once.

    ``used`` comes from ``foreign_keys``; ``parents`` gives each target's keys.  Keys are counted where they are read, so
    one row per task, relation and value moves; children and parents then meet in one aggregate over (target, key), without a
    join, and every table is scanned once.
    """
    counted = reduce(DataFrame.unionByName, used).groupBy("target", "relation", "key").agg(F.count("*").alias("row_count"))
    keys = [
        df.select(F.lit(target).alias("target"), F.lit(None).cast("string").alias("relation"), F.col(df.columns[0]).cast("bigint").alias("key"), F.lit(None).cast("bigint").alias("row_count"))
        .where("key IS NOT NULL")
        for target, df in parents.items()
    ]
    met = reduce(DataFrame.unionByName, [counted, *keys]).groupBy("target", "key").agg(
        F.max(F.col("relation").isNull()).alias("known"), F.collect_set(F.struct("relation", "row_count")).alias("uses")
    )
    lost = met.where("NOT known").select(F.explode("uses").alias("use"), F.col("key").alias("missing_key"))
    return lost.select("use.relation", "missing_key", "use.row_count")
