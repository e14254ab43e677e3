"""Reading and writing JSON held in text columns."""

from __future__ import annotations

import re

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Text forms that count as "absent" when the first usable key of a node is chosen.
FALSY_TEXT = ("", "0", "0.0", "false", "null", "[]", "{}")
_FALSY = r"\A(?:" + "|".join(re.escape(text) for text in FALSY_TEXT) + r")\z"


#: JSON tokens of the values that count as absent.
_EMPTY_TOKEN = r"\A(?:null|false|\"\"|\[\]|\{\}|-?0+(?:\.0+)?(?:[eE][-+]?[0-9]+)?)\z"


def json_text(c: Column, path: str) -> Column:
    """scalar (or nested JSON text) at ``path``; NULL when missing, JSON null or malformed."""
    return F.get_json_object(c, path)


def is_json(c: Column) -> Column:
    """Whether the whole text is one JSON document; path reads are lenient and would not tell."""
    return F.try_parse_json(c).isNotNull()


def json_items(c: Column) -> Column:
    """elements of a JSON array as text; NULL unless the value is an array."""
    return F.when(F.ltrim(c).startswith("["), F.from_json(c, "array<string>"))


def has_items(c: Column) -> Column:
    """Text of a JSON array that is not literally empty."""
    return c.isNotNull() & (c != "[]")


def explode_items(df: DataFrame, column: str, alias: str) -> DataFrame:
    """one row per array element; rows without an array vanish, as with an inner unnest."""
    kept = [F.col(name) for name in df.columns if name != column]
    return df.select(*kept, F.explode(json_items(F.col(column))).alias(alias))


def explode_variant(df: DataFrame, column: str, alias: str) -> DataFrame:
    """one row per element of a JSON array, as a VARIANT; the document is parsed once.

    Documents that are no array, or cannot be read, give no rows, as with an inner unnest.
    """
    kept = [c for c in df.columns if c != column]
    parsed = df.select(*kept, F.try_parse_json(F.col(column)).alias("_document"))
    elements = parsed.lateralJoin(df.sparkSession.tvf.variant_explode(F.col("_document").outer()))
    return elements.where("key IS NULL").select(*kept, F.col("value").alias(alias))


def member(element: Column, path: str, target: str = "string") -> Column:
    """a member of a VARIANT as text or another type; NULL where it is absent or of no such type."""
    return F.try_variant_get(element, f"$.{path}", target)


def truthy(c: Column) -> Column:
    """The value unless it is NULL or one of the empty forms."""
    return F.when(~c.rlike(_FALSY), c)


def first_truthy(*columns: Column) -> Column:
    """First usable value among alternatives, all read as text."""
    return F.coalesce(*[truthy(c.cast("string")) for c in columns])


def usable_member(document: Column, text: Column, key: str) -> Column:
    """The text of a member unless its JSON value is null, false, zero or empty.

    The type decides: the texts ``"0"`` and ``"false"`` are values like any other.
    """
    token = F.to_json(F.try_variant_get(document, f"$.{key}", "variant"))
    return F.when(~token.rlike(_EMPTY_TOKEN), text)


def nested_to_text(df: DataFrame) -> DataFrame:
    """struct, array and map columns as JSON text, null members kept, text kept as UTF-8."""
    nested = {
        field.name: F.to_json(F.col(field.name), {"ignoreNullFields": "false"})
        for field in df.schema.fields
        if field.dataType.typeName() in ("struct", "array", "map")
    }
    return df.withColumns(nested) if nested else df
