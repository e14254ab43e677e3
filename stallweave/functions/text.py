"""Text shaping."""

from __future__ import annotations

import re

from pyspark.sql import Column
from pyspark.sql import functions as F

#: Patterns of the landing layout and of category links.
CATEGORY_LINK = r"/c(\d+)(?:[/?#]|$)"
PARTITION_PATH = r"/dt=([^/]+)/run_id=([^/]+)/"
CSV_DIGITS = r"^\s*\d+(\s*,\s*\d+)*\s*$"
PATH_SEPARATOR = " > "
LABEL_WIDTH = 45


def root_segment(path: Column, sep: str = PATH_SEPARATOR) -> Column:
    """first segment of a path; the whole path when ``sep`` does not occur."""
    return F.split_part(path, F.lit(sep), F.lit(1))


def review_text(title: Column, content: Column) -> Column:
    """``title — content`` with NULL as empty."""
    return F.concat(F.coalesce(title, F.lit("")), F.lit(" — "), F.coalesce(content, F.lit("")))


def clip(c: Column, width: int) -> Column:
    """F8: first ``width`` code points."""
    return F.substring(c, 1, width)


def non_blank(c: Column) -> Column:
    """Text with at least one character."""
    return c.isNotNull() & (F.length(c) > 0)


def short_label(c: Column, width: int = LABEL_WIDTH) -> Column:
    """the text, or its first ``width`` characters and an ellipsis."""
    return F.when(F.length(c) > width, F.concat(clip(c, width), F.lit("..."))).otherwise(c)


def link_category_id(link: Column) -> Column:
    """numeric id at the end of a category link, NULL without a match."""
    return F.nullif(F.regexp_extract(link, CATEGORY_LINK, 1), F.lit("")).try_cast("bigint")


def child_path(parent: Column, name: Column) -> Column:
    """path of a node below ``parent``; nameless nodes keep the parent's path, empty is NULL."""
    return F.nullif(F.concat_ws(PATH_SEPARATOR, parent, name), F.lit(""))


def content_hash(c: Column) -> Column:
    """SHA-256 of the UTF-8 text as lower-case hex."""
    return F.sha2(c, 256)


def grouped_number(c: Column, digits: int) -> Column:
    """thousands separators and a fixed number of decimals, half-even on the binary value."""
    return F.format_number(c.cast("double"), digits)


def form_encode(c: Column) -> Column:
    """Form encoding as in ``urllib.parse.quote_plus`` (``~`` stays, ``*`` is escaped)."""
    return F.replace(F.replace(F.url_encode(c), F.lit("*"), F.lit("%2A")), F.lit("%7E"), F.lit("~"))


def request_key(url: Column, params: Column) -> Column:
    """url, ``?`` and the encoded parameters sorted by name; the bare url without parameters."""
    pairs = F.transform(
        F.array_sort(F.map_entries(params)),
        lambda e: F.concat(form_encode(e["key"]), F.lit("="), form_encode(e["value"])),
    )
    return F.when(F.coalesce(F.size(params), F.lit(0)) <= 0, url).otherwise(
        F.concat(url, F.lit("?"), F.array_join(pairs, "&"))
    )


def named_request_key(url: Column, params: dict[str, str | Column]) -> Column:
    """F15 where the names are known beforehand: the same text as ``request_key``, with no map, sort or lambda per row.

    Parameters that are NULL are left out, as there; constant values are encoded like others.
    """
    if not params:
        return url
    # Spark compares texts by their bytes.
    names = sorted(params, key=lambda name: name.encode())
    pairs = [F.concat(form_encode(F.lit(n)), F.lit("="), form_encode(F.lit(params[n]) if isinstance(params[n], str) else params[n])) for n in names]
    return F.concat(url, F.lit("?"), F.concat_ws("&", *pairs))


def csv_ids(c: Column) -> Column:
    """F16: array of ids from ``'8322, 316'``; NULL when the text is not a list of digits."""
    return F.when(
        c.rlike(CSV_DIGITS), F.transform(F.split(c, ","), lambda part: F.trim(part).try_cast("bigint"))
    )


def parse_csv_ids(text: str) -> list[int]:
    """F16 for a job parameter: fail before any work is planned."""
    if not re.match(CSV_DIGITS, text):
        raise ValueError(f"expected comma-separated digits, got {text!r}")
    return [int(part) for part in text.split(",")]


def partition_value(path: Column, which: str) -> Column:
    """``dt`` or ``run_id`` from a file path, NULL when the path has neither."""
    group = {"dt": 1, "run_id": 2}[which]
    return F.nullif(F.regexp_extract(path, PARTITION_PATH, group), F.lit(""))


def archive_path(path: Column, entity: str) -> Column:
    """path of a live file after archiving."""
    return F.regexp_replace(path, rf"/{re.escape(entity)}/(?!_processed/)", f"/{entity}/_processed/")
