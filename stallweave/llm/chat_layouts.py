"""Chat records of many layouts, told apart by the fingerprints of their field paths, as formatted text with a loss mask.

A record is a JSON text or a VARIANT.  Its nested field paths (``messages[].role``) are listed; those that any layout names are
hashed, and the hash selects the layout.  A layout is data: which fields make which turns.  Records whose paths fit no
layout, or that cannot be read, keep their row without turns, so nothing is lost.

The template marks turns; control strings inside texts are escaped by one more backslash, which reading takes away:

    <turn user>
    text
    </turn>

The loss mask lists where in the formatted text (code points, end exclusive) a model learns.  DataFrame functions only; a
record stays one row from the layout to the formatted text, without a shuffle.
"""

from __future__ import annotations

import hashlib
from itertools import combinations
from typing import NamedTuple

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import VariantType

TURNS = "array<struct<role: string, text: string>>"
#: A backslash after the ``<`` of every control string in a text, before those it already has.
ESCAPE, UNESCAPE = (r"<(\\*)(/?turn)", r"<\\$1$2"), (r"<\\(\\*)(/?turn)", "<$1$2")
#: Characters of a role that would end its mark, and their stand-ins, ``%`` first.
ROLE_MARKS = (("%", "%25"), ("<", "%3C"), (">", "%3E"), ("\n", "%0A"))
HEAD, TAIL = "<turn ", "</turn>\n"
#: Code points of the pieces in which a masked text is looked up, so that no span walks the text from its beginning.
BLOCK = 512


class Say(NamedTuple):
    """One turn: the texts of some fields, absent or null ones left out, joined by an empty line.  ``?`` marks fields a record may lack."""

    role: str
    fields: tuple[str, ...]

    def paths(self) -> list[str]:
        return list(self.fields)

    def turns(self, record: Column) -> Column:
        texts = [F.try_variant_get(record, f"$.{f.rstrip('?')}", "string") for f in self.fields]
        turn = F.struct(F.lit(self.role).alias("role"), F.concat_ws("\n\n", *texts).alias("text"))
        if all(f.endswith("?") for f in self.fields):
            return F.when(F.coalesce(*texts).isNotNull(), F.array(turn)).otherwise(F.array().cast(TURNS))
        return F.array(turn)


class Each(NamedTuple):
    """A turn for each element of a list, in its order or by a field; ``part``: the text is a list of parts with this field."""

    list: str
    role: str
    text: str
    order: str | None = None
    part: str | None = None
    names: tuple[tuple[str, str], ...] = ()

    def paths(self) -> list[str]:
        own = [self.list, *(f"{self.list}[].{f}" for f in (self.role, self.text, self.order) if f)]
        return [*own, f"{self.list}[].{self.text}[].{self.part}"] if self.part else own

    def turns(self, record: Column) -> Column:
        elements = F.try_variant_get(record, f"$.{self.list}", "array<variant>")

        def text(element: Column) -> Column:
            plain = F.try_variant_get(element, f"$.{self.text}", "string")
            if self.part is None:
                return plain
            parts = F.try_variant_get(element, f"$.{self.text}", "array<variant>")
            return F.coalesce(F.array_join(F.transform(parts, lambda p: F.try_variant_get(p, f"$.{self.part}", "string")), ""), plain)

        def turn(element: Column) -> Column:
            role = F.try_variant_get(element, f"$.{self.role}", "string")
            for name, canonical in self.names:
                role = F.when(role == name, canonical).otherwise(role)
            return F.struct(F.coalesce(role, F.lit("")).alias("role"), F.coalesce(text(element), F.lit("")).alias("text"))

        if self.order is None:
            return F.transform(elements, turn)
        placed = F.transform(elements, lambda e, i: F.struct(F.try_variant_get(e, f"$.{self.order}", "long").alias("order"), i.alias("place"), turn(e).alias("turn")))
        return F.transform(F.sort_array(placed), lambda p: p["turn"])


class Layout(NamedTuple):
    """A name and the steps that give its turns, one after the other."""

    name: str
    steps: tuple[Say | Each, ...]

    def fingerprints(self) -> list[str]:
        """One for each choice of the fields a record may lack; a list without elements lacks all below it."""
        paths = [p for s in self.steps for p in s.paths()]
        fixed = [p for p in paths if not p.endswith("?")]
        free = [p.rstrip("?") for p in paths if p.endswith("?")]
        lists = [s.list for s in self.steps if isinstance(s, Each)]
        found = set()
        for k in range(len(free) + 1):
            for chosen in combinations(free, k):
                for j in range(len(lists) + 1):
                    for empty in combinations(lists, j):
                        found.add(fingerprint_of([p for p in (*fixed, *chosen) if not p.startswith(tuple(f"{x}[]" for x in empty))]))
        return sorted(found)

    def turns(self, record: Column) -> Column:
        return F.concat(*[step.turns(record) for step in self.steps]).cast(TURNS)


#: The layouts that records are taken from; names of fields and roles are those of the formats.
LAYOUTS = (
    Layout("turn rows", (Each("rows", "role", "text", order="turn"),)),
    Layout("messages", (Each("messages", "role", "content"),)),
    Layout("messages of parts", (Each("messages", "role", "content", part="text"),)),
    Layout("from and value", (Say("system", ("system?",)), Each("conversations", "from", "value", names=(("human", "user"), ("gpt", "assistant"))))),
    Layout("prompt and completion", (Say("system", ("system?",)), Say("user", ("prompt",)), Say("assistant", ("completion",)))),
    Layout("prompt and response", (Say("system", ("system?",)), Say("user", ("prompt",)), Say("assistant", ("response",)))),
    Layout("instruction", (Say("system", ("system?",)), Say("user", ("instruction", "input?")), Say("assistant", ("output",)))),
    Layout("question", (Say("user", ("context?", "question")), Say("assistant", ("answer",)))),
)


def fingerprint_of(paths: list[str]) -> str:
    """Digest of a set of paths, as ``fingerprint`` gives it."""
    return hashlib.sha256("\n".join(sorted(set(paths))).encode()).hexdigest()


def known_paths(layouts: tuple[Layout, ...]) -> list[str]:
    return sorted({p.rstrip("?") for layout in layouts for step in layout.steps for p in step.paths()})


def field_paths(value: Column, depth: int, prefix: Column | None = None) -> Column:
    """Distinct paths of all fields below a VARIANT, to ``depth`` levels of objects or lists."""
    none = F.array().cast("array<string>")
    if not depth:
        return none
    before = F.lit("") if prefix is None else F.concat(prefix, F.lit("."))
    entries = F.map_entries(F.try_variant_get(value, "$", "map<string,variant>"))
    fields = F.transform(entries, lambda e: F.concat(F.array(F.concat(before, e["key"])), field_paths(e["value"], depth - 1, F.concat(before, e["key"]))))
    elements = F.try_variant_get(value, "$", "array<variant>")
    listed = F.concat(F.lit("") if prefix is None else prefix, F.lit("[]"))
    items = F.transform(elements, lambda e: field_paths(e, depth - 1, listed))
    return F.array_distinct(F.concat(F.coalesce(F.flatten(fields), none), F.coalesce(F.flatten(items), none)))


def fingerprint(paths: Column, known: list[str]) -> Column:
    """Digest of those ``paths`` that a layout names."""
    return F.sha2(F.array_join(F.sort_array(F.array_intersect(paths, F.array(*map(F.lit, known)))), "\n"), 256)


def canonical(records: DataFrame, column: str = "record", layouts: tuple[Layout, ...] = LAYOUTS) -> DataFrame:
    """``records`` with paths, fingerprint, layout and turns (role, text).

    Null, empty or unreadable records and those that fit no layout have null layout and turns.  Fields no layout names change
    nothing; null roles and texts are ''; a text that is itself an object or a list stays as JSON; a list without elements has
    no turns; repeated rows are rows like others.
    """
    record = F.col(column)
    value = record if isinstance(records.schema[column].dataType, VariantType) else F.try_parse_json(record)
    known = known_paths(layouts)
    depth = max(p.count(".") + p.count("[]") + 1 for p in known)
    read = records.withColumn("_record", value)
    listed = read.withColumn("paths", field_paths(F.col("_record"), depth))
    named = listed.withColumn("fingerprint", F.when(F.col("_record").isNotNull(), fingerprint(F.col("paths"), known)))
    name, turns = F.lit(None).cast("string"), F.lit(None).cast(TURNS)
    for layout in layouts:
        fits = F.col("fingerprint").isin(layout.fingerprints())
        name, turns = F.when(fits, layout.name).otherwise(name), F.when(fits, layout.turns(F.col("_record"))).otherwise(turns)
    return named.withColumn("layout", name).withColumn("turns", turns).drop("_record")


def from_turn_rows(rows: DataFrame, key: str = "conv_id", turn: str = "turn", role: str = "role", text: str = "text") -> DataFrame:
    """(key, record): the turns of each conversation as one record, by turn, then role, then text; null roles and texts are ''.

    A conversation is one record and one formatted text by nature, so it must fit a row.  Null keys are one conversation.
    """
    packed = F.struct(F.col(turn).alias("turn"), F.coalesce(role, F.lit("")).alias("role"), F.coalesce(text, F.lit("")).alias("text"))
    return rows.groupBy(key).agg(F.to_variant_object(F.struct(F.sort_array(F.collect_list(packed)).alias("rows"))).alias("record"))


def escaped_role(role: Column) -> Column:
    for mark, stand_in in ROLE_MARKS:
        role = F.replace(role, F.lit(mark), F.lit(stand_in))
    return role


def read_role(role: Column) -> Column:
    for mark, stand_in in reversed(ROLE_MARKS):
        role = F.replace(role, F.lit(stand_in), F.lit(mark))
    return role


def escaped(text: Column) -> Column:
    return F.regexp_replace(text, *ESCAPE)


def unescaped(text: Column) -> Column:
    return F.regexp_replace(text, *UNESCAPE)


def formatted(conversations: DataFrame, loss_roles: tuple[str, ...] = ("assistant",)) -> DataFrame:
    """``conversations`` (turns) with formatted and loss (array of start and end in code points); null turns give nulls."""
    pieces = F.transform(
        "turns",
        lambda t: F.struct(
            F.concat(F.lit(HEAD), escaped_role(t["role"]), F.lit(">\n")).alias("head"),
            escaped(t["text"]).alias("body"),
            t["role"].isin(*loss_roles).alias("loss"),
        ),
    )
    start = F.struct(F.lit(0).alias("at"), F.array().cast("array<struct<start: int, end: int>>").alias("spans"))

    def step(state: Column, piece: Column) -> Column:
        begin = state["at"] + F.length(piece["head"])
        end = begin + F.length(piece["body"])
        span = F.struct(begin.alias("start"), end.alias("end"))
        return F.struct((end + F.lit(1 + len(TAIL))).alias("at"), F.when(piece["loss"], F.concat(state["spans"], F.array(span))).otherwise(state["spans"]).alias("spans"))

    cut = conversations.withColumn("_pieces", pieces)
    whole = F.array_join(F.transform("_pieces", lambda p: F.concat(p["head"], p["body"], F.lit("\n" + TAIL))), "")
    return cut.withColumn("formatted", whole).withColumn("loss", F.aggregate("_pieces", start, step, lambda s: s["spans"])).drop("_pieces")


def parsed(text: Column) -> Column:
    """The turns of a formatted text."""
    parts = F.split(text, TAIL, -1)

    def turn(part: Column) -> Column:
        head = F.substring_index(part, ">\n", 1)
        body = F.substr(part, F.length(head) + 3, F.length(part) - F.length(head) - 3)
        return F.struct(read_role(F.substr(head, F.lit(len(HEAD) + 1))).alias("role"), unescaped(body).alias("text"))

    return F.transform(F.slice(parts, F.lit(1), F.size(parts) - 1), turn)


def masked(text: Column, spans: Column) -> Column:
    """The texts under the mask, unescaped, one for each span."""
    blocks = F.regexp_extract_all(text, F.lit(f"(?s).{{1,{BLOCK}}}"), F.lit(0))

    def part(blocks: Column, span: Column) -> Column:
        first = F.floor(span["start"] / BLOCK).cast("int")
        some = F.array_join(F.slice(blocks, first + 1, F.floor((span["end"] - 1) / BLOCK).cast("int") - first + 1), "")
        return F.when(span["end"] > span["start"], unescaped(F.substr(some, span["start"] - first * BLOCK + 1, span["end"] - span["start"]))).otherwise("")

    # The blocks are made once: they are the one element of a list.
    return F.flatten(F.transform(F.array(blocks), lambda b: F.transform(spans, lambda s: part(b, s))))


def read_back(conversations: DataFrame) -> DataFrame:
    """``conversations`` (formatted, loss) with read_turns and read_loss (the learned texts), from the formatted text alone."""
    return conversations.withColumn("read_turns", parsed(F.col("formatted"))).withColumn("read_loss", masked(F.col("formatted"), F.col("loss")))
