"""Benchmark decontamination by templates.

Texts become sequences of canonical words: numbers, units after numbers and names turn into typed placeholders, other words
are lower-cased.  Windows of ``width`` canonical words of every benchmark item are hash-joined with those of every document.
What is a name depends on case and punctuation, so windows of case-folded words, with numbers and units as the only
placeholders, are joined as well and judged by themselves; they find copies in other case or without punctuation.
A document holds an item if one place in it covers enough of the item's windows, or a long stretch of them in order, and if
the placeholders agree there: wherever the item repeats a value, the document must repeat the value it has put there.

Documents send only windows that a bit table of the items' windows may contain; its size is fixed, whatever the
benchmark, and the join that follows is exact in any case.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from stallweave.llm.shingles import _BYTE, _STEP, chained, mixed
from stallweave.llm.tables import drop_path, sliced, stored

# Units of measure that may follow a number.
UNITS = (
    "mm cm m km in ft yd mi inch inches foot feet yard yards mile miles meter meters metre metres kilometer kilometers kilometre kilometres g kg mg lb lbs oz gram grams "
    "kilogram kilograms pound pounds ounce ounces ton tons l ml cl liter liters litre litres gallon gallons s sec second seconds min minute minutes h hr hrs hour hours day "
    "days week weeks month months year years usd eur gbp dollar dollars euro euros cent cents percent degree degrees mph kmh kph hz khz mhz ghz kb mb gb tb w kw v a"
).split()
NUMBER, UNIT, NAME = (np.uint64(k) for k in (11, 12, 13))
#: Keeps the windows of case-folded words apart from the others.
FOLDED = np.uint64(0x9E3779B97F4A7C15)


def _class(points: str | list[int]) -> np.ndarray:
    table = np.zeros(256, bool)
    table[[ord(c) if isinstance(c, str) else c for c in points]] = True
    return table


_DIGIT, _UPPER, _LOWER = _class("0123456789"), _class("ABCDEFGHIJKLMNOPQRSTUVWXYZ"), _class("abcdefghijklmnopqrstuvwxyz")
_HIGH = _class(list(range(128, 256)))
_JOINER, _ENDER = _class(".,"), _class(".!?:;\n\"")
#: Second bytes of the capitals from À to Þ after 0xC3; × is none.
_LATIN_CAPITAL = _class([b for b in range(0x80, 0x9F) if b != 0x97])


def _unit_hashes() -> np.ndarray:
    out = []
    for unit in UNITS:
        data = np.frombuffer(unit.encode(), np.uint8)
        powers = np.cumprod(np.full(len(data), _STEP, np.uint64))
        out.append((_BYTE[data] * powers).sum(dtype=np.uint64) + np.uint64(len(data)))
    return mixed(np.array(out, np.uint64))


_UNITS = _unit_hashes()


class Words:
    """Canonical words of many texts: ``code`` of each, its text's number, its place in the bytes, whether it is a slot."""

    def __init__(self, texts: list[str | None]):
        coded = [t.encode("utf-8", "surrogatepass") if t else b"" for t in texts]
        self.data = b"\n".join(coded) + b"\n"
        data = np.frombuffer(self.data, np.uint8)
        digit = _DIGIT[data]
        near = digit[:-2] & digit[2:] & _JOINER[data[1:-1]]
        inside = digit | _UPPER[data] | _LOWER[data] | _HIGH[data]
        inside[1:-1] |= near
        at = np.flatnonzero(inside)
        begins = np.r_[0, np.cumsum(np.fromiter(map(len, coded), np.int64, len(coded)) + 1)]
        if not len(at):
            self.starts = self.ends = np.empty(0, np.int64)
            self.code, self.slot, self.begins = np.empty(0, np.uint64), np.empty(0, bool), np.zeros(len(coded) + 1, np.int64)
            return
        first = np.flatnonzero(np.r_[True, at[1:] != at[:-1] + 1])
        self.starts = at[first]
        lengths = np.diff(np.r_[first, len(at)])
        self.ends = self.starts + lengths
        self.begins = np.searchsorted(self.starts, begins)
        low = data.copy()
        low[_UPPER[data]] += 32
        capital = np.zeros(len(data), bool)
        capital[1:] = (data[:-1] == 0xC3) & _LATIN_CAPITAL[data[1:]]
        low[capital] += 32
        place = np.arange(len(at)) - np.repeat(first, lengths)
        powers = np.cumprod(np.full(int(lengths.max()), _STEP, np.uint64))
        word = mixed(np.add.reduceat(_BYTE[low[at]] * powers[place], first) + lengths.astype(np.uint64))
        number = np.logical_or.reduceat(digit[at], first)
        raised = _UPPER[data] | capital
        leads = raised[self.starts] | ((data[self.starts] == 0xC3) & raised[np.minimum(self.starts + 1, len(data) - 1)])
        shouted = ~np.logical_or.reduceat(_LOWER[data[at]], first) & (lengths > 1)
        enders = np.cumsum(_ENDER[data])
        opens = np.r_[True, enders[self.starts[1:] - 1] > enders[self.ends[:-1] - 1]]
        opens[self.begins[:-1][self.begins[:-1] < len(opens)]] = True
        name = leads & ~shouted & ~opens & ~number
        unit = np.r_[False, number[:-1]] & np.isin(word, _UNITS) & ~number
        self.slot = number | name | unit
        self.code = np.where(number, NUMBER, np.where(unit, UNIT, np.where(name, NAME, word)))

    def value(self, i: int) -> str:
        return self.data[self.starts[i] : self.ends[i]].decode("utf-8", "replace")

    def windows(self, width: int, plain: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(hash, text's number, first word) of every window within one text that has ``plain`` words which are no slots."""
        n = len(self.code) - width + 1
        if n <= 0:
            return np.empty(0, np.uint64), np.empty(0, np.int64), np.empty(0, np.int64)
        owner = np.repeat(np.arange(len(self.begins) - 1), np.diff(self.begins))
        known = np.r_[0, np.cumsum(~self.slot)]
        good = np.flatnonzero((owner[:n] == owner[width - 1 :]) & (known[width:] - known[:n] >= plain))
        return chained(self.code, width)[good], owner[good], good


WINDOWS = "folded boolean, place long, hash long, slots array<string>"


def template_windows(rows: DataFrame, key: str, width: int, plain: int, bits: np.ndarray | None = None) -> DataFrame:
    """(key, folded, place, hash, slots) of the windows of ``rows`` (key, text); with ``bits`` only those it may contain.

    Every text gives the windows of its words as they are and, ``folded``, those of its case-folded words, which hold no names.
    ``slots`` has an entry for each word of the window: its text where a placeholder stands, else null.
    """
    shared = rows.sparkSession.sparkContext.broadcast(bits) if bits is not None else None

    def work(batch: pa.RecordBatch) -> pa.RecordBatch:
        texts = batch.column(1).to_pylist()
        parts = []
        for folded in (False, True):
            words = Words([t.casefold() if t else t for t in texts] if folded else texts)
            h, owner, first = words.windows(width, plain)
            if folded:
                h = h ^ FOLDED
            if shared is not None:
                table = shared.value
                spot = (h & np.uint64(8 * len(table) - 1)).astype(np.int64)
                hit = (table[spot >> 3] >> (spot & 7).astype(np.uint8)) & 1 != 0
                h, owner, first = h[hit], owner[hit], first[hit]
            slots = [[words.value(i) if words.slot[i] else None for i in range(f, f + width)] for f in first]
            parts.append(pa.RecordBatch.from_arrays(
                [batch.column(0).take(pa.array(owner, pa.int64())), pa.array(np.full(len(h), folded)), pa.array(first - words.begins[owner]), pa.array(h.view(np.int64)), pa.array(slots, pa.list_(pa.string()))],
                [key, "folded", "place", "hash", "slots"],
            ))
        return pa.concat_batches(parts)

    kind = rows.schema[key].dataType.simpleString()
    return rows.select(key, "text").where(F.col(key).isNotNull() & F.col("text").isNotNull()).mapInArrow(sliced(work, 2 << 20), f"{key} {kind}, {WINDOWS}")


def bit_table(windows: DataFrame, size: int) -> np.ndarray:
    """Bits (2**size) set at the hashes of ``windows``; packed in Spark, so that the driver gets blocks of bits only."""
    spots = windows.select(F.col("hash").bitwiseAND(F.lit((1 << size) - 1)).alias("spot"))
    rows = spots.groupBy(F.shiftright("spot", 6).alias("word")).agg(F.bit_or(F.expr("shiftleft(1L, CAST(spot % 64 AS INT))")).alias("bits")).toArrow()
    table = np.zeros(1 << (size - 6), np.int64)
    table[np.asarray(rows["word"])] = np.asarray(rows["bits"])
    return table.astype("<i8").view(np.uint8)


def _holds(had: str, longest: str, width: int, cover: float, stretch: int) -> Column:
    return (F.col(had) / F.col("size") >= cover) | (F.col(longest) + width - 1 >= stretch)


def _occurrences(width: int) -> Column:
    """Where an item may stand to which a pair of windows (shift, run, half) belongs: array of (kind, number).

    The windows of one shift (0); those of shifts within an item's length, in bands that overlap by half (1), which follow
    insertions and deletions and take no two copies; all lines of ``width`` windows and more (2), for items in pieces.
    """
    band = F.floor(F.col("shift") / F.col("half"))
    make = lambda kind, number: F.struct(F.lit(kind).alias("kind"), number.cast("long").alias("number"))
    return F.array(make(0, F.col("shift")), make(1, band), make(1, band - 1), F.when(F.col("run") >= width, make(2, F.lit(0))))


def leaks(docs: DataFrame, benchmark: DataFrame, width: int = 5, plain: int = 2, cover: float = 0.8, stretch: int = 13, agree: float = 0.8, bits: int = 22) -> DataFrame:
    """doc_id, item_id, coverage, stretch, agreement of every document (doc_id, text) that holds an item (item_id, text).

    All three are those of one occurrence, the best that counts.  ``coverage``: share of the item's windows that stand there;
    ``stretch``: most words in the item's order without shift; ``agreement``: share of slots whose value is the usual one for
    the item's value.  A pair counts if an occurrence has ``coverage >= cover`` or ``stretch >= stretch``, and
    ``agreement >= agree``; other copies of the item and stray windows elsewhere do not count against it.  Items of fewer than ``width`` words, or with
    fewer than ``plain`` ordinary words in every window, are not searched.  Null texts and keys match nothing; repeated rows
    of a document or an item count once; empty tables give an empty result; other columns are ignored.
    """
    items, items_path = stored(template_windows(benchmark, "item_id", width, plain).dropDuplicates(["item_id", "folded", "place", "hash"]), "item-windows")
    sizes = items.groupBy("item_id", "folded").agg(F.countDistinct("hash").alias("size"), F.greatest(F.lit(1), F.floor((F.max("place") + width) / 2)).alias("half"))
    hits, hits_path = stored(template_windows(docs, "doc_id", width, plain, bit_table(items, bits)).dropDuplicates(["doc_id", "folded", "place", "hash"]), "leak-hits")
    pair = ["doc_id", "item_id", "folded"]
    found = hits.join(items.select("item_id", "folded", "hash", F.col("place").alias("at"), F.col("slots").alias("wanted")), ["folded", "hash"])
    pairs, pairs_path = stored(found.select(*pair, "place", "at", (F.col("place") - F.col("at")).alias("shift"), "hash", "slots", "wanted"), "leak-pairs")
    line = [*pair, "shift"]
    lines, lines_path = stored(pairs.groupBy(*line).agg(F.countDistinct("at").alias("run")), "leak-lines")
    # A whole document covers no less of an item than any of its occurrences, so this rules out most pairs at once.
    covers = pairs.groupBy(*pair).agg(F.countDistinct("hash").alias("had"))
    longest = lines.groupBy(*pair).agg(F.max("run").alias("longest"))
    likely = covers.join(longest, pair).join(sizes, ["item_id", "folded"]).where(_holds("had", "longest", width, cover, stretch)).select(*pair, "size", "half")
    placed = pairs.join(lines.join(likely, pair), line).withColumn("occurrence", F.explode(_occurrences(width)))
    placed, placed_path = stored(placed.where("occurrence IS NOT NULL"), "leak-occurrences")
    place = [*pair, "occurrence"]
    held = placed.groupBy(*place).agg(F.countDistinct("hash").alias("had"), F.max("run").alias("longest"), F.first("size").alias("size")).where(_holds("had", "longest", width, cover, stretch))
    held = held.select(*place, (F.col("had") / F.col("size")).alias("coverage"), (F.col("longest") + width - 1).alias("stretch"))
    slots = (
        placed.join(held.select(*place), place, "left_semi")
        .select(*place, F.explode(F.arrays_zip("wanted", "slots")).alias("slot"))
        .where("slot.wanted IS NOT NULL")
        .groupBy(*place, F.lower("slot.wanted").alias("wanted"), F.lower("slot.slots").alias("got"))
        .agg(F.count("*").alias("n"))
        .groupBy(*place, "wanted")
        .agg(F.max("n").alias("usual"), F.sum("n").alias("n"))
        .groupBy(*place)
        .agg((F.sum("usual") / F.sum("n")).alias("agreement"))
    )
    out = held.join(slots, place, "left").withColumn("agreement", F.coalesce("agreement", F.lit(1.0))).where(F.col("agreement") >= agree)
    best = F.max(F.struct("coverage", "stretch", "agreement")).alias("best")
    out = out.groupBy("doc_id", "item_id").agg(best).select("doc_id", "item_id", "best.*")
    result, _ = stored(out.select("doc_id", "item_id", "coverage", "stretch", "agreement"), "leaks")
    for path in (items_path, hits_path, pairs_path, lines_path, placed_path):
        drop_path(docs.sparkSession, path)
    return result


def without_leaks(docs: DataFrame, benchmark: DataFrame, **options) -> DataFrame:
    """The rows of ``docs``, unchanged, that hold no item of ``benchmark``."""
    return docs.join(leaks(docs, benchmark, **options).select("doc_id").distinct(), "doc_id", "left_anti").select(*docs.columns)
