"""Language ID by bit-sliced Bloom filters over character n-grams.

One array of bit masks holds a Bloom filter of every language at once: bit i of a slot belongs to language i, and the AND
of an n-gram's slots is the set of languages that may contain it.  A text's bits are counted per language, corrected for
the rate at which that language's filter says yes by chance, and the largest corrected count wins.

An n-gram is entered for a language that uses it at least ``share`` times as often as the language that uses it most.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from stallweave.llm.tables import crc_of, drop_path, per_worker, sliced, slices, stored

GRAMS = (3, 4)
UNKNOWN = "und"
#: Bytes of text that a task takes at once; its arrays are some fifty times as large.
SLICE = 2 << 20


def letters() -> np.ndarray:
    """Which code points are letters; built once per worker."""
    return per_worker("letters", lambda: np.fromiter((chr(c).isalpha() for c in range(0x110000)), dtype=bool, count=0x110000))


def _mixed(h: np.ndarray) -> np.ndarray:
    h ^= h >> np.uint64(31)
    h *= np.uint64(0x9E3779B97F4A7C15)
    h ^= h >> np.uint64(29)
    return h


def text_grams(texts: list[str | None]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Hashes of all n-grams, the row of each, and which rows have a letter.

    Letters are lower-cased, everything else is one blank; n-grams may begin or end with a blank and cross none.
    """
    folded = [" " + t.lower() + " " if t else " " for t in texts]
    sizes = np.fromiter(map(len, folded), dtype=np.int64, count=len(folded))
    points = np.frombuffer("".join(folded).encode("utf-32-le", "surrogatepass"), dtype=np.uint32)
    rows = np.repeat(np.arange(len(folded), dtype=np.int32), sizes)
    letter = letters()[points]
    has = np.zeros(len(folded), dtype=bool)
    has[rows[letter]] = True
    keep = letter.copy()
    keep[1:] |= letter[:-1]
    keep[:-1] |= letter[1:]
    chars = np.where(letter, points, np.uint32(32))[keep].astype(np.uint64)
    rows, letter = rows[keep], letter[keep]
    hashes, owners = [], []
    for n in GRAMS:
        count = len(chars) - n + 1
        if count <= 0:
            continue
        inner = letter[1 : count + 1].copy()
        for k in range(2, n - 1):
            inner &= letter[k : count + k]
        h = chars[:count] + np.uint64(n << 40)
        for k in range(1, n):
            h = h * np.uint64(0x100000001B3) + chars[k : count + k]
        hashes.append(_mixed(h[inner]))
        owners.append(rows[1 : count + 1][inner])
    if not hashes:
        return np.empty(0, np.uint64), np.empty(0, np.int32), has
    return np.concatenate(hashes), np.concatenate(owners), has


def slots(h: np.ndarray, bits: int, probes: int) -> list[np.ndarray]:
    """``probes`` places of each hash in a table of 2**bits slots."""
    mask = np.uint64((1 << bits) - 1)
    step = (h >> np.uint64(32)) | np.uint64(1)
    return [((h + np.uint64(k) * step) & mask).astype(np.int64) for k in range(probes)]


@dataclass(frozen=True)
class Filters:
    """``planes``: one array of 64-bit masks for every 64 languages; ``fill``: each language's share of set slots."""

    languages: list[str]
    planes: list[np.ndarray]
    fill: np.ndarray
    bits: int
    probes: int
    usual: int

    def hits(self, h: np.ndarray, rows: np.ndarray, n: int) -> tuple[np.ndarray, np.ndarray]:
        """Corrected counts (row, language) and the number of n-grams of each row."""
        total = np.bincount(rows, minlength=n).astype(float)
        counts = np.zeros((n, len(self.languages)))
        where = slots(h, self.bits, self.probes)
        for p, plane in enumerate(self.planes):
            mask = plane[where[0]]
            for w in where[1:]:
                mask &= plane[w]
            known = mask != 0
            mask, owner = mask[known], rows[known]
            for i in range(min(64, len(self.languages) - 64 * p)):
                counts[:, 64 * p + i] = np.bincount(owner[(mask >> np.array(i, mask.dtype)) & np.array(1, mask.dtype) != 0], minlength=n)
        chance = self.fill**self.probes
        return np.clip((counts - total[:, None] * chance) / np.maximum(1 - chance, 1e-9), 0, None), total

    def decide(self, texts: list[str | None]) -> tuple[list[str], np.ndarray]:
        """Language and score of each text; ``und`` without a letter, the most frequent language without evidence."""
        n = len(texts)
        h, rows, has = text_grams(texts)
        if not self.languages:
            return [UNKNOWN] * n, np.zeros(n)
        counts, _ = self.hits(h, rows, n)
        best, seen = counts.argmax(axis=1), counts.sum(axis=1)
        best[seen == 0] = self.usual
        score = np.where(seen > 0, counts.max(axis=1) / np.maximum(seen, 1e-9), 0.0) * has
        return [self.languages[b] if ok else UNKNOWN for b, ok in zip(best, has)], score


def fit(rows: DataFrame, per_language: int = 2000, share: float = 0.5, least: int = 3, bits: int = 21, probes: int = 2) -> Filters:
    """Filters from ``rows`` (doc_id, text, lang).

    Fitted on about ``per_language`` rows of each language (all, where it has fewer), drawn by a hash of doc_id; of these
    the whole texts count.  Only the filters, 2**bits slots whatever the corpus, reach the driver.  ``least`` is the
    number of times an n-gram must occur.
    """
    spark = rows.sparkSession
    rows = rows.where("text IS NOT NULL AND lang IS NOT NULL").select("doc_id", "text", "lang")
    sizes = {r["lang"]: r["n"] for r in rows.groupBy("lang").agg(F.count("*").alias("n")).collect()}
    names = sorted(sizes)
    if not names:
        return Filters([], [], np.zeros(0), bits, probes, 0)
    width = 64 if len(names) > 32 else 32 if len(names) > 16 else 16 if len(names) > 8 else 8
    dtype = np.dtype(f"uint{width}")
    usual = max(range(len(names)), key=lambda i: (sizes[names[i]], -i))
    # Languages are columns of a model, so their number is bounded by the labels in use, not by the rows.
    drawn = F.create_map(*[x for i, k in enumerate(names) for x in (F.lit(k), F.struct(F.lit(i).alias("i"), F.lit(min(1.0, per_language / sizes[k])).alias("p")))])
    sample = rows.withColumn("pick", drawn[F.col("lang")]).where(F.pmod(F.xxhash64("doc_id"), F.lit(1 << 20)) < F.col("pick.p") * (1 << 20))

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = np.empty(0, np.uint64), np.empty(0, np.int32), np.empty(0, np.int64)
        for batch in slices(batches, SLICE):
            langs = np.asarray(batch.column("i"))
            h, owner, _ = text_grams(batch.column("text").to_pylist())
            h, lang, n = np.concatenate([held[0], h]), np.concatenate([held[1], langs[owner]]), np.concatenate([held[2], np.ones(len(h), np.int64)])
            order = np.lexsort((lang, h))
            h, lang, n = h[order], lang[order], n[order]
            first = np.flatnonzero(np.r_[True, (h[1:] != h[:-1]) | (lang[1:] != lang[:-1])]) if len(h) else np.empty(0, np.int64)
            held = h[first], lang[first].astype(np.int32), np.add.reduceat(n, first) if len(first) else n
        yield pa.RecordBatch.from_arrays([pa.array(held[0].view(np.int64)), pa.array(held[1]), pa.array(held[2])], ["gram", "i", "n"])

    grams = sample.select("text", F.col("pick.i").alias("i")).mapInArrow(count, "gram long, i int, n long")
    stats, path = stored(grams.groupBy("gram", "i").agg(F.sum("n").alias("n")), "language-grams")
    totals = {r["i"]: r["n"] for r in stats.groupBy("i").agg(F.sum("n").alias("n")).collect()}
    rate = F.create_map(*[x for i in range(len(names)) for x in (F.lit(i), F.lit(1.0 / max(1, totals.get(i, 0))))])
    per_gram = (
        stats.withColumn("rate", F.col("n") * rate[F.col("i")])
        .groupBy("gram")
        .agg(F.sum("n").alias("n"), F.max("rate").alias("top"), F.collect_list(F.struct("i", "rate")).alias("langs"))
        .where(F.col("n") >= least)
        .select("gram", F.explode(F.filter("langs", lambda x: x["rate"] >= share * F.col("top"))["i"]).alias("i"))
    )
    mask = (1 << bits) - 1
    start, step = F.col("gram").bitwiseAND(F.lit(mask)), F.shiftrightunsigned("gram", 32).bitwiseOR(F.lit(1)).bitwiseAND(F.lit(mask))
    places = F.array(*[(start + step * k).bitwiseAND(F.lit(mask)).cast("int") for k in range(probes)])
    with_slots = per_gram.select(F.explode(places).alias("slot"), (F.col("i") / 64).cast("int").alias("plane"), F.expr("shiftleft(1L, CAST(i % 64 AS INT))").alias("bit"))
    cells = with_slots.groupBy("plane", "slot").agg(F.bit_or("bit").alias("mask"))
    planes = [np.zeros(1 << bits, dtype) for _ in range(math.ceil(len(names) / 64))]
    table = cells.toArrow()
    plane, slot = np.asarray(table["plane"]), np.asarray(table["slot"])
    value = np.asarray(table["mask"]).view(np.uint64).astype(dtype)
    for p in range(len(planes)):
        planes[p][slot[plane == p]] = value[plane == p]
    fill = np.array([np.count_nonzero(planes[i // 64] >> np.array(i % 64, dtype) & np.array(1, dtype)) / (1 << bits) for i in range(len(names))])
    drop_path(spark, path)
    return Filters(names, planes, fill, bits, probes, usual)


def held_out(doc_id):
    return F.coalesce(crc_of(doc_id) % 4 == 2, F.lit(False))


def predict(docs: DataFrame, filters: Filters) -> DataFrame:
    """All columns of ``docs`` with ``lang_pred`` and ``lang_score`` added (replacing columns of those names)."""
    shared = docs.sparkSession.sparkContext.broadcast(tuple(vars(filters).values()))
    docs = docs.drop("lang_pred", "lang_score")
    schema = T.StructType([*docs.schema.fields, T.StructField("lang_pred", T.StringType()), T.StructField("lang_score", T.DoubleType())])

    def work(batch: pa.RecordBatch) -> pa.RecordBatch:
        langs, score = Filters(*shared.value).decide(batch.column("text").to_pylist())
        return pa.RecordBatch.from_arrays([*batch.columns, pa.array(langs, pa.string()), pa.array(score, pa.float64())], [*batch.schema.names, "lang_pred", "lang_score"])

    return docs.mapInArrow(sliced(work, SLICE), schema)


def identify(docs: DataFrame, **options) -> DataFrame:
    """``docs`` (doc_id, text, lang, any others) with ``held_out``, ``lang_pred`` and ``lang_score``.

    Learns from rows with text, lang and doc_id whose crc32(doc_id) mod 4 is not 2.  ``und`` for null texts and texts
    without a letter, and for every text if nothing could be learned; score 0 where no n-gram is known.  Repeated rows are
    judged alike; ties go to the language first by name; an empty table gives an empty result.
    """
    rows = docs.select("doc_id", "text", "lang").where(F.col("doc_id").isNotNull() & ~held_out(F.col("doc_id")))
    return predict(docs.withColumn("held_out", held_out(F.col("doc_id"))), fit(rows, **options))


def keep_known(docs: DataFrame) -> DataFrame:
    """The rows of ``docs`` with a recognised language, unchanged: neither ``und`` nor without any known n-gram."""
    return identify(docs).where((F.col("lang_pred") != UNKNOWN) & (F.col("lang_score") > 0)).select(*docs.columns)
