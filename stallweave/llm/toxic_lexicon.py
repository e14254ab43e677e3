"""Toxicity by a weighted lexicon, matched by Aho-Corasick over folded text.

Folding lower-cases, takes accents off, maps letters of other scripts that look Latin and the usual digits and signs back to
Latin letters, and turns everything else into single blanks.  Lexicon entries are word beginnings, so inflected and
padded forms match.  Matches inside an exception phrase do not count.  The sum of weights over a power of the length is
held against a threshold.

Entries, weights, exceptions, the power and the threshold are learned from labelled rows.
"""

from __future__ import annotations

import math
import re
import unicodedata
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import ahocorasick
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from stallweave.llm.tables import crc_of, drop_path, per_worker, sliced, stored

# Look-alikes of Latin letters in Cyrillic and Greek, and digits and signs used for letters.
LOOK_ALIKES = {
    "а": "a", "е": "e", "о": "o", "р": "p", "с": "c", "у": "y", "х": "x", "к": "k", "м": "m", "т": "t", "в": "b", "н": "h", "і": "i", "ї": "i", "ј": "j", "ѕ": "s", "ԁ": "d", "ԛ": "q", "ԝ": "w",
    "α": "a", "β": "b", "ε": "e", "η": "n", "ι": "i", "κ": "k", "ν": "v", "ο": "o", "ρ": "p", "τ": "t", "υ": "u", "χ": "x", "ı": "i", "ɑ": "a", "ɡ": "g", "ℓ": "l",
    "0": "o", "1": "i", "3": "e", "4": "a", "5": "s", "7": "t", "8": "b", "9": "g", "@": "a", "$": "s", "|": "l",
}
_FOLD = {ord(a): b for a, b in LOOK_ALIKES.items()} | {c: None for c in (*range(0x300, 0x370), 0xAD, *range(0x200B, 0x2010), 0x2060, 0xFEFF)}
#: Letters of the shortest and longest word beginnings of a lexicon; shorter words enter whole.
SHORTEST, LONGEST = 4, 12
#: Powers of the length to choose from.
POWERS = (0.0, 0.25, 0.5, 0.75, 1.0)
_REST = re.compile(r"[\W\d_]+")
#: Amounts, years, dates and the like: digits with the signs of numbers, and no letter.
_NUMBER = re.compile(r"(?<!\S)[-+#(]*[$\u20ac\u00a3]?\d[\d.,:;/%)\u2013-]*[$\u20ac\u00a3!?]*(?!\S)")


def fold(text: str | None) -> str:
    """The folded text with a blank at either end; one blank for a text without letters.

    Digits stand for letters only in words that have a letter or a letter's sign; numbers are numbers.
    """
    if not text:
        return " "
    low = _NUMBER.sub(" ", text.lower())
    if not low.isascii():
        low = unicodedata.normalize("NFKD", low)
    words = _REST.sub(" ", low.translate(_FOLD)).strip()
    return f" {words} " if words else " "


@dataclass(frozen=True)
class Lexicon:
    """``weights`` by word beginning, or by a whole short word and a blank; ``exceptions``: phrases in which a match does not count."""

    weights: dict[str, float]
    exceptions: frozenset[str]
    threshold: float = 1.0
    power: float = 0.25

    def automaton(self) -> ahocorasick.Automaton:
        machine = ahocorasick.Automaton()
        for stem, weight in self.weights.items():
            machine.add_word(" " + stem, (len(stem) + 1, weight))
        for phrase in self.exceptions:
            machine.add_word(f" {phrase} ", (len(phrase) + 2, None))
        if len(machine):
            machine.make_automaton()
        return machine

    def matches(self, machine: ahocorasick.Automaton, folded: str) -> list[tuple[int, float]]:
        """(place of the blank before it, weight) of every match that stands in no exception phrase."""
        if not len(machine):
            return []
        found, spared = [], []
        for end, (length, weight) in machine.iter(folded):
            (spared if weight is None else found).append((end - length + 1, end, weight))
        if spared:
            found = [f for f in found if not any(a <= f[0] and f[1] <= b for a, b, _ in spared)]
        return [(a, w) for a, _, w in found]

    def weight(self, machine: ahocorasick.Automaton, folded: str) -> float:
        return sum(w for _, w in self.matches(machine, folded))

    def strength(self, weight: float, words: int) -> float:
        """Weight for the length; fifty words more make short texts alike."""
        return weight / (50 + words) ** self.power

    def score(self, strength: float) -> float:
        return strength / (strength + self.threshold) if strength > 0 else 0.0


def _surprise(p: int, n: int, positive: int, negative: int) -> float:
    """Log-likelihood ratio (G) of a word's document counts in the two classes."""
    out, total, rows = 0.0, positive + negative, p + n
    for seen, size in ((p, positive), (n, negative)):
        for k, share in ((seen, rows / total), (size - seen, 1 - rows / total)):
            if k:
                out += 2 * k * math.log(k / (size * share))
    return out


def _counted(sample: DataFrame, of) -> DataFrame:
    """(term, p, n): in how many toxic and clean texts of ``sample`` (folded, toxic) each term of ``of(folded)`` stands."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen = Counter(), Counter()
        for batch in batches:
            for folded, toxic in zip(batch.column("folded").to_pylist(), batch.column("toxic").to_pylist()):
                seen[toxic].update(of(folded))
        terms = list(seen[0] | seen[1])
        yield pa.RecordBatch.from_arrays([pa.array(terms, pa.string()), pa.array([seen[1][t] for t in terms], pa.int64()), pa.array([seen[0][t] for t in terms], pa.int64())], ["term", "p", "n"])

    return sample.mapInArrow(count, "term string, p long, n long").groupBy("term").agg(F.sum("p").alias("p"), F.sum("n").alias("n"))


def fit(rows: DataFrame, labels: DataFrame, per_class: int = 3000, least: int = 4, surprise: float = 28.0, most: int = 2000) -> Lexicon:
    """Lexicon from ``rows`` (doc_id, text) and ``labels`` (doc_id, toxic).

    Fitted on at most about ``per_class`` labelled rows of each class, drawn by a hash of doc_id (all, where there are fewer);
    only those ids are broadcast.  A word beginning of ``SHORTEST`` to ``LONGEST`` letters, or a shorter word as a whole, enters if
    it stands in ``least`` toxic texts and its counts are surprising.  The size of the model is ``most`` entries and as many
    exception phrases (a match and the word before or after it).  Conflicting labels of a document count as toxic, null
    labels not at all.
    """
    spark = rows.sparkSession
    clear = labels.where("doc_id IS NOT NULL AND toxic IN (0, 1)").groupBy("doc_id").agg(F.max("toxic").alias("toxic"))
    sizes = {r["toxic"]: r["n"] for r in clear.groupBy("toxic").agg(F.count("*").alias("n")).collect()}
    share = F.when(F.col("toxic") == 1, per_class / max(1, sizes.get(1, 0))).otherwise(per_class / max(1, sizes.get(0, 0)))
    drawn = clear.where(F.pmod(F.xxhash64("doc_id"), F.lit(1 << 20)) < share * (1 << 20))

    def folded(batch: pa.RecordBatch) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array([fold(t) for t in batch.column("text").to_pylist()], pa.string()), batch.column("toxic")], ["folded", "toxic"])

    texts = rows.select("doc_id", "text").join(F.broadcast(drawn), "doc_id").select("text", F.col("toxic").cast("int").alias("toxic"))
    sample, path = stored(texts.mapInArrow(sliced(folded), "folded string, toxic int"), "toxic-sample")
    seen = {r["toxic"]: r["n"] for r in sample.groupBy("toxic").agg(F.count("*").alias("n")).collect()}
    positive, negative = seen.get(1, 0), seen.get(0, 0)
    if not positive or not negative:
        return Lexicon({}, frozenset())

    def stems(folded: str) -> set[str]:
        words = set(folded.split())
        return {w + " " for w in words if len(w) < SHORTEST} | {w[:k] for w in words for k in range(SHORTEST, min(len(w), LONGEST) + 1)}

    common = _counted(sample, stems).where((F.col("p") >= least) & (F.col("p") * negative > 4 * F.col("n") * positive))
    ranked = sorted(((_surprise(r["p"], r["n"], positive, negative), r["term"], r["p"], r["n"]) for r in common.toLocalIterator()), key=lambda x: (-x[0], len(x[1]), x[1]))
    weights: dict[str, float] = {}
    beginnings: set[str] = set()
    for found, term, p, n in ranked:
        if found < surprise or len(weights) >= most:
            break
        if term in beginnings or any(term[:k] in weights for k in range(1, len(term) + 1)):
            continue
        weights[term] = math.log((p + 0.5) / (positive + 1)) - math.log((n + 0.5) / (negative + 1))
        beginnings.update(term[:k] for k in range(1, len(term) + 1))
    plain = Lexicon(weights, frozenset())

    def phrases(folded: str) -> set[str]:
        machine, out = per_worker(f"toxic {hash(frozenset(weights.items()))}", plain.automaton), set()
        for start, _ in plain.matches(machine, folded):
            # The words around the blank at ``start``, whatever their lengths.
            first = folded.find(" ", start + 1)
            word, second = folded[start + 1 : first], folded.find(" ", first + 1)
            if start > 0:
                out.add(f"{folded[folded.rfind(' ', 0, start) + 1 : start]} {word}")
            if second > 0:
                out.add(f"{word} {folded[first + 1 : second]}")
        return out

    spared = _counted(sample, phrases).where((F.col("n") >= least) & (F.col("p") * negative < F.col("n") * positive))
    exceptions = frozenset(r["term"] for r in spared.orderBy(F.desc("n"), "term").limit(most).collect())
    lexicon = Lexicon(weights, exceptions)

    def weighed(batch: pa.RecordBatch) -> pa.RecordBatch:
        machine, texts = lexicon.automaton(), batch.column("folded").to_pylist()
        return pa.RecordBatch.from_arrays(
            [pa.array([lexicon.weight(machine, t) for t in texts], pa.float64()), pa.array([t.count(" ") for t in texts], pa.int64()), batch.column("toxic")], ["weight", "words", "toxic"]
        )

    # At most the rows of the bounded sample.
    rows_of = sample.mapInArrow(lambda batches: map(weighed, batches), "weight double, words long, toxic int").where("weight > 0").collect()
    drop_path(spark, path)
    best = (0.0, 1.0, 0.25)
    for power in POWERS:
        trial = Lexicon(weights, exceptions, 1.0, power)
        level = sorted(((trial.strength(r["weight"], r["words"]), r["toxic"]) for r in rows_of), reverse=True)
        right = 0.0
        for i, (strength, toxic) in enumerate(level):
            right += toxic / positive - (1 - toxic) / negative
            after = level[i + 1][0] if i + 1 < len(level) else 0.0
            if right > best[0] and after < strength:
                best = (right, (strength + after) / 2, power)
    return Lexicon(weights, exceptions, max(1e-9, best[1]), best[2])


def held_out(doc_id):
    return F.coalesce(crc_of(doc_id) % 5 == 0, F.lit(False))


def score_texts(docs: DataFrame, labels: DataFrame, **options) -> DataFrame:
    """``docs`` (doc_id, text, any others) with ``held_out``, ``score`` (0 to 1) and ``predicted`` added.

    Learns from labelled rows whose crc32(doc_id) mod 5 is not 0.  Null and empty texts and texts without a match score 0;
    so do all where no label of either class could be learned from.  Repeated rows score alike; an empty table gives an
    empty result.
    """
    rows = docs.select("doc_id", "text").where(F.col("doc_id").isNotNull() & ~held_out(F.col("doc_id")))
    shared = docs.sparkSession.sparkContext.broadcast(tuple(vars(fit(rows, labels.where(~held_out(F.col("doc_id"))), **options)).values()))
    docs = docs.drop("held_out", "score", "predicted")

    def work(batch: pa.RecordBatch) -> pa.RecordBatch:
        lexicon = Lexicon(*shared.value)
        machine = per_worker(f"toxic {hash((frozenset(lexicon.weights.items()), lexicon.exceptions))}", lexicon.automaton)
        scores = []
        for folded in map(fold, batch.column("text").to_pylist()):
            scores.append(lexicon.score(lexicon.strength(lexicon.weight(machine, folded), folded.count(" "))))
        return pa.RecordBatch.from_arrays([*batch.columns, pa.array(scores, pa.float64())], [*batch.schema.names, "score"])

    added = T.StructType([*docs.schema.fields, T.StructField("score", T.DoubleType())])
    return docs.mapInArrow(sliced(work), added).withColumn("held_out", held_out(F.col("doc_id"))).withColumn("predicted", (F.col("score") >= 0.5).cast("int"))
