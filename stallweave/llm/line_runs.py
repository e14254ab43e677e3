"""Line dedup over levelled sorted runs of line hashes.

Lines are known by two 64-bit hashes of their key (ends stripped, A-Z lower-cased).  A batch of documents becomes one
row per key: in how many of its documents the key stands, and the largest of their ids.  The batch meets the runs
already stored: keys that no run holds (anti-join) are taken over, keys that one does hold go on counting from their
stored total; both make the new run, sorted by hash.  Once a level has ``fan`` runs they are merged into one of the next
level, so a table of n batches is read through O(log n) runs.

Totals never shrink, so over the runs of a key the largest total and the largest id are the valid ones.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from stallweave.llm.tables import ascii_lower, drop_path, materialise, scratch_path, stored

BLANKS = " \t\n\x0b\x0c\r"
HASH = ["h1", "h2"]


def lines_of(text: Column) -> Column:
    """Lines of a text; null and empty texts are one empty line."""
    return F.split(F.coalesce(text, F.lit("")), "\n", -1)


def line_key(line: Column) -> Column:
    return ascii_lower(F.btrim(line, F.lit(BLANKS)))


def hashed(key: Column) -> list[Column]:
    """128 bits in two numbers; the second hash starts from another seed."""
    return [F.xxhash64(key).alias("h1"), F.xxhash64(F.lit(7), key).alias("h2")]


def batch_counts(docs: DataFrame, min_chars: int, batches: int) -> DataFrame:
    """(batch, h1, h2, n_docs, last_doc) of every key with ``min_chars`` code points.

    The distinct count is spread by document first and summed per task second, so a line that a third of all documents
    share meets in no single task.
    """
    keys = F.array_distinct(F.filter(F.transform(lines_of(F.col("text")), line_key), lambda k: F.length(k) >= min_chars))
    rows = (
        docs.where("doc_id IS NOT NULL")
        .select("doc_id", F.explode(keys).alias("key"))
        .select("doc_id", F.pmod(F.xxhash64("doc_id"), F.lit(batches)).cast("int").alias("batch"), *hashed(F.col("key")))
    )
    return rows.groupBy("batch", *HASH).agg(F.countDistinct("doc_id").alias("n_docs"), F.max("doc_id").alias("last_doc"))


class LineRuns:
    """The stored runs of one table, level by level."""

    def __init__(self, spark: SparkSession, folder: str, fan: int = 3):
        self.spark, self.folder, self.fan = spark, folder, fan
        self.levels: list[list[str]] = [[]]
        self.written = 0

    def _write(self, rows: DataFrame, level: int) -> None:
        path = f"{self.folder}/level={level}/run={self.written}"
        self.written += 1
        rows.sortWithinPartitions(*HASH).write.parquet(path)
        while len(self.levels) <= level:
            self.levels.append([])
        self.levels[level].append(path)

    def totals(self, paths: list[str] | None = None) -> DataFrame:
        """(h1, h2, n_docs, last_doc) over the given runs, all by default."""
        runs = self.spark.read.schema("h1 long, h2 long, n_docs long, last_doc long").parquet(*(paths or sum(self.levels, [])))
        return runs.groupBy(*HASH).agg(F.max("n_docs").alias("n_docs"), F.max("last_doc").alias("last_doc"))

    def add(self, counts: DataFrame) -> None:
        """Takes over a batch's (h1, h2, n_docs, last_doc); its documents are in no earlier batch."""
        counts = counts.select(*HASH, "n_docs", "last_doc")
        if any(self.levels):
            known = self.totals().select(*HASH, F.col("n_docs").alias("n_before"), F.col("last_doc").alias("last_before"))
            fresh = counts.join(known.select(*HASH), HASH, "left_anti")
            grown = counts.join(known, HASH).select(
                *HASH, (F.col("n_docs") + F.col("n_before")).alias("n_docs"), F.greatest("last_doc", "last_before").alias("last_doc")
            )
            counts = fresh.unionByName(grown)
        self._write(counts, 0)
        level = 0
        while len(self.levels[level]) >= self.fan:
            used, self.levels[level] = self.levels[level], []
            self._write(self.totals(used), level + 1)
            for path in used:
                drop_path(self.spark, path)
            level += 1


def _marked(docs: DataFrame, min_chars: int, min_docs: int, batches: int, fan: int) -> DataFrame:
    """``docs`` with ``__gone``, the sorted-out line numbers of each row (null where none)."""
    spark = docs.sparkSession
    counts, staged = stored(batch_counts(docs.select("doc_id", "text"), min_chars, batches), "line-counts")
    runs = LineRuns(spark, scratch_path(spark, "line-runs"), fan)
    for batch in range(batches):
        runs.add(counts.where(F.col("batch") == batch))
    repeated = materialise(runs.totals().where(F.col("n_docs") >= min_docs).select(*HASH, "last_doc"), "repeated-lines")
    drop_path(spark, staged)
    gone = (
        docs.where("doc_id IS NOT NULL")
        .select("doc_id", F.xxhash64("text").alias("row"), F.posexplode(F.transform(lines_of(F.col("text")), line_key)).alias("pos", "key"))
        .where(F.length("key") >= min_chars)
        .select("doc_id", "row", "pos", *hashed(F.col("key")))
        .join(repeated, HASH)
        .where("doc_id < last_doc")
        .groupBy(F.col("doc_id").alias("__doc"), F.col("row").alias("__row"))
        .agg(F.collect_set("pos").alias("__gone"))
    )
    gone = materialise(gone, "dropped-lines")
    return docs.join(gone, (docs["doc_id"] == gone["__doc"]) & (F.xxhash64(docs["text"]) == gone["__row"]), "left").drop("__doc", "__row")


def _kept(text: Column, gone: Column) -> Column:
    lines = lines_of(text)
    stay = F.array_except(F.sequence(F.lit(0), F.size(lines) - 1), gone)
    return F.when(gone.isNull(), F.coalesce(text, F.lit(""))).otherwise(F.array_join(F.transform(stay, lambda i: F.get(lines, i)), "\n"))


def dedup_lines(docs: DataFrame, min_chars: int = 40, min_docs: int = 5, batches: int = 3, fan: int = 3) -> DataFrame:
    """doc_id, text without repeated lines, n_lines, n_dropped for every row of ``docs`` (doc_id, text, other columns ignored).

    A key of ``min_chars`` code points found in ``min_docs`` documents keeps its lines only in the largest doc_id holding it.
    Null and empty texts are one empty line and stay "".  Repeats within a document count once and go or stay together;
    repeated rows of a doc_id count as one document and each is returned.  Rows without doc_id count nowhere and keep all
    lines.  An empty table gives an empty result.
    """
    text, gone = F.col("text"), F.col("__gone")
    return _marked(docs.select("doc_id", "text"), min_chars, min_docs, batches, fan).select(
        "doc_id",
        _kept(text, gone).alias("text"),
        F.size(lines_of(text)).cast("long").alias("n_lines"),
        F.coalesce(F.size(gone), F.lit(0)).cast("long").alias("n_dropped"),
    )


def without_repeated_lines(docs: DataFrame, min_chars: int = 40, min_docs: int = 5, batches: int = 3, fan: int = 3) -> DataFrame:
    """``docs`` with all its columns, the texts without repeated lines and ``n_chars`` (where there is one) their length.

    Rows as in ``dedup_lines``, except that null texts stay null and texts that lose no line stay as they are.
    """
    text, gone = F.col("text"), F.col("__gone")
    changed = _marked(docs, min_chars, min_docs, batches, fan).withColumn("__new", F.when(gone.isNotNull(), _kept(text, gone)))
    columns = {"text": F.coalesce("__new", "text")}
    if "n_chars" in docs.columns:
        columns["n_chars"] = F.coalesce(F.length("__new"), "n_chars").cast(docs.schema["n_chars"].dataType)
    return changed.select(*[columns.get(c, F.col(f"`{c}`")).alias(c) for c in docs.columns])
