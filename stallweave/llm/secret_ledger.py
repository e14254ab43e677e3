"""Secret scan over an incremental ledger of blobs, in DataFrame functions only.

Every version of every path is content-addressed by the SHA-256 of its text.  The ledger holds which (blob, rule version)
pairs have been scanned and what they gave; a scan reads one representative text of each blob that lacks a pair, runs
only the missing rules, appends, and joins the findings of all its blobs back to every path that holds them.

Offsets come from cutting a text at its matches: the gaps (``split``) and the matches (``regexp_extract_all``) of one
expression alternate, so a running sum of their lengths is each match's place.  The sum is a window over (blob, rule),
whose rows are bounded by one text.
"""

from __future__ import annotations

import uuid
from dataclasses import dataclass

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from stallweave.llm.tables import drop_path, materialise, scratch_path


@dataclass(frozen=True)
class Rule:
    """``least`` code points are asked of ``group``; matches below it are dropped after matching."""

    kind: str
    pattern: str
    group: int = 0
    least: int = 1
    version: int = 1

    @property
    def name(self) -> str:
        return f"{self.kind}@{self.version}"


# The three base patterns and their least lengths.
BASE_RULES = (
    Rule("assign", r"""((?i:password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", 2, 12),
    Rule("access", r"AKIA[A-Z0-9]+", 0, 18),
    Rule("hex", r"[0-9a-f]{16,}", 0, 16),
)
# Public token formats; their prefixes do not occur in prose.
MORE_RULES = (
    Rule("pem", r"-----BEGIN [A-Z ]{0,40}PRIVATE KEY-----"),
    Rule("jwt", r"eyJ[A-Za-z0-9_-]{8,}\.eyJ[A-Za-z0-9_-]{8,}\.[A-Za-z0-9_-]{8,}"),
    Rule("github", r"gh[pousr]_[A-Za-z0-9]{36,}"),
    Rule("slack", r"xox[abprs]-[A-Za-z0-9-]{10,}"),
    Rule("google", r"AIza[A-Za-z0-9_-]{35}"),
)
RULES = BASE_RULES + MORE_RULES

SCANNED = "blob string, rule string, run string"
FINDINGS = "blob string, kind string, rank int, begin long, end long, rule string, run string"


def blob_of(text: Column) -> Column:
    return F.sha2(F.coalesce(text, F.lit("")).cast("binary"), 256)


def _matches(texts: DataFrame, rule: Rule) -> DataFrame:
    """(blob, kind, rank, begin, end, rule) of one rule over (blob, text, todo)."""
    pattern = F.lit(rule.pattern)
    hits = F.regexp_extract_all("text", pattern, F.lit(0))
    judged = hits if rule.group == 0 else F.regexp_extract_all("text", pattern, F.lit(rule.group))
    parts = F.arrays_zip(
        F.transform(F.split("text", rule.pattern, -1), F.length).alias("gap"),
        F.transform(hits, F.length).alias("hit"),
        F.transform(judged, F.length).alias("judged"),
    )
    rows = (
        texts.where(F.array_contains("todo", rule.name) & F.col("text").rlike(rule.pattern))
        .select("blob", F.posexplode(parts).alias("pos", "part"))
        .select("blob", "pos", *[F.coalesce(F.col(f"part.{n}"), F.lit(0)).cast("long").alias(n) for n in ("gap", "hit", "judged")])
    )
    ends = F.sum(F.col("gap") + F.col("hit")).over(Window.partitionBy("blob").orderBy("pos"))
    return (
        rows.withColumn("end", ends)
        .where((F.col("hit") > 0) & (F.col("judged") >= rule.least))
        .select("blob", F.lit(rule.kind).alias("kind"), F.lit(RULES.index(rule) if rule in RULES else len(RULES)).alias("rank"),
                (F.col("end") - F.col("hit")).alias("begin"), "end", F.lit(rule.name).alias("rule"))
    )


def _table(spark, path: str, schema: str) -> DataFrame:
    """A ledger table; empty before its first run."""
    try:
        return spark.read.schema(schema).parquet(path)
    except AnalysisException as err:
        if "PATH_NOT_FOUND" not in str(err):
            raise
        return spark.createDataFrame([], schema)


def scan_unseen(versions: DataFrame, ledger: str, rules: tuple[Rule, ...] = RULES) -> None:
    """Scans the (blob, rule version) pairs of ``versions`` (path, text) that ``ledger`` lacks and records them.

    Findings are written before the pairs are marked as scanned; a run that dies between leaves rows that no mark names,
    which are never read, and its pairs are scanned again.
    """
    spark = versions.sparkSession
    run = uuid.uuid4().hex
    held = versions.select("path", blob_of(F.col("text")).alias("blob"))
    done = _table(spark, f"{ledger}/scanned", SCANNED).groupBy("blob").agg(F.collect_set("rule").alias("done"))
    todo = (
        held.groupBy("blob").agg(F.min("path").alias("path"))
        .join(done, "blob", "left")
        .withColumn("todo", F.array_except(F.array(*[F.lit(r.name) for r in rules]), F.coalesce("done", F.array().cast("array<string>"))))
        .where(F.size("todo") > 0)
        .select(F.col("blob").alias("todo_blob"), F.col("path").alias("todo_path"), "todo")
    )
    pairs = f"{ledger}/pending/{run}"
    todo.write.parquet(pairs)
    todo = spark.read.schema(todo.schema).parquet(pairs)
    full = versions.select("path", F.coalesce("text", F.lit("")).alias("text"), blob_of(F.col("text")).alias("blob"))
    texts = full.join(todo, (F.col("blob") == F.col("todo_blob")) & F.col("path").eqNullSafe(F.col("todo_path"))).select("blob", "text", "todo")
    # One table of the texts with anything to look at, so that they are cut once and not once for each rule.
    any_rule = None
    for rule in rules:
        one = F.col("text").rlike(rule.pattern)
        any_rule = one if any_rule is None else any_rule | one
    suspects_path = f"{ledger}/suspects/{run}"
    # A repeated row of the smallest path would be summed twice.
    texts.where(any_rule).dropDuplicates(["blob"]).write.parquet(suspects_path)
    suspects = spark.read.schema(texts.schema).parquet(suspects_path)
    found = None
    for rule in rules:
        one = _matches(suspects, rule)
        found = one if found is None else found.unionByName(one)
    found.dropDuplicates(["blob", "rule", "begin"]).withColumn("run", F.lit(run)).write.mode("append").parquet(f"{ledger}/findings")
    todo.select(F.col("todo_blob").alias("blob"), F.explode("todo").alias("rule"), F.lit(run).alias("run")).write.mode("append").parquet(f"{ledger}/scanned")
    for used in (pairs, suspects_path):
        drop_path(spark, used)


def findings(versions: DataFrame, ledger: str, rules: tuple[Rule, ...] = RULES) -> DataFrame:
    """Every path of ``versions`` with its blob and ``spans``, an array of (begin, rank, kind, end) by begin, then rank."""
    spark = versions.sparkSession
    runs = _table(spark, f"{ledger}/scanned", SCANNED).select("run").distinct()
    spans = (
        _table(spark, f"{ledger}/findings", FINDINGS)
        .where(F.col("rule").isin([r.name for r in rules]))
        .join(runs, "run", "left_semi")
        .groupBy("blob")
        .agg(F.sort_array(F.collect_set(F.struct("begin", "rank", "kind", "end"))).alias("spans"))
    )
    # Written first, so that the join has a plain table on either side and a blob of very many paths can be split.
    spans = materialise(spans, "spans")
    return versions.select("path", blob_of(F.col("text")).alias("blob")).join(spans, "blob", "left").select(
        "path", "blob", F.coalesce("spans", F.array().cast("array<struct<begin:bigint,rank:int,kind:string,end:bigint>>")).alias("spans")
    )


def scan_secrets(docs: DataFrame, ledger: str | None = None, rules: tuple[Rule, ...] = RULES) -> DataFrame:
    """path (doc_id), blob, spans for every row of ``docs`` (doc_id, text; other columns ignored), scanning what ``ledger`` lacks.

    Without ``ledger`` a new one is begun in the shared folder.  Null texts count as empty; an empty table gives an empty
    result; repeated rows are one blob and each is returned; a null doc_id is a path like any other.
    """
    ledger = ledger or scratch_path(docs.sparkSession, "secret-ledger")
    versions = docs.select(F.col("doc_id").alias("path"), "text")
    scan_unseen(versions, ledger, rules)
    return findings(versions, ledger, rules)


def listing(spans: Column) -> Column:
    """kind:begin:end of all spans, comma-joined."""
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["begin"].cast("string"), s["end"].cast("string"))), ",")


def count_of(spans: Column, kind: str) -> Column:
    return F.size(F.filter(spans, lambda s: s["kind"] == kind)).cast("long")
