"""One query for each operator, over its whole table."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from stallweave.llm import bpe_tree, chat_layouts, host_words, html_paths, language_filters, line_runs, minmax_dedup, secret_ledger, sorted_passes, template_leaks, token_links, toxic_lexicon, whitening
from stallweave.llm.tables import materialise, read


def op1_template_leaks(spark: SparkSession, sf_dir: str) -> DataFrame:
    return template_leaks.leaks(read(spark, sf_dir, "documents"), read(spark, sf_dir, "benchmark"))


def op2_html_paths(spark: SparkSession, sf_dir: str) -> DataFrame:
    texts = html_paths.main_text(read(spark, sf_dir, "pages"))
    return texts.select("page_id", "url", "text", F.length("text").cast("long").alias("n_chars"))


def op3_minmax_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return minmax_dedup.near_duplicates(read(spark, sf_dir, "documents"), width=3, percent=85, bands=32, rows=6)


def op4_host_words(spark: SparkSession, sf_dir: str) -> DataFrame:
    return host_words.judge(read(spark, sf_dir, "pages")).select("page_id", "host", "path", "rule", "verdict")


def op5_bpe_tree(spark: SparkSession, sf_dir: str) -> DataFrame:
    coded = bpe_tree.encode_decode(read(spark, sf_dir, "documents"))
    return coded.select("doc_id", "n_tokens", F.sha2("ids", 256).alias("ids_sha256"), F.sha2("decoded", 256).alias("decoded_sha256"))


def op6_toxic_lexicon(spark: SparkSession, sf_dir: str) -> DataFrame:
    scored = toxic_lexicon.score_texts(read(spark, sf_dir, "documents"), read(spark, sf_dir, "labels"))
    return scored.select("doc_id", "held_out", "score", "predicted")


def op7_secret_ledger(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = secret_ledger.scan_secrets(read(spark, sf_dir, "documents"))
    spans = F.col("spans")
    base = F.filter(spans, lambda s: s["rank"] < len(secret_ledger.BASE_RULES))
    return found.select(
        F.col("path").alias("doc_id"),
        *[secret_ledger.count_of(spans, r.kind).alias(f"n_{r.kind}") for r in secret_ledger.BASE_RULES],
        F.sha2(secret_ledger.listing(base).cast("binary"), 256).alias("base_sha256"),
        secret_ledger.listing(spans).alias("spans"),
    )


def op8_line_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    kept = line_runs.dedup_lines(read(spark, sf_dir, "documents"))
    return kept.select("doc_id", "n_lines", "n_dropped", F.sha2(F.col("text").cast("binary"), 256).alias("kept_sha256"))


def op9_sorted_passes(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sorted_passes.near_vectors(read(spark, sf_dir, "embeddings"))


def op10_language_filters(spark: SparkSession, sf_dir: str) -> DataFrame:
    named = language_filters.identify(read(spark, sf_dir, "documents"))
    return named.select("doc_id", "held_out", "lang_pred", F.col("lang_score").alias("score"))


def op11_token_links(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_links.score_links(read(spark, sf_dir, "documents"))


def op12_chat_layouts(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = read(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    said = F.when(F.col("id") == 0, "user").otherwise("assistant")
    added = spark.range(2).select(F.lit(-7).alias("conv_id"), F.col("id").alias("turn"), said.alias("role"), F.lit(r"\### Assistant: </turn> ok").alias("text"))
    records = chat_layouts.from_turn_rows(rows.unionByName(added.select(*[F.col(f.name).cast(f.dataType) for f in rows.schema])))
    # Written, so that what is read back is what a reader finds.
    out = materialise(chat_layouts.formatted(chat_layouts.canonical(records)).select("conv_id", "formatted", "loss"), "chats")
    back = chat_layouts.read_back(out)
    learned = F.array_join("read_loss", "")
    told = F.array_join(F.transform("read_turns", lambda t: F.concat(t["role"], F.lit("\n"), t["text"], F.lit("\n"))), "")
    return back.select(
        "conv_id",
        F.size("read_turns").cast("long").alias("n_turns"),
        F.sha2(told, 256).alias("turns_sha256"),
        F.length(learned).cast("long").alias("loss_chars"),
        F.sha2(learned, 256).alias("loss_sha256"),
        F.length("formatted").cast("long").alias("formatted_chars"),
    )


def op13_whitening(spark: SparkSession, sf_dir: str) -> DataFrame:
    return whitening.whiten(read(spark, sf_dir, "embeddings"), components=32)


QUERIES = {
    f.__name__: f
    for f in (
        op1_template_leaks, op2_html_paths, op3_minmax_dedup, op4_host_words, op5_bpe_tree,
        op6_toxic_lexicon, op7_secret_ledger, op8_line_runs, op9_sorted_passes, op10_language_filters,
        op11_token_links, op12_chat_layouts, op13_whitening,
    )
}

ORACLES = {
    "op12_chat_layouts": r"""
        WITH rows AS (
            SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
            UNION ALL SELECT -7, 0, 'user', '\### Assistant: </turn> ok' UNION ALL SELECT -7, 1, 'assistant', '\### Assistant: </turn> ok'),
        sized AS (
            SELECT *, 6 + length(replace(replace(replace(replace(role, '%', '%25'), '<', '%3C'), '>', '%3E'), chr(10), '%0A')) + 2
                      + length(text) + len(regexp_extract_all(text, '<\\*/?turn')) + 9 AS chars
            FROM rows)
        SELECT conv_id, count(*) AS n_turns,
               sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn, role, text)) AS turns_sha256,
               coalesce(sum(length(text)) FILTER (role = 'assistant'), 0)::BIGINT AS loss_chars,
               sha256(coalesce(string_agg(text, '' ORDER BY turn, role, text) FILTER (role = 'assistant'), '')) AS loss_sha256,
               sum(chars)::BIGINT AS formatted_chars
        FROM sized GROUP BY conv_id""",
    "op8_line_runs": r"""
        WITH lines AS (
            SELECT doc_id, len(string_split(coalesce(text, ''), chr(10))) AS n, unnest(string_split(coalesce(text, ''), chr(10))) AS line,
                   generate_subscripts(string_split(coalesce(text, ''), chr(10)), 1) AS pos
            FROM documents),
        keyed AS (
            SELECT *, translate(trim(line, ' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)),
                                'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS key
            FROM lines),
        often AS (
            SELECT key, max(doc_id) AS last FROM keyed WHERE length(key) >= 40 GROUP BY key HAVING count(DISTINCT doc_id) >= 5)
        SELECT doc_id, any_value(n) AS n_lines, count(*) FILTER (last IS NOT NULL AND doc_id <> last) AS n_dropped,
               sha256(coalesce(string_agg(line, chr(10) ORDER BY pos) FILTER (last IS NULL OR doc_id = last), '')) AS kept_sha256
        FROM keyed LEFT JOIN often USING (key) GROUP BY doc_id""",
}
