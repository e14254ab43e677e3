"""Language, toxicity, lines, secrets and tokens beside plain versions."""

from __future__ import annotations

import hashlib
import random
import re
import zlib

import numpy as np
import public_tokenizers
import pytest
import tiktoken

from stallweave.llm import bpe_tree, language_filters, line_runs, secret_ledger, toxic_lexicon
from stallweave.llm.queries import QUERIES

SF = "/root/testdata/sf0.01"
STRIP = " \t\n\x0b\x0c\r"


def lower(text):
    return "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text)


# Line dedup.


def plain_dedup(rows, least, docs):
    holders = {}
    for doc, text in rows:
        for line in (text or "").split("\n"):
            key = lower(line.strip(STRIP))
            if doc is not None and len(key) >= least:
                holders.setdefault(key, set()).add(doc)
    out = []
    for doc, text in rows:
        lines = (text or "").split("\n")
        kept = [x for x in lines if doc is None or len(holders.get(lower(x.strip(STRIP)), ())) < docs or max(holders[lower(x.strip(STRIP))]) == doc]
        out.append((doc, "\n".join(kept), len(lines), len(lines) - len(kept)))
    return sorted(out, key=str)


@pytest.mark.parametrize("batches,fan", [(1, 2), (4, 2), (5, 3)])
def test_lines_match_plain_version(spark, documents, batches, fan):
    rng = random.Random(batches)
    pool = [f"É{'x' * rng.randint(0, 4)} line {i % 7}" for i in range(9)] + ["", "  ", "\tEnd Line 3 \r", "end line 3", "É line 1", "é line 1"]
    rows = [(i, "\n".join(rng.choices(pool, k=rng.randint(1, 8)))) for i in range(60)] + [(None, "end line 3\nend line 3"), (3, "end line 3"), (70, None), (71, ""), (72, "\n")]
    got = line_runs.dedup_lines(documents(rows, h1=1, key="k", batch=2), min_chars=5, min_docs=3, batches=batches, fan=fan)
    assert sorted(map(tuple, got.select("doc_id", "text", "n_lines", "n_dropped").collect()), key=str) == plain_dedup(rows, 5, 3)


def test_lines_stage_keeps_columns(spark, documents):
    rows = [(i, "a shared line of some length\nown " + str(i), "en") for i in range(5)] + [(9, None, None), (9, None, None)]
    docs = documents(rows, key="k", pos=1)
    got = line_runs.without_repeated_lines(docs, min_chars=10)
    assert got.columns == docs.columns and got.count() == 7
    texts = {r["doc_id"]: (r["text"], r["n_chars"]) for r in got.collect()}
    assert texts[0] == ("own 0", 5) and texts[4][0].startswith("a shared") and texts[9] == (None, None)
    assert line_runs.dedup_lines(docs.limit(0)).count() == 0


# Secrets.


def plain_spans(text):
    out = []
    for rank, rule in enumerate(secret_ledger.RULES):
        pattern = re.compile(rule.pattern, re.A) if rule.kind != "hex" else re.compile("[0-9a-f]+")
        for m in pattern.finditer(text or ""):
            if len(m[rule.group]) >= max(rule.least, 16 if rule.kind == "hex" else 1):
                out.append((m.start(), rank, rule.kind, m.end()))
    return sorted(out)


SECRETS = [
    'x token = "f231efbfd1fdb295f161be24c505140eae764acc" y', "AKIAABCDEFGHIJKLMN and AKIASHORT", "token=secret:abcdefghijklmnop", "😀é PASSWORD:'aaaaaaaaaaaa' api-key api_key=\"0123456789abcdef\"",
    "-----BEGIN RSA PRIVATE KEY----- eyJabcdefgh.eyJabcdefgh.abcdefgh_-", "ghp_" + "a" * 36, "", None, "deadbeef" * 3 + " " + "deadbeef" * 2 + "g", "plain words only",
]


def test_secrets_match_plain_version(spark, documents):
    rows = list(enumerate(SECRETS)) + [(100, SECRETS[0]), (100, SECRETS[0]), (None, SECRETS[1])]
    got = secret_ledger.scan_secrets(documents(rows, blob="b", rank=1, end=2)).collect()
    assert len(got) == len(rows)
    for row in got:
        texts = [t for d, t in rows if d == row["path"]]
        assert [tuple(s) for s in row["spans"]] == plain_spans(texts[0])
        assert row["blob"] == hashlib.sha256((texts[0] or "").encode()).hexdigest()


def test_repeated_smallest_paths_are_scanned_once(spark, documents):
    rows = [(0, SECRETS[0]), (0, SECRETS[0]), (7, SECRETS[0]), (None, SECRETS[1]), (None, SECRETS[1]), (3, SECRETS[3]), (3, SECRETS[3]), (3, SECRETS[3])]
    texts = {hashlib.sha256(t.encode()).hexdigest(): t for _, t in rows}
    got = secret_ledger.scan_secrets(documents(rows)).collect()
    assert len(got) == len(rows) and {r["blob"] for r in got} == set(texts)
    for row in got:
        assert [tuple(s) for s in row["spans"]] == plain_spans(texts[row["blob"]])


def test_ledger_scans_each_pair_once(spark, documents, tmp_path):
    ledger, first, later = str(tmp_path / "ledger"), documents(list(enumerate(SECRETS))), documents([(50, SECRETS[0]), (51, "new token: abcdefghijkl")])
    secret_ledger.scan_unseen(first.withColumnRenamed("doc_id", "path"), ledger)
    marks = lambda: spark.read.schema(secret_ledger.SCANNED).parquet(f"{ledger}/scanned")
    before = marks().count()
    secret_ledger.scan_unseen(later.withColumnRenamed("doc_id", "path"), ledger)
    assert marks().count() == before + len(secret_ledger.RULES)
    assert marks().groupBy("blob", "rule").count().where("count > 1").count() == 0
    newer = secret_ledger.BASE_RULES[:2] + (secret_ledger.Rule("hex", "[0-9a-f]{16,}", 0, 16, version=2),)
    secret_ledger.scan_unseen(later.withColumnRenamed("doc_id", "path"), ledger, newer)
    assert marks().where("rule = 'hex@2'").count() == 2
    got = {r["path"]: r["spans"] for r in secret_ledger.findings(later.withColumnRenamed("doc_id", "path"), ledger).collect()}
    assert len(got[50]) == 2 and len(got[51]) == 1
    assert secret_ledger.scan_secrets(later.limit(0)).count() == 0


def test_secret_query_has_no_python(spark):
    plan = QUERIES["op7_secret_ledger"](spark, "/root/testdata/sf0.001")._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Arrow" not in plan


# Tokens.


@pytest.fixture(scope="module")
def library():
    with open(bpe_tree.RANKS, "rb") as file:
        ranks = bpe_tree.read_ranks(file.read())
    return ranks, tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})


def sample_texts():
    rng = random.Random(5)
    alphabets = ["ab", " \n\t", "aé😀 '", "'s't re ve", "0123 ab", "ñüß日本 ", "".join(map(chr, range(32, 127)))]
    out = ["", "a" * 5000, " " * 3001 + "x", "ab" * 777, "'" * 99 + "ll", "x \n \n  y", "abc'r", "é" * 50, "\x00\x01", "<|endoftext|>"]
    for alphabet in alphabets:
        out += ["".join(rng.choices(alphabet, k=rng.choice([1, 7, 60, 400]))) for _ in range(25)]
    return out


@pytest.mark.parametrize("leaf_chars,leaf_bytes", [(8, 2), (16, 5), (8192, 16)])
def test_tree_matches_library(library, leaf_chars, leaf_bytes):
    ranks, encoding = library
    coder = bpe_tree.Coder(ranks, public_tokenizers.PATTERN, leaf_chars, leaf_bytes, most=500)
    for text in sample_texts():
        ids = coder.encode(text)
        assert ids == encoding.encode_ordinary(text), text[:80]
        assert coder.decode(ids, leaf=3) == text.encode()


def test_encode_decode_table(spark, documents, library):
    texts = sample_texts()
    rows = list(enumerate(texts)) + [(1000, None), (None, "null id"), (1001, "twice"), (1001, "twice")]
    got = bpe_tree.encode_decode(documents(rows, ids="x", decoded=1)).collect()
    assert len(got) == len(rows)
    wanted = {d: t or "" for d, t in rows}
    for row in got:
        ids = np.frombuffer(row["ids"], "<u4")
        assert list(ids) == library[1].encode_ordinary(wanted[row["doc_id"]]) and row["n_tokens"] == len(ids)
        assert bytes(row["decoded"]) == wanted[row["doc_id"]].encode()
    assert bpe_tree.encode_decode(documents(rows).limit(0)).count() == 0


# Language.


def crc(doc):
    return zlib.crc32(str(doc).encode())


def test_language_of_held_out(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    rows = QUERIES["op10_language_filters"](spark, SF).join(docs.select("doc_id", "lang"), "doc_id").collect()
    assert len(rows) == docs.count()
    held = [r for r in rows if r["held_out"]]
    assert all(r["held_out"] == (crc(r["doc_id"]) % 4 == 2) and 0 <= r["score"] <= 1 for r in rows)
    assert sum(r["lang"] == r["lang_pred"] for r in held) >= 0.99 * len(held)


def test_language_edges(spark, documents):
    known = [(i, "the cat sat on the mat and the dog" if i % 2 else "der hund und die katze auf der matte", "en" if i % 2 else "de") for i in range(40)]
    odd = [(100, None, "en"), (101, "", None), (102, "12 !? 34", "de"), (103, "ΩΨ ΞΣ", None), (None, "the dog and the cat", None), (104, "the mat " * 20000, None), (105, "the cat", None), (105, "the cat", None)]
    got = language_filters.identify(documents(known + odd, lang_pred="x", score=5), least=1).collect()
    assert len(got) == 48
    by = {r["doc_id"]: r for r in got}
    assert {by[k]["lang_pred"] for k in (100, 101, 102)} == {"und"} and by[103]["lang_pred"] in ("de", "en") and by[103]["lang_score"] == 0
    assert by[None]["lang_pred"] == by[104]["lang_pred"] == by[105]["lang_pred"] == "en" and not by[None]["held_out"]
    kept = language_filters.keep_known(documents(known + odd))
    assert kept.columns == documents([]).columns and {r["doc_id"] for r in kept.collect()} == {*range(40), None, 104, 105}
    assert language_filters.identify(documents([])).count() == 0
    unlabelled = language_filters.identify(documents([(1, "some words")])).first()
    assert unlabelled["lang_pred"] == "und" and unlabelled["lang_score"] == 0


def test_filters_correct_for_chance():
    rng = np.random.default_rng(1)
    plane = (rng.random(1 << 10) < 0.5).astype(np.uint8) | 2
    filters = language_filters.Filters(["a", "b"], [plane], np.array([0.5, 1.0]), 10, 1, 0)
    h = rng.integers(0, 1 << 62, 20000, dtype=np.uint64)
    counts, total = filters.hits(h, np.zeros(20000, np.int32), 1)
    assert total[0] == 20000 and abs(counts[0, 0]) < 600 and counts[0, 1] < 1e-3 * 20000


# Toxicity.


def test_toxicity_of_held_out(spark):
    labels = spark.read.parquet(f"{SF}/labels.parquet")
    rows = QUERIES["op6_toxic_lexicon"](spark, SF).join(labels, "doc_id").collect()
    assert all(r["held_out"] == (crc(r["doc_id"]) % 5 == 0) and r["predicted"] == (r["score"] >= 0.5) and 0 <= r["score"] <= 1 for r in rows)
    held = [r for r in rows if r["held_out"]]
    assert sum(r["toxic"] == r["predicted"] for r in held) >= 0.93 * len(held)


def test_fold():
    assert toxic_lexicon.fold("1D10T! Іdіоt, ｉｄｉｏｔ é-é") == " idiot idiot idiot e e "
    assert toxic_lexicon.fold(None) == toxic_lexicon.fold("?!") == " "


def test_numbers_are_no_words():
    assert toxic_lexicon.fold("455 people paid 80085 in 2017") == " people paid in "
    assert toxic_lexicon.fold("on 12.05.2017 at 10:45, $455 or 455$!") == " on at or "
    assert toxic_lexicon.fold("4ss @55 b00k 1d10t") == " ass ass book idiot "
    lexicon = toxic_lexicon.Lexicon({"ass ": 3.0, "idio": 5.0}, frozenset(["no ass"]))
    machine = lexicon.automaton()
    weight = lambda text: lexicon.weight(machine, toxic_lexicon.fold(text))
    assert weight("an assistant came, the bill was 455 euro") == 0.0
    assert weight("you 4SS") == weight("ass") == 3.0 and weight("no ass") == 0.0 and weight("idiots ass ass") == 11.0


def test_short_words_are_learned_whole(spark, documents):
    rows = [(i, f"the ass number {i} came here today" if i % 2 else f"an assistant number {i} came here today") for i in range(400)]
    labels = spark.createDataFrame([(i, i % 2) for i in range(400)], "doc_id long, toxic int")
    got = {r["doc_id"]: r["predicted"] for r in toxic_lexicon.score_texts(documents([*rows, (1000, "assistants passed 455 assets")]), labels).collect()}
    assert all(got[i] == i % 2 for i in range(400)) and got[1000] == 0


def test_toxicity_edges(spark, documents):
    rng = random.Random(3)
    plain = lambda: " ".join(rng.choices("some plain words about the weather today with rain or sun".split(), k=6))
    rows = [(i, f"{plain()} {'wretched' if i % 4 == 0 else 'a wretched fool of' if i % 10 == 1 else 'good'} {plain()}") for i in range(400)]
    rows += [(500, None), (501, ""), (502, "WR3TCHED " * 3), (503, "a wretched fool of"), (None, "wretched person"), (504, "wretched"), (504, "wretched"), (505, "fine " * 50000)]
    labels = spark.createDataFrame([(i, int(i % 4 == 0)) for i in range(400)] + [(7, None), (None, 1), (0, 0), (900, 1)], "doc_id long, toxic int")
    got = toxic_lexicon.score_texts(documents(rows, score=1, held_out="x"), labels).collect()
    by = {r["doc_id"]: r for r in got}
    assert len(got) == len(rows) and by[500]["score"] == by[501]["score"] == by[505]["score"] == 0
    assert by[502]["predicted"] == by[504]["predicted"] == by[None]["predicted"] == 1
    assert by[503]["predicted"] == 0, "stands in a phrase that clean texts have"
    assert toxic_lexicon.score_texts(documents([]), labels).count() == 0
    assert {r["score"] for r in toxic_lexicon.score_texts(documents(rows), labels.limit(0)).collect()} == {0.0}
    assert by[500].asDict().keys() >= {"lang", "source"}
