"""Token links and whitening beside plain versions."""

from __future__ import annotations

import hashlib
import random
from collections import Counter

import numpy as np
import pytest
from sentencepiece import SentencePieceProcessor
from tokenizers import Tokenizer

from stallweave.llm import token_links, whitening
from stallweave.llm.queries import QUERIES

SF = "/root/testdata/sf0.01"


@pytest.fixture(scope="module")
def words():
    with open(token_links.BYTE_VOCABULARY, "rb") as a, open(token_links.PIECE_VOCABULARY, "rb") as b:
        return token_links.Vocabularies(a.read(), b.read())


def plain_ids(text):
    """Both encodings by the libraries alone, as (id, start, end) in bytes of a space and the text."""
    a_tokenizer = Tokenizer.from_file(token_links.BYTE_VOCABULARY)
    a_tokenizer.encode_special_tokens = True
    b_tokenizer = SentencePieceProcessor(model_file=token_links.PIECE_VOCABULARY)
    alphabet = token_links.byte_alphabet()

    def both(text):
        sides = []
        data = (" " + text).encode()
        a = a_tokenizer.encode(" " + text, add_special_tokens=False).ids
        a_parts = [bytes(alphabet[c] for c in a_tokenizer.id_to_token(i)) for i in a]
        b = b_tokenizer.encode(text)
        b_parts = [bytes([int(b_tokenizer.id_to_piece(i)[3:5], 16)]) if b_tokenizer.is_byte(i) else b_tokenizer.id_to_piece(i).replace("▁", " ").encode() for i in b]
        if not text or b"".join(a_parts) != data or b"".join(b_parts) != data:
            return [], []
        for ids, parts in ((a, a_parts), (b, b_parts)):
            at, side = 0, []
            for i, part in zip(ids, parts):
                side.append((i, at, at + len(part)))
                at += len(part)
            sides.append(side)
        return sides

    return both(text) if text else ([], [])


def plain_scores(rows):
    """All pairs of tokens compared; counts over all rows."""
    links, groups = [], []
    for _, text in rows:
        a, b = plain_ids(text)
        links.append([(x[0], y[0]) for x in a for y in b if x[1] < y[2] and y[1] < x[2]])
        ends = sorted({x[2] for x in a} & {y[2] for y in b})
        starts = [0, *ends[:-1]]
        groups.append([([x[0] for x in a if s <= x[1] < e], [y[0] for y in b if s <= y[1] < e]) for s, e in zip(starts, ends)])
    count = Counter(p for doc in links for p in doc)
    best = {}
    for (_, b), n in count.items():
        best[b] = max(best.get(b, 0), n)
    out = []
    for (doc, _), own, parts in zip(rows, links, groups):
        text = ";".join(",".join(map(str, a)) + "|" + ",".join(map(str, b)) for a, b in parts)
        out.append((
            doc, sum(len(a) for a, _ in parts), sum(len(b) for _, b in parts), len(parts), len(own),
            sum(count[p] == best[p[1]] for p in own), sum(count[p] for p in own), hashlib.sha256(text.encode()).hexdigest() if text else "",
        ))
    return sorted(out, key=str)


ODD = [
    "", None, " ", "\n\t q ", "a", "▁x", "naïve é́ ﬁ ① ​﻿x", "<s> </s> <unk> <0x41> <|endoftext|>", "\0\x1f", "日本語のテキスト", "𝒳𝒴 😀😀",
    "don't can't WE'LL", "-" * 300, "a" * 999, "9" * 257, "\r\n\r\n  x  \n", "text " * 40,
]


@pytest.mark.parametrize("chunk_bytes", [1, 300, 8 << 20])
def test_links_match_plain_version(spark, documents, chunk_bytes):
    rng = random.Random(chunk_bytes)
    pool = ["the", "an alignment", "tokenization", "Grüße", "été", "123456", "<unk>", "  ", "\n", "http://x.y/z?q=1", "ﬁn", "漢字", "…", "''"]
    rows = list(enumerate([*ODD, *("".join(rng.choices([*pool, " "], k=rng.randint(1, 60))) for _ in range(25))])) + [(3, "again"), (None, "again"), (None, None)]
    got = token_links.score_links(documents(rows, chunk="c", codes=1, groups="g"), chunk_bytes=chunk_bytes)
    assert sorted(map(tuple, got.collect()), key=str) == plain_scores(rows)


def test_links_over_sample_add_up(spark):
    """Over the whole table: every token is in a link, counts of links add up from both sides, digests are those of ``align``."""
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    got = QUERIES["op11_token_links"](spark, SF).toPandas().set_index("doc_id")
    assert len(got) == docs.count() and got.columns.tolist() == ["n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256"]
    assert (got.n_links == got.n_a + got.n_b - got.n_groups).all() and (got.n_best <= got.n_links).all()
    listed = token_links.align(docs).toPandas().set_index("doc_id")
    for groups in listed.groups.head(40):
        for group in groups.split(";") if groups else []:
            a, b = (side.split(",") for side in group.split("|"))
            assert len(a) and len(b)
    assert listed.groups.map(lambda g: hashlib.sha256(g.encode()).hexdigest() if g else "").equals(got.groups_sha256.loc[listed.index])
    one = listed.groups.str.contains("|", regex=False)
    assert (got.n_groups.loc[listed.index][one] == listed.groups[one].str.count(";") + 1).all()


def test_links_of_empty_table(spark, documents):
    got = token_links.score_links(documents([(1, "x")]).limit(0))
    assert got.count() == 0 and token_links.align(documents([(1, None)])).collect()[0][1:] == (0, 0, 0, 0, "")


def test_quick_encoder_is_the_library(words):
    """The quicker encoder stands for the library: on every code point in several surroundings, and only for such vocabularies."""
    assert words.quick is not None
    texts = [f"a{chr(c)}1{chr(c)}.{chr(c)} {chr(c)}{chr(c)} b" for c in [*range(0x3000), *range(0x3000, 0x110000, 97)] if not 0xD800 <= c < 0xE000]
    texts += [" " * n + "x" * m for n in (0, 1, 2, 500) for m in (0, 1, 800)]
    slow = [x.ids for x in words.a.encode_batch_fast([" " + t for t in texts], add_special_tokens=False)]
    assert words.encode_a(texts) == slow
    blank = " " * 300_000 + "x"
    assert words.encode_a([blank])[0] == words.a.encode(" " + blank, add_special_tokens=False).ids
    with open(token_links.BYTE_VOCABULARY) as file:
        text = file.read()
    assert token_links.ranked(text.replace('"use_regex": true', '"use_regex": false').replace('"use_regex":true', '"use_regex":false'), words.a, words.a_bytes) is None


def test_gallop_finds_first_place():
    rng = np.random.default_rng(1)
    for n in (1, 2, 7, 500):
        ends = np.unique(rng.integers(1, 5 * n + 2, n))
        targets = rng.integers(-3, ends[-1] + 1, 40)
        for guess in (np.zeros(40, np.int64), rng.integers(-5, 2 * n, 40), np.full(40, 10**6)):
            assert (token_links.gallop(targets, ends, guess) == np.searchsorted(ends, targets)).all()


def test_packed_numbers_return():
    for numbers in ([], [0], [1, 255, 256, 2**32 - 1, 7]):
        assert token_links.unpacked(token_links.packed(np.array(numbers, np.int64))).tolist() == numbers


# Whitening.

VECTORS = "vec_id long, embedding array<float>, label int, x string, key int"


def plain_whitening(vectors, components):
    x = np.floor(64 * np.array(vectors, np.float64)).astype(np.int64) + 1_000_000
    n, sums = len(x), x.sum(axis=0)
    values, vectors = np.linalg.eigh(np.cov(((x * n - sums) / n).T, bias=True).reshape(x.shape[1], -1))
    order = np.argsort(-values)[:components]
    values, vectors, trace = values[order], vectors[:, order], values.sum()
    return ((x * n - sums) ** 2).sum(axis=1), ((x * n - sums) / n) @ vectors / np.sqrt(values), values / trace, vectors


def as_table(spark, vectors, ids=None):
    return spark.createDataFrame([(i if ids is None else ids[i], None if v is None else list(map(lambda c: None if c is None else float(c), v)), 1, "a", 2) for i, v in enumerate(vectors)], VECTORS)


@pytest.mark.parametrize("n,dims,components", [(400, 9, 4), (60, 12, 32), (50, 1, 3)])
def test_whitening_matches_eigenvectors(spark, n, dims, components):
    rng = np.random.default_rng(n)
    # The same single-precision numbers as the table holds.
    good = (rng.standard_normal((n, dims)) * np.linspace(3, 0.5, dims)).astype(np.float32)
    deviation, whitened, explained, _ = plain_whitening(good, components)
    bad = [None, [], [None] * dims, [float("nan")] * dims, [float("inf")] + [0.0] * (dims - 1), [1.0] * (dims + 1)]
    got = whitening.whiten(as_table(spark, [*good, *bad]), components).toPandas()
    k = min(dims, components)
    assert len(got) == n * k and set(got.n) == {n}
    table = got.pivot(index="vec_id", columns="component", values="whitened")
    signs = np.sign((table.values * whitened).sum(axis=0))
    assert table.index.tolist() == list(range(n)) and np.abs(table.values * signs - whitened).max() < 1e-9
    first = got[got.component == 1].sort_values("vec_id")
    assert first.deviation.tolist() == deviation.tolist()
    assert np.abs(got[got.vec_id == 0].sort_values("component").explained.values / explained - 1).max() < 1e-12
    assert got.identity_error.nunique() == 1 and got.identity_error[0] < 1e-12


def test_whitening_of_equal_eigenvalues_and_lost_dimensions(spark):
    """Four equal eigenvalues need fresh starts; a constant and a repeated dimension have no variance of their own."""
    corners = [[s * (d == k) for d in range(4)] for k in range(4) for s in (1.0, -1.0)]
    got = whitening.whiten(as_table(spark, [[*c, 7.0, c[0]] for c in corners]), 6).toPandas()
    x = np.floor(64 * np.array([[*c, 7.0, c[0]] for c in corners])) + 1_000_000
    centred = x - x.mean(axis=0)
    assert sorted(set(got.component)) == [1, 2, 3, 4] and got.identity_error[0] < 1e-12
    w = got.pivot(index="vec_id", columns="component", values="whitened").values
    # Whitened rows of all variance: the same products whatever basis an eigenspace has.
    assert np.allclose(w @ w.T, centred @ np.linalg.pinv(centred.T @ centred / 8) @ centred.T)
    assert np.allclose(got[got.vec_id == 0].sort_values("component").explained, [0.4, 0.2, 0.2, 0.2])


def test_whitening_of_few_rows(spark):
    empty = as_table(spark, [[1.0, 2.0]]).limit(0)
    columns = ["vec_id", "component", "n", "deviation", "whitened", "explained", "identity_error"]
    for table in (empty, as_table(spark, [None, []]), as_table(spark, [[1.0, 2.0]]), as_table(spark, [[1.0, 2.0]] * 5)):
        got = whitening.whiten(table)
        assert got.columns == columns and got.count() == 0
    # Repeated rows, null ids: two different vectors span one dimension.
    got = whitening.whiten(as_table(spark, [[0.0, 0.0], [1.0, 1.0], [1.0, 1.0], [1.0, 1.0]], ids=[None, 1, 1, 1])).toPandas()
    assert len(got) == 4 and set(got.component) == {1} and got.vec_id.isna().sum() == 1 and abs(got.explained[0] - 1) < 1e-12


def test_whitening_of_sizes_beyond_64_bits(spark):
    with pytest.raises(OverflowError):
        whitening.whiten(as_table(spark, [[1e17], [-1e17], [0.0]]))


def test_whitening_over_sample(spark):
    got = QUERIES["op13_whitening"](spark, SF).toPandas()
    vectors = np.array([r[0] for r in spark.read.parquet(f"{SF}/embeddings.parquet").orderBy("vec_id").select("embedding").collect()], np.float64)
    deviation, whitened, explained, _ = plain_whitening(vectors, 32)
    table = got.pivot(index="vec_id", columns="component", values="whitened")
    assert np.abs(np.abs(table.values) - np.abs(whitened)).max() < 1e-8
    assert got[got.component == 7].sort_values("vec_id").deviation.tolist() == deviation.tolist()
    assert np.allclose(got[got.vec_id == 0].sort_values("component").explained, explained, rtol=1e-10)
