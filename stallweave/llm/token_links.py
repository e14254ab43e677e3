"""Alignment of two tokenizations of the same texts by galloping intersection of their token ends.

Both tokenizers must give back the bytes of a space and the text; then the places where a token of each ends are two
ascending lists.  The shorter list drives: every end of it looks for its place in the longer one, from the place its rank
suggests, by steps that double until they pass it and by halving what lies between.  Ends found in both lists cut the
tokens into groups; the difference of two neighbouring places is the range of tokens that overlap the one between.

Links of all documents are counted per pair of ids.  Tasks work on chunks of bounded bytes and send each pair once for
a chunk, so counting and reading the counts back shuffle rows in proportion to the distinct pairs of chunks, whatever
document or pair is frequent.  Documents keep their own links as places in their chunk's list of pairs.
"""

from __future__ import annotations

import hashlib
import json
import os
import re
from collections.abc import Iterator

import numpy as np
import public_tokenizers
import pyarrow as pa
import tiktoken
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from sentencepiece import SentencePieceProcessor
from tokenizers import Tokenizer

from stallweave.llm.tables import per_worker, slices, stored

BYTE_VOCABULARY = public_tokenizers.path("byte_bpe_50k.json")
PIECE_VOCABULARY = public_tokenizers.path("piece_bpe_32k.model")
#: Characters that a library encodes in one call; its objects take far more than the text.
CALL_CHARS = 1 << 18
#: The quicker library's scanner gives up on longer runs of blanks.
_LONG_BLANK = re.compile(r"\s{10000}")


def byte_alphabet() -> dict[str, int]:
    """The printable stand-ins of byte-level vocabularies: printable bytes stand for themselves, the others follow from 256."""
    printable = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    rest = [b for b in range(256) if b not in printable]
    return {chr(b): b for b in printable} | {chr(256 + k): b for k, b in enumerate(rest)}


def ranked(text: str, tokenizer: Tokenizer, bytes_of: list[bytes]) -> tiktoken.Encoding | None:
    """The same encoder in the library that is four times as quick, where both rules are surely one; else None.

    One merges the neighbours with the first rule, the other those whose union has the least id.  Both choose alike if
    the merges make their entries in the order of the ids and every entry's own encoding is itself: neighbours whose
    union is an entry are then its one merge, since the entry is reached through them.
    """
    spec = json.loads(text)
    model, split = spec["model"], spec.get("pre_tokenizer") or {}
    plain_split = split.get("type") == "ByteLevel" and split.get("use_regex", True) and not split.get("add_prefix_space")
    plain_model = not any(model.get(k) for k in ("dropout", "continuing_subword_prefix", "end_of_word_suffix", "ignore_merges", "byte_fallback"))
    if spec.get("normalizer") or not plain_split or not plain_model or not all(t["special"] for t in spec.get("added_tokens", [])):
        return None
    vocabulary = model["vocab"]
    made = [vocabulary["".join(m if isinstance(m, list) else m.split(" "))] for m in model["merges"]]
    if made != sorted(set(made)) or len(made) + 256 != len(vocabulary):
        return None
    if any([t.id for t in tokenizer.model.tokenize(entry)] != [i] for entry, i in vocabulary.items()):
        return None
    return tiktoken.Encoding("ranked", pat_str=public_tokenizers.PATTERN, mergeable_ranks={bytes_of[i]: i for i in vocabulary.values()}, special_tokens={})


class Vocabularies:
    """Both tokenizers and what their ids mean."""

    def __init__(self, byte_file: bytes, piece_file: bytes):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        text = byte_file.decode()
        self.a = Tokenizer.from_str(text)
        self.a.encode_special_tokens = True
        self.b = SentencePieceProcessor(model_proto=piece_file)
        alphabet = byte_alphabet()
        entries = self.a.get_vocab(with_added_tokens=True)
        added = {t["content"] for t in json.loads(text).get("added_tokens", [])}
        self.a_bytes = [b""] * (max(entries.values()) + 1)
        for entry, i in entries.items():
            self.a_bytes[i] = entry.encode() if entry in added else bytes(alphabet[c] for c in entry)
        self.quick = ranked(text, self.a, self.a_bytes)
        pieces = [self.b.id_to_piece(i) for i in range(self.b.vocab_size())]
        self.b_bytes = [bytes([int(p[3:-1], 16)]) if self.b.is_byte(i) else p.replace("▁", " ").encode() for i, p in enumerate(pieces)]
        self.a_sizes = np.array([len(x) for x in self.a_bytes], np.int64)
        self.b_sizes = np.array([len(x) for x in self.b_bytes], np.int64)
        a_names, b_names = ([str(i) for i in range(len(x))] for x in (self.a_bytes, self.b_bytes))
        #: Ids as text before a comma and, at the end of a group's side, before the mark that follows it.
        self.names = [n + mark for names, last in ((a_names, "|"), (b_names, ";")) for n in names for mark in (",", last)]

    def encode(self, texts: list[str]) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        """Ids of each text by both; none where the tokens' bytes are not those of a space and the text."""
        none = np.empty(0, np.int64)
        for start, end in calls([len(t) for t in texts]):
            some = texts[start:end]
            for text, a, b in zip(some, self.encode_a(some), self.b.encode(some, num_threads=1)):
                data = b" " + text.encode()
                if text and b"".join(map(self.a_bytes.__getitem__, a)) == data == b"".join(map(self.b_bytes.__getitem__, b)):
                    yield np.array(a, np.int64), np.array(b, np.int64)
                else:
                    yield none, none

    def encode_a(self, texts: list[str]) -> list[list[int]]:
        if self.quick is None or any(len(t) >= 10_000 and _LONG_BLANK.search(t) for t in texts):
            return [x.ids for x in self.a.encode_batch_fast([" " + t for t in texts], add_special_tokens=False)]
        return [self.quick.encode_ordinary(" " + t) for t in texts]


def calls(sizes: list[int]) -> Iterator[tuple[int, int]]:
    """Ranges of texts of about ``CALL_CHARS`` characters, at least one text each."""
    start = total = 0
    for i, size in enumerate(sizes):
        if i > start and total + size > CALL_CHARS:
            yield start, i
            start = i
            total = 0
        total += size
    if start < len(sizes):
        yield start, len(sizes)


def gallop(targets: np.ndarray, ends: np.ndarray, guess: np.ndarray) -> np.ndarray:
    """First place of ``ends`` (ascending, the last no smaller than any target) not below each target.

    All targets step together: from their guesses up or down by 1, 2, 4 ... until the target is passed, then by halves.
    """
    top = len(ends) - 1
    high = np.clip(guess, 0, top)
    low = high.copy()
    below = ends[high] < targets
    live, step = np.flatnonzero(below), 1
    while len(live):
        low[live] = high[live] + 1
        high[live] = np.minimum(high[live] + step, top)
        live, step = live[ends[high[live]] < targets[live]], 2 * step
    live, step = np.flatnonzero(~below), 1
    while len(live):
        high[live] = low[live]
        low[live] = np.maximum(low[live] - step, 0)
        live, step = live[(ends[low[live]] >= targets[live]) & (low[live] > 0)], 2 * step
    live = np.flatnonzero(low < high)
    while len(live):
        middle = (low[live] + high[live]) >> 1
        passed = ends[middle] >= targets[live]
        high[live] = np.where(passed, middle, high[live])
        low[live] = np.where(passed, low[live], middle + 1)
        live = live[low[live] < high[live]]
    return high


def runs(counts: np.ndarray) -> np.ndarray:
    """0, 1, ... count - 1 for each count, one after the other."""
    return np.arange(counts.sum()) - np.repeat(np.cumsum(counts) - counts, counts)


class Cut:
    """Groups and links of several documents, laid end to end, of which one side never has more tokens than the other."""

    def __init__(self, short: list[np.ndarray], long: list[np.ndarray], short_sizes: np.ndarray, long_sizes: np.ndarray):
        self.short, self.long = np.concatenate(short), np.concatenate(long)
        n_short, n_long = (np.array([len(x) for x in side], np.int64) for side in (short, long))
        short_ends, long_ends = np.cumsum(short_sizes[self.short]), np.cumsum(long_sizes[self.long])
        scaled = runs(n_short) * np.repeat(n_long / n_short, n_short)
        places = gallop(short_ends, long_ends, np.repeat(np.cumsum(n_long) - n_long, n_short) + scaled.astype(np.int64))
        #: Whether a token's end is one of the other side, too.
        self.short_common = long_ends[places] == short_ends
        self.long_common = np.zeros(len(self.long), bool)
        self.long_common[places[self.short_common]] = True
        first = np.r_[0, places[:-1] + self.short_common[:-1]]
        overlap = places - first + 1
        #: Links as places in both sides, and their number for each document.
        self.link_short = np.repeat(np.arange(len(self.short)), overlap)
        self.link_long = np.repeat(first, overlap) + runs(overlap)
        starts = np.cumsum(n_short) - n_short
        self.n_links = np.add.reduceat(overlap, starts)
        self.n_groups = np.add.reduceat(self.short_common.astype(np.int64), starts)


def listed(a: np.ndarray, b: np.ndarray, a_common: np.ndarray, b_common: np.ndarray, size_a: int) -> np.ndarray:
    """Places in ``Vocabularies.names`` of all tokens, group by group, those of ``a`` first."""
    a_to, b_to = np.flatnonzero(a_common) + 1, np.flatnonzero(b_common) + 1
    out = np.empty(len(a) + len(b), np.int64)
    before = np.r_[0, b_to]
    out[np.arange(len(a)) + before[np.cumsum(a_common) - a_common]] = 2 * a + a_common
    out[np.arange(len(b)) + a_to[np.cumsum(b_common) - b_common]] = 2 * (size_a + b) + b_common
    return out


def packed(numbers: np.ndarray) -> bytes:
    """Little-endian unsigned 32-bit numbers, first bytes first, so that the many empty high bytes lie together."""
    return numbers.astype("<u4").view(np.uint8).reshape(-1, 4).T.tobytes()


def unpacked(data: bytes) -> np.ndarray:
    return np.frombuffer(np.frombuffer(data, np.uint8).reshape(4, len(data) // 4).T.tobytes(), "<u4").astype(np.int64)


def aligned_chunk(texts: list[str | None], words: Vocabularies) -> tuple[list[tuple], np.ndarray, np.ndarray]:
    """(n_a, n_b, n_groups, n_links, groups, places, times) for each text; the chunk's sorted pair codes and how often each is linked."""
    ids = list(words.encode([t or "" for t in texts]))
    rows: list[tuple] = [(0, 0, 0, 0, "", b"", b"")] * len(texts)
    owners, codes, told = [], [], {}
    size_a, size_b = len(words.a_bytes), len(words.b_bytes)
    for a_drives in (True, False):
        docs = [i for i, (a, b) in enumerate(ids) if len(a) and (len(a) <= len(b)) == a_drives]
        if not docs:
            continue
        sides = [ids[i][0] for i in docs], [ids[i][1] for i in docs]
        if a_drives:
            cut = Cut(*sides, words.a_sizes, words.b_sizes)
            a, b, a_common, b_common, a_at, b_at = cut.short, cut.long, cut.short_common, cut.long_common, cut.link_short, cut.link_long
        else:
            cut = Cut(*sides[::-1], words.b_sizes, words.a_sizes)
            a, b, a_common, b_common, a_at, b_at = cut.long, cut.short, cut.long_common, cut.short_common, cut.link_long, cut.link_short
        owners.append(np.repeat(np.array(docs, np.int64), cut.n_links))
        codes.append(a[a_at] * size_b + b[b_at])
        names, at = listed(a, b, a_common, b_common, size_a), 0
        for i, n_groups, n_links in zip(docs, cut.n_groups.tolist(), cut.n_links.tolist()):
            n_a, n_b = map(len, ids[i])
            groups = "".join(map(words.names.__getitem__, names[at : at + n_a + n_b].tolist()))[:-1]
            at += n_a + n_b
            told[i] = (n_a, n_b, n_groups, n_links, groups)
    if not told:
        return rows, np.empty(0, np.int64), np.empty(0, np.int64)
    owner, code = np.concatenate(owners), np.concatenate(codes)
    pairs, place, times = np.unique(code, return_inverse=True, return_counts=True)
    own, own_times = np.unique(owner * len(pairs) + place, return_counts=True)
    begins = np.searchsorted(own, np.arange(len(texts) + 1) * len(pairs))
    for i, numbers in told.items():
        part = slice(begins[i], begins[i + 1])
        rows[i] = (*numbers, packed(np.diff(own[part] - i * len(pairs), prepend=0)), packed(own_times[part]))
    return rows, pairs, times


def alignments(docs: DataFrame, a_path: str, b_path: str, chunk_bytes: int) -> DataFrame:
    """One row for each document, and one with ``codes`` and ``counts`` for each chunk of them."""
    with open(a_path, "rb") as a_file, open(b_path, "rb") as b_file:
        files = a_file.read(), b_file.read()
    shared = docs.sparkSession.sparkContext.broadcast(files)
    digest = hashlib.sha256(files[0] + files[1]).hexdigest()
    kind = docs.schema["doc_id"].dataType.simpleString()
    long, longs, binary = pa.int64(), pa.list_(pa.int64()), pa.binary()

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words = per_worker(f"token links {digest}", lambda: Vocabularies(*shared.value))
        partition = TaskContext.get().partitionId()
        for number, batch in enumerate(slices(batches, chunk_bytes)):
            rows, pairs, times = aligned_chunk(batch.column("text").to_pylist(), words)
            columns = list(zip(*rows)) if rows else [()] * 7
            here = pa.array([(partition << 32) + number] * (len(rows) + 1), long)
            ids = batch.column("doc_id")
            own = [pa.array(c, t) for c, t in zip(columns, (long, long, long, long, pa.string(), binary, binary))]
            empty = [pa.nulls(1, x.type) for x in own]
            yield pa.RecordBatch.from_arrays(
                [
                    here, pa.concat_arrays([ids, pa.nulls(1, ids.type)]), *[pa.concat_arrays([x, e]) for x, e in zip(own, empty)],
                    pa.concat_arrays([pa.nulls(len(rows), longs), pa.array([pairs], longs)]),
                    pa.concat_arrays([pa.nulls(len(rows), longs), pa.array([times], longs)]),
                ],
                ["chunk", "doc_id", "n_a", "n_b", "n_groups", "n_links", "groups", "places", "times", "codes", "counts"],
            )

    schema = f"chunk long, doc_id {kind}, n_a long, n_b long, n_groups long, n_links long, groups string, places binary, times binary, codes array<long>, counts array<long>"
    return docs.select("doc_id", "text").mapInArrow(work, schema)


def align(docs: DataFrame, a_path: str = BYTE_VOCABULARY, b_path: str = PIECE_VOCABULARY, chunk_bytes: int = 2 << 20) -> DataFrame:
    """doc_id, n_a, n_b, n_groups, n_links, groups for every row of ``docs`` (doc_id, text; other columns ignored).

    ``groups`` lists the ids of both tokenizations between common ends, ``a1,a2|b1;a3|b2,b3``.  A text that is null, empty or
    not given back byte by byte by both tokenizers has no tokens: zeros and ''.  Repeated rows and null doc_ids are rows like
    others; an empty table gives an empty result.  A task's memory follows its chunk, or the longest text.
    """
    rows = alignments(docs, a_path, b_path, chunk_bytes).where("codes IS NULL")
    return rows.select("doc_id", "n_a", "n_b", "n_groups", "n_links", "groups")


def link_counts(pairs: DataFrame, size_b: int) -> DataFrame:
    """code, count, best (whether no other pair of the same second id has more) of all ``pairs`` (code, times)."""
    counted = pairs.groupBy("code").agg(F.sum("times").alias("count"))
    highest = counted.groupBy(F.pmod("code", F.lit(size_b)).alias("b")).agg(F.max("count").alias("highest"))
    return counted.join(highest, F.pmod("code", F.lit(size_b)) == F.col("b")).select("code", "count", (F.col("count") == F.col("highest")).alias("best"))


def score_links(docs: DataFrame, a_path: str = BYTE_VOCABULARY, b_path: str = PIECE_VOCABULARY, chunk_bytes: int = 2 << 20) -> DataFrame:
    """doc_id, n_a, n_b, n_groups, n_links, n_best, count_sum, groups_sha256 for every row of ``docs``.

    A pair's count is the number of its links in all rows together; n_best counts the document's links whose pair has the
    highest count of its second id, count_sum adds up the counts of its links.  ``groups_sha256`` is the digest of ``align``'s
    ``groups``, '' without tokens.  Nulls, empty texts and tables as in ``align``.
    """
    size_b = SentencePieceProcessor(model_file=b_path).vocab_size()
    rows = alignments(docs, a_path, b_path, chunk_bytes).withColumn("groups", F.when(F.col("groups") != "", F.sha2("groups", 256)).otherwise(F.col("groups")))
    rows, _ = stored(rows, "token-links")
    listed_pairs = rows.where("codes IS NOT NULL").select("chunk", F.posexplode(F.arrays_zip("codes", "counts")).alias("place", "pair"))
    pairs = listed_pairs.select("chunk", "place", F.col("pair.codes").alias("code"), F.col("pair.counts").alias("times"))
    counted = link_counts(pairs, size_b)
    # A chunk's prices in the order of its list, one row for each chunk.
    priced = pairs.join(counted, "code").groupBy("chunk").agg(F.sort_array(F.collect_list(F.struct("place", "count", "best"))).alias("prices"))
    priced = priced.select(F.col("chunk").alias("of_chunk"), F.col("prices.count").alias("price"), F.col("prices.best").alias("best"))
    own = rows.where("codes IS NULL").select("chunk", "doc_id", "n_a", "n_b", "n_groups", "n_links", F.col("groups").alias("groups_sha256"), "places", "times")

    def summed(left: pa.Table, right: pa.Table) -> pa.Table:
        price = right.column("price").combine_chunks().flatten().to_numpy()
        best = right.column("best").combine_chunks().flatten().to_numpy(zero_copy_only=False)
        n_best, total = [], []
        for places, times in zip(left.column("places").to_pylist(), left.column("times").to_pylist()):
            at, n = np.cumsum(unpacked(places)), unpacked(times)
            n_best.append(int(n[best[at]].sum()))
            total.append(int((n * price[at]).sum()))
        named = left.select(["doc_id", "n_a", "n_b", "n_groups", "n_links"]).append_column("n_best", pa.array(n_best, pa.int64())).append_column("count_sum", pa.array(total, pa.int64()))
        return named.append_column("groups_sha256", left.column("groups_sha256"))

    kind = docs.schema["doc_id"].dataType.simpleString()
    schema = f"doc_id {kind}, n_a long, n_b long, n_groups long, n_links long, n_best long, count_sum long, groups_sha256 string"
    return own.groupBy("chunk").cogroup(priced.groupBy("of_chunk")).applyInArrow(summed, schema)
