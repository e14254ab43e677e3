"""Byte-level BPE as a tree reduction, with the vocabulary of a public rank file.

Encodings of texts form a monoid: two halves are encoded on their own and joined at the seam.

Pieces.  The pattern's scanner looks at nothing before its place and at most ``AHEAD`` characters beyond a match, so all
pieces of the left half that end ``AHEAD`` before the seam stand.  From there the text is scanned anew until a piece
ends where one of the right half ends; everything after that stands too.

Tokens of one piece.  A sequence of tokens is the encoding of its bytes exactly if every pair of neighbours is the
encoding of its own bytes.  Within the halves all pairs are; a window around the seam is encoded anew and grown until both
of its outer pairs are, which proves the rest.

Decoding joins the bytes of the two halves.
"""

from __future__ import annotations

import base64
import hashlib
import heapq
from itertools import chain

import numpy as np
import public_tokenizers
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from stallweave.llm.tables import per_worker, sliced

RANKS = public_tokenizers.path("byte_bpe_50k.tiktoken")
#: Characters beyond a match that the pattern may look at: two after an apostrophe, one after white space.
AHEAD = 2
#: What an entry of a dictionary takes besides its text and tokens.
ENTRY_BYTES = 200
#: Rank of a pair that is no token.
NEVER = 1 << 40


def read_ranks(data: bytes) -> dict[bytes, int]:
    return {base64.b64decode(token): int(rank) for token, rank in (line.split() for line in data.splitlines() if line)}


class Coder(dict):
    """Maps a piece to its tokens and keeps what it has met, in two generations, in the memory of about ``most`` short pieces.

    When the young one is full it becomes the old one, and the old one goes; pieces met again in the old one return.
    """

    def __init__(self, ranks: dict[bytes, int], pattern: str, leaf_chars: int = 8192, leaf_bytes: int = 16, most: int = 400_000):
        super().__init__()
        self.ranks, self.most_bytes = ranks, most * ENTRY_BYTES
        self.young_bytes, self.old = 0, {}
        self.bytes_of = [b""] * (max(ranks.values(), default=-1) + 1)
        for token, rank in ranks.items():
            self.bytes_of[rank] = token
        self.scan = regex.compile(pattern)
        self.leaf_chars, self.leaf_bytes = max(leaf_chars, 4 * AHEAD), leaf_bytes
        self.pairs: dict[tuple[int, int], bool] = {}

    def __missing__(self, piece: str) -> tuple[int, ...]:
        out = self.old.get(piece)
        if out is None:
            data = piece.encode("utf-8", "surrogatepass")
            rank = self.ranks.get(data)
            out = tuple(self.tokens(data)) if rank is None else (rank,)
        self.young_bytes += ENTRY_BYTES + 4 * max(0, len(piece) - 16) + 8 * len(out)
        if self.young_bytes > self.most_bytes // 2:
            self.old, self.young_bytes = dict(self), 0
            self.clear()
        self[piece] = out
        return out

    # Pieces of a text.

    def pieces(self, text: str) -> list[str]:
        if len(text) <= self.leaf_chars:
            return self.scan.findall(text)
        half = len(text) // 2
        return self.join_pieces(self.pieces(text[:half]), self.pieces(text[half:]))

    def join_pieces(self, left: list[str], right: list[str]) -> list[str]:
        loose, cut = 0, len(left)
        while cut and loose < AHEAD:
            cut -= 1
            loose += len(left[cut])
        window = "".join(left[cut:])
        # Places in ``window + right`` where a piece of the right half ends, met while the new scan goes on.
        text, taken, end = window, 0, len(window)
        ends = {end: 0}
        again: list[str] = []
        size = 64
        while True:
            while taken < len(right) and len(text) < len(window) + size:
                text += right[taken]
                taken += 1
                end += len(right[taken - 1])
                ends[end] = taken
            again, settled = [], None
            for match in self.scan.finditer(text):
                if match.end() + AHEAD > len(text) and taken < len(right):
                    break
                again.append(match.group())
                if match.end() in ends and match.end() >= len(window):
                    settled = ends[match.end()]
                    break
            if settled is not None:
                return left[:cut] + again + right[settled:]
            if taken == len(right):
                return left[:cut] + again
            size *= 2

    # Tokens of one piece.

    def merge(self, data: bytes) -> list[int]:
        """The plain rule: always the leftmost of the adjacent pairs with the least rank.

        Keeps the rank of every adjacent pair; a merge changes two of them.
        """
        if len(data) > 64:
            return self._merge_long([data[i : i + 1] for i in range(len(data))])
        rank_of = self.ranks.get
        parts = [data[i : i + 1] for i in range(len(data))]
        pairs = [rank_of(data[i : i + 2], NEVER) for i in range(len(data) - 1)]
        while pairs and (least := min(pairs)) != NEVER:
            at = pairs.index(least)
            parts[at] += parts.pop(at + 1)
            del pairs[at]
            if at:
                pairs[at - 1] = rank_of(parts[at - 1] + parts[at], NEVER)
            if at < len(pairs):
                pairs[at] = rank_of(parts[at] + parts[at + 1], NEVER)
        return [self.ranks[p] for p in parts]

    def _merge_long(self, parts: list[bytes]) -> list[int]:
        """The same rule with a heap of candidate pairs, for windows that had to grow."""
        ranks, n = self.ranks, len(parts)
        after, before = list(range(1, n + 1)), list(range(-1, n - 1))
        heap = [(r, i, parts[i], parts[i + 1]) for i in range(n - 1) if (r := ranks.get(parts[i] + parts[i + 1])) is not None]
        heapq.heapify(heap)
        live = [True] * n
        while heap:
            _, i, a, b = heapq.heappop(heap)
            j = after[i]
            if not live[i] or j >= n or parts[i] != a or parts[j] != b:
                continue
            parts[i], live[j], after[i] = a + b, False, after[j]
            if after[i] < n:
                before[after[i]] = i
                if (r := ranks.get(parts[i] + parts[after[i]])) is not None:
                    heapq.heappush(heap, (r, i, parts[i], parts[after[i]]))
            if before[i] >= 0 and (r := ranks.get(parts[before[i]] + parts[i])) is not None:
                heapq.heappush(heap, (r, before[i], parts[before[i]], parts[i]))
        return [ranks[p] for p, ok in zip(parts, live) if ok]

    def tokens(self, data: bytes) -> list[int]:
        if len(data) <= self.leaf_bytes:
            return self.merge(data)
        # Cut at a power of two, so that runs of one byte meet no shifted seam.
        half = 1 << ((len(data) - 1).bit_length() - 1)
        return self.join_tokens(self.tokens(data[:half]), self.tokens(data[half:]))

    def stands(self, a: int, b: int) -> bool:
        """Whether two neighbours are the encoding of their own bytes."""
        known = self.pairs.get((a, b))
        if known is None:
            if len(self.pairs) * ENTRY_BYTES > self.most_bytes // 3:
                self.pairs.clear()
            known = self.pairs[a, b] = self.merge(self.bytes_of[a] + self.bytes_of[b]) == [a, b]
        return known

    def join_tokens(self, left: list[int], right: list[int]) -> list[int]:
        if not left or not right or self.stands(left[-1], right[0]):
            return left + right
        width = 2
        while True:
            a, b = max(0, len(left) - width), min(len(right), width)
            window = self.merge(self.decode(left[a:]) + self.decode(right[:b]))
            if (a == 0 or self.stands(left[a - 1], window[0])) and (b == len(right) or self.stands(window[-1], right[b])):
                return left[:a] + window + right[b:]
            width *= 2

    # Texts.

    def encode(self, text: str) -> list[int]:
        return list(chain.from_iterable(map(self.__getitem__, self.pieces(text))))

    def decode(self, ids: list[int], leaf: int = 4096) -> bytes:
        if len(ids) <= leaf:
            return b"".join(map(self.bytes_of.__getitem__, ids))
        half = len(ids) // 2
        return self.decode(ids[:half], leaf) + self.decode(ids[half:], leaf)


def encode_decode(docs: DataFrame, ranks_path: str = RANKS, pattern: str = public_tokenizers.PATTERN) -> DataFrame:
    """doc_id, n_tokens, ids (little-endian unsigned 32-bit integers), decoded (bytes) for every row of ``docs`` (doc_id, text).

    The decoded bytes come from the ids alone.  Null and empty texts give no ids and no bytes; repeated rows, null doc_ids
    and other columns change nothing; an empty table gives an empty result.  A task's memory follows its longest text.
    """
    with open(ranks_path, "rb") as file:
        data = file.read()
    shared = docs.sparkSession.sparkContext.broadcast((data, pattern))
    digest = hashlib.sha256(data + pattern.encode()).hexdigest()

    def work(batch: pa.RecordBatch) -> pa.RecordBatch:
        coder = per_worker(f"bpe {digest}", lambda: Coder(read_ranks(shared.value[0]), shared.value[1]))
        ids, decoded, sizes = [], [], []
        for text in batch.column("text").to_pylist():
            row = coder.encode(text) if text else []
            sizes.append(len(row))
            ids.append(np.array(row, dtype="<u4").tobytes())
            decoded.append(coder.decode(row))
        return pa.RecordBatch.from_arrays(
            [batch.column("doc_id"), pa.array(sizes, pa.int64()), pa.array(ids, pa.binary()), pa.array(decoded, pa.binary())], ["doc_id", "n_tokens", "ids", "decoded"]
        )

    kind = docs.schema["doc_id"].dataType.simpleString()
    return docs.select("doc_id", F.col("text")).mapInArrow(sliced(work), f"doc_id {kind}, n_tokens long, ids binary, decoded binary")
