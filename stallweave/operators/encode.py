"""Text to vectors in Arrow batches, one encoder per Python worker."""

from __future__ import annotations

import hashlib
from collections.abc import Callable, Iterator
from typing import Protocol

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


#: Words whose slots a worker remembers; a setting of memory, it changes no result.
WORDS_KEPT = 200_000


class Encoder(Protocol):
    """Anything that turns a batch of texts into a matrix of unit vectors."""

    def encode(self, texts: list[str]) -> np.ndarray: ...


class HashingEncoder:
    """Default encoder without model files: counts of words hashed into ``dim`` slots, length 1.

    Words are the runs between blanks, tabs and line ends.  MD5 rather than ``hash`` keeps every worker equal.
    """

    def __init__(self, dim: int = 1024):
        self.dim = dim
        self._slots = _Slots(dim)

    def encode(self, texts: list[str]) -> np.ndarray:
        counts = np.zeros((len(texts), self.dim))
        for row, text in enumerate(texts):
            words = text.replace("\t", " ").replace("\n", " ").replace("\r", " ").split(" ")
            slots = np.fromiter(map(self._slots.__getitem__, words), np.int64, len(words))
            counts[row] = np.bincount(slots, minlength=self.dim + 1)[: self.dim]
            if len(self._slots) > WORDS_KEPT:
                self._slots = _Slots(self.dim)
        lengths = np.linalg.norm(counts, axis=1, keepdims=True)
        return (counts / np.where(lengths > 0, lengths, 1.0)).astype(np.float32)


class _Slots(dict):
    """Slot of a word, worked out when it is met first; the empty word has a slot of its own, behind all others."""

    def __init__(self, dim: int):
        super().__init__({"": dim})
        self.dim = dim

    def __missing__(self, word: str) -> int:
        slot = self[word] = int(hashlib.md5(word.encode("utf-8")).hexdigest()[:8], 16) % self.dim
        return slot


def encoder_udf(factory: Callable[[], Encoder], batch_size: int = 32):
    """Iterator Arrow UDF: ``factory`` runs once per worker task, on the first batch.

    Python holds the texts of ``batch_size`` rows at a time beside the Arrow batch, and its vectors as one array.
    """

    @F.arrow_udf("array<float>")
    def encode(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        encoder = None
        for texts in batches:
            if encoder is None:
                encoder = factory()
            vectors: list[np.ndarray] = []
            for start in range(0, len(texts), batch_size):
                values = texts.slice(start, batch_size).fill_null("").to_pylist()
                vectors.append(np.asarray(encoder.encode(values), dtype=np.float32))
            flat = np.concatenate(vectors).ravel() if vectors else np.empty(0, np.float32)
            ends = np.linspace(0, len(flat), len(texts) + 1).astype(np.int32)
            yield pa.ListArray.from_arrays(pa.array(ends), pa.array(flat))

    return encode


def spread_rows(df: DataFrame, rows: int, rows_per_task: int = 200) -> DataFrame:
    """Rows dealt out for encoding: encoders are slow, so tasks are sized by rows and not by bytes.

    ``rows_per_task`` is the work that a lost task repeats; the number of tasks follows from it alone.
    """
    return df.repartition(max(1, -(-rows // rows_per_task)))


def with_embedding(
    df: DataFrame, text: str | Column, factory: Callable[[], Encoder], alias: str = "embedding", batch_size: int = 32
) -> DataFrame:
    """Rows plus the vector of their whole text."""
    return df.withColumn(alias, encoder_udf(factory, batch_size)(text))
