"""Hashed word shingles of many texts at once."""

from __future__ import annotations

import numpy as np

_SPACE = np.zeros(256, bool)
_SPACE[[9, 10, 11, 12, 13, 32]] = True
_BYTE = np.random.default_rng(20240229).integers(1, 1 << 63, 256, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_STEP = np.uint64(0x5851F42D4C957F2D)


def mixed(h: np.ndarray) -> np.ndarray:
    """Spreads every bit over the whole 64-bit number, one to one."""
    h = h ^ (h >> np.uint64(30))
    h = h * np.uint64(0xBF58476D1CE4E5B9)
    h = h ^ (h >> np.uint64(27))
    h = h * np.uint64(0x94D049BB133111EB)
    return h ^ (h >> np.uint64(31))


def word_hashes(texts: list[str | None]) -> tuple[np.ndarray, np.ndarray]:
    """64-bit hashes of the words of all texts in order, and the place where each text's words begin (one more than texts).

    Words are runs of anything but the six ASCII blanks; A-Z are lower-cased, nothing else.
    """
    coded = [t.encode("utf-8", "surrogatepass") if t else b"" for t in texts]
    data = np.frombuffer(b"\n".join(coded).lower() + b"\n", np.uint8)
    sizes = np.fromiter(map(len, coded), np.int64, len(coded)) + 1
    blank = _SPACE[data]
    at = np.flatnonzero(~blank)
    if not len(at):
        return np.empty(0, np.uint64), np.zeros(len(coded) + 1, np.int64)
    first = np.flatnonzero(np.r_[True, at[1:] != at[:-1] + 1])
    starts = at[first]
    lengths = np.diff(np.r_[first, len(at)])
    place = np.arange(len(at)) - np.repeat(first, lengths)
    powers = np.cumprod(np.full(int(lengths.max()), _STEP, np.uint64))
    h = np.add.reduceat(_BYTE[data[at]] * powers[place], first)
    words = mixed(h + lengths.astype(np.uint64))
    return words, np.searchsorted(starts, np.r_[0, np.cumsum(sizes)])


def chained(words: np.ndarray, width: int) -> np.ndarray:
    """One hash for every ``width`` neighbouring words."""
    n = len(words) - width + 1
    h = np.full(n, np.uint64(width))
    for k in range(width):
        h = mixed(h * np.uint64(3) + words[k : k + n])
    return h


def shingle_sets(texts: list[str | None], width: int) -> list[np.ndarray]:
    """Sorted distinct shingle hashes of each text; a shorter text is one shingle, one without words none."""
    words, begins = word_hashes(texts)
    every = chained(words, width) if len(words) >= width else np.empty(0, np.uint64)
    sets = []
    for a, b in zip(begins[:-1], begins[1:]):
        if b - a >= width:
            sets.append(np.unique(every[a : b - width + 1]))
        elif b > a:
            sets.append(chained(words[a:b], b - a))
        else:
            sets.append(np.empty(0, np.uint64))
    return sets
