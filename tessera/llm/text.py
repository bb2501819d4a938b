"""Word and shingle helpers shared by the operators (run inside Arrow batches)."""

from __future__ import annotations

import re
from functools import cache
from hashlib import blake2b

import numpy as np

#: Maximal runs of Unicode letters or digits.
WORD = re.compile(r"[^\W_]+")
MASK64 = (1 << 64) - 1


def words(text: str | None) -> list[str]:
    return WORD.findall(text.lower()) if text else []


def word_hash(word: str) -> int:
    """A stable 64-bit hash, the same on every worker."""
    return int.from_bytes(blake2b(word.encode("utf-8", "surrogatepass"), digest_size=8).digest(), "little")


def mix(h: np.ndarray) -> np.ndarray:
    """Finaliser of a 64-bit hash (full avalanche)."""
    with np.errstate(over="ignore"):
        h = (h ^ (h >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
        h = (h ^ (h >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
        return h ^ (h >> np.uint64(31))


def jaccard(a: np.ndarray, b: np.ndarray) -> float:
    """Of two sorted arrays of distinct values."""
    common = len(np.intersect1d(a, b, assume_unique=True))
    return common / (len(a) + len(b) - common)


@cache
def wordy() -> np.ndarray:
    """By code point, whether it is a letter or digit."""
    return np.array([chr(i).isalnum() for i in range(0x110000)])


def _flat(lows: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """Word hashes of lower-case texts, and the number of words of each."""
    c = np.frombuffer("\n".join(lows).encode("utf-32-le", "surrogatepass"), np.uint32)
    on = wordy()[c]
    edge = np.flatnonzero(np.diff(on, prepend=False, append=False))
    start, size = edge[::2], edge[1::2] - edge[::2]
    ends = np.cumsum([len(t) + 1 for t in lows])
    first = np.cumsum(size) - size
    with np.errstate(over="ignore"):
        letter = c[on].astype(np.uint64)
        letter += np.arange(len(letter), dtype=np.uint64) - np.repeat(first.astype(np.uint64), size) << np.uint64(32)
        h = np.add.reduceat(mix(letter), first) if len(first) else np.zeros(0, np.uint64)
        h = mix(h + size.astype(np.uint64))
    return h, np.diff(np.searchsorted(start, ends), prepend=0)


def flat_words(texts: list[str | None]) -> tuple[np.ndarray, np.ndarray]:
    """64-bit hashes, the same on every worker, of all words of the texts, one after another, and where
    each text's words begin and end."""
    parts, counts, lows, chars = [np.zeros(0, np.uint64)], [np.zeros(1, np.int64)], [], 0
    for k, t in enumerate(texts):
        lows.append(t.lower() if t else "")
        chars += len(lows[-1])
        if chars > 100_000 or k == len(texts) - 1:
            h, n = _flat(lows)
            parts.append(h)
            counts.append(n)
            lows, chars = [], 0
    return np.concatenate(parts), np.cumsum(np.concatenate(counts))


def sequence_keys(flat: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """A signed 64-bit key of every text's word sequence."""
    sizes = np.diff(ends)
    within = (np.arange(len(flat)) - np.repeat(ends[:-1], sizes)).astype(np.uint64)
    with np.errstate(over="ignore"):
        terms = mix(flat + (within + np.uint64(1)) * np.uint64(0x9E3779B97F4A7C15))
        total = np.concatenate([[np.uint64(0)], np.cumsum(terms, dtype=np.uint64)])
        return mix((total[ends[1:]] - total[ends[:-1]]) ^ mix(sizes.astype(np.uint64))).astype(np.int64)


def flat_shingles(flat: np.ndarray, ends: np.ndarray, size: int) -> tuple[np.ndarray, np.ndarray]:
    """Hashed runs of ``size`` words of every text, with repeats; at least one for each text."""
    sizes = np.diff(ends)
    n_runs = np.maximum(sizes - size + 1, 1)
    at = np.concatenate([[0], np.cumsum(n_runs)])
    start = np.repeat(ends[:-1], n_runs) + np.arange(at[-1]) - np.repeat(at[:-1], n_runs)
    short = np.repeat(sizes < size, n_runs)
    acc = np.zeros(at[-1], np.uint64)
    last = max(len(flat) - 1, 0)
    padded = flat if len(flat) else np.zeros(1, np.uint64)
    with np.errstate(over="ignore"):
        for k in range(size):
            acc = mix(acc * np.uint64(0x9E3779B97F4A7C15) + padded[np.minimum(start + k, last)])
    if short.any():
        acc[short] = sequence_keys(flat, ends)[sizes < size].astype(np.uint64)
    return acc, at
