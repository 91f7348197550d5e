"""Hashed word n-grams of texts, with numpy; the same on every machine and run."""

from __future__ import annotations

import hashlib

import numpy as np

#: Words are hashed so many at a time; a longer word than LONG_WORD bytes counts by its digest.
CHUNK_WORDS = 200_000
LONG_WORD = 1024

_U = np.uint64


def mix(x: np.ndarray) -> np.ndarray:
    """The splitmix64 finaliser: a bijection that spreads close values."""
    x = (x ^ (x >> _U(30))) * _U(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> _U(27))) * _U(0x94D049BB133111EB)
    return x ^ (x >> _U(31))


def _powers(base: int, n: int) -> np.ndarray:
    return np.array([pow(base, i, 1 << 64) for i in range(n)], dtype=_U)


_POWERS = _powers(0x9E3779B97F4A7C15, LONG_WORD + 1)
_ORDER = mix(np.arange(1, 65, dtype=_U)) | _U(1)


def word_hashes(words: list[str]) -> np.ndarray:
    """A 64-bit hash of each word."""
    out = []
    for i in range(0, len(words), CHUNK_WORDS):
        part = words[i : i + CHUNK_WORDS]
        raw = (" ".join(part) + " ").encode("utf-8", "replace")
        data = np.frombuffer(raw, dtype=np.uint8)
        starts = np.concatenate([[0], np.flatnonzero(data == 32) + 1])  # the last one ends the text
        lengths = np.diff(starts)
        if lengths.max() > LONG_WORD:
            part = [w if len(w) * 4 < LONG_WORD else "\0" + hashlib.blake2b(w.encode("utf-8", "replace")).hexdigest() for w in part]
            out.append(word_hashes(part))
            continue
        starts = starts[:-1]
        at = np.arange(len(data)) - np.repeat(starts, lengths)
        terms = (data.astype(_U) + _U(1)) * _POWERS[at]
        out.append(mix(np.add.reduceat(terms, starts)))
    return np.concatenate(out) if out else np.zeros(0, dtype=_U)


def ngram_hashes(h: np.ndarray, n: int) -> np.ndarray:
    """A hash of each run of n words; of all words together if they are fewer; nothing for no words."""
    if not len(h):
        return h
    k = min(n, len(h))
    total = np.zeros(len(h) - k + 1, dtype=_U)
    for j in range(k):
        total += h[j : len(h) - k + 1 + j] * _ORDER[j]
    return mix(total)


def words_of(text: str | None) -> list[str]:
    return (text or "").lower().split()
