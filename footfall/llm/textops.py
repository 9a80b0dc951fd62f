"""Vectorised hashing of words and word n-grams over many texts at once.

The texts of a batch are laid end to end in one byte array. A word's hash is a polynomial of
its bytes modulo 2**64, taken from one running sum, so no Python code runs per word. All
hashes depend on the bytes alone: they are the same in every task and every run.
"""

from __future__ import annotations

import numpy as np

BASE = np.uint64(0x9E3779B97F4A7C15 | 1)
INVERSE = np.uint64(pow(int(BASE), -1, 1 << 64))
WHITE = np.zeros(256, bool)
WHITE[[0x20, 0x09, 0x0A, 0x0B, 0x0C, 0x0D]] = True
#: Everything that is neither a letter or digit nor part of a multi-byte character.
NOT_WORD = np.array([not (chr(b).isalnum() and b < 128 or b >= 128) for b in range(256)])

_powers: dict[str, np.ndarray] = {"up": np.ones(1, np.uint64), "down": np.ones(1, np.uint64)}


def mix(x: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit values whose every output bit depends on every input bit."""
    x = x ^ (x >> np.uint64(30))
    x = x * np.uint64(0xBF58476D1CE4E5B9)
    x = x ^ (x >> np.uint64(27))
    x = x * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def _tables(n: int) -> tuple[np.ndarray, np.ndarray]:
    if len(_powers["up"]) < n:
        for name, base in (("up", BASE), ("down", INVERSE)):
            steps = np.full(n, base, np.uint64)
            steps[0] = 1
            _powers[name] = np.cumprod(steps, dtype=np.uint64)
    return _powers["up"], _powers["down"]


def word_hashes(texts: list[bytes], breaks: np.ndarray = WHITE) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Words of all texts: their hashes, where each text's words begin (one more entry than
    texts), and each word's first byte and end within its own text."""
    joined = b" ".join(texts) + b" "
    data = np.frombuffer(joined, np.uint8)
    gap = breaks[data]
    lengths = np.fromiter(map(len, texts), np.int64, len(texts))
    text_starts = np.zeros(len(texts) + 1, np.int64)
    np.cumsum(lengths + 1, out=text_starts[1:])
    edge = np.flatnonzero(np.diff(gap, prepend=True))
    starts, ends = edge[0::2], edge[1::2]
    hashes = spans_hashed(data, starts, ends)
    first = np.searchsorted(starts, text_starts)
    own = np.repeat(text_starts[:-1], np.diff(first))
    return hashes, first, starts - own, ends - own


def spans_hashed(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """The hash of the bytes of each span."""
    up, down = _tables(len(data) + 1)
    total = np.zeros(len(data) + 1, np.uint64)
    np.cumsum((data.astype(np.uint64) + np.uint64(1)) * up[: len(data)], dtype=np.uint64, out=total[1:])
    return mix((total[ends] - total[starts]) * down[starts] + (ends - starts).astype(np.uint64))


def factors(n: int, seed: int = 5) -> np.ndarray:
    return np.random.default_rng(seed).integers(1, 1 << 63, n, dtype=np.uint64) * np.uint64(2) + np.uint64(1)


def gram_hashes(words: np.ndarray, n: int) -> np.ndarray:
    """The hash of the ``n`` words from each position on (as many as fit)."""
    if len(words) < n:
        return np.zeros(0, np.uint64)
    out = np.zeros(len(words) - n + 1, np.uint64)
    for j, k in enumerate(factors(n)):
        out += words[j : j + len(out)] * k
    return mix(out)


def shingle_sets(texts: list[bytes], n: int) -> list[np.ndarray]:
    """Sorted distinct hashes of each text's ``n``-word shingles.

    A text of fewer words has one shingle, its whole word sequence; one without words has none.
    """
    words, first, _, _ = word_hashes(texts)
    grams = gram_hashes(words, n)
    out = []
    for lo, hi in zip(first[:-1].tolist(), first[1:].tolist()):
        if hi - lo >= n:
            out.append(np.unique(grams[lo : hi - n + 1]))
        elif hi > lo:
            out.append(gram_hashes(words[lo:hi], hi - lo) + np.uint64(hi - lo))
        else:
            out.append(np.zeros(0, np.uint64))
    return out
