"""Words of whole texts as 64-bit hashes, many texts at a time.

Texts are handled as UTF-8 bytes: a table maps each byte to the byte that counts
(0: not part of a word), and the hash of a word is a polynomial in its bytes, so
the words of a block of texts are hashed without a Python object per word.
"""

from __future__ import annotations

import numpy as np

U = np.uint64
BASE = U(0x9E3779B97F4A7C15 | 1)
BASE_INVERSE = U(pow(int(BASE), -1, 1 << 64))


def mix(x: np.ndarray) -> np.ndarray:
    """Scatter 64-bit values (a bijection)."""
    x = x ^ (x >> U(30))
    x = x * U(0xBF58476D1CE4E5B9)
    x = x ^ (x >> U(27))
    x = x * U(0x94D049BB133111EB)
    return x ^ (x >> U(31))


BYTE_VALUE = mix(np.arange(1, 257, dtype=np.uint64) * BASE)
_powers: dict[int, np.ndarray] = {}


def powers(base: np.uint64, n: int) -> np.ndarray:
    """1, base, base**2, ... modulo 2**64."""
    found = _powers.get(int(base))
    if found is None or len(found) < n:
        found = np.full(max(n, 1 << 16), base)
        found[0] = 1
        found = _powers[int(base)] = np.cumprod(found, dtype=np.uint64)
    return found[:n]


def spaced_words() -> np.ndarray:
    """Byte table: words are runs without ASCII white space; A-Z in lower case."""
    fold = np.arange(256, dtype=np.uint8)
    fold[0x41:0x5B] += 32
    fold[[9, 10, 11, 12, 13, 32]] = 0
    return fold


def letter_words() -> np.ndarray:
    """Byte table: words are runs of ASCII letters, digits and other code points."""
    fold = spaced_words()
    keep = np.zeros(256, bool)
    keep[[*range(0x30, 0x3A), *range(0x61, 0x7B), *range(0x41, 0x5B), *range(0x80, 0x100)]] = True
    fold[~keep] = 0
    return fold


def word_hashes(texts: list[bytes], fold: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(hash of every word, index of each text's first word and behind the last)."""
    data = np.frombuffer(b" ".join(texts) + b" ", np.uint8)
    n = len(data)
    byte = fold[data]
    edges = np.flatnonzero(np.diff((byte != 0).view(np.int8), prepend=0))
    starts, ends = edges[0::2], edges[1::2]
    sums = np.zeros(n + 1, np.uint64)
    np.cumsum(BYTE_VALUE[byte] * powers(BASE, n), out=sums[1:])
    words = mix((sums[ends] - sums[starts]) * powers(BASE_INVERSE, n)[starts] + (ends - starts).astype(np.uint64))
    first = np.cumsum([0] + [len(t) + 1 for t in texts])
    return words, np.searchsorted(starts, first)


def sequence_hash(words: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """A hash of each text's whole sequence of words."""
    n = len(words)
    sums = np.zeros(n + 1, np.uint64)
    np.cumsum(words * powers(BASE, n), out=sums[1:])
    a, b = offsets[:-1], offsets[1:]
    whole = (sums[b] - sums[a]) * powers(BASE_INVERSE, n + 1)[a]
    return mix(whole + (b - a).astype(np.uint64) * U(0xD6E8FEB86659FD93))


def shingle_hashes(words: np.ndarray, size: int) -> np.ndarray:
    """The hash of each run of ``size`` words, by its first word."""
    n = len(words) - size + 1
    if n <= 0:
        return np.empty(0, np.uint64)
    out = np.zeros(n, np.uint64)
    for i in range(size):
        out = out * BASE + words[i : i + n]
    return mix(out)


def shingle_sets(words: np.ndarray, offsets: np.ndarray, size: int) -> list[np.ndarray]:
    """Each text's sorted distinct shingles; a text with fewer words has one, its whole
    sequence; a text without words has none."""
    runs, whole = shingle_hashes(words, size), sequence_hash(words, offsets)
    out = []
    for i, (a, b) in enumerate(zip(offsets[:-1], offsets[1:])):
        if b - a >= size:
            out.append(np.unique(runs[a : b - size + 1]))
        else:
            out.append(whole[i : i + 1] if b > a else runs[:0])
    return out
