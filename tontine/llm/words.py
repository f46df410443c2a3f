"""Vectorised word splitting and hashing of UTF-8 text (used inside tasks).

A word's hash is a polynomial in its bytes over 64-bit integers, taken from running sums, so a
whole text is hashed by a handful of numpy passes. Sequences of words are hashed the same way.
"""

from __future__ import annotations

import numpy as np
import xxhash

U = np.uint64
_BASE, _SEQ = 0x9E3779B97F4A7C15 | 1, 0xD1342543DE82EF95 | 1
_SEGMENT = 1 << 20
_POWERS: dict[int, tuple[np.ndarray, np.ndarray]] = {}


def _powers(base: int, n: int) -> tuple[np.ndarray, np.ndarray]:
    """base**i and base**-i modulo 2**64 for i < n (kept per process, grown by doubling)."""
    have = _POWERS.get(base)
    if have is None or len(have[0]) < n:
        size = 1 << max(12, int(n - 1).bit_length())
        pair = []
        for b in (base, pow(base, -1, 1 << 64)):
            p = np.full(size, b, dtype=U)
            p[0] = 1
            pair.append(np.multiply.accumulate(p))
        have = _POWERS[base] = (pair[0], pair[1])
    return have


def mix(x: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit integers that spreads every bit."""
    x = x ^ (x >> U(30))
    x = x * U(0xBF58476D1CE4E5B9)
    x ^= x >> U(27)
    x = x * U(0x94D049BB133111EB)
    x ^= x >> U(31)
    return x


def byte_classes(word: str) -> tuple[np.ndarray, np.ndarray]:
    """(lower-casing table, word-byte table): ``alnum`` words are 0-9, a-z and every non-ASCII
    byte; ``space`` words are everything but blank and \\x09-\\x0D. A-Z count as a-z."""
    lower = np.arange(256, dtype=np.uint8)
    lower[65:91] += 32
    is_word = np.ones(256, dtype=bool)
    if word == "alnum":
        is_word[:128] = False
        for a, b in ((48, 58), (65, 91), (97, 123)):
            is_word[a:b] = True
    else:
        is_word[[32, *range(9, 14)]] = False
    return lower, is_word


CLASSES = {k: byte_classes(k) for k in ("alnum", "space")}
_BYTE = mix(np.arange(1, 257, dtype=U) * U(0x2545F4914F6CDD1D))
_LOWER_BYTE = _BYTE[CLASSES["space"][0]]


def _segment(buf: np.ndarray, is_word: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    inside = np.zeros(len(buf) + 2, dtype=np.int8)
    inside[1:-1] = is_word[buf]
    step = np.diff(inside)
    starts, ends = np.flatnonzero(step == 1), np.flatnonzero(step == -1)
    power, inverse = _powers(_BASE, len(buf) + 1)
    run = np.zeros(len(buf) + 1, dtype=U)
    np.cumsum(_LOWER_BYTE[buf] * power[:len(buf)], out=run[1:])
    return starts, ends, mix((run[ends] - run[starts]) * inverse[starts])


def word_hashes(text: bytes, word: str) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Start and end bytes and hashes of the words of ``text``, A-Z lower-cased. Long texts go
    through in segments cut between words."""
    is_word = CLASSES[word][1]
    buf = np.frombuffer(text, dtype=np.uint8)
    if len(buf) <= _SEGMENT:
        return _segment(buf, is_word)
    found, at = [], 0
    while at < len(buf):
        end = min(at + _SEGMENT, len(buf))
        while end < len(buf):  # a word longer than a segment is kept whole
            gap = np.flatnonzero(~is_word[buf[end:end + _SEGMENT]])
            if len(gap):
                end += int(gap[0])
                break
            end = min(end + _SEGMENT, len(buf))
        s, e, h = _segment(buf[at:end], is_word)
        found.append((s + at, e + at, h))
        at = end
    return tuple(np.concatenate(x) for x in zip(*found))


def sequence_hashes(words: np.ndarray, n: int) -> np.ndarray:
    """Hashes of every run of ``n`` consecutive words."""
    if n < 1 or len(words) < n:
        return np.zeros(0, dtype=U)
    power, inverse = _powers(_SEQ, len(words) + 1)
    run = np.zeros(len(words) + 1, dtype=U)
    np.cumsum(words * power[:len(words)], out=run[1:])
    at = len(words) - n + 1
    return mix((run[n:] - run[:at]) * inverse[:at] + U(n))


def shingles(text: bytes, n: int) -> np.ndarray:
    """Sorted distinct hashes of the ``n``-word shingles of ``text`` (words between white space,
    A-Z lower-cased); fewer words make one shingle, no word none. Words go through xxh3."""
    words = np.array(list(map(xxhash.xxh3_64_intdigest, text.lower().split())), dtype=U)  # bytes: ASCII case, blank and \\x09-\\x0D
    return np.unique(sequence_hashes(words, min(n, len(words))))
