"""Rolling hashes over bytes and words, for whole batches of texts at once."""

from __future__ import annotations

import numpy as np

from .common import mix64

#: An odd base, so that it has an inverse modulo 2**64.
_BASE = 0x9E3779B97F4A7C15
_BACK = pow(_BASE, -1, 1 << 64)
#: A random value for each byte, without and with A-Z taken as a-z.
_PLAIN = np.random.default_rng(1).integers(0, 1 << 64, 256, np.uint64)
_LOWER = _PLAIN.copy()
_LOWER[0x41:0x5B] = _PLAIN[0x61:0x7B]
#: Bytes that are part of a word: all but the space and 0x09-0x0D.
_IN_WORD = np.ones(256, bool)
_IN_WORD[[0x20, *range(0x09, 0x0E)]] = False

_powers: dict[int, np.ndarray] = {}


def powers(base: int, n: int) -> np.ndarray:
    """base**0 ... base**(n - 1) modulo 2**64; kept, and made longer when a longer text comes."""
    have = _powers.get(base)
    if have is None or len(have) < n:
        size = max(1 << 18, 1 << (n - 1).bit_length())
        seq = np.full(size, base, np.uint64)
        seq[0] = 1
        have = _powers[base] = np.multiply.accumulate(seq)
    return have[:n]


def prefix_sums(body: np.ndarray, table: np.ndarray = _PLAIN) -> np.ndarray:
    """s with (s[b] - s[a]) * back(a) as the hash of body[a:b]; equal bytes give equal hashes anywhere."""
    out = np.zeros(len(body) + 1, np.uint64)
    np.cumsum(table[body] * powers(_BASE, len(body)), out=out[1:])
    return out


def span_hash(sums: np.ndarray, start: np.ndarray, end: np.ndarray) -> np.ndarray:
    """Hash of the bytes from each start to each end."""
    return mix64((sums[end] - sums[start]) * powers(_BACK, len(sums))[start] + (end - start).astype(np.uint64))


def word_spans(body: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Starts and ends of all words, and for each text the number of its first word (one more entry at the end)."""
    inside = _IN_WORD[body]
    new = np.zeros(len(body) + 1, bool)
    new[offsets] = True  # a text's first byte starts anew
    before = np.zeros(len(body) + 1, bool)
    before[1:] = inside
    follows = np.append(inside, False)
    starts = np.flatnonzero(follows & (~before | new))
    ends = np.flatnonzero(before & (~follows | new))
    return starts, ends, np.searchsorted(starts, offsets)


def hash_words(body: np.ndarray, offsets: np.ndarray, lower: bool = False) -> tuple[np.ndarray, np.ndarray]:
    """Hash of every word, and the number of each text's first word."""
    starts, ends, first = word_spans(body, offsets)
    return span_hash(prefix_sums(body, _LOWER if lower else _PLAIN), starts, ends), first
