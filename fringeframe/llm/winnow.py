"""Windows of a sequence grouped by their least gram.

Every window of ``length`` units has an anchor: its gram of ``gram`` units with the least
hash, the first of them on a tie. Neighbouring windows with the same anchor form a stretch.
Equal windows have equal anchors at equal places, wherever they occur, so windows can be
compared anchor by anchor, and only a few stretches a window length have to be exchanged.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np

from .wordhash import prefix_sums, span_hash

#: Tables for a second, independent hash of the same units.
_SECOND = np.random.default_rng(2).integers(0, 1 << 64, 256, np.uint64)


@dataclass
class Stretches:
    """Per stretch: text number, first window's start in it, number of windows, anchor and content hashes.

    ``near`` has 32 bits for the half window that ends with the anchor's gram and 32 for the one
    that begins with it; 0 where the text does not reach so far. Two stretches of one anchor share
    a window only if they agree in one of them.
    """

    text: np.ndarray
    start: np.ndarray
    count: np.ndarray
    anchor: np.ndarray
    first: np.ndarray
    second: np.ndarray
    near: np.ndarray


def _sliding_min(keys: np.ndarray, w: int) -> np.ndarray:
    """Least of every w neighbours."""
    n = len(keys) - w + 1
    rows = -(-len(keys) // w)
    padded = np.full(rows * w, np.iinfo(np.uint64).max, np.uint64)
    padded[: len(keys)] = keys
    grid = padded.reshape(rows, w)
    ahead = np.minimum.accumulate(grid, 1).ravel()
    back = np.minimum.accumulate(grid[:, ::-1], 1)[:, ::-1].ravel()
    return np.minimum(back[:n], ahead[w - 1 : w - 1 + n])


def stretches(body: np.ndarray, unit_at: np.ndarray | None, bounds: np.ndarray, length: int, gram: int) -> Stretches:
    """Stretches of all texts of a batch.

    ``body`` holds the bytes of the texts; units are bytes, or, with ``unit_at`` (starts, ends),
    the byte spans of words, which must be written with nothing but single separators between
    them in ``body``. ``bounds`` has the first unit of each text and the number of units.
    """
    n = int(bounds[-1])
    w = length - gram + 1
    if n < length:
        z = np.zeros(0, np.int64)
        return Stretches(z, z, z, z, z, z, z)
    sums = prefix_sums(body)
    starts, ends = (np.arange(n), np.arange(1, n + 1)) if unit_at is None else unit_at
    grams = span_hash(sums, starts[: n - gram + 1], ends[gram - 1 :])
    keys = (grams >> np.uint64(32) << np.uint64(32)) | np.arange(len(grams), dtype=np.uint64)
    least = (_sliding_min(keys, w) & np.uint64(0xFFFFFFFF)).astype(np.int64)  # one a window: its anchor's place
    text = np.repeat(np.arange(len(bounds) - 1), np.diff(bounds))[: n - length + 1]
    ok = np.arange(n - length + 1) + length <= bounds[text + 1]
    new = np.ones(n - length + 1, bool)
    new[1:] = (least[1:] != least[:-1]) | (text[1:] != text[:-1])
    new &= ok
    at = np.flatnonzero(new)
    if not len(at):
        z = np.zeros(0, np.int64)
        return Stretches(z, z, z, z, z, z, z)
    group = np.cumsum(new) - 1
    count = np.bincount(group[ok], minlength=len(at))
    last = at + count - 1 + length - 1
    lo, hi = starts[at], ends[last]
    second = span_hash(prefix_sums(body, _SECOND), lo, hi)
    place, half = least[at], -(-(length - gram) // 2)
    low, high = bounds[text[at]], bounds[text[at] + 1]
    has_left, has_right = place - half >= low, place + gram + half <= high
    left = np.where(has_left, span_hash(sums, starts[np.where(has_left, place - half, place)], ends[place + gram - 1]) | np.uint64(1), 0)
    right = np.where(has_right, span_hash(sums, starts[place], ends[np.where(has_right, place + half + gram, place + gram) - 1]) | np.uint64(1), 0)
    near = (left << np.uint64(32) | right & np.uint64(0xFFFFFFFF)).view(np.int64)
    return Stretches(text[at], at - bounds[text[at]], count, grams[least[at]].view(np.int64), span_hash(sums, lo, hi).view(np.int64), second.view(np.int64), near)
