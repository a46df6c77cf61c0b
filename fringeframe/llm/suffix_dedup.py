"""Substring dedup with longest-previous-factor arrays.

The longest previous factor of a place is the longest string there that also starts at an
earlier place. In suffix order, the earlier place with the longest match is the previous or
the next one with a smaller place; so one sorted order of suffixes, the common prefixes of
its neighbours and two pointer arrays give it for all places at once. A place whose factor
reaches ``length`` bytes starts a later copy.

Suffixes are ordered anchor by anchor (:mod:`repeats`): places whose strings of ``length``
bytes agree always fall under one anchor, and only such places matter here, so suffixes are
ordered by these bytes. ``keep="first"`` removes later copies; ``keep="none"`` removes the
first as well.

Defined results: a null text is empty; texts shorter than ``length`` lose nothing; a null id
comes last in order; rows with the same id are ordered by a hash of their text, and rows that
agree in both are one document for ``keep="first"`` and copies of each other for
``keep="none"``. An empty table gives no rows; other columns play no part.
"""

from __future__ import annotations

import hashlib

import numpy as np
from pyspark.sql import DataFrame

from .common import narrow
from .repeats import Rule, groups, keyed, span_rows, spans, with_spans
from .wordhash import prefix_sums, span_hash

LENGTH, GRAM = 200, 48


def previous_factors(place: np.ndarray, common: np.ndarray) -> np.ndarray:
    """Longest previous factor of each entry of a suffix order.

    ``place`` is the text order of the entries; ``common[i]`` the common prefix of entries
    i - 1 and i (common[0] is 0). Pointers to the previous smaller place jump over larger
    ones, all at once, until none moves; the same backwards for the next smaller.
    """

    def one_way(place, common):
        n = len(place)
        to, least = np.arange(-1, n - 1), common.copy()
        while True:
            move = np.flatnonzero((to >= 0) & (place[to] >= place))
            if not len(move):
                break
            over = to[move]
            least[move] = np.minimum(least[move], least[over])
            to[move] = to[over]
        return np.where(to >= 0, least, 0)

    if not len(place):
        return np.zeros(0, np.int64)
    back = np.append(common[1:], 0)[::-1]  # between an entry and the next, read from the end
    return np.maximum(one_way(place, common), one_way(place[::-1], back)[::-1])


def _hits(cols: list[np.ndarray], length: int, keep_first: bool):
    """(rid, place) of the windows of a chunk of pieces that are copies."""
    anchor, doc, rid, start, count, body = cols
    sizes = np.array([len(b) for b in body], np.int64)
    data = np.frombuffer(b"".join(body), np.uint8)
    offset = np.cumsum(sizes) - sizes
    piece = np.repeat(np.arange(len(count)), count)
    inner = np.arange(len(piece)) - np.repeat(np.cumsum(count) - count, count)
    at = offset[piece] + inner
    group = np.cumsum(np.concatenate([[0], anchor[1:] != anchor[:-1]]))[piece]
    # a window whose hash is alone in its group has no partner
    key = span_hash(prefix_sums(data), at, at + length) + group.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)
    _, same, n = np.unique(key, return_inverse=True, return_counts=True)
    some = np.flatnonzero(n[same] > 1)
    if not len(some):
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    piece, at, group = piece[some], at[some], group[some]
    place = start[piece] + inner[some]
    rank = np.lexsort((place, rid[piece], doc[piece], group))
    piece, at, group, place = piece[rank], at[rank], group[rank], place[rank]
    hit = np.zeros(len(at), bool)
    edges = np.flatnonzero(np.diff(group)) + 1
    step = 1 << 16  # whole groups of about this many suffixes at a time
    lo = 0
    while lo < len(at):
        later = edges[edges >= lo + step]
        hi = int(later[0]) if len(later) else len(at)
        suffix = np.empty((hi - lo, 4 + length), np.uint8)
        suffix[:, :4] = np.ascontiguousarray((group[lo:hi] - group[lo]).astype(">u4")).view(np.uint8).reshape(-1, 4)
        suffix[:, 4:] = np.lib.stride_tricks.sliding_window_view(data, length)[at[lo:hi]]
        order = np.argsort(np.ascontiguousarray(suffix).view(f"S{4 + length}").ravel(), kind="stable")
        differ = suffix[order[1:]] != suffix[order[:-1]]
        common = np.where(differ.any(1), differ.argmax(1), 4 + length)
        common = np.concatenate([[0], np.maximum(common - 4, 0)]).astype(np.int64)
        if keep_first:
            # rows alike in id, text and place count as one occurrence
            p = rid[piece[lo:hi]]
            new = np.concatenate([[True], (p[1:] != p[:-1]) | (place[lo + 1 : hi] != place[lo : hi - 1])])
            factor = previous_factors(np.cumsum(new)[order], common)
        else:
            factor = np.maximum(common, np.append(common[1:], 0))
        hit[lo + order] = factor >= length
        lo = hi
    r, p = rid[piece[hit]], place[hit]
    order = np.lexsort((p, r))
    return r[order], p[order]


def find_copies(texts: DataFrame, length: int = LENGTH, gram: int = GRAM, keep: str = "first") -> DataFrame:
    """(rid, start, end): byte spans of copies, of texts with doc_id, text and rid."""
    rule = Rule(False, length, min(gram, length), keep == "first")

    def compare(batches):
        for cols in groups(batches):
            rid, at = _hits(cols, length, rule.keep_first)
            if len(rid):
                yield span_rows(rid, at, length)

    return spans(texts, rule, compare)


def _remove(text: str | None, starts: np.ndarray, ends: np.ndarray) -> tuple[bytes, bytes]:
    raw = (text or "").encode("utf-8", "surrogatepass")
    cuts = [0, *np.stack([starts, ends], 1).ravel().tolist(), len(raw)]
    return raw, b"".join(raw[a:b] for a, b in zip(cuts[::2], cuts[1::2]))


def remove_copies(docs: DataFrame, length: int = LENGTH, keep: str = "first", id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, kept (UTF-8 bytes without the copies), n_removed of every row."""
    texts = keyed(narrow(docs, id_col, text_col))

    def digest(doc_id, text, starts, ends):
        raw, kept = _remove(text, starts, ends)
        return {"doc_id": doc_id, "kept": kept, "n_removed": len(raw) - len(kept)}

    return with_spans(texts, find_copies(texts, length, keep=keep), "doc_id long, kept binary, n_removed long", digest)


def copy_report(docs: DataFrame) -> DataFrame:
    """doc_id, n_bytes, n_removed, n_spans and kept_sha256 of every document, all copies removed."""
    texts = keyed(narrow(docs, "doc_id", "text"))

    def digest(doc_id, text, starts, ends):
        raw, kept = _remove(text, starts, ends)
        return {"doc_id": doc_id, "n_bytes": len(raw), "n_removed": len(raw) - len(kept), "n_spans": len(starts), "kept_sha256": hashlib.sha256(kept).hexdigest()}

    return with_spans(texts, find_copies(texts, keep="none"), "doc_id long, n_bytes long, n_removed long, n_spans long, kept_sha256 string", digest)
