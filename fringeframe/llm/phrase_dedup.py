"""Substring dedup with repeated-phrase automata.

Windows of ``length`` words that occur more than once are found and removed but for their
first occurrence. Candidates come from :mod:`repeats`: equal stretches of words are folded
and decided there; stretches that share an anchor but differ are streamed, shard by shard,
through an Aho-Corasick automaton over the shard's recurring phrases, with words as letters.
A shard is a bounded number of whole anchor groups; a phrase always falls in one anchor's
group, so the shard's automaton finds every occurrence, and a document's words only go
to the shards that have phrases for them. A phrase is confirmed by the automaton's match of
its words, not by its hash.

Defined results: a null text has no words; texts shorter than ``length`` words lose nothing;
a null id comes last in order; rows with the same id are ordered by a hash of their text, and
rows that agree in both are one document. Windows are judged on the input. An empty table gives
no rows; other columns play no part.
"""

from __future__ import annotations

import hashlib

import ahocorasick
import numpy as np
from pyspark.sql import DataFrame

from .common import mix64, narrow
from .repeats import Rule, groups, keyed, span_rows, spans, with_spans

LENGTH, GRAM = 20, 6


def _letters(body: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """A number for each word of the pieces (equal words, equal numbers), and the words of each piece."""
    lists = [b.split(b" ") for b in body]
    names: dict[bytes, int] = {}
    number = names.setdefault
    return np.array([number(w, len(names)) for ws in lists for w in ws], np.int64), np.array([len(ws) for ws in lists], np.int64)


def _recurring(letters: np.ndarray, at: np.ndarray, group: np.ndarray, length: int) -> np.ndarray:
    """Windows (indices of ``at``) whose words, by hash, recur in their group."""
    key = group.astype(np.uint64)
    for j in range(length):
        key = mix64(key + letters[at + j].astype(np.uint64) + np.uint64(j + 1))
    _, same, n = np.unique(key, return_inverse=True, return_counts=True)
    return np.flatnonzero(n[same] > 1)


def _hits(cols: list[np.ndarray], length: int):
    """(rid, place) of the windows of a shard's pieces that occur earlier."""
    anchor, doc, rid, start, count, body = cols
    letters, sizes = _letters(body)
    offset = np.cumsum(sizes) - sizes
    piece = np.repeat(np.arange(len(count)), count)
    inner = np.arange(len(piece)) - np.repeat(np.cumsum(count) - count, count)
    group = np.cumsum(np.concatenate([[0], anchor[1:] != anchor[:-1]]))
    some = _recurring(letters, offset[piece] + inner, group[piece], length)
    if not len(some):
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    automaton = ahocorasick.Automaton(ahocorasick.STORE_INTS, ahocorasick.KEY_SEQUENCE)
    words = letters.tolist()
    known: dict[tuple, int] = {}
    for p, i in zip(piece[some].tolist(), inner[some].tolist()):
        o = int(offset[p]) + i
        known.setdefault(tuple(words[o : o + length]), len(known))
    for phrase, k in known.items():
        automaton.add_word(phrase, k)
    automaton.make_automaton()
    which, where, whose = [], [], []
    for p in np.unique(piece[some]).tolist():
        o = int(offset[p])
        for end, k in automaton.iter(tuple(words[o : o + int(sizes[p])])):
            which.append(k)
            where.append(end - length + 1)
            whose.append(p)
    which, where, whose = (np.array(x, np.int64) for x in (which, where, whose))
    place = start[whose] + where
    order = np.lexsort((place, rid[whose], doc[whose], which))
    which, place, r = which[order], place[order], rid[whose[order]]
    head = np.concatenate([[True], which[1:] != which[:-1]])
    first = np.flatnonzero(head)[np.cumsum(head) - 1]
    later = (r != r[first]) | (place != place[first])
    r, place = r[later], place[later]
    order = np.lexsort((place, r))
    return r[order], place[order]


def find_repeats(texts: DataFrame, length: int = LENGTH, gram: int = GRAM) -> DataFrame:
    """(rid, start, end): spans of words, of texts with doc_id, text and rid, that repeat earlier words."""
    rule = Rule(True, length, min(gram, length), True)

    def compare(batches):
        for cols in groups(batches):
            rid, at = _hits(cols, length)
            if len(rid):
                yield span_rows(rid, at, length)

    return spans(texts, rule, compare)


def _remove(text: str | None, starts: np.ndarray, ends: np.ndarray) -> tuple[int, list[bytes]]:
    words = (text or "").encode("utf-8", "surrogatepass").split()
    cuts = [0, *np.stack([starts, ends], 1).ravel().tolist(), len(words)]
    return len(words), [w for a, b in zip(cuts[::2], cuts[1::2]) for w in words[a:b]]


def remove_repeats(docs: DataFrame, length: int = LENGTH, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, kept (words joined by one space), n_removed of every row."""
    texts = keyed(narrow(docs, id_col, text_col))

    def digest(doc_id, text, starts, ends):
        n, kept = _remove(text, starts, ends)
        return {"doc_id": doc_id, "kept": b" ".join(kept).decode("utf-8", "surrogatepass"), "n_removed": n - len(kept)}

    return with_spans(texts, find_repeats(texts, length), "doc_id long, kept string, n_removed long", digest)


def repeat_report(docs: DataFrame) -> DataFrame:
    """doc_id, n_words, n_removed and kept_sha256 of every document."""
    texts = keyed(narrow(docs, "doc_id", "text"))

    def digest(doc_id, text, starts, ends):
        n, kept = _remove(text, starts, ends)
        return {"doc_id": doc_id, "n_words": n, "n_removed": n - len(kept), "kept_sha256": hashlib.sha256(b" ".join(kept)).hexdigest()}

    return with_spans(texts, find_repeats(texts), "doc_id long, n_words long, n_removed long, kept_sha256 string", digest)
