"""Plain versions of the operators, for small tables."""

from __future__ import annotations

import hashlib
import re

WORD = re.compile(r"[^\x20\x09-\x0D]+")
LOWER = {c: c + 32 for c in range(65, 91)}


def words(text):
    return WORD.findall(text or "")


def sha(b):
    return hashlib.sha256(b if isinstance(b, bytes) else b.encode()).hexdigest()


def leaks(docs, items, window=10):
    """{doc_id: (n_words, hit words, item ids)}"""
    norm = lambda t: re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", (t or "").translate(LOWER))
    out = {}
    for d, t in docs:
        w, hit, who = norm(t), set(), set()
        for item, it in items:
            iw = norm(it)
            n = min(window, len(iw))
            runs = {tuple(iw[i : i + n]) for i in range(len(iw) - n + 1)} if n else set()
            for p in range(len(w) - n + 1) if n else ():
                if tuple(w[p : p + n]) in runs:
                    hit.update(range(p, p + n))
                    if item is not None:
                        who.add(str(item))
        out[d] = (len(w), hit, sorted(who))
    return out


def phrase_kept(docs, length=20):
    """{doc_id: (n_words, kept words)} after removal of windows that start earlier; docs sorted by id, null last."""
    seen, out = set(), {}
    for d, t in docs:
        w = words(t)
        gone = [False] * len(w)
        for p in range(len(w) - length + 1):
            k = tuple(w[p : p + length])
            if k in seen:
                gone[p : p + length] = [True] * length
            seen.add(k)
        out[d] = (len(w), [x for x, g in zip(w, gone) if not g])
    return out


def bytes_kept(docs, length=200, keep="none"):
    """{doc_id: (n_bytes, kept, spans)}"""
    count, out, seen = {}, {}, set()
    raw = [(d, (t or "").encode()) for d, t in docs]
    for _, b in raw:
        for p in range(len(b) - length + 1):
            k = b[p : p + length]
            count[k] = count.get(k, 0) + 1
    for d, b in raw:
        gone = bytearray(len(b))
        for p in range(len(b) - length + 1):
            k = b[p : p + length]
            if count[k] > 1 and (keep == "none" or k in seen):
                gone[p : p + length] = b"\1" * length
            seen.add(k)
        spans = sum(1 for i in range(len(gone)) if gone[i] and not (i and gone[i - 1]))
        out[d] = (len(b), bytes(x for x, g in zip(b, gone) if not g), spans)
    return out


def components(docs, percent=85, k=4):
    """{doc_id: (n_shingles, component)}"""
    sets = {}
    for d, t in docs:
        w = words((t or "").translate(LOWER))
        sets[d] = {tuple(w[i : i + k]) for i in range(len(w) - k + 1)} if len(w) >= k else ({tuple(w)} if w else set())
    root = {d: d for d in sets}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    ids = sorted(sets)
    for i, a in enumerate(ids):
        for b in ids[i + 1 :]:
            s, t = sets[a], sets[b]
            both = len(s & t)
            if s and t and 100 * both >= percent * (len(s) + len(t) - both) and find(a) != find(b):
                x, y = sorted((find(a), find(b)))
                root[y] = x
    return {d: (len(sets[d]), find(d)) for d in ids}
