"""Repeated windows of a corpus: what the two substring operators share.

1. Every text is cut into stretches (:mod:`winnow`); equal stretches of a batch are folded.
2. Stretches meet by anchor in sorted streams. Equal stretches are decided there, by two
   64-bit hashes of their content. An anchor that only one stretch has is dropped at once.
3. Stretches that share an anchor but differ may still share some windows, if half a window
   beside the anchor agrees: one of each kind is then fetched with its content and compared by
   the operator's own method, anchor by anchor.
   Anchors with very many kinds are spread by window instead.
4. The spans that were found are merged text by text.

A stretch is a row of six numbers, whatever its length, and a stream keeps one row of state,
so neither a text that a third of the rows share nor a passage in a third of the texts gathers
in memory. Texts are told apart by id and content (``rid``): rows that agree in both are alike.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import cut_lineage, in_steps, raw_texts
from .winnow import stretches
from .wordhash import word_spans

#: A null id comes last.
LAST = (1 << 63) - 1
#: Kinds of stretches that are compared in one group.
GROUP = 4096


@dataclass(frozen=True)
class Rule:
    """What is compared (words or bytes), how long a window is, and whether its first occurrence stays."""

    words: bool
    length: int
    gram: int
    keep_first: bool


def keyed(rows: DataFrame) -> DataFrame:
    """doc_id, text, rid."""
    return rows.select("doc_id", "text", F.xxhash64("doc_id", "text").alias("rid"))


def _units(body: np.ndarray, offsets: np.ndarray, words: bool):
    """(bytes, unit spans, first unit of each text); words are joined by one space."""
    if not words:
        return body, None, offsets
    raw = body.tobytes()
    texts = [b" ".join(raw[a:b].split()) for a, b in zip(offsets[:-1].tolist(), offsets[1:].tolist())]
    joined = np.frombuffer(b"".join(texts), np.uint8)
    starts, ends, first = word_spans(joined, np.concatenate([[0], np.cumsum([len(t) for t in texts])]).astype(np.int64))
    return joined, (starts, ends), first


#: A stretch in six numbers: ``near`` is from :mod:`winnow`; ``spot`` holds 13 more bits of the content hash, the start (32 bits),
#: the number of windows (16 bits), and 1 for a single one or 2 for several equal ones. A span that is
#: decided has spot 0, its start in ``first`` and its end in ``doc``.
SPOTS = ["anchor", "first", "doc", "rid", "spot", "near"]


def _pack(second, start, count, copies):
    return (second & 0x1FFF) << 50 | start << 18 | count << 2 | np.minimum(copies, 2)


def _unpack(spot):
    """second, start, count, copies"""
    return spot >> 50, spot >> 18 & 0xFFFFFFFF, spot >> 2 & 0xFFFF, spot & 3


def _spots(rows: DataFrame, rule: Rule) -> DataFrame:
    """Stretches of all texts, equal ones of a batch as one, and the spans that this decides."""
    if rule.length > 60_000:
        raise ValueError("windows are limited to 60,000 units")

    def run(batches):
        for batch in batches:
            body, offsets = raw_texts(batch.column(1))
            doc = np.array([LAST if d is None else d for d in batch.column(0).to_pylist()], np.int64)
            if not rule.keep_first:
                doc[:] = 0  # the order of documents does not matter
            rid = batch.column(2).to_numpy(zero_copy_only=False)
            parts = []
            for lo, hi in in_steps(np.diff(offsets) + 1):
                s = stretches(*_units(body[offsets[lo] : offsets[hi]], offsets[lo : hi + 1] - offsets[lo], rule.words), rule.length, rule.gram)
                parts.append((s.anchor, s.first, s.second & 0x1FFF, doc[lo:hi][s.text], rid[lo:hi][s.text], s.start, s.count, s.near))
            if not parts:
                continue
            cols = [np.concatenate(p) for p in zip(*parts)]
            order = np.lexsort((cols[5], cols[4], cols[3], cols[2], cols[1], cols[0]))
            cols = [c[order] for c in cols]
            (rid_, start, end), head, copies = _decide(cols, np.ones(len(order), np.int64), np.zeros(len(order), bool), rule)
            anchor, first, second, doc_, r, at, count, near = (c[head] for c in cols)
            out = [(anchor, rid_), (first, start), (doc_, end), (r, rid_), (_pack(second, at, count, copies), np.zeros(len(rid_), np.int64)), (near, np.zeros(len(rid_), np.int64))]
            yield pa.RecordBatch.from_arrays([pa.array(np.concatenate(c)) for c in out], SPOTS)

    return rows.mapInArrow(run, ", ".join(f"{c} long" for c in SPOTS))


def _decide(cols, copies, done, rule: Rule):
    """Of sorted stretches: spans of those that are repeats for sure, the first row of each kind, and the kinds' copies."""
    n = len(copies)
    if not n:
        z = np.zeros(0, np.int64)
        return (z, z, z), z, z
    new = np.ones(n, bool)
    new[1:] = (cols[0][1:] != cols[0][:-1]) | (cols[1][1:] != cols[1][:-1]) | (cols[2][1:] != cols[2][:-1])
    head = np.flatnonzero(new)
    kind = np.cumsum(new) - 1
    total = np.add.reduceat(copies, head)
    if rule.keep_first:
        lead = head[kind]  # rows alike in id, content and place are one occurrence
        hit = (cols[4] != cols[4][lead]) | (cols[5] != cols[5][lead])
    else:
        hit = (total[kind] > 1) & ~done & (copies == 1)
    return (cols[4][hit], cols[5][hit], cols[5][hit] + cols[6][hit] + rule.length - 1), head, total


FOUND = ["piece", "anchor", "doc", "rid", "start", "count"]


def _meet(spots: DataFrame, rule: Rule) -> DataFrame:
    """Spans (rid, start, count = end) and pieces: one stretch of each kind of an anchor that has several."""

    def run(batches):
        carry, held, crowded = None, None, None

        def told(piece, anchor, doc, rid, start, count):
            n = len(rid)
            cols = [np.full(n, piece), *(np.zeros(n, np.int64) if c is None else c for c in (anchor, doc, rid, start, count))]
            return pa.RecordBatch.from_arrays([pa.array(c) for c in cols], FOUND)

        def pieces(kinds):
            """Of whole anchors, the kinds that may share a window with another one."""
            anchor, near = kinds[0], kinds[5]
            keep = np.zeros(len(anchor), bool)
            for half in (near >> 32 & 0xFFFFFFFF, near & 0xFFFFFFFF):
                order = np.lexsort((half, anchor))
                a, h = anchor[order], half[order]
                same = (a[1:] == a[:-1]) & (h[1:] == h[:-1]) & (h[1:] != 0)
                keep[order[1:]] |= same
                keep[order[:-1]] |= same
            return told(True, *(c[keep] for c in kinds[:5]))

        for batch in batches:
            anchor, first, doc, rid, spot, near = (c.to_numpy(zero_copy_only=False) for c in batch.columns)
            span = spot == 0
            if span.any():
                yield told(False, None, None, rid[span], first[span], doc[span])
                anchor, first, doc, rid, spot, near = (c[~span] for c in (anchor, first, doc, rid, spot, near))
            second, start, count, copies = _unpack(spot)
            cols = [anchor, first, second, doc, rid, start, count, copies, near]
            n = len(cols[0])
            if not n:
                continue
            done = cols[7] > 1  # their spans are written already
            if carry is not None:
                cols = [np.concatenate([[a], c]) for a, c in zip(carry[0], cols)]
                done = np.concatenate([[carry[1]], done])
            # a carried row may stand for several: its own span is open only while it is alone
            spans, head, total = _decide(cols[:7], np.where(done, np.maximum(cols[7], 2), cols[7]), done, rule)
            yield told(False, None, None, *spans)
            last = head[-1]
            carry = ([c[last] for c in cols[:7]] + [int(total[-1]), cols[8][last]], bool(total[-1] > 1))
            # kinds wait until their anchor is complete; those of a crowded anchor go on at once
            kinds = [cols[i][head[:-1]] for i in (0, 3, 4, 5, 6, 8)]
            kinds = [np.concatenate(x) for x in zip(held, kinds)] if held is not None else kinds
            closed = kinds[0] != carry[0][0]
            if crowded is not None:
                known = kinds[0] == crowded
                yield told(True, *(c[known] for c in kinds[:5]))
                kinds, closed = [c[~known] for c in kinds], closed[~known]
            yield pieces([c[closed] for c in kinds])
            held = [c[~closed] for c in kinds]
            if len(held[0]) > 4 * GROUP:
                yield told(True, *held[:5])
                crowded, held = held[0][0], None
        if carry is not None:
            kinds = [np.array([carry[0][i]]) for i in (0, 3, 4, 5, 6, 8)]
            kinds = [np.concatenate(x) for x in zip(held, kinds)] if held is not None else kinds
            known = kinds[0] == crowded if crowded is not None else np.zeros(len(kinds[0]), bool)
            yield told(True, *(c[known] for c in kinds[:5]))
            yield pieces([c[~known] for c in kinds])

    listed = spots.repartition("anchor").sortWithinPartitions("anchor", "first", "doc", "rid", "spot")
    return cut_lineage(listed.mapInArrow(run, "piece boolean, " + ", ".join(f"{c} long" for c in FOUND[1:])))


PIECES = "anchor long, doc long, rid long, start long, count long, body binary"


def _fetch(texts: DataFrame, pieces: DataFrame, rule: Rule, by_window: bool) -> DataFrame:
    """The content of the pieces; ``by_window`` cuts them into single windows under keys of their own."""
    wanted = pieces.groupBy("rid").agg(F.collect_list(F.struct("anchor", "doc", "start", "count")).alias("wanted"))  # no longer than its text

    def run(batches):
        for batch in batches:
            for lo in range(0, batch.num_rows, 64):
                out = []
                for rid, text, want in zip(*(batch.slice(lo, 64).column(i).to_pylist() for i in range(3))):
                    raw = (text or "").encode("utf-8", "surrogatepass")
                    units = raw.split() if rule.words else raw
                    for w in want:
                        a, n = w["start"], w["count"]
                        for i, k in ((j, 1) for j in range(n)) if by_window else ((0, n),):
                            part = units[a + i : a + i + k + rule.length - 1]
                            out.append((w["anchor"], w["doc"], rid, a + i, k, b" ".join(part) if rule.words else part))
                cols = list(zip(*out)) or [[]] * 6
                kinds = [pa.int64()] * 5 + [pa.binary()]
                yield pa.RecordBatch.from_arrays([pa.array(list(c), k) for c, k in zip(cols, kinds)], ["anchor", "doc", "rid", "start", "count", "body"])

    # with the id, though it is not needed, the shuffled texts are those that with_spans() uses again
    return texts.join(wanted, "rid").select("rid", "text", "wanted", "doc_id").mapInArrow(run, PIECES)


def groups(batches, most: int = GROUP) -> Iterator[list[np.ndarray]]:
    """Chunks of whole anchor groups from a stream sorted by anchor: about ``most`` pieces each."""
    held, n = [], 0
    for batch in batches:
        if not batch.num_rows:
            continue
        cols = [c.to_numpy(zero_copy_only=False) for c in batch.columns]
        held.append(cols)
        n += len(cols[0])
        if n >= most:
            cols = [np.concatenate(c) for c in zip(*held)]
            cut = int(np.searchsorted(cols[0], cols[0][-1], "left"))
            if cut:
                yield [c[:cut] for c in cols]
            held, n = [[c[cut:] for c in cols]], len(cols[0]) - cut
    if held:
        yield [np.concatenate(c) for c in zip(*held)]


def span_rows(rid: np.ndarray, at: np.ndarray, length: int) -> pa.RecordBatch:
    """Spans of runs of neighbouring windows (text, place), sorted by both."""
    new = np.ones(len(at), bool)
    new[1:] = (rid[1:] != rid[:-1]) | (at[1:] != at[:-1] + 1)
    head = np.flatnonzero(new)
    tail = np.append(head[1:], len(at)) - 1
    return pa.RecordBatch.from_arrays([pa.array(rid[head]), pa.array(at[head]), pa.array(at[tail] + length)], ["rid", "start", "end"])


def spans(texts: DataFrame, rule: Rule, compare: Callable) -> DataFrame:
    """(rid, start, end) of everything to remove. ``compare`` turns a sorted stream of pieces into such rows."""
    found = _meet(_spots(texts.select("doc_id", "text", "rid"), rule), rule)
    plain = found.where("NOT piece").select("rid", "start", F.col("count").alias("end"))
    pieces = found.where("piece").drop("piece")
    crowded = pieces.groupBy("anchor").count().where(F.col("count") > GROUP).select("anchor")
    crowded = cut_lineage(crowded)
    usual = pieces.join(crowded, "anchor", "left_anti")
    sent = _fetch(texts, usual, rule, False).repartition("anchor").sortWithinPartitions("anchor", "doc", "rid", "start")
    out = plain.unionByName(sent.mapInArrow(compare, "rid long, start long, end long"))
    if not crowded.isEmpty():
        single = _fetch(texts, pieces.join(crowded, "anchor"), rule, True)
        key = (F.xxhash64(F.lit(17), "body").alias("ka"), F.xxhash64(F.lit(41), "body").alias("kb"))  # 128 bits for a window
        single = single.select(*key, "doc", "rid", "start")  # not written: in one job, all read the same shuffled texts
        each = single.groupBy("ka", "kb").agg(F.count(F.lit(1)).alias("copies"), F.min(F.struct("doc", "rid", "start")).alias("lead")).where("copies > 1")
        hit = F.struct("doc", "rid", "start") > F.col("lead") if rule.keep_first else F.lit(True)
        out = out.unionByName(single.join(each, ["ka", "kb"]).where(hit).select("rid", "start", (F.col("start") + rule.length).alias("end")))
    return out


def with_spans(texts: DataFrame, found: DataFrame, out_schema: str, digest: Callable) -> DataFrame:
    """``digest(doc_id, text, starts, ends)`` of every text and its merged spans, as one row each."""
    mine = found.groupBy("rid").agg(F.array_sort(F.collect_list(F.struct("start", "end"))).alias("spans"))  # bounded by the text

    def run(batches):
        for batch in batches:
            out = []
            for doc_id, text, spans_ in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), batch.column(2)):
                a = b = np.zeros(0, np.int64)
                if spans_.is_valid:
                    both = spans_.values
                    a, b = both.field(0).to_numpy(), both.field(1).to_numpy()
                    reach = np.maximum.accumulate(b)
                    new = np.ones(len(a), bool)
                    new[1:] = a[1:] > reach[:-1]
                    head = np.flatnonzero(new)
                    a, b = a[head], reach[np.append(head[1:], len(a)) - 1]
                out.append(digest(doc_id, text, a, b))
            yield pa.RecordBatch.from_pylist(out, schema=_schema(out_schema))

    return texts.join(mine, "rid", "left").select("doc_id", "text", "spans").mapInArrow(run, out_schema)


def _schema(ddl: str) -> pa.Schema:
    kinds = {"long": pa.int64(), "string": pa.string(), "binary": pa.binary()}
    return pa.schema([(n, kinds[k]) for n, k in (f.split() for f in ddl.split(", "))])
