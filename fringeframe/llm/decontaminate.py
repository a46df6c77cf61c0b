"""Benchmark decontamination with one Aho-Corasick automaton over normalised test texts.

Normalising lower-cases A-Z and turns every other ASCII character that is neither a letter
nor a digit into white space, byte for byte, so that a word's place in the normalised text
is its place in the original. The automaton holds every run of ``window`` words of every
item (an item with fewer words is one run), written with one space around each word; a text
is scanned once, written the same way, and the matches give the words and the original
UTF-8 spans that are hit.

The automaton is built from the benchmark, not from the documents. Its size is checked: a
benchmark beyond ``PART`` bytes of patterns is cut by hash into parts, each with a scan of
its own, and the parts' hits are joined.

Defined results: null and empty texts have no words and no hits; items without words are
never found; items with the same id count once, and an item without an id can be hit but
is not listed; repeated rows are judged alike. Empty tables give empty or clean results.
"""

from __future__ import annotations

import ahocorasick
import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from .common import cut_lineage, narrow

WINDOW = 10
#: Bytes of patterns in one automaton; about fifty times this in memory at most.
PART = 4 << 20

#: What each byte becomes. Bytes of non-ASCII characters stay.
_KEEP = bytes(range(0x30, 0x3A)) + bytes(range(0x41, 0x5B)) + bytes(range(0x61, 0x7B)) + bytes(range(0x80, 0x100))
NORMAL = bytes(c + 32 if 0x41 <= c <= 0x5A else c if c in _KEEP else 0x20 for c in range(256))

HITS = "n_words long, n_hit long, items array<string>, words array<int>, spans array<struct<start:long,end:long>>"


def normal_words(text: str | None) -> list[bytes]:
    return (text or "").encode("utf-8", "surrogatepass").translate(NORMAL).split()


def _windows(words: list[bytes], window: int) -> list[bytes]:
    if not words:
        return []
    return [b" ".join(words[i : i + window]) for i in range(max(1, len(words) - window + 1))]


def patterns(benchmark: DataFrame, window: int = WINDOW) -> DataFrame:
    """(pattern, items): every distinct run of words with the ids of the items that have it."""

    def cut(batches):
        for batch in batches:
            ids, out = [], []
            for item, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                for w in set(_windows(normal_words(text), window)):
                    ids.append(item)
                    out.append(w)
            yield pa.RecordBatch.from_arrays([pa.array(out, pa.binary()), pa.array(ids, pa.string())], ["pattern", "item"])

    rows = benchmark.select(F.col("item_id").cast("string").alias("item"), F.col("text").cast("string").alias("text"))
    return rows.mapInArrow(cut, "pattern binary, item string").groupBy("pattern").agg(F.collect_set("item").alias("items"))


class Scanner:
    """An automaton that is built where it is first used, from patterns that travel as plain data."""

    def __init__(self, rows: list[tuple[bytes, list[str]]]):
        self.rows = rows

    def __getstate__(self):
        return self.rows

    def __setstate__(self, rows):
        self.rows = rows

    @property
    def automaton(self):
        made = self.__dict__.get("_made")
        if made is None:
            made = ahocorasick.Automaton()
            for pattern, items in self.rows:
                made.add_word(f" {pattern.decode('latin-1')} ", (pattern.count(b" ") + 1, items))
            made.make_automaton()
            self._made = made
        return made

    def hits(self, words: list[bytes]) -> tuple[np.ndarray, set[str]]:
        """Which words are hit, and the items."""
        hit, items = np.zeros(len(words), bool), set()
        if not self.rows or not words:
            return hit, items
        text = f" {b' '.join(words).decode('latin-1')} "
        found = list(self.automaton.iter(text))
        if found:
            ends = np.cumsum(np.fromiter((len(w) + 1 for w in words), np.int64, len(words)))
            for end, (n, who) in found:
                last = int(np.searchsorted(ends, end))  # the word before the closing space
                hit[last - n + 1 : last + 1] = True
                items.update(who)
        return hit, items


def _spans(text: str, hit: np.ndarray) -> list[dict]:
    """UTF-8 spans in the original of the runs of hit words."""
    is_word = np.frombuffer(text.encode("utf-8", "surrogatepass").translate(NORMAL), np.uint8) != 0x20
    edge = np.flatnonzero(np.diff(np.concatenate([[False], is_word, [False]]).astype(np.int8)))
    starts, ends = edge[::2], edge[1::2]
    run = np.flatnonzero(np.diff(np.concatenate([[False], hit, [False]]).astype(np.int8)))
    return [{"start": int(starts[a]), "end": int(ends[b - 1])} for a, b in zip(run[::2], run[1::2])]


def scanners(benchmark: DataFrame, window: int = WINDOW, part: int = PART) -> list:
    """Broadcast automata, as many as the size of the benchmark asks for; one as a rule."""
    found = cut_lineage(patterns(benchmark, window))
    spark = found.sparkSession
    size = found.agg(F.sum(F.length("pattern") + F.coalesce(F.aggregate("items", F.lit(0), lambda a, x: a + F.length(x)), F.lit(0)))).first()[0] or 0
    n = int(size // part) + 1
    out = []
    for i in range(n):
        rows = found.where(F.pmod(F.xxhash64("pattern"), F.lit(n)) == i).orderBy("pattern").collect()  # at most about ``part`` bytes
        out.append(spark.sparkContext.broadcast(Scanner([(bytes(r[0]), sorted(r[1])) for r in rows])))
    return out


def _scan(batch_texts: list[str | None], scanner: Scanner, spans: bool):
    """n_words, n_hit, items, hit words and, if asked for, their spans, of each text."""
    for text in batch_texts:
        words = normal_words(text)
        hit, items = scanner.hits(words)
        some = bool(hit.any())
        yield len(words), int(hit.sum()), sorted(items), np.flatnonzero(hit).tolist(), _spans(text, hit) if some and spans else []


def find_leaks(docs: DataFrame, benchmark: DataFrame, id_col: str = "doc_id", text_col: str = "text", window: int = WINDOW, part: int = PART) -> DataFrame:
    """doc_id, n_words, n_hit, items (sorted as strings), words and original spans that are hit, for every row."""
    rows = narrow(docs, id_col, text_col)

    def scan(shared):
        def run(batches):
            for batch in batches:
                cols = list(zip(*_scan(batch.column(1).to_pylist(), shared.value, True))) or [[]] * 5
                kinds = [pa.int64(), pa.int64(), pa.list_(pa.string()), pa.list_(pa.int32()), pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64())]))]
                yield pa.RecordBatch.from_arrays([batch.column(0), *(pa.array(list(c), k) for c, k in zip(cols, kinds))],
                                                 ["doc_id", "n_words", "n_hit", "items", "words", "spans"])

        return rows.mapInArrow(run, "doc_id long, " + HITS)

    shared = scanners(benchmark, window, part)
    if len(shared) == 1:
        return scan(shared[0])
    # several parts: join their hits row by row; rows are told apart by id and text
    rows = cut_lineage(rows.select("doc_id", "text"))
    keyed = rows.select("doc_id", "text", F.sha2(F.concat_ws("|", F.coalesce(F.col("doc_id").cast("string"), F.lit("?")), F.coalesce(F.sha2("text", 256), F.lit("?"))), 256).alias("row"))
    return _merge(keyed, shared)


def _merge(keyed: DataFrame, shared: list) -> DataFrame:
    def scan(one):
        def run(batches):
            for batch in batches:
                got = [(r, n, items, words) for r, (n, _, items, words, _) in zip(batch.column(2).to_pylist(), _scan(batch.column(1).to_pylist(), one.value, False))]
                cols = list(zip(*got)) or [[]] * 4
                kinds = [pa.string(), pa.int64(), pa.list_(pa.string()), pa.list_(pa.int32())]
                yield pa.RecordBatch.from_arrays([pa.array(list(c), k) for c, k in zip(cols, kinds)], ["row", "n_words", "items", "words"])

        return keyed.mapInArrow(run, "row string, n_words long, items array<string>, words array<int>")

    parts = scan(shared[0])
    for one in shared[1:]:
        parts = parts.unionByName(scan(one))
    each = parts.groupBy("row").agg(F.first("n_words").alias("n_words"),
                                    F.array_sort(F.array_distinct(F.flatten(F.collect_set("items")))).alias("items"),
                                    F.array_sort(F.array_distinct(F.flatten(F.collect_set("words")))).alias("words"))

    def spans(batches):
        for batch in batches:
            out = []
            for text, n, words in zip(*(batch.column(i).to_pylist() for i in (4, 1, 3))):
                hit = np.zeros(n, bool)
                hit[words] = True
                out.append(_spans(text or "", hit))
            n_hit = pa.array([len(w) for w in batch.column(3).to_pylist()], pa.int64())
            kind = pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64())]))
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), n_hit, *batch.columns[2:4], pa.array(out, kind)],
                                             ["doc_id", "n_words", "n_hit", "items", "words", "spans"])

    rows = keyed.join(each, "row").select("doc_id", "n_words", "items", "words", "text")
    return rows.mapInArrow(spans, "doc_id long, " + HITS)


def leak_report(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """The digest of :func:`find_leaks`."""
    return find_leaks(docs, benchmark).select(
        "doc_id", "n_words", "n_hit", F.size("items").cast("long").alias("n_items"),
        F.sha2(F.array_join("items", ",").cast("binary"), 256).alias("items_sha256"), (F.col("n_hit") > 0).alias("contaminated"))


def keep_clean(docs: DataFrame, benchmark: DataFrame, text_col: str = "text", window: int = WINDOW, part: int = PART) -> DataFrame:
    """The rows of ``docs`` without a hit, with all their columns."""
    at = docs.columns.index(text_col)
    out = docs
    for one in scanners(benchmark, window, part):

        def run(batches, one=one):
            for batch in batches:
                clean = [not one.value.hits(normal_words(t))[0].any() for t in batch.column(at).to_pylist()]
                yield batch.filter(pa.array(clean, pa.bool_()))

        out = out.mapInArrow(run, StructType(list(docs.schema.fields)))
    return out
