"""Language identification with hyperdimensional profiles.

Every letter has a random vector of +1 and -1. A trigram binds the vectors of its letters,
each turned by its place, by multiplication; a text bundles its trigrams by addition; the
normalised bundles of a language's labelled texts add up to its prototype. A text gets the
language whose prototype has the largest cosine with its bundle.

Null, empty and letterless texts are ``und`` with score 0. Ties go to the language that
sorts first. A table without labelled rows teaches no language, so every text is ``und``.
Rows are judged one by one, so repeated rows get equal results; other columns play no part.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, StringType, StructField, StructType

from .common import free_kept, fresh, in_steps, narrow

#: Classes of letters: 0 is the gap between words, 1-26 are a-z, the others share the rest.
CLASSES = 64
DIM = 512
SEED = 7
#: Whole numbers, so that prototypes do not depend on the order of addition.
UNIT = 100_000
UNKNOWN = "und"


@lru_cache(1)
def _letter_classes() -> np.ndarray:
    table = np.zeros(0x110000, np.uint8)
    for cp in range(0x110000):
        if chr(cp).isalpha():
            table[cp] = cp - 96 if 97 <= cp <= 122 else 27 + cp * 2654435761 % 4294967296 % (CLASSES - 27)
    return table


@lru_cache(4)
def _letter_vectors(dim: int, seed: int) -> tuple[np.ndarray, ...]:
    first = np.random.default_rng(seed).integers(0, 2, (CLASSES, dim), np.int8) * np.int8(2) - np.int8(1)
    return np.roll(first, 2, 1), np.roll(first, 1, 1), first


def bundles(texts: list[str], dim: int = DIM, seed: int = SEED) -> np.ndarray:
    """One bundled vector a text; zeros where a text has no letter."""
    low = [t.lower() for t in texts]
    size = np.array([len(t) for t in low], np.int64)
    cps = np.frombuffer("".join(low).encode("utf-32-le", "surrogatepass"), "<u4")
    # two gaps before each text and one behind keep trigrams inside it
    room = size + 3
    start = np.cumsum(room) - room
    doc = np.repeat(np.arange(len(texts)), room)
    cls = np.zeros(len(doc), np.uint8)
    cls[np.arange(len(cps)) + np.repeat(start + 2 - (np.cumsum(size) - size), size)] = _letter_classes()[cps]
    keep = np.ones(len(cls), bool)
    keep[1:] = (cls[1:] > 0) | (cls[:-1] > 0) | (doc[1:] != doc[:-1])
    cls, doc = cls[keep].astype(np.int64), doc[keep]
    if len(cls) < 3:
        return np.zeros((len(texts), dim), np.float64)
    code = (cls[:-2] * CLASSES + cls[1:-1]) * CLASSES + cls[2:]
    ok = (doc[:-2] == doc[2:]) & (code > 0)
    key, count = np.unique(doc[:-2][ok] * CLASSES**3 + code[ok], return_counts=True)
    grams, at = np.unique(key % CLASSES**3, return_inverse=True)
    exact = np.float32 if len(cls) < 1 << 24 else np.float64  # both add whole numbers exactly
    table = np.zeros((len(texts), len(grams)), exact)
    table[key // CLASSES**3, at] = count
    a, b, c = _letter_vectors(dim, seed)
    bound = a[grams // CLASSES**2] * b[grams // CLASSES % CLASSES] * c[grams % CLASSES]
    return (table @ bound.astype(exact)).astype(np.float64)


def _unit(vectors: np.ndarray) -> np.ndarray:
    norm = np.sqrt((vectors * vectors).sum(1, keepdims=True))
    return vectors / np.where(norm == 0, 1, norm)


def _batches(texts: pa.Array) -> Iterator[tuple[int, int, list[str]]]:
    sizes = pc.fill_null(pc.utf8_length(texts), 0).to_numpy(zero_copy_only=False)
    for lo, hi in in_steps(sizes.astype(np.int64) + 3, 1 << 19):  # only these become Python strings at once
        yield lo, hi, [t or "" for t in texts.slice(lo, hi - lo).to_pylist()]


def train(docs: DataFrame, lang: str = "lang", text: str = "text", dim: int = DIM, seed: int = SEED) -> tuple[list[str], np.ndarray]:
    """Languages in order and their prototypes, from every row with a language and a text.

    Tasks add up what they read; the driver receives one vector a language.
    """

    def partial(batches):
        free_kept()
        total: dict[str, np.ndarray] = {}
        for batch in batches:
            langs = np.array(batch.column(0).to_pylist(), object)
            for lo, hi, texts in _batches(batch.column(1)):
                unit = np.rint(_unit(bundles(texts, dim, seed)) * UNIT).astype(np.int64)
                for name in set(langs[lo:hi]):
                    total[name] = total.get(name, 0) + unit[langs[lo:hi] == name].sum(0)
        if total:
            yield pa.RecordBatch.from_arrays(
                [pa.array(list(total)), pa.array([v.tolist() for v in total.values()], pa.list_(pa.int64()))], ["lang", "total"])

    rows = docs.select(F.col(lang).cast("string").alias("lang"), F.col(text).cast("string").alias("text")).where("lang IS NOT NULL AND text IS NOT NULL")
    sums = (rows.mapInArrow(partial, "lang string, total array<long>").select("lang", F.posexplode("total").alias("at", "v"))
            .groupBy("lang", "at").agg(F.sum("v").alias("v")).collect())
    names = sorted({r["lang"] for r in sums})
    proto = np.zeros((len(names), dim))
    for r in sums:
        proto[names.index(r["lang"]), r["at"]] = r["v"]
    some = proto.any(1) if len(names) else np.zeros(0, bool)
    return [n for n, x in zip(names, some) if x], _unit(proto[some]) if len(names) else proto


def classify(texts: list[str], model: tuple[list[str], np.ndarray], seed: int = SEED) -> tuple[np.ndarray, np.ndarray]:
    """Language and cosine (not below 0) of each text."""
    names, proto = model
    lang, score = np.full(len(texts), UNKNOWN, object), np.zeros(len(texts))
    if names:
        vectors = bundles(texts, proto.shape[1], seed)
        cosine = _unit(vectors) @ proto.T
        some = vectors.any(1)
        best = cosine.argmax(1)
        lang[some] = np.array(names, object)[best[some]]
        score[some] = np.clip(cosine[np.arange(len(texts)), best][some], 0.0, 1.0)
    return lang, score


def add_language(docs: DataFrame, model: tuple[list[str], np.ndarray], text: str = "text", lang_out: str = "lang_pred",
                 score_out: str = "score", seed: int = SEED) -> DataFrame:
    """``docs`` with two more columns; clashing names of ``docs`` must be renamed by the caller."""
    at = docs.columns.index(text)

    def label(batches):
        free_kept()
        for batch in batches:
            lang, score = np.full(batch.num_rows, UNKNOWN, object), np.zeros(batch.num_rows)
            for lo, hi, texts in _batches(batch.column(at)):
                lang[lo:hi], score[lo:hi] = classify(texts, model, seed)
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(lang, pa.string()), pa.array(score, pa.float64())],
                                             [*batch.schema.names, lang_out, score_out])

    return docs.mapInArrow(label, StructType([*docs.schema.fields, StructField(lang_out, StringType()), StructField(score_out, DoubleType())]))


def is_held_out(doc_id: Column) -> Column:
    """One document in four by its id; never for a null id."""
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % 4 == 2, F.lit(False))


def train_on_open_part(docs: DataFrame) -> tuple[list[str], np.ndarray]:
    """Learn from the documents that are not held out; rows without an id teach nothing."""
    return train(docs.where(F.col("doc_id").isNotNull() & ~is_held_out(F.col("doc_id"))))


def language_report(docs: DataFrame) -> DataFrame:
    """doc_id, held_out, lang_pred and score of every document."""
    return add_language(narrow(docs, "doc_id", "text"), train_on_open_part(docs)).select(
        "doc_id", is_held_out(F.col("doc_id")).alias("held_out"), "lang_pred", "score")


def keep_identified(docs: DataFrame) -> DataFrame:
    """The rows of ``docs`` in which a language can be seen; letterless and null texts go.

    Where no row teaches a language, only the letters are asked for.
    """
    lang, score = fresh(docs, "lang_pred"), fresh(docs, "score")
    model = train_on_open_part(docs)
    if not model[0]:
        return docs.where(F.col("text").rlike(r"\p{L}"))
    return add_language(docs, model, "text", lang, score).where(F.col(lang) != UNKNOWN).drop(lang, score)
