"""Small helpers that several operators share."""

from __future__ import annotations

import ctypes
import gc
import uuid
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..session import cut_lineage, drop_table, shared_path  # noqa: F401  (used by the operators)

#: Characters (or bytes) of text that a task works on at once.
STEP = 1 << 20
#: How to free what tasks have left in this worker process for the next task.
_kept: list[Callable[[], object]] = []


def keep(clear: Callable[[], object]) -> None:
    """A cache that outlives its task, and ``clear`` to empty it."""
    if clear not in _kept:
        _kept.append(clear)


def free_kept() -> None:
    """Empty the caches of earlier jobs in a worker process that is used again, and give back what Arrow has left over from them."""
    pa.default_memory_pool().release_unused()
    if _kept:
        while _kept:
            _kept.pop()()
        gc.collect()
        if hasattr(trim := ctypes.CDLL(None), "malloc_trim"):  # glibc keeps freed pieces otherwise
            trim.malloc_trim(0)


def fresh(df: DataFrame, name: str) -> str:
    """``name``, or a variant of it that no column of ``df`` has."""
    taken = {c.lower() for c in df.columns}
    return name if name.lower() not in taken else f"{name}_{uuid.uuid4().hex[:8]}"


def narrow(df: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """Only ``doc_id`` and ``text``, so that further columns of any name are harmless."""
    return df.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text"))


def utf8_size(text: Column) -> Column:
    """UTF-8 bytes of a text; null has none."""
    return F.coalesce(F.octet_length(text), F.lit(0)).cast("long")


def words_of(text: Column) -> Column:
    """Number of runs of characters other than ASCII white space."""
    return F.coalesce(F.regexp_count(text, F.lit(r"[^\x20\x09-\x0D]+")), F.lit(0)).cast("long")


def raw_texts(column) -> tuple[np.ndarray, np.ndarray]:
    """(bytes, offsets) of an Arrow string column without copying; a null text has length 0."""
    arr = column.combine_chunks() if isinstance(column, pa.ChunkedArray) else column
    if not pa.types.is_large_string(arr.type):
        arr = arr.cast(pa.large_string())
    if arr.null_count:
        arr = arr.fill_null("")
    _, offsets, data = arr.buffers()
    n = len(arr)
    if n == 0:
        return np.zeros(0, np.uint8), np.zeros(1, np.int64)
    off = np.frombuffer(offsets, np.int64, n + 1, arr.offset * 8)
    body = np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8)
    return body[off[0]:off[-1]], off - off[0]


def in_steps(sizes: np.ndarray, step: int = STEP) -> Iterator[tuple[int, int]]:
    """Ranges of rows with about ``step`` in total; a larger row stands alone."""
    lo, n = 0, len(sizes)
    ends = np.cumsum(sizes)
    while lo < n:
        base = ends[lo - 1] if lo else 0
        hi = max(lo + 1, int(np.searchsorted(ends, base + step, "right")))
        yield lo, hi
        lo = hi


def mix64(x: np.ndarray) -> np.ndarray:
    """A bijective scrambling of 64-bit values."""
    x = x.astype(np.uint64, copy=True)
    x ^= x >> np.uint64(30)
    x *= np.uint64(0xBF58476D1CE4E5B9)
    x ^= x >> np.uint64(27)
    x *= np.uint64(0x94D049BB133111EB)
    x ^= x >> np.uint64(31)
    return x
