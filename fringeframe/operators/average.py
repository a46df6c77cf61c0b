"""Averaging along the spectrum and concatenation of spectra and tables."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.order import array_sum


def _blocks(arr: Column, n: int) -> Column:
    """Cut an array into pieces of ``n``; an error unless ``n`` divides its length."""
    size = F.size(arr)
    checked = F.when(size % n == 0, F.floor(size / n).cast("int")).otherwise(
        F.raise_error(F.concat(F.lit(f"{n} does not divide the number of channels, "), size.cast("string"))).cast("int")
    )
    return F.transform(F.sequence(F.lit(0), checked - 1), lambda i: F.slice(arr, i * n + 1, n))


def average_channels(df: DataFrame, n: int, sigma: bool = False) -> DataFrame:
    """Mean of the unflagged channels in blocks of ``n``; an empty block is zero and flagged.

    ``freq`` (if there) is averaged and ``chan_width`` multiplied.  With ``sigma``
    the noise becomes sqrt(sum sigma^2) / count.  Nothing leaves the row.
    """
    if n < 2:
        return df
    names = ["re", "im", "flag"] + (["sigma"] if sigma else [])
    good = F.transform(_blocks(F.arrays_zip(*names), n), lambda b: F.filter(b, lambda s: ~s["flag"]))
    out = df.withColumn("__good", good)

    def mean(field):
        return lambda b: F.when(F.size(b) > 0, array_sum(F.transform(b, lambda s: s[field])) / F.size(b)).otherwise(0.0)

    cols = {
        "re": F.transform("__good", mean("re")),
        "im": F.transform("__good", mean("im")),
        "flag": F.transform("__good", lambda b: F.size(b) == 0),
    }
    if sigma:
        cols["sigma"] = F.transform("__good", lambda b: F.when(
            F.size(b) > 0,
            F.sqrt(array_sum(F.transform(b, lambda s: s["sigma"] * s["sigma"]))) / F.size(b)).otherwise(0.0))
    if "freq" in df.columns:
        cols["freq"] = F.transform(_blocks(F.col("freq"), n), lambda b: array_sum(b) / F.lit(float(n)))
    if "chan_width" in df.columns:
        cols["chan_width"] = F.col("chan_width") * n
    if sigma and "row_sigma" in df.columns:
        cols["row_sigma"] = F.col("row_sigma") / F.sqrt(F.lit(float(n)))
    for name, c in cols.items():
        out = out.withColumn(name, c)
    return out.drop("__good")


def concat_tables(tables: Sequence[DataFrame], dims: Sequence[DataFrame], key: str, attrs: Sequence[str]):
    """Append visibility tables whose ``key`` points into their own dimension table.

    Returns (rows, dimension): equal dimension rows (by ``attrs``) get one id,
    taken from a hash of the attributes, so no global numbering is needed.
    """
    new_id = F.xxhash64(*attrs).alias("__new")
    merged = reduce(DataFrame.unionByName, [d.select(*attrs) for d in dims]).distinct().select(new_id, *attrs)
    rows = [
        t.join(d.select(key, new_id), key).drop(key).withColumnRenamed("__new", key)
        for t, d in zip(tables, dims)
    ]
    return reduce(DataFrame.unionByName, rows), merged.withColumnRenamed("__new", key)


def merge_spectra(tables: Sequence[DataFrame], keys: Sequence[str], arrays: Sequence[str]) -> DataFrame:
    """Join tables on their row key and concatenate their spectra in the given order.

    Other columns come from the first table.
    """
    keys = list(keys)
    first, *rest = tables
    out = first
    for i, t in enumerate(rest):
        out = out.join(t.select(*keys, *[F.col(a).alias(f"__{a}_{i}") for a in arrays]), keys)
    for a in arrays:
        parts = [F.col(a)] + [F.col(f"__{a}_{i}") for i in range(len(rest))]
        out = out.withColumn(a, F.concat(*parts))
    return out.drop(*[f"__{a}_{i}" for a in arrays for i in range(len(rest))])


def explode_spectra(df: DataFrame, keys: Sequence[str], names: Sequence[str] = ("re", "im", "flag")) -> DataFrame:
    """One row per channel; for operators that work across rows."""
    z = F.arrays_zip(*names)
    d = df.select(*keys, F.posexplode(z).alias("chan", "__s"))
    return d.select(*keys, F.col("chan").cast("long").alias("chan"), *[F.col(f"__s.{n}").alias(n) for n in names])
