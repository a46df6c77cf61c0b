"""Range, as-of and dimension joins, written as equi joins on bucket columns."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


#: Rows of a table that is sent to every task; a larger one is joined by a salted shuffle.
SMALL, SALTS = 1_000_000, 32


def lookup_join(facts: DataFrame, table: DataFrame, keys: Sequence[str], how: str = "inner") -> DataFrame:
    """Join ``facts`` to a table on few distinct keys (antennas, fields).

    A small table is broadcast, so no fact moves. A larger one is repeated over salts and
    the facts of a key are spread over them, so that a key is not one task.
    """
    keys = list(keys)
    if table.count() <= SMALL:
        return facts.join(F.broadcast(table), keys, how)
    salt = F.pmod(F.xxhash64(*[F.col(f"`{c}`") for c in facts.columns]), F.lit(SALTS))
    spread = table.withColumn("__salt", F.explode(F.sequence(F.lit(0).cast("long"), F.lit(SALTS - 1).cast("long"))))
    return facts.withColumn("__salt", salt).join(spread, [*keys, "__salt"], how).drop("__salt")


# ---------------------------------------------------------------- times

def match_times(meta: DataFrame, data: DataFrame, meta_time: str, data_time: str, interval: int) -> DataFrame:
    """Pair cycles whose times differ by less than half an interval.

    The data's time is kept; a pair whose times differ is flagged whole.  Times
    are put into interval-wide buckets and metadata is repeated in the two
    neighbours, so this stays an equi join.
    """
    b = lambda c: F.floor(F.col(c) / F.lit(interval))
    m = meta.withColumn("__b", F.explode(F.array(b(meta_time) - 1, b(meta_time), b(meta_time) + 1)))
    j = m.join(data.withColumn("__b", b(data_time)), "__b")
    j = j.where(F.abs(F.col(data_time) - F.col(meta_time)) * 2 < interval)
    return j.withColumn("flag", F.col(data_time) != F.col(meta_time)).drop("__b").withColumnRenamed(data_time, "time")


def merge_on_time(vis: DataFrame, meta: DataFrame, time: str) -> DataFrame:
    """Visibilities of the cycles the metadata announces; idle scans (negative id) are skipped."""
    return vis.join(meta.where(F.col("scan_id") >= 0), time)


# ---------------------------------------------------------------- ranges

def _bins(low: str, high: str, width: float) -> Column:
    return F.explode(F.sequence(F.floor(F.col(low) / F.lit(width)), F.floor(F.col(high) / F.lit(width))))


def range_join(points: DataFrame, ranges: DataFrame, point: str, low: str, high: str, width: float,
               residual: Column | None = None) -> DataFrame:
    """Pairs with low <= point <= high: ranges are cut into bins of ``width`` and joined on the bin."""
    r = ranges.withColumn("__bin", _bins(low, high, width))
    p = points.withColumn("__bin", F.floor(F.col(point) / F.lit(width)))
    cond = F.col(point).between(F.col(low), F.col(high))
    return p.join(r, "__bin").where(cond if residual is None else cond & residual).drop("__bin")


def in_any_range(points: DataFrame, ranges: DataFrame, point: str, low: str, high: str, width: float,
                 residual: Column | None = None) -> DataFrame:
    """Points inside at least one range, each once."""
    r = ranges.withColumn("__bin", _bins(low, high, width))
    p = points.withColumn("__bin", F.floor(F.col(point) / F.lit(width)))
    cond = (p["__bin"] == r["__bin"]) & F.col(point).between(F.col(low), F.col(high))
    return p.join(r, cond if residual is None else cond & residual, "left_semi").drop("__bin")


# ---------------------------------------------------------------- as-of

def as_of(facts: DataFrame, versions: DataFrame, keys: Sequence[str], fact_time: str, version_time: str,
          width: int, cols: Sequence[str]) -> DataFrame:
    """For each fact the last version at or before its time; facts without one are dropped.

    Each version is repeated over the time bins until the next one, so the join
    is on (keys, bin) with a range residual.  Both the successor and the last
    bin come from bucketed scans, so a key with many versions is not one task.
    """
    from ..functions.prefix import scan_lag

    keys = list(keys)
    v = versions.select(*keys, version_time, *cols)
    # the successor in time is the predecessor in negated time
    neg = v.withColumn("__neg", -F.col(version_time))
    neg = scan_lag(neg, keys, "__neg", F.floor(F.col("__neg") / F.lit(width * 64)), [version_time])
    end = facts.agg(F.max(fact_time).alias("m")).select(F.max("m")).scalar()
    until = F.coalesce(F.col(f"prev.{version_time}") - 1, F.greatest(end, F.col(version_time)))
    v = neg.withColumn("__until", until).where(F.col("__until") >= F.col(version_time))
    v = v.withColumn("__bin", F.explode(F.sequence(F.floor(F.col(version_time) / F.lit(width)),
                                                   F.floor(F.col("__until") / F.lit(width)))))
    v = v.select(*keys, F.col(version_time).alias("__from"), "__until", "__bin", *cols)
    f = facts.withColumn("__bin", F.floor(F.col(fact_time) / F.lit(width)))
    j = f.join(v, [*keys, "__bin"]).where(F.col(fact_time).between(F.col("__from"), F.col("__until")))
    return j.withColumnRenamed("__from", "solution_time").drop("__until", "__bin")


def latest(versions: DataFrame, keys: Sequence[str], time: str, cols: Sequence[str]) -> DataFrame:
    """Most recent version per key, by partial aggregation."""
    s = versions.groupBy(*keys).agg(F.max_by(F.struct(time, *cols), time).alias("s"))
    return s.select(*keys, *[F.col(f"s.{c}").alias(c) for c in (time, *cols)])


# ---------------------------------------------------------------- dimensions

def find_or_add(rows: DataFrame, dim: DataFrame, attrs: Sequence[str], id_col: str) -> DataFrame:
    """Dimension rows still missing from ``dim``, with ids from a hash of their attributes."""
    new = rows.select(*attrs).distinct().join(dim, list(attrs), "left_anti")
    return new.withColumn(id_col, F.xxhash64(*attrs))


def name_outer(a: DataFrame, b: DataFrame, key: str) -> DataFrame:
    """Union of names with both sides' columns."""
    return a.join(b, key, "full_outer")
