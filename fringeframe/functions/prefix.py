"""Ordered scans that do not put a whole ordering into one task.

``lag`` and running sums over a long axis (time, say) are computed inside
buckets of that axis, then carried across with one summary row per bucket.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..session import cut_lineage


def scan_lag(df: DataFrame, keys: Sequence[str], order: str, bucket: Column, cols: Sequence[str]) -> DataFrame:
    """Add ``prev_<col>`` from the preceding row in ``order`` (unique within keys).

    ``bucket`` must not decrease along ``order``.  The struct ``prev`` is null on
    the first row of each key, which tells "no previous row" from "null value".
    """
    keys = list(keys)
    d = df.withColumn("__bk", bucket).withColumn("__row", F.struct(*cols))
    inside = Window.partitionBy(*keys, "__bk").orderBy(order)
    d = d.withColumn("__prev", F.lag("__row").over(inside))
    ends = d.groupBy(*keys, "__bk").agg(F.max_by("__row", order).alias("__last"))
    across = Window.partitionBy(*keys).orderBy("__bk")
    ends = ends.select(*keys, "__bk", F.lag("__last").over(across).alias("__carry"))
    d = d.join(ends, keys + ["__bk"], "left")
    return d.withColumn("prev", F.coalesce("__prev", "__carry")).drop("__bk", "__row", "__prev", "__carry")


def scan_sum(df: DataFrame, keys: Sequence[str], order: str, bucket: Column, value: str, name: str) -> DataFrame:
    """Add ``name``: the running sum of ``value`` along ``order`` within keys."""
    keys = list(keys)
    d = df.withColumn("__bk", bucket)
    inside = Window.partitionBy(*keys, "__bk").orderBy(order).rowsBetween(Window.unboundedPreceding, 0)
    d = d.withColumn("__part", F.sum(value).over(inside))
    tot = d.groupBy(*keys, "__bk").agg(F.sum(value).alias("__tot"))
    across = Window.partitionBy(*keys).orderBy("__bk").rowsBetween(Window.unboundedPreceding, -1)
    tot = tot.select(*keys, "__bk", F.coalesce(F.sum("__tot").over(across), F.lit(0)).alias("__off"))
    return d.join(tot, keys + ["__bk"]).withColumn(name, F.col("__part") + F.col("__off")).drop("__bk", "__part", "__off")


def runs(df: DataFrame, keys: Sequence[str], order: str, bucket: Column, same: Sequence[str],
         step: int | None = None, name: str = "run") -> DataFrame:
    """Number maximal runs of rows with equal ``same`` columns, from 1 within keys.

    With ``step`` a run also ends where ``order`` advances by more than ``step``.
    """
    d = scan_lag(df, keys, order, bucket, list(dict.fromkeys([*same, order])))
    changed = F.col("prev").isNull()
    for c in same:
        changed = changed | ~F.col(c).eqNullSafe(F.col(f"prev.{c}"))
    if step is not None:
        changed = changed | (F.col(order) - F.col(f"prev.{order}") > step)
    d = d.withColumn("__new", changed.cast("long"))
    return scan_sum(d, keys, order, bucket, "__new", name).drop("__new", "prev")


def running_total(df: DataFrame, order: Sequence[str], value: Column, name: str) -> DataFrame:
    """Add ``name``: the running sum of ``value`` over the whole table in ``order`` (unique), this row included.

    The table is cut into ranges of the order and written; sums run inside the ranges and
    one number a range is carried on, so neither a narrow spread of values nor many rows go
    through one task.
    """
    d = df.withColumn("__v", value).repartitionByRange(*order).withColumn("__part", F.spark_partition_id())
    d = cut_lineage(d)
    inside = Window.partitionBy("__part").orderBy(*order).rowsBetween(Window.unboundedPreceding, 0)
    tot = d.groupBy("__part").agg(F.sum("__v").alias("__tot"))
    before = Window.orderBy("__part").rowsBetween(Window.unboundedPreceding, -1)
    tot = tot.select("__part", F.coalesce(F.sum("__tot").over(before), F.lit(0)).alias("__off"))
    d = d.withColumn(name, F.sum("__v").over(inside)).join(tot, "__part")
    return d.withColumn(name, F.col(name) + F.col("__off")).drop("__part", "__off", "__v")
