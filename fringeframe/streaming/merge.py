"""Correlator and metadata streams merged into flagged cycles."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def fill_expected(cycles: DataFrame, received: DataFrame, cycle: str, n_ant: int, n_chan: int) -> DataFrame:
    """The expected (baseline, channel) grid of each cycle with what arrived; the rest is flagged.

    The grid is exploded inside each cycle's row, so it needs no cross join.
    """
    g = cycles.withColumn("ant1", F.explode(F.sequence(F.lit(0).cast("long"), F.lit(n_ant - 1).cast("long"))))
    g = g.withColumn("ant2", F.explode(F.sequence(F.col("ant1"), F.lit(n_ant - 1).cast("long"))))
    g = g.withColumn("chan", F.explode(F.sequence(F.lit(0).cast("long"), F.lit(n_chan - 1).cast("long"))))
    got = received.withColumn("__got", F.lit(True))
    j = g.join(got, [cycle, "ant1", "ant2", "chan"], "left")
    return j.withColumn("flag", F.col("__got").isNull()).drop("__got")


def merge_streams(vis: DataFrame, meta: DataFrame, interval_ms: int, delay: str) -> DataFrame:
    """Stream-stream inner join of visibilities and metadata whose times differ by less than half an interval.

    Both sides carry ``event_time`` (timestamp) and ``t_ms``; a pair whose times
    differ keeps the data's time and is flagged.  Idle scans are skipped.  State is
    bounded by the watermarks and the time-range condition.
    """
    half = f"INTERVAL {interval_ms} MILLISECONDS"
    b = lambda c: F.floor(F.col(c) / F.lit(interval_ms))
    m = meta.where("scan_id >= 0").withWatermark("event_time", delay)
    m = m.select(F.col("event_time").alias("meta_event"), F.col("t_ms").alias("meta_ms"), "scan_id",
                 F.explode(F.array(b("t_ms") - 1, b("t_ms"), b("t_ms") + 1)).alias("meta_bin"))
    v = vis.withWatermark("event_time", delay).withColumn("bin", b("t_ms"))
    cond = (F.col("bin") == F.col("meta_bin")) & (F.abs(F.col("t_ms") - F.col("meta_ms")) * 2 < interval_ms)
    cond = cond & F.expr(f"event_time BETWEEN meta_event - {half} AND meta_event + {half}")
    j = v.join(m, cond)
    return j.withColumn("cycle_flag", F.col("t_ms") != F.col("meta_ms")).drop("bin", "meta_bin", "meta_event")


def latest_points(points: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Last value per monitoring point, for update mode; a null value invalidates the point."""
    return points.groupBy(*keys).agg(F.max_by(F.struct("ts", "value"), "ts").alias("last"))
