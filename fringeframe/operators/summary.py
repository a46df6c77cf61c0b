"""Inventories, metadata statistics, time chunks, exports and monitors across rows."""

from __future__ import annotations

from collections.abc import Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.prefix import runs, scan_lag
from ..functions.sky import RAD
from ..session import cut_lineage

C_M_S = 299792458.0


#: Cycles of a run that one task looks through at a time.
CHUNK = 65_536
#: Directions further apart than this (radians) are different.
SAME_DIRECTION = 1e-7
_START = ("s_cycle", "s_time", "s_ra", "s_dec", "part")


def _parts(cycle, time, ra, dec, start, cycle_limit, time_limit):
    """Parts of a stretch of cycles: a part goes on while cycle, time and direction stay within the limits of its first cycle.

    ``start`` is the part that is open where the stretch begins, or none. Steps from part to part, not from cycle to cycle.
    """
    u = np.stack([np.cos(dec) * np.cos(ra), np.cos(dec) * np.sin(ra), np.sin(dec)], 1)
    out = {c: np.empty(len(cycle), np.int64 if c in ("s_cycle", "part") else np.float64) for c in _START}
    at, now, fresh = 0, start, start is None
    while at < len(cycle):
        if now is None:
            now = (cycle[at], time[at], ra[at], dec[at], 0)
        c0, t0, ra0, dec0, part = now
        end = len(cycle)
        if cycle_limit is not None:
            end = min(end, int(np.searchsorted(cycle, c0 + cycle_limit)))
        if time_limit is not None:
            over = np.flatnonzero(~(time[at:end] - t0 < time_limit))
            end = at + int(over[0]) if len(over) else end
        first = np.array([np.cos(dec0) * np.cos(ra0), np.cos(dec0) * np.sin(ra0), np.sin(dec0)])
        apart = 2 * np.arcsin(np.minimum(1.0, np.linalg.norm(u[at:end] - first, axis=1) / 2))
        away = np.flatnonzero(~(apart < SAME_DIRECTION))
        end = at + int(away[0]) if len(away) else end
        end = max(end, at + fresh)  # a part has its first cycle, also where that has no time or direction
        for c, v in zip(_START, now):
            out[c][at:end] = v
        at, fresh = end, True
        if at < len(cycle):
            now = (cycle[at], time[at], ra[at], dec[at], part + 1)
    return out


def scan_inventory(obs: DataFrame, cycle_limit: int | None = None, step: int = 1, bucket: int = 4096, time_limit: float | None = None, time: str | None = None, chunk: int = CHUNK) -> DataFrame:
    """Scans per beam from one row per (beam, cycle): consecutive cycles with equal file, scan, field and direction.

    A scan also ends where a cycle is ``cycle_limit`` or more after its first one, ``time_limit`` or more
    after its time, or points elsewhere; the next observed cycle starts the next one. Directions (degrees) are
    compared on the sphere with that of the scan's first cycle.

    Runs of equal file, scan and field are found in buckets. Inside a run the limits restart one after the
    other: runs go in parallel, a run of more than ``chunk`` cycles goes on from chunk to chunk with the
    scan that is open at its end.
    """
    d = obs.withColumn("__t", (F.col(time) if time else F.lit(0.0)).cast("double")).withColumn("__ra", F.radians("ra")).withColumn("__dec", F.radians("dec"))
    d = runs(d, ["beam"], "cycle", F.floor(F.col("cycle") / bucket), ["name", "scan", "field"], step=step, name="run")
    d = d.select("beam", "run", F.col("cycle").cast("long").alias("cycle"), "name", "scan", "field", "__t", "__ra", "__dec", F.floor(F.col("cycle") / chunk).alias("__k"))
    first = d.groupBy("beam", "run").agg(F.min("__k").alias("__k0"))
    d = cut_lineage(d.join(first, ["beam", "run"]).withColumn("__k", F.col("__k") - F.col("__k0")).drop("__k0"))
    rounds = (d.agg(F.max("__k")).first()[0] or 0) + 1
    limits = (cycle_limit, time_limit)

    def cut(table: pa.Table) -> pa.Table:
        table = table.sort_by("cycle")
        start = tuple(table.column(c)[0].as_py() for c in _START)
        found = _parts(*(table.column(c).to_numpy() for c in ("cycle", "__t", "__ra", "__dec")), None if start[0] is None else start, *limits)
        kept = table.select(["beam", "run", "cycle", "name", "scan", "field"])
        for c in _START:
            kept = kept.append_column(c, pa.array(found[c]))
        return kept

    state, done = None, None
    kinds = dict(zip(_START, ("long", "double", "double", "double", "long")))
    types = {c: t for c, t in d.dtypes}
    schema = ", ".join([f"{c} {types[c]}" for c in ("beam", "run", "cycle", "name", "scan", "field")] + [f"{c} {t}" for c, t in kinds.items()])
    for k in range(rounds):
        rows = d.where(F.col("__k") == k)
        if state is None:
            rows = rows.select("*", *[F.lit(None).cast(t).alias(c) for c, t in kinds.items()])
        else:
            rows = rows.join(state, ["beam", "run"], "left")
        rows = cut_lineage(rows.groupBy("beam", "run").applyInArrow(cut, schema))
        state = rows.groupBy("beam", "run").agg(F.max_by(F.struct(*_START), "cycle").alias("s")).select("beam", "run", "s.*")
        done = rows if done is None else done.unionByName(rows)
    return done.groupBy("beam", "run", "part").agg(
        F.min("cycle").alias("start_cycle"), F.max("cycle").alias("end_cycle"), F.first("name").alias("name"), F.first("scan").alias("scan"),
        F.first("field").alias("field"), F.count(F.lit(1)).alias("n_cycles"))


def flagged_antennas(rows: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Antennas without any good row per key; rows carry ``flag`` (everything flagged)."""
    e = rows.select(*keys, F.explode(F.array("ant1", "ant2")).alias("ant"), "flag")
    return e.groupBy(*keys, "ant").agg(F.bool_and("flag").alias("bad")).where("bad").drop("bad")


def metadata_statistics(rows: DataFrame, keys: Sequence[str] = ()) -> DataFrame:
    """Mergeable statistics: counts, largest u, v, w in wavelengths, frequency range, indices, field box."""
    k = F.col("freq_max") / C_M_S
    return rows.groupBy(*keys).agg(
        F.sum("n_chan").alias("n_vis"), F.max(F.abs("u") * k).alias("max_u"), F.max(F.abs("v") * k).alias("max_v"), F.max(F.abs("w") * k).alias("max_w"),
        F.min("freq_min").alias("min_freq"), F.max("freq_max").alias("max_freq"), (F.greatest(F.max("ant1"), F.max("ant2")) + 1).alias("n_ant"),
        (F.max("beam") + 1).alias("n_beam"), F.min("off_x").alias("x_min"), F.max("off_x").alias("x_max"), F.min("off_y").alias("y_min"), F.max("off_y").alias("y_max"))


def merge_statistics(parts: DataFrame, keys: Sequence[str] = ()) -> DataFrame:
    """Combine partial statistics; equal to computing them over all rows."""
    how = {"n_vis": F.sum, "min_freq": F.min, "x_min": F.min, "y_min": F.min}
    cols = ["n_vis", "max_u", "max_v", "max_w", "min_freq", "max_freq", "n_ant", "n_beam", "x_min", "x_max", "y_min", "y_max"]
    return parts.groupBy(*keys).agg(*[how.get(c, F.max)(c).alias(c) for c in cols])


def imaging_advice(stats: DataFrame) -> DataFrame:
    """Cell size (arcsec), field size (deg) and image size from metadata statistics; offsets in radians."""
    import math

    cell = 6.48e5 / math.pi / (6.0 * F.greatest("max_u", "max_v"))
    off = F.greatest((F.col("x_max") - F.col("x_min")) / 2, (F.col("y_max") - F.col("y_min")) / 2)
    field = F.degrees(2.0 * off + 1.7 * 1.2 * (C_M_S / F.col("min_freq")) / 12.0)
    d = stats.withColumn("cell_arcsec", cell).withColumn("field_deg", field)
    return d.withColumn("image_size", F.floor(F.col("field_deg") * 3600 / F.col("cell_arcsec")) + 1)


# ---------------------------------------------------------------- time chunks

def regular_chunks(df: DataFrame, time: str, t0, interval) -> DataFrame:
    return df.withColumn("chunk", F.floor((F.col(time) - t0) / interval))


def interval_starts(times: DataFrame, time: str, interval: float) -> DataFrame:
    """Start times of solution intervals on an irregular time axis.

    A chunk lasts while t - t_first < interval and the next sample starts the next
    one.  Every time gets a pointer to the start that would follow it; the starts
    are those reached from the first time, found by doubling the pointers, so the
    axis is never walked in one task.
    """
    t = cut_lineage(times.select(F.col(time).cast("double").alias("t")).distinct())
    width = F.lit(float(interval))
    ev = t.select(F.col("t").alias("at"), F.col("t").alias("hit"), F.lit(None).cast("double").alias("src")).unionByName(
        t.select((F.col("t") + width).alias("at"), F.lit(None).cast("double").alias("hit"), F.col("t").alias("src")))
    ev = ev.withColumn("b", F.floor(F.col("at") / width))
    # windows look back in falling time: a frame that grows costs one step a row, one that shrinks the rest of the bin
    ahead = Window.partitionBy("b").orderBy(F.col("at").desc(), F.col("hit").isNull()).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    ev = ev.withColumn("nx", F.last("hit", ignorenulls=True).over(ahead))
    firsts = ev.groupBy("b").agg(F.min("hit").alias("m"))
    # the next start after a bin: inside a block of bins, else the first of a later block
    firsts = firsts.withColumn("k", F.floor(F.col("b") / 4096))
    later = Window.partitionBy("k").orderBy(F.col("b").desc()).rowsBetween(Window.unboundedPreceding, -1)
    blocks = firsts.groupBy("k").agg(F.min("m").alias("m"))
    blocks = blocks.select("k", F.last("m", ignorenulls=True).over(Window.orderBy(F.col("k").desc()).rowsBetween(Window.unboundedPreceding, -1)).alias("far"))
    firsts = firsts.withColumn("near", F.last("m", ignorenulls=True).over(later)).join(blocks, "k").select("b", F.coalesce("near", "far").alias("after"))
    jump = ev.where(F.col("src").isNotNull()).join(firsts, "b").select(F.col("src").alias("t"), F.coalesce("nx", "after").alias("to"))
    jump = cut_lineage(jump.where(F.col("to").isNotNull()))
    seen = cut_lineage(t.agg(F.min("t").alias("t")))
    while True:
        more = seen.join(jump, "t").select(F.col("to").alias("t"))
        grown = cut_lineage(seen.unionByName(more).distinct())
        if grown.count() == seen.count():
            return grown.withColumnRenamed("t", "start")
        seen = grown
        jump = cut_lineage(jump.join(jump.select(F.col("t").alias("to"), F.col("to").alias("to2")), "to").select("t", F.col("to2").alias("to")))


def assign_intervals(df: DataFrame, time: str, starts: DataFrame, interval: float) -> DataFrame:
    """Attach to each row the start of its interval: starts are at least one interval apart, so it lies in this or the bin before."""
    width = F.lit(float(interval))
    s = starts.withColumn("__b", F.floor(F.col("start") / width))
    s = s.withColumn("__b", F.explode(F.array("__b", F.col("__b") + 1)))
    j = df.withColumn("__b", F.floor(F.col(time) / width)).join(s, "__b")
    return j.where((F.col("start") <= F.col(time)) & (F.col(time) < F.col("start") + width)).drop("__b")


def split_range(df: DataFrame, start: str, end: str, step_minutes: float) -> DataFrame:
    """Cut [start, end] (seconds) into the whole number of equal parts nearest below the step."""
    length = F.col(end) - F.col(start)
    n = F.floor(length / F.lit(step_minutes * 60.0))
    d = df.where(n >= 1).withColumn("__n", n).withColumn("part", F.explode(F.sequence(F.lit(0).cast("long"), n - 1)))
    size = (F.col(end) - F.col(start)) / F.col("__n")
    return d.withColumn("part_start", F.col(start) + F.col("part") * size).withColumn("part_end", F.col(start) + (F.col("part") + 1) * size).drop("__n")


# ---------------------------------------------------------------- export and monitors

def waterfall(cells: DataFrame, keys: Sequence[str], time: str, interval: float | None = None) -> DataFrame:
    """Time x channel amplitude, phase and real part; with an interval also the phase rate between cycles.

    The wrap is counted along time in buckets, so a long observation of one baseline is not one task.
    """
    from .calibrate import unwrap_along
    import math

    d = cells.withColumn("amplitude", F.sqrt(F.col("re") ** 2 + F.col("im") ** 2)).withColumn("phase", F.atan2("im", "re"))
    if interval is None:
        return d
    bucket = F.floor(F.col(time) / F.lit(4096))
    d = unwrap_along(d, keys, time, bucket, "phase", 1.5 * math.pi)
    unit = 2 * math.pi / 268435456.0 / 54e-6  # fixed value: unit of the fringe rotator
    # the rate of a cycle looks ahead: the next cycle is the previous one in negated time
    d = d.withColumn("__neg", -F.col(time))
    d = scan_lag(d, keys, "__neg", F.floor(F.col("__neg") / F.lit(4096)), ["unwrapped"])
    return d.withColumn("rate", (F.col("unwrapped") - F.col("prev.unwrapped")) / unit / interval).drop("__neg", "prev")


def packet_loss(meta: DataFrame, received: DataFrame, time: str) -> DataFrame:
    """Expected minus received per cycle; cycles without data lose everything."""
    j = meta.join(received, time, "left").withColumn("received", F.coalesce("received", F.lit(0).cast("long")))
    lost = F.col("expected") - F.col("received")
    return j.select(time, "expected", "received", lost.alias("lost"), (100.0 * F.try_divide(lost, "expected")).alias("lost_percent"))


def data_rate(rows: DataFrame, time: str, bytes_per_vis: int, interval: float) -> DataFrame:
    """Header points and data rate per cycle."""
    return rows.groupBy(time).agg(
        F.count(F.lit(1)).alias("n_vis"), F.count_distinct("chan").alias("n_chan"), F.count_distinct("beam").alias("n_beam"),
        F.count_distinct("ant1", "ant2").alias("n_baseline"), (F.count(F.lit(1)) * bytes_per_vis / F.lit(interval)).alias("bytes_per_sec"))


def merge_streams(parts: DataFrame, cycle: str, stream: str, time: str) -> DataFrame:
    """Channel merge: the time shared by most streams of a cycle wins (the first stream's on a tie); others are flagged."""
    votes = parts.groupBy(cycle, time).agg(F.count(F.lit(1)).alias("n"), F.min(stream).alias("s0"))
    best = votes.groupBy(cycle).agg(F.max_by(F.struct(time, "n"), F.struct(F.col("n"), -F.col("s0"))).alias("b"), F.sum("n").alias("total"))
    best = best.select(cycle, F.col(f"b.{time}").alias("merged_time"), (F.col("total") - F.col("b.n")).alias("misaligned"))
    return parts.join(best, cycle).withColumn("flag", F.col(time) != F.col("merged_time"))


def publish_subset(cells: DataFrame, keys: Sequence[str]) -> DataFrame:
    """One message per key with its baselines in order.

    Samples are averaged to one value per baseline first, so a list is no longer than the number of baselines.
    """
    b = cells.groupBy(*keys, "ant1", "ant2").agg(F.avg("re").alias("re"), F.avg("im").alias("im"), F.bool_and("flag").alias("flag"))
    m = b.groupBy(*keys).agg(F.array_sort(F.collect_list(F.struct("ant1", "ant2", "re", "im", "flag"))).alias("baselines"))
    return m.withColumn("n_baselines", F.size("baselines").cast("long"))


def scan_manifest(vis: DataFrame) -> DataFrame:
    """Per observation the scans of its visibility table: start, end, field, channels, products."""
    s = vis.groupBy("field", "scan").agg(
        F.min("ts").alias("start"), F.max("ts").alias("end"), F.count_distinct("chan").alias("n_chan"),
        F.array_sort(F.collect_set("pol")).alias("pols"), F.count(F.lit(1)).alias("n_vis"))
    return s
