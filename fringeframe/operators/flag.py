"""Flaggers.  Each takes spectra rows and returns them with more flags, never fewer.

Writing is a separate step, so a dry run is the same plan without the write.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.bind import let
from ..functions.order import array_mean_std, array_robust, grouped_robust
from ..functions.prefix import runs, scan_sum
from ..functions.sky import RAD
from .average import explode_spectra

EPSILON = 1.1920929e-07  # fixed value: single-precision machine epsilon


def amplitude(re: str = "re", im: str = "im") -> Column:
    return F.zip_with(re, im, lambda a, b: F.sqrt(a * a + b * b))


def or_mask(flag: Column | str, bad: Column) -> Column:
    return F.zip_with(flag, bad, lambda f, b: f | b)


def all_true(flag: Column | str) -> Column:
    return F.transform(flag, lambda f: F.lit(True))


def _where_unflagged(values: Column, flag: Column) -> Column:
    kept = F.filter(F.arrays_zip(values.alias("v"), flag.alias("f")), lambda s: ~s["f"])
    return F.transform(kept, lambda s: s["v"])


# ---------------------------------------------------------------- selection, elevation

def flag_rows(df: DataFrame, cond: Column) -> DataFrame:
    """Flag whole rows."""
    return df.withColumn("flag", F.when(cond, all_true("flag")).otherwise(F.col("flag")))


def flag_channels(df: DataFrame, ranges: Sequence[tuple[int, int, int]], cond: Column | None = None) -> DataFrame:
    """Flag channels start..stop (inclusive) by step, on rows meeting ``cond``."""
    row = F.lit(True) if cond is None else cond

    def hit(i):
        c = F.lit(False)
        for start, stop, step in ranges:
            c = c | (i.between(start, stop) & ((i - start) % step == 0))
        return c

    marked = F.transform("flag", lambda f, i: f | hit(i))
    return df.withColumn("flag", F.when(row, marked).otherwise(F.col("flag")))


MAX_ANTENNAS = 2000


def elevation_deg(hour_angle: Column, dec: Column, latitude: Column) -> Column:
    """Elevation of a direction, apparent frame, degrees."""
    s = (F.sin(latitude * RAD) * F.sin(dec * RAD)
         + F.cos(latitude * RAD) * F.cos(dec * RAD) * F.cos(hour_angle * RAD))
    return F.asin(F.greatest(F.lit(-1.0), F.least(F.lit(1.0), s))) / RAD


def elevation_table(times: DataFrame, antennas: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Elevation per (time, antenna), once per integration rather than per row.

    ``times`` carries ``hour_angle`` and ``dec``; ``antennas`` is the instrument's
    list (``ant``, ``latitude``) of at most ``MAX_ANTENNAS``, which goes into the
    expression itself, so no join is planned.
    """
    kinds = dict(antennas.dtypes)
    rows = antennas.select("ant", "latitude").limit(MAX_ANTENNAS + 1).collect()
    if len(rows) > MAX_ANTENNAS:
        raise ValueError(f"more than {MAX_ANTENNAS} antennas")
    listed = F.array(*[F.struct(F.lit(r["ant"]).cast(kinds["ant"]).alias("ant"), F.lit(r["latitude"]).cast(kinds["latitude"]).alias("latitude")) for r in rows])
    t = times.withColumn("a", F.explode(listed if rows else F.array().cast(f"array<struct<ant:{kinds['ant']},latitude:{kinds['latitude']}>>")))
    return t.select(*keys, F.col("a.ant").alias("ant"),
                    elevation_deg(F.col("hour_angle"), F.col("dec"), F.col("a.latitude")).alias("elevation"))


def low_high_elevation(df: DataFrame, elev: DataFrame, keys: Sequence[str], low: float, high: float) -> DataFrame:
    """Add ``bad_elevation``: either antenna below ``low`` or above ``high`` degrees."""
    e1 = elev.select(*keys, F.col("ant").alias("ant1"), F.col("elevation").alias("__e1"))
    e2 = elev.select(*keys, F.col("ant").alias("ant2"), F.col("elevation").alias("__e2"))
    j = df.join(e1, [*keys, "ant1"], "left").join(e2, [*keys, "ant2"], "left")
    out = lambda c: (F.col(c) < F.lit(float(low))) | (F.col(c) > F.lit(float(high)))
    return j.withColumn("bad_elevation", F.coalesce(out("__e1") | out("__e2"), F.lit(False))).drop("__e1", "__e2")


# ---------------------------------------------------------------- amplitude and Stokes V clips

def clip_fixed(df: DataFrame, low: float | None = None, high: float | None = None) -> DataFrame:
    """Flag amplitudes below ``low`` or above ``high``."""
    bad = lambda a: (F.lit(False) if low is None else a < F.lit(float(low))) | (
        F.lit(False) if high is None else a > F.lit(float(high)))
    return df.withColumn("flag", or_mask("flag", F.transform(amplitude(), bad)))


def clip_auto(df: DataFrame, k: float, low: float | None = None, high: float | None = None) -> DataFrame:
    """Flag amplitudes outside median -/+ k sigma (quartile elements) of each spectrum.

    A limit given explicitly replaces the derived one.
    """
    def bounds(amp):
        med, sig = array_robust(_where_unflagged(amp, F.col("flag")))
        return let(F.struct(med.alias("m"), sig.alias("s")), lambda t: F.struct(
            (F.lit(float(low)) if low is not None else t["m"] - k * t["s"]).alias("lo"),
            (F.lit(float(high)) if high is not None else t["m"] + k * t["s"]).alias("hi")))

    bad = let(amplitude(), lambda amp: let(bounds(amp), lambda b: F.transform(
        amp, lambda a: F.coalesce((a < b["lo"]) | (a > b["hi"]), F.lit(False)))))
    return df.withColumn("flag", or_mask("flag", bad))


def clip_stokes_v(df: DataFrame, k: float, robust: bool = False) -> DataFrame:
    """Flag channels whose |V| exceeds mean + k sigma, upper side only.

    Rows carry linear cross hands (``xy_re`` .. ``yx_im``) and ``flag``, true where
    any product is flagged; statistics use the other channels.  Rows whose mean
    and sigma are both zero (V cannot be formed) are left alone.
    """
    v_amp = F.transform(
        F.arrays_zip("xy_re", "xy_im", "yx_re", "yx_im"),
        lambda s: F.sqrt((s["xy_re"] - s["yx_re"]) * (s["xy_re"] - s["yx_re"])
                         + (s["xy_im"] - s["yx_im"]) * (s["xy_im"] - s["yx_im"])) / 2.0)

    def stats(amp):
        def of(good):
            avg, sig = array_robust(good) if robust else array_mean_std(good)
            return F.struct(avg.alias("avg"), F.coalesce(sig, F.lit(0.0)).alias("sig"))
        return let(_where_unflagged(amp, F.col("flag")), of)

    def bad(amp):
        return let(stats(amp), lambda t: F.transform(amp, lambda a: F.coalesce(
            ((F.abs(t["avg"]) > EPSILON) | (F.abs(t["sig"]) > EPSILON)) & (a > t["avg"] + k * t["sig"]), F.lit(False))))

    return df.withColumn("flag", or_mask("flag", let(v_amp, bad)))


def clip_stream(df: DataFrame, auto: float | None, cross: float | None, zero: bool = False) -> DataFrame:
    """Streaming threshold with separate limits for auto- and cross-correlations."""
    is_auto = F.col("ant1") == F.col("ant2")
    limit = F.when(is_auto, F.lit(auto).cast("double")).otherwise(F.lit(cross).cast("double"))
    bad = let(limit, lambda m: F.transform(amplitude(), lambda a: F.coalesce(a > m, F.lit(False))))
    out = df.withColumn("__hit", F.zip_with(bad, "flag", lambda b, f: b & ~f))
    if zero:
        for c in ("re", "im"):
            out = out.withColumn(c, F.zip_with(c, "__hit", lambda x, h: F.when(h, 0.0).otherwise(x)))
    return out.withColumn("flag", or_mask("flag", F.col("__hit"))).drop("__hit")


def flag_listed(df: DataFrame, bad: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Zero and flag listed channels; ``bad`` has ``keys`` and an array ``chans`` per baseline and product."""
    j = df.join(bad.select(*keys, F.col("chans").alias("__c")), list(keys), "left")
    hit = F.transform("flag", lambda f, i: F.coalesce(F.array_contains("__c", i), F.lit(False)))
    j = j.withColumn("__hit", hit)
    for c in ("re", "im"):
        j = j.withColumn(c, F.zip_with(c, "__hit", lambda x, h: F.when(h, 0.0).otherwise(x)))
    return j.withColumn("flag", or_mask("flag", F.col("__hit"))).drop("__c", "__hit")


# ---------------------------------------------------------------- two-pass clips

def integrate_spectra(df: DataFrame, keys: Sequence[str], k: float) -> DataFrame:
    """Flag channels of the time-averaged spectrum of each key that stand out or hold no data.

    Run after the per-row clip: the average leaves flagged samples out.  One key
    has at most one averaged value per channel, so the collected spectrum is short.
    """
    keys = list(keys)
    d = df.withColumn("amp", amplitude())
    cells = explode_spectra(d, keys, ("amp", "flag"))
    avg = cells.groupBy(*keys, "chan").agg(F.avg(F.when(~F.col("flag"), F.col("amp"))).alias("a"))
    spec = avg.groupBy(*keys).agg(F.collect_list(F.struct("chan", "a")).alias("s"))
    good = F.transform(F.filter("s", lambda x: x["a"].isNotNull()), lambda x: x["a"])

    def verdict(g):
        med, sig = array_robust(g)
        return let(F.struct(med.alias("m"), sig.alias("s")), lambda t: F.transform(F.filter("s", lambda x: F.coalesce(
            (x["a"] < t["m"] - k * t["s"]) | (x["a"] > t["m"] + k * t["s"]), F.lit(True))), lambda x: x["chan"]))

    masks = spec.select(*keys, let(good, verdict).alias("chans"))
    j = df.join(masks, keys, "left")
    hit = F.transform("flag", lambda f, i: f | F.coalesce(F.array_contains("chans", i.cast("long")), F.lit(False)))
    return j.withColumn("flag", hit).drop("chans")


def integrate_times(df: DataFrame, keys: Sequence[str], time: str, k: float) -> DataFrame:
    """Flag times of each key whose channel-averaged amplitude stands out or holds no data."""
    keys = list(keys)
    kept = F.filter(F.arrays_zip(amplitude().alias("a"), F.col("flag").alias("f")), lambda s: ~s["f"])
    d = df.withColumn("__sum", F.aggregate(kept, F.lit(0.0), lambda acc, s: acc + s["a"])).withColumn("__n", F.size(kept))
    avg = d.groupBy(*keys, time).agg(F.try_divide(F.sum("__sum"), F.sum("__n")).alias("a"))
    stats = grouped_robust(avg, keys, "a")
    bad = avg.join(stats, keys, "left").where(F.coalesce(
        (F.col("a") < F.col("median") - k * F.col("sigma")) | (F.col("a") > F.col("median") + k * F.col("sigma")),
        F.lit(True))).select(*keys, time, F.lit(True).alias("__bad"))
    j = df.join(bad, [*keys, time], "left")
    return flag_rows(j, F.coalesce("__bad", F.lit(False))).drop("__bad")


# ---------------------------------------------------------------- per-integration set logic

def shadowed_antennas(rows: DataFrame, time: Sequence[str], diameter: float) -> DataFrame:
    """(time, ant) of antennas behind another in projection.

    Fails on an unflagged cross baseline of zero length, where uvw is missing.
    """
    sep = F.sqrt(F.col("u") * F.col("u") + F.col("v") * F.col("v"))
    length = F.sqrt(sep * sep + F.col("w") * F.col("w"))
    cross = rows.where(F.col("ant1") != F.col("ant2"))
    zero = length < 1e-6
    checked = F.when(zero & ~F.col("flag"), F.raise_error(F.lit("zero uvw on an unflagged baseline")).cast("long"))
    behind = F.when(zero, checked).when(sep < diameter, F.when(F.col("w") < 0, F.col("ant1")).otherwise(F.col("ant2")))
    return cross.select(*time, behind.alias("ant")).where(F.col("ant").isNotNull()).distinct()


def touches(rows: DataFrame, bad: DataFrame, time: Sequence[str], name: str) -> DataFrame:
    """Add ``name``: does either antenna of the row appear in ``bad`` (time, ant)?

    ``bad`` is folded to one short list per integration, so rows join once.
    """
    lists = bad.groupBy(*time).agg(F.collect_set("ant").alias("__ants"))
    j = rows.join(lists, list(time), "left")
    hit = F.array_contains("__ants", F.col("ant1")) | F.array_contains("__ants", F.col("ant2"))
    return j.withColumn(name, F.coalesce(hit, F.lit(False))).drop("__ants")


def shadow_transitions(shadowed: DataFrame, times: DataFrame, time: str) -> DataFrame:
    """Enter and leave events of the shadowed set, one row per antenna and change.

    ``times`` lists every integration: an antenna leaves at the next one even if
    no other antenna is shadowed then.
    """
    from ..functions.prefix import scan_lag

    bucket = F.floor(F.col(time) / F.lit(4096))
    order = scan_lag(times.select(time).distinct(), [], time, bucket, [time])
    order = order.select(time, F.col(f"prev.{time}").alias("__prev"))
    before = shadowed.select(F.col(time).alias("__prev"), "ant")
    now = shadowed.join(order, time)
    enter = now.join(before, ["__prev", "ant"], "left_anti").select(time, "ant", F.lit("enter").alias("event"))
    was = order.join(before, "__prev").select(time, "ant")
    leave = was.join(shadowed, [time, "ant"], "left_anti").select(time, "ant", F.lit("leave").alias("event"))
    return enter.unionByName(leave)


def antennas_without_baselines(rows: DataFrame, bad_row: Column, time: Sequence[str]) -> DataFrame:
    """(time, ant) of antennas left with no good cross baseline in an integration."""
    ends = rows.withColumn("__good", (F.col("ant1") != F.col("ant2")) & ~bad_row)
    ends = ends.select(*time, F.explode(F.array_distinct(F.array("ant1", "ant2"))).alias("ant"), "__good")
    return ends.groupBy(*time, "ant").agg(F.bool_or("__good").alias("__g")).where(~F.col("__g")).drop("__g")


def quack_cycles(meta: DataFrame, time: str, scan: str, n: int, bucket_size: int = 4096) -> DataFrame:
    """Times in the first ``n`` cycles after each change of scan, from one row per cycle."""
    bucket = F.floor(F.col(time) / F.lit(bucket_size))
    seg = runs(meta.select(time, scan).distinct(), [], time, bucket, [scan], name="run")
    one = seg.withColumn("__one", F.lit(1).cast("long"))
    k = scan_sum(one, ["run"], time, bucket, "__one", "nth")
    return k.where(F.col("nth") <= n).select(time)


# ---------------------------------------------------------------- reports

def flag_statistics(before: DataFrame) -> DataFrame:
    """Counts of one flagger from rows with ``flag`` (before) and ``new_flag`` (after)."""
    already = F.size(F.filter("flag", lambda f: f))
    total = F.size(F.filter("new_flag", lambda f: f))
    fully = (total == F.size("new_flag")) & (already < F.size("flag"))
    return before.agg(
        F.sum(already.cast("long")).alias("vis_already_flagged"),
        F.sum((total - already).cast("long")).alias("vis_flagged"),
        F.sum(fully.cast("long")).alias("rows_flagged"),
        F.count(F.lit(1)).alias("n_rows"))


def flag_summary(df: DataFrame, order: str, chunk: Sequence[str], bucket: Column) -> DataFrame:
    """Per contiguous chunk: rows, flagged rows, flagged samples, times, baselines and beams.

    Rows are spectra with ``n_flag`` and ``n_chan``; runs are found on the
    distinct times, which are far fewer than the rows.
    """
    chunk = list(chunk)
    seg = runs(df.select(order, *chunk).distinct(), [], order, bucket, chunk, name="chunk")
    j = df.join(seg, [order, *chunk])
    return j.groupBy("chunk", *chunk).agg(
        F.count(F.lit(1)).alias("n_rows"),
        (100.0 * F.sum((F.col("n_flag") == F.col("n_chan")).cast("long")) / F.count(F.lit(1))).alias("pct_rows_flagged"),
        (100.0 * F.sum("n_flag") / F.sum("n_chan")).alias("pct_vis_flagged"),
        F.count_distinct(order).alias("n_times"),
        F.count_distinct("ant1", "ant2").alias("n_baselines"),
        F.count_distinct("beam").alias("n_beams"))
