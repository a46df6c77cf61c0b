"""Row and channel selection on visibility and catalogue tables."""

from __future__ import annotations

from collections.abc import Iterable, Mapping
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.sky import separation_deg


def _all(conds: Iterable[Column]) -> Column:
    return reduce(lambda a, b: a & b, conds, F.lit(True))


# ---------------------------------------------------------------- row criteria (Columns, so they compose)

def baseline(a1: int, a2: int) -> Column:
    return (F.col("ant1") == a1) & (F.col("ant2") == a2)


def antenna(a: int) -> Column:
    return (F.col("ant1") == a) | (F.col("ant2") == a)


def feed(b: int, col1: str = "beam", col2: str | None = None) -> Column:
    c = F.col(col1) == b
    return c if col2 is None else c & (F.col(col2) == b)


def user_column(name: str, value) -> Column:
    return F.col(name) == value


def auto_correlations(beam1: str = "beam", beam2: str = "beam") -> Column:
    same_feed = F.lit(True) if beam1 == beam2 else F.col(beam1) == F.col(beam2)
    return (F.col("ant1") == F.col("ant2")) & same_feed


def cross_correlations(beam1: str = "beam", beam2: str = "beam") -> Column:
    return ~auto_correlations(beam1, beam2)


def uv_distance() -> Column:
    return F.sqrt(F.col("u") * F.col("u") + F.col("v") * F.col("v"))


def uv_range(low: float | None = None, high: float | None = None) -> Column:
    """Inclusive at both ends."""
    conds = []
    if low is not None:
        conds.append(uv_distance() >= F.lit(float(low)))
    if high is not None:
        conds.append(uv_distance() <= F.lit(float(high)))
    return _all(conds)


def scan_number(n: int) -> Column:
    return F.col("scan") == n


def time_range(start, stop, col: str = "ts") -> Column:
    return F.col(col).between(start, stop)


def split_rows(begin=None, end=None, scans=None, fields=None, beams=None, time_col: str = "ts",
               beam1: str = "beam", beam2: str = "beam") -> Column:
    """Row filter of the splitter: a row stays if either feed is in the beam set."""
    conds = []
    if begin is not None:
        conds.append(F.col(time_col) >= begin)
    if end is not None:
        conds.append(F.col(time_col) <= end)
    if scans:
        conds.append(F.col("scan").isin(list(scans)))
    if fields:
        conds.append(F.col("field").isin(list(fields)))
    if beams:
        conds.append(F.col(beam1).isin(list(beams)) | F.col(beam2).isin(list(beams)))
    return _all(conds)


# ---------------------------------------------------------------- dimension lookups

def spectral_window(vis: DataFrame, data_desc: DataFrame, spw_id: int) -> DataFrame:
    """Rows whose data description belongs to a spectral window; none if it has no description."""
    ids = data_desc.where(F.col("spw_id") == spw_id).select("data_desc_id")
    return vis.join(ids, "data_desc_id", "left_semi")


def field_names(vis: DataFrame, field: DataFrame, names: list[str]) -> DataFrame:
    """Rows of the named fields.  Raises if no name is known (the field table is one row per pointing)."""
    ids = field.where(F.col("name").isin(names)).select(F.col("field_id").alias("field"))
    if ids.isEmpty():
        raise ValueError(f"no field is called any of {names}")
    return vis.join(ids, "field", "left_semi")


def missing_field_names(field: DataFrame, names: list[str]) -> list[str]:
    """Requested names that the field table lacks, for a warning."""
    found = field.where(F.col("name").isin(names)).select("name").distinct()
    return sorted(set(names) - {r["name"] for r in found.toLocalIterator()})


# ---------------------------------------------------------------- channel selection on spectra

def channels(df: DataFrame, start: int, n: int, average: int = 1) -> DataFrame:
    """``n`` output channels from ``start``, each the mean of ``average`` adjacent input channels."""
    from .average import average_channels

    cut = df
    for c in ("re", "im", "flag", "sigma"):
        if c in df.columns:
            cut = cut.withColumn(c, F.slice(c, start + 1, n * average))
    return cut if average < 2 else average_channels(cut, average)


def stream_channels(df: DataFrame, start: int, n: int) -> DataFrame:
    """Streaming selection ``[start, start + n)``; a range outside the spectrum flags it whole."""
    fits = F.size("re") >= start + n
    out = df.withColumn("__fits", fits)
    for c in ("re", "im"):
        out = out.withColumn(c, F.when(F.col("__fits"), F.slice(c, start + 1, n)).otherwise(F.col(c)))
    out = out.withColumn(
        "flag",
        F.when(F.col("__fits"), F.slice("flag", start + 1, n)).otherwise(F.transform("flag", lambda f: F.lit(True))),
    )
    return out.drop("__fits")


def cycles(df: DataFrame, start: int, stop: int, time_col: str = "cycle") -> DataFrame:
    """Integrations ``start..stop`` by their place in time order (0-based, inclusive).

    The n-th distinct time is found by counting times in coarse steps, so the
    time axis is never sorted as a whole.
    """
    from ..functions.prefix import scan_sum

    times = df.select(time_col).distinct().withColumn("__one", F.lit(1).cast("long"))
    numbered = scan_sum(times, [], time_col, F.floor(F.col(time_col) / F.lit(4096)), "__one", "__k")
    keep = numbered.where((F.col("__k") - 1).between(start, stop)).select(time_col)
    return df.join(keep, time_col, "left_semi")


def frequencies(df: DataFrame, low: float, high: float, f0: float, df_chan: float) -> DataFrame:
    """Keep the channels of each spectrum whose frequency f0 + i * df lies in [low, high]."""
    first = max(0, -int(-(low - f0) // df_chan))
    last = int((high - f0) // df_chan)
    out = df
    for c in ("re", "im", "flag", "sigma"):
        if c in df.columns:
            out = out.withColumn(c, F.slice(c, first + 1, max(0, last - first + 1)))
    return out.withColumn("first_chan", F.lit(first).cast("long"))


#: Speed of light in km/s.
C_KM_S = 299_792.458


def velocities(df: DataFrame, low: float, high: float, rest: float, f0: float, df_chan: float) -> DataFrame:
    """Keep the channels whose radio velocity c (1 - f / rest), in km/s, lies in [low, high]; frequencies as in :func:`frequencies`."""
    return frequencies(df, rest * (1.0 - high / C_KM_S), rest * (1.0 - low / C_KM_S), f0, df_chan)


def polarisations(pols: Iterable[str]) -> Column:
    return F.col("pol").isin(list(pols))


# ---------------------------------------------------------------- catalogue criteria

#: Columns whose zero and negative bounds are meaningful, so they are set by presence.
SIGNED = frozenset({"pos_ang", "spectral_index", "spectral_curvature"})


def criteria(bounds: Mapping[str, tuple[float | None, float | None]]) -> Column:
    """Conjunction of inclusive ranges.  A negative bound means "not set", except for
    position angle, spectral index and curvature, where only ``None`` does."""
    conds = []
    for name, (low, high) in bounds.items():
        unset = (lambda b: b is None) if name in SIGNED else (lambda b: b is None or b < 0)
        if not unset(low):
            conds.append(F.col(name) >= F.lit(float(low)))
        if not unset(high):
            conds.append(F.col(name) <= F.lit(float(high)))
    return _all(conds)


def cone_flux(df: DataFrame, ra: float, dec: float, radius: float, flux_limit: float) -> DataFrame:
    """Exact cone and flux limit.  The declination band reaches the scan as a plain range."""
    sep = separation_deg(F.col("ra_deg"), F.col("dec_deg"), F.lit(float(ra)), F.lit(float(dec)))
    return df.where(
        F.col("dec_deg").between(dec - radius, dec + radius) & (sep <= F.lit(float(radius)))
        & (F.col("flux_peak") >= F.lit(float(flux_limit)))
    )


def cone_flux_counts(df: DataFrame, ra: float, dec: float, radius: float, flux_limit: float) -> DataFrame:
    """Accepted and rejected counts; a component outside the cone is not tested for flux."""
    sep = separation_deg(F.col("ra_deg"), F.col("dec_deg"), F.lit(float(ra)), F.lit(float(dec)))
    verdict = (
        F.when(sep > F.lit(float(radius)), "outside_cone")
        .when(F.col("flux_peak") < F.lit(float(flux_limit)), "below_flux")
        .otherwise("accepted")
    )
    return df.groupBy(verdict.alias("verdict")).agg(F.count(F.lit(1)).alias("n"))


def by_id(df: DataFrame, ids: DataFrame, key: str) -> DataFrame:
    """Look up rows by id; an unknown id gives a row of nulls."""
    return ids.join(df, key, "left")


def sub_lists(df: DataFrame, lists: list[tuple[str, float, float]], ra: float, dec: float) -> DataFrame:
    """One membership row per (list, component): flux at least the threshold, within the radius.

    ``lists`` is a short parameter list of (name, flux threshold, radius); it is
    expanded inside the row, so there is no join.
    """
    sep = separation_deg(F.col("ra_deg"), F.col("dec_deg"), F.lit(float(ra)), F.lit(float(dec)))
    rules = F.array(*[
        F.when((F.col("flux_peak") >= F.lit(float(flux))) & (F.col("__sep") <= F.lit(float(rad))), F.lit(name))
        for name, flux, rad in lists
    ])
    return (df.withColumn("__sep", sep)
            .withColumn("list_name", F.explode(F.filter(rules, lambda x: x.isNotNull())))
            .drop("__sep"))


def log_query(events: DataFrame, origin: str | None = None, start=None, stop=None,
              levels: Iterable[str] | None = None, tag: str | None = None, host: str | None = None) -> DataFrame:
    """Log events by origin, creation time, levels, tag and host; unset criteria do not filter."""
    conds = []
    if origin is not None:
        conds.append(F.col("origin") == origin)
    if start is not None:
        conds.append(F.col("created") >= start)
    if stop is not None:
        conds.append(F.col("created") <= stop)
    if levels is not None:
        conds.append(F.col("level").isin(list(levels)))
    if tag is not None:
        conds.append(F.col("tag") == tag)
    if host is not None:
        conds.append(F.col("host") == host)
    return events.where(_all(conds))
