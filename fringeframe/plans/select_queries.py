"""Selection queries (FLT*) and their checking SQL."""

from __future__ import annotations

import datetime as dt
import math

import numpy as np
from pyspark.sql import functions as F

from ..functions import healpix, sky
from ..operators import average, select, skymodel
from ..views import spectra, view
from .registry import op, r6

SAMPLE = ["cycle", "scan", "field", "ant1", "ant2", "beam", "chan", "pol", "re", "im", "flag"]
_S = "cycle, scan, field, ant1, ant2, beam, chan, pol, re, ROUND(im, 6) + CAST(0.0 AS DOUBLE) AS im, flag"


def _sample(df):
    return df.select(*[r6("im").alias("im") if c == "im" else c for c in SAMPLE])


def _row_filter(key, cond, where):
    @op(key, f"SELECT {_S} FROM v_vis WHERE {where}")
    def query(spark, sf):
        return _sample(view(spark, sf, "v_vis").where(cond()))

    return query


_row_filter("flt1", lambda: select.baseline(1, 2), "ant1 = 1 AND ant2 = 2")
_row_filter("flt2", lambda: select.antenna(3), "ant1 = 3 OR ant2 = 3")
_row_filter("flt3", lambda: select.feed(2), "beam = 2")
_row_filter("flt4", lambda: select.user_column("field", 1), "field = 1")
_row_filter("flt5", select.cross_correlations, "ant1 <> ant2")
_row_filter("flt6", lambda: select.uv_range(10.0, 50.0), "SQRT(u*u + v*v) >= 10 AND SQRT(u*u + v*v) <= 50")
_row_filter("flt7", lambda: select.scan_number(4), "scan = 4")
_row_filter("flt9", lambda: select.time_range(dt.datetime(1996, 1, 1), dt.datetime(1996, 12, 31)),
            "ts >= TIMESTAMP '1996-01-01' AND ts <= TIMESTAMP '1996-12-31'")
_row_filter("flt13", lambda: select.split_rows(dt.datetime(1996, 1, 1), dt.datetime(1999, 1, 1), [1, 2, 5], [0, 2], [1, 3]),
            "ts >= TIMESTAMP '1996-01-01' AND ts <= TIMESTAMP '1999-01-01' AND scan IN (1,2,5) "
            "AND field IN (0,2) AND beam IN (1,3)")


@op("flt5_auto", f"SELECT {_S} FROM v_vis WHERE ant1 = ant2")
def flt5_auto(spark, sf):
    return _sample(view(spark, sf, "v_vis").where(select.auto_correlations()))


@op("flt8", f"""WITH dd AS (SELECT n_nationkey AS data_desc_id FROM nation WHERE n_regionkey = 1)
SELECT {_S} FROM v_vis WHERE field * 4 + beam IN (SELECT data_desc_id FROM dd)""")
def flt8(spark, sf):
    from ..views import tables

    dd = tables(spark, sf, "nation").select(
        F.col("n_nationkey").cast("long").alias("data_desc_id"), F.col("n_regionkey").alias("spw_id"))
    vis = view(spark, sf, "v_vis").withColumn("data_desc_id", F.col("field") * 4 + F.col("beam"))
    return _sample(select.spectral_window(vis, dd, 1))


@op("flt10", """WITH @grid, b AS (
  SELECT scan, ant1, ant2, beam, pol, CAST(FLOOR((chan - 6) / 4) AS BIGINT) AS out_chan,
         SUM(CASE WHEN flag THEN 0 ELSE 1 END) AS n, SUM(CASE WHEN flag THEN 0.0 ELSE re END) AS re,
         SUM(CASE WHEN flag THEN 0.0 ELSE im END) AS im
  FROM v_grid WHERE chan >= 6 AND chan < 46 GROUP BY 1,2,3,4,5,6)
SELECT scan, ant1, ant2, beam, pol, out_chan AS chan, n = 0 AS flag,
       ROUND(CASE WHEN n > 0 THEN re / n ELSE 0.0 END + 3.1e-9, 6) + CAST(0.0 AS DOUBLE) AS re,
       ROUND(CASE WHEN n > 0 THEN im / n ELSE 0.0 END + 3.1e-9, 6) + CAST(0.0 AS DOUBLE) AS im FROM b""")
def flt10(spark, sf):
    d = select.channels(spectra(spark, sf), start=6, n=10, average=4)
    e = average.explode_spectra(d, ["scan", "ant1", "ant2", "beam", "pol"])
    return e.select("scan", "ant1", "ant2", "beam", "pol", "chan", "flag", r6("re").alias("re"), r6("im").alias("im"))


@op("flt11_cycles", f"""WITH t AS (SELECT cycle, DENSE_RANK() OVER (ORDER BY cycle) - 1 AS k FROM (SELECT DISTINCT cycle FROM v_vis))
SELECT {_S} FROM v_vis WHERE cycle IN (SELECT cycle FROM t WHERE k BETWEEN 10 AND 19)""")
def flt11_cycles(spark, sf):
    return _sample(select.cycles(view(spark, sf, "v_vis"), 10, 19))


@op("flt11_freq", """WITH @grid SELECT scan, ant1, ant2, beam, pol, chan, flag, ROUND(re, 6) + CAST(0.0 AS DOUBLE) AS re
FROM v_grid WHERE 700.0 + chan * 1.0 >= 710.5 AND 700.0 + chan * 1.0 <= 730.0""")
def flt11_freq(spark, sf):
    d = select.frequencies(spectra(spark, sf), 710.5, 730.0, 700.0, 1.0)
    e = average.explode_spectra(d, ["scan", "ant1", "ant2", "beam", "pol", "first_chan"])
    return e.select("scan", "ant1", "ant2", "beam", "pol", (F.col("chan") + F.col("first_chan")).alias("chan"),
                    "flag", r6("re").alias("re"))


@op("flt11_velocity", """WITH @grid SELECT scan, ant1, ant2, beam, pol, chan, flag, ROUND(re, 6) + CAST(0.0 AS DOUBLE) AS re
FROM v_grid WHERE 299792.458 * (1 - (1400.0 + chan * 0.5) / 1420.405752) BETWEEN -500.0 AND 1200.0""")
def flt11_velocity(spark, sf):
    """Channels by radio velocity about the neutral hydrogen line."""
    d = select.velocities(spectra(spark, sf), -500.0, 1200.0, 1420.405752, 1400.0, 0.5)
    e = average.explode_spectra(d, ["scan", "ant1", "ant2", "beam", "pol", "first_chan"])
    return e.select("scan", "ant1", "ant2", "beam", "pol", (F.col("chan") + F.col("first_chan")).alias("chan"), "flag", r6("re").alias("re"))


_row_filter("flt11_pol", lambda: select.polarisations(["XX", "YY"]), "pol IN ('XX', 'YY')")


@op("flt12", """WITH @grid SELECT scan, ant1, ant2, beam, pol, chan - 40 AS chan, flag, ROUND(re, 6) + CAST(0.0 AS DOUBLE) AS re,
       FALSE AS out_of_range FROM v_grid WHERE chan >= 40 AND chan < 54
UNION ALL SELECT scan, ant1, ant2, beam, pol, chan, TRUE AS flag, ROUND(re, 6) + CAST(0.0 AS DOUBLE) AS re, TRUE AS out_of_range FROM v_grid""")
def flt12(spark, sf):
    s = spectra(spark, sf)
    keys = ["scan", "ant1", "ant2", "beam", "pol"]
    inside = average.explode_spectra(select.stream_channels(s, 40, 14), keys).withColumn("out_of_range", F.lit(False))
    outside = average.explode_spectra(select.stream_channels(s, 41, 14), keys).withColumn("out_of_range", F.lit(True))
    return inside.unionByName(outside).select(*keys, "chan", "flag", r6("re").alias("re"), "out_of_range")


@op("flt14", f"""WITH f AS (SELECT r_regionkey AS field_id, r_name AS name FROM region)
SELECT {_S} FROM v_vis WHERE field IN (SELECT field_id FROM f WHERE name IN ('AMERICA', 'ASIA'))""")
def flt14(spark, sf):
    from ..views import tables

    fields = tables(spark, sf, "region").select(F.col("r_regionkey").cast("long").alias("field_id"), F.col("r_name").alias("name"))
    return _sample(select.field_names(view(spark, sf, "v_vis"), fields, ["AMERICA", "ASIA", "NOWHERE"]))


_C = "comp_id, ra_deg, dec_deg, flux_peak"
_CR = ("comp_id, ROUND(ra_deg, 6) AS ra_deg, ROUND(dec_deg, 6) + CAST(0.0 AS DOUBLE) AS dec_deg, "
       "ROUND(flux_peak, 6) + CAST(0.0 AS DOUBLE) AS flux_peak")
_SEP = ("DEGREES(ACOS(GREATEST(-1.0, LEAST(1.0, COS(RADIANS({ra1} - {ra2})) * COS(RADIANS({d1})) * COS(RADIANS({d2}))"
        " + SIN(RADIANS({d1})) * SIN(RADIANS({d2}))))))")


def sep_sql(ra1, d1, ra2, d2):
    return _SEP.format(ra1=ra1, d1=d1, ra2=ra2, d2=d2)


def comp(df, *more):
    return df.select("comp_id", *[r6(c).alias(c) for c in ("ra_deg", "dec_deg", "flux_peak")], *more)


@op("flt15", f"""SELECT {_CR} FROM v_comp WHERE freq_mhz >= 890 AND freq_mhz <= 905 AND flux_peak >= 2.0
AND spectral_index >= -0.6 AND spectral_index <= 0.0""")
def flt15(spark, sf):
    return comp(view(spark, sf, "v_comp").where(select.criteria({
        "freq_mhz": (890.0, 905.0), "flux_peak": (2.0, -1.0), "spectral_index": (-0.6, 0.0), "dec_deg": (-1.0, None)})))


_RAD = "0.017453292519943295e0"
_WOVEN = " + ".join(f"(x // {1 << i}) % 2 * {1 << 2 * i} + (y // {1 << i}) % 2 * {2 << 2 * i}" for i in range(10))
#: Nested index at nside 1024 and the place on the rings: z and t of the position, the face, x and y in it.
_PIXELS = f"""s AS (SELECT *, SIN(dec_deg * {_RAD}) AS z, (ra_deg - 360 * FLOOR(ra_deg / 360)) / 90.0 AS t FROM v_comp),
 e AS (SELECT *, ABS(z) <= 2.0::DOUBLE / 3.0 AS belt, CAST(LEAST(3, FLOOR(t)) AS BIGINT) AS q, SQRT(3.0 * (1.0 - ABS(z))) * 1024 AS w FROM s),
 d AS (SELECT *, CASE WHEN belt THEN CAST(FLOOR((0.5 + t) * 1024 - z * 768) AS BIGINT) ELSE LEAST(1023, CAST(FLOOR((t - q) * w) AS BIGINT)) END AS p,
  CASE WHEN belt THEN CAST(FLOOR((0.5 + t) * 1024 + z * 768) AS BIGINT) ELSE LEAST(1023, CAST(FLOOR((1.0 - t + q) * w) AS BIGINT)) END AS m FROM e),
 f AS (SELECT *, CASE WHEN NOT belt THEN q + CASE WHEN z >= 0 THEN 0 ELSE 8 END WHEN p // 1024 = m // 1024 THEN (p // 1024) % 4 + 4
   WHEN p < m THEN (p // 1024) % 4 ELSE (m // 1024) % 4 + 8 END AS face,
  CASE WHEN belt THEN m % 1024 WHEN z >= 0 THEN 1023 - m ELSE p END AS x, CASE WHEN belt THEN 1023 - p % 1024 WHEN z >= 0 THEN 1023 - p ELSE m END AS y FROM d),
 h AS (SELECT *, face * 1048576 + {_WOVEN} AS healpix_index,
  (face // 4 + 2) * 1024 - x - y - 1 AS jr FROM f),
 g AS (SELECT *, CASE WHEN jr < 1024 THEN jr WHEN jr > 3072 THEN 4096 - jr ELSE 1024 END AS nr, CASE WHEN jr < 1024 OR jr > 3072 THEN 0 ELSE jr % 2 END AS odd FROM h),
 k AS (SELECT *, ((face % 4 * 2 + CASE WHEN face // 4 = 1 THEN 0 ELSE 1 END) * nr + x - y + 1 + odd) // 2 AS j0 FROM g),
 px AS (SELECT *, (CASE WHEN j0 > 4 * nr THEN j0 - 4 * nr WHEN j0 < 1 THEN j0 + 4 * nr ELSE j0 END - (odd + 1) * 0.5) * 90.0 / nr AS pix_ra,
  ASIN(CASE WHEN jr < 1024 THEN 1.0 - nr * nr / 3145728.0 WHEN jr > 3072 THEN nr * nr / 3145728.0 - 1.0 ELSE (2048 - jr) * (2.0 / 3072.0) END) / {_RAD} AS pix_dec FROM k)"""
_RIM = healpix.max_pixel_radius_deg(healpix.NSIDE)


def _rect_sql(ra, dec, width, height):
    """Pixel centres on the inner side of each edge of the rectangle's great circles, or nearer than a pixel's radius."""
    unit = [(math.cos(math.radians(d)) * math.cos(math.radians(r)), math.cos(math.radians(d)) * math.sin(math.radians(r)), math.sin(math.radians(d)))
            for r, d in sky.rect_corners(ra, dec, width, height)]
    mid, sides = [sum(c) for c in zip(*unit)], []
    for u, v in zip(unit, unit[1:] + unit[:1]):
        n = np.cross(u, v)
        n = n / np.linalg.norm(n) * (1 if np.dot(n, mid) >= 0 else -1)
        a, d = f"pix_ra * {_RAD}", f"pix_dec * {_RAD}"
        sides.append(f"COS({d}) * COS({a}) * ({n[0]:.17e}) + COS({d}) * SIN({a}) * ({n[1]:.17e}) + SIN({d}) * ({n[2]:.17e}) >= {-math.sin(math.radians(_RIM)):.17e}")
    return " AND ".join(sides)


@op("flt16", f"""WITH {_PIXELS} SELECT {_CR}, healpix_index FROM px WHERE {sep_sql('pix_ra', 'pix_dec', 79.0, -30.0)} <= 20.0 + {_RIM:.17e}""")
def flt16(spark, sf):
    """Pixel-inclusive cone: complete, with extra rows near the rim (see flt16_exact)."""
    m = skymodel.index_components(view(spark, sf, "v_comp"))
    return comp(skymodel.cone_search(m, 79.0, -30.0, 20.0), "healpix_index")


@op("flt16_exact", f"""SELECT {_CR} FROM v_comp WHERE {sep_sql('ra_deg', 'dec_deg', 79.0, -30.0)} <= 20.0
AND flux_peak >= 1.0""")
def flt16_exact(spark, sf):
    m = skymodel.index_components(view(spark, sf, "v_comp"))
    return comp(skymodel.cone_search(m, 79.0, -30.0, 20.0, exact=True, bounds={"flux_peak": (1.0, None)}))


@op("flt17", f"""WITH {_PIXELS} SELECT {_CR}, healpix_index FROM px WHERE {_rect_sql(355.0, 10.0, 30.0, 20.0)}""")
def flt17(spark, sf):
    """Pixel-inclusive rectangle (see flt17_exact)."""
    m = skymodel.index_components(view(spark, sf, "v_comp"))
    return comp(skymodel.rect_search(m, 355.0, 10.0, 30.0, 20.0), "healpix_index")


@op("flt17_exact", f"""SELECT {_CR} FROM v_comp WHERE (ra_deg >= 340 OR ra_deg <= 10) AND dec_deg BETWEEN 0 AND 20""")
def flt17_exact(spark, sf):
    m = skymodel.index_components(view(spark, sf, "v_comp"))
    return comp(skymodel.rect_search(m, 355.0, 10.0, 30.0, 20.0, exact=True))


@op("flt19", f"""SELECT {_CR} FROM v_comp WHERE {sep_sql('ra_deg', 'dec_deg', 180.0, -45.0)} <= 40.0 AND flux_peak >= 3.0""")
def flt19(spark, sf):
    return comp(select.cone_flux(view(spark, sf, "v_comp"), 180.0, -45.0, 40.0, 3.0))


@op("flt19_counts", f"""SELECT CASE WHEN {sep_sql('ra_deg', 'dec_deg', 180.0, -45.0)} > 40.0 THEN 'outside_cone'
  WHEN flux_peak < 3.0 THEN 'below_flux' ELSE 'accepted' END AS verdict, COUNT(*) AS n FROM v_comp GROUP BY 1""")
def flt19_counts(spark, sf):
    return select.cone_flux_counts(view(spark, sf, "v_comp"), 180.0, -45.0, 40.0, 3.0)


@op("flt20", f"""WITH ids AS (SELECT s_suppkey * 17 AS comp_id FROM supplier)
SELECT i.comp_id, ROUND(c.ra_deg, 6) AS ra_deg, ROUND(c.dec_deg, 6) + CAST(0.0 AS DOUBLE) AS dec_deg,
  ROUND(c.flux_peak, 6) + CAST(0.0 AS DOUBLE) AS flux_peak FROM ids i LEFT JOIN v_comp c ON c.comp_id = i.comp_id""")
def flt20(spark, sf):
    from ..views import tables

    ids = tables(spark, sf, "supplier").select((F.col("s_suppkey") * 17).alias("comp_id"))
    return comp(select.by_id(view(spark, sf, "v_comp"), ids, "comp_id"))


_LISTS = [("bright_wide", 8.0, 60.0), ("mid", 4.0, 30.0), ("faint_narrow", 1.0, 15.0)]


@op("flt21", "SELECT l.list_name, c.comp_id FROM v_comp c JOIN (VALUES " + ", ".join(
    f"('{n}', CAST({f} AS DOUBLE), CAST({r} AS DOUBLE))" for n, f, r in _LISTS) + f""") l(list_name, flux, radius)
ON c.flux_peak >= l.flux AND {sep_sql('c.ra_deg', 'c.dec_deg', 120.0, -20.0)} <= l.radius""")
def flt21(spark, sf):
    return select.sub_lists(view(spark, sf, "v_comp"), _LISTS, 120.0, -20.0).select("list_name", "comp_id")


@op("flt22", """SELECT comp_id, ROUND(flux_peak * POWER(1400.0 / freq_mhz, spectral_index), 6) AS flux_1400
FROM v_comp WHERE ra_deg BETWEEN 40 AND 80 AND dec_deg BETWEEN -40 AND 0 AND flux_peak > 0.5""")
def flt22(spark, sf):
    df = view(spark, sf, "v_comp")
    return spark.sql(
        """SELECT comp_id, round(flux_peak * power(1400.0D / freq_mhz, spectral_index), 6) AS flux_1400
           FROM {sky} WHERE ra_deg BETWEEN 40 AND 80 AND dec_deg BETWEEN -40 AND 0 AND flux_peak > 0.5""", sky=df)


@op("flt23", """SELECT event_id, point AS level, antenna FROM v_mon WHERE point IN ('error', 'view')
AND ts >= TIMESTAMP '2024-01-05' AND ts <= TIMESTAMP '2024-01-20' AND antenna % 5 = 2""")
def flt23(spark, sf):
    ev = view(spark, sf, "v_mon").select(
        "event_id", F.col("point").alias("level"), "antenna", F.col("ts").alias("created"),
        F.concat(F.lit("host"), (F.col("antenna") % 5).cast("string")).alias("host"))
    return select.log_query(ev, start=dt.datetime(2024, 1, 5), stop=dt.datetime(2024, 1, 20),
                            levels=["error", "view"], host="host2").select("event_id", "level", "antenna")


@op("flt23_values", "SELECT DISTINCT point AS level FROM v_mon")
def flt23_values(spark, sf):
    return view(spark, sf, "v_mon").select(F.col("point").alias("level")).distinct()


@op("sc5", f"WITH {_PIXELS} SELECT comp_id, healpix_index FROM px")
def sc5(spark, sf):
    c = view(spark, sf, "v_comp")
    return c.select("comp_id", healpix.ang2pix_nest(healpix.NSIDE, F.col("ra_deg"), F.col("dec_deg")).alias("healpix_index"))


@op("jn21", f"""WITH f AS (SELECT n_nationkey AS field_id, (n_nationkey * 37) % 360 AS ra, (n_nationkey * 11) % 120 - 60 AS dec FROM nation)
SELECT f.field_id, c.comp_id FROM f JOIN v_comp c ON {sep_sql('c.ra_deg', 'c.dec_deg', 'f.ra', 'f.dec')} <= 3.0""")
def jn21(spark, sf):
    from ..views import tables

    fields = tables(spark, sf, "nation").select(
        F.col("n_nationkey").alias("field_id"), ((F.col("n_nationkey") * 37) % 360).cast("double").alias("ra"),
        ((F.col("n_nationkey") * 11) % 120 - 60).cast("double").alias("dec"))
    m = skymodel.index_components(view(spark, sf, "v_comp"))
    return skymodel.footprints(m, fields, "field_id", 3.0).select("field_id", "comp_id")
