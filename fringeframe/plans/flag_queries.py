"""Flagging queries (FLG*, flag reports, shadowing) and their checking SQL."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions.prefix import runs
from ..operators import flag, joins, select
from ..views import spectra, tables, view
from .registry import op, r6

KEY = ["scan", "ant1", "ant2", "beam", "pol"]
_K = ", ".join(KEY)


def digest(df, *keys):
    """Flag pattern per spectrum: how many flags, and the sum of their channels."""
    on = F.filter(F.transform("flag", lambda f, i: F.when(f, i.cast("long"))), lambda x: x.isNotNull())
    return df.withColumn("__on", on).select(
        *keys, F.size("__on").cast("long").alias("n_flag"),
        F.aggregate("__on", F.lit(0).cast("long"), lambda a, x: a + x).alias("chan_sum"))


def digest_sql(keys, flag_expr, source):
    return (f"SELECT {keys}, CAST(SUM(CASE WHEN {flag_expr} THEN 1 ELSE 0 END) AS BIGINT) AS n_flag, "
            f"CAST(SUM(CASE WHEN {flag_expr} THEN chan ELSE 0 END) AS BIGINT) AS chan_sum FROM {source} GROUP BY {keys}")


@op("flg1", "WITH @grid " + digest_sql(_K, "flag OR (ant1 = 1 AND scan IN (2, 3) AND beam = 1) OR ant1 = ant2", "v_grid"))
def flg1(spark, sf):
    d = flag.flag_rows(spectra(spark, sf), (F.col("ant1") == 1) & F.col("scan").isin(2, 3) & select.feed(1))
    return digest(flag.flag_rows(d, select.auto_correlations()), *KEY)


@op("flg2", "WITH @grid " + digest_sql(
    _K, "flag OR (beam = 2 AND ((chan BETWEEN 3 AND 21 AND (chan - 3) % 3 = 0) OR chan BETWEEN 50 AND 53))", "v_grid"))
def flg2(spark, sf):
    return digest(flag.flag_channels(spectra(spark, sf), [(3, 21, 3), (50, 60, 1)], select.feed(2)), *KEY)


@op("flg3", """WITH t AS (SELECT DISTINCT cycle, field FROM v_vis),
a AS (SELECT DISTINCT s_suppkey % 6 AS ant, -26.7 + 0.3 * CAST(s_suppkey % 6 AS DOUBLE) AS lat FROM supplier),
e AS (SELECT cycle, field, ant, DEGREES(ASIN(SIN(RADIANS(lat)) * SIN(RADIANS(-30.0 - 20.0 * field))
   + COS(RADIANS(lat)) * COS(RADIANS(-30.0 - 20.0 * field)) * COS(RADIANS((cycle - 32) * 3.1)))) AS elevation FROM t CROSS JOIN a)
SELECT r.cycle, r.field, r.ant1, r.ant2, r.beam,
  (e1.elevation < 20 OR e1.elevation > 80 OR e2.elevation < 20 OR e2.elevation > 80) AS bad_elevation
FROM v_row r JOIN e e1 ON e1.cycle = r.cycle AND e1.field = r.field AND e1.ant = r.ant1
JOIN e e2 ON e2.cycle = r.cycle AND e2.field = r.field AND e2.ant = r.ant2""")
def flg3(spark, sf):
    rows = view(spark, sf, "v_row")
    times = view(spark, sf, "v_vis").select("cycle", "field").distinct().select(
        "cycle", "field", ((F.col("cycle") - 32) * 3.1).alias("hour_angle"), (-30.0 - 20.0 * F.col("field")).alias("dec"))
    ants = tables(spark, sf, "supplier").select((F.col("s_suppkey") % 6).alias("ant")).distinct().select(
        "ant", (-26.7 + 0.3 * F.col("ant")).alias("latitude"))
    elev = flag.elevation_table(times, ants, ["cycle", "field"])
    out = flag.low_high_elevation(rows, elev, ["cycle", "field"], 20.0, 80.0)
    return out.select("cycle", "field", "ant1", "ant2", "beam", "bad_elevation")


def _cross_hands(spark, sf):
    """Spectra with two products side by side; the test data has XY and YY, the second stands in for YX."""
    s = spectra(spark, sf)
    k = ["scan", "ant1", "ant2", "beam"]
    a = s.where("pol = 'XY'").select(*k, F.col("re").alias("xy_re"), F.col("im").alias("xy_im"), F.col("flag").alias("f1"))
    b = s.where("pol = 'YY'").select(*k, F.col("re").alias("yx_re"), F.col("im").alias("yx_im"), F.col("flag").alias("f2"))
    return a.join(b, k).withColumn("flag", flag.or_mask("f1", F.col("f2"))).drop("f1", "f2")


_V = """WITH @grid, vv AS (
  SELECT a.scan, a.ant1, a.ant2, a.beam, a.chan, a.flag OR b.flag AS flag,
         SQRT((a.re - b.re) * (a.re - b.re) + (a.im - b.im) * (a.im - b.im)) / 2.0 AS amp
  FROM v_grid a JOIN v_grid b ON a.scan = b.scan AND a.ant1 = b.ant1 AND a.ant2 = b.ant2 AND a.beam = b.beam
       AND a.chan = b.chan WHERE a.pol = 'XY' AND b.pol = 'YY'), """
_VK = "scan, ant1, ant2, beam"


@op("flg4", _V + f"""st AS (SELECT {_VK}, AVG(amp) AS m, COALESCE(STDDEV_SAMP(amp), 0) AS s FROM vv WHERE NOT flag GROUP BY {_VK}),
o AS (SELECT v.*, v.flag OR COALESCE((ABS(m) > 1.1920929e-07 OR ABS(s) > 1.1920929e-07) AND amp > m + 1.5 * s, FALSE) AS nf
      FROM vv v LEFT JOIN st USING ({_VK})) """ + digest_sql(_VK, "nf", "o"))
def flg4(spark, sf):
    return digest(flag.clip_stokes_v(_cross_hands(spark, sf), 1.5), "scan", "ant1", "ant2", "beam")


def _iqr_sql(keys, source, value):
    return f"""rk AS (SELECT {keys}, {value} AS x, ROW_NUMBER() OVER (PARTITION BY {keys} ORDER BY {value}) - 1 AS i,
        COUNT(*) OVER (PARTITION BY {keys}) AS n FROM {source}),
 st AS (SELECT {keys}, MAX(CASE WHEN i = n // 2 THEN x END) AS m,
   (MAX(CASE WHEN i = (3 * n) // 4 THEN x END) - MAX(CASE WHEN i = n // 4 THEN x END)) / CAST(1.34896 AS DOUBLE) AS s
   FROM rk GROUP BY {keys})"""


@op("flg5", _V + f"""g AS (SELECT * FROM vv WHERE NOT flag), {_iqr_sql(_VK, 'g', 'amp')},
o AS (SELECT v.*, v.flag OR COALESCE((ABS(m) > 1.1920929e-07 OR ABS(s) > 1.1920929e-07) AND amp > m + 1.5 * s, FALSE) AS nf
      FROM vv v LEFT JOIN st USING ({_VK})) """ + digest_sql(_VK, "nf", "o"))
def flg5(spark, sf):
    return digest(flag.clip_stokes_v(_cross_hands(spark, sf), 1.5, robust=True), "scan", "ant1", "ant2", "beam")


_AMP = "WITH @grid, ga AS (SELECT *, SQRT(re * re + im * im) AS amp FROM v_grid), "


@op("flg6", _AMP + "o AS (SELECT *, flag OR amp < 2.0 OR amp > 22.0 AS nf FROM ga) " + digest_sql(_K, "nf", "o"))
def flg6(spark, sf):
    return digest(flag.clip_fixed(spectra(spark, sf), 2.0, 22.0), *KEY)


_CLIP = f"""g AS (SELECT * FROM ga WHERE NOT flag), {_iqr_sql(_K, 'g', 'amp')},
 c AS (SELECT ga.*, ga.flag OR COALESCE(amp < m - 1.2 * s OR amp > m + 1.2 * s, FALSE) AS nf FROM ga LEFT JOIN st USING ({_K}))"""


@op("flg7", _AMP + _CLIP + " " + digest_sql(_K, "nf", "c"))
def flg7(spark, sf):
    return digest(flag.clip_auto(spectra(spark, sf), 1.2), *KEY)


@op("flg7_low", _AMP + f"""g AS (SELECT * FROM ga WHERE NOT flag), {_iqr_sql(_K, 'g', 'amp')},
 c AS (SELECT ga.*, ga.flag OR amp < 3.0 OR COALESCE(amp > m + 1.0 * s, FALSE) AS nf FROM ga LEFT JOIN st USING ({_K})) """
    + digest_sql(_K, "nf", "c"))
def flg7_low(spark, sf):
    return digest(flag.clip_auto(spectra(spark, sf), 1.0, low=3.0), *KEY)


def _rename(sql, suffix):
    for n in ("rk", "st"):
        sql = sql.replace(f"{n} AS (", f"{n}{suffix} AS (").replace(f"FROM {n} ", f"FROM {n}{suffix} ")
    return sql


@op("flg8", _AMP + _CLIP + """, av AS (SELECT ant1, ant2, beam, pol, chan, AVG(CASE WHEN NOT nf THEN amp END) AS a FROM c GROUP BY 1,2,3,4,5),
 g2 AS (SELECT * FROM av WHERE a IS NOT NULL), """ + _rename(_iqr_sql("ant1, ant2, beam, pol", "g2", "a"), "2") + f""",
 o AS (SELECT c.*, c.nf OR COALESCE(av.a < st2.m - 1.5 * st2.s OR av.a > st2.m + 1.5 * st2.s, TRUE) AS ff
   FROM c JOIN av USING (ant1, ant2, beam, pol, chan) LEFT JOIN st2 USING (ant1, ant2, beam, pol)) """ + digest_sql(_K, "ff", "o"))
def flg8(spark, sf):
    first = flag.clip_auto(spectra(spark, sf), 1.2)
    return digest(flag.integrate_spectra(first, ["ant1", "ant2", "beam", "pol"], 1.5), *KEY)


@op("flg9", _AMP + _CLIP + """, av AS (SELECT scan, ant1, ant2, beam, pol, AVG(CASE WHEN NOT nf THEN amp END) AS a FROM c GROUP BY 1,2,3,4,5),
 g2 AS (SELECT * FROM av WHERE a IS NOT NULL), """ + _rename(_iqr_sql("ant1, ant2, beam, pol", "g2", "a"), "2") + f""",
 o AS (SELECT c.*, c.nf OR COALESCE(av.a < st2.m - 1.0 * st2.s OR av.a > st2.m + 1.0 * st2.s, TRUE) AS ff
   FROM c JOIN av USING ({_K}) LEFT JOIN st2 USING (ant1, ant2, beam, pol)) """ + digest_sql(_K, "ff", "o"))
def flg9(spark, sf):
    first = flag.clip_auto(spectra(spark, sf), 1.2)
    return digest(flag.integrate_times(first, ["ant1", "ant2", "beam", "pol"], "scan", 1.0), *KEY)


_STATS = f"""SELECT CAST(SUM(f) AS BIGINT) AS vis_already_flagged, CAST(SUM(nf - f) AS BIGINT) AS vis_flagged,
 CAST(SUM(CASE WHEN nf = nch AND f < nch THEN 1 ELSE 0 END) AS BIGINT) AS rows_flagged, COUNT(*) AS n_rows FROM (
 SELECT {_K}, SUM(CASE WHEN flag THEN 1 ELSE 0 END) AS f, SUM(CASE WHEN nf THEN 1 ELSE 0 END) AS nf, COUNT(*) AS nch FROM c GROUP BY {_K})"""


@op("flg10", _AMP + _CLIP + _STATS)
def flg10(spark, sf):
    """Dry run: the clip's statistics, nothing written."""
    s = spectra(spark, sf)
    after = flag.clip_auto(s.withColumn("old", F.col("flag")), 1.2)
    return flag.flag_statistics(after.select(F.col("old").alias("flag"), F.col("flag").alias("new_flag")))


@op("agg4", _AMP + "c AS (SELECT *, flag OR amp < 2.0 OR amp > 22.0 AS nf FROM ga) " + _STATS)
def agg4(spark, sf):
    s = spectra(spark, sf).withColumn("old", F.col("flag"))
    after = flag.clip_fixed(s, 2.0, 22.0)
    return flag.flag_statistics(after.select(F.col("old").alias("flag"), F.col("flag").alias("new_flag")))


@op("flg11", _AMP + f"""o AS (SELECT *, NOT flag AND amp > CASE WHEN ant1 = ant2 THEN 15.0 ELSE 20.0 END AS hit FROM ga)
SELECT {_K}, CAST(SUM(CASE WHEN flag OR hit THEN 1 ELSE 0 END) AS BIGINT) AS n_flag,
 ROUND(SUM(CASE WHEN hit THEN 0.0 ELSE re END), 6) + CAST(0.0 AS DOUBLE) AS re_sum FROM o GROUP BY {_K}""")
def flg11(spark, sf):
    d = flag.clip_stream(spectra(spark, sf), 15.0, 20.0, zero=True)
    return d.select(*KEY, F.size(F.filter("flag", lambda f: f)).cast("long").alias("n_flag"),
                    r6(F.aggregate("re", F.lit(0.0), lambda a, x: a + x)).alias("re_sum"))


@op("flg12", """WITH @grid, bad AS (SELECT DISTINCT p_partkey % 6 AS ant1, p_size % 6 AS ant2,
   CASE WHEN p_partkey % 2 = 0 THEN 'XX' ELSE 'YY' END AS pol, (p_partkey * 5) % 54 AS chan FROM part),
 o AS (SELECT g.*, b.chan IS NOT NULL AS hit FROM v_grid g LEFT JOIN bad b USING (ant1, ant2, pol, chan))
SELECT """ + _K + """, CAST(SUM(CASE WHEN flag OR hit THEN 1 ELSE 0 END) AS BIGINT) AS n_flag,
 ROUND(SUM(CASE WHEN hit THEN 0.0 ELSE re END), 6) + CAST(0.0 AS DOUBLE) AS re_sum FROM o GROUP BY """ + _K)
def flg12(spark, sf):
    p = tables(spark, sf, "part")
    bad = (p.select((F.col("p_partkey") % 6).alias("ant1"), (F.col("p_size") % 6).cast("long").alias("ant2"),
                    F.when(F.col("p_partkey") % 2 == 0, "XX").otherwise("YY").alias("pol"),
                    ((F.col("p_partkey") * 5) % 54).cast("int").alias("chan"))
           .groupBy("ant1", "ant2", "pol").agg(F.collect_set("chan").alias("chans")))
    d = flag.flag_listed(spectra(spark, sf), bad, ["ant1", "ant2", "pol"])
    return d.select(*KEY, F.size(F.filter("flag", lambda f: f)).cast("long").alias("n_flag"),
                    r6(F.aggregate("re", F.lit(0.0), lambda a, x: a + x)).alias("re_sum"))


_SH = """WITH rows0 AS (SELECT cycle, ant1, ant2, ROUND(AVG(u), 6) AS u, ROUND(AVG(v), 6) AS v, ROUND(AVG(w), 6) AS w, COUNT(*) AS n FROM v_vis GROUP BY 1,2,3),
 sh AS (SELECT DISTINCT cycle, CASE WHEN w < 0 THEN ant1 ELSE ant2 END AS ant FROM rows0
   WHERE ant1 <> ant2 AND SQRT(u*u+v*v+w*w) >= 1e-6 AND SQRT(u*u+v*v) < 1.0) """


def _shadow(spark, sf, diameter=1.0):
    rows = view(spark, sf, "v_vis").groupBy("cycle", "ant1", "ant2").agg(
        *[F.round(F.avg(c), 6).alias(c) for c in "uvw"],
        F.lit(True).alias("flag"), F.count(F.lit(1)).alias("n"))
    return rows, flag.shadowed_antennas(rows, ["cycle"], diameter)


@op("flg13", _SH + """SELECT r.cycle, r.ant1, r.ant2,
 (EXISTS (SELECT 1 FROM sh WHERE sh.cycle = r.cycle AND (sh.ant = r.ant1 OR sh.ant = r.ant2))) AS shadowed FROM rows0 r""")
def flg13(spark, sf):
    rows, sh = _shadow(spark, sf)
    return flag.touches(rows, sh, ["cycle"], "shadowed").select("cycle", "ant1", "ant2", "shadowed")


@op("str9", _SH + """, tt AS (SELECT cycle, LAG(cycle) OVER (ORDER BY cycle) AS p FROM (SELECT DISTINCT cycle FROM rows0))
SELECT sh.cycle, sh.ant, 'enter' AS event FROM sh JOIN tt USING (cycle)
 WHERE NOT EXISTS (SELECT 1 FROM sh s2 WHERE s2.cycle = tt.p AND s2.ant = sh.ant)
UNION ALL SELECT tt.cycle, s2.ant, 'leave' AS event FROM tt JOIN sh s2 ON s2.cycle = tt.p
 WHERE NOT EXISTS (SELECT 1 FROM sh WHERE sh.cycle = tt.cycle AND sh.ant = s2.ant)""")
def str9(spark, sf):
    """Batch replay of the shadow log."""
    rows, sh = _shadow(spark, sf)
    return flag.shadow_transitions(sh, rows, "cycle")


@op("flg14", """WITH s AS (SELECT cycle, scan_id, CASE WHEN LAG(scan_id) OVER (ORDER BY cycle) IS DISTINCT FROM scan_id THEN 1 ELSE 0 END AS new FROM v_meta),
 r AS (SELECT cycle, SUM(new) OVER (ORDER BY cycle) AS run FROM s),
 q AS (SELECT cycle FROM (SELECT cycle, ROW_NUMBER() OVER (PARTITION BY run ORDER BY cycle) AS k FROM r) WHERE k <= 2)
SELECT cycle, field, ant1, ant2, beam, (flag OR cycle IN (SELECT cycle FROM q)) AS flag FROM v_row""")
def flg14(spark, sf):
    first = flag.quack_cycles(view(spark, sf, "v_meta"), "cycle", "scan_id", 2).withColumn("__q", F.lit(True))
    j = view(spark, sf, "v_row").join(first, "cycle", "left")
    return j.select("cycle", "field", "ant1", "ant2", "beam",
                    (F.col("flag") | F.coalesce("__q", F.lit(False))).alias("flag"))


@op("flg15", """WITH d AS (SELECT DISTINCT cycle * 1000 + (cycle * 7) % 9 * 100 AS data_time, cycle FROM v_vis)
SELECT m.cycle * 1000 AS meta_time, d.data_time AS time, d.data_time <> m.cycle * 1000 AS flag
FROM v_meta m JOIN d ON ABS(d.data_time - m.cycle * 1000) < 500""")
def flg15(spark, sf):
    data = view(spark, sf, "v_vis").select((F.col("cycle") * 1000 + (F.col("cycle") * 7) % 9 * 100).alias("data_time")).distinct()
    meta = view(spark, sf, "v_meta").select((F.col("cycle") * 1000).alias("meta_time"))
    return joins.match_times(meta, data, "meta_time", "data_time", 1000)


@op("flg16", """WITH r0 AS (SELECT *, ABS(u) < 12 AS bad FROM v_row),
 e AS (SELECT cycle, field, ant1 AS ant, ant1 <> ant2 AND NOT bad AS good FROM r0
       UNION ALL SELECT cycle, field, ant2 AS ant, ant1 <> ant2 AND NOT bad AS good FROM r0),
 b AS (SELECT cycle, field, ant FROM e GROUP BY 1,2,3 HAVING NOT BOOL_OR(good))
SELECT cycle, field, ant1, ant2, beam, EXISTS (SELECT 1 FROM b WHERE b.cycle = r0.cycle AND b.field = r0.field
   AND (b.ant = r0.ant1 OR b.ant = r0.ant2)) AS flagged FROM r0""")
def flg16(spark, sf):
    rows = view(spark, sf, "v_row")
    bad = flag.antennas_without_baselines(rows, F.abs(F.col("u")) < 12, ["cycle", "field"])
    return flag.touches(rows, bad, ["cycle", "field"], "flagged").select("cycle", "field", "ant1", "ant2", "beam", "flagged")


_RFI = """WITH rfi AS (SELECT n_nationkey AS rfi_id, 690.0 + n_nationkey * 2.5 AS f_lo, 690.0 + n_nationkey * 2.5 + 0.2 + (n_nationkey % 4) AS f_hi,
  (n_nationkey * 5) % 60 AS t_lo, (n_nationkey * 5) % 60 + 9 AS t_hi FROM nation)"""


def _rfi(spark, sf):
    n = F.col("n_nationkey")
    return tables(spark, sf, "nation").select(
        n.alias("rfi_id"), (690.0 + n * 2.5).alias("f_lo"), (690.0 + n * 2.5 + 0.2 + n % 4).alias("f_hi"),
        ((n * 5) % 60).alias("t_lo"), ((n * 5) % 60 + 9).alias("t_hi"))


@op("flg17", _RFI + """ SELECT v.cycle, v.chan, v.pol, COUNT(*) AS n_vis FROM v_vis v
WHERE EXISTS (SELECT 1 FROM rfi r WHERE 700.0 + v.chan * 1.0 BETWEEN r.f_lo AND r.f_hi AND v.cycle BETWEEN r.t_lo AND r.t_hi)
GROUP BY 1, 2, 3""")
def flg17(spark, sf):
    vis = view(spark, sf, "v_vis").withColumn("freq", 700.0 + F.col("chan") * 1.0)
    hit = joins.in_any_range(vis, _rfi(spark, sf), "freq", "f_lo", "f_hi", 2.0, F.col("cycle").between(F.col("t_lo"), F.col("t_hi")))
    return hit.groupBy("cycle", "chan", "pol").agg(F.count(F.lit(1)).alias("n_vis"))


@op("jn9", _RFI + """ SELECT r.rfi_id, v.cycle, v.chan, COUNT(*) AS n_vis FROM v_vis v
JOIN rfi r ON 700.0 + v.chan * 1.0 BETWEEN r.f_lo AND r.f_hi AND v.cycle BETWEEN r.t_lo AND r.t_hi GROUP BY 1, 2, 3""")
def jn9(spark, sf):
    cells = view(spark, sf, "v_vis").groupBy("cycle", "chan").agg(F.count(F.lit(1)).alias("n"))
    vis = cells.withColumn("freq", 700.0 + F.col("chan") * 1.0)
    j = joins.range_join(vis, _rfi(spark, sf), "freq", "f_lo", "f_hi", 2.0, F.col("cycle").between(F.col("t_lo"), F.col("t_hi")))
    return j.groupBy("rfi_id", "cycle", "chan").agg(F.sum("n").alias("n_vis"))


@op("agg3", """WITH @grid, sp AS (SELECT scan, ant1, ant2, beam, pol, scan // 2 AS chunk_scan, scan % 2 = 9 AS x,
   SUM(CASE WHEN flag THEN 1 ELSE 0 END) AS n_flag, COUNT(*) AS n_chan FROM v_grid GROUP BY 1,2,3,4,5),
 t AS (SELECT scan, chunk_scan, CASE WHEN LAG(chunk_scan) OVER (ORDER BY scan) IS DISTINCT FROM chunk_scan THEN 1 ELSE 0 END AS new
   FROM (SELECT DISTINCT scan, chunk_scan FROM sp)), r AS (SELECT scan, CAST(SUM(new) OVER (ORDER BY scan) AS BIGINT) AS chunk FROM t)
SELECT chunk, chunk_scan, COUNT(*) AS n_rows, ROUND(100.0 * SUM(CASE WHEN n_flag = n_chan THEN 1 ELSE 0 END) / COUNT(*), 6) AS pct_rows_flagged,
 ROUND(CAST(100.0 * SUM(n_flag) / SUM(n_chan) AS DOUBLE), 6) AS pct_vis_flagged, COUNT(DISTINCT scan) AS n_times,
 COUNT(DISTINCT ant1 * 100 + ant2) AS n_baselines, COUNT(DISTINCT beam) AS n_beams FROM sp JOIN r USING (scan) GROUP BY 1, 2""")
def agg3(spark, sf):
    s = spectra(spark, sf).select(
        *KEY, F.floor(F.col("scan") / 2).alias("chunk_scan"),
        F.size(F.filter("flag", lambda f: f)).cast("long").alias("n_flag"), F.size("flag").cast("long").alias("n_chan"))
    out = flag.flag_summary(s, "scan", ["chunk_scan"], F.floor(F.col("scan") / F.lit(1024)))
    return out.withColumn("pct_rows_flagged", r6("pct_rows_flagged")).withColumn("pct_vis_flagged", r6("pct_vis_flagged"))


@op("win7", """WITH s AS (SELECT cycle, scan_id, field % 2 AS f, CASE WHEN LAG(scan_id) OVER (ORDER BY cycle) IS DISTINCT FROM scan_id
   OR LAG(field % 2) OVER (ORDER BY cycle) IS DISTINCT FROM field % 2 THEN 1 ELSE 0 END AS new FROM v_meta)
SELECT cycle, CAST(SUM(new) OVER (ORDER BY cycle) AS BIGINT) AS run FROM s""")
def win7(spark, sf):
    m = view(spark, sf, "v_meta").withColumn("f", F.col("field") % 2)
    return runs(m, [], "cycle", F.floor(F.col("cycle") / F.lit(16)), ["scan_id", "f"]).select("cycle", "run")
