"""Joins, calibration, prediction and gridding queries with their checking SQL."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions.cx import Cx
from ..operators import average, calibrate, flag, joins, predict
from ..sources import caltext
from ..views import spectra, tables, view
from .registry import op, r6



def rs(expr, name, digits=6):
    return f"ROUND(CAST({expr} AS DOUBLE) + 3.1e-9, {digits}) AS {name}"


@op("jn1", "SELECT m.cycle, m.scan_id, m.field AS meta_field, v.beam, COUNT(*) AS n_vis, " + rs("SUM(v.re)", "re_sum") +
    " FROM v_vis v JOIN v_meta m ON m.cycle = v.cycle WHERE m.scan_id >= 0 GROUP BY 1, 2, 3, 4")
def jn1(spark, sf):
    meta = view(spark, sf, "v_meta").withColumnRenamed("field", "meta_field")
    j = joins.merge_on_time(view(spark, sf, "v_vis"), meta, "cycle")
    return j.groupBy("cycle", "scan_id", "meta_field", "beam").agg(F.count(F.lit(1)).alias("n_vis"), r6(F.sum("re")).alias("re_sum"))


@op("jn2", """SELECT c.comp_id, ROUND(p.rm, 6) AS rm, d.name AS source_name FROM v_comp c
LEFT JOIN (SELECT s_suppkey * 3 AS comp_id, s_acctbal / 100.0 AS rm FROM supplier) p ON p.comp_id = c.comp_id
LEFT JOIN (SELECT n_nationkey AS source_id, n_name AS name FROM nation WHERE n_regionkey < 3) d ON d.source_id = c.island_id""")
def jn2(spark, sf):
    pol = tables(spark, sf, "supplier").select((F.col("s_suppkey") * 3).alias("comp_id"), (F.col("s_acctbal") / 100.0).alias("rm"))
    src = tables(spark, sf, "nation").where("n_regionkey < 3").select(
        F.col("n_nationkey").cast("long").alias("island_id"), F.col("n_name").alias("source_name"))
    c = view(spark, sf, "v_comp")
    return c.join(pol, "comp_id", "left").join(src, "island_id", "left").select("comp_id", F.round("rm", 6).alias("rm"), "source_name")


_ASOF = """WITH va AS (SELECT cycle, ant1, COUNT(*) AS n_vis FROM v_vis GROUP BY 1, 2)
SELECT v.cycle, v.ant1, v.n_vis, s.cycle AS solution_time, s.g_re, s.g_im
FROM va v ASOF JOIN v_cal s ON v.ant1 = s.ant AND v.cycle >= s.cycle"""


@op("jn5", _ASOF)
def jn5(spark, sf):
    vis = view(spark, sf, "v_vis").groupBy("cycle", "ant1").agg(F.count(F.lit(1)).alias("n_vis"))
    cal = view(spark, sf, "v_cal").withColumnRenamed("ant", "ant1").withColumnRenamed("cycle", "sol")
    return joins.as_of(vis, cal, ["ant1"], "cycle", "sol", 8, ["g_re", "g_im"]).select(
        "cycle", "ant1", "n_vis", "solution_time", "g_re", "g_im")


@op("jn5_latest", """SELECT ant, MAX(cycle) AS cycle, ARG_MAX(g_re, cycle) AS g_re, ARG_MAX(g_im, cycle) AS g_im FROM v_cal GROUP BY ant""")
def jn5_latest(spark, sf):
    return joins.latest(view(spark, sf, "v_cal"), ["ant"], "cycle", ["g_re", "g_im"])


# ---- complex algebra in SQL text, for the checking side only

def _cm(a, b):
    return f"({a[0]} * {b[0]} - {a[1]} * {b[1]})", f"({a[0]} * {b[1]} + {a[1]} * {b[0]})"


def _conj(a):
    return a[0], f"(-{a[1]})"


_CAL_COLS = ("g_re AS g1_re, g_im AS g1_im, g_re * 0.9 AS g2_re, -g_im AS g2_im, "
             "CAST(0.05 AS DOUBLE) * (ant % 3) AS d12_re, CAST(0.01 AS DOUBLE) AS d12_im, CAST(0.02 AS DOUBLE) AS d21_re, CAST(0.03 AS DOUBLE) * (ant % 2) AS d21_im")


def _jones_sql():
    lines = []
    for s in ("1", "2"):
        g1, g2 = (f"s{s}.g1_re", f"s{s}.g1_im"), (f"s{s}.g2_re", f"s{s}.g2_im")
        d12, d21 = (f"s{s}.d12_re", f"s{s}.d12_im"), (f"s{s}.d21_re", f"s{s}.d21_im")
        b = _cm(d12, g1)
        c = _cm(d21, g2)
        for n, z in (("a", g1), ("b", b), ("c", (f"-({c[0]})", f"-({c[1]})")), ("d", g2)):
            lines += [f"{z[0]} AS {n}{s}r", f"{z[1]} AS {n}{s}i"]
    return ", ".join(lines)


def _mueller_inverse_sql():
    """x = inv(J1) V inv(J2)^H with inv by the adjugate, column by column."""
    out = []
    J = {(s, n): (f"{n}{s}r", f"{n}{s}i") for s in "12" for n in "abcd"}
    neg = lambda z: (f"(-{z[0]})", f"(-{z[1]})")
    adj = {s: [[J[s, "d"], neg(J[s, "b"])], [neg(J[s, "c"]), J[s, "a"]]] for s in "12"}
    V = [[("xx_re", "xx_im"), ("xy_re", "xy_im")], [("yx_re", "yx_im"), ("yy_re", "yy_im")]]
    for i, pol in enumerate(("xx", "xy", "yx", "yy")):
        r, c = divmod(i, 2)
        terms = []
        for k in range(2):
            for m in range(2):
                terms.append(_cm(_cm(adj["1"][r][k], V[k][m]), _conj(adj["2"][c][m])))
        out += [f"{' + '.join(t[0] for t in terms)} AS {pol}_nr", f"{' + '.join(t[1] for t in terms)} AS {pol}_ni"]
    d1 = _cm(J["1", "a"], J["1", "d"]), _cm(J["1", "b"], J["1", "c"])
    d2 = _cm(J["2", "a"], J["2", "d"]), _cm(J["2", "b"], J["2", "c"])
    out += [f"{d1[0][0]} - {d1[1][0]} AS e1r", f"{d1[0][1]} - {d1[1][1]} AS e1i",
            f"{d2[0][0]} - {d2[1][0]} AS e2r", f"{d2[0][1]} - {d2[1][1]} AS e2i"]
    return ", ".join(out)


_FULL = f"""WITH c AS (SELECT cycle, ant1, ant2, chan, AVG(CASE WHEN pol = 'XX' THEN re END) AS xx_re, AVG(CASE WHEN pol = 'XX' THEN im END) AS xx_im,
  AVG(CASE WHEN pol = 'XY' THEN re END) AS xy_re, AVG(CASE WHEN pol = 'XY' THEN im END) AS xy_im,
  AVG(CASE WHEN pol = 'YY' THEN re END) AS yy_re, AVG(CASE WHEN pol = 'YY' THEN im END) AS yy_im,
  MAX(CASE WHEN flag THEN 1 ELSE 0 END) = 1 AS flag FROM v_vis GROUP BY 1, 2, 3, 4),
 w AS (SELECT cycle, ant1, ant2, chan, COALESCE(xx_re, 0.0) AS xx_re, COALESCE(xx_im, 0.0) AS xx_im, COALESCE(xy_re, 0.0) AS xy_re,
   COALESCE(xy_im, 0.0) AS xy_im, COALESCE(xy_re, 0.0) AS yx_re, -COALESCE(xy_im, 0.0) AS yx_im, COALESCE(yy_re, 0.0) AS yy_re,
   COALESCE(yy_im, 0.0) AS yy_im, flag FROM c),
 s AS (SELECT ant, cycle, {_CAL_COLS} FROM v_cal),
 j AS (SELECT w.*, s1.g1_re IS NOT NULL AND s2.g1_re IS NOT NULL AS valid, {_jones_sql()} FROM w
   LEFT JOIN s s1 ON s1.ant = w.ant1 AND s1.cycle = w.cycle - w.cycle % 10 LEFT JOIN s s2 ON s2.ant = w.ant2 AND s2.cycle = w.cycle - w.cycle % 10),
 n AS (SELECT *, {_mueller_inverse_sql()} FROM j),
 e AS (SELECT *, e1r * e2r + e1i * e2i AS er, e1i * e2r - e1r * e2i AS ei, NOT valid OR flag AS dr FROM n)
SELECT cycle, ant1, ant2, chan, dr AS flag, """ + ", ".join(
    [rs(f"CASE WHEN dr THEN 0.0 ELSE ({p}_nr * er + {p}_ni * ei) / (er * er + ei * ei) END", f"{p}_re") for p in ("xx", "xy", "yx", "yy")]
    + [rs(f"CASE WHEN dr THEN 0.0 ELSE ({p}_ni * er - {p}_nr * ei) / (er * er + ei * ei) END", f"{p}_im") for p in ("xx", "yy")]) + " FROM e"


def _wide(spark, sf):
    v = view(spark, sf, "v_vis")
    pick = lambda p, c: F.coalesce(F.avg(F.when(F.col("pol") == p, F.col(c))), F.lit(0.0))
    w = v.groupBy("cycle", "ant1", "ant2", "chan").agg(
        *[pick(p.upper(), c).alias(f"{p}_{c}") for p in ("xx", "xy", "yy") for c in ("re", "im")],
        F.bool_or("flag").alias("flag"))
    return w.withColumn("yx_re", F.col("xy_re")).withColumn("yx_im", -F.col("xy_im"))


def _cal_terms(spark, sf):
    c, a = view(spark, sf, "v_cal"), F.col("ant")
    return c.select("ant", F.col("cycle").alias("sol_cycle"), F.col("g_re").alias("g1_re"), F.col("g_im").alias("g1_im"),
                    (F.col("g_re") * 0.9).alias("g2_re"), (-F.col("g_im")).alias("g2_im"),
                    (0.05 * (a % 3)).alias("d12_re"), F.lit(0.01).alias("d12_im"), F.lit(0.02).alias("d21_re"),
                    (0.03 * (a % 2)).alias("d21_im"))


@op("jn3", _FULL)
def jn3(spark, sf):
    w = _wide(spark, sf).withColumn("sol_cycle", F.col("cycle") - F.col("cycle") % 10)
    j = calibrate.join_solutions(w, _cal_terms(spark, sf), ["sol_cycle"])
    out = calibrate.apply_jones(j, F.col("g1_re_1").isNotNull() & F.col("g1_re_2").isNotNull())
    return out.select("cycle", "ant1", "ant2", "chan", "flag", *[r6(f"{p}_re").alias(f"{p}_re") for p in calibrate.POLS],
                      *[r6(f"{p}_im").alias(f"{p}_im") for p in ("xx", "yy")])


_G12 = ("g1.g_re * g2.g_re + g1.g_im * g2.g_im", "g1.g_im * g2.g_re - g1.g_re * g2.g_im")


@op("jn3_parallel", f"""WITH g AS (SELECT ant, MAX(g_re) AS g_re, MAX(g_im) AS g_im FROM v_cal GROUP BY ant),
 j AS (SELECT v.*, {_G12[0]} AS gr, {_G12[1]} AS gi FROM v_cell v JOIN g g1 ON g1.ant = v.ant1 JOIN g g2 ON g2.ant = v.ant2)
SELECT scan, ant1, ant2, beam, pol, chan, {rs('(re * gr + im * gi) / (gr * gr + gi * gi)', 're')}, {rs('(im * gr - re * gi) / (gr * gr + gi * gi)', 'im')} FROM j""")
def jn3_parallel(spark, sf):
    g = view(spark, sf, "v_cal").groupBy("ant").agg(F.max("g_re").alias("g_re"), F.max("g_im").alias("g_im"))
    v = calibrate.join_solutions(view(spark, sf, "v_cell"), g, [])
    v = v.where("g_re_1 IS NOT NULL AND g_re_2 IS NOT NULL")
    out = calibrate.apply_parallel(v, Cx.of("g_re_1", "g_im_1"), Cx.of("g_re_2", "g_im_2"))
    return out.select("scan", "ant1", "ant2", "beam", "pol", "chan", r6("re").alias("re"), r6("im").alias("im"))


@op("jn15", """WITH @grid SELECT scan, ant1, ant2, beam, pol, chan, flag, ROUND(re, 6) + CAST(0.0 AS DOUBLE) AS re FROM v_grid
UNION ALL SELECT scan, ant1, ant2, beam, pol, chan + 54 AS chan, flag, ROUND(re * 2.0, 6) + CAST(0.0 AS DOUBLE) AS re FROM v_grid""")
def jn15(spark, sf):
    keys = ["scan", "ant1", "ant2", "beam", "pol"]
    a = spectra(spark, sf)
    b = a.withColumn("re", F.transform("re", lambda x: x * 2.0))
    m = average.merge_spectra([a, b], keys, ["re", "im", "flag"])
    e = average.explode_spectra(m, keys, ("re", "flag"))
    return e.select(*keys, "chan", "flag", r6("re").alias("re"))


_MODEL = """WITH comps AS (SELECT comp_id, comp_id % 3 AS field, SIN(RADIANS(ra_deg / 400.0)) AS l, SIN(RADIANS(dec_deg / 200.0)) AS m, flux_peak AS flux FROM v_comp),
 rows0 AS (SELECT cycle, field, ant1, ant2, MIN(u) AS u, MIN(v) AS v, MIN(w) AS w, AVG(re) AS re, AVG(im) AS im, 8.88e8 + 1.0e6 * (cycle % 5) AS freq
   FROM v_vis GROUP BY 1, 2, 3, 4),
 pr AS (SELECT r.cycle, r.field, r.ant1, r.ant2, ANY_VALUE(r.re) AS re, ANY_VALUE(r.im) AS im,
   SUM(flux / SQRT(1 - l*l - m*m) * COS(2 * PI() * freq * (l * u + m * v + (SQRT(1 - l*l - m*m) - 1) * w) / 299792458.0)) AS mr,
   SUM(flux / SQRT(1 - l*l - m*m) * SIN(2 * PI() * freq * (l * u + m * v + (SQRT(1 - l*l - m*m) - 1) * w) / 299792458.0)) AS mi
   FROM rows0 r JOIN comps c ON c.field = r.field GROUP BY 1, 2, 3, 4) """


def _predicted(spark, sf):
    c = view(spark, sf, "v_comp").select(
        "comp_id", (F.col("comp_id") % 3).alias("field"), F.sin(F.radians(F.col("ra_deg") / 400.0)).alias("l"),
        F.sin(F.radians(F.col("dec_deg") / 200.0)).alias("m"), F.col("flux_peak").alias("flux"))
    rows = view(spark, sf, "v_vis").groupBy("cycle", "field", "ant1", "ant2").agg(
        F.min("u").alias("u"), F.min("v").alias("v"), F.min("w").alias("w"), F.avg("re").alias("re"), F.avg("im").alias("im"))
    rows = rows.withColumn("freq", 8.88e8 + 1.0e6 * (F.col("cycle") % 5))
    return predict.predict(rows, predict.pack_components(c, "field"), ["cycle", "field", "ant1", "ant2"], "field", "freq")


@op("jn16", _MODEL + f"SELECT cycle, field, ant1, ant2, {rs('mr', 'model_re', 4)}, {rs('mi', 'model_im', 4)} FROM pr")
def jn16(spark, sf):
    return _predicted(spark, sf).select("cycle", "field", "ant1", "ant2", r6("model_re", 4).alias("model_re"), r6("model_im", 4).alias("model_im"))


@op("jn17", _MODEL + f"SELECT cycle, field, ant1, ant2, {rs('re - mr', 're', 4)}, {rs('im - mi', 'im', 4)} FROM pr")
def jn17(spark, sf):
    out = predict.subtract_model(_predicted(spark, sf))
    return out.select("cycle", "field", "ant1", "ant2", r6("re", 4).alias("re"), r6("im", 4).alias("im"))


_GAIN_NAMES = """WITH g AS (SELECT 'gain.g11.' || ant || '.' || cycle AS name, g_re AS re, g_im AS im FROM v_cal WHERE ant < 4
  UNION ALL SELECT 'gain.g22.' || ant || '.' || cycle AS name, g_re AS re, -g_im AS im FROM v_cal WHERE ant < 4),
 h AS (SELECT 'gain.g11.' || ant || '.' || cycle AS name, g_re * 1.1 AS re, g_im + 0.05 AS im FROM v_cal WHERE ant > 1) """


def _gain_sets(spark, sf):
    c = view(spark, sf, "v_cal")
    name = lambda t: F.concat_ws(".", F.lit(f"gain.{t}"), F.col("ant"), F.col("cycle")).alias("name")
    low = c.where("ant < 4")
    a = low.select(name("g11"), F.col("g_re").alias("re"), F.col("g_im").alias("im")).unionByName(
        low.select(name("g22"), F.col("g_re").alias("re"), (-F.col("g_im")).alias("im")))
    b = c.where("ant > 1").select(name("g11"), (F.col("g_re") * 1.1).alias("re"), (F.col("g_im") + 0.05).alias("im"))
    return a, b


@op("jn19", _GAIN_NAMES + f"""SELECT g.name, {rs('SQRT(POWER(g.re * h.re + g.im * h.im, 2) + POWER(g.im * h.re - g.re * h.im, 2))', 'amp')},
 {rs('ATAN2(g.im * h.re - g.re * h.im, g.re * h.re + g.im * h.im)', 'phase')} FROM g JOIN h ON g.name = h.name WHERE g.name LIKE '%g11%'""")
def jn19(spark, sf):
    return calibrate.compare_gains(*_gain_sets(spark, sf)).select("name", r6("amp").alias("amp"), r6("phase").alias("phase"))


@op("set2", _GAIN_NAMES + "SELECT name FROM g UNION SELECT name FROM h")
def set2(spark, sf):
    a, b = _gain_sets(spark, sf)
    return a.select("name").union(b.select("name")).distinct()


@op("jn20", """WITH m AS (SELECT DISTINCT p_partkey % 6 AS ant1, p_size % 6 AS ant2, CASE WHEN p_partkey % 2 = 0 THEN 'XX' ELSE 'YY' END AS pol FROM part)
SELECT m.ant1 * 100 + m.ant2 * 10 + CASE WHEN m.pol = 'XX' THEN 0 ELSE 1 END AS baseline_id, COUNT(*) AS n_vis FROM v_vis v
JOIN m ON v.ant1 = m.ant1 AND v.ant2 = m.ant2 AND v.pol = m.pol GROUP BY 1""")
def jn20(spark, sf):
    p = tables(spark, sf, "part")
    pol = F.when(F.col("p_partkey") % 2 == 0, "XX").otherwise("YY")
    m = p.select((F.col("p_partkey") % 6).alias("ant1"), (F.col("p_size") % 6).cast("long").alias("ant2"), pol.alias("pol")).distinct()
    m = m.withColumn("baseline_id", F.col("ant1") * 100 + F.col("ant2") * 10 + F.when(F.col("pol") == "XX", 0).otherwise(1))
    return view(spark, sf, "v_vis").join(m, ["ant1", "ant2", "pol"]).groupBy("baseline_id").agg(F.count(F.lit(1)).alias("n_vis"))


_SUMS = """x AS (SELECT *, 1.0 + 0.1 * chan AS mr, 0.2 * beam AS mi, 1.0 / (sigma * sigma) AS wt, ant1 <> ant2 AND NOT flag AS used FROM v_vis)
SELECT {k}, """ + ", ".join([
    rs("SUM(CASE WHEN used THEN wt * (mr * re + mi * im) ELSE 0.0 END)", "xr", 4),
    rs("SUM(CASE WHEN used THEN wt * (mr * im - mi * re) ELSE 0.0 END)", "xi", 4),
    rs("SUM(CASE WHEN used THEN wt * (mr * mr + mi * mi) ELSE 0.0 END)", "mm", 4)]) + """,
 CAST(SUM(CASE WHEN used THEN 1 ELSE 0 END) AS BIGINT) AS n_used, CAST(SUM(CASE WHEN ant1 <> ant2 AND flag THEN 1 ELSE 0 END) AS BIGINT) AS n_flagged,
 CAST(SUM(CASE WHEN ant1 = ant2 THEN 1 ELSE 0 END) AS BIGINT) AS n_auto FROM x GROUP BY {k}"""


def _with_model(spark, sf):
    return view(spark, sf, "v_vis").withColumn("model_re", 1.0 + 0.1 * F.col("chan")).withColumn("model_im", 0.2 * F.col("beam"))


@op("agg19", "WITH " + _SUMS.format(k="ant1, ant2, beam, chan"))
def agg19(spark, sf):
    s = calibrate.pre_average(_with_model(spark, sf), ["ant1", "ant2", "beam", "chan"])
    return s.select("ant1", "ant2", "beam", "chan", *[r6(c, 4).alias(c) for c in ("xr", "xi", "mm")], "n_used", "n_flagged", "n_auto")


def _truth(spark, sf):
    """Measured = model times known gains, so that a solve must give the gains back."""
    a = lambda c: Cx(1.0 + 0.05 * F.col(c), 0.1 * F.col(c))
    v = _with_model(spark, sf)
    z = Cx.of("model_re", "model_im") * a("ant1") * a("ant2").conj()
    return v.withColumn("re", z.re).withColumn("im", z.im)


#: The gains that ``_truth`` puts on the data: antenna 0 has phase zero, so a solve referred to it returns them as they are.
_GAINS = """WITH u AS (SELECT *, cycle // 8 AS interval FROM v_vis WHERE ant1 <> ant2 AND NOT flag),
 a AS (SELECT {k}, ant1 AS ant FROM u UNION SELECT {k}, ant2 FROM u)
SELECT {k}, ant, ROUND(1.0 + 0.05 * ant, 4)::DOUBLE AS g_re, ROUND(0.1 * ant, 4)::DOUBLE AS g_im, TRUE AS converged FROM a"""


def _gains(solved, *keys):
    return solved.select(*keys, "ant", r6("g_re", 4).alias("g_re"), r6("g_im", 4).alias("g_im"), "converged")


def _per_interval(v):
    return calibrate.pre_average(v.withColumn("interval", F.floor(F.col("cycle") / F.lit(8))), ["ant1", "ant2", "interval", "beam"])


@op("cal1", _GAINS.format(k="beam, chan"))
def cal1(spark, sf):
    """Bandpass: one solve per (beam, channel) from pre-averaged sums."""
    sums = calibrate.pre_average(_truth(spark, sf), ["ant1", "ant2", "beam", "chan"])
    return _gains(calibrate.solve_groups(sums, ["beam", "chan"]), "beam", "chan")


@op("cal2", _GAINS.format(k="interval, beam"))
def cal2(spark, sf):
    """Gains per solution interval of eight cycles and beam."""
    return _gains(calibrate.solve_groups(_per_interval(_truth(spark, sf)), ["interval", "beam"]), "interval", "beam")


@op("cal3", f"""WITH r AS (SELECT * FROM v_cal WHERE ant = 2)
SELECT c.ant, c.cycle, {rs('(c.g_re * r.g_re + c.g_im * r.g_im) / SQRT(r.g_re * r.g_re + r.g_im * r.g_im)', 'g_re')},
 {rs('(c.g_im * r.g_re - c.g_re * r.g_im) / SQRT(r.g_re * r.g_re + r.g_im * r.g_im)', 'g_im')} FROM v_cal c LEFT JOIN r ON r.cycle = c.cycle""")
def cal3(spark, sf):
    """Cycles without the reference antenna have no referenced gains; with ``strict`` they are an error."""
    out = calibrate.phase_reference(view(spark, sf, "v_cal"), ["cycle"], 2, strict=False)
    return out.select("ant", "cycle", r6("g_re").alias("g_re"), r6("g_im").alias("g_im"))


@op("cal4", """WITH a AS (SELECT ant, cycle, g_re, g_im, cycle AS solution_id FROM v_cal WHERE cycle <= 40
 UNION ALL SELECT ant, cycle, g_re, g_im, cycle AS solution_id FROM v_cal WHERE cycle > 40)
SELECT solution_id, COUNT(*) AS n_terms, solution_id = (SELECT MAX(solution_id) FROM a) AS is_latest FROM a GROUP BY 1""")
def cal4(spark, sf):
    c = view(spark, sf, "v_cal")
    table = c.where("cycle <= 40").withColumn("solution_id", F.col("cycle"))
    t = calibrate.add_solution(table, c.where("cycle > 40"), "cycle")
    newest = t.agg(F.max("solution_id").alias("m")).scalar()
    return t.groupBy("solution_id").agg(F.count(F.lit(1)).alias("n_terms")).withColumn("is_latest", F.col("solution_id") == newest)


@op("cal5", f"""SELECT ant, cycle, g_re, g_im FROM v_cal WHERE NOT (ant % 2 = 0 AND cycle < 30)
UNION ALL SELECT ant, cycle, {rs('g_re * 2.0', 'g_re')}, g_im FROM v_cal WHERE ant % 2 = 0 AND cycle < 30""")
def cal5(spark, sf):
    c = view(spark, sf, "v_cal")
    change = c.where("ant % 2 = 0 AND cycle < 30").withColumn("g_re", r6(F.col("g_re") * 2.0))
    return calibrate.adjust_solution(c, change, ["ant", "cycle"]).select("ant", "cycle", "g_re", "g_im")


_FIT = """WITH p0 AS (SELECT ant1 AS ant, cycle, ATAN2(SUM(im), SUM(re)) AS ph FROM v_vis WHERE ant1 <> ant2 GROUP BY 1, 2),
 d AS (SELECT *, ph - COALESCE(LAG(ph) OVER (PARTITION BY ant ORDER BY cycle), ph) AS j FROM p0),
 un AS (SELECT ant, cycle, ph + 2 * PI() * SUM(CASE WHEN j > 1.5 * PI() THEN -1 WHEN j < -1.5 * PI() THEN 1 ELSE 0 END)
    OVER (PARTITION BY ant ORDER BY cycle) AS y, (cycle - 32) * 0.05 AS h FROM d) """


@op("cal6", _FIT + f""", t AS (SELECT ant, COUNT(*) AS n, SUM(SIN(h)) AS s, SUM(COS(h)) AS c, SUM(SIN(h)*SIN(h)) AS ss, SUM(SIN(h)*COS(h)) AS sc, SUM(COS(h)*COS(h)) AS cc,
   SUM(y) AS y, SUM(y*SIN(h)) AS ys, SUM(y*COS(h)) AS yc FROM un GROUP BY ant),
 e AS (SELECT *, n*(ss*cc-sc*sc) - s*(s*cc-sc*c) + c*(s*sc-ss*c) AS dt FROM t)
SELECT ant, n, {rs('(y*(ss*cc-sc*sc) - s*(ys*cc-sc*yc) + c*(ys*sc-ss*yc))/dt', 'a', 4)}, {rs('(n*(ys*cc-sc*yc) - y*(s*cc-sc*c) + c*(s*yc-ys*c))/dt', 'b', 4)},
 {rs('(n*(ss*yc-ys*sc) - s*(s*yc-ys*c) + y*(s*sc-ss*c))/dt', 'c_fit', 4)} FROM e""")
def cal6(spark, sf):
    p = (view(spark, sf, "v_vis").where("ant1 <> ant2").groupBy(F.col("ant1").alias("ant"), "cycle")
         .agg(F.atan2(F.sum("im"), F.sum("re")).alias("ph")))
    import math
    un = calibrate.unwrap_along(p, ["ant"], "cycle", F.floor(F.col("cycle") / F.lit(1024)), "ph", 1.5 * math.pi)
    fit = calibrate.fit_sinusoid(un.withColumn("h", (F.col("cycle") - 32) * 0.05), ["ant"], "h", "unwrapped")
    return fit.select("ant", "n", r6("a", 4).alias("a"), r6("b", 4).alias("b"), r6("c_fit", 4).alias("c_fit"))


_GRID = """WITH s AS (SELECT *, (8.88e8 + chan * 1.0e6) / (299792458.0 * 9.0) AS sc, 1.0 / (sigma * sigma) AS wt FROM v_vis WHERE NOT flag),
 c AS (SELECT pol, CAST(FLOOR(u * sc + 0.5) AS BIGINT) + 16 AS iu, CAST(FLOOR(v * sc + 0.5) AS BIGINT) + 16 AS iv, re, im, wt FROM s) """


def _grid_samples(spark, sf):
    return view(spark, sf, "v_vis").withColumn("freq", 8.88e8 + F.col("chan") * 1.0e6)


@op("agg18", _GRID + f"""SELECT pol, iu, iv, {rs('SUM(re * wt)', 'g_re', 4)}, {rs('SUM(im * wt)', 'g_im', 4)}, {rs('SUM(wt)', 'g_wt', 4)}, COUNT(*) AS n
FROM c WHERE iu BETWEEN 0 AND 31 AND iv BETWEEN 0 AND 31 GROUP BY 1, 2, 3""")
def agg18(spark, sf):
    g = predict.grid_box(_grid_samples(spark, sf), 9.0, 32, "freq")
    return g.select("pol", "iu", "iv", *[r6(c, 4).alias(c) for c in ("g_re", "g_im", "g_wt")], "n")


@op("agg18_kernel", _GRID + f""", k AS (SELECT du, dv FROM (SELECT UNNEST(RANGE(-1, 2)) AS du) CROSS JOIN (SELECT UNNEST(RANGE(-1, 2)) AS dv))
SELECT pol, iu + du AS iu, iv + dv AS iv, {rs('SUM(re * wt) / 9.0', 'g_re', 4)}, {rs('SUM(im * wt) / 9.0', 'g_im', 4)}, {rs('SUM(wt) / 9.0', 'g_wt', 4)}
FROM c CROSS JOIN k WHERE iu BETWEEN 1 AND 30 AND iv BETWEEN 1 AND 30 GROUP BY 1, 2, 3""")
def agg18_kernel(spark, sf):
    g = predict.grid_kernel(_grid_samples(spark, sf), predict.box_kernel(spark, 1), 9.0, 32, 1, "freq")
    return g.select("pol", "iu", "iv", *[r6(c, 4).alias(c) for c in ("g_re", "g_im", "g_wt")])


@op("src6", """SELECT 'gain.g11.' || ant || '.' || cycle || ' = [' || PRINTF('%.6f', g_re) || ', ' || PRINTF('%.6f', g_im) || ']' AS line FROM v_cal WHERE ant <> 3
UNION ALL SELECT 'gain.g22.' || ant || '.' || cycle || ' = [' || PRINTF('%.6f', g_re * 0.5) || ', ' || PRINTF('%.6f', g_im) || ']' AS line FROM v_cal WHERE cycle % 4 <> 0""")
def src6(spark, sf):
    c = view(spark, sf, "v_cal").select(
        "ant", F.col("cycle").alias("beam"), F.col("g_re").alias("g1_re"), F.col("g_im").alias("g1_im"),
        (F.col("g_re") * 0.5).alias("g2_re"), F.col("g_im").alias("g2_im"),
        (F.col("ant") != 3).alias("g1_valid"), (F.col("cycle") % 4 != 0).alias("g2_valid"))
    return caltext.gain_lines(c).select("line")


@op("src6_bandpass", """SELECT 'bandpass.g11.' || ant || '.0 = [' || STRING_AGG('[' || PRINTF('%.6f', g_re) || ', ' || PRINTF('%.6f', g_im) || ']', ', ' ORDER BY cycle) || ']' AS line
FROM v_cal GROUP BY ant""")
def src6_bandpass(spark, sf):
    c = view(spark, sf, "v_cal").select("ant", F.lit(0).cast("long").alias("beam"), F.col("cycle").alias("chan"), "g_re", "g_im")
    return caltext.bandpass_lines(c, "g11").select("line")


@op("src7", "SELECT 'g11' AS term, ant, cycle AS beam, g_re AS re, g_im AS im FROM v_cal")
def src7(spark, sf):
    c = view(spark, sf, "v_cal").select(
        "ant", F.col("cycle").alias("beam"), F.col("g_re").alias("g1_re"), F.col("g_im").alias("g1_im"),
        F.lit(0.0).alias("g2_re"), F.lit(0.0).alias("g2_im"), F.lit(True).alias("g1_valid"), F.lit(False).alias("g2_valid"))
    return caltext.parse_lines(caltext.gain_lines(c).select(F.col("line").alias("value"))).select("term", "ant", "beam", "re", "im")


_FLAG_DECAY = f"""WITH @grid, ga AS (SELECT *, SQRT(re * re + im * im) AS amp FROM v_grid WHERE ant1 <> ant2),
 g AS (SELECT * FROM ga WHERE NOT flag),
 rk AS (SELECT scan, ant1, ant2, beam, pol, amp AS x, ROW_NUMBER() OVER (PARTITION BY scan, ant1, ant2, beam, pol ORDER BY amp) - 1 AS i,
   COUNT(*) OVER (PARTITION BY scan, ant1, ant2, beam, pol) AS n FROM g),
 st AS (SELECT scan, ant1, ant2, beam, pol, MAX(CASE WHEN i = n // 2 THEN x END) AS m,
   (MAX(CASE WHEN i = (3 * n) // 4 THEN x END) - MAX(CASE WHEN i = n // 4 THEN x END)) / CAST(1.34896 AS DOUBLE) AS s FROM rk GROUP BY 1, 2, 3, 4, 5),
 c AS (SELECT ga.*, ga.flag OR COALESCE(amp < m - 3.0 * s OR amp > m + 3.0 * s, FALSE) AS nf FROM ga LEFT JOIN st USING (scan, ant1, ant2, beam, pol)),
 b AS (SELECT scan, ant1, ant2, beam, pol, chan // 6 AS block, AVG(CASE WHEN NOT nf THEN re END) AS re, AVG(CASE WHEN NOT nf THEN im END) AS im FROM c GROUP BY 1, 2, 3, 4, 5, 6),
 gn AS (SELECT ant, MAX(g_re) AS g_re, MAX(g_im) AS g_im FROM v_cal GROUP BY ant),
 j AS (SELECT b.*, {_G12[0]} AS gr, {_G12[1]} AS gi FROM b JOIN gn g1 ON g1.ant = b.ant1 JOIN gn g2 ON g2.ant = b.ant2 WHERE b.re IS NOT NULL)
SELECT ant1, ant2, beam, block, {rs('AVG((re * gr + im * gi) / (gr * gr + gi * gi))', 're')}, {rs('AVG((im * gr - re * gi) / (gr * gr + gi * gi))', 'im')}, COUNT(*) AS n
FROM j GROUP BY 1, 2, 3, 4"""


@op("flagship", _FLAG_DECAY)
def flagship(spark, sf):
    """Which channels survive robust clipping, and the averaged, calibrated spectrum per baseline and beam."""
    s = spectra(spark, sf).where("ant1 <> ant2")
    s = average.average_channels(flag.clip_auto(s, 3.0), 6)
    e = average.explode_spectra(s, ["ant1", "ant2", "beam", "pol"]).where("NOT flag")
    g = view(spark, sf, "v_cal").groupBy("ant").agg(F.max("g_re").alias("g_re"), F.max("g_im").alias("g_im"))
    v = calibrate.join_solutions(e, g, []).where("g_re_1 IS NOT NULL AND g_re_2 IS NOT NULL")
    v = calibrate.apply_parallel(v, Cx.of("g_re_1", "g_im_1"), Cx.of("g_re_2", "g_im_2"))
    return v.groupBy("ant1", "ant2", "beam", F.col("chan").alias("block")).agg(
        r6(F.avg("re")).alias("re"), r6(F.avg("im")).alias("im"), F.count(F.lit(1)).alias("n"))
