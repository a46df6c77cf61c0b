"""Catalogue matching queries with their checking SQL."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..operators import match
from ..views import view
from .calibration_queries import rs
from .registry import op, r6

EPS = 0.0015  # between the offsets 0.001 and 0.002 deg of the reference view


def points(spark, sf):
    s = view(spark, sf, "v_comp").select(F.col("comp_id").alias("id"), F.round("ra_deg", 6).alias("x"),
                                         F.round("dec_deg", 6).alias("y"), F.round("flux_peak", 6).alias("flux"))
    r = view(spark, sf, "v_ref").select(F.col("ref_id").alias("id"), F.round("ra_deg", 6).alias("x"),
                                        F.round("dec_deg", 6).alias("y"), F.round("flux_peak", 6).alias("flux"))
    return s, r


_P = """src AS (SELECT comp_id AS id, ROUND(ra_deg, 6) AS x, ROUND(dec_deg, 6) AS y, ROUND(flux_peak, 6) AS flux FROM v_comp),
 ref AS (SELECT ref_id AS id, ROUND(ra_deg, 6) AS x, ROUND(dec_deg, 6) AS y, ROUND(flux_peak, 6) AS flux FROM v_ref)"""
_M = _P + f""", pr AS (SELECT s.id AS src_id, r.id AS ref_id, s.x AS sx, s.y AS sy, s.flux AS sf, r.x AS rx, r.y AS ry, r.flux AS rf
  FROM src s JOIN ref r ON ABS(s.x - r.x) < {EPS} AND ABS(s.y - r.y) < {EPS} AND SQRT(POWER(s.x - r.x, 2) + POWER(s.y - r.y, 2)) < {EPS})"""


# In these tables a source has at most one reference within reach and a reference
# at most one source, so the greedy result is the set of all close pairs.
@op("jn6", f"WITH {_M} SELECT src_id, ref_id FROM pr")
def jn6(spark, sf):
    s, r = points(spark, sf)
    return match.greedy_match(s, r, EPS)


@op("jn6_crowded")
def jn6_crowded(spark, sf):
    """Many sources and references per neighbourhood: the sky folded to a patch, so the order matters.

    The sequential rule has no fast SQL; it is tested against a plain loop.
    """
    s, r = points(spark, sf)
    fold = lambda d: d.withColumn("x", F.round(F.col("x") % 4, 6)).withColumn("y", F.round(F.col("y") % 4, 6))
    return match.greedy_match(fold(s), fold(r), 0.011)


_NEAR = _P + """, un AS (SELECT * FROM src),
 c AS (SELECT s.id AS src_id, r.id AS ref_id, SQRT(POWER(s.x + 0.0005 - r.x, 2) + POWER(s.y - r.y, 2)) AS sep, s.flux AS src_flux, r.flux AS ref_flux
   FROM un s JOIN ref r ON ABS(s.x + 0.0005 - r.x) < 0.0045 AND ABS(s.y - r.y) < 0.0045),
 n AS (SELECT *, ROW_NUMBER() OVER (PARTITION BY src_id ORDER BY sep, ref_id) AS k FROM c WHERE sep < 0.0045)"""

_AFTER = _M + _NEAR[len(_P):].replace("SELECT * FROM src)", "SELECT * FROM src WHERE id NOT IN (SELECT src_id FROM pr))")


def _nearest(spark, sf):
    s, r = points(spark, sf)
    return match.nearest_match(s, r, 3 * EPS, -0.0005, 0.0), s, r


@op("jn7", f"WITH {_NEAR} SELECT src_id, ref_id, {rs('sep', 'sep')} FROM n WHERE k = 1")
def jn7(spark, sf):
    m, _, _ = _nearest(spark, sf)
    return m.select("src_id", "ref_id", r6("sep").alias("sep"))


@op("jn7_unmatched", f"WITH {_AFTER} SELECT src_id, ref_id, {rs('sep', 'sep')} FROM n WHERE k = 1")
def jn7_unmatched(spark, sf):
    """Only the sources that the first, greedy match left over."""
    s, r = points(spark, sf)
    free = s.join(match.greedy_match(s, r, EPS).select(F.col("src_id").alias("id")), "id", "left_anti")
    return match.nearest_match(free, r, 3 * EPS, -0.0005, 0.0).select("src_id", "ref_id", r6("sep").alias("sep"))


@op("jn8", f"""WITH {_P}, pr AS (SELECT s.id AS src_id, s.id % 50 AS ref_id, s.flux AS src_flux, CAST(s.id % 50 AS DOUBLE) / 5.0 AS ref_flux FROM src s),
 k AS (SELECT *, ROW_NUMBER() OVER (PARTITION BY ref_id ORDER BY ABS(src_flux - ref_flux), src_id DESC) AS n FROM pr)
SELECT src_id, ref_id, {rs('src_flux', 'src_flux')} FROM k WHERE n = 1""")
def jn8(spark, sf):
    s, _ = points(spark, sf)
    pr = s.select(F.col("id").alias("src_id"), (F.col("id") % 50).alias("ref_id"), F.col("flux").alias("src_flux"),
                  ((F.col("id") % 50).cast("double") / 5.0).alias("ref_flux"))
    return match.reject_multiple(pr, "src_id").select("src_id", "ref_id", r6("src_flux").alias("src_flux"))


TOP = 18
TRI_EPS = 0.02


def _tri_sql(name, source):
    def side(u, v):
        return f"SQRT(POWER({v}.x - {u}.x, 2) + POWER({v}.y - {u}.y, 2))"
    return f"""{name}_top AS (SELECT * FROM {source} ORDER BY flux DESC, id LIMIT {TOP}),
 {name}_raw AS (SELECT a.id AS ia, b.id AS ib, c.id AS ic, {side('a', 'b')} AS lab, {side('b', 'c')} AS lbc, {side('c', 'a')} AS lca,
   b.x - a.x AS abx, b.y - a.y AS aby, c.x - b.x AS bcx, c.y - b.y AS bcy, a.x - c.x AS cax, a.y - c.y AS cay
   FROM {name}_top a JOIN {name}_top b ON a.id < b.id JOIN {name}_top c ON b.id < c.id),
 {name}_o AS (SELECT *, LEAST(lab, lbc, lca) AS r2, GREATEST(lab, lbc, lca) AS r3,
   CASE WHEN lab <= lbc AND lab <= lca THEN 0 WHEN lbc <= lca THEN 1 ELSE 2 END AS s2,
   CASE WHEN lca >= lab AND lca >= lbc THEN 2 WHEN lbc >= lab THEN 1 ELSE 0 END AS s3 FROM {name}_raw),
 {name}_v AS (SELECT *, CASE s2 WHEN 0 THEN abx WHEN 1 THEN bcx ELSE cax END AS x2, CASE s2 WHEN 0 THEN aby WHEN 1 THEN bcy ELSE cay END AS y2,
   CASE s3 WHEN 0 THEN abx WHEN 1 THEN bcx ELSE cax END AS x3, CASE s3 WHEN 0 THEN aby WHEN 1 THEN bcy ELSE cay END AS y3,
   CASE WHEN s2 + s3 = 1 THEN ib WHEN s2 + s3 = 3 THEN ic ELSE ia END AS a,
   CASE WHEN s2 = 0 THEN CASE WHEN s3 = 1 THEN ia ELSE ib END WHEN s2 = 1 THEN CASE WHEN s3 = 0 THEN ic ELSE ib END
        ELSE CASE WHEN s3 = 0 THEN ic ELSE ia END END AS b,
   CASE WHEN s3 = 0 THEN CASE WHEN s2 = 1 THEN ia ELSE ib END WHEN s3 = 1 THEN CASE WHEN s2 = 0 THEN ic ELSE ib END
        ELSE CASE WHEN s2 = 0 THEN ic ELSE ia END END AS c FROM {name}_o WHERE r2 > 0),
 {name} AS (SELECT a, b, c, r3 / r2 AS ratio, (x3*x2 + y3*y2) / (r3*r2) AS angle, LOG10(lab + lbc + lca) AS lp,
   (y2*x3 - y3*x2) / (x2*x3 + y2*y3) > 0 AS cw,
   1/(r3*r3) - ((x3*x2 + y3*y2) / (r3*r2)) / (r3*r2) + 1/(r2*r2) AS f FROM {name}_v WHERE r3 / r2 < 10),
 {name}_t AS (SELECT *, 2 * ratio * ratio * {TRI_EPS * TRI_EPS} * f AS rt,
   2 * (1 - angle*angle) * {TRI_EPS * TRI_EPS} * f + 3 * angle*angle * {TRI_EPS ** 4} * f * f AS at FROM {name})"""


_TRI = f"""WITH {_P}, {_tri_sql('ts', 'src')}, {_tri_sql('tr', 'ref')},
 tm AS (SELECT s.a AS s_a, s.b AS s_b, s.c AS s_c, r.a AS r_a, r.b AS r_b, r.c AS r_c, s.lp - r.lp AS mag, s.cw = r.cw AS same
   FROM ts_t s JOIN tr_t r ON POWER(s.ratio - r.ratio, 2) < s.rt + r.rt AND POWER(s.angle - r.angle, 2) < s.at + r.at)"""


def _tri(spark, sf):
    s, r = points(spark, sf)
    return match.match_triangles(match.triangles(s, TOP, TRI_EPS), match.triangles(r, TOP, TRI_EPS))


@op("jn10", _TRI + " SELECT s_a, s_b, s_c, r_a, r_b, r_c, same FROM tm")
def jn10(spark, sf):
    m = _tri(spark, sf)
    return m.select(*[f"{x}_{v}" for x in "sr" for v in "abc"], (F.col("s_clockwise") == F.col("r_clockwise")).alias("same"))


@op("jn11")
def jn11(spark, sf):
    return match.trim_triangles(_tri(spark, sf)).select(*[f"{x}_{v}" for x in "sr" for v in "abc"])


@op("jn12", _TRI + """, b AS (SELECT src_id, ref_id, COUNT(*) AS votes FROM (SELECT s_a AS src_id, r_a AS ref_id FROM tm
  UNION ALL SELECT s_b, r_b FROM tm UNION ALL SELECT s_c, r_c FROM tm) GROUP BY 1, 2),
 o AS (SELECT *, ROW_NUMBER() OVER (ORDER BY votes DESC, src_id, ref_id) AS k, LAG(votes) OVER (ORDER BY votes DESC, src_id, ref_id) AS pv,
   ROW_NUMBER() OVER (PARTITION BY src_id ORDER BY votes DESC, ref_id) AS rep FROM b)
SELECT src_id, ref_id, votes FROM o WHERE k < COALESCE((SELECT MIN(k) FROM o WHERE rep > 1 OR votes < 0.5 * pv), 1000000000)
 AND (SELECT MAX(votes) FROM b) > 1""")
def jn12(spark, sf):
    return match.vote(_tri(spark, sf))


@op("jn12_trimmed")
def jn12_trimmed(spark, sf):
    """Votes of the triangles that trimming leaves."""
    return match.vote(match.trim_triangles(_tri(spark, sf)))


@op("jn13", f"WITH {_M} SELECT ref_id AS id, COUNT(*) AS n_src FROM pr GROUP BY 1")
def jn13(spark, sf):
    s, r = points(spark, sf)
    return match.crude_match(r, s, EPS).select("id", "n_src")


@op("jn14", f"""WITH {_M}, m AS (SELECT src_id, ref_id FROM pr)
SELECT 'S' AS side, id FROM src WHERE id NOT IN (SELECT src_id FROM m) UNION ALL SELECT 'R' AS side, id FROM ref WHERE id NOT IN (SELECT ref_id FROM m)""")
def jn14(spark, sf):
    s, r = points(spark, sf)
    return match.unmatched(match.greedy_match(s, r, EPS), s, r)


def _id_pairs(spark, sf):
    """The greedy match of the two catalogues, with the points of both sides."""
    s, r = points(spark, sf)
    return match.with_points(match.greedy_match(s, r, EPS), s, r), s, r


_IDP = f"WITH {_M}, m AS (SELECT src_id AS id, ref_id, sx, sy, sf, rx, ry, rf FROM pr)"


@op("agg25", _IDP + f""" SELECT {rs('AVG(sx - rx)', 'mean_dx')}, {rs('AVG(sy - ry)', 'mean_dy')}, {rs('STDDEV_SAMP(sx - rx)', 'rms_dx')},
 {rs('STDDEV_SAMP(sy - ry)', 'rms_dy')}, COUNT(*) AS n FROM m""")
def agg25(spark, sf):
    o = match.offsets(_id_pairs(spark, sf)[0])
    return o.select(*[r6(c).alias(c) for c in ("mean_dx", "mean_dy", "rms_dx", "rms_dy")], "n")


@op("agg26", _IDP + """, b AS (SELECT CAST(FLOOR(sf) AS BIGINT) AS fbin, CAST(FLOOR(sy / 20.0) AS BIGINT) AS dbin, 1 AS m, 0 AS s, 0 AS r FROM m
  UNION ALL SELECT CAST(FLOOR(flux) AS BIGINT), CAST(FLOOR(y / 20.0) AS BIGINT), 0, 1, 0 FROM src WHERE id NOT IN (SELECT id FROM m)
  UNION ALL SELECT CAST(FLOOR(flux) AS BIGINT), CAST(FLOOR(y / 20.0) AS BIGINT), 0, 0, 1 FROM ref WHERE id NOT IN (SELECT ref_id FROM m)),
 g AS (SELECT fbin, dbin, CAST(SUM(m) AS BIGINT) AS m, CAST(SUM(s) AS BIGINT) AS s, CAST(SUM(r) AS BIGINT) AS r FROM b GROUP BY 1, 2)
SELECT fbin, dbin, m AS n_match, m + s AS n_src, m + r AS n_ref, ROUND(CASE WHEN m + r > 0 THEN CAST(m AS DOUBLE) / (m + r) END, 6) AS completeness,
 ROUND(CASE WHEN m + s > 0 THEN CAST(m AS DOUBLE) / (m + s) END, 6) AS reliability FROM g""")
def agg26(spark, sf):
    p, s, r = _id_pairs(spark, sf)
    m = p
    fb, db = lambda f: F.floor(F.col(f)).alias("fbin"), lambda y: F.floor(F.col(y) / 20.0).alias("dbin")
    ms = s.join(m.select(F.col("src_id").alias("id")), "id", "left_anti").select(fb("flux"), db("y"))
    mr = r.join(m.select(F.col("ref_id").alias("id")), "id", "left_anti").select(fb("flux"), db("y"))
    out = match.completeness(m.select(fb("src_flux"), db("src_y")), ms, mr, ["fbin", "dbin"])
    return out.withColumn("completeness", F.round("completeness", 6)).withColumn("reliability", F.round("reliability", 6))


@op("agg27", _IDP + f" SELECT {rs('AVG(sf - rf)', 'mean')}, {rs('MEDIAN(sf - rf)', 'median')}, {rs('STDDEV_POP(sf - rf)', 'std')}, COUNT(*) AS n FROM m")
def agg27(spark, sf):
    return match.flux_comparison(_id_pairs(spark, sf)[0]).select(r6("mean").alias("mean"), r6("median").alias("median"), r6("std").alias("std"), "n")


@op("srt1", f"WITH {_P} SELECT id, {rs('flux', 'flux')} FROM src ORDER BY flux DESC, id LIMIT 40")
def srt1(spark, sf):
    return match.brightest(points(spark, sf)[0], 40).select("id", r6("flux").alias("flux"))


@op("srt2", f"""WITH {_P} SELECT id, ROW_NUMBER() OVER (ORDER BY -flux, id) AS number, CASE WHEN x < 5 OR x > 355 OR ABS(y) > 80 THEN 'E' ELSE '-' END AS edge FROM src""")
def srt2(spark, sf):
    s, _ = points(spark, sf)
    n = match.number_detections(s.withColumn("o", -F.col("flux")), "o", "id")
    edge = F.when((F.col("x") < 5) | (F.col("x") > 355) | (F.abs("y") > 80), "E").otherwise("-")
    return n.select("id", "number", edge.alias("edge"))


@op("agg24", "SELECT COUNT(*) AS n_components FROM v_comp")
def agg24(spark, sf):
    return view(spark, sf, "v_comp").agg(F.count(F.lit(1)).alias("n_components"))
