"""Image, cube and detection queries with their checking SQL."""

from __future__ import annotations

import math

from pyspark.sql import functions as F

from ..functions.order import grouped_madfm
from ..operators import detect, image
from ..session import cut_lineage
from ..views import tables, view
from .calibration_queries import rs
from .registry import op, r6

N = 32


def pix(spark, sf):
    return view(spark, sf, "v_pix").withColumn("value", r6("value")).withColumn("weight", r6("weight"))


_PX = "px AS (SELECT image_id, x, y, ROUND(value + 3.1e-9, 6) AS value, ROUND(weight + 3.1e-9, 6) AS weight FROM v_pix)"


def rounded(df, keys, cols, digits=6):
    return df.select(*keys, *[r6(c, digits).alias(c) for c in cols])


def rsql(cols, digits=6):
    return ", ".join(rs(e, n, digits) for n, e in cols.items())


@op("agg9", f"WITH {_PX} SELECT image_id, COUNT(value) AS n, {rsql({'mean': 'AVG(value)', 'std': 'STDDEV_SAMP(value)'})} FROM px GROUP BY 1")
def agg9(spark, sf):
    return rounded(image.exact_stats(pix(spark, sf), ["image_id"]), ["image_id", "n"], ["mean", "std"])


@op("agg9_pooled", f"""WITH {_PX}, p AS (SELECT image_id, x // 8 AS part, COUNT(*) AS n, AVG(value) AS m, COALESCE(STDDEV_SAMP(value), 0) AS s FROM px GROUP BY 1, 2)
SELECT image_id, CAST(SUM(n) AS BIGINT) AS n, {rsql({'mean': 'SUM(n * m) / SUM(n)', 'std': 'SQRT(SUM(s * s * (n - 1)) / (SUM(n) - 1))'})} FROM p GROUP BY 1""")
def agg9_pooled(spark, sf):
    parts = pix(spark, sf).withColumn("part", F.floor(F.col("x") / 8)).groupBy("image_id", "part").agg(
        F.count("value").alias("n"), F.avg("value").alias("mean"), F.coalesce(F.stddev_samp("value"), F.lit(0.0)).alias("std"))
    return rounded(image.pooled_stats(parts, ["image_id"]), ["image_id", "n"], ["mean", "std"])


_MAD = """md AS (SELECT {k}, MEDIAN(value) AS med FROM {t} GROUP BY {k}),
 mf AS (SELECT {k}, MEDIAN(ABS(value - med)) AS mad FROM {t} JOIN md USING ({k}) GROUP BY {k})"""


@op("agg10", f"WITH {_PX}, {_MAD.format(k='image_id', t='px')} SELECT image_id, {rsql({'median': 'med', 'madfm': 'mad', 'sigma': 'mad / 0.6744888'})} FROM md JOIN mf USING (image_id)")
def agg10(spark, sf):
    return rounded(grouped_madfm(pix(spark, sf), ["image_id"], "value"), ["image_id"], ["median", "madfm", "sigma"])


@op("agg11", f"""WITH {_MAD.format(k='chan', t='v_cube')}
SELECT chan, {rsql({'rms': 'SQRT(AVG(value * value))', 'std': 'STDDEV_POP(value)', 'mean': 'AVG(value)', 'onepc': 'QUANTILE_CONT(value, 0.01)',
 'median': 'ANY_VALUE(med)', 'madfm': 'ANY_VALUE(mad)', 'minval': 'MIN(value)', 'maxval': 'MAX(value)'})}
FROM v_cube JOIN md USING (chan) JOIN mf USING (chan) GROUP BY chan""")
def agg11(spark, sf):
    s = image.cube_stats(view(spark, sf, "v_cube"), ["chan"])
    return rounded(s, ["chan"], ["rms", "std", "mean", "onepc", "median", "madfm", "minval", "maxval"])


_GOOD = """q AS (SELECT image_id, MEDIAN(value) AS q2, QUANTILE_CONT(value, 0.75) - QUANTILE_CONT(value, 0.25) AS iqr FROM px GROUP BY 1)"""


@op("agg12", f"""WITH {_PX}, {_GOOD} SELECT image_id, x, y, {rs('value', 'value')} FROM px JOIN q USING (image_id)
WHERE ABS(value) < 1e5 AND ABS(value - q2) < 5.0 * iqr AND x < 999""")
def agg12(spark, sf):
    return rounded(image.good_cells(pix(spark, sf), ["image_id"], "value"), ["image_id", "x", "y"], ["value"])


_CH = """cs AS (SELECT image_id AS beam, chan, STDDEV_POP(value) AS std, MEDIAN(value) AS med FROM v_cube GROUP BY 1, 2),
 cm AS (SELECT c.image_id AS beam, c.chan, MEDIAN(ABS(c.value - cs.med)) / 0.6744888 AS madfm FROM v_cube c JOIN cs ON cs.beam = c.image_id AND cs.chan = c.chan GROUP BY 1, 2),
 st AS (SELECT beam, chan, ROUND(std, 6) AS std, ROUND(madfm, 6) AS madfm FROM cs JOIN cm USING (beam, chan))"""


def _good_sql(col):
    return f"""(SELECT s.beam, s.{col} FROM st s JOIN (SELECT beam, MEDIAN({col}) AS q2, QUANTILE_CONT({col}, 0.75) - QUANTILE_CONT({col}, 0.25) AS iqr FROM st GROUP BY 1) q
 ON q.beam = s.beam WHERE ABS(s.{col}) < 1e5 AND ABS(s.{col} - q.q2) < 5.0 * q.iqr)"""


@op("agg13", f"""WITH {_CH}, a AS (SELECT beam, MAX(std) AS s_hi, MIN(std) AS s_lo FROM {_good_sql('std')} GROUP BY 1),
 b AS (SELECT beam, MAX(madfm) AS m_hi FROM {_good_sql('madfm')} GROUP BY 1), r AS (SELECT beam, LEAST(s_lo, m_hi) AS lo, GREATEST(s_hi, m_hi) AS hi FROM a JOIN b USING (beam))
SELECT beam, {rsql({'ymin': 'lo - 0.1 * (hi - lo)', 'ymax': 'hi + 0.1 * (hi - lo)'})} FROM r""")
def agg13(spark, sf):
    c = view(spark, sf, "v_cube")
    std = c.groupBy("image_id", "chan").agg(F.stddev_pop("value").alias("std"))
    mad = grouped_madfm(c, ["image_id", "chan"], "value").select("image_id", "chan", F.col("sigma").alias("madfm"))
    st = std.join(mad, ["image_id", "chan"]).select(F.col("image_id").alias("beam"), "chan", F.round("std", 6).alias("std"), F.round("madfm", 6).alias("madfm"))
    return rounded(image.noise_range(st, "beam"), ["beam"], ["ymin", "ymax"])


@op("agg13_psf", f"""WITH b AS (SELECT s_nationkey AS beam, ABS(s_acctbal) / 100.0 + 10 AS bmaj, ABS(s_acctbal) / 200.0 + 5 AS bmin FROM supplier),
 r AS (SELECT beam, MAX(bmaj) AS hi, MIN(bmin) AS lo FROM b GROUP BY 1) SELECT beam, {rsql({'ymin': 'lo - 0.1 * (hi - lo)', 'ymax': 'hi + 0.1 * (hi - lo)'})} FROM r""")
def agg13_psf(spark, sf):
    a = F.abs("s_acctbal")
    b = tables(spark, sf, "supplier").select(F.col("s_nationkey").alias("beam"), (a / 100.0 + 10).alias("bmaj"), (a / 200.0 + 5).alias("bmin"))
    return rounded(image.psf_range(b, "beam"), ["beam"], ["ymin", "ymax"])


@op("agg14", f"""WITH {_PX}, k AS (SELECT *, ROW_NUMBER() OVER (PARTITION BY image_id ORDER BY value DESC, y, x) AS n FROM px)
SELECT image_id, {rs('MAX(value)', 'maxval')}, MAX(CASE WHEN n = 1 THEN x END) AS max_x, MAX(CASE WHEN n = 1 THEN y END) AS max_y,
 {rsql({'minval': 'MIN(value)', 'rms': 'SQRT(AVG(value * value))', 'median': 'MEDIAN(value)', 'inner_max': 'MAX(CASE WHEN x BETWEEN 8 AND 24 AND y BETWEEN 8 AND 24 THEN value END)',
 'inner_min': 'MIN(CASE WHEN x BETWEEN 8 AND 24 AND y BETWEEN 8 AND 24 THEN value END)'})} FROM k GROUP BY 1""")
def agg14(spark, sf):
    s = image.image_stats(pix(spark, sf), (N, N))
    return rounded(s, ["image_id", "max_x", "max_y"], ["maxval", "minval", "rms", "median", "inner_max", "inner_min"])


_FWHM, _INC = 0.3, 0.012


def _beamed(spark, sf):
    p = pix(spark, sf)
    c = 10.0 + 6.0 * F.col("image_id")
    return p.withColumn("pb", image.primary_beam(F.col("x") - c, F.col("y") - c, (0.0, 0.0), (_INC, _INC), _FWHM))


_PB = _PX + f""", pb AS (SELECT *, EXP(-4.0 * LN(2.0) * POWER(ASIN(LEAST(1.0, SQRT(POWER({_INC} * (x - 10.0 - 6.0 * image_id), 2)
  + POWER({_INC} * (y - 10.0 - 6.0 * image_id), 2)))) / {_FWHM}, 2)) AS pb FROM px)"""
_FACTORS = {  # img factor and weight, by weight source and input state
    ("weight_images", "corrected"): ("weight", "weight"), ("weight_images", "inherent"): ("SQRT(weight)", "weight"),
    ("weight_images", "weighted"): ("1.0", "weight"), ("beam_model", "corrected"): ("pb * pb", "pb * pb"),
    ("beam_model", "inherent"): ("pb", "pb * pb"), ("beam_model", "weighted"): ("1.0", "pb * pb"),
    ("combined", "corrected"): ("weight * pb * pb", "weight * pb * pb"), ("combined", "inherent"): ("weight * pb", "weight * pb * pb"),
    ("combined", "weighted"): ("1.0", "weight * pb * pb")}


def _mosaic_sql(source, state, cutoff=0.4):
    f, w = _FACTORS[source, state]
    cut = "" if source == "weight_images" else f" WHERE wgt >= {cutoff * cutoff} * top"
    return f"""SELECT '{source}' AS source, '{state}' AS state, x, y, SUM(img) AS img, SUM(wgt) AS wgt, COUNT(*) AS n_images FROM (
 SELECT *, MAX(wgt) OVER (PARTITION BY image_id) AS top FROM (SELECT image_id, x, y, value * ({f}) AS img, ({w}) AS wgt FROM pb)){cut} GROUP BY x, y"""


@op("agg15", f"WITH {_PB}, m AS (" + "\nUNION ALL ".join(_mosaic_sql(*k) for k in _FACTORS) + f") SELECT source, state, x, y, {rsql({'img': 'img', 'wgt': 'wgt'}, 5)}, n_images FROM m")
def agg15(spark, sf):
    b, out = cut_lineage(_beamed(spark, sf)), None
    for source, state in _FACTORS:
        m = image.mosaic(image.weigh(b, source, state), ["x", "y"], 0.4, source).withColumn("source", F.lit(source)).withColumn("state", F.lit(state))
        out = m if out is None else out.unionByName(m)
    return rounded(out, ["source", "state", "x", "y", "n_images"], ["img", "wgt"], 5)


_M1 = f"WITH {_PB}, m AS ({_mosaic_sql('beam_model', 'corrected')})"


def _mosaic1(spark, sf):
    return image.mosaic(image.weigh(_beamed(spark, sf), "beam_model", "corrected"), ["x", "y"], 0.4, "beam_model")


@op("agg16", _M1 + f" SELECT x, y, {rsql({'value': 'CASE WHEN wgt > 0 THEN img / wgt ELSE 0 END', 'sensitivity': 'CASE WHEN wgt > 0 THEN SQRT(1.0 / wgt) ELSE 0 END'}, 5)} FROM m")
def agg16(spark, sf):
    return rounded(image.deweight(_mosaic1(spark, sf)), ["x", "y"], ["value", "sensitivity"], 5)


@op("agg17", _M1 + f" SELECT x, y, {rsql({'img': 'CASE WHEN wgt > 0 THEN img ELSE 0 END'}, 5)} FROM m")
def agg17(spark, sf):
    d = image.deweight(_mosaic1(spark, sf)).drop("img")
    return rounded(image.reweight(d), ["x", "y"], ["img"], 5)


_OBJ = "ob AS (SELECT image_id, x // 4 + 4 * (y // 4) AS obj_id, x, y FROM v_cube WHERE (x + y) % 3 < 2 GROUP BY 1, 2, 3, 4)"


def _objects(spark, sf):
    c = view(spark, sf, "v_cube")
    return c.where("(x + y) % 3 < 2").select("image_id", (F.floor(F.col("x") / 4) + 4 * F.floor(F.col("y") / 4)).alias("obj_id"), "x", "y").distinct()


@op("agg20", f"""WITH vx AS (SELECT image_id * 100 + x // 4 AS obj_id, x, y, chan * 5.0 - 20.0 AS v, value - 25.0 AS value FROM v_cube WHERE value > 25.0),
 a AS (SELECT obj_id, x, y, SUM(value * 5.0) AS m0, SUM(value * v * 5.0) AS s1 FROM vx GROUP BY 1, 2, 3),
 b AS (SELECT *, CASE WHEN m0 > 0 THEN s1 / m0 END AS m1 FROM a), c AS (SELECT obj_id, x, y, SUM(value * POWER(v - m1, 2) * 5.0) AS s2 FROM vx JOIN b USING (obj_id, x, y) GROUP BY 1, 2, 3)
SELECT obj_id, x, y, {rsql({'mom0': 'm0', 'mom1': 'm1', 'mom2': 'CASE WHEN m0 > 0 THEN SQRT(GREATEST(s2 / m0, 0.0)) END'}, 4)} FROM b JOIN c USING (obj_id, x, y)""")
def agg20(spark, sf):
    c = view(spark, sf, "v_cube").where("value > 25.0").select(
        (F.col("image_id") * 100 + F.floor(F.col("x") / 4)).alias("obj_id"), "x", "y", (F.col("chan") * 5.0 - 20.0).alias("v"), (F.col("value") - 25.0).alias("value"))
    m = image.moments(c, 5.0)
    return rounded(m, ["obj_id", "x", "y"], ["mom0", "mom1", "mom2"], 4)


@op("agg21", f"WITH {_OBJ} SELECT obj_id, chan, {rs('SUM(value) / 12.5', 'flux', 5)}, COUNT(*) AS n_pix FROM v_cube JOIN ob USING (image_id, x, y) GROUP BY 1, 2")
def agg21(spark, sf):
    s = image.object_spectrum(view(spark, sf, "v_cube"), _objects(spark, sf), 12.5)
    return rounded(s, ["obj_id", "chan", "n_pix"], ["flux"], 5)


_BOX = """bx AS (SELECT n_nationkey % 3 AS image_id, n_nationkey AS obj_id, n_nationkey % 14 AS x_min, n_nationkey % 14 + 1 AS x_max, (n_nationkey * 3) % 13 AS y_min,
   (n_nationkey * 3) % 13 + 2 AS y_max, n_nationkey % 5 AS chan_min, n_nationkey % 5 + 1 AS chan_max FROM nation),
 cb AS (SELECT b.obj_id, c.* FROM v_cube c JOIN bx b ON c.image_id = b.image_id AND c.x BETWEEN b.x_min - 2 AND b.x_max + 2 AND c.y BETWEEN b.y_min - 2 AND b.y_max + 2
   AND c.chan BETWEEN b.chan_min - 1 AND b.chan_max + 1)"""


def _cubelets(spark, sf, tile=4):
    n = F.col("n_nationkey").cast("long")
    b = tables(spark, sf, "nation").select(
        (n % 3).alias("image_id"), F.col("n_nationkey").alias("obj_id"), (n % 14).alias("x_min"), (n % 14 + 1).alias("x_max"), ((n * 3) % 13).alias("y_min"),
        ((n * 3) % 13 + 2).alias("y_max"), (n % 5).alias("chan_min"), (n % 5 + 1).alias("chan_max"))
    return image.cubelets(view(spark, sf, "v_cube"), b, 2, 1, (16, 16, 8), tile)


@op("flt24", f"WITH {_BOX} SELECT obj_id, image_id, x, y, chan, {rs('value', 'value')} FROM cb")
def flt24(spark, sf):
    return rounded(_cubelets(spark, sf), ["obj_id", "image_id", "x", "y", "chan"], ["value"])


@op("agg22", f"""WITH {_BOX}, {_MAD.format(k='obj_id, chan', t='cb')} SELECT obj_id, chan, {rs('mad / 0.6744888', 'noise')} FROM mf""")
def agg22(spark, sf):
    return rounded(image.noise_spectrum(_cubelets(spark, sf), True), ["obj_id", "chan"], ["noise"])


@op("agg22_rms", f"WITH {_BOX} SELECT obj_id, chan, {rs('STDDEV_SAMP(value)', 'noise')} FROM cb GROUP BY 1, 2")
def agg22_rms(spark, sf):
    return rounded(image.noise_spectrum(_cubelets(spark, sf), False), ["obj_id", "chan"], ["noise"])


_ISL = _PX + ", il AS (SELECT *, x // 8 + 4 * (y // 8) AS obj_id, value * 0.5 AS background, CASE WHEN (x + y) % 7 = 0 THEN 2e6 ELSE weight END AS noise, value - 38.0 AS residual FROM px)"


def _islands(spark, sf):
    p = pix(spark, sf)
    return p.withColumn("obj_id", F.floor(F.col("x") / 8) + 4 * F.floor(F.col("y") / 8)).withColumn("background", F.col("value") * 0.5).withColumn(
        "noise", F.when((F.col("x") + F.col("y")) % 7 == 0, 2e6).otherwise(F.col("weight"))).withColumn("residual", F.col("value") - 38.0)


@op("agg23", f"""WITH {_ISL} SELECT image_id, obj_id, {rsql({'background': 'AVG(background)', 'noise': 'COALESCE(AVG(CASE WHEN ABS(noise) < 1e6 THEN noise END), 0)', 'res_max': 'MAX(residual)',
 'res_min': 'MIN(residual)', 'res_mean': 'AVG(residual)', 'res_std': 'STDDEV_SAMP(residual)', 'res_rms': 'SQRT(AVG(residual * residual))'})} FROM il GROUP BY 1, 2""")
def agg23(spark, sf):
    return rounded(detect.island_statistics(_islands(spark, sf)), ["image_id", "obj_id"], ["background", "noise", "res_max", "res_min", "res_mean", "res_std", "res_rms"])


@op("agg37", f"""WITH cp AS (SELECT comp_id, ra_deg % 24 + 4 AS x0, (dec_deg + 90) % 24 + 4 AS y0, flux_peak AS flux, 0.6 + (comp_id % 3) * 0.2 AS sigma FROM v_comp),
 r AS (SELECT *, CAST(CEIL(sigma * SQRT(-2 * LN(POWER(2.0, -52)))) AS BIGINT) AS h, CAST(FLOOR(x0 + 0.5) AS BIGINT) AS cx, CAST(FLOOR(y0 + 0.5) AS BIGINT) AS cy FROM cp),
 px AS (SELECT cx + dx AS x, cy + dy AS y, flux / (2 * PI() * sigma * sigma) * EXP(-(POWER(cx + dx - x0, 2) + POWER(cy + dy - y0, 2)) / (2 * sigma * sigma)) AS v
   FROM r CROSS JOIN (SELECT UNNEST(RANGE(-9, 10)) AS dx) CROSS JOIN (SELECT UNNEST(RANGE(-9, 10)) AS dy) WHERE ABS(dx) <= h AND ABS(dy) <= h)
SELECT x, y, {rs('SUM(v)', 'value', 5)} FROM px GROUP BY 1, 2""")
def agg37(spark, sf):
    c = view(spark, sf, "v_comp").select("comp_id", (F.col("ra_deg") % 24 + 4).alias("x0"), ((F.col("dec_deg") + 90) % 24 + 4).alias("y0"),
                                         F.col("flux_peak").alias("flux"), (0.6 + (F.col("comp_id") % 3) * 0.2).alias("sigma"))
    return rounded(image.sum_images(image.render_components(c), ["x", "y"]), ["x", "y"], ["value"], 5)


@op("agg37_ellipse", f"""WITH cp AS (SELECT comp_id, ra_deg + 4 AS x0, dec_deg + 94 AS y0, flux_peak AS flux, freq_mhz, spectral_index AS al,
   (1.5 + (comp_id % 4) * 0.4) / 2.3548200450309493e0 AS sa, (1.0 + (comp_id % 3) * 0.15) / 2.3548200450309493e0 AS sb, RADIANS((comp_id % 18) * 10) AS pa FROM v_comp),
 r AS (SELECT *, CAST(CEIL(sa * SQRT(-2 * LN(POWER(2.0, -52)))) AS BIGINT) AS h, CAST(FLOOR(x0 + 0.5) AS BIGINT) AS cx, CAST(FLOOR(y0 + 0.5) AS BIGINT) AS cy FROM cp),
 st AS (SELECT i / 8.0 - 0.5 AS o, CASE WHEN i IN (0, 8) THEN 1 WHEN i % 2 = 1 THEN 4 ELSE 2 END / 24.0 AS w FROM RANGE(9) g(i)),
 px AS (SELECT comp_id, cx + dx AS x, cy + dy AS y, SUM(u.w * v.w * EXP(-0.5 * (POWER(((cx + dx + u.o - x0) * COS(pa) + (cy + dy + v.o - y0) * SIN(pa)) / sb, 2)
     + POWER(((cy + dy + v.o - y0) * COS(pa) - (cx + dx + u.o - x0) * SIN(pa)) / sa, 2)))) AS share
   FROM r CROSS JOIN (SELECT UNNEST(RANGE(-12, 13)) AS dx) CROSS JOIN (SELECT UNNEST(RANGE(-12, 13)) AS dy) CROSS JOIN st u CROSS JOIN st v
   WHERE ABS(dx) <= h AND ABS(dy) <= h AND cx + dx BETWEEN 0 AND 367 AND cy + dy BETWEEN 0 AND 187 GROUP BY 1, 2, 3)
SELECT x, y, c.chan, {rs('SUM(share * flux * al * POWER(c.mhz / freq_mhz, al) / (2 * PI() * sa * sb))', 'value', 6)} FROM px JOIN cp USING (comp_id)
CROSS JOIN (VALUES (0, 880.0), (1, 1080.0)) c(chan, mhz) GROUP BY 1, 2, 3""")
def agg37_ellipse(spark, sf):
    """First Taylor term of rotated elliptical components, two channels."""
    k = F.col("comp_id")
    c = view(spark, sf, "v_comp").select((F.col("ra_deg") + 4).alias("x0"), (F.col("dec_deg") + 94).alias("y0"), F.col("flux_peak").alias("flux"),
                                         F.col("freq_mhz").alias("freq0"), F.col("spectral_index").alias("alpha"), (1.5 + (k % 4) * 0.4).alias("major"),
                                         (1.0 + (k % 3) * 0.15).alias("minor"), F.radians((k % 18) * 10).alias("pa"))
    return rounded(image.paint_components(c, (368, 188), [880.0, 1080.0], term=1, steps=8), ["x", "y", "chan"], ["value"], 6)


@op("agg38", """WITH b AS (SELECT 'cube' || (p_partkey % 5) AS name, p_partkey // 5 AS chan, CASE WHEN p_partkey % 5 = 0 OR p_partkey // 5 = 0 THEN p_retailprice / 100.0 END AS bmaj,
   CASE WHEN p_partkey % 5 < 2 THEN p_size / 10.0 END AS bmin, CAST(p_size AS DOUBLE) AS bpa FROM part)
SELECT name, chan, ROUND(COALESCE(bmaj, MAX(CASE WHEN chan = 0 THEN bmaj END) OVER (PARTITION BY name), 0.0), 6) AS bmaj, ROUND(COALESCE(bmin, 0.0), 6) AS bmin, bpa FROM b""")
def agg38(spark, sf):
    k, n = F.col("p_partkey"), F.col("p_partkey") % 5
    ch = F.floor(k / 5)
    b = tables(spark, sf, "part").select(
        F.concat(F.lit("cube"), n.cast("string")).alias("name"), ch.alias("chan"), F.when((n == 0) | (ch == 0), F.col("p_retailprice") / 100.0).alias("bmaj"),
        F.when(n < 2, F.col("p_size") / 10.0).alias("bmin"), F.col("p_size").cast("double").alias("bpa"))
    return rounded(image.beam_log(b), ["name", "chan"], ["bmaj", "bmin", "bpa"])


@op("agg43", f"WITH {_PX} SELECT CAST(LEAST(FLOOR(value / 2.0), 49) AS BIGINT) AS bin, COUNT(*) AS n, CAST(LEAST(FLOOR(value / 2.0), 49) * 2.0 AS DOUBLE) AS bin_low FROM px WHERE value BETWEEN 0 AND 100 GROUP BY 1, 3")
def agg43(spark, sf):
    return image.histogram(pix(spark, sf), "value", 0.0, 100.0, 50)


_SLIDE = _PX + """, nb AS (SELECT a.image_id, a.x, a.y, a.value, b.value AS bv FROM px a JOIN px b ON a.image_id = b.image_id AND ABS(a.x - b.x) <= 1 AND ABS(a.y - b.y) <= 1)"""
_SL = _SLIDE + """, sl AS (SELECT image_id, x, y, ANY_VALUE(value) AS value, CASE WHEN x BETWEEN 1 AND 30 AND y BETWEEN 1 AND 30 THEN AVG(bv) ELSE 0 END AS middle,
   CASE WHEN x BETWEEN 1 AND 30 AND y BETWEEN 1 AND 30 THEN COALESCE(STDDEV_SAMP(bv), 0) ELSE 0 END AS spread FROM nb GROUP BY 1, 2, 3)"""


@op("win1", f"WITH {_SL} SELECT image_id, x, y, {rsql({'middle': 'middle', 'spread': 'spread'}, 5)} FROM sl")
def win1(spark, sf):
    return rounded(image.sliding_stats(pix(spark, sf), ["image_id"], 1, (N, N), False), ["image_id", "x", "y"], ["middle", "spread"], 5)


_SLR = _SLIDE + f""", md AS (SELECT image_id, x, y, MEDIAN(bv) AS med FROM nb GROUP BY 1, 2, 3), mf AS (SELECT image_id, x, y, MEDIAN(ABS(bv - med)) / 0.6744888 AS s
   FROM nb JOIN md USING (image_id, x, y) GROUP BY 1, 2, 3),
 sl AS (SELECT px.image_id, px.x, px.y, px.value, CASE WHEN px.x BETWEEN 1 AND 30 AND px.y BETWEEN 1 AND 30 THEN med ELSE 0 END AS middle,
   CASE WHEN px.x BETWEEN 1 AND 30 AND px.y BETWEEN 1 AND 30 THEN s ELSE 0 END AS spread FROM px JOIN md USING (image_id, x, y) JOIN mf USING (image_id, x, y))"""


@op("win1_robust", f"WITH {_SLR} SELECT image_id, x, y, {rsql({'middle': 'middle', 'spread': 'spread'}, 5)} FROM sl")
def win1_robust(spark, sf):
    return rounded(image.sliding_stats(pix(spark, sf), ["image_id"], 1, (N, N), True), ["image_id", "x", "y"], ["middle", "spread"], 5)


@op("win1_spectrum", f"""WITH nb AS (SELECT a.image_id, a.x, a.y, a.chan, b.value AS bv FROM v_cube a JOIN v_cube b ON a.image_id = b.image_id AND a.x = b.x AND a.y = b.y AND ABS(a.chan - b.chan) <= 1)
SELECT image_id, x, y, chan, {rsql({'middle': 'CASE WHEN chan BETWEEN 1 AND 6 THEN AVG(bv) ELSE 0 END', 'spread': 'CASE WHEN chan BETWEEN 1 AND 6 THEN COALESCE(STDDEV_SAMP(bv), 0) ELSE 0 END'}, 5)}
FROM nb GROUP BY 1, 2, 3, 4""")
def win1_spectrum(spark, sf):
    s = image.sliding_spectrum(view(spark, sf, "v_cube"), ["image_id", "x", "y"], 1, 8)
    return rounded(s, ["image_id", "x", "y", "chan"], ["middle", "spread"], 5)


@op("win2", f"WITH {_SLR} SELECT image_id, x, y, {rs('CASE WHEN spread > 0 THEN (value - middle) / spread ELSE 0 END', 'snr', 4)} FROM sl")
def win2(spark, sf):
    s = image.signal_to_noise(image.sliding_stats(pix(spark, sf), ["image_id"], 1, (N, N), True))
    return rounded(s, ["image_id", "x", "y"], ["snr"], 4)


@op("win3", f"""WITH {_SL}, bs AS (SELECT image_id, x, y, SUM(bv) AS box_sum FROM nb GROUP BY 1, 2, 3)
SELECT image_id, x, y, {rsql({'threshold': 'middle + 3.0 * spread', 'box_sum': 'box_sum'}, 4)} FROM sl JOIN bs USING (image_id, x, y)""")
def win3(spark, sf):
    s = image.sliding_stats(pix(spark, sf), ["image_id"], 1, (N, N), False).withColumn("threshold", F.col("middle") + 3.0 * F.col("spread"))
    return rounded(image.box_sums(s, ["image_id"], 1, {"box_sum": F.col("value")}), ["image_id", "x", "y"], ["threshold", "box_sum"], 4)


@op("win4", f"WITH {_PX}, t AS (SELECT *, SQRT(weight / MAX(weight) OVER (PARTITION BY image_id)) AS sc FROM px) SELECT image_id, x, y, {rs('sc', 'scale')}, sc >= 0.75 AS valid FROM t")
def win4(spark, sf):
    w = image.weight_mask(pix(spark, sf), ["image_id"], 0.75)
    return w.select("image_id", "x", "y", r6("scale").alias("scale"), "valid")


@op("win5", f"WITH {_SLIDE} SELECT image_id, x, y, {rs('SUM(bv) - 9.0 * ANY_VALUE(value)', 'curvature', 4)} FROM nb GROUP BY 1, 2, 3")
def win5(spark, sf):
    return rounded(image.curvature(pix(spark, sf), ["image_id"]), ["image_id", "x", "y"], ["curvature"], 4)


@op("set3", """WITH t AS (SELECT s_name AS name, s_suppkey % 4 AS beam, 700.0 + s_suppkey AS freq, s_suppkey % 7 + 4 AS n_chan FROM supplier),
 b AS (SELECT *, COALESCE(SUM(n_chan) OVER (ORDER BY freq ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS bf FROM t WHERE beam = 2)
SELECT name, CAST(GREATEST(1, 10 - bf) AS BIGINT) AS first, CAST(LEAST(n_chan, 40 - bf) AS BIGINT) AS last FROM b WHERE n_chan + bf >= 10 AND bf < 40""")
def set3(spark, sf):
    k = F.col("s_suppkey")
    t = tables(spark, sf, "supplier").select(F.col("s_name").alias("name"), (k % 4).alias("beam"), (700.0 + k).alias("freq"), (k % 7 + 4).alias("n_chan"))
    return image.tables_for_channels(t, 2, 10, 40)


@op("set4", f"""WITH i AS (SELECT 'image.' || LPAD(CAST(chan * 10 + 5 AS VARCHAR), 3, '0') AS name, image_id, x, y, value FROM v_cube),
 n AS (SELECT name, ROW_NUMBER() OVER (ORDER BY name) - 1 AS chan FROM (SELECT DISTINCT name FROM i)) SELECT image_id, x, y, chan, {rs('value', 'value')} FROM i JOIN n USING (name)""")
def set4(spark, sf):
    c = view(spark, sf, "v_cube").withColumn("name", F.concat(F.lit("image."), F.lpad((F.col("chan") * 10 + 5).cast("string"), 3, "0"))).drop("chan")
    return rounded(image.stack(c, "name", ["image_id"]), ["image_id", "x", "y", "chan"], ["value"])


@op("set5", f"""WITH a AS (SELECT image_id, x, y, chan - 2 AS chan, CASE WHEN x = 3 THEN 0.0 ELSE value * 2.5 END AS value FROM v_cube WHERE chan BETWEEN 2 AND 4),
 b AS (SELECT image_id, x, y, chan + 3 AS chan, CASE WHEN x = 3 THEN 0.0 ELSE value * 2.5 END AS value FROM v_cube WHERE chan BETWEEN 0 AND 1)
SELECT image_id, x, y, chan, {rs('value', 'value')} FROM (SELECT * FROM a UNION ALL SELECT * FROM b)""")
def set5(spark, sf):
    c = view(spark, sf, "v_cube").withColumn("value", F.when(F.col("x") == 3, F.lit(float("nan"))).otherwise(F.col("value")))
    m = image.merge_cubes([(image.slice_cube(c, 2, 4), 3), (image.slice_cube(c, 0, 1), 2)])
    return rounded(image.nan_to_zero(image.scale(m, 2.5)), ["image_id", "x", "y", "chan"], ["value"])


@op("jn18", f"""WITH {_PX}, s AS (SELECT comp_id, CAST(FLOOR(ra_deg / 10.0) AS BIGINT) AS x, CAST(FLOOR((dec_deg + 90) / 5.0) AS BIGINT) AS y FROM v_comp), m AS (SELECT image_id, x, y, weight FROM px), g AS (SELECT DISTINCT image_id FROM px)
SELECT s.comp_id, g.image_id, COALESCE(m.weight > 0.5, FALSE) AS is_good FROM s CROSS JOIN g LEFT JOIN m ON m.image_id = g.image_id AND m.x = s.x AND m.y = s.y""")
def jn18(spark, sf):
    s = view(spark, sf, "v_comp").select("comp_id", F.floor(F.col("ra_deg") / 10.0).alias("x"), F.floor((F.col("dec_deg") + 90) / 5.0).alias("y"))
    m = pix(spark, sf).select("image_id", "x", "y", F.col("weight").alias("value"))
    images = m.agg(F.array_sort(F.collect_set("image_id"))).first()[0]  # a mask per image; there are few
    s = s.withColumn("image_id", F.explode(F.array(*[F.lit(i) for i in images]).cast("array<bigint>")))
    return image.mask_lookup(s, m, 0.5, ["image_id"]).select("comp_id", "image_id", "is_good")


CUT = 0.9
_TH = _PX + f", th AS (SELECT image_id, AVG(value) + {CUT} * STDDEV_SAMP(value) AS threshold FROM px GROUP BY 1), dt AS (SELECT px.* FROM px JOIN th USING (image_id) WHERE value > threshold)"


@op("det1", f"WITH {_TH} SELECT image_id, {rs('threshold', 'threshold')} FROM th")
def det1(spark, sf):
    return rounded(detect.thresholds(pix(spark, sf), ["image_id"], CUT, False), ["image_id"], ["threshold"])


@op("det1_robust", f"WITH {_PX}, {_MAD.format(k='image_id', t='px')} SELECT image_id, {rs(f'med + {CUT} * mad / 0.6744888', 'threshold')} FROM md JOIN mf USING (image_id)")
def det1_robust(spark, sf):
    return rounded(detect.thresholds(pix(spark, sf), ["image_id"], CUT, True), ["image_id"], ["threshold"])


def _detected(spark, sf):
    p = pix(spark, sf)
    return detect.detect(p, ["image_id"], detect.thresholds(p, ["image_id"], CUT, False))


@op("det2", f"WITH {_TH} SELECT image_id, x, y, {rs('value', 'value')} FROM dt")
def det2(spark, sf):
    return rounded(_detected(spark, sf), ["image_id", "x", "y"], ["value"])


def _cc_sql(reach):
    return f"""WITH RECURSIVE {_TH},
 reach0(image_id, x, y, lab) AS (SELECT image_id, x, y, y * 16777216 + x AS lab FROM dt
  UNION SELECT d.image_id, d.x, d.y, r.lab FROM reach0 r JOIN dt d ON d.image_id = r.image_id AND ABS(d.x - r.x) <= {reach} AND ABS(d.y - r.y) <= {reach}),
 lb AS (SELECT image_id, x, y, MIN(lab) AS obj_id FROM reach0 GROUP BY 1, 2, 3)"""


def _labelled(spark, sf, reach=1):
    return detect.label_objects(_detected(spark, sf), reach, tile=8)


@op("det3", _cc_sql(1) + " SELECT image_id, x, y, obj_id FROM lb")
def det3(spark, sf):
    return _labelled(spark, sf)


@op("det3_gap", _cc_sql(2) + " SELECT image_id, x, y, obj_id FROM lb")
def det3_gap(spark, sf):
    """Objects also join across a gap (pixels within 2)."""
    return _labelled(spark, sf, 2)


@op("det4", _cc_sql(1) + " SELECT image_id, x, y, obj_id FROM lb JOIN (SELECT image_id, obj_id FROM lb GROUP BY 1, 2 HAVING COUNT(*) >= 3) k USING (image_id, obj_id)")
def det4(spark, sf):
    return detect.keep_large(_labelled(spark, sf), 3).select("image_id", "x", "y", "obj_id")


def _cube_sql(cut, reach, chan_reach, stretched=False):
    """Objects of the cube, grown from every voxel to all voxels it can be reached from."""
    places = "x * 4 + y % 2 AS x, y * 4 + x % 3 AS y, chan * 7 + (x + y) % 3 AS chan" if stretched else "x, y, chan"
    return f"""WITH RECURSIVE cube AS (SELECT image_id, {places}, value FROM v_cube),
 th AS (SELECT image_id, AVG(value) + {cut} * STDDEV_SAMP(value) AS threshold FROM cube GROUP BY 1),
 dt AS (SELECT cube.* FROM cube JOIN th USING (image_id) WHERE value > threshold),
 reach0(image_id, x, y, chan, lab) AS (SELECT image_id, x, y, chan, (chan * 16777216 + y) * 16777216 + x AS lab FROM dt
  UNION SELECT d.image_id, d.x, d.y, d.chan, r.lab FROM reach0 r JOIN dt d ON d.image_id = r.image_id AND ABS(d.x - r.x) <= {reach} AND ABS(d.y - r.y) <= {reach} AND ABS(d.chan - r.chan) <= {chan_reach}),
 lb AS (SELECT image_id, x, y, chan, MIN(lab) AS obj_id FROM reach0 GROUP BY 1, 2, 3, 4)"""


#: Spreads above the mean of a detected voxel.
BRIGHT = 1.2


def _cube_objects(spark, sf, reach, chan_reach, stretched=False):
    cube = view(spark, sf, "v_cube")
    if stretched:  # neighbours are 3 to 5 pixels and 5 to 9 channels apart, some within the gap and some beyond
        x, y, c = F.col("x"), F.col("y"), F.col("chan")
        cube = cube.select("image_id", (x * 4 + y % 2).alias("x"), (y * 4 + x % 3).alias("y"), (c * 7 + (x + y) % 3).alias("chan"), "value")
    found = detect.detect(cube, ["image_id"], detect.thresholds(cube, ["image_id"], BRIGHT, False))
    return detect.label_objects(found, reach, tile=8, chan="chan", chan_reach=chan_reach, chan_tile=max(4, chan_reach))


@op("det3_cube", _cube_sql(BRIGHT, 1, 1) + " SELECT image_id, x, y, chan, obj_id FROM lb")
def det3_cube(spark, sf):
    """Objects on three axes: voxels that touch in position and channel."""
    return _cube_objects(spark, sf, 1, 1)


@op("det3_cube_gap", _cube_sql(BRIGHT, 3, 7, True) + " SELECT image_id, x, y, chan, obj_id FROM lb")
def det3_cube_gap(spark, sf):
    """Adjacency off: voxels within 3 pixels and 7 channels."""
    return _cube_objects(spark, sf, 3, 7, True)


@op("det4_cube", _cube_sql(BRIGHT, 1, 1) + """, sz AS (SELECT image_id, obj_id, COUNT(*) AS n_vox, COUNT(DISTINCT y * 16777216 + x) AS n_pix, COUNT(DISTINCT chan) AS n_chan FROM lb GROUP BY 1, 2)
SELECT image_id, x, y, chan, obj_id FROM lb JOIN sz USING (image_id, obj_id) WHERE n_pix >= 2 AND n_chan >= 3 AND n_vox >= 6 AND n_chan <= 7""")
def det4_cube(spark, sf):
    """Limits on positions, channels and voxels of whole objects."""
    return detect.keep_objects(_cube_objects(spark, sf, 1, 1), 2, 3, max_chan=7)


@op("det4_sizes", _cube_sql(BRIGHT, 3, 7, True) + """ SELECT image_id, obj_id, COUNT(*) AS n_vox, COUNT(DISTINCT y * 16777216 + x) AS n_pix, COUNT(DISTINCT chan) AS n_chan FROM lb GROUP BY 1, 2""")
def det4_sizes(spark, sf):
    return detect.object_sizes(_cube_objects(spark, sf, 3, 7, True)).select("image_id", "obj_id", "n_vox", "n_pix", "n_chan")


def _object_pixels(spark, sf):
    return _labelled(spark, sf).join(pix(spark, sf), ["image_id", "x", "y"])


@op("det5", _cc_sql(1) + f""", o AS (SELECT lb.*, px.value, ROW_NUMBER() OVER (PARTITION BY image_id, obj_id ORDER BY value DESC, y, x) AS k FROM lb JOIN px USING (image_id, x, y))
SELECT image_id, obj_id, COUNT(*) AS n_pix, MIN(x) AS x_min, MAX(x) AS x_max, MIN(y) AS y_min, MAX(y) AS y_max, MAX(CASE WHEN k = 1 THEN x END) AS x_peak, MAX(CASE WHEN k = 1 THEN y END) AS y_peak,
 {rsql({'x_mean': 'AVG(x)', 'y_mean': 'AVG(y)', 'x_cen': 'SUM(x * value) / SUM(value)', 'y_cen': 'SUM(y * value) / SUM(value)', 'flux_sum': 'SUM(value)', 'flux_peak': 'MAX(value)'}, 5)} FROM o GROUP BY 1, 2""")
def det5(spark, sf):
    p = detect.object_parameters(_object_pixels(spark, sf))
    return rounded(p, ["image_id", "obj_id", "n_pix", "x_min", "x_max", "y_min", "y_max", "x_peak", "y_peak"], ["x_mean", "y_mean", "x_cen", "y_cen", "flux_sum", "flux_peak"], 5)


@op("det6", _ISL.join(["WITH ", ""]) + f""", s AS (SELECT image_id, obj_id, COUNT(*) AS n_pix, SUM(value) AS flux, MAX(value) AS peak, SUM(value * x) / SUM(value) AS mx, SUM(value * y) / SUM(value) AS my FROM il GROUP BY 1, 2),
 m AS (SELECT il.image_id, il.obj_id, ANY_VALUE(n_pix) AS n_pix, ANY_VALUE(flux) AS flux, ANY_VALUE(peak) AS peak, ANY_VALUE(mx) AS x_cen, ANY_VALUE(my) AS y_cen,
  SUM(value * POWER(x - mx, 2)) / SUM(value) AS cxx, SUM(value * POWER(y - my, 2)) / SUM(value) AS cyy, SUM(value * (x - mx) * (y - my)) / SUM(value) AS cxy FROM il JOIN s USING (image_id, obj_id) GROUP BY 1, 2),
 e AS (SELECT *, (cxx + cyy) / 2 AS mid, SQRT(POWER((cxx - cyy) / 2, 2) + cxy * cxy) AS hf FROM m)
SELECT image_id, obj_id, n_pix, {rsql({'flux': 'flux', 'peak': 'peak', 'x_cen': 'x_cen', 'y_cen': 'y_cen', 'maj': f'{2 * math.sqrt(2 * math.log(2))} * SQRT(GREATEST(mid + hf, 0))',
 'min': f'{2 * math.sqrt(2 * math.log(2))} * SQRT(GREATEST(mid - hf, 0))', 'pa': 'CASE WHEN hf > 1e-9 THEN DEGREES(0.5 * ATAN2(2 * cxy, cxx - cyy)) ELSE 0 END'}, 4)} FROM e""")
def det6(spark, sf):
    return rounded(detect.moment_components(_islands(spark, sf)), ["image_id", "obj_id", "n_pix"], ["flux", "peak", "x_cen", "y_cen", "maj", "min", "pa"], 4)
