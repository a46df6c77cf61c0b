"""Image and cube operators on a pixel table ``(image_id, x, y[, chan], value[, weight])``."""

from __future__ import annotations

import math
import sys
from collections.abc import Sequence
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.bind import let
from ..functions.prefix import running_total
from ..session import cut_lineage
from ..functions.order import (MADFM_TO_SIGMA, grouped_madfm, grouped_median, grouped_quantiles, value_counts)


# ---------------------------------------------------------------- statistics

def pooled_stats(parts: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Mean and standard deviation from per-part (n, mean, std): size-weighted mean and pooled variance."""
    n, s = F.col("n"), F.col("std")
    d = parts.groupBy(*keys).agg(F.sum(n).alias("n"), (F.sum(n * F.col("mean")) / F.sum(n)).alias("mean"),
                                 F.sum(s * s * (n - 1)).alias("__ss"))
    return d.withColumn("std", F.sqrt(F.try_divide("__ss", F.col("n") - 1))).drop("__ss")


def exact_stats(pix: DataFrame, keys: Sequence[str], value: str = "value") -> DataFrame:
    return pix.groupBy(*keys).agg(F.count(value).alias("n"), F.avg(value).alias("mean"), F.stddev_samp(value).alias("std"))


def cube_stats(cube: DataFrame, keys: Sequence[str], value: str = "value") -> DataFrame:
    """Per key: rms, std (population), mean, 1 %, median, MADFM, min, max; 1 % by linear interpolation."""
    keys = list(keys)
    basic = cube.groupBy(*keys).agg(
        F.sqrt(F.avg(F.col(value) * F.col(value))).alias("rms"), F.stddev_pop(value).alias("std"), F.avg(value).alias("mean"),
        F.min(value).alias("minval"), F.max(value).alias("maxval"))
    robust = grouped_madfm(cube, keys, value, {"onepc": 0.01}).select(*keys, "onepc", "median", "madfm")
    return basic.join(robust, keys)


def good_cells(df: DataFrame, keys: Sequence[str], value: str) -> DataFrame:
    """Rows with |x| < 1e5 and |x - median| below five interquartile ranges of their key."""
    keys = list(keys)
    q = grouped_quantiles(df, keys, value, {"__q1": 0.25, "__q2": 0.5, "__q3": 0.75}).drop("n")
    j = df.join(q, keys)
    ok = (F.abs(value) < 1.0e5) & (F.abs(F.col(value) - F.col("__q2")) < 5.0 * (F.col("__q3") - F.col("__q1")))
    return j.where(ok).drop("__q1", "__q2", "__q3")


def padded_range(low: Column, high: Column, pad: float = 0.1) -> list[Column]:
    return [(low - pad * (high - low)).alias("ymin"), (high + pad * (high - low)).alias("ymax")]


def noise_range(stats: DataFrame, key: str) -> DataFrame:
    """Padded plot range per beam from the good cells of std and of the MADFM sigma.

    The lower limit compares the largest good MADFM, as the reports do.
    """
    a = good_cells(stats, [key], "std").groupBy(key).agg(F.max("std").alias("s_hi"), F.min("std").alias("s_lo"))
    b = good_cells(stats, [key], "madfm").groupBy(key).agg(F.max("madfm").alias("m_hi"))
    j = a.join(b, key)
    return j.select(key, *padded_range(F.least("s_lo", "m_hi"), F.greatest("s_hi", "m_hi")))


def psf_range(beams: DataFrame, key: str) -> DataFrame:
    """Padded range of the restoring beam axes per beam."""
    g = beams.groupBy(key).agg(F.max("bmaj").alias("hi"), F.min("bmin").alias("lo"))
    return g.select(key, *padded_range(F.col("lo"), F.col("hi")))


def image_stats(pix: DataFrame, size: tuple[int, int]) -> DataFrame:
    """Per image: peak with position, minimum, rms, median, and peak/minimum of the inner quarter."""
    bx, by = size[0] // 4, size[1] // 4
    inner = F.col("x").between(bx, 3 * bx) & F.col("y").between(by, 3 * by)
    a = pix.groupBy("image_id").agg(
        F.max_by(F.struct("value", "x", "y"), F.struct(F.col("value"), -F.col("y"), -F.col("x"))).alias("p"),
        F.min("value").alias("minval"), F.sqrt(F.avg(F.col("value") * F.col("value"))).alias("rms"),
        F.max(F.when(inner, F.col("value"))).alias("inner_max"), F.min(F.when(inner, F.col("value"))).alias("inner_min"))
    med = grouped_median(value_counts(pix, ["image_id"], "value"), ["image_id"]).drop("n")
    return a.join(med, "image_id").select("image_id", F.col("p.value").alias("maxval"), F.col("p.x").alias("max_x"),
                                          F.col("p.y").alias("max_y"), "minval", "rms", "median", "inner_max", "inner_min")


def histogram(pix: DataFrame, value: str, low: float, high: float, bins: int, keys: Sequence[str] = ()) -> DataFrame:
    """Counts per equal-width bin of [low, high]; the top edge belongs to the last bin."""
    width = (high - low) / bins
    b = F.least(F.floor((F.col(value) - low) / width), F.lit(bins - 1).cast("long"))
    d = pix.where(F.col(value).between(low, high)).groupBy(*keys, b.alias("bin")).agg(F.count(F.lit(1)).alias("n"))
    return d.withColumn("bin_low", low + F.col("bin") * width)


# ---------------------------------------------------------------- mosaicking

def primary_beam(x: Column, y: Column, ref: tuple[float, float], inc: tuple[float, float], fwhm: float) -> Column:
    """Gaussian beam gain at a pixel."""
    dx, dy = inc[0] * (x - ref[0]), inc[1] * (y - ref[1])
    off = F.asin(F.least(F.lit(1.0), F.sqrt(dx * dx + dy * dy)))
    return F.exp(-4.0 * math.log(2.0) * (off / fwhm) * (off / fwhm))


def weigh(pix: DataFrame, source: str, state: str) -> DataFrame:
    """Multiply pixels by the power of weight and beam that their state still lacks.

    ``source``: "weight_images", "beam_model" or "combined"; ``state``: "corrected",
    "inherent" or "weighted".  Uses ``weight`` and ``pb`` as needed; adds ``img``, ``wgt``.
    """
    lacks = {"corrected": 2, "inherent": 1, "weighted": 0}[state]
    w, pb = F.col("weight"), F.col("pb")
    power = F.lit(1.0) if lacks == 0 else pb if lacks == 1 else pb * pb
    if source == "weight_images":
        # the weight image carries the beam squared; an inherent image carries one power of it
        factor = {2: w, 1: F.sqrt(w), 0: F.lit(1.0)}[lacks]
        return pix.withColumn("img", F.col("value") * factor).withColumn("wgt", w)
    if source == "beam_model":
        return pix.withColumn("img", F.col("value") * power).withColumn("wgt", pb * pb)
    if source == "combined":
        factor = w * power if lacks else F.lit(1.0)
        return pix.withColumn("img", F.col("value") * factor).withColumn("wgt", w * pb * pb)
    raise ValueError(f"unknown weight source {source}")


def mosaic(weighted: DataFrame, keys: Sequence[str], cutoff: float, source: str, plane: Sequence[str] = ("image_id",)) -> DataFrame:
    """Sums of img and wgt over images per output pixel.

    NaN pixels are left out, and those below cutoff^2 of the image's largest weight
    unless the weights come from weight images.
    """
    d = weighted.where(~F.isnan("img") & ~F.isnan("wgt"))
    if source == "weight_images":
        d = d.where(F.col("wgt") >= 0)
    else:
        top = d.groupBy(*plane).agg(F.max("wgt").alias("__top"))
        d = d.join(top, list(plane)).where(F.col("wgt") >= cutoff * cutoff * F.col("__top"))
    return d.groupBy(*keys).agg(F.sum("img").alias("img"), F.sum("wgt").alias("wgt"), F.count(F.lit(1)).alias("n_images"))


def deweight(m: DataFrame) -> DataFrame:
    """Divide by the weight sum: NaN weight gives NaN, no weight zero; sensitivity is sqrt(1 / sum)."""
    v = F.when(F.isnan("wgt"), F.lit(float("nan"))).when(F.col("wgt") > 0, F.try_divide("img", "wgt")).otherwise(0.0)
    s = F.when(F.isnan("wgt"), F.lit(float("nan"))).when(F.col("wgt") > 0, F.sqrt(F.try_divide(F.lit(1.0), "wgt"))).otherwise(0.0)
    return m.withColumn("value", v).withColumn("sensitivity", s)


def reweight(m: DataFrame) -> DataFrame:
    """Inverse of :func:`deweight`."""
    nan = F.lit(float("nan"))
    v = F.when(F.isnan("wgt"), nan).when(F.col("wgt") > 0, F.col("value") * F.col("wgt")).otherwise(0.0)
    return m.withColumn("img", v)


def weight_mask(pix: DataFrame, keys: Sequence[str], cutoff: float) -> DataFrame:
    """Scale sqrt(w / max w) and a mask where it falls below the cutoff."""
    top = pix.groupBy(*keys).agg(F.max("weight").alias("__top"))
    d = pix.join(top, list(keys)).withColumn("scale", F.sqrt(F.try_divide("weight", "__top")))
    return d.withColumn("valid", F.col("scale") >= cutoff).drop("__top")


# ---------------------------------------------------------------- sliding boxes

def _row_window(keys, h):
    return Window.partitionBy(*keys, "y").orderBy("x").rangeBetween(-h, h)


def _col_window(keys, h):
    return Window.partitionBy(*keys, "x").orderBy("y").rangeBetween(-h, h)


def _fits(h: int, size: tuple[int, int]) -> Column:
    return F.col("x").between(h, size[0] - 1 - h) & F.col("y").between(h, size[1] - 1 - h)


def _with_gaps(pix: DataFrame, keys: Sequence[str], h: int) -> DataFrame:
    """Add a ``__gap`` row at every place of each column's span, widened by ``h``.

    The pass along rows must leave a value also where a pixel is missing, or the
    pass along columns would lose that row's neighbours.  A union needs no join;
    gap rows carry nothing and are dropped after the second pass.
    """
    span = pix.groupBy(*keys, "x").agg((F.min("y") - h).alias("__lo"), (F.max("y") + h).alias("__hi"))
    gaps = span.select(*keys, "x", F.explode(F.sequence("__lo", "__hi")).alias("y"), F.lit(True).alias("__gap"))
    return pix.withColumn("__gap", F.lit(False)).unionByName(gaps, allowMissingColumns=True)


def box_sums(pix: DataFrame, keys: Sequence[str], h: int, exprs: dict[str, Column]) -> DataFrame:
    """Sums over the (2h+1)^2 box around each pixel, along rows then columns.

    A window holds one image row or column; missing pixels add nothing.
    """
    d = _with_gaps(pix, keys, h)
    for n, c in exprs.items():
        d = d.withColumn(f"__s_{n}", F.when(F.col("__gap"), 0.0).otherwise(c))
    rest = [c for c in d.columns if not c.startswith("__s_")]
    total = lambda n, w: F.sum(f"__s_{n}").over(w)
    # after the first pass each place counts once, through its gap row
    d = d.select(*rest, *[F.when(F.col("__gap"), total(n, _row_window(keys, h))).otherwise(0.0).alias(f"__s_{n}") for n in exprs])
    d = d.select(*rest, *[total(n, _col_window(keys, h)).alias(f"__s_{n}") for n in exprs])
    d = d.where("NOT __gap").drop("__gap")
    for n in exprs:
        d = d.withColumnRenamed(f"__s_{n}", n)
    return d


def sliding_stats(pix: DataFrame, keys: Sequence[str], h: int, size: tuple[int, int], robust: bool) -> DataFrame:
    """Box ``middle`` and ``spread``: mean/std or median/MADFM sigma; zero where the box leaves the image.

    Pixels with ``valid`` false do not count. Mean and std come from sums of the differences from
    the image's mean, so that a large level of the whole image costs no digits.
    """
    use = F.col("valid") if "valid" in pix.columns else F.lit(True)
    if not robust:
        finite = F.abs("value") < float("inf")
        level = pix.where(use & finite).groupBy(*keys).agg(F.avg("value").alias("__level"))
        pix = pix.join(cut_lineage(level), list(keys), "left").withColumn("__level", F.coalesce("__level", F.lit(0.0)))
        v = F.when(use, F.col("value") - F.col("__level"))
        d = box_sums(pix, keys, h, {"bn": F.when(use, 1.0).otherwise(0.0), "bs": F.coalesce(v, F.lit(0.0)), "bq": F.coalesce(v * v, F.lit(0.0))})
        mean = F.try_divide("bs", "bn")
        var = F.try_divide(F.col("bq") - F.col("bs") * mean, F.col("bn") - 1)
        middle, spread = F.col("__level") + mean, F.sqrt(F.greatest(var, F.lit(0.0)))
        d = d.withColumn("middle", middle).withColumn("spread", spread).drop("bn", "bs", "bq", "__level")
    else:
        # lists hold at most one box of pixels
        d = _with_gaps(pix, keys, h)
        d = d.withColumn("__l", F.collect_list(F.when(~F.col("__gap") & use, F.col("value"))).over(_row_window(keys, h)))
        # several rows share a place, so a list is taken from one row per place only
        d = d.withColumn("__l", F.when(F.col("__gap"), F.col("__l")))
        d = d.withColumn("__l", F.flatten(F.collect_list("__l").over(_col_window(keys, h)))).where("NOT __gap").drop("__gap")

        def median(a):
            s, n = F.array_sort(a), F.size(a)
            return (F.try_element_at(s, F.floor((n - 1) / 2).cast("int") + 1) + F.try_element_at(s, F.floor(n / 2).cast("int") + 1)) / 2

        both = let(F.col("__l"), lambda a: let(median(a), lambda m: F.struct(
            m.alias("middle"), (median(F.transform(a, lambda x: F.abs(x - m))) / MADFM_TO_SIGMA).alias("spread"))))
        d = d.withColumn("__b", both)
        d = d.withColumn("middle", F.col("__b.middle")).withColumn("spread", F.col("__b.spread")).drop("__l", "__b")
    fit = _fits(h, size)
    for c in ("middle", "spread"):
        d = d.withColumn(c, F.when(fit, F.coalesce(c, F.lit(0.0))).otherwise(0.0))
    return d


def signal_to_noise(d: DataFrame) -> DataFrame:
    """(value - middle) / spread; zero where the spread is not positive or the pixel is masked."""
    use = F.col("valid") if "valid" in d.columns else F.lit(True)
    return d.withColumn("snr", F.when(use & (F.col("spread") > 0), F.try_divide(F.col("value") - F.col("middle"), F.col("spread"))).otherwise(0.0))


def sliding_spectrum(spec: DataFrame, keys: Sequence[str], h: int, n_chan: int) -> DataFrame:
    """1-D box along the channel of each spectrum; a window holds one spectrum."""
    w = Window.partitionBy(*keys).orderBy("chan").rangeBetween(-h, h)
    fit = F.col("chan").between(h, n_chan - 1 - h)
    return spec.withColumn("middle", F.when(fit, F.avg("value").over(w)).otherwise(0.0)).withColumn(
        "spread", F.when(fit, F.coalesce(F.stddev_samp("value").over(w), F.lit(0.0))).otherwise(0.0))


def curvature(pix: DataFrame, keys: Sequence[str]) -> DataFrame:
    """3x3 kernel of ones with -8 in the centre; outside the image counts as zero."""
    d = box_sums(pix, keys, 1, {"b3": F.col("value")})
    return d.withColumn("curvature", F.col("b3") - 9.0 * F.col("value")).drop("b3")


# ---------------------------------------------------------------- extraction

def cubelets(cube: DataFrame, boxes: DataFrame, pad_xy: int, pad_chan: int, size: tuple[int, int, int], tile: int = 64) -> DataFrame:
    """Pixels in each object's padded box, clipped to the image.  Boxes are cut into tiles for an equi join."""
    def lim(c, pad, top):
        return (F.greatest(F.col(f"{c}_min") - pad, F.lit(0)).alias(f"__{c}0"), F.least(F.col(f"{c}_max") + pad, F.lit(top - 1)).alias(f"__{c}1"))

    b = boxes.select("image_id", "obj_id", *lim("x", pad_xy, size[0]), *lim("y", pad_xy, size[1]), *lim("chan", pad_chan, size[2]))
    tiles = lambda c: F.explode(F.sequence(F.floor(F.col(f"__{c}0") / tile), F.floor(F.col(f"__{c}1") / tile)))
    b = b.withColumn("__tx", tiles("x")).withColumn("__ty", tiles("y"))
    p = cube.withColumn("__tx", F.floor(F.col("x") / tile)).withColumn("__ty", F.floor(F.col("y") / tile))
    j = p.join(b, ["image_id", "__tx", "__ty"])
    for c in ("x", "y", "chan"):
        j = j.where(F.col(c).between(F.col(f"__{c}0"), F.col(f"__{c}1")))
    return j.select("obj_id", *cube.columns)


def moments(voxels: DataFrame, dv: float) -> DataFrame:
    """Moment 0, 1 and 2 per (object, x, y) over detected voxels with velocity ``v``; null unless mom0 > 0.

    The second moment uses sums about the first, in one more pass.
    """
    keys = ["obj_id", "x", "y"]
    m = voxels.groupBy(*keys).agg(F.sum(F.col("value") * dv).alias("mom0"), F.sum(F.col("value") * F.col("v") * dv).alias("__a"))
    m = m.withColumn("mom1", F.when(F.col("mom0") > 0, F.try_divide("__a", "mom0"))).drop("__a")
    d = F.col("v") - F.col("mom1")
    s = voxels.join(m, keys).groupBy(*keys).agg(F.sum(F.col("value") * d * d * dv).alias("__b"))
    return m.join(s, keys).withColumn("mom2", F.when(F.col("mom0") > 0, F.sqrt(F.greatest(F.try_divide("__b", "mom0"), F.lit(0.0))))).drop("__b")


def object_spectrum(cube: DataFrame, mask: DataFrame, beam_factor: float) -> DataFrame:
    """Sum over an object's pixels per channel, over the beam factor."""
    j = cube.join(mask.select("image_id", "x", "y", "obj_id"), ["image_id", "x", "y"])
    return j.groupBy("obj_id", "chan").agg((F.sum("value") / beam_factor).alias("flux"), F.count(F.lit(1)).alias("n_pix"))


def noise_spectrum(boxed: DataFrame, robust: bool) -> DataFrame:
    """Noise per (object, channel) over box pixels: MADFM sigma, or rms."""
    if robust:
        return grouped_madfm(boxed, ["obj_id", "chan"], "value").select("obj_id", "chan", F.col("sigma").alias("noise"))
    return boxed.groupBy("obj_id", "chan").agg(F.stddev_samp("value").alias("noise"))


# ---------------------------------------------------------------- cubes

def stack(images: DataFrame, name: str, plane: Sequence[str]) -> DataFrame:
    """Cube from per-channel images: the channel is the place of the image's name in order.

    Names are one row per image; they are numbered on their own and joined back.
    """
    names = images.select(name).distinct()
    numbered = running_total(names, [name], F.lit(1), "chan").withColumn("chan", F.col("chan") - 1)
    return images.join(numbered.withColumn("chan", F.col("chan").cast("long")), name)


def slice_cube(cube: DataFrame, lo: int, hi: int) -> DataFrame:
    return cube.where(F.col("chan").between(lo, hi)).withColumn("chan", F.col("chan") - lo)


def merge_cubes(cubes: Sequence[tuple[DataFrame, int]]) -> DataFrame:
    """Put cubes behind each other along the channel; each comes with its number of channels."""
    out, start = [], 0
    for c, n in cubes:
        out.append(c.withColumn("chan", F.col("chan") + start))
        start += n
    return reduce(DataFrame.unionByName, out)


def scale(pix: DataFrame, factor: float) -> DataFrame:
    return pix.withColumn("value", F.col("value") * factor)


def nan_to_zero(pix: DataFrame) -> DataFrame:
    return pix.withColumn("value", F.nanvl("value", F.lit(0.0)))


def render_components(comps: DataFrame) -> DataFrame:
    """Gaussian components (x0, y0, flux, sigma in pixels) as summed pixels.

    Each component paints its own box, out to where it falls below the machine
    epsilon of its peak, which no sum of doubles can see; nothing else is produced.
    """
    reach = math.sqrt(-2.0 * math.log(sys.float_info.epsilon))
    half = F.ceil(F.col("sigma") * reach).cast("long")
    d = comps.withColumn("__h", half).withColumn("__cx", F.floor(F.col("x0") + 0.5).cast("long")).withColumn("__cy", F.floor(F.col("y0") + 0.5).cast("long"))
    around = lambda c: F.explode(F.sequence(F.col(c) - F.col("__h"), F.col(c) + F.col("__h")))
    d = d.withColumn("x", around("__cx")).withColumn("y", around("__cy"))
    r2 = (F.col("x") - F.col("x0")) * (F.col("x") - F.col("x0")) + (F.col("y") - F.col("y0")) * (F.col("y") - F.col("y0"))
    s2 = F.col("sigma") * F.col("sigma")
    return d.withColumn("value", F.col("flux") / (2 * math.pi * s2) * F.exp(-r2 / (2.0 * s2)))


FWHM = 2.0 * math.sqrt(2.0 * math.log(2.0))  # full width at half maximum, in sigmas
#: Components that one task paints on one tile, about; a tile with more has several tasks.
PAINTED = 4_096
#: Samples of a component that are held at once, about.
SAMPLES = 1 << 16


def _line_share(t0, t1, sigma):
    """Share of a line's Gaussian profile between two distances from its centre; none where they are out of order."""
    cdf = np.vectorize(lambda t: 0.5 * math.erf(t / sigma / math.sqrt(2.0)), otypes=[float])
    share = np.zeros(t0.shape)
    on = t1 > t0
    if on.any():
        share[on] = cdf(t1[on]) - cdf(t0[on])
    return share


def _shares(x0, y0, major, minor, pa, xs, ys, steps):
    """Share of a component's flux in each pixel (rows y, columns x): Simpson's rule over the pixel, along a line if the minor axis vanishes."""
    ux, uy = -math.sin(pa), math.cos(pa)  # of the major axis, from +y towards -x
    if major <= 0.0:
        return ((ys == math.floor(y0 + 0.5))[:, None] & (xs == math.floor(x0 + 0.5))[None, :]).astype(float)
    if minor < 1e-3:  # fixed value: narrower ones are lines
        lo, hi = np.full((len(ys), len(xs)), -np.inf), np.full((len(ys), len(xs)), np.inf)
        for d, u in ((xs[None, :] - x0, ux), (ys[:, None] - y0, uy)):
            if abs(u) < 1e-12:  # the line runs along this side: all of it or nothing
                hi = np.where((d >= -0.5) & (d < 0.5), hi, -np.inf)
            else:
                ends = (d - 0.5) / u, (d + 0.5) / u
                lo, hi = np.maximum(lo, np.minimum(*ends)), np.minimum(hi, np.maximum(*ends))
        return _line_share(lo, hi, major / FWHM)
    # nodes on the edge of two pixels are sampled once; a block of pixel rows bounds the samples held
    weight = np.where(np.arange(steps + 1) % 2 == 1, 4.0, 2.0) / (3.0 * steps)
    weight[[0, -1]] /= 2.0
    major, minor = major / FWHM, minor / FWHM
    dx = xs[0] - 0.5 - x0 + np.arange(len(xs) * steps + 1) / steps
    dy = ys[0] - 0.5 - y0 + np.arange(len(ys) * steps + 1) / steps
    scale = math.sqrt(0.5)
    along_x, across_x, along_y, across_y = dx * (ux * scale / major), dx * (uy * scale / minor), dy * (uy * scale / major), dy * (-ux * scale / minor)
    out = np.empty((len(ys), len(xs)))
    block = max(1, SAMPLES // (len(dx) * steps))
    for lo in range(0, len(ys), block):
        hi = min(len(ys), lo + block)
        part = slice(lo * steps, hi * steps + 1)
        g = np.add.outer(across_y[part], across_x)
        g *= g
        t = np.add.outer(along_y[part], along_x)
        t *= t
        g += t
        np.negative(g, out=g)
        np.exp(g, out=g)
        rows = (g[:, :-1].reshape(-1, steps) @ weight[:-1]).reshape(len(g), len(xs)) + weight[-1] * g[:, steps::steps]
        out[lo:hi] = np.einsum("isx,s->ix", rows[:-1].reshape(hi - lo, steps, len(xs)), weight[:-1]) + weight[-1] * rows[steps::steps]
    return out / (2.0 * math.pi * major * minor)


def paint_components(comps: DataFrame, shape: tuple[int, int], freqs: Sequence[float], term: int = 0, steps: int = 32, tile: int = 64) -> DataFrame:
    """Sky components as summed pixels (x, y, chan, value) of an image ``shape`` (width, height) with channels at ``freqs``.

    ``comps``: x0, y0, full widths ``major`` and ``minor`` in pixels (major 0: a point; minor 0: a line), ``pa`` in radians
    from +y towards -x, ``flux`` at ``freq0`` and the spectral index ``alpha`` (null: constant). ``term`` is the Taylor term
    0, 1 or 2. A component whose centre is off the image is not painted; nulls in position, flux or widths neither. Shapes are integrated
    over the pixels at ``steps`` (even) intervals a side. A task paints the components of one tile on one array, so pixels are summed before they move.
    """
    if term not in (0, 1, 2) or steps % 2:
        raise ValueError("term must be 0, 1 or 2 and steps even")
    width, height = shape
    alpha = F.coalesce(F.col("alpha").cast("double"), F.lit(0.0))
    taylor = (F.lit(1.0), alpha, 0.5 * alpha * (alpha - 1.0))[term]
    d = comps.where((F.col("x0") >= 0) & (F.col("x0") <= width - 1) & (F.col("y0") >= 0) & (F.col("y0") <= height - 1)).select(
        *[F.col(c).cast("double").alias(c) for c in ("x0", "y0", "pa")], F.greatest("major", "minor").cast("double").alias("major"),
        F.least("major", "minor").cast("double").alias("minor"),
        F.array(*[F.col("flux") * taylor * F.pow(F.lit(float(f)) / F.col("freq0"), alpha) for f in freqs]).alias("flux")).na.drop()
    reach = math.sqrt(-2.0 * math.log(sys.float_info.epsilon)) / FWHM
    d = d.withColumn("h", F.ceil(F.col("major") * reach).cast("int"))
    for t, c, n in (("tx", "x0", width), ("ty", "y0", height)):
        mid = F.floor(F.col(c) + 0.5).cast("int")
        first, last = F.greatest(F.lit(0), mid - F.col("h")), F.least(F.lit(n - 1), mid + F.col("h"))
        d = d.withColumn(t, F.explode(F.sequence(F.floor(first / tile).cast("int"), F.floor(last / tile).cast("int"))))
    crowd = d.groupBy("tx", "ty").agg(F.ceil(F.count(F.lit(1)) / PAINTED).alias("n")).where("n > 1")
    d = d.join(crowd, ["tx", "ty"], "left").withColumn("salt", F.pmod(F.xxhash64("x0", "y0", "flux"), F.coalesce("n", F.lit(1)))).drop("n")

    def paint(batches):
        now, image, seen = None, None, None

        def told():
            y, x = np.nonzero(seen)
            for chan in range(len(freqs)):
                yield pa.RecordBatch.from_arrays([pa.array(x + now[0] * tile), pa.array(y + now[1] * tile), pa.array(np.full(len(x), chan, np.int32)),
                                                  pa.array(image[chan, y, x])], ["x", "y", "chan", "value"])

        for batch in batches:
            for r in batch.to_pylist():
                if (r["tx"], r["ty"], r["salt"]) != now:
                    if now is not None:
                        yield from told()
                    now, image, seen = (r["tx"], r["ty"], r["salt"]), np.zeros((len(freqs), tile, tile)), np.zeros((tile, tile), bool)
                box = []
                for mid, t, n in ((math.floor(r["x0"] + 0.5), now[0], width), (math.floor(r["y0"] + 0.5), now[1], height)):
                    box.append(np.arange(max(0, mid - r["h"], t * tile), min(n - 1, mid + r["h"], t * tile + tile - 1) + 1))
                xs, ys = box
                at = np.ix_(ys - now[1] * tile, xs - now[0] * tile)
                share = _shares(r["x0"], r["y0"], r["major"], r["minor"], r["pa"], xs, ys, steps)
                seen[at] = True
                for chan, flux in enumerate(r["flux"]):
                    image[chan][at] += flux * share
        if now is not None:
            yield from told()

    painted = d.repartition("tx", "ty", "salt").sortWithinPartitions("tx", "ty", "salt").mapInArrow(paint, "x long, y long, chan int, value double")
    return sum_images(painted, ["x", "y", "chan"])


def sum_images(pix: DataFrame, keys: Sequence[str]) -> DataFrame:
    return pix.groupBy(*keys).agg(F.sum("value").alias("value"))


def tables_for_channels(tables: DataFrame, beam: int, lo: int, hi: int) -> DataFrame:
    """Tables of a beam that overlap channels lo..hi, with the overlap in their own numbering.

    One row per table; channels are counted up in frequency order.
    """
    d = running_total(tables.where(F.col("beam") == beam), ["freq", "name"], F.col("n_chan"), "__b").withColumn("__b", F.col("__b") - F.col("n_chan"))
    d = d.where((F.col("n_chan") + F.col("__b") >= lo) & (F.col("__b") < hi))
    return d.select("name", F.greatest(F.lit(1), lo - F.col("__b")).alias("first"), F.least(F.col("n_chan"), hi - F.col("__b")).alias("last"))


def beam_log(cube_beams: DataFrame) -> DataFrame:
    """Restoring beam per image and channel; a cube with one beam repeats it, one without gives zero."""
    return cube_beams.select("name", "chan", *[F.coalesce(c, F.first(c, True).over(Window.partitionBy("name")), F.lit(0.0)).alias(c)
                                               for c in ("bmaj", "bmin", "bpa")])


def mask_lookup(sources: DataFrame, mask: DataFrame, threshold: float, keys: Sequence[str] = ()) -> DataFrame:
    """Is the mask (or weight) pixel under each source above the threshold?  Off the image: no.  ``keys`` tell several images apart."""
    j = sources.join(mask.select(*keys, "x", "y", F.col("value").alias("__m")), [*keys, "x", "y"], "left")
    return j.withColumn("is_good", F.coalesce(F.col("__m") > threshold, F.lit(False))).drop("__m")
