"""Source detection: thresholds, connected objects, object parameters."""

from __future__ import annotations

import math
from collections.abc import Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.order import grouped_madfm
from ..session import cut_lineage

ROW = 1 << 24  # columns of a row and rows of a channel in a voxel id; channels then go up to 2^15


def thresholds(pix: DataFrame, keys: Sequence[str], cut: float, robust: bool) -> DataFrame:
    """Per key: ``threshold`` = middle + cut * spread."""
    if robust:
        st = grouped_madfm(pix, keys, "value").select(*keys, F.col("median").alias("m"), F.col("sigma").alias("s"))
    else:
        st = pix.groupBy(*keys).agg(F.avg("value").alias("m"), F.stddev_samp("value").alias("s"))
    return st.select(*keys, (F.col("m") + cut * F.col("s")).alias("threshold"))


def detect(pix: DataFrame, keys: Sequence[str], levels: DataFrame) -> DataFrame:
    """Pixels above their key's threshold."""
    return pix.join(levels, list(keys)).where(F.col("value") > F.col("threshold"))


def _unite(n: int, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Least node of the component of each of ``n`` nodes under the edges (a, b), by pointer jumping."""
    root = np.arange(n)
    while True:
        ra, rb = root[a], root[b]
        open_ = ra != rb
        if not open_.any():
            return root
        a, b, ra, rb = a[open_], b[open_], ra[open_], rb[open_]
        np.minimum.at(root, np.maximum(ra, rb), np.minimum(ra, rb))
        while True:
            up = root[root]
            if np.array_equal(up, root):
                break
            root = up


def label_tile(x: np.ndarray, y: np.ndarray, c: np.ndarray, reach: int, chan_reach: int) -> np.ndarray:
    """For each voxel the position of the first voxel (by channel, row, column) of its object.

    Voxels of a row (y, c) that follow within ``reach`` form a run, and runs are united with the runs
    of the rows within reach: in the expanded order of row and column their partners are one stretch.
    """
    x, y, c = x - x.min(), y - y.min(), c - c.min()
    wide, high = int(x.max()) + 2 * reach + 2, int(y.max()) + 2 * reach + 2  # room, so that a stretch never leaves its row
    row = c * high + y
    at = row * wide + x
    order = np.argsort(at, kind="stable")
    at, row = at[order], row[order]
    starts = np.flatnonzero(np.concatenate(([True], (row[1:] != row[:-1]) | (at[1:] - at[:-1] > reach))))
    first, last = at[starts], at[np.append(starts[1:], len(at)) - 1]
    pairs_a, pairs_b = [], []
    for dc in range(chan_reach + 1):
        for dy in range(-reach if dc else 1, reach + 1):
            shift = (dc * high + dy) * wide
            lo, hi = np.searchsorted(last, first + shift - reach), np.searchsorted(first, last + shift + reach, "right")
            n = np.maximum(hi - lo, 0)
            a = np.repeat(np.arange(len(starts)), n)
            pairs_a.append(a)
            pairs_b.append(np.arange(len(a)) - np.repeat(np.cumsum(n) - n, n) + np.repeat(lo, n))
    root = _unite(len(starts), np.concatenate(pairs_a), np.concatenate(pairs_b)) if pairs_a else np.arange(len(starts))
    lengths = np.diff(np.append(starts, len(at)))
    out = np.empty(len(at), np.int64)
    out[order] = np.repeat(order[starts[root]], lengths)
    return out


def voxel_id(x: Column, y: Column, chan: Column) -> Column:
    """A number that ascends by channel, row and column; a pixel of an image without channels is y * ROW + x."""
    return (chan * ROW + y) * ROW + x


def _star(edges: DataFrame, key: str, large: bool) -> DataFrame:
    """One star step on directed edges (u, v): connect neighbours to the smallest one."""
    both = edges.select(key, "u", "v").unionByName(edges.select(key, F.col("v").alias("u"), F.col("u").alias("v")))
    if large:
        low = both.groupBy(key, "u").agg(F.least(F.min("v"), F.first("u")).alias("m"))
        out = both.where(F.col("v") > F.col("u")).join(low, [key, "u"]).select(key, F.col("v").alias("u"), F.col("m").alias("v"))
    else:
        down = both.where(F.col("v") < F.col("u"))
        low = down.groupBy(key, "u").agg(F.min("v").alias("m"))
        j = down.join(low, [key, "u"])
        out = j.select(key, F.col("v").alias("u"), F.col("m").alias("v")).unionByName(j.select(key, "u", F.col("m").alias("v")))
    return out.where(F.col("u") != F.col("v")).distinct()


def components(edges: DataFrame, key: str) -> DataFrame:
    """(key, u, v): the smallest node ``v`` of each node's component, by alternating star steps.

    The number of rounds grows with the logarithm of the component size.  Minima
    are partial aggregates and edges are kept distinct, so a large component is
    no hot group.  Each round is one table in the checkpoint folder, compared with the
    one before by its count and the sum of its rows' hashes.
    """
    cur, seen = edges.where(F.col("u") != F.col("v")).distinct(), None
    while True:
        cur = cut_lineage(_star(_star(cur, key, True), key, False))
        edge = F.xxhash64(key, F.greatest("u", "v"), F.least("u", "v")).cast("decimal(38,0)")
        now = tuple(cur.agg(F.count(F.lit(1)), F.sum(edge)).first())
        if now == seen:  # a fixed point is a set of stars
            break
        seen = now
    # every edge points down to the centre of its star
    hi, lo = F.greatest("u", "v"), F.least("u", "v")
    return cur.select(key, hi.alias("u"), lo.alias("v")).distinct()


def label_objects(det: DataFrame, reach: int = 1, tile: int = 256, chan: str | None = None, chan_reach: int = 1, chan_tile: int = 64) -> DataFrame:
    """Add ``obj_id``: the smallest voxel id (:func:`voxel_id`) of the connected object, per image.

    ``reach`` 1 means touching, 3 means within 3 pixels on either axis; ``chan`` names a spectral axis, on
    which ``chan_reach`` counts. Without it objects have two axes.

    Two levels: voxels are labelled inside tiles that hold their own voxels and a halo of ``reach`` beyond
    the upper faces (every pair within reach shares one of them), then the labels that a halo voxel has in
    its tiles are united across tiles.  A tile is bounded, and only voxels near faces are copied.
    """
    if tile < reach or chan_tile < chan_reach:
        raise ValueError("a tile must be at least as wide as the reach")
    z = F.col(chan).cast("long") if chan else F.lit(0).cast("long")
    vox = det.select(F.col("image_id").cast("long").alias("image_id"), F.col("x").cast("long").alias("x"), F.col("y").cast("long").alias("y"), z.alias("chan"))
    both = lambda c, size, r: F.array_distinct(F.array(F.floor(F.col(c) / size), F.floor((F.col(c) - r) / size)))
    homes = vox.select("*", both("x", tile, reach).alias("tx"), both("y", tile, reach).alias("ty"), both("chan", chan_tile, chan_reach if chan else 0).alias("tz"))
    copies = homes.select("image_id", "x", "y", "chan", (F.size("tx") * F.size("ty") * F.size("tz") > 1).alias("shared"), F.col("tx")[0].alias("hx"), F.col("ty")[0].alias("hy"),
                          F.col("tz")[0].alias("hz"), F.explode("tx").alias("tx"), "ty", "tz").withColumn("ty", F.explode("ty")).withColumn("tz", F.explode("tz"))
    tiled = copies.select("image_id", "x", "y", "chan", "shared", ((F.col("tx") == F.col("hx")) & (F.col("ty") == F.col("hy")) & (F.col("tz") == F.col("hz"))).alias("home"), "tx", "ty", "tz")

    def label(t: pa.Table) -> pa.Table:
        x, y, c = (t.column(n).to_numpy() for n in ("x", "y", "chan"))
        root = label_tile(x, y, c, reach, chan_reach if chan else 0)
        ids = (c * ROW + y) * ROW + x
        return t.select(["image_id", "x", "y", "chan", "shared", "home"]).append_column("label", pa.array(ids[root]))

    local = cut_lineage(tiled.groupBy("image_id", "tx", "ty", "tz").applyInArrow(label, "image_id long, x long, y long, chan long, shared boolean, home boolean, label long"))
    ends = local.where("shared").groupBy("image_id", "x", "y", "chan").agg(F.min("label").alias("v"), F.collect_set("label").alias("all"))  # at most 8 tiles
    edges = ends.select("image_id", F.explode("all").alias("u"), "v").where("u <> v").distinct()
    roots = components(edges, "image_id")
    out = local.where("home").join(roots.withColumnRenamed("u", "label"), ["image_id", "label"], "left")
    return out.select("image_id", "x", "y", *([F.col("chan").alias(chan)] if chan else []), F.coalesce("v", "label").alias("obj_id"))


def keep_large(labelled: DataFrame, min_pix: int) -> DataFrame:
    """Drop objects with fewer pixels, after the merge."""
    keep = labelled.groupBy("image_id", "obj_id").agg(F.count(F.lit(1)).alias("n")).where(F.col("n") >= min_pix)
    return labelled.join(keep.select("image_id", "obj_id"), ["image_id", "obj_id"], "left_semi")


def object_sizes(labelled: DataFrame, chan: str = "chan") -> DataFrame:
    """Per object: ``n_vox``, ``n_pix`` (positions on the sky) and ``n_chan`` (channels).

    Positions and channels are counted after a grouping of their own, so that no distinct count
    multiplies the voxels and no object is one task.
    """
    obj = ["image_id", "obj_id"]
    sky = labelled.groupBy(*obj, "x", "y").agg(F.count(F.lit(1)).alias("n")).groupBy(*obj).agg(F.sum("n").alias("n_vox"), F.count(F.lit(1)).alias("n_pix"))
    spectral = labelled.groupBy(*obj, chan).agg(F.count(F.lit(1)).alias("n")).groupBy(*obj).agg(F.count(F.lit(1)).alias("n_chan"))
    return sky.join(spectral, obj)


def keep_objects(labelled: DataFrame, min_pix: int = 2, min_chan: int = 3, min_vox: int = 0, max_pix: int = -1, max_chan: int = -1, max_vox: int = -1, chan: str = "chan") -> DataFrame:
    """Objects within the size limits, after the merge.

    At least ``min_pix`` + ``min_chan`` + 1 voxels are asked for, more if ``min_vox`` says so. A negative
    upper limit is none.
    """
    least = {"n_pix": min_pix, "n_chan": min_chan, "n_vox": max(min_vox, min_pix + min_chan + 1)}
    most = {"n_pix": max_pix, "n_chan": max_chan, "n_vox": max_vox}
    ok = F.lit(True)
    for c in least:
        ok = ok & (F.col(c) >= least[c])
        if most[c] >= 0:
            ok = ok & (F.col(c) <= most[c])
    return labelled.join(object_sizes(labelled, chan).where(ok).select("image_id", "obj_id"), ["image_id", "obj_id"], "left_semi")


def object_parameters(obj_pix: DataFrame) -> DataFrame:
    """Per object: bounds, pixel count, centroids, integrated and peak flux with position."""
    v = F.col("value")
    g = obj_pix.groupBy("image_id", "obj_id").agg(
        F.count(F.lit(1)).alias("n_pix"), F.min("x").alias("x_min"), F.max("x").alias("x_max"), F.min("y").alias("y_min"), F.max("y").alias("y_max"),
        F.avg("x").alias("x_mean"), F.avg("y").alias("y_mean"), F.try_divide(F.sum(F.col("x") * v), F.sum(v)).alias("x_cen"),
        F.try_divide(F.sum(F.col("y") * v), F.sum(v)).alias("y_cen"), F.sum(v).alias("flux_sum"),
        F.max_by(F.struct("value", "x", "y"), F.struct(v, -F.col("y"), -F.col("x"))).alias("p"))
    return g.select("*", F.col("p.value").alias("flux_peak"), F.col("p.x").alias("x_peak"), F.col("p.y").alias("y_peak")).drop("p")


def _finite(c: Column) -> Column:
    return F.when(~F.isnan(c) & (F.abs(c) < 1e6), c)


def island_statistics(obj_pix: DataFrame) -> DataFrame:
    """Per object: mean ``background`` and ``noise`` under it (finite, below 1e6), and residual statistics."""
    r = F.col("residual")
    return obj_pix.groupBy("image_id", "obj_id").agg(
        F.coalesce(F.avg(_finite(F.col("background"))), F.lit(0.0)).alias("background"),
        F.coalesce(F.avg(_finite(F.col("noise"))), F.lit(0.0)).alias("noise"),
        F.max(r).alias("res_max"), F.min(r).alias("res_min"), F.avg(r).alias("res_mean"),
        F.stddev_samp(r).alias("res_std"), F.sqrt(F.avg(r * r)).alias("res_rms"))


def moment_components(obj_pix: DataFrame) -> DataFrame:
    """Component estimate per island: flux-weighted centroid, and axes (FWHM) and angle from second moments.

    Central moments come from one set of sums about the island's first pixel.
    """
    first = obj_pix.groupBy("image_id", "obj_id").agg(F.min("x").alias("__x0"), F.min("y").alias("__y0"))
    d = obj_pix.join(first, ["image_id", "obj_id"])
    x, y, v = F.col("x") - F.col("__x0"), F.col("y") - F.col("__y0"), F.col("value")
    s = d.groupBy("image_id", "obj_id", "__x0", "__y0").agg(
        F.sum(v).alias("flux"), F.max(v).alias("peak"), F.count(F.lit(1)).alias("n_pix"), F.sum(v * x).alias("sx"), F.sum(v * y).alias("sy"),
        F.sum(v * x * x).alias("sxx"), F.sum(v * y * y).alias("syy"), F.sum(v * x * y).alias("sxy"))
    mx, my = F.try_divide("sx", "flux"), F.try_divide("sy", "flux")
    s = s.withColumn("mx", mx).withColumn("my", my)
    s = s.select("image_id", "obj_id", "n_pix", "flux", "peak", (F.col("mx") + F.col("__x0")).alias("x_cen"), (F.col("my") + F.col("__y0")).alias("y_cen"),
                 (F.try_divide("sxx", "flux") - F.col("mx") * F.col("mx")).alias("cxx"), (F.try_divide("syy", "flux") - F.col("my") * F.col("my")).alias("cyy"),
                 (F.try_divide("sxy", "flux") - F.col("mx") * F.col("my")).alias("cxy"))
    mid, half = (F.col("cxx") + F.col("cyy")) / 2, F.sqrt(((F.col("cxx") - F.col("cyy")) / 2) ** 2 + F.col("cxy") * F.col("cxy"))
    to_fwhm = 2.0 * math.sqrt(2.0 * math.log(2.0))
    axis = lambda e: to_fwhm * F.sqrt(F.greatest(e, F.lit(0.0)))
    angle = F.when(half > 1e-9, F.degrees(0.5 * F.atan2(2.0 * F.col("cxy"), F.col("cxx") - F.col("cyy")))).otherwise(0.0)
    return s.select("image_id", "obj_id", "n_pix", "flux", "peak", "x_cen", "y_cen", axis(mid + half).alias("maj"),
                    axis(mid - half).alias("min"), angle.alias("pa"))
