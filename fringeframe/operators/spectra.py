"""Delays, Faraday synthesis, line parameters and monitors: work inside one spectrum."""

from __future__ import annotations

import math
from collections.abc import Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.bind import let

TURN = 2 * math.pi
UNWRAP = 1.5 * math.pi  # fixed value: phase step taken for a wrap


# ---------------------------------------------------------------- delays

def unwrapped_phase(spec: DataFrame, keys: Sequence[str], order: str, phase: str) -> DataFrame:
    """Add ``unwrapped`` along ``order``; a window holds one spectrum."""
    w = Window.partitionBy(*keys).orderBy(order)
    jump = F.col(phase) - F.lag(phase).over(w)
    d = spec.withColumn("__t", F.when(jump >= UNWRAP, -1).when(jump <= -UNWRAP, 1).otherwise(0))
    return d.withColumn("unwrapped", F.col(phase) + F.sum("__t").over(w) * TURN).drop("__t")


def delay_fit(phases: Column, resolution: float) -> Column:
    """Delay from the slope of unwrapped phase against channel, as one fold over the array.

    NaN phases are left out of the sums while the divisor stays the array length.
    """
    n = F.size(phases)
    d0 = F.lit(0.0)
    init = F.struct(F.lit(None).cast("double").alias("prev"), d0.alias("turn"), d0.alias("i"), d0.alias("x"), d0.alias("y"),
                    d0.alias("xx"), d0.alias("xy"), d0.alias("yy"))

    def step(a, p):
        jump = p - a["prev"]
        turn = a["turn"] + F.when(jump >= UNWRAP, -TURN).when(jump <= -UNWRAP, TURN).otherwise(0.0)
        add = F.struct(p.alias("prev"), turn.alias("turn"), (a["i"] + 1.0).alias("i"), (a["x"] + a["i"]).alias("x"), (a["y"] + p + turn).alias("y"),
                       (a["xx"] + a["i"] * a["i"]).alias("xx"), (a["xy"] + a["i"] * (p + turn)).alias("xy"), (a["yy"] + (p + turn) * (p + turn)).alias("yy"))
        return F.when(F.isnan(p), a.withField("i", a["i"] + 1.0)).otherwise(add)

    def finish(a):
        cov, var = a["xy"] / n - a["x"] / n * (a["y"] / n), a["xx"] / n - a["x"] / n * (a["x"] / n)
        vy = a["yy"] / n - a["y"] / n * (a["y"] / n)
        return F.when(vy > 0, F.try_divide(cov, var) / (TURN * resolution)).otherwise(0.0)

    return F.aggregate(phases, init, step, finish)


def phases(re: Column, im: Column) -> Column:
    return F.zip_with(re, im, lambda a, b: F.atan2(b, a))


#: Complex numbers that one matrix product holds, about.
_PRODUCT = 1 << 21


def _lag_sums(v: np.ndarray) -> np.ndarray:
    """Sums over channels i of v[row, i] exp(-2 pi i k / n), with lag k = 0 in the middle of each row.

    Channels i = b j1 + j2 and lags k = k1 + a k2 for n = a b: a product over j1, a turn
    by j2 k1 / n and a product over j2, so a spectrum costs n (a + b) and not n * n.
    """
    n = v.shape[1]
    a = next(d for d in range(math.isqrt(n), 0, -1) if n % d == 0)
    b = n // a
    turn = lambda x, y, m: np.exp(-1j * TURN / m * (np.outer(x, y) % m))
    first = np.einsum("kj,rjl->rkl", turn(np.arange(a), np.arange(a), a), v.reshape(-1, a, b), optimize=True) if a > 1 else v.reshape(-1, 1, b)
    first = first * turn(np.arange(a), np.arange(b), n)
    out = np.empty((len(v), b, a), complex)
    step = max(1, _PRODUCT // b)  # a prime n has b = n: its matrix is made in slices of lags
    for lo in range(0, b, step):
        out[:, lo : lo + step] = (first @ turn(np.arange(b), np.arange(lo, min(lo + step, b)), b)).transpose(0, 2, 1)
    return np.roll(out.reshape(len(v), n), n // 2, axis=1)


def delay_fft(df: DataFrame, keys: Sequence[str], resolution: float) -> DataFrame:
    """Delay of the largest lag of each spectrum's Fourier transform; of equal lags the first counts.

    The spectra of one length in an Arrow batch are transformed together by matrix products.
    Spectra of at most one channel have delay 0, a null spectrum has a null delay.
    """

    @F.arrow_udf("double")
    def lag(re: pa.Array, im: pa.Array) -> pa.Array:
        n = re.value_lengths().fill_null(0).to_numpy(zero_copy_only=False)
        a, b = (x.flatten().to_numpy(zero_copy_only=False).astype(float) for x in (re, im))
        start, out = np.cumsum(n) - n, np.zeros(len(n))
        for width in np.unique(n[n > 1]):
            rows = np.flatnonzero(n == width)
            for part in np.array_split(rows, -(-len(rows) * int(width) // _PRODUCT)):
                at = start[part][:, None] + np.arange(width)
                out[part] = (np.argmax(np.abs(_lag_sums(a[at] + 1j * b[at])), axis=1) - width // 2) / (width * resolution)
        return pa.array(out, mask=re.is_null().to_numpy(zero_copy_only=False))

    both = F.col("re").isNotNull() & F.col("im").isNotNull()
    return df.select(*keys, lag(F.when(both, F.col("re")), F.when(both, F.col("im"))).alias("delay"))


def monitor_average(df: DataFrame, keys: Sequence[str], resolution: float, first: int | None = None, last: int | None = None) -> DataFrame:
    """Mean of the unflagged channels first..last (inclusive): amplitude, phase in degrees, delay."""
    cut = (lambda c: F.slice(c, first + 1, last - first + 1)) if first is not None else (lambda c: F.col(c))
    d = df.select(*keys, cut("re").alias("re"), cut("im").alias("im"), cut("flag").alias("flag"))
    good = F.filter(F.arrays_zip("re", "im", "flag"), lambda s: ~s["flag"])
    mean = let(good, lambda g: F.struct(
        F.size(g).cast("long").alias("n"),
        F.coalesce(F.try_divide(F.aggregate(g, F.lit(0.0), lambda a, s: a + s["re"]), F.size(g)), F.lit(0.0)).alias("re"),
        F.coalesce(F.try_divide(F.aggregate(g, F.lit(0.0), lambda a, s: a + s["im"]), F.size(g)), F.lit(0.0)).alias("im"),
        F.when(F.size(g) > 1, delay_fit(F.transform(g, lambda s: F.atan2(s["im"], s["re"])), resolution)).otherwise(0.0).alias("delay")))
    d = d.select(*keys, mean.alias("m"))
    return d.select(*keys, "m.n", F.sqrt(F.col("m.re") ** 2 + F.col("m.im") ** 2).alias("amplitude"),
                    F.degrees(F.atan2("m.im", "m.re")).alias("phase"), F.col("m.delay").alias("delay"))


def delay_average(samples: DataFrame, keys: Sequence[str], n_avg: int, cutoff: float, freq0: float, df: float, delay: Column | None = None) -> DataFrame:
    """Time-averaged spectrum per key and block of ``n_avg`` channels: unflagged, below the cutoff (if positive),
    with a prior delay taken off."""
    d = samples.where(~F.col("flag"))
    if cutoff >= 0:
        d = d.where(F.sqrt(F.col("re") ** 2 + F.col("im") ** 2) < cutoff)
    re, im = F.col("re"), F.col("im")
    if delay is not None:
        ph = -TURN * (F.col("chan") * df) * delay
        re, im = re * F.cos(ph) - im * F.sin(ph), re * F.sin(ph) + im * F.cos(ph)
    return d.groupBy(*keys, F.floor(F.col("chan") / n_avg).alias("block")).agg(
        F.avg(re).alias("re"), F.avg(im).alias("im"), F.count(F.lit(1)).alias("n"))


# ---------------------------------------------------------------- Faraday synthesis

def faraday_weights(q: Column, u: Column, noise: Column, weighting: str) -> Column:
    """Array of (q, u, w): uniform or 1/noise^2; a channel that is not finite gets zeros."""
    finite = lambda x: ~(F.isnan(x) | (F.abs(x) == float("inf")))
    w = (lambda s: F.when(s["n"] > 0, 1.0 / (s["n"] * s["n"])).otherwise(0.0)) if weighting == "variance" else (lambda s: F.lit(1.0))
    z = F.arrays_zip(q.alias("q"), u.alias("u"), noise.alias("n"))
    return F.transform(z, lambda s: F.when(finite(s["q"]) & finite(s["u"]), F.struct(s["q"].alias("q"), s["u"].alias("u"), w(s).alias("w")))
                       .otherwise(F.struct(F.lit(0.0).alias("q"), F.lit(0.0).alias("u"), F.lit(0.0).alias("w"))))


def rm_synthesis(df: DataFrame, keys: Sequence[str], lsq: Sequence[float], n_phi: int, d_phi: float, weighting: str = "uniform",
                 i_flux=None, rmsf: bool = False) -> DataFrame:
    """Faraday dispersion function per source: arrays in, an array of (phi, re, im) out.

    ``q``, ``u`` (fractional) and ``noise`` are arrays over channel; ``i_flux`` maps
    the reference frequency to Stokes I.  With ``rmsf`` the response on the doubled
    grid instead.  An Arrow batch of weighted spectra is multiplied by one matrix of
    (channel, grid point) turns about the mean of ``lsq``; a source's own reference is a turn of its
    result, so nothing is shuffled and no row is repeated.  A source without weight has
    null values, one without ``q`` or ``u`` a null function.
    """
    lam = F.array(*[F.lit(float(x)) for x in lsq])
    total = lambda arr, f: F.aggregate(arr, F.lit(0.0), lambda a, s: a + f(s))
    n = 2 * n_phi if rmsf else n_phi
    phi = -n * d_phi / 2.0 + d_phi * np.arange(n)
    squares = np.asarray(lsq, float)
    middle, channels = float(squares.mean()), len(squares)

    def reference(s):
        k = F.try_divide(F.lit(1.0), total(s, lambda c: c["w"]))
        return F.struct(s.alias("s"), k.alias("k"), (k * total(s, lambda c: c["w"] * c["l"])).alias("l0"))

    @F.arrow_udf("array<struct<phi:double,re:double,im:double>>")
    def transform(re: pa.Array, im: pa.Array, l0: pa.Array, scale: pa.Array) -> pa.Array:
        width = re.value_lengths()
        if any(w != channels for w in width.unique().to_pylist() if w is not None):
            raise ValueError(f"a spectrum does not have {channels} channels")
        l0, scale = (x.to_numpy(zero_copy_only=False).astype(float) for x in (l0, scale))
        here = np.flatnonzero(re.is_valid().to_numpy(zero_copy_only=False))
        a, b = (x.flatten().to_numpy(zero_copy_only=False).astype(float).reshape(-1, channels) for x in (re, im))
        out = np.empty((len(here), n), complex)
        step = max(1, _PRODUCT // channels)
        for lo in range(0, n, step):
            out[:, lo : lo + step] = (a + 1j * b) @ np.exp(-2j * np.outer(squares - middle, phi[lo : lo + step]))
        out *= np.exp(2j * np.outer(l0[here] - middle, phi)) * scale[here][:, None]
        none = np.isnan(l0[here] + scale[here]).repeat(n)
        point = pa.StructArray.from_arrays([pa.array(np.tile(phi, len(here))), pa.array(out.real.ravel(), mask=none), pa.array(out.imag.ravel(), mask=none)], ["phi", "re", "im"])
        size = np.zeros(len(re) + 1, np.int32)
        size[here + 1] = n
        return pa.ListArray.from_arrays(pa.array(np.cumsum(size), pa.int32(), mask=np.append(re.is_null().to_numpy(zero_copy_only=False), False)), point)

    weights = F.zip_with(faraday_weights(F.col("q"), F.col("u"), F.col("noise"), weighting), lam, lambda s, x: s.withField("l", x))
    noise = total(F.col("noise"), lambda x: x) / F.size("noise") / F.sqrt(F.size("noise").cast("double"))
    d = df.select(*keys, noise.alias("fdf_noise"), let(weights, reference).alias("b"))
    scale = F.col("b.k") if (rmsf or i_flux is None) else F.col("b.k") * i_flux(299792458.0 / F.sqrt("b.l0"))
    part = lambda f: F.transform("b.s", f)
    re, im = (part(lambda s: s["w"]), part(lambda s: F.lit(0.0))) if rmsf else (part(lambda s: s["w"] * s["q"]), part(lambda s: s["w"] * s["u"]))
    d = d.select(*keys, F.col("b.l0").alias("lsq0"), "fdf_noise", re.alias("__re"), im.alias("__im"), scale.cast("double").alias("__k"))
    return d.select(*keys, "lsq0", "fdf_noise", transform("__re", "__im", "lsq0", "__k").alias("fdf"))


def rmsf_width(rmsf: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Full width at half maximum of |RMSF| about its peak, crossings interpolated."""
    e = rmsf.select(*keys, F.posexplode("fdf").alias("i", "f"))
    e = e.select(*keys, "i", F.col("f.phi").alias("phi"), F.sqrt(F.col("f.re") ** 2 + F.col("f.im") ** 2).alias("p"))
    top = e.groupBy(*keys).agg(F.max_by(F.struct("p", "i"), F.struct(F.col("p"), -F.col("i"))).alias("m"))
    w = Window.partitionBy(*keys).orderBy("i")
    e = e.withColumn("pn", F.lead("p").over(w)).withColumn("xn", F.lead("phi").over(w)).join(top, list(keys))
    half = F.col("m.p") / 2
    cross = F.col("phi") + (F.col("xn") - F.col("phi")) * F.try_divide(F.col("p") - half, F.col("p") - F.col("pn"))
    up = (F.col("p") < half) & (F.col("pn") >= half) & (F.col("i") < F.col("m.i"))
    down = (F.col("p") >= half) & (F.col("pn") < half) & (F.col("i") >= F.col("m.i"))
    return e.groupBy(*keys).agg((F.min(F.when(down, cross)) - F.max(F.when(up, cross))).alias("width"))


def faraday_peak(fdf: DataFrame, keys: Sequence[str], width: float, detection: float, debias: float, i_ref: float) -> DataFrame:
    """Peak of the dispersion function: SNR, detection, debiased and refined peak, edge flag, angles, fraction."""
    amp = F.transform("fdf", lambda f: F.sqrt(f["re"] * f["re"] + f["im"] * f["im"]))
    d = fdf.withColumn("__p", amp).withColumn("__n", F.size("fdf"))
    d = d.withColumn("p_peak", F.array_max("__p")).withColumn("__i", F.array_position("__p", F.array_max("__p")).cast("int"))
    at = lambda arr, o: F.try_element_at(arr, F.when(F.col("__i") + o >= 1, F.col("__i") + o))
    peak = F.element_at("fdf", F.col("__i"))
    d = d.withColumn("snr", F.col("p_peak") / F.col("fdf_noise")).withColumn("phi_peak", peak["phi"])
    d = d.withColumn("__re", peak["re"]).withColumn("__im", peak["im"])
    y0, y1, y2 = at(F.col("__p"), -1), F.col("p_peak"), at(F.col("__p"), 1)
    x0, x1 = at(F.col("fdf"), -1)["phi"], F.col("phi_peak")
    h = x1 - x0
    a, b = (y0 - 2 * y1 + y2) / (2 * h * h), (y2 - y0) / (2 * h)
    debiased = lambda p: F.when(F.col("snr") > debias, F.sqrt(F.greatest(F.lit(0.0), p * p - 2.3 * F.col("fdf_noise") * F.col("fdf_noise"))))
    fitted = F.when((F.col("__i") > 1) & (F.col("__i") < F.col("__n")), y1 - F.try_divide(b * b, 4 * a))
    phi_fit = F.when((F.col("__i") > 1) & (F.col("__i") < F.col("__n")), x1 - F.try_divide(b, 2 * a))
    first, last = F.element_at("fdf", 1)["phi"], F.element_at("fdf", -1)["phi"]
    ref = F.degrees(0.5 * F.atan2("__im", "__re"))
    return d.select(
        *keys, "snr", (F.col("snr") > detection).alias("detected"), "p_peak", debiased(F.col("p_peak")).alias("p_eff"), "phi_peak",
        ((x1 < first + width / 2) | (x1 > last - width / 2)).alias("edge"), fitted.alias("p_fit"), phi_fit.alias("phi_fit"),
        ref.alias("angle_ref"), (ref - x1 * F.col("lsq0")).alias("angle_zero"), (F.col("p_peak") / i_ref).alias("frac_pol"))


# ---------------------------------------------------------------- spectral lines

def line_parameters(spec: DataFrame, key: str) -> DataFrame:
    """Line widths and clipped fluxes per object from ``(key, i, v, flux)``.

    W50/W20 span the outermost crossings of 50/20 % of the peak, interpolated; the
    centroid widths CW50/CW20 go outward from the flux-weighted centroid to the first
    crossing on either side.  Windows hold one spectrum.
    """
    s, v = F.col("flux"), F.col("v")
    g = spec.groupBy(key).agg(
        F.max("flux").alias("flux_max"), F.min("flux").alias("flux_min"), F.avg("flux").alias("flux_mean"), F.stddev_samp("flux").alias("flux_std"),
        F.sqrt(F.avg(s * s)).alias("flux_rms"), F.avg(F.when(s > 0, v)).alias("v_uw"),
        F.try_divide(F.sum(F.when(s > 0, s * v)), F.sum(F.when(s > 0, s))).alias("v_w"), F.max_by(v, F.struct(s, -v)).alias("v_peak"))
    w = Window.partitionBy(key).orderBy("i")
    d = spec.join(g, key)
    d = d.withColumn("fp", F.lag("flux").over(w)).withColumn("vp", F.lag("v").over(w)).withColumn("fn", F.lead("flux").over(w)).withColumn("vn", F.lead("v").over(w))
    aggs = []
    for pc in (50, 20):
        lev = F.col("flux_max") * (pc / 100.0)
        left = F.when(s >= lev, F.coalesce(v - (v - F.col("vp")) * F.try_divide(s - lev, s - F.when(F.col("fp") < lev, F.col("fp"))), v))
        right = F.when(s >= lev, F.coalesce(v + (F.col("vn") - v) * F.try_divide(s - lev, s - F.when(F.col("fn") < lev, F.col("fn"))), v))
        in_left = F.when((s >= lev) & (F.col("fp") < lev) & (F.col("vp") <= F.col("v_w")), left)
        in_right = F.when((s >= lev) & (F.col("fn") < lev) & (F.col("vn") >= F.col("v_w")), right)
        aggs += [F.min_by(left, F.when(s >= lev, F.col("i"))).alias(f"l{pc}"), F.max_by(right, F.when(s >= lev, F.col("i"))).alias(f"r{pc}"),
                 F.max(in_left).alias(f"cl{pc}"), F.min(in_right).alias(f"cr{pc}"), F.sum(F.when(s >= lev, s)).alias(f"flux_clip{pc}")]
    e = d.groupBy(key).agg(*aggs)
    e = e.select(key, *[(F.col(f"r{p}") - F.col(f"l{p}")).alias(f"w{p}") for p in (50, 20)],
                 *[(F.coalesce(f"cr{p}", f"r{p}") - F.coalesce(f"cl{p}", f"l{p}")).alias(f"cw{p}") for p in (50, 20)], "flux_clip50", "flux_clip20")
    return g.join(e, key)


# ---------------------------------------------------------------- polynomial fits

def taylor_fit(df: DataFrame, keys: Sequence[str], x: str, y: str, terms: int) -> DataFrame:
    """Least-squares polynomial of one to three terms per key, from sums."""
    p = [F.sum(F.pow(F.col(x), F.lit(float(k)))).alias(f"s{k}") for k in range(2 * terms - 1)]
    q = [F.sum(F.col(y) * F.pow(F.col(x), F.lit(float(k)))).alias(f"t{k}") for k in range(terms)]
    d = df.groupBy(*keys).agg(*p, *q)
    m = [[F.col(f"s{i + j}") for j in range(terms)] for i in range(terms)]
    r = [F.col(f"t{i}") for i in range(terms)]

    def det(a):
        if len(a) == 1:
            return a[0][0]
        total = None
        for j in range(len(a)):
            minor = det([row[:j] + row[j + 1:] for row in a[1:]])
            term = a[0][j] * minor
            total = term if total is None else total + term if j % 2 == 0 else total - term
        return total

    base = det(m)
    cols = [F.try_divide(det([[r[i] if k == j else m[i][k] for k in range(terms)] for i in range(terms)]), base).alias(f"c{j}") for j in range(terms)]
    return d.select(*keys, *cols)
