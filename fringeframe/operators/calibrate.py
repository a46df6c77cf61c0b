"""Calibration: apply, pre-average, solve, reference, compare, store."""

from __future__ import annotations

from collections.abc import Sequence

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.cx import Cx
from ..functions.prefix import scan_lag, scan_sum
from .joins import lookup_join

POLS = ("xx", "xy", "yx", "yy")
MIN_DET = 1e-25  # fixed value: smallest usable determinant of the batch apply
MIN_DET_STREAM = 1e-5  # fixed value: the same for the streaming apply


def _solution(cal: DataFrame, keys: Sequence[str], ant: str, side: str) -> DataFrame:
    rest = [c for c in cal.columns if c not in (*keys, "ant")]
    return cal.select(*keys, F.col("ant").alias(ant), *[F.col(c).alias(f"{c}_{side}") for c in rest])


def join_solutions(vis: DataFrame, cal: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Both antennas' solutions beside each row: ``cal`` columns with suffixes _1 and _2.

    A solution table is small next to the visibilities; see :func:`lookup_join` for what happens
    when it is not.
    """
    keys = list(keys)
    j = lookup_join(vis, _solution(cal, keys, "ant1", "1"), [*keys, "ant1"], "left")
    return lookup_join(j, _solution(cal, keys, "ant2", "2"), [*keys, "ant2"], "left")


def jones(side: str) -> list[list[Cx]]:
    """2x2 Jones matrix of one side; absent gains are one, absent leakages zero."""
    g = lambda n, d: Cx(F.coalesce(F.col(f"{n}_re_{side}"), F.lit(d)), F.coalesce(F.col(f"{n}_im_{side}"), F.lit(0.0)))
    g1, g2, d12, d21 = g("g1", 1.0), g("g2", 1.0), g("d12", 0.0), g("d21", 0.0)
    return [[g1, d12 * g1], [d21 * F.lit(-1.0) * g2, g2]]


def _inv2(m: list[list[Cx]]) -> tuple[list[list[Cx]], Cx]:
    det = m[0][0] * m[1][1] - m[0][1] * m[1][0]
    minus = F.lit(-1.0)
    return [[m[1][1] / det, m[0][1] * minus / det], [m[1][0] * minus / det, m[0][0] / det]], det


def apply_jones(vis: DataFrame, valid: Column, flag_allowed: bool = True, scale_noise: bool = False) -> DataFrame:
    """Correct four products by the inverse of J1 (x) conj(J2).

    Rows hold ``xx_re`` .. ``yy_im``, ``flag`` (any product) and the columns added by
    :func:`join_solutions`.  A bad solution or a determinant below 1e-25 flags and
    zeroes the sample, or fails if flagging is not allowed.  The inverse of the
    product matrix is the product of the 2x2 inverses.
    """
    inv1, det1 = _inv2(jones("1"))
    inv2, det2 = _inv2(jones("2"))
    # name the intermediate values, so that the plan computes each of them once
    cols = {}
    for tag, inv in (("p", inv1), ("q", inv2)):
        for i in range(2):
            for k in range(2):
                cols[f"__{tag}{i}{k}_re"], cols[f"__{tag}{i}{k}_im"] = inv[i][k].re, inv[i][k].im
    d = vis.select("*", *[c.alias(n) for n, c in cols.items()], (det1.norm() * det2.norm()).alias("__det"))
    bad = ~valid | (F.col("__det") < MIN_DET) | F.col("__det").isNull()
    if flag_allowed:
        drop = bad | F.col("flag")
    else:
        drop = F.when(bad | F.col("flag"), F.raise_error(F.lit("no usable solution and flagging is not allowed")).cast("boolean")).otherwise(False)
    d = d.withColumn("__drop", drop)
    p = lambda i, k: Cx.of(f"__p{i}{k}_re", f"__p{i}{k}_im")
    q = lambda i, k: Cx.of(f"__q{i}{k}_re", f"__q{i}{k}_im").conj()
    out, noise = [], []
    for r, pol in enumerate(POLS):
        i, j = divmod(r, 2)
        total, var = None, None
        for s, src in enumerate(POLS):
            k, m = divmod(s, 2)
            coef = p(i, k) * q(j, m)
            term = coef * Cx.of(f"{src}_re", f"{src}_im")
            total = term if total is None else total + term
            if scale_noise:
                sq = coef.norm() * F.col(f"{src}_sigma") * F.col(f"{src}_sigma")
                var = sq if var is None else var + sq
        out += [F.when(F.col("__drop"), 0.0).otherwise(total.re).alias(f"{pol}_re"),
                F.when(F.col("__drop"), 0.0).otherwise(total.im).alias(f"{pol}_im")]
        if scale_noise:
            noise.append(F.when(F.col("__drop"), F.col(f"{pol}_sigma")).otherwise(F.sqrt(var)).alias(f"{pol}_sigma"))
    replaced = {f"{p}_{c}" for p in POLS for c in ("re", "im")} | {"flag"}
    if scale_noise:
        replaced |= {f"{p}_sigma" for p in POLS}
    keep = [c for c in vis.columns if c not in replaced]
    return d.select(*keep, *out, *noise, (F.col("flag") | F.col("__drop")).alias("flag"))


def apply_parallel(vis: DataFrame, g1: Cx, g2: Cx, min_det: float | None = None) -> DataFrame:
    """Parallel hands only: divide by g1 conj(g2).  ``min_det`` makes a small divisor an error."""
    g = g1 * g2.conj()
    d = vis.withColumn("__gr", g.re).withColumn("__gi", g.im)
    out = Cx.of("re", "im") / Cx.of("__gr", "__gi")
    if min_det is not None:
        small = Cx.of("__gr", "__gi").abs() < min_det
        stop = F.raise_error(F.lit("gain too close to zero")).cast("double")
        out = Cx(F.when(small, stop).otherwise(out.re), F.when(small, stop).otherwise(out.im))
    return d.withColumn("__r", out.re).withColumn("im", out.im).withColumn("re", F.col("__r")).drop("__r", "__gr", "__gi")


def apply_hands(vis: DataFrame, g1: tuple[Cx, Cx], g2: tuple[Cx, Cx], min_det: float = MIN_DET_STREAM) -> DataFrame:
    """Every product ``pol`` divided by g1(first hand) conj(g2(second hand)); the gains are pairs for X and Y.

    The four divisors are the diagonal of the product matrix. Its determinant, their product, is
    tested for every row, whatever its own product is; a small one is an error, as is another ``pol``.
    """
    divisors = [a * b.conj() for a in g1 for b in g2]
    d = vis
    for r, g in enumerate(divisors):
        d = d.withColumn(f"__g{r}_re", g.re).withColumn(f"__g{r}_im", g.im)
    g = [Cx.of(f"__g{r}_re", f"__g{r}_im") for r in range(4)]
    det = g[0].abs() * g[1].abs() * g[2].abs() * g[3].abs()
    stop = lambda text: F.raise_error(F.lit(text)).cast("double")
    pick = lambda part: F.coalesce(*[F.when(F.lower("pol") == p, getattr(x, part)) for p, x in zip(POLS, g)])
    known = F.coalesce(F.lower("pol").isin(*POLS), F.lit(False))
    d = d.withColumn("__gr", F.when(~known, stop("unknown product")).when(det < min_det, stop("gains too close to zero")).otherwise(pick("re"))).withColumn("__gi", pick("im"))
    out = Cx.of("re", "im") / Cx.of("__gr", "__gi")
    d = d.withColumn("__r", out.re).withColumn("im", out.im).withColumn("re", F.col("__r"))
    return d.drop("__r", "__gr", "__gi", *[f"__g{r}_{c}" for r in range(4) for c in ("re", "im")])


# ---------------------------------------------------------------- sums for solving

def pre_average(samples: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Sums of w conj(model) measured and w |model|^2 per key, with skip counts.

    Auto-correlations and flagged samples are counted, not used; w = 1 / sigma^2.
    """
    auto = F.col("ant1") == F.col("ant2")
    use = ~auto & ~F.col("flag")
    w = F.when(F.col("sigma") > 0, 1.0 / (F.col("sigma") * F.col("sigma"))).otherwise(0.0)
    model, meas = Cx.of("model_re", "model_im"), Cx.of("re", "im")
    x = model.conj() * meas * w
    pick = lambda c: F.sum(F.when(use, c).otherwise(0.0))
    return samples.groupBy(*keys).agg(
        pick(x.re).alias("xr"), pick(x.im).alias("xi"), pick(model.norm() * w).alias("mm"),
        F.sum(use.cast("long")).alias("n_used"), F.sum((~auto & F.col("flag")).cast("long")).alias("n_flagged"),
        F.sum(auto.cast("long")).alias("n_auto"))


def solve_gains(ant1: np.ndarray, ant2: np.ndarray, x: np.ndarray, m: np.ndarray,
                tol: float = 1e-10, patience: int = 500) -> tuple[dict[int, complex], bool, int, float]:
    """Antenna gains from sums: minimise sum |x/m - g1 conj(g2)|^2 m, alternating with damping.

    Steps go on until the gains move by no more than ``tol``, or until the smallest move has not
    become smaller for ``patience`` steps.  Returns gains, whether they converged, steps and the last move.
    """
    ants = np.unique(np.concatenate([ant1, ant2]))
    idx = {a: i for i, a in enumerate(ants)}
    n = len(ants)
    xs, ms = np.zeros((n, n), complex), np.zeros((n, n))
    for a, b, xv, mv in zip(ant1, ant2, x, m):
        i, j = idx[a], idx[b]
        xs[i, j] += xv
        ms[i, j] += mv
        xs[j, i] += np.conj(xv)
        ms[j, i] += mv
    g = np.ones(n, complex)
    steps, best, since, move = 0, np.inf, 0, np.inf
    while move > tol and since < patience:
        num, den = xs @ g, ms @ (np.abs(g) ** 2)
        new = np.where(den > 0, num / np.where(den > 0, den, 1), g)
        step = (g + new) / 2
        move = float(np.max(np.abs(step - g)) / max(1.0, np.max(np.abs(step))))
        since = 0 if move < best else since + 1
        best, steps, g = min(best, move), steps + 1, step
    return {int(a): g[i] for a, i in idx.items()}, move <= tol, steps, move


def solve_groups(sums: DataFrame, keys: Sequence[str], ref_ant: int | None = 0) -> DataFrame:
    """Independent solve per key, e.g. (beam, chan) or (interval, beam).

    The input has at most one row per baseline and key (see :func:`pre_average`),
    so a group is bounded by the number of antennas squared.
    """
    keys = list(keys)

    def solve(pdf: pd.DataFrame) -> pd.DataFrame:
        ok = pdf[(pdf.mm > 0) & (pdf.ant1 != pdf.ant2)]
        cols = [*keys, "ant", "g_re", "g_im", "converged", "n_steps", "residual"]
        if ok.empty:
            return pd.DataFrame({c: [] for c in cols})
        g, converged, steps, residual = solve_gains(ok.ant1.to_numpy(), ok.ant2.to_numpy(), ok.xr.to_numpy() + 1j * ok.xi.to_numpy(), ok.mm.to_numpy())
        if ref_ant in g and abs(g[ref_ant]) > 0:
            ph = np.conj(g[ref_ant]) / abs(g[ref_ant])
            g = {a: v * ph for a, v in g.items()}
        out = pd.DataFrame({"ant": list(g), "g_re": [v.real for v in g.values()], "g_im": [v.imag for v in g.values()],
                            "converged": converged, "n_steps": steps, "residual": residual})
        for k in keys:
            out[k] = pdf[k].iloc[0]
        return out[cols]

    types = dict(sums.dtypes)
    schema = ", ".join([*(f"{k} {types[k]}" for k in keys), "ant long", "g_re double", "g_im double", "converged boolean", "n_steps long", "residual double"])
    return sums.groupBy(*keys).applyInPandas(solve, schema)


def phase_reference(gains: DataFrame, keys: Sequence[str], ref_ant: int, strict: bool = True) -> DataFrame:
    """Rotate gains so that the reference antenna has zero phase in each key.

    Without that antenna it fails, or gives null gains for that key if not ``strict``.
    """
    keys = [*keys, "__k"]  # a constant key stands in when there is none
    gains = gains.withColumn("__k", F.lit(1))
    ref = gains.where(F.col("ant") == ref_ant).select(*keys, F.col("g_re").alias("__r"), F.col("g_im").alias("__i"))
    d = gains.join(ref, keys, "left")
    r = Cx.of("__r", "__i")
    missing = F.raise_error(F.lit("reference antenna has no gain")).cast("double") if strict else F.lit(None).cast("double")
    have = F.when(F.col("__r").isNull(), missing).otherwise(r.abs())
    d = d.withColumn("__a", have)
    z = Cx.of("g_re", "g_im") * r.conj()
    return (d.withColumn("__x", F.try_divide(z.re, F.col("__a"))).withColumn("g_im", F.try_divide(z.im, F.col("__a")))
            .withColumn("g_re", F.col("__x")).drop("__r", "__i", "__a", "__x", "__k"))


# ---------------------------------------------------------------- solution tables

def add_solution(table: DataFrame, new: DataFrame, time: str) -> DataFrame:
    """Append a solution with an id that grows with its time (microseconds), unique per set."""
    return table.unionByName(new.withColumn("solution_id", F.col(time).cast("long")))


def adjust_solution(old: DataFrame, change: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Entries of ``change`` replace those of ``old`` with the same keys; the others stay."""
    return old.join(change, list(keys), "left_anti").unionByName(change)


def compare_gains(a: DataFrame, b: DataFrame) -> DataFrame:
    """Gains named ``g11`` in both sets: amplitude and phase of g1 conj(g2)."""
    j = a.select("name", F.col("re").alias("r1"), F.col("im").alias("i1")).join(
        b.select("name", F.col("re").alias("r2"), F.col("im").alias("i2")), "name", "full_outer")
    j = j.where(F.col("name").contains("g11") & F.col("r1").isNotNull() & F.col("r2").isNotNull())
    z = Cx.of("r1", "i1") * Cx.of("r2", "i2").conj()
    return j.select("name", z.abs().alias("amp"), z.arg().alias("phase"))


# ---------------------------------------------------------------- antenna positions

def unwrap_along(df: DataFrame, keys: Sequence[str], order: str, bucket: Column, phase: str, threshold: float) -> DataFrame:
    """Add ``unwrapped``: a jump beyond ``threshold`` adds or removes a turn from there on."""
    d = scan_lag(df, keys, order, bucket, [phase])
    jump = F.col(phase) - F.coalesce(F.col(f"prev.{phase}"), F.col(phase))
    d = d.withColumn("__turn", F.when(jump > threshold, -1).when(jump < -threshold, 1).otherwise(0).cast("long"))
    d = scan_sum(d, keys, order, bucket, "__turn", "__turns")
    return d.withColumn("unwrapped", F.col(phase) + F.col("__turns") * (2 * np.pi)).drop("prev", "__turn", "__turns")


def fit_sinusoid(df: DataFrame, keys: Sequence[str], angle: str, value: str) -> DataFrame:
    """Least squares value = a + b sin(angle) + c cos(angle) per key, from sums (Cramer's rule)."""
    s, c, y = F.sin(angle), F.cos(angle), F.col(value)
    t = df.groupBy(*keys).agg(
        F.count(value).cast("double").alias("n"), F.sum(s).alias("s"), F.sum(c).alias("c"), F.sum(s * s).alias("ss"),
        F.sum(s * c).alias("sc"), F.sum(c * c).alias("cc"), F.sum(y).alias("y"), F.sum(y * s).alias("ys"),
        F.sum(y * c).alias("yc"))
    q = {k: F.col(k) for k in ("n", "s", "c", "ss", "sc", "cc", "y", "ys", "yc")}
    m = [[q["n"], q["s"], q["c"]], [q["s"], q["ss"], q["sc"]], [q["c"], q["sc"], q["cc"]]]
    r = [q["y"], q["ys"], q["yc"]]

    def det(a):
        return (a[0][0] * (a[1][1] * a[2][2] - a[1][2] * a[2][1]) - a[0][1] * (a[1][0] * a[2][2] - a[1][2] * a[2][0])
                + a[0][2] * (a[1][0] * a[2][1] - a[1][1] * a[2][0]))

    def swapped(j):
        return [[r[i] if k == j else m[i][k] for k in range(3)] for i in range(3)]

    d = det(m)
    fits = [F.when(F.abs(d) > 1e-9, F.try_divide(det(swapped(j)), d)).alias(n) for j, n in enumerate(("a", "b", "c_fit"))]
    return t.select(*keys, F.col("n").cast("long").alias("n"), *fits)
