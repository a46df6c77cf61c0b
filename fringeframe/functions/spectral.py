"""Frequencies, velocities, spectra and polarisation as Column expressions."""

from __future__ import annotations

import math

from pyspark.sql import Column
from pyspark.sql import functions as F

from .cx import Cx

# Speed of light (km/s), HI rest frequency (Hz).
C_KM_S = 299792.458
HI_HZ = 1.420405751786e9


def redshift_to_velocity(z: Column) -> Column:
    q = (z + 1.0) * (z + 1.0)
    return C_KM_S * (q - 1.0) / (q + 1.0)


def velocity_to_redshift(vel: Column) -> Column:
    return F.sqrt((1.0 + vel / C_KM_S) / (1.0 - vel / C_KM_S)) - 1.0


def frequency_to_redshift(freq: Column, rest: float = HI_HZ) -> Column:
    return rest / freq - 1.0


def redshift_to_frequency(z: Column, rest: float = HI_HZ) -> Column:
    return rest / (z + 1.0)


def frequency_to_velocity(freq: Column, rest: float = HI_HZ) -> Column:
    return redshift_to_velocity(frequency_to_redshift(freq, rest))


def velocity_to_frequency(vel: Column, rest: float = HI_HZ) -> Column:
    return redshift_to_frequency(velocity_to_redshift(vel), rest)


def power_law(s0: Column, freq: Column, ref: Column, alpha: Column, beta: Column) -> Column:
    """S0 (f/f0)^(alpha + beta ln(f/f0))"""
    x = freq / ref
    return s0 * F.pow(x, alpha + beta * F.ln(x))


def power_law_integral(s0: Column, f1: Column, f2: Column, ref: Column, alpha: Column) -> Column:
    """Band integral without curvature; the logarithm at alpha = -1."""
    hi, lo = F.greatest(f1, f2), F.least(f1, f2)
    p = alpha + 1.0
    general = F.try_divide(s0 * (F.pow(hi, p) - F.pow(lo, p)), p * F.pow(ref, alpha))
    return F.when(F.abs(p) < 1e-9, s0 * ref * F.ln(hi / lo)).otherwise(general)


# Cubic in log10(MHz) of the flux density model of 1934-638 (Reynolds).
CAL_1934 = (-30.7667, 26.4908, -7.0977, 0.6053334)


def calibrator_1934(mhz: Column) -> Column:
    """Flux density (Jy) of the calibrator; an error outside 500 MHz to 10 GHz."""
    x = F.log10(mhz)
    a, b, c, d = CAL_1934
    s = F.pow(F.lit(10.0), a + x * (b + x * (c + x * d)))
    return F.when((mhz > 500) & (mhz < 10000), s).otherwise(F.raise_error(F.lit("model valid from 500 MHz to 10 GHz")).cast("double"))


def stokes_from_linear(xx: Cx, xy: Cx, yx: Cx, yy: Cx) -> dict[str, Cx]:
    """I, Q, U, V of linear products, I = (XX + YY) / 2."""
    v = (xy - yx) * 0.5
    return {"i": (xx + yy) * 0.5, "q": (xx - yy) * 0.5, "u": (xy + yx) * 0.5, "v": Cx(v.im, -v.re)}


def stokes_noise(a: Column, b: Column) -> Column:
    """Noise of a half sum or half difference, in quadrature."""
    return F.sqrt(a * a + b * b) * 0.5


def gaussian_beam(offset: Column, fwhm: Column) -> Column:
    return F.exp(-4.0 * math.log(2.0) * (offset / fwhm) * (offset / fwhm))


def deconvolve(a0: Column, b0: Column, pa0: Column, a2: Column, b2: Column, pa2: Column) -> dict[str, Column]:
    """Take a beam (a2, b2, pa2) off a Gaussian (a0, b0, pa0); angles in radians; axes stop at zero."""
    d0, d2 = a0 * a0 - b0 * b0, a2 * a2 - b2 * b2
    excess = a0 * a0 + b0 * b0 - a2 * a2 - b2 * b2
    d1 = F.sqrt(F.greatest(F.lit(0.0), d0 * d0 + d2 * d2 - 2.0 * d0 * d2 * F.cos(2.0 * (pa0 - pa2))))
    axis = lambda s: F.sqrt(F.greatest(F.lit(0.0), 0.5 * s))
    cos_part = d0 * F.cos(2.0 * pa0) - d2 * F.cos(2.0 * pa2)
    sin_part = d0 * F.sin(2.0 * pa0) - d2 * F.sin(2.0 * pa2)
    return {"maj": axis(excess + d1), "min": axis(excess - d1), "pa": F.when(cos_part == 0, 0.0).otherwise(F.atan2(sin_part, cos_part) / 2.0)}


def circular_atan(sin_term: Column, cos_term: Column) -> Column:
    """Angle in [0, 2 pi); terms below 1e-10 count as zero."""
    clean = lambda c: F.when(F.abs(c) < 1e-10, 0.0).otherwise(c)
    return F.pmod(F.atan2(clean(sin_term), clean(cos_term)), F.lit(2 * math.pi))


def normal_tail(z: Column) -> Column:
    """Probability that a standard normal value is above z >= 0: a power series up to 2, a continued fraction beyond."""
    density = F.exp(-0.5 * z * z) / math.sqrt(2.0 * math.pi)
    # z + z^3/3 + z^5/(3 5) + ...; each term is the one before times z^2 / (2 i + 1)
    start = F.struct(z.alias("term"), z.alias("total"))
    grown = lambda acc, i: F.struct((acc["term"] * z * z / (2.0 * i + 1.0)).alias("term"), (acc["total"] + acc["term"] * z * z / (2.0 * i + 1.0)).alias("total"))
    series = F.aggregate(F.sequence(F.lit(1), F.lit(40)), start, grown, lambda acc: acc["total"])
    # z + 1/(z + 2/(z + 3/...)), from the inside
    below = F.aggregate(F.sequence(F.lit(120), F.lit(1), F.lit(-1)), F.lit(0.0), lambda acc, k: k / (z + acc))
    return F.when(z < 2.0, 0.5 - density * series).otherwise(density / (z + below))


def normal_z_value(p: Column) -> Column:
    """z with upper tail probability p: rational start (Abramowitz & Stegun 26.2.23) and Newton steps on the tail; null outside (0, 1)."""
    q = F.least(p, 1.0 - p)
    t = F.sqrt(-2.0 * F.ln(q))
    z = t - (2.515517 + t * (0.802853 + t * 0.010328)) / (1.0 + t * (1.432788 + t * (0.189269 + t * 0.001308)))
    step = lambda z, _: F.greatest(F.lit(0.0), z + (normal_tail(z) - q) * math.sqrt(2.0 * math.pi) * F.exp(0.5 * z * z))
    z = F.aggregate(F.sequence(F.lit(1), F.lit(4)), F.greatest(F.lit(0.0), z), step)
    return F.when((p > 0) & (p < 1), F.when(p > 0.5, -z).otherwise(z))


def ellipse_limits(major: Column, minor: Column, pa: Column) -> tuple[Column, Column]:
    """Half extents in x and y of an ellipse with semi-axes and position angle (radians, from the x axis)."""
    c, s = F.cos(pa), F.sin(pa)
    return (F.sqrt(major * major * c * c + minor * minor * s * s), F.sqrt(major * major * s * s + minor * minor * c * c))


def quadratic_through(x: tuple[float, float, float], y: tuple[Column, Column, Column]) -> tuple[Column, Column, Column]:
    """(c0, c1, c2) of the parabola through three points."""
    (x0, x1, x2), (y0, y1, y2) = x, y
    d = (x0 - x1) * (x0 - x2) * (x1 - x2)
    c2 = (y0 * (x1 - x2) + y1 * (x2 - x0) + y2 * (x0 - x1)) / d
    c1 = (y0 * (x2 * x2 - x1 * x1) + y1 * (x0 * x0 - x2 * x2) + y2 * (x1 * x1 - x0 * x0)) / d
    c0 = (y0 * (x1 * x2 * (x1 - x2)) + y1 * (x0 * x2 * (x2 - x0)) + y2 * (x0 * x1 * (x0 - x1))) / d
    return c0, c1, c2


def luminosity_distance(z: Column, h0: float = 70.0, om: float = 0.3, steps: int = 64) -> Column:
    """Luminosity distance (Mpc) in a flat universe, by Simpson's rule within the row."""
    f = lambda x: 1.0 / F.sqrt(om * F.pow(1.0 + x, F.lit(3.0)) + (1.0 - om))
    nodes = F.sequence(F.lit(0), F.lit(steps))
    weight = lambda i: F.when((i == 0) | (i == steps), 1.0).when(i % 2 == 1, 4.0).otherwise(2.0)
    total = F.aggregate(nodes, F.lit(0.0), lambda acc, i: acc + weight(i) * f(z * i / steps))
    return (1.0 + z) * (C_KM_S / h0) * (z / steps / 3.0) * total
