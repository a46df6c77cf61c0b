"""Array geometry, delays and channel bookkeeping as Column expressions."""

from __future__ import annotations

import math

from pyspark.sql import Column
from pyspark.sql import functions as F

C_M_S = 299792458.0  # fixed value: speed of light
SIDEREAL = 1.0027379 / 86400.0  # fixed value: turns per second


def baseline_uvw(dx: Column, dy: Column, dz: Column, h0: Column, dec: Column) -> tuple[Column, Column, Column]:
    """(u, v, w) of an antenna difference (second minus first), apparent frame, angles in radians."""
    sh, ch, sd, cd = F.sin(h0), F.cos(h0), F.sin(dec), F.cos(dec)
    return (-sh * dx - ch * dy, sd * ch * dx - sd * sh * dy - cd * dz, -cd * ch * dx + cd * sh * dy - sd * dz)


def antenna_delay(x: Column, y: Column, z: Column, h0: Column, dec: Column) -> Column:
    """Geometric delay (s) of an antenna."""
    return (-F.cos(dec) * F.cos(h0) * x + F.cos(dec) * F.sin(h0) * y - F.sin(dec) * z) / C_M_S


def fringe_rate(x: Column, y: Column, h0: Column, dec: Column, lo_hz: Column) -> Column:
    """Fringe rate (rad/s) of an antenna at an effective local-oscillator frequency."""
    return (F.cos(dec) * F.sin(h0) * x + F.cos(dec) * F.cos(h0) * y) * SIDEREAL * (2 * math.pi / C_M_S) * lo_hz


def baseline_row(ant1: Column, ant2: Column, beam: Column, n_ant: int) -> Column:
    """Row of an upper-triangle baseline (ant1 <= ant2), beams outermost."""
    before = ant1 * n_ant - F.floor(ant1 * (ant1 + 1) / F.lit(2))
    return beam * (n_ant * (n_ant + 1) // 2) + before + ant2


def channel_frequency(chan: Column, stream: Column, per_stream: int, centre: float, width: float, total: int) -> Column:
    """Frequency of a channel of a stream, streams side by side about the centre."""
    first = centre - width * total / 2.0 + width / 2.0
    return first + (stream * per_stream + chan) * width


def rotate(re: Column, im: Column, freq0: float, df: float, offset: Column, delay: Column) -> Column:
    """Spectrum times exp(i (offset + 2 pi f delay)), as array<struct<re, im>>."""
    z = F.arrays_zip(re.alias("re"), im.alias("im"))
    phase = lambda i: offset + 2 * math.pi * (freq0 + i * df) * delay
    return F.transform(z, lambda s, i: F.struct(
        (s["re"] * F.cos(phase(i)) - s["im"] * F.sin(phase(i))).alias("re"),
        (s["re"] * F.sin(phase(i)) + s["im"] * F.cos(phase(i))).alias("im")))


def deripple(values: Column, coefficients: list[float]) -> Column:
    """Multiply by a repeating list of coefficients; its length must divide the spectrum's."""
    n = len(coefficients)
    coef = F.array(*[F.lit(float(c)) for c in coefficients])
    scaled = F.transform(values, lambda x, i: x * F.element_at(coef, i % n + 1))
    return F.when(F.size(values) % n == 0, scaled).otherwise(
        F.raise_error(F.lit(f"number of channels is not a multiple of {n}")).cast("array<double>"))
