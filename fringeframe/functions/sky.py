"""Positions on the sky: separations, frames, sexagesimal text, rectangles."""

from __future__ import annotations

import math

from pyspark.sql import Column
from pyspark.sql import functions as F

RAD = math.pi / 180.0

# North galactic pole (J2000) and the ascending node, degrees.
NGP_RA, NGP_DEC, GAL_NODE = 192.859508, 27.128336, 32.932


def _clamp(c: Column) -> Column:
    return F.greatest(F.lit(-1.0), F.least(F.lit(1.0), c))


def separation_deg(ra1: Column, dec1: Column, ra2: Column, dec2: Column) -> Column:
    """Great-circle separation in degrees from positions in degrees."""
    d1, d2 = dec1 * RAD, dec2 * RAD
    cosine = F.cos((ra1 - ra2) * RAD) * F.cos(d1) * F.cos(d2) + F.sin(d1) * F.sin(d2)
    return F.acos(_clamp(cosine)) / RAD


def to_galactic(ra: Column, dec: Column) -> tuple[Column, Column]:
    """(l, b) in degrees from J2000 (ra, dec) in degrees; l is not wrapped."""
    a, d = (ra - NGP_RA) * RAD, dec * RAD
    sin_b = F.cos(d) * math.cos(NGP_DEC * RAD) * F.cos(a) + F.sin(d) * math.sin(NGP_DEC * RAD)
    y = F.sin(d) - sin_b * math.sin(NGP_DEC * RAD)
    x = F.cos(d) * F.sin(a) * math.cos(NGP_DEC * RAD)
    return F.atan2(y, x) / RAD + GAL_NODE, F.asin(_clamp(sin_b)) / RAD


def wrap_degrees(angle: Column) -> Column:
    return F.pmod(angle, F.lit(360.0))


def sexagesimal_to_deg(text: Column) -> Column:
    """'-dd:mm:ss.s' to degrees; blanks also separate; the sign holds for '-00'."""
    p = F.split(F.regexp_replace(F.trim(text), r"[:hdm ]+", ":"), ":")
    mag = (F.abs(p[0].cast("double")) + p[1].cast("double") / 60.0
           + F.regexp_replace(p[2], "s", "").cast("double") / 3600.0)
    return F.when(F.trim(text).startswith("-"), -mag).otherwise(mag)


def deg_to_sexagesimal(deg: Column, digits: int = 2, plus: bool = True) -> Column:
    """Degrees to 'sdd:mm:ss.ss'; rounding is done once, on the smallest unit, so 60 never shows."""
    unit = 10 ** digits
    total = F.floor(F.abs(deg) * (3600 * unit) + F.lit(0.5)).cast("long")
    sec = total % (60 * unit)
    minutes = F.floor(total / F.lit(60 * unit)).cast("long")
    sign = F.when(deg < 0, "-").otherwise("+" if plus else "")
    return F.concat(
        sign, F.lpad(F.floor(minutes / F.lit(60)).cast("string"), 2, "0"), F.lit(":"),
        F.lpad((minutes % 60).cast("string"), 2, "0"), F.lit(":"),
        F.lpad(F.floor(sec / F.lit(unit)).cast("string"), 2, "0"), F.lit("."),
        F.lpad((sec % unit).cast("string"), digits, "0"),
    )


def rect_corners(ra: float, dec: float, width: float, height: float) -> list[tuple[float, float]]:
    """Corners of a rectangle, right ascension wrapped to [0, 360)."""
    return [((ra + sx * width / 2) % 360.0, dec + sy * height / 2)
            for sx, sy in ((-1, 1), (1, 1), (1, -1), (-1, -1))]


def in_rect(ra: Column, dec: Column, centre_ra: float, centre_dec: float, width: float, height: float) -> Column:
    """Inside the rectangle in (ra, dec), across the 0/360 line too."""
    d_ra = F.pmod(ra - F.lit(centre_ra - width / 2), F.lit(360.0))
    return (d_ra <= F.lit(float(width))) & dec.between(centre_dec - height / 2, centre_dec + height / 2)


def direction_cosines(ra: Column, dec: Column, ra0: Column, dec0: Column) -> tuple[Column, Column]:
    """(l, m) of a position relative to a phase centre, all in degrees."""
    dr = (ra - ra0) * RAD
    el = F.cos(dec * RAD) * F.sin(dr)
    em = F.sin(dec * RAD) * F.cos(dec0 * RAD) - F.cos(dec * RAD) * F.sin(dec0 * RAD) * F.cos(dr)
    return el, em
