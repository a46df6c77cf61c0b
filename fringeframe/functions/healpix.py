"""HEALPix nested indexing in Column arithmetic (Gorski et al. 2005), up to nside 2^16.

The sky model uses nside 1024.  Searches narrow the sky in factors of eight,
nside 8 -> 64 -> 512, and end with a test on the component's own pixel.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .bind import let
from .sky import RAD, separation_deg

NSIDE = 1024  # fixed value: 2 << 9
STEPS = (8, 64, 512)


def _bits(nside: int) -> int:
    if nside < 1 or nside & (nside - 1) or nside > 1 << 16:
        raise ValueError("nside must be a power of two up to 65536")
    return nside.bit_length() - 1


def _interleave(x: Column, y: Column, bits: int) -> Column:
    """Bits of x at even, of y at odd places."""
    out = F.lit(0).cast("long")
    for i in range(bits):
        one = F.lit(1 << i).cast("long")
        out = out + F.shiftleft(x.bitwiseAND(one), i) + F.shiftleft(y.bitwiseAND(one), i + 1)
    return out


def _deinterleave(p: Column, bits: int) -> tuple[Column, Column]:
    """The numbers whose bits are at even and at odd places."""
    x = y = F.lit(0).cast("long")
    for i in range(bits):
        x = x + F.shiftright(p.bitwiseAND(F.lit(1 << 2 * i).cast("long")), i)
        y = y + F.shiftright(p.bitwiseAND(F.lit(2 << 2 * i).cast("long")), i + 1)
    return x, y


def _mod4(c: Column) -> Column:
    return c.bitwiseAND(F.lit(3).cast("long"))


def ang2pix_nest(nside: int, ra: Column, dec: Column) -> Column:
    """Nested pixel index of a position in degrees."""
    k = _bits(nside)
    low = F.lit(nside - 1).cast("long")
    whole = lambda c: F.floor(c).cast("long")

    def belt(s):  # crossing edge lines, counted along both diagonals
        a, b = (F.lit(0.5) + s["t"]) * nside, s["z"] * (0.75 * nside)
        return F.struct(whole(a - b).alias("p"), whole(a + b).alias("m"))

    def belt_face(e):
        fp, fm = F.shiftright(e["p"], k), F.shiftright(e["m"], k)
        face = F.when(fp == fm, _mod4(fp) + 4).when(fp < fm, _mod4(fp)).otherwise(_mod4(fm) + 8)
        return F.struct(face.alias("face"), e["m"].bitwiseAND(low).alias("x"),
                        (low - e["p"].bitwiseAND(low)).alias("y"))

    def cap(s):
        quarter = F.least(F.lit(3).cast("long"), whole(s["t"]))
        ring = F.sqrt(3.0 * (1.0 - F.abs(s["z"]))) * nside
        return F.struct(quarter.alias("q"), (s["z"] >= 0).alias("north"),
                        F.least(low, whole((s["t"] - quarter) * ring)).alias("p"),
                        F.least(low, whole((1.0 - s["t"] + quarter) * ring)).alias("m"))

    def cap_face(e):
        return F.struct(F.when(e["north"], e["q"]).otherwise(e["q"] + 8).alias("face"),
                        F.when(e["north"], low - e["m"]).otherwise(e["p"]).alias("x"),
                        F.when(e["north"], low - e["p"]).otherwise(e["m"]).alias("y"))

    def place(s):
        return F.when(F.abs(s["z"]) <= 2.0 / 3.0, let(belt(s), belt_face)).otherwise(let(cap(s), cap_face))

    sky_point = F.struct(F.sin(dec * RAD).alias("z"), (F.pmod(ra, F.lit(360.0)) / 90.0).alias("t"))
    return let(let(sky_point, place), lambda f: F.shiftleft(f["face"], 2 * k) + _interleave(f["x"], f["y"], k))


def pix2ang_nest(nside: int, pix: Column) -> Column:
    """Struct (ra, dec) in degrees of a pixel centre."""
    k = _bits(nside)

    def split(p):
        x, y = _deinterleave(p, k)
        return F.struct(F.shiftright(p, 2 * k).alias("face"), x.alias("x"), y.alias("y"))

    def ring(s):
        row = F.shiftright(s["face"], 2)
        return F.struct(s["face"].alias("face"), (s["x"] - s["y"]).alias("d"), row.alias("row"),
                        ((row + 2) * nside - s["x"] - s["y"] - 1).alias("jr"))

    def zone(s):
        jr = s["jr"]
        north, south = jr < nside, jr > 3 * nside
        nr = F.when(north, jr).when(south, 4 * nside - jr).otherwise(F.lit(nside).cast("long"))
        odd = F.when(north | south, F.lit(0).cast("long")).otherwise(_mod4(jr - nside).bitwiseAND(F.lit(1).cast("long")))
        column = _mod4(s["face"]) * 2 + F.when(s["row"] == 1, F.lit(0)).otherwise(F.lit(1))
        return F.struct(nr.alias("nr"), odd.alias("odd"), north.alias("north"), south.alias("south"),
                        jr.alias("jr"), F.shiftright(column * nr + s["d"] + 1 + odd, 1).alias("jp"))

    def angles(s):
        nr, jp = s["nr"], s["jp"]
        cap = 1.0 - nr * nr / F.lit(3.0 * nside * nside)
        z = F.when(s["north"], cap).when(s["south"], -cap).otherwise((2 * nside - s["jr"]) * (2.0 / (3.0 * nside)))
        jp = F.when(jp > 4 * nr, jp - 4 * nr).when(jp < 1, jp + 4 * nr).otherwise(jp)
        return F.struct(((jp - (s["odd"] + 1) * 0.5) * 90.0 / nr).alias("ra"), (F.asin(z) / RAD).alias("dec"))

    return let(let(let(let(pix.cast("long"), split), ring), zone), angles)


def max_pixel_radius_deg(nside: int) -> float:
    """Largest distance from a pixel centre to its corner."""
    za, pa = 2.0 / 3.0, math.pi / (4.0 * nside)
    t = 1.0 - 1.0 / nside
    zb = 1.0 - t * t / 3.0
    sa, sb = math.sqrt(1 - za * za), math.sqrt(1 - zb * zb)
    return math.degrees(math.acos(min(1.0, sa * sb * math.cos(pa) + za * zb)))


def _margin_deg(nside: int) -> float:
    """How far outside an area a pixel's centre may be; a coarse pixel passes if any of its finest pixels does."""
    return max_pixel_radius_deg(nside) + (max_pixel_radius_deg(NSIDE) if nside < NSIDE else 0.0)


def disc_test(nside: int, pix: Column, ra: Column, dec: Column, radius: Column) -> Column:
    """May the pixel overlap the disc?  Never false for one that does."""
    return let(pix2ang_nest(nside, pix), lambda c: separation_deg(c["ra"], c["dec"], ra, dec)
                <= radius + _margin_deg(nside))


def polygon_test(nside: int, pix: Column, corners: list[tuple[float, float]]) -> Column:
    """May the pixel overlap the convex polygon of great circles through ``corners``?"""
    vec = [(math.cos(d * RAD) * math.cos(r * RAD), math.cos(d * RAD) * math.sin(r * RAD), math.sin(d * RAD))
           for r, d in corners]
    mid = [sum(v[i] for v in vec) for i in range(3)]
    margin = -math.sin(_margin_deg(nside) * RAD)

    def inside(p):
        ok = F.lit(True)
        for i, a in enumerate(vec):
            b = vec[(i + 1) % len(vec)]
            n = (a[1] * b[2] - a[2] * b[1], a[2] * b[0] - a[0] * b[2], a[0] * b[1] - a[1] * b[0])
            norm = math.sqrt(sum(c * c for c in n))
            if norm < 1e-12:
                continue  # two corners coincide: the edge has no direction
            if sum(c * m for c, m in zip(n, mid)) < 0:
                norm = -norm
            ok = ok & (p["x"] * (n[0] / norm) + p["y"] * (n[1] / norm) + p["z"] * (n[2] / norm) >= margin)
        return ok

    unit = lambda c: F.struct((F.cos(c["dec"] * RAD) * F.cos(c["ra"] * RAD)).alias("x"),
                              (F.cos(c["dec"] * RAD) * F.sin(c["ra"] * RAD)).alias("y"),
                              F.sin(c["dec"] * RAD).alias("z"))
    return let(let(pix2ang_nest(nside, pix), unit), inside)


def search_nside(radius_deg: float) -> int:
    """Pixel size for a search: a few hundred to a few thousand pixels whatever the radius."""
    return 512 if radius_deg <= 1.5 else 64 if radius_deg <= 12.0 else 8


def cover(areas: DataFrame, nside: int, test, name: str = "pixel") -> DataFrame:
    """One row per (area, pixel of ``nside``) that passes ``test(nside, pixel)``; narrow steps only."""
    pix = F.col("__pix")
    out = areas.withColumn("__pix", F.explode(F.sequence(F.lit(0).cast("long"), F.lit(767).cast("long"))))
    out = out.where(test(8, pix))
    for step in STEPS[1:]:
        if step > nside:
            break
        out = out.withColumn("__pix", F.explode(F.sequence(pix * 64, pix * 64 + 63))).where(test(step, pix))
    return out.withColumnRenamed("__pix", name)


#: Ranges that a search names; closer ones are joined, and the test on the component's own pixel decides.
RANGES = 64


def index_ranges(pixels: list[int], nside: int) -> list[tuple[int, int]]:
    """Pixels of ``nside`` as at most RANGES ranges (both ends inside) of the index at NSIDE."""
    width = (NSIDE // nside) ** 2
    out: list[tuple[int, int]] = []
    for p in sorted(set(pixels)):
        if out and p * width == out[-1][1] + 1:
            out[-1] = out[-1][0], (p + 1) * width - 1
        else:
            out.append((p * width, (p + 1) * width - 1))
    gaps = sorted(range(1, len(out)), key=lambda i: out[i][0] - out[i - 1][1])
    closed = set(gaps[: max(0, len(out) - RANGES)])
    merged: list[tuple[int, int]] = []
    for i, (lo, hi) in enumerate(out):
        if i in closed:
            merged[-1] = merged[-1][0], hi
        else:
            merged.append((lo, hi))
    return merged
