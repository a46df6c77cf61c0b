"""Sky-model component table: spatial index, searches and footprints."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import healpix as hp
from ..functions import sky
from .select import criteria

_FINE_BITS = 10  # nside 1024


def index_components(df: DataFrame, ra: str = "ra_deg", dec: str = "dec_deg") -> DataFrame:
    """Add ``healpix_index`` (nested, nside 1024) and ``healpix_coarse`` (nside 4, for partitioning)."""
    idx = hp.ang2pix_nest(hp.NSIDE, F.col(ra), F.col(dec))
    return df.withColumn("healpix_index", idx).withColumn("healpix_coarse", F.shiftright("healpix_index", 16))


def _at(nside: int):
    return F.shiftright("healpix_index", 2 * (_FINE_BITS - (nside.bit_length() - 1)))


def _within(df: DataFrame, test, nside: int) -> DataFrame:
    """Components whose own pixel passes.

    The area's pixels at ``nside``, a few thousand at most by ``search_nside``, become ranges of
    the index: plain comparisons that a scan of a table sorted by ``healpix_index`` uses to skip row groups.
    """
    one = df.sparkSession.range(1).select(F.lit(1).alias("__one"))
    pixels = [r[0] for r in hp.cover(one, nside, test, "__p").select("__p").collect()]
    near = F.lit(False)
    for lo, hi in hp.index_ranges(pixels, nside):
        near = near | F.col("healpix_index").between(lo, hi)
    return df.where(near).where(test(hp.NSIDE, F.col("healpix_index")))


def cone_search(df: DataFrame, ra: float, dec: float, radius: float, bounds=None, exact: bool = False) -> DataFrame:
    """Components in pixels that overlap the disc, then criteria.

    As in a pixel index search, rows just outside the rim can appear; ``exact``
    adds the separation test.
    """
    def test(nside, pix):
        return hp.disc_test(nside, pix, F.lit(float(ra)), F.lit(float(dec)), F.lit(float(radius)))

    out = _within(df, test, hp.search_nside(radius))
    if exact:
        out = out.where(sky.separation_deg(F.col("ra_deg"), F.col("dec_deg"), F.lit(float(ra)), F.lit(float(dec)))
                        <= F.lit(float(radius)))
    return out.where(criteria(bounds)) if bounds else out


def rect_search(df: DataFrame, ra: float, dec: float, width: float, height: float, bounds=None,
                exact: bool = False) -> DataFrame:
    """Components in pixels that overlap the polygon of the four wrapped corners.

    ``exact`` asks for the box in right ascension and declination instead, which
    is a plain range that the scan can use.
    """
    if exact:
        out = df.where(sky.in_rect(F.col("ra_deg"), F.col("dec_deg"), ra, dec, width, height))
    else:
        corners = sky.rect_corners(ra, dec, width, height)
        out = _within(df, lambda nside, pix: hp.polygon_test(nside, pix, corners),
                      hp.search_nside(max(width, height) / 2))
    return out.where(criteria(bounds)) if bounds else out


def footprints(df: DataFrame, fields: DataFrame, field_key: str, radius: float) -> DataFrame:
    """Components of every field at once: pixels per field, equi join on pixel, separation test.

    ``fields`` has ``ra`` and ``dec`` in degrees.
    """
    nside = hp.search_nside(radius)

    def test(n, pix):
        return hp.disc_test(n, pix, F.col("ra"), F.col("dec"), F.lit(float(radius)))

    pixels = hp.cover(fields.select(field_key, "ra", "dec"), nside, test, "__p")
    j = df.withColumn("__p", _at(nside)).join(pixels, "__p").drop("__p")
    return j.where(sky.separation_deg(F.col("ra_deg"), F.col("dec_deg"), F.col("ra"), F.col("dec")) <= F.lit(float(radius)))
