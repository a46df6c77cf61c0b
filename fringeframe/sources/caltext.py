"""Calibration solutions as text lines ``gain.g11.<ant>.<beam> = [re, im]``."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F


def _pair(re: Column, im: Column) -> Column:
    return F.format_string("[%.6f, %.6f]", re, im)


def _line(prefix: str, value: Column) -> Column:
    return F.concat(F.lit(prefix), F.lit("."), F.col("ant").cast("string"), F.lit("."), F.col("beam").cast("string"),
                    F.lit(" = "), value)


def gain_lines(gains: DataFrame) -> DataFrame:
    """Lines for the valid gains of (``ant``, ``beam``): columns g1_*, g2_* and their valid flags."""
    items = F.array(*[
        F.when(F.col(f"g{i}_valid"), _line(f"gain.g{i}{i}", _pair(F.col(f"g{i}_re"), F.col(f"g{i}_im")))) for i in (1, 2)])
    return gains.select("ant", "beam", F.explode(F.filter(items, lambda x: x.isNotNull())).alias("line"))


def leakage_lines(leak: DataFrame) -> DataFrame:
    """Both leakage terms, whatever their validity."""
    items = F.array(*[_line(f"leakage.{n}", _pair(F.col(f"{n}_re"), F.col(f"{n}_im"))) for n in ("d12", "d21")])
    return leak.select("ant", "beam", F.explode(items).alias("line"))


def bandpass_lines(band: DataFrame, term: str) -> DataFrame:
    """One line per (ant, beam) with the channels in order, whatever their validity.

    The list is bounded by the number of channels of the instrument.
    """
    g = band.groupBy("ant", "beam").agg(F.array_sort(F.collect_list(F.struct("chan", "g_re", "g_im"))).alias("s"))
    body = F.concat(F.lit("["), F.concat_ws(", ", F.transform("s", lambda x: _pair(x["g_re"], x["g_im"]))), F.lit("]"))
    return g.select("ant", "beam", _line(f"bandpass.{term}", body).alias("line"))


def write_lines(df: DataFrame, path: str, stamp: str | None = None) -> None:
    """Write the lines as text files; the time stamp goes to every part as a comment column value."""
    out = df.select("line") if stamp is None else df.select(F.concat("line", F.lit(f"  # {stamp}")).alias("line"))
    out.write.mode("overwrite").text(path)


_NAME = r"^\s*(gain|leakage)\.(g11|g22|d12|d21)\.(\d+)\.(\d+)\s*=\s*\[\s*([^,\]]+)\s*,\s*([^,\]]+)\s*\]"


def parse_lines(lines: DataFrame) -> DataFrame:
    """Rows (kind, term, ant, beam, re, im) from text lines; comments and other lines are skipped."""
    pick = lambda i: F.regexp_extract("value", _NAME, i)
    return lines.where(F.col("value").rlike(_NAME)).select(
        pick(1).alias("kind"), pick(2).alias("term"), pick(3).cast("long").alias("ant"), pick(4).cast("long").alias("beam"),
        pick(5).cast("double").alias("re"), pick(6).cast("double").alias("im"))


def read_lines(spark: SparkSession, path: str) -> DataFrame:
    return parse_lines(spark.read.text(path))
