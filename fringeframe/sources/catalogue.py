"""Component catalogues: text, simulated-sky text, XML tables, and the written column set."""

from __future__ import annotations

import math
from collections.abc import Mapping

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.spectral import quadratic_through
from ..operators.skymodel import index_components
from . import publish

#: Factor to the canonical unit (deg, arcsec, Jy) of each column kind.
UNITS = {"deg": 1.0, "rad": 180.0 / math.pi, "arcsec": 1.0, "arcmin": 60.0, "Jy": 1.0, "mJy": 1e-3, "uJy": 1e-6, "": 1.0}


def fix_axes(df: DataFrame) -> DataFrame:
    """Major axis not below the minor; a zero minor axis of a resolved source becomes 1e-15 arcsec."""
    a, b = F.greatest("maj_axis", "min_axis"), F.least("maj_axis", "min_axis")
    d = df.withColumn("__a", a).withColumn("__b", b)
    minor = F.when((F.col("__a") > 0) & (F.col("__b") == 0), F.lit(1e-15)).otherwise(F.col("__b"))
    return d.withColumn("maj_axis", F.col("__a")).withColumn("min_axis", minor).drop("__a", "__b")


def parse_text(lines: DataFrame, spec: Mapping[str, tuple[int, str]], n_tokens: int) -> tuple[DataFrame, DataFrame]:
    """(components, rejected) from lines in ``value``; ``spec`` maps a name to (column number, unit).

    A line is rejected if it has another number of tokens or a field that is no number;
    blank lines and comments are neither.
    """
    d = lines.where(~F.col("value").rlike(r"^\s*(#|$)")).withColumn("__t", F.split(F.trim("value"), r"\s+"))
    vals = {n: F.try_element_at("__t", F.lit(i + 1)).try_cast("double") * UNITS[u] for n, (i, u) in spec.items()}
    for n, c in vals.items():
        d = d.withColumn(n, c)
    ok = F.size("__t") == n_tokens
    for n in spec:
        ok = ok & F.col(n).isNotNull()
    d = d.withColumn("__ok", ok)
    good = fix_axes(d.where("__ok")).drop("__t", "__ok", "value")
    return good, d.where("NOT __ok").drop("__t", "__ok", *spec)


def read_text(spark: SparkSession, path: str, spec: Mapping[str, tuple[int, str]], n_tokens: int) -> tuple[DataFrame, DataFrame]:
    return parse_text(spark.read.text(path), spec, n_tokens)


def parse_simulated_sky(lines: DataFrame) -> DataFrame:
    """Simulated-sky lines of 13 tokens: position, log10 flux at 610/1400/4860 MHz, axes, angle in radians.

    Index and curvature are the parabola in log flux against log frequency through the three points.
    """
    d = lines.withColumn("__t", F.split(F.trim("value"), r"\s+"))
    tok = lambda i: F.element_at("__t", i + 1).cast("double")
    d = d.where(F.size("__t") == 13)
    x = (math.log10(610.0 / 1400.0), 0.0, math.log10(4860.0 / 1400.0))
    _, c1, c2 = quadratic_through(x, (tok(9), tok(10), tok(11)))
    rest = [c for c in lines.columns if c != "value"]
    return d.select(*rest, tok(3).alias("ra"), tok(4).alias("dec"), (1000.0 * F.pow(F.lit(10.0), tok(10))).alias("flux_mjy"), tok(6).alias("maj_axis"),
                    tok(7).alias("min_axis"), F.degrees(tok(5)).alias("pa"), c1.alias("spectral_index"), c2.alias("spectral_curvature"))


def read_votable(spark: SparkSession, path: str, columns: Mapping[str, str]) -> DataFrame:
    """Rows of an XML table: each TR's TDs in order, named and typed by ``columns`` (name to type, in field order)."""
    schema = "TD array<string>"
    rows = spark.read.format("xml").option("rowTag", "TR").schema(schema).load(path)
    return rows.select(*[F.get("TD", F.lit(i)).try_cast(t).alias(n) for i, (n, t) in enumerate(columns.items())])


def field_names(spark: SparkSession, path: str) -> list[tuple[str, str]]:
    """(name, ucd) of the FIELDs of an XML table, in order; the header is a few dozen elements."""
    f = spark.read.format("xml").option("rowTag", "FIELD").schema("_name string, _ucd string").load(path)
    return [(r["_name"], r["_ucd"]) for r in f.collect()]


def load_components(spark: SparkSession, components: str, columns: Mapping[str, str], polarisation: str | None = None,
                    pol_columns: Mapping[str, str] | None = None) -> DataFrame:
    """Components from an XML table with their pixel index, and polarisation matched on component id if given."""
    c = index_components(read_votable(spark, components, columns), "ra", "dec")
    if polarisation is None:
        return c
    return c.join(read_votable(spark, polarisation, pol_columns), "component_id", "left")


def ingest(components: DataFrame, path: str, sb_id: int, obs_date: str | None = None, source: str | None = None, batch: str | None = None, retries: int = 0) -> DataFrame:
    """Add the components of a scheduling block to the sky model, partitioned by coarse pixel; returns their ids.

    The block is published as one batch (``batch`` names it, else the block's number does): a job that
    is run again adds nothing and returns the ids of the first run. ``retries`` more attempts are made
    when one fails. The id is a hash of scheduling block and component name; two components of one
    batch with the same id are an error.
    """
    batch = batch or f"sb{sb_id}"
    d = components if "healpix_index" in components.columns else index_components(components, "ra", "dec")
    d = (d.withColumn("sb_id", F.lit(sb_id).cast("long")).withColumn("observation_date", F.lit(obs_date).cast("timestamp"))
         .withColumn("data_source", F.lit(source).cast("string")).withColumn("id", F.xxhash64(F.lit(sb_id).cast("long"), "component_id")))
    # rebalancing gives each pixel few files, and splits a crowded one over several tasks
    d = d.hint("rebalance", "healpix_coarse").sortWithinPartitions("healpix_coarse", "healpix_index")
    spark = d.sparkSession
    for attempt in range(retries + 1):
        try:
            if not publish.exists(spark, f"{path}/manifest/{batch}.json") and not components.groupBy("component_id").count().where("count > 1").isEmpty():
                raise ValueError("two components of one name")
            publish.publish(d, path, batch, {"sb_id": sb_id, "observation_date": obs_date, "data_source": source}, ["healpix_coarse"])
            break
        except ValueError:
            raise
        except Exception:
            if attempt == retries:
                raise
    return publish.published(spark, path, [batch]).select("id", "component_id")


def model(spark: SparkSession, path: str) -> DataFrame:
    """All published components of a sky model."""
    return publish.published(spark, path)


#: Written names and decimals of the component catalogue.
COMPONENT_COLUMNS = {"comp_id": ("component_id", None), "island_id": ("island_id", None), "ra_deg": ("ra_deg_cont", 6), "dec_deg": ("dec_deg_cont", 6),
                     "freq_mhz": ("freq", 1), "flux_peak": ("flux_peak", 3), "spectral_index": ("spectral_index", 2)}


def component_columns(df: DataFrame) -> DataFrame:
    """The catalogue's names and precision; columns it does not know are left out."""
    out = []
    for name, (target, digits) in COMPONENT_COLUMNS.items():
        if name in df.columns:
            c = F.col(name) if digits is None else F.round(name, digits)
            out.append(c.alias(target))
    return df.select(*out)


def write_catalogue(df: DataFrame, path: str, fmt: str = "parquet") -> None:
    """Write a catalogue as parquet, csv with header, or XML rows."""
    w = component_columns(df).write.mode("overwrite")
    if fmt == "csv":
        w.option("header", True).csv(path)
    elif fmt == "xml":
        w.format("xml").option("rootTag", "TABLEDATA").option("rowTag", "TR").save(path)
    else:
        w.parquet(path)
