"""Streaming sources: correlator datagrams and telescope metadata."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..schemas import DATAGRAM, TYPED_VALUES


def datagrams(spark: SparkSession, path: str, files_per_trigger: int | None = None) -> DataFrame:
    """Stream of datagrams from a folder that files arrive in."""
    r = spark.readStream.schema(DATAGRAM)
    if files_per_trigger:
        r = r.option("maxFilesPerTrigger", files_per_trigger)
    return r.parquet(path)


def unpack(grams: DataFrame, baselines_per_slice: int) -> DataFrame:
    """One row per (time, channel, beam, baseline): the payload of each slice is numbered on."""
    d = grams.select("timestamp", "channel", "freq", "beam", "slice", F.posexplode("payload").alias("k", "z"))
    return d.select("timestamp", "channel", "freq", "beam", (F.col("slice") * baselines_per_slice + F.col("k")).alias("baseline"),
                    F.col("z.re").alias("re"), F.col("z.im").alias("im"))


def metadata(spark: SparkSession, path: str) -> DataFrame:
    """Stream of metadata records from JSON lines ``{timestamp, data: {name: {type, value}}}``."""
    return typed_metadata(spark.readStream.schema("value string").text(path))


def typed_metadata(lines: DataFrame) -> DataFrame:
    """Typed-value map to a record; an idle cycle (negative scan) carries only time and scan."""
    d = lines.select(F.from_json("value", TYPED_VALUES).alias("m")).select("m.timestamp", "m.data")
    get = lambda n: F.try_element_at("data", F.lit(n))["value"]
    scan = get("scan_id").cast("long")
    keep = lambda c: F.when(F.col("scan_id") >= 0, c)
    d = d.withColumn("scan_id", scan)
    return d.select(
        "timestamp", "scan_id", keep(get("flagged").cast("boolean")).alias("flagged"), keep(get("sky_frequency").cast("double")).alias("centre_mhz"),
        keep(get("target_name")).alias("target_name"), keep(get("corrmode")).alias("corr_mode"), F.col("data").alias("values"))
