"""Streaming sinks: partitioned visibility tables, messages, and draining a stream into a table."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..session import shared_path


def file_name(pattern: str, ts: Column, beam: Column, chunk: Column) -> Column:
    """Expand ``%d`` (YYYY-MM-DD), ``%t`` (HHMMSS), ``%b`` (beam) and ``%f`` (frequency chunk) in a name."""
    rules = {"%d": F.date_format(ts, "yyyy-MM-dd"), "%t": F.date_format(ts, "HHmmss"), "%b": beam.cast("string"), "%f": chunk.cast("string")}
    parts, rest = [], pattern
    while rest:
        hits = [(rest.index(k), k) for k in rules if k in rest]
        if not hits:
            parts.append(F.lit(rest))
            break
        at, k = min(hits)
        if at:
            parts.append(F.lit(rest[:at]))
        parts.append(rules[k])
        rest = rest[at + len(k):]
    return F.concat(*parts)


def write_visibilities(stream: DataFrame, path: str, checkpoint: str, chans_per_chunk: int,
                       folders: tuple[str, ...] = ("date", "beam", "freq_chunk")):
    """Append visibilities until the source is drained, with a folder for each value of ``folders``.

    Date, beam and frequency chunk stay columns where they are no folder.
    """
    d = stream.withColumn("date", F.to_date("ts")).withColumn("freq_chunk", F.floor(F.col("chan") / chans_per_chunk))
    d = d.repartition(*folders)  # one file a folder and batch, not one a task
    return (d.writeStream.format("parquet").option("path", path).option("checkpointLocation", checkpoint)
            .partitionBy(*folders).trigger(availableNow=True).start())


def as_messages(df: DataFrame, keys: list[str]) -> DataFrame:
    """(key, value) rows for a message sink: key text and the row as JSON."""
    return df.select(F.concat_ws("/", *keys).alias("key"), F.to_json(F.struct(*df.columns)).alias("value"))


def send(stream: DataFrame, write: Callable[[DataFrame, int], None], checkpoint: str):
    """Hand every micro-batch to ``write(batch, id)``; a batch may come again after a failure, with the same id."""
    return stream.writeStream.foreachBatch(write).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()


#: State store with timers and named states.
STATE_STORE = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"


def drain(stream: DataFrame, timers: bool = False) -> DataFrame:
    """Run an append stream until its source is drained and return the written table."""
    spark, key = stream.sparkSession, "spark.sql.streaming.stateStore.providerClass"
    path, ckpt, before = shared_path(spark, "sink"), shared_path(spark, "ckpt"), spark.conf.get(key)
    if timers:
        spark.conf.set(key, STATE_STORE)
    try:
        q = stream.writeStream.format("parquet").option("path", path).option("checkpointLocation", ckpt).trigger(availableNow=True).start()
        q.awaitTermination()
    finally:
        spark.conf.set(key, before)
    return spark.read.schema(stream.schema).parquet(path)


def drain_updates(stream: DataFrame, keys: list[str]) -> DataFrame:
    """Run an update stream until its source is drained; of each key the row of the last batch."""
    spark = stream.sparkSession
    path = shared_path(spark, "updates")
    write = lambda batch, i: batch.withColumn("batch", F.lit(i)).write.mode("overwrite").parquet(f"{path}/part={i}")
    stream.writeStream.outputMode("update").foreachBatch(write).option("checkpointLocation", shared_path(spark, "ckpt")).trigger(availableNow=True).start().awaitTermination()
    rows = spark.read.parquet(path)
    return rows.groupBy(*keys).agg(F.max_by(F.struct(*[c for c in stream.columns if c not in keys]), "batch").alias("r")).select(*keys, "r.*")
