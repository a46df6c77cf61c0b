"""Correlator datagrams in binary files as a stream source with offsets.

Receivers append fixed-size records to files of a folder. The offset of a stream is the number of
bytes of every file that it has read, so a restarted query goes on where its checkpoint says, files
may grow between triggers, and a record that is only half written waits. A trigger's bytes are read
in ranges, one a task.
"""

from __future__ import annotations

import uuid
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.datasource import DataSource, DataSourceStreamReader, InputPartition

from .votable import documents, file_system

#: Fields of a record before its visibilities, little-endian and packed.
FIELDS = [("version", "<u4"), ("slice", "<u4"), ("timestamp", "<u8"), ("block", "<u4"), ("card", "<u4"), ("channel", "<u4"), ("freq", "<f8"), ("beam", "<u4"),
          ("baseline1", "<u4"), ("baseline2", "<u4")]
SCHEMA = ("version long, slice long, timestamp long, block long, card long, channel long, freq double, beam long, baseline1 long, baseline2 long, "
          "payload array<struct<re:float,im:float>>")
RECORDS = 1 << 14  # of a range


def layout(baselines: int) -> np.dtype:
    """Record of a datagram with room for so many baselines."""
    return np.dtype([*FIELDS, ("vis", "<f4", (baselines, 2))])


class _Range(InputPartition):
    def __init__(self, file: str, start: int, end: int):
        self.file, self.start, self.end = file, start, end


class _Reader(DataSourceStreamReader):
    def __init__(self, path: str, baselines: int, records: int):
        self.path, self.baselines, self.records = path, baselines, records

    def initialOffset(self) -> dict:
        return {}

    def latestOffset(self) -> dict:
        size = layout(self.baselines).itemsize
        return {f: n // size * size for f, n in documents(self.path)[1]}

    def partitions(self, start: dict, end: dict) -> list[InputPartition]:
        step = self.records * layout(self.baselines).itemsize
        return [_Range(f, a, min(a + step, n)) for f, n in sorted(end.items()) for a in range(start.get(f, 0), n, step)]

    def read(self, partition: _Range) -> Iterator[pa.RecordBatch]:
        system, _ = file_system(self.path)
        kind = layout(self.baselines)
        with system.open_input_file(partition.file) as f:
            raw = f.read_at(partition.end - partition.start, partition.start)
        rec = np.frombuffer(raw, kind)
        for lo in range(0, len(rec), 1024):
            r = rec[lo : lo + 1024]
            n = (r["baseline2"].astype(np.int64) - r["baseline1"] + 1).clip(0, self.baselines)
            used = np.arange(self.baselines) < n[:, None]
            pairs = pa.StructArray.from_arrays([pa.array(r["vis"][..., k][used]) for k in (0, 1)], ["re", "im"])
            lists = pa.ListArray.from_arrays(pa.array(np.concatenate(([0], np.cumsum(n))), pa.int32()), pairs)
            cols = [pa.array(r[c].astype(np.float64 if c == "freq" else np.int64)) for c, _ in FIELDS]
            yield pa.RecordBatch.from_arrays([*cols, lists], [*[c for c, _ in FIELDS], "payload"])

    def commit(self, end: dict) -> None:
        """Files stay; nothing is kept for a committed offset."""


class DatagramSource(DataSource):
    """Format ``datagrams``. Options: ``path``, ``baselines`` (room of a record), ``records`` (of a range)."""

    @classmethod
    def name(cls) -> str:
        return "datagrams"

    def schema(self) -> str:
        return SCHEMA

    def streamReader(self, schema) -> DataSourceStreamReader:
        return _Reader(self.options["path"], int(self.options["baselines"]), int(self.options.get("records", RECORDS)))


def stream(spark: SparkSession, path: str, baselines: int, records: int = RECORDS) -> DataFrame:
    """Stream of the datagrams in the files of a folder."""
    spark.dataSource.register(DatagramSource)
    return spark.readStream.format("datagrams").option("baselines", baselines).option("records", records).load(path)


def unpack(grams: DataFrame) -> DataFrame:
    """One row per (time, channel, beam, baseline); visibilities that were not sent are NaN and left out."""
    d = grams.select("timestamp", "channel", "freq", "beam", "baseline1", F.posexplode("payload").alias("k", "z")).where(~F.isnan("z.re"))
    return d.select("timestamp", "channel", "freq", "beam", (F.col("baseline1") + F.col("k")).alias("baseline"), F.col("z.re").alias("re"), F.col("z.im").alias("im"))


def write(grams: DataFrame, path: str, baselines: int) -> DataFrame:
    """Append datagrams (columns of the schema) to a folder, a file a task, each put in place when it is whole; returns (file, n)."""
    kind = layout(baselines)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        system, root = file_system(path)
        system.create_dir(root, recursive=True)
        name, n = uuid.uuid4().hex, 0
        with system.open_output_stream(f"{root}/_{name}") as f:
            for b in batches:
                rec = np.zeros(b.num_rows, kind)
                for c, _ in FIELDS:
                    rec[c] = b.column(c).to_numpy(zero_copy_only=False)
                rec["vis"] = np.nan
                for i, p in enumerate(b.column("payload").to_pylist()):
                    for k, z in enumerate(p):
                        if z is not None:
                            rec["vis"][i, k] = z["re"], z["im"]
                f.write(rec.tobytes())
                n += len(rec)
        if n:
            system.move(f"{root}/_{name}", f"{root}/{name}.dat")
        yield pa.RecordBatch.from_arrays([pa.array([name]), pa.array([n])], ["file", "n"])

    return grams.select(*[c for c, _ in FIELDS], "payload").mapInArrow(run, "file string, n long")
