"""Cycles of correlator data put together from streams, with event-time timers.

A processor is keyed by stream (a receiving card, a beam) or by cycle. It keeps what has
arrived for cycles that are not closed yet: the time after which a cycle is closed is a timer
in event time, so for data within the delay the same rows come out whatever the size of the
micro-batches. Data behind the watermark, or older than the last closed cycle, is dropped.
The state needs the RocksDB store (``sinks.drain(..., timers=True)`` chooses it).
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle

IDLE, COMPLETE = -1, -2  # fixed values: scan ids with a meaning
LONG_AGO = -(1 << 55)  # milliseconds

MERGED = "stream long, meta_ms long, t_ms long, scan_id long, flag boolean, received array<long>"
CHUNKS = "stream long, t_ms long, n_vis long, n_chan long"
PARTS = "cycle long, stream long, merged_time long, misaligned long, flag boolean"


class _Arrivals:
    """State of the datagrams of one key by their time: how many rows came, and which datagrams."""

    def __init__(self, handle: StatefulProcessorHandle):
        self.map = handle.getMapState("arrived", "t_ms long", "n long, ids array<long>")

    def add(self, rows: pd.DataFrame) -> None:
        for t, ids in rows.groupby("t_ms")["item"]:
            n, had = self.map.getValue((int(t),)) if self.map.containsKey((int(t),)) else (0, [])
            self.map.updateValue((int(t),), (n + len(ids), np.union1d(np.asarray(had, np.int64), ids.to_numpy(np.int64)).tolist()))

    def times(self) -> list[int]:
        return sorted(k[0] for k in self.map.keys())

    def get(self, t: int) -> tuple[int, list[int]]:
        n, ids = self.map.getValue((t,))
        return int(n), [int(i) for i in ids]

    def drop(self, t: int) -> None:
        self.map.removeKey((t,))


class MergeProcessor(StatefulProcessor):
    """Metadata and datagrams of one stream merged into cycles.

    Metadata drives: a cycle at T takes the earliest data time nearer than half an interval, and is
    flagged whole if that is not T; datagrams before it are dropped; without data the cycle is
    skipped (no received datagram). Idle scans give no cycle, a complete scan ends the stream, an
    unknown negative scan or a second record of the same time is an error. A cycle is closed when
    the watermark has passed its half interval and ``wait`` more.
    """

    def __init__(self, interval: int, wait: int, epoch: int):
        self.interval, self.wait, self.epoch = interval, wait, epoch

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.arrived = _Arrivals(handle)
        self.meta = handle.getMapState("meta", "t_ms long", "scan_id long")
        self.head = handle.getValueState("head", "closed_ms long, ended_ms long")  # last closed time, time of the complete record

    def _head(self) -> tuple[int, int | None]:
        if not self.head.exists():
            return LONG_AGO, None
        closed, ended = self.head.get()
        return int(closed), None if ended is None or pd.isna(ended) else int(ended)

    def _due(self, t: int) -> int:
        return self.epoch + t + self.interval // 2 + self.wait

    def handleInputRows(self, key, rows: Iterator[pd.DataFrame], timerValues) -> Iterator[pd.DataFrame]:
        closed, ended = self._head()
        for pdf in rows:
            for t, scan in sorted(zip(*[pdf.loc[pdf["scan_id"].notna(), c].astype("int64") for c in ("t_ms", "scan_id")])):
                if scan < COMPLETE:
                    raise ValueError(f"unexpected scan id {scan}")
                if t <= closed or (ended is not None and t >= ended):
                    continue
                if scan == COMPLETE:
                    ended = t
                elif scan > IDLE:
                    if self.meta.containsKey((t,)):
                        raise ValueError(f"two cycles of time {t}")
                    self.meta.updateValue((t,), (scan,))
                    self.handle.registerTimer(self._due(t))
            data = pdf[pdf["scan_id"].isna()]
            data = data[2 * (data["t_ms"] - closed) > self.interval]
            if len(data):
                self.arrived.add(data)
        self.head.update((closed, ended))
        yield from ()

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[pd.DataFrame]:
        closed, ended = self._head()
        out, times = [], self.arrived.times()
        for t, scan in sorted((int(k[0]), int(v[0])) for k, v in self.meta.iterator()):
            if self._due(t) > expiredTimerInfo.getExpiryTimeInMs():
                break
            self.meta.removeKey((t,))
            if ended is None or t < ended:
                mine = [d for d in times if 2 * abs(d - t) < self.interval]
                got = self.arrived.get(mine[0])[1] if mine else []
                out.append((key[0], t, mine[0] if mine else None, scan, bool(mine) and mine[0] != t, got))
            for d in [d for d in times if 2 * (d - t) <= self.interval]:
                self.arrived.drop(d)
                times.remove(d)
            closed = max(closed, t)
        self.head.update((closed, ended))
        if out:
            yield pd.DataFrame(out, columns=["stream", "meta_ms", "t_ms", "scan_id", "flag", "received"]).astype({"t_ms": "Int64"})


class ChunkProcessor(StatefulProcessor):
    """Without metadata: the datagrams of each time are a chunk; a time at or before the last chunk's is dropped."""

    def __init__(self, wait: int, epoch: int):
        self.wait, self.epoch = wait, epoch

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.arrived = _Arrivals(handle)
        self.last = handle.getValueState("last", "t_ms long")

    def handleInputRows(self, key, rows: Iterator[pd.DataFrame], timerValues) -> Iterator[pd.DataFrame]:
        last = int(self.last.get()[0]) if self.last.exists() else LONG_AGO
        for pdf in rows:
            new = pdf[pdf["t_ms"] > last]
            if len(new):
                self.arrived.add(new)
            for t in new["t_ms"].unique():
                self.handle.registerTimer(self.epoch + int(t) + self.wait)
        yield from ()

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[pd.DataFrame]:
        out = []
        for t in self.arrived.times():
            if self.epoch + t + self.wait > expiredTimerInfo.getExpiryTimeInMs():
                break
            n, ids = self.arrived.get(t)
            out.append((key[0], t, n, len(ids)))
            self.arrived.drop(t)
            self.last.update((t,))
        if out:
            yield pd.DataFrame(out, columns=["stream", "t_ms", "n_vis", "n_chan"])


class VoteProcessor(StatefulProcessor):
    """Parts of one cycle from several streams: the time that most streams have wins, the first stream's on a tie.

    The cycle is closed when ``n_streams`` parts are there or its timer expires; parts with another
    time are flagged and counted. Parts that come later are dropped: a closed cycle is remembered for
    ``keep`` milliseconds of event time, by when the watermark holds them back.
    """

    def __init__(self, n_streams: int, wait: int, epoch: int, keep: int = 60_000):
        self.n_streams, self.wait, self.epoch, self.keep = n_streams, wait, epoch, keep

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.parts = handle.getMapState("parts", "stream long", "t_ms long")
        self.done = handle.getValueState("done", "done boolean")

    def _close(self, cycle: int) -> Iterator[pd.DataFrame]:
        parts = sorted((int(k[0]), int(v[0])) for k, v in self.parts.iterator())
        votes: dict[int, list[int]] = {}
        for stream, t in parts:
            votes.setdefault(t, []).append(stream)
        best = min(votes, key=lambda t: (-len(votes[t]), votes[t][0]))
        rest = len(parts) - len(votes[best])
        self.parts.clear()
        self.done.update((True,))
        self.handle.registerTimer(self.epoch + max(t for _, t in parts) + self.keep)
        yield pd.DataFrame([(cycle, s, best, rest, t != best) for s, t in parts], columns=["cycle", "stream", "merged_time", "misaligned", "flag"])

    def handleInputRows(self, key, rows: Iterator[pd.DataFrame], timerValues) -> Iterator[pd.DataFrame]:
        if self.done.exists():
            return
        first = not self.parts.exists()
        latest, n = None, len(list(self.parts.keys())) if not first else 0
        for pdf in rows:
            for stream, t in zip(pdf["stream"], pdf["t_ms"]):
                n += not self.parts.containsKey((int(stream),))
                self.parts.updateValue((int(stream),), (int(t),))
                latest = int(t) if latest is None else max(latest, int(t))
        if n >= self.n_streams:
            yield from self._close(int(key[0]))
        elif latest is not None:
            self.handle.registerTimer(self.epoch + latest + self.wait)

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[pd.DataFrame]:
        if self.done.exists():
            if not list(self.handle.listTimers()):
                self.done.clear()
        elif self.parts.exists():
            yield from self._close(int(key[0]))


def _run(df: DataFrame, by: str, processor: StatefulProcessor, schema: str) -> DataFrame:
    return df.groupBy(by).transformWithStateInPandas(processor, schema, "Append", "EventTime")


def _timed(df: DataFrame, epoch: int, delay: str) -> DataFrame:
    """``t_ms`` as event time under a watermark."""
    return df.withColumn("event_time", F.timestamp_millis(F.col("t_ms") + F.lit(epoch))).withWatermark("event_time", delay)


def merged_cycles(vis: DataFrame, meta: DataFrame, interval: int, wait: int = 100, epoch: int = 0, delay: str = "2 seconds") -> DataFrame:
    """Closed cycles of each stream from datagrams (stream, t_ms, item) and metadata (stream, t_ms, scan_id).

    ``item`` numbers the datagrams expected in a cycle; ``received`` lists those that came, the others
    stay flagged (:func:`expected_grid`). Times are milliseconds after ``epoch``. The watermark is the
    lower one of the two streams, so that neither runs ahead.
    """
    cols = ("stream", "t_ms", "scan_id", "item", "event_time")
    v = _timed(vis.select("stream", "t_ms", F.lit(None).cast("long").alias("scan_id"), F.col("item").cast("long").alias("item")), epoch, delay).select(*cols)
    m = _timed(meta.select("stream", "t_ms", F.col("scan_id").cast("long").alias("scan_id"), F.lit(None).cast("long").alias("item")), epoch, delay).select(*cols)
    return _run(v.union(m), "stream", MergeProcessor(interval, wait, epoch), MERGED)


def expected_grid(merged: DataFrame, n_items: int) -> DataFrame:
    """A row for each expected datagram of a closed cycle; one that did not arrive is flagged, as is a whole mistimed cycle."""
    grid = merged.withColumn("item", F.explode(F.sequence(F.lit(0).cast("long"), F.lit(n_items - 1).cast("long"))))
    missing = ~F.array_contains("received", F.col("item"))
    return grid.select("stream", "meta_ms", "item", missing.alias("missing"), (missing | F.col("flag")).alias("flag"))


def chunks(vis: DataFrame, wait: int = 100, epoch: int = 0, delay: str = "2 seconds") -> DataFrame:
    """Chunks of each stream by time from datagrams (stream, t_ms, item) when there is no metadata."""
    return _run(_timed(vis.select("stream", "t_ms", F.col("item").cast("long").alias("item")), epoch, delay), "stream", ChunkProcessor(wait, epoch), CHUNKS)


def merged_channels(parts: DataFrame, n_streams: int, wait: int = 100, epoch: int = 0, delay: str = "2 seconds") -> DataFrame:
    """Channel merge of the streams' parts (cycle, stream, t_ms) of each cycle."""
    return _run(_timed(parts.select("cycle", "stream", "t_ms"), epoch, delay), "cycle", VoteProcessor(n_streams, wait, epoch), PARTS)
