"""Stateful stream operators, keyed by stream; the state of a key is a few numbers."""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql.streaming.state import GroupState, GroupStateTimeout

IDLE, COMPLETE = -1, -2  # fixed values: scan ids with a meaning


def _in_time_order(pdfs: Iterator[pd.DataFrame]) -> pd.DataFrame:
    """The rows of one key in one trigger: one per cycle, so as many as cycles arrived."""
    return pd.concat(list(pdfs)).sort_values("cycle")


def _scan_states(key, pdfs: Iterator[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
    scan, done = state.get if state.exists else (IDLE, False)
    pdf = _in_time_order(pdfs)
    out = []
    for cycle, new in zip(pdf["cycle"], pdf["scan_id"]):
        new = int(new)
        if not done:
            if new < COMPLETE:
                raise ValueError(f"unexpected scan id {new}")
            scan, done = new, new == COMPLETE
        out.append((key[0], int(cycle), scan, "complete" if done else "idle" if scan == IDLE else "active"))
    state.update((scan, done))
    yield pd.DataFrame(out, columns=["stream", "cycle", "scan_id", "state"])


def scan_states(meta: DataFrame) -> DataFrame:
    """Scan state per cycle from (stream, cycle, scan_id): idle, active, or complete for good."""
    return meta.groupBy("stream").applyInPandasWithState(
        _scan_states, "stream long, cycle long, scan_id long, state string", "scan long, done boolean", "append", GroupStateTimeout.NoTimeout)


def quack(meta: DataFrame, n: int) -> DataFrame:
    """Flag of each cycle: true for the first ``n`` cycles after a change of scan."""

    def run(key, pdfs, state):
        scan, seen = state.get if state.exists else (None, 0)
        pdf = _in_time_order(pdfs)
        out = []
        for cycle, new in zip(pdf["cycle"], pdf["scan_id"]):
            new = int(new)
            seen = seen + 1 if scan is not None and new == scan else 1
            scan = new
            out.append((key[0], int(cycle), seen <= n))
        state.update((scan, seen))
        yield pd.DataFrame(out, columns=["stream", "cycle", "flag"])

    return meta.groupBy("stream").applyInPandasWithState(
        run, "stream long, cycle long, flag boolean", "scan long, seen long", "append", GroupStateTimeout.NoTimeout)


def shadow_log(shadowed: DataFrame) -> DataFrame:
    """Enter and leave events from (stream, cycle, ants), the antennas shadowed in each cycle."""

    def run(key, pdfs, state):
        before = set(state.get[0]) if state.exists else set()
        pdf = _in_time_order(pdfs)
        out = []
        for cycle, ants in zip(pdf["cycle"], pdf["ants"]):
            now = set(int(a) for a in ants)
            out += [(key[0], int(cycle), a, "enter") for a in sorted(now - before)]
            out += [(key[0], int(cycle), a, "leave") for a in sorted(before - now)]
            before = now
        state.update((sorted(before),))
        yield pd.DataFrame(out, columns=["stream", "cycle", "ant", "event"])

    return shadowed.groupBy("stream").applyInPandasWithState(
        run, "stream long, cycle long, ant long, event string", "ants array<long>", "append", GroupStateTimeout.NoTimeout)
