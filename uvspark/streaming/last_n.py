"""Predictions from the last solutions of a series, as a stream with list state, timers and expiry.

Per series the last 2n rows are kept. Each new row is predicted by the median of the last n good ones among them, as the batch
window does. A series without rows for `idle` of event time is forgotten by a timer.
"""

from __future__ import annotations

from collections.abc import Iterator
from statistics import median

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming.stateful_processor import StatefulProcessor, StatefulProcessorHandle

from .sessions import drain, event_stream

PROVIDER = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"
KEPT = "value double, good boolean"
PREDICTED = "user_id long, event_id long, ts timestamp, predicted double"


class LastSolutions(StatefulProcessor):
    """State of one series: a list of its last 2n rows, and the time at which it is forgotten."""

    def __init__(self, n: int, idle_ms: int):
        self.n, self.idle_ms = n, idle_ms

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.kept = handle.getListState("kept", KEPT)
        self.expiry = handle.getValueState("expiry", "at long")

    def handleInputRows(self, key, rows: Iterator[pd.DataFrame], timerValues) -> Iterator[pd.DataFrame]:
        parts = list(rows)
        new = (parts[0] if len(parts) == 1 else pd.concat(parts, ignore_index=True)).sort_values(["ts", "event_id"], ignore_index=True)
        kept = [(x[0], x[1]) for x in self.kept.get()]
        out = []
        for value, good in zip(new["value"].tolist(), new["good"].tolist()):
            # Plain numbers: a pandas series for each row would take most of the time.
            last = [v for v, ok in kept[-2 * self.n :] if ok][-self.n :]
            last = [v for v in last if v is not None and v == v]
            out.append(float(median(last)) if last else None)
            kept.append((value, bool(good)))
        self.kept.put(kept[-2 * self.n :])
        at = int(new["ts"].max().timestamp() * 1000) + self.idle_ms
        if self.expiry.exists():
            before = self.expiry.get()[0]
            at = max(at, before)
            self.handle.deleteTimer(before)
        self.handle.registerTimer(at)
        self.expiry.update((at,))
        yield pd.DataFrame({"user_id": key[0], "event_id": new["event_id"], "ts": new["ts"], "predicted": pd.array(out, dtype="Float64")})

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[pd.DataFrame]:
        self.kept.clear()
        self.expiry.clear()
        yield pd.DataFrame({"user_id": pd.Series(dtype="int64"), "event_id": pd.Series(dtype="int64"), "ts": pd.Series(dtype="datetime64[ns]"), "predicted": pd.Series(dtype="float64")})

    def close(self) -> None:
        pass


def predicted_stream(events: DataFrame, n: int = 3, idle: str = "20 days", late: str = "1 hour") -> DataFrame:
    """(user_id, event_id, ts, predicted) of each row of a stream (user_id, event_id, ts, value, good). The session needs the RocksDB state store."""
    idle_ms = int(pd.Timedelta(idle).total_seconds() * 1000)
    rows = events.withWatermark("ts", late).select("user_id", "event_id", "ts", "value", "good")
    return rows.groupBy("user_id").transformWithStateInPandas(LastSolutions(n, idle_ms), PREDICTED, "Append", "EventTime")


def _streamed(s, d):
    before = s.conf.get("spark.sql.streaming.stateStore.providerClass")
    s.conf.set("spark.sql.streaming.stateStore.providerClass", PROVIDER)
    try:
        events = event_stream(s, d).withColumn("good", F.col("event_id") % 4 != 0)
        out = drain(predicted_stream(events), "append")
    finally:
        s.conf.set("spark.sql.streaming.stateStore.providerClass", before)
    return out.select("event_id", "predicted")


QUERIES = {"stream_last_solutions": _streamed}
SQL = {
    "stream_last_solutions": """WITH p AS (SELECT event_id, list({'v': value, 'g': event_id % 4 <> 0}) OVER (PARTITION BY user_id ORDER BY ts, event_id ROWS BETWEEN 6 PRECEDING AND 1 PRECEDING) AS past FROM events),
      g AS (SELECT event_id, list_transform(list_filter(past, lambda x: x.g), lambda x: x.v) AS v FROM p)
      SELECT event_id, list_aggregate(v[greatest(len(v) - 2, 1):], 'median') AS predicted FROM g""",
}
