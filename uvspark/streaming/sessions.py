"""Streaming forms of the batch windows: gap sessions, binned sums, last-n prediction. Each run to the end of its input equals the batch result."""

from __future__ import annotations

import uuid
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators.ranks import shared_folder
from ..plans.model import SERIES


def event_stream(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The events table as a stream of files; event time as timestamp (watermarks refuse timestamp_ntz)."""
    schema = spark.read.parquet(f"{sf_dir}/events.parquet").schema
    stream = spark.readStream.schema(schema).option("pathGlobFilter", "events.parquet").parquet(sf_dir)
    return stream.withColumn("ts", F.col("ts").cast("timestamp"))


def sessions(events: DataFrame, gap: str = "6 hours", late: str = "1 hour") -> DataFrame:
    """Count and sum per user and gap session."""
    s = events.withWatermark("ts", late).groupBy("user_id", F.session_window("ts", gap).alias("w")).agg(F.count("*").alias("n"), F.sum("value").alias("total"))
    return s.select("user_id", F.col("w.start").alias("start"), "n", F.round("total", 2).alias("total"))


def binned(events: DataFrame, width: str = "6 hours", late: str = "1 hour") -> DataFrame:
    """Count and sum per type and tumbling window."""
    b = events.withWatermark("ts", late).groupBy("event_type", F.window("ts", width).alias("w")).agg(F.count("*").alias("n"), F.sum("value").alias("total"))
    return b.select("event_type", F.col("w.start").alias("start"), "n", F.round("total", 2).alias("total"))


def last_values(events: DataFrame, n: int = 3) -> DataFrame:
    """Per user and batch: the median of the last n values seen so far, kept as state."""

    def step(key: tuple, batches: Iterator[pd.DataFrame], state) -> Iterator[pd.DataFrame]:
        kept = list(state.get[0]) if state.exists else []
        rows = pd.concat(list(batches)).sort_values(["ts", "event_id"])
        kept = (kept + rows["value"].tolist())[-n:]
        state.update((kept,))
        yield pd.DataFrame({"user_id": [key[0]], "predicted": [float(pd.Series(kept).median())]})

    return events.groupBy("user_id").applyInPandasWithState(step, "user_id long, predicted double", "kept array<double>", "update", "NoTimeout")


def drain_counted(stream: DataFrame, mode: str = "append") -> tuple[DataFrame, int]:
    """drain, and the number of rows left out as late: Spark judges a batch by the watermark that the batch before it ran under."""
    dropped = []

    def done(query) -> None:
        dropped.extend(op["numRowsDroppedByWatermark"] for p in query.recentProgress for op in p["stateOperators"])

    out = drain(stream, mode, done)
    return out, sum(dropped)


def drain(stream: DataFrame, mode: str = "complete", done=None) -> DataFrame:
    """Run a stream over all input there is now; its result as a table of files in the shared folder."""
    spark = stream.sparkSession
    path = f"{shared_folder(spark)}/uvspark-stream-{uuid.uuid4().hex}"

    def put(batch: DataFrame, batch_id: int) -> None:
        # Whole batches replace what a failed attempt at the same batch left.
        batch.write.mode("overwrite").parquet(f"{path}/out/batch={0 if mode == 'complete' else batch_id}")

    query = stream.writeStream.foreachBatch(put).outputMode(mode).option("checkpointLocation", f"{path}/state").trigger(availableNow=True).start()
    query.awaitTermination()
    if done:
        done(query)
    return spark.read.parquet(f"{path}/out").drop("batch")


def _ntz(df: DataFrame) -> DataFrame:
    return df.withColumn("start", F.col("start").cast("timestamp_ntz"))


QUERIES = {
    "stream_sessions": lambda s, d: _ntz(drain(sessions(event_stream(s, d)))),
    "stream_bins": lambda s, d: _ntz(drain(binned(event_stream(s, d)))),
    "stream_last_values": lambda s, d: drain(last_values(event_stream(s, d)), "update"),
}
SQL = {
    "stream_sessions": f"""WITH {SERIES}, b AS (SELECT *, CASE WHEN us - lag(us) OVER w < 21600000000 THEN 0 ELSE 1 END AS new FROM ev WINDOW w AS (PARTITION BY user_id ORDER BY us, event_id)),
      n AS (SELECT *, sum(new) OVER (PARTITION BY user_id ORDER BY us, event_id) AS k FROM b) SELECT user_id, min(ts) AS start, count(*) AS n, round(sum(value), 2) AS total FROM n GROUP BY user_id, k""",
    "stream_bins": "SELECT event_type, time_bucket(INTERVAL 6 HOUR, ts) AS start, count(*) AS n, round(sum(value), 2) AS total FROM events GROUP BY ALL",
    "stream_last_values": "SELECT user_id, median(value) AS predicted FROM (SELECT user_id, value, row_number() OVER (PARTITION BY user_id ORDER BY ts DESC, event_id DESC) AS rn FROM events) WHERE rn <= 3 GROUP BY user_id",
}
