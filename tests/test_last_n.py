"""State of the last rows of a series: it survives a restart, equals the batch window, and idle series are forgotten."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from uvspark.operators.asof import predict_from_previous
from uvspark.streaming import last_n

SCHEMA = "user_id long, event_id long, ts timestamp, value double, good boolean"


@pytest.fixture
def rocks(spark):
    before = spark.conf.get("spark.sql.streaming.stateStore.providerClass")
    spark.conf.set("spark.sql.streaming.stateStore.providerClass", last_n.PROVIDER)
    yield spark
    spark.conf.set("spark.sql.streaming.stateStore.providerClass", before)


def at(days):
    return dt.datetime(2024, 1, 1) + dt.timedelta(days=days)


def run(spark, folder, parts, n=2):
    """Each part arrives, then the query starts anew from its checkpoint."""
    for i, rows in enumerate(parts):
        spark.createDataFrame(rows, SCHEMA).coalesce(1).write.parquet(f"{folder}/in/{i}")
        stream = spark.readStream.schema(SCHEMA).option("recursiveFileLookup", "true").parquet(f"{folder}/in")
        query = last_n.predicted_stream(stream, n).writeStream.format("parquet").option("path", f"{folder}/out").option("checkpointLocation", f"{folder}/state").outputMode("append").trigger(availableNow=True).start()
        query.awaitTermination()
    return {r.event_id: r.predicted for r in spark.read.parquet(f"{folder}/out").collect()}


def test_state_survives_restarts_and_equals_the_batch(rocks, tmp_path):
    rows = [(i % 3, i, at(i / 10), float(i * 7 % 10), i % 4 != 1) for i in range(60)]
    got = run(rocks, str(tmp_path), [rows[:17], rows[17:40], rows[40:]])
    want = predict_from_previous(rocks.createDataFrame(rows, SCHEMA), ["user_id"], ["ts", "event_id"], "value", F.col("good"), 2)
    assert got == {r.event_id: r.predicted for r in want.collect()} and sum(x is not None for x in got.values()) > 50


def test_idle_series_are_forgotten(rocks, tmp_path):
    parts = [
        [(1, i, at(i), 5.0, True) for i in range(3)] + [(2, 10, at(0), 1.0, True)],
        [(2, 11, at(30), 3.0, True)],  # the watermark passes the first series' expiry
        [(1, 12, at(31), 7.0, True), (2, 13, at(31), 9.0, True)],
        [(1, 14, at(32), 8.0, True)],
    ]
    got = run(rocks, str(tmp_path), parts)
    assert got[2] == 5.0 and got[11] == 1.0 and got[13] == 2.0
    assert got[12] is None and got[14] == 7.0
