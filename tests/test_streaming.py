"""Rows that come after the watermark."""

import os
from datetime import datetime, timedelta

from uvspark.streaming import sessions


def test_late_rows_are_counted(spark, tmp_path):
    start = datetime(2024, 1, 1)
    files = [[0, 1, 30], [31, 29], [60, 2, 3]]  # hours; a batch is judged by the watermark that the one before it ran under: 2 and 3 come after 29
    for k, hours in enumerate(files):
        spark.createDataFrame([(start + timedelta(hours=h), "a", 1.0) for h in hours], "ts timestamp, event_type string, value double").coalesce(1).write.parquet(f"{tmp_path}/{k}")
    paths = sorted(tmp_path.glob("*/*.parquet"))
    for k, path in enumerate(paths):
        target = tmp_path / "in" / f"{k}.parquet"
        target.parent.mkdir(exist_ok=True)
        path.rename(target)
        os.utime(target, (1_700_000_000 + k, 1_700_000_000 + k))
    stream = spark.readStream.schema("ts timestamp, event_type string, value double").option("maxFilesPerTrigger", 1).parquet(str(tmp_path / "in"))
    out, dropped = sessions.drain_counted(sessions.binned(stream, "1 hour", "1 hour"))
    rows = {r.start: r.n for r in out.collect()}
    assert dropped == 2 and rows == {start + timedelta(hours=h): 1 for h in (0, 1, 29, 30, 31)}
