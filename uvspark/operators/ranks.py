"""Row numbers over a global order without a one-task window."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F


def shared_folder(spark: SparkSession) -> str:
    """The folder for intermediate tables that the session names. Only a local master may go without: it gets one of its own."""
    sc = spark.sparkContext
    folder = spark.conf.get("spark.checkpoint.dir", None) or sc.getCheckpointDir()
    if not folder:
        if not sc.master.startswith("local[") and sc.master != "local":
            raise RuntimeError("spark.checkpoint.dir must name a folder that driver and executors share")
        folder = tempfile.mkdtemp(prefix="uvspark-")
        sc.setCheckpointDir(folder)
    return folder


def pinned(df: DataFrame) -> DataFrame:
    """Written to the shared folder and read back: what follows, also after a lost executor, sees the same rows in the same places."""
    path = f"{shared_folder(df.sparkSession)}/uvspark-{uuid.uuid4().hex}"
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def global_rank(df: DataFrame, order: list[Column], name: str) -> DataFrame:
    """Add the 0-based place of each row in the order, from range partitions and their row counts."""
    placed = pinned(df.repartitionByRange(*order).sortWithinPartitions(*order).withColumn("__at", F.monotonically_increasing_id()))
    part = F.shiftright("__at", 33)
    sizes = {r[0]: r[1] for r in placed.groupBy(part).agg(F.count("*")).collect()}
    starts, total = [], 0
    for p in range(max(sizes, default=-1) + 1):
        starts.append(total)
        total += sizes.get(p, 0)
    start = F.split(F.lit(",".join(map(str, starts)) or "0"), ",").cast("array<bigint>")
    return placed.withColumn(name, F.get(start, part.cast("int")) + F.col("__at").bitwiseAND((1 << 33) - 1)).drop("__at")
