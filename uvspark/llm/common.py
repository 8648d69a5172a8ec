"""Helpers shared by the operators of this subpackage: inputs, checkpoints, distributed ranks."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: Words are maximal runs of characters other than space and U+0009 to U+000D.
WORD = r"[^\x20\x09-\x0D]+"
GAP = r"[\x20\x09-\x0D]+"


#: Stands for a null doc_id inside Python stages, where pandas would turn the others into floats.
NO_ID = -(1 << 63)


def id_or_none(doc_id: Column) -> Column:
    return F.coalesce(doc_id.cast("long"), F.lit(NO_ID)).alias("doc_id")


def with_null_ids(df: DataFrame) -> DataFrame:
    return df.withColumn("doc_id", F.nullif(F.col("doc_id"), F.lit(NO_ID)))


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def scratch_dir(spark: SparkSession) -> str:
    """The shared folder for intermediate tables: what the session names. Only a local master may go without: it gets one of its own."""
    sc = spark.sparkContext
    shared = spark.conf.get("spark.checkpoint.dir", None) or sc.getCheckpointDir()
    if not shared:
        if not sc.master.startswith("local[") and sc.master != "local":
            raise RuntimeError("spark.checkpoint.dir must name a folder that driver and executors share")
        shared = tempfile.mkdtemp(prefix="uvspark-")
    if not sc.getCheckpointDir():
        sc.setCheckpointDir(shared)
    return shared


def materialize(df: DataFrame) -> DataFrame:
    """Write df as Parquet in the shared folder and read it back: cuts lineage, survives lost executors."""
    path = f"{scratch_dir(df.sparkSession)}/uvspark-{uuid.uuid4().hex}"
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def checkpoint(df: DataFrame) -> DataFrame:
    """A written table for a step of an iteration. DataFrame.checkpoint keeps the constraints of the plan it cuts, which grow from step to step."""
    return materialize(df)


def words(text: Column) -> Column:
    """Array of the words of a text; null text has none."""
    return F.filter(F.split(F.coalesce(text, F.lit("")), GAP, -1), lambda w: w != "")


def with_global_rank(df: DataFrame, order: list[Column], name: str = "rank") -> DataFrame:
    """Add the 0-based rank of every row in the order given, without a single-task window.

    Rows are range-partitioned and sorted; a row's rank is its index in its partition plus the
    rows of the partitions before it. Only one count per partition reaches the driver. Rows equal
    in all order columns get ranks in no fixed order.
    """
    placed = materialize(df.repartitionByRange(*order).sortWithinPartitions(*order).withColumn("_mid", F.monotonically_increasing_id()))
    counts = {r["_pid"]: r["n"] for r in placed.groupBy(F.shiftright("_mid", 33).alias("_pid")).agg(F.count("*").alias("n")).collect()}
    starts, total = [], 0
    for pid in range(max(counts, default=-1) + 1):
        starts.append(total)
        total += counts.get(pid, 0)
    rank = F.get(long_array(starts), F.shiftright("_mid", 33).cast("int")) + F.col("_mid").bitwiseAND((1 << 33) - 1)
    return placed.withColumn(name, rank).drop("_mid")


def long_array(values: list[int]) -> Column:
    """A constant array, from one literal: an expression per member would make a large plan."""
    if not values:
        return F.array().cast("array<bigint>")
    return F.split(F.lit(",".join(map(str, values))), ",").cast("array<bigint>")
