"""Stand-ins for the measurement model on the star-schema tables, in Spark and as SQL text.

vis: one row per visibility (two antennas, a scan, a subband, an amplitude, a weight, flags).
series: one time series per key, from the event stream.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

ANTENNAS = 8
SCAN_DAYS = 30


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def visibilities(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rows with antenna1 <= antenna2; equal antennas are autocorrelations."""
    a, b = F.col("l_suppkey") % ANTENNAS, F.col("l_partkey") % ANTENNAS
    day = F.datediff(F.col("l_shipdate").cast("date"), F.lit("1995-01-01").cast("date"))
    return table(spark, sf_dir, "lineitem").select(
        F.least(a, b).cast("int").alias("antenna1"),
        F.greatest(a, b).cast("int").alias("antenna2"),
        F.floor(day / SCAN_DAYS).cast("int").alias("scan"),
        day.alias("day"),
        F.col("l_linenumber").alias("ddid"),
        F.col("l_extendedprice").alias("amp"),
        F.col("l_quantity").alias("weight"),
        (F.col("l_returnflag") == "R").alias("flag"),
        (F.col("l_discount") != 0).alias("observable"),
        F.col("l_quantity").alias("u"),
        (F.col("l_tax") * 100).alias("v"),
        F.col("l_shipdate").alias("time"),
    )


VIS = f"""vis AS (SELECT CAST(least(l_suppkey % {ANTENNAS}, l_partkey % {ANTENNAS}) AS INT) AS antenna1,
  CAST(greatest(l_suppkey % {ANTENNAS}, l_partkey % {ANTENNAS}) AS INT) AS antenna2,
  CAST(floor(date_diff('day', DATE '1995-01-01', CAST(l_shipdate AS DATE)) / {SCAN_DAYS}.0) AS INT) AS scan,
  CAST(date_diff('day', DATE '1995-01-01', CAST(l_shipdate AS DATE)) AS INT) AS day,
  l_linenumber AS ddid, l_extendedprice AS amp, l_quantity AS weight, l_returnflag = 'R' AS flag, l_discount <> 0 AS observable,
  l_quantity AS u, l_tax * 100 AS v, l_shipdate AS time FROM lineitem)"""


def series(spark: SparkSession, sf_dir: str) -> DataFrame:
    """events with seconds `t` since 2024-01-01 (whole microseconds) and day number."""
    e = table(spark, sf_dir, "events")
    us = F.unix_micros(F.col("ts").cast("timestamp")) - 1704067200000000
    return e.withColumns({"us": us, "t": us / 1e6, "day": F.floor(us / 86400000000).cast("int")})


SERIES = """ev AS (SELECT *, epoch_us(ts) - 1704067200000000 AS us, (epoch_us(ts) - 1704067200000000) / 1e6 AS t,
  CAST(floor((epoch_us(ts) - 1704067200000000) / 86400000000.0) AS INT) AS day FROM events)"""
