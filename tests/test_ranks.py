"""Distributed row numbers."""

from pyspark.sql import functions as F

from uvspark.operators.ranks import global_rank


def test_global_rank(spark):
    df = spark.range(5000).select(((F.col("id") * 7919) % 4001).alias("x"), "id")
    got = [(r["rank"], r.x, r.id) for r in global_rank(df, [F.col("x"), F.col("id")], "rank").collect()]
    want = sorted((r.x, r.id) for r in df.collect())
    assert sorted(got) == [(i, *r) for i, r in enumerate(want)]


def test_global_rank_of_nothing(spark):
    assert global_rank(spark.range(0), [F.col("id")], "rank").count() == 0


def test_global_rank_descending_with_nulls(spark):
    df = spark.createDataFrame([(3,), (None,), (1,), (2,)], "x int")
    got = {r.x: r["rank"] for r in global_rank(df, [F.col("x").desc_nulls_last()], "rank").collect()}
    assert got == {3: 0, 2: 1, 1: 2, None: 3}
