"""Partitioned snapshot store of the fact table, its layout of runs, solution tables and flag versions.

All paths go through Spark's readers and writers, so they may lie in any store Spark can open.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..operators.ranks import shared_folder
from ..plans.model import VIS, visibilities

ARRAY = T.ArrayType(T.FloatType())
#: Declared schemas: the fact table with array cells, and solution tables.
VIS_SCHEMA = T.StructType(
    [T.StructField(n, T.DoubleType()) for n in ("time", "time_centroid", "interval", "exposure")]
    + [T.StructField(n, T.IntegerType()) for n in ("antenna1", "antenna2", "array_id", "data_desc_id", "field_id", "observation_id", "scan_number", "feed1", "feed2", "processor_id", "state_id")]
    + [T.StructField("flag_row", T.BooleanType()), T.StructField("uvw", T.ArrayType(T.DoubleType())), T.StructField("data_re", ARRAY), T.StructField("data_im", ARRAY)]
    + [T.StructField("flag", T.ArrayType(T.BooleanType())), *[T.StructField(n, ARRAY) for n in ("weight", "sigma", "weight_spectrum", "sigma_spectrum")]]
)
CALTABLE_SCHEMA = T.StructType(
    [T.StructField("time", T.DoubleType()), T.StructField("interval", T.DoubleType())]
    + [T.StructField(n, T.IntegerType()) for n in ("field_id", "spw_id", "antenna1", "antenna2", "scan_number", "observation_id")]
    + [T.StructField(n, ARRAY) for n in ("fparam", "paramerr", "snr")]
    + [T.StructField("flag", T.ArrayType(T.BooleanType()))]
)


def conform(df: DataFrame, schema: T.StructType) -> DataFrame:
    """df with exactly the columns of a schema; missing ones are null."""
    have = set(df.columns)
    return df.select(*[(F.col(f.name) if f.name in have else F.lit(None)).cast(f.dataType).alias(f.name) for f in schema])


def write_store(vis: DataFrame, path: str, by: list[str], mode: str = "errorifexists", rows_per_file: int = 1_000_000) -> None:
    """One directory per partition value; its rows are gathered in files of some rows_per_file before writing, so that no task holds a whole value."""
    counts = vis.groupBy(*by).agg(F.ceil(F.count("*") / rows_per_file).cast("int").alias("_files"))
    files = counts.agg(F.coalesce(F.sum("_files"), F.lit(1))).first()[0]
    same = [F.col(f"r.{c}").eqNullSafe(F.col(f"c.{c}")) for c in by]
    placed = vis.withColumn("_at", F.xxhash64(*vis.columns)).alias("r").join(F.broadcast(counts).alias("c"), same)  # as many counts as directories
    dealt = placed.select("r.*", F.pmod("_at", F.col("_files")).alias("_file")).drop("_at")
    dealt.repartition(4 * files, *by, "_file").drop("_file").write.mode(mode).partitionBy(*by).parquet(path)


def overwrite_partitions(vis: DataFrame, path: str, by: list[str]) -> None:
    """Replace just the partitions that vis has rows of."""
    vis.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(*by).parquet(path)


def parts(df: DataFrame) -> list[str]:
    return sorted(df.inputFiles())


def runs(vis: DataFrame, keys: list[str], time: str) -> DataFrame:
    """Layout: per run of equal keys its rows and time range."""
    return vis.groupBy(*keys).agg(F.count("*").alias("n_rows"), F.min(time).alias("t_min"), F.max(time).alias("t_max"))


def select_runs(layout: DataFrame, within: dict[str, list], t_min=None, t_max=None) -> DataFrame:
    """Runs with key values among the given ones whose time range touches [t_min, t_max]."""
    cond = F.lit(True)
    for key, values in within.items():
        cond = cond & F.col(key).isin(values)
    if t_min is not None:
        cond = cond & (F.col("t_max") >= t_min)
    if t_max is not None:
        cond = cond & (F.col("t_min") <= t_max)
    return layout.filter(cond)


def slice_cells(df: DataFrame, columns: list[str], ncorr: int, chans: range, corrs: list[int]) -> DataFrame:
    """Channel-major array cells cut to some channels and correlations."""
    index = F.array(*[F.lit(c * ncorr + k) for c in chans for k in corrs])
    pick = lambda name: F.transform(index, lambda i: F.get(F.col(name), i))
    return df.withColumns({name: pick(name) for name in columns})


def write_caltable(df: DataFrame, path: str) -> None:
    conform(df, CALTABLE_SCHEMA).write.mode("overwrite").parquet(path)


def read_caltable(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema(CALTABLE_SCHEMA).parquet(path)


class FlagVersions:
    """Named snapshots of the flags of rows with an id, one directory each, and a list of them."""

    def __init__(self, spark: SparkSession, root: str):
        self.spark, self.root = spark, root
        self.schema = "name string, comment string, at long, dir string, live boolean"

    def _log(self, name: str, comment: str, directory: str, live: bool) -> None:
        n = self.entries().count() if self._exists() else 0
        self.spark.createDataFrame([(name, comment, n, directory, live)], self.schema).coalesce(1).write.mode("append").parquet(f"{self.root}/log")

    def _exists(self) -> bool:
        jvm = self.spark._jvm
        path = jvm.org.apache.hadoop.fs.Path(f"{self.root}/log")
        return path.getFileSystem(self.spark._jsc.hadoopConfiguration()).exists(path)

    def entries(self) -> DataFrame:
        return self.spark.read.schema(self.schema).parquet(f"{self.root}/log")

    def list(self) -> DataFrame:
        """Live versions: the last entry of each name."""
        if not self._exists():
            return self.spark.createDataFrame([], "name string, comment string, dir string")
        last = self.entries().groupBy("name").agg(F.max_by(F.struct("comment", "dir", "live"), "at").alias("e"))
        return last.filter("e.live").select("name", "e.comment", "e.dir")

    def save(self, rows: DataFrame, row_id: str, flag: str, name: str, comment: str = "") -> None:
        directory = f"v-{uuid.uuid4().hex}"
        rows.select(F.col(row_id).alias("row_id"), F.col(flag).alias("saved")).write.parquet(f"{self.root}/{directory}")
        self._log(name, comment, directory, True)

    def read(self, name: str) -> DataFrame:
        found = self.list().filter(F.col("name") == name).select("dir").first()
        if found is None:
            raise KeyError(name)
        return self.spark.read.parquet(f"{self.root}/{found[0]}")

    def restore(self, rows: DataFrame, row_id: str, flag: str, name: str, merge: str = "replace") -> DataFrame:
        """rows with the saved flags in place of theirs, or joined with them by and / or. Works on booleans and arrays."""
        joined = rows.join(self.read(name).withColumnRenamed("row_id", row_id), row_id, "left")
        if merge == "replace":
            new = F.col("saved")
        elif dict(rows.dtypes)[flag].startswith("array"):
            new = F.zip_with(flag, "saved", (lambda a, b: a | b) if merge == "or" else (lambda a, b: a & b))
        else:
            new = (F.col(flag) | F.col("saved")) if merge == "or" else (F.col(flag) & F.col("saved"))
        return joined.withColumn(flag, F.coalesce(new, F.col(flag))).select(*rows.columns)

    def delete(self, name: str) -> None:
        self._log(name, "", "", False)

    def rename(self, old: str, new: str, comment: str | None = None) -> None:
        e = self.list().filter(F.col("name") == old).first()
        if e is None:
            raise KeyError(old)
        self._log(new, e["comment"] if comment is None else comment, e["dir"], True)
        self.delete(old)


def scratch(spark: SparkSession) -> str:
    return f"{shared_folder(spark)}/uvspark-{uuid.uuid4().hex}"


def _versioned(s, d):
    rows = visibilities(s, d).withColumn("row_id", F.xxhash64("time", "amp", "weight", "antenna1", "antenna2", "ddid")).dropDuplicates(["row_id"])
    versions = FlagVersions(s, scratch(s))
    versions.save(rows.withColumn("flag", F.col("flag") & (F.col("ddid") > 3)), "row_id", "flag", "late", "upper subbands")
    versions.rename("late", "upper")
    out = versions.restore(rows.withColumn("flag", F.col("ddid") == 1), "row_id", "flag", "upper", "or")
    return out.groupBy("ddid").agg(F.sum(F.col("flag").cast("long")).alias("n_flagged"))


def _layout(s, d):
    path = scratch(s)
    write_store(visibilities(s, d), path, ["ddid"])
    layout = runs(s.read.parquet(path), ["ddid", "scan"], "day")
    return select_runs(layout, {"ddid": [1, 2, 5]}, 100, 900)


QUERIES = {"store_layout": _layout, "flag_versions": _versioned}
SQL = {
    "store_layout": f"WITH {VIS}, r AS (SELECT ddid, scan, count(*) AS n_rows, min(day) AS t_min, max(day) AS t_max FROM vis GROUP BY ALL) SELECT * FROM r WHERE ddid IN (1, 2, 5) AND t_max >= 100 AND t_min <= 900",
    "flag_versions": f"WITH {VIS}, q AS (SELECT DISTINCT time, amp, weight, antenna1, antenna2, ddid, first(flag) OVER (PARTITION BY time, amp, weight, antenna1, antenna2, ddid) AS flag FROM vis) SELECT ddid, CAST(sum(((ddid = 1) OR (flag AND ddid > 3))::INT) AS BIGINT) AS n_flagged FROM q GROUP BY ddid",
}
