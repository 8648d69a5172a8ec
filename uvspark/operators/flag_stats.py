"""Flag statistics. The denominator is always observable cells: cross-correlations with data."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..plans.model import VIS, table, visibilities


def cross(vis: DataFrame) -> DataFrame:
    return vis.filter("antenna1 <> antenna2")


def _counts() -> list:
    seen = F.sum(F.col("observable").cast("long"))
    lost = F.sum((F.col("observable") & F.col("flag")).cast("long"))
    return [seen.alias("n_observable"), lost.alias("n_flagged"), F.round(lost / F.nullif(seen, F.lit(0)), 6).alias("fraction")]


def baseline_counts(vis: DataFrame) -> DataFrame:
    """Counts per baseline and subband: the fact table is read once, and all levels are rolled up from these few rows."""
    seen, lost, _ = _counts()
    return cross(vis).groupBy("antenna1", "antenna2", "ddid").agg(seen, lost)


def _rolled() -> list:
    seen, lost = F.sum("n_observable"), F.sum("n_flagged")
    return [seen.alias("n_observable"), lost.alias("n_flagged"), F.round(lost / F.nullif(seen, F.lit(0)), 6).alias("fraction")]


def flag_counts(vis: DataFrame, *by: str) -> DataFrame:
    """Observable and flagged counts and fraction, per group or over all."""
    return cross(vis).groupBy(*by).agg(*_counts())


def endpoints(vis: DataFrame) -> DataFrame:
    """One row per visibility and endpoint, as `antenna`."""
    return vis.withColumn("antenna", F.explode(F.array("antenna1", "antenna2")))


def flag_counts_by_antenna(vis: DataFrame) -> DataFrame:
    return endpoints(baseline_counts(vis)).groupBy("antenna").agg(*_rolled())


def flag_summary(vis: DataFrame) -> DataFrame:
    """Total and subband levels from grouping sets, antenna level from the exploded endpoints."""
    counts = baseline_counts(vis)
    flat = counts.groupingSets([[], ["ddid"]], "ddid").agg(*_rolled())
    flat = flat.select(F.when(F.col("ddid").isNull(), "total").otherwise("ddid").alias("level"), F.coalesce("ddid", F.lit(-1)).cast("int").alias("key"), "n_observable", "n_flagged", "fraction")
    ants = endpoints(counts).groupBy("antenna").agg(*_rolled()).select(F.lit("antenna").alias("level"), F.col("antenna").alias("key"), "n_observable", "n_flagged", "fraction")
    return flat.unionByName(ants)


def dead_antennas(vis: DataFrame) -> DataFrame:
    """Antennas whose observable cells are all flagged."""
    return flag_counts_by_antenna(vis).filter("n_observable > 0 AND n_flagged = n_observable").select("antenna")


def flag_counts_without_dead(vis: DataFrame) -> DataFrame:
    """Totals over baselines between antennas that aren't fully flagged."""
    alive, dead = baseline_counts(vis), dead_antennas(vis)
    for end in ("antenna1", "antenna2"):
        alive = alive.join(dead.withColumnRenamed("antenna", end), end, "left_anti")
    return alive.agg(*_rolled())


def participation(vis: DataFrame) -> DataFrame:
    """(antenna, ddid) pairs with at least one valid sample, and how many."""
    return endpoints(cross(vis).filter("observable AND NOT flag")).groupBy("antenna", "ddid").agg(F.count("*").alias("n_valid"))


def usable_subbands(vis: DataFrame, least: int = 2) -> DataFrame:
    """Subbands that at least so many antennas take part in."""
    return participation(vis).groupBy("ddid").agg(F.count("*").alias("n_antennas")).filter(F.col("n_antennas") >= least)


def scan_summary(vis: DataFrame) -> DataFrame:
    """Per scan: time range, rows, antennas, subbands."""
    ants = F.size(F.array_distinct(F.flatten(F.collect_set(F.array("antenna1", "antenna2"))))).cast("long")  # at most all baselines
    return vis.groupBy("scan").agg(F.min("time").alias("first"), F.max("time").alias("last"), F.count("*").alias("n_rows"), F.countDistinct("ddid").alias("n_subbands"), ants.alias("n_antennas"))


def baseline_pairs(antennas: DataFrame) -> DataFrame:
    """Unordered pairs of antennas (antenna, x, y) and their distance. Small dimension table."""
    a, b = antennas.alias("a"), F.broadcast(antennas).alias("b")
    return a.join(b, F.col("a.antenna") < F.col("b.antenna")).select(F.col("a.antenna").alias("antenna1"), F.col("b.antenna").alias("antenna2"), F.round(F.hypot(F.col("a.x") - F.col("b.x"), F.col("a.y") - F.col("b.y")), 6).alias("length"))


def _with_dead(spark, d):
    vis = visibilities(spark, d)
    return vis.withColumn("flag", F.col("flag") | (F.col("antenna1") == 7) | (F.col("antenna2") == 7))


def stations(spark, d):
    """Antennas on a plane, from the nations."""
    return table(spark, d, "nation").select(F.col("n_nationkey").alias("antenna"), (F.col("n_nationkey") * F.col("n_nationkey") % 17 * 10.0).alias("x"), (F.col("n_regionkey") * 35.0).alias("y"))


STATIONS = "st AS (SELECT n_nationkey AS antenna, n_nationkey * n_nationkey % 17 * 10.0::DOUBLE AS x, n_regionkey * 35.0::DOUBLE AS y FROM nation)"
_C = "CAST(sum(CASE WHEN observable THEN 1 ELSE 0 END) AS BIGINT) AS n_observable, CAST(sum(CASE WHEN observable AND flag THEN 1 ELSE 0 END) AS BIGINT) AS n_flagged, round(sum(CASE WHEN observable AND flag THEN 1 ELSE 0 END)::DOUBLE / nullif(sum(CASE WHEN observable THEN 1 ELSE 0 END), 0), 6) AS fraction"
_X = f"WITH {VIS}, c AS (SELECT * FROM vis WHERE antenna1 <> antenna2), e AS (SELECT *, unnest([antenna1, antenna2]) AS antenna FROM c)"

QUERIES = {
    "flag_fraction_total": lambda s, d: flag_counts(visibilities(s, d)),
    "flag_fraction_by_ddid": lambda s, d: flag_counts(visibilities(s, d), "ddid"),
    "flag_fraction_by_antenna": lambda s, d: flag_counts_by_antenna(visibilities(s, d)),
    "flag_summary_sets": lambda s, d: flag_summary(visibilities(s, d)),
    "flag_excluding_dead": lambda s, d: flag_counts_without_dead(_with_dead(s, d)),
    "subband_participation": lambda s, d: participation(visibilities(s, d)),
    "scan_summary": lambda s, d: scan_summary(visibilities(s, d)),
    "baseline_pairs": lambda s, d: baseline_pairs(stations(s, d)),
    "usable_subbands": lambda s, d: usable_subbands(visibilities(s, d)),
}
SQL = {
    "flag_fraction_total": f"{_X} SELECT {_C} FROM c",
    "flag_fraction_by_ddid": f"{_X} SELECT ddid, {_C} FROM c GROUP BY ddid",
    "flag_fraction_by_antenna": f"{_X} SELECT antenna, {_C} FROM e GROUP BY antenna",
    "flag_summary_sets": f"{_X} SELECT 'total' AS level, -1 AS key, {_C} FROM c UNION ALL SELECT 'ddid', ddid, {_C} FROM c GROUP BY ddid UNION ALL SELECT 'antenna', antenna, {_C} FROM e GROUP BY antenna",
    "flag_excluding_dead": f"""WITH {VIS}, k AS (SELECT * REPLACE (flag OR antenna1 = 7 OR antenna2 = 7 AS flag) FROM vis WHERE antenna1 <> antenna2),
      dead AS (SELECT antenna FROM (SELECT *, unnest([antenna1, antenna2]) AS antenna FROM k) GROUP BY antenna HAVING bool_and(flag OR NOT observable) AND bool_or(observable))
      SELECT {_C} FROM k WHERE antenna1 NOT IN (FROM dead) AND antenna2 NOT IN (FROM dead)""",
    "subband_participation": f"{_X} SELECT antenna, ddid, count(*) AS n_valid FROM e WHERE observable AND NOT flag GROUP BY antenna, ddid",
    "scan_summary": f"""WITH {VIS} SELECT scan, min(time) AS first, max(time) AS last, count(*) AS n_rows, count(DISTINCT ddid) AS n_subbands,
      (SELECT count(DISTINCT a) FROM (SELECT unnest([antenna1, antenna2]) AS a FROM vis v WHERE v.scan = vis.scan)) AS n_antennas FROM vis GROUP BY scan""",
    "baseline_pairs": f"WITH {STATIONS} SELECT a.antenna AS antenna1, b.antenna AS antenna2, round(sqrt((a.x - b.x) ** 2 + (a.y - b.y) ** 2), 6) AS length FROM st a JOIN st b ON a.antenna < b.antenna",
    "usable_subbands": f"{_X} SELECT ddid, count(DISTINCT antenna) AS n_antennas FROM e WHERE observable AND NOT flag GROUP BY ddid HAVING count(DISTINCT antenna) >= 2",
}
