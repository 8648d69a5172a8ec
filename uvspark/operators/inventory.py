"""What there is: source sets and their calibrators, restricted surveys, run descriptors, metadata from the store alone, epochs, feature vectors, report rules."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..plans.model import SERIES, VIS, series, table, visibilities
from .decide import _ASSESS, assess_series
from .ranks import pinned
from .robust import rounded


def calibrators_for(targets: DataFrame, sources: DataFrame, mapping: DataFrame) -> DataFrame:
    """(name, calibrator) of each target: those mapped to it, else the fringe finders, else the phase calibrators, else itself.

    sources: name, role; mapping: target, calibrator. A target has one way, so no pair comes twice.
    """
    own = targets.select("name").join(mapping, F.col("name") == F.col("target")).select("name", "calibrator")
    rest = targets.select("name").join(own, "name", "left_anti")
    finders, phase = (sources.filter(F.col("role") == r).select(F.col("name").alias("calibrator")) for r in ("finder", "calibrator"))
    fallback = finders if not finders.isEmpty() else phase
    if fallback.isEmpty():
        return own.union(rest.select("name", F.col("name").alias("calibrator")))
    lists = fallback.agg(F.sort_array(F.collect_list("calibrator")).alias("_all"))  # one row: the calibrators of one observation
    return own.union(rest.join(F.broadcast(lists)).select("name", F.explode("_all").alias("calibrator")))


def restrict_sources(sources: DataFrame, mapping: DataFrame, observed: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Sources and mapping without what wasn't observed (name)."""
    seen = observed.select("name").distinct()
    kept = mapping.join(seen.withColumnRenamed("name", "target"), "target", "left_semi").join(seen.withColumnRenamed("name", "calibrator"), "calibrator", "left_semi")
    return sources.join(seen, "name", "left_semi"), kept.select("target", "calibrator")


def add_sources(sources: DataFrame, others: DataFrame) -> DataFrame:
    """Union of two source sets; a name that is there keeps its entry."""
    return sources.unionByName(others.join(sources.select("name"), "name", "left_anti").dropDuplicates(["name"]))


def restrict_survey(survey: DataFrame, sources: DataFrame | None = None, without: DataFrame | None = None) -> DataFrame:
    """Survey rows (scan, source, antenna, hand, snr) of some sources, and without some scans."""
    if sources is not None:
        survey = survey.join(sources.select("source").distinct(), "source", "left_semi")
    return survey if without is None else survey.join(without.select("scan").distinct(), "scan", "left_anti")


def without_weak_detections(survey: DataFrame, weak: DataFrame, min_snr: float, references: list[str]) -> DataFrame:
    """Null the snr of antennas in scans where they are weak (scan, antenna), if another scan detects them without being weak.

    A weak reference antenna nulls its whole scan, whether another scan detects it or not.
    """
    reference = F.col("antenna").isin(references) if references else F.lit(False)
    weak = weak.select("scan", "antenna").distinct().withColumn("_weak", F.lit(True))
    marked = survey.join(weak, ["scan", "antenna"], "left").withColumn("_weak", F.coalesce("_weak", F.lit(False)))
    seen = marked.groupBy("scan", "antenna", "_weak").agg(F.max(F.col("snr") >= min_snr).alias("_seen"))
    good = seen.filter("NOT _weak AND _seen").select("antenna").distinct().withColumn("_elsewhere", F.lit(True))
    lost = seen.filter("_weak").join(good, "antenna", "left")
    lost = lost.filter(reference | (F.col("_seen") & F.coalesce("_elsewhere", F.lit(False)))).select("scan", "antenna", reference.alias("_all"))
    scans = lost.filter("_all").select("scan").distinct().withColumn("_scan", F.lit(True))
    out = marked.join(lost.select("scan", "antenna", F.lit(True).alias("_own")), ["scan", "antenna"], "left").join(scans, "scan", "left")
    return out.withColumn("snr", F.when(F.coalesce("_own", "_scan").isNull(), F.col("snr"))).select(*survey.columns)


def split_runs(runs: DataFrame, max_rows: int) -> DataFrame:
    """Cut the runs (path, start, nrow) of each part into chunks of max_rows rows in order: path, chunk, start, nrow."""
    w = Window.partitionBy("path").orderBy("start").rowsBetween(Window.unboundedPreceding, -1)
    r = runs.withColumn("_at", F.coalesce(F.sum("nrow").over(w), F.lit(0)))
    last = F.col("_at") + F.col("nrow") - 1
    r = r.filter("nrow > 0").withColumn("chunk", F.explode(F.sequence(F.floor(F.col("_at") / max_rows), F.floor(last / max_rows))))
    lo, hi = F.greatest(F.col("_at"), F.col("chunk") * max_rows), F.least(last + 1, (F.col("chunk") + 1) * max_rows)
    return r.select("path", "chunk", (F.col("start") + lo - F.col("_at")).alias("start"), (hi - lo).alias("nrow"))


def adjacent_runs(runs: DataFrame, same: list[str]) -> DataFrame:
    """Spans of runs that follow each other without a gap and are alike in `same`: path, start, nrow, n_runs."""
    w = Window.partitionBy("path").orderBy("start")
    joins = F.lag(F.col("start") + F.col("nrow")).over(w) == F.col("start")
    for c in same:
        joins = joins & F.lag(c).over(w).eqNullSafe(F.col(c))
    r = runs.withColumn("_new", F.coalesce((~joins).cast("int"), F.lit(1))).withColumn("_span", F.sum("_new").over(w))
    return r.groupBy("path", "_span").agg(F.min("start").alias("start"), F.sum("nrow").alias("nrow"), F.count("*").alias("n_runs")).drop("_span")


def store_metadata(rows: DataFrame) -> DataFrame:
    """One row that describes an observation, from its rows alone, in one pass."""
    ends = F.array("antenna1", "antenna2")
    return rows.agg(
        F.count("*").alias("n_rows"), F.countDistinct("scan").alias("n_scans"), F.countDistinct("ddid").alias("n_subbands"),
        F.countDistinct("antenna1", "antenna2").alias("n_baselines"), F.size(F.array_distinct(F.flatten(F.collect_set(ends)))).cast("long").alias("n_antennas"),
        F.min("day").alias("first_day"), F.max("day").alias("last_day"), F.round(F.avg(F.col("flag").cast("double")), 6).alias("flagged"),
    )


def changed_epochs(epochs: DataFrame, reports: DataFrame) -> DataFrame:
    """Epochs (epoch, changed) that changed after their last report (epoch, written), or have none."""
    last = reports.groupBy("epoch").agg(F.max("written").alias("_w"))
    return epochs.join(last, "epoch", "left").filter(F.col("_w").isNull() | (F.col("changed") > F.col("_w"))).select("epoch")


def has_source(scans: DataFrame, names: DataFrame) -> DataFrame:
    """(name, observed) for every name asked for."""
    seen = scans.select(F.col("source").alias("name")).distinct().withColumn("_s", F.lit(True))
    return names.join(seen, "name", "left").select("name", F.coalesce("_s", F.lit(False)).alias("observed"))


def feature_rows(series_stats: DataFrame, unit: Column, features: list[str], stage: str, experiment: str) -> DataFrame:
    """Feature vectors of a stage: experiment, stage, unit, x (nulls where a feature is missing) and the labels that rules gave."""
    x = F.array(*[F.col(c).cast("double") for c in features])
    return series_stats.select(F.lit(experiment).alias("experiment"), F.lit(stage).alias("stage"), unit.alias("unit"), x.alias("x"), F.filter(F.split("labels", ","), lambda s: s != "").alias("rule_labels"))


#: Remarks of a report: name, condition over a row of numbers, text with {column} for its numbers.
REMARKS = [
    ("flagged", "flagged > 0.3", "{percent} % of the data are flagged"),
    ("few_antennas", "n_antennas < 4", "only {n_antennas} antennas have data"),
    ("few_rows", "n_rows < 30", "only {n_rows} rows"),
]


def remarks(numbers: DataFrame, keys: list[str], rules: list[tuple[str, str, str]] = REMARKS) -> DataFrame:
    """One row per key and remark that applies, in the order of the rules."""

    def filled(text: str) -> Column:
        parts = [F.lit(p) if i % 2 == 0 else F.col(p).cast("string") for i, p in enumerate(text.replace("}", "{").split("{"))]
        return F.concat(*parts)

    found = F.array_compact(F.array(*[F.when(F.expr(cond), F.struct(F.lit(i).alias("nth"), F.lit(name).alias("remark"), filled(text).alias("text"))) for i, (name, cond, text) in enumerate(rules)]))
    return numbers.select(*keys, F.explode(found).alias("_r")).select(*keys, "_r.*")


def cube_round_trip(cube: DataFrame) -> DataFrame:
    """A reduced cube written to the shared folder and read back."""
    return pinned(cube)


def _sources(s, d):
    n = table(s, d, "nation")
    k = F.col("n_nationkey")
    return n.select(F.col("n_name").alias("name"), F.when(k % 5 == 0, "finder").when(k % 5 < 3, "calibrator").otherwise("target").alias("role"))


def _mapping(s, d):
    n = table(s, d, "nation")
    a = n.filter("n_nationkey % 5 = 3").select(F.col("n_name").alias("target"), (F.col("n_nationkey") - 1).alias("_k"))
    return a.join(n.select(F.col("n_nationkey").alias("_k"), F.col("n_name").alias("calibrator")), "_k").select("target", "calibrator")


def _calibrators(s, d):
    observed = table(s, d, "nation").filter("n_nationkey <> 7 AND n_nationkey <> 10").select(F.col("n_name").alias("name"))
    sources, mapping = restrict_sources(_sources(s, d), _mapping(s, d), observed)
    return calibrators_for(sources.filter("role = 'target'"), sources, mapping)


def _added(s, d):
    some = _sources(s, d).filter("role <> 'target'")
    return add_sources(some, table(s, d, "nation").select(F.col("n_name").alias("name"), F.lit("other").alias("role")))


def _survey(s, d):
    e = series(s, d)
    return e.groupBy(F.col("day").alias("scan"), F.col("event_type").alias("source"), (F.col("user_id") % 10).cast("string").alias("antenna"), F.when(F.col("event_id") % 2 == 0, "r").otherwise("l").alias("hand")).agg(F.round(F.max("value") / 10, 6).alias("snr"))


def _restricted(s, d):
    names = s.createDataFrame([("click",), ("purchase",)], "source string")
    return restrict_survey(_survey(s, d), names, s.range(30).filter("id % 4 = 1").select(F.col("id").cast("int").alias("scan")))


def _without_weak(s, d):
    best = _survey(s, d).groupBy("scan", "antenna").agg(F.max("snr").alias("snr")).withColumn("hand", F.lit("r"))
    weak = best.filter("(scan * 3 + cast(antenna AS int)) % 5 = 0 OR antenna = '4'")
    return without_weak_detections(best, weak, 18.0, ["7"]).select("scan", "antenna", "snr")


def _runs(s, d):
    """Runs of the fact table: parts are suppliers mod 8, runs their consecutive order keys with some gaps."""
    r = table(s, d, "orders").select((F.col("o_custkey") % 8).cast("string").alias("path"), (F.col("o_orderkey") * 10).alias("start"), (F.col("o_orderkey") % 7 * 3 + F.lit(1)).alias("nrow"), (F.col("o_orderkey") % 3).alias("ddid"))
    return r.withColumn("nrow", F.when(F.col("start") % 30 == 0, 10).otherwise(F.col("nrow")))


def _adjacent(s, d):
    r = table(s, d, "orders").select(F.lit("part").alias("path"), (F.col("o_custkey") % 50).cast("string").alias("k"), "o_orderkey")
    r = r.select("k", F.col("o_orderkey").alias("key")).withColumn("path", F.concat(F.lit("p"), "k"))
    rn = F.row_number().over(Window.partitionBy("path").orderBy("key"))
    r = r.select("path", (rn * 4 + F.floor(rn / 6)).alias("start"), F.lit(4).cast("long").alias("nrow"), F.floor(F.col("key") / 100).alias("chans"))
    return adjacent_runs(r, ["chans"])


def _features(s, d):
    a = assess_series(series(s, d), ["user_id", "event_type"], ["us", "event_id"], "value", ["user_id"])
    out = feature_rows(a, F.concat(F.col("user_id").cast("string"), F.lit("@"), F.col("event_type")), ["n", "median", "scatter", "trend", "level"], "tsys", "sf")
    total = F.aggregate(F.filter("x", lambda v: v.isNotNull()), F.lit(0.0), lambda acc, v: acc + v)
    return out.select("experiment", "stage", "unit", F.size(F.filter("x", lambda v: v.isNull())).alias("missing"), rounded(total, 3).alias("total"), F.array_join("rule_labels", ",").alias("rule_labels"))


def _remarks(s, d):
    g = visibilities(s, d).groupBy("scan").agg(F.count("*").alias("n_rows"), F.countDistinct("antenna1").alias("n_antennas"), F.avg(F.col("flag").cast("double")).alias("flagged"))
    return remarks(g.withColumn("percent", F.round(F.col("flagged") * 100).cast("int")), ["scan"])


def _epochs(s, d):
    o = table(s, d, "orders")
    epochs = o.groupBy(F.col("o_custkey").alias("epoch")).agg(F.max("o_orderdate").alias("changed"))
    return changed_epochs(epochs, o.filter("o_orderstatus = 'F'").select(F.col("o_custkey").alias("epoch"), F.col("o_orderdate").alias("written")))


def _has(s, d):
    names = table(s, d, "customer").select((F.col("c_custkey")).alias("name"))
    return has_source(table(s, d, "orders").filter("o_totalprice > 300000").select(F.col("o_custkey").alias("source")), names)


QUERIES = {
    "calibrators_for": _calibrators,
    "add_sources": _added,
    "restrict_survey": _restricted,
    "without_weak_detections": _without_weak,
    "split_runs": lambda s, d: split_runs(_runs(s, d), 64),
    "adjacent_runs": _adjacent,
    "store_metadata": lambda s, d: store_metadata(visibilities(s, d)),
    "changed_epochs": _epochs,
    "has_source": _has,
    "feature_rows": _features,
    "report_remarks": _remarks,
    "cube_round_trip": lambda s, d: cube_round_trip(visibilities(s, d).groupBy("scan", "ddid").agg(F.count("*").alias("n"), F.round(F.sum("amp"), 2).alias("total"))),
}
_SO = "so AS (SELECT n_name AS name, n_nationkey AS k, CASE WHEN n_nationkey % 5 = 0 THEN 'finder' WHEN n_nationkey % 5 < 3 THEN 'calibrator' ELSE 'target' END AS role FROM nation)"
_SURVEY = f"{SERIES}, su AS (SELECT day AS scan, event_type AS source, CAST(user_id % 10 AS VARCHAR) AS antenna, CASE WHEN event_id % 2 = 0 THEN 'r' ELSE 'l' END AS hand, round(max(value) / 10, 6) AS snr FROM ev GROUP BY ALL)"
SQL = {
    "calibrators_for": f"""WITH {_SO}, ob AS (SELECT * FROM so WHERE k NOT IN (7, 10)), t AS (SELECT * FROM ob WHERE role = 'target'), m AS (SELECT t.name, c.name AS calibrator FROM t JOIN ob c ON c.k = t.k - 1 WHERE t.k % 5 = 3)
      SELECT * FROM m UNION ALL SELECT t.name, f.name FROM t, ob f WHERE f.role = 'finder' AND t.name NOT IN (SELECT name FROM m)""",
    "add_sources": f"WITH {_SO} SELECT name, CASE WHEN role = 'target' THEN 'other' ELSE role END AS role FROM so",
    "restrict_survey": f"WITH {_SURVEY} SELECT * FROM su WHERE source IN ('click', 'purchase') AND scan NOT IN (SELECT id FROM range(30) r(id) WHERE id % 4 = 1)",
    "without_weak_detections": f"""WITH {_SURVEY}, b AS (SELECT scan, antenna, max(snr) AS snr FROM su GROUP BY ALL), w AS (SELECT *, (scan * 3 + antenna::INT) % 5 = 0 OR antenna = '4' AS weak FROM b),
      g AS (SELECT DISTINCT antenna FROM w WHERE NOT weak AND snr >= 18), lost AS (SELECT scan, antenna FROM w WHERE weak AND (antenna = '7' OR (snr >= 18 AND antenna IN (SELECT antenna FROM g))))
      SELECT scan, antenna, CASE WHEN (scan, antenna) NOT IN (SELECT (scan, antenna) FROM lost) AND scan NOT IN (SELECT scan FROM lost WHERE antenna = '7') THEN snr END AS snr FROM b""",
    "split_runs": """WITH r AS (SELECT CAST(o_custkey % 8 AS VARCHAR) AS path, o_orderkey * 10 AS start, CASE WHEN o_orderkey * 10 % 30 = 0 THEN 10 ELSE o_orderkey % 7 * 3 + 1 END AS nrow FROM orders),
      c AS (SELECT *, CAST(coalesce(sum(nrow) OVER (PARTITION BY path ORDER BY start ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS BIGINT) AS begun FROM r),
      x AS (SELECT path, start, unnest(range(begun, begun + nrow)) AS pos, begun FROM c) SELECT path, pos // 64 AS chunk, min(start + pos - begun) AS start, count(*) AS nrow FROM x GROUP BY path, x.start, pos // 64""",
    "adjacent_runs": """WITH r AS (SELECT 'p' || CAST(o_custkey % 50 AS VARCHAR) AS path, row_number() OVER (PARTITION BY o_custkey % 50 ORDER BY o_orderkey) AS rn, o_orderkey // 100 AS chans FROM orders),
      q AS (SELECT path, rn * 4 + rn // 6 AS start, chans FROM r), n AS (SELECT *, CASE WHEN lag(start + 4) OVER w = start AND lag(chans) OVER w = chans THEN 0 ELSE 1 END AS new FROM q WINDOW w AS (PARTITION BY path ORDER BY start)),
      g AS (SELECT *, sum(new) OVER (PARTITION BY path ORDER BY start) AS span FROM n) SELECT path, min(start) AS start, count(*) * 4 AS nrow, count(*) AS n_runs FROM g GROUP BY path, span""",
    "store_metadata": f"""WITH {VIS} SELECT count(*) AS n_rows, count(DISTINCT scan) AS n_scans, count(DISTINCT ddid) AS n_subbands, count(DISTINCT antenna1 * 100 + antenna2) AS n_baselines,
      (SELECT count(DISTINCT a) FROM (SELECT unnest([antenna1, antenna2]) AS a FROM vis)) AS n_antennas, min(day) AS first_day, max(day) AS last_day, round(avg(flag::INT::DOUBLE), 6) AS flagged FROM vis""",
    "changed_epochs": """WITH e AS (SELECT o_custkey AS epoch, max(o_orderdate) AS changed, max(o_orderdate) FILTER (o_orderstatus = 'F') AS w FROM orders GROUP BY o_custkey) SELECT epoch FROM e WHERE w IS NULL OR changed > w""",
    "has_source": "SELECT c_custkey AS name, c_custkey IN (SELECT o_custkey FROM orders WHERE o_totalprice > 300000) AS observed FROM customer",
    "feature_rows": f"""WITH {_ASSESS} SELECT 'sf' AS experiment, 'tsys' AS stage, CAST(user_id AS VARCHAR) || '@' || event_type AS unit, CAST((median IS NULL)::INT + (scatter IS NULL)::INT + (trend IS NULL)::INT + (level IS NULL)::INT AS INT) AS missing,
      round(n + coalesce(median, 0) + coalesce(scatter, 0) + coalesce(trend, 0) + coalesce(level, 0), 3) AS total, concat_ws(',', CASE WHEN nominal THEN 'nominal' END, CASE WHEN scatter > 0.5 THEN 'noisy' END, CASE WHEN level > 1.3 THEN 'high_subband' END,
      CASE WHEN abs(trend) > 0.15 THEN 'trend' END, CASE WHEN un > 0 THEN 'unphysical' END) AS rule_labels FROM assess""",
    "report_remarks": f"""WITH {VIS}, g AS (SELECT scan, count(*) AS n_rows, count(DISTINCT antenna1) AS n_antennas, avg(flag::INT::DOUBLE) AS flagged FROM vis GROUP BY scan)
      SELECT scan, 0 AS nth, 'flagged' AS remark, CAST(round(flagged * 100) AS INT) || ' % of the data are flagged' AS text FROM g WHERE flagged > 0.3
      UNION ALL SELECT scan, 1, 'few_antennas', 'only ' || n_antennas || ' antennas have data' FROM g WHERE n_antennas < 4 UNION ALL SELECT scan, 2, 'few_rows', 'only ' || n_rows || ' rows' FROM g WHERE n_rows < 30""",
    "cube_round_trip": f"WITH {VIS} SELECT scan, ddid, count(*) AS n, round(sum(amp), 2) AS total FROM vis GROUP BY ALL",
}
