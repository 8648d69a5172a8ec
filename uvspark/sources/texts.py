"""Text sources: ionosphere maps, flag files, Earth-orientation series, embedded flag commands, feature rows.

Files are read as whole texts or lines by Spark and parsed with its string functions.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..plans.model import table

FEATURES = "experiment string, stage string, unit string, x array<double>, rule_labels array<string>, label string, written_by string"
REVIEW = "experiment string, reviewer string, notes map<string,string>, labels map<string,string>"
MJD_1970 = 40587


def read_ionex(spark: SparkSession, path: str) -> DataFrame:
    """IONEX vertical TEC maps as t (MJD seconds), lat, lon, tec (TECU): one row per grid point; 9999 is null.

    Each file is one text, as its maps give values in groups of lines; files are the unit of work.
    """
    text = F.col("value")
    files = spark.read.text(path, wholetext=True)
    body = F.regexp_extract(text, r"(?s)END OF HEADER\s*\n(.*)", 1)
    exponent = F.coalesce(F.nullif(F.trim(F.regexp_extract(text, r"(?m)^(.{6}).{54}EXPONENT", 1)), F.lit("")).cast("int"), F.lit(-1))
    maps = files.select(exponent.alias("e"), F.explode(F.regexp_extract_all(body, F.lit(r"(?s)START OF TEC MAP.*?END OF TEC MAP"), F.lit(0))).alias("m"))
    when = F.split(F.trim(F.regexp_extract("m", r"(?m)^(.{60})EPOCH OF CURRENT MAP", 1)), r"\s+")
    mjd = F.datediff(F.make_date(F.get(when, 0).cast("int"), F.get(when, 1).cast("int"), F.get(when, 2).cast("int")), F.lit("1858-11-17").cast("date"))
    t = mjd * 86400.0 + F.get(when, 3).cast("int") * 3600 + F.get(when, 4).cast("int") * 60 + F.get(when, 5).cast("double")
    bands = maps.select("e", t.alias("t"), F.explode(F.regexp_extract_all("m", F.lit(r"(?s)[^\n]{60}LAT/LON1/LON2/DLON/H.*?(?=\n[^\n]{60}LAT/LON1|\n[^\n]*END OF TEC MAP)"), F.lit(0))).alias("b"))
    num = lambda a, n: F.trim(F.substring("b", a, n)).cast("double")
    values = F.regexp_extract_all(F.regexp_replace("b", r"^[^\n]*\n", ""), F.lit(r"-?\d+"), F.lit(0))
    rows = bands.select("e", "t", num(3, 6).alias("lat"), num(9, 6).alias("lon1"), num(21, 6).alias("dlon"), F.posexplode(values).alias("i", "v"))
    tec = F.when(F.col("v") != "9999", F.col("v").cast("double") * F.pow(F.lit(10.0), F.col("e")))
    return rows.select("t", "lat", (F.col("lon1") + F.col("i") * F.col("dlon")).alias("lon"), tec.alias("tec"))


def merge_maps(parts: list[DataFrame]) -> DataFrame:
    """Maps of several files; of an epoch in more than one, the first file's."""
    out = None
    for i, p in enumerate(parts):
        p = p.withColumn("_file", F.lit(i))
        out = p if out is None else out.unionByName(p)
    return out.withColumn("_first", F.min("_file").over(Window.partitionBy("t"))).filter("_file = _first").drop("_file", "_first")


def read_uvflg(spark: SparkSession, path: str, year: int) -> DataFrame:
    """Flag file of keyword groups ended by '/': antenna, t0, t1 (MJD seconds), reason.

    timerang gives two day-of-year times (day, hour, minute, second); a group without times covers the
    whole file, times null. Comments start with '!'.
    """
    clean = F.regexp_replace(F.col("value"), r"!(?=(?:[^'\n]*'[^'\n]*')*[^'\n]*$)[^\n]*", "")
    clean = F.regexp_replace(clean, r"(?m)!.*$", "")
    groups = spark.read.text(path, wholetext=True).select(F.explode(F.split(clean, r"/\s*(?:\n|$)")).alias("g")).filter(F.length(F.trim("g")) > 0)
    word = lambda k: F.nullif(F.regexp_extract("g", rf"(?i)\b{k}\w*\s*=\s*'([^']*)'", 1), F.lit(""))
    name = F.coalesce(F.nullif(F.regexp_extract("g", r"(?i)\bant_name\s*=\s*'?([A-Za-z0-9_]+)'?", 1), F.lit("")), word("ant"))
    times = F.transform(F.regexp_extract_all(F.regexp_extract("g", r"(?i)\btimer\w*\s*=\s*([-0-9.,\s]+)", 1), F.lit(r"[0-9.]+"), F.lit(0)), lambda x: x.cast("double"))
    start = F.datediff(F.make_date(F.lit(year), F.lit(1), F.lit(1)), F.lit("1858-11-17").cast("date"))
    at = lambda i: (start + F.get("_t", i) - 1) * 86400.0 + F.get("_t", i + 1) * 3600 + F.get("_t", i + 2) * 60 + F.get("_t", i + 3)
    rows = groups.select(F.upper(name).alias("antenna"), word("reason").alias("reason"), times.alias("_t"))
    return rows.select("antenna", F.when(F.size("_t") >= 8, at(0)).alias("t0"), F.when(F.size("_t") >= 8, at(4)).alias("t1"), "reason")


def uvflg_commands(flags: DataFrame, antennas: list[str], max_seconds: float | None = None) -> DataFrame:
    """Flag commands of the known antennas, none longer than max_seconds, as text."""
    f = flags.filter(F.col("antenna").isin([a.upper() for a in antennas]))
    if max_seconds is not None:
        f = f.filter(F.col("t0").isNull() | (F.col("t1") - F.col("t0") <= max_seconds))
    clock = lambda c: F.date_format(F.timestamp_micros((F.round(F.col(c) * 1000) * 1000 - MJD_1970 * 86400 * 1000000).cast("long")), "yyyy/MM/dd/HH:mm:ss.SSS")
    span = F.when(F.col("t0").isNull(), "").otherwise(F.concat(F.lit(" timerange='"), clock("t0"), F.lit("~"), clock("t1"), F.lit("'")))
    return f.select(F.concat(F.lit("mode='manual' antenna='"), "antenna", F.lit("'"), span, F.coalesce(F.concat(F.lit(" reason='"), "reason", F.lit("'")), F.lit(""))).alias("command"))


def read_eop(spark: SparkSession, path: str, mjd_min: float, mjd_max: float) -> DataFrame:
    """Earth orientation from fixed columns of the finals format: mjd, x, y (arcsec), ut1_utc (s)."""
    cut = lambda a, n: F.trim(F.substring("value", a, n)).cast("double")
    rows = spark.read.text(path).select(cut(8, 8).alias("mjd"), cut(19, 9).alias("x"), cut(38, 9).alias("y"), cut(59, 10).alias("ut1_utc"))
    return rows.filter(F.col("mjd").between(mjd_min, mjd_max) & F.col("ut1_utc").isNotNull())


def without_leap_jumps(eop: DataFrame) -> DataFrame:
    """ut1_utc made continuous: jumps of about a second between neighbouring days are taken out. One row per day."""
    w = Window.orderBy("mjd")
    jump = F.round(F.col("ut1_utc") - F.lag("ut1_utc").over(w))
    return eop.withColumn("_j", F.coalesce(jump, F.lit(0.0))).withColumn("ut1_smooth", F.col("ut1_utc") - F.sum("_j").over(w)).drop("_j")


def commands_from_table(rows: DataFrame, antennas: DataFrame) -> DataFrame:
    """Rows of an embedded flag table (time, interval, command) as commands: ids become names, the interval a time range about its centre."""
    numbered = rows.withColumn("_id", F.regexp_extract("command", r"antenna='?(\d+)", 1).cast("int"))
    named = numbered.join(F.broadcast(antennas.select(F.col("antenna").alias("_id"), "name")), "_id", "left")
    text = F.when(F.col("name").isNotNull(), F.regexp_replace(F.col("command"), F.lit(r"antenna='?\d+'?"), F.concat(F.lit("antenna='"), "name", F.lit("'")))).otherwise(F.col("command"))
    return named.select(text.alias("command"), (F.col("time") - F.col("interval") / 2).alias("t0"), (F.col("time") + F.col("interval") / 2).alias("t1"))


def read_features(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema(FEATURES).json(path)


def upsert_stage(old: DataFrame, new: DataFrame, stage: str) -> DataFrame:
    """Feature rows with those of one stage replaced."""
    return old.filter(F.col("stage") != stage).unionByName(new.filter(F.col("stage") == stage))


def apply_review(rows: DataFrame, review: DataFrame) -> DataFrame:
    """Labels overridden by a review's 'stage/unit' entries; a trailing * matches any rest; exact entries win, then the longest."""
    keys = review.select("experiment", "reviewer", F.explode("labels").alias("pattern", "new"))
    keys = F.broadcast(keys)
    name = F.concat_ws("/", "stage", "unit")
    r = rows.withColumn("_row", F.struct(*rows.columns)).alias("r")
    like = (F.col("k.pattern") == name) | (F.col("k.pattern").endswith("*") & F.col("r.stage").isNotNull() & F.expr("startswith(concat_ws('/', r.stage, r.unit), rtrim('*', k.pattern))"))
    hits = r.join(keys.alias("k"), (F.col("r.experiment") == F.col("k.experiment")) & like, "left")
    rank = F.struct((F.col("k.pattern") == name).cast("int").alias("exact"), F.length("k.pattern").alias("len"), F.col("k.new").alias("new"), F.col("k.reviewer").alias("who"))
    best = hits.groupBy("_row").agg(F.max(F.when(F.col("k.pattern").isNotNull(), rank)).alias("b"))
    out = best.select("_row.*", "b")
    return out.withColumns({"label": F.coalesce("b.new", "label"), "written_by": F.coalesce("b.who", "written_by")}).drop("b")




def _reviewed(s, d):
    rows = table(s, d, "labels").select(F.lit("E1").alias("experiment"), F.when(F.col("doc_id") % 2 == 0, "tsys").otherwise("cal").alias("stage"), F.concat(F.lit("A"), F.col("doc_id") % 9, F.lit("@"), F.col("doc_id")).alias("unit"), F.array(F.col("quality").cast("double")).alias("x"), F.array(F.lit("none")).alias("rule_labels"), F.col("quality").cast("string").alias("label"), F.lit("rule").alias("written_by"))
    review = s.createDataFrame([("E1", "R", {}, {"tsys/A4*": "good", "cal/A*": "bad", "cal/A1*": "fine"})], REVIEW)
    return apply_review(rows, review).groupBy("stage", "label", "written_by").agg(F.count("*").alias("n"))


QUERIES = {"feature_review": _reviewed}
SQL = {
    "feature_review": """WITH r AS (SELECT CASE WHEN doc_id % 2 = 0 THEN 'tsys' ELSE 'cal' END AS stage, 'A' || doc_id % 9 AS unit, quality::VARCHAR AS label FROM labels),
      o AS (SELECT stage, CASE WHEN stage = 'tsys' AND unit LIKE 'A4%' THEN 'good' WHEN stage = 'cal' AND unit LIKE 'A1%' THEN 'fine' WHEN stage = 'cal' THEN 'bad' END AS new, label FROM r)
      SELECT stage, coalesce(new, label) AS label, CASE WHEN new IS NULL THEN 'rule' ELSE 'R' END AS written_by, count(*) AS n FROM o GROUP BY ALL""",
}
