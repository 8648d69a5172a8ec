"""How late antennas arrive on bright fields, carried to fields too faint to measure; and channels that a bandpass can't calibrate, as commands."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..plans.model import SERIES, series, table
from .ranks import global_rank

GAPLESS, LEVEL, MARGIN, LEAST, SHARE = 10.0, 0.8, 1, 5, 0.2


def scan_kinds(scans: DataFrame, gapless: float = GAPLESS) -> DataFrame:
    """scans (scan, start, end, ...) with kind: "gapless" if one starts at most `gapless` seconds after the end of the scan before it in time, else "gap"."""
    placed = global_rank(scans, [F.col("start"), F.col("scan")], "_at")
    before = placed.select((F.col("_at") + 1).alias("_at"), F.col("end").alias("_end"))
    return placed.join(before, "_at", "left").withColumn("kind", F.when(F.col("start") - F.col("_end") <= gapless, "gapless").otherwise("gap")).drop("_at", "_end")


def arrivals(samples: DataFrame, scans: DataFrame, step: float, level: float = LEVEL, least: int = LEAST) -> DataFrame:
    """(antenna, scan, kind, arrival): seconds from a scan's start until the antenna was on source.

    samples: antenna, scan, t, factor, n_baselines. Off source: a factor under `level`, judged with two baselines or more. The
    arrival ends with the leading run of off-source samples; it is 0 without one. Scans of fewer than `least` judged samples don't count.
    """
    judged = samples.filter("n_baselines >= 2")
    w = Window.partitionBy("antenna", "scan").orderBy("t")
    on = (F.col("factor") >= level).cast("int")
    leading = judged.withColumn("_lead", F.sum(on).over(w) == 0)
    g = leading.groupBy("antenna", "scan").agg(F.count("*").alias("_n"), F.max(F.when(F.col("_lead"), F.col("t"))).alias("_last"))
    g = g.filter(F.col("_n") >= least).join(scans.select("scan", "start", "kind"), "scan")
    return g.select("antenna", "scan", "kind", F.coalesce(F.col("_last") + step / 2 - (F.col("start") - step / 2), F.lit(0.0)).alias("arrival"))


def typical_arrivals(found: DataFrame, least: int = LEAST, share: float = SHARE) -> DataFrame:
    """(antenna, kind, seconds): the 90th percentile of arrivals, for antennas late in at least `share` of at least `least` scans of the kind."""
    g = found.groupBy("antenna", "kind").agg(F.count("*").alias("_n"), F.avg((F.col("arrival") > 0).cast("double")).alias("_late"), F.percentile("arrival", 0.9).alias("seconds"))
    return g.filter((F.col("_n") >= least) & (F.col("_late") >= share) & (F.col("seconds") > 0)).select("antenna", "kind", "seconds")


def transfer(typical: DataFrame, scans: DataFrame, step: float, margin: int = MARGIN) -> DataFrame:
    """Commands (antenna, scan, begin, end) for the start of scans of fields that can't be measured: the typical arrival of each of their antennas, in scans of the same kind, and a margin of samples.

    scans: scan, start, end, kind, antennas (array).
    """
    each = scans.select("scan", "start", "end", "kind", F.explode("antennas").alias("antenna"))
    begin = F.col("start") - step / 2
    return each.join(typical, ["antenna", "kind"]).select("antenna", "scan", begin.alias("begin"), F.least(begin + F.col("seconds") + margin * step, F.col("end") + step / 2).alias("end"))


def bandpass_gaps(solutions: DataFrame, keys: list[str], min_gain: float = 0.5) -> DataFrame:
    """Commands (keys, hand, first, last) for channels that a bandpass can't calibrate.

    solutions: keys, hand, arrays amp and flag over channels. A hand without any solution, where another has some, is dead: a command for
    that hand alone, without channels. Runs of channels flagged or under min_gain in any live hand are commands for all hands
    (hand null). Keys without a solution in any hand have none: there is no data to protect.
    """
    live = F.exists("flag", lambda f: ~f)
    marked = solutions.withColumn("_live", live)
    marked = marked.withColumn("_some", F.max("_live").over(Window.partitionBy(*keys))).filter("_some")
    dead = marked.filter("NOT _live").select(*keys, "hand", F.lit(None).cast("int").alias("first"), F.lit(None).cast("int").alias("last"))
    cells = marked.filter("_live").select(*keys, F.posexplode(F.zip_with("amp", "flag", lambda a, f: f | (a < min_gain))).alias("channel", "_bad"))
    bad = cells.groupBy(*keys, "channel").agg(F.max("_bad").alias("_bad")).filter("_bad")
    isle = F.col("channel") - F.row_number().over(Window.partitionBy(*keys).orderBy("channel"))
    runs = bad.withColumn("_isle", isle).groupBy(*keys, "_isle").agg(F.min("channel").alias("first"), F.max("channel").alias("last"))
    return dead.unionByName(runs.select(*keys, F.lit(None).cast("int").alias("hand"), "first", "last"))


STEP, LENGTH = 60.0, 3600


def _samples(s, d) -> DataFrame:
    """Events as samples: scans of an hour of even ones in bright fields; antennas by user."""
    e = series(s, d)
    return e.select((F.col("user_id") % 9).cast("int").alias("antenna"), F.floor(F.col("t") / LENGTH).cast("int").alias("scan"), "t", (F.col("value") / 40).alias("factor"), (F.col("event_id") % 6).alias("n_baselines"))


def _scans(s, d) -> DataFrame:
    g = _samples(s, d).groupBy("scan").agg(F.min("t").alias("start"), F.max("t").alias("end"), F.array_sort(F.collect_set("antenna")).alias("antennas"))
    return scan_kinds(g, 300.0)


def _transferred(s, d):
    scans = _scans(s, d)
    bright = _samples(s, d).filter("scan % 2 = 0")
    typical = typical_arrivals(arrivals(bright, scans, STEP, least=2), least=3)
    out = transfer(typical, scans.filter("scan % 2 = 1"), STEP)
    return out.select("antenna", "scan", F.round("begin", 3).alias("begin"), F.round("end", 3).alias("end"))


def _gaps(s, d):
    e, k = table(s, d, "embeddings"), F.col("vec_id")
    x = F.transform(F.slice("embedding", 1, 24), lambda v: v.cast("double"))
    rows = e.select(F.floor(k / 2).alias("antenna"), (k % 2).cast("int").alias("hand"), F.transform(x, lambda v: F.lit(0.75) + v).alias("amp"), F.when(k % 11 == 3, F.transform(x, lambda v: F.lit(True))).otherwise(F.transform(x, lambda v: v > 1.0)).alias("flag"))
    return bandpass_gaps(rows, ["antenna"])


QUERIES = {"off_source_transfer": _transferred, "bandpass_gaps": _gaps}
SQL = {
    "off_source_transfer": f"""WITH {SERIES}, x AS (SELECT CAST(user_id % 9 AS INT) AS antenna, CAST(floor(t / {LENGTH}) AS INT) AS scan, t, value / 40 AS factor, event_id % 6 AS nb FROM ev),
      sc AS (SELECT scan, min(t) AS s, max(t) AS e FROM x GROUP BY scan), k AS (SELECT *, CASE WHEN s - lag(e) OVER (ORDER BY s, scan) <= 300 THEN 'gapless' ELSE 'gap' END AS kind FROM sc),
      j AS (SELECT *, sum((factor >= {LEVEL})::INT) OVER (PARTITION BY antenna, scan ORDER BY t) = 0 AS lead FROM x WHERE nb >= 2 AND scan % 2 = 0),
      a AS (SELECT antenna, scan, count(*) AS n, max(t) FILTER (lead) AS last FROM j GROUP BY ALL HAVING count(*) >= 2),
      r AS (SELECT antenna, kind, coalesce(last + {STEP / 2} - (s - {STEP / 2}), 0.0) AS arrival FROM a JOIN k USING (scan)),
      ty AS (SELECT antenna, kind, quantile_cont(arrival, 0.9) AS seconds FROM r GROUP BY ALL HAVING count(*) >= 3 AND avg((arrival > 0)::INT) >= {SHARE} AND quantile_cont(arrival, 0.9) > 0),
      m AS (SELECT DISTINCT antenna, scan FROM x WHERE scan % 2 = 1)
      SELECT m.antenna, m.scan, round(s - {STEP / 2}, 3) AS begin, round(least(s - {STEP / 2} + seconds + {STEP}, e + {STEP / 2}), 3) AS "end" FROM m JOIN k USING (scan) JOIN ty ON ty.antenna = m.antenna AND ty.kind = k.kind""",
    "bandpass_gaps": """WITH r AS (SELECT vec_id // 2 AS antenna, vec_id % 2 AS hand, vec_id % 11 = 3 AS dead, embedding FROM embeddings),
      c AS (SELECT antenna, hand, dead, c, CASE WHEN dead THEN true ELSE embedding[c + 1]::DOUBLE > 1.0 END AS f, 0.75 + embedding[c + 1]::DOUBLE < 0.5 AS low FROM r, range(24) q(c)),
      l AS (SELECT antenna, hand, bool_or(NOT f) AS live FROM c GROUP BY ALL), s AS (SELECT antenna, bool_or(live) AS any_live FROM l GROUP BY antenna),
      b AS (SELECT DISTINCT c.antenna, c.c FROM c JOIN l USING (antenna, hand) WHERE live AND (f OR low)), i AS (SELECT *, c - row_number() OVER (PARTITION BY antenna ORDER BY c) AS isle FROM b)
      SELECT antenna, hand::INT AS hand, NULL::INT AS first, NULL::INT AS last FROM l JOIN s USING (antenna) WHERE any_live AND NOT live UNION ALL SELECT antenna, NULL, min(c)::INT, max(c)::INT FROM i GROUP BY antenna, isle""",
}
