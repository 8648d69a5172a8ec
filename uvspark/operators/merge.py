"""Merging epochs and dimensions, pivots, upserts, decimation and compact text."""

from __future__ import annotations

import math

import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..plans.model import SERIES, VIS, series, table, visibilities
from .ranks import global_rank


def concat_epochs(first: DataFrame, others: list[DataFrame], scales: list[float] | None = None) -> DataFrame:
    """Union of epochs: scans follow the ones before (maximum + 1 - own minimum), amplitudes are scaled, weights by the inverse square."""
    out = first.withColumn("epoch", F.lit(0))
    for i, other in enumerate(others, 1):
        scale = (scales or [1.0] * len(others))[i - 1]
        top, low = F.broadcast(out.agg((F.max("scan") + 1).alias("_top"))), F.broadcast(other.agg(F.min("scan").alias("_low")))
        moved = other.crossJoin(top).crossJoin(low).withColumn("scan", F.col("scan") + F.col("_top") - F.col("_low")).drop("_top", "_low")
        moved = moved.withColumns({"amp": F.col("amp") * scale, "weight": F.col("weight") / scale**2, "epoch": F.lit(i)})
        out = out.unionByName(moved)
    return out


def remap_antennas(vis: DataFrame, ids: DataFrame, im: str | None = None) -> DataFrame:
    """Replace antenna ids through (old, new); baselines whose order flips are swapped, and the imaginary part negated."""
    for end in (1, 2):
        m = F.broadcast(ids.select(F.col("old").alias(f"antenna{end}"), F.col("new").alias(f"_n{end}")))
        vis = vis.join(m, f"antenna{end}")
    flip = F.col("_n1") > F.col("_n2")
    cols = {"antenna1": F.least("_n1", "_n2"), "antenna2": F.greatest("_n1", "_n2")}
    if im:
        cols[im] = F.when(flip, -F.col(im)).otherwise(F.col(im))
    return vis.withColumns(cols).drop("_n1", "_n2")


def match_dimension(known: DataFrame, others: DataFrame, equal: str, position: str, tolerance: float) -> DataFrame:
    """Id of each of `others` (id, equal, position) in `known`: equal attribute and position within the tolerance, the last such row; else appended after the largest id.

    Positions meet in cells of twice the tolerance, so only near rows are compared.
    """
    cell = F.floor(F.col(position) / (2 * tolerance))
    a = others.withColumn("_c", F.explode(F.array(cell - 1, cell, cell + 1))).alias("a")
    b = known.withColumn("_c", cell).alias("b")
    near = F.abs(F.col(f"a.{position}") - F.col(f"b.{position}")) <= tolerance
    hits = a.join(b, (F.col("a._c") == F.col("b._c")) & (F.col(f"a.{equal}") == F.col(f"b.{equal}")) & near)
    best = hits.groupBy(F.col("a.id").alias("id")).agg(F.max("b.id").alias("matched"))
    out = others.join(best, "id", "left")
    top = F.broadcast(known.agg(F.max("id").alias("_top")))
    new = global_rank(out.filter("matched IS NULL").select("id"), [F.col("id")], "_nth").crossJoin(top)
    new = new.select("id", (F.col("_top") + F.col("_nth") + 1).alias("new_id"), F.lit(True).alias("appended"))
    return out.filter("matched IS NOT NULL").select("id", F.col("matched").alias("new_id"), F.lit(False).alias("appended")).unionByName(new)


def dedup_rows(rows: DataFrame, attributes: list[str]) -> DataFrame:
    """Map each id to the least id with equal attributes."""
    return rows.select("id", F.min("id").over(Window.partitionBy(*attributes)).alias("new_id"))


def pivot_subbands(vis: DataFrame, keys: list[str], subbands: list[int]) -> DataFrame:
    """Subbands as columns if1, if2, ...; missing ones are padded with 0, and n_present counts the others."""
    p = vis.groupBy(*keys).pivot("ddid", subbands).agg(F.round(F.sum("amp"), 2))
    names = [str(b) for b in subbands]
    present = sum((F.col(f"`{n}`").isNotNull().cast("int") for n in names), F.lit(0))
    return p.select(*keys, *[F.coalesce(F.col(f"`{n}`"), F.lit(0.0)).alias(f"if{n}") for n in names], present.alias("n_present"))


def every_kth(rows: DataFrame, key: str, order: list[str], most: int) -> DataFrame:
    """Every k-th row per key, k the least that leaves at most `most`."""
    w = Window.partitionBy(key)
    k = F.ceil(F.count("*").over(w) / most)
    return rows.withColumn("_k", k).withColumn("_rn", F.row_number().over(w.orderBy(*order)) - 1).filter("_rn % _k = 0").drop("_k", "_rn")


def even_sample(rows: DataFrame, key: str, order: list[str], k: int) -> DataFrame:
    """Rows floor(i * n / k) for i below k, per key; all if there are no more than k."""
    w = Window.partitionBy(key)
    n, at = F.count("*").over(w), F.row_number().over(w.orderBy(*order)) - 1
    i = F.ceil(F.col("_at") * k / F.col("_n"))
    chosen = (F.col("_n") <= k) | ((i < k) & (F.floor(i * F.col("_n") / k) == F.col("_at")))
    return rows.withColumn("_n", n).withColumn("_at", at).filter(chosen).drop("_n", "_at")


def format_runs(rows: DataFrame, key: str, number: str) -> DataFrame:
    """Distinct numbers per key as text: '1-3, 5'."""
    w = Window.partitionBy(key).orderBy(number)
    isle = rows.select(key, number).distinct().withColumn("_i", F.col(number) - F.row_number().over(w))
    runs = isle.groupBy(key, "_i").agg(F.min(number).alias("a"), F.max(number).alias("b"))
    text = F.when(F.col("a") == F.col("b"), F.col("a").cast("string")).otherwise(F.concat_ws("-", "a", "b"))
    listed = runs.groupBy(key).agg(F.sort_array(F.collect_list(F.struct("a", text.alias("t")))).alias("r"))
    return listed.select(key, F.array_join(F.transform("r", lambda x: x["t"]), ", ").alias("runs"))


def upsert(old: DataFrame, new: DataFrame, keys: list[str]) -> DataFrame:
    """Rows of new, and those of old whose keys new doesn't have."""
    return old.join(new.select(*keys).distinct(), keys, "left_anti").unionByName(new)


def blend(first: DataFrame, second: DataFrame, keys: list[str], value: str, x: Column | float) -> DataFrame:
    """(1 - x) A + x B over both; a point that one side alone has takes that one."""
    j = first.select(*keys, F.col(value).alias("_a")).join(second.select(*keys, F.col(value).alias("_b")), keys, "full")
    return j.select(*keys, F.coalesce((1 - F.lit(x)) * F.col("_a") + F.lit(x) * F.col("_b"), "_a", "_b").alias(value))


def nearest(f):
    """A function of the C library on a column; null stays null. Its last digit is nearly always right; that of Spark's log and exp isn't, and a ratio at the limit shows it. For small tables."""

    @F.pandas_udf("double")
    def of(x: pd.Series) -> pd.Series:
        return pd.Series([None if pd.isna(v) else f(v) for v in x], dtype="Float64").astype(float)

    return of


def level_gains(rows: DataFrame, factor: float = 2.0) -> DataFrame:
    """Per antenna and subband: gains over the level of (antenna, field), exp of the mean over hands of log medians; ratios within the factor, merged over fields as snr-weighted geometric mean."""
    log, exp = nearest(math.log), nearest(math.exp)
    logs = rows.groupBy("antenna", "field", "hand").agg(F.median("gain").alias("_m")).withColumn("_log", log(F.when(F.col("_m") > 0, F.col("_m"))))
    med = logs.groupBy("antenna", "field").agg(F.avg("_log").alias("_log")).withColumn("_level", exp("_log")).drop("_log")
    r = rows.join(med, ["antenna", "field"]).withColumn("ratio", F.col("gain") / F.col("_level"))
    ok = r.filter(F.col("ratio").between(1 / factor, factor))
    return ok.groupBy("antenna", "ddid").agg(F.round(F.exp(F.sum(F.col("snr") * F.log("ratio")) / F.sum("snr")), 6).alias("gain"), F.count("*").alias("n"))


def _halves(s, d):
    v = visibilities(s, d).withColumn("_odd", F.col("day") % 2)
    out = concat_epochs(v.filter("_odd = 0"), [v.filter("_odd = 1")], [2.0])
    return out.groupBy("epoch", "scan").agg(F.count("*").alias("n"), F.round(F.sum("amp"), 2).alias("amp"), F.round(F.sum("weight"), 4).alias("weight"))


def _matched(s, d):
    known = table(s, d, "supplier").select(F.col("s_suppkey").alias("id"), F.col("s_nationkey").alias("nation"), F.col("s_acctbal").alias("pos"))
    others = table(s, d, "customer").select(F.col("c_custkey").alias("id"), F.col("c_nationkey").alias("nation"), F.col("c_acctbal").alias("pos"))
    return match_dimension(known, others, "nation", "pos", 100.0)


def _upserted(s, d):
    days = series(s, d).groupBy("user_id", "day").agg(F.round(F.sum("value"), 2).alias("total"))
    return upsert(days, days.filter("day % 3 = 0 AND user_id % 2 = 0").withColumn("total", F.lit(-1.0)), ["user_id", "day"])


def _blended(s, d):
    hand = lambda k: series(s, d).filter(F.col("event_type") == k).groupBy("user_id", "day").agg(F.avg("value").alias("value"))
    out = blend(hand("click"), hand("view"), ["user_id", "day"], "value", 0.25)
    return out.select("user_id", "day", F.round("value", 6).alias("value"))


def _levelled(s, d):
    r = series(s, d).select((F.col("user_id") % 10).alias("antenna"), F.col("event_type").alias("field"), (F.col("user_id") % 2).alias("hand"), (F.col("day") % 4).alias("ddid"), F.col("value").alias("gain"), (F.lit(1) + F.col("event_id") % 5).cast("double").alias("snr"))
    return level_gains(r)


QUERIES = {
    "concat_epochs": _halves,
    "dim_match_tolerance": _matched,
    "observation_dedup": lambda s, d: dedup_rows(table(s, d, "orders").select(F.col("o_orderkey").alias("id"), "o_custkey", "o_orderstatus"), ["o_custkey", "o_orderstatus"]),
    "uv_pivot_ifs": lambda s, d: pivot_subbands(visibilities(s, d), ["scan", "antenna1", "antenna2"], list(range(1, 8))),
    "every_kth_row": lambda s, d: every_kth(series(s, d), "user_id", ["us", "event_id"], 10).select("event_id", "user_id"),
    "even_sample": lambda s, d: even_sample(series(s, d), "user_id", ["us", "event_id"], 12).select("event_id", "user_id"),
    "format_runs": lambda s, d: format_runs(series(s, d), "user_id", "day"),
    "caltable_upsert": _upserted,
    "interpolated_combine": _blended,
    "level_gains": _levelled,
}
SQL = {
    "concat_epochs": f"""WITH {VIS}, a AS (SELECT * FROM vis WHERE day % 2 = 0), b AS (SELECT * FROM vis WHERE day % 2 = 1),
      u AS (SELECT 0 AS epoch, scan, amp, weight FROM a UNION ALL SELECT 1, scan + (SELECT max(scan) + 1 FROM a) - (SELECT min(scan) FROM b), amp * 2.0, weight / 4.0 FROM b)
      SELECT epoch, scan, count(*) AS n, round(sum(amp), 2) AS amp, round(sum(weight), 4) AS weight FROM u GROUP BY ALL""",
    "dim_match_tolerance": """WITH m AS (SELECT c_custkey AS id, max(s_suppkey) AS k FROM customer LEFT JOIN supplier ON c_nationkey = s_nationkey AND abs(c_acctbal - s_acctbal) <= 100.0 GROUP BY c_custkey)
      SELECT id, coalesce(k, (SELECT max(s_suppkey) FROM supplier) + row_number() OVER (PARTITION BY k IS NULL ORDER BY id)) AS new_id, k IS NULL AS appended FROM m""",
    "observation_dedup": "SELECT o_orderkey AS id, min(o_orderkey) OVER (PARTITION BY o_custkey, o_orderstatus) AS new_id FROM orders",
    "uv_pivot_ifs": f"WITH {VIS} SELECT scan, antenna1, antenna2, " + ", ".join(f"coalesce(round(sum(amp) FILTER (ddid = {k}), 2), 0.0) AS if{k}" for k in range(1, 8)) + ", CAST(count(DISTINCT ddid) AS INT) AS n_present FROM vis GROUP BY ALL",
    "every_kth_row": f"WITH {SERIES}, r AS (SELECT event_id, user_id, row_number() OVER (PARTITION BY user_id ORDER BY us, event_id) - 1 AS rn, CAST(ceil(count(*) OVER (PARTITION BY user_id) / 10.0) AS INT) AS k FROM ev) SELECT event_id, user_id FROM r WHERE rn % k = 0",
    "even_sample": f"""WITH {SERIES}, r AS (SELECT event_id, user_id, row_number() OVER (PARTITION BY user_id ORDER BY us, event_id) - 1 AS rn, count(*) OVER (PARTITION BY user_id) AS n FROM ev)
      SELECT event_id, user_id FROM r WHERE n <= 12 OR EXISTS (SELECT 1 FROM range(12) i(i) WHERE (i * n) // 12 = rn)""",
    "format_runs": f"""WITH {SERIES}, q AS (SELECT DISTINCT user_id, day FROM ev), i AS (SELECT *, day - row_number() OVER (PARTITION BY user_id ORDER BY day) AS g FROM q), r AS (SELECT user_id, min(day) AS a, max(day) AS b FROM i GROUP BY user_id, g)
      SELECT user_id, string_agg(CASE WHEN a = b THEN a::VARCHAR ELSE a || '-' || b END, ', ' ORDER BY a) AS runs FROM r GROUP BY user_id""",
    "caltable_upsert": f"WITH {SERIES} SELECT user_id, day, CASE WHEN day % 3 = 0 AND user_id % 2 = 0 THEN -1.0 ELSE round(sum(value), 2) END AS total FROM ev GROUP BY user_id, day",
    "interpolated_combine": f"""WITH {SERIES}, a AS (SELECT user_id, day, avg(value) FILTER (event_type = 'click') AS a, avg(value) FILTER (event_type = 'view') AS b FROM ev WHERE event_type IN ('click', 'view') GROUP BY ALL)
      SELECT user_id, day, round(coalesce(0.75 * a + 0.25 * b, a, b), 6) AS value FROM a""",
    "level_gains": f"""WITH {SERIES}, r AS (SELECT user_id % 10 AS antenna, event_type AS field, user_id % 2 AS hand, day % 4 AS ddid, value AS gain, (1 + event_id % 5)::DOUBLE AS snr FROM ev),
      m AS (SELECT antenna, field, exp(avg(ln(m))) AS level FROM (SELECT antenna, field, hand, median(gain) AS m FROM r GROUP BY ALL) GROUP BY ALL),
      x AS (SELECT *, gain / level AS ratio FROM r JOIN m USING (antenna, field) WHERE gain / level BETWEEN 0.5 AND 2.0)
      SELECT antenna, ddid, round(exp(sum(snr * ln(ratio)) / sum(snr)), 6) AS gain, count(*) AS n FROM x GROUP BY ALL""",
}
