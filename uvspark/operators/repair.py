"""Repair of system-temperature series by decisions, and windows that widen until they hold enough good points."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..plans.model import SERIES, series, table
from .robust import despike

# The share of the median under which a value is unphysical, windows of smoothing in seconds, and the largest factor for opacity.
UNPHYSICAL, LONG, DEFAULT, SHORT, MOST_FACTOR = 0.3, 1800.0, 600.0, 300.0, 3.0
SERIES_KEYS = ["antenna", "spw", "hand"]


def smoothed_within(value: Column, keys: list[str], scaled: str, least: int = 3) -> Column:
    """Median over the closed window from one unit before to one after each row, in a time that every series scales by half its own window; the value itself where fewer than `least` are there."""
    w = Window.partitionBy(*keys).orderBy(scaled).rangeBetween(-1, 1)
    return F.when(value.isNotNull(), F.when(F.count(value).over(w) >= least, F.percentile(value, 0.5).over(w)).otherwise(value))


def repair(rows: DataFrame, decisions: DataFrame, despike_sigma: float = 6.0, least: int = 3) -> DataFrame:
    """Series repaired in a fixed order, each step on the result of the one before.

    rows: antenna, spw, hand, field, t, id (unique), value, flag. decisions, one row per series or none: source_hand (the series takes that
    hand's time dependence at its own median), scale, window (seconds; 0: no smoothing), combine_fields, exponent. Steps:

    1. values under UNPHYSICAL of the series' median are flagged;
    2. with a source_hand, values become that hand's at the same time, times the ratio of the medians where both are good (three at least);
    3. values are scaled;
    4. each series (each field of it, unless combined) of three or more is de-spiked, then smoothed by its window's median;
    5. with an exponent, values grow by (slow / level) ** (exponent - 1), slow being their median over DEFAULT seconds, within MOST_FACTOR.

    Series without a decision are smoothed over DEFAULT with their fields combined. Adds `changed`; a flagged value is null in the steps
    and keeps its own unless step 2 replaces it. Hands meet by a join on (antenna, spw, time); all windows run over one partitioning by series.
    """
    keys = SERIES_KEYS
    r = rows.join(decisions, keys, "left").withColumns({"window": F.coalesce("window", F.lit(DEFAULT)), "combine_fields": F.coalesce("combine_fields", F.lit(True)), "exponent": F.coalesce("exponent", F.lit(1.0))})
    own = Window.partitionBy(*keys)
    good = F.when(~F.col("flag") & (F.col("value") > 0), F.col("value"))
    r = r.withColumn("_m", F.median(good).over(own))
    r = r.withColumn("_flag", F.col("flag") | F.coalesce(good < UNPHYSICAL * F.col("_m"), F.lit(False)))
    r = r.withColumn("_v", F.when(~F.col("_flag"), F.col("value"))).drop("_m")
    # 2: the other hand's values at the same time.
    source = r.select("antenna", "spw", F.col("hand").alias("source_hand"), "t", F.col("_v").alias("_sv")).groupBy("antenna", "spw", "source_hand", "t").agg(F.min("_sv").alias("_sv"))
    r = r.join(source, ["antenna", "spw", "source_hand", "t"], "left")
    both = (F.col("_v") > 0) & (F.col("_sv") > 0)
    med = lambda c: F.median(F.when(both, F.col(c))).over(own)
    r = r.withColumns({"_n": F.count(F.when(both, 1)).over(own), "_ratio": med("_v") / med("_sv")})
    take = F.coalesce((F.col("_n") >= 3) & F.col("_sv").isNotNull(), F.lit(False))
    r = r.withColumns({"_took": take, "_w": F.when(take, F.col("_sv") * F.col("_ratio")).otherwise(F.col("_v"))})
    r = r.withColumn("_flag", F.col("_flag") & ~F.col("_took"))
    # 3
    factor = F.when(F.col("scale") > 0, F.col("scale")).otherwise(1.0)
    r = r.withColumn("_w", F.col("_w") * factor)
    # 4: within groups of a series.
    group = [*keys, "_group"]
    r = r.withColumn("_group", F.when(F.col("combine_fields"), F.lit(-1)).otherwise(F.col("field")))
    whole = Window.partitionBy(*group)
    r = r.withColumn("_few", (F.count("*").over(whole) < 3) | (F.count("_w").over(whole) < 3))
    r = despike(r, group, ["t", "id"], "_w", despike_sigma, 3, 5).withColumn("_c", F.when(F.col("_few"), F.col("_w")).otherwise(F.col("despiked"))).drop("despiked")
    r = r.withColumn("_scaled", 2 * F.col("t") / F.when(F.col("window") > 0, F.col("window")).otherwise(1.0))
    r = r.withColumn("_c", F.when(F.col("_few") | (F.col("window") <= 0), F.col("_c")).otherwise(smoothed_within(F.col("_c"), group, "_scaled", least)))
    # 5
    r = r.withColumn("_t", 2 * F.col("t") / DEFAULT).withColumn("_level", F.median("_c").over(own))
    r = r.withColumn("_slow", smoothed_within(F.col("_c"), keys, "_t", least))
    power = F.pow(F.col("_slow") / F.col("_level"), F.col("exponent") - 1)
    opaque = (F.col("exponent") != 1) & (F.col("_level") > 0) & (F.col("_c") > 0) & (F.col("_slow") > 0)
    r = r.withColumn("_c", F.when(F.coalesce(opaque, F.lit(False)), F.col("_c") * F.greatest(F.lit(1 / MOST_FACTOR), F.least(F.lit(MOST_FACTOR), power))).otherwise(F.col("_c")))
    kept = F.coalesce("_c", F.when(F.col("_flag"), F.col("value") * factor))
    return r.select(*keys, "field", "t", "id", kept.alias("value"), F.col("_flag").alias("flag"), F.coalesce(kept != F.col("value"), F.lit(True)).alias("changed"))


def widened_window(rows: DataFrame, keys: list[str], time: str, window: float, least: int) -> DataFrame:
    """Add _window: the window, or as wide as `least` + 1 median spacings of its series."""
    gap = F.col(time) - F.lag(time).over(Window.partitionBy(*keys).orderBy(time))
    spaced = rows.withColumn("_gap", gap)
    wide = F.greatest(F.lit(float(window)), (max(1, least) + 1) * F.coalesce(F.median("_gap").over(Window.partitionBy(*keys)), F.lit(0.0)))
    return spaced.withColumn("_window", wide).drop("_gap")


def smooth_widened(rows: DataFrame, keys: list[str], time: str, value: str, window: float, least: int) -> DataFrame:
    """Add width and smoothed: the median of good values in a closed window that is wide enough for the series' own spacing; the value itself where fewer than `least` are there."""
    r = widened_window(rows, keys, time, window, least).withColumn("_scaled", 2 * F.col(time) / F.col("_window"))
    return r.withColumn("smoothed", smoothed_within(F.col(value), keys, "_scaled", least)).withColumnRenamed("_window", "width").drop("_scaled")


def mean_of_enough(rows: DataFrame, keys: list[str], time: str, unique: str, value: str, half: float, least: int) -> DataFrame:
    """Add reach, n_used and mean: of all good values within the least distance, `half` at least, that holds `least` of them (itself included).

    The least-th nearest lies a known number of good points before or after, so its distance comes from lags. Counts and sums up to both ends of
    the reach are found among the running sums of the series by one sort of points and ends: no list per row. Null reach where a series
    has fewer than `least`.
    """
    w = Window.partitionBy(*keys).orderBy(time, unique)
    ahead = Window.partitionBy(*keys).orderBy(F.desc(time), F.desc(unique))
    good = F.col(value).isNotNull()
    # Times of the good points about each row: the k-th before (or at) and after it.
    t = F.col(time)
    points = rows.filter(good).withColumns({"_n": F.count("*").over(w), "_s": F.sum(value).over(w)})
    near = [F.greatest(t - F.lag(t, i).over(w), F.lead(t, least - 1 - i).over(w) - t) for i in range(least)]
    options = F.array_min(F.filter(F.array(*near), lambda x: x.isNotNull())) if least > 1 else F.lit(0.0)
    whole = F.array(*[F.when(F.lag(t, i).over(w).isNotNull() & F.lead(t, least - 1 - i).over(w).isNotNull(), near[i]) for i in range(least)])
    reach = F.array_min(F.filter(whole, lambda x: x.isNotNull())) if least > 1 else options
    points = points.withColumn("reach", F.greatest(F.lit(float(half)), reach)).withColumn("reach", F.when(reach.isNotNull(), F.col("reach")))
    # Ends before all points of the same time on the left, after them on the right.
    none = F.lit(None)
    marks = points.select(*keys, t.alias("_t"), F.lit(1).alias("_o"), none.cast("bigint").alias("_of"), none.cast("int").alias("_end"), F.lit(1).alias("_one"), F.col(value).cast("double").alias("_x"))
    ends = points.filter("reach IS NOT NULL").select(*keys, F.explode(F.array(F.struct((t - F.col("reach")).alias("_t"), F.lit(0).alias("_o"), F.lit(0).alias("_end")), F.struct((t + F.col("reach")).alias("_t"), F.lit(2).alias("_o"), F.lit(1).alias("_end")))).alias("_e"), F.col(unique).cast("bigint").alias("_of"))
    ends = ends.select(*keys, "_e._t", "_e._o", "_of", "_e._end", F.lit(0).alias("_one"), F.lit(0.0).alias("_x"))
    order = Window.partitionBy(*keys).orderBy("_t", "_o").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    run = marks.unionByName(ends).withColumns({"_n": F.sum("_one").over(order), "_s": F.sum("_x").over(order)}).filter("_of IS NOT NULL")
    sign = F.when(F.col("_end") == 1, 1).otherwise(-1)
    found = run.groupBy(*keys, F.col("_of").alias(unique)).agg(F.sum(sign * F.col("_n")).alias("n_used"), F.sum(sign * F.col("_s")).alias("_sum"))
    out = rows.join(points.select(*keys, unique, "reach"), [*keys, unique], "left").join(found, [*keys, unique], "left")
    return out.withColumn("mean", F.col("_sum") / F.col("n_used")).drop("_sum")


def _tsys(s, d) -> DataFrame:
    """Events as series of two hands; some flagged, some spikes, some far too low."""
    e = series(s, d)
    k = F.col("event_id")
    level = 50 + F.col("value") % 20 + F.when(k % 37 == 0, 400.0).otherwise(0.0) - F.when(k % 41 == 0, 45.0).otherwise(0.0)
    return e.select((F.col("user_id") % 6).cast("int").alias("antenna"), F.lit(0).alias("spw"), (k % 2).cast("int").alias("hand"), (F.col("user_id") % 3).cast("int").alias("field"), (F.floor(F.col("t") / 1200) * 60.0).alias("t"), k.alias("id"), level.alias("value"), (k % 13 == 5).alias("flag"))


def _one_per_time(s, d) -> DataFrame:
    """One row per series and time: the one of least id."""
    return _tsys(s, d).groupBy("antenna", "spw", "hand", "t").agg(F.min(F.struct("id", "field", "value", "flag")).alias("_x")).select("antenna", "spw", "hand", "_x.field", "t", "_x.id", "_x.value", "_x.flag")


def _decisions(s) -> DataFrame:
    rows = [(0, 0, 1, 0, None, 600.0, True, 1.0), (1, 0, 0, None, 1.5, 300.0, False, 1.0), (2, 0, 0, None, None, 1800.0, True, 2.0), (3, 0, 1, None, None, 0.0, True, 1.0), (4, 0, 0, 1, 0.5, 300.0, True, 1.5)]
    return s.createDataFrame(rows, "antenna int, spw int, hand int, source_hand int, scale double, window double, combine_fields boolean, exponent double")


def _repaired(s, d):
    out = repair(_one_per_time(s, d), _decisions(s))
    return out.select("id", F.round("value", 5).alias("value"), "flag")


def _wide(s, d):
    e = series(s, d).select("user_id", "event_id", "t", F.when(F.col("event_id") % 5 != 0, F.col("value")).alias("value")).filter("user_id % 3 = 0 OR event_id % 4 = 0")
    out = smooth_widened(e, ["user_id"], "t", "value", 20000.0, 4)
    return out.select("event_id", F.round("width", 3).alias("width"), F.round("smoothed", 6).alias("smoothed"))


def _enough(s, d):
    e = series(s, d).select("user_id", "event_id", "t", F.when(F.col("event_id") % 5 != 0, F.col("value")).alias("value"))
    out = mean_of_enough(e, ["user_id"], "t", "event_id", "value", 10000.0, 4)
    return out.select("event_id", F.round("reach", 3).alias("reach"), "n_used", F.round("mean", 6).alias("mean"))


QUERIES = {"repair_tsys_series": _repaired, "smooth_widened": _wide, "mean_of_enough": _enough}


def _pass(i: int) -> str:
    """One pass of the de-spiking in SQL: outliers become the running median of the others."""
    return f""", a{i} AS (SELECT *, count(x{i}) OVER g AS n_{i}, median(x{i}) OVER g AS m_{i} FROM p{i} WINDOW g AS (PARTITION BY antenna, hand, grp)),
      b{i} AS (SELECT *, 1.4826 * median(abs(x{i} - m_{i})) OVER (PARTITION BY antenna, hand, grp) AS s_{i} FROM a{i}),
      c{i} AS (SELECT *, coalesce(n_{i} >= 3 AND s_{i} > 0 AND round(abs(x{i} - m_{i}), 6) > round(6.0 * s_{i}, 6), false) AS off_{i} FROM b{i}),
      p{i + 1} AS (SELECT *, CASE WHEN off_{i} THEN coalesce(round(median(CASE WHEN NOT off_{i} THEN x{i} END) OVER (PARTITION BY antenna, hand, grp ORDER BY t, id ROWS BETWEEN 2 PRECEDING AND 2 FOLLOWING), 9), x{i}) ELSE x{i} END AS x{i + 1} FROM c{i})"""


SQL = {
    "repair_tsys_series": f"""WITH {SERIES}, l AS (SELECT CAST(user_id % 6 AS INT) AS antenna, CAST(event_id % 2 AS INT) AS hand, CAST(user_id % 3 AS INT) AS field, floor(t / 1200) * 60.0 AS t, event_id AS id, 50 + value % 20 + CASE WHEN event_id % 37 = 0 THEN 400.0 ELSE 0.0 END - CASE WHEN event_id % 41 = 0 THEN 45.0 ELSE 0.0 END AS v, event_id % 13 = 5 AS flag FROM ev),
      o AS (SELECT * FROM l QUALIFY row_number() OVER (PARTITION BY antenna, hand, t ORDER BY id) = 1),
      de AS (SELECT * FROM (VALUES (0, 1, 0, NULL, 600.0, true, 1.0), (1, 0, NULL, 1.5, 300.0, false, 1.0), (2, 0, NULL, NULL, 1800.0, true, 2.0), (3, 1, NULL, NULL, 0.0, true, 1.0), (4, 0, 1, 0.5, 300.0, true, 1.5)) q(antenna, hand, source_hand, scale, win, comb, ex)),
      r0 AS (SELECT o.*, source_hand, coalesce(scale, 1.0)::DOUBLE AS scale, coalesce(win, 600.0)::DOUBLE AS win, coalesce(comb, true) AS comb, coalesce(ex, 1.0)::DOUBLE AS ex FROM o LEFT JOIN de USING (antenna, hand)),
      r1 AS (SELECT *, flag OR coalesce(v < {UNPHYSICAL} * median(CASE WHEN NOT flag AND v > 0 THEN v END) OVER (PARTITION BY antenna, hand) AND NOT flag AND v > 0, false) AS f1 FROM r0),
      r2 AS (SELECT *, CASE WHEN NOT f1 THEN v END AS g FROM r1),
      r3 AS (SELECT a.*, b.g AS sv FROM r2 a LEFT JOIN r2 b ON b.antenna = a.antenna AND b.hand = a.source_hand AND b.t = a.t),
      r4 AS (SELECT *, count(*) FILTER (g > 0 AND sv > 0) OVER w AS nb, median(g) FILTER (g > 0 AND sv > 0) OVER w / median(sv) FILTER (g > 0 AND sv > 0) OVER w AS ratio FROM r3 WINDOW w AS (PARTITION BY antenna, hand)),
      r5 AS (SELECT *, nb >= 3 AND sv IS NOT NULL AS took, CASE WHEN nb >= 3 AND sv IS NOT NULL THEN sv * ratio ELSE g END * scale AS y, CASE WHEN comb THEN -1 ELSE field END AS grp FROM r4),
      p0 AS (SELECT *, y AS x0, count(*) OVER w < 3 OR count(y) OVER w < 3 AS few FROM r5 WINDOW w AS (PARTITION BY antenna, hand, grp))"""
    + "".join(_pass(i) for i in range(3))
    + f""", q0 AS (SELECT *, CASE WHEN few THEN y ELSE x3 END AS c0, 2 * t / CASE WHEN win > 0 THEN win ELSE 1.0 END AS ts, 2 * t / {DEFAULT} AS tt FROM p3),
      q1 AS (SELECT *, CASE WHEN few OR win <= 0 OR c0 IS NULL THEN c0 WHEN count(c0) OVER w >= 3 THEN median(c0) OVER w ELSE c0 END AS c1 FROM q0 WINDOW w AS (PARTITION BY antenna, hand, grp ORDER BY ts RANGE BETWEEN 1 PRECEDING AND 1 FOLLOWING)),
      q2 AS (SELECT *, median(c1) OVER (PARTITION BY antenna, hand) AS level, CASE WHEN c1 IS NOT NULL THEN CASE WHEN count(c1) OVER w >= 3 THEN median(c1) OVER w ELSE c1 END END AS slow FROM q1 WINDOW w AS (PARTITION BY antenna, hand ORDER BY tt RANGE BETWEEN 1 PRECEDING AND 1 FOLLOWING))
      SELECT id, round(coalesce(CASE WHEN ex <> 1 AND level > 0 AND c1 > 0 AND slow > 0 THEN c1 * greatest(1 / {MOST_FACTOR}, least({MOST_FACTOR}, pow(slow / level, ex - 1))) ELSE c1 END, v * scale), 5) AS value, f1 AND NOT took AS flag FROM q2""",
    "smooth_widened": f"""WITH {SERIES}, e AS (SELECT user_id, event_id, t, CASE WHEN event_id % 5 <> 0 THEN value END AS v FROM ev WHERE user_id % 3 = 0 OR event_id % 4 = 0), g AS (SELECT *, t - lag(t) OVER (PARTITION BY user_id ORDER BY t) AS gap FROM e),
      w AS (SELECT *, greatest(20000.0, 5 * coalesce(median(gap) OVER (PARTITION BY user_id), 0)) AS width FROM g), s AS (SELECT *, 2 * t / width AS ts FROM w)
      SELECT event_id, round(width, 3) AS width, round(CASE WHEN v IS NOT NULL THEN CASE WHEN count(v) OVER q >= 4 THEN median(v) OVER q ELSE v END END, 6) AS smoothed FROM s WINDOW q AS (PARTITION BY user_id ORDER BY ts RANGE BETWEEN 1 PRECEDING AND 1 FOLLOWING)""",
    # By lists and a join over ranges, which the method does without.
    "mean_of_enough": f"""WITH {SERIES}, e AS (SELECT user_id, event_id, t, CASE WHEN event_id % 5 <> 0 THEN value END AS v FROM ev), g AS (SELECT * FROM e WHERE v IS NOT NULL),
      d AS (SELECT a.event_id, a.user_id, a.t, list_sort(list(abs(b.t - a.t)))[4] AS fourth FROM g a JOIN g b ON b.user_id = a.user_id GROUP BY ALL), r AS (SELECT *, CASE WHEN fourth IS NOT NULL THEN greatest(10000.0, fourth) END AS reach FROM d),
      m AS (SELECT r.event_id, r.reach, count(*) AS n_used, avg(g.v) AS mean FROM r JOIN g ON g.user_id = r.user_id AND g.t BETWEEN r.t - r.reach AND r.t + r.reach GROUP BY ALL)
      SELECT e.event_id, round(r.reach, 3) AS reach, n_used, round(mean, 6) AS mean FROM e LEFT JOIN r USING (event_id) LEFT JOIN m USING (event_id)""",
}
