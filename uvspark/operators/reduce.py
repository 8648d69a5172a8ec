"""Binned reductions: averages are sums of valid samples over counts, an empty cell has none."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..plans.model import SERIES, VIS, series, table, visibilities
from .ranks import global_rank

LIGHT = 299792458.0


def time_bin(t: Column, origin: Column, width: float) -> Column:
    return F.floor((t - origin) / max(width, 1e-6)).cast("int")


def scan_numbers(rows: DataFrame, field: str, time_us: str, unique: str, gap_s: float) -> DataFrame:
    """Add scan_number: a field's gap of more than gap_s starts a new scan; scans count from 1 in order of their starts."""
    w = Window.partitionBy(field).orderBy(time_us, unique)
    before = F.lag(time_us).over(w)
    new = (before.isNull() | (F.col(time_us) - before > gap_s * 1e6)).cast("int")
    marked = rows.withColumn("_new", new).withColumn("_nth", F.sum("_new").over(w))
    starts = global_rank(marked.filter("_new = 1").select(field, "_nth", time_us, unique), [F.col(time_us), F.col(unique)], "_rank")
    starts = starts.select(F.col(field).alias("_field"), F.col("_nth").alias("_n"), (F.col("_rank") + 1).alias("scan_number"))
    return marked.join(starts, F.col(field).eqNullSafe(F.col("_field")) & (F.col("_nth") == F.col("_n"))).drop("_new", "_nth", "_field", "_n")


def dynamic_spectra(rows: DataFrame, keys: list[str], channel: str, time: str, value: str, lo: float, hi: float, bins: int) -> DataFrame:
    """Mean per key, channel and bin of a track-wide time grid; times outside go to the end bins."""
    at = F.greatest(F.lit(0), F.least(F.lit(bins - 1), F.floor((F.col(time) - lo) / ((hi - lo) / bins)).cast("int")))
    return rows.groupBy(*keys, channel, at.alias("bin")).agg(F.round(F.sum(value) / F.count(value), 6).alias("mean"), F.count(value).alias("n"))


def uvdistance(vis: DataFrame, width_days: int, frequency: Column) -> DataFrame:
    """Per scan, baseline, subband and time bin from the scan's start: mean amplitude and uv distance in megawavelengths."""
    starts = vis.groupBy("scan").agg(F.min("day").alias("_start"))
    binned = vis.join(F.broadcast(starts), "scan").withColumn("bin", F.floor((F.col("day") - F.col("_start")) / width_days).cast("int"))
    mean = binned.groupBy("scan", "antenna1", "antenna2", "ddid", "bin").agg(F.avg("u").alias("u"), F.avg("v").alias("v"), F.avg(F.when(~F.col("flag"), F.col("amp"))).alias("amp"))
    return mean.select("scan", "antenna1", "antenna2", "ddid", "bin", F.round(F.hypot("u", "v") * frequency / LIGHT / 1e6, 9).alias("uvdist"), F.round("amp", 6).alias("amp"))


def total_visibility(rows: DataFrame, keys: list[str]) -> DataFrame:
    """Coherent sums of re and im and their count, per keys."""
    return rows.groupBy(*keys).agg(F.sum("re").alias("sum_re"), F.sum("im").alias("sum_im"), F.count("re").alias("n"))


def rebin_lightcurve(sums: DataFrame, keys: list[str], time: str, width: float) -> DataFrame:
    """From sums to coarser bins: amplitude |sum| / n and the count-weighted time, never an average of averages."""
    grouped = sums.groupBy(*keys, F.floor(F.col(time) / width).cast("int").alias("bin"))
    return grouped.agg(
        F.round(F.hypot(F.sum("sum_re"), F.sum("sum_im")) / F.sum("n"), 6).alias("amplitude"),
        F.round(F.sum(F.col(time) * F.col("n")) / F.sum("n"), 3).alias("time"),
        F.sum("n").alias("n"),
    )


def spectrum(rows: DataFrame, key: str, values: str) -> DataFrame:
    """Mean and count per key and channel of an array column."""
    cells = rows.select(key, F.posexplode(values).alias("channel", "x"))
    return cells.groupBy(key, "channel").agg(F.round(F.avg(F.col("x").cast("double")), 6).alias("mean"), F.count("x").alias("n"))


def row_amplitude(values: Column) -> Column:
    """Mean absolute value of an array, null if it has none."""
    total = F.aggregate(values, F.lit(0.0), lambda a, x: a + F.abs(x.cast("double")))
    return total / F.nullif(F.size(values), F.lit(0))


def with_differences(rows: DataFrame, keys: list[str], order: list[str], value: str) -> DataFrame:
    """First and second differences of consecutive rows in a cell."""
    w = Window.partitionBy(*keys).orderBy(*order)
    one, two = F.lag(value, 1).over(w), F.lag(value, 2).over(w)
    return rows.withColumns({"d1": F.col(value) - one, "d2": F.col(value) - 2 * one + two})


def statistics_cube(rows: DataFrame, keys: list[str], order: list[str], value: str) -> DataFrame:
    """Moments of every cell: count, sum, power and the sums of squared first and second differences."""
    x = F.col(value)
    return with_differences(rows, keys, order, value).groupBy(*keys).agg(
        F.count(value).alias("n"), F.round(F.sum(x), 4).alias("total"), F.round(F.sum(x * x), 4).alias("power"),
        F.count("d1").alias("n1"), F.round(F.sum(F.col("d1") ** 2), 4).alias("s1"), F.count("d2").alias("n2"), F.round(F.sum(F.col("d2") ** 2), 4).alias("s2"),
    )


def difference_noise(cube: DataFrame, by: str) -> DataFrame:
    """Noise variance from first (over 2n) and second differences (over 6n)."""
    g = cube.groupBy(by).agg(*(F.sum(c).alias(c) for c in ("s1", "n1", "s2", "n2")))
    return g.select(by, F.round(F.col("s1") / F.nullif(2 * F.col("n1"), F.lit(0)), 4).alias("noise_first"), F.round(F.col("s2") / F.nullif(6 * F.col("n2"), F.lit(0)), 4).alias("noise_second"))


def variance_weight(n: Column, variance: Column, minsamp: int) -> tuple[Column, Column]:
    """Weight 1 / variance and a flag: too few samples or no variance give weight 0, flagged."""
    starved = (n < minsamp) | ~(F.coalesce(variance, F.lit(0.0)) > 0)
    return F.when(starved, 0.0).otherwise(1 / variance), starved


def split_average(vis: DataFrame, keys: list[str]) -> DataFrame:
    """Weighted mean of unflagged samples; where all are flagged, of all, and the result is flagged."""
    ok = ~F.col("flag")
    w, x = F.col("weight"), F.col("amp")
    good, all_ = F.sum(F.when(ok, w)), F.sum(w)
    mean = F.coalesce(F.sum(F.when(ok, w * x)) / F.nullif(good, F.lit(0.0)), F.sum(w * x) / F.nullif(all_, F.lit(0.0)))
    sigma = F.when(good > 0, 1 / F.sqrt(good)).otherwise(-1.0)
    return vis.groupBy(*keys).agg(F.round(mean, 2).alias("amp"), F.round(F.coalesce(good, F.lit(0.0)), 4).alias("weight"), F.round(F.coalesce(sigma, F.lit(-1.0)), 6).alias("sigma"), (F.max(ok.cast("int")) == 0).alias("flag"))


def split_channels(rows: DataFrame, keys: list[str], scan: list[str], nchan: int, seconds: float, width: int) -> DataFrame:
    """Average rows (time, interval, exposure, centroid, weight, arrays re, im and flag) in time bins from each scan's first time and in blocks of `width` channels (the last may be narrower).

    A cell is the weighted mean of its unflagged samples; without any, of all, and flagged. weight_spectrum sums
    the weights used; sigma_spectrum is 1 / sqrt of it, -1 without weight. weight and sigma are means over the
    unflagged cells (all, without any). Rows with an unflagged sample give the exposure and, by weight, the
    centroid; time and interval are of the rows up to the last such row. One shuffle; scans' first times are joined.
    """
    starts = range(0, nchan, width)
    first = rows.groupBy(*scan).agg(F.min("time").alias("_first"))
    r = rows.join(first, scan).withColumn("bin", F.floor((F.col("time") - F.col("_first") + 1e-6) / seconds).cast("long"))
    ok = lambda c: ~F.get("flag", F.lit(c))
    w = F.col("weight")
    total = lambda value, lo, some: F.coalesce(F.sum(sum(F.when(ok(c), value(c)).otherwise(0.0) if some else value(c) for c in range(lo, min(lo + width, nchan)))), F.lit(0.0))
    cell = lambda lo: F.struct(*[
        total(v, lo, some).alias(f"{n}_{'ok' if some else 'all'}") for some in (True, False) for n, v in (("re", lambda c: w * F.get("re", F.lit(c))), ("im", lambda c: w * F.get("im", F.lit(c))), ("w", lambda c: w))
    ], total(lambda c: F.lit(1.0), lo, True).alias("n"))
    some = F.exists("flag", lambda f: ~f)
    weighed = F.when(some, w).otherwise(0.0)
    mean = lambda c: F.coalesce(F.sum(weighed * F.col(c)) / F.nullif(F.sum(weighed), F.lit(0.0)), F.avg(c))
    g = r.groupBy(*keys, "bin").agg(
        F.array(*[cell(lo) for lo in starts]).alias("_cells"), F.collect_list(F.struct("time", "interval", some.alias("ok"))).alias("_rows"),
        F.coalesce(F.sum(F.when(some, F.col("exposure"))), F.sum("exposure")).alias("exposure"), mean("centroid").alias("centroid"),
    )
    last = F.array_max(F.transform(F.filter("_rows", lambda x: x["ok"]), lambda x: x["time"]))
    g = g.withColumn("_last", last).withColumn("_upto", F.filter("_rows", lambda x: F.col("_last").isNull() | (x["time"] <= F.col("_last"))))
    add = lambda c, name: F.aggregate(c, F.lit(0.0), lambda a, x: a + x[name])

    def averaged(c):
        empty = c["n"] == 0
        pick = lambda n: F.when(empty, c[f"{n}_all"]).otherwise(c[f"{n}_ok"])
        by = F.when(pick("w") > 0, pick("w")).otherwise(1.0)
        sigma = F.when(pick("w") > 0, 1 / F.sqrt(pick("w"))).otherwise(-1.0)
        return F.struct((pick("re") / by).alias("re"), (pick("im") / by).alias("im"), empty.alias("flag"), pick("w").alias("weight_spectrum"), sigma.alias("sigma_spectrum"))

    g = g.withColumn("cells", F.transform("_cells", averaged))
    good = F.filter("cells", lambda c: ~c["flag"])
    used = F.when(F.size(good) > 0, good).otherwise(F.col("cells"))
    return g.withColumn("_used", used).select(
        *keys, "bin", (add(F.col("_upto"), "time") / F.size("_upto")).alias("time"), add(F.col("_upto"), "interval").alias("interval"), "exposure", "centroid",
        (add(F.col("_used"), "weight_spectrum") / F.size("_used")).alias("weight"), (add(F.col("_used"), "sigma_spectrum") / F.size("_used")).alias("sigma"), "cells",
    )


def fringe_rows(s, d):
    e = series(s, d)
    return e.withColumns({"re": F.col("value"), "im": F.regexp_extract("props", "([0-9]+)", 1).cast("double"), "hour": F.floor(F.col("us") / 3600000000).cast("long")})


def _noise(s, d):
    return difference_noise(statistics_cube(series(s, d), ["user_id", "event_type", "day"], ["us", "event_id"], "value"), "event_type")


def _statwt_rows(s, d):
    cells = table(s, d, "embeddings").select("vec_id", F.explode("embedding").alias("x"))
    g = cells.groupBy("vec_id").agg(F.count("x").alias("n"), F.var_pop(F.col("x").cast("double")).alias("v"))
    weight, starved = variance_weight(F.col("n"), F.col("v"), 8)
    return g.select("vec_id", F.round(weight, 4).alias("weight"), starved.alias("flag"))


def _statwt_series(s, d):
    g = series(s, d).groupBy("user_id", "event_type").agg(F.count("value").alias("n"), F.var_pop("value").alias("v"))
    weight, starved = variance_weight(F.col("n"), F.col("v"), 8)
    return g.select("user_id", "event_type", F.round(weight, 8).alias("weight"), starved.alias("flag"))


def _split_channels(s, d):
    v = F.col("vec_id").cast("double")
    re = F.transform("embedding", lambda x: x.cast("double"))
    rows = table(s, d, "embeddings").select(
        "label", (v * 2).alias("time"), F.lit(2.0).alias("interval"), (1.5 + F.col("vec_id") % 2 / 4).alias("exposure"), (v * 2 + 0.25).alias("centroid"), (F.col("vec_id") % 4).cast("double").alias("weight"),
        re.alias("re"), F.reverse(re).alias("im"), F.transform("embedding", lambda x, c: ((F.col("vec_id") + F.floor(c / 12)) % 3 == 0) | (F.col("vec_id") % 7 < 3)).alias("flag"),
    )
    out = split_channels(rows.withColumn("scan", F.lit(1)), ["scan", "label"], ["scan"], 64, 32.0, 12)
    cells = out.select("*", F.posexplode("cells").alias("block", "c")).select("label", "bin", "block", "time", "interval", "exposure", "centroid", "weight", "sigma", "c.*")
    return cells.select(*[F.round(c, 6).alias(c) if t == "double" else F.col(c) for c, t in cells.dtypes])


CUBE = f"""{SERIES}, df AS (SELECT *, value - lag(value, 1) OVER w AS d1, value - 2 * lag(value, 1) OVER w + lag(value, 2) OVER w AS d2
  FROM ev WINDOW w AS (PARTITION BY user_id, event_type, day ORDER BY us, event_id)),
  cube AS (SELECT user_id, event_type, day, count(value) AS n, round(sum(value), 4) AS total, round(sum(value * value), 4) AS power,
  count(d1) AS n1, round(sum(d1 * d1), 4) AS s1, count(d2) AS n2, round(sum(d2 * d2), 4) AS s2 FROM df GROUP BY ALL)"""
TOTAL = f"{SERIES}, fr AS (SELECT *, value AS re, CAST(regexp_extract(props, '([0-9]+)', 1) AS DOUBLE) AS im, CAST(us // 3600000000 AS BIGINT) AS hour FROM ev), tot AS (SELECT event_type, hour, sum(re) AS sum_re, sum(im) AS sum_im, count(re) AS n FROM fr GROUP BY ALL)"

QUERIES = {
    "scan_numbers": lambda s, d: scan_numbers(series(s, d).select("event_id", "user_id", "us"), "user_id", "us", "event_id", 6 * 3600).select("event_id", "user_id", "scan_number"),
    "dynamic_spectra": lambda s, d: dynamic_spectra(series(s, d).withColumn("baseline", F.col("user_id") % 8), ["baseline"], "event_type", "t", "value", 86400.0, 29 * 86400.0, 56),
    "uvdistance_bins": lambda s, d: uvdistance(visibilities(s, d), 7, F.lit(1.0e9) + F.col("ddid") * 1.0e8),
    "total_visibility": lambda s, d: total_visibility(fringe_rows(s, d), ["event_type", "hour"]).withColumns({"sum_re": F.round("sum_re", 4), "sum_im": F.round("sum_im", 4)}),
    "lightcurve_rebin": lambda s, d: rebin_lightcurve(total_visibility(fringe_rows(s, d), ["event_type", "hour"]), ["event_type"], "hour", 24.0),
    "spectrum_by_subband": lambda s, d: spectrum(table(s, d, "embeddings"), "label", "embedding"),
    "row_amplitude": lambda s, d: table(s, d, "embeddings").select("vec_id", F.round(row_amplitude(F.col("embedding")), 6).alias("amplitude")),
    "stat_cube": lambda s, d: statistics_cube(series(s, d), ["user_id", "event_type", "day"], ["us", "event_id"], "value"),
    "noise_from_differences": _noise,
    "statwt_weights": _statwt_rows,
    "statwt_series": _statwt_series,
    "split_average": lambda s, d: split_average(visibilities(s, d), ["scan", "antenna1", "antenna2"]),
    "split_channels": _split_channels,
}
SQL = {
    "split_channels": """WITH r AS (SELECT label, vec_id, vec_id * 2.0 AS time, 1.5 + vec_id % 2 / 4.0 AS exposure, CAST(vec_id % 4 AS DOUBLE) AS w, embedding AS e, CAST(floor((vec_id * 2.0 - min(vec_id * 2.0) OVER () + 1e-6) / 32.0) AS BIGINT) AS bin FROM embeddings),
      s AS (SELECT * EXCLUDE e, unnest(e) AS re, unnest(list_reverse(e)) AS im, generate_subscripts(e, 1) - 1 AS c FROM r),
      f AS (SELECT *, CAST(c // 12 AS INT) AS block, (vec_id + c // 12) % 3 = 0 OR vec_id % 7 < 3 AS flag FROM s),
      k AS (SELECT label, bin, block, bool_and(flag) AS flag, sum(w) AS wa, sum(w * re::DOUBLE) AS ra, sum(w * im::DOUBLE) AS ia, coalesce(sum(w) FILTER (NOT flag), 0.0) AS wo, coalesce(sum(w * re::DOUBLE) FILTER (NOT flag), 0.0) AS ro, coalesce(sum(w * im::DOUBLE) FILTER (NOT flag), 0.0) AS io FROM f GROUP BY ALL),
      p AS (SELECT label, bin, block, flag, CASE WHEN flag THEN wa ELSE wo END AS ws, CASE WHEN flag THEN ra ELSE ro END AS re, CASE WHEN flag THEN ia ELSE io END AS im FROM k),
      c AS (SELECT *, CASE WHEN ws > 0 THEN 1 / sqrt(ws) ELSE -1.0 END AS ss FROM p),
      h AS (SELECT label, bin, coalesce(avg(ws) FILTER (NOT flag), avg(ws)) AS weight, coalesce(avg(ss) FILTER (NOT flag), avg(ss)) AS sigma FROM c GROUP BY ALL),
      o AS (SELECT label, bin, vec_id, time, exposure, w, NOT bool_and(flag) AS ok FROM f GROUP BY ALL),
      l AS (SELECT *, max(CASE WHEN ok THEN time END) OVER (PARTITION BY label, bin) AS last FROM o),
      t AS (SELECT label, bin, avg(time) FILTER (last IS NULL OR time <= last) AS time, 2.0 * count(*) FILTER (last IS NULL OR time <= last) AS "interval", coalesce(sum(exposure) FILTER (ok), sum(exposure)) AS exposure,
        coalesce(sum(w * (time + 0.25)) FILTER (ok) / nullif(sum(w) FILTER (ok), 0), avg(time + 0.25)) AS centroid FROM l GROUP BY ALL)
      SELECT label, bin, block, round(time, 6) AS time, round("interval", 6)::DOUBLE AS "interval", round(exposure, 6)::DOUBLE AS exposure, round(centroid, 6)::DOUBLE AS centroid, round(weight, 6) AS weight, round(sigma, 6) AS sigma,
        round(re / CASE WHEN ws > 0 THEN ws ELSE 1 END, 6) AS re, round(im / CASE WHEN ws > 0 THEN ws ELSE 1 END, 6) AS im, flag, round(ws, 6) AS weight_spectrum, round(ss, 6) AS sigma_spectrum FROM c JOIN h USING (label, bin) JOIN t USING (label, bin)""",
    "scan_numbers": f"""WITH {SERIES}, b AS (SELECT event_id, user_id, us, CASE WHEN us - lag(us) OVER w <= 21600000000 THEN 0 ELSE 1 END AS new FROM ev WINDOW w AS (PARTITION BY user_id ORDER BY us, event_id)),
      n AS (SELECT *, sum(new) OVER (PARTITION BY user_id ORDER BY us, event_id) AS nth FROM b),
      k AS (SELECT user_id, nth, row_number() OVER (ORDER BY us, event_id) AS scan_number FROM n WHERE new = 1)
      SELECT event_id, user_id, scan_number FROM n JOIN k USING (user_id, nth)""",
    "dynamic_spectra": f"""WITH {SERIES} SELECT user_id % 8 AS baseline, event_type, greatest(0, least(55, CAST(floor((t - 86400.0) / ((29 * 86400.0 - 86400.0) / 56)) AS INT))) AS bin,
      round(sum(value) / count(value), 6) AS mean, count(value) AS n FROM ev GROUP BY ALL""",
    "uvdistance_bins": f"""WITH {VIS}, st AS (SELECT scan, min(day) AS start FROM vis GROUP BY scan),
      m AS (SELECT scan, antenna1, antenna2, ddid, CAST(floor((day - start) / 7.0) AS INT) AS bin, avg(u) AS u, avg(v) AS v, avg(CASE WHEN NOT flag THEN amp END) AS amp FROM vis JOIN st USING (scan) GROUP BY ALL)
      SELECT scan, antenna1, antenna2, ddid, bin, round(sqrt(u * u + v * v) * (1.0e9 + ddid * 1.0e8) / {LIGHT} / 1e6, 9) AS uvdist, round(amp, 6) AS amp FROM m""",
    "total_visibility": f"WITH {TOTAL} SELECT event_type, hour, round(sum_re, 4) AS sum_re, round(sum_im, 4) AS sum_im, n FROM tot",
    "lightcurve_rebin": f"WITH {TOTAL} SELECT event_type, CAST(floor(hour / 24.0) AS INT) AS bin, round(sqrt(sum(sum_re) ** 2 + sum(sum_im) ** 2) / sum(n), 6) AS amplitude, round(CAST(sum(hour * n) AS DOUBLE) / sum(n), 3) AS time, CAST(sum(n) AS BIGINT) AS n FROM tot GROUP BY ALL",
    "spectrum_by_subband": "SELECT label, channel, round(avg(CAST(x AS DOUBLE)), 6) AS mean, count(x) AS n FROM (SELECT label, unnest(embedding) AS x, CAST(generate_subscripts(embedding, 1) - 1 AS INT) AS channel FROM embeddings) GROUP BY ALL",
    "row_amplitude": "SELECT vec_id, round(list_sum(list_transform(embedding, lambda x: abs(CAST(x AS DOUBLE)))) / nullif(len(embedding), 0), 6) AS amplitude FROM embeddings",
    "stat_cube": f"WITH {CUBE} SELECT * FROM cube",
    "noise_from_differences": f"WITH {CUBE} SELECT event_type, round(sum(s1) / nullif(2 * sum(n1), 0), 4) AS noise_first, round(sum(s2) / nullif(6 * sum(n2), 0), 4) AS noise_second FROM cube GROUP BY event_type",
    "statwt_weights": "WITH g AS (SELECT vec_id, count(x) AS n, var_pop(CAST(x AS DOUBLE)) AS v FROM (SELECT vec_id, unnest(embedding) AS x FROM embeddings) GROUP BY vec_id) SELECT vec_id, CASE WHEN n < 8 OR NOT v > 0 THEN 0.0 ELSE round(1 / v, 4) END AS weight, n < 8 OR NOT v > 0 AS flag FROM g",
    "statwt_series": f"WITH {SERIES}, g AS (SELECT user_id, event_type, count(value) AS n, var_pop(value) AS v FROM ev GROUP BY ALL) SELECT user_id, event_type, CASE WHEN n < 8 OR NOT v > 0 THEN 0.0 ELSE round(1 / v, 8) END AS weight, n < 8 OR NOT v > 0 AS flag FROM g",
    "split_average": f"""WITH {VIS} SELECT scan, antenna1, antenna2,
      round(coalesce(sum(CASE WHEN NOT flag THEN weight * amp END) / nullif(sum(CASE WHEN NOT flag THEN weight END), 0), sum(weight * amp) / nullif(sum(weight), 0)), 2) AS amp,
      round(coalesce(sum(CASE WHEN NOT flag THEN weight END), 0.0), 4) AS weight, round(CASE WHEN sum(CASE WHEN NOT flag THEN weight END) > 0 THEN 1 / sqrt(sum(CASE WHEN NOT flag THEN weight END)) ELSE -1.0 END, 6) AS sigma,
      bool_and(flag) AS flag FROM vis GROUP BY ALL""",
}
