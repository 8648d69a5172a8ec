"""How measurements evolve: timelines, debiased amplitudes, series shapes, leave-one-out residuals and their tests, image noise, changed flags."""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..plans.model import SERIES, VIS, series, table, visibilities

# Chance of an outlier bin, least deviation, share of thermal noise under which a model is weak; scatter and subband limits.
OUTLIER_P, LEAST_DEVIATION, WEAK = 1e-7, 0.10, 5.0
SCAN_SIGMA, SCAN_FACTOR, SCAN_LEAST = 6.0, 2.0, 4
SUBBAND_SIGMA, SUBBAND_SHARE, SUBBAND_LEAST = 6.0, 0.15, 3


def median_of(values: Column) -> Column:
    """Median of an array without nulls; null if empty."""
    s = F.sort_array(values)
    n = F.size(values)
    return (F.get(s, F.floor((n - 1) / 2).cast("int")) + F.get(s, F.floor(n / 2).cast("int"))) / 2


def baseline_timeline(vis: DataFrame, time: str) -> DataFrame:
    """Per (baseline, time): sum over subbands of the unflagged vector averages, and how many subbands there are."""
    cross = vis.filter("antenna1 <> antenna2 AND NOT flag")
    band = cross.groupBy("antenna1", "antenna2", time, "ddid").agg(F.avg("re").alias("_re"), F.avg("im").alias("_im"))
    return band.groupBy("antenna1", "antenna2", time).agg(F.sum("_re").alias("sum_re"), F.sum("_im").alias("sum_im"), F.count("*").alias("n_subbands"))


def row_evolution(values: Column, flags: Column) -> Column:
    """Mean of the recorded and unflagged cells of a row; null without any."""
    good = F.filter(F.zip_with(values, flags, lambda x, f: F.when(~f, x)), lambda x: x.isNotNull())
    return F.aggregate(good, F.lit(0.0), lambda a, x: a + x) / F.nullif(F.size(good), F.lit(0))


def debiased_amplitude(power: Column, noise: Column) -> Column:
    """Root of the power less the noise's share, not below zero. Coherent: |mean|^2 and the noise of the mean; else mean power and the noise of a sample."""
    return F.sqrt(F.greatest(power - noise, F.lit(0.0)))


def binned_median(rows: DataFrame, keys: list[str], x: str, y: str, bins: int) -> DataFrame:
    """Medians of x and y in equal-width bins over each key's range of x; the last bin holds its upper end. Empty bins are left out."""
    ends = rows.groupBy(*keys).agg(F.min(x).alias("_lo"), F.max(x).alias("_hi"))
    at = F.floor((F.col(x) - F.col("_lo")) / F.nullif((F.col("_hi") - F.col("_lo")) / bins, F.lit(0.0)))
    b = F.least(F.lit(bins - 1), F.coalesce(at, F.lit(bins - 1))).cast("int")
    return rows.join(ends, keys).groupBy(*keys, b.alias("bin")).agg(F.round(F.median(x), 6).alias("x"), F.round(F.median(y), 6).alias("y"), F.count("*").alias("n"))


def series_shape(rows: DataFrame, keys: list[str], order: list[str], value: str) -> DataFrame:
    """Shape of each series: n, scan_scatter, trend, max_drop, max_rise and range; all null under three points.

    Scatter (seven points at least): 1.25 robust sigmas about the running median of five, whose ends repeat the
    end points. Trend: median of the last 15 % less that of the first. Drop, rise and range: of the running
    median about its median.
    """
    w = Window.partitionBy(*keys).orderBy(*order)
    whole = Window.partitionBy(*keys)
    ends = w.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    x, n = F.col(value), F.count("*").over(whole)
    first, last = F.first(value).over(ends), F.last(value).over(ends)
    at = lambda k: F.coalesce(F.lag(value, k).over(w), first) if k > 0 else F.coalesce(F.lead(value, -k).over(w), last)
    around = F.when(n >= 5, F.array(at(2), at(1), x, at(-1), at(-2))).when(n == 4, F.array(at(2), at(1), x, at(-1))).otherwise(F.array(at(1), x, at(-1)))
    k = F.greatest(F.lit(1), F.bround(0.15 * n).cast("int"))
    rn = F.row_number().over(w)
    p = rows.select(*keys, x.alias("_x"), around.alias("_w"), F.when(rn <= k, x).alias("_a"), F.when(rn > n - k, x).alias("_b"))
    p = p.withColumn("_s", F.get(F.sort_array("_w"), F.floor(F.size("_w") / 2).cast("int"))).withColumn("_r", F.col("_x") - F.col("_s"))
    mid = p.groupBy(*keys).agg(F.median("_r").alias("_m"))
    g = p.join(mid, keys).groupBy(*keys).agg(
        F.count("*").alias("n"), (1.4826 * 1.25 * F.median(F.abs(F.col("_r") - F.col("_m")))).alias("_sc"), (F.median("_b") - F.median("_a")).alias("_t"),
        F.median("_s").alias("_l"), F.min("_s").alias("_lo"), F.max("_s").alias("_hi"),
    )
    some = lambda c, least=3: F.when(F.col("n") >= least, F.round(c, 6))
    return g.select(
        *keys, "n", some(F.col("_sc"), 7).alias("scan_scatter"), some(F.col("_t")).alias("trend"), some(F.col("_lo") - F.col("_l")).alias("max_drop"),
        some(F.col("_hi") - F.col("_l")).alias("max_rise"), some(F.col("_hi") - F.col("_lo")).alias("range"),
    )


def residuals(rows: DataFrame, keys: list[str], order: list[str], re: str, im: str, thermal: Column, jitter: Column, half: int = 3) -> DataFrame:
    """Add model_re, model_im, used, z2 and deviation: against the running median of the `half` neighbours on either side, the point itself left out.

    Needs two neighbours. Expected scatter squared: thermal^2 (1 + pi / (2 used)) + (jitter |model|)^2.
    """
    w = Window.partitionBy(*keys).orderBy(*order)
    others = lambda c: F.concat(F.collect_list(c).over(w.rowsBetween(-half, -1)), F.collect_list(c).over(w.rowsBetween(1, half)))
    r = rows.withColumns({"_ore": others(re), "_oim": others(im)}).withColumn("used", F.size("_ore"))
    enough = F.col("used") >= 2
    r = r.withColumns({"model_re": F.when(enough, median_of(F.col("_ore"))), "model_im": F.when(enough, median_of(F.col("_oim")))}).drop("_ore", "_oim")
    off = (F.col(re) - F.col("model_re")) ** 2 + (F.col(im) - F.col("model_im")) ** 2
    m2 = F.col("model_re") ** 2 + F.col("model_im") ** 2
    return r.withColumns({"z2": off / (thermal**2 * (1 + math.pi / (2 * F.col("used"))) + jitter**2 * m2), "deviation": F.sqrt(off / F.nullif(m2, F.lit(0.0))), "weak": F.sqrt(m2) < WEAK * thermal})


def outlier_bin() -> Column:
    """Of rows with residuals: beyond the noise, and by more than a share of a model that isn't weak."""
    return F.coalesce((F.col("z2") > -math.log(OUTLIER_P)) & ((F.col("deviation") > LEAST_DEVIATION) | F.col("weak")), F.lit(False))


def excess_scatter(rows: DataFrame, keys: list[str]) -> DataFrame:
    """Per key of rows with residuals (SCAN_LEAST at least): mean z2, and whether it is beyond its own spread and SCAN_FACTOR."""
    g = rows.filter("z2 IS NOT NULL").groupBy(*keys).agg(F.avg("z2").alias("_c"), F.count("*").alias("n")).filter(F.col("n") >= SCAN_LEAST)
    bad = (F.col("_c") > 1 + SCAN_SIGMA / F.sqrt("n")) & (F.col("_c") > SCAN_FACTOR)
    return g.select(*keys, F.round("_c", 6).alias("chi2r"), "n", bad.alias("bad"))


def subband_departures(rows: DataFrame, keys: list[str], subband: str, amp: str, sigma: Column) -> DataFrame:
    """Subbands off the median of at least SUBBAND_LEAST of their key: by SUBBAND_SIGMA errors and SUBBAND_SHARE of it."""
    wt = 1 / (sigma * sigma)
    m = rows.groupBy(*keys, subband).agg((F.sum(F.col(amp) * wt) / F.sum(wt)).alias("_m"), (1 / F.sqrt(F.sum(wt))).alias("_e"))
    level = m.groupBy(*keys).agg(F.median("_m").alias("_l"), F.count("*").alias("_k")).filter((F.col("_k") >= SUBBAND_LEAST) & (F.col("_l") > 0))
    out = m.join(level, keys).select(*keys, subband, F.round(F.col("_m") / F.col("_l"), 6).alias("ratio"), F.round((F.col("_m") - F.col("_l")) / F.col("_e"), 4).alias("nsigma"))
    return out.filter((F.abs("nsigma") > SUBBAND_SIGMA) & (F.abs(F.col("ratio") - 1) > SUBBAND_SHARE))


def image_statistics(rows: DataFrame, keys: list[str], pixels: str) -> DataFrame:
    """Per image, from its rows of pixels: the peak and the robust noise (1.4826 median absolute deviations)."""
    cells = rows.select(*keys, F.explode(pixels).alias("_p")).withColumn("_p", F.col("_p").cast("double"))
    mid = cells.groupBy(*keys).agg(F.median("_p").alias("_m"), F.max("_p").alias("_max"))
    return cells.join(mid, keys).groupBy(*keys).agg(F.round(F.max("_max"), 6).alias("peak"), F.round(1.4826 * F.median(F.abs(F.col("_p") - F.col("_m"))), 6).alias("noise"), F.count("*").alias("n"))


def flag_changes(rows: DataFrame, keys: list[str], order: list[str], time: str, before: Column, after: Column) -> DataFrame:
    """Fewest commands that turn one flag state into another: a run of consecutive rows of a key that are newly flagged, or newly free, is one."""
    w = Window.partitionBy(*keys).orderBy(*order)
    kind = F.when(after & ~before, "flag").when(before & ~after, "unflag").otherwise("")
    r = rows.withColumn("action", kind)
    r = r.withColumn("_run", F.sum(F.coalesce((F.col("action") != F.lag("action").over(w)).cast("int"), F.lit(1))).over(w)).filter("action <> ''")
    return r.groupBy(*keys, "action", "_run").agg(F.min(time).alias("start"), F.max(time).alias("end"), F.count("*").alias("n")).drop("_run")


def _phased(s, d):
    return visibilities(s, d).withColumns({"re": F.col("amp") * F.cos(F.col("v") / 10), "im": F.col("amp") * F.sin(F.col("v") / 10)})


def _timeline(s, d):
    return baseline_timeline(_phased(s, d), "day").select("antenna1", "antenna2", "day", F.round("sum_re", 4).alias("sum_re"), F.round("sum_im", 4).alias("sum_im"), "n_subbands")


def _evolution(s, d):
    e = table(s, d, "embeddings")
    values = F.transform("embedding", lambda x: x.cast("double"))
    return e.select("vec_id", F.round(row_evolution(F.slice(values, 17, 32), F.transform(F.slice(values, 17, 32), lambda x: x > 0.1)), 6).alias("mean"))


def _debiased(s, d):
    w = Window.partitionBy("user_id", "day").orderBy("us", "event_id")
    e = series(s, d).withColumn("_d", F.col("value") - F.lag("value").over(w))
    g = e.groupBy("user_id", "day").agg(F.count("*").alias("n"), F.avg("value").alias("vec"), F.avg(F.col("value") ** 2).alias("power"), (F.sum(F.col("_d") ** 2) / (2 * F.nullif(F.count("_d"), F.lit(0)))).alias("noise2"))
    mean_noise = F.col("noise2") / F.col("n")
    raw, coherent = debiased_amplitude(F.col("power"), F.col("noise2")), debiased_amplitude(F.col("vec") ** 2, mean_noise)
    return g.select("user_id", "day", "n", F.round(raw, 5).alias("amplitude"), F.round(coherent, 5).alias("coherent"), F.round(F.sqrt(mean_noise), 5).alias("sigma"), F.round(raw / F.nullif(F.sqrt(mean_noise), F.lit(0.0)), 4).alias("snr")).filter("n >= 2")


def _residuals(s, d):
    return residuals(series(s, d).withColumns({"re": F.col("value"), "im": F.col("value") % 7}), ["user_id"], ["us", "event_id"], "re", "im", F.lit(4.0), F.lit(0.1))


def _departed(s, d):
    return subband_departures(visibilities(s, d).filter("antenna1 <> antenna2 AND NOT flag"), ["antenna1", "antenna2", "scan"], "ddid", "amp", F.lit(1301.0))


QUERIES = {
    "baseline_timeline": _timeline,
    "row_evolution": _evolution,
    "debiased_amplitude": _debiased,
    "binned_median": lambda s, d: binned_median(visibilities(s, d), ["ddid"], "amp", "weight", 60),
    "series_shape": lambda s, d: series_shape(series(s, d).withColumn("x", F.log(1 + F.col("value"))), ["user_id"], ["us", "event_id"], "x"),
    "complex_residuals": lambda s, d: _residuals(s, d).select("event_id", "used", F.round("model_re", 6).alias("model_re"), F.round("z2", 5).alias("z2"), outlier_bin().alias("outlier")),
    "excess_scatter": lambda s, d: excess_scatter(_residuals(s, d), ["user_id", "event_type"]),
    "subband_departures": _departed,
    "image_statistics": lambda s, d: image_statistics(table(s, d, "embeddings"), ["label"], "embedding"),
    "flag_changes": lambda s, d: flag_changes(series(s, d), ["user_id"], ["us", "event_id"], "us", F.col("value") > 60, (F.col("value") > 50) & (F.col("event_type") != "click")),
}
_MED = "list_median"
_RES = f"""{SERIES}, x AS (SELECT event_id, user_id, event_type, us, value AS re, value % 7 AS im FROM ev),
  o AS (SELECT *, coalesce(list(re) OVER b, []) || coalesce(list(re) OVER a, []) AS ore, coalesce(list(im) OVER b, []) || coalesce(list(im) OVER a, []) AS oim FROM x WINDOW b AS (PARTITION BY user_id ORDER BY us, event_id ROWS BETWEEN 3 PRECEDING AND 1 PRECEDING), a AS (PARTITION BY user_id ORDER BY us, event_id ROWS BETWEEN 1 FOLLOWING AND 3 FOLLOWING)),
  m AS (SELECT *, coalesce(len(ore), 0)::INT AS used, CASE WHEN len(ore) >= 2 THEN {_MED}(ore) END AS mr, CASE WHEN len(oim) >= 2 THEN {_MED}(oim) END AS mi FROM o),
  z AS (SELECT *, (re - mr) ** 2 + (im - mi) ** 2 AS off, mr * mr + mi * mi AS m2 FROM m),
  y AS (SELECT *, off / (16 * (1 + pi() / (2 * used)) + 0.01 * m2) AS z2 FROM z)"""
SQL = {
    "baseline_timeline": f"""WITH {VIS}, b AS (SELECT antenna1, antenna2, day, ddid, avg(amp * cos(v / 10)) AS re, avg(amp * sin(v / 10)) AS im FROM vis WHERE antenna1 <> antenna2 AND NOT flag GROUP BY ALL)
      SELECT antenna1, antenna2, day, round(sum(re), 4) AS sum_re, round(sum(im), 4) AS sum_im, count(*) AS n_subbands FROM b GROUP BY ALL""",
    "row_evolution": "SELECT vec_id, round(list_avg(list_filter(list_transform(embedding[17:48], lambda x: x::DOUBLE), lambda x: x <= 0.1)), 6) AS mean FROM embeddings",
    "debiased_amplitude": f"""WITH {SERIES}, x AS (SELECT user_id, day, value, value - lag(value) OVER (PARTITION BY user_id, day ORDER BY us, event_id) AS d FROM ev),
      g AS (SELECT user_id, day, count(*) AS n, avg(value) AS vec, avg(value * value) AS power, sum(d * d) / (2 * nullif(count(d), 0)) AS noise2 FROM x GROUP BY ALL)
      SELECT user_id, day, n, round(sqrt(greatest(power - noise2, 0)), 5) AS amplitude, round(sqrt(greatest(vec * vec - noise2 / n, 0)), 5) AS coherent, round(sqrt(noise2 / n), 5) AS sigma, round(sqrt(greatest(power - noise2, 0)) / nullif(sqrt(noise2 / n), 0), 4) AS snr FROM g WHERE n >= 2""",
    "binned_median": f"""WITH {VIS}, e AS (SELECT ddid, min(amp) AS lo, max(amp) AS hi FROM vis GROUP BY ddid),
      b AS (SELECT ddid, CAST(least(59, floor((amp - lo) / ((hi - lo) / 60))) AS INT) AS bin, amp, weight FROM vis JOIN e USING (ddid)) SELECT ddid, bin, round(median(amp), 6) AS x, round(median(weight), 6) AS y, count(*) AS n FROM b GROUP BY ddid, bin""",
    "series_shape": f"""WITH {SERIES}, x AS (SELECT user_id, us, event_id, ln(1 + value) AS x FROM ev),
      a AS (SELECT *, count(*) OVER (PARTITION BY user_id) AS n, row_number() OVER w AS rn, first_value(x) OVER f AS fi, last_value(x) OVER f AS la, lag(x, 1) OVER w AS l1, lag(x, 2) OVER w AS l2, lead(x, 1) OVER w AS r1, lead(x, 2) OVER w AS r2 FROM x
        WINDOW w AS (PARTITION BY user_id ORDER BY us, event_id), f AS (PARTITION BY user_id ORDER BY us, event_id ROWS BETWEEN UNBOUNDED PRECEDING AND UNBOUNDED FOLLOWING)),
      b AS (SELECT *, greatest(1, round_even(0.15 * n, 0)) AS k, list_sort(CASE WHEN n >= 5 THEN [coalesce(l2, fi), coalesce(l1, fi), x, coalesce(r1, la), coalesce(r2, la)] WHEN n = 4 THEN [coalesce(l2, fi), coalesce(l1, fi), x, coalesce(r1, la)] ELSE [coalesce(l1, fi), x, coalesce(r1, la)] END) AS s FROM a),
      c AS (SELECT *, s[len(s) // 2 + 1] AS m, x - s[len(s) // 2 + 1] AS r FROM b),
      g AS (SELECT user_id, count(*) AS n, 1.4826 * 1.25 * mad(r) AS sc, median(x) FILTER (rn > n - k) - median(x) FILTER (rn <= k) AS t, median(m) AS l, min(m) AS lo, max(m) AS hi FROM c GROUP BY user_id)
      SELECT user_id, n, CASE WHEN n >= 7 THEN round(sc, 6) END AS scan_scatter, CASE WHEN n >= 3 THEN round(t, 6) END AS trend, CASE WHEN n >= 3 THEN round(lo - l, 6) END AS max_drop, CASE WHEN n >= 3 THEN round(hi - l, 6) END AS max_rise, CASE WHEN n >= 3 THEN round(hi - lo, 6) END AS "range" FROM g""",
    "complex_residuals": f"WITH {_RES} SELECT event_id, used, round(mr, 6) AS model_re, round(z2, 5) AS z2, coalesce(z2 > -ln(1e-7) AND (sqrt(off / nullif(m2, 0)) > 0.1 OR sqrt(m2) < 20), false) AS outlier FROM y",
    "excess_scatter": f"WITH {_RES}, g AS (SELECT user_id, event_type, avg(z2) AS c, count(*) AS n FROM y WHERE z2 IS NOT NULL GROUP BY ALL HAVING count(*) >= 4) SELECT user_id, event_type, round(c, 6) AS chi2r, n, c > 1 + 6 / sqrt(n) AND c > 2 AS bad FROM g",
    "subband_departures": f"""WITH {VIS}, m AS (SELECT antenna1, antenna2, scan, ddid, avg(amp) AS m, 1301 / sqrt(count(*)) AS e FROM vis WHERE antenna1 <> antenna2 AND NOT flag GROUP BY ALL),
      l AS (SELECT antenna1, antenna2, scan, median(m) AS l FROM m GROUP BY ALL HAVING count(*) >= 3 AND median(m) > 0), r AS (SELECT antenna1, antenna2, scan, ddid, round(m / l, 6) AS ratio, round((m - l) / e, 4) AS nsigma FROM m JOIN l USING (antenna1, antenna2, scan))
      SELECT * FROM r WHERE abs(nsigma) > 6 AND abs(ratio - 1) > 0.15""",
    "image_statistics": "WITH c AS (SELECT label, unnest(embedding)::DOUBLE AS p FROM embeddings) SELECT label, round(max(p), 6) AS peak, round(1.4826 * mad(p), 6) AS noise, count(*) AS n FROM c GROUP BY label",
    "flag_changes": f"""WITH {SERIES}, k AS (SELECT user_id, us, event_id, CASE WHEN value > 50 AND event_type <> 'click' AND NOT value > 60 THEN 'flag' WHEN value > 60 AND NOT (value > 50 AND event_type <> 'click') THEN 'unflag' ELSE '' END AS action FROM ev),
      r AS (SELECT *, sum(new) OVER (PARTITION BY user_id ORDER BY us, event_id) AS run FROM (SELECT *, CASE WHEN action = lag(action) OVER (PARTITION BY user_id ORDER BY us, event_id) THEN 0 ELSE 1 END AS new FROM k))
      SELECT user_id, action, min(us) AS start, max(us) AS "end", count(*) AS n FROM r WHERE action <> '' GROUP BY user_id, action, run""",
}
