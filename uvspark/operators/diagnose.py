"""Diagnostics over tracks: off-source scans, slewing, spikes on baselines, coherence, and the commands that follow."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..plans.model import SERIES, VIS, series, visibilities
from .robust import mad_sigma, median_of, running_median

HOUR_US = 3600 * 1000000


def smooth_half_open(rows: DataFrame, keys: list[str], time: str, value: str, half: int, kind: str = "median") -> DataFrame:
    """Add smoothed over the half-open window (t - half, t + half] of whole time units."""
    w = Window.partitionBy(*keys).orderBy(time).rangeBetween(-half + 1, half)
    return rows.withColumn("smoothed", F.percentile(value, 0.5).over(w) if kind == "median" else F.avg(value).over(w))


def baseline_levels(rows: DataFrame, keys: list[str], scan: str, value: str, window: int = 5) -> DataFrame:
    """Per key and scan: median, its running median over the scans, their ratio, and the ratio's robust scatter over the track."""
    med = rows.groupBy(*keys, scan).agg(F.median(value).alias("amp"))
    out = med.withColumn("level", running_median(F.col("amp"), keys, [scan], window)).withColumn("ratio", F.col("amp") / F.nullif("level", F.lit(0.0)))
    scatter = mad_sigma(out, keys, "ratio").select(*keys, F.col("sigma").alias("scatter"))
    return out.join(scatter, keys)


def weak_scans(rows: DataFrame, keys: list[str], scan: str, value: str, level: float = 0.3) -> DataFrame:
    """Scans whose median is under level times the key's best scan; a key of one scan has none."""
    med = rows.groupBy(*keys, scan).agg(F.median(value).alias("amp"))
    w = Window.partitionBy(*keys)
    out = med.withColumn("share", F.col("amp") / F.nullif(F.max("amp").over(w), F.lit(0.0))).withColumn("_n", F.count("*").over(w))
    return out.filter((F.col("_n") > 1) & (F.round("share", 6) < level)).select(*keys, scan, F.round("share", 6).alias("share"))


def leading_low_time(rows: DataFrame, keys: list[str], order: list[str], time: str, value: str, integration: float, most: float, sigma: float = 3.0) -> DataFrame:
    """Per scan: how long it starts low. The level is that of the samples after a guard, if five or more, else of all.

    guard = max(3 integrations, min(most, a quarter of the span)); under five samples: 0.
    """
    w = Window.partitionBy(*keys)
    t0, span = F.min(time).over(w), F.max(time).over(w) - F.min(time).over(w)
    guard = F.greatest(F.lit(3 * integration), F.least(F.lit(most), span / 4))
    r = rows.withColumns({"_off": F.col(time) - t0, "_guard": guard, "_n": F.count(value).over(w)})
    late = F.when(F.col("_off") > F.col("_guard"), F.col(value))
    r = r.withColumn("_late", late)
    counts = r.groupBy(*keys).agg(F.count("_late").alias("_nl"), F.median("_late").alias("_ml"), F.median(value).alias("_ma"))
    r = r.join(counts, keys).withColumn("_level", F.when(F.col("_nl") >= 5, F.col("_ml")).otherwise(F.col("_ma")))
    used = F.when(F.col("_nl") >= 5, F.col("_late")).otherwise(F.col(value))
    spread = r.withColumn("_dev", F.abs(used - F.col("_level"))).groupBy(*keys).agg((1.4826 * F.median("_dev")).alias("_sigma"))
    r = r.join(spread, keys).withColumn("_low", F.round(F.col(value), 6) < F.round(F.col("_level") - sigma * F.col("_sigma"), 6))
    r = r.withColumn("_rn", F.row_number().over(w.orderBy(*order)))
    first = r.groupBy(*keys).agg(F.min(F.when(~F.coalesce("_low", F.lit(False)), F.col("_rn"))).alias("_stop"), F.max("_n").alias("_n"))
    j = r.join(first.drop("_n"), keys).filter(F.col("_stop").isNull() | (F.col("_rn") < F.col("_stop")))
    lasted = j.groupBy(*keys).agg(F.max("_off").alias("_last"))
    out = first.join(lasted, keys, "left")
    return out.select(*keys, F.when((F.col("_n") < 5) | F.col("_last").isNull(), 0.0).otherwise(F.round(F.least(F.col("_last") + integration, F.lit(most)), 6)).alias("low_time"))


def consensus(lows: DataFrame, by: list[str], value: str, least: int = 2) -> DataFrame:
    """Per scan: the median of the positive values if there are two and they are half of all; else 0."""
    positive = F.when(F.col(value) > 0, F.col(value))
    g = lows.groupBy(*by).agg(F.count(positive).alias("_p"), F.count("*").alias("_n"), F.median(positive).alias("_m"))
    return g.select(*by, F.when((F.col("_p") >= least) & (2 * F.col("_p") >= F.col("_n")), F.round("_m", 6)).otherwise(0.0).alias("agreed"))


def spikes(rows: DataFrame, keys: list[str], order: list[str], value: str, threshold: float = 5.0, window: int = 9, least: int = 5, refuse: float = 0.1) -> DataFrame:
    """Bins off their running median by more than threshold sigmas; a key with more than `refuse` of its bins off keeps them all."""
    out = rows.withColumn("_rel", F.col(value) / F.nullif(running_median(F.col(value), keys, order, window), F.lit(0.0)) - 1)
    s = mad_sigma(out, keys, "_rel").select(*keys, F.col("n").alias("_n"), F.col("sigma").alias("_s"))
    off = (F.col("_n") >= least) & (F.col("_s") > 0) & (F.round(F.abs("_rel"), 6) > F.round(threshold * F.col("_s"), 6))
    out = out.join(s, keys).withColumn("_off", F.coalesce(off, F.lit(False)))
    share = F.avg(F.col("_off").cast("double")).over(Window.partitionBy(*keys))
    return out.withColumn("spike", F.col("_off") & (share <= refuse)).drop("_rel", "_n", "_s", "_off")


def coherence(rows: DataFrame, keys: list[str], order: list[str], re: Column, im: Column) -> DataFrame:
    """Per key: |mean| / mean |.|, and the lag-one coherence |sum v conj(v')| / sum |v v'|; null under two samples."""
    w = Window.partitionBy(*keys).orderBy(*order)
    r = rows.select(*keys, *[o for o in order if o not in keys], re.alias("_re"), im.alias("_im"))
    r = r.withColumns({"_nr": F.lead("_re").over(w), "_ni": F.lead("_im").over(w)})
    power = F.hypot("_re", "_im")
    cr, ci = F.col("_re") * F.col("_nr") + F.col("_im") * F.col("_ni"), F.col("_im") * F.col("_nr") - F.col("_re") * F.col("_ni")
    g = r.groupBy(*keys).agg(F.avg("_re").alias("a"), F.avg("_im").alias("b"), F.avg(power).alias("c"), F.sum(cr).alias("d"), F.sum(ci).alias("e"), F.sum(power * F.hypot("_nr", "_ni")).alias("f"), F.count("*").alias("n"))
    zero = F.lit(0.0)
    return g.select(*keys, F.round(F.hypot("a", "b") / F.nullif("c", zero), 6).alias("coherence"), F.when(F.col("n") >= 2, F.round(F.hypot("d", "e") / F.nullif("f", zero), 6)).alias("lag_coherence"))


def mask_commands(masks: DataFrame, keys: list[str], scan: str, bin_: str, mask: str) -> DataFrame:
    """Consecutive bins of one scan with the same non-empty mask as one command: first and last bin, mask."""
    w = Window.partitionBy(*keys, scan).orderBy(bin_)
    same = (F.col(mask) == F.lag(mask).over(w)) & (F.col(bin_) == F.lag(bin_).over(w) + 1)
    r = masks.filter(F.col(mask) != "").withColumn("_isle", F.sum((~F.coalesce(same, F.lit(False))).cast("int")).over(w))
    return r.groupBy(*keys, scan, "_isle", mask).agg(F.min(bin_).alias("first"), F.max(bin_).alias("last")).drop("_isle")


def escalate(bins: DataFrame, keys: list[str], scan: str, flagged: str, least: int = 3) -> DataFrame:
    """Flag commands of bins; a scan with `least` flagged bins or more is flagged whole."""
    w = Window.partitionBy(*keys, scan)
    n = F.sum(F.col(flagged).cast("int")).over(w)
    out = bins.withColumn("_k", n).filter((F.col("_k") > 0) & (F.col(flagged) | (F.col("_k") >= least)))
    return out.withColumn("whole", F.col("_k") >= least).drop("_k")


def neighbour_scans(scans: DataFrame, scan: str, kind: str, lost: str) -> DataFrame:
    """Target scans strictly between a lost calibrator scan and the calibrator scans before and after it.

    One row per scan is ordered here, over one track.
    """
    back = Window.orderBy(scan).rowsBetween(Window.unboundedPreceding, -1)
    ahead = Window.orderBy(scan).rowsBetween(1, Window.unboundedFollowing)
    is_lost = F.when(F.col(kind) == "calibrator", F.col(lost))
    out = scans.withColumns({"_b": F.last(is_lost, True).over(back), "_a": F.first(is_lost, True).over(ahead)})
    return out.filter((F.col(kind) == "target") & (F.coalesce("_b", F.lit(False)) | F.coalesce("_a", F.lit(False)))).select(scan)


def best_window(rows: DataFrame, key: str, time: str, weight: str, width: int) -> DataFrame:
    """Per key: start of the half-open window [t, t + width) of the largest summed weight, the earliest on ties."""
    total = F.sum(weight).over(Window.partitionBy(key).orderBy(time).rangeBetween(0, width - 1))
    r = rows.withColumn("_total", F.round(total, 6))
    best = r.groupBy(key).agg(F.max(F.struct(F.col("_total").alias("w"), (-F.col(time)).alias("t"))).alias("_b"))
    return best.select(key, (-F.col("_b.t")).alias("start"), F.col("_b.w").alias("total"))


def model_ratio(rows: DataFrame, keys: list[str], data: str, model: str, weight: str) -> DataFrame:
    """Weighted least-squares ratio of data to model per key."""
    g = rows.groupBy(*keys).agg((F.sum(F.col(weight) * F.col(data) * F.col(model)) / F.nullif(F.sum(F.col(weight) * F.col(model) ** 2), F.lit(0.0))).alias("ratio"), F.count("*").alias("n"))
    return g.withColumn("ratio", F.round("ratio", 6))


def worst(rows: DataFrame, by: str, ratio: str) -> DataFrame:
    """Per group the row furthest from 1."""
    return rows.groupBy(by).agg(F.max_by(F.struct(*rows.columns), F.abs(F.col(ratio) - 1)).alias("_w")).select("_w.*")


def membership(rows: DataFrame, key: str, member: str, values: list) -> DataFrame:
    """One boolean column per value: does the key hold it."""
    p = rows.groupBy(key).agg(*[F.max((F.col(member) == v).cast("int")).alias(f"has_{v}") for v in values])
    return p.select(key, *[(F.col(f"has_{v}") == 1).alias(f"has_{v}") for v in values])


def natural_order(rows: DataFrame, text: str) -> DataFrame:
    """Sorted by the text before the first number, the number, then the text."""
    return rows.orderBy(F.regexp_extract(text, r"^(\D*)", 1), F.regexp_extract(text, r"(\d+)", 1).cast("bigint"), text)


def _low(s, d):
    return leading_low_time(series(s, d).select("event_type", "day", "us", "event_id", "t", "value"), ["event_type", "day"], ["us", "event_id"], "t", "value", 600.0, 7200.0, 0.5)


def _masks(s, d):
    hours = series(s, d).groupBy("user_id", "day", F.floor(F.col("us") / HOUR_US % 24).cast("int").alias("bin")).agg(F.when(F.max("value") > 60, F.when(F.min("value") > 30, "both").otherwise("high")).otherwise("").alias("mask"))
    return mask_commands(hours, ["user_id"], "day", "bin", "mask")


def _scans(s, d):
    return visibilities(s, d).groupBy("scan").agg(F.when(F.col("scan") % 3 == 0, "calibrator").otherwise("target").alias("kind"), (F.avg(F.col("flag").cast("double")) > 0.34).alias("lost"))


def _whole(s, d):
    out = escalate(series(s, d).select("event_id", "user_id", "day", (F.col("value") > 80).alias("bad")), ["user_id"], "day", "bad", 2)
    return out.groupBy("user_id", "day", "whole").agg(F.count("*").alias("n"))


def _levels(s, d):
    out = baseline_levels(visibilities(s, d), ["antenna1", "antenna2"], "scan", "amp")
    return out.select("antenna1", "antenna2", "scan", F.round("ratio", 6).alias("ratio"), F.round("scatter", 6).alias("scatter"))


def _spikes(s, d):
    return spikes(visibilities(s, d).groupBy("antenna1", "antenna2", "day").agg(F.median("amp").alias("amp")), ["antenna1", "antenna2"], ["day"], "amp", 1.6).groupBy("antenna1", "antenna2").agg(F.sum(F.col("spike").cast("long")).alias("n_spikes"))


def _worst(s, d):
    v = visibilities(s, d).withColumn("model", F.lit(1000.0) + 900 * F.col("u"))
    r = model_ratio(v, ["antenna1", "antenna2", "ddid"], "amp", "model", "weight")
    return worst(r, "antenna1", "ratio").select("antenna1", F.round(F.abs(F.col("ratio") - 1), 5).alias("off"))


_LOW = f"""{SERIES}, a AS (SELECT event_type, day, us, event_id, value, t - min(t) OVER w AS off, greatest(1800.0, least(7200.0, (max(t) OVER w - min(t) OVER w) / 4)) AS guard, count(value) OVER w AS n FROM ev WINDOW w AS (PARTITION BY event_type, day)),
  c AS (SELECT event_type, day, count(*) FILTER (off > guard) AS nl, median(value) FILTER (off > guard) AS ml, median(value) AS ma FROM a GROUP BY ALL),
  l AS (SELECT a.*, nl, CASE WHEN nl >= 5 THEN ml ELSE ma END AS level FROM a JOIN c USING (event_type, day)),
  s AS (SELECT event_type, day, 1.4826 * median(abs(value - level)) FILTER (nl < 5 OR off > guard) AS sg FROM l GROUP BY ALL),
  f AS (SELECT l.*, coalesce(round(value, 6) < round(level - 0.5 * sg, 6), false) AS low, row_number() OVER (PARTITION BY event_type, day ORDER BY us, event_id) AS rn FROM l JOIN s USING (event_type, day)),
  st AS (SELECT event_type, day, min(rn) FILTER (NOT low) AS stop, max(n) AS n FROM f GROUP BY ALL),
  la AS (SELECT f.event_type, f.day, max(off) AS last FROM f JOIN st USING (event_type, day) WHERE stop IS NULL OR rn < stop GROUP BY ALL),
  lows AS (SELECT event_type, day, CASE WHEN n < 5 OR last IS NULL THEN 0.0 ELSE round(least(last + 600.0, 7200.0), 6) END AS low_time FROM st LEFT JOIN la USING (event_type, day))"""

QUERIES = {
    "smoothcal": lambda s, d: smooth_half_open(series(s, d), ["user_id"], "us", "value", 12 * HOUR_US).select("event_id", F.round("smoothed", 6).alias("smoothed")),
    "baseline_levels": _levels,
    "weak_scans": lambda s, d: weak_scans(visibilities(s, d), ["antenna1", "antenna2"], "scan", "amp", 0.45),
    "measure_quack": _low,
    "quack_consensus": lambda s, d: consensus(_low(s, d), ["day"], "low_time"),
    "baseline_spikes": _spikes,
    "lag_coherence": lambda s, d: coherence(series(s, d), ["user_id"], ["us", "event_id"], F.col("value") * F.cos(F.col("value")), F.col("value") * F.sin(F.col("value"))),
    "mask_commands": _masks,
    "escalate_scans": _whole,
    "receiver_scans": lambda s, d: neighbour_scans(_scans(s, d), "scan", "kind", "lost"),
    "stage_window": lambda s, d: best_window(series(s, d), "user_id", "us", "value", 24 * HOUR_US),
    "model_check": _worst,
    "antenna_scan_matrix": lambda s, d: membership(visibilities(s, d).withColumn("antenna", F.explode(F.array("antenna1", "antenna2"))), "scan", "antenna", list(range(8))),
}
SQL = {
    "smoothcal": f"WITH {SERIES} SELECT event_id, round(median(value) OVER (PARTITION BY user_id ORDER BY us RANGE BETWEEN {12 * HOUR_US - 1} PRECEDING AND {12 * HOUR_US} FOLLOWING), 6) AS smoothed FROM ev",
    "baseline_levels": f"""WITH {VIS}, m AS (SELECT antenna1, antenna2, scan, median(amp) AS amp FROM vis GROUP BY ALL),
      r AS (SELECT *, amp / nullif(median(amp) OVER (PARTITION BY antenna1, antenna2 ORDER BY scan ROWS BETWEEN 2 PRECEDING AND 2 FOLLOWING), 0) AS ratio FROM m),
      s AS (SELECT antenna1, antenna2, 1.4826 * mad(ratio) AS sg FROM r GROUP BY ALL) SELECT antenna1, antenna2, scan, round(ratio, 6) AS ratio, round(sg, 6) AS scatter FROM r JOIN s USING (antenna1, antenna2)""",
    "weak_scans": f"""WITH {VIS}, m AS (SELECT antenna1, antenna2, scan, median(amp) AS amp FROM vis GROUP BY ALL), r AS (SELECT *, round(amp / max(amp) OVER w, 6) AS share, count(*) OVER w AS n FROM m WINDOW w AS (PARTITION BY antenna1, antenna2))
      SELECT antenna1, antenna2, scan, share FROM r WHERE n > 1 AND share < 0.45""",
    "measure_quack": f"WITH {_LOW} SELECT * FROM lows",
    "quack_consensus": f"WITH {_LOW} SELECT day, CASE WHEN count(*) FILTER (low_time > 0) >= 2 AND 2 * count(*) FILTER (low_time > 0) >= count(*) THEN round(median(low_time) FILTER (low_time > 0), 6) ELSE 0.0 END AS agreed FROM lows GROUP BY day",
    "baseline_spikes": f"""WITH {VIS}, m AS (SELECT antenna1, antenna2, day, median(amp) AS amp FROM vis GROUP BY ALL),
      r AS (SELECT *, amp / nullif(median(amp) OVER (PARTITION BY antenna1, antenna2 ORDER BY day ROWS BETWEEN 4 PRECEDING AND 4 FOLLOWING), 0) - 1 AS rel FROM m),
      s AS (SELECT antenna1, antenna2, count(rel) AS n, 1.4826 * mad(rel) AS sg FROM r GROUP BY ALL),
      o AS (SELECT antenna1, antenna2, coalesce(n >= 5 AND sg > 0 AND round(abs(rel), 6) > round(1.6 * sg, 6), false) AS off FROM r JOIN s USING (antenna1, antenna2))
      SELECT antenna1, antenna2, CASE WHEN avg(off::INT) <= 0.1 THEN CAST(sum(off::INT) AS BIGINT) ELSE 0 END AS n_spikes FROM o GROUP BY ALL""",
    "lag_coherence": f"""WITH {SERIES}, v AS (SELECT user_id, us, event_id, value * cos(value) AS re, value * sin(value) AS im FROM ev), n AS (SELECT *, lead(re) OVER w AS nr, lead(im) OVER w AS ni FROM v WINDOW w AS (PARTITION BY user_id ORDER BY us, event_id))
      SELECT user_id, round(sqrt(avg(re) ** 2 + avg(im) ** 2) / nullif(avg(sqrt(re * re + im * im)), 0), 6) AS coherence,
      CASE WHEN count(*) >= 2 THEN round(sqrt(sum(re * nr + im * ni) ** 2 + sum(im * nr - re * ni) ** 2) / nullif(sum(sqrt(re * re + im * im) * sqrt(nr * nr + ni * ni)), 0), 6) END AS lag_coherence FROM n GROUP BY user_id""",
    "mask_commands": f"""WITH {SERIES}, h AS (SELECT user_id, day, CAST(us // {HOUR_US} % 24 AS INT) AS bin, CASE WHEN max(value) > 60 THEN CASE WHEN min(value) > 30 THEN 'both' ELSE 'high' END ELSE '' END AS mask FROM ev GROUP BY ALL),
      q AS (SELECT * FROM h WHERE mask <> ''), n AS (SELECT *, CASE WHEN mask = lag(mask) OVER w AND bin = lag(bin) OVER w + 1 THEN 0 ELSE 1 END AS new FROM q WINDOW w AS (PARTITION BY user_id, day ORDER BY bin)),
      k AS (SELECT *, sum(new) OVER (PARTITION BY user_id, day ORDER BY bin) AS isle FROM n) SELECT user_id, day, mask, min(bin) AS first, max(bin) AS last FROM k GROUP BY user_id, day, isle, mask""",
    "escalate_scans": f"""WITH {SERIES}, k AS (SELECT user_id, day, value > 80 AS bad, sum((value > 80)::INT) OVER (PARTITION BY user_id, day) AS k FROM ev) SELECT user_id, day, k >= 2 AS whole, count(*) AS n FROM k WHERE k > 0 AND (bad OR k >= 2) GROUP BY ALL""",
    "receiver_scans": f"""WITH {VIS}, s AS (SELECT scan, CASE WHEN scan % 3 = 0 THEN 'calibrator' ELSE 'target' END AS kind, avg(flag::INT) > 0.34 AS lost FROM vis GROUP BY scan)
      SELECT scan FROM s t WHERE kind = 'target' AND ((SELECT lost FROM s c WHERE c.kind = 'calibrator' AND c.scan < t.scan ORDER BY c.scan DESC LIMIT 1) OR (SELECT lost FROM s c WHERE c.kind = 'calibrator' AND c.scan > t.scan ORDER BY c.scan LIMIT 1))""",
    "stage_window": f"""WITH {SERIES}, w AS (SELECT user_id, us, round(sum(value) OVER (PARTITION BY user_id ORDER BY us RANGE BETWEEN CURRENT ROW AND {24 * HOUR_US - 1} FOLLOWING), 6) AS total FROM ev),
      b AS (SELECT user_id, us AS start, total, row_number() OVER (PARTITION BY user_id ORDER BY total DESC, us) AS rn FROM w) SELECT user_id, start, total FROM b WHERE rn = 1""",
    "model_check": f"""WITH {VIS}, m AS (SELECT antenna1, antenna2, ddid, round(sum(weight * amp * (1000.0 + 900 * u)) / nullif(sum(weight * (1000.0 + 900 * u) ** 2), 0), 6) AS ratio FROM vis GROUP BY ALL) SELECT antenna1, round(max(abs(ratio - 1)), 5) AS off FROM m GROUP BY antenna1""",
    "antenna_scan_matrix": f"WITH {VIS}, e AS (SELECT scan, unnest([antenna1, antenna2]) AS a FROM vis) SELECT scan, " + ", ".join(f"bool_or(a = {i}) AS has_{i}" for i in range(8)) + " FROM e GROUP BY scan",
}
