"""Averages against a reference antenna, channel blocks, solution intervals, bandpass shapes, component models and text states."""

from __future__ import annotations

import math

import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..plans.model import SERIES, VIS, series, table, visibilities

HOUR_US = 3600 * 1000000


def to_reference(vis: DataFrame, reference: int, re: str, im: str) -> DataFrame:
    """Rows of baselines to one antenna, turned so that it comes first: `other`, and im negated where it was second."""
    rows = vis.filter((F.col("antenna1") != F.col("antenna2")) & ((F.col("antenna1") == reference) | (F.col("antenna2") == reference)))
    second = F.col("antenna2") == reference
    return rows.withColumns({"other": F.when(second, F.col("antenna1")).otherwise(F.col("antenna2")), im: F.when(second, -F.col(im)).otherwise(F.col(im))})


def vector_average(rows: DataFrame, keys: list[str], re: str, im: str) -> DataFrame:
    """Amplitude and phase in degrees of the mean vector of unflagged rows, and their count."""
    ok = ~F.col("flag")
    a, b = F.avg(F.when(ok, F.col(re))), F.avg(F.when(ok, F.col(im)))
    g = rows.groupBy(*keys).agg(a.alias("_a"), b.alias("_b"), F.count(F.when(ok, 1)).alias("n"))
    return g.select(*keys, F.round(F.hypot("_a", "_b"), 6).alias("amplitude"), F.round(F.degrees(F.atan2("_b", "_a")), 6).alias("phase_deg"), "n")


def channel_blocks(rows: DataFrame, key: str, values: str, blocks: int) -> DataFrame:
    """Mean of an array column per key and block of channels, floor(channel * blocks / channels)."""
    cells = rows.select(key, F.size(values).alias("_n"), F.posexplode(values).alias("_c", "_x"))
    block = F.floor(F.col("_c") * blocks / F.col("_n")).cast("int")
    return cells.groupBy(key, block.alias("block")).agg(F.round(F.avg(F.col("_x").cast("double")), 6).alias("mean"), F.count("_x").alias("n"))


def solution_interval(time_us: Column, first_us: Column, seconds: float) -> Column:
    """Key of a solution interval: endless is one, zero is each millisecond, else bins from the first time."""
    if math.isinf(seconds):
        return F.lit(0).cast("long")
    if seconds == 0:
        return F.floor(time_us / 1000).cast("long")
    return F.floor((time_us - first_us) / (seconds * 1e6)).cast("long")


def accumulate(rows: DataFrame, keys: list[str], scan: str, time_us: str, seconds: float, value: str, weight: str) -> DataFrame:
    """Sums of weight * value and of weight per key and solution interval, intervals starting anew in each scan."""
    first = rows.groupBy(scan).agg(F.min(time_us).alias("_first"))  # one row per scan
    r = rows.join(first, scan).withColumn("interval", solution_interval(F.col(time_us), F.col("_first"), seconds)).drop("_first")
    return r.groupBy(*keys, scan, "interval").agg(F.round(F.sum(F.col(weight) * F.col(value)), 4).alias("sum_wv"), F.round(F.sum(weight), 4).alias("sum_w"))


def normalised(values: Column) -> Column:
    """An array over its root mean square; unchanged if that is zero."""
    rms = F.sqrt(F.aggregate(values, F.lit(0.0), lambda a, x: a + x.cast("double") * x.cast("double")) / F.size(values))
    return F.transform(values, lambda x: x.cast("double") / F.coalesce(F.nullif(rms, F.lit(0.0)), F.lit(1.0)))


def divide_by_continuum(rows: DataFrame, nchan: int) -> DataFrame:
    """Divide channel sums (arrays sum_re, sum_im, w) by their channel-averaged visibility m, in the form that keeps signal-to-noise: sums become sum * conj(m), weights w * |m|^2; no weight at all: zero."""
    total = lambda c: F.aggregate(c, F.lit(0.0), lambda a, x: a + x)
    by = F.nullif(total("w"), F.lit(0.0))
    r = rows.withColumns({"_mr": F.coalesce(total("sum_re") / by, F.lit(0.0)), "_mi": F.coalesce(total("sum_im") / by, F.lit(0.0))})
    both = lambda f: F.zip_with("sum_re", "sum_im", f)
    mr, mi = F.col("_mr"), F.col("_mi")
    return r.select(
        *[c for c in rows.columns if c not in ("sum_re", "sum_im", "w")], both(lambda a, b: a * mr + b * mi).alias("sum_re"), both(lambda a, b: b * mr - a * mi).alias("sum_im"),
        F.transform("w", lambda w: w * (mr * mr + mi * mi)).alias("w"),
    )


def divide_by_model(cells: DataFrame, keys: list[str]) -> DataFrame:
    """Divide cells (re, im, weight, flag) by their model (model_re, model_im) scaled to median amplitude 1 over the usable cells of each key.

    Weights grow by the scaled amplitude's square. Cells whose model is missing, zero or under a thousandth of
    the largest are flagged, with weight 0, and keep their value. Keys without a usable cell, or whose model is 1
    throughout, stay as they are. The model is dropped.
    """
    amp = F.sqrt(F.col("model_re") ** 2 + F.col("model_im") ** 2)
    finite = F.coalesce(~F.isnan(amp) & (amp > 0) & (amp < float("inf")), F.lit(False))
    r = cells.withColumn("_amp", amp).withColumn("_use", ~F.col("flag") & finite)
    one = (F.abs(F.col("model_re") - 1) <= 1.001e-5) & (F.abs(F.col("model_im")) <= 1e-5)
    level = r.filter("_use").groupBy(*keys).agg(F.median("_amp").alias("_scale"), F.max("_amp").alias("_most"), F.min(one.cast("int")).alias("_one"))
    r = r.join(level, keys, "left").withColumn("_on", F.coalesce(F.col("_one") == 0, F.lit(False)))
    weak = ~F.col("_use") | (F.col("_amp") < 1e-3 * F.col("_most"))
    p = (F.col("_amp") / F.col("_scale")) ** 2
    ur, ui = F.col("model_re") / F.col("_scale"), F.col("model_im") / F.col("_scale")
    keep = lambda new, old: F.when(~F.col("_on") | weak, F.col(old)).otherwise(new).alias(old)
    return r.select(
        *[c for c in cells.columns if c not in ("re", "im", "weight", "flag", "model_re", "model_im")],
        keep((F.col("re") * ur + F.col("im") * ui) / p, "re"), keep((F.col("im") * ur - F.col("re") * ui) / p, "im"),
        F.when(~F.col("_on"), F.col("weight")).when(weak, 0.0).otherwise(F.col("weight") * p).alias("weight"), F.when(F.col("_on"), F.col("flag") | weak).otherwise(F.col("flag")).alias("flag"),
    )


def predict_components(vis: DataFrame, components: DataFrame, frequency: Column) -> DataFrame:
    """Add re and im of a sum of components (flux, l, m, sigma: Gaussian width in radians); components are few and broadcast."""
    light = 299792458.0
    listed = F.broadcast(components.agg(F.collect_list(F.struct("flux", "l", "m", "sigma")).alias("_parts")))
    r = vis.crossJoin(listed).withColumns({"_u": F.col("u") * frequency / light, "_v": F.col("v") * frequency / light})
    size = lambda c: c["flux"] * F.exp(-2 * math.pi**2 * c["sigma"] ** 2 * (F.col("_u") ** 2 + F.col("_v") ** 2))
    angle = lambda c: 2 * math.pi * (F.col("_u") * c["l"] + F.col("_v") * c["m"])
    total = lambda f: F.aggregate(F.transform("_parts", f), F.lit(0.0), lambda a, x: a + x)
    return r.withColumns({"re": total(lambda c: size(c) * F.cos(angle(c))), "im": total(lambda c: size(c) * F.sin(angle(c)))}).drop("_parts", "_u", "_v")


def structure_metrics(rows: DataFrame, keys: list[str], amplitude: str) -> DataFrame:
    """90th and 10th percentiles of an amplitude, and their ratio."""
    g = rows.groupBy(*keys).agg(F.percentile(amplitude, 0.9).alias("p90"), F.percentile(amplitude, 0.1).alias("p10"))
    return g.select(*keys, F.round("p90", 6).alias("p90"), F.round("p10", 6).alias("p10"), F.round(F.col("p10") / F.nullif("p90", F.lit(0.0)), 6).alias("visibility"))


def spaced_samples(rows: DataFrame, key: str, time: str, gap: int) -> DataFrame:
    """Greedy choice per key: the first time, then each that is more than gap after the last one chosen. A key's times are one group."""
    kind = {c: t for c, t in rows.dtypes}

    def choose(pdf: pd.DataFrame) -> pd.DataFrame:
        last, out = None, []
        for t in sorted(pdf[time].tolist()):
            if last is None or t - last > gap:
                out.append(t)
                last = t
        return pd.DataFrame({key: [pdf[key].iloc[0]] * len(out), time: out})

    return rows.select(key, time).groupBy(key).applyInPandas(choose, f"{key} {kind[key]}, {time} {kind[time]}")


def snr_class(snr: Column) -> Column:
    return F.when(snr.isNull(), "none").when(snr < 3, "lost").when(snr < 7, "weak").when(snr < 30, "good").otherwise("strong")


def antenna_states(snr: DataFrame, scans: DataFrame, antennas: DataFrame) -> DataFrame:
    """State of every (scan, antenna): its class by best snr where it took part, else absent. Both dimensions are small tables."""
    best = snr.groupBy("scan", "antenna").agg(F.max("snr").alias("_s"))
    grid = scans.crossJoin(F.broadcast(antennas))
    return grid.join(best, ["scan", "antenna"], "left").select("scan", "antenna", F.when(F.col("_s").isNull(), "absent").otherwise(snr_class(F.col("_s"))).alias("state"))


def match_ranges(points: DataFrame, ranges: DataFrame, keys: list[str]) -> DataFrame:
    """Range (id, lo, hi) that holds each point (name, x) of a setup (keys): the one of nearest centre, then least id, each used once.

    Points choose in order of name. A setup has a few dozen of each; setups are independent groups.
    """
    lists = ranges.groupBy(*keys).agg(F.sort_array(F.collect_list(F.struct("id", "lo", "hi"))).alias("_ranges"))
    grouped = points.groupBy(*keys).agg(F.sort_array(F.collect_list(F.struct("name", "x"))).alias("_points")).join(lists, keys, "left")

    def take(acc, p):
        free = F.filter(F.col("_ranges"), lambda r: p["x"].between(r["lo"], r["hi"]) & ~F.exists(acc, lambda m: F.coalesce(m["matched"] == r["id"], F.lit(False))))
        best = F.array_min(F.transform(free, lambda r: F.struct(F.abs(p["x"] - (r["lo"] + r["hi"]) / 2).alias("d"), r["id"].alias("id"))))
        return F.concat(acc, F.array(F.struct(p["name"].alias("name"), best["id"].alias("matched"))))

    id_, name = dict(ranges.dtypes)["id"], dict(points.dtypes)["name"]
    none = F.array().cast(f"array<struct<name:{name},matched:{id_}>>")
    return grouped.select(*keys, F.explode(F.aggregate("_points", none, take)).alias("_m")).select(*keys, "_m.*")


def hand_ratios(rows: DataFrame, keys: list[str], hand: str, value: str, first: str, second: str) -> DataFrame:
    """Median of one hand over that of the other, as a logarithm, where both have three values."""
    side = lambda h: F.when(F.col(hand) == h, F.col(value))
    g = rows.groupBy(*keys).agg(F.median(side(first)).alias("_a"), F.median(side(second)).alias("_b"), F.count(side(first)).alias("_na"), F.count(side(second)).alias("_nb"))
    return g.filter("_na >= 3 AND _nb >= 3").select(*keys, F.round(F.log(F.col("_a") / F.col("_b")), 6).alias("log_ratio"))


def amplitude_limit(rows: DataFrame, keys: list[str], value: str, share: float = 0.999) -> DataFrame:
    return rows.groupBy(*keys).agg(F.round(F.percentile(value, share), 6).alias("limit"))


def chain_factor(gains: DataFrame, keys: list[str]) -> DataFrame:
    """Product of positive gains along a chain, through logarithms."""
    return gains.filter("gain > 0").groupBy(*keys).agg(F.round(F.exp(F.sum(F.log("gain"))), 6).alias("factor"), F.count("*").alias("n_tables"))


def baseline_groups(rows: DataFrame, keys: list[str], time: str, tolerance: int) -> DataFrame:
    """Number groups of rows per key whose times follow within the tolerance: the rows an output with subbands side by side shares."""
    w = Window.partitionBy(*keys).orderBy(time)
    new = F.coalesce(F.col(time) - F.lag(time).over(w) > tolerance, F.lit(True)).cast("int")
    g = rows.withColumn("_new", new).withColumn("grp", F.sum("_new").over(w))
    return g.groupBy(*keys, "grp").agg(F.min(time).alias("t"), F.count("*").alias("n"))


def _phased(s, d):
    v = visibilities(s, d)
    return v.withColumns({"re": F.col("amp") * F.cos(F.col("v") / 10), "im": F.col("amp") * F.sin(F.col("v") / 10)})


def _predicted(s, d):
    parts = s.createDataFrame([(2.0, 1e-9, -2e-9, 1e-10), (0.5, -3e-9, 1e-9, 0.0), (0.1, 0.0, 0.0, 2e-9)], "flux double, l double, m double, sigma double")
    v = visibilities(s, d).select("ddid", (F.col("u") * 1e6).alias("u"), (F.col("v") * 1e6).alias("v"))
    p = predict_components(v, parts, F.lit(1e9) + F.col("ddid") * 1e8)
    return p.groupBy("ddid").agg(F.round(F.avg("re"), 6).alias("re"), F.round(F.avg("im"), 6).alias("im"))


def _continuum(s, d):
    x = F.transform("embedding", lambda e: e.cast("double"))
    rows = table(s, d, "embeddings").select("vec_id", x.alias("sum_re"), F.reverse(x).alias("sum_im"), F.transform("embedding", lambda e, c: ((F.col("vec_id") + c) % 3).cast("double")).alias("w"))
    out = divide_by_continuum(rows, 64).select("vec_id", F.posexplode(F.arrays_zip("sum_re", "sum_im", "w")).alias("chan", "c"))
    return out.select("vec_id", "chan", *[F.round(f"c.{n}", 6).alias(n) for n in ("sum_re", "sum_im", "w")])


def _modelled(s, d):
    e = series(s, d).select("event_id", "event_type", F.col("value").alias("re"), (F.col("user_id") % 11).cast("double").alias("im"), F.lit(2.0).alias("weight"), (F.col("event_id") % 5 == 0).alias("flag"), F.col("user_id"))
    odd = F.col("event_id") % 13
    cells = e.withColumn("model_re", F.when(odd == 0, None).when(odd == 1, 0.0).when(odd == 2, 1e-4).when(F.col("event_type") == "click", 1.0).otherwise(1.0 + F.col("user_id") % 7))
    cells = cells.withColumn("model_im", F.when(F.col("event_type") == "click", 0.0).otherwise((F.col("event_id") % 3).cast("double") * F.when(odd > 2, 1.0).otherwise(0.0)))
    out = divide_by_model(cells.drop("user_id"), ["event_type"])
    return out.select("event_id", "event_type", F.round("re", 6).alias("re"), F.round("im", 6).alias("im"), F.round("weight", 6).alias("weight"), "flag")


def _states(s, d):
    e = series(s, d).select(F.col("day").alias("scan"), (F.col("user_id") % 40).alias("antenna"), (F.col("value") / 10).alias("snr"))
    return antenna_states(e, s.range(30).select(F.col("id").cast("int").alias("scan")), s.range(42).select(F.col("id").alias("antenna")))


def _normal(s, d):
    x = table(s, d, "embeddings").select("vec_id", normalised(F.col("embedding")).alias("b"))
    return x.select("vec_id", F.round(F.get("b", 0), 6).alias("first"), F.round(F.array_max("b"), 6).alias("top"))


def _ranges(s, d):
    """Setups are a user's days; points all events of each, ranges eight that overlap."""
    setup = ["day", "user_id"]
    points = series(s, d).select(*setup, F.col("event_id").alias("name"), (F.col("value") % 80).alias("x"))
    k = F.col("id").cast("int")
    ranges = points.select(*setup).distinct().join(F.broadcast(s.range(8).select(k.alias("id"), (k * 10.0).alias("lo"), (k * 10.0 + 24).alias("hi"))))
    return match_ranges(points, ranges, setup).select("day", "user_id", "name", F.coalesce("matched", F.lit(-1)).alias("matched"))



QUERIES = {
    "reference_timeseries": lambda s, d: vector_average(to_reference(_phased(s, d), 2, "re", "im"), ["other", "scan"], "re", "im"),
    "subband_phase": lambda s, d: vector_average(to_reference(_phased(s, d), 0, "re", "im"), ["other", "ddid"], "re", "im"),
    "channel_blocks": lambda s, d: channel_blocks(table(s, d, "embeddings"), "label", "embedding", 6),
    "divide_by_continuum": _continuum,
    "divide_by_model": _modelled,
    "solution_intervals": lambda s, d: accumulate(series(s, d).withColumn("w", F.lit(1.0) + F.col("event_id") % 3), ["event_type"], "day", "us", 3600.0, "value", "w"),
    "normalise_bandpass": _normal,
    "predict_components": _predicted,
    "structure_metrics": lambda s, d: structure_metrics(visibilities(s, d), ["antenna1", "antenna2"], "amp"),
    "sample_times": lambda s, d: spaced_samples(series(s, d), "user_id", "us", 12 * HOUR_US),
    "antenna_states": _states,
    "match_subbands": _ranges,
    "hand_ratios": lambda s, d: hand_ratios(series(s, d), ["user_id"], "event_type", "value", "click", "view"),
    "amplitude_limit": lambda s, d: amplitude_limit(series(s, d), ["event_type"], "value"),
    "chain_factor": lambda s, d: chain_factor(series(s, d).select((F.col("user_id") % 30).alias("antenna"), "day", (F.col("value") / 40).alias("gain")), ["antenna", "day"]),
    "time_baseline_groups": lambda s, d: baseline_groups(series(s, d).select("user_id", "us"), ["user_id"], "us", 3 * HOUR_US).drop("grp"),
}
_PH = f"{VIS}, ph AS (SELECT *, amp * cos(v / 10) AS re, amp * sin(v / 10) AS im FROM vis WHERE antenna1 <> antenna2)"


def _vector(reference: int, key: str) -> str:
    return f"""WITH {_PH}, o AS (SELECT CASE WHEN antenna2 = {reference} THEN antenna1 ELSE antenna2 END AS other, {key}, re, CASE WHEN antenna2 = {reference} THEN -im ELSE im END AS im, flag FROM ph WHERE antenna1 = {reference} OR antenna2 = {reference}),
      g AS (SELECT other, {key}, avg(re) FILTER (NOT flag) AS a, avg(im) FILTER (NOT flag) AS b, count(*) FILTER (NOT flag) AS n FROM o GROUP BY ALL) SELECT other, {key}, round(sqrt(a * a + b * b), 6) AS amplitude, round(degrees(atan2(b, a)), 6) AS phase_deg, n FROM g"""


SQL = {
    "reference_timeseries": _vector(2, "scan"),
    "subband_phase": _vector(0, "ddid"),
    "channel_blocks": "SELECT label, CAST(floor(c * 6 / n) AS INT) AS block, round(avg(CAST(x AS DOUBLE)), 6) AS mean, count(x) AS n FROM (SELECT label, len(embedding)::DOUBLE AS n, unnest(embedding) AS x, generate_subscripts(embedding, 1) - 1 AS c FROM embeddings) GROUP BY ALL",
    "divide_by_continuum": """WITH c AS (SELECT vec_id, unnest(embedding)::DOUBLE AS a, unnest(list_reverse(embedding))::DOUBLE AS b, CAST(generate_subscripts(embedding, 1) - 1 AS INT) AS chan FROM embeddings),
      w AS (SELECT *, CAST((vec_id + chan) % 3 AS DOUBLE) AS w FROM c), m AS (SELECT vec_id, coalesce(sum(a) / nullif(sum(w), 0), 0) AS mr, coalesce(sum(b) / nullif(sum(w), 0), 0) AS mi FROM w GROUP BY vec_id)
      SELECT vec_id, chan, round(a * mr + b * mi, 6) AS sum_re, round(b * mr - a * mi, 6) AS sum_im, round(w * (mr * mr + mi * mi), 6) AS w FROM w JOIN m USING (vec_id)""",
    "divide_by_model": """WITH e AS (SELECT event_id, event_type, value AS re, CAST(user_id % 11 AS DOUBLE) AS im, event_id % 5 = 0 AS flag, event_id % 13 AS odd,
        CASE WHEN event_id % 13 = 0 THEN NULL WHEN event_id % 13 = 1 THEN 0.0 WHEN event_id % 13 = 2 THEN 1e-4 WHEN event_type = 'click' THEN 1.0 ELSE 1.0 + user_id % 7 END::DOUBLE AS mr,
        CASE WHEN event_type = 'click' OR event_id % 13 <= 2 THEN 0.0 ELSE event_id % 3 END::DOUBLE AS mi FROM events),
      a AS (SELECT *, sqrt(mr * mr + mi * mi) AS amp FROM e), u AS (SELECT *, NOT flag AND coalesce(amp > 0, false) AS use FROM a),
      l AS (SELECT event_type, median(amp) AS scale, max(amp) AS most, bool_and(abs(mr - 1) <= 1e-5 AND abs(mi) <= 1e-5) AS same FROM u WHERE use GROUP BY event_type),
      j AS (SELECT *, NOT coalesce(same, true) AS active, NOT use OR amp < 1e-3 * most AS weak FROM u LEFT JOIN l USING (event_type))
      SELECT event_id, event_type, round(CASE WHEN active AND NOT weak THEN (re * mr + im * mi) / (amp * amp) * scale ELSE re END, 6) AS re, round(CASE WHEN active AND NOT weak THEN (im * mr - re * mi) / (amp * amp) * scale ELSE im END, 6) AS im,
        round(CASE WHEN NOT active THEN 2.0 WHEN weak THEN 0.0 ELSE 2.0 * (amp / scale) ** 2 END, 6)::DOUBLE AS weight, flag OR (active AND weak) AS flag FROM j""",
    "solution_intervals": f"""WITH {SERIES}, i AS (SELECT *, 1.0 + event_id % 3 AS w, CAST(floor((us - min(us) OVER (PARTITION BY day)) / 3600e6) AS BIGINT) AS "interval" FROM ev) SELECT event_type, day, "interval", round(sum(w * value), 4)::DOUBLE AS sum_wv, round(sum(w), 4)::DOUBLE AS sum_w FROM i GROUP BY ALL""",
    "normalise_bandpass": "WITH x AS (SELECT vec_id, list_transform(embedding, lambda v: CAST(v AS DOUBLE)) AS x FROM embeddings), r AS (SELECT *, sqrt(list_sum(list_transform(x, lambda v: v * v)) / len(x)) AS r FROM x) SELECT vec_id, round(x[1] / coalesce(nullif(r, 0), 1), 6) AS first, round(list_max(x) / coalesce(nullif(r, 0), 1), 6) AS top FROM r",
    "predict_components": f"""WITH {VIS}, c AS (SELECT * FROM (VALUES (2.0::DOUBLE, 1e-9::DOUBLE, -2e-9::DOUBLE, 1e-10::DOUBLE), (0.5, -3e-9, 1e-9, 0.0), (0.1, 0.0, 0.0, 2e-9)) t(flux, l, m, sg)),
      w AS (SELECT row_number() OVER () AS id, ddid, u * 1e6 * (1e9 + ddid * 1e8) / 299792458.0 AS u, v * 1e6 * (1e9 + ddid * 1e8) / 299792458.0 AS v FROM vis),
      p AS (SELECT id, ddid, sum(flux * exp(-2 * pi() ** 2 * sg ** 2 * (u * u + v * v)) * cos(2 * pi() * (u * l + v * m))) AS re, sum(flux * exp(-2 * pi() ** 2 * sg ** 2 * (u * u + v * v)) * sin(2 * pi() * (u * l + v * m))) AS im FROM w, c GROUP BY ALL)
      SELECT ddid, round(avg(re), 6) AS re, round(avg(im), 6) AS im FROM p GROUP BY ddid""",
    "structure_metrics": f"WITH {VIS}, g AS (SELECT antenna1, antenna2, quantile_cont(amp, 0.9) AS a, quantile_cont(amp, 0.1) AS b FROM vis GROUP BY ALL) SELECT antenna1, antenna2, round(a, 6) AS p90, round(b, 6) AS p10, round(b / nullif(a, 0), 6) AS visibility FROM g",
    "sample_times": f"""WITH RECURSIVE {SERIES}, r AS (SELECT user_id, min(us) AS us FROM ev GROUP BY user_id UNION ALL SELECT user_id, us FROM (SELECT r.user_id, (SELECT min(us) FROM ev WHERE ev.user_id = r.user_id AND ev.us - r.us > {12 * HOUR_US}) AS us FROM r) WHERE us IS NOT NULL) SELECT user_id, us FROM r""",
    "antenna_states": f"""WITH {SERIES}, b AS (SELECT day AS scan, user_id % 40 AS antenna, max(value / 10) AS s FROM ev GROUP BY ALL)
      SELECT k::INT AS scan, a AS antenna, CASE WHEN s IS NULL THEN 'absent' WHEN s < 3 THEN 'lost' WHEN s < 7 THEN 'weak' WHEN s < 30 THEN 'good' ELSE 'strong' END AS state FROM range(30) x(k) CROSS JOIN range(42) y(a) LEFT JOIN b ON b.scan = k AND b.antenna = a""",
    "match_subbands": f"""WITH RECURSIVE {SERIES}, q AS (SELECT day, user_id, event_id AS name, value % 80 AS x, CAST(row_number() OVER (PARTITION BY day, user_id ORDER BY event_id) AS INT) AS n FROM ev), r AS (SELECT id::INT AS id, id * 10.0::DOUBLE AS lo, id * 10.0::DOUBLE + 24 AS hi FROM range(8) t(id)),
      cand AS (SELECT day, user_id, name, n, list({{'d': abs(x - (lo + hi) / 2), 'id': id}}) FILTER (x BETWEEN lo AND hi) AS c FROM q, r GROUP BY ALL),
      g AS (SELECT DISTINCT day, user_id, 0 AS n, NULL::BIGINT AS name, []::INT[] AS used, NULL::INT AS matched FROM q
        UNION ALL SELECT day, user_id, n, name, CASE WHEN m IS NULL THEN used ELSE list_append(used, m) END, m FROM (SELECT c.day, c.user_id, c.n, c.name, g.used, list_sort(list_filter(c.c, lambda z: NOT list_contains(g.used, z.id)))[1].id AS m FROM g JOIN cand c ON c.day = g.day AND c.user_id = g.user_id AND c.n = g.n + 1))
      SELECT day, user_id, name, coalesce(matched, -1)::INT AS matched FROM g WHERE n > 0""",
    "hand_ratios": "WITH g AS (SELECT user_id, median(value) FILTER (event_type = 'click') AS a, median(value) FILTER (event_type = 'view') AS b, count(*) FILTER (event_type = 'click') AS na, count(*) FILTER (event_type = 'view') AS nb FROM events GROUP BY user_id) SELECT user_id, round(ln(a / b), 6) AS log_ratio FROM g WHERE na >= 3 AND nb >= 3",
    "amplitude_limit": "SELECT event_type, round(quantile_cont(value, 0.999), 6) AS \"limit\" FROM events GROUP BY event_type",
    "chain_factor": f"WITH {SERIES} SELECT user_id % 30 AS antenna, day, round(exp(sum(ln(value / 40))), 6) AS factor, count(*) AS n_tables FROM ev WHERE value > 0 GROUP BY ALL",
    "time_baseline_groups": f"WITH {SERIES}, n AS (SELECT user_id, us, CASE WHEN us - lag(us) OVER (PARTITION BY user_id ORDER BY us) <= {3 * HOUR_US} THEN 0 ELSE 1 END AS new FROM ev), g AS (SELECT *, sum(new) OVER (PARTITION BY user_id ORDER BY us) AS grp FROM n) SELECT user_id, min(us) AS t, count(*) AS n FROM g GROUP BY user_id, grp",
}
