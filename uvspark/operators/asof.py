"""As-of lookups: brackets of each probe in a table of solutions, interpolation, and applying chains of gains."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..plans.model import SERIES, VIS, series, table, visibilities

HOUR_US = 3600 * 1000000


#: Most solutions whose sorted lists are broadcast to the probes; beyond, both tables are shuffled.
BROADCAST_SOLUTIONS = 1_000_000


def brackets(probes: DataFrame, solutions: DataFrame, keys: list[str], time: str, value: str) -> DataFrame:
    """Add t0, v0 (last solution at or before) and t1, v1 (first at or after) to the probes.

    Solutions are few next to the probes: behind a check of their number, a sorted list per key is
    broadcast and searched in each row, so the probes aren't moved. Flagged solutions are the caller's to drop.
    """
    if solutions.count() > BROADCAST_SOLUTIONS:
        return shuffled_brackets(probes, solutions, keys, time, value)
    entry = F.struct(F.col(time).alias("t"), F.col(value).cast("double").alias("v"))
    lists = solutions.groupBy(*keys).agg(F.sort_array(F.collect_list(entry)).alias("_list"))
    steps = F.array(*[F.lit(1 << i) for i in reversed(range(BROADCAST_SOLUTIONS.bit_length()))])
    until = F.aggregate(steps, F.lit(0), lambda n, step: n + F.when(F.get("_list", n + step - 1)["t"] <= F.col(time), step).otherwise(0))
    found = probes.join(F.broadcast(lists), keys, "left").withColumn("_n", until)
    found = found.withColumns({"_lo": F.get("_list", F.col("_n") - 1), "_hi": F.get("_list", F.col("_n"))}).drop("_list", "_n")
    found = found.withColumn("_hi", F.when(F.col("_lo.t") == F.col(time), F.col("_lo")).otherwise(F.col("_hi")))
    return found.select(*probes.columns, F.col("_lo.t").alias("t0"), F.col("_lo.v").alias("v0"), F.col("_hi.t").alias("t1"), F.col("_hi.v").alias("v1"))


def shuffled_brackets(probes: DataFrame, solutions: DataFrame, keys: list[str], time: str, value: str) -> DataFrame:
    """brackets for many solutions: one shuffle on the keys. Both tables are stacked and each probe looks back and ahead in its window."""
    cols = probes.columns
    a = probes.select(F.struct(*cols).alias("_p"), *keys, F.col(time).alias("_t"), F.lit(None).cast("double").alias("_v"), F.lit(1).alias("_probe"))
    b = solutions.select(F.lit(None).cast(a.schema["_p"].dataType).alias("_p"), *keys, F.col(time).alias("_t"), F.col(value).cast("double").alias("_v"), F.lit(0).alias("_probe"))
    sol = F.when(F.col("_probe") == 0, F.struct(F.col("_t").alias("t"), F.col("_v").alias("v")))
    by_time = Window.partitionBy(*keys).orderBy("_t")
    lo = F.last(sol, True).over(by_time.rangeBetween(Window.unboundedPreceding, Window.currentRow))
    hi = F.first(sol, True).over(by_time.rangeBetween(Window.currentRow, Window.unboundedFollowing))
    both = a.unionByName(b).withColumns({"_lo": lo, "_hi": hi}).filter("_probe = 1")
    return both.select("_p.*", F.col("_lo.t").alias("t0"), F.col("_lo.v").alias("v0"), F.col("_hi.t").alias("t1"), F.col("_hi.v").alias("v1"))


def nearest(time: Column) -> Column:
    """Value of the nearer end; the earlier on ties; the only one at the ends."""
    t0, t1, v0, v1 = (F.col(c) for c in ("t0", "t1", "v0", "v1"))
    return F.when(t1.isNull() | (time - t0 <= t1 - time), F.coalesce(v0, v1)).otherwise(F.coalesce(v1, v0))


def linear(time: Column) -> Column:
    """Linear between the ends, clamped outside."""
    t0, t1, v0, v1 = (F.col(c) for c in ("t0", "t1", "v0", "v1"))
    w = F.when(t1 > t0, (time - t0) / (t1 - t0)).otherwise(0.0)
    return F.coalesce(v0 * (1 - w) + v1 * w, v0, v1)


def bracket_gaps(rows: DataFrame, time: str) -> DataFrame:
    """Add before and after: the distances to both ends, infinite where one is missing."""
    inf = F.lit(float("inf"))
    return rows.withColumns({"before": F.coalesce((F.col(time) - F.col("t0")).cast("double"), inf), "after": F.coalesce((F.col("t1") - F.col(time)).cast("double"), inf)})


def scan_of_times(rows: DataFrame, time: str, scans: DataFrame) -> DataFrame:
    """Add scan: the one (scan, start, end; disjoint) that holds the time, else the next, else -1."""
    ends = scans.select(F.col("end").alias(time), F.col("scan").alias("_scan"), F.lit(0).alias("_k"))
    keyed = rows.withColumn("_k", F.lit(0))
    # The wanted scan is the first whose end isn't before the time; scans are few, so each time bucket gets its own copy of that list.
    ordered = F.broadcast(ends.groupBy("_k").agg(F.sort_array(F.collect_list(F.struct(F.col(time).alias("end"), F.col("_scan").alias("scan")))).alias("_list")))
    first = F.aggregate(F.lit([1 << i for i in reversed(range(24))]), F.lit(0), lambda acc, step: acc + F.when(F.get("_list", acc + step - 1)["end"] < F.col(time), step).otherwise(0))
    return keyed.join(ordered, "_k").withColumn("_i", first).withColumn("scan", F.coalesce(F.get("_list", F.col("_i"))["scan"], F.lit(-1))).drop("_k", "_list", "_i")


def predict_from_previous(rows: DataFrame, keys: list[str], order: list[str], value: str, good: Column, n: int) -> DataFrame:
    """Add predicted: median of the last n good values among the previous 2n rows, null with none."""
    w = Window.partitionBy(*keys).orderBy(*order).rowsBetween(-2 * n, -1)
    past = F.filter(F.collect_list(F.struct(F.col(value).alias("x"), good.alias("ok"))).over(w), lambda s: s["ok"])
    rows = rows.withColumn("_past", F.transform(past, lambda s: s["x"]))
    tail = F.sort_array(F.when(F.size("_past") > n, F.slice("_past", -n, n)).otherwise(F.col("_past")))
    rows = rows.withColumn("_tail", tail).withColumn("_n", F.size("_tail"))
    mid = (F.get("_tail", F.floor((F.col("_n") - 1) / 2).cast("int")) + F.get("_tail", F.floor(F.col("_n") / 2).cast("int"))) / 2
    return rows.withColumn("predicted", mid).drop("_past", "_tail", "_n")


def apply_gains(vis: DataFrame, tables: list[tuple[DataFrame, list[str]]]) -> DataFrame:
    """Divide amplitudes by the product of both endpoints' gains of a chain of tables.

    Each table has antenna, its further keys and gain; a missing or non-positive gain flags the row and
    leaves its amplitude. Weights are scaled by the squared product.
    """
    product, bad = F.lit(1.0), F.lit(False)
    for i, (gains, keys) in enumerate(tables):
        for end in (1, 2):
            g = gains.select(F.col("antenna").alias(f"antenna{end}"), *keys, F.col("gain").alias(f"_g{i}{end}"))
            vis = vis.join(F.broadcast(g), [f"antenna{end}", *keys], "left")
            x = F.col(f"_g{i}{end}")
            bad = bad | ~F.coalesce(x > 0, F.lit(False))
            product = product * F.coalesce(x, F.lit(1.0))
    vis = vis.withColumns({"_bad": bad, "_product": F.when(bad, 1.0).otherwise(product)})
    out = vis.withColumns({"amp": F.col("amp") / F.col("_product"), "weight": F.col("weight") * F.col("_product") ** 2, "flag": F.col("flag") | F.col("_bad")})
    return out.drop("_bad", "_product", *[f"_g{i}{e}" for i in range(len(tables)) for e in (1, 2)])


def nearest_fields(targets: DataFrame, references: DataFrame, k: int) -> DataFrame:
    """The k nearest references of each target by angular separation (degrees); both small (name, ra, dec) tables."""
    ra1, de1, ra2, de2 = (F.radians(F.col(c)) for c in ("t.ra", "t.dec", "r.ra", "r.dec"))
    h = F.sin((de2 - de1) / 2) ** 2 + F.cos(de1) * F.cos(de2) * F.sin((ra2 - ra1) / 2) ** 2
    sep = F.round(F.degrees(2 * F.asin(F.least(F.lit(1.0), F.sqrt(h)))), 6)
    pairs = targets.alias("t").join(F.broadcast(references).alias("r"), F.col("t.name") != F.col("r.name")).select(F.col("t.name").alias("target"), F.col("r.name").alias("reference"), sep.alias("separation"))
    return pairs.withColumn("nth", F.row_number().over(Window.partitionBy("target").orderBy("separation", "reference"))).filter(F.col("nth") <= k)


def _split(s, d):
    e = series(s, d).select("event_id", "user_id", "us", "event_type", "value")
    return e.filter("event_type = 'view'"), e.filter("event_type = 'purchase'").dropDuplicates(["user_id", "us"])


def _brackets(s, d):
    return brackets(*_split(s, d), ["user_id"], "us", "value")


def _gains(s, d):
    one = table(s, d, "supplier").groupBy((F.col("s_suppkey") % 8).cast("int").alias("antenna")).agg(F.round(1 + F.avg("s_acctbal") / 10000, 4).alias("gain"))
    two = s.range(8 * 7).select((F.col("id") % 8).cast("int").alias("antenna"), (F.floor(F.col("id") / 8) + 1).cast("int").alias("ddid"), (F.lit(1.0) + (F.col("id") % 5) / 10 - F.when(F.col("id") % 11 == 3, 2.0).otherwise(0.0)).alias("gain"))
    return [(one, []), (two, ["ddid"])]


def _applied(s, d):
    out = apply_gains(visibilities(s, d), _gains(s, d))
    return out.groupBy("antenna1", "antenna2", "ddid").agg(F.round(F.sum("amp"), 4).alias("amp"), F.round(F.sum("weight"), 6).alias("weight"), F.sum(F.col("flag").cast("long")).alias("n_flagged"))


def _scans(s):
    k = F.col("id").cast("int")
    return s.range(200).select(k.alias("scan"), (k.cast("long") * 3 * HOUR_US).alias("start"), ((k.cast("long") * 3 + 2) * HOUR_US).alias("end"))


def _places(s, d):
    n = table(s, d, "nation")
    return n.select(F.col("n_name").alias("name"), (F.col("n_nationkey") * 14.0).alias("ra"), (F.col("n_regionkey") * 15.0 - 30 + F.col("n_nationkey") % 4).alias("dec"))


_BR = f"""{SERIES}, p AS (SELECT event_id, user_id, us FROM ev WHERE event_type = 'view'), so AS (SELECT user_id, us, value FROM ev WHERE event_type = 'purchase'),
  br AS (SELECT p.*, (SELECT max(us) FROM so WHERE so.user_id = p.user_id AND so.us <= p.us) AS t0, (SELECT min(us) FROM so WHERE so.user_id = p.user_id AND so.us >= p.us) AS t1 FROM p),
  bv AS (SELECT br.*, a.value AS v0, b.value AS v1 FROM br LEFT JOIN so a ON a.user_id = br.user_id AND a.us = br.t0 LEFT JOIN so b ON b.user_id = br.user_id AND b.us = br.t1)"""

QUERIES = {
    "asof_nearest": lambda s, d: _brackets(s, d).select("event_id", F.round(nearest(F.col("us")), 6).alias("gain")),
    "asof_linear_gain": lambda s, d: _brackets(s, d).select("event_id", F.round(linear(F.col("us")), 6).alias("gain")),
    "bracket_gaps": lambda s, d: bracket_gaps(_brackets(s, d), "us").select("event_id", *[F.when(F.col(c) < float("inf"), F.col(c)).otherwise(-1.0).alias(c) for c in ("before", "after")]),
    "scan_of_times": lambda s, d: scan_of_times(series(s, d), "us", _scans(s)).select("event_id", "scan"),
    "predict_from_previous": lambda s, d: predict_from_previous(series(s, d), ["user_id"], ["us", "event_id"], "value", F.col("value") > 40, 3).select("event_id", F.round("predicted", 6).alias("predicted")),
    "apply_chain": _applied,
    "nearest_references": lambda s, d: nearest_fields(_places(s, d), _places(s, d), 2),
}
SQL = {
    "asof_nearest": f"WITH {_BR} SELECT event_id, round(CASE WHEN t1 IS NULL OR us - t0 <= t1 - us THEN coalesce(v0, v1) ELSE coalesce(v1, v0) END, 6) AS gain FROM bv",
    "asof_linear_gain": f"WITH {_BR}, w AS (SELECT *, CASE WHEN t1 > t0 THEN (us - t0)::DOUBLE / (t1 - t0) ELSE 0.0 END AS w FROM bv) SELECT event_id, round(coalesce(v0 * (1 - w) + v1 * w, v0, v1), 6) AS gain FROM w",
    "bracket_gaps": f"WITH {_BR} SELECT event_id, coalesce((us - t0)::DOUBLE, -1.0) AS before, coalesce((t1 - us)::DOUBLE, -1.0) AS after FROM bv",
    "scan_of_times": f"WITH {SERIES} SELECT event_id, coalesce((SELECT min(k) FROM range(200) r(k) WHERE (k * 3 + 2) * {HOUR_US} >= us), -1)::INT AS scan FROM ev",
    "predict_from_previous": f"""WITH {SERIES}, l AS (SELECT event_id, list_filter(list({{'x': value, 'ok': value > 40}}) OVER (PARTITION BY user_id ORDER BY us, event_id ROWS BETWEEN 6 PRECEDING AND 1 PRECEDING), lambda z: z.ok) AS p FROM ev)
      SELECT event_id, round(list_median(list_transform(p[-3:], lambda z: z.x)), 6) AS predicted FROM l""",
    "apply_chain": f"""WITH {VIS}, g1 AS (SELECT CAST(s_suppkey % 8 AS INT) AS antenna, round(1 + avg(s_acctbal) / 10000, 4) AS gain FROM supplier GROUP BY ALL),
      g2 AS (SELECT CAST(id % 8 AS INT) AS antenna, CAST(id // 8 + 1 AS INT) AS ddid, 1.0::DOUBLE + (id % 5)::DOUBLE / 10 - CASE WHEN id % 11 = 3 THEN 2.0 ELSE 0.0 END AS gain FROM range(56) r(id)),
      j AS (SELECT v.*, a.gain AS a, b.gain AS b, c.gain AS c, e.gain AS e FROM vis v LEFT JOIN g1 a ON a.antenna = antenna1 LEFT JOIN g1 b ON b.antenna = antenna2
        LEFT JOIN g2 c ON c.antenna = antenna1 AND c.ddid = v.ddid LEFT JOIN g2 e ON e.antenna = antenna2 AND e.ddid = v.ddid),
      k AS (SELECT *, NOT coalesce(a > 0 AND b > 0 AND c > 0 AND e > 0, false) AS bad FROM j), z AS (SELECT *, CASE WHEN bad THEN 1.0 ELSE a * b * c * e END AS p FROM k)
      SELECT antenna1, antenna2, ddid, round(sum(amp / p), 4) AS amp, round(sum(weight * p * p), 6) AS weight, CAST(sum((flag OR bad)::INT) AS BIGINT) AS n_flagged FROM z GROUP BY ALL""",
    "nearest_references": """WITH f AS (SELECT n_name AS name, n_nationkey * 14.0::DOUBLE AS ra, n_regionkey * 15.0::DOUBLE - 30 + n_nationkey % 4 AS dec FROM nation),
      p AS (SELECT t.name AS target, r.name AS reference, round(degrees(2 * asin(least(1.0, sqrt(sin((radians(r.dec) - radians(t.dec)) / 2) ** 2 + cos(radians(t.dec)) * cos(radians(r.dec)) * sin((radians(r.ra) - radians(t.ra)) / 2) ** 2)))), 6) AS separation FROM f t JOIN f r ON t.name <> r.name),
      n AS (SELECT *, CAST(row_number() OVER (PARTITION BY target ORDER BY separation, reference) AS INT) AS nth FROM p) SELECT * FROM n WHERE nth <= 2""",
}
