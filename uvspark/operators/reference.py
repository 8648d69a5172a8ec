"""Phase referencing and reference antennas: pairs of references, plans, time grids, channel interpolation, selections."""

from __future__ import annotations

import heapq

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..plans.model import SERIES, VIS, series, table, visibilities
from .asof import _BR, _brackets, _places, nearest_fields
from .decide import _SNR, resolve_plan, snr_table

HOUR_US = 3600 * 1000000


def nearest_within(bracketed: DataFrame, time: str, tolerance: int) -> DataFrame:
    """Add near: value of the nearer bracket end (the earlier on ties) if within the tolerance, else null."""
    back, ahead = F.col(time) - F.col("t0"), F.col("t1") - F.col(time)
    pick = F.when(ahead.isNull() | (back <= ahead), F.when(back <= tolerance, F.col("v0"))).otherwise(F.when(ahead <= tolerance, F.col("v1")))
    return bracketed.withColumn("near", pick)


def projection(ra: Column, dec: Column, a: tuple[Column, Column], b: tuple[Column, Column]) -> Column:
    """Where the point falls on the line from a to b (0 to 1) in the tangent plane at a; degrees in."""
    scale = F.cos(F.radians(a[1]))
    wrap = lambda x: F.pmod(x + 180, F.lit(360.0)) - 180
    bx, by = wrap(b[0] - a[0]) * scale, b[1] - a[1]
    px, py = wrap(ra - a[0]) * scale, dec - a[1]
    return (px * bx + py * by) / F.nullif(bx * bx + by * by, F.lit(0.0))


def interpolation_pairs(targets: DataFrame, references: DataFrame, most: float = 0.5) -> DataFrame:
    """Per target its two nearest references and the weight of the second, kept within [-most, 1 + most]. Small (name, ra, dec) tables."""
    two = nearest_fields(targets, references, 2).groupBy("target").pivot("nth", [1, 2]).agg(F.first("reference"))
    a, b = (F.broadcast(references.select(F.col("name").alias(str(i)), F.col("ra").alias(f"ra{i}"), F.col("dec").alias(f"dec{i}"))) for i in (1, 2))
    t = F.broadcast(targets.select(F.col("name").alias("target"), "ra", "dec"))
    j = two.join(a, "1").join(b, "2").join(t, "target")
    x = projection(F.col("ra"), F.col("dec"), (F.col("ra1"), F.col("dec1")), (F.col("ra2"), F.col("dec2")))
    return j.select("target", F.col("1").alias("first"), F.col("2").alias("second"), F.round(F.greatest(F.lit(-most), F.least(F.lit(1 + most), x)), 6).alias("weight"))


def receiver_times(scans: DataFrame, start: str, end: str, cadence: int) -> DataFrame:
    """A regular grid of times inside each scan, its ends included where they fall on it."""
    return scans.withColumn("t", F.explode(F.sequence(F.col(start), F.col(end), F.lit(cadence))))


def reference_gaps(listed: DataFrame, coherence: DataFrame, least: float) -> DataFrame:
    """Antennas to avoid as reference: listed without data, or incoherent (best value under `least`) on half of their sources or more."""
    absent = listed.join(coherence.select("antenna").distinct(), "antenna", "left_anti").select("antenna", F.lit("no data").alias("why"))
    best = coherence.groupBy("antenna", "source").agg(F.max("value").alias("_b"))
    poor = best.groupBy("antenna").agg((2 * F.sum((F.col("_b") < least).cast("int")) >= F.count("*")).alias("_p")).filter("_p").select("antenna", F.lit("incoherent").alias("why"))
    return absent.unionByName(poor)


def select_antennas(snr: DataFrame, reference: int, min_snr: float, most: int | None = None) -> DataFrame:
    """Antennas with a median snr of min_snr, the reference always and first, then by median; the first `most`. One row per antenna."""
    med = snr.groupBy("antenna").agg(F.round(F.median("snr"), 6).alias("median_snr")).filter((F.col("median_snr") >= min_snr) | (F.col("antenna") == reference))
    w = Window.orderBy(F.when(F.col("antenna") == reference, 0).otherwise(1), F.desc("median_snr"), "antenna")
    out = med.withColumn("place", F.row_number().over(w))
    return out if most is None else out.filter(F.col("place") <= most)


def rescaled_sigma(sigma: Column, old: Column, new: Column) -> Column:
    """Sigma after a change of weight: scaled by sqrt(old / new); unchanged where either isn't positive."""
    return F.when((old > 0) & (new > 0), sigma * F.sqrt(old / new)).otherwise(sigma)


def interpolate_channels(freqs: Column, values: Column, flags: Column, at: Column, keep_flags: bool = False) -> Column:
    """Values of a table's channels (ascending frequencies) at data frequencies: array of structs value, flag.

    Linear between unflagged neighbours, constant beyond the ends; with keep_flags a data channel whose
    nearest table channel is flagged stays flagged. No unflagged channel flags all.
    """
    cells = F.zip_with(F.zip_with(freqs, values, lambda f, v: F.struct(f.alias("f"), v.alias("v"))), flags, lambda c, b: F.struct(c["f"].alias("f"), c["v"].alias("v"), b.alias("bad")))
    once = lambda value, body: F.get(F.transform(F.array(value), body), 0)  # noqa: E731  bound to a variable, so evaluated once per row

    def one(x: Column, cells: Column, good: Column) -> Column:
        lo, hi = F.try_element_at(F.filter(good, lambda c: c["f"] <= x), F.lit(-1)), F.get(F.filter(good, lambda c: c["f"] >= x), 0)
        ends = F.struct(lo.alias("lo"), hi.alias("hi"))

        def blend(e: Column) -> Column:
            low, high = e["lo"], e["hi"]
            w = F.when(high["f"] > low["f"], (x - low["f"]) / (high["f"] - low["f"])).otherwise(0.0)
            value = F.coalesce(low["v"] * (1 - w) + high["v"] * w, low["v"], high["v"])
            closest = F.array_min(F.transform(cells, lambda c: F.struct(F.abs(c["f"] - x).alias("d"), c["f"].alias("f"), c["bad"].alias("bad"))))["bad"]
            return F.struct(value.alias("value"), (value.isNull() | (closest if keep_flags else F.lit(False))).alias("flag"))

        return once(ends, blend)

    return once(cells, lambda c: once(F.filter(c, lambda x: ~x["bad"]), lambda good: F.transform(at, lambda x: one(x, c, good))))


def ionosphere_fringe(stec: Column, fmin: float, fmax: float) -> tuple[Column, Column]:
    """Phase (turns) at the lower and upper edge of a band for a slant TEC in TECU."""
    k = 40.308e16 / 299792458.0
    return -k * stec / fmin, -k * stec / fmax


def plan_parts(sizes: dict[str, int], parts: int) -> list[list[str]]:
    """Chunks dealt to parts, largest first, each to the part with least so far. Chunks are few: scans times subbands."""
    heap = [(0, i) for i in range(parts)]
    out: list[list[str]] = [[] for _ in range(parts)]
    for name, size in sorted(sizes.items(), key=lambda x: (-x[1], x[0])):
        total, i = heapq.heappop(heap)
        out[i].append(name)
        heapq.heappush(heap, (total + size, i))
    return out


def _plans(s, d):
    g = snr_table(s, d).groupBy("antenna", "source").agg(F.max("snr").alias("b"))
    top = g.groupBy("antenna").agg(F.sort_array(F.collect_list("b"), asc=False).alias("l"), F.count("*").alias("n"))
    plan = resolve_plan(F.get("l", 0), F.get("l", 1), F.col("antenna") * 100.0, F.col("n"))
    return top.select("antenna", plan.alias("plan"))


def _grid(s, d):
    scans = series(s, d).groupBy("user_id", "day").agg(F.min("us").alias("a"), F.max("us").alias("b"))
    return receiver_times(scans, "a", "b", 3 * HOUR_US).groupBy("user_id", "day").agg(F.count("*").alias("n"), F.max("t").alias("last"))


def _gaps(s, d):
    c = snr_table(s, d).filter("antenna <> 3").select("antenna", "source", (F.col("snr") / 50).alias("value"))
    return reference_gaps(s.range(12).select(F.col("id").alias("antenna")), c, 0.75)


def _interpolated(s, d):
    e = table(s, d, "embeddings").select("vec_id", F.transform("embedding", lambda x: F.round(x.cast("double"), 6)).alias("v"))
    nominal = F.transform(F.sequence(F.lit(0), F.lit(63)), lambda i: i * 4.0)
    bad = F.transform(F.sequence(F.lit(0), F.lit(63)), lambda i: (i * 7 + F.col("vec_id")) % 6 == 0)
    out = e.select("vec_id", interpolate_channels(nominal, F.col("v"), bad, F.transform(F.sequence(F.lit(0), F.lit(9)), lambda i: i * 27.0 + 1)).alias("o"))
    return out.select("vec_id", F.posexplode("o").alias("at", "c")).select("vec_id", "at", F.round("c.value", 9).alias("value"))


def _sigma(s, d):
    v = visibilities(s, d)
    x = rescaled_sigma(F.lit(1.0) / F.sqrt("weight"), F.col("weight"), F.when(F.col("flag"), 0.0).otherwise(F.col("weight") * 4))
    return v.groupBy("ddid").agg(F.round(F.sum(x), 5).alias("total"))


QUERIES = {
    "nearest_within": lambda s, d: nearest_within(_brackets(s, d), "us", 36 * HOUR_US).select("event_id", F.round("near", 6).alias("near")),
    "interpolation_pairs": lambda s, d: interpolation_pairs(_places(s, d), _places(s, d)),
    "phase_reference_plan": _plans,
    "receiver_times": _grid,
    "reference_gaps": _gaps,
    "select_antennas": lambda s, d: select_antennas(snr_table(s, d), 4, 3.3, 5),
    "rescaled_sigma": _sigma,
    "channel_interpolation": _interpolated,
}
SQL = {
    "nearest_within": f"WITH {_BR} SELECT event_id, round(CASE WHEN t1 IS NULL OR us - t0 <= t1 - us THEN CASE WHEN us - t0 <= {36 * HOUR_US} THEN v0 END ELSE CASE WHEN t1 - us <= {36 * HOUR_US} THEN v1 END END, 6) AS near FROM bv",
    "interpolation_pairs": """WITH f AS (SELECT n_name AS name, n_nationkey * 14.0::DOUBLE AS ra, n_regionkey * 15.0::DOUBLE - 30 + n_nationkey % 4 AS dec FROM nation),
      p AS (SELECT t.name AS target, r.name AS reference, round(degrees(2 * asin(least(1.0, sqrt(sin((radians(r.dec) - radians(t.dec)) / 2) ** 2 + cos(radians(t.dec)) * cos(radians(r.dec)) * sin((radians(r.ra) - radians(t.ra)) / 2) ** 2)))), 6) AS separation FROM f t JOIN f r ON t.name <> r.name),
      n AS (SELECT *, row_number() OVER (PARTITION BY target ORDER BY separation, reference) AS nth FROM p),
      j AS (SELECT x.target, x.reference AS a, y.reference AS b FROM n x JOIN n y ON x.target = y.target AND x.nth = 1 AND y.nth = 2),
      q AS (SELECT j.*, cos(radians(fa.dec)) AS sc, fb.ra - fa.ra AS bx0, fb.dec - fa.dec AS b_y, ft.ra - fa.ra AS px0, ft.dec - fa.dec AS py FROM j JOIN f fa ON fa.name = a JOIN f fb ON fb.name = b JOIN f ft ON ft.name = target),
      w AS (SELECT *, ((bx0 + 540)::DOUBLE % 360 - 180) * sc AS bx, ((px0 + 540)::DOUBLE % 360 - 180) * sc AS px FROM q)
      SELECT target, a AS "first", b AS "second", round(greatest(-0.5, least(1.5, (px * bx + py * b_y) / nullif(bx * bx + b_y * b_y, 0))), 6) AS weight FROM w""",
    "phase_reference_plan": f"""WITH {_SNR}, g AS (SELECT antenna, source, max(snr) AS b FROM snr GROUP BY ALL), t AS (SELECT antenna, list(b ORDER BY b DESC) AS l, count(*) AS n FROM g GROUP BY antenna)
      SELECT antenna, CASE WHEN n = 1 THEN 'single' WHEN l[1] >= 3 * l[2] THEN 'sequential' WHEN antenna * 100.0 > 600 THEN 'time' ELSE 'interpolate' END AS plan FROM t""",
    "receiver_times": f"WITH {SERIES}, s AS (SELECT user_id, day, min(us) AS a, max(us) AS b FROM ev GROUP BY ALL) SELECT user_id, day, (b - a) // {3 * HOUR_US} + 1 AS n, a + (b - a) // {3 * HOUR_US} * {3 * HOUR_US} AS last FROM s",
    "reference_gaps": f"""WITH {_SNR}, c AS (SELECT antenna, source, snr / 50 AS value FROM snr WHERE antenna <> 3), b AS (SELECT antenna, source, max(value) AS b FROM c GROUP BY ALL)
      SELECT a AS antenna, 'no data' AS why FROM range(12) t(a) WHERE a NOT IN (SELECT antenna FROM c) UNION ALL SELECT antenna, 'incoherent' FROM b GROUP BY antenna HAVING 2 * sum((b < 0.75)::INT) >= count(*)""",
    "select_antennas": f"""WITH {_SNR}, m AS (SELECT antenna, round(median(snr), 6) AS median_snr FROM snr GROUP BY antenna), p AS (SELECT *, CAST(row_number() OVER (ORDER BY (antenna <> 4)::INT, median_snr DESC, antenna) AS INT) AS place FROM m WHERE median_snr >= 3.3 OR antenna = 4)
      SELECT * FROM p WHERE place <= 5""",
    "rescaled_sigma": f"WITH {VIS} SELECT ddid, round(sum(CASE WHEN weight > 0 AND NOT flag THEN 1 / sqrt(weight) * sqrt(weight / (weight * 4)) ELSE 1 / sqrt(weight) END), 5) AS total FROM vis GROUP BY ddid",
    "channel_interpolation": """WITH c AS (SELECT vec_id, generate_subscripts(embedding, 1) - 1 AS i, round(CAST(unnest(embedding) AS DOUBLE), 6) AS v FROM embeddings), g AS (SELECT vec_id, i * 4.0::DOUBLE AS f, v FROM c WHERE (i * 7 + vec_id) % 6 <> 0),
      a AS (SELECT vec_id, k::INT AS "at", k * 27.0::DOUBLE + 1 AS x FROM (SELECT DISTINCT vec_id FROM c), range(10) r(k)),
      b AS (SELECT a.*, max(f) FILTER (f <= x) AS lo, min(f) FILTER (f >= x) AS hi FROM a JOIN g USING (vec_id) GROUP BY ALL),
      w AS (SELECT b.vec_id, "at", p.v AS v0, q.v AS v1, CASE WHEN hi > lo THEN (x - lo) / (hi - lo) ELSE 0 END AS w FROM b LEFT JOIN g p ON p.vec_id = b.vec_id AND p.f = lo LEFT JOIN g q ON q.vec_id = b.vec_id AND q.f = hi)
      SELECT vec_id, "at", round(coalesce(v0 * (1 - w) + v1 * w, v0, v1), 9) AS value FROM w""",
}
