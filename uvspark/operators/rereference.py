"""Solutions brought to one reference antenna: origins moved, stages joined on a common reference, and phases carried through time where the reference is missing."""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.complexes import wrap
from ..plans.model import table, visibilities
from .ranks import pinned

TURN = 2 * math.pi


def time_centroids(rows: DataFrame, keys: list[str], time: str, weight: str) -> DataFrame:
    """Weighted mean time of each antenna's unflagged baselines, per key; null without weight."""
    ends = rows.filter((F.col("antenna1") != F.col("antenna2")) & ~F.col("flag")).select(*keys, time, weight, F.explode(F.array("antenna1", "antenna2")).alias("antenna"))
    return ends.groupBy(*keys, "antenna").agg((F.sum(F.col(weight) * F.col(time)) / F.nullif(F.sum(weight), F.lit(0.0))).alias("centroid"))


def move_origin(solutions: DataFrame, f_from: float, t_from: Column, f_to: float, t_to: Column, zero_rates: bool = False) -> DataFrame:
    """Phases at another frequency and time: delay (ns) carries them through frequency, rate (times f_to) through time. With zero_rates the rates are used up: t_to is then each antenna's centroid."""
    moved = F.col("phase") + TURN * ((f_to - f_from) * 1e-9 * F.col("delay") + f_to * (t_to - t_from) * F.col("rate"))
    out = solutions.withColumn("phase", wrap(moved))
    return out.withColumn("rate", F.lit(0.0)) if zero_rates else out


def append_stage(main: DataFrame, stage: DataFrame, keys: list[str], stage_reference: int, antennas: list[int], rebase: bool = True) -> DataFrame:
    """main with the solutions of some antennas that a later stage found on a reference of its own.

    Both: keys, antenna, reference, phase, delay, rate, flag. Adding main's solution of the stage's reference (same keys)
    brings a stage solution onto main's reference; where that is flagged, so is the sum. Keys without it are left out. An
    antenna that main has is only filled where it is flagged there. Without rebase stage solutions come as they are.
    """
    values = ("phase", "delay", "rate")
    wanted = stage.filter(F.col("antenna").isin(antennas))
    if rebase:
        base = main.filter(F.col("antenna") == stage_reference).select(*keys, *[F.col(v).alias(f"_{v}") for v in values], F.col("flag").alias("_f"), F.col("reference").alias("_r"))
        wanted = wanted.join(base, keys).withColumns({v: F.col(v) + F.col(f"_{v}") for v in values})
        wanted = wanted.withColumns({"phase": wrap(F.col("phase")), "flag": F.col("flag") | F.col("_f"), "reference": F.col("_r")})
    wanted = wanted.select(*keys, "antenna", F.struct("reference", *values, "flag").alias("_new"))
    both = main.join(wanted, [*keys, "antenna"], "full")
    take = F.col("_new").isNotNull() & F.coalesce(F.col("flag") & ~F.col("_new.flag") | F.col("flag").isNull(), F.lit(False))
    return both.select(*keys, "antenna", *[F.when(take, F.col(f"_new.{c}")).otherwise(F.col(c)).alias(c) for c in ("reference", *values, "flag")])


def fill_flagged(target: DataFrame, source: DataFrame, keys: list[str], values: list[str], wanted: DataFrame) -> DataFrame:
    """target with the source's unflagged solutions of the wanted (antenna, scan), only where target is flagged; `filled` says where."""
    good = source.filter(~F.col("flag")).join(wanted, wanted.columns, "left_semi").select(*keys, F.struct(*values).alias("_new"))
    both = target.join(good, keys, "left").withColumn("filled", F.col("flag") & F.col("_new").isNotNull())
    changed = {v: F.when(F.col("filled"), F.col(f"_new.{v}")).otherwise(F.col(v)) for v in values}
    return both.withColumns({**changed, "flag": F.col("flag") & ~F.col("filled")}).drop("_new")


def to_one_reference(solutions: DataFrame, keys: list[str], time: str, reference: int, f_ref: float) -> DataFrame:
    """All solutions relative to one antenna, also in intervals that lack it.

    solutions: keys, time, antenna, reference, phase, delay, rate, flag; one row per antenna and interval, its own reference's
    among them. Intervals with a good solution of the wanted antenna subtract it. The others are hung on them in a tree through time:
    the antenna whose last or next known solution is nearest in time (then the least antenna) is carried there by its own
    rate, and what it lacks is added to its whole interval; then intervals hang on those, until nothing is left to hang. Each
    round is a window per antenna and a join per interval; rounds are as many as the tree is deep. Intervals without
    any path keep their reference.
    """
    values = ("phase", "delay", "rate")
    at = [*keys, time]
    rows = pinned(solutions)
    base = rows.filter((F.col("antenna") == reference) & ~F.col("flag")).select(*at, *[F.col(v).alias(f"_{v}") for v in values])
    joined = rows.join(base, at, "left")
    known = joined.filter("_phase IS NOT NULL").withColumns({v: F.col(v) - F.col(f"_{v}") for v in values}).withColumn("reference", F.lit(reference)).select(rows.columns)
    left = joined.filter("_phase IS NULL").select(rows.columns)
    done = known = pinned(known)
    while True:
        left = pinned(left)
        found = hang(known, left, keys, time, f_ref)
        joined = pinned(left.join(found, at, "left"))
        new = joined.filter("_phase IS NOT NULL")
        if new.isEmpty():
            break
        new = new.withColumns({v: F.col(v) + F.col(f"_{v}") for v in values}).withColumn("reference", F.lit(reference)).select(rows.columns)
        known = pinned(known.unionByName(new))
        done, left = known, joined.filter("_phase IS NULL").select(rows.columns)
    return done.unionByName(left).withColumn("phase", wrap(F.col("phase")))


def hang(known: DataFrame, left: DataFrame, keys: list[str], time: str, f_ref: float) -> DataFrame:
    """Per interval of `left` what has to be added (_phase, _delay, _rate) so that its best bridging antenna agrees with its nearest known solution."""
    kind = F.struct(F.col(time).alias("t"), "phase", "delay", "rate")
    stacked = known.filter(~F.col("flag")).select(*keys, time, "antenna", kind.alias("_k"), F.lit(None).cast(kind_of(known, time)).alias("_u")).unionByName(
        left.filter(~F.col("flag")).select(*keys, time, "antenna", F.lit(None).cast(kind_of(known, time)).alias("_k"), kind.alias("_u"))
    )
    w = Window.partitionBy(*keys, "antenna").orderBy(time)
    before = F.last("_k", ignorenulls=True).over(w.rowsBetween(Window.unboundedPreceding, Window.currentRow))
    after = F.first("_k", ignorenulls=True).over(w.rowsBetween(Window.currentRow, Window.unboundedFollowing))
    near = stacked.withColumns({"_b": before, "_a": after}).filter("_u IS NOT NULL AND (_b IS NOT NULL OR _a IS NOT NULL)")
    pick = F.when(F.col("_a").isNull() | (F.col(time) - F.col("_b.t") <= F.col("_a.t") - F.col(time)), F.coalesce("_b", "_a")).otherwise(F.coalesce("_a", "_b"))
    near = near.withColumn("_n", pick)
    carried = F.col("_n.phase") + TURN * f_ref * F.col("_n.rate") * (F.col(time) - F.col("_n.t"))
    offer = F.struct(F.abs(F.col(time) - F.col("_n.t")).alias("gap"), "antenna", (carried - F.col("_u.phase")).alias("phase"), (F.col("_n.delay") - F.col("_u.delay")).alias("delay"), (F.col("_n.rate") - F.col("_u.rate")).alias("rate"))
    best = near.groupBy(*keys, time).agg(F.min(offer).alias("_o"))
    return best.select(*keys, time, *[F.col(f"_o.{v}").alias(f"_{v}") for v in ("phase", "delay", "rate")])


def kind_of(df: DataFrame, time: str) -> str:
    kinds = dict(df.dtypes)
    return f"struct<t:{kinds[time]},phase:{kinds['phase']},delay:{kinds['delay']},rate:{kinds['rate']}>"


F_REF, WANTED = 5e9, 0


def _planted(s, d) -> DataFrame:
    """Solutions of antennas with known phases, delays and rates, relative to the least antenna that is there; antenna 0 is missing in most intervals."""
    v = visibilities(s, d).filter("antenna1 <> antenna2").select((F.col("ddid") % 2).cast("int").alias("hand"), F.floor(F.col("day") / 10).cast("int").alias("interval"), F.explode(F.array("antenna1", "antenna2")).alias("antenna"))
    there = v.distinct().filter("antenna > 0 OR interval % 7 = 2").filter("NOT (interval % 7 = 4 AND antenna < 6)")
    t = F.col("interval") * 100.0
    rate = lambda a: ((a * 5 + F.col("hand")) % 7 - 3) * 1e-13
    phase = lambda a: (a * 7 + F.col("hand") * 3) % 11 * 0.5 + TURN * F_REF * rate(a) * t
    delay = lambda a: ((a * 3 + F.col("hand")) % 5 - 2).cast("double")
    first = there.groupBy("hand", "interval").agg(F.min("antenna").alias("reference"))
    rows = there.join(first, ["hand", "interval"]).withColumn("t", t)
    a, r = F.col("antenna"), F.col("reference")
    return rows.select("hand", "interval", "t", "antenna", "reference", wrap(phase(a) - phase(r)).alias("phase"), (delay(a) - delay(r)).alias("delay"), (rate(a) - rate(r)).alias("rate"), ((a + F.col("interval")) % 13 == 5).alias("flag"))


def _referenced(s, d):
    out = to_one_reference(_planted(s, d).drop("interval"), ["hand"], "t", WANTED, F_REF)
    return out.select("hand", "t", "antenna", "reference", (F.round(F.cos("phase"), 5) + 0.0).alias("cos"), (F.round(F.sin("phase"), 5) + 0.0).alias("sin"), (F.round("delay", 6) + 0.0).alias("delay"), (F.round(F.col("rate") * 1e13, 6) + 0.0).alias("rate"))


def _staged(s, d):
    p = _planted(s, d)
    main = p.filter("antenna < 5").withColumn("flag", F.col("flag") | (F.col("antenna") == 3))
    stage = p.filter("antenna >= 2").withColumns({"phase": F.col("phase") + 0.25, "delay": F.col("delay") + 1, "reference": F.lit(2)})
    out = append_stage(main, stage, ["hand", "interval", "t"], 2, [3, 5, 6])
    return out.select("hand", "interval", "antenna", "reference", (F.round(F.cos("phase"), 5) + 0.0).alias("cos"), (F.round(F.sin("phase"), 5) + 0.0).alias("sin"), F.round("delay", 6).alias("delay"), "flag")


def _fill(s, d):
    o = table(s, d, "orders").select((F.col("o_custkey") % 40).cast("int").alias("scan"), (F.col("o_custkey") % 7).cast("int").alias("antenna"), F.col("o_orderkey").alias("id"), (F.col("o_totalprice") / 1000).alias("phase"), (F.col("o_orderstatus") == "F").alias("flag"))
    source = o.withColumns({"phase": F.col("phase") + 1, "flag": F.col("id") % 3 == 0})
    wanted = o.filter("antenna = 2 AND scan < 20 OR antenna = 5").select("antenna", "scan").distinct()
    out = fill_flagged(o, source, ["id"], ["phase"], wanted)
    return out.select("id", F.round("phase", 6).alias("phase"), "flag", "filled")


def _centroids(s, d):
    v = visibilities(s, d)
    return time_centroids(v, ["scan"], "day", "weight").select("scan", "antenna", F.round("centroid", 6).alias("centroid"))


QUERIES = {"rereference_solutions": _referenced, "append_stage": _staged, "fill_flagged_solutions": _fill, "time_centroids": _centroids}
_PLANTED = """WITH RECURSIVE x AS (SELECT CAST(l_linenumber % 2 AS INT) AS hand, CAST(floor(date_diff('day', DATE '1995-01-01', CAST(l_shipdate AS DATE)) / 10.0) AS INT) AS "interval", unnest([l_suppkey % 8, l_partkey % 8])::INT AS antenna FROM lineitem WHERE l_suppkey % 8 <> l_partkey % 8),
  th AS (SELECT DISTINCT * FROM x WHERE (antenna > 0 OR "interval" % 7 = 2) AND NOT ("interval" % 7 = 4 AND antenna < 6)),
  fi AS (SELECT hand, "interval", min(antenna) AS reference FROM th GROUP BY ALL),
  tr AS (SELECT h AS hand, a, (a * 7 + h * 3) % 11 * 0.5::DOUBLE AS p0, ((a * 3 + h) % 5 - 2)::DOUBLE AS delay, ((a * 5 + h) % 7 - 3)::DOUBLE AS rate FROM range(2) y(h), range(8) z(a))"""
SQL = {
    # Truth, not the method: a solution is the antenna's less the wanted one's; only intervals without any good solution keep their own.
    "rereference_solutions": _PLANTED
    + f""", u AS (SELECT hand, "interval", bool_or((antenna + "interval") % 13 <> 5) AS ok FROM th GROUP BY ALL),
      k AS (SELECT th.*, CASE WHEN ok THEN {WANTED} ELSE reference END AS to_a FROM th JOIN u USING (hand, "interval") JOIN fi USING (hand, "interval")),
      j AS (SELECT k.hand, "interval" * 100.0::DOUBLE AS t, antenna, to_a, m.p0 - n.p0 + 2 * pi() * {F_REF} * 1e-13 * (m.rate - n.rate) * "interval" * 100 AS p, m.delay - n.delay AS delay, m.rate - n.rate AS rate FROM k JOIN tr m ON m.hand = k.hand AND m.a = antenna JOIN tr n ON n.hand = k.hand AND n.a = to_a)
      SELECT hand, t, antenna, to_a::INT AS reference, round(cos(p), 5) + 0.0 AS cos, round(sin(p), 5) + 0.0 AS sin, delay, rate FROM j""",
    "append_stage": _PLANTED
    + f""", j AS (SELECT th.hand, th."interval", antenna, reference, m.p0 - n.p0 + 2 * pi() * {F_REF} * 1e-13 * (m.rate - n.rate) * th."interval" * 100 AS p, m.delay - n.delay AS delay, (antenna + th."interval") % 13 = 5 AS flag
        FROM th JOIN fi USING (hand, "interval") JOIN tr m ON m.hand = th.hand AND m.a = antenna JOIN tr n ON n.hand = th.hand AND n.a = reference),
      m AS (SELECT hand, "interval", antenna, reference, p, delay, flag OR antenna = 3 AS flag FROM j WHERE antenna < 5),
      b AS (SELECT * FROM m WHERE antenna = 2),
      st AS (SELECT j.hand, j."interval", j.antenna, b.reference, j.p + 0.25 + b.p AS p, j.delay + 1 + b.delay AS delay, j.flag OR b.flag AS flag FROM j JOIN b USING (hand, "interval") WHERE j.antenna IN (3, 5, 6)),
      o AS (SELECT coalesce(m.hand, st.hand) AS hand, coalesce(m."interval", st."interval") AS "interval", coalesce(m.antenna, st.antenna) AS antenna, m.antenna IS NULL OR (m.flag AND NOT coalesce(st.flag, true)) AS take, m.reference AS r1, st.reference AS r2, m.p AS p1, st.p AS p2, m.delay AS d1, st.delay AS d2, m.flag AS f1, st.flag AS f2
        FROM m FULL JOIN st ON m.hand = st.hand AND m."interval" = st."interval" AND m.antenna = st.antenna)
      SELECT hand, "interval", antenna, CASE WHEN take THEN r2 ELSE r1 END AS reference, round(cos(CASE WHEN take THEN p2 ELSE p1 END), 5) + 0.0 AS cos, round(sin(CASE WHEN take THEN p2 ELSE p1 END), 5) + 0.0 AS sin, round(CASE WHEN take THEN d2 ELSE d1 END, 6) AS delay, CASE WHEN take THEN f2 ELSE f1 END AS flag FROM o""",
    "fill_flagged_solutions": """WITH o AS (SELECT CAST(o_custkey % 40 AS INT) AS scan, o_custkey % 7 AS antenna, o_orderkey AS id, o_totalprice / 1000 AS phase, o_orderstatus = 'F' AS flag FROM orders),
      f AS (SELECT *, flag AND id % 3 <> 0 AND (antenna = 2 AND scan < 20 OR antenna = 5) AS filled FROM o)
      SELECT id, round(CASE WHEN filled THEN phase + 1 ELSE phase END, 6) AS phase, flag AND NOT filled AS flag, filled FROM f""",
    "time_centroids": """WITH v AS (SELECT CAST(floor(date_diff('day', DATE '1995-01-01', CAST(l_shipdate AS DATE)) / 30.0) AS INT) AS scan, CAST(date_diff('day', DATE '1995-01-01', CAST(l_shipdate AS DATE)) AS INT) AS day, l_quantity AS w, unnest([l_suppkey % 8, l_partkey % 8])::INT AS antenna FROM lineitem WHERE l_suppkey % 8 <> l_partkey % 8 AND l_returnflag <> 'R')
      SELECT scan, antenna, round(sum(w * day) / sum(w), 6) AS centroid FROM v GROUP BY ALL""",
}
