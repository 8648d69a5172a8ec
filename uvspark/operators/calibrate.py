"""Calibration of complex cells by chains of solution tables, and care of the tables: coverage, remapping, repair, gaps."""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..plans.model import SERIES, VIS, series, table, visibilities

#: Most solution rows whose sorted lists are broadcast to the data.
BROADCAST_SOLUTIONS = 2_000_000


def _list_per_antenna(solutions: DataFrame) -> DataFrame:
    """antenna, _by: per hand the unflagged solutions (t, amp, phase; arrays over the table's channels) by time."""
    good = solutions.filter(~F.col("flag")).groupBy("antenna", "hand").agg(F.sort_array(F.collect_list(F.struct("t", "amp", "phase"))).alias("_l"))
    return good.groupBy("antenna").agg(F.map_from_entries(F.collect_list(F.struct("hand", "_l"))).alias("_by"))


def _count_until(values: Column, time: Column) -> Column:
    """How many solutions of a sorted list aren't after the time, by binary search."""
    steps = F.array(*[F.lit(1 << i) for i in reversed(range(21))])
    return F.aggregate(steps, F.lit(0), lambda n, step: n + F.when(F.get(values, n + step - 1)["t"] <= time, step).otherwise(0))


def _between(lo: Column, hi: Column, time: Column, interp: str) -> tuple[Column, Column]:
    """Amplitude and phase arrays at the time from the solutions around it; the only one at the ends."""
    if interp == "nearest":
        near = F.when(hi.isNull() | (time - lo["t"] <= hi["t"] - time), F.coalesce(lo, hi)).otherwise(F.coalesce(hi, lo))
        return near["amp"], near["phase"]
    w = (time - lo["t"]) / (hi["t"] - lo["t"])
    turn = lambda d: d - 2 * math.pi * F.ceil((d - math.pi) / (2 * math.pi))
    amp = F.when(lo.isNull(), hi["amp"]).when(hi.isNull(), lo["amp"]).otherwise(F.zip_with(lo["amp"], hi["amp"], lambda a, b: a + w * (b - a)))
    phase = F.when(lo.isNull(), hi["phase"]).when(hi.isNull(), lo["phase"]).otherwise(F.zip_with(lo["phase"], hi["phase"], lambda a, b: a + w * turn(b - a)))
    return amp, phase


def _to_channels(values: Column, nodes: int, nchan: int) -> Column:
    """Values at `nodes` evenly spaced channels, the first and the last among them, to all channels, linearly."""
    if nodes == 1:
        return F.transform(F.sequence(F.lit(0), F.lit(nchan - 1)), lambda c: F.get(values, F.lit(0)))
    if nodes == nchan:
        return values
    step = (nchan - 1) / (nodes - 1)

    def at(c):
        k = F.least(F.floor(c / step).cast("int"), F.lit(nodes - 2))
        a, b = F.get(values, k), F.get(values, k + 1)
        return a + (b - a) * (c - k * step) / step

    return F.transform(F.sequence(F.lit(0), F.lit(nchan - 1)), at)


def apply_tables(rows: DataFrame, tables: list[dict], nchan: int, hands: int = 2) -> DataFrame:
    """Divide complex cells by the gains of both antennas, through a chain of tables.

    rows: antenna1, antenna2, t, arrays re, im, flags over nchan * hands cells (hand fastest), weight (one
    per hand). A table is a dict: solutions (antenna, t, hand, amp, phase, flag; amp and phase arrays over
    `nodes` channels), nodes, interp ("nearest" or "linear" in time), phase_only, weigh. Cells without a
    positive gain are flagged and stay; weights are scaled by the squared gain product's mean over
    channels where a table weighs. Solutions are small next to the data: their lists are broadcast behind
    a check of their number and searched in each row, so the data isn't moved.
    """
    cells = F.sequence(F.lit(0), F.lit(nchan - 1))
    factors: dict[int, list] = {h: [] for h in range(hands)}
    for i, spec in enumerate(tables):
        lists = _list_per_antenna(spec["solutions"])
        if spec["solutions"].count() <= BROADCAST_SOLUTIONS:
            lists = F.broadcast(lists)
        for end in (1, 2):
            rows = rows.join(lists.select(F.col("antenna").alias(f"antenna{end}"), F.col("_by").alias(f"_by{end}")), f"antenna{end}", "left")
            for h in range(hands):
                rows = rows.withColumn("_s", F.try_element_at(F.col(f"_by{end}"), F.lit(h))).withColumn("_n", _count_until(F.col("_s"), F.col("t")))
                rows = rows.withColumns({"_lo": F.get("_s", F.col("_n") - 1), "_hi": F.get("_s", F.col("_n"))})
                amp, phase = _between(F.col("_lo"), F.col("_hi"), F.col("t"), spec["interp"])
                rows = rows.withColumns({f"_a{i}{end}{h}": amp, f"_p{i}{end}{h}": phase})
                rows = rows.withColumns({c: _to_channels(F.col(c), spec["nodes"], nchan) for c in (f"_a{i}{end}{h}", f"_p{i}{end}{h}")})
            rows = rows.drop(f"_by{end}", "_s", "_n", "_lo", "_hi")
        for h in range(hands):
            factors[h].append((f"{i}1{h}", f"{i}2{h}", spec.get("phase_only", False), spec.get("weigh", True)))

    def product(h, scaled):
        def at(c):
            out = F.lit(1.0)
            for x, y, phase_only, weigh in factors[h]:
                if not phase_only and (weigh or not scaled):
                    out = out * F.get(F.col(f"_a{x}"), c) * F.get(F.col(f"_a{y}"), c)
            return out

        return F.transform(cells, at)

    def angle(h):
        return F.transform(cells, lambda c: sum((F.get(F.col(f"_p{x}"), c) - F.get(F.col(f"_p{y}"), c) for x, y, _, _ in factors[h]), F.lit(0.0)))

    def sound(h):
        return F.transform(cells, lambda c: F.forall(F.array(*[F.get(F.col(f"_a{x}"), c) for f in factors[h] for x in f[:2]]), lambda a: F.coalesce(a > 0, F.lit(False))))

    for h in range(hands):
        rows = rows.withColumns({f"_A{h}": product(h, False), f"_F{h}": angle(h), f"_ok{h}": sound(h), f"_W{h}": product(h, True)})
    pick = lambda name, i: F.get(F.array(*[F.col(f"{name}{h}") for h in range(hands)]), i % hands)
    at = lambda name, i: F.get(pick(name, i), F.floor(i / hands).cast("int"))
    good = lambda i: at("_ok", i)
    # (re + i im) / (A e^{i F})
    real = F.transform("re", lambda x, i: F.when(good(i), (x * F.cos(at("_F", i)) + F.get("im", i) * F.sin(at("_F", i))) / at("_A", i)).otherwise(x))
    imag = F.transform("im", lambda y, i: F.when(good(i), (y * F.cos(at("_F", i)) - F.get("re", i) * F.sin(at("_F", i))) / at("_A", i)).otherwise(y))
    rows = rows.withColumns({"_re": real, "_im": imag, "flags": F.transform("flags", lambda f, i: f | ~good(i))})

    def scaled_weight(w, h):
        used = F.filter(F.zip_with(pick("_W", h), pick("_ok", h), lambda x, ok: F.when(ok, x * x)), lambda x: x.isNotNull())
        return w * F.when(F.size(used) > 0, F.aggregate(used, F.lit(0.0), lambda a, x: a + x) / F.size(used)).otherwise(1.0)

    rows = rows.withColumn("weight", F.transform("weight", scaled_weight))
    kept = [c for c in rows.columns if not c.startswith("_") and c not in ("re", "im")]
    return rows.select(*kept, F.col("_re").alias("re"), F.col("_im").alias("im"))


def clear_calibration(rows: DataFrame, add_model: bool = True) -> DataFrame:
    """Corrected cells are the data again; the model, if asked for, is a unit point source."""
    rows = rows.withColumns({"corrected_re": F.col("re"), "corrected_im": F.col("im")})
    if add_model:
        rows = rows.withColumns({"model_re": F.transform("re", lambda x: F.lit(1.0)), "model_im": F.transform("im", lambda x: F.lit(0.0))})
    return rows


def adapt_table(solutions: DataFrame, own_names: DataFrame, data_names: DataFrame, spwmap: list[int] | None = None) -> DataFrame:
    """Solutions with the data's antenna numbers, matched by name; antennas that the data lack go.

    own_names, data_names: antenna, name. spwmap[i] is the table's subband for the data's subband i; a
    solution then serves every subband that maps to it.
    """
    ids = own_names.select(F.col("antenna").alias("_own"), "name").join(data_names.select("antenna", "name"), "name").select("_own", F.col("antenna").alias("_data"))
    out = solutions.join(ids, F.col("antenna") == F.col("_own")).withColumn("antenna", F.col("_data")).drop("_own", "_data")
    if spwmap is not None:
        uses = F.filter(F.sequence(F.lit(0), F.lit(len(spwmap) - 1)), lambda i: F.get(F.array(*map(F.lit, spwmap)), i) == F.col("ddid"))
        out = out.withColumn("ddid", F.explode(uses))
    return out


def solution_coverage(solutions: DataFrame) -> DataFrame:
    """Per antenna: the subbands with an unflagged solution, the unflagged share and the median snr of unflagged ones."""
    ok = ~F.col("flag")
    return solutions.groupBy("antenna").agg(
        F.array_join(F.sort_array(F.collect_set(F.when(ok, F.col("ddid")))), ",").alias("subbands"),
        F.round(F.avg(ok.cast("double")), 6).alias("solved"),
        F.round(F.median(F.when(ok, F.col("snr"))), 6).alias("median_snr"),
    )


def substitute_hand(pairs: DataFrame, keys: list[str], chosen: DataFrame, least: int = 3) -> DataFrame:
    """For the chosen keys, dst follows src times their median ratio, where at least `least` pairs are positive; other rows stay.

    pairs: keys, src, dst (null: flagged). Where src isn't positive, dst stays.
    """
    both = (F.col("src") > 0) & (F.col("dst") > 0)
    scale = pairs.join(chosen, keys, "left_semi").groupBy(*keys).agg(F.median(F.when(both, F.col("dst") / F.col("src"))).alias("_scale"), F.count(F.when(both, 1)).alias("_n"))
    scale = scale.filter(F.col("_n") >= least).drop("_n")
    out = pairs.join(scale, keys, "left")
    changed = F.coalesce(F.col("_scale").isNotNull() & (F.col("src") > 0), F.lit(False))
    return out.withColumns({"dst": F.when(changed, F.col("src") * F.col("_scale")).otherwise(F.col("dst")), "changed": changed}).drop("_scale")


def fill_fringe_gaps(rows: DataFrame, keys: list[str], time: str, order: list[str], f_ref_hz: float, n: int = 2) -> DataFrame:
    """Rebuild the unusable solutions of each series from up to n usable ones on either side.

    rows: phase, delay, rate, usable. Delay and rate: a straight line through the neighbours at the time,
    their mean if one side has none. Phase: argument of the distance-weighted phasors, each advanced by its
    own rate. Usable solutions are numbered, and a gap finds its neighbours by their numbers: one join,
    however long the gap. Without any neighbour the result is null.
    """
    w = Window.partitionBy(*keys).orderBy(*order)
    marked = rows.withColumn("_u", F.sum(F.col("usable").cast("int")).over(w))
    good = marked.filter("usable").select(*keys, F.col("_u").alias("_k"), F.col(time).alias("_t"), *[F.col(c).alias(f"_{c}") for c in ("phase", "delay", "rate")])
    gaps = marked.filter(~F.col("usable")).withColumn("_k", F.explode(F.sequence(F.col("_u") - n + 1, F.col("_u") + n)))
    near = gaps.join(good, [*keys, "_k"], "left").withColumn("_d", F.col("_t") - F.col(time))
    weight = 1 / F.greatest(F.abs("_d"), F.lit(1e-6))
    turned = F.col("_phase") - 2 * math.pi * f_ref_hz * F.col("_rate") * F.col("_d")
    sides = lambda c: F.when((F.min(F.col("_k") - F.col("_u")) <= 0) & (F.max(F.col("_k") - F.col("_u")) > 0), F.regr_intercept(c, F.col("_d"))).otherwise(F.avg(c))
    found = near.filter("_t IS NOT NULL").groupBy(*keys, time, *order).agg(
        sides(F.col("_delay")).alias("delay"), sides(F.col("_rate")).alias("rate"), F.atan2(F.sum(weight * F.sin(turned)), F.sum(weight * F.cos(turned))).alias("phase"), F.count("*").alias("n_used")
    )
    return found


def reference_with_data(rows: DataFrame, keys: list[str], chain: list[int]) -> DataFrame:
    """Per key: the first antenna of the chain that has unflagged data, null if none has."""
    ends = rows.filter(~F.col("flag")).select(*keys, F.explode(F.array("antenna1", "antenna2")).alias("_a"))
    place = F.array_position(F.array(*map(F.lit, chain)), F.col("_a"))
    first = ends.groupBy(*keys).agg(F.min(F.when(place > 0, place)).alias("_p"))
    found = rows.select(*keys).distinct().join(first, keys, "left")
    return found.select(*keys, F.get(F.array(*map(F.lit, chain)), (F.col("_p") - 1).cast("int")).alias("reference"))


def autocorrelation_levels(vis: DataFrame) -> DataFrame:
    """Gain per (scan, antenna, subband): root of the weighted mean of its unflagged autocorrelations."""
    auto = vis.filter("antenna1 = antenna2 AND NOT flag AND weight > 0")
    mean = F.sum(F.col("amp") * F.col("weight")) / F.sum("weight")
    return auto.groupBy("scan", F.col("antenna1").alias("antenna"), "ddid").agg(F.round(F.sqrt(mean), 6).alias("gain"), F.count("*").alias("n"))


def off_source_runs(samples: DataFrame, keys: list[str], order: list[str], time: str, step: float, margin: float, limit: float = 0.8, least: int = 5) -> DataFrame:
    """One command per run of off-source samples: from half a step and a margin before the first to as much after the last.

    samples: factor and n_baselines per key and time. Off: at least two baselines and a factor under the
    limit. Keys of fewer than `least` judged samples have no commands.
    """
    judged = samples.filter("n_baselines >= 2")
    w = Window.partitionBy(*keys).orderBy(*order)
    off = F.col("factor") < limit
    new = (off & ~F.coalesce(F.lag(off.cast("int")).over(w) == 1, F.lit(False))).cast("int")
    runs = judged.withColumns({"_off": off, "_n": F.count("*").over(Window.partitionBy(*keys)), "_new": new})
    runs = runs.withColumn("_run", F.sum("_new").over(w)).filter((F.col("_n") >= least) & F.col("_off"))
    return runs.groupBy(*keys, "_run").agg((F.min(time) - step / 2 - margin).alias("start"), (F.max(time) + step / 2 + margin).alias("end"), F.count("*").alias("n")).drop("_run")


NCHAN = 16


def _cells(s, d):
    e = table(s, d, "embeddings")
    k = F.col("vec_id")
    double = lambda a, b: F.transform(F.slice("embedding", a, b), lambda x: x.cast("double"))
    return e.select(
        "vec_id", (k % 5).cast("int").alias("antenna1"), (F.lit(5) + k % 3).cast("int").alias("antenna2"), (k * 60.0).alias("t"),
        double(1, 32).alias("re"), double(33, 32).alias("im"), F.transform(F.slice("embedding", 1, 32), lambda x: x > 0.3).alias("flags"), F.array(F.lit(1.0), F.lit(2.0)).alias("weight"),
    )


def _chain(s):
    a, k, h = (F.floor(F.col("id") / 14)).cast("int"), F.floor(F.col("id") / 2) % 7, (F.col("id") % 2).cast("int")
    gains = s.range(8 * 14).select(a.alias("antenna"), (k * 5000.0).alias("t"), h.alias("hand"), F.array(1 + (a * 3 + k * 5 + h) % 7 / 10.0).alias("amp"), F.array((a * 11 + k * 13 + h * 5) % 60 / 10.0 - 3.0).alias("phase"), ((a + k + h) % 9 == 4).alias("flag"))
    a, h = F.floor(F.col("id") / 2).cast("int"), (F.col("id") % 2).cast("int")
    nodes = F.sequence(F.lit(0), F.lit(3))
    band = s.range(16).select(
        a.alias("antenna"), F.lit(0.0).alias("t"), h.alias("hand"), F.transform(nodes, lambda c: F.when((a == 6) & (c == 3), 0.0).otherwise(1 + (a + c * 2 + h) % 5 / 20.0)).alias("amp"),
        F.transform(nodes, lambda c: (a * c + h) % 20 / 10.0 - 1.0).alias("phase"), F.lit(False).alias("flag"),
    )
    return [{"solutions": gains, "nodes": 1, "interp": "linear"}, {"solutions": band, "nodes": 4, "interp": "nearest", "weigh": False}, {"solutions": gains, "nodes": 1, "interp": "nearest", "phase_only": True}]


def _applied(s, d):
    out = apply_tables(_cells(s, d), _chain(s), NCHAN)
    ok = lambda c: F.filter(F.zip_with(c, "flags", lambda x, f: F.when(~f, x)), lambda x: x.isNotNull())
    total = lambda c: F.aggregate(ok(c), F.lit(0.0), lambda a, x: a + x)
    return out.select("vec_id", F.round(total("re"), 6).alias("re"), F.round(total("im"), 6).alias("im"), F.round(F.get("weight", F.lit(0)) + F.get("weight", F.lit(1)), 6).alias("weight"), F.size(F.filter("flags", lambda f: f)).cast("long").alias("n_flagged"))


def _cleared(s, d):
    out = clear_calibration(_cells(s, d))
    total = lambda c: F.round(F.aggregate(F.col(c), F.lit(0.0), lambda a, x: a + x), 6).alias(c)
    return out.select("vec_id", total("corrected_re"), total("corrected_im"), total("model_re"), total("model_im"))


def _solutions(s, d):
    return visibilities(s, d).select(F.col("antenna1").alias("antenna"), "ddid", "flag", (F.col("amp") / 1000).alias("snr"))


def _adapted(s, d):
    n = table(s, d, "nation")
    own = n.select(F.col("n_nationkey").alias("antenna"), F.col("n_name").alias("name"))
    data = n.filter("n_nationkey % 5 <> 3").select((F.col("n_nationkey") * 7 % 25).alias("antenna"), F.col("n_name").alias("name"))
    solutions = table(s, d, "supplier").select(F.col("s_suppkey").alias("id"), F.col("s_nationkey").alias("antenna"), (F.col("s_suppkey") % 4).cast("int").alias("ddid"))
    return adapt_table(solutions, own, data, [0, 1, 1, 3, 3]).select("id", "antenna", "ddid")


def _substituted(s, d):
    p = series(s, d).select("event_id", "user_id", F.when(F.col("event_id") % 6 != 0, F.col("value")).alias("src"), F.when(F.col("event_id") % 7 != 0, F.col("value") * (1 + F.col("event_id") % 5 / 10)).alias("dst"))
    out = substitute_hand(p, ["user_id"], p.filter("user_id % 4 = 0").select("user_id").distinct())
    return out.select("event_id", F.round("dst", 6).alias("dst"), "changed")


def _filled(s, d):
    v = F.col("value")
    e = series(s, d).select("user_id", "event_id", "us", "t", (v % 6 - 3).alias("phase"), (v / 10).alias("delay"), (v % 7 / 1e6).alias("rate"), (v % 10 >= 3).alias("usable"))
    out = fill_fringe_gaps(e, ["user_id"], "t", ["us", "event_id"], 1.0)
    return out.select("event_id", F.round("delay", 6).alias("delay"), F.round(F.col("rate") * 1e6, 6).alias("rate_e6"), F.round(F.cos("phase"), 5).alias("cos_phase"), F.round(F.sin("phase"), 5).alias("sin_phase"), "n_used")


def _off(s, d):
    e = series(s, d).select("user_id", "us", "event_id", "t", (F.col("value") / 50).alias("factor"), (F.col("event_id") % 5).alias("n_baselines"))
    out = off_source_runs(e, ["user_id"], ["us", "event_id"], "t", 10.0, 2.0)
    return out.select("user_id", F.round("start", 3).alias("start"), F.round("end", 3).alias("end"), "n")


QUERIES = {
    "apply_complex_chain": _applied,
    "clear_calibration": _cleared,
    "adapt_table": _adapted,
    "solution_coverage": lambda s, d: solution_coverage(_solutions(s, d)),
    "substitute_hand": _substituted,
    "fill_fringe_gaps": _filled,
    "reference_with_data": lambda s, d: reference_with_data(visibilities(s, d).filter("antenna1 <> antenna2 AND ddid = 1"), ["day"], [5, 2, 7, 0]),
    "autocorrelation_levels": lambda s, d: autocorrelation_levels(visibilities(s, d)),
    "off_source_runs": _off,
}
_TURN = "(p1 - p0 - 2 * pi() * ceil((p1 - p0 - pi()) / (2 * pi())))"
SQL = {
    "apply_complex_chain": f"""WITH v AS (SELECT vec_id, CAST(vec_id % 5 AS INT) AS antenna1, CAST(5 + vec_id % 3 AS INT) AS antenna2, vec_id * 60.0::DOUBLE AS t, embedding FROM embeddings),
      cell AS (SELECT vec_id, antenna1, antenna2, t, i // 2 AS c, i % 2 AS hand, CAST(embedding[i + 1] AS DOUBLE) AS re, CAST(embedding[i + 33] AS DOUBLE) AS im, embedding[i + 1] > 0.3 AS flag FROM (SELECT *, unnest(range(32)) AS i FROM v)),
      sol AS (SELECT id // 14 AS antenna, id // 2 % 7 * 5000.0::DOUBLE AS t, id % 2 AS hand, 1 + (id // 14 * 3 + id // 2 % 7 * 5 + id % 2) % 7 / 10.0::DOUBLE AS amp, (id // 14 * 11 + id // 2 % 7 * 13 + id % 2 * 5) % 60 / 10.0::DOUBLE - 3.0 AS phase
        FROM range(112) r(id) WHERE (id // 14 + id // 2 % 7 + id % 2) % 9 <> 4),
      probe AS (SELECT DISTINCT t, a AS antenna, h AS hand FROM (SELECT t, unnest([antenna1, antenna2]) AS a FROM v) x, (SELECT unnest([0, 1]) AS h) y),
      br AS (SELECT p.*, (SELECT max(s.t) FROM sol s WHERE s.antenna = p.antenna AND s.hand = p.hand AND s.t <= p.t) AS t0, (SELECT min(s.t) FROM sol s WHERE s.antenna = p.antenna AND s.hand = p.hand AND s.t > p.t) AS t1 FROM probe p),
      bv AS (SELECT br.*, a.amp AS a0, b.amp AS a1, a.phase AS p0, b.phase AS p1, (br.t - t0) / (t1 - t0) AS w FROM br LEFT JOIN sol a ON a.antenna = br.antenna AND a.hand = br.hand AND a.t = t0 LEFT JOIN sol b ON b.antenna = br.antenna AND b.hand = br.hand AND b.t = t1),
      g AS (SELECT t, antenna, hand, CASE WHEN t0 IS NULL THEN a1 WHEN t1 IS NULL THEN a0 ELSE a0 + w * (a1 - a0) END AS amp, CASE WHEN t0 IS NULL THEN p1 WHEN t1 IS NULL THEN p0 ELSE p0 + w * {_TURN} END AS phase,
        CASE WHEN t1 IS NULL OR t - t0 <= t1 - t THEN coalesce(p0, p1) ELSE coalesce(p1, p0) END AS near FROM bv),
      node AS (SELECT a AS antenna, h AS hand, n, CASE WHEN a = 6 AND n = 3 THEN 0.0 ELSE 1 + (a + n * 2 + h) % 5 / 20.0::DOUBLE END AS amp, (a * n + h) % 20 / 10.0::DOUBLE - 1.0 AS phase FROM range(8) x(a), range(2) y(h), range(4) z(n)),
      band AS (SELECT l.antenna, l.hand, c, l.amp + (u.amp - l.amp) * (c - l.n * 5.0) / 5.0 AS amp, l.phase + (u.phase - l.phase) * (c - l.n * 5.0) / 5.0 AS phase FROM range(16) x(c) JOIN node l ON l.n = least(c // 5, 2) JOIN node u ON u.antenna = l.antenna AND u.hand = l.hand AND u.n = l.n + 1),
      j AS (SELECT cell.*, coalesce(g1.amp > 0 AND g2.amp > 0 AND b1.amp > 0 AND b2.amp > 0, false) AS ok, g1.amp * g2.amp AS w, g1.amp * g2.amp * b1.amp * b2.amp AS a, g1.phase - g2.phase + b1.phase - b2.phase + g1.near - g2.near AS f
        FROM cell LEFT JOIN g g1 ON g1.t = cell.t AND g1.antenna = antenna1 AND g1.hand = cell.hand LEFT JOIN g g2 ON g2.t = cell.t AND g2.antenna = antenna2 AND g2.hand = cell.hand
        LEFT JOIN band b1 ON b1.antenna = antenna1 AND b1.hand = cell.hand AND b1.c = cell.c LEFT JOIN band b2 ON b2.antenna = antenna2 AND b2.hand = cell.hand AND b2.c = cell.c),
      wt AS (SELECT vec_id, sum(x) AS weight FROM (SELECT vec_id, hand, (hand + 1) * coalesce(avg(w * w) FILTER (ok), 1.0) AS x FROM j GROUP BY vec_id, hand) GROUP BY vec_id)
      SELECT vec_id, coalesce(round(sum((re * cos(f) + im * sin(f)) / a) FILTER (ok AND NOT flag), 6), 0.0) AS re, coalesce(round(sum((im * cos(f) - re * sin(f)) / a) FILTER (ok AND NOT flag), 6), 0.0) AS im, round(any_value(weight), 6) AS weight,
        count(*) FILTER (flag OR NOT ok) AS n_flagged FROM j JOIN wt USING (vec_id) GROUP BY vec_id""",
    "clear_calibration": "SELECT vec_id, round(list_sum(list_transform(embedding[1:32], lambda x: x::DOUBLE)), 6) AS corrected_re, round(list_sum(list_transform(embedding[33:64], lambda x: x::DOUBLE)), 6) AS corrected_im, 32.0::DOUBLE AS model_re, 0.0::DOUBLE AS model_im FROM embeddings",
    "adapt_table": """WITH m AS (SELECT unnest([0, 1, 2, 3, 4]) AS ddid, unnest([0, 1, 1, 3, 3]) AS spw)
      SELECT s_suppkey AS id, n_nationkey * 7 % 25 AS antenna, m.ddid::INT AS ddid FROM supplier JOIN nation ON n_nationkey = s_nationkey JOIN m ON m.spw = s_suppkey % 4 WHERE n_nationkey % 5 <> 3""",
    "solution_coverage": f"""WITH {VIS} SELECT antenna1 AS antenna, array_to_string(list_sort(list(DISTINCT ddid) FILTER (NOT flag)), ',') AS subbands, round(avg((NOT flag)::INT::DOUBLE), 6) AS solved, round(median(amp / 1000) FILTER (NOT flag), 6) AS median_snr FROM vis GROUP BY antenna1""",
    "substitute_hand": """WITH p AS (SELECT event_id, user_id, CASE WHEN event_id % 6 <> 0 THEN value END AS src, CASE WHEN event_id % 7 <> 0 THEN value * (1 + event_id % 5 / 10.0::DOUBLE) END AS dst FROM events),
      k AS (SELECT user_id, median(dst / src) FILTER (src > 0 AND dst > 0) AS scale FROM p WHERE user_id % 4 = 0 GROUP BY user_id HAVING count(*) FILTER (src > 0 AND dst > 0) >= 3)
      SELECT event_id, round(CASE WHEN scale IS NOT NULL AND src > 0 THEN src * scale ELSE dst END, 6) AS dst, coalesce(scale IS NOT NULL AND src > 0, false) AS changed FROM p LEFT JOIN k USING (user_id)""",
    "fill_fringe_gaps": f"""WITH {SERIES}, x AS (SELECT user_id, event_id, us, t, value % 6 - 3 AS phase, value / 10 AS delay, value % 7 / 1e6 AS rate, value % 10 >= 3 AS usable FROM ev),
      m AS (SELECT *, sum(usable::INT) OVER (PARTITION BY user_id ORDER BY us, event_id) AS u FROM x),
      n AS (SELECT g.event_id, h.t - g.t AS d, h.u - g.u AS side, h.delay, h.rate, h.phase - 2 * pi() * h.rate * (h.t - g.t) AS p, 1 / greatest(abs(h.t - g.t), 1e-6) AS w FROM m g JOIN m h ON h.user_id = g.user_id AND h.usable AND h.u BETWEEN g.u - 1 AND g.u + 2 WHERE NOT g.usable),
      o AS (SELECT event_id, min(side) <= 0 AND max(side) > 0 AS two, regr_intercept(delay, d) AS d1, avg(delay) AS d2, regr_intercept(rate, d) AS r1, avg(rate) AS r2, atan2(sum(w * sin(p)), sum(w * cos(p))) AS a, count(*) AS n_used FROM n GROUP BY event_id)
      SELECT event_id, round(CASE WHEN two THEN d1 ELSE d2 END, 6) AS delay, round(CASE WHEN two THEN r1 ELSE r2 END * 1e6, 6) AS rate_e6, round(cos(a), 5) AS cos_phase, round(sin(a), 5) AS sin_phase, n_used FROM o""",
    "reference_with_data": f"""WITH {VIS}, x AS (SELECT * FROM vis WHERE antenna1 <> antenna2 AND ddid = 1), e AS (SELECT day, unnest([antenna1, antenna2]) AS a FROM x WHERE NOT flag), p AS (SELECT day, min(list_position([5, 2, 7, 0], a)) AS p FROM e GROUP BY day)
      SELECT day, [5, 2, 7, 0][p]::INT AS reference FROM (SELECT DISTINCT day FROM x) LEFT JOIN p USING (day)""",
    "autocorrelation_levels": f"WITH {VIS} SELECT scan, antenna1 AS antenna, ddid, round(sqrt(sum(amp * weight) / sum(weight)), 6) AS gain, count(*) AS n FROM vis WHERE antenna1 = antenna2 AND NOT flag AND weight > 0 GROUP BY ALL",
    "off_source_runs": f"""WITH {SERIES}, j AS (SELECT user_id, us, event_id, t, value / 50 < 0.8 AS off, count(*) OVER (PARTITION BY user_id) AS k FROM ev WHERE event_id % 5 >= 2),
      r AS (SELECT *, sum((off AND NOT coalesce(p, false))::INT) OVER (PARTITION BY user_id ORDER BY us, event_id) AS run FROM (SELECT *, lag(off) OVER (PARTITION BY user_id ORDER BY us, event_id) AS p FROM j))
      SELECT user_id, round(min(t) - 7.0, 3) AS start, round(max(t) + 7.0, 3) AS "end", count(*) AS n FROM r WHERE k >= 5 AND off GROUP BY user_id, run""",
}
