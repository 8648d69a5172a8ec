"""Outliers traced to the antenna that is common to most of them.

Cells of baselines are judged against their series' running median. In each moment the antenna that explains most bad
baselines takes them, then the next, until none explains enough: those that are left stay flags of baselines.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..plans.model import table

#: Bins of one moment's other keys (field, subband, block, hand) that share a task's group.
TOGETHER = 256


def departures(cells: DataFrame, series: list[str], bin_: str, value: str, half: int = 7, threshold: float = 5.0, weak: float = 3.0, least: int = 5, floor: float = 0.0) -> DataFrame:
    """Add strong and weak: whether a cell departs from the running median of its series by so many robust sigmas (and by the floor).

    The running median takes `half` bins on either side. Series of fewer than `least` cells, or without scatter, aren't judged.
    """
    w = Window.partitionBy(*series)
    trend = F.percentile(F.col(value), 0.5).over(w.orderBy(bin_).rowsBetween(-half, half))
    r = cells.withColumn("_r", F.col(value) - trend)
    r = r.withColumns({"_s": 1.4826 * F.median(F.abs("_r")).over(w), "_n": F.count("_r").over(w)})
    beyond = lambda k: F.coalesce((F.col("_n") >= least) & (F.col("_s") > 0) & (F.round(F.abs("_r"), 9) > F.round(F.greatest(k * F.col("_s"), F.lit(floor)), 9)), F.lit(False))
    return r.withColumns({"strong": beyond(threshold), "weak": beyond(weak)}).drop("_r", "_s", "_n")


def greedy(bad: np.ndarray, has: np.ndarray, least: int = 2, share: float = 0.5) -> tuple[np.ndarray, np.ndarray]:
    """Antennas to blame (moment, antenna) and bad baselines that none explains (moment, antenna, antenna), of many moments at once.

    bad and has are symmetric. The antenna of most bad baselines (the least on ties) is blamed if they are at least `least` and `share`
    of those it has that aren't explained yet; then its baselines count no more.
    """
    bad, has = bad.copy(), has.copy()
    blamed = np.zeros(bad.shape[:2], bool)
    at = np.arange(len(bad))
    for _ in range(bad.shape[1]):
        n, of = bad.sum(axis=2), has.sum(axis=2)
        worst = n.argmax(axis=1)
        go = (n[at, worst] >= least) & (n[at, worst] >= share * of[at, worst])
        if not go.any():
            break
        k, a = at[go], worst[go]
        blamed[k, a] = True
        for x in (bad, has):
            x[k, a] = False
            x[k, :, a] = False
    return blamed, bad


def blame(cells: DataFrame, moment: list[str], bin_: str, flag: str, antennas: int, least: int = 2, share: float = 0.5) -> DataFrame:
    """(moment, bin, antenna, other): blamed antennas (other null), and bad baselines that are left (antenna < other).

    cells: one row per baseline, moment and bin with data. TOGETHER bins of a moment's other keys are one group, of at most as many
    cells as bins times baselines.
    """
    kinds = dict(cells.dtypes)
    schema = ", ".join(f"`{c}` {kinds[c]}" for c in [*moment, bin_]) + ", antenna int, other int"

    def solve(pdf: pd.DataFrame) -> pd.DataFrame:
        bins, at = np.unique(pdf[bin_].to_numpy(), return_inverse=True)
        bad, has = (np.zeros((len(bins), antennas, antennas), bool) for _ in range(2))
        a, b, f = pdf["antenna1"].to_numpy(), pdf["antenna2"].to_numpy(), pdf[flag].to_numpy(bool)
        has[at, a, b] = has[at, b, a] = True
        bad[at[f], a[f], b[f]] = bad[at[f], b[f], a[f]] = True
        found, left = greedy(bad, has, least, share)
        i, k = np.nonzero(found)
        j, x, y = np.nonzero(np.triu(left))
        out = pd.DataFrame({bin_: np.concatenate([bins[i], bins[j]]), "antenna": np.concatenate([k, x]).astype(np.int32), "other": pd.array([None] * len(k) + y.tolist(), dtype="Int32")})
        for i, c in enumerate(moment):
            out.insert(i, c, [pdf[c].iloc[0]] * len(out))
        return out

    chunk = F.floor(F.col(bin_) / TOGETHER)
    marked = cells.select(*moment, bin_, "antenna1", "antenna2", flag)
    return marked.groupBy(*moment, chunk).applyInPandas(solve, schema)


def grown(strong: DataFrame, weak: DataFrame, keys: list[str], bin_: str) -> DataFrame:
    """The rising and falling edges too: bins blamed at the weak limit that are next to each other and to one at the strong limit."""
    marked = weak.select(*keys, bin_, F.lit(0).alias("_strong")).unionByName(strong.select(*keys, bin_, F.lit(1).alias("_strong")))
    marked = marked.groupBy(*keys, bin_).agg(F.max("_strong").alias("_strong"))
    w = Window.partitionBy(*keys).orderBy(bin_)
    new = F.coalesce((F.col(bin_) - F.lag(bin_).over(w) != 1).cast("int"), F.lit(1))
    isles = marked.withColumn("_isle", F.sum(new).over(w))
    return isles.withColumn("_any", F.max("_strong").over(Window.partitionBy(*keys, "_isle"))).filter("_any = 1").select(*keys, bin_)


def lost_scans(cells: DataFrame, blamed: DataFrame, keys: list[str], scan: str, fraction: float = 0.9) -> DataFrame:
    """(keys, scan, antenna) whose antenna is blamed in at least `fraction` of the cells it has in the scan.

    cells: keys, scan, bin, antenna, distinct; blamed the same columns.
    """
    of = cells.join(blamed.withColumn("_hit", F.lit(1)), blamed.columns, "left")
    g = of.groupBy(*keys, scan, "antenna").agg(F.count("*").alias("_n"), F.count("_hit").alias("_hit"))
    return g.filter(F.col("_hit") >= fraction * F.col("_n")).select(*keys, scan, "antenna")


def scans_between(scans: DataFrame, lost: DataFrame) -> DataFrame:
    """(antenna, scan): target scans between the calibrator scans around one that the antenna lost.

    scans: scan, calibrator (itself, or the one that serves a target), role ("calibrator", "target"), t_min. Each target scan finds its
    calibrator's last scan before and first after it; windows run per calibrator.
    """
    w = Window.partitionBy("calibrator").orderBy("t_min")
    own = F.when(F.col("role") == "calibrator", F.col("scan"))
    around = scans.withColumns({"_b": F.last(own, True).over(w.rowsBetween(Window.unboundedPreceding, -1)), "_a": F.first(own, True).over(w.rowsBetween(1, Window.unboundedFollowing))})
    near = around.filter("role = 'target'").select("scan", F.explode(F.array("_b", "_a")).alias("_near"))
    return near.join(lost.select("antenna", F.col("scan").alias("_near")), "_near").select("antenna", "scan").distinct()


ANTENNAS = 8
#: Planted: antenna 3 falls away in bins 4 to 6 of each 16, antenna 1 bursts in bins 10 and 11; in bins 12, both do.
_LOST, _BURST = "bin % 16 BETWEEN 4 AND 6 OR bin % 16 = 12", "bin % 16 IN (10, 11, 12)"


def _grid(s, d) -> DataFrame:
    """Mean log amplitude per baseline, hand and bin with planted faults."""
    v = table(s, d, "lineitem").select(
        F.least(F.col("l_suppkey") % 8, F.col("l_partkey") % 8).cast("int").alias("antenna1"), F.greatest(F.col("l_suppkey") % 8, F.col("l_partkey") % 8).cast("int").alias("antenna2"), (F.col("l_linenumber") % 2).cast("int").alias("hand"),
        F.floor(F.datediff(F.col("l_shipdate").cast("date"), F.lit("1992-01-01").cast("date")) / 20).cast("int").alias("bin"),
    ).filter("antenna1 <> antenna2")
    g = v.groupBy("hand", "antenna1", "antenna2", "bin").agg(F.count("*").alias("n"))
    on = lambda k: f"(antenna1 = {k} OR antenna2 = {k})"
    fault = F.expr(f"CASE WHEN ({_LOST}) AND {on(3)} THEN -3.0D ELSE 0.0D END + CASE WHEN {_BURST} AND {on(1)} THEN 1.5D ELSE 0.0D END")
    quiet = F.expr("((antenna1 * 7 + antenna2 * 3 + bin * 5 + hand) % 11 - 5) / 50.0D + bin / 200.0D")
    return g.withColumn("value", quiet + fault)


def _blamed(s, d):
    cells = departures(_grid(s, d), ["hand", "antenna1", "antenna2"], "bin", "value")
    return blame(cells, ["hand"], "bin", "strong", ANTENNAS)


def _extended(s, d):
    cells = departures(_grid(s, d), ["hand", "antenna1", "antenna2"], "bin", "value")
    both = [blame(cells, ["hand"], "bin", f, ANTENNAS).filter("other IS NULL").select("hand", "bin", "antenna") for f in ("strong", "weak")]
    hit = grown(*both, ["hand", "antenna"], "bin")
    at = F.floor(F.col("bin") / 3).cast("int").alias("scan")
    ends = cells.select("hand", at, "bin", F.explode(F.array("antenna1", "antenna2")).alias("antenna")).distinct()
    lost = lost_scans(ends, hit.select("hand", at, "bin", "antenna"), ["hand"], "scan")
    scans = ends.select("scan").distinct().select("scan", F.lit(0).alias("calibrator"), F.when(F.col("scan") % 2 == 0, "calibrator").otherwise("target").alias("role"), F.col("scan").alias("t_min"))
    return scans_between(scans, lost.filter("hand = 0 AND scan % 2 = 0"))


QUERIES = {"antenna_blame": _blamed, "blame_next_scans": _extended}
_CELLS = f"""WITH l AS (SELECT CAST(l_linenumber % 2 AS INT) AS hand, CAST(least(l_suppkey % 8, l_partkey % 8) AS INT) AS a, CAST(greatest(l_suppkey % 8, l_partkey % 8) AS INT) AS b, CAST(floor(date_diff('day', DATE '1992-01-01', CAST(l_shipdate AS DATE)) / 20.0) AS INT) AS bin FROM lineitem),
  g AS (SELECT hand, a, b, bin, ((a * 7 + b * 3 + bin * 5 + hand) % 11 - 5) / 50.0::DOUBLE + bin / 200.0::DOUBLE + (CASE WHEN ({_LOST}) AND 3 IN (a, b) THEN -3.0::DOUBLE ELSE 0.0::DOUBLE END + CASE WHEN {_BURST} AND 1 IN (a, b) THEN 1.5::DOUBLE ELSE 0.0::DOUBLE END) AS v FROM l WHERE a <> b GROUP BY hand, a, b, bin),
  t AS (SELECT *, v - median(v) OVER (PARTITION BY hand, a, b ORDER BY bin ROWS BETWEEN 7 PRECEDING AND 7 FOLLOWING) AS r FROM g),
  m AS (SELECT *, 1.4826 * median(abs(r)) OVER w AS s, count(*) OVER w AS n FROM t WINDOW w AS (PARTITION BY hand, a, b)),
  j AS MATERIALIZED (SELECT hand, a, b, bin, n >= 5 AND s > 0 AND round(abs(r), 9) > round(5.0 * s, 9) AS strong, n >= 5 AND s > 0 AND round(abs(r), 9) > round(3.0 * s, 9) AS weak FROM m)"""


def _rounds(of: str, name: str, n: int) -> str:
    """The greedy choice written out: each round takes the worst antenna of every moment and drops its baselines."""
    out = f", {name}0 AS MATERIALIZED (SELECT hand, a, b, bin, {of} AS bad FROM j)"
    for i in range(1, n + 1):
        out += f""", {name}e{i} AS (SELECT hand, bin, unnest([a, b]) AS antenna, bad FROM {name}{i - 1}), {name}c{i} AS (SELECT hand, bin, antenna, count(*) FILTER (bad) AS k, count(*) AS n FROM {name}e{i} GROUP BY ALL),
          {name}w{i} AS MATERIALIZED (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY hand, bin ORDER BY k DESC, antenna) AS o FROM {name}c{i}) WHERE o = 1 AND k >= 2 AND k >= 0.5 * n),
          {name}{i} AS MATERIALIZED (SELECT x.* FROM {name}{i - 1} x LEFT JOIN {name}w{i} w ON w.hand = x.hand AND w.bin = x.bin WHERE w.antenna IS NULL OR (w.antenna <> x.a AND w.antenna <> x.b))"""
    return out + f", {name} AS (" + " UNION ALL ".join(f"SELECT hand, bin, antenna FROM {name}w{i}" for i in range(1, n + 1)) + ")"


SQL = {
    "antenna_blame": _CELLS + _rounds("strong", "x", 5) + " SELECT hand, bin, antenna, CAST(NULL AS INT) AS other FROM x UNION ALL SELECT hand, bin, a, b FROM x5 WHERE bad",
    "blame_next_scans": _CELLS
    + _rounds("strong", "x", 5)
    + _rounds("weak", "y", 5)
    + """, u AS (SELECT hand, antenna, bin, max(strong) AS strong FROM (SELECT *, 1 AS strong FROM x UNION ALL SELECT *, 0 FROM y) GROUP BY ALL),
      i AS (SELECT *, bin - row_number() OVER (PARTITION BY hand, antenna ORDER BY bin) AS isle FROM u), h AS (SELECT hand, antenna, bin FROM (SELECT *, max(strong) OVER (PARTITION BY hand, antenna, isle) AS hit FROM i) WHERE hit = 1),
      e AS (SELECT DISTINCT hand, bin // 3 AS scan, bin, unnest([a, b]) AS antenna FROM j), lo AS (SELECT e.scan, e.antenna FROM e LEFT JOIN h ON h.hand = e.hand AND h.bin = e.bin AND h.antenna = e.antenna WHERE e.hand = 0 GROUP BY e.scan, e.antenna HAVING count(h.bin) >= 0.9 * count(*)),
      s AS (SELECT DISTINCT scan FROM e), ar AS (SELECT scan, (SELECT max(q.scan) FROM s q WHERE q.scan < s.scan AND q.scan % 2 = 0) AS before, (SELECT min(q.scan) FROM s q WHERE q.scan > s.scan AND q.scan % 2 = 0) AS after FROM s WHERE scan % 2 = 1)
      SELECT DISTINCT lo.antenna, CAST(ar.scan AS INT) AS scan FROM ar JOIN lo ON lo.scan % 2 = 0 AND (lo.scan = ar.before OR lo.scan = ar.after)""",
}
