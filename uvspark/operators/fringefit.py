"""Fringe fits of solution intervals: sums in Spark, a search per baseline, a global fit per interval, and a second pass about what earlier solutions predict."""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..plans.model import table
from .asof import predict_from_previous
from .ranks import pinned
from .solve import REFERENCE_SNR, fringe_peak

# Least signal-to-noise of a solution that predicts, the number of solutions it takes, and the window about a prediction.
PREDICTING_SNR, PREVIOUS, WINDOW = 10.0, 3, (2e-9, 1e-12)
SOLUTIONS = "time double, reference int, antenna int, phase double, delay double, rate double, snr double, flag boolean, from_prior boolean"
COLUMNS = [c.split()[0] for c in SOLUTIONS.split(", ")]


def interval_sums(rows: DataFrame, keys: list[str], solint: float, nchan: int) -> DataFrame:
    """Weighted sums per key, solution interval, baseline and time; `re` and `im` (arrays by channel) are of unflagged cells.

    Intervals of solint seconds start at the first time of each key (null solint: one; 0: every time its own).
    Empty intervals give no rows. Flagged cells and autocorrelations are left out; null or NaN cells too.
    """
    first = rows.groupBy(*keys).agg(F.min("time").alias("_first"))
    if solint is None:
        at = F.lit(0).cast("long")
    elif solint <= 0:
        at = F.bround(F.col("time") * 1000).cast("long")
    else:
        at = F.floor((F.col("time") - F.col("_first")) / solint).cast("long")
    on = [F.col(f"r.{k}").eqNullSafe(F.col(f"f.{k}")) for k in keys]
    # One row per key is sent to the rows: a join dealt by keys would bring all rows of a key to one task.
    placed = rows.alias("r").join(F.broadcast(first).alias("f"), on).select("r.*", at.alias("interval"))

    # One row per cell: any number of channels is a number of rows, not of expressions.
    cells = placed.filter("antenna1 <> antenna2 AND weight > 0").select(*keys, "interval", "time", "antenna1", "antenna2", "weight", F.posexplode(F.arrays_zip("re", "im", "flag")).alias("_c", "_v"))
    good = F.coalesce(~F.col("_v.flag") & ~F.isnan("_v.re") & ~F.isnan("_v.im"), F.lit(False))
    w = F.when(good, F.col("weight"))
    row = [*keys, "interval", "time", "antenna1", "antenna2"]
    each = cells.groupBy(*row, "_c").agg(*[F.coalesce(F.sum(x), F.lit(0.0)).alias(n) for n, x in (("re", w * F.col("_v.re")), ("im", w * F.col("_v.im")), ("w", w))])
    listed = each.groupBy(*row).agg(F.array_sort(F.collect_list(F.struct("_c", "re", "im", "w"))).alias("_l"))
    return listed.select(*row, *[F.col("_l").getField(n).alias(n) for n in ("re", "im", "w")])


def near_peak(vis: np.ndarray, weight: np.ndarray, dt: float, df: float, about: tuple[float, float], window: tuple[float, float]) -> tuple[float, float, float]:
    """Delay, rate and phase at the highest point of the window about a (delay, rate)."""
    unit = np.exp(1j * np.angle(vis)) * weight
    t, f = np.arange(vis.shape[0]) * dt, np.arange(vis.shape[1]) * df
    (delay, rate), (step_d, step_r) = about, window
    for _ in range(10):
        rates = np.clip(rate + step_r * np.linspace(-1, 1, 17), about[1] - window[1], about[1] + window[1])
        delays = np.clip(delay + step_d * np.linspace(-1, 1, 17), about[0] - window[0], about[0] + window[0])
        z = np.exp(-2j * np.pi * np.outer(rates, t)) @ unit @ np.exp(-2j * np.pi * np.outer(f, delays))
        i, j = np.unravel_index(np.abs(z).argmax(), z.shape)
        rate, delay, step_r, step_d = rates[i], delays[j], step_r / 4, step_d / 4
    return delay, rate, float(np.angle(z[i, j]))


def global_fit(x: np.ndarray, z: np.ndarray, a: np.ndarray, b: np.ndarray, t: np.ndarray, f: np.ndarray, free: np.ndarray, most: int = 50) -> np.ndarray:
    """(phase, delay, rate) per antenna that bring the phases of all baselines' cells z nearest to x[a] - x[b], by damped Gauss-Newton steps.

    z has a row per baseline and time t, a column per frequency f; only antennas marked free move.
    """
    basis = np.stack([np.ones(z.shape), np.broadcast_to(2 * np.pi * f, z.shape), np.broadcast_to(2 * np.pi * t[:, None], z.shape)])
    strength, n = np.abs(z), len(x)
    scale = np.maximum(np.sqrt((basis**2 * strength).sum((1, 2)) / max(strength.sum(), 1e-300)), 1e-300)
    basis = basis / scale[:, None, None]
    moments = np.einsum("prc,qrc,rc->rpq", basis, basis, strength)
    normal = np.zeros((n, n, 3, 3))
    for i, j, sign in ((a, a, 1), (b, b, 1), (a, b, -1), (b, a, -1)):
        np.add.at(normal, (i, j), sign * moments)
    normal = normal.transpose(0, 2, 1, 3).reshape(3 * n, 3 * n)
    cells = np.flatnonzero(np.repeat(free, 3))
    normal = normal[np.ix_(cells, cells)]
    y, damp, known = x * scale, 1e-3, None

    def off(y):
        d = y[a] - y[b]
        turned = z * np.exp(-1j * np.einsum("rp,prc->rc", d, basis))
        return turned, (strength - turned.real).sum()

    turned, cost = off(y)
    for _ in range(most):
        if known is None:
            part = np.einsum("prc,rc->rp", basis, turned.imag)
            slope = np.zeros((n, 3))
            np.add.at(slope, a, part)
            np.add.at(slope, b, -part)
            known = slope.reshape(-1)[cells]
        step = np.linalg.lstsq(normal + damp * np.diag(np.diag(normal)), known, rcond=1e-12)[0]
        new = y.copy()
        new.reshape(-1)[cells] += step
        after, new_cost = off(new)
        if new_cost <= cost:
            done = np.abs(step).max(initial=0.0) < 1e-12
            y, turned, cost, damp, known = new, after, new_cost, damp / 10, None
            if done:
                break
        elif damp > 1e6:
            break
        else:
            damp *= 10
    return y / scale


def solve_interval(pdf: pd.DataFrame, antennas: int, chain: list[int], width: float, min_snr: float, priors: dict | None = None, window: tuple[float, float] = WINDOW) -> pd.DataFrame:
    """Solutions of one interval (rows of interval_sums): the first antenna of the chain with data is the reference; no rows without one.

    An antenna is searched on a baseline to one that already has a solution, the reference first; priors
    (antenna: (delay, rate)) restrict its search. Phases are at the middle of the band and the mid-time.
    """
    pdf = pdf.sort_values(["antenna1", "antenna2", "time"])
    re, im, w = (np.stack(pdf[c].to_numpy()).astype(float) for c in ("re", "im", "w"))
    has = w.sum(1) > 0
    pdf, z, w = pdf[has], (re + 1j * im)[has], w[has]
    a, b, time = pdf["antenna1"].to_numpy(), pdf["antenna2"].to_numpy(), pdf["time"].to_numpy()
    seen = set(a) | set(b)
    reference = next((i for i in chain if i in seen), None)
    if reference is None:
        return pd.DataFrame(columns=COLUMNS)
    times = np.unique(time)
    dt = float(np.diff(times).min()) if len(times) > 1 else 1.0
    at = np.rint((time - times[0]) / dt).astype(int)
    mid, middle = (times[0] + times[-1]) / 2, (w.shape[1] - 1) / 2 * width
    f = np.arange(w.shape[1]) * width - middle
    x, snr, by_prior = np.zeros((antennas, 3)), np.zeros(antennas), np.zeros(antennas, bool)
    solved, front = {reference}, [reference]
    snr[reference] = REFERENCE_SNR
    while front:
        i = front.pop(0)
        for k in sorted(seen - solved):
            on = ((a == k) & (b == i)) | ((a == i) & (b == k))
            if not on.any():
                continue
            cube, weight = np.zeros((at[on].max() + 1, w.shape[1]), complex), np.zeros((at[on].max() + 1, w.shape[1]))
            np.add.at(cube, at[on], np.where((a[on] == k)[:, None], z[on], z[on].conj()))
            np.add.at(weight, at[on], w[on])
            delay, rate, phase, snr[k] = fringe_peak(cube, weight, dt, width)
            if priors and k in priors and i == reference:
                delay, rate, phase = near_peak(cube, weight, dt, width, priors[k], window)
                by_prior[k] = True
            x[k] = x[i] + [phase + 2 * np.pi * (delay * middle + rate * (mid - times[0])), delay, rate]
            solved.add(k)
            front.append(k)
    free = np.isin(np.arange(antennas), list(solved - {reference}))
    use = np.isin(a, list(solved)) & np.isin(b, list(solved))
    x = global_fit(x, z[use], a[use], b[use], time[use] - mid, f, free)
    out = [(mid, reference, k, float(np.angle(np.exp(1j * x[k, 0]))), x[k, 1], x[k, 2], snr[k], bool(k != reference and snr[k] < min_snr), bool(by_prior[k])) for k in sorted(solved)]
    return pd.DataFrame(out, columns=COLUMNS)


def fringefit(rows: DataFrame, keys: list[str], antennas: int, chain: list[int], width: float, solint: float | None, nchan: int, min_snr: float = 5.0) -> DataFrame:
    """Solutions per key, interval and antenna. A task holds one interval's sums, whose size follows its times, baselines and channels."""
    return solve_sums(interval_sums(rows, keys, solint, nchan), [*keys, "interval"], antennas, chain, width, min_snr)


def solve_sums(sums: DataFrame, group: list[str], antennas: int, chain: list[int], width: float, min_snr: float) -> DataFrame:
    def solve(pdf: pd.DataFrame) -> pd.DataFrame:
        return _keyed(pdf, group, solve_interval(pdf, antennas, chain, width, min_snr))

    return sums.groupBy(*group).applyInPandas(solve, _schema(sums, group))


def _keyed(pdf: pd.DataFrame, group: list[str], out: pd.DataFrame) -> pd.DataFrame:
    for at, name in enumerate(group):
        out.insert(at, name, [pdf[name].iloc[0]] * len(out))
    return out


def _schema(sums: DataFrame, group: list[str]) -> str:
    return ", ".join(f"`{n}` {t}" for n, t in sums.select(*group).dtypes) + ", " + SOLUTIONS


def predictions(solutions: DataFrame, series: list[str], n: int = PREVIOUS, least: float = PREDICTING_SNR) -> DataFrame:
    """Add delay0 and rate0: medians of the last n good solutions among the 2 n before, of one series, antenna and reference; null without any, and for the reference."""
    good = ~F.col("flag") & (F.col("snr") >= least)
    keys, other = [*series, "antenna", "reference"], F.col("antenna") != F.col("reference")
    out = solutions
    for value in ("delay", "rate"):
        out = predict_from_previous(out, keys, ["time"], value, good, n).withColumnRenamed("predicted", f"{value}0")
    return out.withColumns({c: F.when(other, F.col(c)) for c in ("delay0", "rate0")})


def departs(window: tuple[float, float] = WINDOW) -> Column:
    """Whether a solution with a prediction was flagged or lies outside the window about it."""
    off = F.col("flag") | (F.abs(F.col("delay") - F.col("delay0")) > window[0]) | (F.abs(F.col("rate") - F.col("rate0")) > window[1])
    return F.col("delay0").isNotNull() & F.col("rate0").isNotNull() & off


def fringefit_around(rows: DataFrame, keys: list[str], series: list[str], antennas: int, chain: list[int], width: float, solint: float | None, nchan: int, min_snr: float = 5.0, window: tuple[float, float] = WINDOW) -> DataFrame:
    """fringefit, and intervals in which an antenna departs from its prediction are solved again within the window about all predictions.

    The second solution stands where a prior was used and it isn't flagged. keys tell intervals apart, series (a part of keys) what one predicts for another.
    Sums and first solutions are written once: the data is read once, and no interval is solved twice but those that depart.
    """
    group = [*keys, "interval"]
    sums = pinned(interval_sums(rows, keys, solint, nchan))
    predicted = pinned(predictions(pinned(solve_sums(sums, group, antennas, chain, width, min_snr)), series))
    known = F.filter(F.collect_list(F.when(F.col("delay0").isNotNull(), F.struct("antenna", "delay0", "rate0"))), lambda p: p.isNotNull())
    wanted = predicted.groupBy(*group).agg(F.max(departs(window).cast("int")).alias("_off"), known.alias("priors")).filter("_off = 1").drop("_off")
    again = sums.alias("s").join(wanted.alias("p"), [F.col(f"s.{g}").eqNullSafe(F.col(f"p.{g}")) for g in group]).select("s.*", "p.priors")

    def solve(pdf: pd.DataFrame) -> pd.DataFrame:
        priors = {p["antenna"]: (p["delay0"], p["rate0"]) for p in pdf["priors"].iloc[0]}
        return _keyed(pdf, group, solve_interval(pdf, antennas, chain, width, min_snr, priors, window))

    second = again.groupBy(*group).applyInPandas(solve, _schema(sums, group)).filter("from_prior AND NOT flag")
    values = ["phase", "delay", "rate", "snr", "flag", "from_prior"]
    found = second.select(*group, "antenna", F.struct(*values).alias("_new"))
    both = predicted.alias("a").join(found.alias("b"), [F.col(f"a.{g}").eqNullSafe(F.col(f"b.{g}")) for g in [*group, "antenna"]], "left")
    pick = [F.when(F.col("b._new").isNotNull(), F.col(f"b._new.{v}")).otherwise(F.col(f"a.{v}")).alias(v) for v in values]
    return both.select(*[f"a.{g}" for g in group], "a.time", "a.reference", "a.antenna", *pick)


CHANNELS, WIDTH, INTERVAL, SHORTER = 8, 1e6, 1300.0, 500.0


def planted(s, d) -> DataFrame:
    """Visibilities of eight antennas with delays (25 ns steps) and rates (1e-3 Hz steps) known from antenna and hand; a day counts as a second."""
    a, b, hand = F.col("l_suppkey") % 8, F.col("l_partkey") % 8, F.col("l_linenumber") % 2
    delay = lambda k: ((k * 7 + hand * 3) % 11 - 5) * 25e-9
    rate = lambda k: ((k * 3 + hand) % 5 - 2) * 1e-3
    time = F.datediff(F.col("l_shipdate").cast("date"), F.lit("1992-01-01").cast("date")).cast("double")
    rows = table(s, d, "lineitem").select(F.least(a, b).cast("int").alias("antenna1"), F.greatest(a, b).cast("int").alias("antenna2"), hand.cast("int").alias("hand"), time.alias("time"), F.col("l_quantity").cast("double").alias("weight"), (F.col("l_returnflag") == "R").alias("_off"))
    hand = F.col("hand")
    of = lambda k: F.col(k)
    turn = lambda c: 2 * np.pi * ((delay(of("antenna1")) - delay(of("antenna2"))) * (c * WIDTH) + (rate(of("antenna1")) - rate(of("antenna2"))) * F.col("time"))
    each = lambda value: F.array(*[value(c) for c in range(CHANNELS)])
    return rows.withColumns({"re": each(lambda c: F.cos(turn(c))), "im": each(lambda c: F.sin(turn(c))), "flag": each(lambda c: F.col("_off"))}).drop("_off")


def _fitted(s, d):
    out = fringefit(planted(s, d), ["hand"], 8, list(range(8)), WIDTH, INTERVAL, CHANNELS)
    return out.filter("NOT flag").select("hand", "interval", "time", "reference", "antenna", (F.round(F.col("delay") * 1e9, 2) + 0.0).alias("delay_ns"), (F.round(F.col("rate") * 1e3, 3) + 0.0).alias("rate_mhz"))


def _predicted(s, d):
    out = fringefit_around(planted(s, d), ["hand"], ["hand"], 8, list(range(8)), WIDTH, SHORTER, CHANNELS)
    return out.filter("NOT flag").select("hand", "interval", "reference", "antenna", (F.round(F.col("delay") * 1e9, 1) + 0.0).alias("delay_ns"), (F.round(F.col("rate") * 1e3, 2) + 0.0).alias("rate_mhz"))


QUERIES = {"fringefit_intervals": _fitted, "fringefit_predicted": _predicted}
_TRUTH = """WITH v AS (SELECT l_suppkey % 8 AS a, l_partkey % 8 AS b, CAST(l_linenumber % 2 AS INT) AS hand, CAST(date_diff('day', DATE '1992-01-01', CAST(l_shipdate AS DATE)) AS DOUBLE) AS t, l_returnflag = 'R' AS flag, l_quantity AS w FROM lineitem),
      i AS (SELECT *, CAST(floor((t - min(t) OVER (PARTITION BY hand)) / 1300.0) AS BIGINT) AS "interval" FROM v),
      g AS (SELECT * FROM i WHERE a <> b AND NOT flag AND w > 0),
      e AS (SELECT hand, "interval", a AS antenna FROM g UNION SELECT hand, "interval", b FROM g),
      m AS (SELECT hand, "interval", (min(t) + max(t)) / 2 AS time FROM g GROUP BY ALL),
      r AS (SELECT hand, "interval", min(antenna) AS reference FROM e GROUP BY ALL)"""
SQL = {
    "fringefit_intervals": _TRUTH
    + """ SELECT hand, "interval", time, CAST(reference AS INT) AS reference, CAST(antenna AS INT) AS antenna,
        CAST(((antenna * 7 + hand * 3) % 11 - (reference * 7 + hand * 3) % 11) * 25 AS DOUBLE) AS delay_ns, CAST((antenna * 3 + hand) % 5 - (reference * 3 + hand) % 5 AS DOUBLE) AS rate_mhz
      FROM e JOIN m USING (hand, "interval") JOIN r USING (hand, "interval")""",
    "fringefit_predicted": _TRUTH.replace("1300.0", "500.0")
    + """ SELECT hand, "interval", CAST(reference AS INT) AS reference, CAST(antenna AS INT) AS antenna, CAST(((antenna * 7 + hand * 3) % 11 - (reference * 7 + hand * 3) % 11) * 25 AS DOUBLE) AS delay_ns, CAST((antenna * 3 + hand) % 5 - (reference * 3 + hand) % 5 AS DOUBLE) AS rate_mhz
      FROM e JOIN r USING (hand, "interval")""",
}
