"""Bandpasses as a shape per channel, shared by all intervals, times a continuum gain per interval.

Sums stay rows of (key, interval, baseline, channel), so any number of channels is a number of rows. What a baseline's source
does in an interval is divided out in Spark; only the baseline sums of one key (for the shape) or of one interval (for the
continuum) are a group for the solver.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..plans.model import table
from .ranks import pinned
from .solve import connected_groups

BASELINE = ["antenna1", "antenna2"]


def solve_gains(cross: np.ndarray, weight: np.ndarray, mode: str = "ap", min_snr: float = 0.0, least: int = 4, iterations: int = 200, tolerance: float = 1e-9) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Gains g with cross[c, i, j] ~ weight[c, i, j] g[c, i] conj(g[c, j]) for many solves c at once; flags; signal-to-noise.

    cross is Hermitian and weight symmetric. Modes: "ap"; "a" takes amplitudes of the means alone; "p" unit gains of unit
    means, weighted by their amplitudes squared. Antennas of fewer baselines than `least` (lowered to one less than the antennas
    there are, but not below 2) are flagged. Groups of antennas without a common baseline start from leading vectors of their own,
    and the signal-to-noise is over each group's own root of chi-squared per degree of freedom. 1 and 0 where flagged.
    """
    weight, n = weight.astype(float).copy(), cross.shape[1]
    mean = np.where(weight > 0, cross / np.where(weight > 0, weight, 1), 0)
    if mode == "a":
        mean = np.abs(mean).astype(complex)
    if mode == "p":
        size = np.abs(mean)
        mean, weight = np.where(size > 0, mean / np.where(size > 0, size, 1), 0), weight * size**2
    need = np.clip(np.minimum(least, (weight > 0).any(axis=2).sum(axis=1) - 1), 2, None)
    alive = np.ones(cross.shape[:2], bool)
    while True:
        short = alive & ((weight > 0).sum(axis=2) < need[:, None])
        if not short.any():
            break
        alive &= ~short
        weight *= alive[:, :, None] & alive[:, None, :]
    labels = np.stack([connected_groups(w) for w in weight])
    together = (labels[:, :, None] == labels[:, None, :]) & alive[:, :, None] & alive[:, None, :]
    # Blocks of one matrix are its groups; each antenna takes the leading vector of its own block.
    g = np.ones(cross.shape[:2], complex)
    for c in range(len(cross)):
        for k in np.unique(labels[c][alive[c]]):
            own = np.flatnonzero((labels[c] == k) & alive[c])
            values, vectors = np.linalg.eigh(np.where(weight[c] > 0, mean[c], 0)[np.ix_(own, own)])
            links = np.maximum((weight[c][np.ix_(own, own)] > 0).sum(axis=1), 1)
            g[c, own] = vectors[:, -1] * (1 if mode == "p" else np.sqrt(max(values[-1], 0.0) * len(own) / links))
    g = np.where(np.abs(g) > 0, g, 1)
    shaped = {"a": lambda x: np.abs(x).astype(complex), "p": lambda x: np.where(np.abs(x) > 0, x / np.maximum(np.abs(x), 1e-300), 1), "ap": lambda x: x}[mode]
    g = shaped(g)
    for step in range(iterations):
        power = np.einsum("cij,cj->ci", weight, np.abs(g) ** 2)
        new = shaped(np.where(power > 0, np.einsum("cij,cij,cj->ci", weight, mean, g) / np.where(power > 0, power, 1), 1))
        new = new if step % 2 == 0 else (g + new) / 2
        change, g = np.abs(np.where(alive, new - g, 0)).max(initial=0.0), new
        if step % 2 and change < tolerance:
            break
    power = np.einsum("cij,cj->ci", weight, np.abs(g) ** 2)
    off = weight * np.abs(mean - g[:, :, None] * g[:, None, :].conj()) ** 2
    # Sums over a group's baselines, each counted once, for all of its antennas.
    chi2 = np.einsum("cij,cj->ci", together, off.sum(axis=2)) / 2
    freedom = np.einsum("cij,cj->ci", together, (weight > 0).sum(axis=2)) / 2 - together.sum(axis=2)
    misfit = np.sqrt(np.where((freedom > 0) & (chi2 > 0), chi2 / np.where(freedom > 0, freedom, 1), 1))
    snr = np.abs(g) * np.sqrt(power) / misfit
    flags = ~alive | (power <= 0) | (snr < min_snr)
    return np.where(flags, 1, g), flags, np.where(flags, 0, snr)


def turned_to(g: np.ndarray, flags: np.ndarray, weight: np.ndarray, chain: list[int]) -> np.ndarray:
    """Gains turned so that the first good antenna of the chain has no phase in its group; other groups take their own first."""
    out = g.copy()
    rank = {a: i for i, a in enumerate(chain)}
    for c in range(len(g)):
        label = connected_groups(weight[c])
        for k in np.unique(label[~flags[c]]):
            own = np.flatnonzero((label == k) & ~flags[c])
            first = min(own, key=lambda a: (rank.get(a, len(rank)), a))
            out[c, own] = g[c, own] * np.conj(g[c, first]) / max(abs(g[c, first]), 1e-300)
    return out


def channel_sums(rows: DataFrame, keys: list[str]) -> DataFrame:
    """(keys, antenna1, antenna2, channel, re, im, w): weighted sums of good cells of cross-correlations. rows: weight, arrays re, im, flag."""
    cells = rows.filter("antenna1 <> antenna2 AND weight > 0").select(*keys, *BASELINE, "weight", F.posexplode(F.arrays_zip("re", "im", "flag")).alias("channel", "c"))
    good = cells.filter("NOT c.flag AND NOT isnan(c.re) AND NOT isnan(c.im)")
    return good.groupBy(*keys, *BASELINE, "channel").agg(F.sum(F.col("weight") * F.col("c.re")).alias("re"), F.sum(F.col("weight") * F.col("c.im")).alias("im"), F.sum("weight").alias("w"))


def over_source(sums: DataFrame, group: list[str], shape: DataFrame | None, keys: list[str]) -> DataFrame:
    """Sums over each baseline's source term per group (an interval): its weighted mean over channels, or over the model if there is a shape.

    In the form that keeps signal-to-noise: sums times conj(s), weights times |s|^2.
    """
    s = sums
    if shape is None:
        s = s.withColumns({"_mr": F.lit(1.0), "_mi": F.lit(0.0)})
    else:  # one row per key, channel and antenna: small, joined by key
        good = shape.filter(~F.col("flag")).select(*keys, "channel", "antenna", F.col("re").alias("_r"), F.col("im").alias("_i"))
        for k in (1, 2):
            s = s.join(good.select(*keys, "channel", F.col("antenna").alias(f"antenna{k}"), F.col("_r").alias(f"_r{k}"), F.col("_i").alias(f"_i{k}")), [*keys, "channel", f"antenna{k}"])
        s = s.withColumns({"_mr": F.col("_r1") * F.col("_r2") + F.col("_i1") * F.col("_i2"), "_mi": F.col("_i1") * F.col("_r2") - F.col("_r1") * F.col("_i2")})
    power = F.sum(F.col("w") * (F.col("_mr") ** 2 + F.col("_mi") ** 2))
    term = s.groupBy(*group, *BASELINE).agg(
        (F.sum(F.col("re") * F.col("_mr") + F.col("im") * F.col("_mi")) / power).alias("_sr"), (F.sum(F.col("im") * F.col("_mr") - F.col("re") * F.col("_mi")) / power).alias("_si")
    )
    j = sums.join(term, [*group, *BASELINE])
    return j.select(*sums.columns[: -3], (F.col("re") * F.col("_sr") + F.col("im") * F.col("_si")).alias("re"), (F.col("im") * F.col("_sr") - F.col("re") * F.col("_si")).alias("im"), (F.col("w") * (F.col("_sr") ** 2 + F.col("_si") ** 2)).alias("w"))


def solved(sums: DataFrame, group: list[str], along: str | None, antennas: int, chain: list[int], mode: str, min_snr: float, least: int) -> DataFrame:
    """Gains of each group: one solve per value of `along` (the channels of a bandpass), or one. A group holds its baselines times channels."""
    kinds = dict(sums.dtypes)
    schema = ", ".join(f"`{g}` {kinds[g]}" for g in group) + ", " + (f"{along} int, " if along else "") + "antenna int, re double, im double, snr double, flag boolean"

    def solve(pdf: pd.DataFrame) -> pd.DataFrame:
        values, at = np.unique(pdf[along].to_numpy(), return_inverse=True) if along else (np.array([0]), np.zeros(len(pdf), int))
        cross, weight = np.zeros((len(values), antennas, antennas), complex), np.zeros((len(values), antennas, antennas))
        a, b, z = pdf["antenna1"].to_numpy(), pdf["antenna2"].to_numpy(), pdf["re"].to_numpy() + 1j * pdf["im"].to_numpy()
        np.add.at(cross, (at, a, b), z)
        np.add.at(cross, (at, b, a), z.conj())
        np.add.at(weight, (at, a, b), pdf["w"].to_numpy())
        np.add.at(weight, (at, b, a), pdf["w"].to_numpy())
        g, flags, snr = solve_gains(cross, weight, mode, min_snr, least)
        g = turned_to(g, flags, weight, chain) if mode != "a" else g
        seen = np.unique(np.concatenate([a, b]))
        out = pd.DataFrame({along or "_one": np.repeat(values, len(seen)), "antenna": np.tile(seen, len(values)), "re": g[:, seen].real.ravel(), "im": g[:, seen].imag.ravel(), "snr": snr[:, seen].ravel(), "flag": flags[:, seen].ravel()})
        out = out.drop(columns=[] if along else ["_one"])
        for i, name in enumerate(group):
            out.insert(i, name, [pdf[name].iloc[0]] * len(out))
        return out

    return sums.groupBy(*group).applyInPandas(solve, schema)


def shape_and_continuum(rows: DataFrame, keys: list[str], interval: str, antennas: int, chain: list[int], rounds: int = 3, min_snr: float = 0.0, least: int = 4, mode: str = "ap") -> tuple[DataFrame, DataFrame]:
    """The shape (keys, channel, antenna: re, im, snr, flag) that all intervals share, and the continuum gain of each interval (keys, interval, antenna).

    The shape is first solved on sums over each baseline's mean over channels. That mean holds a little of the shape; so in `rounds` rounds
    the source term of every baseline and interval is estimated anew against the shape and divided out. The continuum is then solved
    on channel sums over the shape. No source structure can disturb the shape; the continuum takes the source for a point.
    """
    group = [*keys, interval]
    sums = pinned(channel_sums(rows, group))
    shape = None
    total = [F.sum(c).alias(c) for c in ("re", "im", "w")]
    for _ in range(rounds + 1):
        divided = over_source(sums, group, shape, keys).groupBy(*keys, *BASELINE, "channel").agg(*total)
        shape = pinned(solved(divided, keys, "channel", antennas, chain, mode, min_snr, least))
    good = shape.filter(~F.col("flag")).select(*keys, "channel", "antenna", F.col("re").alias("_r"), F.col("im").alias("_i"))
    s = sums
    for k in (1, 2):
        s = s.join(good.select(*keys, "channel", F.col("antenna").alias(f"antenna{k}"), F.col("_r").alias(f"_r{k}"), F.col("_i").alias(f"_i{k}")), [*keys, "channel", f"antenna{k}"])
    mr, mi = F.col("_r1") * F.col("_r2") + F.col("_i1") * F.col("_i2"), F.col("_i1") * F.col("_r2") - F.col("_r1") * F.col("_i2")
    level = s.groupBy(*group, *BASELINE).agg(F.sum(F.col("re") * mr + F.col("im") * mi).alias("re"), F.sum(F.col("im") * mr - F.col("re") * mi).alias("im"), F.sum(F.col("w") * (mr**2 + mi**2)).alias("w"))
    return shape, solved(level, group, None, antennas, chain, mode, min_snr, least)


CHANNELS, ANTENNAS = 8, 8


def _planted(s, d, structure: bool) -> DataFrame:
    """Visibilities of a planted shape per antenna and channel, a gain per antenna and interval, and (if asked for) a source of its own per baseline and interval."""
    rows = table(s, d, "lineitem").select(
        (F.col("l_linenumber") % 2).cast("int").alias("hand"), F.floor(F.datediff(F.col("l_shipdate").cast("date"), F.lit("1992-01-01").cast("date")) / 300).cast("int").alias("interval"), (F.col("l_suppkey") % 8).cast("int").alias("_a"), (F.col("l_partkey") % 8).cast("int").alias("_b"),
        F.col("l_quantity").cast("double").alias("weight"), (F.col("l_returnflag") == "R").alias("_f"),
    ).withColumns({"antenna1": F.least("_a", "_b"), "antenna2": F.greatest("_a", "_b")})
    a, b, t, h = (F.col(c) for c in ("antenna1", "antenna2", "interval", "hand"))
    amp = lambda k, c: 1 + ((k * 3 + c * 5 + h) % 7 - 3) / 20.0
    turn = lambda k, c: F.when(k == 0, 0.0).otherwise(((k * 5 + c * 3 + h) % 9 - 4) / 10.0)
    level = lambda k: 1 + ((k * 2 + t) % 5) / 10.0
    phase = lambda k: F.when(k == 0, 0.0).otherwise((k * 7 + t * 3) % 6 - 2.5)
    source = (1 + (a + b + t) % 4 / 2.0) if structure else F.lit(2.0)
    own = ((a * 2 + b + t) % 5 / 2.0) if structure else F.lit(0.0)
    size = lambda c: source * amp(a, c) * amp(b, c) * level(a) * level(b)
    angle = lambda c: own + turn(a, c) - turn(b, c) + phase(a) - phase(b)
    each = lambda f: F.array(*[f(F.lit(c)).cast("double") for c in range(CHANNELS)])
    return rows.withColumns({"re": each(lambda c: size(c) * F.cos(angle(c))), "im": each(lambda c: size(c) * F.sin(angle(c))), "flag": F.array(*[F.col("_f")] * CHANNELS)}).drop("_a", "_b", "_f")


def _shape(s, d):
    shape, _ = shape_and_continuum(_planted(s, d, True), ["hand"], "interval", ANTENNAS, list(range(ANTENNAS)), rounds=6)
    first = shape.filter("channel = 0").select("hand", "antenna", F.col("re").alias("_r"), F.col("im").alias("_i"))
    r = shape.filter("NOT flag").join(first, ["hand", "antenna"])
    power = F.col("_r") ** 2 + F.col("_i") ** 2
    re, im = (F.col("re") * F.col("_r") + F.col("im") * F.col("_i")) / power, (F.col("im") * F.col("_r") - F.col("re") * F.col("_i")) / power
    return r.select("hand", "channel", "antenna", (F.round(re, 3) + 0.0).alias("re"), (F.round(im, 3) + 0.0).alias("im"))


def _bandpass(s, d):
    shape, gains = shape_and_continuum(_planted(s, d, False), ["hand"], "interval", ANTENNAS, list(range(ANTENNAS)), rounds=6)
    r = gains.filter("NOT flag").join(shape.filter("NOT flag").select("hand", "channel", "antenna", F.col("re").alias("_r"), F.col("im").alias("_i")), ["hand", "antenna"])
    re, im = F.col("re") * F.col("_r") - F.col("im") * F.col("_i"), F.col("re") * F.col("_i") + F.col("im") * F.col("_r")
    return r.select("hand", "interval", "channel", "antenna", (F.round(re, 3) + 0.0).alias("re"), (F.round(im, 3) + 0.0).alias("im"))


QUERIES = {"bandpass_shape": _shape, "bandpass_with_continuum": _bandpass}
_SEEN = """WITH v AS (SELECT CAST(l_linenumber % 2 AS INT) AS hand, CAST(floor(date_diff('day', DATE '1992-01-01', CAST(l_shipdate AS DATE)) / 300.0) AS INT) AS "interval", l_suppkey % 8 AS a, l_partkey % 8 AS b FROM lineitem WHERE l_returnflag <> 'R' AND l_suppkey % 8 <> l_partkey % 8),
  e AS (SELECT DISTINCT hand, "interval", unnest([a, b])::INT AS antenna FROM v)"""
SQL = {
    # Planted truth.
    "bandpass_shape": _SEEN
    + """, k AS (SELECT DISTINCT hand, antenna, c AS channel, 1 + ((antenna * 3 + c * 5 + hand) % 7 - 3) / 20.0::DOUBLE AS a, 1 + ((antenna * 3 + hand) % 7 - 3) / 20.0::DOUBLE AS a0,
        CASE WHEN antenna = 0 THEN 0 ELSE ((antenna * 5 + c * 3 + hand) % 9 - 4) / 10.0::DOUBLE - ((antenna * 5 + hand) % 9 - 4) / 10.0::DOUBLE END AS p FROM e, range(8) r(c))
      SELECT hand, CAST(channel AS INT) AS channel, antenna, round(a / a0 * cos(p), 3) + 0.0 AS re, round(a / a0 * sin(p), 3) + 0.0 AS im FROM k""",
    "bandpass_with_continuum": _SEEN
    + """ SELECT hand, "interval", CAST(c AS INT) AS channel, antenna, round(sqrt(2) * g * cos(p), 3) + 0.0 AS re, round(sqrt(2) * g * sin(p), 3) + 0.0 AS im FROM (SELECT *,
      (1 + ((antenna * 3 + c * 5 + hand) % 7 - 3) / 20.0::DOUBLE) * (1 + ((antenna * 2 + "interval") % 5) / 10.0::DOUBLE) AS g, CASE WHEN antenna = 0 THEN 0 ELSE ((antenna * 5 + c * 3 + hand) % 9 - 4) / 10.0::DOUBLE + (antenna * 7 + "interval" * 3) % 6 - 2.5 END AS p FROM e, range(8) r(c))""",
}
