"""Cells of correlator rows (one band each) decoded to visibilities, flags and weights, with the corrections for the sampling of the signal."""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..plans.model import table

# Published constants of the digital corrections. Per pair of levels: sampling loss, cutoff efficiency, scale of the levels.
A_COEF, H_COEF = 5.36, 0.87890625
TWO = 64.0 / 63.0
FOUR = 3.335875 * 64.0 / 63.0
RM = {(4, 4): 4.3048, (2, 2): 1.0, (2, 4): 5.8784}
ALFA = {(4, 4): 0.882518, (2, 2): 2.0 / np.pi, (2, 4): 0.882518}
GAMMA = {(4, 4): FOUR, (2, 2): TWO, (2, 4): FOUR}
# Rational form of the relation between true and measured correlation of four-level samples, in powers of r squared.
RHO4_TOP = (1.1329552, -3.1056902, 2.9296994, -0.90122460)
RHO4_BOTTOM = (1.0, -2.7056559, 2.5012473, -0.73985978)
#: Versions of the VLBA correlator from which the scale holds the integration time too.
INTEGRATED_FROM = 4.17


@dataclass(frozen=True)
class Setup:
    """order and swapped_order: where in a recorded cell each correlation is taken from, for rows as they are and rows whose antennas were exchanged."""

    nchan: int
    order: tuple[int, ...]
    swapped_order: tuple[int, ...]
    parallel: tuple[bool, ...]
    scale: float = 1.0
    width: float = 1.0
    values: int = 3
    kind: str = ""
    version: float = 0.0
    corrected: bool = False
    by_weight: bool = False


def rho_four(r: np.ndarray) -> np.ndarray:
    x = r * r
    return r * np.polynomial.polynomial.polyval(x, RHO4_TOP) / np.polynomial.polynomial.polyval(x, RHO4_BOTTOM)


def van_vleck(spectrum: np.ndarray, levels: int) -> np.ndarray | None:
    """A recorded autocorrelation spectrum, corrected lag by lag for two- or four-level sampling.

    The point past the last channel is extrapolated, the spectrum is turned to lags as an even series, each lag's
    ratio to the tapered zero lag is corrected, and turned back. None for a spectrum that starts at zero, which is left as it is.
    """
    n = len(spectrum)
    scaled = spectrum * GAMMA[levels, levels] ** 2 / (A_COEF * RM[levels, levels] * H_COEF)
    if abs(scaled[0]) < 1e-20:
        return None
    ends = np.append(scaled, 2 * scaled[-1] - scaled[-2] if n > 1 else scaled[-1])
    even = lambda x: np.fft.rfft(np.concatenate([x, x[-2:0:-1]])).real
    lags = even(ends)
    taper = (1 - np.arange(1, n) / n) * lags[0]
    with np.errstate(divide="ignore", invalid="ignore"):
        ratio = lags[1:n] / taper
    lags[1:n] = taper * (rho_four(ratio) if levels == 4 else np.sin(np.pi * ratio / 2))
    lags[n] = 0.0
    return even(lags)[:n] / (2 * n)


def _pair(values: dict, other: float) -> Column:
    lo, hi = F.least("levels1", "levels2"), F.greatest("levels1", "levels2")
    out = F.lit(other)
    for (a, b), v in values.items():
        out = F.when((lo == a) & (hi == b), v).otherwise(out)
    return out


def _corrected(rows: DataFrame, s: Setup) -> DataFrame:
    """re and im scaled for the sampling; parallel hands of autocorrelations with equal levels by van_vleck, their imaginary part dropped."""
    alfa = F.lit(1.0) if s.corrected else _pair(ALFA, 1.0)
    factor = _pair(GAMMA, 1.0) ** 2 / (A_COEF * _pair(RM, 1 / (A_COEF * H_COEF)) * alfa * H_COEF)
    auto = F.lit(False) if s.corrected else (F.col("antenna1") == F.col("antenna2")) & (F.col("levels1") == F.col("levels2")) & F.col("levels1").isin(2, 4)
    ncorr, parallel, vlba = len(s.order), s.parallel, s.kind == "VLBA"

    @F.pandas_udf("array<double>")
    def lag_corrected(re: pd.Series, weight: pd.Series, levels: pd.Series) -> pd.Series:
        def one(x, w, k):
            if x is None:
                return None
            x, w = np.array(x, float).reshape(-1, ncorr), np.array(w, float).reshape(-1, ncorr)
            for p in np.flatnonzero(parallel):
                new = van_vleck(x[:, p], int(k))
                if new is not None:
                    x[:, p] = new * (1 + (0.25 if ncorr > 2 else 0.125) * w[:, p] if vlba else 1.0)
            return x.ravel()

        return pd.Series([one(*v) for v in zip(re, weight, levels)])

    crossed = lambda c: F.transform(c, lambda x, i: F.when(F.get(F.array(*map(F.lit, parallel)), i % ncorr), x).otherwise(x * F.col("_factor")))
    scaled = lambda c: F.transform(c, lambda x: x * F.col("_factor"))
    r = rows.withColumns({"_factor": factor, "_auto": F.coalesce(auto, F.lit(False))})
    if not s.corrected:
        r = r.withColumn("_lags", lag_corrected(F.when(F.col("_auto"), crossed("re")), F.when(F.col("_auto"), F.col("_w")), F.col("levels1")))
    else:
        r = r.withColumn("_lags", F.lit(None).cast("array<double>"))
    none = F.transform(crossed("im"), lambda x, i: F.when(F.get(F.array(*map(F.lit, parallel)), i % ncorr), 0.0).otherwise(x))
    return r.withColumns({"re": F.when(F.col("_auto"), F.col("_lags")).otherwise(scaled("re")), "im": F.when(F.col("_auto"), none).otherwise(scaled("im"))}).drop("_factor", "_auto", "_lags")


def decode_cells(rows: DataFrame, s: Setup) -> DataFrame:
    """Replace `flux` (and `weights`, one per correlation, if there) by arrays re, im, flag, weight_spectrum, sigma_spectrum (channel by channel, correlations inside), sigma, weight (per correlation) and flag_row.

    flux holds for each channel and recorded correlation s.values numbers: real, imaginary and, with three, a
    weight; weights of zero and less flag. Exchanged rows (`swapped`) keep the sign of the imaginary part, others
    turn it. Data that the correlator scaled by weight are divided by it; without weight they become null. Rows
    need antenna1, antenna2, interval, swapped and, from a correlator of kind DIFX or VLBA, levels1 and levels2.
    """
    ncorr = len(s.order)
    cells = F.sequence(F.lit(0), F.lit(s.nchan * ncorr - 1))
    pick = lambda i: F.when(F.col("swapped"), F.get(F.array(*map(F.lit, s.swapped_order)), i % ncorr)).otherwise(F.get(F.array(*map(F.lit, s.order)), i % ncorr))
    at = lambda i, k: F.get("flux", ((F.floor(i / ncorr).cast("int") * ncorr + pick(i)) * s.values + k))
    raw = (lambda i: at(i, 2)) if s.values == 3 else (lambda i: F.get("weights", pick(i))) if "weights" in rows.columns else (lambda i: F.lit(1.0))
    each = lambda f: F.transform(cells, f)
    r = rows.withColumns({"re": each(lambda i: at(i, 0)), "im": each(lambda i: F.when(F.col("swapped"), at(i, 1)).otherwise(-at(i, 1))), "_raw": each(raw)})
    r = r.withColumns({"flag": F.transform("_raw", lambda x: x <= 0), "_w": F.transform("_raw", F.abs)})
    if s.kind in ("DIFX", "VLBA"):
        r = _corrected(r, s)
    if s.by_weight:
        scale = F.lit(s.scale) * (F.col("interval") if s.kind == "VLBA" and s.version >= INTEGRATED_FROM else F.lit(1.0))
        r = r.withColumns({c: F.zip_with(c, "_w", lambda x, w: x / F.nullif(w * scale, F.lit(0.0))) for c in ("re", "im")})
    factor = s.scale * s.width * F.when(F.col("antenna1") != F.col("antenna2"), 2.0).otherwise(1.0) * F.col("interval")
    r = r.withColumn("weight_spectrum", F.transform("_w", lambda w: w * factor))
    r = r.withColumn("sigma_spectrum", F.transform("weight_spectrum", lambda w: F.when(w > 0, 1 / F.sqrt(w)).otherwise(1.0)))
    middle = lambda p: F.get(F.sort_array(F.filter("sigma_spectrum", lambda x, i: i % ncorr == p)), (s.nchan - 1) // 2)
    r = r.withColumn("sigma", F.array(*[middle(p) for p in range(ncorr)]))
    return r.withColumns({"weight": F.transform("sigma", lambda x: 1 / (x * x)), "flag_row": F.forall("flag", lambda f: f)}).drop("flux", "weights", "_raw", "_w")


def _decoded(s, d):
    v = F.col("vec_id")
    rows = table(s, d, "embeddings").select("vec_id", (v % 4).cast("int").alias("antenna1"), (v % 5).cast("int").alias("antenna2"), (v % 3 == 0).alias("swapped"), (1.0 + v % 2).alias("interval"), F.lit(2).alias("levels1"), F.lit(4).alias("levels2"), F.transform(F.slice("embedding", 1, 60), lambda x: x.cast("double")).alias("flux"))
    out = decode_cells(rows, Setup(10, (1, 0), (0, 1), (True, False), scale=0.5, width=8.0, kind="DIFX", by_weight=True))
    cells = out.select("vec_id", "sigma", "weight", "flag_row", F.posexplode(F.arrays_zip("re", "im", "flag", "weight_spectrum", "sigma_spectrum")).alias("cell", "c"))
    of = lambda c: F.round(F.get(c, F.col("cell") % 2), 6).alias(c)
    return cells.select("vec_id", "cell", of("sigma"), of("weight"), "flag_row", *[F.round(f"c.{c}", 6).alias(c) for c in ("re", "im", "weight_spectrum", "sigma_spectrum")], F.col("c.flag").alias("flag"))


FACTOR = f"({FOUR} * {FOUR} / ({A_COEF} * {RM[2, 4]} * {ALFA[2, 4]} * {H_COEF}))"
QUERIES = {"decode_cells": _decoded}
SQL = {
    "decode_cells": f"""WITH c AS (SELECT vec_id, unnest(range(20)) AS cell, embedding AS e FROM embeddings),
      k AS (SELECT *, ((cell // 2) * 2 + CASE WHEN vec_id % 3 = 0 THEN cell % 2 ELSE 1 - cell % 2 END) * 3 AS pos FROM c),
      p AS (SELECT vec_id, CAST(cell AS INT) AS cell, e[pos + 1]::DOUBLE * {FACTOR} AS a, (CASE WHEN vec_id % 3 = 0 THEN 1 ELSE -1 END) * e[pos + 2]::DOUBLE * {FACTOR} AS b, e[pos + 3]::DOUBLE AS raw FROM k),
      w AS (SELECT *, abs(raw) * 0.5 * 8.0 * CASE WHEN vec_id % 4 <> vec_id % 5 THEN 2 ELSE 1 END * (1 + vec_id % 2) AS ws FROM p),
      s AS (SELECT *, CASE WHEN ws > 0 THEN 1 / sqrt(ws) ELSE 1.0 END AS ss FROM w),
      m AS (SELECT vec_id, cell % 2 AS corr, list_sort(list(ss))[5] AS sigma FROM s GROUP BY ALL), f AS (SELECT vec_id, bool_and(raw <= 0) AS flag_row FROM s GROUP BY ALL)
      SELECT s.vec_id AS vec_id, cell, round(sigma, 6) AS sigma, round(1 / (sigma * sigma), 6) AS weight, flag_row, round(a / nullif(abs(raw) * 0.5, 0), 6) AS re, round(b / nullif(abs(raw) * 0.5, 0), 6) AS im,
        round(ws, 6) AS weight_spectrum, round(ss, 6) AS sigma_spectrum, raw <= 0 AS flag FROM s JOIN m ON m.vec_id = s.vec_id AND corr = cell % 2 JOIN f ON f.vec_id = s.vec_id""",
}
