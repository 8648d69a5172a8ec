"""Gain curves of stations as power polynomials in zenith angle."""

from __future__ import annotations

from math import comb

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.complexes import horner
from ..plans.model import table

#: Coefficients of a hand's polynomial; longer ones are cut.
TERMS = 8


def _terms(poly: Column, n: int = TERMS) -> list[Column]:
    return [F.coalesce(F.get(poly, F.lit(i)).cast("double"), F.lit(0.0)) for i in range(n)]


def in_zenith_angle(poly: Column) -> Column:
    """Coefficients (from the constant term up) in zenith angle of a polynomial in elevation, both in degrees."""
    c = _terms(poly)
    return F.array(*[sum((c[j] * float(comb(j, i) * (-1) ** i * 90 ** (j - i)) for j in range(i, TERMS)), F.lit(0.0)) for i in range(TERMS)])


def squared(poly: Column) -> Column:
    """Coefficients of the square, as many as a table holds."""
    c = _terms(poly)
    return F.array(*[sum((c[k] * c[i - k] for k in range(i + 1)), F.lit(0.0)) for i in range(TERMS)])


def power_curves(rows: DataFrame) -> DataFrame:
    """rows with `curves`: per hand the power gain (K/Jy) as TERMS coefficients in zenith angle (degrees).

    rows: kind ("POWER" or "VOLTAGE" of "(EL)" or "(ZA)"), gains (array of a polynomial per hand) and sensitivities (K/Jy per hand). Polynomials in
    elevation are re-expanded, voltages squared, and each is multiplied by its hand's sensitivity. Any other kind gives null curves.
    """
    el, volt = F.col("kind").endswith("(EL)"), F.col("kind").startswith("VOLTAGE")
    known = F.col("kind").isin("POWER(EL)", "POWER(ZA)", "VOLTAGE(EL)", "VOLTAGE(ZA)")

    def curve(poly: Column, sensitivity: Column) -> Column:
        p = F.when(el, in_zenith_angle(poly)).otherwise(F.array(*_terms(poly)))
        once = lambda value, body: F.get(F.transform(F.array(value), body), 0)
        p = once(p, lambda q: F.when(volt, squared(q)).otherwise(q))
        return F.transform(p, lambda c: c * sensitivity)

    return rows.withColumn("curves", F.when(known, F.zip_with("gains", "sensitivities", curve)))


def gains_at(rows: DataFrame, elevation: Column) -> DataFrame:
    """rows of power_curves with `voltage`: per hand the root of the power at an elevation in degrees; null where it isn't positive."""
    za = 90.0 - elevation
    return rows.withColumn("voltage", F.transform("curves", lambda c: F.when(horner(c, za) > 0, F.sqrt(horner(c, za)))))


def _stations(s, d) -> DataFrame:
    k = F.col("s_suppkey")
    kinds = F.array(*map(F.lit, ("POWER(EL)", "POWER(ZA)", "VOLTAGE(EL)", "VOLTAGE(ZA)", "UNKNOWN")))
    poly = lambda h: F.array(1 + (k + h) % 5 / 10.0, (k * 3 + h) % 7 / 1000.0, (k + h) % 3 / -100000.0)
    return table(s, d, "supplier").select("s_suppkey", F.get(kinds, (k % 5).cast("int")).alias("kind"), F.array(poly(0), poly(1)).alias("gains"), F.array(0.1 + k % 4 / 20.0, 0.1 + k % 3 / 25.0).alias("sensitivities"))


def _curves(s, d):
    out = gains_at(power_curves(_stations(s, d)), F.lit(15.0) + F.col("s_suppkey") % 70)
    return out.select("s_suppkey", "kind", *[F.round(F.get("voltage", F.lit(h)), 8).alias(f"gain{h}") for h in (0, 1)])


QUERIES = {"gain_curve_tables": _curves}
SQL = {
    "gain_curve_tables": """WITH s AS (SELECT s_suppkey AS k, ['POWER(EL)', 'POWER(ZA)', 'VOLTAGE(EL)', 'VOLTAGE(ZA)', 'UNKNOWN'][s_suppkey % 5 + 1] AS kind, 15.0::DOUBLE + s_suppkey % 70 AS el FROM supplier),
      x AS (SELECT *, CASE WHEN kind LIKE '%(EL)' THEN el ELSE 90 - el END AS a FROM s),
      p AS (SELECT *, h, 1 + (k + h) % 5 / 10.0::DOUBLE + (k * 3 + h) % 7 / 1000.0::DOUBLE * a - (k + h) % 3 / 100000.0::DOUBLE * a * a AS y, CASE WHEN h = 0 THEN 0.1 + k % 4 / 20.0::DOUBLE ELSE 0.1 + k % 3 / 25.0::DOUBLE END AS f FROM x, range(2) r(h)),
      g AS (SELECT k, kind, h, CASE WHEN kind = 'UNKNOWN' THEN NULL WHEN kind LIKE 'VOLTAGE%' THEN f * y * y ELSE f * y END AS w FROM p)
      SELECT k AS s_suppkey, kind, round(max(CASE WHEN h = 0 AND w > 0 THEN sqrt(w) END), 8) AS gain0, round(max(CASE WHEN h = 1 AND w > 0 THEN sqrt(w) END), 8) AS gain1 FROM g GROUP BY ALL""",
}
