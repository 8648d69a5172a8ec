"""Earth rotation in column expressions: delays of antennas towards sources, and what another Earth-orientation series changes in them.

Precession and bias by the four angles of IAU 2006, nutation by its largest terms (good to about 0.02 arcseconds), the Earth rotation
angle, polar motion. A daily series is met by the day before and the day after a time: two joins on whole days.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..plans.model import table

LIGHT, ARCSEC, J2000 = 299792458.0, math.pi / 180 / 3600, 51544.5
# Days (MJD) from which TAI - UTC has one second more, from 10 on.
LEAPS = (41317, 41499, 41683, 42048, 42413, 42778, 43144, 43509, 43874, 44239, 44786, 45151, 45516, 46247, 47161, 47892, 48257, 48804, 49169, 49534, 50083, 50630, 51179, 53736, 54832, 56109, 57204, 57754)
# The precession angles of IAU 2006 in arcseconds, by powers of centuries.
GAMMA, PHI = (-0.052928, 10.556378, 0.4932044, -0.00031238), (84381.412819, -46.811016, 0.0511268, 0.00053289)
PSI, EPSILON = (-0.041775, 5038.481484, 1.5584175, -0.00018522), (84381.406, -46.836769, -0.0001831, 0.0020034)
#: Sidereal time less the rotation angle, in arcseconds.
GMST = (0.014506, 4612.156534, 1.3915817, -0.00000044)
# Multiples of (l, l', F, D, Omega), sine of longitude and cosine of obliquity, in arcseconds, of the largest terms of nutation.
NUTATION = (
    ((0, 0, 0, 0, 1), -17.2064161, 9.2052331), ((0, 0, 2, -2, 2), -1.3170906, 0.5730336), ((0, 0, 2, 0, 2), -0.2276413, 0.0978459), ((0, 0, 0, 0, 2), 0.2074554, -0.0897492), ((0, 1, 0, 0, 0), 0.1475877, 0.0073871),
    ((0, 1, 2, -2, 2), -0.0516821, 0.0224386), ((1, 0, 0, 0, 0), 0.0711159, -0.000675), ((0, 0, 2, 0, 1), -0.0387298, 0.0200728), ((1, 0, 2, 0, 2), -0.0301461, 0.0129025), ((0, -1, 2, -2, 2), 0.0215829, -0.0095929),
    ((0, 0, 2, -2, 1), 0.0128227, -0.0068982), ((-1, 0, 2, 0, 2), 0.0123457, -0.0053311), ((-1, 0, 0, 2, 0), 0.0156994, -0.0001235), ((1, 0, 0, 0, 1), 0.0063110, -0.0033228), ((-1, 0, 0, 0, 1), -0.0057976, 0.0031429),
)
# The arguments of nutation in arcseconds, constant and rate by century.
ARGUMENTS = ((485868.249036, 1717915923.2178), (1287104.79305, 129596581.0481), (335779.526232, 1739527262.8478), (1072260.70369, 1602961601.209), (450160.398036, -6962890.5431))

Vector = tuple[Column, Column, Column]


def polynomial(powers: tuple[float, ...], t: Column) -> Column:
    out = F.lit(0.0)
    for c in reversed(powers):
        out = out * t + c
    return out * ARCSEC


def turned_1(v: Vector, a: Column) -> Vector:
    return v[0], v[1] * F.cos(a) + v[2] * F.sin(a), v[2] * F.cos(a) - v[1] * F.sin(a)


def turned_2(v: Vector, a: Column) -> Vector:
    return v[0] * F.cos(a) - v[2] * F.sin(a), v[1], v[0] * F.sin(a) + v[2] * F.cos(a)


def turned_3(v: Vector, a: Column) -> Vector:
    return v[0] * F.cos(a) + v[1] * F.sin(a), v[1] * F.cos(a) - v[0] * F.sin(a), v[2]


def tai_utc(mjd: Column) -> Column:
    """TAI - UTC in seconds at a UTC day, 10 before 1972."""
    return (10 + F.size(F.filter(F.array(*map(F.lit, LEAPS[1:])), lambda d: d <= mjd))).cast("double")


def interpolated(rows: DataFrame, eop: DataFrame, mjd: str, prefix: str) -> DataFrame:
    """Add ut1_utc (s), x and y (radians), each with a prefix, from a daily series (mjd, x, y in arcseconds, ut1_utc).

    Between two days linearly; a leap second between them is taken out. Null where either day is missing. A series has a row a day: it is
    joined on the day, and Spark broadcasts it if it is as small as it should be.
    """
    day = F.floor(mjd)
    w = F.col(mjd) - day
    at = lambda k: eop.select((F.floor("mjd") - k).alias("_day"), *[F.col(c).alias(f"_{c}{k}") for c in ("x", "y", "ut1_utc")])
    r = rows.withColumn("_day", day).join(at(0), "_day", "left").join(at(1), "_day", "left")
    step = F.col("_ut1_utc1") - F.col("_ut1_utc0")
    out = r.withColumns({f"{prefix}ut1_utc": F.col("_ut1_utc0") + w * (step - F.round(step)), **{f"{prefix}{c}": (F.col(f"_{c}0") + w * (F.col(f"_{c}1") - F.col(f"_{c}0"))) * ARCSEC for c in ("x", "y")}})
    return out.drop("_day", *[f"_{c}{k}" for c in ("x", "y", "ut1_utc") for k in (0, 1)])


def with_angles(rows: DataFrame, mjd: str) -> DataFrame:
    """Add the angles that hang on the time alone: _g, _p, _psi, _eps (with nutation), _eq (equation of the equinoxes) and _t (centuries of TT)."""
    r = rows.withColumn("_t", (F.col(mjd) + (tai_utc(F.col(mjd)) + 32.184) / 86400 - J2000) / 36525)
    t = F.col("_t")
    r = r.withColumns({f"_a{i}": (F.lit(c) + rate * t) * ARCSEC for i, (c, rate) in enumerate(ARGUMENTS)})
    angle = lambda k: sum((m * F.col(f"_a{i}") for i, m in enumerate(k) if m), F.lit(0.0))
    dpsi = sum((s * F.sin(angle(k)) for k, s, _ in NUTATION), F.lit(0.0)) * ARCSEC
    deps = sum((c * F.cos(angle(k)) for k, _, c in NUTATION), F.lit(0.0)) * ARCSEC
    r = r.withColumns({"_dpsi": dpsi, "_deps": deps, "_om": F.col("_a4")}).drop(*[f"_a{i}" for i in range(5)])
    mean = polynomial(EPSILON, t)
    r = r.withColumns({"_g": polynomial(GAMMA, t), "_p": polynomial(PHI, t), "_psi": polynomial(PSI, t) + F.col("_dpsi"), "_eps": mean + F.col("_deps"), "_eq": F.col("_dpsi") * F.cos(mean) + (0.00264096 * F.sin("_om") + 0.00006352 * F.sin(2 * F.col("_om"))) * ARCSEC})
    return r.drop("_dpsi", "_deps", "_om")


def of_date(v: Vector) -> Vector:
    """A celestial vector on the true equator and equinox of date."""
    return turned_1(turned_3(turned_1(turned_3(v, F.col("_g")), F.col("_p")), -F.col("_psi")), -F.col("_eps"))


def sidereal(mjd: str, ut1_utc: str) -> Column:
    """Apparent sidereal time at Greenwich."""
    days = F.col(mjd) + F.col(ut1_utc) / 86400 - J2000
    turns = 0.7790572732640 + 0.00273781191135448 * days + F.pmod(days, F.lit(1.0))
    return 2 * math.pi * F.pmod(turns, F.lit(1.0)) + polynomial(GMST, F.col("_t")) + F.col("_eq")


def with_delay(rows: DataFrame, mjd: str, prefix: str, name: str) -> DataFrame:
    """Add the geometric delay (s) of an antenna (px, py, pz in metres) towards a source (sx, sy, sz, a unit vector) at a UTC MJD, by the orientation under a prefix. Needs with_angles."""
    r = rows.withColumns(dict(zip(("_v0", "_v1", "_v2"), of_date((F.col("sx"), F.col("sy"), F.col("sz"))))))
    r = r.withColumn("_st", sidereal(mjd, f"{prefix}ut1_utc"))
    v = turned_3((F.col("_v0"), F.col("_v1"), F.col("_v2")), F.col("_st"))
    r = r.withColumns(dict(zip(("_v0", "_v1", "_v2"), v)))
    v = turned_1(turned_2((F.col("_v0"), F.col("_v1"), F.col("_v2")), -F.col(f"{prefix}x")), -F.col(f"{prefix}y"))
    return r.withColumn(name, (F.col("px") * v[0] + F.col("py") * v[1] + F.col("pz") * v[2]) / LIGHT).drop("_v0", "_v1", "_v2", "_st")


def delay_change(rows: DataFrame, before: DataFrame, after: DataFrame, mjd: str = "mjd") -> DataFrame:
    """Add delay (by the series before) and change (s): what the series after adds. rows: mjd, px, py, pz, sx, sy, sz."""
    r = with_angles(interpolated(interpolated(rows, before, mjd, "_b"), after, mjd, "_c"), mjd)
    r = with_delay(with_delay(r, mjd, "_b", "delay"), mjd, "_c", "_after")
    extra = ["_t", "_g", "_p", "_psi", "_eps", "_eq", "_after", *[f"{p}{c}" for p in ("_b", "_c") for c in ("ut1_utc", "x", "y")]]
    return r.withColumn("change", F.col("_after") - F.col("delay")).drop(*extra)


def _series(s: SparkSession, d: str, shift: float) -> DataFrame:
    """A daily series over the orders' days, with a leap second on one of them."""
    day = F.floor(F.datediff(F.col("o_orderdate").cast("date"), F.lit("1858-11-17").cast("date")))
    span = table(s, d, "orders").agg(F.min(day).alias("a"), (F.max(day) + 1).alias("b"))
    k = F.col("mjd")
    days = span.select(F.explode(F.sequence("a", "b")).alias("mjd"))
    return days.select((k * 1.0).alias("mjd"), (F.lit(0.1) + k % 17 / 100 + shift).alias("x"), (F.lit(0.3) - k % 13 / 100).alias("y"), (k % 90 / 200 - 0.4 + shift / 10 + F.when(k >= 51179, 1.0).otherwise(0.0)).alias("ut1_utc"))


def _changed(s, d):
    k = F.col("o_custkey")
    ra, dec = (k * 7 % 360) * math.pi / 180, (k * 11 % 140 - 70) * math.pi / 180
    day = F.datediff(F.col("o_orderdate").cast("date"), F.lit("1858-11-17").cast("date"))
    rows = table(s, d, "orders").select(
        "o_orderkey", (day + F.col("o_orderkey") % 24 / 24.0).alias("mjd"), ((k % 9 - 4) * 1e6).cast("double").alias("px"), ((k % 7 - 3) * 1.5e6).cast("double").alias("py"), ((k % 5 + 1) * 1e6).cast("double").alias("pz"),
        (F.cos(dec) * F.cos(ra)).alias("sx"), (F.cos(dec) * F.sin(ra)).alias("sy"), F.sin(dec).alias("sz"),
    )
    out = delay_change(rows, _series(s, d, 0.0), _series(s, d, 0.02))
    return out.select("o_orderkey", F.round(F.col("delay") * 1e9, 2).alias("delay_ns"), (F.round(F.col("change") * 1e9, 2) + 0.0).alias("change_ns"))


QUERIES = {"orientation_delays": _changed}


def _poly(powers: tuple[float, ...]) -> str:
    return "(" + " + ".join(f"({c!r}) * pow(t, {i})" for i, c in enumerate(powers)) + f") * {ARCSEC!r}"


def _nutation(column: int, function: str) -> str:
    angle = lambda k: " + ".join(f"({m}) * ({c!r} + {r!r} * t)" for m, (c, r) in zip(k, ARGUMENTS) if m)
    return "(" + " + ".join(f"({term[column]!r}) * {function}(({angle(term[0])}) * {ARCSEC!r})" for term in NUTATION) + f") * {ARCSEC!r}"


def _day_series(name: str, shift: float) -> str:
    return f"{name} AS (SELECT k, 0.1 + k % 17 / 100.0::DOUBLE + {shift} AS x, 0.3 - k % 13 / 100.0::DOUBLE AS y, k % 90 / 200.0::DOUBLE - 0.4 + {shift / 10} + CASE WHEN k >= 51179 THEN 1.0 ELSE 0.0 END AS u FROM (SELECT unnest(range(min(day), max(day) + 2)) AS k FROM o))"


def _rotated(source: str, p: str) -> str:
    """The rotations from the source's vector on, one after the other, for the series under a letter."""
    om = f"({ARGUMENTS[4][0]!r} + {ARGUMENTS[4][1]!r} * t) * {ARCSEC!r}"
    mean, third = _poly(EPSILON), lambda a: f"a * cos({a}) + b * sin({a}) AS a, b * cos({a}) - a * sin({a}) AS b, c"
    first = lambda a: f"a, b * cos({a}) + c * sin({a}) AS b, c * cos({a}) - b * sin({a}) AS c"
    second = lambda a: f"a * cos({a}) - c * sin({a}) AS a, b, a * sin({a}) + c * cos({a}) AS c"
    days = f"(mjd + {p}u / 86400 - {J2000})"
    turns = f"0.7790572732640 + 0.00273781191135448 * {days} + ({days} - floor({days}))"
    keep = "id, t, px, py, pz, ux, uy, st"
    steps = [third("g"), first("p"), third("(-psi)"), first("(-eps)"), third("st"), second("(-ux)"), first("(-uy)")]
    out = f""", {p}0 AS (SELECT id, t, px, py, pz, {p}x * {ARCSEC!r} AS ux, {p}y * {ARCSEC!r} AS uy, sx AS a, sy AS b, sz AS c, {_poly(GAMMA)} AS g, {_poly(PHI)} AS p, {_poly(PSI)} + dpsi AS psi, {mean} + deps AS eps,
      2 * pi() * (({turns}) - floor({turns})) + {_poly(GMST)} + dpsi * cos({mean}) + (0.00264096 * sin({om}) + 0.00006352 * sin(2 * {om})) * {ARCSEC!r} AS st FROM {source})"""
    for i, step in enumerate(steps, 1):
        out += f", {p}{i} AS (SELECT {keep}, g, p, psi, eps, {step} FROM {p}{i - 1})"
    return out + f", {p} AS (SELECT id, (px * a + py * b + pz * c) / {LIGHT} AS delay FROM {p}7)"


SQL = {
    "orientation_delays": f"""WITH o AS (SELECT o_orderkey AS id, date_diff('day', DATE '1858-11-17', CAST(o_orderdate AS DATE)) AS day, o_orderkey % 24 / 24.0::DOUBLE AS w, o_custkey AS k FROM orders),
      {_day_series("ea", 0.0)}, {_day_series("eb", 0.02)},
      r AS (SELECT id, day + w AS mjd, w, day, (k % 9 - 4) * 1e6 AS px, (k % 7 - 3) * 1.5e6 AS py, (k % 5 + 1) * 1e6 AS pz, radians(k * 7 % 360) AS ra, radians(k * 11 % 140 - 70) AS de FROM o),
      j AS (SELECT r.*, cos(de) * cos(ra) AS sx, cos(de) * sin(ra) AS sy, sin(de) AS sz, (mjd + (10 + len(list_filter({list(LEAPS[1:])}, lambda q: q <= mjd)) + 32.184) / 86400 - {J2000}) / 36525 AS t,
        a0.x + w * (a1.x - a0.x) AS vx, a0.y + w * (a1.y - a0.y) AS vy, a0.u + w * (a1.u - a0.u - round(a1.u - a0.u)) AS vu, b0.x + w * (b1.x - b0.x) AS zx, b0.y + w * (b1.y - b0.y) AS zy, b0.u + w * (b1.u - b0.u - round(b1.u - b0.u)) AS zu
        FROM r JOIN ea a0 ON a0.k = day JOIN ea a1 ON a1.k = day + 1 JOIN eb b0 ON b0.k = day JOIN eb b1 ON b1.k = day + 1),
      n AS (SELECT *, {_nutation(1, "sin")} AS dpsi, {_nutation(2, "cos")} AS deps FROM j){_rotated("n", "v")}{_rotated("n", "z")}
      SELECT v.id AS o_orderkey, round(v.delay * 1e9, 2) AS delay_ns, round((z.delay - v.delay) * 1e9, 2) + 0.0 AS change_ns FROM v JOIN z ON z.id = v.id""",
}
