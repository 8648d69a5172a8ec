"""Angles on the sky, ionosphere geometry, weights and text forms, as columns. Angles in radians unless named _deg."""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..plans.model import SERIES, series, table
from . import complexes as C

EARTH_M = 6371000.0
LIGHT = 299792458.0


def sidereal(mjd_s: Column) -> Column:
    """Greenwich mean sidereal angle of MJD seconds (UT)."""
    days = mjd_s / 86400.0 - 51544.5
    return F.radians(F.pmod(280.46061837 + 360.98564736629 * days, F.lit(360.0)))


def hour_angle(lon: Column, ra: Column, mjd_s: Column) -> Column:
    return C.wrap(sidereal(mjd_s) + lon - ra)


def elevation(lat: Column, ha: Column, dec: Column) -> Column:
    return F.asin(F.sin(lat) * F.sin(dec) + F.cos(lat) * F.cos(dec) * F.cos(ha))


def azimuth(lat: Column, ha: Column, dec: Column) -> Column:
    """From north through east."""
    return F.atan2(-F.cos(dec) * F.sin(ha), F.sin(dec) * F.cos(lat) - F.cos(dec) * F.cos(ha) * F.sin(lat))


def parallactic(lat: Column, ha: Column, dec: Column) -> Column:
    return F.atan2(F.cos(lat) * F.sin(ha), F.sin(lat) * F.cos(dec) - F.cos(lat) * F.sin(dec) * F.cos(ha))


def feed_angle(mount: Column, chi: Column, el: Column) -> Column:
    """Rotation of the feed on the sky by mount: alt-az turns, equatorial doesn't, Nasmyth adds or takes the elevation."""
    return F.when(mount == "equatorial", 0.0).when(mount == "nasmyth-r", chi + el).when(mount == "nasmyth-l", chi - el).otherwise(chi)


def separation(ra1: Column, dec1: Column, ra2: Column, dec2: Column) -> Column:
    h = F.sin((dec2 - dec1) / 2) ** 2 + F.cos(dec1) * F.cos(dec2) * F.sin((ra2 - ra1) / 2) ** 2
    return 2 * F.asin(F.least(F.lit(1.0), F.sqrt(h)))


def slant_factor(el: Column, height_m: float, radius_m: float = EARTH_M) -> Column:
    """Path through a thin shell over the vertical one."""
    x = radius_m / (radius_m + height_m) * F.cos(el)
    return 1 / F.sqrt(1 - x * x)


def pierce_point(lat: Column, lon: Column, az: Column, el: Column, height_m: float, radius_m: float = EARTH_M) -> C.Pair:
    """Latitude and longitude where the line of sight crosses the shell."""
    psi = math.pi / 2 - el - F.asin(radius_m / (radius_m + height_m) * F.cos(el))
    plat = F.asin(F.sin(lat) * F.cos(psi) + F.cos(lat) * F.sin(psi) * F.cos(az))
    return plat, lon + F.asin(F.sin(psi) * F.sin(az) / F.cos(plat))


def sigma_weight(sigma: Column) -> Column:
    return F.when(sigma > 0, 1 / (sigma * sigma)).otherwise(0.0)


def tsys_gain(tsys: Column) -> Column:
    """1 / sqrt(T), null where it isn't positive."""
    return F.when(tsys > 0, 1 / F.sqrt(tsys))


def resolution_mas(freq_hz: Column, baseline_m: Column) -> Column:
    return F.degrees(LIGHT / freq_hz / baseline_m) * 3600e3


def format_mjd(seconds: Column) -> Column:
    """'YYYY/MM/DD/hh:mm:ss.mmm', truncated."""
    ms = F.floor(F.round(seconds * 1e6) / 1e3).cast("long")
    at = F.timestamp_micros((ms * 1000 - 40587 * 86400 * 1000000).cast("long"))
    return F.date_format(at, "yyyy/MM/dd/HH:mm:ss.SSS")


def sexagesimal(deg: Column) -> Column:
    """'+dd:mm:ss' of an angle in degrees, seconds truncated."""
    s = F.floor(F.round(F.abs(deg) * 3600, 6)).cast("long")
    return F.concat(F.when(deg < 0, "-").otherwise("+"), F.format_string("%02d:%02d:%02d", F.floor(s / 3600), F.floor(s / 60) % 60, s % 60))


def vertical_tec(probes: DataFrame, maps: DataFrame, step: float, rotation: float = 1.0) -> DataFrame:
    """Add tec to probes (t in seconds, lat_deg, lon_deg): linear in time between the two maps around, each bilinear where the ionosphere above the point stood at its epoch.

    The ionosphere follows the Sun by `rotation` of a full turn a day: the earlier map is read that much
    further east, the later one further west; 0 leaves the maps fixed to the Earth. maps: epoch t, lat, lon on a
    grid of `step` degrees, tec. Latitudes beyond the grid take its edge; a grid of 360 degrees wraps in
    longitude, a smaller one gives null outside, as do times outside. Each grid cell carries its four
    corners, so a probe meets a map in one equality join.
    """
    la0, la1, lo0, lo1 = maps.agg(F.min("lat"), F.max("lat"), F.min("lon"), F.max("lon")).first()
    rows_, cols_ = round((la1 - la0) / step), round((lo1 - lo0) / step)
    wraps = abs(lo1 - lo0 - 360) < 1e-6
    j, i = F.round((F.col("lat") - la0) / step).cast("int"), F.round((F.col("lon") - lo0) / step).cast("int")
    corners = F.array(*[F.struct((j - a).alias("j"), (i - b).alias("i"), F.lit(2 * a + b).alias("k")) for a in (0, 1) for b in (0, 1)])
    cells = maps.select("t", "tec", F.explode(corners).alias("_c")).groupBy("t", "_c.j", "_c.i")
    cells = cells.agg(*[F.max(F.when(F.col("_c.k") == k, F.col("tec"))).alias(f"c{k}") for k in range(4)]).dropna(subset=["c0", "c1", "c2", "c3"])
    epochs = F.broadcast(maps.select("t").distinct().agg(F.sort_array(F.collect_list("t")).alias("_epochs")))  # one array: the epochs of one track
    p = probes.join(epochs)
    p = p.withColumns({"_t0": F.array_max(F.filter("_epochs", lambda e: e <= F.col("t"))), "_t1": F.array_min(F.filter("_epochs", lambda e: e >= F.col("t")))}).drop("_epochs")
    y = F.least(F.lit(float(rows_)), F.greatest(F.lit(0.0), (F.col("lat_deg") - la0) / step))
    p = p.withColumn("_y", y).withColumn("_j", F.least(F.floor("_y").cast("int"), F.lit(rows_ - 1)))
    values = []
    for n in (0, 1):
        x = (F.col("lon_deg") + 360.0 * rotation * (F.col("t") - F.col(f"_t{n}")) / 86400.0 - lo0) / step
        p = p.withColumn("_x", F.pmod(x, F.lit(float(cols_))) if wraps else F.when((x >= 0) & (x <= cols_), x))
        p = p.withColumn("_i", F.least(F.floor("_x").cast("int"), F.lit(cols_ - 1)))
        m = cells.select(F.col("t").alias(f"_t{n}"), F.col("j").alias("_j"), F.col("i").alias("_i"), *[F.col(f"c{k}").alias(f"_c{k}") for k in range(4)])
        p = p.join(m, [f"_t{n}", "_j", "_i"], "left")
        wy, wx = F.col("_y") - F.col("_j"), F.col("_x") - F.col("_i")
        p = p.withColumn(f"_v{n}", F.col("_c0") * (1 - wy) * (1 - wx) + F.col("_c1") * (1 - wy) * wx + F.col("_c2") * wy * (1 - wx) + F.col("_c3") * wy * wx).drop("_x", "_i", "_c0", "_c1", "_c2", "_c3")
        values.append(F.col(f"_v{n}"))
    w = F.when(F.col("_t1") > F.col("_t0"), (F.col("t") - F.col("_t0")) / (F.col("_t1") - F.col("_t0"))).otherwise(0.0)
    return p.withColumn("tec", F.when(F.col("_t1") == F.col("_t0"), values[0]).otherwise(values[0] * (1 - w) + values[1] * w)).select(*probes.columns, "tec")


def unwrap_in_time(rows: DataFrame, keys: list[str], order: list[str], time: str, angle: str, max_gap: float) -> DataFrame:
    """Add unwrapped: whole turns taken out between neighbours, anew after a gap in time."""
    w = Window.partitionBy(*keys).orderBy(*order)
    new = F.coalesce((F.col(time) - F.lag(time).over(w) > max_gap).cast("int"), F.lit(1))
    r = rows.withColumn("_new", new).withColumn("_turn", F.when(F.col("_new") == 1, 0.0).otherwise(-F.round((F.col(angle) - F.lag(angle).over(w)) / (2 * math.pi))))
    r = r.withColumn("_part", F.sum("_new").over(w))
    turns = F.sum("_turn").over(Window.partitionBy(*keys, "_part").orderBy(*order))
    return r.withColumn("unwrapped", F.col(angle) + 2 * math.pi * turns).drop("_new", "_turn", "_part")


def _sky(s, d):
    e = series(s, d).select("event_id", (F.lit(60310.0) * 86400 + F.col("t")).alias("mjd_s"), F.radians((F.col("user_id") % 60) - 10.0).alias("dec"), F.radians((F.col("user_id") * 7 % 360).cast("double")).alias("ra"))
    lat, lon = F.lit(math.radians(52.5)), F.lit(math.radians(6.6))
    ha = hour_angle(lon, F.col("ra"), F.col("mjd_s"))
    e = e.withColumn("ha", ha)
    el, az = elevation(lat, F.col("ha"), F.col("dec")), azimuth(lat, F.col("ha"), F.col("dec"))
    return e.select("event_id", F.round("ha", 6).alias("ha"), F.round(el, 6).alias("el"), F.round(az, 6).alias("az"), F.round(parallactic(lat, F.col("ha"), F.col("dec")), 6).alias("chi"), F.round(slant_factor(el, 450e3), 6).alias("slant"), F.round(pierce_point(lat, lon, az, el, 450e3)[0], 6).alias("pierce_lat"))


def _corrected(s, d):
    e = table(s, d, "embeddings").select("vec_id", F.slice("embedding", 1, 32).alias("re"), F.slice("embedding", 33, 32).alias("im"), F.lit(0.8).alias("gr"), (F.col("label") / 10.0 - 0.3).alias("gi"))
    out = e.withColumn("c", array_sum(C.array_correct(F.col("re"), F.col("im"), (F.col("gr"), F.col("gi")))))
    return out.select("vec_id", F.round("c.re", 6).alias("sum_re"), F.round("c.im", 6).alias("sum_im"))


def array_sum(cells: Column) -> Column:
    """Sum of an array of re, im structs."""
    zero = F.struct(F.lit(0.0).alias("re"), F.lit(0.0).alias("im"))
    return F.aggregate(cells, zero, lambda a, c: F.struct((a["re"] + c["re"]).alias("re"), (a["im"] + c["im"]).alias("im")))


def _formats(s, d):
    deg = (F.col("value") - 150) / 7
    return series(s, d).select("event_id", format_mjd(F.lit(60310.0) * 86400 + F.floor(F.col("us") / 1000) / 1000).alias("stamp"), sexagesimal(F.round(deg, 3)).alias("angle"))


def _unwrapped(s, d):
    a = series(s, d).withColumn("angle", F.round(F.col("value") % 6.0 - 3.0, 6))
    return unwrap_in_time(a, ["user_id"], ["us", "event_id"], "t", "angle", 43200.0).select("event_id", F.round("unwrapped", 5).alias("unwrapped"))


def _curve(s, d):
    c = F.array(F.lit(0.9), F.lit(0.004), F.lit(-0.00006))
    return series(s, d).select("event_id", F.round(F.sqrt(C.horner(c, F.col("value") % 80)), 8).alias("gain"))


def _maps(s, days, cols):
    k, lo = F.col("id"), F.col("id") % cols
    return s.range(days * 9 * cols).select((F.floor(k / (9 * cols)) * 86400.0).alias("t"), (F.floor(k / cols) % 9 * 10.0).alias("lat"), (lo * 10.0).alias("lon"), ((F.floor(k / cols) * 37 + lo % 36 * 53) % 101 / 4.0).alias("tec"))


def _probes(s, d):
    return series(s, d).select("event_id", "t", (F.col("value") % 100 - 5).alias("lat_deg"), (F.col("user_id") * 7 % 360 - 170.5).alias("lon_deg"))


def _tec(s, d):
    return vertical_tec(_probes(s, d), _maps(s, 31, 37), 10.0).select("event_id", F.round("tec", 6).alias("tec"))


def _tec_fixed(s, d):
    """A regional grid, fixed to the Earth."""
    return vertical_tec(_probes(s, d), _maps(s, 31, 9), 10.0, rotation=0.0).select("event_id", F.round("tec", 6).alias("tec"))


def _tec_sql(cols: int, rotation: float) -> str:
    x = f"(lo + 360.0::DOUBLE * {rotation} * (t - t{{n}}) / 86400.0) / 10"
    x = f"{x} - 36 * floor(({x}) / 36)" if cols == 37 else x
    q = ", ".join(f"{x.format(n=n)} AS x{n}" for n in (0, 1))
    value = lambda n: f"""(SELECT sum(m.tec * (CASE WHEN m.j = least(floor(y), 7) THEN 1 - (y - least(floor(y), 7)) ELSE y - least(floor(y), 7) END) * (CASE WHEN m.i = least(floor(x{n}), {cols - 2}) THEN 1 - (x{n} - least(floor(x{n}), {cols - 2})) ELSE x{n} - least(floor(x{n}), {cols - 2}) END))
        FROM m WHERE m.t = t{n} AND m.j IN (least(floor(y), 7), least(floor(y), 7) + 1) AND m.i IN (least(floor(x{n}), {cols - 2}), least(floor(x{n}), {cols - 2}) + 1) AND x{n} BETWEEN 0 AND {cols - 1} HAVING count(*) = 4) AS v{n}"""  # noqa: E731
    return f"""WITH {SERIES}, m AS (SELECT id // {9 * cols} * 86400.0::DOUBLE AS t, (id // {cols} % 9)::DOUBLE AS j, (id % {cols})::DOUBLE AS i, (id // {cols} * 37 + id % {cols} % 36 * 53) % 101 / 4.0::DOUBLE AS tec FROM range({31 * 9 * cols}) r(id)),
      p AS (SELECT event_id, t, floor(t / 86400) * 86400 AS t0, CASE WHEN ceil(t / 86400) <= 30 THEN ceil(t / 86400) * 86400 END AS t1, least(8.0, greatest(0.0, (value % 100 - 5) / 10)) AS y, user_id * 7 % 360 - 170.5::DOUBLE AS lo FROM ev),
      q AS (SELECT *, {q} FROM p), g AS (SELECT event_id, t, t0, t1, {value(0)}, {value(1)} FROM q)
      SELECT event_id, round(CASE WHEN t1 = t0 THEN v0 ELSE v0 * (1 - (t - t0) / (t1 - t0)) + v1 * (t - t0) / (t1 - t0) END, 6) AS tec FROM g"""


QUERIES = {"sky_angles": _sky, "complex_correct": _corrected, "text_formats": _formats, "unwrap_in_time": _unwrapped, "gain_curve": _curve, "vertical_tec": _tec, "vertical_tec_fixed": _tec_fixed}
_PI2 = "(2 * pi())"
SQL = {
    "sky_angles": f"""WITH {SERIES}, a AS (SELECT event_id, 60310.0::DOUBLE * 86400 + t AS m, radians((user_id % 60) - 10.0) AS dec, radians((user_id * 7 % 360)::DOUBLE) AS ra, radians(52.5) AS lat, radians(6.6) AS lon FROM ev),
      b AS (SELECT *, radians(fmod(280.46061837::DOUBLE + 360.98564736629::DOUBLE * (m / 86400.0 - 51544.5), 360.0)) + lon - ra AS h FROM a), c AS (SELECT *, h - {_PI2} * ceil((h - pi()) / {_PI2}) AS ha FROM b),
      e AS (SELECT *, asin(sin(lat) * sin(dec) + cos(lat) * cos(dec) * cos(ha)) AS el, atan2(-cos(dec) * sin(ha), sin(dec) * cos(lat) - cos(dec) * cos(ha) * sin(lat)) AS az FROM c),
      x AS (SELECT *, 6371000.0::DOUBLE / (6371000.0 + 450e3) * cos(el) AS x FROM e)
      SELECT event_id, round(ha, 6) AS ha, round(el, 6) AS el, round(az, 6) AS az, round(atan2(cos(lat) * sin(ha), sin(lat) * cos(dec) - cos(lat) * sin(dec) * cos(ha)), 6) AS chi, round(1 / sqrt(1 - x * x), 6) AS slant,
      round(asin(sin(lat) * cos(pi() / 2 - el - asin(x)) + cos(lat) * sin(pi() / 2 - el - asin(x)) * cos(az)), 6) AS pierce_lat FROM x""",
    "complex_correct": """WITH c AS (SELECT vec_id, 0.8::DOUBLE AS gr, label / 10.0::DOUBLE - 0.3::DOUBLE AS gi, CAST(unnest(embedding[1:32]) AS DOUBLE) AS x, CAST(unnest(embedding[33:64]) AS DOUBLE) AS y FROM embeddings)
      SELECT vec_id, round(sum((x * gr + y * gi) / (gr * gr + gi * gi)), 6) AS sum_re, round(sum((y * gr - x * gi) / (gr * gr + gi * gi)), 6) AS sum_im FROM c GROUP BY vec_id""",
    "text_formats": f"""WITH {SERIES}, a AS (SELECT event_id, ts, round((value - 150) / 7, 3) AS deg FROM ev), b AS (SELECT *, CAST(floor(round(abs(deg) * 3600, 6)) AS BIGINT) AS s FROM a)
      SELECT event_id, strftime(ts, '%Y/%m/%d/%H:%M:%S.%g') AS stamp, (CASE WHEN deg < 0 THEN '-' ELSE '+' END) || printf('%02d:%02d:%02d', s // 3600, s // 60 % 60, s % 60) AS angle FROM b""",
    "unwrap_in_time": f"""WITH {SERIES}, a AS (SELECT event_id, user_id, us, t, round(value % 6.0 - 3.0, 6) AS angle FROM ev),
      n AS (SELECT *, coalesce((t - lag(t) OVER w > 43200.0)::INT, 1) AS new, angle - lag(angle) OVER w AS d FROM a WINDOW w AS (PARTITION BY user_id ORDER BY us, event_id)),
      p AS (SELECT *, CASE WHEN new = 1 THEN 0.0 ELSE -round(d / {_PI2}) END AS turn, sum(new) OVER (PARTITION BY user_id ORDER BY us, event_id) AS part FROM n)
      SELECT event_id, round(angle + {_PI2} * sum(turn) OVER (PARTITION BY user_id, part ORDER BY us, event_id), 5) AS unwrapped FROM p""",
    "gain_curve": f"WITH {SERIES}, x AS (SELECT event_id, value % 80 AS x FROM ev) SELECT event_id, round(sqrt((-0.00006::DOUBLE * x + 0.004::DOUBLE) * x + 0.9::DOUBLE), 8) AS gain FROM x",
    "vertical_tec": _tec_sql(37, 1.0),
    "vertical_tec_fixed": _tec_sql(9, 0.0),
}
