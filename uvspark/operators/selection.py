"""Selections: the mini-languages for antennas, subbands and times, flag commands, interval coalescing, flag masks."""

from __future__ import annotations

import re
from datetime import datetime, timedelta

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..plans.model import SERIES, VIS, series, table, visibilities

EPOCH = datetime(1858, 11, 17)
HOUR_US = 3600 * 1000000


def parse_command(text: str) -> dict[str, str]:
    """key='value' pairs of a command line; values may be quoted or bare."""
    return {k: a or b or c for k, a, b, c in re.findall(r"(\w+)=(?:'([^']*)'|\"([^\"]*)\"|(\S+))", text)}


def command_tokens(rows: DataFrame, text: str) -> DataFrame:
    """parse_command on a column: one row per key, as key and value."""
    pair = r"(\w+)=('[^']*'|\S+)"
    hits = F.explode(F.regexp_extract_all(text, F.lit(pair), F.lit(0)))
    return rows.withColumn("_hit", hits).withColumns({"key": F.regexp_extract("_hit", pair, 1), "value": F.trim(F.regexp_extract("_hit", pair, 2), F.lit("'"))}).drop("_hit", text)


def parse_time(text: str, date: datetime | None = None) -> tuple[float, datetime]:
    """'YYYY/MM/DD/hh:mm:ss' or 'hh:mm:ss' on the date carried along, as MJD seconds, and the date."""
    day, _, clock = text.strip().rpartition("/")
    if day:
        date = datetime.strptime(day, "%Y/%m/%d")
    elif clock.count(":") < 1:
        raise ValueError(f"no time in {text!r}")
    if date is None:
        raise ValueError(f"no date for {text!r}")
    parts = [float(x) for x in clock.split(":")] + [0.0, 0.0]
    return (date - EPOCH).total_seconds() + parts[0] * 3600 + parts[1] * 60 + parts[2], date


def parse_timerange(text: str) -> list[tuple[float, float]]:
    """Comma-separated 'a~b' ranges, inclusive; the start's date carries to the end."""
    out = []
    for part in filter(None, (p.strip() for p in text.split(","))):
        a, _, b = part.partition("~")
        start, date = parse_time(a)
        out.append((start, parse_time(b, date)[0] if b else start))
    return out


def parse_numbers(text: str, upper: int) -> list[int]:
    """'1,3~5' as numbers below upper; '' and '*' are all."""
    if text.strip() in ("", "*"):
        return list(range(upper))
    out = set()
    for part in text.split(","):
        a, _, b = part.strip().partition("~")
        out |= set(range(int(a), int(b or a) + 1))
    return sorted(x for x in out if 0 <= x < upper)


def parse_spw(text: str, nspw: int, nchan: int) -> dict[int, list[tuple[int, int]]]:
    """'0:1~3;5,2' as channel ranges per subband; '*:0~3' for each of them. A subband that isn't there raises ValueError."""
    out: dict[int, list[tuple[int, int]]] = {}
    for part in filter(None, (p.strip() for p in (text or "*").split(","))):
        spws, _, chans = part.partition(":")
        ranges = []
        for piece in filter(None, chans.split(";")):
            a, _, b = piece.partition("~")
            ranges.append((int(a), min(int(b or a), nchan - 1)))
        known = parse_numbers(spws, nspw)
        if spws.strip() not in ("", "*") and len(known) < len(parse_numbers(spws, 1 << 20)):
            raise ValueError(f"{spws!r} names subbands beyond the {nspw} there are")
        for spw in known:
            out.setdefault(spw, []).extend(ranges or [(0, nchan - 1)])
    return out


def parse_antenna(text: str, names: list[str]) -> tuple[set[int], set[tuple[int, int]]]:
    """'A;B&C' as antenna ids and baselines; 'A&' or 'A&*' are all of A's baselines; autocorrelations excluded. Case doesn't matter."""
    index = {n.lower(): i for i, n in enumerate(names)}
    ids, pairs = set(), set()
    for part in filter(None, (p.strip() for p in re.split("[;,]", text))):
        a, amp, b = (x.strip().lower() for x in part.partition("&"))
        if unknown := {a, b} - {"", "*", *index}:
            raise ValueError(f"unknown antenna {', '.join(sorted(unknown))}")
        if not amp:
            ids.add(index[a])
        else:
            for j in [index[b]] if b not in ("", "*") else range(len(names)):
                if j != index[a]:
                    pairs.add((min(index[a], j), max(index[a], j)))
    return ids, pairs


def parse_solint(text: str) -> float:
    """Seconds of a solution interval: 'inf' is endless, 'int' zero, else a number with s, min or h."""
    text = text.strip().lower()
    if text in ("inf", ""):
        return float("inf")
    if text == "int":
        return 0.0
    number, unit = re.fullmatch(r"([0-9.]+)\s*(s|sec|min|m|h|hr)?", text).groups()
    return float(number) * {"s": 1, "sec": 1, None: 1, "m": 60, "min": 60, "h": 3600, "hr": 3600}[unit]


def channel_mask(ranges: list[tuple[int, int]], nchan: int) -> Column:
    """Boolean array over channels."""
    inside = lambda c: F.exists(F.array(*[F.struct(F.lit(a).alias("a"), F.lit(b).alias("b")) for a, b in ranges]), lambda r: c.between(r["a"], r["b"]))
    return F.transform(F.sequence(F.lit(0), F.lit(nchan - 1)), inside if ranges else lambda c: F.lit(False))


def compile_selection(params: dict[str, str], antennas: list[str], nspw: int, nchan: int) -> Column:
    """Row condition of a command over antenna1, antenna2, scan, ddid and mjd_s. Unknown keys raise."""
    known = {"mode", "antenna", "scan", "spw", "timerange", "reason", "flagbackup"}
    if extra := set(params) - known:
        raise ValueError(f"unsupported keys: {sorted(extra)}")
    cond = F.lit(True)
    if params.get("antenna"):
        ids, pairs = parse_antenna(params["antenna"], antennas)
        hit = F.lit(False)
        for i in ids:
            hit = hit | (F.col("antenna1") == i) | (F.col("antenna2") == i)
        for a, b in pairs:
            hit = hit | ((F.col("antenna1") == a) & (F.col("antenna2") == b))
        cond = cond & hit
    if params.get("scan"):
        cond = cond & F.col("scan").isin(parse_numbers(params["scan"], 1 << 20))
    if params.get("spw"):
        cond = cond & F.col("ddid").isin(list(parse_spw(params["spw"], nspw, nchan)))
    if params.get("timerange"):
        hit = F.lit(False)
        for a, b in parse_timerange(params["timerange"]):
            hit = hit | F.col("mjd_s").between(a, b)
        cond = cond & hit
    return cond


def apply_commands(vis: DataFrame, commands: list[str], antennas: list[str], nspw: int, nchan: int) -> DataFrame:
    """Update `flag` by commands in order: mode='unflag' clears, all others set."""
    flag = F.col("flag")
    for text in commands:
        params = parse_command(text)
        hit = compile_selection(params, antennas, nspw, nchan)
        flag = (flag & ~hit) if params.get("mode") == "unflag" else (flag | hit)
    return vis.withColumn("flag", flag)


def merge_intervals(rows: DataFrame, keys: list[str], start: str, end: str) -> DataFrame:
    """Coalesce overlapping or touching intervals per key."""
    before = Window.partitionBy(*keys).orderBy(start, end).rowsBetween(Window.unboundedPreceding, -1)
    upto = Window.partitionBy(*keys).orderBy(start, end)
    new = (F.max(end).over(before).isNull() | (F.col(start) > F.max(end).over(before))).cast("int")
    isle = rows.withColumn("_new", new).withColumn("_isle", F.sum("_new").over(upto))
    return isle.groupBy(*keys, "_isle").agg(F.min(start).alias(start), F.max(end).alias(end), F.count("*").alias("n")).drop("_isle")


def inside_intervals(rows: DataFrame, time: str, unique: str, intervals: DataFrame, on: Column, start: str, end: str, width: int) -> DataFrame:
    """Add hit: the time lies in some interval (closed) that `on` matches.

    Both sides meet on time buckets of `width`; an interval stands in every bucket it touches, so no
    pair outside of a bucket is compared.
    """
    ivals = intervals.withColumn("_bucket", F.explode(F.sequence(F.floor(F.col(start) / width), F.floor(F.col(end) / width)))).alias("i")
    probe = rows.withColumn("_bucket", F.floor(F.col(time) / width)).alias("r")
    cond = (F.col("r._bucket") == F.col("i._bucket")) & F.col(f"r.{time}").between(F.col(f"i.{start}"), F.col(f"i.{end}")) & on
    hits = probe.join(ivals, cond, "left_semi").select(F.col(f"r.{unique}").alias("_u"))
    return rows.join(hits, F.col(unique) == F.col("_u"), "left").withColumn("hit", F.col("_u").isNotNull()).drop("_u")


def flag_masks(rows: DataFrame, flag: str, masks: list[tuple[Column, Column, bool]]) -> DataFrame:
    """Fold (row condition, cell mask, unflag) into a flag array in order; add changed, the number of cells that differ."""
    out = F.col(flag)
    for cond, mask, unflag in masks:
        both = F.zip_with(out, mask, (lambda a, b: a & ~b) if unflag else (lambda a, b: a | b))
        out = F.when(cond, both).otherwise(out)
    new = rows.withColumn("_flag", out)
    changed = F.size(F.filter(F.zip_with(flag, "_flag", lambda a, b: a != b), lambda x: x))
    return new.withColumn("changed", changed).withColumn(flag, F.col("_flag")).drop("_flag")


def cross_groups(vis: DataFrame, groups: DataFrame) -> DataFrame:
    """Baselines between antennas of different groups (antenna, grp); antennas in no group are left alone."""
    one = F.broadcast(groups.select(F.col("antenna").alias("antenna1"), F.col("grp").alias("g1")))
    two = F.broadcast(groups.select(F.col("antenna").alias("antenna2"), F.col("grp").alias("g2")))
    return vis.join(one, "antenna1").join(two, "antenna2").filter("g1 <> g2")


def central_channels(nchan: int, fraction: float) -> tuple[int, int]:
    """First and one past the last of the central fraction of the channels, three at least."""
    drop = min(round(nchan * (1 - fraction) / 2), max(0, (nchan - 3) // 2))
    return drop, nchan - drop


def flag_runs(rows: DataFrame, keys: list[str], order: str, flagged: str) -> DataFrame:
    """Runs of consecutive flagged rows per key: first, last, length."""
    w = Window.partitionBy(*keys).orderBy(order)
    r = rows.withColumn("_isle", F.row_number().over(w) - F.sum(F.col(flagged).cast("int")).over(w)).filter(flagged)
    return r.groupBy(*keys, "_isle").agg(F.min(order).alias("first"), F.max(order).alias("last"), F.count("*").alias("n")).drop("_isle")


def _commands(s, d):
    n = table(s, d, "nation")
    return n.select((F.col("n_nationkey") * 6).alias("u0"), (F.col("n_nationkey") * 6 + 8).alias("u1"), (F.col("n_nationkey") * 24 * HOUR_US).alias("t0"), ((F.col("n_nationkey") * 24 + 30) * HOUR_US).alias("t1"))


_COMMANDS = f"cm AS (SELECT n_nationkey * 6 AS u0, n_nationkey * 6 + 8 AS u1, n_nationkey::BIGINT * 24 * {HOUR_US} AS t0, (n_nationkey::BIGINT * 24 + 30) * {HOUR_US} AS t1 FROM nation)"


def _applied(s, d):
    on = F.col("r.user_id").between(F.col("i.u0"), F.col("i.u1"))
    hit = inside_intervals(series(s, d), "us", "event_id", _commands(s, d), on, "t0", "t1", 24 * HOUR_US)
    return hit.groupBy("user_id").agg(F.count("*").alias("n"), F.sum(F.col("hit").cast("long")).alias("n_flagged"))


def _masked(s, d):
    rows = table(s, d, "embeddings").select("vec_id", "label", F.transform("embedding", lambda x: F.abs(x.cast("double")) > 0.2).alias("flag"))
    edge, mid = channel_mask([(0, 3), (60, 63)], 64), channel_mask([(2, 12)], 64)
    out = flag_masks(rows, "flag", [(F.col("label") < 5, edge, False), (F.col("label") % 2 == 0, mid, True)])
    return out.select("vec_id", "changed", F.size(F.filter("flag", lambda x: x)).alias("n_flagged"))


def _tokens(s, d):
    text = F.concat(F.lit("mode='manual' antenna='"), F.col("n_name"), F.lit("' spw='0:1~"), F.col("n_regionkey"), F.lit("' reason=late"))
    return command_tokens(table(s, d, "nation").select("n_nationkey", text.alias("text")), "text")


def _selected(s, d):
    vis = visibilities(s, d)
    out = apply_commands(vis, ["mode='manual' antenna='A1;A2&A5' scan='10~40'", "mode='unflag' spw='2~3' antenna='A1'"], [f"A{i}" for i in range(8)], 8, 64)
    return out.groupBy("antenna1", "antenna2").agg(F.count("*").alias("n"), F.sum(F.col("flag").cast("long")).alias("n_flagged"))


def _crossed(s, d):
    groups = s.range(8).select(F.col("id").cast("int").alias("antenna"), F.when(F.col("id") < 3, "west").otherwise("east").alias("grp"))
    return cross_groups(visibilities(s, d), groups).groupBy("scan").agg(F.count("*").alias("n_cross"))


QUERIES = {
    "merge_intervals": lambda s, d: merge_intervals(series(s, d).select("event_type", F.col("us").alias("t0"), (F.col("us") + 1200000000).alias("t1")), ["event_type"], "t0", "t1"),
    "flag_commands_apply": _applied,
    "flag_mask_arrays": _masked,
    "command_tokens": _tokens,
    "selection_apply": _selected,
    "cross_subarrays": _crossed,
    "flag_runs": lambda s, d: flag_runs(series(s, d).withColumn("bad", F.col("value") > 60), ["user_id"], "us", "bad"),
}
SQL = {
    "merge_intervals": f"""WITH {SERIES}, i AS (SELECT event_type, us AS t0, us + 1200000000 AS t1 FROM ev),
      n AS (SELECT *, CASE WHEN t0 <= max(t1) OVER (PARTITION BY event_type ORDER BY t0, t1 ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) THEN 0 ELSE 1 END AS new FROM i),
      k AS (SELECT *, sum(new) OVER (PARTITION BY event_type ORDER BY t0, t1) AS isle FROM n)
      SELECT event_type, min(t0) AS t0, max(t1) AS t1, count(*) AS n FROM k GROUP BY event_type, isle""",
    "flag_commands_apply": f"WITH {SERIES}, {_COMMANDS} SELECT user_id, count(*) AS n, CAST(sum(CASE WHEN EXISTS (SELECT 1 FROM cm WHERE user_id BETWEEN u0 AND u1 AND us BETWEEN t0 AND t1) THEN 1 ELSE 0 END) AS BIGINT) AS n_flagged FROM ev GROUP BY user_id",
    "flag_mask_arrays": """WITH c AS (SELECT vec_id, label, generate_subscripts(embedding, 1) - 1 AS ch, abs(CAST(unnest(embedding) AS DOUBLE)) > 0.2 AS f FROM embeddings),
      a AS (SELECT *, CASE WHEN label < 5 THEN f OR ch <= 3 OR ch >= 60 ELSE f END AS g FROM c), b AS (SELECT *, CASE WHEN label % 2 = 0 THEN g AND NOT (ch BETWEEN 2 AND 12) ELSE g END AS h FROM a)
      SELECT vec_id, CAST(sum(CASE WHEN f <> h THEN 1 ELSE 0 END) AS INT) AS changed, CAST(sum(CASE WHEN h THEN 1 ELSE 0 END) AS INT) AS n_flagged FROM b GROUP BY vec_id""",
    "command_tokens": "SELECT n_nationkey, 'mode' AS key, 'manual' AS value FROM nation UNION ALL SELECT n_nationkey, 'antenna', n_name FROM nation UNION ALL SELECT n_nationkey, 'spw', '0:1~' || n_regionkey FROM nation UNION ALL SELECT n_nationkey, 'reason', 'late' FROM nation",
    "selection_apply": f"""WITH {VIS}, a AS (SELECT *, flag OR ((antenna1 = 1 OR antenna2 = 1 OR (antenna1 = 2 AND antenna2 = 5)) AND scan BETWEEN 10 AND 40) AS f FROM vis),
      b AS (SELECT *, f AND NOT (ddid BETWEEN 2 AND 3 AND (antenna1 = 1 OR antenna2 = 1)) AS g FROM a) SELECT antenna1, antenna2, count(*) AS n, CAST(sum(g::INT) AS BIGINT) AS n_flagged FROM b GROUP BY ALL""",
    "cross_subarrays": f"WITH {VIS} SELECT scan, count(*) AS n_cross FROM vis WHERE (antenna1 < 3) <> (antenna2 < 3) GROUP BY scan",
    "flag_runs": f"WITH {SERIES}, r AS (SELECT user_id, us, value > 60 AS bad, row_number() OVER w - sum((value > 60)::INT) OVER w AS isle FROM ev WINDOW w AS (PARTITION BY user_id ORDER BY us)) SELECT user_id, min(us) AS first, max(us) AS last, count(*) AS n FROM r WHERE bad GROUP BY user_id, isle",
}
