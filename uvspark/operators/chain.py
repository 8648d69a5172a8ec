"""Deferred calibration: chains of solution tables per field, kept as a table and turned into a plan on read.

Solutions are found by subband, antenna and hand, and brought to the channels that are read before they meet the data.
Fringe solutions stay parameters: phase, delay and dispersive delay are interpolated in time, and only the difference
of the two antennas becomes angles of cells.
"""

from __future__ import annotations

import json
import math
import uuid
from dataclasses import dataclass, field, replace

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..functions.complexes import dispersion
from ..plans.model import table
from .calibrate import _between, _count_until
from .ranks import shared_folder

#: Largest lists of solutions that are broadcast, in bytes; solutions of a series in a time bucket beyond it, on average.
BROADCAST_BYTES, IN_BUCKET = 64_000_000, 64


@dataclass(frozen=True)
class Step:
    """A solution table in a chain.

    kind "gain": solutions (spw, antenna, t, hand, flag; arrays freqs, amp, phase, bad over the table's channels,
    in order of frequency). kind "fringe": solutions (spw, antenna, t, hand, flag, phase, delay in ns, rate, disp), with the
    reference frequency of each subband of the table. spwmap[i] is the table's subband for the data's subband i.
    """

    solutions: DataFrame
    kind: str = "gain"
    interp: str = "linear"
    spwmap: tuple[int, ...] | None = None
    reference: dict[int, float] = field(default_factory=dict)
    phase_only: bool = False
    weigh: bool = True


def spectral_windows(spark: SparkSession, freqs: dict[int, list[float]]) -> DataFrame:
    """(spw, freqs, fmin, fmax): the data's subbands. They are a few dozen and are broadcast."""
    return spark.createDataFrame([(k, f, min(f), max(f)) for k, f in freqs.items()], "spw int, freqs array<double>, fmin double, fmax double")


def cut_channels(windows: DataFrame, channels: list[int]) -> DataFrame:
    return windows.withColumn("freqs", F.transform(F.array(*map(F.lit, channels)), lambda c: F.get("freqs", c)))


def _mapped(windows: DataFrame, spwmap: tuple[int, ...] | None) -> DataFrame:
    """windows with the table's subband `_from` of each."""
    if spwmap is None:
        return windows.withColumn("_from", F.col("spw"))
    return windows.withColumn("_from", F.get(F.array(*map(F.lit, spwmap)), F.col("spw"))).filter(F.col("_from").isNotNull())


def on_channels(freqs: Column, amp: Column, phase: Column, bad: Column, at: Column) -> Column:
    """Amplitudes and phases of a table's channels at other frequencies: array of structs a, p.

    Flagged channels (and amplitudes of zero and less) are interpolated across: amplitude linearly, phase along the
    shorter arc, the nearest one beyond the ends. One channel serves all. Null without a usable channel.
    """
    turn = lambda d: d - 2 * math.pi * F.ceil((d - math.pi) / (2 * math.pi))
    once = lambda value, body: F.get(F.transform(F.array(value), body), 0)
    cells = F.filter(F.transform(F.arrays_zip(freqs.alias("f"), amp.alias("a"), phase.alias("p"), bad.alias("b")), lambda c: c), lambda c: ~c["b"] & (c["a"] > 0))

    def one(x: Column, cells: Column) -> Column:
        # How many usable channels lie at x or below.
        below = F.size(F.filter(cells, lambda c: c["f"] <= x))

        def blend(k: Column) -> Column:
            lo, hi = F.get(cells, F.greatest(k - 1, F.lit(0))), F.get(cells, F.least(k, F.size(cells) - 1))
            w = F.when(hi["f"] > lo["f"], (x - lo["f"]) / (hi["f"] - lo["f"])).otherwise(0.0)
            w = F.when(k == 0, 0.0).otherwise(w)
            return F.struct((lo["a"] + w * (hi["a"] - lo["a"])).alias("a"), (lo["p"] + w * turn(hi["p"] - lo["p"])).alias("p"))

        return once(below, blend)

    few = F.size(freqs) == 1
    return once(cells, lambda c: F.when(F.size(c) > 0, F.when(few, c_first(c)).otherwise(F.transform(at, lambda x: one(x, c)))))


def c_first(cells: Column) -> Column:
    return F.array(F.struct(F.get(cells, 0)["a"].alias("a"), F.get(cells, 0)["p"].alias("p")))


def solutions_of(step: Step, windows: DataFrame) -> DataFrame:
    """Unflagged solutions of the data's subbands: spw, antenna, hand and a struct s that begins with the time."""
    good = step.solutions.filter(~F.col("flag")).withColumnRenamed("spw", "_from")
    met = good.join(F.broadcast(_mapped(windows, step.spwmap).select("spw", "_from", F.col("freqs").alias("_at"))), "_from")
    if step.kind == "fringe":
        return met.select("spw", "antenna", "hand", F.struct("t", "phase", "delay", "rate", "disp").alias("s"))
    cells = met.withColumn("_c", on_channels(F.col("freqs"), F.col("amp"), F.col("phase"), F.col("bad"), F.col("_at"))).filter("_c IS NOT NULL")
    return cells.select("spw", "antenna", "hand", F.struct("t", F.transform("_c", lambda c: c["a"]).alias("amp"), F.transform("_c", lambda c: c["p"]).alias("phase")).alias("s"))


def _lists(solutions: DataFrame, *more: str) -> DataFrame:
    """_by: per key the solutions of each hand, by time."""
    per = solutions.groupBy("spw", "antenna", *more, "hand").agg(F.sort_array(F.collect_list("s")).alias("_l"))
    return per.groupBy("spw", "antenna", *more).agg(F.map_from_entries(F.collect_list(F.struct("hand", "_l"))).alias("_by"))


def meet(rows: DataFrame, solutions: DataFrame, channels: int) -> DataFrame:
    """rows with the solutions of both antennas, _by1 and _by2.

    Lists of at most BROADCAST_BYTES are broadcast: the data isn't moved. Beyond it the lists are cut to time buckets, each with
    the solutions around it, and the data meets them on (subband, antenna, bucket).
    """
    n, series, first, last = solutions.agg(F.count("*"), F.count_distinct("spw", "antenna", "hand"), F.min("s.t"), F.max("s.t")).first()
    if n * (48 + 16 * channels) <= BROADCAST_BYTES:
        lists, on, bucket = F.broadcast(_lists(solutions)), ["spw"], None
    else:
        width = max((last - first) * IN_BUCKET * series / n, 1e-3)
        at = lambda t: F.floor((t - first) / width)
        w = Window.partitionBy("spw", "antenna", "hand").orderBy("s.t")
        before, after = F.coalesce(F.lag("s.t").over(w), F.lit(first)), F.coalesce(F.lead("s.t").over(w), F.lit(last))
        placed = solutions.withColumns({"_a": at(before), "_b": at(after)}).withColumn("_bucket", F.explode(F.sequence("_a", "_b"))).drop("_a", "_b")
        lists, on = _lists(placed, "_bucket"), ["spw", "_bucket"]
        bucket = F.greatest(at(F.lit(first)), F.least(at(F.lit(last)), at(F.col("t"))))
        rows = rows.withColumn("_bucket", bucket)
    for end in (1, 2):
        rows = rows.join(lists.select(*on, F.col("antenna").alias(f"antenna{end}"), F.col("_by").alias(f"_by{end}")), [*on, f"antenna{end}"], "left")
    return rows.drop("_bucket")


def _fringe_at(lo: Column, hi: Column, t: Column, turn: Column, interp: str) -> Column:
    """Struct p, d, x of a fringe at a time: the phase of each solution is advanced by its own rate; between two the weighted phasors' argument, delay and dispersion linearly."""
    alone = lambda s: F.struct((s["phase"] + turn * s["rate"] * (t - s["t"])).alias("p"), s["delay"].alias("d"), s["disp"].alias("x"))
    if interp == "nearest":
        near = F.when(hi.isNull() | (t - lo["t"] <= hi["t"] - t), F.coalesce(lo, hi)).otherwise(F.coalesce(hi, lo))
        return F.when(near.isNotNull(), alone(near))
    w = (t - lo["t"]) / (hi["t"] - lo["t"])
    a, b = (s["phase"] + turn * s["rate"] * (t - s["t"]) for s in (lo, hi))
    angle = F.atan2((1 - w) * F.sin(a) + w * F.sin(b), (1 - w) * F.cos(a) + w * F.cos(b))
    both = F.struct(angle.alias("p"), ((1 - w) * lo["delay"] + w * hi["delay"]).alias("d"), ((1 - w) * lo["disp"] + w * hi["disp"]).alias("x"))
    return F.when(lo.isNull() & hi.isNull(), None).when(lo.isNull(), alone(hi)).when(hi.isNull(), alone(lo)).otherwise(both)


def apply_chain(rows: DataFrame, steps: list[Step], windows: DataFrame, nchan: int, hands: int = 2, keep_flags: bool = False) -> DataFrame:
    """Divide complex cells by the gains of both antennas through a chain of tables.

    rows: spw, antenna1, antenna2, t, arrays re, im, flags (nchan * hands cells, hand fastest), weight (one per
    hand). windows: their subbands with the frequencies of those channels. Cells without a solution of both antennas in
    every step are flagged and keep their value; keep_flags leaves the flags as they were. Weights are scaled by the mean
    squared amplitude of the steps that weigh.
    """
    columns = rows.columns
    refs = windows
    for i, s in enumerate(steps):
        if s.kind == "fringe":
            known = F.create_map(*[F.lit(x) for pair in s.reference.items() for x in pair])
            mapped = F.get(F.array(*map(F.lit, s.spwmap)), F.col("spw")) if s.spwmap else F.col("spw")
            refs = refs.withColumn(f"_ref{i}", F.try_element_at(known, mapped))
    rows = rows.join(F.broadcast(refs.withColumnRenamed("freqs", "_f")), "spw")
    gains, fringes = [], []
    for i, s in enumerate(steps):
        solutions = solutions_of(s, windows)
        rows = meet(rows, solutions, nchan if s.kind == "gain" else 2)
        for end in (1, 2):
            for h in range(hands):
                name = f"{i}_{end}{h}"
                rows = rows.withColumn("_s", F.try_element_at(F.col(f"_by{end}"), F.lit(h))).withColumn("_n", _count_until(F.col("_s"), F.col("t")))
                lo, hi = F.get("_s", F.col("_n") - 1), F.get("_s", F.col("_n"))
                rows = rows.withColumns({"_lo": lo, "_hi": hi})
                if s.kind == "fringe":
                    rows = rows.withColumn(f"_x{name}", _fringe_at(F.col("_lo"), F.col("_hi"), F.col("t"), 2 * math.pi * F.col(f"_ref{i}"), s.interp))
                else:
                    amp, phase = _between(F.col("_lo"), F.col("_hi"), F.col("t"), s.interp)
                    rows = rows.withColumns({f"_a{name}": amp, f"_p{name}": phase})
            rows = rows.drop(f"_by{end}", "_s", "_n", "_lo", "_hi")
        (fringes if s.kind == "fringe" else gains).append((i, s))

    k = F.sequence(F.lit(0), F.lit(nchan - 1))
    cell = lambda c, i: F.get(F.col(c), F.least(i, F.size(c) - 1))  # noqa: E731  one node serves all channels
    for h in range(hands):
        known = [F.col(f"_x{i}_{e}{h}").isNotNull() for i, _ in fringes for e in (1, 2)] + [F.col(f"_a{i}_{e}{h}").isNotNull() for i, _ in gains for e in (1, 2)]
        level = lambda c, only, h=h: math.prod([cell(f"_a{i}_{e}{h}", c) for i, s in gains for e in (1, 2) if only(s)], start=F.lit(1.0))
        difference = lambda i, part, h=h: F.col(f"_x{i}_1{h}")[part] - F.col(f"_x{i}_2{h}")[part]

        def angle(c, h=h):
            out = sum((cell(f"_p{i}_1{h}", c) - cell(f"_p{i}_2{h}", c) for i, _ in gains), F.lit(0.0))
            f = F.get("_f", c)
            for i, _ in fringes:
                out = out + difference(i, "p", h) + 2e-9 * math.pi * difference(i, "d", h) * (f - F.col(f"_ref{i}"))
                out = out + F.when(difference(i, "x", h) != 0, difference(i, "x", h) * 2e6 * math.pi * dispersion(f, F.col("fmin"), F.col("fmax"))).otherwise(0.0)
            return out

        all_known = F.forall(F.array(*known), lambda x: x) if known else F.lit(True)
        # One struct per channel: cosine and sine are made once.
        both = F.transform(k, lambda c: F.struct(F.cos(angle(c)).alias("c"), F.sin(angle(c)).alias("s"), level(c, lambda s: not s.phase_only).alias("a"), level(c, lambda s: s.weigh and not s.phase_only).alias("w")))
        rows = rows.withColumn(f"_g{h}", F.when(all_known, both))
    at = lambda i: F.get(F.get(F.array(*[F.col(f"_g{h}") for h in range(hands)]), i % hands), F.floor(i / hands).cast("int"))
    good = lambda i: F.coalesce(at(i)["a"] > 0, F.lit(False))
    out = F.transform("re", lambda x, i: F.when(good(i), F.struct(((x * at(i)["c"] + F.get("im", i) * at(i)["s"]) / at(i)["a"]).alias("re"), ((F.get("im", i) * at(i)["c"] - x * at(i)["s"]) / at(i)["a"]).alias("im"))).otherwise(F.struct(x.cast("double").alias("re"), F.get("im", i).cast("double").alias("im"))))

    def scaled(w, h):
        g = F.filter(F.get(F.array(*[F.col(f"_g{x}") for x in range(hands)]), h), lambda c: c["a"] > 0)
        return w * F.when(F.size(g) > 0, F.aggregate(g, F.lit(0.0), lambda a, c: a + c["w"] * c["w"]) / F.size(g)).otherwise(1.0)

    rows = rows.withColumns({"_out": out, "weight": F.transform("weight", scaled)})
    if not keep_flags:
        rows = rows.withColumn("flags", F.transform("flags", lambda f, i: f | ~good(i)))
    return rows.withColumns({"re": F.transform("_out", lambda c: c["re"]), "im": F.transform("_out", lambda c: c["im"])}).select(*columns)


class CalibratedView:
    """The fact table as its fields' chains would leave it, computed on read.

    Nothing is stored but the chains. A read takes the selection and the cut to channels first: filters reach the scan, cells are
    cut before they are corrected, and gains are made for the channels read only. Fields without a chain come as they are.
    """

    def __init__(self, rows: DataFrame, windows: DataFrame, chains: dict[int, list[Step]], nchan: int, hands: int = 2, keep_flags: tuple[int, ...] = ()):
        self.rows, self.windows, self.chains, self.nchan, self.hands, self.keep_flags = rows, windows, chains, nchan, hands, keep_flags

    def read(self, where: Column | None = None, channels: list[int] | None = None) -> DataFrame:
        rows = self.rows if where is None else self.rows.filter(where)
        windows, n = self.windows, self.nchan
        if channels is not None:
            index = F.array(*[F.lit(c * self.hands + h) for c in channels for h in range(self.hands)])
            pick = lambda name: F.transform(index, lambda i: F.get(F.col(name), i))
            rows = rows.withColumns({c: pick(c) for c in ("re", "im", "flags")})
            windows, n = cut_channels(windows, channels), len(channels)
        groups: dict[tuple, list[int]] = {}
        for f, steps in self.chains.items():
            groups.setdefault((tuple(map(id, steps)), f in self.keep_flags), []).append(f)
        out = rows.filter(F.col("field").isNull() | ~F.col("field").isin(list(self.chains))) if self.chains else rows
        out = out.withColumns({c: F.col(c).cast("array<double>") for c in ("re", "im", "weight")})
        for (_, keep), fields in groups.items():
            out = out.unionByName(apply_chain(rows.filter(F.col("field").isin(fields)), self.chains[fields[0]], windows, n, self.hands, keep))
        return out


def save_chains(spark: SparkSession, path: str, chains: dict[int, list[tuple[str, Step]]]) -> None:
    """Keep chains: per field its steps and the path of each step's solutions. Solutions are written once per path."""
    written, rows = set(), []
    for f, steps in chains.items():
        for place, (where, s) in enumerate(steps):
            if where not in written:
                s.solutions.write.mode("overwrite").parquet(where)
                written.add(where)
            rows.append((f, place, where, json.dumps({"kind": s.kind, "interp": s.interp, "spwmap": s.spwmap, "reference": s.reference, "phase_only": s.phase_only, "weigh": s.weigh})))
    spark.createDataFrame(rows, "field int, place int, path string, step string").coalesce(1).write.mode("overwrite").parquet(path)


def load_chains(spark: SparkSession, path: str) -> dict[int, list[Step]]:
    """The chains that save_chains kept, with a plan for each table of solutions."""
    steps: dict[tuple, Step] = {}
    out: dict[int, list[Step]] = {}
    for r in spark.read.parquet(path).orderBy("field", "place").collect():
        if (r.path, r.step) not in steps:
            p = json.loads(r.step)
            p |= {"spwmap": tuple(p["spwmap"]) if p["spwmap"] else None, "reference": {int(k): v for k, v in p["reference"].items()}}
            steps[r.path, r.step] = Step(spark.read.parquet(r.path), **p)
        out.setdefault(r.field, []).append(steps[r.path, r.step])
    return out


def reference_only(step: Step) -> Step:
    """The step applied in phase alone."""
    return replace(step, phase_only=True)


NCHAN = 16


def _rows(s, d) -> DataFrame:
    """Embeddings as rows of 16 channels and two hands, in two subbands and three fields."""
    e, k = table(s, d, "embeddings"), F.col("vec_id")
    double = lambda a: F.transform(F.slice("embedding", a, 32), lambda x: x.cast("double"))
    return e.select(
        "vec_id", (k % 3).cast("int").alias("field"), (k % 2).cast("int").alias("spw"), (k % 5).cast("int").alias("antenna1"), (F.lit(5) + k % 3).cast("int").alias("antenna2"), (k * 60.0).alias("t"),
        double(1).alias("re"), double(33).alias("im"), F.transform(F.slice("embedding", 1, 32), lambda x: x > 0.3).alias("flags"), F.array(F.lit(1.0), F.lit(2.0)).alias("weight"),
    )


def _windows(s) -> DataFrame:
    return spectral_windows(s, {0: [5e9 + 1e6 * c for c in range(NCHAN)], 1: [5.1e9 + 2e6 * c for c in range(NCHAN)]})


def _gains(s, d) -> DataFrame:
    """One amplitude and phase per supplier, day and hand: antennas by supplier."""
    k, n = F.col("s_suppkey"), F.col("s_nationkey")
    rows = table(s, d, "supplier").filter("s_suppkey <= 80").crossJoin(s.range(2).select(F.col("id").cast("int").alias("hand")))
    return rows.select(
        F.lit(0).alias("spw"), (k % 8).cast("int").alias("antenna"), (F.floor(k / 8) * 3000.0).alias("t"), "hand", ((k + F.col("hand")) % 9 == 4).alias("flag"), F.array(F.lit(5e9)).alias("freqs"),
        F.array(1 + (n * 3 + F.col("hand")) % 7 / 10.0).alias("amp"), F.array((n * 11 + F.col("hand") * 5) % 60 / 10.0 - 3.0).alias("phase"), F.array(F.lit(False)).alias("bad"),
    )


def _band(s) -> DataFrame:
    """Four channels at uneven frequencies in each subband; one antenna has a bad one."""
    a, h, w = F.floor(F.col("id") / 4).cast("int"), F.floor(F.col("id") / 2 % 2).cast("int"), (F.col("id") % 2).cast("int")
    n = F.sequence(F.lit(0), F.lit(3))
    return s.range(32).select(
        w.alias("spw"), a.alias("antenna"), F.lit(0.0).alias("t"), h.alias("hand"), F.lit(False).alias("flag"), F.transform(n, lambda c: 5e9 + w * 1e8 + c * c * 1.5e6).alias("freqs"),
        F.transform(n, lambda c: (1 + (a + c * 2 + h) % 5 / 20.0).cast("double")).alias("amp"), F.transform(n, lambda c: ((a * c + h + w) % 20 / 10.0 - 1.0).cast("double")).alias("phase"), F.transform(n, lambda c: (a == 6) & (c == 2)).alias("bad"),
    )


def _fringes(s, d) -> DataFrame:
    k, n = F.col("s_suppkey"), F.col("s_nationkey")
    rows = table(s, d, "supplier").filter("s_suppkey <= 80").crossJoin(s.range(2).select(F.col("id").cast("int").alias("hand")))
    return rows.select(
        F.lit(0).alias("spw"), (k % 8).cast("int").alias("antenna"), (F.floor(k / 8) * 3000.0).alias("t"), "hand", ((k + F.col("hand")) % 11 == 4).alias("flag"),
        ((n * 7 + F.col("hand")) % 60 / 10.0 - 3.0).cast("double").alias("phase"), ((n * 13 + k) % 50 / 5.0 - 5.0).cast("double").alias("delay"), ((k * 5 + n) % 7 * 1e-14).cast("double").alias("rate"), ((k + n) % 5 * 0.01).cast("double").alias("disp"),
    )


def _view(s, d) -> CalibratedView:
    """Chains of two fields, kept and loaded; the third field has none."""
    root = f"{shared_folder(s)}/chains-{uuid.uuid4().hex}"
    gain, band = Step(_gains(s, d), spwmap=(0, 0)), Step(_band(s), interp="nearest", weigh=False)
    fringe = Step(_fringes(s, d), kind="fringe", spwmap=(0, 0), reference={0: 5.008e9})
    save_chains(s, f"{root}/list", {0: [(f"{root}/gain", gain), (f"{root}/fringe", fringe)], 1: [(f"{root}/gain", gain), (f"{root}/band", band)]})
    return CalibratedView(_rows(s, d), _windows(s), load_chains(s, f"{root}/list"), NCHAN)


def _summed(out: DataFrame) -> DataFrame:
    ok = lambda c: F.aggregate(F.filter(F.zip_with(c, "flags", lambda x, f: F.when(~f, x)), lambda x: x.isNotNull()), F.lit(0.0), lambda a, x: a + x)
    return out.select("vec_id", F.round(ok("re"), 5).alias("re"), F.round(ok("im"), 5).alias("im"), F.round(F.get("weight", F.lit(0)) + F.get("weight", F.lit(1)), 6).alias("weight"), F.size(F.filter("flags", lambda f: f)).cast("long").alias("n_flagged"))


QUERIES = {
    "calibrated_view": lambda s, d: _summed(_view(s, d).read()),
    "calibrated_view_channel": lambda s, d: _summed(_view(s, d).read(F.col("field") < 2, [5])),
}
_TURN = lambda a, b: f"({b} - {a} - 2 * pi() * ceil(({b} - {a} - pi()) / (2 * pi())))"
_BOTH = f"""WITH v AS (SELECT vec_id, CAST(vec_id % 3 AS INT) AS field, CAST(vec_id % 2 AS INT) AS spw, CAST(vec_id % 5 AS INT) AS antenna1, CAST(5 + vec_id % 3 AS INT) AS antenna2, vec_id * 60.0::DOUBLE AS t, embedding FROM embeddings),
  cell AS (SELECT vec_id, field, spw, antenna1, antenna2, t, i // 2 AS c, i % 2 AS hand, CASE WHEN spw = 0 THEN 5e9 + 1e6 * (i // 2) ELSE 5.1e9 + 2e6 * (i // 2) END AS f, CAST(embedding[i + 1] AS DOUBLE) AS re, CAST(embedding[i + 33] AS DOUBLE) AS im, embedding[i + 1] > 0.3 AS flag FROM (SELECT *, unnest(range(32)) AS i FROM v)),
  s AS (SELECT s_suppkey AS k, s_nationkey AS n, CAST(s_suppkey % 8 AS INT) AS antenna, (s_suppkey // 8) * 3000.0::DOUBLE AS t, h AS hand FROM supplier, range(2) r(h) WHERE s_suppkey <= 80),
  gs AS (SELECT antenna, t, hand, 1 + (n * 3 + hand) % 7 / 10.0::DOUBLE AS amp, (n * 11 + hand * 5) % 60 / 10.0::DOUBLE - 3.0 AS phase FROM s WHERE (k + hand) % 9 <> 4),
  fs AS (SELECT antenna, t, hand, (n * 7 + hand) % 60 / 10.0::DOUBLE - 3.0 AS phase, (n * 13 + k) % 50 / 5.0::DOUBLE - 5.0 AS delay, (k * 5 + n) % 7 * 1e-14::DOUBLE AS rate, (k + n) % 5 * 0.01::DOUBLE AS disp FROM s WHERE (k + hand) % 11 <> 4),
  probe AS (SELECT DISTINCT t, a AS antenna, h AS hand FROM (SELECT t, unnest([antenna1, antenna2]) AS a FROM v) x, range(2) y(h)),
  g0 AS (SELECT p.*, (SELECT max(z.t) FROM gs z WHERE z.antenna = p.antenna AND z.hand = p.hand AND z.t <= p.t) AS t0, (SELECT min(z.t) FROM gs z WHERE z.antenna = p.antenna AND z.hand = p.hand AND z.t > p.t) AS t1 FROM probe p),
  g1 AS (SELECT x.*, a.amp AS a0, b.amp AS a1, a.phase AS p0, b.phase AS p1, (x.t - t0) / (t1 - t0) AS w FROM g0 x LEFT JOIN gs a ON a.antenna = x.antenna AND a.hand = x.hand AND a.t = t0 LEFT JOIN gs b ON b.antenna = x.antenna AND b.hand = x.hand AND b.t = t1),
  g AS (SELECT t, antenna, hand, CASE WHEN t0 IS NULL THEN a1 WHEN t1 IS NULL THEN a0 ELSE a0 + w * (a1 - a0) END AS amp, CASE WHEN t0 IS NULL THEN p1 WHEN t1 IS NULL THEN p0 ELSE p0 + w * {_TURN("p0", "p1")} END AS phase FROM g1),
  f0 AS (SELECT p.*, (SELECT max(z.t) FROM fs z WHERE z.antenna = p.antenna AND z.hand = p.hand AND z.t <= p.t) AS t0, (SELECT min(z.t) FROM fs z WHERE z.antenna = p.antenna AND z.hand = p.hand AND z.t > p.t) AS t1 FROM probe p),
  f1 AS (SELECT x.t, x.antenna, x.hand, (x.t - t0) / (t1 - t0) AS w, a.phase + 2 * pi() * 5.008e9 * a.rate * (x.t - a.t) AS p0, b.phase + 2 * pi() * 5.008e9 * b.rate * (x.t - b.t) AS p1, a.delay AS d0, b.delay AS d1, a.disp AS x0, b.disp AS x1
    FROM f0 x LEFT JOIN fs a ON a.antenna = x.antenna AND a.hand = x.hand AND a.t = t0 LEFT JOIN fs b ON b.antenna = x.antenna AND b.hand = x.hand AND b.t = t1),
  fr AS (SELECT t, antenna, hand, CASE WHEN w IS NULL THEN coalesce(p0, p1) ELSE atan2((1 - w) * sin(p0) + w * sin(p1), (1 - w) * cos(p0) + w * cos(p1)) END AS p, CASE WHEN w IS NULL THEN coalesce(d0, d1) ELSE (1 - w) * d0 + w * d1 END AS d, CASE WHEN w IS NULL THEN coalesce(x0, x1) ELSE (1 - w) * x0 + w * x1 END AS x FROM f1),
  node AS (SELECT a AS antenna, h AS hand, q AS spw, n, 5e9 + q * 1e8 + n * n * 1.5e6 AS f, 1 + (a + n * 2 + h) % 5 / 20.0::DOUBLE AS amp, (a * n + h + q) % 20 / 10.0::DOUBLE - 1.0 AS phase FROM range(8) x(a), range(2) y(h), range(2) z(q), range(4) u(n) WHERE NOT (a = 6 AND n = 2)),
  ends AS (SELECT antenna, hand, spw, f, amp, phase, lead(f) OVER w AS f1, lead(amp) OVER w AS amp1, lead(phase) OVER w AS phase1, n = 0 AS low FROM node WINDOW w AS (PARTITION BY antenna, hand, spw ORDER BY f)),
  chan AS (SELECT DISTINCT spw, c, f FROM cell),
  band AS (SELECT e.antenna, e.hand, e.spw, x.c, CASE WHEN f1 IS NULL THEN amp ELSE amp + (x.f - e.f) / (f1 - e.f) * (amp1 - amp) END AS amp, CASE WHEN f1 IS NULL THEN phase ELSE phase + (x.f - e.f) / (f1 - e.f) * {_TURN("phase", "phase1")} END AS phase
    FROM chan x JOIN ends e ON e.spw = x.spw AND e.f <= x.f AND (f1 IS NULL OR f1 > x.f)),
  j AS (SELECT c.vec_id, c.field, c.c, c.hand, c.re, c.im, c.flag, c.field = 2 OR coalesce(g1.amp * g2.amp, 0) > 0 AND CASE c.field WHEN 0 THEN coalesce(f1.d + f2.d IS NOT NULL, false) ELSE coalesce(b1.amp * b2.amp, 0) > 0 END AS ok,
      CASE WHEN c.field = 2 THEN 1.0 ELSE g1.amp * g2.amp END AS w, CASE c.field WHEN 0 THEN g1.amp * g2.amp WHEN 1 THEN g1.amp * g2.amp * b1.amp * b2.amp ELSE 1.0 END AS a,
      CASE c.field WHEN 0 THEN g1.phase - g2.phase + f1.p - f2.p + 2e-9 * pi() * (f1.d - f2.d) * (c.f - 5.008e9) + (f1.x - f2.x) * 2e6 * pi() * (1 / c.f + (c.f - lo - hi) / (lo * hi)) WHEN 1 THEN g1.phase - g2.phase + b1.phase - b2.phase ELSE 0.0 END AS o
    FROM (SELECT *, CASE WHEN spw = 0 THEN 5e9 ELSE 5.1e9 END AS lo, CASE WHEN spw = 0 THEN 5.015e9 ELSE 5.13e9 END AS hi FROM cell) c LEFT JOIN g g1 ON g1.t = c.t AND g1.antenna = antenna1 AND g1.hand = c.hand LEFT JOIN g g2 ON g2.t = c.t AND g2.antenna = antenna2 AND g2.hand = c.hand
    LEFT JOIN fr f1 ON f1.t = c.t AND f1.antenna = antenna1 AND f1.hand = c.hand LEFT JOIN fr f2 ON f2.t = c.t AND f2.antenna = antenna2 AND f2.hand = c.hand
    LEFT JOIN band b1 ON b1.antenna = antenna1 AND b1.hand = c.hand AND b1.spw = c.spw AND b1.c = c.c LEFT JOIN band b2 ON b2.antenna = antenna2 AND b2.hand = c.hand AND b2.spw = c.spw AND b2.c = c.c
    WHERE PICKED),
  wt AS (SELECT vec_id, sum(x) AS weight FROM (SELECT vec_id, hand, (hand + 1) * coalesce(avg(w * w) FILTER (ok), 1.0) AS x FROM j GROUP BY vec_id, hand) GROUP BY vec_id)
  SELECT vec_id, coalesce(round(sum((re * cos(o) + im * sin(o)) / a) FILTER (ok AND NOT flag), 5), 0.0) AS re, coalesce(round(sum((im * cos(o) - re * sin(o)) / a) FILTER (ok AND NOT flag), 5), 0.0) AS im, round(any_value(weight), 6) AS weight,
    count(*) FILTER (flag OR NOT ok) AS n_flagged FROM j JOIN wt USING (vec_id) GROUP BY vec_id"""
SQL = {"calibrated_view": _BOTH.replace("PICKED", "true"), "calibrated_view_channel": _BOTH.replace("PICKED", "c.field < 2 AND c.c = 5")}
