"""Edge rules of parsers, windows, lookups and sources."""

import math
import struct

import pytest
from pyspark.sql import functions as F

from uvspark.functions import complexes
from uvspark.operators import asof, merge, robust, selection
from uvspark.sources import fits, store, texts


def test_parsers():
    assert selection.parse_command("mode='manual' antenna='EF&JB' scan=3") == {"mode": "manual", "antenna": "EF&JB", "scan": "3"}
    assert selection.parse_numbers("1,3~5", 5) == [1, 3, 4] and selection.parse_numbers("*", 3) == [0, 1, 2]
    assert selection.parse_spw("0:1~3;60~90,2", 4, 64) == {0: [(1, 3), (60, 63)], 2: [(0, 63)]}
    assert selection.parse_antenna("A;B&C;C&", ["A", "B", "C"]) == ({0}, {(1, 2), (0, 2)})
    a, b = selection.parse_timerange("2020/01/02/03:04:05~03:05:00")[0]
    assert b - a == 55 and a == 58850 * 86400 + 3 * 3600 + 4 * 60 + 5
    assert selection.parse_solint("2min") == 120 and selection.parse_solint("inf") == float("inf") and selection.parse_solint("int") == 0
    with pytest.raises(ValueError):
        selection.parse_timerange("03:04:05~03:05:00")
    with pytest.raises(ValueError):
        selection.compile_selection({"uvrange": "1"}, [], 1, 1)
    assert selection.central_channels(64, 0.8) == (6, 58) and selection.central_channels(4, 0.1) == (0, 4)


def series(spark, values):
    return spark.createDataFrame([("a", i, v) for i, v in enumerate(values)], "k string, t long, x double")


def column(df, name):
    return [r[name] for r in df.orderBy("t").collect()]


def test_minimum_populations(spark):
    assert column(robust.outlier_mask(series(spark, [1.0, 50.0]), ["k"], "x"), "outlier") == [False, False]
    assert column(robust.outlier_mask(series(spark, [1.0, 1.0, 1.0, 1.0, 90.0]), ["k"], "x"), "outlier") == [False] * 5
    assert column(robust.outlier_mask(series(spark, [1.0, 1.1, 0.9, 1.0, None, 90.0]), ["k"], "x"), "outlier") == [False] * 5 + [True]
    out = robust.smooth_in_time(series(spark, [1.0, 9.0, None, 3.0]), ["k"], "t", "x", 2)
    assert column(out, "smoothed") == [1.0, 9.0, None, 3.0]
    spiky = robust.despike(series(spark, [1.0, 1.2, 0.8, 40.0, 1.1, 0.9, 1.0]), ["k"], ["t"], "x")
    assert column(spiky, "despiked")[3] == pytest.approx(1.0, abs=0.15)
    loo = robust.outliers_in_time(series(spark, [1.0, 1.2, 0.9, 30.0, 1.1, 1.0]), ["k"], "t", "t", "x", 20)
    assert column(loo, "outlier") == [False, False, False, True, False, False]


def test_short_bands_are_whole(spark):
    df = spark.createDataFrame([(1, [9.0, 1.0, 1.0]), (2, [50.0, 60.0] + [1.0, 1.1, 0.9, 1.0, 1.05, 0.95] * 2 + [70.0, None])], "k int, x array<double>")
    got = {r.k: (r["first"], r["last"]) for r in robust.flat_range(df, "k", "x").collect()}
    assert got == {1: (0, 2), 2: (2, 13)}


def test_asof_ties_and_ends(spark):
    probes = spark.createDataFrame([("a", t) for t in (0, 10, 14, 15, 16, 20, 99)] + [("b", 5)], "k string, t long")
    solutions = spark.createDataFrame([("a", 10, 1.0), ("a", 20, 3.0)], "k string, t long, v double")
    br = asof.brackets(probes, solutions, ["k"], "t", "v").withColumns({"n": asof.nearest(F.col("t")), "l": asof.linear(F.col("t"))})
    got = {(r.k, r.t): (r.n, r.l) for r in br.collect()}
    assert [got["a", t][0] for t in (0, 10, 14, 15, 16, 20, 99)] == [1.0, 1.0, 1.0, 1.0, 3.0, 3.0, 3.0]
    assert [got["a", t][1] for t in (0, 10, 15, 20, 99)] == [1.0, 1.0, 2.0, 3.0, 3.0] and got["b", 5] == (None, None)


def test_intervals(spark):
    df = spark.createDataFrame([("a", *p) for p in [(0, 10), (2, 5), (10, 12), (20, 30), (20, 30), (31, 40)]], "k string, a long, b long")
    assert sorted((r.a, r.b, r.n) for r in selection.merge_intervals(df, ["k"], "a", "b").collect()) == [(0, 12, 3), (20, 30, 2), (31, 40, 1)]


def test_remap_swaps_and_conjugates(spark):
    vis = spark.createDataFrame([(0, 1, 2.0), (0, 2, 3.0)], "antenna1 int, antenna2 int, im double")
    ids = spark.createDataFrame([(0, 1), (1, 0), (2, 5)], "old int, new int")
    got = sorted((r.antenna1, r.antenna2, r.im) for r in merge.remap_antennas(vis, ids, "im").collect())
    assert got == [(0, 1, -2.0), (1, 5, 3.0)]


def test_complex(spark):
    one = spark.range(1)
    re, im = complexes.cdiv((F.lit(1.0), F.lit(2.0)), (F.lit(3.0), F.lit(-1.0)))
    w = complexes.blend_polar((F.cos(F.lit(3.0)), F.sin(F.lit(3.0))), (F.cos(F.lit(-3.0)), F.sin(F.lit(-3.0))), F.lit(0.5))
    r = one.select(re.alias("re"), im.alias("im"), complexes.wrap(F.lit(7.0)).alias("w"), complexes.amplitude(w).alias("a"), complexes.phase(w).alias("p"), complexes.cdiv((F.lit(1.0), F.lit(0.0)), (F.lit(0.0), F.lit(0.0)))[0].alias("z")).first()
    z = (1 + 2j) / (3 - 1j)
    assert (r.re, r.im) == pytest.approx((z.real, z.imag)) and r.w == pytest.approx(7 - 2 * 3.141592653589793)
    assert r.a == pytest.approx(1) and abs(r.p) == pytest.approx(3.141592653589793) and r.z is None


def test_flag_versions(spark, tmp_path):
    rows = spark.createDataFrame([(i, [i % 2 == 0, False]) for i in range(4)], "id long, flag array<boolean>")
    v = store.FlagVersions(spark, str(tmp_path / "v"))
    assert v.list().count() == 0
    v.save(rows, "id", "flag", "one", "first")
    v.rename("one", "two")
    assert [(r.name, r.comment) for r in v.list().collect()] == [("two", "first")]
    now = rows.withColumn("flag", F.array(F.col("id") < 2, F.lit(True)))
    get = lambda merge: [r.flag for r in v.restore(now, "id", "flag", "two", merge).orderBy("id").collect()]
    assert get("replace") == [[True, False], [False, False]] * 2
    assert get("or") == [[True, True], [True, True], [True, True], [False, True]] and get("and")[1] == [False, False]
    v.delete("two")
    assert v.list().count() == 0
    with pytest.raises(KeyError):
        v.read("two")


def test_store(spark, tmp_path):
    df = spark.createDataFrame([(i, i % 3, float(i)) for i in range(30)], "id long, part int, x double")
    path = str(tmp_path / "s")
    store.write_store(df, path, ["part"])
    store.overwrite_partitions(spark.createDataFrame([(99, 1, 0.0)], "id long, part int, x double"), path, ["part"])
    back = spark.read.parquet(path)
    assert back.count() == 21 and back.filter("part = 1").count() == 1
    assert store.conform(df.select(F.col("x").alias("time")), store.CALTABLE_SCHEMA).columns == store.CALTABLE_SCHEMA.names
    cells = spark.createDataFrame([([float(i) for i in range(8)],)], "data array<double>")
    assert store.slice_cells(cells, ["data"], 2, range(1, 3), [1]).first().data == [3.0, 5.0]


def test_ionex(spark, tmp_path):
    def card(text, label):
        return f"{text:<60}{label}\n"

    text = card("  -1", "EXPONENT") + card("", "END OF HEADER")
    for hour, base in ((0, 100), (2, 200)):
        text += card("     1", "START OF TEC MAP") + card(f"  2020     1     2{hour:6d}     0     0", "EPOCH OF CURRENT MAP")
        for lat in (10.0, 0.0):
            text += card(f"  {lat:6.1f}{-5.0:6.1f}{5.0:6.1f}{5.0:6.1f}{450.0:6.1f}", "LAT/LON1/LON2/DLON/H") + "".join(f"{v:5d}" for v in (base, base + 1, 9999)) + "\n"
        text += card("     1", "END OF TEC MAP")
    (tmp_path / "m.i").write_text(text)
    rows = texts.read_ionex(spark, str(tmp_path / "m.i"))
    got = {(r.t - 58850 * 86400, r.lat, r.lon): r.tec for r in rows.collect()}
    assert len(got) == 12 and got[0, 10.0, -5.0] == pytest.approx(10.0) and got[7200, 0.0, 0.0] == pytest.approx(20.1) and got[0, 0.0, 5.0] is None
    other = rows.withColumn("tec", F.lit(1.0)).unionByName(rows.withColumns({"t": F.col("t") + 1e6, "tec": F.lit(2.0)}))
    assert texts.merge_maps([rows, other]).count() == 24


def test_uvflg(spark, tmp_path):
    (tmp_path / "f").write_text("! a comment\nant_name='Ef' timerang=2,3,4,5, 2,3,5,5 reason='off source' /\nant_name='JB' timerang=1,0,0,0, 300,0,0,0 /\nant_name='XX' reason='x' /\n")
    flags = texts.read_uvflg(spark, str(tmp_path / "f"), 2020)
    got = {r.antenna: (r.t0, r.t1, r.reason) for r in flags.collect()}
    start = 58849 * 86400
    assert got["EF"] == (start + 86400 + 3 * 3600 + 245, start + 86400 + 3 * 3600 + 305, "off source") and got["XX"][0] is None
    commands = [r.command for r in texts.uvflg_commands(flags, ["EF", "JB"], 86400).collect()]
    assert commands == ["mode='manual' antenna='EF' timerange='2020/01/02/03:04:05.000~2020/01/02/03:05:05.000' reason='off source'"]


def test_eop_without_leaps(spark):
    df = spark.createDataFrame([(1.0, 0.1), (2.0, 0.09), (3.0, 1.08), (4.0, 1.07)], "mjd double, ut1_utc double")
    assert [round(r.ut1_smooth, 6) for r in texts.without_leap_jumps(df).orderBy("mjd").collect()] == [0.1, 0.09, 0.08, 0.07]


def test_fits_source(spark, tmp_path):
    def block(cards):
        return "".join(f"{c:<80}" for c in [*cards, "END"]).ljust(2880 * -(-80 * (len(cards) + 1) // 2880)).encode()

    rows = b"".join(struct.pack(">hd4s2f", i, i / 2, f"A{i}".encode(), i, -i) for i in range(7))
    head = ["XTENSION= 'BINTABLE'", "BITPIX  = 8", "NAXIS   = 2", "NAXIS1  = 22", "NAXIS2  = 7", "PCOUNT  = 0", "GCOUNT  = 1", "TFIELDS = 4", "EXTNAME = 'ROWS    '"]
    head += ["TFORM1  = 'I'", "TTYPE1  = 'N'", "TFORM2  = 'D'", "TTYPE2  = 'TIME'", "TFORM3  = '4A'", "TTYPE3  = 'NAME'", "TFORM4  = '1C'", "TTYPE4  = 'FLUX'"]
    (tmp_path / "t.fits").write_bytes(block(["SIMPLE  = T", "BITPIX  = 8", "NAXIS   = 0"]) + block(head) + rows.ljust(2880, b"\0"))
    fits.register(spark)
    df = spark.read.format("fits").option("extension", "ROWS").option("rows", "3").load(str(tmp_path / "t.fits"))
    got = [(r.n, r.time, r.name, r.flux) for r in df.orderBy("n").collect()]
    assert got == [(i, i / 2, f"A{i}", [float(i), float(-i)]) for i in range(7)] and df.rdd.getNumPartitions() == 3


def test_plan_parts():
    from uvspark.operators.reference import plan_parts

    parts = plan_parts({"a": 9, "b": 5, "c": 4, "d": 1}, 2)
    assert sorted(map(sorted, parts)) == [["a"], ["b", "c", "d"]] or sorted(map(sorted, parts)) == [["a", "d"], ["b", "c"]]


def test_channel_flags_kept(spark):
    from uvspark.operators.reference import interpolate_channels

    a = lambda *x: F.array(*[F.lit(v) for v in x])
    r = spark.range(1).select(interpolate_channels(a(0.0, 1.0, 2.0), a(5.0, 9.0, 7.0), a(False, True, False), a(0.5, 1.1, 3.0), True).alias("o"), interpolate_channels(a(0.0, 1.0), a(5.0, 9.0), a(True, True), a(0.5)).alias("none")).first()
    assert [(round(c.value, 6), c.flag) for c in r.o] == [(5.5, False), (6.1, True), (7.0, False)] and r.none[0].flag


def test_selections_refuse_what_is_not_there():
    assert selection.parse_spw("0:1~3;5,2", 4, 8) == {0: [(1, 3), (5, 5)], 2: [(0, 7)]}
    for text in ("9:1~3", "2~5", "4"):
        with pytest.raises(ValueError):
            selection.parse_spw(text, 4, 8)
    assert selection.parse_antenna("ef;JB&mc", ["Ef", "Jb", "Mc"]) == ({0}, {(1, 2)})
    with pytest.raises(ValueError):
        selection.parse_antenna("XX", ["Ef"])


def test_roles():
    from uvspark.operators.decide import roles_of

    cycle = [("c", 60), ("t", 180)] * 8 + [("c", 60)]
    near = {"c": (10.0, 50.0), "t": (12.0, 51.0), "f": (200.0, 10.0), "u": (100.0, 0.0)}
    scans = [("f", 300), *cycle, ("f", 300)]
    assert roles_of(scans, {}, near) == {"f": ("finder", None), "c": ("calibrator", None), "t": ("target", "c")}
    assert roles_of(scans, {"f": 0.0, "c": 9.0, "t": 50.0}, near)["f"] == ("other", None)
    assert roles_of(scans, {"t": 50.0}, near)["c"] == ("calibrator", None)  # brightness has no vote
    assert roles_of(scans, {}, near, {"c": "target"})["t"] == ("calibrator", None)
    far = near | {"t": (40.0, 51.0)}
    assert {r for r, _ in (roles_of(scans, {}, far)[x] for x in "ct")} == {"target"}
    blocks = [("c", 60)] * 8 + [("t", 60)] * 8
    assert {r for r, _ in roles_of(blocks, {}, near).values()} == {"target"}
    assert roles_of([("a", 1)], {}, {}) == {"a": ("target", None)}
    assert roles_of([("a", 1), ("b", 1)], {"b": 3.0}, {}) == {"b": ("finder", None), "a": ("target", None)}


def test_ionosphere_follows_the_sun(spark):
    """A map that only depends on the longitude under the Sun gives the same value all day."""
    from uvspark.functions.sky import vertical_tec

    maps = [(h * 7200.0, float(la), float(lo), 10 + 5 * math.cos(math.radians(lo + 360 * h / 12))) for h in range(13) for la in (-30, 0, 30) for lo in range(-180, 181, 30)]
    maps = spark.createDataFrame(maps, "t double, lat double, lon double, tec double")
    probes = spark.createDataFrame([(i, 1800.0 * i, 80.0 if i % 2 else 10.0, (-360 * 1800.0 * i / 86400) % 360 - 180) for i in range(40)], "id long, t double, lat_deg double, lon_deg double")
    tec = [r.tec for r in vertical_tec(probes, maps, 30.0).collect()]
    assert max(tec) - min(tec) < 1e-9 and abs(tec[0] - 5) < 1e-9
    assert vertical_tec(probes, maps, 30.0, rotation=0.0).selectExpr("max(tec) - min(tec)").first()[0] > 0.3
    assert vertical_tec(probes.selectExpr("id", "t + 1e6 AS t", "lat_deg", "lon_deg"), maps, 30.0).filter("tec IS NOT NULL").isEmpty()


def test_points_choose_ranges_once(spark):
    from uvspark.operators.measure import match_ranges

    points = spark.createDataFrame([("a", i, x) for i, x in enumerate([5.0, 6.0, 15.0, 99.0])] + [("b", 0, 5.0)], "k string, name long, x double")
    ranges = spark.createDataFrame([("a", 0, 0.0, 10.0), ("a", 1, 4.0, 16.0)], "k string, id int, lo double, hi double")
    got = {(r.k, r.name): r.matched for r in match_ranges(points, ranges, ["k"]).collect()}
    assert got == {("a", 0): 0, ("a", 1): 1, ("a", 2): None, ("a", 3): None, ("b", 0): None}


def test_brackets_by_broadcast_and_by_shuffle(spark):
    import random

    rng = random.Random(4)
    solutions = spark.createDataFrame([(k, t, float(t * 10 + k)) for k in range(3) for t in sorted(rng.sample(range(100), 9))] + [(7, 50, 1.0)], "k int, t long, v double")
    probes = spark.createDataFrame([(i, rng.choice([0, 1, 2, 7, 9]), rng.randrange(-5, 110)) for i in range(400)], "id long, k int, t long")
    one, two = (f(probes, solutions, ["k"], "t", "v").collect() for f in (asof.brackets, asof.shuffled_brackets))
    key = lambda rows: [(r.id, r.t0, r.v0, r.t1, r.v1) for r in rows]
    assert key(sorted(one, key=lambda r: r.id)) == key(sorted(two, key=lambda r: r.id)) and len(one) == 400
    plan = asof.brackets(probes, solutions, ["k"], "t", "v")._jdf.queryExecution().executedPlan().toString()
    assert "SortMergeJoin" not in plan and "Window" not in plan
