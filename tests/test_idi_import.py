"""Raw files: generated ones become fact and dimension tables with one dictionary of ids."""

import numpy as np
import pytest

from uvspark.sources import idi


def raw_file(path, names, sources, baselines, nband=1, stokes=4, nchan=2, freq=5e9, times=None, positions=None, levels=4, **more):
    """One row per (first name, second name, source); flux: 1000 row + 100 band + 10 channel + correlation."""
    n = len(baselines)
    number = {x: i + 1 for i, x in enumerate(names)}
    flux = np.zeros((n, nband, nchan, stokes, 3))
    flux += 1000 * np.arange(n).reshape(-1, 1, 1, 1, 1) + 100 * np.arange(nband).reshape(-1, 1, 1, 1) + 10 * np.arange(nchan).reshape(-1, 1, 1) + np.arange(stokes).reshape(-1, 1)
    flux[..., 1] += 0.5
    flux[..., 2] = 1.0
    shared = {"NO_STKD": stokes, "STK_1": -1, "NO_BAND": nband, "NO_CHAN": nchan, "REF_FREQ": freq, "REF_PIXL": 1.0, "VIS_SCAL": 1.0} | more
    many = lambda form: f"{nband}{form}"
    parts = [
        idi.primary_bytes(),
        idi.table_bytes("ARRAY_GEOMETRY", {"ANNAME": ("8A", list(names)), "STABXYZ": ("3D", [[1.0, 2.0, 3.0]] * len(names)), "NOSTA": ("1J", list(number.values()))}),
        idi.table_bytes("ANTENNA", {"ANTENNA_NO": ("1J", list(number.values())), "NO_LEVELS": (many("J"), [[levels] * nband] * len(names))}),
        idi.table_bytes("SOURCE", {"SOURCE_ID": ("1J", [i + 1 for i in range(len(sources))]), "SOURCE": ("16A", list(sources)), "RAEPO": ("1D", (positions or [1.0] * len(sources))), "DECEPO": ("1D", [0.0] * len(sources))}),
        idi.table_bytes("FREQUENCY", {"FREQID": ("1J", [1]), "BANDFREQ": (many("D"), [[4e6 * k for k in range(nband)]]), "CH_WIDTH": (many("E"), [[1e6] * nband])}, shared),
        idi.table_bytes("UV_DATA", {
            "UU": ("1D", [1e-6] * n), "VV": ("1D", [2e-6] * n), "WW": ("1D", [3e-6] * n), "DATE": ("1D", [2460000.5] * n), "TIME": ("1D", times or [k / 86400 for k in range(n)]),
            "BASELINE": ("1J", [256 * number[a] + number[b] for a, b, _ in baselines]), "SOURCE": ("1J", [sources.index(x) + 1 for *_, x in baselines]), "FREQID": ("1J", [1] * n), "INTTIM": ("1E", [2.0] * n), "FLUX": (f"{nband * nchan * stokes * 3}E", flux.reshape(n, -1)),
        }, shared),
    ]
    path.write_bytes(b"".join(parts))
    return str(path)


def test_one_dictionary_over_files(spark, tmp_path):
    one = raw_file(tmp_path / "1.idi", ["EF", "JB", "ON"], ["A", "B"], [("EF", "JB", "A"), ("ON", "JB", "B")])
    two = raw_file(tmp_path / "2.idi", ["WB", "ON", "EF"], ["B", "C"], [("EF", "WB", "C"), ("WB", "ON", "B")], freq=5.1e9)
    with pytest.raises(ValueError, match="ref_freq differ"):
        idi.read_setup(spark, [one, two])
    two = raw_file(tmp_path / "2.idi", ["WB", "ON", "EF"], ["B", "C"], [("EF", "WB", "C"), ("WB", "ON", "B")])
    fact, setup = idi.import_files(spark, [one, two])
    name = {r.antenna: r.name for r in setup.antennas.collect()}
    assert name == {0: "EF", 1: "JB", 2: "ON", 3: "WB"} and [r.name for r in setup.fields.orderBy("field").collect()] == ["A", "B", "C"]
    assert [(r.spw, r.freqs) for r in setup.windows.collect()] == [(0, [5e9, 5.001e9])]
    rows = {(r.file, r.row): r for r in fact.collect()}
    assert {k: (name[r.antenna1], name[r.antenna2], "ABC"[r.field]) for k, r in rows.items()} == {(0, 0): ("EF", "JB", "A"), (0, 1): ("JB", "ON", "B"), (1, 0): ("EF", "WB", "C"), (1, 1): ("ON", "WB", "B")}
    # Exchanged antennas: uvw turned, the cross hands change places, imaginary parts keep their sign; others turn it.
    plain, turned = rows[0, 0], rows[0, 1]
    assert np.allclose(plain.uvw, np.array([1, 2, 3]) * 299.792458) and np.allclose(turned.uvw, -np.array(plain.uvw))
    assert plain.re == [0, 2, 3, 1, 10, 12, 13, 11] and turned.re == [1000, 1003, 1002, 1001, 1010, 1013, 1012, 1011]
    assert plain.im[0] == -0.5 and turned.im[0] == 1000.5 and not any(plain.flag)
    assert abs(plain.time - (60000.0 * 86400)) < 1e-3 and plain.time_centroid == plain.time + 1 and plain.interval == 2


def test_scans_and_bands(spark, tmp_path):
    """A pause in a field starts a scan, whatever the file; each band is a subband; rows come in several partitions."""
    times = [0, 1, 30, 31, 100]
    of = lambda ts: [t / 86400 for t in ts]
    one = raw_file(tmp_path / "1.idi", ["EF", "JB"], ["A", "B"], [("EF", "JB", x) for x in "AABBA"], nband=3, stokes=2, times=of(times))
    two = raw_file(tmp_path / "2.idi", ["EF", "JB"], ["A"], [("EF", "JB", "A")] * 2, nband=3, stokes=2, times=of([10, 108]))
    fact, setup = idi.import_files(spark, [one, two], scan_gap=15.0)
    assert setup.windows.count() == 3 and fact.count() == 21
    got = {(r.file, r.row, r.spw): r.scan_number for r in fact.collect()}
    assert [got[0, i, 2] for i in range(5)] == [1, 1, 2, 2, 3] and [got[1, i, 0] for i in range(2)] == [1, 3]
    scanned = idi.scan_files(spark, [one, two]).collect()
    small = idi.read_table(spark, scanned, "UV_DATA", rows=2)
    assert small.rdd.getNumPartitions() == 4 and [r.row for r in small.filter("file = 0").orderBy("row").collect()] == [0, 1, 2, 3, 4]
    assert {r.re[0] % 1000 for r in fact.filter("file = 0 AND spw = 1").collect()} == {100.0}


def test_what_files_must_agree_on(spark, tmp_path):
    good = raw_file(tmp_path / "1.idi", ["EF", "JB"], ["A"], [("EF", "JB", "A")])
    for name, more in {"nchan": {"nchan": 4}, "scale": {"VIS_SCAL": 2.0}, "stokes": {"stokes": 2}}.items():
        other = raw_file(tmp_path / f"{name}.idi", ["EF", "JB"], ["A"], [("EF", "JB", "A")], **more)
        with pytest.raises(ValueError, match=f"{name} differ"):
            idi.read_setup(spark, [good, other])
    moved = raw_file(tmp_path / "moved.idi", ["EF", "JB"], ["A"], [("EF", "JB", "A")], positions=[2.0])
    with pytest.raises(ValueError, match="several positions"):
        idi.read_setup(spark, [good, moved])
    coarse = raw_file(tmp_path / "coarse.idi", ["EF", "JB"], ["A"], [("EF", "JB", "A")], levels=2)
    with pytest.raises(ValueError, match="levels"):
        idi.read_setup(spark, [good, coarse])
    (tmp_path / "none.idi").write_bytes(idi.primary_bytes())
    with pytest.raises(ValueError, match="no UV_DATA"):
        idi.read_setup(spark, [str(tmp_path / "none.idi")])


def test_export_and_back(spark, tmp_path):
    """Four correlations, exchanged antennas, flagged cells: what is exported is imported as it was."""
    one = raw_file(tmp_path / "1.idi", ["EF", "JB", "ON"], ["A", "B"], [("JB", "EF", "A"), ("EF", "ON", "B"), ("ON", "ON", "A")], nband=2)
    fact, setup = idi.import_files(spark, [one])
    fact = fact.withColumn("flag", idi.F.transform("flag", lambda f, i: f | (i == 3)))
    paths = idi.export_files(fact, setup, str(tmp_path / "out"), rows_per_file=1)
    again, dims = idi.import_files(spark, paths)
    assert [r.name for r in dims.antennas.collect()] == ["EF", "JB", "ON"] and {r.name for r in dims.fields.collect()} == {"A", "B"}
    assert [r.freqs for r in dims.windows.collect()] == [r.freqs for r in setup.windows.collect()]
    name = {r.field: r.name for r in dims.fields.collect()}
    key = lambda r, field: (field, r.antenna1, r.antenna2, r.spw)
    want = {key(r, "AB"[r.field]): r for r in fact.collect()}
    got = {key(r, name[r.field]): r for r in again.collect()}
    assert set(got) == set(want) and len(got) == 6
    for k, r in got.items():
        w = want[k]
        assert np.allclose(r.re, w.re) and np.allclose(r.im, w.im) and r.flag == w.flag and np.allclose(r.weight_spectrum, w.weight_spectrum) and np.allclose(r.uvw, w.uvw) and abs(r.time - w.time) < 1e-4


def test_small_tables_share_a_task(spark, tmp_path):
    """Tables of a few rows in many files are read by few tasks, and only the columns asked for."""
    paths = [raw_file(tmp_path / f"{i}.idi", ["EF", "JB"], ["A"], [("EF", "JB", "A")] * 2) for i in range(12)]
    scanned = idi.scan_files(spark, paths).collect()
    found = idi.read_table(spark, scanned, "ARRAY_GEOMETRY", rows=10)
    assert found.rdd.getNumPartitions() == 3 and {(r.file, r.row) for r in found.collect()} == {(i, k) for i in range(12) for k in range(2)}
    times = idi.read_table(spark, scanned, "UV_DATA", only=["time", "file"])
    assert times.columns == ["time", "file"] and times.count() == 24


def test_stand_in_files_are_bounded(spark, sf_dir, monkeypatch):
    """No task holds all rows of a line number: files grow in number, not in size."""
    monkeypatch.setattr(idi, "ROWS_PER_FILE", 500)
    paths = idi._made(spark, sf_dir)
    rows = [r.rows for r in idi.scan_files(spark, paths).collect() if r.name == "UV_DATA"]
    assert sum(rows) == spark.read.parquet(f"{sf_dir}/lineitem.parquet").count() and len(rows) >= sum(rows) / 500 and max(rows) < 1000


def test_compressed_tables(spark, tmp_path):
    """Rows of any range and columns of a table in compressed tiles are those of the plain one; so are files with such a table."""
    rng = np.random.default_rng(1)
    cols = {"A": ("3A", [f"x{i}" for i in range(23)]), "J": ("1J", np.arange(23) - 5), "D": ("3D", rng.normal(size=(23, 3))), "E": ("4E", rng.normal(size=(23, 4)))}
    (tmp_path / "two.fits").write_bytes(idi.primary_bytes() + idi.table_bytes("PLAIN", cols) + idi.table_bytes("TILED", cols, tile=5) + idi.table_bytes("NONE", {"J": ("1J", [])}, tile=5) + idi.table_bytes("LAST", cols))
    scanned = idi.scan_files(spark, [str(tmp_path / "two.fits")]).collect()
    assert [(r.name, r.rows) for r in scanned] == [("PLAIN", 23), ("TILED", 23), ("NONE", 0), ("LAST", 23)]
    of = lambda *a, **b: sorted(map(str, idi.read_table(spark, scanned, *a, **b).collect()))
    assert of("TILED") == of("PLAIN") == of("LAST") == of("TILED", rows=7) and of("TILED", only=["row", "e"]) == of("PLAIN", only=["row", "e"])


def test_export_leaves_little_on_disk(spark, sf_dir, tmp_path):
    """Cells of an export are shuffled once, as bytes, without a sort; compressed files are a fraction of their rows and are imported as the plain ones are."""
    fact, setup = idi.import_files(spark, idi._made(spark, sf_dir))
    fact = idi.pinned(fact)
    plain, tiled = [idi.export_files(fact, setup, str(tmp_path / name), tile=tile) for name, tile in (("plain", 0), ("tiled", 500))]
    size = lambda paths: sum(idi.os.path.getsize(p) for p in paths)
    assert size(tiled) * 3 < size(plain)
    rows = [sorted(map(str, idi.import_files(spark, p)[0].drop("file", "row").collect())) for p in (plain, tiled)]
    assert rows[0] == rows[1] and len(rows[0]) == fact.count()
