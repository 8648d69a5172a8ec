"""Import of raw interferometer files (FITS tables by the public IDI convention) into fact and dimension tables.

Files are scanned in tasks; a data source reads row ranges of the tables of many files as Arrow batches. Each file has
numbers of its own for antennas, sources and subbands: one dictionary over all files, by name or frequency, gives them the
ids of the dimension tables. Cells are decoded to visibilities, flags and weights.
"""

from __future__ import annotations

import json
import os
import re
import uuid
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.datasource import DataSource, DataSourceReader, InputPartition

from ..operators.calibrate import _count_until
from ..operators.ranks import pinned, shared_folder
from ..operators.reduce import scan_numbers
from ..plans.model import table
from .correlator import Setup, decode_cells
from .fits import BLOCK, CODES, columns, data_size, packed, read_header, read_rows, row_count

LIGHT, MJD0 = 299792458.0, 2400000.5
# Codes of correlations in raw files, their order in the fact table, and cross hands exchanged with the antennas.
STOKES = {-1: "RR", -2: "LL", -3: "RL", -4: "LR", -5: "XX", -6: "YY", -7: "XY", -8: "YX"}
ORDER = ("RR", "RL", "LR", "LL", "XX", "XY", "YX", "YY")
#: Files that a task opens at most; rows that a task writes, in some files, and rows of a compressed tile.
FILES, WRITTEN, TILE = 500, 100_000, 5000
EXCHANGED = {"RL": "LR", "LR": "RL", "XY": "YX", "YX": "XY"}


def tables_in(path: str) -> Iterator[dict]:
    """Name, header and data offset of each binary table of a file."""
    with open(path, "rb") as f:
        while h := read_header(f):
            if h.get("XTENSION") == "BINTABLE":
                yield {"name": str(h.get("EXTNAME", "")).upper(), "header": h, "offset": f.tell()}
            f.seek(-(-data_size(h) // BLOCK) * BLOCK, 1)


def scan_files(spark: SparkSession, paths: list[str]) -> DataFrame:
    """(file, path, hdu, name, rows, offset, header as JSON, without its rows) of every table; one task opens few files."""

    def scan(batches):
        for pdf in batches:
            out = [(file, path, i, t["name"], row_count(t["header"]), t["offset"], json.dumps({k: v for k, v in t["header"].items() if k not in ("NAXIS2", "ZNAXIS2", "PCOUNT")})) for file, path in zip(pdf["file"], pdf["path"]) for i, t in enumerate(tables_in(path))]
            yield pd.DataFrame(out, columns=["file", "path", "hdu", "name", "rows", "offset", "header"])

    listed = spark.createDataFrame(list(enumerate(paths)), "file int, path string").repartition(min(len(paths), 200))
    return listed.mapInPandas(scan, "file int, path string, hdu int, name string, rows long, offset long, header string")


class IdiSource(DataSource):
    """Format "idi": rows of one kind of table in many files. Options: files (JSON: file, path, rows, offset, and the place of its header), headers (JSON), rows (of a partition)."""

    @classmethod
    def name(cls) -> str:
        return "idi"

    def schema(self) -> str:
        kind = lambda code, n: CODES[code][2] if code == "A" or n * CODES[code][1] == 1 else f"array<{CODES[code][2]}>"
        first = json.loads(self.options["headers"])[json.loads(self.options["files"])[0][4]]
        return "file int, row long, " + ", ".join(f"`{name}` {kind(code, n)}" for name, code, n in columns(json.loads(first)) if n)

    def reader(self, schema) -> DataSourceReader:
        return IdiReader(self.options, [f.name for f in schema])


class IdiReader(DataSourceReader):
    def __init__(self, options: dict, names: list[str]):
        self.files, self.headers, self.step, self.names = json.loads(options["files"]), json.loads(options["headers"]), int(options.get("rows", 50_000)), names

    def __getstate__(self) -> dict:
        return self.__dict__ | {"files": None}  # a task gets the ranges of its partition, not all files

    def partitions(self) -> list[InputPartition]:
        """Ranges of rows; small tables of many files share a partition."""
        out, rows = [], self.step
        for file, path, n, offset, header in self.files:
            for a in range(0, n, self.step):
                b = min(n, a + self.step)
                if rows + b - a > self.step or len(out[-1]) >= FILES:
                    out.append([])
                    rows = 0
                out[-1].append((file, path, offset, header, n, a, b))
                rows += b - a
        return [InputPartition(x) for x in out]

    def read(self, partition: InputPartition) -> Iterator[pa.RecordBatch]:
        kept = {}
        for file, path, offset, header, total, first, last in partition.value:
            if header not in kept:
                h = json.loads(self.headers[header])
                kept[header] = h, [c for c in columns(h) if c[2]]
            h, cols = kept[header]
            missing = [c for c in self.names if c not in {"file", "row", *[c[0] for c in cols]}]
            if missing:
                raise ValueError(f"{path}: no column {', '.join(missing)} in {str(h.get('EXTNAME', '')).upper()}")
            with open(path, "rb") as f:
                for a in range(first, last, TILE):
                    n = min(TILE, last - a)
                    rows = read_rows(f, h, offset, total, a, a + n, set(self.names))
                    found = {name: _arrow(rows[name], code) for name, code, _ in cols if name in self.names}
                    found |= {"file": pa.array(np.full(n, file, np.int32)), "row": pa.array(np.arange(a, a + n))}
                    yield pa.RecordBatch.from_arrays([found[c] for c in self.names], self.names)


def _arrow(values: np.ndarray, code: str) -> pa.Array:
    """A column of big-endian FITS values as Arrow: scalars, or lists where a cell holds several."""
    if code == "A":
        return pa.array([x.decode("ascii", "replace").rstrip("\0 ") for x in values])
    native = {"boolean": np.bool_, "int": np.int32, "bigint": np.int64, "float": np.float32, "double": np.float64}[CODES[code][2]]
    flat = (values == b"T" if code == "L" else values).astype(native).reshape(-1)
    width = values.shape[1]
    if width == 1:
        return pa.array(flat)
    return pa.ListArray.from_arrays(pa.array(np.arange(0, len(flat) + 1, width, dtype=np.int32)), pa.array(flat))


def read_table(spark: SparkSession, scanned: list, name: str, rows: int = 50_000, only: list[str] | None = None) -> DataFrame:
    """All tables of a name, in all files; only: columns to read. scanned: rows of scan_files."""
    found = [r for r in scanned if r.name == name]
    if not found:
        raise ValueError(f"no table {name} in the files")
    places: dict[str, int] = {}
    files = [(r.file, r.path, r.rows, r.offset, places.setdefault(r.header, len(places))) for r in found]
    spark.dataSource.register(IdiSource)
    reader = spark.read.format("idi").option("files", json.dumps(files)).option("headers", json.dumps(list(places))).option("rows", rows)
    whole = reader.load()
    return reader.schema(T.StructType([whole.schema[c] for c in only])).load() if only else whole


@dataclass(frozen=True)
class Scanned:
    """A table of a file, as scan_files lists it."""

    file: int
    path: str
    name: str
    rows: int
    offset: int
    header: str


@dataclass
class RawSetup:
    """Dimension tables over all files, the maps from each file's own numbers to their ids, and what all files must agree on."""

    antennas: DataFrame
    antenna_of: DataFrame
    fields: DataFrame
    field_of: DataFrame
    windows: DataFrame
    window_of: DataFrame
    scanned: list
    axes: dict


def _dictionary(rows: DataFrame, key: list[str], order: list[str], name: str) -> DataFrame:
    """rows of the first appearance of each key with an id by that order. As many rows as there are names."""
    first = rows.groupBy(*key).agg(F.min(F.struct(*order, *[c for c in rows.columns if c not in order and c not in key])).alias("_f"))
    listed = first.agg(F.array_sort(F.collect_list(F.struct("_f", *key))).alias("_l"))
    return listed.select(F.posexplode("_l").alias(name, "_x")).select(F.col(name).cast("int"), "_x._f.*", *[f"_x.{k}" for k in key])


def _clashes(rows: DataFrame, key: list[str], differs: Column) -> list[str]:
    found = rows.groupBy(*key).agg(differs.alias("_d")).filter("_d").select(F.concat_ws(",", *key).alias("k")).limit(5).collect()
    return [r.k for r in found]


def read_setup(spark: SparkSession, paths: list[str]) -> RawSetup:
    """Dimension tables and maps from the headers and small tables of all files.

    All files must agree on axes, correlations, scale and kind of weights; a source of one name must have one position, an antenna
    one number of levels. Antennas and sources are told apart by name, subbands by their frequencies.
    """
    listed = pinned(scan_files(spark, paths).withColumn("_h", F.xxhash64("header")))
    # Each header comes to the driver once: those of files made alike are equal.
    headers = {r["_h"]: r.header for r in listed.groupBy("_h").agg(F.first("header").alias("header")).collect()}
    scanned = [Scanned(r.file, r.path, r.name, r.rows, r.offset, headers[r["_h"]]) for r in listed.select("file", "path", "name", "rows", "offset", "_h").orderBy("file", "hdu").collect()]
    data = [r for r in scanned if r.name == "UV_DATA"]
    if not data:
        raise ValueError("no UV_DATA table in the files")
    known = {h: _axes(json.loads(h)) for h in {r.header for r in data}}
    axes = known[data[0].header]
    for r in data[1:]:
        if (a := known[r.header]) != axes:
            raise ValueError(f"{r.path}: {', '.join(k for k in a if a[k] != axes[k])} differ from the first file")
    stations = read_table(spark, scanned, "ARRAY_GEOMETRY").select("file", "row", F.trim("anname").alias("name"), F.col("nosta").alias("number"), F.col("stabxyz").alias("position"))
    own = read_table(spark, scanned, "ANTENNA").select("file", F.col("antenna_no").alias("number"), F.get("no_levels", 0).alias("levels") if axes["nband"] > 1 else F.col("no_levels").alias("levels"))
    stations = stations.join(own, ["file", "number"], "left")
    if bad := _clashes(stations, ["name"], F.count_distinct("levels") > 1):
        raise ValueError(f"antennas with several numbers of levels: {bad}")
    antennas = _dictionary(stations.select("name", "file", "row", "position", "levels"), ["name"], ["file", "row"], "antenna").select("antenna", "name", "position", "levels")
    sources = read_table(spark, scanned, "SOURCE").select("file", "row", F.trim("source").alias("name"), F.col("source_id").alias("number"), "raepo", "decepo")
    apart = (F.max("raepo") - F.min("raepo") > 1e-7) | (F.max("decepo") - F.min("decepo") > 1e-7)
    if bad := _clashes(sources, ["name"], apart):
        raise ValueError(f"sources with several positions: {bad}")
    fields = _dictionary(sources.select("name", "file", "row", "raepo", "decepo"), ["name"], ["file", "row"], "field").select("field", "name", "raepo", "decepo")
    listed = lambda c: F.col(c) if axes["nband"] > 1 else F.array(c)
    bands = read_table(spark, scanned, "FREQUENCY").select("file", "row", "freqid", F.posexplode(F.arrays_zip(listed("bandfreq").alias("f"), listed("ch_width").alias("w"))).alias("band", "b"))
    channels = F.transform(F.sequence(F.lit(0), F.lit(axes["nchan"] - 1)), lambda c: F.lit(axes["ref_freq"]) + F.col("b.f") + (c + 1 - axes["ref_pixl"]) * F.col("b.w"))
    bands = bands.withColumns({"freqs": channels, "width": F.col("b.w").cast("double")}).drop("b")
    windows = _dictionary(bands.select("freqs", "width", "file", "freqid", "band"), ["freqs", "width"], ["file", "freqid", "band"], "spw").select("spw", "freqs", "width")
    return RawSetup(
        antennas, stations.select("file", "number", "name").join(antennas.select("name", "antenna"), "name").drop("name"),
        fields, sources.select("file", "number", "name").join(fields.select("name", "field"), "name").drop("name"),
        windows, bands.select("file", "freqid", "band", "freqs", "width").join(windows, ["freqs", "width"]).select("file", "freqid", "band", "spw", "width"), scanned, axes,
    )


def _axes(h: dict) -> dict:
    """What every table of data must agree on."""
    kind = str(h.get("CORRELAT", "")).upper()
    stokes = [STOKES[h["STK_1"] - i] for i in range(h["NO_STKD"])]
    complex_axis = next((h[f"MAXIS{i}"] for i in range(1, h.get("MAXIS", 0) + 1) if h.get(f"CTYPE{i}") == "COMPLEX"), 3)
    return {
        "stokes": stokes, "nchan": h["NO_CHAN"], "nband": h["NO_BAND"], "values": complex_axis, "kind": kind, "scale": float(h.get("VIS_SCAL", 1.0)),
        "by_weight": h.get("WEIGHTYP", "CORRELAT" if kind in ("DIFX", "VLBA") else "") == "CORRELAT", "ref_freq": float(h["REF_FREQ"]), "ref_pixl": float(h.get("REF_PIXL", 1.0)),
    }


def scan_lists(stamps: DataFrame, gap: float) -> DataFrame:
    """Per field the starts of its scans with their numbers, by time; scans count over all fields in order of their starts."""
    marked = scan_numbers(stamps, "field", "time_us", "field_order", gap)
    starts = marked.groupBy("field", "scan_number").agg(F.min("time_us").alias("t"))
    return starts.groupBy("field").agg(F.sort_array(F.collect_list(F.struct("t", "scan_number"))).alias("_scans"))


def import_files(spark: SparkSession, paths: list[str], scan_gap: float = 15.0) -> tuple[DataFrame, RawSetup]:
    """The fact table of raw files, and their dimension tables.

    One row per raw row and subband: time (MJD seconds), time_centroid, interval, antenna1 <= antenna2, field, spw, scan_number,
    uvw (m), and the cells of decode_cells. Rows whose antennas stand the other way round are exchanged, uvw negated. A pause of more
    than scan_gap seconds in a field starts a scan. The raw rows are read once for the scans (times alone) and once for the cells.
    """
    s = read_setup(spark, paths)
    a = s.axes
    raw = read_table(spark, s.scanned, "UV_DATA")
    named = {re.split(r"[^a-z0-9]", c)[0]: c for c in reversed(raw.columns)}
    number = lambda c: F.col(f"`{named[c]}`")
    seconds = (number("date") - MJD0 + number("time")) * 86400.0
    source = number("source") if "source" in named else number("source_id")
    time_us = F.round(seconds * 1e6).cast("long").alias("time_us")
    rows = raw.select("file", "row", time_us, seconds.alias("time"), F.floor(number("baseline") / 256).cast("int").alias("_n1"), (number("baseline") % 256).cast("int").alias("_n2"), source.alias("_source"), number("freqid").alias("freqid"), number("inttim").cast("double").alias("interval"), *[number(c).cast("double").alias(f"_{c}") for c in ("uu", "vv", "ww")], number("flux").alias("flux"))
    field_of = s.field_of.select("file", F.col("number").alias("_source"), "field")
    times = read_table(spark, s.scanned, "UV_DATA", only=["file", *[named[c] for c in ("date", "time", "source" if "source" in named else "source_id")]])
    stamps = times.select("file", source.alias("_source"), time_us).join(F.broadcast(field_of), ["file", "_source"]).select("field", "time_us", F.col("field").alias("field_order")).distinct()
    scans = scan_lists(stamps, scan_gap)
    end = lambda k: s.antenna_of.select("file", F.col("number").alias(f"_n{k}"), F.col("antenna").alias(f"_a{k}"))
    rows = rows.join(F.broadcast(field_of), ["file", "_source"]).join(F.broadcast(end(1)), ["file", "_n1"]).join(F.broadcast(end(2)), ["file", "_n2"]).join(F.broadcast(scans), "field")
    swapped = F.col("_a1") > F.col("_a2")
    rows = rows.withColumns({"swapped": swapped, "antenna1": F.least("_a1", "_a2"), "antenna2": F.greatest("_a1", "_a2"), "scan_number": F.get("_scans", _count_until(F.col("_scans"), F.col("time_us")) - 1)["scan_number"]})
    sign = F.when(F.col("swapped"), -LIGHT).otherwise(LIGHT)
    rows = rows.withColumn("uvw", F.array(*[F.col(f"_{c}") * sign for c in ("uu", "vv", "ww")])).withColumn("time_centroid", F.col("time") + F.col("interval") / 2)
    rows = rows.join(F.broadcast(s.window_of), ["file", "freqid"])
    size = a["nchan"] * len(a["stokes"]) * a["values"]
    rows = rows.withColumn("flux", F.slice("flux", F.col("band") * size + 1, F.lit(size)).cast("array<double>"))
    levels = s.antennas.select("antenna", "levels")
    for k in (1, 2):
        rows = rows.join(F.broadcast(levels.select(F.col("antenna").alias(f"antenna{k}"), F.col("levels").alias(f"levels{k}"))), f"antenna{k}")
    to = sorted(a["stokes"], key=ORDER.index)
    order = tuple(a["stokes"].index(x) for x in to)
    other = tuple(a["stokes"].index(EXCHANGED.get(x, x)) for x in to)
    parallel = tuple(x[0] == x[1] for x in to)
    out = None
    for width in sorted({r.width for r in s.windows.select("width").distinct().collect()}):
        setup = Setup(a["nchan"], order, other, parallel, a["scale"], abs(width), a["values"], a["kind"], 0.0, False, a["by_weight"])
        part = decode_cells(rows.filter(F.col("width") == width), setup)
        out = part if out is None else out.unionByName(part)
    keep = ["file", "row", "time", "time_centroid", "interval", "antenna1", "antenna2", "field", "spw", "scan_number", "uvw", "re", "im", "flag", "flag_row", "weight", "sigma", "weight_spectrum", "sigma_spectrum"]
    return out.select(*keep), s


def header_bytes(cards: list[tuple[str, object]]) -> bytes:
    text = "".join(f"{k:<8}= {_card(v)}"[:80].ljust(80) for k, v in cards) + "END".ljust(80)
    return text.ljust(-(-len(text) // BLOCK) * BLOCK).encode("ascii")


def _card(v) -> str:
    if isinstance(v, bool):
        return f"{'T' if v else 'F':>20}"
    return f"'{v:<8}'" if isinstance(v, str) else f"{v!r:>20}".replace("e", "E")


def table_bytes(name: str, cols: dict[str, tuple[str, list]], cards: dict | None = None, tile: int = 0) -> bytes:
    """A binary table: per column its form (such as "1D", "16A", "24E") and values. tile: compressed by column in tiles of so many rows."""
    n = len(next(iter(cols.values()))[1])
    forms = {c: re.match(r"(\d+)([A-Z])", form).groups() for c, (form, _) in cols.items()}
    dtype = np.dtype([(c, f"S{k}" if code == "A" else (CODES[code][0], (int(k),))) for c, (k, code) in forms.items()])
    rows = np.zeros(n, dtype)
    for c, (_, values) in cols.items():
        rows[c] = [v.encode() for v in values] if forms[c][1] == "A" else np.asarray(values).reshape(rows[c].shape)
    own = [(f"{t}{i}", v) for i, (c, (form, _)) in enumerate(cols.items(), 1) for t, v in (("TTYPE", c), ("TFORM", "1QB" if tile else form))]
    size, data, heap, more = (dtype.itemsize, n), rows.tobytes(), 0, []
    if tile:
        numbers = {c: dtype[c].base.itemsize > 1 and forms[c][1] != "A" for c in cols}
        parts = [packed(rows[c][a : a + tile], numbers[c]) for a in range(0, n, tile) for c in cols]
        length = np.array([len(x) for x in parts], ">i8")
        data = np.stack([length, np.cumsum(length) - length], axis=1).astype(">i8").tobytes() + b"".join(parts)
        size, heap = (16 * len(cols), -(-n // tile)), int(length.sum())
        own += [(f"{t}{i}", v) for i, (c, (form, _)) in enumerate(cols.items(), 1) for t, v in (("ZFORM", form), ("ZCTYP", "GZIP_2" if numbers[c] else "GZIP_1"))]
        more = [("ZTABLE", True), ("ZNAXIS1", dtype.itemsize), ("ZNAXIS2", n), ("ZPCOUNT", 0), ("ZTILELEN", tile)]
    head = [("XTENSION", "BINTABLE"), ("BITPIX", 8), ("NAXIS", 2), ("NAXIS1", size[0]), ("NAXIS2", size[1]), ("PCOUNT", heap), ("GCOUNT", 1), ("TFIELDS", len(cols)), *own, *more, ("EXTNAME", name), *(cards or {}).items()]
    return header_bytes(head) + data.ljust(-(-len(data) // BLOCK) * BLOCK, b"\0")


def primary_bytes() -> bytes:
    return header_bytes([("SIMPLE", True), ("BITPIX", 8), ("NAXIS", 0), ("EXTEND", True)])


def numbered(rows: DataFrame, key: str, counts: dict, at: Column) -> tuple[DataFrame, int]:
    """rows with the number of their file, _file: each value of key has so many files, among which its rows are dealt by a hash; and the number of all files."""
    starts, total = [], 0
    for value, files in sorted(counts.items()):
        starts.append((value, total, files))
        total += files
    listed = rows.sparkSession.createDataFrame(starts, f"{key} int, _start int, _files int")
    return rows.join(F.broadcast(listed), key).withColumn("_file", F.col("_start") + F.pmod(at, F.col("_files")).cast("int")).drop("_start", "_files"), total


def write_files(rows: DataFrame, total: int, rows_per_file: int, folder: str, build) -> list[str]:
    """A file per number _file below total, made in a task by build(pandas rows) -> bytes and put in place by a rename, so that a repeated task does no harm; the paths by number.

    A task gets whole files of some WRITTEN rows in all and tells them apart itself: rows are shuffled, but not sorted. The folder must be one that all executors mount.
    """
    path = folder.removeprefix("file:")
    path = re.sub(r"^/+", "/", path)
    each = max(1, WRITTEN // rows_per_file)

    def write(frames):
        frames = [pdf for pdf in frames if len(pdf)]
        if not frames:
            return
        os.makedirs(path, exist_ok=True)
        pdf = pd.concat(frames, ignore_index=True)
        for number, at in pdf.groupby("_file").indices.items():
            name, part = f"{path}/{number}.idi", f"{path}/.{uuid.uuid4().hex}"
            with open(part, "wb") as f:
                f.write(build(pdf.iloc[at]))
            os.replace(part, name)
            yield pd.DataFrame({"number": [number], "path": [name]})

    dealt = rows.repartitionById(-(-total // each), F.floor(F.col("_file") / each).cast("int"))
    return [r.path for r in sorted(dealt.mapInPandas(write, "number int, path string").collect())]


#: Columns of the fact table that raw files are made from.
EXPORTED = ("file", "row", "time", "interval", "antenna1", "antenna2", "field", "spw", "uvw", "re", "im", "flag", "weight_spectrum")


def export_files(fact: DataFrame, setup: RawSetup, folder: str, rows_per_file: int = 200_000, tile: int = 0) -> list[str]:
    """Write a fact table (as import_files gives it; EXPORTED columns) as raw files again, each with the dimension tables; the files' paths.

    The subbands of a time and baseline become one raw row. A file holds rows of one field, some rows_per_file of them, and is built by one task;
    its rows are in order of time. Subbands must be those of the setup, all of one width. Flagged cells get a negative weight. Cells are
    shuffled once, as the bytes that files hold. tile: rows are compressed in tiles of so many.
    """
    a = setup.axes
    windows = setup.windows.orderBy("spw").collect()
    antennas, fields = setup.antennas.orderBy("antenna").collect(), setup.fields.orderBy("field").collect()
    widths = {w.width for w in windows}
    if len(widths) > 1:
        raise ValueError("subbands of several widths")
    width = widths.pop()
    to = sorted(a["stokes"], key=ORDER.index)
    back = [to.index(x) for x in a["stokes"]]
    nchan, nst, nband = a["nchan"], len(to), len(windows)
    counts = {r.field: max(1, round(r["n"] / nband / rows_per_file)) for r in fact.filter("field IS NOT NULL").groupBy("field").agg(F.count("*").alias("n")).collect()}
    placed, total = numbered(fact.select(*EXPORTED), "field", counts, F.xxhash64("file", "row"))
    keys = ["time", "antenna1", "antenna2", "file", "row", "interval", "u", "v", "w"]
    placed = placed.select("_file", "field", "spw", *keys[:-3], *[F.get("uvw", i).alias(c) for i, c in enumerate("uvw")], "re", "im", "flag", "weight_spectrum")

    def pack(batches):
        """Cells as the numbers a file holds: all real parts, imaginary parts and weights of a row."""
        for batch in batches:
            cell = lambda c: batch[c].flatten().cast(pa.float64()).to_numpy(zero_copy_only=False).reshape(-1, nchan, nst)[..., back]  # noqa: B023, E731
            number = lambda c: batch[c].to_numpy(zero_copy_only=False)  # noqa: B023, E731
            scale = a["scale"] * abs(width) * (1 + (number("antenna1") != number("antenna2"))) * number("interval")
            w = cell("weight_spectrum") / scale[:, None, None]
            cells = np.stack([cell("re"), -cell("im"), np.where(cell("flag") > 0, -w, w)], axis=1).astype(">f4")
            flat, size = pa.py_buffer(cells.tobytes()), cells[:1].nbytes
            ends = pa.py_buffer(np.arange(0, (len(cells) + 1) * size, size, dtype=np.int32)) if len(cells) else pa.py_buffer(np.zeros(1, np.int32))
            kept = [c for c in batch.schema.names if c not in ("re", "im", "flag", "weight_spectrum")]
            yield pa.RecordBatch.from_arrays([*[batch[c] for c in kept], pa.Array.from_buffers(pa.binary(), len(cells), [None, ends, flat])], [*kept, "cells"])

    kinds = dict(placed.dtypes)
    dealt = placed.mapInArrow(pack, ", ".join(f"{c} {k}" for c, k in kinds.items() if not k.startswith("array")) + ", cells binary")
    base, listed = windows[0].freqs[0], [w.freqs[0] for w in windows]
    pixel = a["ref_pixl"]

    def build(pdf: pd.DataFrame) -> bytes:
        pdf = pdf.sort_values(keys, ignore_index=True)
        first, own = np.ones(len(pdf), bool), pdf[keys].to_numpy(float)
        first[1:] = ((own[1:] != own[:-1]) & ~(np.isnan(own[1:]) & np.isnan(own[:-1]))).any(axis=1)
        at, spw = np.cumsum(first) - 1, pdf["spw"].to_numpy()
        cells = np.frombuffer(b"".join(pdf["cells"]), ">f4").reshape(-1, 3, nchan, nst)
        pdf = pdf[first]
        n, flux = len(pdf), np.zeros((len(pdf), nband, nchan, nst, 3), ">f4")
        flux[at, spw] = np.moveaxis(cells, 1, -1)
        day = np.floor(pdf["time"].to_numpy() / 86400)
        uvw = pdf[["u", "v", "w"]].to_numpy() / LIGHT
        many = lambda form: f"{nband}{form}"
        shared = {"NO_STKD": nst, "STK_1": next(k for k, v in STOKES.items() if v == a["stokes"][0]), "NO_BAND": nband, "NO_CHAN": nchan, "REF_FREQ": base, "REF_PIXL": pixel, "CHAN_BW": width, "VIS_SCAL": a["scale"]}
        return b"".join([
            primary_bytes(),
            table_bytes("ARRAY_GEOMETRY", {"ANNAME": ("8A", [x.name for x in antennas]), "STABXYZ": ("3D", [x.position for x in antennas]), "NOSTA": ("1J", [x.antenna + 1 for x in antennas])}),
            table_bytes("ANTENNA", {"ANTENNA_NO": ("1J", [x.antenna + 1 for x in antennas]), "NO_LEVELS": (many("J"), [[x.levels or 0] * nband for x in antennas])}),
            table_bytes("SOURCE", {"SOURCE_ID": ("1J", [x.field + 1 for x in fields]), "SOURCE": ("16A", [x.name for x in fields]), "RAEPO": ("1D", [x.raepo for x in fields]), "DECEPO": ("1D", [x.decepo for x in fields])}),
            table_bytes("FREQUENCY", {"FREQID": ("1J", [1]), "BANDFREQ": (many("D"), [[f - base - (1 - pixel) * width for f in listed]]), "CH_WIDTH": (many("E"), [[width] * nband])}, shared),
            table_bytes("UV_DATA", {
                "UU": ("1D", uvw[:, 0]), "VV": ("1D", uvw[:, 1]), "WW": ("1D", uvw[:, 2]), "DATE": ("1D", day + MJD0), "TIME": ("1D", pdf["time"].to_numpy() / 86400 - day), "BASELINE": ("1J", 256 * (pdf["antenna1"].to_numpy() + 1) + pdf["antenna2"].to_numpy() + 1),
                "SOURCE": ("1J", pdf["field"].to_numpy() + 1), "FREQID": ("1J", np.ones(n, int)), "INTTIM": ("1E", pdf["interval"].to_numpy()), "FLUX": (f"{nband * nchan * nst * 3}E", flux.reshape(n, -1)),
            }, shared, tile),
        ])

    return write_files(dealt, total, rows_per_file, folder, build)


#: Rows of a stand-in file, some of which make up each of three files' numbering.
ROWS_PER_FILE = 100_000
NCHAN, NBAND, NAMES, FIELDS = 4, 2, [f"ST{k}" for k in range(8)], ["ALPHA", "BETA", "GAMMA"]


def _made(s, d) -> list[str]:
    """Raw files from lineitem, by line number, of some ROWS_PER_FILE rows: antennas and sources numbered upwards in some, downwards in the others."""
    day = F.datediff(F.col("l_shipdate").cast("date"), F.lit("1858-11-17").cast("date"))
    rows = table(s, d, "lineitem").select(
        (F.col("l_linenumber") % 3).cast("int").alias("file"), day.alias("day"), (F.col("l_orderkey") % 64).alias("part"), (F.col("l_suppkey") % 8).cast("int").alias("a"), (F.col("l_partkey") % 8).cast("int").alias("b"), (F.col("l_partkey") % 3).cast("int").alias("f"),
        F.col("l_quantity").cast("double").alias("q"), F.round(F.col("l_discount") * 100).cast("double").alias("x"), F.round(F.col("l_tax") * 100).cast("double").alias("w"), F.xxhash64("l_orderkey", "l_partkey", "l_suppkey").alias("_at"),
    )
    counts = {r.file: -(-r["n"] // ROWS_PER_FILE) for r in rows.groupBy("file").agg(F.count("*").alias("n")).collect()}
    rows, total = numbered(rows, "file", counts, F.col("_at"))

    def build(pdf):
        up = pdf["file"].iloc[0] % 2 == 0
        number = (lambda k: k + 1) if up else (lambda k: 8 - k)
        source = (lambda k: k + 1) if up else (lambda k: 3 - k)
        ids, files = sorted(range(8), key=number), sorted(range(3), key=source)
        n, at = len(pdf), {c: pdf[c].to_numpy() for c in pdf}
        flux = np.zeros((n, NBAND, NCHAN, 2, 3))
        flux[..., 0] = at["q"][:, None, None, None] + 100 * np.arange(NBAND)[:, None, None] + np.arange(NCHAN)[:, None]
        flux[..., 1] = at["x"][:, None, None, None] + 10 * np.arange(2)
        flux[..., 2] = at["w"][:, None, None, None] - np.arange(2)
        shared = {"NO_STKD": 2, "STK_1": -1, "NO_BAND": NBAND, "NO_CHAN": NCHAN, "REF_FREQ": 5e9, "REF_PIXL": 1.0, "CHAN_BW": 1e6}
        return b"".join([
            primary_bytes(),
            table_bytes("ARRAY_GEOMETRY", {"ANNAME": ("8A", [NAMES[k] for k in ids]), "STABXYZ": ("3D", [[k, 2.0 * k, 3.0] for k in ids]), "NOSTA": ("1J", [number(k) for k in ids])}),
            table_bytes("ANTENNA", {"ANTENNA_NO": ("1J", [number(k) for k in ids]), "NO_LEVELS": (f"{NBAND}J", [[4] * NBAND] * 8)}),
            table_bytes("SOURCE", {"SOURCE_ID": ("1J", [source(k) for k in files]), "SOURCE": ("16A", [FIELDS[k] for k in files]), "RAEPO": ("1D", [10.0 * k for k in files]), "DECEPO": ("1D", [5.0 * k for k in files])}),
            table_bytes("FREQUENCY", {"FREQID": ("1J", [1]), "BANDFREQ": (f"{NBAND}D", [[0.0, 4e6]]), "CH_WIDTH": (f"{NBAND}E", [[1e6, 1e6]])}, shared),
            table_bytes("UV_DATA", {
                "UU---SIN": ("1D", at["q"] / LIGHT), "VV---SIN": ("1D", at["x"] / LIGHT), "WW---SIN": ("1D", at["w"] / LIGHT), "DATE": ("1D", at["day"] + MJD0), "TIME": ("1D", at["part"] / 1024),
                "BASELINE": ("1J", 256 * number(at["a"]) + number(at["b"])), "SOURCE": ("1J", source(at["f"])), "FREQID": ("1J", np.ones(n, int)), "INTTIM": ("1E", np.full(n, 2.0)), "FLUX": (f"{NBAND * NCHAN * 6}E", flux.reshape(n, -1)),
            }, shared, TILE),
        ])

    return write_files(rows.drop("_at"), total, ROWS_PER_FILE, f"{shared_folder(s)}/idi-{uuid.uuid4().hex}", build)


def _imported(s, d):
    return _per_scan(*import_files(s, _made(s, d), 86400.0 * 3))


def _exported(s, d):
    """Imported, written as other files, and imported from those."""
    fact, setup = import_files(s, _made(s, d), 86400.0 * 3)
    paths = export_files(pinned(fact.select(*EXPORTED)), setup, f"{shared_folder(s)}/idi-{uuid.uuid4().hex}", 5000, TILE)
    return _per_scan(*import_files(s, paths, 86400.0 * 3))


def _per_scan(fact: DataFrame, setup: RawSetup) -> DataFrame:
    """Sums of cells per baseline, source, subband and scan, with the names of the dimensions."""
    names = setup.antennas.select("antenna", "name")
    cells = F.arrays_zip("re", "im", "flag", "weight_spectrum")
    total = lambda f: F.aggregate(F.transform(cells, f), F.lit(0.0), lambda a, x: a + x)
    sums = fact.select("antenna1", "antenna2", "field", "spw", "scan_number", "uvw", total(lambda c: F.when(c["flag"], 0.0).otherwise(c["re"])).alias("re"), total(lambda c: F.when(c["flag"], 0.0).otherwise(c["im"])).alias("im"), total(lambda c: c["flag"].cast("double")).alias("bad"), total(lambda c: c["weight_spectrum"]).alias("w"))
    g = sums.groupBy("antenna1", "antenna2", "field", "spw", "scan_number").agg(F.count("*").alias("n_rows"), *[F.round(F.sum(c), 3).alias(c) for c in ("re", "im", "bad", "w")], F.round(F.sum(F.get("uvw", 0)), 4).alias("u"))
    for k in (1, 2):
        g = g.join(F.broadcast(names.select(F.col("antenna").alias(f"antenna{k}"), F.col("name").alias(f"name{k}"))), f"antenna{k}")
    g = g.join(F.broadcast(setup.fields.select("field", F.col("name").alias("source"))), "field").join(F.broadcast(setup.windows.select("spw", F.get("freqs", 0).alias("first_freq"))), "spw")
    return g.select("name1", "name2", "source", "first_freq", "scan_number", "n_rows", "re", "im", "bad", "w", "u")


QUERIES = {"import_raw_files": _imported, "export_raw_files": _exported}
_TRUTH = """WITH l AS (SELECT CAST(l_suppkey % 8 AS INT) AS a, CAST(l_partkey % 8 AS INT) AS b, CAST(l_partkey % 3 AS INT) AS f, l_quantity::DOUBLE AS q, round(l_discount * 100)::DOUBLE AS x, round(l_tax * 100)::DOUBLE AS w,
        date_diff('day', DATE '1858-11-17', CAST(l_shipdate AS DATE)) * 86400000000 + l_orderkey % 64 * 84375000 AS t FROM lineitem),
      st AS (SELECT DISTINCT f, t FROM l), ga AS (SELECT f, t, (t - lag(t) OVER (PARTITION BY f ORDER BY t) <= 259200000000) IS NOT TRUE AS new FROM st),
      nth AS (SELECT f, t, new, sum(new::INT) OVER (PARTITION BY f ORDER BY t) AS k FROM ga), sc AS (SELECT f, k, row_number() OVER (ORDER BY t, f) AS scan_number FROM nth WHERE new),
      r AS (SELECT l.*, scan_number FROM l JOIN nth ON nth.f = l.f AND nth.t = l.t JOIN sc ON sc.f = nth.f AND sc.k = nth.k),
      e AS (SELECT least(a, b) AS n1, greatest(a, b) AS n2, f, scan_number, band, h, a > b AS swapped, q, x, w - h AS w, a <> b AS crossed FROM r, range(2) y(band), range(2) z(h)),
      s AS (SELECT n1, n2, f, band, scan_number, count(*) / 2 AS n_rows, sum(CASE WHEN w > 0 THEN 4 * (q + 100 * band) + 6 ELSE 0 END) AS re, sum(CASE WHEN w > 0 THEN 4 * (CASE WHEN swapped THEN 1 ELSE -1 END) * (x + 10 * h) ELSE 0 END) AS im,
        sum(CASE WHEN w > 0 THEN 0 ELSE 4 END)::DOUBLE AS bad, sum(4 * abs(w) * 1e6 * 2 * CASE WHEN crossed THEN 2 ELSE 1 END) AS w, sum(CASE WHEN h = 0 THEN CASE WHEN swapped THEN -q ELSE q END ELSE 0 END) AS u FROM e GROUP BY ALL)
      SELECT 'ST' || n1 AS name1, 'ST' || n2 AS name2, ['ALPHA', 'BETA', 'GAMMA'][f + 1] AS source, 5e9 + 4e6 * band AS first_freq, scan_number, CAST(n_rows AS BIGINT) AS n_rows, round(re, 3) AS re, round(im, 3) AS im, round(bad, 3) AS bad, round(w, 3) AS w, round(u, 4) AS u FROM s"""
SQL = {"import_raw_files": _TRUTH, "export_raw_files": _TRUTH}
