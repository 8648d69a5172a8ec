"""Spark data source for FITS binary tables (the public FITS standard): format "fits", options path, extension, rows.

Each partition is a range of rows of one file, read by offset. Column types: L, B, I, J, K, E, D, A and
arrays of them; complex C and M become arrays twice as long (re, im in turns). Needs the file on a path
that every executor can open. Tables may be compressed in tiles of rows (the standard's ZTABLE convention, by gzip).
"""

from __future__ import annotations

import gzip
import math
import re
from collections.abc import Iterator

import numpy as np
from pyspark.sql.datasource import DataSource, DataSourceReader, InputPartition

BLOCK = 2880
#: Code: NumPy type (big-endian), values per element, Spark type.
CODES = {"L": ("S1", 1, "boolean"), "B": ("u1", 1, "int"), "I": (">i2", 1, "int"), "J": (">i4", 1, "int"), "K": (">i8", 1, "bigint"), "E": (">f4", 1, "float"), "D": (">f8", 1, "double"), "C": (">f4", 2, "float"), "M": (">f8", 2, "double"), "A": ("S", 1, "string")}


def read_header(f) -> dict:
    cards: dict = {}
    while True:
        block = f.read(BLOCK)
        if len(block) < BLOCK:
            return cards
        for i in range(0, BLOCK, 80):
            card = block[i : i + 80].decode("ascii", "replace")
            key = card[:8].strip()
            if key == "END":
                return cards
            if card[8:10] == "= ":
                raw = card[10:]
                text = re.match(r"\s*'((?:[^']|'')*)'", raw)
                value = text[1].replace("''", "'").rstrip() if text else raw.split("/")[0].strip()
                if not text:
                    value = {"T": True, "F": False}.get(value, value)
                    if isinstance(value, str) and value:
                        value = int(value) if re.fullmatch(r"[-+]?\d+", value) else float(value.replace("D", "E"))
                cards.setdefault(key, value)


def data_size(h: dict) -> int:
    if not h.get("NAXIS"):
        return 0
    n = math.prod(h[f"NAXIS{i}"] for i in range(1, h["NAXIS"] + 1))
    return abs(h["BITPIX"]) // 8 * h.get("GCOUNT", 1) * (h.get("PCOUNT", 0) + n)


def find_table(path: str, extension: str) -> tuple[dict, int]:
    """Header and data offset of the binary table of a name."""
    with open(path, "rb") as f:
        while h := read_header(f):
            if h.get("XTENSION") == "BINTABLE" and h.get("EXTNAME", "").upper() == extension.upper():
                return h, f.tell()
            f.seek(-(-data_size(h) // BLOCK) * BLOCK, 1)
    raise ValueError(f"no table {extension} in {path}")


def columns(h: dict) -> list[tuple[str, str, int]]:
    """Name, code and repeat count of each column."""
    out = []
    for i in range(1, h["TFIELDS"] + 1):
        n, code = re.match(r"(\d*)([A-Z])", h.get(f"ZFORM{i}", h[f"TFORM{i}"])).groups()
        out.append((h.get(f"TTYPE{i}", f"c{i}").lower(), code, int(n or 1)))
    return out


def row_count(h: dict) -> int:
    return h["ZNAXIS2"] if h.get("ZTABLE") else h["NAXIS2"]


def packed(values: np.ndarray, shuffled: bool) -> bytes:
    """A column of a tile by gzip; shuffled: first bytes of all numbers first."""
    data = np.ascontiguousarray(values).tobytes()
    return gzip.compress(np.frombuffer(data, "u1").reshape(-1, values.dtype.itemsize).T.tobytes() if shuffled else data, 1, mtime=0)


def _unpacked(data: bytes, kind: str, dtype: np.dtype) -> np.ndarray:
    if kind not in ("GZIP_1", "GZIP_2"):
        raise ValueError(f"column compressed by {kind}")
    data = gzip.decompress(data)
    return np.frombuffer(np.frombuffer(data, "u1").reshape(dtype.base.itemsize, -1).T.tobytes() if kind == "GZIP_2" else data, dtype)


def read_rows(f, h: dict, offset: int, total: int, first: int, last: int, names: set | None = None) -> np.ndarray:
    """Rows of a range as a structured array, of names' columns if the table (of total rows) is compressed; of that, only their tiles are read."""
    cols = [(i, *c) for i, c in enumerate(columns(h)) if c[2]]
    dtype = lambda cols: np.dtype([(name, f"S{n}" if code == "A" else (CODES[code][0], (n * CODES[code][1],))) for _, name, code, n in cols])
    if not h.get("ZTABLE"):
        f.seek(offset + first * h["NAXIS1"])
        return np.frombuffer(f.read((last - first) * h["NAXIS1"]), dtype(cols))
    cols = [c for c in cols if names is None or c[1] in names]
    out, step = np.empty(last - first, dtype(cols)), h["ZTILELEN"]
    heap = offset + h.get("THEAP", h["NAXIS1"] * -(-total // step))
    for tile in range(first // step, -(-last // step)):
        f.seek(offset + tile * h["NAXIS1"])
        row, place = f.read(h["NAXIS1"]), {}
        at = 0
        for i in range(1, h["TFIELDS"] + 1):
            size = 8 if re.match(r"\d*Q", h[f"TFORM{i}"]) else 4
            place[i - 1] = np.frombuffer(row, f">i{size}", 2, at)
            at += 2 * size
        a, b = max(first, tile * step), min(last, (tile + 1) * step)
        for i, name, *_ in cols:
            f.seek(heap + int(place[i][1]))
            out[name][a - first : b - first] = _unpacked(f.read(int(place[i][0])), h[f"ZCTYP{i + 1}"], out.dtype[name])[a - tile * step : b - tile * step]
    return out


class FitsSource(DataSource):
    @classmethod
    def name(cls) -> str:
        return "fits"

    def schema(self) -> str:
        h, _ = find_table(self.options["path"].split(",")[0], self.options["extension"])
        kind = lambda code, n: CODES[code][2] if code == "A" or n * CODES[code][1] == 1 else f"array<{CODES[code][2]}>"
        return ", ".join(f"`{name}` {kind(code, n)}" for name, code, n in columns(h) if n)

    def reader(self, schema) -> DataSourceReader:
        return FitsReader(self.options)


class FitsReader(DataSourceReader):
    def __init__(self, options: dict):
        self.paths, self.extension = options["path"].split(","), options["extension"]
        self.rows = int(options.get("rows", 100_000))

    def partitions(self) -> list[InputPartition]:
        out = []
        for path in self.paths:
            n = row_count(find_table(path, self.extension)[0])
            out += [InputPartition((path, a, min(n, a + self.rows))) for a in range(0, n, self.rows)]
        return out

    def read(self, partition: InputPartition) -> Iterator[tuple]:
        path, first, last = partition.value
        h, offset = find_table(path, self.extension)
        cols = [c for c in columns(h) if c[2]]
        with open(path, "rb") as f:
            table = read_rows(f, h, offset, row_count(h), first, last)
        for row in table:
            yield tuple(self.value(row[name], code) for name, code, _ in cols)

    @staticmethod
    def value(x, code: str):
        if code == "A":
            return x.decode("ascii", "replace").rstrip("\0 ")
        out = (x == b"T").tolist() if code == "L" else x.tolist()
        return out if len(out) > 1 else out[0]


def register(spark) -> None:
    spark.dataSource.register(FitsSource)
