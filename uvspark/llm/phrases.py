"""Phrase collocations by levels of candidates, a minimal perfect hash over each, and arrays of counts.

Texts become arrays of 64-bit word keys (0: a break) once. Phrases of k words may only be frequent if both their
parts of k - 1 words are. For each k:

1. Mappers count the hashes of phrases whose parts are frequent in a table of bounded size; tables are summed in a
   tree. Only phrases at places that reach the least count can be frequent, whatever else fell there.
2. Those phrases are the candidates, a superset of the frequent ones. Some tasks send theirs first; the others are told
   of them and send only what isn't among them. A minimal perfect hash gives each candidate a slot and stores its key
   and a check, so that no other phrase counts.
3. Mappers bincount slots, and the arrays are summed in a tree: exact counts by slot.

Cuts are read by slot: the counts of a phrase's parts come from a perfect hash over the frequent phrases.
What is sent to tasks is bounded: tables of PLACES bits at most, and perfect hashes of ROUND_KEYS keys. More candidates
are counted in several rounds.
"""

from __future__ import annotations

import struct
import zlib
from collections.abc import Callable, Iterator
from contextlib import contextmanager

import numpy as np
import pandas as pd
import xxhash
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from .common import materialize, table
from .perfect_hash import PerfectHash

_U = np.uint64
_LOWER = bytes(c + 32 if 65 <= c <= 90 else c for c in range(256))
#: Of each byte: 0 inside a word, 1 between words, 2 between pieces.
_KIND = np.zeros(256, np.uint8)
_KIND[[0x20, 0x09]] = 1
_KIND[[*b".,;:!?\n\x0b\x0c\r"]] = 2
_BYTE = np.random.Generator(np.random.PCG64(1111)).integers(0, 1 << 64, 256, dtype=_U)
_MUL = _U(0x9E3779B97F4A7C15)
_BACK = _U(pow(int(_MUL), -1, 1 << 64))
_CHECK = _U(0xD1342543DE82EF95)

#: Characters of text made into keys at once; least and most places of a table; words that fall to a place on average; keys of a perfect hash.
TEXT_STEP, LEAST_PLACES, PLACES, LOAD, ROUND_KEYS = 60_000, 1 << 14, 1 << 26, 8, 1 << 21
#: Texts, and blocks of keys, that a task is handed at once.
TEXT_ROWS, BLOCK_ROWS = 1000, 64
#: Bits (or slots) of a row of sums, arrays summed by one task, indices gathered before they are counted.
CHUNK, FAN, GATHERED = 1 << 14, 64, 1 << 20
#: One of so many parts of the blocks sends its candidates first.
EARLY = 8


def mix(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> _U(32))) * _U(0xD6E8FEB86659FD93)
    x = (x ^ (x >> _U(32))) * _U(0xD6E8FEB86659FD93)
    return x ^ (x >> _U(32))


def words_of(texts: list[str | None], lang: str) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray, bytes]:
    """Keys of the words of texts in their order, whether a piece begins before each, their first byte, the byte after, and the bytes."""
    raw = ("\n" + "\n".join(t or "" for t in texts) + "\n").encode("utf-8", "surrogatepass").translate(_LOWER)
    codes = np.frombuffer(raw, np.uint8)
    kind = _KIND[codes]
    gap = kind > 0
    first, last = np.flatnonzero(gap[:-1] & ~gap[1:]) + 1, np.flatnonzero(~gap[:-1] & gap[1:]) + 1
    with np.errstate(over="ignore"):
        powers = np.full(len(codes) + 1, _MUL, _U)
        powers[0] = 1
        np.multiply.accumulate(powers, out=powers)
        sums = np.concatenate([[_U(0)], np.cumsum(_BYTE[codes] * powers[:-1], dtype=_U)])
        back = np.full(len(codes) + 1, _BACK, _U)
        back[0] = 1
        np.multiply.accumulate(back, out=back)
        key = mix(mix((sums[last] - sums[first]) * back[first] + (last - first).astype(_U)) ^ _U(xxhash.xxh64_intdigest(lang)))
    key[key == 0] = 1
    pieces = np.cumsum(kind == 2)[first]
    return key, np.diff(pieces, prepend=0) > 0, first, last, raw


def by_lang(batches: Iterator[pd.DataFrame]) -> Iterator[tuple[str, list[str | None]]]:
    """Texts of one language, of some TEXT_STEP characters together."""
    for pdf in batches:
        for lang, part in pdf.groupby("lang", sort=False):
            held, size = [], 0
            for text in part["text"].tolist():
                held.append(text)
                size += len(text or "")
                if size >= TEXT_STEP:
                    yield lang, held
                    held, size = [], 0
            if held:
                yield lang, held


def key_batches(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """(lang, n_words, words): arrays of word keys, a 0 before each piece."""
    for lang, texts in by_lang(batches):
        key, breaks, *_ = words_of(texts, lang)
        if len(key):
            words = np.zeros(len(key) + int(breaks.sum()), _U)
            words[np.arange(len(key)) + np.cumsum(breaks)] = key
            yield pd.DataFrame({"lang": [lang], "n_words": [len(key)], "words": [words.tobytes()]})


def extend(keys: np.ndarray, words: np.ndarray, k: int) -> np.ndarray:
    """Keys of phrases of k words from those of k - 1 and the last words."""
    return mix(keys * _MUL + words + _U(k))


def fold(words: np.ndarray) -> np.ndarray:
    """Keys of phrases, one per row of word keys."""
    keys = words[:, 0]
    for j in range(1, words.shape[1]):
        keys = extend(keys, words[:, j], j + 1)
    return keys


def check(words: np.ndarray) -> np.ndarray:
    """A second digest of phrases, independent of fold."""
    out = mix(words[:, 0] ^ _CHECK)
    for j in range(1, words.shape[1]):
        out = mix((out ^ words[:, j]) * _CHECK + _U(j))
    return out


def place(keys: np.ndarray, size: int) -> np.ndarray:
    """Places of keys in a table, by their upper halves."""
    return (((keys >> _U(32)) * _U(size)) >> _U(32)).astype(np.int64)


def has(bits: np.ndarray, keys: np.ndarray) -> np.ndarray:
    """Whether the bit of each key is set."""
    at = place(keys, 8 * len(bits))
    return (bits[at >> 3] >> (at & 7).astype(np.uint8)) & 1 == 1


def places(words: np.ndarray, k: int, frequent: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    """Where phrases of k words begin whose parts are frequent as far as the tables of the shorter ones tell, and their keys."""
    at = np.flatnonzero(words)
    keys = words[at]
    for j in range(2, k + 1):
        go = has(frequent[j - 2], keys)
        at, keys = at[go], keys[go]
        there = np.zeros(len(words) + 1, bool)
        there[at] = True
        go = there[at + 1]
        at, keys = at[go], extend(keys[go], words[at[go] + j - 1], j)
    return at, keys


def spelled(words: np.ndarray, at: np.ndarray, k: int) -> np.ndarray:
    """The words of phrases, a row each."""
    return words[at[:, None] + np.arange(k)]


def squeezed(counts: np.ndarray) -> bytes:
    """Counts in planes of bytes, each compressed by itself: if few aren't 0, the gaps between those and their values, else all."""
    at = np.flatnonzero(counts)
    few = 3 * len(at) < len(counts)
    gaps, values = (np.diff(at, prepend=-1) - 1, counts[at]) if few else (at[:0], counts)
    planes = [gaps & 255, gaps >> 8, *np.ascontiguousarray(values).view(np.uint8).reshape(-1, values.itemsize).T]
    parts = []
    for plane in planes:
        how = zlib.compressobj(1, zlib.DEFLATED, -15, 9, zlib.Z_RLE)
        parts.append(how.compress(plane.astype(np.uint8).tobytes()) + how.flush())
    return struct.pack(f"<I?B{len(parts)}I", len(counts), few, len(parts), *map(len, parts)) + b"".join(parts)


def released(data: bytes) -> np.ndarray:
    """The counts, as 64-bit numbers."""
    n, few, k = struct.unpack_from("<I?B", data)
    planes, start = [], 6 + 4 * k
    for size in struct.unpack_from(f"<{k}I", data, 6):
        planes.append(np.frombuffer(zlib.decompress(data[start : start + size], -15), np.uint8).astype(np.int64))
        start += size
    values = sum(plane << (8 * i) for i, plane in enumerate(planes[2:]))
    if not few:
        return values
    out = np.zeros(n, np.int64)
    out[np.cumsum((planes[0] | planes[1] << 8) + 1) - 1] = values
    return out


class Tally:
    """Counts of indices below `size`, sent in chunks; with `most`, counts stop there, in a byte each."""

    def __init__(self, size: int, most: int | None = None):
        self.most, self.held, self.n = most, [], 0
        self.counts = np.zeros(size, np.uint8 if most is not None and most < 256 else np.uint32)

    def add(self, at: np.ndarray) -> None:
        self.held.append(at)
        self.n += len(at)
        if self.n >= GATHERED:
            self.settle()

    def settle(self) -> None:
        if self.n and self.most is None:
            more = np.bincount(np.concatenate(self.held), minlength=len(self.counts))
            np.add(self.counts, more, out=self.counts, casting="unsafe")
        elif self.n:  # few of very many places: no array of that size beside the counts
            at, more = np.unique(np.concatenate(self.held), return_counts=True)
            self.counts[at] = np.minimum(self.counts[at] + more, self.most)
        self.held, self.n = [], 0

    def rows(self) -> pd.DataFrame:
        """(chunk, mapper, counts); chunks without any are left out."""
        self.settle()
        found = [(c, part) for c in range(0, -(-len(self.counts) // CHUNK)) if (part := self.counts[c * CHUNK : (c + 1) * CHUNK]).any()]
        mapper = TaskContext.get().partitionId()
        return pd.DataFrame([(c, mapper, squeezed(part)) for c, part in found], columns=["chunk", "mapper", "counts"])


TALLY = "chunk int, mapper int, counts binary"
SUM = "chunk int, mapper int, total binary"


def _sum(pdf: pd.DataFrame, column: str, fan: int) -> pd.DataFrame:
    total = sum(map(released, pdf[column]))
    return pd.DataFrame({"chunk": [pdf["chunk"].iloc[0]], "mapper": [pdf["mapper"].iloc[0] // fan], "total": [squeezed(total)]})


@contextmanager
def arrow_rows(spark, n: int):
    """While it lasts, Python stages are handed n rows at once: blocks are large rows, and what is handed over at once takes memory beside the heap."""
    name = "spark.sql.execution.arrow.maxRecordsPerBatch"
    before = spark.conf.get(name)
    spark.conf.set(name, n)
    try:
        yield
    finally:
        spark.conf.set(name, before)


def tree_sum(tallies: DataFrame) -> DataFrame:
    """(chunk, total): sums over all mappers, FAN of them in a task."""
    fan = FAN
    node = F.floor(F.col("mapper") / fan)
    with arrow_rows(tallies.sparkSession, BLOCK_ROWS):
        sums = materialize(tallies.groupBy("chunk", node).applyInPandas(lambda pdf: _sum(pdf, "counts", fan), SUM))
    while (sums.agg(F.max("mapper")).first()[0] or 0) > 0:
        sums = materialize(sums.groupBy("chunk", node).applyInPandas(lambda pdf: _sum(pdf, "total", fan), SUM))
    return sums.select("chunk", "total")


def gathered(rows: DataFrame, size: int) -> np.ndarray:
    """The bit table from its chunks (chunk, bits): at most PLACES bits."""
    out = np.zeros(size // 8, np.uint8)
    for r in rows.toLocalIterator():
        part = np.frombuffer(r["bits"], np.uint8)
        out[r["chunk"] * CHUNK // 8 :][: len(part)] = part
    return out


def reached(sums: DataFrame, least: int, size: int) -> np.ndarray:
    """Bits of the places whose total is at least `least`."""

    def pack(batches):
        for pdf in batches:
            packed = [np.packbits(released(t) >= least, bitorder="little").tobytes() for t in pdf["total"]]
            yield pd.DataFrame({"chunk": pdf["chunk"], "bits": packed})

    return gathered(sums.mapInPandas(pack, "chunk int, bits binary"), size)


def bits_of(keys: DataFrame, size: int) -> np.ndarray:
    """Bits of the keys of a table."""

    def pack(pdf):
        at = place(pdf["key"].to_numpy().view(_U), size)
        chunk = int(at[0]) // CHUNK
        row = np.zeros(min(CHUNK, size - chunk * CHUNK), bool)
        row[at - chunk * CHUNK] = True
        return pd.DataFrame({"chunk": [chunk], "bits": [np.packbits(row, bitorder="little").tobytes()]})

    at = F.shiftrightunsigned(F.shiftrightunsigned("key", 32) * F.lit(size), 32)
    return gathered(keys.select("key").groupBy(F.floor(at / CHUNK)).applyInPandas(pack, "chunk int, bits binary"), size)


def each_batch(work: Callable[[np.ndarray], pd.DataFrame | None], done: Callable[[], pd.DataFrame] | None = None):
    """A function for mapInPandas over blocks of word keys, those of a batch together: each block begins with a break."""

    def run(batches):
        with np.errstate(over="ignore"):
            for pdf in batches:
                out = work(np.frombuffer(b"".join(pdf["words"]), _U))
                if out is not None and len(out):
                    yield out
            if done:
                yield done()

    return run


def sketched(blocks: DataFrame, k: int, frequent, least: int, size: int) -> np.ndarray:
    """Bits of the places to which phrases of k words fall `least` times or more in all."""

    def run(batches):
        tally = Tally(size, least)
        yield from each_batch(lambda w: tally.add(place(places(w, k, frequent.value)[1], size)), tally.rows)(batches)

    return reached(tree_sum(blocks.mapInPandas(run, TALLY)), least, size)


def untold(words: np.ndarray, k: int, frequent: list[np.ndarray], some: np.ndarray, told: PerfectHash | None) -> np.ndarray:
    """The distinct phrases of k words that may be frequent and aren't among those told, a row of words each."""
    at, keys = places(words, k, frequent)
    go = has(some, keys)
    keys, one = np.unique(keys[go], return_index=True)
    rows = spelled(words, at[go][one], k)
    return rows if told is None else rows[told.slots(keys, check(rows)) < 0]


def candidates(blocks: DataFrame, k: int, frequent, some) -> DataFrame:
    """(words, key, check) of the distinct phrases of k words that may be frequent; single words with their lang.

    What is shuffled is the word keys alone, each phrase once from a task. The early part of the blocks goes first;
    its phrases (of more than ROUND_KEYS those that most tasks sent) the rest needn't send again.
    """
    names = [f"w{j}" for j in range(k)]
    cols = [*names, "lang"] if k == 1 else names

    def found(w: np.ndarray, told) -> pd.DataFrame:
        rows = untold(w, k, frequent.value, some.value, told and told.value)
        return pd.DataFrame(rows.view(np.int64), columns=names)

    def sent(part: DataFrame, told=None) -> DataFrame:
        def words(batches):
            with np.errstate(over="ignore"):
                for pdf in batches:
                    for lang, some_ in pdf.groupby("lang", sort=False):
                        yield found(np.frombuffer(b"".join(some_["words"]), _U), told).assign(lang=lang)

        return part.mapInPandas(words if k == 1 else each_batch(lambda w: found(w, told)), ", ".join(f"{n} long" for n in names) + lang)

    def named(batches):
        with np.errstate(over="ignore"):
            for pdf in batches:
                rows = np.ascontiguousarray(pdf[names].to_numpy(np.int64)).view(_U)
                flat, width = rows.tobytes(), 8 * k
                new = {"words": [flat[i : i + width] for i in range(0, len(flat), width)], "key": fold(rows).view(np.int64), "check": check(rows).view(np.int64)}
                yield pd.DataFrame(new | ({"lang": pdf["lang"]} if k == 1 else {}))

    lang = ", lang string" if k == 1 else ""
    schema = f"words binary, key long, check long{lang}"
    with arrow_rows(blocks.sparkSession, BLOCK_ROWS):
        first = materialize(sent(blocks.filter("early")).groupBy(*cols).agg(F.count("*").alias("times")))
    left, least = ROUND_KEYS, None
    for r in first.groupBy("times").count().orderBy(F.desc("times")).toLocalIterator():
        left -= r["count"]
        if left < 0:
            break
        least = r["times"]
    first_keys = first.filter(F.col("times") >= least if least else F.lit(False)).select(*cols).mapInPandas(named, schema)
    told = blocks.sparkSession.sparkContext.broadcast(hash_of(first_keys))
    with arrow_rows(blocks.sparkSession, BLOCK_ROWS):
        distinct = materialize(first.select(*cols).union(sent(blocks.filter("NOT early"), told)).distinct())
    told.destroy()
    return materialize(distinct.mapInPandas(named, schema))


def packed(rows: DataFrame, names: list[str]) -> list[np.ndarray]:
    """Long columns of a table of bounded size, as arrays in the driver."""

    def pack(batches):
        for pdf in batches:
            yield pd.DataFrame({"b": [np.ascontiguousarray(pdf[names].to_numpy(np.int64)).tobytes()]})

    found = b"".join(bytes(r["b"]) for r in rows.select(*names).mapInPandas(pack, "b binary").toLocalIterator())
    return list(np.ascontiguousarray(np.frombuffer(found, np.int64).reshape(-1, len(names)).T))


def hash_of(rows: DataFrame) -> PerfectHash:
    keys, checks = packed(rows, ["key", "check"])
    keys, one = np.unique(keys.view(_U), return_index=True)
    return PerfectHash(keys, checks.view(_U)[one])


def counted(blocks: DataFrame, k: int, frequent, some, found: DataFrame, least: int) -> DataFrame:
    """(key, check, f) of the candidates that occur `least` times or more."""
    out, rounds = None, max(1, -(-found.count() // ROUND_KEYS))
    for r in range(rounds):
        slots = blocks.sparkSession.sparkContext.broadcast(hash_of(found.filter(F.pmod("key", F.lit(rounds)) == r)))

        def run(batches, slots=slots):
            tally = Tally(max(1, len(slots.value)))

            def work(w):
                at, keys = places(w, k, frequent.value)
                go = has(some.value, keys)
                at, keys = at[go], keys[go]
                s = slots.value.slots(keys, check(spelled(w, at, k)))
                tally.add(s[s >= 0])

            yield from each_batch(work, tally.rows)(batches)

        def read(batches, slots=slots):
            for pdf in batches:
                for c, total in zip(pdf["chunk"], pdf["total"]):
                    f = released(total)
                    at = np.flatnonzero(f >= least)
                    if len(at) and len(slots.value):
                        yield pd.DataFrame({"key": slots.value.keys[c * CHUNK + at].view(np.int64), "check": slots.value.checks[c * CHUNK + at].view(np.int64), "f": f[at]})

        sums = tree_sum(blocks.mapInPandas(run, TALLY))
        part = materialize(sums.mapInPandas(read, "key long, check long, f long"))
        out = part if out is None else out.union(part)
    return out


def spellings(texts: DataFrame, some) -> DataFrame:
    """(key, word) of the words whose bit is set."""

    def run(batches):
        with np.errstate(over="ignore"):
            for lang, part in by_lang(batches):
                key, _, first, last, raw = words_of(part, lang)
                key, one = np.unique(key, return_index=True)
                go = has(some.value, key)
                if go.any():
                    spelled_ = [raw[a:b].decode("utf-8", "replace") for a, b in zip(first[one[go]].tolist(), last[one[go]].tolist())]
                    yield pd.DataFrame({"key": key[go].view(np.int64), "word": spelled_})

    return materialize(texts.mapInPandas(run, "key long, word string").distinct())


def word_keys(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """(key, i, word_key) of each word of phrases."""
    for pdf in batches:
        n = pdf["words"].str.len().to_numpy(np.int64) // 8
        words = np.frombuffer(b"".join(pdf["words"]), np.int64)
        yield pd.DataFrame({"key": np.repeat(pdf["key"].to_numpy(np.int64), n), "i": np.arange(len(words)) - np.repeat(np.cumsum(n) - n, n), "word_key": words})


def with_cuts(phrases: DataFrame, frequent: DataFrame, longest: int) -> DataFrame:
    """phrases with the counts of both parts of each cut (arrays l and r, by the first part's words), read by slot, the key of the first word, and the keys of the phrases of two words or more inside."""
    rounds = max(1, -(-frequent.count() // ROUND_KEYS))
    phrases = phrases.withColumns({"_first": F.lit(0).cast("long"), "l": F.array_repeat(F.lit(0).cast("long"), F.col("k") - 1), "r": F.array_repeat(F.lit(0).cast("long"), F.col("k") - 1), "inner": F.array().cast("array<bigint>")})
    schema = phrases.schema
    for r in range(rounds):
        keys, checks, f = packed(frequent.filter(F.pmod("key", F.lit(rounds)) == r), ["key", "check", "f"])
        keys, one = np.unique(keys.view(_U), return_index=True)
        slots = PerfectHash(keys, checks.view(_U)[one])
        counts = np.zeros(len(slots), np.int64)
        counts[slots.slots(slots.keys, slots.checks)] = f[one][np.argsort(slots.slots(keys, checks.view(_U)[one]))]
        sent = phrases.sparkSession.sparkContext.broadcast((slots, counts))

        def count(words: np.ndarray, sent=sent) -> np.ndarray:
            slots, counts = sent.value
            at = slots.slots(fold(words), check(words))
            return np.where(at >= 0, counts[at] if len(counts) else 0, 0)

        def run(batches, count=count):
            with np.errstate(over="ignore"):
                for pdf in batches:
                    pdf = pdf.assign(_first=np.frombuffer(b"".join(x[:8] for x in pdf["words"]), np.int64))
                    lefts, rights, inner = (pdf[c].tolist() for c in ("l", "r", "inner"))
                    for k in range(2, longest + 1):
                        rows = np.flatnonzero(pdf["k"].to_numpy() == k)
                        if not len(rows):
                            continue
                        words = np.frombuffer(b"".join(pdf["words"].iloc[rows]), _U).reshape(-1, k)
                        l, r_ = (np.stack([count(words[:, a:b]) for a, b in cut], 1) for cut in ([(0, c) for c in range(1, k)], [(c, k) for c in range(1, k)]))
                        parts = [fold(words[:, a : a + j]) for j in range(2, k) for a in range(k - j + 1)]
                        parts = np.stack(parts, 1).view(np.int64).tolist() if parts else [[]] * len(rows)
                        for i, row in enumerate(rows):
                            lefts[row], rights[row], inner[row] = (lefts[row] + l[i]).tolist(), (rights[row] + r_[i]).tolist(), parts[i]
                    yield pdf.assign(l=lefts, r=rights, inner=inner)

        phrases = phrases.mapInPandas(run, schema)
    return phrases


def collocations(docs: DataFrame, least: int = 30, longest: int = 4, percent: int = 80, top: int = 2000) -> DataFrame:
    """The first `top` phrases of each language: lang, rank, phrase, a, l, r, n, score.

    A-Z are lower-cased; texts split at . , ; : ! ? and line ends into pieces, pieces at spaces and tabs into words.
    n counts a language's words. Phrases of 2 to `longest` words in one piece that occur a >= least times (overlaps
    count) are cut where floor(2000000 a / (l + r)) is lowest, l and r being the counts of the parts; of ties the
    shortest first part. Phrases inside a longer one of at least `percent` % of their occurrences are dropped. Order: score
    and a descending, phrase ascending. Null texts are empty, null lang is "und"; long texts count whole, repeated
    rows as often as they stand. An empty table gives no rows; other columns are ignored. Counts are exact; phrases are
    told apart by 128 bits, words by 64.
    """
    spark = docs.sparkSession
    send = spark.sparkContext.broadcast
    texts = docs.select("text", F.coalesce("lang", F.lit("und")).alias("lang"))
    with arrow_rows(spark, TEXT_ROWS):
        blocks = materialize(texts.mapInPandas(key_batches, "lang string, n_words long, words binary").withColumn("early", F.spark_partition_id() % EARLY == 0))
    sizes = blocks.groupBy("lang").agg(F.sum("n_words").alias("n"))
    total = blocks.agg(F.sum("n_words")).first()[0] or 0
    size = max(LEAST_PLACES, min(PLACES, total // LOAD // 8 * 8))
    shorter, phrases, frequent, langs = [], None, None, None
    for k in range(1, longest + 1):
        known = send(list(shorter))
        some = send(sketched(blocks, k, known, least, size))
        found = candidates(blocks, k, known, some)
        counts = counted(blocks, k, known, some, found, least)
        these = found.join(counts, ["key", "check"])
        if k == 1:
            langs = these.select(F.col("key").alias("_first"), "lang")
        else:
            these = these.select(F.lit(k).alias("k"), "words", "key", F.col("f").alias("a"))
            phrases = these if phrases is None else phrases.union(these)
        if k < longest:
            shorter.append(bits_of(counts, size))
            frequent = counts if frequent is None else frequent.union(counts)
    phrases = materialize(with_cuts(phrases, frequent, longest))
    longer = phrases.select(F.explode("inner").alias("key"), F.col("a").alias("f")).groupBy("key").agg(F.max("f").alias("f"))
    exact = lambda c: F.col(c).cast("decimal(20,0)")
    phrases = phrases.join(longer, "key", "left").filter(F.col("f").isNull() | (exact("f") * 100 < exact("a") * percent)).drop("f", "inner")
    cut = "array_min(transform(sequence(1, k - 1), c -> struct(cast(cast(a as decimal(20,0)) * 2000000 div (cast(l[c - 1] as decimal(20,0)) + r[c - 1]) as bigint) as score, c as c)))"
    phrases = phrases.withColumn("cut", F.expr(cut)).select("_first", "key", "words", "a", F.expr("l[cut.c - 1]").alias("l"), F.expr("r[cut.c - 1]").alias("r"), "cut.score")
    phrases = phrases.join(langs, "_first")
    # By score and count alone, ties kept: first in parts of a language, then in all of it.
    order = [F.desc("score"), F.desc("a")]
    for part in ([F.pmod("key", F.lit(64))], []):
        phrases = phrases.withColumn("place", F.rank().over(Window.partitionBy("lang", *part).orderBy(*order))).filter(F.col("place") <= top).drop("place")
    phrases = materialize(phrases)
    each = materialize(phrases.mapInPandas(word_keys, "key long, i int, word_key long"))
    with arrow_rows(spark, TEXT_ROWS):
        names = spellings(texts, send(bits_of(each.select(F.col("word_key").alias("key")).distinct(), size)))
    each = each.join(names.select(F.col("key").alias("word_key"), "word"), "word_key")
    text = F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("i", "word"))), lambda x: x["word"]), " ")
    named = phrases.join(each.groupBy("key").agg(text.alias("phrase")), "key").join(F.broadcast(sizes), "lang")
    rank = F.row_number().over(Window.partitionBy("lang").orderBy(F.desc("score"), F.desc("a"), "phrase")).cast("long")
    return named.withColumn("rank", rank).filter(F.col("rank") <= top).select("lang", "rank", "phrase", "a", "l", "r", "n", "score")


def op11_phrase_collocations(spark, sf_dir):
    return collocations(table(spark, sf_dir, "documents"))


OP11_SQL = r"""
WITH t AS (SELECT coalesce(lang, 'und') AS lang, unnest(regexp_split_to_array(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[.,;:!?\x0A-\x0D]')) AS piece FROM documents),
w AS MATERIALIZED (SELECT lang, regexp_extract_all(piece, '[^\x20\x09]+') AS ws FROM t),
g AS MATERIALIZED (SELECT lang, k, array_to_string(ws[i + 1 : i + k], ' ') AS p FROM (SELECT lang, ws, k, unnest(range(len(ws) - k + 1)) AS i FROM w, range(1, 5) q(k) WHERE len(ws) >= k)),
n AS (SELECT lang, count(*) AS n FROM g WHERE k = 1 GROUP BY lang),
f AS MATERIALIZED (SELECT lang, k, p, count(*) AS f, string_split(p, ' ') AS ws FROM g GROUP BY lang, k, p HAVING count(*) >= 30),
u AS MATERIALIZED (SELECT lang, p, k, f AS a, c, array_to_string(ws[1 : c], ' ') AS lp, array_to_string(ws[c + 1 : k], ' ') AS rp FROM f, range(1, 4) q(c) WHERE c < k),
c AS (SELECT u.lang, u.p, u.a, u.c, l.f AS l, r.f AS r, CAST(2000000::HUGEINT * a // (l.f + r.f) AS BIGINT) AS score
  FROM u JOIN f l ON l.lang = u.lang AND l.p = u.lp JOIN f r ON r.lang = u.lang AND r.p = u.rp),
b AS (SELECT * FROM c QUALIFY row_number() OVER (PARTITION BY lang, p ORDER BY score, c) = 1),
i AS (SELECT lang, array_to_string(ws[s + 1 : s + j], ' ') AS p, max(f) AS f FROM (SELECT lang, ws, f, j, unnest(range(k - j + 1)) AS s FROM f, range(2, 4) q(j) WHERE j < k) GROUP BY ALL),
d AS (SELECT b.* FROM b LEFT JOIN i USING (lang, p) WHERE i.f IS NULL OR 100 * i.f < 80 * b.a)
SELECT lang, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, p) AS rank, p AS phrase, a, l, r, n, score FROM d JOIN n USING (lang)
QUALIFY rank <= 2000
"""
