"""Removal of repeated byte strings by sparse prefix doubling.

Names (64-bit ranks) of the strings of 1, 2, 4, ... bytes at every position are doubled: the name of
2n bytes at p is made from the names of n bytes at p and p + n. Suffix ranks are needed up to the
threshold only, and only where a string occurs again. So of all positions Spark sorts a sample that
no string of `threshold` bytes can escape: in every such string, the position whose GRAM-byte name is
least (its anchor). Rounds:

1. Positions are sorted by the name of GRAM bytes. Anchors that are alone are unique: dropped, with
   all strings they stand for.
2. The rest are ranked by the name of everything that the strings they stand for cover. Where
   that occurs in a smaller document, all those strings do.
3. What is left (neighbourhoods that differ somewhere) is ranked by the full names of `threshold`
   bytes, doubled again from the bytes.

A gram that stands in very many documents with differing surroundings would fill one bucket. A sample of
the documents finds such grams beforehand; it only decides where anchors go, not what is removed. Anchors of
hot grams are dealt by their neighbourhood, and in round 3 string by string, in Spark's own aggregates.
"""

from __future__ import annotations

import hashlib
import zlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import materialize, table

GRAM = 16
#: Bytes of text named at once; anchors sent on at once; anchors, and neighbourhoods, of one bucket.
TEXT_STEP, SEND, PER_BUCKET, PER_BUCKET_3 = 2_000_000, 1_000_000, 400_000, 40_000

#: Bytes of the sample that finds hot grams, anchors from which on one is hot (it would fill a bucket by itself), most hot
#: grams (8 MB of names; beyond some 7 TB the limit of anchors rises with the input, to 14 buckets at 100 TB), and how many
#: anchors of a hot gram the sample holds at least, on average.
SAMPLE_BYTES, HOT_ANCHORS, MOST_HOT, SAMPLED = 32_000_000, PER_BUCKET, 1_000_000, 20
#: Most repeated strings of hot grams that are broadcast.
BROADCAST_STRINGS = 1_000_000

_U = np.uint64
_MUL = _U(0x9E3779B97F4A7C15)
_BACK = _U(pow(int(_MUL), -1, 1 << 64))
_BYTE = np.random.Generator(np.random.PCG64(50)).integers(0, 1 << 64, 256, dtype=_U)
_MASK40 = _U((1 << 40) - 1)


def mix(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> _U(32))) * _U(0xD6E8FEB86659FD93)
    return (x ^ (x >> _U(32))) * _U(0xD6E8FEB86659FD93)


def double_names(codes: np.ndarray, length: int) -> np.ndarray:
    """Names of the `length`-byte strings along the last axis, from pairs of names at growing offsets."""
    name, n = _BYTE[codes], 1
    while n < length:
        step = min(n, length - n)  # the last round overlaps if length is no power of two
        name = mix(name[..., : name.shape[-1] - step] * _MUL + name[..., step:])
        n += step
    return name


def anchors(codes: np.ndarray, ends: np.ndarray, threshold: int):
    """Anchor of every string of `threshold` bytes inside texts that end at `ends`: (first, last start, anchor, name, neighbourhood name)."""
    n = len(codes) - threshold + 1
    if n <= 0:
        return tuple(np.empty(0, t) for t in (np.int64, np.int64, np.int64, _U, _U))
    name = double_names(codes, GRAM)
    low, at, width = name, np.arange(len(name), dtype=np.int32), threshold - GRAM + 1
    done = 1
    while done < width:  # least name in windows, by doubling; the leftmost on ties
        step = min(done, width - done)
        right = low[step:] < low[:-step]
        low, at = np.where(right, low[step:], low[:-step]), np.where(right, at[step:], at[:-step])
        done += step
    del low, right
    inside = np.ones(n, bool)
    for e in ends[:-1]:
        inside[max(0, e - threshold + 1) : e] = False
    new = np.ones(n, bool)
    new[1:] = (at[1:] != at[:-1]) | (inside[1:] != inside[:-1])
    first = np.flatnonzero(new)
    last = np.append(first[1:], n) - 1
    ok = inside[first]
    first, last = first[ok], last[ok]
    p = at[first].astype(np.int64)
    name = name[p]
    del at, new, inside
    powers = np.full(len(codes) + 1, _MUL, _U)
    powers[0] = 1
    np.multiply.accumulate(powers, out=powers)
    sums = np.concatenate([[_U(0)], np.cumsum(_BYTE[codes] * powers[:-1], dtype=_U)])
    del powers
    back = np.full(len(codes) + 1, _BACK, _U)
    back[0] = 1
    np.multiply.accumulate(back, out=back)
    around = mix((sums[last + threshold] - sums[first]) * back[first] + (p - first).astype(_U) * _MUL + (last - first).astype(_U))
    return first, last, p, name, around


def _pack(cols: list[np.ndarray]) -> bytes:
    return zlib.compress(b"".join(c.tobytes() for c in cols), 1)


def _low5(x: np.ndarray) -> np.ndarray:
    return np.ascontiguousarray(x.astype("<u8").view(np.uint8).reshape(-1, 8)[:, :5])


def _wide(x: np.ndarray) -> np.ndarray:
    out = np.zeros((len(x), 8), np.uint8)
    out[:, :5] = x
    return out.view("<u8").ravel()


class Outbox:
    """Anchors of many texts, sent as compressed blocks per bucket; those of hot grams to as many further buckets, by their neighbourhood."""

    def __init__(self, buckets: int, hot: np.ndarray = np.empty(0, _U)):
        self.buckets, self.hot, self.parts, self.docs, self.n = buckets, hot, [], [], 0

    def add(self, docs: list[tuple[int, int]], which, first, last, p, name, around) -> None:
        self.parts.append((which + len(self.docs), first, last, p, name, around))
        self.docs += docs
        self.n += len(first)

    def blocks(self) -> Iterator[pd.DataFrame]:
        if not self.parts:
            return
        which, first, last, p, name, around = (np.concatenate(c) for c in zip(*self.parts))
        ids, texts = (np.array(c, np.int64) for c in zip(*self.docs))
        self.parts, self.docs, self.n = [], [], 0
        # Of equal neighbourhoods in this task only the least document's go on; the others are settled.
        order = np.lexsort((ids[which], around, name))
        n, a, d = name[order], around[order], ids[which][order]
        head = np.ones(len(order), bool)
        head[1:] = (n[1:] != n[:-1]) | (a[1:] != a[:-1])
        settled = np.zeros(len(order), bool)
        settled[order] = d > d[np.flatnonzero(head)][np.cumsum(head) - 1]
        del order, n, a, d, head
        rows = []
        s = np.flatnonzero(settled)
        if s.size:
            w, f, l = which[s], first[s], last[s]
            cut = np.ones(len(s), bool)
            cut[1:] = (w[1:] != w[:-1]) | (f[1:] != l[:-1] + 1)
            at = np.flatnonzero(cut)
            w, f, l = w[at], f[at], l[np.append(at[1:], len(s)) - 1]
            # Settled runs only pass through the exchange, spread by block.
            spread = zlib.crc32(ids.tobytes()) % self.buckets
            rows.append((-1 - spread, _pack([ids[w], texts[w], f.astype("<u4"), l.astype("<u4")]), len(w)))
        g = np.flatnonzero(~settled)
        bucket = (name[g] % _U(self.buckets)).astype(np.int64)
        if len(self.hot):
            at = np.minimum(np.searchsorted(self.hot, name[g]), len(self.hot) - 1)
            h = np.flatnonzero(self.hot[at] == name[g])
            bucket[h] = self.buckets + (mix(name[g][h] ^ (around[g][h] * _MUL)) % _U(self.buckets)).astype(np.int64)
            name[g[h]] = at[h].astype(_U) * _U(self.buckets)  # its number among the hot ones
        for b in np.unique(bucket).tolist():
            k = g[bucket == b]
            used, w = np.unique(which[k], return_inverse=True)
            # The gram's name only forms groups and may be cut; the neighbourhood's decides what is removed and goes whole.
            name5, lo = _low5(name[k] // _U(self.buckets)), first[k]
            cols = [ids[used], texts[used], np.diff(w, prepend=0).astype("<u4"), np.diff(lo, prepend=0).astype("<i4"), (last[k] - lo).astype("u1"), (p[k] - lo).astype("u1"), name5, around[k].astype("<u8")]
            rows.append((b, len(used).to_bytes(4, "little") + _pack(cols), len(k)))
        yield pd.DataFrame(rows, columns=["bucket", "block", "n"])


def sampled_grams(batches: Iterator[pd.DataFrame], threshold: int) -> Iterator[pd.DataFrame]:
    """(name, n) of the anchors' grams that occur twice or more in a batch."""
    with np.errstate(over="ignore"):
        for pdf in batches:
            raw = [t.encode() for t in pdf["text"]]
            for at in range(0, len(raw), 256):
                part = [r for r in raw[at : at + 256] if len(r) >= threshold]
                if part:
                    names = anchors(np.frombuffer(b"".join(part), np.uint8), np.cumsum([len(r) for r in part]), threshold)[3]
                    name, n = np.unique(names, return_counts=True)
                    yield pd.DataFrame({"name": name[n > 1].view(np.int64), "n": n[n > 1]})


def hot_grams(rows: DataFrame, threshold: int, total: int, expected: float) -> np.ndarray:
    """Names of grams that a sample of whole documents expects at HOT_ANCHORS anchors or more; at most MOST_HOT."""
    most = max(HOT_ANCHORS, expected / MOST_HOT)
    share = min(1.0, max(SAMPLE_BYTES / max(1, total), SAMPLED / most))
    some = rows if share == 1 else rows.filter(F.xxhash64("doc") < -(1 << 63) + int(share * (1 << 64)))
    seen = some.mapInPandas(lambda it: sampled_grams(it, threshold), "name long, n long").groupBy("name").agg(F.sum("n").alias("n"))
    found = seen.filter(F.col("n") >= most * share).orderBy(F.desc("n"), "name").limit(MOST_HOT).collect()
    return np.sort(np.array([r["name"] for r in found], np.int64).view(_U))


def anchor_batches(batches: Iterator[pd.DataFrame], threshold: int, buckets: int, hot: np.ndarray) -> Iterator[pd.DataFrame]:
    box = Outbox(buckets, hot)

    def name(docs: list, raw: list[bytes]) -> None:
        codes = np.frombuffer(b"".join(raw), np.uint8)
        ends = np.cumsum([len(r) for r in raw])
        first, last, p, gram, around = anchors(codes, ends, threshold)
        which = np.searchsorted(ends, first, side="right")
        start = (ends - [len(r) for r in raw])[which]
        box.add(docs, which, first - start, last - start, p - start, gram, around)

    with np.errstate(over="ignore"):
        for pdf in batches:
            docs, raw, size = [], [], 0
            for d, h, t in zip(pdf["doc"].tolist(), pdf["text_id"].tolist(), pdf["text"].tolist()):
                if len(t) * 4 < threshold:
                    continue
                b = t.encode()
                if len(b) >= threshold:
                    docs.append((d, h))
                    raw.append(b)
                    size += len(b)
                if size >= TEXT_STEP:
                    name(docs, raw)
                    docs, raw, size = [], [], 0
            if raw:
                name(docs, raw)
            if box.n >= SEND:
                yield from box.blocks()
        yield from box.blocks()


FOUND = "doc long, text_id long, open boolean, a int, b int, p int, name long, hot boolean"


def rank_bucket(pdf: pd.DataFrame, buckets: int = 1 << 62) -> pd.DataFrame:
    """Rounds 1 and 2 in one bucket: settled runs of starts, and open neighbourhoods. Buckets from `buckets` on hold hot grams."""
    out = _rank_bucket(pdf, hot := bool(pdf["bucket"].iloc[0] >= buckets))
    return out.assign(hot=hot)


def _rank_bucket(pdf: pd.DataFrame, hot: bool) -> pd.DataFrame:
    if pdf["bucket"].iloc[0] < 0:
        out = []
        for block, n in zip(pdf["block"], pdf["n"]):
            raw = zlib.decompress(block)
            i, t = np.frombuffer(raw, "<i8", 2 * n).reshape(2, n)
            a, b = np.frombuffer(raw, "<u4", 2 * n, 16 * n).reshape(2, n)
            out.append(pd.DataFrame({"doc": i, "text_id": t, "open": False, "a": a.astype(np.int32), "b": b.astype(np.int32), "p": np.int32(0), "name": np.int64(0)}))
        return pd.concat(out)
    parts = []
    for block, n in zip(pdf["block"], pdf["n"]):
        u, raw = int.from_bytes(block[:4], "little"), zlib.decompress(block[4:])
        i, t = np.frombuffer(raw, "<i8", 2 * u).reshape(2, u)
        at = 16 * u
        w = np.cumsum(np.frombuffer(raw, "<u4", n, at).astype(np.int64))
        lo = np.cumsum(np.frombuffer(raw, "<i4", n, at + 4 * n).astype(np.int64))
        span, off = np.frombuffer(raw, "u1", 2 * n, at + 8 * n).reshape(2, n)
        five = np.frombuffer(raw, "u1", 5 * n, at + 10 * n).reshape(n, 5)
        parts.append((i[w], t[w], lo, lo + span, lo + off, _wide(five), np.frombuffer(raw, "<u8", n, at + 15 * n)))
    doc, text_id, a, b, p, name, around = (np.concatenate(c) for c in zip(*parts))
    del parts
    order = np.lexsort((doc, around, name))
    doc, text_id, a, b, p, name, around = (c[order] for c in (doc, text_id, a, b, p, name, around))
    head = np.ones(len(doc), bool)
    head[1:] = name[1:] != name[:-1]
    sub = head.copy()
    sub[1:] |= around[1:] != around[:-1]
    group, klass = np.cumsum(head) - 1, np.cumsum(sub) - 1
    lead = np.flatnonzero(sub)
    full = doc > doc[lead][klass]
    # A group of several neighbourhoods and several documents stays open.
    kinds = np.bincount(group[lead])
    low, high = np.minimum.reduceat(doc, np.flatnonzero(head)), np.maximum.reduceat(doc, np.flatnonzero(head))
    # A hot gram's other neighbourhoods are in other buckets: it has several.
    open_ = ~full if hot else ~full & ((kinds > 1) & (low < high))[group]
    keep = np.flatnonzero(full | open_)
    return pd.DataFrame({"doc": doc[keep], "text_id": text_id[keep], "open": open_[keep], "a": a[keep].astype(np.int32), "b": b[keep].astype(np.int32), "p": p[keep].astype(np.int32), "name": name[keep].view(np.int64)})


def context_batches(batches: Iterator[pd.DataFrame], threshold: int) -> Iterator[pd.DataFrame]:
    """The bytes of every open neighbourhood."""
    for pdf in batches:
        rows = []
        for d, t, text, places in zip(pdf["doc"].tolist(), pdf["text_id"].tolist(), pdf["text"].tolist(), pdf["places"].tolist()):
            raw = text.encode()
            rows += [(x["bucket"], d, t, x["a"], raw[x["a"] : x["b"] + threshold]) for x in places]
        yield pd.DataFrame(rows, columns=["bucket", "doc", "text_id", "a", "raw"])


STRINGS = "name long, doc long, text_id long, a int"


def string_batches(batches: Iterator[pd.DataFrame], threshold: int) -> Iterator[pd.DataFrame]:
    """Names of all strings of `threshold` bytes in contexts."""
    with np.errstate(over="ignore"):
        for pdf in batches:
            sizes = pdf["raw"].str.len().to_numpy()
            for size in np.unique(sizes):
                rows = pdf[sizes == size]
                names = double_names(np.frombuffer(b"".join(rows["raw"]), np.uint8).reshape(len(rows), size), threshold)
                each = names.shape[1]
                at = (rows["a"].to_numpy()[:, None] + np.arange(each)).ravel().astype(np.int32)
                yield pd.DataFrame({"name": names.ravel().view(np.int64), "doc": np.repeat(rows["doc"].to_numpy(), each), "text_id": np.repeat(rows["text_id"].to_numpy(), each), "a": at})


def repeated_strings(contexts: DataFrame, threshold: int) -> DataFrame:
    """Starts (as runs) of strings in contexts that also start in a smaller document.

    Only the least document of each repeated string is needed: one partial aggregate, whatever the string's
    number of rows. It is broadcast behind a check of its size; else strings of very many rows are, which are few.
    """
    contexts = materialize(contexts)
    strings = contexts.mapInPandas(lambda it: string_batches(it, threshold), STRINGS)
    low = materialize(strings.groupBy("name").agg(F.min("doc").alias("low"), F.max("doc").alias("high"), F.count("*").alias("n")).filter("low < high"))
    total, repeated = low.agg(F.sum("n"), F.count("*")).first()
    most = 0 if repeated <= BROADCAST_STRINGS else max(1000, total // 2000)
    common, rest = (low.filter(c).select("name", "low") for c in (F.col("n") > most, F.col("n") <= most))
    marked = strings.join(F.broadcast(common), "name", "left")
    if most == 0:
        found = marked.filter(F.col("doc") > F.col("low"))
    else:
        found = marked.filter(F.col("doc") > F.col("low")).unionByName(marked.filter("low IS NULL").drop("low").join(rest, "name").filter(F.col("doc") > F.col("low")))
    return found.select("doc", "text_id", "a", F.col("a").alias("b"))


RUNS = "doc long, text_id long, a int, b int"


def compare_contexts(pdf: pd.DataFrame, threshold: int) -> pd.DataFrame:
    """Round 3 in one bucket: starts of full strings that also start in a smaller document."""
    docs, texts, a = pdf["doc"].to_numpy(), pdf["text_id"].to_numpy(), pdf["a"].to_numpy()
    sizes = pdf["raw"].str.len().to_numpy()
    with np.errstate(over="ignore"):
        names, owner, start = [], [], []
        for size in np.unique(sizes):
            rows = np.flatnonzero(sizes == size)
            m = double_names(np.frombuffer(b"".join(pdf["raw"].iloc[rows]), np.uint8).reshape(len(rows), size), threshold)
            names.append(m.ravel())
            owner.append(np.repeat(rows, m.shape[1]))
            start.append(np.tile(np.arange(m.shape[1]), len(rows)))
    name, owner, start = np.concatenate(names), np.concatenate(owner), np.concatenate(start)
    order = np.lexsort((docs[owner], name))
    n, d = name[order], docs[owner][order]
    head = np.ones(len(n), bool)
    head[1:] = n[1:] != n[:-1]
    hit = np.sort(order[d > d[np.flatnonzero(head)][np.cumsum(head) - 1]])
    o, s = owner[hit], start[hit]
    order = np.lexsort((s, o))
    o, s = o[order], s[order]
    cut = np.ones(len(o), bool)
    cut[1:] = (o[1:] != o[:-1]) | (s[1:] != s[:-1] + 1)
    at = np.flatnonzero(cut)
    end = np.append(at[1:], len(o))[: len(at)] - 1
    return pd.DataFrame({"doc": docs[o[at]], "text_id": texts[o[at]], "a": (a[o[at]] + s[at]).astype(np.int32), "b": (a[o[at]] + s[end]).astype(np.int32)})


RESULT = "doc long, text_id long, n_bytes long, n_removed long, n_spans long, kept_sha256 string, kept binary"


def removed_spans(runs: list[tuple[int, int]], threshold: int) -> list[tuple[int, int]]:
    """Maximal byte spans covered by the strings that start in the runs."""
    spans: list[list[int]] = []
    for a, b in sorted(runs):
        if spans and a <= spans[-1][1]:
            spans[-1][1] = max(spans[-1][1], b + threshold)
        else:
            spans.append([a, b + threshold])
    return [(a, b) for a, b in spans]


def cut_batches(batches: Iterator[pd.DataFrame], threshold: int) -> Iterator[pd.DataFrame]:
    for pdf in batches:
        rows = []
        for d, t, text, runs in zip(pdf["doc"].tolist(), pdf["text_id"].tolist(), pdf["text"].tolist(), pdf["runs"].tolist()):
            raw = text.encode()
            spans = removed_spans([(r["a"], r["b"]) for r in runs], threshold) if runs is not None else []
            kept, at = [], 0
            for a, b in spans:
                kept.append(raw[at:a])
                at = b
            kept = b"".join([*kept, raw[at:]])
            rows.append((d, t, len(raw), len(raw) - len(kept), len(spans), hashlib.sha256(kept).hexdigest(), kept))
        yield pd.DataFrame(rows, columns=["doc", "text_id", "n_bytes", "n_removed", "n_spans", "kept_sha256", "kept"])


def remove_repeats(docs: DataFrame, threshold: int = 50, with_bytes: bool = True) -> DataFrame:
    """One row per document: doc_id, n_bytes, n_removed, n_spans, kept_sha256 and, if asked for, the kept bytes.

    Every byte covered by a string of `threshold` (at least 2 * GRAM, at most 255) bytes that also
    starts in a document with a smaller doc_id is removed; null doc_id counts as the largest. Null text
    counts as empty; long texts are searched whole. Repeated rows have one doc_id and don't remove from
    each other: equal rows are searched once, and each gets the result. An empty table gives no rows; other
    columns are ignored.
    """
    if not 2 * GRAM <= threshold <= 255:
        raise ValueError("threshold out of range")
    text = F.coalesce("text", F.lit(""))
    rows = docs.select(F.coalesce(F.col("doc_id").cast("long"), F.lit((1 << 63) - 1)).alias("doc"), F.xxhash64(text).alias("text_id"), text.alias("text"))
    every = rows
    repeated = not rows.groupBy("doc", "text_id").agg(F.count("*").alias("n")).filter("n > 1").isEmpty()
    if repeated:
        rows = materialize(rows.groupBy("doc", "text_id").agg(F.min("text").alias("text")))
    total = rows.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    expected = 2 * total / (threshold - GRAM + 2)
    buckets = max(1, round(expected / PER_BUCKET))
    hot = hot_grams(rows, threshold, total, expected)
    blocks = rows.mapInPandas(lambda it: anchor_batches(it, threshold, buckets, hot), "bucket long, block binary, n long")
    found = materialize(blocks.groupBy("bucket").applyInPandas(lambda pdf: rank_bucket(pdf, buckets), FOUND))
    open_ = found.filter("open AND NOT hot")
    n3 = max(1, round(open_.count() / PER_BUCKET_3))
    place = F.struct(F.pmod(F.col("name"), F.lit(n3)).alias("bucket"), "a", "b")
    places = open_.groupBy("doc", "text_id").agg(F.collect_list(place).alias("places"))
    contexts = rows.join(places, ["doc", "text_id"]).mapInPandas(lambda it: context_batches(it, threshold), "bucket long, doc long, text_id long, a int, raw binary")
    late = contexts.groupBy("bucket").applyInPandas(lambda pdf: compare_contexts(pdf, threshold), RUNS)
    runs = found.filter("NOT open").select("doc", "text_id", "a", "b").union(late)
    if len(hot):
        few = found.filter("open AND hot").groupBy("doc", "text_id").agg(F.collect_list(F.struct(F.lit(0).cast("long").alias("bucket"), "a", "b")).alias("places"))
        hot_contexts = rows.join(few, ["doc", "text_id"]).mapInPandas(lambda it: context_batches(it, threshold), "bucket long, doc long, text_id long, a int, raw binary")
        runs = runs.union(repeated_strings(hot_contexts, threshold))
    runs = runs.groupBy("doc", "text_id").agg(F.collect_list(F.struct("a", "b")).alias("runs"))
    result = RESULT if with_bytes else RESULT.removesuffix(", kept binary")
    out = rows.join(runs, ["doc", "text_id"], "left").mapInPandas(lambda it: (p if with_bytes else p.drop(columns="kept") for p in cut_batches(it, threshold)), result)
    if repeated:
        out = every.select("doc", "text_id").join(materialize(out), ["doc", "text_id"])
    return out.drop("text_id").withColumn("doc", F.nullif("doc", F.lit((1 << 63) - 1))).withColumnRenamed("doc", "doc_id")


def op3_prefix_doubling(spark, sf_dir):
    return remove_repeats(table(spark, sf_dir, "documents"), with_bytes=False)


OP3_SQL = """
WITH h AS (SELECT doc_id, hex(encode(coalesce(text, ''))) AS h, strlen(coalesce(text, '')) AS n FROM documents),
p AS (SELECT doc_id, i, substr(h, 2 * i + 1, 100) AS g FROM (SELECT doc_id, h, unnest(range(n - 49)) AS i FROM h WHERE n >= 50)),
d AS (SELECT doc_id, i FROM (SELECT doc_id, i, min(doc_id) OVER (PARTITION BY g) AS first FROM p) WHERE first < doc_id),
s AS (SELECT *, CASE WHEN i <= lag(i) OVER (PARTITION BY doc_id ORDER BY i) + 50 THEN 0 ELSE 1 END AS new FROM d),
k AS (SELECT *, sum(new) OVER (PARTITION BY doc_id ORDER BY i) AS isle FROM s),
r AS (SELECT doc_id, isle, min(i) AS a, max(i) + 50 AS b FROM k GROUP BY ALL),
g AS (SELECT doc_id, count(*) AS n_spans, sum(b - a) AS n_removed, list(a ORDER BY a) AS aa, list(b ORDER BY a) AS bb FROM r GROUP BY doc_id)
SELECT h.doc_id, CAST(n AS BIGINT) AS n_bytes, CAST(coalesce(n_removed, 0) AS BIGINT) AS n_removed, CAST(coalesce(n_spans, 0) AS BIGINT) AS n_spans,
  sha256(unhex(CASE WHEN aa IS NULL THEN h ELSE array_to_string(list_transform(range(len(aa) + 1), lambda j:
    substr(h, 2 * (CASE WHEN j = 0 THEN 0 ELSE bb[j] END) + 1, 2 * ((CASE WHEN j = len(aa) THEN n ELSE aa[j + 1] END) - (CASE WHEN j = 0 THEN 0 ELSE bb[j] END)))), '') END)) AS kept_sha256
FROM h LEFT JOIN g USING (doc_id)
"""
