"""Grouping of spelling variants: words that differ by one edit, found in sorted dictionaries.

Of two words that differ by one inserted, deleted or replaced character, one keeps its first half or its last half (cut
by the shorter word's length). So every word stands in a forward dictionary, under its first half, and in a reversed
one, under its last half read backwards. Blocks of equal halves are ranges of the sorted dictionaries.
A block of too many words is subdivided: what lies between the parts known to be intact is halved again, and the
words go on under the longer first part or the longer last part. Blocks are scanned, and close words verified.

An entry stands for pairs whose shorter word has `short` characters, whose first `head` and last `tail` characters are
equal, and that first differ before `before`: so each pair is met in one block.
"""

from __future__ import annotations

import re
import zlib
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import id_or_none, materialize, NO_ID, table

_LOWER = bytes(c + 32 if 65 <= c <= 90 else c for c in range(256))
RUN = re.compile("[A-Za-zÀ-ÿ]+")
#: Words of a block that isn't subdivided; longest words compared as rows of a matrix; most large blocks that are broadcast (8 bytes each).
BLOCK, WIDE, BROADCAST_BLOCKS = 48, 64, 2_000_000
#: Distinct words gathered before they are sent on.
GATHERED = 200_000


def word_counts(batches: Iterator[pd.DataFrame], drop_every: int, min_chars: int) -> Iterator[pd.DataFrame]:
    """(word, n) of batches of texts, one character deleted where drop_every divides the crc32 of doc_id and run."""
    total: Counter[str] = Counter()

    def rows() -> pd.DataFrame:
        return pd.DataFrame({"word": pd.Series(list(total), dtype=object), "n": pd.Series(list(total.values()), dtype="int64")})

    for pdf in batches:
        for doc_id, text in zip(pdf["doc_id"].tolist(), pdf["text"].tolist()):
            if not text:
                continue
            start = zlib.crc32(f"{'' if doc_id == NO_ID else doc_id}:".encode())
            lower = text.encode("utf-8", "surrogatepass").translate(_LOWER).decode("utf-8", "surrogatepass")
            for run, n in Counter(RUN.findall(lower)).items():
                if len(run) < min_chars:
                    continue
                if drop_every and (h := zlib.crc32(run.encode(), start)) % drop_every == 0:
                    i = h % len(run)
                    run = run[:i] + run[i + 1 :]
                    if len(run) < min_chars:
                        continue
                total[run] += n
            if len(total) >= GATHERED:
                yield rows()
                total.clear()
    yield rows()


def entries_of(words: DataFrame) -> DataFrame:
    """The places of every word in both dictionaries: as the shorter word of a pair (or one of two equally long), and as the longer."""
    length = F.length("word")
    short = F.explode(F.array(length, length - 1)).alias("short")
    cut = F.floor(F.col("short") / 2).cast("int")
    forward = F.struct(cut.alias("head"), F.lit(0).alias("tail"), F.lit((1 << 31) - 1).alias("before"))
    reverse = F.struct(F.lit(0).alias("head"), (F.col("short") - cut).alias("tail"), cut.alias("before"))
    return words.select("word", "n", short).select("word", "n", "short", F.explode(F.array(forward, reverse)).alias("e")).select("word", "n", "short", "e.*")


def keyed(entries: DataFrame) -> DataFrame:
    """entries with what they sort by: the intact first part, and the intact last part backwards."""
    return entries.withColumns({"first": F.expr("left(word, head)"), "last": F.expr("reverse(right(word, tail))")})


KEY = ["short", "head", "tail", "first", "last"]


def halved(entries: DataFrame) -> DataFrame:
    """The entries of a block's subdivision: each word under the longer first part, and under the longer last part."""
    middle = F.col("short") - F.col("head") - F.col("tail")
    cut = (F.col("head") + F.floor(middle / 2)).cast("int")
    forward = F.struct(cut.alias("head"), F.col("tail"), F.col("before"))
    reverse = F.struct(F.col("head"), (F.col("short") - cut).alias("tail"), cut.alias("before"))
    return entries.select("word", "n", "short", F.explode(F.array(forward, reverse)).alias("e")).select("word", "n", "short", "e.*")


def blocks_of(words: DataFrame) -> DataFrame:
    """Entries in blocks of at most BLOCK words, or of words that have one character (the longer ones two) between equal parts."""
    entries, out = entries_of(words), None
    while True:
        entries = materialize(keyed(entries).withColumn("block", F.xxhash64(*KEY)))
        large = materialize(entries.filter(F.expr("short - head - tail >= 2")).groupBy("block").agg(F.count("*").alias("size")).filter(F.col("size") > BLOCK).select("block"))
        n = large.count()
        if not n:
            return entries if out is None else out.unionByName(entries)
        large = F.broadcast(large) if n <= BROADCAST_BLOCKS else large
        ready = entries.join(large, "block", "left_anti")
        out = ready if out is None else out.unionByName(ready)
        entries = halved(entries.join(large, "block", "left_semi"))


def near_in_blocks(batches: Iterator[pd.DataFrame], widest: int) -> Iterator[pd.DataFrame]:
    """(word, other, other_n), both ways, of the pairs one edit apart in sorted entries."""
    rest = None

    def matrix(words: list[bytes], width: int) -> np.ndarray:
        return np.frombuffer(b"".join(w.ljust(width, b"\0") for w in words), np.uint8).reshape(-1, width)

    def agree(a: np.ndarray, b: np.ndarray, width: int) -> np.ndarray:
        """How many first columns are equal."""
        differ = a[:, :width] != b[:, :width]
        return np.where(differ.any(axis=1), differ.argmax(axis=1), width)

    def same_start(u: bytes, v: bytes) -> int:
        n = min(len(u), len(v))
        if u[:n] == v[:n]:
            return n
        a, b = np.frombuffer(u, np.uint8, n), np.frombuffer(v, np.uint8, n)
        return int((a != b).argmax())

    def pairs(pdf: pd.DataFrame) -> pd.DataFrame:
        word, n = pdf["word"].to_numpy(), pdf["n"].to_numpy()
        raw = [w.encode("latin-1") for w in word]
        size, short, head, before = (np.array(x) for x in ([len(w) for w in raw], pdf["short"], pdf["head"], pdf["before"]))
        new = np.ones(len(pdf), bool)
        for c in KEY:
            v = pdf[c].to_numpy()
            new[1:] &= v[1:] == v[:-1]
        new[1:] = ~new[1:]
        block = np.cumsum(new)
        longest = int(np.bincount(block).max())
        wide = short > widest
        rows = np.flatnonzero(~wide)
        width = int(short[rows].max(initial=0)) + 1
        place = np.zeros(len(pdf), np.int64)
        place[rows] = np.arange(len(rows))
        ahead, back = matrix([raw[i] for i in rows], width), matrix([raw[i][::-1] for i in rows], width)
        left, right = [], []
        for step in range(1, longest):
            i = np.flatnonzero(block[step:] == block[:-step])
            if not len(i):
                break
            j = i + step
            go = np.minimum(size[i], size[j]) == short[i]
            i, j = i[go], j[go]
            for at in range(0, len(i), 50_000):
                x, y = i[at : at + 50_000], j[at : at + 50_000]
                slow = wide[x]
                begin, end = np.zeros(len(x), np.int64), np.zeros(len(x), np.int64)
                fast = np.flatnonzero(~slow)
                p, q = place[x[fast]], place[y[fast]]
                # Beyond the shorter word's end only the longer one has bytes other than zero.
                begin[fast], end[fast] = (np.minimum(agree(m[p], m[q], width), short[x[fast]]) for m in (ahead, back))
                for k in np.flatnonzero(slow):
                    u, v = raw[x[k]], raw[y[k]]
                    begin[k], end[k] = same_start(u, v), same_start(u[::-1], v[::-1])
                longer = np.maximum(size[x], size[y])
                ok = (begin + end >= longer - 1) & (begin >= head[x]) & (begin < before[x]) & ((size[x] != size[y]) | (begin < short[x]))
                left.append(x[ok])
                right.append(y[ok])
        a, b = (np.concatenate(c) if c else np.empty(0, int) for c in (left, right))
        return pd.DataFrame({"word": np.concatenate([word[a], word[b]]), "other": np.concatenate([word[b], word[a]]), "other_n": np.concatenate([n[b], n[a]])})

    for pdf in batches:
        pdf = pdf if rest is None else pd.concat([rest, pdf], ignore_index=True)
        last = pdf.iloc[-1]
        done = np.ones(len(pdf), bool)
        for c in KEY:
            done &= pdf[c].to_numpy() == last[c]
        cut = int(np.flatnonzero(done)[0]) if len(pdf) else 0
        rest = pdf.iloc[cut:]
        if cut:
            yield pairs(pdf.iloc[:cut])
    if rest is not None and len(rest):
        yield pairs(rest)


def near_words(words: DataFrame) -> DataFrame:
    """(word, other, other_n) of all pairs of words (word, n) that are one edit apart, both ways. Characters up to U+00FF."""
    blocks = blocks_of(words).drop("tail", "block").withColumn("tail", F.length("last"))
    sorted_ = blocks.repartitionByRange(*KEY).sortWithinPartitions(*KEY).select("word", "n", "before", *KEY)
    widest = WIDE
    return sorted_.mapInPandas(lambda it: near_in_blocks(it, widest), "word string, other string, other_n long")


def roots(forms: DataFrame) -> DataFrame:
    """(word, root) of words with a form: forms followed to the last, twice as far in each round. A form has twice its word's count at least, so there are no rings."""
    at = materialize(forms.select("word", F.col("form").alias("root")))
    while True:
        on = at.select(F.col("word").alias("_word"), F.col("root").alias("_next"))
        far = materialize(at.join(on, F.col("root") == F.col("_word"), "left").select("word", F.coalesce("_next", "root").alias("root"), F.col("_next").isNotNull().alias("moved")))
        moved = not far.filter("moved").isEmpty()
        at = far.select("word", "root")
        if not moved:
            return at


def variants(docs: DataFrame, min_chars: int = 5, min_count: int = 3, drop_every: int = 97) -> DataFrame:
    """One row per word: word, n, n_near, form, form_n, root.

    Words are the runs of A-Z, a-z and U+00C0 to U+00FF in all texts, A-Z in lower case, of min_chars characters or more
    that occur min_count times or more. Where drop_every (0: nowhere) divides the crc32 h of `<doc_id>:<run>`, the run's
    character h % length is left out. Near words differ by exactly one inserted, deleted or replaced character; a word's form
    is its near word of largest n (ties: the smallest word) if that has twice the word's n; its root the last of its forms.
    Null and empty texts have no words; a null doc_id counts as empty in h; long texts count whole, repeated rows as often
    as they stand. An empty table gives no rows; other columns are ignored.
    """
    rows = docs.select(id_or_none(F.col("doc_id")), "text")
    counts = rows.mapInPandas(lambda it: word_counts(it, drop_every, min_chars), "word string, n long")
    words = materialize(counts.groupBy("word").agg(F.sum("n").alias("n")).filter(F.col("n") >= min_count))
    best = near_words(words).groupBy("word").agg(F.count("*").alias("n_near"), F.min(F.struct((-F.col("other_n")).alias("least"), "other")).alias("best"))
    found = words.join(best, "word", "left").select("word", "n", F.coalesce("n_near", F.lit(0).cast("long")).alias("n_near"), F.when(-F.col("best.least") >= 2 * F.col("n"), F.col("best")).alias("best"))
    found = materialize(found.select("word", "n", "n_near", F.col("best.other").alias("form"), (-F.col("best.least")).alias("form_n")))
    last = roots(found.filter("form IS NOT NULL"))
    return found.join(last, "word", "left").withColumn("root", F.coalesce("root", "word"))


def op13_spelling_variants(spark, sf_dir):
    return variants(table(spark, sf_dir, "documents")).select("word", "n", "n_near", "form", "form_n", "root")


OP13_SQL = r"""
WITH RECURSIVE tab AS (
  SELECT list_transform(range(256), lambda i: list_reduce(list_prepend(i, range(8)), lambda c, k: CASE WHEN c % 2 = 1 THEN xor(3988292384, c // 2) ELSE c // 2 END)) AS t
), run AS (
  SELECT doc_id, run, count(*) AS n FROM (SELECT doc_id, unnest(regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[A-Za-z\x{00C0}-\x{00FF}]+')) AS run FROM documents)
  WHERE length(run) >= 5 GROUP BY ALL
), h AS (
  SELECT run, n, xor(4294967295, list_reduce(list_prepend(4294967295, list_transform(regexp_extract_all(hex(encode(doc_id || ':' || run)), '..'), lambda x: ('0x' || x)::BIGINT)),
    lambda c, b: xor(c // 256, t[CAST(xor(c % 256, b) AS INT) + 1]))) AS h FROM run, tab
), w AS MATERIALIZED (
  SELECT word, CAST(sum(n) AS BIGINT) AS n FROM (SELECT n, CASE WHEN h % 97 = 0 THEN left(run, CAST(h % length(run) AS INT)) || substr(run, CAST(h % length(run) AS INT) + 2) ELSE run END AS word FROM h)
  WHERE length(word) >= 5 GROUP BY word HAVING sum(n) >= 3
), d AS MATERIALIZED (SELECT word, i, left(word, i) || substr(word, i + 2) AS s FROM (SELECT word, unnest(range(CAST(length(word) AS INT)))::INT AS i FROM w)),
one AS (SELECT DISTINCT d.word, w.word AS other FROM d JOIN w ON w.word = d.s),
near AS (
  SELECT a.word, b.word AS other FROM d a JOIN d b ON a.i = b.i AND a.s = b.s AND a.word <> b.word
  UNION SELECT word, other FROM one UNION SELECT other, word FROM one
), best AS (
  SELECT near.word, count(*) AS n_near, min({'a': -w.n, 'b': near.other}) AS b FROM near JOIN w ON w.word = near.other GROUP BY near.word
), f AS MATERIALIZED (
  SELECT w.word, w.n, coalesce(n_near, 0) AS n_near, CASE WHEN -b.a >= 2 * w.n THEN b.b END AS form, CASE WHEN -b.a >= 2 * w.n THEN -b.a END AS form_n FROM w LEFT JOIN best USING (word)
), r AS (SELECT word, word AS at, form FROM f UNION ALL SELECT r.word, f.word, f.form FROM r JOIN f ON f.word = r.form)
SELECT f.word, n, n_near, f.form, form_n, r.at AS root FROM f JOIN r ON r.word = f.word AND r.form IS NULL
"""
