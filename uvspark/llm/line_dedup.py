"""Removal of lines that stand in many documents.

Lines are normalised, exploded as 128-bit hashes (one row per document and distinct key), and the documents of
each hash are counted. Hashes over the threshold drop their lines in all documents but the last; a document's
lines are put together again by position from what is left.
"""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import id_or_none, materialize, table, with_null_ids

_LOWER = bytes(c + 32 if 65 <= c <= 90 else c for c in range(256))
BLANK = b" \t\n\x0b\x0c\r"
#: Largest tables that are broadcast, in bytes: common lines, and drops of all documents.
BROADCAST_BYTES = 32_000_000
#: Common lines that stand in more than a HOT-th of all (document, line) rows are at most HOT: they are broadcast.
HOT = 2000


def line_keys(text: str | None, min_chars: int) -> list[bytes | None]:
    """Hash of the key of every line; None for keys of fewer than min_chars characters."""
    lines = (text or "").encode("utf-8", "surrogatepass").translate(_LOWER).split(b"\n")
    keys = [line.strip(BLANK) for line in lines]
    return [xxhash.xxh128_digest(k) if len(k) >= min_chars and (k.isascii() or len(k.decode("utf-8", "surrogatepass")) >= min_chars) else None for k in keys]


def key_batches(batches: Iterator[pd.DataFrame], min_chars: int) -> Iterator[pd.DataFrame]:
    """(doc_id, key) of the distinct keys of every row."""
    for pdf in batches:
        ids, keys = [], []
        for d, text in zip(pdf["doc_id"].tolist(), pdf["text"].tolist()):
            found = {k for k in line_keys(text, min_chars) if k}
            ids += [d] * len(found)
            keys += found
        yield pd.DataFrame({"doc_id": pd.Series(ids, dtype="int64"), "key": pd.Series(keys, dtype=object)})


def keep_batches(batches: Iterator[pd.DataFrame], min_chars: int) -> Iterator[pd.DataFrame]:
    """Rows with the lines that aren't to be dropped, in their order."""
    for pdf in batches:
        counts, dropped, texts = [], [], []
        for text, drops in zip(pdf["text"].tolist(), pdf["drops"].tolist()):
            lines = (text or "").split("\n")
            gone = set() if drops is None else set(map(bytes, drops))
            kept = [line for line, key in zip(lines, line_keys(text, min_chars)) if key not in gone] if gone else lines
            counts.append(len(lines))
            dropped.append(len(lines) - len(kept))
            texts.append("\n".join(kept) if len(kept) < len(lines) else text or "")
        yield pd.DataFrame({"doc_id": pdf["doc_id"], "n_lines": pd.Series(counts, dtype="int64"), "n_dropped": pd.Series(dropped, dtype="int64"), "text": pd.Series(texts, dtype=object)})


def common_lines(keys: DataFrame, min_docs: int) -> DataFrame:
    """(key, last, n) of keys that stand in min_docs documents or more: the largest doc_id, the number of documents.

    The distinct count first meets on (key, document) and then adds up inside the tasks, so that a line of very
    many documents is spread.
    """
    return keys.groupBy("key").agg(F.count_distinct("doc_id").alias("n"), F.max("doc_id").alias("last")).filter(F.col("n") >= min_docs)


def drops_of(keys: DataFrame, common: DataFrame) -> DataFrame:
    """(doc_id, drops): the keys that a document loses. Common lines are broadcast behind a check of their size; beyond it only those of very many documents are, which are few."""
    n, rows = common.agg(F.count("*"), F.sum("n")).first()
    most = 0 if 32 * n <= BROADCAST_BYTES else max(1000, rows // HOT)
    hot = F.broadcast(common.filter(F.col("n") > most).select("key", "last"))
    marked = keys.join(hot, "key", "left")
    lost = marked.filter("doc_id < last").select("doc_id", "key")
    if most:
        rest = common.filter(F.col("n") <= most).select("key", F.col("last").alias("at"))
        lost = lost.unionByName(marked.filter("last IS NULL").join(rest, "key").filter("doc_id < at").select("doc_id", "key"))
    return lost.groupBy("doc_id").agg(F.collect_set("key").alias("drops"))


def drop_lines(docs: DataFrame, min_chars: int = 40, min_docs: int = 5) -> DataFrame:
    """One row per document: doc_id, n_lines (before), n_dropped and the text without the lines dropped.

    A line's key is the line without blanks at its ends, A-Z in lower case. Keys of at least min_chars characters
    that stand in at least min_docs documents lose all their lines except in the largest doc_id that holds them (there
    all stay, ties included). Null and empty text is one empty line; long texts count whole. Rows of one doc_id
    are one document for the counts, and each loses its lines; rows without doc_id are one document, less than all
    others. An empty table gives no rows; other columns are ignored.
    """
    rows = docs.select(id_or_none(F.col("doc_id")), "text")
    keys = materialize(rows.mapInPandas(lambda it: key_batches(it, min_chars), "doc_id long, key binary"))
    drops = materialize(drops_of(keys, materialize(common_lines(keys, min_docs))))
    size = drops.agg(F.sum(24 + 24 * F.size("drops"))).first()[0] or 0
    if size <= BROADCAST_BYTES:  # else the texts are shuffled
        drops = F.broadcast(drops)
    out = rows.join(drops, "doc_id", "left").mapInPandas(lambda it: keep_batches(it, min_chars), "doc_id long, n_lines long, n_dropped long, text string")
    return with_null_ids(out)


def op12_line_dedup(spark, sf_dir):
    return drop_lines(table(spark, sf_dir, "documents")).select("doc_id", "n_lines", "n_dropped", F.sha2("text", 256).alias("kept_sha256"))


OP12_SQL = """
WITH l AS (SELECT doc_id, unnest(string_split(coalesce(text, ''), chr(10))) AS line, generate_subscripts(string_split(coalesce(text, ''), chr(10)), 1) AS i FROM documents),
k AS (SELECT *, translate(trim(line, ' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS key FROM l),
c AS (SELECT key, max(doc_id) AS last FROM k WHERE length(key) >= 40 GROUP BY key HAVING count(DISTINCT doc_id) >= 5),
d AS (SELECT k.doc_id, k.i, k.line, coalesce(k.doc_id < c.last, false) AS gone FROM k LEFT JOIN c USING (key))
SELECT doc_id, count(*) AS n_lines, CAST(count(*) FILTER (WHERE gone) AS BIGINT) AS n_dropped,
  sha256(coalesce(string_agg(line, chr(10) ORDER BY i) FILTER (WHERE NOT gone), '')) AS kept_sha256
FROM d GROUP BY doc_id
"""
