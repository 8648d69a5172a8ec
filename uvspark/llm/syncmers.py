"""Document fingerprints from closed syncmers over words.

A window of K words is an anchor if the least hash among its inner windows of S words stands at its
first or its last place. That depends on the window alone, so the same passage gives the same anchors
in any document, wherever it starts, and no K - S windows in a row are without one. A fingerprint holds
every anchor with its distance from the one before: two documents share a passage where they share
anchors, and share it in place where they share neighbouring anchors at one distance.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import long_array, table, words

K, S = 5, 2
#: Bytes of text of one range of with_next: at least the first, and more in proportion to the root of all bytes.
RANGE_BYTES, RANGE_ROOT = 4 << 20, 1 << 10
_LOW32 = (1 << 32) - 1


def with_anchors(rows: DataFrame, text: str, name: str) -> DataFrame:
    """Add {name} (32-bit anchor hashes, in order), {name}_at (their word positions) and {name}_head of a text column.

    A text of 1 to K - 1 words has one anchor, all its words; a text without words has none. The head is
    the number of words and a hash of all of them, as text.
    """
    h, s, at = F.col("_h"), F.col("_s"), F.col(f"{name}_at")
    inner = K - S + 1
    rows = rows.withColumn("_h", F.transform(words(F.col(text)), lambda w: F.xxhash64(w)))
    rows = rows.withColumn("_s", F.when(F.size(h) >= K, F.transform(F.sequence(F.lit(0), F.size(h) - S), lambda i: F.xxhash64(*[F.get(h, i + j) for j in range(S)]))))

    def closed(i):
        all_ = [F.get(s, i + j) for j in range(inner)]
        low = F.least(*all_[1:-1])
        return ((all_[0] <= low) & (all_[0] <= all_[-1])) | ((all_[-1] <= low) & (all_[-1] <= all_[0]))

    few = F.when(F.size(h) > 0, F.array(F.lit(0))).otherwise(F.array().cast("array<int>"))
    rows = rows.withColumn(f"{name}_at", F.when(F.size(h) >= K, F.filter(F.sequence(F.lit(0), F.size(h) - K), closed)).otherwise(few))
    low = lambda x: x.bitwiseAND(F.lit(_LOW32))
    whole = F.transform(at, lambda i: low(F.xxhash64(h)))
    rows = rows.withColumn(name, F.when(F.size(h) >= K, F.transform(at, lambda i: low(F.xxhash64(F.get(s, i), F.get(s, i + 2), F.get(s, i + 3))))).otherwise(whole))
    head = F.concat(F.size(h).cast("string"), F.lit(":"), F.lower(F.lpad(F.hex(F.xxhash64(h)), 16, "0")))
    return rows.withColumn(f"{name}_head", head).drop("_h", "_s")


def packed(name: str) -> Column:
    """Anchors with their distances: 16 * hash + words since the anchor before (the first: since the start)."""
    at = F.col(f"{name}_at")
    return F.transform(F.col(name), lambda x, i: x * 16 + (F.get(at, i) - F.coalesce(F.get(at, i - 1), F.lit(0))))


def likeness(a: Column, b: Column) -> Column:
    """Shared members over all members of either array; 1 if both have none."""
    both, union = F.size(F.array_intersect(a, b)), F.size(F.array_union(a, b))
    return F.when(union == 0, 1.0).otherwise(both / union)


def near(a: Column, b: Column) -> Column:
    """Likeness of two packed fingerprints by their anchors, wherever they stand."""
    bare = lambda x: F.transform(x, lambda p: F.shiftright(p, 4))
    return likeness(bare(a), bare(b))


def aligned(a: Column, b: Column) -> Column:
    """Likeness by place: neighbouring anchors at one distance, wherever the passage starts. A fingerprint of one anchor counts as that anchor."""

    def links(x):
        pair = F.transform(F.sequence(F.lit(1), F.size(x) - 1), lambda i: F.xxhash64(F.shiftright(F.get(x, i - 1), 4), F.get(x, i)))
        return F.when(F.size(x) > 1, pair).otherwise(x)

    return likeness(links(a), links(b))


def fingerprint(head: Column, anchors: Column) -> Column:
    """Text form: the head, then 9 hex digits per anchor of the packed array: 8 of its hash, one of its distance."""
    return F.concat(head, F.lit(":"), F.array_join(F.transform(anchors, lambda x: F.lower(F.lpad(F.hex(x), 9, "0"))), ""))


def with_next(docs: DataFrame) -> DataFrame:
    """Add to each row the text and packed anchors of the next row, descending doc_id, nulls last, equal ids by a hash of the text and the text; after the last: the first.

    doc_id is cut at quantiles into ranges, by the bytes of text; an id that spans several quantiles is cut
    further by the hash. Rows are dealt by range and looked up by a window in each. The first row of every
    range is also sent to the range before it, so that no range needs another one's rows. Only one cut and
    one head per range reach the driver.
    """
    key = F.bitwise_not(F.coalesce(F.col("doc_id").cast("long"), F.lit(-(1 << 63))))  # ascending where doc_id descends
    rows = docs.select("doc_id", "text", key.alias("_key"))
    total = rows.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    n = max(1, int(total // max(RANGE_BYTES, (total * RANGE_ROOT) ** 0.5)))
    shares = F.split(F.lit(",".join(f"{i / n:.9f}" for i in range(1, n)) or "0.5"), ",").cast("array<double>")
    found = rows.agg(F.percentile_approx("_key", shares, 20 * n)).first()[0] or [0]
    cuts = sorted(set(found))
    times = [found.count(c) for c in cuts] if len(cuts) < len(found) else [1] * len(cuts)
    starts = [0]
    for t in [1, *times]:
        starts.append(starts[-1] + t)
    steps = [1 << i for i in reversed(range(len(cuts).bit_length()))]
    bounds = long_array(cuts)
    # Number of cuts up to the key, by binary search.
    j = F.aggregate(long_array(steps).cast("array<int>"), F.lit(0), lambda acc, step: acc + F.when(F.get(bounds, acc + step - 1) <= F.col("_key"), step).otherwise(0))
    rows = rows.withColumn("_j", j)
    hot = max(times) > 1
    hash_ = F.xxhash64("text") if hot else F.lit(0).cast("long")
    m = F.get(long_array([1, *times]), F.col("_j"))
    if hot:
        part = F.least(m - 1, F.floor((F.xxhash64("text") / F.lit(2.0**64) + 0.5) * m))
        last = F.when((m > 1) & (F.get(bounds, F.col("_j") - 1) == F.col("_key")), part).otherwise(m - 1)
    else:
        last = F.lit(0)
    rows = rows.withColumn("_range", (F.get(long_array(starts), F.col("_j")) + last).cast("int")).withColumn("_hash", hash_)
    heads = {r["_range"]: r["_head"] for r in rows.groupBy("_range").agg(F.min(F.struct("_key", "_hash")).alias("_head")).collect()}
    order = sorted(heads) or [0]
    before = {b: order[i - 1] for i, b in enumerate(order)}
    every = range(order[-1] + 1)
    of = lambda values: F.get(long_array([values(b) for b in every]), F.col("_range"))
    none = {"_key": 0, "_hash": 0}
    is_head = (of(lambda b: heads.get(b, none)["_key"]) == F.col("_key")) & (of(lambda b: heads.get(b, none)["_hash"]) == F.col("_hash"))
    here = F.struct(F.col("_range").alias("r"), F.lit(False).alias("ghost"))
    there = F.struct(of(lambda b: before.get(b, 0)).cast("int").alias("r"), F.lit(True).alias("ghost"))
    placed = rows.withColumn("_to", F.explode(F.when(is_head, F.array(here, there)).otherwise(F.array(here))))
    placed = placed.select("doc_id", "text", "_key", F.col("_to.r").alias("_range"), F.col("_to.ghost").alias("_ghost")).repartition("_range")
    placed = with_anchors(placed, "text", "_a").withColumn("_anchors", packed("_a")).drop("_a", "_a_at").withColumnRenamed("_a_head", "_head")
    w = Window.partitionBy("_range").orderBy("_ghost", "_key", F.xxhash64("text"), "text")
    follow = F.lead(F.struct(F.col("text").alias("text"), F.col("_anchors").alias("anchors"))).over(w)
    return placed.withColumn("_next", follow).filter("NOT _ghost")


def fingerprint_documents(docs: DataFrame) -> DataFrame:
    """doc_id, anchors and anchors_at (word positions) of every document; null text has none; repeated rows each have their own."""
    return with_anchors(docs.select("doc_id", F.coalesce("text", F.lit("")).alias("_text")), "_text", "anchors").drop("_text", "anchors_head")


def compare_edited(docs: DataFrame) -> DataFrame:
    """Fingerprint every document, its half-replaced text, and compare both and the next document.

    near_* is the share of anchors of either fingerprint that both have, aligned_* that of neighbouring
    anchors at one distance. Null text counts as empty; long texts count whole. Repeated rows are
    documents of their own; a single row is its own next. An empty table gives no rows; other columns are ignored.
    """
    rows = with_next(docs.select("doc_id", F.coalesce("text", F.lit("")).alias("text")))
    n = F.length("text")
    half = F.floor(n / 2).cast("int")
    rows = rows.withColumn("_edited", F.concat(F.substring(F.col("text"), F.lit(1), n - half), F.substring(F.col("_next.text"), F.lit(1), half)))
    rows = rows.select("doc_id", n.cast("long").alias("n_chars"), F.sha2("_edited", 256).alias("edited_sha256"), "_head", "_anchors", F.col("_next.anchors").alias("_after"), "_edited")
    rows = with_anchors(rows, "_edited", "_e").withColumn("_changed", packed("_e"))
    a, b, c = F.col("_anchors"), F.col("_changed"), F.col("_after")
    return rows.select(
        "doc_id", "n_chars", "edited_sha256",
        fingerprint(F.col("_head"), a).alias("fingerprint"), fingerprint(F.col("_e_head"), b).alias("edited_fingerprint"),
        near(a, b).alias("near_edited"), near(a, c).alias("near_next"), aligned(a, b).alias("aligned_edited"), aligned(a, c).alias("aligned_next"),
    )


def op2_closed_syncmers(spark, sf_dir):
    return compare_edited(table(spark, sf_dir, "documents"))
