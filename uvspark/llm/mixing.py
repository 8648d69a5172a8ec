"""Mixing sources to target weights by entropy balancing.

Each source gets a word target. Document rates minimise bounded relative entropy to 1 under the
constraint sum(rate * size) = target per source; the dual solution is an exponential tilt of the odds,
rate = cap / (1 + (cap - 1) * exp(-lambda * size / scale)), one lambda per source, found by Newton
iterations on a compact (source, size) histogram. Rates are then rounded into copies.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import GAP, checkpoint, materialize, table, with_global_rank

WEIGHTS = (1, 2, 3)
CAP = 3
#: Newton ends when every source is this near its target, relatively; beyond so many steps it raises.
TOLERANCE, NEWTON_STEPS = 1e-7, 100
CHUNK_ROWS = 256
#: A document is rounded in a chunk only if the chunks hold this many times its words on average.
SPREAD = 8
#: Most rows of copies that are broadcast to the documents.
BROADCAST_ROWS = 500_000


def source_targets(sizes: DataFrame, weights: tuple[int, ...] = WEIGHTS, cap: int = CAP) -> DataFrame:
    """_source, source_size, target per source of `sizes` (_source, size, n).

    Weights repeat over the sources by code point, null last. All words are shared by weight; a source
    whose share would pass cap times its words stops there, and the rest is shared anew.
    """
    spark = sizes.sparkSession
    sums = sizes.groupBy("_source").agg(F.sum(F.col("size") * F.col("n")).alias("source_size"))
    ranked = with_global_rank(sums, [F.col("_source").asc_nulls_last()], "_rank")
    w = F.element_at(F.array(*map(F.lit, weights)), (F.col("_rank") % len(weights) + 1).cast("int"))
    open_ = checkpoint(ranked.select("_source", "source_size", w.alias("_w"), F.lit(False).alias("_full")))
    while True:
        total, full, weight = open_.agg(F.sum("source_size"), F.sum(F.when(F.col("_full"), F.col("source_size") * cap).otherwise(0)), F.sum(F.when(F.col("_full"), 0).otherwise(F.col("_w")))).first()
        if not total or not weight:
            share = 0.0
            break
        share = (total - full) / weight
        more = open_.withColumn("_full", F.col("_full") | (F.col("_w") * share > F.col("source_size") * cap))
        if not more.filter("_full").count() > open_.filter("_full").count():
            break
        open_ = checkpoint(more)
    target = F.when(F.col("_full"), F.col("source_size").cast("double") * cap).otherwise(F.col("_w") * F.lit(float(share)))
    return open_.select("_source", "source_size", target.alias("target"))


def rate(lam, x, cap: int = CAP):
    return cap / (1 + (cap - 1) * F.exp(-F.greatest(F.lit(-700.0), F.least(F.lit(700.0), lam * x))))


def solve_tilts(hist: DataFrame, targets: DataFrame, cap: int = CAP, steps: int = NEWTON_STEPS) -> DataFrame:
    """Add _lambda and _scale per source: damped Newton on the dual, all sources at once.

    Each step is one aggregate over the histogram. A bracket kept per source takes over where a Newton
    step would leave it. A source whose target is all it may give has rate cap throughout and takes no part.
    """
    full = F.col("target") >= F.col("source_size") * cap * (1 - 1e-12)
    state = targets.withColumns({"_lambda": F.when(full, 700.0).otherwise(0.0), "_full": full, "_lo": F.lit(-700.0), "_hi": F.lit(700.0)})
    scale = hist.groupBy("_source").agg((F.sum(F.col("size") * F.col("n")) / F.sum("n")).alias("_scale"))
    state = checkpoint(state.join(scale, state["_source"].eqNullSafe(scale["_source"])).drop(scale["_source"]))
    for _ in range(steps):
        x = F.col("size") / F.col("_scale")
        r = rate(F.col("_lambda"), x, cap)
        s = F.col("h._source")
        sums = (
            hist.alias("h").join(state, s.eqNullSafe(state["_source"])).groupBy(s.alias("_key"))
            .agg(F.sum(F.col("n") * F.col("size") * r).alias("_f"), F.sum(F.col("n") * F.col("size") * x * r * (1 - r / cap)).alias("_df"))
        )
        over = F.col("_f") > F.col("target")
        done = F.col("_full") | (F.abs(F.col("_f") - F.col("target")) <= TOLERANCE * F.col("target"))
        lo, hi = F.when(over, F.col("_lo")).otherwise(F.col("_lambda")), F.when(over, F.col("_lambda")).otherwise(F.col("_hi"))
        newton = F.col("_lambda") - (F.col("_f") - F.col("target")) / F.nullif(F.col("_df"), F.lit(0.0))
        state = state.join(sums, F.col("_source").eqNullSafe(F.col("_key"))).select("_source", "source_size", "target", "_scale", "_full", "_lambda", lo.alias("_lo"), hi.alias("_hi"), newton.alias("_try"), done.alias("_done"))
        step = F.when(F.col("_try").between(F.col("_lo"), F.col("_hi")), F.col("_try")).otherwise((F.col("_lo") + F.col("_hi")) / 2)
        state = state.withColumn("_lambda", F.when(F.col("_done"), F.col("_lambda")).otherwise(step)).drop("_try")
        state = checkpoint(state)  # short plans, alike in every step
        if state.filter("NOT _done").isEmpty():
            return state.select("_source", "source_size", "target", "_scale", "_lambda")
        state = state.drop("_done")
    raise RuntimeError(f"the tilts miss their targets by more than {TOLERANCE} after {steps} steps")


def size_levels(every: DataFrame) -> tuple[DataFrame, int]:
    """Per _source of `every` (_source, size, n): _levels, an array of (level, top, rows, words) by size; and the most levels.

    A level ends at the largest size of which its chunks can absorb a document; larger ones make the
    next level, in fewer chunks, until one chunk holds what is left.
    """
    open_, parts, level = every, None, 0
    w = Window.partitionBy("_source")
    while True:
        open_ = open_.withColumn("_chunks", F.ceil(F.sum("n").over(w) / CHUNK_ROWS)).withColumn("_below", F.sum(F.col("size") * F.col("n")).over(w.orderBy("size")))
        fits = (F.col("_chunks") == 1) | (F.col("_below") >= SPREAD * F.col("size") * F.col("_chunks"))
        open_ = checkpoint(open_.withColumn("_top", F.max(F.when(fits, F.col("size"))).over(w)))
        here = F.col("_top").isNull() | (F.col("size") <= F.col("_top"))
        part = open_.filter(here).groupBy("_source").agg(F.struct(F.lit(level).alias("level"), F.max("size").alias("top"), F.sum("n").alias("rows"), F.sum(F.col("size") * F.col("n")).alias("words")).alias("_l"))
        parts = part if parts is None else parts.union(part)
        open_ = open_.filter(~here).select("_source", "size", "n")
        level += 1
        if open_.isEmpty():
            return parts.groupBy("_source").agg(F.sort_array(F.collect_list("_l")).alias("_levels")), level


def mix_sizes(sizes: DataFrame, weights: tuple[int, ...] = WEIGHTS, cap: int = CAP) -> DataFrame:
    """Add source_size, target, rate and copies to rows with columns _id, source, size and perhaps _salt.

    _id and _salt together place a row in its chunk; rows alike in both meet in one.

    Copies: each source is cut into chunks of about CHUNK_ROWS documents by hash; inside a chunk the
    documents go from large to small, each taking the copies nearest to its own rate's words plus the
    words still owed, so a chunk's error is at most about its least document. Documents too large for
    the others of a chunk to make up for are rounded before, among themselves; the words they leave owed
    are spread over the next smaller level.
    """
    sizes = sizes.withColumnRenamed("source", "_source")
    if "_salt" not in sizes.columns:
        sizes = sizes.withColumn("_salt", F.lit(0))
    hist = checkpoint(sizes.filter("size > 0").groupBy("_source", "size").agg(F.count("*").alias("n")))
    every = sizes.groupBy("_source", "size").agg(F.count("*").alias("n"))
    targets = source_targets(every, weights, cap)
    tilts = solve_tilts(hist, targets, cap)
    levels, n_levels = size_levels(every)
    per_source = targets.join(levels, targets["_source"].eqNullSafe(levels["_source"])).drop(levels["_source"])
    per_source = per_source.join(tilts.select(F.col("_source").alias("_key"), "_lambda", "_scale"), F.col("_source").eqNullSafe(F.col("_key")), "left").drop("_key")
    per_source = checkpoint(per_source.withColumnRenamed("_source", "_key").withColumn("_add", F.lit(0.0)))

    def take(acc, d):
        owed = acc["owed"] + (d["rate"] + d["add"]) * d["size"]
        n = F.when(d["size"] > 0, F.greatest(F.lit(0), F.least(F.lit(cap), F.round(owed / d["size"])))).otherwise(1).cast("int")
        return F.struct((owed - n * d["size"]).alias("owed"), F.concat(acc["copies"], F.array(n)).alias("copies"))

    out = None
    for level in reversed(range(n_levels)):
        rated = sizes.join(per_source, F.col("_source").eqNullSafe(F.col("_key"))).drop("_key")
        rated = rated.withColumn("rate", F.when(F.col("size") > 0, rate(F.col("_lambda"), F.col("size") / F.col("_scale"), cap)).otherwise(1.0))
        if n_levels > 1:
            rated = rated.filter(F.size(F.filter("_levels", lambda x: x["top"] < F.col("size"))) == level)
        chunk = F.pmod(F.xxhash64("_id", "_salt"), F.greatest(F.lit(1), F.ceil(F.get("_levels", F.lit(level))["rows"] / CHUNK_ROWS).cast("long")))
        row = F.struct("size", "_id", "rate", "source_size", "target", F.col("_add").alias("add"))
        chunks = rated.groupBy("_source", chunk.alias("_chunk")).agg(F.sort_array(F.collect_list(row), asc=False).alias("_docs"))
        taken = F.aggregate("_docs", F.struct(F.lit(0.0).alias("owed"), F.array().cast("array<int>").alias("copies")), take)
        settled = chunks.withColumn("_taken", taken)
        if level:
            settled = materialize(settled)
            owed = settled.groupBy(F.col("_source").alias("_s")).agg(F.sum("_taken.owed").alias("_owed"))
            below = F.get("_levels", F.lit(level - 1))["words"]
            per_source = per_source.join(owed, F.col("_key").eqNullSafe(F.col("_s")), "left").withColumn("_add", F.coalesce(F.col("_owed") / F.nullif(below, F.lit(0)), F.lit(0.0)))
            per_source = checkpoint(per_source.drop("_s", "_owed"))
        flat = settled.select("_source", F.explode(F.arrays_zip("_docs", F.col("_taken.copies").alias("_copies"))).alias("_d"))
        out = flat if out is None else out.union(flat)
    d = F.col("_d._docs")
    return out.select(d["_id"].alias("_id"), F.col("_source").alias("source"), d["size"].alias("size"), d["source_size"].alias("source_size"), d["target"].alias("target"), d["rate"].alias("rate"), F.col("_d._copies").alias("copies"))


def document_sizes(docs: DataFrame) -> DataFrame:
    """doc_id, source, size in words and a hash of the text; null text has no words. `source` may be absent: then null."""
    text = F.coalesce("text", F.lit(""))
    gaps = F.size(F.split(text, GAP, -1))
    empty_ends = F.when(text.rlike(r"^[\x20\x09-\x0D]"), 1).otherwise(0) + F.when(text.rlike(r"[\x20\x09-\x0D]\z"), 1).otherwise(0)
    n = F.when(text.rlike(r"[^\x20\x09-\x0D]"), gaps - empty_ends).otherwise(0)
    source = F.col("source") if "source" in docs.columns else F.lit(None).cast("string").alias("source")
    return docs.select("doc_id", source, n.cast("long").alias("size"), F.xxhash64(text).alias("_salt"))


def mix_documents(docs: DataFrame, weights: tuple[int, ...] = WEIGHTS, cap: int = CAP) -> DataFrame:
    """One row per document: doc_id, source, size, source_size, target, rate, copies, taken.

    Null source, or no such column, is a source of its own, the last. A document without words keeps one
    copy of nothing. Long texts count whole. Repeated rows are documents of their own. The same input gives
    the same copies again. An empty table gives no rows; other columns are ignored.
    """
    sized = materialize(document_sizes(docs))
    rows = mix_sizes(sized.withColumnRenamed("doc_id", "_id"), weights, cap)
    return rows.withColumnRenamed("_id", "doc_id").withColumn("taken", (F.col("copies") * F.col("size")).cast("long"))


def copy_documents(docs: DataFrame, weights: tuple[int, ...] = WEIGHTS, cap: int = CAP) -> DataFrame:
    """docs as the mix takes them: every row as often as its copies say, so perhaps not at all.

    Columns stay, whatever their names; `source` may be absent. Rows alike in doc_id, source and text share
    their copies. Null text has no words and keeps one copy; an empty table stays empty.
    """
    source = F.col("source") if "source" in docs.columns else F.lit(None).cast("string")
    key = {"__id": F.col("doc_id"), "__source": source, "__text": F.xxhash64(F.coalesce("text", F.lit("")))}
    sized = document_sizes(docs.select(F.struct(*[v.alias(k) for k, v in key.items()]).alias("doc_id"), source.alias("source"), "text")).drop("_salt")
    mixed = mix_sizes(materialize(sized.withColumnRenamed("doc_id", "_id")), weights, cap)
    copies = materialize(mixed.groupBy("_id").agg(F.sum("copies").cast("int").alias("__copies"), F.count("*").alias("__rows")).filter("__copies > 0"))
    rows = docs.select(F.struct(*docs.columns).alias("__row"), F.struct(*[v.alias(k) for k, v in key.items()]).alias("__key"))
    if copies.count() <= BROADCAST_ROWS:  # else the documents are shuffled
        copies = F.broadcast(copies)
    if not copies.filter("__rows > 1").isEmpty():
        rows = rows.groupBy("__key").agg(F.min("__row").alias("__row"))
    joined = rows.join(copies, F.col("__key").eqNullSafe(F.col("_id")))
    return joined.select("__row", F.explode(F.sequence(F.lit(1), F.col("__copies")))).select("__row.*")


def op6_entropy_balancing(spark, sf_dir):
    return mix_documents(table(spark, sf_dir, "documents")).select("doc_id", "size", "source_size", "target", "taken", "source", "copies", "rate")
