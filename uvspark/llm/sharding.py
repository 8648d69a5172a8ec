"""Sharding by a hierarchical weighted hash tree.

Regions hold racks, racks hold shards. At each level a row draws one exponential variate per child of
the node it is in, from a hash of (key, child) and at the rate of the child's summed weight, and goes
down to the least: a weighted choice. Only the winner's children are drawn next, so a row costs the
branching of its path, not the number of shards. A weight change alters the draws of the nodes above
that shard alone: rows move into or out of the subtrees whose weights change, and within them. A
shard that is added later stands in a region of its own, so that rows move only into it.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import long_array, materialize, table, with_global_rank

SHARDS_PER_RACK, RACKS_PER_REGION = 4, 4
#: Shards that a tree is built with; later ones stand in regions of their own.
BUILT = 40

#: Weights of shards, by rack, by region. Shards are numbered in this order.
Tree = Sequence[Sequence[Sequence[float]]]


def built_tree(weights: Sequence[float], built: int = BUILT) -> list[list[list[float]]]:
    """The tree of shards 0..len(weights)-1: the first `built` in full racks and regions, each later one in a region of its own."""
    cut = lambda x, n: [list(x[i : i + n]) for i in range(0, len(x), n)]
    return cut(cut(weights[:built], SHARDS_PER_RACK), RACKS_PER_REGION) + [[[w]] for w in weights[built:]]


def grown_tree(tree: Tree, weight: float = 1.0) -> list[list[list[float]]]:
    """tree with one more shard, in a region of its own."""
    return [*tree, [[weight]]]


def child(path: Column, weights: Column) -> Column:
    """Index of the child drawn at a node: path names the node for this key, weights are the children's; weight 0 takes none.

    A draw is -ln(u) / weight, u from 52 bits of md5(path:child).
    """

    def draw(w, i):
        bits = F.conv(F.substring(F.md5(F.concat(path, F.lit(":"), i.cast("string"))), 1, 13), 16, 10).cast("double")
        return F.struct((-F.log((bits + 1) / F.lit(float(1 << 52))) / F.nullif(w, F.lit(0.0))).alias("draw"), i.alias("child"), (w > 0).alias("open"))

    return F.array_min(F.filter(F.transform(weights, draw), lambda x: x["open"]))["child"]


def _nested(values, depth: int) -> Column:
    return F.array(*[_nested(v, depth - 1) for v in values]) if depth else F.lit(values)


def with_shard(rows: DataFrame, key: str, tree: Tree, name: str) -> DataFrame:
    """Add column {name}: the shard of each key (a string column) in the tree. Needs a weight above 0."""
    rack_sums = [[float(sum(rack)) for rack in region] for region in tree]
    if not sum(map(sum, rack_sums)) > 0:
        raise ValueError("no shard takes rows")
    first, n = [], 0
    for region in tree:
        first.append([])
        for rack in region:
            first[-1].append(n)
            n += len(rack)
    at, k = F.col("_region"), F.col(key)
    # One projection per level, so that each draw is made once.
    rows = rows.withColumn("_region", child(k, _nested([sum(r) for r in rack_sums], 1)))
    rows = rows.withColumn("_rack", child(F.concat(k, F.lit(":"), at.cast("string")), F.get(_nested(rack_sums, 2), at)))
    weights = F.get(F.get(_nested([[[float(w) for w in rack] for rack in region] for region in tree], 3), at), F.col("_rack"))
    rows = rows.withColumn("_leaf", child(F.concat_ws(":", k, at.cast("string"), F.col("_rack").cast("string")), weights))
    start = F.get(F.get(_nested(first, 2), at), F.col("_rack"))
    return rows.withColumn(name, start + F.col("_leaf")).drop("_region", "_rack", "_leaf")


def shard_documents(docs: DataFrame, shards: int = 40, weights: Sequence[float] | None = None, new_weight: float = 1.0, built: int = BUILT) -> DataFrame:
    """One row per document: size, crc, shard, slot in the shard, and the shard if one more is added.

    Null or empty text: size 16, crc 0; long texts count whole. A null doc_id is hashed as the text
    "null". Repeated rows go to one shard, in slots of their own; slots follow doc_id, ties by crc and
    then in no fixed order. An empty table gives no rows. Other columns are ignored. `built` is how many shards
    the tree was built with: those stand in its racks and regions, later ones in regions of their own. It must
    stay the same when shards are added, or more than the new shard's rows move.
    """
    tree = built_tree(list(weights or [1.0] * shards), built)
    text = F.coalesce("text", F.lit(""))
    rows = docs.select(
        "doc_id",
        (F.octet_length(text) + 16).cast("long").alias("size"),
        F.crc32(text.cast("binary")).alias("text_crc32"),
        F.coalesce(F.col("doc_id").cast("string"), F.lit("null")).alias("_key"),
    )
    rows = with_shard(with_shard(rows, "_key", tree, "shard"), "_key", grown_tree(tree, new_weight), "grown_shard").drop("_key")
    placed = with_global_rank(materialize(rows), [F.col("shard"), F.col("doc_id"), F.col("text_crc32")])
    firsts = {r["shard"]: r["n"] for r in placed.groupBy("shard").agg(F.min("rank").alias("n")).collect()}  # one row per shard
    slot = F.col("rank") - F.get(long_array([firsts.get(i, 0) for i in range(max(firsts, default=0) + 1)]), F.col("shard"))
    return placed.select("doc_id", "size", "text_crc32", F.lit("key").alias("law"), "shard", slot.alias("slot"), "grown_shard")


def op10_hash_tree_sharding(spark, sf_dir):
    return shard_documents(table(spark, sf_dir, "documents"))


OP10_SQL = """
WITH tab AS (
  SELECT list_transform(range(256), lambda i: list_reduce(list_prepend(i, range(8)), lambda c, k: CASE WHEN c % 2 = 1 THEN xor(3988292384, c // 2) ELSE c // 2 END)) AS t
), crc AS (
  SELECT doc_id, text, xor(4294967295, list_reduce(list_prepend(4294967295, list_transform(regexp_extract_all(hex(encode(coalesce(text, ''))), '..'), lambda h: ('0x' || h)::BIGINT)),
    lambda c, b: xor(c // 256, t[CAST(xor(c % 256, b) AS INT) + 1]))) AS crc FROM documents, tab
), leaf AS (  -- the tree: shards 0 to 39 in racks of 4 and regions of 16; shard 40 in region 3
  SELECT s AS shard, CASE WHEN s < 40 THEN s // 16 ELSE 3 END AS region, CASE WHEN s < 40 THEN s % 16 // 4 ELSE 0 END AS rack, CASE WHEN s < 40 THEN s % 4 ELSE 0 END AS place FROM range(41) r(s)
), trees AS (SELECT leaf.*, grown FROM leaf, (SELECT unnest([false, true]) AS grown) g WHERE grown OR shard < 40),
regions AS (SELECT grown, region, count(*) AS w FROM trees GROUP BY ALL),
racks AS (SELECT grown, region, rack, count(*) AS w FROM trees GROUP BY ALL),
d1 AS (
  SELECT doc_id, grown, arg_min(region, -ln((('0x' || substr(md5(doc_id || ':' || region), 1, 13))::BIGINT + 1) / 4503599627370496.0) / w) AS region
  FROM documents, regions GROUP BY ALL
), d2 AS (
  SELECT doc_id, grown, region, arg_min(rack, -ln((('0x' || substr(md5(doc_id || ':' || region || ':' || rack), 1, 13))::BIGINT + 1) / 4503599627370496.0) / w) AS rack
  FROM d1 JOIN racks USING (grown, region) GROUP BY ALL
), d3 AS (
  SELECT doc_id, grown, arg_min(shard, -ln((('0x' || substr(md5(doc_id || ':' || region || ':' || rack || ':' || place), 1, 13))::BIGINT + 1) / 4503599627370496.0)) AS shard
  FROM d2 JOIN trees USING (grown, region, rack) GROUP BY doc_id, grown
), best AS (
  SELECT doc_id, max(shard) FILTER (WHERE NOT grown)::INT AS shard, max(shard) FILTER (WHERE grown)::INT AS grown_shard FROM d3 GROUP BY doc_id
)
SELECT doc_id, CAST(strlen(coalesce(text, '')) + 16 AS BIGINT) AS size, CAST(crc AS BIGINT) AS text_crc32, 'key' AS law, shard,
  row_number() OVER (PARTITION BY shard ORDER BY doc_id) - 1 AS slot, grown_shard
FROM crc JOIN best USING (doc_id)
"""
