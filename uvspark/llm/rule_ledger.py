"""Quality rules as a bitmask ledger.

Every rule is evaluated once per document; the ledger row keeps the measurements and one failure bit
per rule. Policies are named, versioned bit masks over the ledger, so a policy change or an ablation
(what would each rule reject alone, or only) needs bit operations on the ledger, never the texts.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import table, words

#: Rules by bit, as SQL over the measurements; all integer arithmetic.
RULES = {
    "too_few_words": "n_words < 50",
    "repeated_words": "100 * n_repeat_words > 50 * n_words",
    "symbols": "10 * n_symbols > 2 * n_words",
    "duplicate_lines": "2 * n_dup_lines > n_lines",
    "word_length": "word_chars > 12 * n_words OR word_chars < 2 * n_words",
    "capitals": "2 * n_capitals > word_chars",
}
BIT = {name: 1 << i for i, name in enumerate(RULES)}
#: Policy versions: the rules that reject.
POLICIES = {
    "base": BIT["too_few_words"] | BIT["repeated_words"],
    "v1": sum(BIT.values()),
}


def measure(docs: DataFrame) -> DataFrame:
    """doc_id and the measurements of every document.

    Null text counts as empty, long texts count whole, repeated rows each. A word belongs to a repeated window if any of the windows of three
    words that hold it occurs twice or more in its text.
    """
    text = F.coalesce("text", F.lit(""))
    w = F.col("_words")
    step1 = docs.select("doc_id", text.alias("_text"), words(F.col("text")).alias("_words"))
    step2 = step1.select(
        "doc_id",
        F.size(w).cast("long").alias("n_words"),
        F.length(F.array_join(w, "")).cast("long").alias("word_chars"),
        F.length(F.regexp_replace("_text", r"[^#*$%&|<>]+", "")).cast("long").alias("n_symbols"),
        F.length(F.regexp_replace("_text", r"[^A-Z]+", "")).cast("long").alias("n_capitals"),
        F.filter(F.split("_text", "\n", -1), lambda x: x.rlike(r"[^\x20\x09-\x0D]")).alias("_lines"),
        F.transform(w, lambda x: F.xxhash64(x)).alias("_hash"),
    )
    h, lines = F.col("_hash"), F.col("_lines")
    step3 = step2.select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_capitals",
        F.size(lines).cast("long").alias("n_lines"),
        (F.size(lines) - F.size(F.array_distinct(lines))).cast("long").alias("n_dup_lines"),
        F.when(F.size(h) < 3, F.array().cast("array<bigint>")).otherwise(F.transform(F.sequence(F.lit(0), F.size(h) - 3), lambda i: F.xxhash64(F.get(h, i), F.get(h, i + 1), F.get(h, i + 2)))).alias("_tri"),
    )
    tri, pairs = F.col("_tri"), F.col("_pairs")
    # Only a text with a repeated window pays for sorting its windows with their places.
    step4 = step3.withColumn(
        "_pairs",
        F.when(F.size(F.array_distinct(tri)) < F.size(tri), F.sort_array(F.transform(tri, lambda x, i: F.struct(x.alias("h"), i.alias("i"))))).otherwise(F.array().cast("array<struct<h:bigint,i:int>>")),
    )
    same = lambda p, j: F.coalesce(F.get(pairs, j)["h"] == p["h"], F.lit(False))
    step5 = step4.withColumn("_at", F.sort_array(F.transform(F.filter(pairs, lambda p, j: same(p, j - 1) | same(p, j + 1)), lambda p: p["i"])))
    covered = F.aggregate(
        "_at",
        F.struct(F.lit(-3).alias("last"), F.lit(0).cast("long").alias("n")),
        lambda a, i: F.struct(i.alias("last"), (a["n"] + F.least(F.lit(3), i - a["last"])).alias("n")),
        lambda a: a["n"],
    )
    return step5.withColumn("n_repeat_words", covered).drop("_tri", "_pairs", "_at")


def ledger(docs: DataFrame) -> DataFrame:
    """One row per document: doc_id, measurements and `failed` (bit i: rule i fails).

    Repeated rows are measured on their own; null or empty text has no words and fails
    too_few_words; an empty table gives an empty ledger; other columns are ignored.
    """
    failed = F.lit(0)
    for name, rule in RULES.items():
        failed = failed + F.when(F.expr(rule), BIT[name]).otherwise(0)
    return measure(docs).withColumn("failed", failed.cast("int"))


def apply_policy(rows: DataFrame, policy: str = "v1") -> DataFrame:
    """Add base_failed and kept under a policy version to ledger rows."""
    rejects = lambda mask: F.col("failed").bitwiseAND(F.lit(mask)) != 0
    return rows.withColumns({"base_failed": rejects(POLICIES["base"]), "kept": ~rejects(POLICIES["base"] | POLICIES[policy])})


def ablation(rows: DataFrame, policy: str = "v1") -> DataFrame:
    """Per rule of a policy: documents it rejects, documents only it rejects. One aggregate over the ledger."""
    mask = POLICIES[policy]
    hits = F.col("failed").bitwiseAND(F.lit(mask))
    names = [n for n in RULES if BIT[n] & mask]
    sums = [F.sum((hits.bitwiseAND(F.lit(BIT[n])) != 0).cast("long")).alias(f"{n}_all") for n in names] + [F.sum((hits == BIT[n]).cast("long")).alias(f"{n}_only") for n in names]
    pairs = ", ".join(f"'{n}', coalesce({n}_all, 0L), coalesce({n}_only, 0L)" for n in names)
    return rows.agg(*sums).selectExpr(f"stack({len(names)}, {pairs}) AS (rule, rejected, only_here)")


def keep_documents(docs: DataFrame, policy: str = "v1") -> DataFrame:
    """The documents a policy keeps, with their columns.

    Null and empty texts have no words and go; long texts are measured whole; repeated rows are judged alike, each
    row for itself, so ties don't arise. An empty table stays empty; columns of any name stay.
    """
    packed = docs.select(F.struct(*docs.columns).alias("doc_id"), "text")  # the whole row rides along
    # A column that isn't deterministic keeps the filter above the measurements; pushed below, it would evaluate them once per rule and use.
    rows = apply_policy(ledger(packed), policy).withColumn("_part", F.spark_partition_id())
    return rows.filter("kept AND _part >= 0").select("doc_id.*")


def op8_rule_ledger(spark, sf_dir):
    rows = apply_policy(ledger(table(spark, sf_dir, "documents")))
    return rows.select("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept", "n_lines", "n_capitals", "failed")


OP8_SQL = r"""
WITH w AS (
  SELECT doc_id, coalesce(text, '') AS t, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS ws,
    list_filter(string_split(coalesce(text, ''), chr(10)), lambda x: regexp_matches(x, '[^\x20\x09-\x0D]')) AS lines
  FROM documents
), tri AS (
  SELECT doc_id, i, ws[i] || ' ' || ws[i + 1] || ' ' || ws[i + 2] AS g
  FROM (SELECT doc_id, ws, unnest(range(1, len(ws) - 1)) AS i FROM w)
), hot AS (
  SELECT doc_id, i FROM (SELECT doc_id, i, count(*) OVER (PARTITION BY doc_id, g) AS c FROM tri) WHERE c > 1
), rep AS (
  SELECT doc_id, count(DISTINCT p) AS n FROM (SELECT doc_id, unnest([i, i + 1, i + 2]) AS p FROM hot) GROUP BY doc_id
), m AS (
  SELECT w.doc_id, CAST(len(ws) AS BIGINT) AS n_words, CAST(length(array_to_string(ws, '')) AS BIGINT) AS word_chars,
    CAST(length(regexp_replace(t, '[^#*$%&|<>]+', '', 'g')) AS BIGINT) AS n_symbols,
    CAST(len(lines) - len(list_distinct(lines)) AS BIGINT) AS n_dup_lines, CAST(coalesce(rep.n, 0) AS BIGINT) AS n_repeat_words,
    CAST(len(lines) AS BIGINT) AS n_lines, CAST(length(regexp_replace(t, '[^A-Z]+', '', 'g')) AS BIGINT) AS n_capitals
  FROM w LEFT JOIN rep USING (doc_id)
), f AS (
  SELECT *, CAST((n_words < 50)::INT + 2 * (100 * n_repeat_words > 50 * n_words)::INT + 4 * (10 * n_symbols > 2 * n_words)::INT
    + 8 * (2 * n_dup_lines > n_lines)::INT + 16 * (word_chars > 12 * n_words OR word_chars < 2 * n_words)::INT
    + 32 * (2 * n_capitals > word_chars)::INT AS INT) AS failed FROM m
)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, failed & 3 <> 0 AS base_failed, failed = 0 AS kept, n_lines, n_capitals, failed FROM f
"""
