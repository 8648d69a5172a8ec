"""Every operator and stage on hard tables: texts of a million characters, and doc_ids that repeat thousands of times."""

import zlib
from collections import Counter

import numpy as np
import pandas as pd
import pytest

from uvspark.llm import entry, minhash_join, packing, secret_scan, sharding, suffix_dedup, syncmers, weak_label

P = pytest.importorskip("public_tokenizers")
pipeline = pytest.importorskip("corpus_pipeline")
MILLION = 1_000_000


@pytest.fixture(scope="module")
def long_texts():
    return {0: " " * MILLION, 1: "a" * MILLION, 2: "#=" * (MILLION // 2), 3: "\n\t" * (MILLION // 2), 4: "word " * (MILLION // 5), 5: "short text of a few words"}


@pytest.fixture(scope="module")
def hard(spark, long_texts, tmp_path_factory):
    """Long texts; 12,000 rows of one doc_id, half of them alike; 12,000 without doc_id; two different texts of one doc_id."""
    rows = [(i, t, "s0") for i, t in long_texts.items()]
    rows += [(3, "the same text in every row" if i % 2 else f"another text number {i} of this id", "s1") for i in range(12_000)]
    rows += [(None, f"row {i} has no id", None) for i in range(12_000)]
    path = str(tmp_path_factory.mktemp("hard"))
    df = spark.createDataFrame([(d, t, "en", s, len(t)) for d, t, s in rows], "doc_id long, text string, lang string, source string, n_chars long").repartition(8)
    df.write.parquet(f"{path}/documents.parquet")
    return path


BY_WORD = ("op11_phrase_collocations", "op13_spelling_variants")


@pytest.mark.parametrize("name", sorted(set(entry.QUERIES) - set(BY_WORD)))
def test_query_on_hard_table(spark, hard, name):
    out = entry.QUERIES[name](spark, hard).select("doc_id").groupBy("doc_id").count().collect()
    want = {0: 1, 1: 1, 2: 1, 4: 1, 5: 1, 3: 12_001, None: 12_000}
    got = {r.doc_id: r["count"] for r in out}
    if name.startswith("op5"):  # one row per piece
        assert set(got) == set(want) and all(got[k] >= want[k] for k in want)
    else:
        assert got == want


def test_words_of_hard_table(spark, hard):
    """The operators whose rows are words or phrases, against brute force."""
    from tests.llm.test_text_mining import COLUMNS, collocations, grouped

    rows = [(r.doc_id, r.text, r.lang) for r in spark.read.parquet(f"{hard}/documents.parquet").collect()]
    got = sorted(tuple(r[c] for c in COLUMNS) for r in entry.QUERIES[BY_WORD[0]](spark, hard).collect())
    assert got == collocations([(t, lang) for _, t, lang in rows], 30, 4, 80, 2000)
    got = {r.word: (r.n, r.n_near, r.form, r.form_n, r.root) for r in entry.QUERIES[BY_WORD[1]](spark, hard).collect()}
    assert got == grouped([(d, t) for d, t, _ in rows])


def test_pipeline_on_hard_table(spark, hard):
    docs = spark.read.parquet(f"{hard}/documents.parquet")
    for _, stage in pipeline.STAGES:
        stage(spark, docs, hard).write.format("noop").mode("overwrite").save()


def test_ids_of_long_texts(spark, long_texts):
    from tokenizers import Tokenizer

    t = Tokenizer.from_file(P.path("byte_bpe_50k.json"))
    encode = packing.encoder(P.path("byte_bpe_50k.json"), P.path("byte_bpe_50k.tiktoken"))
    for text, ids in zip(long_texts.values(), encode(list(long_texts.values()))):
        assert ids == t.encode(text, add_special_tokens=False).ids


@pytest.mark.parametrize("doc_id", [*range(10), None])
def test_quality_of_one_repeated_id(spark, doc_id):
    df = spark.range(12_000).selectExpr(f"cast({'NULL' if doc_id is None else doc_id} as long) AS doc_id", "'a text that is the same everywhere' AS text")
    assert weak_label.classify(df).count() == 12_000


def test_repeats_of_equal_rows(spark):
    """12,000 equal rows of a text of 2 KB, half of which stands in another document, and once more in a third."""
    import hashlib
    import random
    import time

    rng = random.Random(4)
    word = lambda n: " ".join("".join(rng.choice("abcdefghij") for _ in range(7)) for _ in range(n))
    shared, own, other = word(125), word(125), word(300)
    took = {}
    for n in (100, 12_000):
        rows = [(1, other + " " + shared)] + [(2, shared + own)] * n + [(3, own + word(20)), (None, shared), (None, shared)]
        df = spark.createDataFrame(rows, "doc_id long, text string").repartition(8)
        start = time.time()
        got = Counter((r.doc_id, r.n_bytes, r.n_removed, r.n_spans, r.kept_sha256) for r in suffix_dedup.remove_repeats(df, with_bytes=False).collect())
        took[n] = time.time() - start
        sha = lambda t: hashlib.sha256(t.encode()).hexdigest()
        want = Counter({(1, len(rows[0][1]), 0, 0, sha(rows[0][1])): 1, (2, len(shared + own), len(shared), 1, sha(own)): n, (None, len(shared), len(shared), 1, sha("")): 2})
        want[3, len(rows[n + 1][1]), len(own), 1, sha(rows[n + 1][1][len(own) :])] += 1
        assert got == want
    assert took[12_000] < 30 + 3 * took[100]


def two_texts():
    """60 groups (10 g, A), (10 g + 1, A), (10 g + 1, B), (10 g + 5, C) with B and C alike, and rows without doc_id."""
    rows = []
    for g in range(60):
        a = " ".join(f"a{g}w{i}" for i in range(100))
        b = [f"b{g}w{i}" for i in range(300)]
        rows += [(10 * g, a), (10 * g + 1, a), (10 * g + 1, " ".join(b)), (10 * g + 5, " ".join(b[:-2]) + f" c{g} d{g}"), (None, " ".join(b).upper()), (None, f"lone {g} of these")]
    return rows


def test_links_of_ids_with_two_texts(spark):
    rows = two_texts()
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(4)
    got = Counter((r.doc_id, r.n_shingles, r.component_id, r.kept) for r in minhash_join.near_duplicates(df, 5).collect())
    want = Counter()
    for g in range(60):
        want.update([(10 * g, 96, 10 * g, True), (10 * g + 1, 96, 10 * g, False), (10 * g + 1, 296, 10 * g + 1, True), (10 * g + 5, 296, 10 * g + 1, False), (None, 296, 10 * g + 1, True), (None, 1, None, True)])
    assert got == want


def test_one_of_each_class_of_ids_with_two_texts(spark):
    rows = two_texts()
    kept = Counter((r.doc_id, r.text) for r in minhash_join.keep_one(spark.createDataFrame(rows, "doc_id long, text string").repartition(4)).collect())
    assert kept == Counter((d, t) for i, (d, t) in enumerate(rows) if i % 6 in (0, 2, 4, 5))
