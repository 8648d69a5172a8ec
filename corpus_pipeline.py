"""The corpus pipeline: five stages over `documents`, each one's result written as Parquet and reread by the next."""

from __future__ import annotations

import public_tokenizers

from uvspark.llm import minhash_join, mixing, packing, rule_ledger, secret_scan
from uvspark.llm.common import materialize, table

WORDS, PERCENT = 5, 80


def quality_rules(spark, docs, sf_dir):
    """Documents that break a rule of the policy go; null and empty texts among them. Repeated rows are judged alike."""
    return rule_ledger.keep_documents(docs)


def near_dedup(spark, docs, sf_dir):
    """Of each class of near-duplicates one document stays, the least doc_id; rows that repeat it become one. Null, empty and blank texts and rows without doc_id stay."""
    return minhash_join.keep_one(docs, WORDS, PERCENT)


def secret_scans(spark, docs, sf_dir):
    """Secrets are replaced in the texts, however long; no document goes. Null texts stay null."""
    return secret_scan.redact_documents(docs)


def mix_sources(spark, docs, sf_dir):
    """Documents are repeated or left out so that the sources reach their targets. Null texts have no words and keep one copy; a null source is a source, the last."""
    return mixing.copy_documents(docs)


def best_fit_packing(spark, docs, sf_dir):
    """Token pieces placed in sequences: of null and empty texts one piece of one token, of long texts as many as they need."""
    return packing.pack_documents(docs, public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.path("byte_bpe_50k.tiktoken"))


STAGES = [("quality_rules", quality_rules), ("near_dedup", near_dedup), ("secret_scans", secret_scans), ("mix_sources", mix_sources), ("best_fit_packing", best_fit_packing)]
#: SQL can't express the near-duplicate and packing methods; tests hold the stages against brute force.
ORACLE_SQL = None


def run(spark, sf_dir):
    docs = table(spark, sf_dir, "documents")
    for i, (_, stage) in enumerate(STAGES, 1):
        docs = stage(spark, docs, sf_dir)
        if i < len(STAGES):
            docs = materialize(docs)
    return docs
