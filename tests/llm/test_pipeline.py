"""The pipeline's stages, each on its own input, and the registered queries."""

import re
from collections import Counter

import pytest

pipeline = pytest.importorskip("corpus_pipeline")
WORD = re.compile(r"[^\x20\x09-\x0D]+")


def test_stages(spark, sf_dir, docs):
    from tests.llm.test_free import classes
    from tests.llm.test_native import base_spans, ledger_of
    from uvspark.llm.common import materialize

    steps = dict(pipeline.STAGES)
    assert list(steps) == ["quality_rules", "near_dedup", "secret_scans", "mix_sources", "best_fit_packing"]
    one = materialize(steps["quality_rules"](spark, docs, sf_dir))
    kept = {r.doc_id for r in one.collect()}
    for r in docs.collect():
        n, _, _, _, rep = ledger_of(r.text)
        if r.doc_id in kept:
            assert n >= 50 and 100 * rep <= 50 * n
    two = materialize(steps["near_dedup"](spark, one, sf_dir))
    want = classes([(r.doc_id, r.text) for r in one.collect()], 5)
    assert {r.doc_id for r in two.collect()} == {d for d, (_, _, k) in want.items() if k}
    three = materialize(steps["secret_scans"](spark, two, sf_dir))
    texts = {r.doc_id: r.text for r in two.collect()}
    assert three.count() == two.count()
    for r in three.collect():
        assert (r.text == texts[r.doc_id]) == (not base_spans(texts[r.doc_id])) or "[secret]" in r.text
        assert not base_spans(r.text)
    four = materialize(steps["mix_sources"](spark, three, sf_dir))
    copies = Counter(r.doc_id for r in four.collect())
    assert max(copies.values()) <= 3 and set(copies) <= set(texts)
    for df in (one, two, three, four):
        assert df.columns == docs.columns
    five = steps["best_fit_packing"](spark, four, sf_dir)
    assert five.groupBy("sequence_id").sum("length").filter("`sum(length)` > 2048").isEmpty()


def test_run(spark, sf_dir):
    assert pipeline.run(spark, sf_dir).count() > 0


def test_stages_on_empty_and_odd(spark, sf_dir, odd, empty):
    for _, stage in pipeline.STAGES:
        assert stage(spark, empty, sf_dir).count() == 0
        stage(spark, odd, sf_dir).count()


def test_registered():
    import __spark_entry__ as entry

    names = entry.queries()
    assert {f"op{n}" for n in range(1, 14)} <= {k.partition("_")[0] for k in names} and "pipeline" in names
