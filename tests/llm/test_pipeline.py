"""The stages follow one another; each decision takes effect."""

import corpus_pipeline
from churnlens.llm.textops import saved
from tests.conftest import SF_SMALL
from tests.llm import brute


def test_stages_over_the_small_table(spark):
    docs = spark.read.parquet(f"{SF_SMALL}/documents.parquet")
    columns, kept = docs.columns, docs
    names = [n for n, _ in corpus_pipeline.STAGES]
    assert names == ["quality classifier", "toxicity", "near-duplicates", "substring dedup", "packing"]
    before = {}
    for name, stage in corpus_pipeline.STAGES[:-1]:
        after = saved(stage(spark, kept, SF_SMALL), "stage")
        assert after.columns == columns
        before[name] = (kept, after)
        kept = after
    old, new = before["near-duplicates"]
    want = brute.near_duplicates([(r.doc_id, r.text) for r in old.collect()])
    assert {r.doc_id for r in new.collect()} == {i for i, (_, c) in want.items() if i == c}
    old, new = before["substring dedup"]
    rows = [(r.doc_id, r.text) for r in old.collect()]
    want = brute.substring_dedup(rows)
    for r in new.collect():
        text = next(t for i, t in rows if i == r.doc_id)
        n, removed, _ = want[r.doc_id, text]
        assert len(brute.WORD.findall(r.text or "")) == n - removed and r.n_chars == (len(r.text) if removed else r.n_chars)
    pieces = corpus_pipeline.STAGES[-1][1](spark, kept, SF_SMALL).collect()
    assert {r.doc_id for r in pieces} == {r.doc_id for r in kept.collect()}
    assert len(corpus_pipeline.run(spark, SF_SMALL).collect()) == len(pieces)
