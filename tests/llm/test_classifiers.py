"""Held-out accuracy of the classifiers, the grammar's rules, and defined results of odd inputs."""

import random
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from churnlens.llm import quality, toxicity
from churnlens.llm.labelled import held_out, sample
from tests.conftest import SF_MID


def accuracy(spark, module, label, threshold):
    docs = spark.read.parquet(f"{SF_MID}/documents.parquet").select("doc_id", "text")
    labels = spark.read.parquet(f"{SF_MID}/labels.parquet")
    scored = module.score(docs, module.fit(docs, labels))
    assert scored.count() == docs.count()
    rows = scored.join(labels, "doc_id").filter(held_out(F.col("doc_id"))).collect()
    assert all(zlib.crc32(str(r.doc_id).encode()) % 4 == 2 and 0 <= r.score <= 1 for r in rows)
    return np.mean([(r.score >= threshold) == (r[label] == 1) for r in rows])


def test_quality_on_held_out_rows(spark):
    assert accuracy(spark, quality, "quality", 0.7) > 0.93


def test_toxicity_on_held_out_rows(spark):
    assert accuracy(spark, toxicity, "toxic", 0.3) > 0.92


def test_dual_coordinate_descent_separates():
    rng = np.random.default_rng(0)
    rows = [np.unique(rng.choice(50, 8)) for _ in range(200)]
    y = np.array([1.0 if 7 in r else -1.0 for r in rows])
    w = quality.descend(rows, [np.ones(len(r)) for r in rows], y, 50, 10.0, 200, 0)
    assert all(np.sign(w[r].sum() + w[-1]) == v for r, v in zip(rows, y))


@pytest.fixture(scope="module")
def odd(spark):
    return spark.createDataFrame([(1, None, 0.5), (2, "", 0.5), (3, " \n", 0.5), (None, "you idiot", 0.5), (4, "word " * 30000, 0.5), (4, "word " * 30000, 0.5)],
                                 "doc_id long, text string, score double")


@pytest.mark.parametrize("module,label", [(quality, "quality"), (toxicity, "toxic")])
def test_odd_rows_and_missing_labels(spark, odd, module, label):
    labels = spark.createDataFrame([(k, k % 2, k % 2) for k in range(0)], "doc_id long, quality int, toxic int")
    got = module.score(odd, module.fit(odd, labels)).collect()
    assert len(got) == 6 and all(0 <= r.score <= 1 for r in got)
    none = odd.limit(0)
    assert module.score(none, module.fit(none, labels)).count() == 0
    labels = spark.createDataFrame([(k, k % 2, k % 2) for k in range(1, 6)] + [(None, 1, 1), (1, None, None)], "doc_id long, quality int, toxic int")
    got = module.score(odd, module.fit(odd, labels)).collect()
    assert len(got) == 6 and len({r.score for r in got if r.doc_id == 4}) == 1


def test_quality_without_poor_rows_keeps_everything():
    model = quality.fit_rows([np.array([1]), np.array([2])], np.array([1, 1]), 1.0)
    assert model.constant == 1.0


def clause(text):
    return toxicity.Model().clauses(text)


def test_grammar_weighs_clauses():
    plain, aimed, negated, told = (clause(t)[0] for t in ("such an idiot", "you idiot", "not an idiot", "people said he looked idiot"))
    assert aimed > plain > told > 0 and plain > negated > 0
    assert clause("kill you")[0] > clause("kill the process")[0]
    assert len(clause("an idiot. a fine day. another moron!")) == 2
    assert clause("nothing here") == [] and clause("") == []
    assert clause("unidiot") == []  # stems open words


def test_grammar_is_a_finite_machine():
    table, start = toxicity.grammar()
    states = {s for s, _ in table}
    assert start in states and all(after in states for after, _ in table.values()) and len(states) < 400


def test_stems_are_learnt_from_rows_that_hold_them():
    rng = random.Random(2)
    bad = [" ".join(rng.choice(["alpha", "beta", "gamma"]) for _ in range(20)) + " grumpel" + rng.choice(["en", "t", "st"]) for _ in range(30)]
    good = [" ".join(rng.choice(["alpha", "beta", "gamma"]) for _ in range(20)) for _ in range(30)]
    counts = {}
    for y, rows in ((1, bad), (0, good)):
        for t in rows:
            for s in toxicity._stems(t):
                counts.setdefault(s, [0, 0])[y] += 1
    chosen = toxicity.choose([(s, c[1], c[0]) for s, c in counts.items()], [toxicity._stems(t) & counts.keys() for t in bad], 30, 30)
    assert chosen and all(s.startswith("grum") for s in chosen)


def test_sample_is_bounded_when_one_id_holds_many_rows(spark):
    docs = spark.range(20_000).select(F.lit(5).cast("long").alias("doc_id"), F.when(F.col("id") % 3 == 0, "same").otherwise(F.concat(F.lit("text "), "id")).alias("text"))
    docs = docs.unionByName(spark.createDataFrame([(i, f"doc {i}") for i in range(100, 160)], "doc_id long, text string"))
    labels = spark.createDataFrame([(5, 1)] * 3 + [(5, 0)] + [(i, i % 2) for i in range(100, 160)] + [(None, 1), (101, None)], "doc_id long, toxic int")
    rows, (zero, one) = sample(docs, labels, "toxic", per_class=10)
    got = rows.collect()
    counts = {c: [r.doc_id for r in got if r.label == c] for c in (0, 1)}
    assert zero > 10 and one > 10 and all(len(v) <= 10 and len(v) == len(set(v)) for v in counts.values())
    again = sample(docs.repartition(9), labels, "toxic", per_class=10)[0]
    assert {(r.doc_id, r.label, r.text) for r in got} == {(r.doc_id, r.label, r.text) for r in again.collect()}
    few = sample(docs, labels, "toxic", per_class=10, most_bytes=30)[0]
    assert few.groupBy("label").agg(F.sum(F.octet_length("text")).alias("n")).filter("n > 30").count() == 0 and few.count() > 0
