"""Substring and near-duplicate detection against brute force."""

import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from churnlens.llm import graph, minhash, substring_dedup
from tests.conftest import SF_SMALL
from tests.llm import brute

SCHEMA = "doc_id long, text string, n_words string, component_id string"


def texts():
    rng = random.Random(9)
    vocab = [f"w{k}" for k in range(400)] + ["Ä", "é.", "IT", "it"]
    said = lambda n: [rng.choice(vocab) for _ in range(n)]
    passage, other = said(70), said(55)
    base = said(160)
    out = [" ".join(base)]
    for k in range(40):  # near copies, each a little further from the first
        copy = list(base)
        for _ in range(1 + k // 4):
            copy[rng.randrange(len(copy))] = "edit" + str(rng.random())
        out.append(" ".join(copy))
    out += [" ".join(base)] * 12
    for k in range(12):
        out.append("\n".join([" ".join(said(30)), "  ".join(passage[k % 3:]), "\t".join(said(20)), " ".join(other if k % 2 else other[:49])]))
    out += ["same same same same same " * 40, "same same same same same " * 30, " ".join(said(3)), "a b", "a  B", "", " \n ", None,
            " ".join(passage * 3), " ".join(said(6000) + passage), "x y " * 60, "x y " * 51]
    rng.shuffle(out)
    return out


@pytest.fixture(scope="module")
def rows():
    return [(3 * i, t) for i, t in enumerate(texts())]


@pytest.fixture(scope="module")
def docs(spark, rows):
    return spark.createDataFrame([(i, t, "clash", "clash") for i, t in rows], SCHEMA).repartition(5)


@pytest.mark.parametrize("shard", [1 << 12, 1 << 22])
def test_substring_dedup_equals_brute_force(monkeypatch, docs, rows, shard):
    monkeypatch.setattr(substring_dedup, "_SHARD", shard)
    got = substring_dedup.dedup_substrings(docs).withColumn("sha", F.sha2("kept_text", 256)).collect()
    want = brute.substring_dedup(rows)
    assert len(got) == len(rows)
    for r in got:
        assert (r.n_words, r.n_removed, r.sha) == want[r.doc_id, r.text], r.doc_id
        assert r.n_removed == sum(s.end - s.first for s in r.removed_spans) and r.component_id == "clash"
    assert sum(r.n_removed for r in got) > 3000


def test_substring_dedup_of_repeated_and_null_ids(spark):
    long = " ".join(f"t{k}" for k in range(80))
    docs = spark.createDataFrame([(5, long), (5, long), (7, long), (None, long), (2, "short")], "doc_id long, text string")
    got = sorted((r.doc_id is None, r.doc_id or 0, r.n_removed) for r in substring_dedup.dedup_substrings(docs).collect())
    assert got == [(False, 2, 0), (False, 5, 0), (False, 5, 0), (False, 7, 80), (True, 0, 0)]


def test_substring_dedup_of_a_row_that_fills_a_third_of_the_table(monkeypatch, docs, rows):
    monkeypatch.setattr(substring_dedup, "_SHARD", 1 << 12)
    long = " ".join(f"h{k}" for k in range(90))
    more = [(50_000, long)] * 60 + [(40_000, "a " + long)] + [(60_000, long + " z")] + [(50_001, None)] * 40
    nulls = [(None, long + " q")] * 50
    spark = docs.sparkSession
    both = docs.unionByName(spark.createDataFrame([(i, t, str(n), "clash") for n, (i, t) in enumerate(more + nulls)], SCHEMA)).repartition(6)
    got = substring_dedup.dedup_substrings(both).withColumn("sha", F.sha2("kept_text", 256)).collect()
    want = brute.substring_dedup(rows + more)
    assert len(got) == len(rows) + len(more) + len(nulls)
    for r in got:
        if r.doc_id is None:
            assert (r.n_words, r.n_removed, r.kept_text) == (91, 0, long + " q")
        else:
            assert (r.n_words, r.n_removed, r.sha) == want[r.doc_id, r.text], r.doc_id
    assert want[50_000, long][1] == 90
    assert {r.component_id for r in got} == {"clash"}


def test_phrases_that_first_run_across_two_documents_are_located(spark):
    rows = [(1, "x y"), (2, "x y " * 60), (3, "x y " * 60), (4, "x\ny"), (5, "y " + "x y " * 40)]
    docs = spark.createDataFrame(rows, "doc_id long, text string").coalesce(1)
    got = {r.doc_id: r.n_removed for r in substring_dedup.dedup_substrings(docs).collect()}
    assert got == {i: brute.substring_dedup(rows)[i, t][1] for i, t in rows} and got[3] == 120


@pytest.mark.parametrize("window, phrase", [(20, 5), (5, 8)])
def test_substring_dedup_with_other_parameters_equals_brute_force(docs, rows, window, phrase):
    short = " ".join(f"s{k}" for k in range(24))
    more = [(10_000, short), (10_001, "before " + short)]
    both = docs.unionByName(docs.sparkSession.createDataFrame([(i, t, "clash", "clash") for i, t in more], SCHEMA))
    got = substring_dedup.dedup_substrings(both, window, phrase).withColumn("sha", F.sha2("kept_text", 256)).collect()
    want = brute.substring_dedup(rows + more, window)
    assert {(r.doc_id, r.text): (r.n_words, r.n_removed, r.sha) for r in got} == want


def test_drop_repeats_returns_the_columns_of_the_input(spark):
    long = " ".join(f"t{k}" for k in range(60))
    docs = spark.createDataFrame([(1, long, len(long)), (2, "a  b " + long, len(long) + 5), (3, "a  b", 4)], "doc_id long, text string, n_chars long")
    got = {r.doc_id: (r.text, r.n_chars) for r in substring_dedup.drop_repeats(docs).collect()}
    assert got == {1: (long, len(long)), 2: ("a b", 3), 3: ("a  b", 4)}


@pytest.mark.parametrize("block", [4, 256])
def test_near_duplicates_equal_brute_force(monkeypatch, docs, rows, block):
    monkeypatch.setattr(minhash, "_BLOCK", block)
    got = minhash.near_duplicates(docs).collect()
    want = brute.near_duplicates(rows)
    assert len(got) == len(rows)
    assert {r.doc_id: (r.n_shingles, r.component_id) for r in got} == want
    assert all(r.kept == (r.doc_id == r.component_id) for r in got)


def test_equal_stored_minima_of_a_band_mean_an_equal_key(spark):
    docs = spark.createDataFrame([(i, f"a b c d e f{i % 3} g h i j") for i in range(9)], "doc_id long, text string")
    for r in minhash._sketch(docs).collect():
        stored = np.frombuffer(r.sig, dtype=np.uint32).astype(np.uint64)[None, :]
        assert minhash.band_keys(stored).view(np.int64)[0].tolist() == r.bands


def test_links_beyond_the_first_of_a_bucket_are_found(spark):
    # a chain: each differs from the next by less than a quarter, its ends by far more
    words = [f"c{k}" for k in range(400)]
    rows = [(i, " ".join(words[12 * i:12 * i + 120])) for i in range(12)]
    got = {r.doc_id: r.component_id for r in minhash.near_duplicates(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert got == {i: c for i, (_, c) in brute.near_duplicates(rows).items()}
    assert set(got.values()) == {0}


def test_texts_that_share_a_doc_id_are_all_compared(spark):
    a, b, c = (" ".join(f"{x}{i}" for i in range(80)) for x in "abc")
    rows = [(5, a), (5, b), (3, b), (9, a + " end"), (5, c), (11, "start " + c), (5, a), (20, "q r s"), (21, c + " z")]
    for n in (1, 4):
        docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(n)
        got = [(r.doc_id, r.component_id) for r in minhash.near_duplicates(docs).collect()]
        assert len(got) == len(rows) and dict(got) == {3: 3, 5: 3, 9: 3, 11: 3, 20: 20, 21: 3}


def test_drop_near_duplicates_keeps_one_of_each_group_and_null_ids(spark):
    t = " ".join(f"k{i}" for i in range(30))
    docs = spark.createDataFrame([(4, t, 1), (2, t, 2), (9, t + " x", 3), (None, t, 4), (11, None, 5), (12, None, 6)], "doc_id long, text string, component long")
    got = minhash.drop_near_duplicates(docs)
    assert got.columns == docs.columns
    assert sorted(r.component for r in got.collect()) == [2, 4, 5, 6]


def test_drop_near_duplicates_keeps_one_row_of_a_repeated_doc_id(spark):
    t, other = (" ".join(f"{x}{i}" for i in range(30)) for x in "kv")
    rows = [(2, t, 1), (2, t, 1), (2, t, 2), (4, t, 3), (2, "", 4), (2, " \n", 5), (6, other, 6), (6, other, 6), (None, t, 7), (None, t, 7), (8, None, 8), (8, None, 8)]
    kept = minhash.drop_near_duplicates(spark.createDataFrame(rows, "doc_id long, text string, source long").repartition(4)).collect()
    assert sorted(r.source for r in kept if r.source > 2) == [4, 5, 6, 7, 7, 8, 8]
    assert sum(r.source <= 2 for r in kept) == 1


def test_components(spark):
    rng = random.Random(1)
    edges = [(rng.randrange(300), rng.randrange(300)) for _ in range(220)] + [(400 + k, 401 + k) for k in range(60)]
    parent = {}

    def find(x):
        while parent.setdefault(x, x) != x:
            x = parent[x]
        return x

    for a, b in edges:
        if a != b:
            x, y = find(a), find(b)
            parent[max(x, y)] = min(x, y)
    got = {r.node: r.component for r in graph.components(spark.createDataFrame(edges, "u long, v long")).collect()}
    assert got == {x: find(x) for x in parent}


def test_empty_tables(spark):
    none = spark.createDataFrame([], "doc_id long, text string")
    assert substring_dedup.dedup_substrings(none).count() == 0
    assert minhash.near_duplicates(none).count() == 0


def test_whole_small_table_equals_brute_force(spark):
    docs = spark.read.parquet(f"{SF_SMALL}/documents.parquet")
    rows = [(r.doc_id, r.text) for r in docs.collect()]
    got = {(r.doc_id, r.text): r for r in substring_dedup.dedup_substrings(docs).withColumn("sha", F.sha2("kept_text", 256)).collect()}
    for k, v in brute.substring_dedup(rows).items():
        assert (got[k].n_words, got[k].n_removed, got[k].sha) == v
    near = {r.doc_id: (r.n_shingles, r.component_id) for r in minhash.near_duplicates(docs).collect()}
    assert near == brute.near_duplicates(rows)
