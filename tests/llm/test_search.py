"""Exact top-k against brute force; recall of the hash-prefix forest."""

import duckdb
import numpy as np
import pytest

from churnlens.llm import ann, queries, topk, vectors
from tests.llm import brute

SCHEMA = "vec_id long, embedding array<float>, rank string"


@pytest.fixture(scope="module")
def table(spark):
    rng = np.random.default_rng(3)
    m = rng.standard_normal((600, 16)).astype(np.float32)
    m /= np.linalg.norm(m, axis=1, keepdims=True)
    m[100:300] = m[100]  # a third are copies
    rows = [(i, m[i].tolist(), "clash") for i in range(600)]
    rows += [(1000, None, "x"), (1010, [None] * 16, "x"), (1020, [float("nan")] * 16, "x"), (1030, [float("inf")] * 16, "x"), (1040, [], "x"),
             (1050, [0.0] * 16, "x"), (None, m[0].tolist(), "x"), (1060, [1.0, 2.0], "x")]
    return spark.createDataFrame(rows, SCHEMA).repartition(7), m


def grouped(df):
    out = {}
    for r in sorted(df.collect(), key=lambda r: (r.query_id, r.rank)):
        out.setdefault(r.query_id, []).append((r.vec_id, r.score))
        assert r.rank == len(out[r.query_id])
    return out


@pytest.mark.parametrize("k", [1, 10])
def test_exact_top_k(table, k):
    df, m = table
    got = grouped(topk.top_k(df, df.filter("vec_id % 10 = 0"), k))
    ids = [*range(600), 1050]
    rows = np.vstack([m, np.zeros((1, 16), dtype=np.float32)])
    whole = brute.integers(rows)
    want = brute.nearest(ids, whole, [i for i in ids if i % 10 == 0], k, lambda q, c: c @ q)
    assert {q: got[q] for q in want} == want
    assert set(got) == set(want)  # 1060 has no vector of its length to be compared with


def test_top_k_with_few_candidates_and_none(spark):
    df = spark.createDataFrame([(0, [1.0, 0.0]), (1, [0.5, 0.5]), (2, [0.5, 0.5])], "vec_id long, embedding array<double>")
    assert grouped(topk.top_k(df, df, 10))[0] == [(1, 512 * 1024), (2, 512 * 1024)]
    none = df.limit(0)
    assert topk.top_k(none, none, 10).count() == 0
    one = df.filter("vec_id = 0")
    assert topk.top_k(one, one, 10).count() == 0
    assert ann.nearest(none, none, 3).count() == 0 and ann.nearest(one, one, 3).count() == 0


def test_doubled_rows_in_several_blocks_of_queries(spark, scratch):
    rng = np.random.default_rng(6)
    m = rng.standard_normal((400, 8)).astype(np.float32)
    rows = [(100 * i, m[i].tolist()) for i in range(400) for _ in range(2)]
    path = f"{scratch}/embeddings.parquet"
    spark.createDataFrame(rows, "vec_id long, embedding array<float>").coalesce(1).write.parquet(path)
    df = spark.read.parquet(path)
    got = sorted(tuple(r) for r in queries.op3_exact_topk(spark, scratch).collect())
    con = duckdb.connect()
    con.execute(f"CREATE VIEW embeddings AS SELECT * FROM '{path}/*.parquet'")
    assert got == sorted(con.execute(queries.ORACLE["op3_exact_topk"]).fetchall())
    asked = vectors.blocks(vectors.gathered(df, 256), "queries", "vec_id", "embedding")
    assert asked.count() == asked.select("block").distinct().count() > 1
    near = {}
    for r in ann.nearest(df, df, 10).collect():
        near.setdefault(r.query_id, []).append(r.vec_id)
    exact = brute.nearest(list(range(400)), m.astype(float), list(range(400)), 10, lambda q, c: c @ q)
    hit = [len(set(near[100 * q]) & {100 * i for i, _ in exact[q][:3]}) / 3 for q in exact]
    assert np.mean(hit) >= 0.9


def test_large_scores_stay_exact():
    q, c = np.array([[2.0 ** 27 + 1, 1.0]]), np.array([[2.0 ** 27 - 1, 3.0]])
    assert topk.scores(q, c)[0, 0] == (2 ** 27 + 1) * (2 ** 27 - 1) + 3
    assert topk.scores(q * 2.0 ** 20, c * 2.0 ** 20)[0, 0] == (1 << 62) - 2  # held to the bound
    rng = np.random.default_rng(1)
    q, c = (np.floor(rng.standard_normal((n, 5)) * 1000) for n in (7, 9))
    q[2] *= 2.0 ** 40
    c[[1, 5]] *= 2.0 ** 45
    c[5] = 0
    c[5, 3], q[2, 3] = 2.0 ** 60, 1.0
    held = lambda x: max(2 - (1 << 62), min((1 << 62) - 2, x))
    assert topk.scores(q, c).tolist() == [[held(sum(int(x) * int(y) for x, y in zip(a, b))) for b in c] for a in q]


def test_a_row_of_huge_components_costs_no_other_row(spark):
    rng = np.random.default_rng(17)
    m = rng.standard_normal((300, 8))
    rows = [(i, m[i].tolist()) for i in range(300)] + [(1000, [1e200] + [0.0] * 7), (1001, [-1.7e308] * 8)]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    asked = df.filter("vec_id % 20 = 0")
    got = grouped(topk.top_k(df, asked, 5))
    whole = brute.integers(m)
    want = brute.nearest(list(range(300)), whole, list(range(0, 300, 20)), 300, lambda q, c: c @ q)
    for q, best in want.items():
        far = [(i, (1 << 62) - 2) for i, s in ((1000, m[q][0]), (1001, -m[q].sum())) if s > 0]
        assert got[q] == (far + best)[:5]
    assert set(got) == {*want, 1000}
    near = grouped(ann.nearest(df, asked, 5))
    assert set(near) == set(got) and not any(np.isnan(s) for best in near.values() for _, s in best)
    every = np.array([v for _, v in rows], dtype=np.longdouble)  # a wider range than doubles have
    ids = [i for i, _ in rows]
    exact = {q: [ids[j] for j in np.argsort(-(every @ every[j]), kind="stable") if ids[j] != q][:5] for j, q in enumerate(ids) if q in near}
    assert np.mean([len({i for i, _ in near[q]} & set(exact[q])) / 5 for q in near]) >= 0.9


def test_forest_recall_order_and_scores(table):
    df, m = table
    got = grouped(ann.nearest(df, df.filter("vec_id % 10 = 0"), 10))
    ids = list(range(600))
    want = brute.nearest(ids, m.astype(float), [i for i in ids if i % 10 == 0], 10, lambda q, c: c @ q)
    assert set(want) <= set(got) and 1050 not in got
    hit = [len({i for i, _ in got[q]} & {i for i, _ in want[q]}) / 10 for q in want]
    assert np.mean(hit) >= 0.9
    for q, found in got.items():
        if q in want:
            assert found == sorted(found, key=lambda x: (-x[1], x[0]))
            assert all(abs(s - float(m[i].astype(float) @ m[q].astype(float))) < 1e-12 for i, s in found)


def test_forest_finds_longest_inner_products_of_uneven_vectors(spark):
    rng = np.random.default_rng(5)
    m = rng.standard_normal((400, 12)) * rng.uniform(0.2, 3.0, (400, 1))
    df = spark.createDataFrame([(i, m[i].tolist()) for i in range(400)], "vec_id long, embedding array<double>")
    got = grouped(ann.nearest(df, df.filter("vec_id % 20 = 0"), 5))
    want = brute.nearest(list(range(400)), m, list(range(0, 400, 20)), 5, lambda q, c: c @ q)
    assert np.mean([len({i for i, _ in got[q]} & {i for i, _ in want[q]}) / 5 for q in want]) >= 0.9


@pytest.mark.parametrize("n", [5, 15, 20, 21])
def test_forest_finds_all_candidates_of_small_tables(spark, n):
    m = np.random.default_rng(n).standard_normal((n, 16))
    df = spark.createDataFrame([(i, m[i].tolist()) for i in range(n)], "vec_id long, embedding array<double>")
    got = grouped(ann.nearest(df, df, 20))
    assert {q: {i for i, _ in found} for q, found in got.items()} == {q: set(range(n)) - {q} for q in range(n)}


def test_forest_finds_all_candidates_of_a_rare_length(spark):
    rng = np.random.default_rng(12)
    rows = [(i, rng.standard_normal(16).tolist()) for i in range(600)] + [(1000 + i, rng.standard_normal(24).tolist()) for i in range(14)]
    df = spark.createDataFrame([*rows, rows[-1]], "vec_id long, embedding array<double>")  # the last one twice
    got = grouped(ann.nearest(df, df.filter("vec_id % 3 = 0 OR vec_id >= 1000"), 14))
    for q in range(1000, 1013):
        assert sorted(i for i, _ in got[q]) == sorted([*(i for i in range(1000, 1014) if i != q), 1013])


def test_forest_measures_on_usable_queries(spark):
    rng = np.random.default_rng(14)
    m = rng.standard_normal((500, 16))
    df = spark.createDataFrame([(i, m[i].tolist()) for i in range(500)], "vec_id long, embedding array<double>")
    bad = [None, [0.0] * 16, [float("nan")] * 16, [float("inf")] * 16, [None] * 16, [], [1.0, 2.0]]
    asked = df.filter("vec_id % 100 = 0").unionByName(spark.createDataFrame([(1000 + i, bad[i % 7]) for i in range(7000)], df.schema))
    got = grouped(ann.nearest(df, asked, 10))
    want = brute.nearest(list(range(500)), m, list(range(0, 500, 100)), 10, lambda q, c: c @ q)
    assert set(got) == set(want)
    assert np.mean([len({i for i, _ in got[q]} & {i for i, _ in want[q]}) / 10 for q in want]) >= 0.9


def test_descent_and_ascent_count_prefixes():
    rng = np.random.default_rng(8)
    c = rng.standard_normal((50, 4))
    f = ann.Forest(c, float(np.linalg.norm(c, axis=1).max()))
    q = ann.strings(c[:3], None)
    own = ann.strings(c, float(np.linalg.norm(c, axis=1).max()))
    for i in range(3):
        for depth in (0, 1, 3, 32):
            want = sum(int(((own[t] >> (32 - depth)) == (q[t][i] >> (32 - depth))).sum()) for t in range(ann.TREES))
            assert f.counts(q)[i, depth] == want
