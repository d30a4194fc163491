"""Source mixing: targets, nested budgets, copies of one row, and the rows that are taken."""

import hashlib
from collections import defaultdict

import pytest

from churnlens.llm import mixing
from tests.llm.brute import WORD

SCHEMA = "doc_id long, source string, text string, size string, rest string"


def brute(rows, weights=(5.0, 2.0, 1.0), most=3):
    """Sorted (doc_id, size, source_size, target, taken) by the definition."""
    size = [len(WORD.findall(t or "")) for _, _, t in rows]
    total = defaultdict(int)
    for (_, s, _), n in zip(rows, size):
        total[s] += n
    names = sorted(total, key=lambda s: (s is None, (s or "").encode()))
    weight = {s: weights[i % len(weights)] for i, s in enumerate(names)}
    stopped = set()
    while True:
        free = [s for s in names if s not in stopped]
        level = (sum(total.values()) - sum(most * total[s] for s in stopped)) / sum(weight[s] for s in free) if free else 0.0
        more = {s for s in free if level * weight[s] >= most * total[s]}
        if not more:
            break
        stopped |= more
    target = {s: float(most * total[s]) if s in stopped else level * weight[s] for s in names}
    out = []
    for s in names:
        full = min(int(target[s] // total[s]), most) if total[s] else 0
        rest, before = target[s] - full * total[s], 0
        mine = [(hashlib.md5(f"{'' if i is None else i}:{t or ''}".encode()).hexdigest(), i, n) for (i, x, t), n in zip(rows, size) if x == s]
        for _, i, n in sorted(mine, key=lambda x: x[0]):
            more = n > 0 and 2 * (rest - before) >= n
            before += n
            out.append((i, n, total[s], round(target[s], 6), n * (full + more)))
    return sorted(out, key=str)


def result(df):
    return sorted(((r.doc_id, r.size, r.source_size, round(r.target, 6), r.taken) for r in df.collect()), key=str)


@pytest.fixture(scope="module")
def rows():
    out = [(i, f"s{i % 7}", " ".join(["word"] * (1 + i * 37 % 91))) for i in range(400)]
    out += [(1000, "hot", "one two three")] * 300  # a third of all rows are one row
    out += [(2000, None, "a b c"), (2001, None, None), (2002, "empty", ""), (2003, "empty", None), (None, "s1", "x y"), (None, None, "z")]
    out += [(3000, "long", "w " * 200_000), (3001, "é", "u v"), (3002, "z", "u\x0bv w")]
    return out


def frame(spark, rows, parts):
    return spark.createDataFrame([(*r, "clash", "keep") for r in rows], SCHEMA).repartition(parts)


def test_equals_the_definition(spark, rows):
    docs = frame(spark, rows, 7)
    got = mixing.mix(docs, mixing.cyclic_weights(docs), keep=("size", "rest")).cache()
    assert result(got) == brute(rows)
    assert {r.rest for r in got.select("rest").distinct().collect()} == {"keep"}
    for r in got.groupBy("source").agg({"taken": "sum", "target": "max", "size": "max"}).collect():
        assert abs(r["sum(taken)"] - r["max(target)"]) <= max(r["max(size)"], 1) / 2
    assert got.filter("taken > 3 * size").count() == 0


def test_reruns_and_partitions_agree(spark, rows):
    one, many = frame(spark, rows, 1), frame(spark, rows, 16)
    assert result(mixing.mix(one, mixing.cyclic_weights(one))) == result(mixing.mix(many, mixing.cyclic_weights(many)))


def test_larger_budgets_keep_what_smaller_ones_took(spark, rows):
    docs = frame(spark, rows[:400], 4)
    weights = mixing.cyclic_weights(docs)
    small = {r.doc_id: r.copies for r in mixing.mix(docs, weights, share=0.2).collect()}
    large = {r.doc_id: r.copies for r in mixing.mix(docs, weights, share=0.5).collect()}
    assert all(large[i] >= small[i] for i in small) and sum(large.values()) > sum(small.values())


def test_no_rows_no_words_and_a_missing_weight(spark):
    docs = frame(spark, [(1, "a", "x y"), (2, "b", "z")], 1)
    assert mixing.mix(docs.limit(0), mixing.cyclic_weights(docs.limit(0))).count() == 0
    blank = frame(spark, [(1, "a", ""), (2, None, None)], 1)
    assert result(mixing.mix(blank, mixing.cyclic_weights(blank))) == [(1, 0, 0, 0.0, 0), (2, 0, 0, 0.0, 0)]
    only = mixing.mix(docs, spark.createDataFrame([("a", 1.0)], "source string, weight double"))
    assert {(r.doc_id, r.target, r.taken) for r in only.collect()} == {(1, 3.0, 4), (2, 0.0, 0)}
