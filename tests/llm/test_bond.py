"""Hard negatives against brute force."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from churnlens.llm import bond

SCHEMA = "vec_id long, embedding array<float>, label int, rank string, score string"


def brute(rows, is_anchor, positives=5, negatives=5, low=80, high=100, scale=256):
    v = [(i, y, [int(np.floor(scale * float(x))) for x in e]) for i, e, y in rows
         if i is not None and y is not None and e and all(x is not None and np.isfinite(x) for x in e)]
    out = []
    for i, y, e in v:
        if not is_anchor(i):
            continue
        scored = sorted((-sum(a * b for a, b in zip(e, f)), j, z) for j, z, f in v if j != i and len(f) == len(e))
        for p, j, _ in [s for s in scored if s[2] == y][:positives]:
            fit = [(j2, -s) for s, j2, z in scored if z != y and low * -p <= 100 * -s <= high * -p][:negatives]
            out += [(i, j, r, k, -p, s) for r, (k, s) in enumerate(fit, 1)]
    return sorted(out)


def mined(df, **k):
    return sorted(map(tuple, bond.hard_negatives(df, F.col("vec_id") % 10 == 0, F.col("label"), **k).collect()))


@pytest.fixture(scope="module")
def rows():
    rng = np.random.default_rng(8)
    m = rng.standard_normal((500, 16)) + rng.standard_normal(16)
    m = (m / np.linalg.norm(m, axis=1, keepdims=True)).astype(np.float32)
    m[100:280] = m[100]  # a third of the rows are one vector
    labels = rng.integers(0, 4, 500)
    labels[100:200] = 1
    out = [(i, m[i].tolist(), int(labels[i])) for i in range(500)]
    out += [(1000, None, 1), (1010, m[0].tolist(), None), (1020, [None] * 16, 1), (1030, [float("nan")] * 16, 1), (1040, [float("inf")] * 16, 1),
            (1050, [], 1), (None, m[0].tolist(), 1), (1060, [1.0, 2.0], 1), (1061, [1.0, 2.0], 1), (1062, [1.0, 1.5], 2), (1070, [0.0] * 16, 9)]
    out += [(2001, m[3].tolist(), 2)] * 3  # repeated rows
    return out


def frame(spark, rows, parts=5):
    return spark.createDataFrame([(*r, "clash", "clash") for r in rows], SCHEMA).repartition(parts)


@pytest.mark.parametrize("block", [64, 4096])
def test_equals_brute_force(spark, rows, block, monkeypatch):
    monkeypatch.setattr(bond, "BLOCK", block)
    monkeypatch.setattr(bond, "ANCHORS", 16)
    assert mined(frame(spark, rows)) == brute(rows, lambda i: i % 10 == 0)


def test_other_windows_and_counts(spark, rows):
    some = {"positives": 2, "negatives": 7, "low": 50, "high": 90, "scale": 1024.0}
    assert mined(frame(spark, rows), **some) == brute(rows, lambda i: i % 10 == 0, 2, 7, 50, 90, 1024)


def test_repeated_anchors_are_reported_twice(spark):
    rows = [(0, [1.0, 0.5], 1), (0, [1.0, 0.5], 1), (1, [1.0, 0.25], 1), (2, [0.9, 0.25], 2), (3, [0.9, 0.25], 2)]
    got = mined(frame(spark, rows))
    assert got == brute(rows, lambda i: i % 10 == 0) and len(got) == 4


def test_large_components_do_not_overflow(spark):
    big = 3e30
    rows = [(0, [big, 1.0], 1), (1, [big, 2.0], 1), (2, [big, 1.0], 2), (3, [-big, 1.0], 2), (10, [3e6, 3e6], 3), (11, [3e6, 3e6], 3), (12, [2.5e6, 3e6], 4)]
    got = mined(frame(spark, rows))
    most = (1 << 63) - 1
    assert [r for r in got if r[0] == 0] == [(0, 1, n, i, most, most) for n, i in enumerate((2, 10, 11, 12), 1)]
    assert (10, 11, 1, 12, (768 * 10 ** 6) ** 2 * 2, 768 * 10 ** 6 * 1408 * 10 ** 6) in got


def test_no_rows_and_no_anchors(spark, rows):
    none = frame(spark, rows[:1]).limit(0)
    assert mined(none) == []
    assert mined(frame(spark, [(1, [1.0], 1), (2, [1.0], 2)])) == []


def test_nothing_is_broadcast(spark, rows, monkeypatch):
    """What is broadcast passes through the driver; it grew with anchors times blocks of rows."""
    monkeypatch.setattr(bond, "BLOCK", 64)
    monkeypatch.setattr(bond, "ANCHORS", 16)
    key = "spark.sql.maxBroadcastTableSize"
    held = spark.conf.get(key)
    spark.conf.set(key, "1")
    try:
        assert mined(frame(spark, rows)) == brute(rows, lambda i: i % 10 == 0)
    finally:
        spark.conf.set(key, held)


@pytest.mark.parametrize("tasks, shared, blocks, scale", [(1, 100, 1, 256.0), (1, 2, 64, 2.0 ** 20), (3, 1, 2, 2.0 ** 27)])
def test_tasks_of_many_blocks(spark, rows, monkeypatch, tasks, shared, blocks, scale):
    """Rows of later blocks against the best of earlier ones; scores in single and double precision and in 64-bit integers."""
    for name, value in (("BLOCK", 32), ("ANCHORS", 16), ("_STEP", 3), ("_TASKS", tasks), ("_SHARED", shared), ("_HELD_BLOCKS", blocks)):
        monkeypatch.setattr(bond, name, value)
    assert mined(frame(spark, rows), scale=scale) == brute(rows, lambda i: i % 10 == 0, scale=scale)


@pytest.mark.parametrize("scale, kind", [(256.0, np.float32), (2.0 ** 20, np.float64), (2.0 ** 27, np.int64), (2.0 ** 40, object)])
def test_scan_is_exact(scale, kind):
    """Pairs that leave early have no place among the first; all others have exact scores."""
    rng = np.random.default_rng(5)
    m = rng.standard_normal((300, 16)) * np.geomspace(1, 0.01, 16)
    x = bond._whole(m / np.linalg.norm(m, axis=1, keepdims=True), scale)
    scan = bond.Scan(np.arange(300), np.zeros(300, dtype=np.int64), x.T)
    q, ids = x[:20], np.arange(20)
    assert scan.exact(q)[0] is kind
    want = np.array([[min(max(sum(int(a) * int(b) for a, b in zip(p, r)), -2 ** 63), 2 ** 63 - 1) for r in x] for p in q], dtype=np.int64)
    for k in (0, 5):
        best = bond.Best([[(-2 ** 63, 2 ** 63 - 1, 0)]] * 20, 5)
        i, j, score = scan.run(q, *best.span(ids), lambda i, j: j != i, best.thin, k)
        assert (score == want[i, j]).all() and len(i) < 20 * 299
        best.add(i, j, score)
        found = sorted(best.rows())
        assert found == sorted((n, 0, *c) for n in range(20) for c in sorted(((int(c), int(s)) for c, s in enumerate(want[n]) if c != n), key=lambda c: (-c[1], c[0]))[:5])
