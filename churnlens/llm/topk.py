"""Exact top-k search by distributed histogram selection.

Vectors become integers (floor(scale * x)) and the score is their integer inner product.  Everything is scored, a
block of queries against a block of candidates at a time, and never stored.  Each round counts the scores of every
query in ``BINS`` bins of its present range; the global histogram tells which bin holds the k-th highest score, and
that bin is the next range, until it is one value wide.  A block reports bins from its highest score down to its own
k-th, since the global k-th cannot be lower.  A last pass keeps the scores from the k-th value up, and of equal ones
at most the k smallest ids of each block, and ranks what is left.

Defined results: vectors that are null, empty or hold null or non-finite components take no part, nor do rows without
an id; vectors of different length are not compared; a query is not compared with rows of its own id; a query with
fewer candidates than k gets all; ties go to the smaller id; repeated rows are candidates of their own; a score beyond
2**62 - 2 either way counts as that bound (components that large are multiplied in integers of any width).
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from churnlens.llm.textops import saved
from churnlens.llm.vectors import blocks, cells, gathered, matrix

BINS = 2048
_QUERIES = 256  # queries of a block
_SALTS = 16
_FAR = 1 << 62
_HUGE = float(np.finfo(np.float64).max)


def scores(q: np.ndarray, c: np.ndarray) -> np.ndarray:
    """Integer inner products, exact: in doubles while no partial sum can leave 2**53, in 64-bit integers below 2**62,
    else, for the rows that are too large, in integers of any width, held to the bound."""
    bound = np.abs(q).max(initial=0) * np.abs(c).max(initial=0) * q.shape[1] if q.size and c.size else 0.0
    if bound < 2 ** 53:
        return (q @ c.T).astype(np.int64)
    if bound < 2 ** 62:
        return np.einsum("ij,kj->ik", q.astype(np.int64), c.astype(np.int64))
    most = (2.0 ** 61 / q.shape[1]) ** 0.5
    large_q, large_c = (np.abs(x).max(axis=1) >= most for x in (q, c))
    out = np.empty((len(q), len(c)), dtype=np.int64)
    out[np.ix_(~large_q, ~large_c)] = scores(q[~large_q], c[~large_c])
    out[large_q] = _wide(q[large_q], c)
    out[np.ix_(~large_q, large_c)] = _wide(q[~large_q], c[large_c])
    return out


def _wide(q: np.ndarray, c: np.ndarray) -> np.ndarray:
    """Products in Python integers, a row of ``q`` at a time."""
    whole = np.vectorize(int, otypes=[object])
    out = np.empty((len(q), len(c)), dtype=np.int64)
    if out.size:
        other = whole(c)
        for i, row in enumerate(whole(q)):
            out[i] = np.clip(other @ row, 2 - _FAR, _FAR - 2).astype(np.int64)
    return out


def _scored(row: dict, scale: float) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(query ids, candidate ids, scores with the lowest value where the ids are equal)."""
    qi, q = matrix(row["q_ids"], row["q_data"], row["dim"])
    ci, c = matrix(row["ids"], row["data"], row["dim"])
    with np.errstate(over="ignore"):
        s = scores(*(np.clip(np.floor(m * scale), -_HUGE, _HUGE) for m in (q, c)))
    s[qi[:, None] == ci[None, :]] = -_FAR
    return qi, ci, s


def top_k(vectors: DataFrame, queries: DataFrame, k: int, scale: float = 1024.0, key: str = "vec_id", vector: str = "embedding") -> DataFrame:
    """(query_id, rank, vec_id, score): the k highest scores of each row of ``queries`` over all rows of ``vectors``."""
    candidates = blocks(vectors, "candidates", key, vector)
    asked = blocks(gathered(queries, _QUERIES), "queries", key, vector).select(
        F.col("block").alias("q_block"), "dim", F.col("ids").alias("q_ids"), F.col("data").alias("q_data"))

    def start(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for row in cells(batches):
            n = len(row["q_ids"]) // 8
            yield pa.RecordBatch.from_arrays([pa.array([row["q_block"]]), pa.array([np.full(n, -_FAR + 1).tobytes()], pa.binary()),
                                              pa.array([np.full(n, _FAR).tobytes()], pa.binary()), pa.array([np.full(n, k).tobytes()], pa.binary())],
                                             names=["q_block", "lo", "hi", "need"])

    def extremes(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Of each query and block: the k-th highest score (no bound where there are fewer) and the highest."""
        for row in cells(batches):
            qi, ci, s = _scored(row, scale)
            enough = (s != -_FAR).sum(axis=1) >= k
            kth = np.where(enough, np.partition(s, max(len(ci) - k, 0), axis=1)[:, max(len(ci) - k, 0)], -_FAR + 1)
            n = len(qi)
            yield pa.RecordBatch.from_arrays([pa.array(np.full(n, row["q_block"])), pa.array(np.arange(n), pa.int32()), pa.array(kth), pa.array(np.maximum(s.max(axis=1), -_FAR + 1))],
                                             names=["q_block", "q", "kth", "top"])

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for row in cells(batches):
            qi, ci, s = _scored(row, scale)
            lo, hi, need = (np.frombuffer(row[x], dtype=np.int64) for x in ("lo", "hi", "need"))
            width = (hi - lo) // BINS + 1
            got = [[], [], []]
            for i in range(len(qi)):
                inside = s[i][(s[i] >= lo[i]) & (s[i] <= hi[i])]
                if len(inside):
                    bins, n = np.unique((inside - lo[i]) // width[i], return_counts=True)
                    bins, n = bins[::-1], n[::-1]
                    most = int(np.searchsorted(np.cumsum(n), need[i])) + 1  # below, nothing can be among the needed
                    got[0].append(np.full(len(bins[:most]), i))
                    got[1].append(bins[:most])
                    got[2].append(n[:most])
            if got[0]:
                q, bins, n = (np.concatenate(x) for x in got)
                yield pa.RecordBatch.from_arrays([pa.array(np.full(len(q), row["q_block"])), pa.array(q, pa.int32()), pa.array(bins, pa.int64()), pa.array(n, pa.int64())],
                                                 names=["q_block", "q", "bin", "n"])

    def narrow(row: dict, q: np.ndarray, bins: np.ndarray, n: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """The next range of each query of a block from its histogram."""
        lo, hi, need = (np.frombuffer(row[x], dtype=np.int64).copy() for x in ("lo", "hi", "need"))
        width = (hi - lo) // BINS + 1
        order = np.lexsort((-bins, q))
        q, bins, n = q[order], bins[order], n[order]
        for i in range(len(lo)):
            a, b = np.searchsorted(q, i), np.searchsorted(q, i, side="right")
            total = np.cumsum(n[a:b])
            at = int(np.searchsorted(total, need[i]))
            if at == b - a:  # fewer candidates than asked for: all of them count
                lo[i] = hi[i] = -_FAR + 1
                continue
            need[i] -= total[at - 1] if at else 0
            lo[i] += bins[a + at] * width[i]
            hi[i] = min(hi[i], lo[i] + width[i] - 1)
        return lo, hi, need

    def narrowed(key_, left: pa.Table, right: pa.Table) -> pa.Table:
        out = []
        for row in left.to_pylist():
            lo, hi, need = narrow(row, *(right.column(c).to_numpy() for c in ("q", "bin", "n")))
            out.append((row["q_block"], lo.tobytes(), hi.tobytes(), need.tobytes(), int((hi - lo).max(initial=0))))
        cols = list(zip(*out)) if out else [[]] * 5
        return pa.table([pa.array(cols[0], pa.int64()), *(pa.array(c, pa.binary()) for c in cols[1:4]), pa.array(cols[4], pa.int64())],
                        names=["q_block", "lo", "hi", "need", "wide"])

    # The first range of a query: from the highest k-th score of a block up to the highest score.
    per_query = _pairs(asked, candidates).mapInArrow(extremes, "q_block long, q int, kth long, top long").groupBy("q_block", "q").agg(
        F.max("kth").alias("kth"), F.max("top").alias("top"))

    def opened(key_, left: pa.Table, right: pa.Table) -> pa.Table:
        out = []
        for row in left.to_pylist():
            lo, hi, need = (np.frombuffer(row[x], dtype=np.int64).copy() for x in ("lo", "hi", "need"))
            q = right.column("q").to_numpy()
            lo[q], hi[q] = right.column("kth").to_numpy(), right.column("top").to_numpy()
            out.append((row["q_block"], lo.tobytes(), hi.tobytes(), need.tobytes(), int((hi - lo).max(initial=0))))
        cols = list(zip(*out)) if out else [[]] * 5
        return pa.table([pa.array(cols[0], pa.int64()), *(pa.array(c, pa.binary()) for c in cols[1:4]), pa.array(cols[4], pa.int64())],
                        names=["q_block", "lo", "hi", "need", "wide"])

    shape = "q_block long, lo binary, hi binary, need binary, wide long"
    first = asked.mapInArrow(start, "q_block long, lo binary, hi binary, need binary")
    state = saved(first.groupBy("q_block").cogroup(per_query.groupBy("q_block")).applyInArrow(opened, shape), "state")
    while True:
        hist = _pairs(asked.join(state, "q_block"), candidates).mapInArrow(count, "q_block long, q int, bin long, n long")
        hist = hist.groupBy("q_block", "q", "bin").agg(F.sum("n").alias("n"))
        state = saved(state.drop("wide").groupBy("q_block").cogroup(hist.groupBy("q_block")).applyInArrow(narrowed, shape), "state")
        if not (state.agg(F.max("wide")).first()[0] or 0):
            break

    def take(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for row in cells(batches):
            qi, ci, s = _scored(row, scale)
            lo = np.frombuffer(row["lo"], dtype=np.int64)
            a, b = np.nonzero((s >= lo[:, None]) & (s != -_FAR))
            order = np.lexsort((ci[b], -s[a, b], a))
            a, b = a[order], b[order]
            new = np.flatnonzero(np.append(True, a[1:] != a[:-1])) if len(a) else a
            place = np.arange(len(a)) - np.repeat(new, np.diff(np.append(new, len(a))))
            a, b = a[place < k], b[place < k]
            yield pa.RecordBatch.from_arrays([pa.array(qi[a]), pa.array(ci[b]), pa.array(s[a, b])], names=["query_id", "vec_id", "score"])

    found = _pairs(asked.join(state.select("q_block", "lo"), "q_block"), candidates).mapInArrow(take, "query_id long, vec_id long, score long")
    return ranked(found, k)


def _pairs(asked: DataFrame, candidates: DataFrame) -> DataFrame:
    """Every block of queries with every block of candidates of the same dimension.

    The condition is written so that it isn't taken for a join key: all blocks have the same dimension, and one key is
    one task.
    """
    c = candidates.withColumnRenamed("dim", "c_dim")
    return c.crossJoin(asked).filter(F.abs(F.col("dim") - F.col("c_dim")) < 1).drop("c_dim")


def ranked(found: DataFrame, k: int) -> DataFrame:
    """The k best of each query: first of each of a few salts, then of what those leave (k * salts rows at most)."""
    order = [F.desc("score"), F.asc("vec_id")]
    salted = found.withColumn("__salt", F.pmod(F.xxhash64("vec_id"), F.lit(_SALTS)))
    near = salted.withColumn("rank", F.row_number().over(Window.partitionBy("query_id", "__salt").orderBy(*order))).filter(F.col("rank") <= k)
    best = near.drop("__salt", "rank").withColumn("rank", F.row_number().over(Window.partitionBy("query_id").orderBy(*order))).filter(F.col("rank") <= k)
    return best.select("query_id", "rank", "vec_id", "score")
