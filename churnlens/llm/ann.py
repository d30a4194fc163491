"""Approximate nearest neighbours with a hash-prefix forest.

Every tree hashes a vector to a string of ``LENGTH`` bits (the signs of its products with random directions) and keeps
the strings of a block of rows as a sorted array.  A query descends each tree to its longest prefix match; then all
trees ascend together, one bit at a time, until the prefixes at that depth hold enough candidates.  Rows with a common
prefix are a range of each sorted array, so descent and ascent are binary searches.  Blocks of rows count alone; the
depth of a query is taken from the sum over all blocks, as if each tree were one array.  A query with no more than k
candidates ascends to the top, where every row is.

How many candidates are enough is measured: for a bounded sample of usable queries the exact neighbours are found by brute
force, and the fewest candidates that reach ``RECALL`` on them are taken.  Every row is indexed.  Candidates are scored
exactly, on the vectors as given.

Signs see angles only, so rows get one more component that makes all their lengths equal (the query's is 0): the
largest inner product is then the smallest angle.

Defined results: vectors that are null, empty, zero or hold null or non-finite components take no part, nor do rows
without an id; vectors of different length are not compared; a query is not compared with rows of its own id; a query
with fewer candidates than k gets all; ties go to the smaller id; a product beyond the range of doubles is infinite.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from churnlens.llm.textops import saved
from churnlens.llm.topk import _pairs, ranked
from churnlens.llm.vectors import blocks, cells, gathered, matrix

TREES, LENGTH = 48, 32
RECALL = 0.95
SAMPLE = 128  # queries that the number of candidates is measured on, at most
_QUERIES = 256
_GRID = 2.0 ** (1 / 4)
_LONGEST = float(np.finfo(np.float64).max)


def directions(dim: int, seed: int = 11) -> np.ndarray:
    """The random directions of all trees, for vectors with the added component."""
    return np.random.Generator(np.random.PCG64([seed, dim])).standard_normal((dim + 1, TREES * LENGTH))


def _size(m: np.ndarray) -> tuple[float, float]:
    """(the largest absolute component, the largest length in units of it): lengths whose squares no double holds."""
    unit = float(np.abs(m).max(initial=0.0))
    return unit, float(np.sqrt(((m / unit) ** 2).sum(axis=1)).max()) if unit else 0.0


def strings(m: np.ndarray, length: float | None) -> np.ndarray:
    """(tree, row) hash strings as integers; ``length`` is the longest row's, None for queries.

    Rows are divided by that length, queries by their own largest component: signs stay, squares can't overflow.
    """
    if length is None:
        m = m / np.maximum(np.abs(m).max(axis=1, initial=0.0), np.finfo(np.float64).tiny)[:, None]
    elif length:
        m, length = m / length, 1.0
    extra = np.zeros(len(m)) if length is None else np.sqrt(np.maximum(length ** 2 - (m * m).sum(axis=1), 0.0))
    signs = np.column_stack([m, extra]) @ directions(m.shape[1]) > 0
    packed = np.packbits(signs.reshape(len(m), TREES, LENGTH), axis=2)
    return np.ascontiguousarray(packed).view(">u4").astype(np.int64)[:, :, 0].T


class Forest:
    """The trees of one block of rows."""

    def __init__(self, m: np.ndarray, length: float):
        found = strings(m, length)
        self.order = np.argsort(found, axis=1, kind="stable")
        self.sorted = np.take_along_axis(found, self.order, axis=1)

    def ranges(self, tree: int, q: np.ndarray, depth: np.ndarray | int) -> tuple[np.ndarray, np.ndarray]:
        """The range of rows that share ``depth`` bits with each query string."""
        drop = LENGTH - depth
        low = (q >> drop) << drop
        return np.searchsorted(self.sorted[tree], low), np.searchsorted(self.sorted[tree], low + (np.int64(1) << drop))

    def counts(self, q: np.ndarray) -> np.ndarray:
        """(query, depth): rows that share at least that many bits, summed over trees."""
        out = np.zeros((q.shape[1], LENGTH + 1), dtype=np.int64)
        for t in range(TREES):
            for depth in range(LENGTH + 1):
                a, b = self.ranges(t, q[t], depth)
                out[:, depth] += b - a
        return out


def _products(c: np.ndarray, q: np.ndarray) -> np.ndarray:
    """Inner products row by row: equal rows give equal values wherever they stand.  Where a sum leaves the range of
    doubles, the sign of the product of the scaled vectors decides which infinity it is."""
    with np.errstate(over="ignore", invalid="ignore"):
        out = (c * q).sum(axis=1)
        out_of_range = ~np.isfinite(out)
        if out_of_range.any():
            units = np.abs(c[out_of_range]).max(axis=1), np.abs(q).max()
            out[out_of_range] = ((c[out_of_range] / units[0][:, None]) * (q / units[1])).sum(axis=1) * units[0] * units[1]
    return out


def _best(ids: np.ndarray, score: np.ndarray, k: int) -> np.ndarray:
    if len(ids) > 4 * k:
        kth = np.partition(score, len(score) - k)[len(score) - k]
        some = np.flatnonzero(score >= kth)
        return some[np.lexsort((ids[some], -score[some]))[:k]]
    return np.lexsort((ids, -score))[:k]


def _measure(asked: DataFrame, rows: DataFrame, k: int, length: float, recall: float) -> float:
    """The fewest candidates (summed over trees) that reach ``recall`` on the sampled queries; infinite if none has any."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for row in cells(batches):
            qi, q = matrix(row["q_ids"], row["q_data"], row["dim"])
            ci, c = matrix(row["ids"], row["data"], row["dim"])
            qs, cs = strings(q, None), strings(c, length)
            counts = Forest(c, length).counts(qs)
            depth = np.zeros((len(qi), len(ci)), dtype=np.int64)
            for t in range(TREES):
                apart = qs[t][:, None] ^ cs[t][None, :]
                depth = np.maximum(depth, LENGTH - np.frexp(apart.astype(np.float64))[1])
            out = []
            for i, d in enumerate(qi.tolist()):
                other = np.flatnonzero(ci != d)
                score = _products(c[other], q[i])
                for j in _best(ci[other], score, k).tolist():
                    out.append((d, -1, 0, int(ci[other[j]]), float(score[j]), int(depth[i, other[j]])))
                out += [(d, x, int(n), 0, 0.0, 0) for x, n in enumerate(counts[i])]
            cols = list(zip(*out)) if out else [[]] * 6
            kinds = [pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.float64(), pa.int32()]
            yield pa.RecordBatch.from_arrays([pa.array(x, t) for x, t in zip(cols, kinds)], names=["query_id", "x", "n", "vec_id", "score", "depth"])

    got = saved(_pairs(asked, rows).mapInArrow(run, "query_id long, x int, n long, vec_id long, score double, depth int"), "measured")
    counts = got.filter("x >= 0").groupBy("query_id", "x").agg(F.sum("n").alias("n")).collect()  # SAMPLE * (LENGTH + 1) rows
    top = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    best = got.filter("x < 0").withColumn("r", F.row_number().over(top)).filter(F.col("r") <= k).select("query_id", "depth").collect()  # SAMPLE * k rows
    table, depths = {}, {}
    for r in counts:
        table.setdefault(r.query_id, np.zeros(LENGTH + 1, dtype=np.int64))[r.x] = r.n
    for r in best:
        depths.setdefault(r.query_id, []).append(r.depth)
    if not depths:
        return math.inf  # nothing to measure: all candidates
    enough = float(k)
    while True:
        hit = []
        for d, held in depths.items():
            at = _depth(table[d], enough)
            hit.append(np.mean([x >= at for x in held]))
        if np.mean(hit) >= recall or enough > max(c[0] for c in table.values()):
            return int(enough)
        enough *= _GRID


def _depth(counts: np.ndarray, enough: float) -> int:
    """The deepest level at which the trees together hold enough candidates."""
    level = np.flatnonzero(counts >= enough)
    return int(level[-1]) if len(level) else 0


def _taken(vector: str) -> Column:
    """Whether ``blocks`` takes a vector: finite components, not all of them zero."""
    finite = F.forall(vector, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    return finite & F.exists(vector, lambda x: x != 0)


def nearest(vectors: DataFrame, queries: DataFrame, k: int, key: str = "vec_id", vector: str = "embedding", recall: float = RECALL) -> DataFrame:
    """(query_id, rank, vec_id, score): the k nearest found of each row of ``queries`` among all rows of ``vectors``."""
    rows = blocks(vectors, "rows", key, vector, keep_zero=False)
    asked = blocks(gathered(queries, _QUERIES), "queries", key, vector, keep_zero=False)
    met = queries.join(F.broadcast(rows.select(F.col("dim").alias("__dim")).distinct()), F.size(vector) == F.col("__dim"), "left_semi")
    fit = met.filter(F.col(key).isNotNull() & _taken(vector)).orderBy(F.xxhash64(key), key).limit(SAMPLE)
    sampled = blocks(fit.repartition(1), "sampled", key, vector, keep_zero=False)
    name = [F.col("block").alias("q_block"), "dim", F.col("ids").alias("q_ids"), F.col("data").alias("q_data")]
    asked, sampled = asked.select(*name), sampled.select(*name)

    def longest(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for row in cells(batches):
            unit, times = _size(np.frombuffer(row["data"], dtype=np.float64).reshape(-1, row["dim"]))
            yield pa.RecordBatch.from_arrays([pa.array([min(unit * times, _LONGEST)])], names=["m"])

    length = rows.select("dim", "data").mapInArrow(longest, "m double").agg(F.max("m")).first()[0] or 0.0
    enough = _measure(sampled, rows, k, length, recall)

    def descend(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for row in cells(batches):
            qi, q = matrix(row["q_ids"], row["q_data"], row["dim"])
            ci, c = matrix(row["ids"], row["data"], row["dim"])
            counts = Forest(c, length).counts(strings(q, None))
            n = np.diff(counts[:, ::-1], prepend=0, axis=1)[:, ::-1]  # rows at exactly that depth
            own = np.sort(ci)
            n = np.column_stack([n, np.searchsorted(own, qi, side="right") - np.searchsorted(own, qi)])  # and rows of the query's id
            a, x = np.nonzero(n)
            yield pa.RecordBatch.from_arrays([pa.array(np.full(len(a), row["q_block"])), pa.array(a, pa.int32()), pa.array(x, pa.int32()), pa.array(n[a, x])],
                                             names=["q_block", "q", "x", "n"])

    counted = _pairs(asked, rows).mapInArrow(descend, "q_block long, q int, x int, n long").groupBy("q_block", "q", "x").agg(F.sum("n").alias("n"))

    def ascend(key_, left: pa.Table, right: pa.Table) -> pa.Table:
        out = []
        for row in left.to_pylist():
            table = np.zeros((len(row["q_ids"]) // 8, LENGTH + 2), dtype=np.int64)
            table[right.column("q").to_numpy(), right.column("x").to_numpy()] = right.column("n").to_numpy()
            table, own = np.cumsum(table[:, -2::-1], axis=1)[:, ::-1], table[:, -1]
            depth = np.array([_depth(c, enough) for c in table], dtype=np.int64)
            depth[table[:, 0] // TREES - own <= k] = 0  # no more candidates than asked for: all of them
            out.append((row["q_block"], depth.tobytes()))
        cols = list(zip(*out)) if out else [[], []]
        return pa.table([pa.array(cols[0], pa.int64()), pa.array(cols[1], pa.binary())], names=["q_block", "depth"])

    depth = saved(asked.select("q_block", "q_ids").groupBy("q_block").cogroup(counted.groupBy("q_block")).applyInArrow(ascend, "q_block long, depth binary"), "depth")

    def collect(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for row in cells(batches):
            qi, q = matrix(row["q_ids"], row["q_data"], row["dim"])
            ci, c = matrix(row["ids"], row["data"], row["dim"])
            at = np.frombuffer(row["depth"], dtype=np.int64)
            forest, qs = Forest(c, length), strings(q, None)
            bounds = [forest.ranges(t, qs[t], at) for t in range(TREES)]
            out = [[], [], []]
            for i, d in enumerate(qi.tolist()):
                found = np.zeros(len(ci), dtype=bool)
                for t, (a, b) in enumerate(bounds):
                    found[forest.order[t, a[i]:b[i]]] = True
                some = np.flatnonzero(found & (ci != d))
                if len(some):
                    score = _products(c[some], q[i])
                    best = _best(ci[some], score, k)
                    out[0].append(np.full(len(best), d))
                    out[1].append(ci[some[best]])
                    out[2].append(score[best])
            cols = [np.concatenate(x) if x else np.zeros(0, dtype=t) for x, t in zip(out, (np.int64, np.int64, np.float64))]
            yield pa.RecordBatch.from_arrays([pa.array(x) for x in cols], names=["query_id", "vec_id", "score"])

    found = _pairs(asked.join(depth, "q_block"), rows).mapInArrow(collect, "query_id long, vec_id long, score double")
    return ranked(found, k)
