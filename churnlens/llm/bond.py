"""Hard-negative mining with a vertical scan of the vectors (branch and bound on dimensions).

Components become integers (floor(scale * x)) and a score is an integer inner product.  Rows are stored in blocks,
dimension by dimension, with the smallest and largest value of each.  A block reads its dimensions for a block of
anchors in the order of what they can add to a score, largest first, a few at a time.  What the unread dimensions can
still add lies between sums of these extremes, so every row has bounds for its score; rows that can't matter any more
leave the bitmap of candidates, and when few are left, the next dimensions are read for those only.

1. Positives: of the rows of the anchor's label a candidate leaves when ``positives`` others surely score higher.
2. Negatives: every positive with score p opens the window [low * p, high * p] for rows of other labels.  A candidate
   leaves when its bounds miss all windows of the anchor, or when each window that it can reach has ``negatives`` rows
   that surely lie in it and score higher.

What is left of a block has exact scores.  A task reads its blocks of rows one after another, each with all anchors that
it was given, and keeps the best ``positives`` rows an anchor, and ``negatives`` a window; rows of later blocks leave as
soon as they can't be better.  The best of these over all tasks are the result.  Anchors meet rows block by block; no
pair becomes a row but these.  Neither vectors nor results pass through the driver.

Defined results: rows without id or label, and vectors that are null, empty or hold null or non-finite components take no
part; vectors of different length are not compared; rows of the anchor's own id are not "other" rows; an anchor row
that occurs twice is reported twice; repeated rows are candidates of their own; ties go to the smaller id; an anchor
without positives, and a positive with an empty window, give no rows; scores beyond 64 bits count as the largest (or
smallest) of 64 bits; other columns are not read.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from churnlens.llm.textops import forget, saved, sized, small_batches
from churnlens.llm.vectors import usable

BLOCK = 4096  # rows of a block
ANCHORS = 256  # anchors of a block
_STEP = 8  # dimensions that are read before the next look at the bounds
_FEW = 1 / 16  # of the pairs: when no more are left, dimensions are read pair by pair
_SALTS = 16
_TASKS = 48  # tasks that the blocks of rows are dealt to, unless that makes more than ...
_SHARED = 8  # ... so many blocks a task
_HELD_BLOCKS, _HELD_BYTES = 64, 16 << 20  # blocks of anchors that a task is given, and their bytes
_MOST = (1 << 63) - 1


def _whole(m: np.ndarray, scale: float) -> np.ndarray:
    """floor(scale * x): 64-bit integers where a score is sure to fit them, else Python's integers."""
    x = np.floor(m * scale)
    top = float(np.abs(x).max(initial=0))
    if top < 2 ** 31 and top * top * m.shape[1] < 2 ** 62:
        return x.astype(np.int64)
    with np.errstate(over="ignore"):
        return np.array([[int(v) if np.isfinite(v) else int(w) * int(scale) for v, w in zip(a, b)] for a, b in zip(x, m)], dtype=object)


def _packed(x: np.ndarray, m: np.ndarray) -> tuple[str, bytes]:
    """(kind, data): whole components ``x`` of ``m`` dimension by dimension in few bytes; ``m`` itself where they are large."""
    if x.dtype == object:
        return "<f8", np.ascontiguousarray(m.T).tobytes()
    kind = "<i2" if x.min(initial=0) >= -2 ** 15 and x.max(initial=0) < 2 ** 15 else "<i4"
    return kind, np.ascontiguousarray(x.T.astype(kind)).tobytes()


def _opened(kind: str, data: bytes, dim: int, scale: float) -> np.ndarray:
    """Whole components, dimension by dimension."""
    x = np.frombuffer(data, dtype=kind).reshape(dim, -1)
    return _whole(x.T, scale).T if kind == "<f8" else x.astype(np.int64)


def _blocks(rows: DataFrame, each: int, scale: float, name: str) -> DataFrame:
    """(block, dim, ids, labels, kind, data): rows (k, label, v) packed by dimension of the vectors, ``each`` at most."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        task, made = TaskContext.get().partitionId(), 0
        for b in batches:
            for at, m in usable(b, "v"):
                k, y = (b.column(c).take(pa.array(at)).to_numpy() for c in ("k", "label"))
                for a in range(0, len(at), each):
                    part = slice(a, a + each)
                    kind, data = _packed(_whole(m[part], scale), m[part])
                    yield pa.RecordBatch.from_arrays(
                        [pa.array([(task << 32) + made]), pa.array([m.shape[1]], pa.int32()), pa.array([k[part].astype(np.int64).tobytes()], pa.binary()),
                         pa.array([y[part].astype(np.int64).tobytes()], pa.binary()), pa.array([kind]), pa.array([data], pa.binary())],
                        names=["block", "dim", "ids", "labels", "kind", "data"])
                    made += 1

    dealt = rows.repartition(sized(rows.count(), each))
    return saved(dealt.mapInArrow(run, "block long, dim int, ids binary, labels binary, kind string, data binary"), name)


def _meet(asked: DataFrame, rows: DataFrame, n_asked: int, n_rows: int) -> DataFrame:
    """Every block of rows with every block of anchors of the same dimension, row block by row block.

    A task is given some blocks of rows, of which it holds one at a time, and a part of the anchors that it can hold. It
    fetches both from the executors that dealt them out: nothing is copied for the pairs, and the driver sees no vector.
    """
    return rows.repartition(n_rows).join(asked.repartition(n_asked).hint("shuffle_replicate_nl"), "dim")


class Scan:
    """A block of rows, read dimension by dimension."""

    def __init__(self, ids: np.ndarray, labels: np.ndarray, columns: np.ndarray):
        self.ids, self.labels, self.columns = ids, labels, columns
        self.low, self.high = columns.min(axis=1), columns.max(axis=1)
        self.farthest = np.maximum(-self.low, self.high)
        self.parts: dict[int, Scan | None] = {}
        self.kinds: dict[type, tuple] = {}

    def of(self, label: int) -> Scan | None:
        """The rows of a label."""
        if label not in self.parts:
            at = np.flatnonzero(self.labels == label)
            self.parts[label] = Scan(self.ids[at], self.labels[at], self.columns[:, at]) if len(at) else None
        return self.parts[label]

    def exact(self, q: np.ndarray) -> tuple[type, int]:
        """(type that holds any sum of these products and three bounds of it exactly, bound)."""
        if q.dtype == object or self.columns.dtype == object:
            return object, 1 + int((np.abs(q).astype(object) @ self.farthest.astype(object)).max())
        reach = int((np.abs(q) @ self.farthest).max())
        for kind, bits in ((np.float32, 22), (np.float64, 51), (np.int64, 61)):
            if reach < 2 ** bits:
                return kind, 2 ** bits
        return object, 1 + reach

    def run(self, q: np.ndarray, floor: np.ndarray, ceil: np.ndarray, other, thin, k: int = 0) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(anchors, rows, exact scores) of the pairs that stay, by anchor.

        Scores below ``floor`` or above ``ceil`` of an anchor don't matter (their extremes: no bound), nor those below
        the ``k``-th of the block, if given.  ``other`` says which pairs count at all; ``thin`` is given anchors and
        lower and upper bounds of the pairs that are left and says which of them stay.
        """
        kind, most_of = self.exact(q)
        if kind not in self.kinds:
            self.kinds[kind] = tuple(x.astype(kind) for x in (self.columns, self.low, self.high))
        columns, low, high = self.kinds[kind]
        q, n = q.astype(kind), columns.shape[1]
        floor, ceil = (np.where(x == none, y, np.clip(x.astype(object) if kind is object else x, -most_of, most_of)).astype(kind)[:, None]
                       for x, none, y in ((floor, -_MOST - 1, -most_of), (ceil, _MOST, most_of)))
        order = np.argsort(-(np.abs(q).sum(axis=0) * (high - low)), kind="stable")
        ends = (q * low)[:, order], (q * high)[:, order]
        least, most = (x.sum(axis=1, keepdims=True) - np.cumsum(x, axis=1) for x in (np.minimum(*ends), np.maximum(*ends)))  # what the dimensions after each can add
        score, at = np.zeros((len(q), n), dtype=kind), 0
        counted = other(np.arange(len(q))[:, None], np.arange(n)[None, :]) if k and n > k else None
        while at < len(order):  # all pairs
            dims = order[at:at + _STEP]
            score += q[:, dims] @ columns[dims]
            at += len(dims)
            down, up = least[:, at - 1:at], most[:, at - 1:at]
            if counted is not None:
                bar = _kth_highest(np.where(counted, score, -most_of), k)[:, None] + down
                if kind is object:  # scores beyond 64 bits are equal
                    bar = np.where(bar <= -_MOST - 1, -most_of, np.minimum(bar, _MOST))
                floor = np.maximum(floor, bar)
            a, b = floor - up, ceil - down
            if at < len(order) and not ((score.min(axis=1, keepdims=True) < a) | (score.max(axis=1, keepdims=True) > b)).any():
                continue
            alive = (score >= a) & (score <= b)
            if at == len(order) or np.count_nonzero(alive) <= _FEW * alive.size:
                break
        i, j = np.nonzero(alive)
        score = score[i, j]
        stay = np.broadcast_to(other(i, j), len(i))
        while True:  # the pairs that are left
            i, j, score = i[stay], j[stay], score[stay]
            stay = thin(i, _held(score + least[i, at - 1]), _held(score + most[i, at - 1]))
            if at == len(order) or not stay.any():
                return i[stay], j[stay], _held(score[stay]).astype(np.int64)
            dims = order[at:at + _STEP]
            score = score + (q[i[:, None], dims] * columns[dims[None, :], j[:, None]]).sum(axis=1)
            at += len(dims)


def _held(x: np.ndarray) -> np.ndarray:
    """Python's integers held to 64 bits; others can't leave them."""
    return np.minimum(np.maximum(x, -_MOST - 1), _MOST).astype(np.int64) if x.dtype == object else x


def _kth_highest(x: np.ndarray, k: int) -> np.ndarray:
    return np.partition(x, x.shape[-1] - k)[..., x.shape[-1] - k]


def _first(ids: np.ndarray, score: np.ndarray, k: int) -> np.ndarray:
    return np.lexsort((ids, ~score))[:k]


class Best:
    """The best ``k`` rows so far of each window of some anchors; what is below ``bars`` can't be one of them."""

    def __init__(self, windows: list[list[tuple[int, int, int]]], k: int):
        """windows: (lowest score, highest score, name) of each anchor, one at least."""
        wide = max(map(len, windows))
        self.windows, self.k = windows, k
        self.bars = np.array([[w[0] for w in x] + [_MOST] * (wide - len(x)) for x in windows], dtype=np.int64)
        self.tops = np.array([[w[1] for w in x] + [-_MOST - 1] * (wide - len(x)) for x in windows], dtype=np.int64)
        self.held: dict[tuple[int, int], tuple[np.ndarray, np.ndarray]] = {}

    def span(self, anchors: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        return self.bars[anchors].min(axis=1), self.tops[anchors].max(axis=1)

    def thin(self, anchors: np.ndarray, lo: np.ndarray, hi: np.ndarray) -> np.ndarray:
        """Which pairs still reach a window, and may be one of the first ``k`` there."""
        stay = np.zeros(len(anchors), dtype=bool)
        for bars, tops in zip(self.bars.T, self.tops.T):
            stay |= (hi >= bars[anchors]) & (lo <= tops[anchors])
        for i, at in _runs(anchors, stay):
            if len(at) > self.k:
                l, h, some = lo[at], hi[at], np.zeros(len(at), dtype=bool)
                for a, b in zip(self.bars[i], self.tops[i]):
                    reach, sure = (h >= a) & (l <= b), l[(l >= a) & (h <= b)]
                    if len(sure) > self.k:
                        reach &= h >= _kth_highest(sure, self.k)
                    some |= reach
                stay[at] = some
        return stay

    def add(self, anchors: np.ndarray, ids: np.ndarray, score: np.ndarray) -> None:
        for i, at in _runs(anchors, np.ones(len(anchors), dtype=bool)):
            for w in range(len(self.windows[i])):
                new = at[(score[at] >= self.bars[i, w]) & (score[at] <= self.tops[i, w])]
                c, s = self.held.get((i, w), (ids[:0], score[:0]))
                if len(c) == self.k:
                    new = new[(score[new] > s[-1]) | (ids[new] < c[-1])]
                if len(new):
                    c, s = np.concatenate([c, ids[new]]), np.concatenate([s, score[new]])
                    best = _first(c, s, self.k)
                    self.held[i, w] = c[best], s[best]
                    if len(best) == self.k:
                        self.bars[i, w] = s[best[-1]]

    def rows(self) -> Iterator[tuple[int, int, int, int]]:
        """(anchor, name of the window, id, score)."""
        for (i, w), found in self.held.items():
            for c, s in zip(*(x.tolist() for x in found)):
                yield i, self.windows[i][w][2], c, s


def _runs(anchors: np.ndarray, stay: np.ndarray) -> Iterator[tuple[int, np.ndarray]]:
    """(anchor, its places) of the places that stay; ``anchors`` are sorted."""
    at = np.flatnonzero(stay)
    if len(at):
        cuts = np.flatnonzero(np.diff(anchors[at])) + 1
        for some in np.split(at, cuts):
            yield int(anchors[some[0]]), some


class Asked:
    """A block of anchors with the windows of each, and the best rows for them; anchors without a window are left out."""

    def __init__(self, row: dict, scale: float, windows: dict[int, list[tuple[int, int, int]]] | None, k: int):
        ids, labels = (np.frombuffer(row[c], dtype=np.int64) for c in ("q_ids", "q_labels"))
        self.at = np.arange(len(ids)) if windows is None else np.array(sorted(windows), dtype=np.int64)
        self.ids, self.labels = ids[self.at], labels[self.at]
        self.q = _opened(row["q_kind"], row["q_data"], row["dim"], scale).T[self.at]
        self.best = Best([[(-_MOST - 1, _MOST, 0)] if windows is None else windows[i] for i in self.at.tolist()], k) if len(self.at) else None

    def same_label(self, scan: Scan) -> None:
        for y in np.unique(self.labels).tolist():
            part, at = scan.of(y), np.flatnonzero(self.labels == y)
            if part:
                i, j, score = part.run(self.q[at], *self.best.span(at), lambda i, j: part.ids[j] != self.ids[at[i]],
                                       lambda i, lo, hi: self.best.thin(at[i], lo, hi), self.best.k)
                self.best.add(at[i], part.ids[j], score)

    def other_labels(self, scan: Scan) -> None:
        i, j, score = scan.run(self.q, *self.best.span(np.arange(len(self.at))),
                               lambda i, j: (scan.labels[j] != self.labels[i]) & (scan.ids[j] != self.ids[i]), self.best.thin)
        self.best.add(i, scan.ids[j], score)

    def found(self, q_block: int) -> list[tuple]:
        return [(q_block, int(self.at[i]), int(self.ids[i]), p, c, s) for i, p, c, s in self.best.rows()] if self.best else []


def _scanned(batches: Iterator[pa.RecordBatch], scale: float, asked, read) -> Iterator[pa.RecordBatch]:
    """The best rows of a task: ``read`` is given every block of anchors, which ``asked`` makes of its first row, and every block of rows."""
    made: dict[int, Asked] = {}
    block, scan = None, None
    for b in batches:
        for at in range(b.num_rows):
            def cell(name: str):
                return b.column(name)[at].as_py()
            if cell("block") != block:
                block, ids, labels = cell("block"), *(np.frombuffer(cell(c), dtype=np.int64) for c in ("ids", "labels"))
                scan = Scan(ids, labels, _opened(cell("kind"), cell("data"), cell("dim"), scale))
            if (q := cell("q_block")) not in made:
                made[q] = asked({n: cell(n) for n in b.schema.names if n not in ("ids", "labels", "data")})
            if made[q].best:
                read(made[q], scan)
    for q, x in made.items():
        yield _out(x.found(q), _FOUND)


def _out(rows: list[tuple], names: tuple[str, ...]) -> pa.RecordBatch:
    cols = list(zip(*rows)) if rows else [[] for _ in names]
    return pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in cols], names=list(names))


_FOUND = ("q_block", "q", "anchor_id", "p", "vec_id", "score")
_FOUND_SCHEMA = ", ".join(f"{c} long" for c in _FOUND)


def _best(found: DataFrame, by: list[str], k: int) -> DataFrame:
    """The first ``k`` by score, then id: of each of a few salts, then of what those leave."""
    order = [F.desc("score"), F.asc("vec_id")]
    salted = found.withColumn("__salt", F.pmod(F.xxhash64("vec_id"), F.lit(_SALTS)))
    near = salted.withColumn("rank", F.row_number().over(Window.partitionBy(*by, "__salt").orderBy(*order))).filter(F.col("rank") <= k)
    return near.drop("__salt").withColumn("rank", F.row_number().over(Window.partitionBy(*by).orderBy(*order))).filter(F.col("rank") <= k)


def hard_negatives(vectors: DataFrame, is_anchor: Column, label: Column, positives: int = 5, negatives: int = 5, low: int = 80, high: int = 100,
                   scale: float = 256.0, key: str = "vec_id", vector: str = "embedding") -> DataFrame:
    """(anchor_id, positive_id, rank, negative_id, positive_score, negative_score): of each anchor and each of its first
    ``positives`` rows of the same label, the first ``negatives`` rows of other labels with ``low`` to ``high`` per cent
    of the positive's score."""
    spark = vectors.sparkSession
    small_batches(spark, BLOCK)
    rows = vectors.select(F.col(key).cast("long").alias("k"), label.cast("long").alias("label"), F.col(vector).alias("v"), is_anchor.alias("a"))
    rows = rows.filter("k IS NOT NULL AND label IS NOT NULL AND v IS NOT NULL")
    stored = _blocks(rows.drop("a"), BLOCK, scale, "rows")
    packed = _blocks(rows.filter("a").drop("a"), ANCHORS, scale, "anchors")
    asked = packed.select(F.col("block").alias("q_block"), "dim", *[F.col(c).alias(f"q_{c}") for c in ("ids", "labels", "kind", "data")])
    n, held = packed.agg(F.count("*"), F.sum(F.length("data"))).first()
    n_rows = stored.count()
    sizes = max(sized(n, _HELD_BLOCKS), sized(held or 0, _HELD_BYTES)), max(1, min(n_rows, max(_TASKS, sized(n_rows, _SHARED))))

    def same_label(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        yield from _scanned(batches, scale, lambda row: Asked(row, scale, None, positives), Asked.same_label)

    near = _best(_meet(asked, stored, *sizes).mapInArrow(same_label, _FOUND_SCHEMA), ["q_block", "q"], positives)
    near = saved(near.select("q_block", "q", "anchor_id", "vec_id", "score"), "positives")
    windows = near.groupBy("q_block").agg(F.collect_set(F.struct("q", "score")).alias("windows"))  # anchors of a block * positives

    def windowed(row: dict) -> Asked:
        opened: dict[int, list[tuple[int, int, int]]] = {}
        for q, p in sorted((w["q"], w["score"]) for w in row["windows"]):
            a, b = -(-low * p // 100), high * p // 100
            if a <= b and a <= _MOST and b >= -_MOST - 1:
                opened.setdefault(q, []).append((max(a, -_MOST - 1), min(b, _MOST), p))
        return Asked(row, scale, opened, negatives)

    def in_windows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        yield from _scanned(batches, scale, windowed, Asked.other_labels)

    # Merged by sorting, for what is broadcast passes through the driver, and both sides grow with the anchors.
    met = _meet(asked.join(windows.hint("merge"), "q_block"), stored, *sizes)
    hard = _best(met.mapInArrow(in_windows, _FOUND_SCHEMA), ["q_block", "q", "p"], negatives)
    hard = hard.select("q_block", "q", F.col("p").alias("positive_score"), "rank", F.col("vec_id").alias("negative_id"), F.col("score").alias("negative_score"))
    pairs = near.select("q_block", "q", "anchor_id", F.col("vec_id").alias("positive_id"), F.col("score").alias("positive_score"))
    out = saved(pairs.join(hard.hint("merge"), ["q_block", "q", "positive_score"]).select(
        "anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score"), "negatives")
    forget(stored, packed, near)
    return out
