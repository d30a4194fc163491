"""Grid search over logistic regressions with shared scans.

All candidates and folds are fitted together: one optimiser state for each
(candidate, held fold), and one pass over the stored feature blocks gives the
loss, the gradient and the curvature of every state.  The search so takes as
many passes as its slowest state, about ten, not one per fit and iteration.

Objective of a state, over the rows outside its fold, with weights w, scale s_j
(the sample standard deviation of feature j over these rows) and b_j = s_j times
the coefficient:

    sum(w * logloss) / sum(w) + reg * (a * sum|b_j| + (1 - a) / 2 * sum b_j^2)

The intercept is free; a feature that doesn't vary gets no weight.  A step
minimises the quadratic model with the penalties by coordinate descent, for
all states at once; a step that raises the objective is halved.  A state is done
when its residual, the largest violation of the optimality conditions, is below
``tolerance``; where the classes can be separated and nothing is penalised, the
optimum is at infinity, and the fit ends as far out as that takes.  Only states (candidates x folds x features numbers) live on the
driver.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from churnlens.operators.sampling import key_hash
from churnlens.plans.models import auc
from churnlens.plans.routing import Linear
from churnlens.session import checkpoint_dir, ship_package
from churnlens.sources.tables import drop_stored, stored_table

_BLOCK = 8192  # rows of a feature block


@dataclass(frozen=True)
class Candidate:
    reg: float
    elastic_net: float = 0.0


@dataclass
class Search:
    """What a search found: a model of every candidate (fitted on all rows), its mean area, and how it went."""
    candidates: list[Candidate]
    models: list[Linear]
    areas: list[float]
    passes: int
    residuals: np.ndarray  # (candidate, held fold; the last is "none")

    @property
    def best(self) -> Linear:
        return self.models[max(range(len(self.models)), key=lambda i: self.areas[i])]


def _blocks(data: DataFrame, features: Sequence[str], label: str, weight: str | None, fold: Column) -> tuple[DataFrame, str]:
    """((fold, y, w, x): rows without nulls, packed by fold inside each task; where they are stored)."""
    cols = [F.col(c).cast("double").alias(f"x{i}") for i, c in enumerate(features)]
    w = F.col(weight).cast("double") if weight else F.lit(1.0)
    rows = data.select(fold.alias("fold"), F.col(label).cast("double").alias("y"), w.alias("w"), *cols)
    rows = rows.na.drop().where(" AND ".join(f"NOT isnan(x{i})" for i in range(len(cols))) or "TRUE")

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            m = np.column_stack([b.column(c).to_numpy() for c in b.schema.names[1:]])
            folds = b.column("fold").to_numpy()
            for f in np.unique(folds).tolist():
                mine = m[folds == f]
                for a in range(0, len(mine), _BLOCK):
                    part = mine[a:a + _BLOCK]
                    yield pa.RecordBatch.from_arrays([pa.array([f], pa.int32()), *(pa.array([np.ascontiguousarray(x).tobytes()], pa.binary())
                                                                                   for x in (part[:, 0], part[:, 1], part[:, 2:]))], names=["fold", "y", "w", "x"])

    return stored_table(rows.mapInArrow(pack, "fold int, y binary, w binary, x binary"), "feature-blocks")


def _unpacked(batches: Iterator[pa.RecordBatch], d: int) -> Iterator[tuple[int, np.ndarray, np.ndarray, np.ndarray]]:
    for b in batches:
        for f, y, w, x in zip(*(b.column(c).to_pylist() for c in ("fold", "y", "w", "x"))):
            yield f, np.frombuffer(y), np.frombuffer(w), np.frombuffer(x).reshape(-1, d)


def _summed(blocks: DataFrame, part, width: int) -> np.ndarray:
    """Sum over all blocks of ``part(fold, y, w, x)``, an array of ``width`` numbers: one row a task, added by Spark in
    slices, so that no task holds more than a slice of all partial sums."""
    slices = 32

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = None
        for got in part(batches):
            total = got if total is None else total + got
        if total is not None:
            cut = np.array_split(total, slices)
            yield pa.RecordBatch.from_arrays([pa.array(range(slices), pa.int32()), pa.array([c.tobytes() for c in cut], pa.binary())], names=["s", "v"])

    def add(key, t: pa.Table) -> pa.Table:
        total = sum(np.frombuffer(v) for v in t.column("v").to_pylist())
        return pa.table([pa.array([key[0].as_py()], pa.int32()), pa.array([np.asarray(total, dtype=np.float64).tobytes()], pa.binary())], names=["s", "v"])

    rows = blocks.mapInArrow(run, "s int, v binary").groupBy("s").applyInArrow(lambda key, t: add(key, t), "s int, v binary").collect()  # ``slices`` rows
    out = np.concatenate([np.frombuffer(r["v"]) for r in sorted(rows, key=lambda r: r["s"])]) if rows else np.zeros(width)
    return out


def _soft(x: np.ndarray, t: np.ndarray) -> np.ndarray:
    return np.sign(x) * np.maximum(np.abs(x) - t, 0.0)


def _residual(b: np.ndarray, grad: np.ndarray, l1: np.ndarray, l2: np.ndarray) -> np.ndarray:
    """The largest violation of the optimality conditions of each state (first column: the intercept)."""
    g = grad[:, 1:] + l2[:, None] * b[:, 1:]
    at_zero = np.maximum(np.abs(g) - l1[:, None], 0.0)
    off_zero = np.abs(g + l1[:, None] * np.sign(b[:, 1:]))
    inner = np.where(b[:, 1:] == 0, at_zero, off_zero)
    return np.maximum(np.abs(grad[:, 0]), inner.max(axis=1, initial=0.0))


def _direction(b: np.ndarray, grad: np.ndarray, hess: np.ndarray, l1: np.ndarray, l2: np.ndarray, sweeps: int = 1000) -> np.ndarray:
    """The minimiser of the quadratic model with the penalties, less ``b``.

    Without an L1 part it solves one linear system; the other states go through
    coordinate descent together.  Flat directions get a ridge of rounding size.
    """
    out, one = np.zeros_like(b), np.eye(b.shape[1])
    inner = np.append(0.0, np.ones(b.shape[1] - 1))
    ridge = 1e-13 * np.einsum("sjj->s", hess) + 1e-300
    smooth = l1 == 0
    if smooth.any():
        left = hess[smooth] + (l2[smooth, None] * inner + ridge[smooth, None])[:, :, None] * one
        right = grad[smooth] + l2[smooth, None] * inner * b[smooth]
        out[smooth] = -np.linalg.solve(left, right[:, :, None])[:, :, 0]
    rest = ~smooth
    if rest.any():
        new, h, t, r = b[rest].copy(), hess[rest], l1[rest], l2[rest]
        curve = np.einsum("sjj->sj", h) + ridge[rest, None]
        model = grad[rest].copy()  # the model's gradient at ``new``, without penalties
        for _ in range(sweeps):
            most = 0.0
            for j in range(new.shape[1]):
                old = new[:, j].copy()
                wish = curve[:, j] * old - model[:, j]
                new[:, j] = wish / curve[:, j] if j == 0 else _soft(wish, t) / (curve[:, j] + r)
                move = new[:, j] - old
                model += h[:, :, j] * move[:, None]
                most = max(most, float(np.abs(move).max()))
            if most < 1e-13:
                break
        out[rest] = new - b[rest]
    return out


def search(data: DataFrame, features: Sequence[str], candidates: Sequence[Candidate], folds: int = 5, label: str = "label",
           weight: str | None = None, key: str = "login", seed: int = 2018, tolerance: float = 1e-9, max_passes: int = 100) -> Search:
    """Fit every candidate with every fold held out and with none, and rate it by the mean area under ROC on the held rows.

    A row's fold depends on its key and the seed only.  Rows with a null are skipped.
    """
    spark = data.sparkSession
    checkpoint_dir(spark)
    ship_package(spark)
    fold = F.pmod(key_hash(key, seed), F.lit(folds)).cast("int")
    blocks, path = _blocks(data, features, label, weight, fold)
    d, distinct = len(features), list(dict.fromkeys(candidates))
    cand = np.repeat(np.arange(len(distinct)), folds + 1)
    held = np.tile(np.arange(folds + 1), len(distinct))  # the last fold number stands for none
    n = len(cand)

    # Size, weight, mean and scale of the rows outside each fold.
    def moments(batches):
        for f, y, w, x in _unpacked(batches, d):
            out = np.zeros((folds, 2 + 2 * d))
            out[f] = [w.sum(), (w * w).sum(), *(w @ x), *(w @ (x * x))]
            yield out.reshape(-1)

    per_fold = _summed(blocks, moments, folds * (2 + 2 * d)).reshape(folds, 2 + 2 * d)
    outside = np.vstack([per_fold.sum(axis=0) - per_fold, per_fold.sum(axis=0)])
    total, squares = outside[:, 0], outside[:, 1]
    mean = outside[:, 2:2 + d] / np.maximum(total, 1e-300)[:, None]
    spread = outside[:, 2 + d:] - total[:, None] * mean ** 2
    variance = np.maximum(spread, 0.0) / np.maximum(total - squares / np.maximum(total, 1e-300), 1e-300)[:, None]
    flat = spread <= 1e-12 * outside[:, 2 + d:]
    scale = np.where(flat, 0.0, np.sqrt(variance))
    inverse = np.where(flat, 0.0, 1.0 / np.where(flat, 1.0, scale))[held]  # of each state

    reg, mix = np.array([c.reg for c in distinct])[cand], np.array([c.elastic_net for c in distinct])[cand]
    l1, l2 = reg * mix, reg * (1.0 - mix)
    # Centred and scaled features, one matrix a state: a feature far from zero would else go along with the intercept.
    shape = np.zeros((n, d + 1, d + 1))
    shape[:, 0, 0] = 1.0
    shape[:, 0, 1:] = -mean[held] * inverse
    shape[:, range(1, d + 1), range(1, d + 1)] = inverse
    upper = np.triu_indices(d + 1)
    width = n * (1 + d + 1 + len(upper[0]))

    def evaluate(b: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(objective, gradient, Hessian) without penalties on centred and scaled features, one pass."""
        raw = np.einsum("sij,sj->si", shape, b)

        def part(batches):
            for f, y, w, x in _unpacked(batches, d):
                one = np.column_stack([np.ones(len(x)), x])
                m = one @ raw.T
                p = 0.5 * (1.0 + np.tanh(0.5 * m))
                use = (held != f).astype(float)
                loss = (w @ (np.logaddexp(0.0, m) - y[:, None] * m)) * use
                grad = (one.T @ (w[:, None] * (p - y[:, None]))) * use
                products = one[:, upper[0]] * one[:, upper[1]]
                curve = (products.T @ (w[:, None] * p * (1.0 - p))) * use
                yield np.concatenate([loss, grad.T.reshape(-1), curve.T.reshape(-1)])

        got = _summed(blocks, part, width)
        size = np.maximum(total[held], 1e-300)
        loss, grad, curve = got[:n] / size, got[n:n * (d + 2)].reshape(n, d + 1) / size[:, None], got[n * (d + 2):].reshape(n, -1) / size[:, None]
        hess = np.zeros((n, d + 1, d + 1))
        hess[:, upper[0], upper[1]] = curve
        hess[:, upper[1], upper[0]] = curve
        turned = np.swapaxes(shape, 1, 2)
        return loss, (turned @ grad[:, :, None])[:, :, 0], turned @ hess @ shape

    def penalised(loss: np.ndarray, b: np.ndarray) -> np.ndarray:
        return loss + l1 * np.abs(b[:, 1:]).sum(axis=1) + 0.5 * l2 * (b[:, 1:] ** 2).sum(axis=1)

    b = np.zeros((n, d + 1))
    loss, grad, hess = evaluate(b)
    value, residual, passes = penalised(loss, b), _residual(b, grad, l1, l2), 2
    step, ahead = np.ones(n), _direction(b, grad, hess, l1, l2)
    while passes < max_passes:
        going = (residual > tolerance) & (step > 1e-8)  # a shorter step changes nothing but rounding
        if not going.any():
            break
        trial = b + np.where(going, step, 0.0)[:, None] * ahead
        loss, g, h = evaluate(trial)
        passes += 1
        now = penalised(loss, trial)
        better = going & (now <= value + 1e-12 * np.abs(value))
        b[better], value[better], grad[better], hess[better] = trial[better], now[better], g[better], h[better]
        residual = _residual(b, grad, l1, l2)
        step = np.where(better, 1.0, np.where(going, step / 2, step))
        ahead = np.where(better[:, None], _direction(b, grad, hess, l1, l2), ahead)
    raw = np.einsum("sij,sj->si", shape, b)

    # Scores of the held rows by all candidates at once, counted per distinct score inside each task.
    states = {f: np.flatnonzero(held == f) for f in range(folds)}

    def scored(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for f, y, w, x in _unpacked(batches, d):
            m = raw[states[f], 0] + x @ raw[states[f], 1:].T
            for c in range(m.shape[1]):
                yield pa.RecordBatch.from_arrays([pa.array(np.full(len(m), c, dtype=np.int32)), pa.array(np.full(len(m), f, dtype=np.int32)),
                                                  pa.array(m[:, c]), pa.array(y.astype(np.int32))], names=["candidate", "fold", "score", "label"])

    points = blocks.mapInArrow(scored, "candidate int, fold int, score double, label int")
    got = auc(points, "score", "label", by=("candidate", "fold")).groupBy("candidate").agg(F.avg("auc_roc").alias("area")).collect()  # a row a candidate
    area = {r["candidate"]: r["area"] for r in got}
    drop_stored(spark, path)
    order = [distinct.index(c) for c in candidates]
    whole = [int(np.flatnonzero((cand == i) & (held == folds))[0]) for i in order]
    models = [Linear(float(raw[s, 0]), tuple(zip(features, map(float, raw[s, 1:])))) for s in whole]
    return Search(list(candidates), models, [area.get(i) if area.get(i) is not None else float("nan") for i in order], passes,
                  residual.reshape(len(distinct), folds + 1)[order])
