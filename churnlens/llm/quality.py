"""Quality classifier: naive Bayes support vectors.

A document's features are indicators of its n-grams: its words, and one to three consecutive word shapes (length
class, letter classes, closing punctuation, whether the word repeats one of the two before it).  Indicators are scaled
by the class log-count ratio of their n-gram; a linear model with hinge loss is fitted on them by dual coordinate
descent, on a bounded sample of labelled rows.  Margins become scores by a logistic map fitted on margins of rows
that the fold's own model has not seen.

Defined results: null and empty texts have no n-gram and get the score of the intercept alone; without labelled rows
of class 0 every score is 1, without any of class 1 it is 0; repeated rows get equal scores; other columns pass
through.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from churnlens.llm.labelled import PER_CLASS, logistic, sample, sigmoid
from churnlens.llm.textops import Words, mix64, slices, small_batches

BITS = 18  # features are hashed to 2**18 columns
LEAST_ROWS = 4  # training rows that must hold an n-gram

_KIND = np.full(256, 4, dtype=np.uint64)  # 0 lower, 1 upper, 2 digit, 3 beyond ASCII, 4 other
_KIND[97:123], _KIND[65:91], _KIND[48:58], _KIND[128:] = 0, 1, 2, 3


def shapes(w: Words) -> np.ndarray:
    """A code of each word's shape."""
    size = w.end - w.start
    out = np.minimum(np.log2(np.maximum(size, 1)).astype(np.uint64), np.uint64(5))
    first, last = w.buf[w.start], w.buf[w.end - 1]
    before = w.buf[np.maximum(w.end - 2, w.start)]
    out = out * np.uint64(5) + _KIND[first]
    for c in (last, before):  # punctuation as itself
        out = out * np.uint64(260) + np.where(_KIND[c] == 4, c.astype(np.uint64) + np.uint64(4), _KIND[c])
    for kind in (1, 2, 4):
        many = np.concatenate([[0], np.cumsum(_KIND[w.buf] == kind)])
        out = out * np.uint64(3) + np.minimum(many[w.end] - many[w.start], 2).astype(np.uint64)
    for back in (1, 2):
        same = np.zeros(len(size), dtype=np.uint64)
        same[back:] = (w.hash[back:] == w.hash[:-back]) & (w.doc[back:] == w.doc[:-back])
        out = out * np.uint64(2) + same
    return mix64(out)


def features(w: Words, bits: int = BITS) -> tuple[np.ndarray, np.ndarray]:
    """(document, column) of every indicator that is on, sorted, without repeats."""
    docs, cols = [w.doc], [mix64(w.hash)]
    shape = shapes(w)
    for n in (1, 2, 3):
        if len(shape) < n:
            break
        inside = w.doc[:len(shape) - n + 1] == w.doc[n - 1:]
        code = np.full(len(shape) - n + 1, n, dtype=np.uint64)
        for k in range(n):
            code = mix64(code * np.uint64(31) + shape[k:len(shape) - n + 1 + k])
        docs.append(w.doc[:len(code)][inside])
        cols.append(code[inside])
    col = np.concatenate(cols) >> np.uint64(64 - bits)
    key = np.unique(np.concatenate(docs).astype(np.uint64) << np.uint64(bits) | col)
    return (key >> np.uint64(bits)).astype(np.int64), (key & np.uint64((1 << bits) - 1)).astype(np.int64)


def descend(rows: list[np.ndarray], values: list[np.ndarray], y: np.ndarray, n_columns: int, c: float, epochs: int, seed: int) -> np.ndarray:
    """Weights (the last is the intercept) of the hinge-loss model, one dual variable at a time."""
    w = np.zeros(n_columns + 1)
    alpha = np.zeros(len(y))
    norm = np.array([v @ v + 1.0 for v in values])
    rng = np.random.default_rng(seed)
    for _ in range(epochs):
        moved = 0.0
        for i in rng.permutation(len(y)):
            g = y[i] * (w[rows[i]] @ values[i] + w[-1]) - 1.0
            new = min(max(alpha[i] - g / norm[i], 0.0), c)
            step = (new - alpha[i]) * y[i]
            if step:
                w[rows[i]] += step * values[i]
                w[-1] += step
                moved = max(moved, abs(new - alpha[i]))
                alpha[i] = new
        if moved < 1e-4 * c:
            break
    return w


@dataclass
class Model:
    weight: np.ndarray  # of each column, the log-count ratio multiplied in
    intercept: float
    slope: float  # of the logistic map of margins
    shift: float
    constant: float | None = None

    def scores(self, texts: pa.Array) -> np.ndarray:
        w = Words(texts)
        if self.constant is not None:
            return np.full(w.n_docs, self.constant)
        doc, col = features(w)
        weight = self.weight[col]
        size = np.bincount(doc, weights=weight != 0, minlength=w.n_docs)
        margin = np.bincount(doc, weights=weight, minlength=w.n_docs) / np.sqrt(np.maximum(size, 1)) + self.intercept
        return sigmoid(self.slope * margin + self.shift)


def fit_rows(cols: list[np.ndarray], label: np.ndarray, share: float, c: float = 1.0, epochs: int = 20, seed: int = 0) -> Model:
    """Fit on indicator columns of each row; ``share`` is class 1's share of all labelled rows."""
    if not (label == 0).any() or not (label == 1).any():
        return Model(np.zeros(0), 0.0, 1.0, 0.0, constant=0.0 if (label == 0).any() else 1.0)
    y, n = np.where(label == 1, 1.0, -1.0), 1 << BITS

    def one(train: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        count = [np.full(n, 1.0), np.full(n, 1.0)]
        for i in train:
            count[label[i]][cols[i]] += 1.0
        ratio = np.log(count[1] / count[1].sum()) - np.log(count[0] / count[0].sum())
        ratio[count[0] + count[1] < LEAST_ROWS + 2] = 0.0
        known = [cols[i][ratio[cols[i]] != 0] for i in train]
        w = descend(known, [ratio[k] / np.sqrt(max(len(k), 1)) for k in known], y[train], n, c, epochs, seed)
        return w[:-1] * ratio, w[-1:]

    fold = np.random.default_rng(seed).permutation(len(y)) % 3
    margin = np.zeros(len(y))
    for f in range(3):
        train = np.flatnonzero(fold != f)
        if len(set(label[train].tolist())) < 2:
            train = np.arange(len(y))
        weight, b = one(train)
        for i in np.flatnonzero(fold == f):
            own = weight[cols[i]]
            margin[i] = own.sum() / np.sqrt(max((own != 0).sum(), 1)) + b[0]
    positive, negative = (label == 1).sum(), (label == 0).sum()
    target = np.where(label == 1, (positive + 1) / (positive + 2), 1 / (negative + 2))
    prior = np.where(label == 1, share / positive, (1 - share) / negative) * len(y)
    shift, slope = logistic(np.column_stack([np.ones(len(y)), margin]), target, prior)
    weight, b = one(np.arange(len(y)))
    return Model(weight, float(b[0]), float(max(slope, 1e-6)), float(shift))


def fit(docs: DataFrame, labels: DataFrame, label: str = "quality", per_class: int = PER_CLASS) -> Model:
    """Fit on at most ``per_class`` labelled rows of each class that are not held out."""
    rows, (zero, one) = sample(docs, labels, label, per_class)
    small_batches(docs.sparkSession)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for part in slices(b):
                w = Words(part.column("text"))
                doc, col = features(w)
                off = np.searchsorted(doc, np.arange(w.n_docs + 1))
                yield pa.RecordBatch.from_arrays([part.column("doc_id").combine_chunks(), part.column("label").combine_chunks(),
                                                  pa.ListArray.from_arrays(pa.array(off, pa.int32()), pa.array(col, pa.int32()))],
                                                 names=["doc_id", "label", "cols"])

    got = rows.mapInArrow(run, f"doc_id {rows.schema['doc_id'].dataType.simpleString()}, label int, cols array<int>").toArrow()  # bounded by per_class
    order = np.lexsort((got["label"].to_numpy(), got["doc_id"].to_numpy())) if len(got) else np.zeros(0, dtype=np.int64)
    cols = got["cols"].combine_chunks() if len(got) else pa.array([], pa.list_(pa.int32()))
    return fit_rows([cols[int(i)].values.to_numpy() for i in order], got["label"].to_numpy()[order].astype(np.int64), one / max(zero + one, 1))


def score(docs: DataFrame, model: Model, out: str = "score", text: str = "text") -> DataFrame:
    """``docs`` with each whole text's score (0 to 1, higher: label 1 likelier)."""
    spark = docs.sparkSession
    small_batches(spark)
    shared = spark.sparkContext.broadcast(model)  # 2**18 weights, whatever the input
    kept = [f for f in docs.schema if f.name != out]
    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in kept)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        m = shared.value
        for b in batches:
            for part in slices(b, text):
                one = part.combine_chunks()
                yield pa.RecordBatch.from_arrays([*(one.column(f.name).chunk(0) for f in kept), pa.array(m.scores(one.column(text)))],
                                                 names=[*(f.name for f in kept), out])

    return docs.mapInArrow(run, f"{schema}, `{out}` double")


def keep_good(docs: DataFrame, model: Model, least: float = 0.7) -> DataFrame:
    """The rows of ``docs`` whose score reaches ``least``."""
    return score(docs, model, "__score").filter(F.col("__score") >= least).drop("__score")
