"""Bounded training samples of labelled documents, and the fits shared by the classifiers."""

from __future__ import annotations

import numpy as np
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from churnlens.llm.textops import saved

#: Labelled rows per class that a classifier is fitted on at most (lowest hashes of doc_id first).
PER_CLASS = 4000
#: Bytes of text per class that the rows of a sample hold at most; beyond, the rows with the highest hashes are left out.
MOST_BYTES = 64 << 20
_FILES = 16  # tasks that read a sample


def held_out(key: Column) -> Column:
    """Rows whose labels are never learnt from."""
    return F.coalesce(F.crc32(key.cast("string").cast("binary")) % 4 == 2, F.lit(False))


def sample(docs: DataFrame, labels: DataFrame, label: str, per_class: int = PER_CLASS, most_bytes: int = MOST_BYTES) -> tuple[DataFrame, tuple[int, int]]:
    """((doc_id, text, label) rows of a bounded sample, stored in the shared folder; labelled ids of class 0 and 1 in all).

    A doc_id counts once for a class, however often it is labelled or held: of the texts of one doc_id the one with the
    smallest hash is taken.  An id that is labelled both ways is in both classes.
    """
    usable = labels.select(F.col("doc_id").alias("__id"), F.col(label).cast("int").alias("label")).filter(
        F.col("__id").isNotNull() & F.col("label").isin(0, 1) & ~held_out(F.col("__id"))).distinct()
    total = {r["label"]: r["n"] for r in usable.groupBy("label").agg(F.count(F.lit(1)).alias("n")).collect()}  # two rows
    ids = None
    for c in (0, 1):
        part = usable.filter(F.col("label") == c).orderBy(F.xxhash64("__id"), "__id").limit(per_class)
        ids = part if ids is None else ids.unionByName(part)
    texts = docs.select(F.col("doc_id").alias("__id"), F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"))
    # At most 2 * per_class ids; rows of one id are reduced to one before they are shuffled.
    got = texts.join(F.broadcast(ids), "__id").groupBy("__id", "label").agg(F.min_by("text", F.struct(F.xxhash64("text"), F.xxhash64(F.lit(1), "text"))).alias("text"))
    upto = F.sum(F.octet_length("text")).over(Window.partitionBy("label").orderBy(F.xxhash64("__id"), "__id"))  # per_class rows
    got = got.select(F.col("__id").alias("doc_id"), "text", "label", upto.alias("__upto")).filter(F.col("__upto") <= most_bytes).drop("__upto")
    got = got.repartition(_FILES, "doc_id")  # the window leaves two partitions
    return saved(got, "sample"), (total.get(0, 0), total.get(1, 0))


def logistic(x: np.ndarray, y: np.ndarray, weight: np.ndarray, ridge: float = 1e-3, rounds: int = 50) -> np.ndarray:
    """Weighted logistic regression by Newton steps; ``x`` holds a column of ones, which is not penalised."""
    b = np.zeros(x.shape[1])
    penalty = np.full(x.shape[1], ridge)
    penalty[0] = 1e-9
    for _ in range(rounds):
        p = sigmoid(x @ b)
        grad = x.T @ (weight * (p - y)) + penalty * b
        h = (x * (weight * np.maximum(p * (1 - p), 1e-9))[:, None]).T @ x + np.diag(penalty)
        step = np.linalg.solve(h, grad)
        b -= step * min(1.0, 5.0 / max(np.abs(step).max(), 1e-12))
        if np.abs(step).max() < 1e-8:
            break
    return b


def sigmoid(z: np.ndarray) -> np.ndarray:
    return 0.5 * (1.0 + np.tanh(0.5 * z))
