"""Blocks of vectors: what the searches score against each other, block by block."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from churnlens.llm.textops import saved, sized, small_batches

BLOCK = 4096  # vectors of a block, at most


def usable(part: pa.RecordBatch, vector: str) -> tuple[np.ndarray, list[np.ndarray]]:
    """(row numbers, matrices by dimension as [(rows, matrix)]) of vectors without null or non-finite components."""
    col = part.column(vector)
    found: dict[int, list[int]] = {}
    lens = pc.fill_null(pc.list_value_length(col), -1).to_numpy(zero_copy_only=False)
    for d in np.unique(lens[lens > 0]).tolist():
        found[d] = np.flatnonzero(lens == d)
    out = []
    for d, rows in found.items():
        values = col.take(pa.array(rows)).flatten()
        m = values.to_numpy(zero_copy_only=False).astype(np.float64).reshape(len(rows), d)
        ok = np.isfinite(m).all(axis=1)
        out.append((rows[ok], m[ok]))
    return out


def blocks(vectors: DataFrame, name: str, key: str, vector: str, keep_zero: bool = True) -> DataFrame:
    """(block, dim, ids, data): packed vectors (float64, row by row), stored; unusable vectors are left out.

    A block's id is the number of the task that packed it and a counter: blocks may hold the same ids.
    """
    small_batches(vectors.sparkSession, BLOCK)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        task, made = TaskContext.get().partitionId(), 0
        for b in batches:
            dims, ids, data = [], [], []
            for rows, m in usable(b, "v"):
                k = b.column("k").take(pa.array(rows)).to_numpy()
                if not keep_zero:
                    some = (m != 0).any(axis=1)
                    k, m = k[some], m[some]
                for a in range(0, len(k), BLOCK):
                    dims.append(m.shape[1])
                    ids.append(k[a:a + BLOCK].astype(np.int64).tobytes())
                    data.append(m[a:a + BLOCK].tobytes())
            block = (task << 32) + made + np.arange(len(dims), dtype=np.int64)
            made += len(dims)
            yield pa.RecordBatch.from_arrays([pa.array(block), pa.array(dims, pa.int32()), pa.array(ids, pa.binary()), pa.array(data, pa.binary())],
                                             names=["block", "dim", "ids", "data"])

    rows = vectors.filter(F.col(key).isNotNull() & F.col(vector).isNotNull()).select(F.col(key).cast("long").alias("k"), F.col(vector).alias("v"))
    packed = rows.mapInArrow(run, "block long, dim int, ids binary, data binary")
    # A few blocks a file, so that their number sets the tasks of a search.
    return saved(packed.repartition(sized(rows.count(), 2 * BLOCK), "block"), name)


def gathered(vectors: DataFrame, each: int) -> DataFrame:
    """Query rows dealt to as few partitions as make blocks of about ``each``."""
    n = max(1, -(-vectors.count() // each))
    return vectors.repartition(n)


def matrix(ids: bytes, data: bytes, dim: int) -> tuple[np.ndarray, np.ndarray]:
    return np.frombuffer(ids, dtype=np.int64), np.frombuffer(data, dtype=np.float64).reshape(-1, dim)


def cells(batches: Iterator[pa.RecordBatch]) -> Iterator[dict]:
    """The rows of batches that hold a pair of blocks each, one at a time."""
    for b in batches:
        for i in range(b.num_rows):
            yield {n: b.column(n)[i].as_py() for n in b.schema.names}
