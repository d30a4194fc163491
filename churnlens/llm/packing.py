"""Bounded-space online packing of tokenised documents into sequences.

Each partition keeps a fixed number of open windows.  A document's whole multiples of the capacity are sequences of
their own; the rest is placed best-fit (the fullest window that still takes it).  When none takes it, a new window is
opened, and the fullest is emitted if that makes one too many.  The windows still open at the end of the partitions
are few (open windows x partitions); their pieces are dealt to groups of bounded size and packed best-fit decreasing.

Defined results: a null text is the empty text; every document ends with the end id, so an empty one has one token;
repeated rows and repeated doc_ids are packed as rows of their own; a table without rows gives no rows; other columns
are not read.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from churnlens.llm.bpe import ByteBpe, coder, load_json
from churnlens.llm.textops import saved, slices, small_batches

_SLICE = 2 << 20
_GROUP = 20_000  # open pieces that one group packs at the end


class Windows:
    """Open windows by free space: a bitmap of the free sizes in use finds the best fit at once."""

    def __init__(self, capacity: int, most: int):
        self.capacity, self.most, self.count, self.next = capacity, most, 0, 0
        self.by_free: dict[int, list[int]] = {}
        self.bits = 0

    def _take(self, free: int) -> int:
        held = self.by_free[free]
        w = held.pop()
        if not held:
            del self.by_free[free]
            self.bits ^= 1 << free
        return w

    def place(self, length: int) -> tuple[int, int]:
        """(window, offset) for a piece shorter than the capacity."""
        fits = self.bits >> length
        if fits:
            free = length + (fits & -fits).bit_length() - 1
            w = self._take(free)
        else:
            if self.count == self.most:
                self._take((self.bits & -self.bits).bit_length() - 1)  # the fullest is emitted
                self.count -= 1
            free, w = self.capacity, self.new()
            self.count += 1
        left = free - length
        if left:
            self.by_free.setdefault(left, []).append(w)
            self.bits |= 1 << left
        else:
            self.count -= 1
        return w, self.capacity - free

    def new(self) -> int:
        self.next += 1
        return self.next - 1

    def open(self) -> set[int]:
        return {w for held in self.by_free.values() for w in held}


def _ids(c: ByteBpe, special: list[tuple[str, int]], texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Ids of the texts in a row, and offsets; special strings inside a text become their own id."""
    found = [(s, k) for s, k in special if pc.any(pc.match_substring(texts, s)).as_py()]
    if not found:
        return c.encode_slice(texts)
    sections, marks, owner = [], [], []
    for row, t in enumerate(texts.to_pylist()):
        at, t = 0, t or ""
        while True:
            hits = sorted((i, -len(s), s, k) for s, k in found if (i := t.find(s, at)) >= 0)
            end = hits[0][0] if hits else len(t)
            sections.append(t[at:end])
            marks.append(hits[0][3] if hits else -1)
            owner.append(row)
            if not hits:
                break
            at = end + len(hits[0][2])
    flat, off = c.encode_slice(pa.array(sections, pa.large_string()))
    marks, owner = np.array(marks), np.array(owner)
    marked = marks >= 0
    out = np.insert(flat, off[1:][marked], marks[marked])
    size = np.diff(off) + marked
    return out, np.concatenate([[0], np.cumsum(np.bincount(owner, weights=size, minlength=len(texts)).astype(np.int64))])


def pack(docs: DataFrame, path: str, pattern: str, end_id: int = 0, capacity: int = 1024, open_windows: int = 128,
         key: str = "doc_id", text: str = "text", with_ids: bool = False) -> DataFrame:
    """One row per piece: key, start, length, ids_crc32, doc_tokens, sequence_id, offset (and ids, if asked for)."""
    spark = docs.sparkSession
    small_batches(spark)
    kind = docs.schema[key].dataType.simpleString()
    schema = f"key {kind}, start long, length long, ids_crc32 long, doc_tokens long, sequence_id long, offset long, open boolean" \
        + ", ids array<int>" * with_ids

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        c = coder(path, pattern)
        special = list(load_json(path)[3].items()) if path.endswith(".json") else []
        first = TaskContext.get().partitionId() << 36
        windows = Windows(capacity, open_windows)
        waiting: dict[int, list[tuple]] = {}  # pieces of the open windows: at most open_windows * capacity

        def rows(got: list[tuple], is_open: bool) -> pa.RecordBatch:
            cols = list(zip(*got)) if got else [[] for _ in range(8)]
            arrays = [pa.array(cols[0], keys), *(pa.array(x, pa.int64()) for x in cols[1:7]), pa.array([is_open] * len(got), pa.bool_())]
            if with_ids:
                arrays.append(pa.array(cols[7], pa.list_(pa.int32())))
            return pa.RecordBatch.from_arrays(arrays, names=names_out)

        names_out = ["key", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset", "open", *["ids"] * with_ids]
        keys = None
        for b in batches:
            keys = b.schema.field("key").type
            for part in slices(b, "text", _SLICE):
                flat, off = _ids(c, special, part.column("text"))
                out = []
                for k, x, y in zip(part.column("key").to_pylist(), off.tolist(), off[1:].tolist()):
                    ids = np.append(flat[x:y], np.int32(end_id)).astype("<i4")
                    n = len(ids)
                    for a in range(0, n, capacity):
                        piece = ids[a:a + capacity]
                        full = len(piece) == capacity
                        w, at = (windows.new(), 0) if full else windows.place(len(piece))
                        row = (k, a, len(piece), zlib.crc32(piece.tobytes()), n, first + w, at, piece if with_ids else None)
                        if full:
                            out.append(row)
                        else:
                            waiting.setdefault(w, []).append(row)
                now = windows.open()
                for w in [w for w in waiting if w not in now]:
                    out += waiting.pop(w)
                if out:
                    yield rows(out, False)
        if waiting:
            yield rows([r for held in waiting.values() for r in held], True)

    placed = saved(docs.select(F.col(key).alias("key"), F.col(text).cast("string").alias("text")).mapInArrow(run, schema), "packed")
    left = placed.filter("open")
    groups = max(1, -(-left.count() // _GROUP))
    names = placed.columns

    def merge(pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values(["length", "sequence_id", "offset"], ascending=[False, True, True], kind="stable").reset_index(drop=True)
        windows = Windows(capacity, len(pdf) + 1)
        spots = [windows.place(n) for n in pdf["length"]]
        # a merged sequence takes over the id of the piece that opened it
        owner: dict[int, int] = {}
        ids = []
        for (w, at), s, o in zip(spots, pdf["sequence_id"], pdf["offset"]):
            ids.append(owner.setdefault(w, (int(s) | int(o) << 25 | 1 << 35)))
        pdf["sequence_id"], pdf["offset"] = ids, [at for _, at in spots]
        return pdf[names]

    # Sequence ids: task << 36 | window; of merged ones bit 35 is set and bits 25 to 34 hold the opener's old offset.
    merged = left.groupBy(F.pmod(F.xxhash64("sequence_id", "offset"), F.lit(groups)).alias("group")).applyInPandas(
        lambda pdf: merge(pdf.drop(columns=["group"], errors="ignore")), placed.schema)
    out = placed.filter("NOT open").unionByName(merged).drop("open")
    return out.withColumnRenamed("key", key)
