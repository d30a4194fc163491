"""Vectorised text helpers that run inside Spark tasks (numpy over Arrow buffers), and shared Spark helpers.

Words are ``[^\\x20\\x09-\\x0D]+`` of the UTF-8 bytes.  A word's hash is a polynomial in random byte codes modulo
2**64, taken from one running sum over a whole slice of documents; hashes of k consecutive words come from the
words' hashes in the same way.  No Python object is made per word.
"""

from __future__ import annotations

import uuid
from collections.abc import Iterator
from itertools import chain

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

_BASE = np.uint64(0x9E3779B97F4A7C15)  # odd and 5 modulo 8: its powers repeat only after 2**62 steps
_BASE_INV = np.uint64(pow(0x9E3779B97F4A7C15, -1, 1 << 64))
CODES = np.random.Generator(np.random.PCG64(20160531)).integers(1, 1 << 63, size=256, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_LOWER = CODES.copy()
_LOWER[65:91] = CODES[97:123]
_SPACE = np.zeros(256, dtype=bool)
_SPACE[[0x20, 0x09, 0x0A, 0x0B, 0x0C, 0x0D]] = True
_POWERS: dict[str, np.ndarray] = {}


def mix64(x: np.ndarray) -> np.ndarray:
    """Finaliser that spreads every input bit over all 64 output bits (a bijection)."""
    x = x ^ (x >> np.uint64(30))
    x = x * np.uint64(0xBF58476D1CE4E5B9)
    x ^= x >> np.uint64(27)
    x *= np.uint64(0x94D049BB133111EB)
    x ^= x >> np.uint64(31)
    return x


def _powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    if len(_POWERS.get("up", ())) < max(n, 1):
        size = max(n, 1 << 16)
        for name, base in (("up", _BASE), ("down", _BASE_INV)):
            p = np.full(size, base, dtype=np.uint64)
            p[0] = 1
            _POWERS[name] = np.cumprod(p, dtype=np.uint64)
    return _POWERS["up"][:n], _POWERS["down"][:n]


def running(values: np.ndarray) -> np.ndarray:
    """Prefix sums (length n + 1) of values[i] * base**i modulo 2**64."""
    up, _ = _powers(len(values))
    out = np.zeros(len(values) + 1, dtype=np.uint64)
    np.cumsum(values * up, out=out[1:])
    return out


def span_hash(prefix: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """Position-independent hashes of the spans [start, end) of the values behind ``prefix``."""
    _, down = _powers(len(prefix))
    return mix64((prefix[ends] - prefix[starts]) * down[starts])


def raw(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """(bytes, offsets from 0) of a column of texts; null is the empty text."""
    texts = pc.fill_null(texts, "")
    if isinstance(texts, pa.ChunkedArray):
        texts = texts.combine_chunks()
    if not pa.types.is_large_string(texts.type):
        texts = texts.cast(pa.large_string())
    n = len(texts)
    off = np.frombuffer(texts.buffers()[1], dtype=np.int64)[texts.offset:texts.offset + n + 1] if n else np.zeros(1, dtype=np.int64)
    data = texts.buffers()[2] if n else None
    buf = np.frombuffer(data, dtype=np.uint8)[off[0]:off[-1]] if data is not None and off[-1] > off[0] else np.zeros(0, dtype=np.uint8)
    return buf, off - off[0]


def ragged(start: np.ndarray, size: np.ndarray) -> np.ndarray:
    """Indices start[0]..start[0]+size[0]-1, start[1].. and so on."""
    total = int(size.sum())
    return np.repeat(start - (np.cumsum(size) - size), size) + np.arange(total)


class _Generation:
    """Sorted keys and the runs that they stand for."""

    def __init__(self):
        self.keys, self.start, self.size = (np.zeros(0, dtype=t) for t in (np.uint64, np.int64, np.int64))
        self.flat = np.zeros(1 << 16, dtype=np.int32)
        self.used = 0

    def at(self, keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(place of each key, whether it is there)."""
        at = np.searchsorted(self.keys, keys)
        known = at < len(self.keys)
        known[known] = self.keys[at[known]] == keys[known]
        return at, known

    def add(self, keys: np.ndarray, size: np.ndarray, flat: np.ndarray) -> None:
        """Merge sorted keys that aren't there yet."""
        at = np.searchsorted(self.keys, keys)
        self.keys = np.insert(self.keys, at, keys)
        self.start = np.insert(self.start, at, self.used + np.cumsum(size) - size)
        self.size = np.insert(self.size, at, size)
        if self.used + len(flat) > len(self.flat):
            grown = np.zeros(max(2 * len(self.flat), self.used + len(flat)), dtype=np.int32)
            grown[:self.used] = self.flat[:self.used]
            self.flat = grown
        self.flat[self.used:self.used + len(flat)] = flat
        self.used += len(flat)


class Memo:
    """Results (runs of int32) of distinct strings, kept by 64-bit hash in two generations of at most about ``most``.

    ``make`` turns a list of strings into a list of integer sequences.  When the young generation is full it becomes the
    old one, whose results are dropped; what is found in the old one moves to the young.  So a string that keeps coming
    back is made once.
    """

    def __init__(self, make, most: int = 700_000):
        self.make, self.most = make, most
        self.young, self.old = _Generation(), _Generation()

    @property
    def flat(self) -> np.ndarray:
        return self.young.flat

    def find(self, hashes: np.ndarray, buf: np.ndarray, start: np.ndarray, end: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(start, size) in ``flat`` for each span of ``buf``; spans with equal hashes are taken as equal."""
        distinct, first, back = np.unique(hashes, return_index=True, return_inverse=True)
        if len(self.young.keys) > self.most:
            self.young, self.old = _Generation(), self.young
        at, known = self.young.at(distinct)
        if not known.all():
            new = np.flatnonzero(~known)
            place, held = self.old.at(distinct[new])
            if held.any():
                place = place[held]
                size = self.old.size[place]
                self.young.add(distinct[new[held]], size, self.old.flat[ragged(self.old.start[place], size)])
                new = new[~held]
            if len(new):
                data = buf.tobytes()
                made = self.make([data[a:b].decode() for a, b in zip(start[first[new]].tolist(), end[first[new]].tolist())])
                size = np.fromiter(map(len, made), dtype=np.int64, count=len(made))
                self.young.add(distinct[new], size, np.fromiter(chain.from_iterable(made), dtype=np.int32, count=int(size.sum())))
            at, _ = self.young.at(distinct)
        at = at[back]
        return self.young.start[at], self.young.size[at]


class Words:
    """Word spans and hashes of a slice of documents: ``start``, ``end`` (bytes), ``doc`` (index in the slice)."""

    def __init__(self, texts: pa.Array, lower: bool = False):
        self.n_docs = len(texts)
        self.buf, self.off = buf, _ = raw(texts)
        n = len(buf)
        word = ~_SPACE[buf]
        first, last = word.copy(), word.copy()
        if n:
            first[1:] &= ~word[:-1]
            last[:-1] &= ~word[1:]
            heads = self.off[:-1][self.off[:-1] < n]
            first[heads] = word[heads]
            tails = self.off[1:][self.off[1:] > 0] - 1
            last[tails] = word[tails]
        self.start, self.end = np.flatnonzero(first), np.flatnonzero(last) + 1
        self.doc = np.searchsorted(self.off, self.start, side="right") - 1
        self.count = np.bincount(self.doc, minlength=self.n_docs)[:self.n_docs] if len(self.doc) else np.zeros(self.n_docs, dtype=np.int64)
        self.begin = np.concatenate([[0], np.cumsum(self.count)])  # first word of each document
        prefix = running((_LOWER if lower else CODES)[buf])
        self.hash = span_hash(prefix, self.start, self.end)

    def grams(self, k: int) -> tuple[np.ndarray, np.ndarray]:
        """(start word, hash) of every k consecutive words inside one document."""
        n = len(self.start)
        if n < k:
            return np.zeros(0, dtype=np.int64), np.zeros(0, dtype=np.uint64)
        at = np.flatnonzero(self.doc[:n - k + 1] == self.doc[k - 1:])
        return at, span_hash(running(self.hash), at, at + k)


def slices(table: pa.Table | pa.RecordBatch, text: str = "text", most_bytes: int = 1 << 20) -> Iterator[pa.Table]:
    """Slices of whole documents of about ``most_bytes`` of text (one document at least)."""
    if isinstance(table, pa.RecordBatch):
        table = pa.Table.from_batches([table])
    sizes = pc.fill_null(pc.binary_length(table.column(text)), 0).to_numpy()
    groups = np.cumsum(sizes) // most_bytes
    cuts = [0, *(np.flatnonzero(np.diff(groups)) + 1).tolist(), table.num_rows]
    for a, b in zip(cuts, cuts[1:]):
        if b > a:
            yield table.slice(a, b - a)


def small_batches(spark: SparkSession, rows: int = 1024) -> None:
    """Before Python runs in tasks: send the package to the executors, and lower the Arrow batch size so that a batch
    of long documents stays small in a worker."""
    from churnlens.session import ship_package
    ship_package(spark)
    key = "spark.sql.execution.arrow.maxRecordsPerBatch"
    now = int(spark.conf.get(key, "10000"))
    if now <= 0 or now > rows:
        spark.conf.set(key, str(rows))


def shared_path(spark: SparkSession, name: str) -> str:
    """A fresh path in the folder that ``spark.checkpoint.dir`` names (shared by driver and executors)."""
    root = spark.conf.get("spark.checkpoint.dir", None)
    if not root:
        from churnlens.session import checkpoint_dir
        root = checkpoint_dir(spark)
    return f"{root.rstrip('/')}/{name}-{uuid.uuid4().hex}"


def saved(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` to the shared folder and read it back: lineage is cut and lost executors cost no recomputation."""
    path = shared_path(df.sparkSession, name)
    df.write.parquet(path)
    out = df.sparkSession.read.schema(df.schema).parquet(path)
    _PATHS[id(out)] = out, path
    return out


_PATHS: dict[int, tuple[DataFrame, str]] = {}


def forget(*frames: DataFrame) -> None:
    """Delete tables of ``saved`` that nothing reads any more."""
    for df in frames:
        _, path = _PATHS.pop(id(df), (None, None))
        if path:
            spark = df.sparkSession
            p = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
            p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(p, True)


def sized(n_bytes: int, each: int) -> int:
    """Partitions of about ``each`` bytes."""
    return max(1, -(-n_bytes // each))
