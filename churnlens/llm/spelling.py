"""Spelling variants of words, found with a trie of letter counts.

Letters fall into ``GROUPS`` groups; a word's frequency vector says how many letters of each group it has.  Words are
arranged in a trie by successive counts.  Two words that differ by one code point have vectors that differ by at most
one letter too many (surplus) and one too few (deficit), so a depth-first search follows the word's own counts, spends
a surplus of one and then a deficit of one, and ends at the leaves where a near word may be.  The surplus is always
spent first: of two words of one length it is the one with the smaller vector that finds the other, and of two lengths the
shorter, so each pair is found once.

Leaf words are verified.  Near words share the first or the last half of the shorter one; of a leaf only words that do so
are compared, letter by letter.

The trie is cut into cells by the first counts of the vectors, as many counts as keep every cell at ``CELL`` words at most;
a word is sent to its own cell and to those within its budget (some dozens, of which only existing ones count).  Where even
whole vectors leave a cell too large, a cell is a vector with one half.

A word's form is its near word with the highest count, if that is ``ratio`` times its own or more; counts rise by that
factor from form to form, so the chains to the root are short and pointer doubling ends after a few joins.

Defined results: a null text has no words; a null id is the empty string in the noise hash; repeated rows and ids count
every time; a word without near words has n_near 0 and is its own root; a table without words gives no rows; other
columns are not read.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from churnlens.llm.textops import CODES, forget, mix64, ragged, running, saved, sized, small_batches, span_hash

GROUPS = 13  # a letter's group is its code point modulo this number
_ORDER = [10, 6, 12, 7, 1, 11, 0, 9, 4, 8, 5, 3, 2]  # groups with frequent letters (e and r, a and n, g and t ...) come first
CELL = 40_000  # words of a cell, at most
LETTERS = "A-Za-z\\u00C0-\\u00FF"
_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
_STEPS = 1 << 16  # queries that descend together
_WIDTH = 64  # longer words are compared one by one
_SAME, _LONGER, _REPLACED = 0, 1, 2  # what a search has spent: nothing, a surplus, a surplus and a deficit
_WHOLE, _FIRST, _LAST = 0, 1, 2  # how a cell is cut: by counts, or also by the first or the last half


def runs(least: int, text: str = "text") -> Column:
    """The maximal runs of at least ``least`` letters, A-Z in lower case."""
    found = F.regexp_extract_all(F.col(text).cast("string"), F.lit(f"[{LETTERS}]{{{least},}}"), F.lit(0))
    return F.transform(found, lambda r: F.when(r.rlike("[A-Z]"), F.translate(r, _UPPER, _LOWER)).otherwise(r))


def noisy(run: Column, key: Column, every: int = 199) -> Column:
    """The run, or, if ``every`` divides h = crc32('<key>:<run>'), the run without its code point h % length."""
    h = F.crc32(F.concat(F.coalesce(key.cast("string"), F.lit("")), F.lit(":"), run).cast("binary"))
    at = (h % F.char_length(run)).cast("int")
    return F.when(h % every == 0, F.concat(F.substr(run, F.lit(1), at), F.substr(run, at + 2))).otherwise(run)


def vocabulary(docs: DataFrame, least_letters: int = 6, least_count: int = 5, key: str = "doc_id", text: str = "text",
               change: Callable[[Column, Column], Column] = noisy) -> DataFrame:
    """(word, n): the words of all texts after ``change``, with their counts."""
    run = docs.select(F.col(key).alias("key"), F.explode(runs(least_letters, text)).alias("run"))
    words = run.select(change(F.col("run"), F.col("key")).alias("word")).filter(F.char_length("word") >= least_letters)
    return words.groupBy("word").agg(F.count(F.lit(1)).alias("n")).filter(F.col("n") >= least_count)


class _Words:
    """Words as bytes (their letters are Latin-1), with hashes of their halves."""

    def __init__(self, words: list[str]):
        self.bytes = [w.encode("latin-1") for w in words]
        self.size = np.fromiter(map(len, self.bytes), dtype=np.int64, count=len(words))
        self.start = np.cumsum(self.size) - self.size
        self.buf = np.frombuffer(b"".join(self.bytes), dtype=np.uint8)
        self.prefix = running(CODES[self.buf])

    def counts(self) -> np.ndarray:
        """(word, group): the frequency vectors."""
        word = np.repeat(np.arange(len(self.size)), self.size)
        return np.bincount(word * GROUPS + self.buf % GROUPS, minlength=len(self.size) * GROUPS).reshape(-1, GROUPS)[:, _ORDER]

    def halves(self, longer: bool) -> tuple[np.ndarray, np.ndarray]:
        h = (self.size - int(longer)) // 2
        return (span_hash(self.prefix, self.start, self.start + h),
                span_hash(self.prefix, self.start + h + int(longer), self.start + self.size))

    def matrix(self, at: np.ndarray, width: int) -> np.ndarray:
        out = np.zeros((len(at), width), dtype=np.uint8)
        size = self.size[at]
        out[np.arange(width)[None, :] < size[:, None]] = self.buf[ragged(self.start[at], size)]
        return out


class Trie:
    """Words arranged by their counts from group ``depth`` on."""

    def __init__(self, words: list[str], depth: int):
        vec = _Words(words).counts()[:, depth:]
        order = np.lexsort(vec.T[::-1]) if vec.shape[1] else np.arange(len(words))
        self.words, vec = _Words([words[i] for i in order.tolist()]), vec[order]
        self.row = order
        self.levels = []  # of each level: the sorted keys parent << 32 | count of its nodes
        node = np.zeros(len(words), dtype=np.int64)
        for level in range(vec.shape[1]):
            key = node << 32 | vec[:, level]
            new = np.append(True, key[1:] != key[:-1]) if len(key) else np.zeros(0, dtype=bool)
            self.levels.append(key[new])
            node = np.cumsum(new) - 1
        # Leaf words by what they share with a query: one half, with or without a letter more in the other.
        self.index = {}
        for longer in (False, True):
            for kind, half in zip((_FIRST, _LAST), self.words.halves(longer)):
                key = self.leaf_key(node, half)
                by = np.argsort(key, kind="stable")
                self.index[longer, kind] = key[by], by

    @staticmethod
    def leaf_key(node: np.ndarray, half: np.ndarray) -> np.ndarray:
        return mix64(half ^ mix64(node.astype(np.uint64) + np.uint64(1)))

    def _children(self, level: int, node: np.ndarray, count: np.ndarray) -> np.ndarray:
        """The child of each node with that count, -1 where there is none."""
        keys, key = self.levels[level], node << 32 | count
        at = np.minimum(np.searchsorted(keys, key), len(keys) - 1)
        return np.where((count >= 0) & (keys[at] == key), at, -1)

    def leaves(self, vec: np.ndarray, state: np.ndarray):
        """Depth first: (queries, leaves, states) that the budget reaches, some at a time."""
        stack = [(0, np.arange(a, min(a + _STEPS, len(vec))), None, None) for a in range(0, len(vec), _STEPS)]
        while stack:
            level, q, node, spent = stack.pop()
            if node is None:
                node, spent = np.zeros(len(q), dtype=np.int64), state[q]
            if level == len(self.levels):
                yield q, node, spent
                continue
            out = []
            for least, more in ((None, 0), (_SAME, 1), (_LONGER, -1)):
                on = slice(None) if least is None else np.flatnonzero(spent == least)
                child = self._children(level, node[on], vec[q[on], level] + more)
                some = child >= 0
                out.append((q[on][some], child[some], spent[on][some] + abs(more)))
            q, node, spent = (np.concatenate(x) for x in zip(*out))
            stack += [(level + 1, q[a:a + _STEPS], node[a:a + _STEPS], spent[a:a + _STEPS]) for a in range(0, len(q), _STEPS)]

    def near(self, asked: _Words, vec: np.ndarray, state: np.ndarray, half: np.ndarray):
        """(queries, rows of the trie) of all pairs that differ by one code point."""
        own = asked.halves(False)
        for q, node, spent in self.leaves(vec, state):
            for now in (_SAME, _LONGER, _REPLACED):
                longer = now == _LONGER
                for kind in (_FIRST, _LAST):
                    some = np.flatnonzero((spent == now) & ((half[q] == _WHOLE) | (half[q] == kind)))
                    keys, by = self.index[longer, kind]
                    key = self.leaf_key(node[some], own[kind - 1][q[some]])
                    a, b = np.searchsorted(keys, key), np.searchsorted(keys, key, side="right")
                    who, hit = np.repeat(q[some], b - a), by[ragged(a, b - a)]
                    for x in range(0, len(who), _STEPS):
                        i, j = who[x:x + _STEPS], hit[x:x + _STEPS]
                        ok = _verified(asked, i, self.words, j, longer, kind == _LAST)
                        i, j = i[ok], j[ok]
                        if now == _SAME:  # words of one vector find each other: one of the two counts
                            one = np.array([asked.bytes[x] < self.words.bytes[y] for x, y in zip(i.tolist(), j.tolist())], dtype=bool)
                            i, j = i[one], j[one]
                        yield i, self.row[j]


def _verified(a: _Words, i: np.ndarray, b: _Words, j: np.ndarray, longer: bool, last: bool) -> np.ndarray:
    """Whether the words differ by one code point; pairs that share both halves count with the first one only."""
    ok = np.zeros(len(i), dtype=bool)
    if not len(i):
        return ok
    size = a.size[i]
    fits = b.size[j] == size + int(longer)
    short = np.flatnonzero(fits & (size < _WIDTH))
    if len(short):
        width = int(size[short].max()) + 1
        x, y = a.matrix(i[short], width), b.matrix(j[short], width)
        differ = x != y
        if longer:
            first = differ.argmax(axis=1)  # a letter more: the rest is shifted by one
            later = np.arange(width - 1)[None, :] >= first[:, None]
            ok[short] = ~((x[:, :-1] != y[:, 1:]) & later).any(axis=1)
        else:
            ok[short] = differ.sum(axis=1) == 1
        if last:
            ok[short] &= (differ & (np.arange(width)[None, :] < (size[short] // 2)[:, None])).any(axis=1)
    for k in np.flatnonzero(fits & (size >= _WIDTH)).tolist():
        s, t = a.bytes[i[k]], b.bytes[j[k]]
        lo, hi = 0, len(s)  # the length of the common start
        while lo < hi:
            mid = (lo + hi + 1) // 2
            lo, hi = (mid, hi) if s[:mid] == t[:mid] else (lo, mid - 1)
        ok[k] = (s != t) and s[lo + 1 - int(longer):] == t[lo + 1:] and not (last and lo >= len(s) // 2)
    return ok


_CODE = np.random.Generator(np.random.PCG64(13)).integers(1, 1 << 63, size=GROUPS, dtype=np.uint64) * np.uint64(2) + np.uint64(1)


def _cells(vec: np.ndarray, depth: int) -> np.ndarray:
    """The cell of each vector, a sum over its first ``depth`` counts: a letter more or less adds or takes its code."""
    return (vec[:, :depth].astype(np.uint64) * _CODE[:depth]).sum(axis=1, dtype=np.uint64)


def _key(cell: np.ndarray, half: np.ndarray | None = None, tag: int = 0) -> np.ndarray:
    key = mix64(cell) if half is None else mix64(mix64(cell) + half * np.uint64(2 * tag + 1))
    return key.view(np.int64)


def _depth(words: DataFrame, n: int, cell: int) -> tuple[int, bool]:
    """(counts that a cell is cut by, whether halves are needed too)."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            vec = _Words(b.column("word").to_pylist()).counts()
            for depth in range(1, GROUPS + 1):
                cells, n = np.unique(_cells(vec, depth).view(np.int64), return_counts=True)
                yield pa.RecordBatch.from_arrays([pa.array(np.full(len(cells), depth, dtype=np.int32)), pa.array(cells), pa.array(n, pa.int64())], names=["depth", "cell", "n"])

    if n <= cell:
        return 0, False
    sizes = words.mapInArrow(run, "depth int, cell long, n long").groupBy("depth", "cell").agg(F.sum("n").alias("n"))
    fits = [r["depth"] for r in sizes.groupBy("depth").agg(F.max("n").alias("most")).collect() if r["most"] <= cell]  # a row for each depth
    return min(fits, default=GROUPS), not fits


def _owners(words: DataFrame, depth: int, halves: bool) -> DataFrame:
    """(own_cell, own_word, own_n): every word in its cell."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            w = _Words(b.column("word").to_pylist())
            cell = _cells(w.counts(), depth)
            keys = [_key(cell, h, 2 * longer + kind) for longer in (0, 1) for kind, h in enumerate(w.halves(bool(longer)))] if halves else [_key(cell)]
            for key in keys:
                yield pa.RecordBatch.from_arrays([pa.array(key), b.column("word"), b.column("n")], names=["own_cell", "own_word", "own_n"])

    return words.mapInArrow(run, "own_cell long, own_word string, own_n long")


def _queries(words: DataFrame, depth: int, halves: bool) -> DataFrame:
    """(cell, state, half, word, n): every word in each cell that its budget reaches."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            w = _Words(b.column("word").to_pylist())
            vec, own = w.counts(), w.halves(False)
            cell, every = _cells(vec, depth), np.arange(len(w.size))
            to = [(_SAME, every, cell)]
            for g in range(depth):
                to.append((_LONGER, every, cell + _CODE[g]))
                for h in range(g + 1, depth):
                    some = np.flatnonzero(vec[:, h])  # a deficit needs a letter to take away
                    to.append((_REPLACED, some, (cell + _CODE[g] - _CODE[h])[some]))
            for state, some, at in to:
                longer = int(state == _LONGER)
                keys = [(kind + 1, _key(at, h[some], 2 * longer + kind)) for kind, h in enumerate(own)] if halves else [(_WHOLE, _key(at))]
                for half, key in keys:
                    yield pa.RecordBatch.from_arrays([pa.array(key), *(pa.array(np.full(len(key), x, dtype=np.int32)) for x in (state, half)),
                                                      b.column("word").take(pa.array(some)), b.column("n").take(pa.array(some))],
                                                     names=["cell", "state", "half", "word", "n"])

    return words.mapInArrow(run, "cell long, state int, half int, word string, n long")


def near_pairs(words: DataFrame, cell: int = CELL) -> DataFrame:
    """(a, na, b, nb): each pair of words that differ by one inserted, deleted or replaced code point, once; ``words`` is
    a stored table (word, n) of different words."""
    spark = words.sparkSession
    small_batches(spark, 4096)
    n = words.count()
    depth, halves = _depth(words, n, cell)
    owners, asked = _owners(words, depth, halves), _queries(words, depth, halves)
    # Only cells that exist; as many tasks as the words to be looked up need.
    tasks = sized(n * (1 + depth + depth * (depth - 1) // 2), 5 * cell)
    asked = asked.join(owners.select("own_cell").distinct(), F.col("cell") == F.col("own_cell"), "left_semi").repartition(tasks, "cell")
    owners = owners.repartition(tasks, "own_cell")

    def search(key, left: pa.Table, right: pa.Table) -> pa.Table:
        out = [[], [], [], []]
        if left.num_rows and right.num_rows:
            held, names = left.column("own_word").to_pylist(), right.column("word").to_pylist()
            n_held, n_names = left.column("own_n").to_numpy(), right.column("n").to_numpy()
            trie, words_ = Trie(held, depth), _Words(names)
            state, half = (right.column(c).to_numpy().astype(np.int64) for c in ("state", "half"))
            for i, j in trie.near(words_, words_.counts()[:, depth:], state, half):
                out[0] += [names[x] for x in i.tolist()]
                out[1].append(n_names[i])
                out[2] += [held[x] for x in j.tolist()]
                out[3].append(n_held[j])
        ns = [np.concatenate(x) if x else np.zeros(0, dtype=np.int64) for x in (out[1], out[3])]
        return pa.table([pa.array(out[0], pa.string()), pa.array(ns[0], pa.int64()), pa.array(out[2], pa.string()), pa.array(ns[1], pa.int64())],
                        names=["a", "na", "b", "nb"])

    return owners.groupBy("own_cell").cogroup(asked.groupBy("cell")).applyInArrow(search, "a string, na long, b string, nb long")


def variants(words: DataFrame, ratio: int = 5, cell: int = CELL) -> DataFrame:
    """(word, n, n_near, form, form_n, root) for a table (word, n) of different words."""
    words = saved(words.select("word", "n"), "words")
    pairs = near_pairs(words, cell)
    # Both ends of a pair, and the best near word of each: highest count, then first in code-point order.
    ends = pairs.select(F.explode(F.array(F.struct(F.col("a").alias("word"), F.col("b").alias("other"), F.col("nb").alias("n")),
                                          F.struct(F.col("b").alias("word"), F.col("a").alias("other"), F.col("na").alias("n")))).alias("e"))
    best = F.min(F.struct((-F.col("e.n")).alias("less"), F.col("e.other").alias("other"))).alias("best")
    near = ends.groupBy(F.col("e.word").alias("word")).agg(F.count(F.lit(1)).alias("n_near"), best)
    out = words.join(near, "word", "left")
    takes = -F.col("best.less") >= ratio * F.col("n")
    out = saved(out.select("word", "n", F.coalesce("n_near", F.lit(0)).cast("long").alias("n_near"), F.when(takes, F.col("best.other")).alias("form"),
                           F.when(takes, -F.col("best.less")).alias("form_n")), "forms")
    # Pointer doubling over the words that have a form.
    to = saved(out.filter("form IS NOT NULL").select("word", F.col("form").alias("root")), "roots")
    while True:
        step = to.select(F.col("word").alias("root"), F.col("root").alias("__next"))
        now = saved(to.join(step, "root", "left").select("word", F.coalesce("__next", "root").alias("root"), F.col("__next").isNotNull().alias("moved")), "roots")
        moved = not now.filter("moved").isEmpty()
        forget(to)
        to = now.select("word", "root")
        if not moved:
            break
    return out.join(to, "word", "left").select("word", "n", "n_near", "form", "form_n", F.coalesce("root", "word").alias("root"))
