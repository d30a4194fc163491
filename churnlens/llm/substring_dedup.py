"""Substring deduplication with repeated-phrase automata.

A window is ``window`` consecutive words of one document.  A word goes if it is covered by a window whose words, in
that order, also start in a document with a smaller doc_id.

1. Phrases.  Of the ``phrase``-word sequences inside a window the one with the smallest hash stands for the window, so
   equal windows have equal phrases.  Phrases that two or more documents hold are confirmed as recurring.
2. Automata.  Documents are dealt to shards of a few megabytes.  Each shard gets the recurring phrases that its
   documents hold, compiles them, as text, into one Aho-Corasick automaton, and streams all its documents through it to
   locate every occurrence.  A window is a candidate if its phrase is among the occurrences.
3. Exact check.  Candidate windows are compared by 96-bit fingerprints of all their words: inside the shard first, so
   that a shard sends each different window once, with the smallest document that has it, then across shards.
4. Each shard removes the covered words of its documents.

A window that recurs in every document is sent once by each shard, never once by each document.  Rows that are alike in
doc_id and text have the same result: beyond ``_OFTEN`` of them one goes on and the others take its result, so that no
shard holds a group of equal rows.

Defined results: null texts have no words; documents shorter than a window keep everything; rows with a null doc_id
neither lose words nor count as a source; rows with equal doc_ids are no source for each other; a table without rows
gives no rows; other columns pass through (input columns named like a result are replaced).
"""

from __future__ import annotations

import re

import ahocorasick
import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from churnlens.llm.textops import Words, forget, mix64, running, saved, sized, slices, small_batches, span_hash

WINDOW, PHRASE = 50, 8
_SHARD = 4 << 20  # bytes of text in a shard
_OFTEN = 32  # equal rows that go to a shard as they are, at most
_TOP = np.uint64(0xFFFFFFFFFFFFFFFF)
_SPLIT = re.compile(r"[\x20\x09-\x0D]+")


def _sliding_min(h: np.ndarray, width: int) -> np.ndarray:
    m, step = h, 1
    while step * 2 <= width:
        m = np.minimum(m[:-step], m[step:])
        step *= 2
    rest = width - step
    return np.minimum(m[:len(m) - rest], m[rest:]) if rest else m


class Windows:
    """The windows of a slice of documents and the phrase that stands for each."""

    def __init__(self, texts: pa.Array, window: int, phrase: int):
        self.words = w = Words(texts)
        n = len(w.start)
        self.at, self.first = w.grams(window)
        self.second = np.zeros(0, dtype=np.uint32)
        self.phrases = np.zeros(0, dtype=np.uint64)  # hash of the phrase that starts at each word
        self.least = np.zeros(0, dtype=np.uint64)
        if len(self.at):
            start = np.arange(n - phrase + 1)
            self.phrases = span_hash(running(w.hash), start, start + phrase)
            self.width = window - phrase + 1
            self.least = _sliding_min(self.phrases, self.width)[self.at]
            again = span_hash(running(mix64(w.hash ^ np.uint64(0xA0761D6478BD642F))), self.at, self.at + window)
            self.second = (again >> np.uint64(32)).astype(np.uint32)
        self.doc = w.doc[self.at]


def _phrases(docs: DataFrame, window: int, phrase: int, shards: int) -> DataFrame:
    """(phrase, shard, lo, hi): the phrases that stand for windows, and the doc_ids that hold them, for each batch."""
    def run(batches):
        for b in batches:
            got = []
            for part in slices(b, "__text"):
                w = Windows(part.column("__text"), window, phrase)
                if len(w.at):
                    ids = part.column("__id").to_numpy()
                    shard = part.column("__shard").to_numpy()
                    new = np.append(True, (w.least[1:] != w.least[:-1]) | (w.doc[1:] != w.doc[:-1]))
                    got.append((w.least[new], shard[w.doc[new]], ids[w.doc[new]]))
            if got:
                h, shard, ids = (np.concatenate(x) for x in zip(*got))
                order = np.lexsort((shard, h))
                h, shard, ids = h[order], shard[order], ids[order]
                begin = np.flatnonzero(np.append(True, (h[1:] != h[:-1]) | (shard[1:] != shard[:-1])))
                yield pa.RecordBatch.from_arrays([
                    pa.array(h[begin].view(np.int64)), pa.array(shard[begin], pa.int32()),
                    pa.array(np.minimum.reduceat(ids, begin)), pa.array(np.maximum.reduceat(ids, begin))], names=["phrase", "shard", "lo", "hi"])

    return docs.filter("__id IS NOT NULL").select("__id", "__shard", "__text").mapInArrow(run, "phrase long, shard int, lo long, hi long")


def _ordered(docs: pa.Table, key: str, text: str) -> pa.Table:
    """A shard's documents in an order that does not depend on how they arrived, with the ids as ``__id``."""
    docs = docs.sort_by([(key, "ascending"), (text, "ascending")])
    return docs.append_column("__id", docs.column(key).cast(pa.int64()))


class Locator:
    """An Aho-Corasick automaton over the recurring phrases of a shard, on words joined by single spaces."""

    def __init__(self, slices_: list[Windows], recurring: np.ndarray, window: int, phrase: int):
        self.window = window
        self.auto, seen = ahocorasick.Automaton(ahocorasick.STORE_LENGTH), set()
        for w in slices_:
            if not len(w.at):
                continue
            here = np.intersect1d(np.unique(w.least), recurring)
            data, words = w.words.buf.tobytes(), w.words
            inside = words.doc[:len(w.phrases)] == words.doc[phrase - 1:]  # documents stand in the buffer without a separator
            spots = np.flatnonzero(inside & np.isin(w.phrases, here))
            spots = spots[np.unique(w.phrases[spots], return_index=True)[1]]
            for p in spots.tolist():
                text = " ".join(_SPLIT.split(data[words.start[p]:words.end[p + phrase - 1]].decode()))
                if text not in seen:
                    seen.add(text)
                    self.auto.add_word(f" {text} ")
        self.size = len(seen)
        if seen:
            self.auto.make_automaton()

    def occurrences(self, w: Words) -> np.ndarray:
        """The words at which a phrase starts."""
        out = []
        data = w.buf.tobytes()
        for d in range(w.n_docs):
            a, b = int(w.begin[d]), int(w.begin[d + 1])
            if b - a < self.window:
                continue
            text = data[w.off[d]:w.off[d + 1]].decode()
            words = [x for x in _SPLIT.split(text) if x]
            found = [end - size + 1 for end, size in self.auto.iter(f" {' '.join(words)} ")]
            if found:
                place = np.concatenate([[0], np.cumsum(np.fromiter(map(len, words), dtype=np.int64, count=len(words)) + 1)])
                out.append(a + np.searchsorted(place, found))
        return np.concatenate(out) if out else np.zeros(0, dtype=np.int64)


_BLOB = "part int, shard int, f1 binary, f2 binary, id binary, at binary, known boolean"
_DTYPES = (("f1", np.uint64), ("f2", np.uint32), ("id", np.int64), ("at", np.int64))


def _candidates(docs: DataFrame, recurring: DataFrame, window: int, phrase: int, parts: int, id_: str, text: str) -> DataFrame:
    """Candidate windows of each shard: those its smallest document has (to be compared across shards), packed by
    fingerprint part, and the removable ones it has settled itself (``known``).  ``at`` is document << 32 | word."""
    names = [c.split(" ")[0] for c in _BLOB.split(", ")]

    def run(key, left: pa.Table, right: pa.Table) -> pa.Table:
        rows = []
        shard = key[0].as_py()
        left = _ordered(left, id_, text)
        if right.num_rows and left.num_rows:
            parted, base = [], 0
            for part in slices(left, text):
                parted.append((base, part.column("__id"), Windows(part.column(text), window, phrase)))
                base += part.num_rows
            locator = Locator([w for _, _, w in parted], np.unique(right.column("phrase").to_numpy().view(np.uint64)), window, phrase)
            got = []
            for base, ids, w in parted if locator.size else []:
                spots = locator.occurrences(w.words) if len(w.at) else ()
                if not len(spots):
                    continue
                located = np.full(len(w.phrases), _TOP)
                located[spots] = w.phrases[spots]
                is_null = ids.is_null().to_numpy()
                hit = (_sliding_min(located, w.width)[w.at] == w.least) & ~is_null[w.doc]
                doc = w.doc[hit]
                place = (base + doc) << 32 | (w.at[hit] - w.words.begin[doc])
                got.append((w.first[hit], w.second[hit], ids.fill_null(0).to_numpy()[doc], place))
            if got:
                f1, f2, ids, at = (np.concatenate(x) for x in zip(*got))
                order = np.lexsort((ids, f2, f1))
                f1, f2, ids, at = f1[order], f2[order], ids[order], at[order]
                least = _group_least(f1, f2, ids)
                known = ids > least
                if known.any():
                    rows.append((0, shard, b"", b"", b"", at[known].tobytes(), True))
                f1, f2, ids, at = f1[~known], f2[~known], ids[~known], at[~known]
                # the part of each fingerprint (its 32 high bits times parts, scaled); fingerprints are sorted, so a part is a run
                part_of = ((f1 >> np.uint64(32)) * np.uint64(parts)) >> np.uint64(32)
                cut = np.flatnonzero(np.append(True, part_of[1:] != part_of[:-1])) if len(f1) else np.zeros(0, dtype=np.int64)
                for a, b in zip(cut.tolist(), np.append(cut[1:], len(f1)).tolist()):
                    rows.append((int(part_of[a]), shard, *(x[a:b].tobytes() for x in (f1, f2, ids, at)), False))
        cols = list(zip(*rows)) if rows else [[] for _ in names]
        kinds = [pa.int32(), pa.int32(), pa.binary(), pa.binary(), pa.binary(), pa.binary(), pa.bool_()]
        return pa.table([pa.array(c, t) for c, t in zip(cols, kinds)], names=names)

    return docs.groupBy("__shard").cogroup(recurring.groupBy("shard")).applyInArrow(run, _BLOB)


def _group_least(f1: np.ndarray, f2: np.ndarray, ids: np.ndarray) -> np.ndarray:
    """The smallest id of each run of equal fingerprints (sorted by fingerprint, then id), for each member."""
    new = np.append(True, (f1[1:] != f1[:-1]) | (f2[1:] != f2[:-1]))
    return ids[new][np.cumsum(new) - 1]


def _settled(candidates: DataFrame) -> DataFrame:
    """(shard, at): the windows to remove.  A group is a range of fingerprints."""
    spread = F.when(F.col("known"), -1 - F.col("shard")).otherwise(F.col("part"))

    def run(key, table: pa.Table) -> pa.Table:
        if key[0].as_py() < 0:
            return table.select(["shard", "at"])
        cols = [np.frombuffer(b"".join(table.column(c).to_pylist()), dtype=t) for c, t in _DTYPES]
        sizes = np.array([len(x) // 8 for x in table.column("at").to_pylist()])
        shard = np.repeat(table.column("shard").to_numpy(), sizes)
        f1, f2, ids, at = cols
        order = np.lexsort((ids, f2, f1))
        f1, f2, ids, at, shard = f1[order], f2[order], ids[order], at[order], shard[order]
        gone = ids > _group_least(f1, f2, ids)
        at, shard = at[gone], shard[gone]
        order = np.argsort(shard, kind="stable")
        at, shard = at[order], shard[order]
        cut = np.flatnonzero(np.append(True, shard[1:] != shard[:-1])) if len(shard) else np.zeros(0, dtype=np.int64)
        ends = np.append(cut[1:], len(shard))
        return pa.table([pa.array(shard[cut], pa.int32()), pa.array([at[a:b].tobytes() for a, b in zip(cut.tolist(), ends.tolist())], pa.binary())],
                        names=["shard", "at"])

    return candidates.withColumn("__group", spread).groupBy("__group").applyInArrow(
        lambda key, t: run(key, t), "shard int, at binary")


RESULTS = ("n_words", "n_removed", "removed_spans", "kept_text")


def dedup_substrings(docs: DataFrame, window: int = WINDOW, phrase: int = PHRASE, key: str = "doc_id", text: str = "text") -> DataFrame:
    """``docs`` with n_words, n_removed, removed_spans (array of first word, end word) and kept_text (the words that
    stay, joined by single spaces).  A window shorter than ``phrase`` is its own phrase."""
    small_batches(docs.sparkSession)
    phrase = min(phrase, window)
    columns = [F.col(f"`{c}`") for c in docs.columns if c not in RESULTS]
    mark = [F.xxhash64(F.col(key), F.col(text)).alias("__h1"), F.xxhash64(F.lit(1), F.col(key), F.col(text)).alias("__h2")]
    size = F.octet_length(F.col(text).cast("string"))
    alike = saved(docs.select(*mark, size.alias("size")).groupBy("__h1", "__h2").agg(
        F.count(F.lit(1)).alias("n"), F.coalesce(F.max("size"), F.lit(0)).cast("long").alias("size")), "alike")
    often = F.col("n") > _OFTEN
    total, groups = alike.agg(F.sum(F.when(often, F.col("size")).otherwise(F.col("n") * F.col("size"))), F.count_if(often)).first()
    total = int(total or 0)
    if not groups:
        forget(alike)
        return _dedup(docs.select(*columns), total, window, phrase, key, text)

    pair = ["__h1", "__h2"]
    hot = alike.filter(often).select(*pair)
    marked = docs.select(*columns, *mark)
    again = marked.join(hot, pair, "left_semi")
    one = again.groupBy(*pair).agg(F.first(F.col(key)).alias(key), F.first(F.col(text)).alias(text))
    once = marked.join(hot, pair, "left_anti").select(*columns, *[F.lit(None).cast("long").alias(h) for h in pair])
    done = saved(_dedup(once.unionByName(one, allowMissingColumns=True), total, window, phrase, key, text), "dedup")
    # A hot group is split by the join: its one result is sent to every part of it.
    result = done.filter("__h1 IS NOT NULL").select(*pair, *RESULTS)
    return done.filter("__h1 IS NULL").drop(*pair).unionByName(again.join(result, pair).drop(*pair))


def _dedup(docs: DataFrame, n_bytes: int, window: int, phrase: int, key: str, text: str) -> DataFrame:
    """``docs`` (without columns named like a result) with the results."""
    kept = list(docs.schema)
    shards = sized(n_bytes, _SHARD)
    shard = F.pmod(F.xxhash64(F.col(key), F.col(text)), F.lit(shards)).cast("int").alias("__shard")
    # One deal of the documents serves both passes over the shards.
    rows = docs.select(*[F.col(f"`{f.name}`") for f in kept], shard)
    slim = docs.select(F.col(key).cast("long").alias("__id"), F.col(text).cast("string").alias("__text"), shard)

    held = _phrases(slim, window, phrase, shards)
    recurring = held.groupBy("phrase").agg(F.min("lo").alias("lo"), F.max("hi").alias("hi")).filter("lo < hi").select("phrase")
    recurring = held.select("phrase", "shard").join(recurring, "phrase").select("phrase", "shard")
    gone = _settled(_candidates(rows, recurring, window, phrase, shards, key, text))

    names = [f.name for f in kept]
    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in kept)
    schema += ", n_words long, n_removed long, removed_spans array<struct<first:int,end:int>>, kept_text string"

    def remove(left: pa.Table, right: pa.Table) -> pa.Table:
        left = _ordered(left, key, text)
        at = np.concatenate([np.frombuffer(x, dtype=np.int64) for x in right.column("at").to_pylist()]) if right.num_rows else np.zeros(0, dtype=np.int64)
        at = np.sort(at)
        out = []
        base = 0
        for part in slices(left, text):
            w = Words(part.column(text))
            own = at[np.searchsorted(at, base << 32):np.searchsorted(at, (base + part.num_rows) << 32)]
            doc, word = (own >> 32) - base, own & 0xFFFFFFFF
            edge = np.zeros(len(w.start) + 1, dtype=np.int64)
            first = w.begin[doc] + word
            np.add.at(edge, first, 1)
            np.add.at(edge, first + window, -1)
            lost = np.cumsum(edge[:-1]) > 0
            data = w.buf.tobytes()
            n_removed, spans, texts = [], [], []
            for d in range(w.n_docs):
                a, b = int(w.begin[d]), int(w.begin[d + 1])
                cover = lost[a:b]
                n = int(cover.sum())
                n_removed.append(n)
                words = [x for x in _SPLIT.split(data[w.off[d]:w.off[d + 1]].decode()) if x]
                if n:
                    turn = np.flatnonzero(np.diff(np.concatenate([[0], cover.astype(np.int8), [0]])))
                    spans.append([{"first": x, "end": y} for x, y in zip(turn[::2].tolist(), turn[1::2].tolist())])
                    words = [x for x, gone_ in zip(words, cover.tolist()) if not gone_]
                else:
                    spans.append([])
                texts.append(" ".join(words))
            part = part.select(names).combine_chunks()
            out.append(pa.table([*(part.column(c) for c in names), pa.array(w.count, pa.int64()), pa.array(n_removed, pa.int64()),
                                 pa.array(spans, pa.list_(pa.struct([("first", pa.int32()), ("end", pa.int32())]))), pa.array(texts, pa.string())],
                                names=[*names, *RESULTS]))
            base += w.n_docs
        return pa.concat_tables(out) if out else pa.table([*(left.select(names).column(c) for c in names), pa.array([], pa.int64()), pa.array([], pa.int64()),
                                                           pa.array([], pa.list_(pa.struct([("first", pa.int32()), ("end", pa.int32())]))), pa.array([], pa.string())],
                                                          names=[*names, *RESULTS])

    return rows.groupBy("__shard").cogroup(gone.groupBy("shard")).applyInArrow(remove, schema)


def drop_repeats(docs: DataFrame, window: int = WINDOW) -> DataFrame:
    """``docs`` with the repeated passages cut out of the texts; untouched texts stay as they are, n_chars follows."""
    cut = dedup_substrings(docs, window)
    text = F.when(F.col("n_removed") > 0, F.col("kept_text")).otherwise(F.col("text"))
    size = F.when(F.col("n_removed") > 0, F.length("kept_text").cast("long")).otherwise(F.col("n_chars")) if "n_chars" in docs.columns else None
    return cut.select(*[text.alias("text") if c == "text" else size.alias("n_chars") if c == "n_chars" else F.col(f"`{c}`") for c in docs.columns])
