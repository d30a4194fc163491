"""MinHash near-duplicate detection: many universal hash minima, banding, signature verification, exact confirmation,
and connected components by alternating large-star and small-star.

1. One pass over the texts makes a sketch of each document: the size and a 128-bit fingerprint of its set of word
   shingles, ``BANDS * ROWS`` minima of universal hashes (a * x + b modulo 2**64, a odd) and a key for each band.
   Documents with equal sets are linked to the smallest doc_id among them; only one row of each set goes on, under a
   row number, so that texts that share a doc_id are compared each for itself.
2. A bucket is a band key that two or more rows hold.  Every member is paired with two of them (the smallest row
   number and the smallest hash); pairs whose signatures or sizes can't reach the threshold are dropped, the others are
   confirmed on full sets.
3. The links so far give components.  In buckets that still span several components, members of different components
   are compared by signature inside blocks of bounded size (all blocks of a bucket meet each other), and what is close
   enough is confirmed on full sets, block by block.  So no link is lost to the choice of a bucket's first members, no
   task holds a whole bucket, and no pair becomes a row.
4. Components of all links.

At similarity 0.75 a pair shares no band of 4 minima among 32 with probability 6e-6; the signature test drops estimates
more than six standard errors below the threshold.

Defined results: documents without words (or null) have empty sets and are linked with nothing; documents with fewer
words than a shingle have their whole word sequence as the one shingle; repeated rows and repeated doc_ids share a
component; rows with a null doc_id are linked with nothing and kept; other columns pass through (input columns named
like a result are replaced).
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from churnlens.llm.graph import components
from churnlens.llm.textops import Words, forget, mix64, running, saved, slices, small_batches, span_hash

BANDS, ROWS = 32, 4
PERCENT = 75
_PAIR = ("u", "v", "du", "dv")
_BLOCK = 256  # members of a bucket that are compared at once
_RNG = np.random.Generator(np.random.PCG64(75))
_A = _RNG.integers(1, 1 << 63, size=BANDS * ROWS, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_B = _RNG.integers(0, 1 << 63, size=BANDS * ROWS, dtype=np.uint64)


def shingles(w: Words, k: int = 5) -> tuple[np.ndarray, np.ndarray]:
    """(document, hash) of the distinct shingles of each document, sorted by both."""
    at, h = w.grams(k)
    doc = w.doc[at]
    short = np.flatnonzero((w.count > 0) & (w.count < k))
    if len(short):
        whole = span_hash(running(w.hash), w.begin[short], w.begin[short + 1])
        h = np.concatenate([h, mix64(whole + w.count[short].astype(np.uint64))])
        doc = np.concatenate([doc, short])
    if not len(doc):
        return doc, h
    order = np.lexsort((h, doc))
    doc, h = doc[order], h[order]
    new = np.append(True, (doc[1:] != doc[:-1]) | (h[1:] != h[:-1]))
    return doc[new], h[new]


def signatures(doc: np.ndarray, h: np.ndarray, n_docs: int) -> tuple[np.ndarray, np.ndarray]:
    """(documents with shingles, their minima): a row of BANDS * ROWS values for each."""
    begin = np.flatnonzero(np.append(True, doc[1:] != doc[:-1])) if len(doc) else np.zeros(0, dtype=np.int64)
    out = np.empty((len(begin), BANDS * ROWS), dtype=np.uint64)
    if len(begin):
        for k in range(BANDS * ROWS):
            out[:, k] = np.minimum.reduceat(h * _A[k] + _B[k], begin)
    return doc[begin], out


def band_keys(sig: np.ndarray) -> np.ndarray:
    """One key for each band (and band number) of each signature."""
    out = np.empty((len(sig), BANDS), dtype=np.uint64)
    for b in range(BANDS):
        key = np.full(len(sig), b + 1, dtype=np.uint64)
        for r in range(ROWS):
            key = mix64(key * np.uint64(0x9E3779B97F4A7C15) + sig[:, b * ROWS + r])
        out[:, b] = key
    return out


def _texts(docs: DataFrame) -> DataFrame:
    """(doc_id, text, t1, t2): the texts with a 128-bit hash, which tells the texts of one doc_id apart."""
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    return rows.select("doc_id", "text", F.xxhash64("text").alias("t1"), F.xxhash64(F.lit(1), "text").alias("t2"))


def _sketch(docs: DataFrame) -> DataFrame:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for part in slices(b):
                w = Words(part.column("text"), lower=True)
                doc, h = shingles(w)
                n = np.bincount(doc, minlength=w.n_docs)
                one, two = mix64(h), mix64(h ^ np.uint64(0xD6E8FEB86659FD93))
                total = [np.concatenate([np.zeros(1, dtype=np.uint64), np.cumsum(x, dtype=np.uint64)]) for x in (one, two)]
                off = np.concatenate([[0], np.cumsum(n)])
                marks = [t[off[1:]] - t[off[:-1]] for t in total]
                rows, sig = signatures(doc, h, w.n_docs)
                sig >>= np.uint64(32)  # keys and stored signatures see the same upper halves: equal minima mean an equal key
                keys = np.zeros((w.n_docs, BANDS), dtype=np.uint64)
                keys[rows] = band_keys(sig)
                small = np.zeros((w.n_docs, BANDS * ROWS), dtype=np.uint32)
                small[rows] = sig.astype(np.uint32)
                id_ = part.column("doc_id").combine_chunks()
                yield pa.RecordBatch.from_arrays([
                    id_, *(part.column(x).combine_chunks() for x in ("t1", "t2")), pa.array(n, pa.int64()), *(pa.array(m.view(np.int64)) for m in marks),
                    pa.array([r.tobytes() for r in small], pa.binary()),
                    pa.ListArray.from_arrays(pa.array(np.arange(w.n_docs + 1) * BANDS, pa.int32()), pa.array(keys.reshape(-1).view(np.int64)))],
                    names=["doc_id", "t1", "t2", "n", "f1", "f2", "sig", "bands"])

    return _texts(docs).mapInArrow(run, "doc_id long, t1 long, t2 long, n long, f1 long, f2 long, sig binary, bands array<long>")


def _agreement(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    return (a == b).mean(axis=-1)


def _least_estimate(percent: int) -> float:
    j = percent / 100
    return j - 6 * (j * (1 - j) / (BANDS * ROWS)) ** 0.5


def _close(pairs: DataFrame, reps: DataFrame, percent: int) -> DataFrame:
    """The pairs (u, v) whose sizes and signatures allow the threshold, with the doc_ids (du, dv) of both."""
    side = reps.select("row", "doc_id", "n", "sig")
    both = pairs.join(side.select(F.col("row").alias("v"), F.col("doc_id").alias("dv"), F.col("n").alias("nv"), F.col("sig").alias("sv")), "v")
    both = both.join(side.select(F.col("row").alias("u"), F.col("doc_id").alias("du"), F.col("n").alias("nu"), F.col("sig").alias("su")), "u")
    both = both.filter(100 * F.least("nu", "nv") >= percent * F.greatest("nu", "nv")).select(*_PAIR, "su", "sv")
    least = _least_estimate(percent)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            if b.num_rows:
                a, c = (np.frombuffer(b"".join(b.column(x).to_pylist()), dtype=np.uint32).reshape(b.num_rows, -1) for x in ("su", "sv"))
                yield b.select(list(_PAIR)).filter(pa.array(_agreement(a, c) >= least))

    return both.mapInArrow(run, "u long, v long, du long, dv long")


def _sets(docs: DataFrame, reps: DataFrame, rows: DataFrame) -> DataFrame:
    """(row, set): the sorted shingle hashes of the documents in ``rows``.

    The join is by shuffle at every size; one of several rows with the same doc_id and text is taken.
    """
    key = ["doc_id", "t1", "t2"]
    wanted = reps.select("row", *key).join(rows, "row", "left_semi")
    texts = _texts(docs).join(wanted.hint("merge"), key).dropDuplicates(key).select("row", "text")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for part in slices(b):
                w = Words(part.column("text"), lower=True)
                doc, h = shingles(w)
                off = np.searchsorted(doc, np.arange(w.n_docs + 1)).tolist()
                yield pa.RecordBatch.from_arrays([part.column("row").combine_chunks(),
                                                  pa.array([h[x:y].tobytes() for x, y in zip(off, off[1:])], pa.binary())], names=["row", "set"])

    return texts.mapInArrow(run, "row long, set binary")


def _linked(a: np.ndarray, b: np.ndarray, percent: int) -> bool:
    """Whether two sorted sets reach the threshold."""
    both = np.concatenate([a, b])
    both.sort(kind="stable")
    common = int((both[1:] == both[:-1]).sum())
    return 100 * common >= percent * (len(a) + len(b) - common)


def _confirm(pairs: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """The pairs whose full sets reach the threshold."""
    both = pairs.join(sets.select(F.col("row").alias("v"), F.col("set").alias("sv")), "v")
    both = both.join(sets.select(F.col("row").alias("u"), F.col("set").alias("su")), "u").select(*_PAIR, "su", "sv")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            keep = [_linked(np.frombuffer(x.as_buffer(), dtype=np.uint64), np.frombuffer(y.as_buffer(), dtype=np.uint64), percent)
                    for x, y in zip(b.column("su"), b.column("sv"))]
            yield b.select(list(_PAIR)).filter(pa.array(keep, pa.bool_()))

    return both.mapInArrow(run, "u long, v long, du long, dv long")


def _across(buckets: DataFrame, comp: DataFrame, reps: DataFrame, percent: int) -> DataFrame:
    """(group, row, doc_id, c, near): members of one bucket but different components that are close by size and signature.

    Buckets are cut into blocks of about ``_BLOCK`` members by hash; a pair of blocks is a group.  ``near`` holds the
    rows beyond its own that a member is close to; a pair is listed in the first band that it shares and in no other.
    No pair becomes a row.
    """
    member = buckets.join(comp, "row", "left").select("bucket", "band", "row", F.coalesce("component", "row").alias("c"))
    span = member.groupBy("bucket").agg(F.min("c").alias("lo"), F.max("c").alias("hi"), F.count(F.lit(1)).alias("size"))
    span = saved(span.filter("lo <> hi").select("bucket", F.ceil(F.col("size") / _BLOCK).cast("int").alias("blocks")), "spans")
    open_ = member.join(span, "bucket")
    open_ = open_.join(reps.select("row", "doc_id", "n", "sig"), "row")
    block = F.pmod(F.xxhash64("row"), F.col("blocks")).cast("int")
    open_ = open_.withColumn("block", block).withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
    open_ = open_.select("bucket", "band", F.least("block", "other").alias("b1"), F.greatest("block", "other").alias("b2"), "block",
                         "row", "doc_id", "c", "n", "sig")
    least = _least_estimate(percent)

    def compare(pdf: pd.DataFrame) -> pd.DataFrame:
        b1, b2, band = int(pdf["b1"].iloc[0]), int(pdf["b2"].iloc[0]), int(pdf["band"].iloc[0])
        group = int(mix64(np.array([pdf["bucket"].iloc[0]]).view(np.uint64) + np.uint64(b1 << 20 | b2)).view(np.int64)[0])
        pdf = pdf.sort_values("row", kind="stable")
        sig = np.frombuffer(b"".join(pdf["sig"]), dtype=np.uint32).reshape(len(pdf), BANDS, ROWS)
        ids, docs, c, n, block = (pdf[x].to_numpy() for x in ("row", "doc_id", "c", "n", "block"))
        near: list[list[int]] = [[] for _ in range(len(ids))]
        seen = np.zeros(len(ids), dtype=bool)
        for i in range(len(ids) - 1):
            j = np.arange(i + 1, len(ids))
            j = j[(c[j] != c[i]) & (100 * np.minimum(n[j], n[i]) >= percent * np.maximum(n[j], n[i])) & ((b1 == b2) | (block[j] != block[i]))]
            if len(j):
                same = sig[j] == sig[i]
                j = j[(same.mean(axis=(1, 2)) >= least) & ~same[:, :band].all(axis=2).any(axis=1)]
            if len(j):
                near[i] = ids[j].tolist()
                seen[i] = seen[j] = True
        return pd.DataFrame({"group": group, "row": ids[seen], "doc_id": docs[seen], "c": c[seen],
                             "near": [np.array(x, dtype=np.int64).tobytes() for x, s in zip(near, seen) if s]})

    return open_.groupBy("bucket", "b1", "b2").applyInPandas(compare, "group long, row long, doc_id long, c long, near binary")


def _confirm_groups(near: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """Links (du, dv) between different components, from full sets; what earlier links of a group join isn't looked at."""
    def check(pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values("row", kind="stable")
        ids = pdf["row"].tolist()
        c, docs = dict(zip(ids, pdf["c"].tolist())), dict(zip(ids, pdf["doc_id"].tolist()))
        held = {d: np.frombuffer(x, dtype=np.uint64) for d, x in zip(ids, pdf["set"])}
        parent = {x: x for x in c.values()}

        def find(x: int) -> int:
            while parent[x] != x:
                parent[x] = x = parent[parent[x]]
            return x

        out = []
        for d, others in zip(ids, pdf["near"]):
            for e in np.frombuffer(others, dtype=np.int64).tolist():
                x, y = find(c[d]), find(c[e])
                if x != y and _linked(held[d], held[e], percent):
                    parent[x] = y
                    out.append((docs[e], docs[d]))
        return pd.DataFrame(out, columns=["du", "dv"]).astype("int64")

    return near.join(sets, "row").groupBy("group").applyInPandas(check, "du long, dv long")


def near_duplicates(docs: DataFrame, percent: int = PERCENT) -> DataFrame:
    """One row per row of ``docs``: doc_id, n_shingles, component_id, kept (whether it is the component's smallest)."""
    spark = docs.sparkSession
    small_batches(spark, 512)
    sketch = saved(_sketch(docs), "sketch")
    filled = sketch.filter("n > 0 AND doc_id IS NOT NULL")

    # Equal sets: every document is linked with the smallest of its set, which stands for all.
    same = saved(filled.groupBy("n", "f1", "f2").agg(F.min("doc_id").alias("rep"), F.max("doc_id").alias("last"))
                 .filter("rep <> last").drop("last"), "same")
    copies = filled.select("doc_id", "n", "f1", "f2").join(same, ["n", "f1", "f2"])
    copies = saved(copies.filter("doc_id <> rep").distinct(), "copies")
    # One row of each set goes on, under a number of its own: a doc_id may have several texts.
    key = ["doc_id", "n", "f1", "f2"]
    reps = filled.join(copies.select(*key), key, "left_anti").dropDuplicates(key)
    reps = saved(reps.select(F.monotonically_increasing_id().alias("row"), "doc_id", "t1", "t2", "n", "sig", "bands"), "reps")

    # Buckets with two members or more; all members are paired with two of them.
    held = reps.select("row", F.posexplode("bands").alias("band", "bucket"))
    by_hash = F.min_by("row", F.xxhash64("row"))
    first = saved(held.groupBy("bucket").agg(F.min("row").alias("first"), F.max("row").alias("last"), by_hash.alias("second"))
                  .filter("first <> last").select("bucket", "first", "second"), "buckets")
    buckets = saved(held.join(first, "bucket"), "members")
    pairs = buckets.select("row", F.explode(F.array("first", "second")).alias("other")).filter("row <> other")
    pairs = pairs.select(F.greatest("row", "other").alias("u"), F.least("row", "other").alias("v")).distinct()
    close = saved(_close(pairs, reps, percent), "close")
    rows = close.select(F.col("u").alias("row")).unionByName(close.select(F.col("v").alias("row"))).distinct()
    sets = saved(_sets(docs, reps, rows), "sets")
    links = saved(_confirm(close, sets, percent), "links")
    forget(first, close, sets)

    # What those two have not linked.
    comp = saved(components(links.select("u", "v")).select(F.col("node").alias("row"), "component"), "components")
    near = saved(_across(buckets.select("bucket", "band", "row"), comp, reps, percent), "near")
    more = saved(_confirm_groups(near, _sets(docs, reps, near.select("row").distinct()), percent), "links")
    forget(buckets, near, reps)
    joined = links.select("du", "dv").unionByName(more).toDF("u", "v")
    final = components(joined.unionByName(copies.select(F.col("doc_id").alias("u"), F.col("rep").alias("v"))))
    final = saved(final.select(F.col("node").alias("doc_id"), "component"), "components")
    forget(same, copies, comp, links, more)
    out = sketch.select("doc_id", F.col("n").alias("n_shingles")).join(final, "doc_id", "left")
    own = F.coalesce("component", "doc_id")
    return out.select("doc_id", "n_shingles", own.alias("component_id"), F.coalesce(F.col("doc_id") == own, F.lit(True)).alias("kept"))


def drop_near_duplicates(docs: DataFrame, percent: int = PERCENT) -> DataFrame:
    """One row of ``docs`` for each group, with its smallest doc_id; rows without words or doc_id stay unless their
    doc_id goes.  Of several rows with that doc_id and words the one with the smallest hash stays."""
    near = near_duplicates(docs, percent)
    gone = near.filter(~F.col("kept")).select("doc_id").distinct()
    often = near.filter("kept AND n_shingles > 0 AND doc_id IS NOT NULL").groupBy("doc_id").count().filter("count > 1")
    often = saved(often.select(F.col("doc_id").alias("__id")), "repeated")
    apart = gone.select(F.col("doc_id").alias("__id")).unionByName(often)
    once = docs.join(apart, docs["doc_id"] == apart["__id"], "left_anti")
    again = docs.join(often, docs["doc_id"] == often["__id"], "left_semi")
    has_words = F.coalesce(F.col("text").cast("string"), F.lit("")).rlike("[^\\x20\\x09-\\x0D]")
    again = again.withColumn("__own", F.when(has_words, F.lit(-1)).otherwise(F.monotonically_increasing_id()))
    columns = [F.col(f"`{c}`") for c in docs.columns]
    one = again.groupBy("doc_id", "__own").agg(F.min_by(F.struct(*columns), F.xxhash64(*columns)).alias("__row"))
    return once.unionByName(one.select("__row.*"))
