"""Byte-level BPE, token counts, packing and sharding against the libraries and brute force."""

import base64
import hashlib
import random
import zlib

import numpy as np
import public_tokenizers as P
import pyarrow as pa
import pytest
import tiktoken
from pyspark.sql import functions as F
from pyspark.sql import types as T
from tokenizers import Tokenizer

from churnlens.llm import bpe, packing, sharding, token_count
from churnlens.llm.textops import Memo, Words

MULTI = P.path("byte_bpe_multi_50k.tiktoken")
DOCS = T.StructType([T.StructField("doc_id", T.LongType()), T.StructField("text", T.StringType()),
                     T.StructField("size", T.StringType()), T.StructField("ids", T.StringType())])
ALPHABET = " \n\t  abcdeé's't  \x1c\x85  　 !?12٣中ßΣİ\U0001F600́ǅaaaaa \n"


def odd_texts(n=300):
    rng = random.Random(5)
    texts = ["".join(rng.choice(ALPHABET) for _ in range(rng.randint(0, 60))) for _ in range(n)]
    return [*texts, "", " ", "  a ", "a" * 5000, "ab" * 3000, "x<|endoftext|>y <|endoftext|>", "<|startoftext|>", "same same", "same same",
            "".join(rng.choice("abcdefgh ") for _ in range(20000)), None]


@pytest.fixture(scope="module")
def docs(spark):
    return spark.createDataFrame([(i, t, "clash", None) for i, t in enumerate(odd_texts())], DOCS).repartition(3)


@pytest.fixture(scope="module")
def library():
    ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, open(MULTI, "rb"))}
    return tiktoken.Encoding("own", pat_str=P.PATTERN, mergeable_ranks=ranks, special_tokens={})


def test_bpe_digests_match_the_library(docs, library):
    texts = odd_texts()
    got = {r.doc_id: r for r in bpe.digests(docs, MULTI, P.PATTERN).collect()}
    assert len(got) == len(texts)
    for i, t in enumerate(texts):
        ids = library.encode_ordinary(t or "")
        assert got[i].n_tokens == len(ids)
        assert got[i].ids_sha256 == hashlib.sha256(",".join(map(str, ids)).encode()).hexdigest()
        assert got[i].decoded_sha256 == hashlib.sha256((t or "").encode()).hexdigest()


def test_bpe_columns_round_trip(docs):
    rows = bpe.decode(bpe.encode(docs, MULTI, P.PATTERN), MULTI, P.PATTERN).collect()
    assert all(bytes(r.decoded) == (r.text or "").encode() and r.size == "clash" for r in rows)


def test_one_piece_queue_equals_the_shared_queue(library):
    c = bpe.coder(MULTI, P.PATTERN)
    rng = random.Random(7)
    pieces = ["".join(rng.choice("abcdeinrst") for _ in range(rng.randint(1, 80))).encode() for _ in range(500)] + [b"a" * 3000]
    shared = c.merge_all(pieces)
    assert shared == [c.bpe.encode(p) for p in pieces]
    assert shared == [library.encode_ordinary(p.decode()) for p in pieces]


def test_lower_rank_that_comes_up_later_goes_first():
    # rank 1 merges (b, c); its result then makes rank 0 with the a before it, ahead of the second (b, c)
    byte = list(range(256))
    pairs = {98 * bpe._CODE + 99: 1, 97 * bpe._CODE + 301: 0}
    one = bpe.RankQueueBpe(byte, pairs, [300, 301])
    assert one.encode(b"abcbc") == [300, 301]
    queue = bpe.RankQueue(pairs, np.array([300, 301], dtype=np.int32))
    tok = np.array([97, 98, 99, 98, 99, -1], dtype=np.int32)
    assert len(queue.merge(tok)) == 1  # reported, so that the caller merges this piece alone


def test_token_counts_match_the_library(docs):
    tk = Tokenizer.from_file(P.path("word_bpe_49k.json"))
    got = {r.doc_id: r for r in token_count.count_tokens(docs, P.path("word_bpe_49k.json"), 100).collect()}
    for i, t in enumerate(odd_texts()):
        n = len(tk.encode(t or "", add_special_tokens=False).ids)
        assert (got[i].n_tokens, got[i].n_bytes, got[i].over_limit) == (n, len((t or "").encode()), n > 100), repr(t)


def test_whole_token_proof():
    c = token_count.counter(P.path("word_bpe_49k.json"))
    assert b"the" in c.whole and len(c.whole) > 20_000
    assert all(n == 1 for n in c.merged(sorted(c.whole)[:2000]))


def pieces_of(spark, docs, **more):
    return packing.pack(docs, P.path("byte_bpe_50k.json"), P.PATTERN, **more).collect()


def test_packing_is_whole_gapless_and_dense(spark, docs):
    tk = Tokenizer.from_file(P.path("byte_bpe_50k.json"))
    rows = pieces_of(spark, docs, open_windows=4)
    by_doc, by_seq = {}, {}
    for r in rows:
        by_doc.setdefault(r.doc_id, []).append(r)
        by_seq.setdefault(r.sequence_id, []).append(r)
    texts = odd_texts()
    assert set(by_doc) == set(range(len(texts)))
    for i, t in enumerate(texts):
        ids = np.array([*tk.encode(t or "", add_special_tokens=False).ids, 0], dtype="<u4")
        at = 0
        for r in sorted(by_doc[i], key=lambda r: r.start):
            assert (r.start, r.doc_tokens) == (at, len(ids))
            assert r.ids_crc32 == zlib.crc32(ids[r.start:r.start + r.length].tobytes())
            at += r.length
        assert at == len(ids)
    for held in by_seq.values():
        at = 0
        for r in sorted(held, key=lambda r: r.offset):
            assert r.offset == at
            at += r.length
        assert at <= 1024
    used = sum(r.length for r in rows)
    assert used / (1024 * len(by_seq)) > 0.95


def test_packing_can_return_the_ids(spark, docs):
    for r in pieces_of(spark, docs, with_ids=True):
        assert r.ids_crc32 == zlib.crc32(np.array(r.ids, dtype="<u4").tobytes()) and len(r.ids) == r.length


def test_best_fit_takes_the_fullest_window_that_fits():
    w = packing.Windows(10, 2)
    assert w.place(6) == (0, 0) and w.place(7) == (1, 0)
    assert w.place(3) == (1, 7)  # the fullest that fits is closed by it
    assert w.place(5) == (2, 0)
    assert w.place(9) == (3, 0)  # none fits: window 0, the fullest, is emitted
    assert w.open() == {2, 3}


def test_sharding_moves_only_into_the_new_shard(spark):
    rows = spark.range(4000).selectExpr("id as doc_id", "if(id % 7 = 0, null, repeat('x', cast(id % 50 as int))) as text", "'a' as shard", "'b' as extra")
    got = sharding.assign(rows, [1.0, 1.0, 2.0]).collect()
    assert len(got) == 4000 and all(r.grown_shard in (r.shard, 3) for r in got)
    share = np.bincount([r.shard for r in got]) / 4000
    assert abs(share - np.array([0.25, 0.25, 0.5])).max() < 0.03
    assert abs(sum(r.grown_shard == 3 for r in got) / 4000 - 0.2) < 0.03
    for s in range(3):
        assert sorted(r.slot for r in got if r.shard == s) == list(range(sum(r.shard == s for r in got)))
    for r in got[:200]:
        t = b"" if r.doc_id % 7 == 0 else b"x" * (r.doc_id % 50)
        assert (r.size, r.text_crc32) == (len(t) + 1, zlib.crc32(t))


def test_sharding_of_repeated_rows_and_null_keys(spark):
    rows = spark.createDataFrame([(None, "a"), (None, "a"), (1, None), (1, None)], "doc_id long, text string")
    got = sharding.assign(rows, [1.0] * 8).collect()
    assert sorted((r.shard, r.slot) for r in got if r.doc_id is None) in ([(s, k) for k in (0, 1)] for s in range(8)) or len({r.shard for r in got}) == 1
    assert len({(r.shard, r.slot) for r in got}) == 4


@pytest.mark.parametrize("run", [
    lambda d: bpe.digests(d, MULTI, P.PATTERN), lambda d: token_count.count_tokens(d, P.path("word_bpe_49k.json"), 5),
    lambda d: packing.pack(d, P.path("byte_bpe_50k.json"), P.PATTERN), lambda d: sharding.assign(d, [1.0] * 8)])
def test_empty_tables(spark, run):
    assert run(spark.createDataFrame([], "doc_id long, text string")).count() == 0
    assert run(spark.createDataFrame([(None, None)], "doc_id long, text string")).count() == 1


def test_memo_keeps_what_comes_back():
    made = []

    def letters(words):
        made.extend(words)
        return [list(w.encode()) for w in words]

    memo, rng = Memo(letters, most=40), random.Random(2)
    for turn in range(60):
        words = ["often", "usual", *(f"w{rng.randrange(400)}" for _ in range(15))]
        w = Words(pa.array([" ".join(words)]))
        at, size = memo.find(w.hash, w.buf, w.start, w.end)
        assert [bytes(memo.flat[a:a + n].tolist()).decode() for a, n in zip(at.tolist(), size.tolist())] == words
        assert len(memo.young.keys) <= 40 + 17
    assert made.count("often") == made.count("usual") == 1 and len(made) > len(set(made))  # rare ones are made again


def test_copies_of_one_row_fill_many_cells(spark, monkeypatch):
    monkeypatch.setattr(sharding, "_CELL", 50)
    docs = spark.range(6000).select(F.when(F.col("id") < 4000, 7).otherwise(F.col("id")).alias("doc_id"), F.lit("same").alias("text")).repartition(5)
    sizes = []
    real = sharding.saved

    def seen(df, name):
        out = real(df, name)
        cells = out.select(F.pmod(F.xxhash64("__row"), F.lit(15)).alias("c"), "shard").groupBy("shard", "c").count()
        sizes.append(cells.agg(F.max("count")).first()[0])
        return out

    monkeypatch.setattr(sharding, "saved", seen)
    rows = sharding.assign(docs, [1.0] * 8).collect()
    assert max(sizes) < 500  # 4,000 copies of one row in one shard
    for s in range(8):
        assert sorted(r.slot for r in rows if r.shard == s) == list(range(sum(r.shard == s for r in rows)))
