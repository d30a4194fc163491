"""Token counts by the whole-token shortcut.

Offline, every vocabulary string that ends a word is put through the merges; those that come out as one token are
proved whole.  A pre-token among them counts as one at once; only the others are merged, all unseen ones of a slice
of texts in one queue.  White space separates pre-tokens and counts nothing, so a text's count is the sum over its
words, and each distinct word is normalised, cut and counted once while it is kept.

Defined results: a null text counts as empty (no bytes, no tokens); special strings inside a text are one token each,
as the library's default has it; other columns are not read; a table without rows gives no rows.
"""

from __future__ import annotations

import re
import unicodedata
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from churnlens.llm.bpe import RankQueue, byte_letters, load_json
from churnlens.llm.textops import Memo, Words, slices, small_batches

#: Fixed value: the pre-token pattern of lower-case vocabularies with word ends (white space is dropped).
WORD_PATTERN = r"""'s|'t|'re|'ve|'m|'ll|'d|[\p{L}]+|[\p{N}]|[^\p{White_Space}\p{L}\p{N}]+"""
WORD_END = "</w>"
_SLICE = 2 << 20


class WordCounter:
    def __init__(self, path: str):
        vocab, pairs, made, special = load_json(path)
        letters = byte_letters()
        self.queue = RankQueue(pairs, np.array(made, dtype=np.int32))
        self.byte = np.array([vocab[c] for c in letters], dtype=np.int32)
        self.last = np.array([vocab[c + WORD_END] for c in letters], dtype=np.int32)
        self.split = regex.compile(WORD_PATTERN).findall
        self.special = re.compile("|".join(map(re.escape, special))) if special else None
        byte_of = {c: b for b, c in enumerate(letters)}
        ends = [bytes(map(byte_of.__getitem__, t[:-len(WORD_END)])) for t in vocab
                if t.endswith(WORD_END) and t not in special and len(t) > len(WORD_END)]
        self.whole = {t for t, n in zip(ends, self.merged(ends)) if n == 1}  # the proof
        self.memo = Memo(self.count_words)

    def merged(self, pieces: list[bytes]) -> list[int]:
        """The number of tokens of each pre-token after all merges."""
        if not pieces:
            return []
        flat = np.frombuffer(b"\0".join(pieces) + b"\0", dtype=np.uint8)
        end = np.cumsum(np.fromiter(map(len, pieces), dtype=np.int64, count=len(pieces)) + 1)
        tok = self.byte[flat]
        tok[end - 2] = self.last[flat[end - 2]]
        tok[end - 1] = -1
        if len(self.queue.merge(tok)):
            raise ValueError("the merges are not in an order in which they can be learnt")
        live = np.cumsum(tok >= 0)[end - 1]
        return np.diff(live, prepend=0).tolist()

    def pre_tokens(self, text: str) -> list[str]:
        if not text.isascii():
            text = unicodedata.normalize("NFC", text).replace("Σ", "σ")  # lower case letter by letter
        return self.split(text.lower())

    def count_words(self, words: list[str]) -> list[tuple[int]]:
        sure, parts = [], []
        for w in words:
            n, pieces = 0, []
            if self.special and "<" in w:
                cut = self.special.split(w)
                n = len(cut) - 1
                for section in cut:
                    pieces += self.pre_tokens(section)
            elif w.isascii() and w.isalpha():
                pieces = [w.lower()]
            else:
                pieces = self.pre_tokens(w)
            left = [p for p in (p.encode() for p in pieces) if p not in self.whole]
            sure.append(n + len(pieces) - len(left))
            parts.append(left)
        rest = list({p for left in parts for p in left})
        count = dict(zip(rest, self.merged(rest)))
        return [(n + sum(map(count.__getitem__, left)),) for n, left in zip(sure, parts)]

    def count(self, texts: pa.Array) -> np.ndarray:
        w = Words(texts)
        if not len(w.start):
            return np.zeros(w.n_docs, dtype=np.int64)
        at, _ = self.memo.find(w.hash, w.buf, w.start, w.end)
        total = np.concatenate([[0], np.cumsum(self.memo.flat[at], dtype=np.int64)])
        return total[w.begin[1:]] - total[w.begin[:-1]]


@lru_cache(maxsize=2)
def counter(path: str) -> WordCounter:
    return WordCounter(path)


def count_tokens(docs: DataFrame, path: str, limit: int, key: str = "doc_id", text: str = "text") -> DataFrame:
    """(key, n_bytes, n_tokens, over_limit) for each row: one pass, no shuffle."""
    small_batches(docs.sparkSession)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        c = counter(path)
        for b in batches:
            for part in slices(b, "text", _SLICE):
                n = c.count(part.column("text"))
                yield pa.RecordBatch.from_arrays(
                    [part.column("key").combine_chunks(), part.column("n_bytes").combine_chunks(), pa.array(n, pa.int64()), pa.array(n > limit)],
                    names=[key, "n_bytes", "n_tokens", "over_limit"])

    rows = docs.select(F.col(key).alias("key"), F.col(text).cast("string").alias("text"),
                       F.coalesce(F.octet_length(text), F.lit(0)).cast("long").alias("n_bytes"))
    return rows.mapInArrow(run, f"`{key}` {docs.schema[key].dataType.simpleString()}, n_bytes long, n_tokens long, over_limit boolean")
