"""Byte-level BPE encoding and decoding with a hierarchical-bitmap rank queue.

A pre-token is a doubly linked list of tokens.  Every mergeable neighbouring pair waits, as the position of its
left token, in the bucket of its merge rank; a two-level bitmap has a bit for each bucket in use, so the lowest rank
is two find-first-set steps away however long the pre-token is.  Entries are never removed when a merge changes
their pair: they are recognised as stale when their bucket comes up.  A merge costs O(1), a whole pre-token O(n).
All unseen pre-tokens of a slice of texts share one list and one queue (``RankQueue``, numpy a bucket at a time);
``RankQueueBpe`` is the same queue for one pre-token.

Defined results: a null text encodes as the empty text (no ids); ids decode to the exact bytes; a table without rows
gives no rows; other columns are passed through, and columns of the input named like a result are replaced.
"""

from __future__ import annotations

import base64
import hashlib
import json
from collections.abc import Iterator
from functools import lru_cache
from itertools import chain

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from churnlens.llm.textops import CODES, Memo, ragged, raw, running, slices, small_batches, span_hash

_CODE = 1 << 20  # ids are below this; a pair of ids is one integer
_SLICE = 2 << 20  # bytes of text whose unseen pre-tokens share one queue


def load_ranks(path: str) -> dict[bytes, int]:
    """Token bytes -> rank from a file of base64 tokens and ranks."""
    with open(path, "rb") as f:
        return {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}


def load_json(path: str) -> tuple[dict[str, int], dict[int, int], list[int], dict[str, int]]:
    """(vocabulary, pair -> rank, id made by each rank, special string -> id) of a BPE tokenizer in a JSON file."""
    with open(path, encoding="utf-8") as f:
        whole = json.load(f)
    vocab, pairs, made = whole["model"]["vocab"], {}, []
    for rank, merge in enumerate(whole["model"]["merges"]):
        left, right = merge.split(" ") if isinstance(merge, str) else merge
        pairs.setdefault(vocab[left] * _CODE + vocab[right], rank)
        made.append(vocab[left + right])
    return vocab, pairs, made, {t["content"]: t["id"] for t in whole.get("added_tokens", [])}


def byte_letters() -> list[str]:
    """The printable letter that stands for each byte in byte-level vocabularies: printable Latin-1 bytes stand for
    themselves, the others, in order, for the letters from U+0100."""
    plain = {*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)}
    other = iter(range(0x100, 0x200))
    return [chr(b) if b in plain else chr(next(other)) for b in range(256)]


def rank_pairs(ranks: dict[bytes, int]) -> dict[int, int]:
    """Every pair of tokens whose bytes in a row are a token, with that token's rank."""
    pairs = {}
    for token, rank in ranks.items():
        for cut in range(1, len(token)):
            left, right = ranks.get(token[:cut]), ranks.get(token[cut:])
            if left is not None and right is not None:
                pairs[left * _CODE + right] = rank
    return pairs


class RankQueueBpe:
    """Merges the bytes of one pre-token by rank: ``pairs`` gives a pair's rank, ``made`` the id a rank makes."""

    def __init__(self, byte: list[int], pairs: dict[int, int], made: list[int]):
        self.byte, self.pair, self.made = byte, pairs, made
        self.shift = (max(pairs.values(), default=1).bit_length() + 1) // 2

    def encode(self, piece: bytes) -> list[int]:
        n, pair, shift, made = len(piece), self.pair.get, self.shift, self.made
        mask = (1 << shift) - 1
        byte = self.byte
        tok = [byte[b] for b in piece]
        nxt = list(range(1, n + 1))
        prv = list(range(-1, n))
        buckets: dict[int, list[int]] = {}
        words: dict[int, int] = {}
        top = 0
        for i in range(n - 1):
            r = pair(tok[i] * _CODE + tok[i + 1])
            if r is not None:
                if r in buckets:
                    buckets[r].append(i)
                else:
                    buckets[r] = [i]
                    w = r >> shift
                    words[w] = words.get(w, 0) | 1 << (r & mask)
                    top |= 1 << w
        while top:
            w = (top & -top).bit_length() - 1
            word = words[w]
            low = word & -word
            rank = w << shift | low.bit_length() - 1
            if word == low:
                del words[w]
                top ^= 1 << w
            else:
                words[w] = word ^ low
            at = buckets.pop(rank)
            at.sort()
            for done, i in enumerate(at):
                left = tok[i]
                j = nxt[i]
                if left < 0 or j >= n or pair(left * _CODE + tok[j]) != rank:
                    continue  # stale
                new = made[rank]
                tok[i], tok[j] = new, -1
                k = nxt[i] = nxt[j]
                lower = False
                if k < n:
                    prv[k] = i
                    r = pair(new * _CODE + tok[k])
                    if r is not None:
                        lower = r < rank
                        if r in buckets:
                            buckets[r].append(i)
                        else:
                            buckets[r] = [i]
                            w = r >> shift
                            words[w] = words.get(w, 0) | 1 << (r & mask)
                            top |= 1 << w
                h = prv[i]
                if h >= 0:
                    r = pair(tok[h] * _CODE + new)
                    if r is not None:
                        lower = lower or r < rank
                        if r in buckets:
                            buckets[r].append(h)
                        else:
                            buckets[r] = [h]
                            w = r >> shift
                            words[w] = words.get(w, 0) | 1 << (r & mask)
                            top |= 1 << w
                if lower and done + 1 < len(at):  # a lower rank has come up: it goes first, the rest waits
                    buckets[rank] = at[done + 1:]
                    w = rank >> shift
                    words[w] = words.get(w, 0) | 1 << (rank & mask)
                    top |= 1 << w
                    break
        return [t for t in tok if t >= 0]


class PairTable:
    """Vectorised lookup (left id, right id) -> rank; -1 where the pair doesn't merge.  Open addressing, load below 1/4."""

    def __init__(self, pairs: dict[int, int]):
        keys = np.fromiter(pairs.keys(), dtype=np.int64, count=len(pairs))
        ranks = np.fromiter(pairs.values(), dtype=np.int32, count=len(pairs))
        bits = max(4, (4 * len(keys)).bit_length())
        self.shift, self.mask = np.uint64(64 - bits), (1 << bits) - 1
        self.keys, self.ranks = np.full(1 << bits, -1, dtype=np.int64), np.full(1 << bits, -1, dtype=np.int32)
        at, todo = self._slot(keys), np.arange(len(keys))
        while len(todo):
            free = self.keys[at[todo]] == -1
            slots, first = np.unique(at[todo][free], return_index=True)
            won = todo[free][first]
            self.keys[slots], self.ranks[slots] = keys[won], ranks[won]
            todo = np.setdiff1d(todo, won, assume_unique=True)
            at[todo] = (at[todo] + 1) & self.mask

    def _slot(self, keys: np.ndarray) -> np.ndarray:
        return ((keys.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)) >> self.shift).astype(np.int64)

    def find(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        key = left.astype(np.int64) * _CODE + right
        at = self._slot(key)
        seen = self.keys[at]
        out = np.where(seen == key, self.ranks[at], np.int32(-1))
        on = np.flatnonzero((seen != key) & (seen != -1))
        while len(on):
            at[on] = (at[on] + 1) & self.mask
            seen = self.keys[at[on]]
            out[on] = np.where(seen == key[on], self.ranks[at[on]], np.int32(-1))
            on = on[(seen != key[on]) & (seen != -1)]
        return out


class RankQueue:
    """The same queue over one long linked list that holds many pre-tokens, a bucket at a time.

    ``made[rank]`` is the id that a merge of that rank makes.  All valid positions of the lowest rank are merged at
    once; of overlapping pairs every second is kept, leftmost first.  New pairs that fall in the bitmap word at work
    go to its buckets directly, the others are dealt to their words when the word is done.
    """

    def __init__(self, pairs: dict[int, int], made: np.ndarray):
        self.table, self.made, self.words = PairTable(pairs), made, (max(pairs.values(), default=0) >> 6) + 1

    def merge(self, tok: np.ndarray) -> np.ndarray:
        """``tok``: initial ids, -1 after each pre-token; merged in place, absorbed positions become -1.  Returns
        the positions at which a rank below the one at work came up (none for trained vocabularies)."""
        n, find = len(tok), self.table.find
        tok = np.append(tok, -1) if n == 0 or tok[-1] != -1 else tok
        n = len(tok)
        nxt, prv = np.arange(1, n + 1), np.arange(-1, n - 1)
        nxt[-1] = n - 1
        rank_at = np.full(n, -1, dtype=np.int32)
        at = np.flatnonzero((tok[:-1] >= 0) & (tok[1:] >= 0))
        rank_at[at] = find(tok[at], tok[at + 1])
        at = np.flatnonzero(rank_at >= 0)
        waiting: list[list[np.ndarray]] = [[] for _ in range(self.words)]
        top, odd = 0, []

        def deal(at: np.ndarray) -> int:
            ranks = rank_at[at]
            order = np.argsort(ranks, kind="stable")
            at, word = at[order], ranks[order] >> 6
            cuts = [0, *(np.flatnonzero(word[1:] != word[:-1]) + 1).tolist(), len(at)]
            bits = 0
            for a, b in zip(cuts, cuts[1:]):
                if b > a:
                    w = int(word[a])
                    waiting[w].append(at[a:b])
                    bits |= 1 << w
            return bits

        top |= deal(at)
        while top:
            w = (top & -top).bit_length() - 1
            top &= top - 1
            at = np.concatenate(waiting[w]) if len(waiting[w]) > 1 else waiting[w][0]
            waiting[w] = []
            at = at[(rank_at[at] >> 6) == w]  # stale entries
            leaf: dict[int, list[np.ndarray]] = {}
            bits, later = 0, []

            def drop(at: np.ndarray) -> int:
                low = rank_at[at] & 63
                order = np.lexsort((at, low))
                at, low = at[order], low[order]
                cuts = [0, *(np.flatnonzero(low[1:] != low[:-1]) + 1).tolist(), len(at)]
                got = 0
                for a, b in zip(cuts, cuts[1:]):
                    if b > a:
                        leaf.setdefault(int(low[a]), []).append(at[a:b])
                        got |= 1 << int(low[a])
                return got

            bits |= drop(at)
            while bits:
                low = (bits & -bits).bit_length() - 1
                bits &= bits - 1
                rank = w << 6 | low
                held = leaf.pop(low)
                at = held[0] if len(held) == 1 else np.sort(np.concatenate(held))
                at = at[rank_at[at] == rank]  # stale entries
                if not len(at):
                    continue
                if len(at) > 1:
                    same = at[1:] == at[:-1]
                    if same.any():
                        at = at[np.append(True, ~same)]
                    touch = nxt[at[:-1]] == at[1:]
                    if touch.any():  # overlapping pairs: every second of a chain, from the left
                        head = np.append(True, ~touch)
                        index = np.arange(len(at))
                        at = at[(index - np.maximum.accumulate(np.where(head, index, 0))) % 2 == 0]
                gone = nxt[at]
                after = nxt[gone]
                tok[at] = self.made[rank]
                tok[gone] = -1
                rank_at[gone] = -1
                nxt[at] = after
                prv[after] = at
                before = prv[at]
                before = before[before >= 0]
                new = np.concatenate([at, before])
                right = tok[nxt[new]]
                left = tok[new]
                alive = (left >= 0) & (right >= 0)
                ranks = np.where(alive, find(np.maximum(left, 0), np.maximum(right, 0)), np.int32(-1))
                rank_at[new] = ranks
                new, ranks = new[ranks >= 0], ranks[ranks >= 0]
                if not len(new):
                    continue
                lower = ranks < rank
                if lower.any():
                    odd.append(new[lower])
                here = (ranks >> 6) == w
                if here.any():
                    bits |= drop(new[here])
                    new = new[~here]
                if len(new):
                    later.append(new)
            if later:
                at = np.concatenate(later)
                at = at[rank_at[at] >= 0]
                top |= deal(at)
        return np.concatenate(odd) if odd else np.zeros(0, dtype=np.int64)


# Bytes that, after a space, show that the space ends its run: neither ASCII white space nor the first byte of other
# white space (U+0085, U+00A0, U+1680, U+2000 and on, U+3000).
_SOLID = np.ones(256, dtype=bool)
_SOLID[[0x20, 0x09, 0x0A, 0x0B, 0x0C, 0x0D, 0xC2, 0xE1, 0xE2, 0xE3]] = False
_PLAIN = _SOLID.copy()
_PLAIN[0x80:] = False


class ByteBpe:
    """Texts to ids and back.  ``pattern`` is the pre-token pattern of the vocabulary (\\s is Unicode white space).

    A slice of texts is cut, on its bytes, into units that no match of the pattern crosses: before a space that a solid
    character follows, and around a line feed between two solid ones.  Unseen units are split by the pattern and their
    pre-tokens merged in one queue; the ids of a text are its units' ids in a row.
    """

    def __init__(self, ids: dict[bytes, int], pairs: dict[int, int], made: list[int], pattern: str):
        byte = [ids[bytes([b])] for b in range(256)]
        self.bpe = RankQueueBpe(byte, pairs, made)
        self.queue = RankQueue(pairs, np.array(made, dtype=np.int32))
        self.byte = np.array(byte, dtype=np.int32)
        self.split = regex.compile(pattern.replace(r"\s", r"\p{White_Space}").replace(r"\S", r"\P{White_Space}")).findall
        # The cuts are proved for patterns whose matches hold white space only as one space in front or as a run.
        self.by_unit = " ?\\p{L}+| ?\\p{N}+| ?[^\\s\\p{L}\\p{N}]+|\\s+(?!\\S)|\\s+" in pattern
        tokens = [b""] * (max(ids.values()) + 1)
        for t, k in ids.items():
            tokens[k] = t
        self.blob = np.frombuffer(b"".join(tokens), dtype=np.uint8)
        self.width = np.fromiter(map(len, tokens), dtype=np.int64, count=len(tokens))
        self.place = np.cumsum(self.width) - self.width
        self.name = [str(k) for k in range(len(tokens))]
        self.memo = Memo(self.merge_units)

    def merge_all(self, pieces: list[bytes]) -> list[list[int]]:
        """The ids of each pre-token, from one queue over all of them."""
        if not pieces:
            return []
        flat = np.frombuffer(b"\0".join(pieces) + b"\0", dtype=np.uint8)
        end = np.cumsum(np.fromiter(map(len, pieces), dtype=np.int64, count=len(pieces)) + 1)
        tok = self.byte[flat]
        tok[end - 1] = -1
        odd = self.queue.merge(tok)
        live = tok >= 0
        cut = [0, *np.cumsum(live)[end - 1].tolist()]
        ids = tok[live].tolist()
        out = [ids[a:b] for a, b in zip(cut, cut[1:])]
        for k in np.unique(np.searchsorted(end, odd, side="right")).tolist():
            out[k] = self.bpe.encode(pieces[k])
        return out

    def merge_units(self, units: list[str]) -> list[list[int]]:
        parts = [[u] if u[1:].isalpha() and (u[0] == " " or u[0].isalpha()) else self.split(u) for u in units]
        made = iter(self.merge_all([p.encode() for ps in parts for p in ps]))
        return [next(made) if len(ps) == 1 else list(chain.from_iterable([next(made) for _ in ps])) for ps in parts]

    def cuts(self, buf: np.ndarray, off: np.ndarray) -> np.ndarray:
        """Where units start."""
        cut = np.zeros(len(buf), dtype=bool)
        if self.by_unit and len(buf) > 2:
            cut[:-1] = (buf[:-1] == 0x20) & _SOLID[buf[1:]]
            alone = (buf[1:-1] == 0x0A) & _PLAIN[buf[:-2]] & _SOLID[buf[2:]]
            cut[1:-1] |= alone
            cut[2:] |= alone
        cut[off[:-1][off[:-1] < len(buf)]] = True
        return np.flatnonzero(cut)

    def encode_slice(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """(ids of all texts in a row, offsets of the texts in it)."""
        buf, off = raw(texts)
        start = self.cuts(buf, off)
        if not len(start):
            return np.zeros(0, dtype=np.int32), np.zeros(len(off), dtype=np.int64)
        end = np.append(start[1:], len(buf))
        at, size = self.memo.find(span_hash(running(CODES[buf]), start, end), buf, start, end)
        ends = np.concatenate([[0], np.cumsum(size)])
        return self.memo.flat[ragged(at, size)], ends[np.searchsorted(start, off)]

    def encode(self, text: str) -> list[int]:
        return self.encode_slice(pa.array([text], pa.large_string()))[0].tolist()

    def decode(self, ids: np.ndarray) -> bytes:
        return self.blob[ragged(self.place[ids], self.width[ids])].tobytes()


@lru_cache(maxsize=2)
def coder(path: str, pattern: str) -> ByteBpe:
    """One coder for each Python worker, from a file of ranks or a JSON file."""
    if path.endswith(".json"):
        vocab, pairs, made, special = load_json(path)
        letter = {c: b for b, c in enumerate(byte_letters())}
        ids = {bytes(map(letter.__getitem__, t)): k for t, k in vocab.items() if t not in special}
        return ByteBpe(ids, pairs, made, pattern)
    ranks = load_ranks(path)
    return ByteBpe(ranks, rank_pairs(ranks), list(range(max(ranks.values()) + 1)), pattern)


def _with(batch: pa.RecordBatch, names: list[str], columns: list[pa.Array]) -> pa.RecordBatch:
    keep = [n for n in batch.schema.names if n not in names]
    return pa.RecordBatch.from_arrays([*(batch.column(n) for n in keep), *columns], names=[*keep, *names])


def _columns(df: DataFrame, without: list[str]) -> str:
    kept = [f for f in df.schema if f.name not in without]
    return ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in kept) + (", " if kept else "")


def encode(docs: DataFrame, path: str, pattern: str, text: str = "text", ids: str = "ids") -> DataFrame:
    """``docs`` with a column of token ids (array<int>) of each whole text, encoded inside the scan's own partitions."""
    small_batches(docs.sparkSession)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        c = coder(path, pattern)
        for b in batches:
            for part in slices(b, text, _SLICE):
                flat, off = c.encode_slice(part.column(text))
                part = part.combine_chunks().to_batches()[0]
                yield _with(part, [ids], [pa.ListArray.from_arrays(pa.array(off, pa.int32()), pa.array(flat, pa.int32()))])

    return docs.mapInArrow(run, f"{_columns(docs, [ids])}`{ids}` array<int>")


def decode(df: DataFrame, path: str, pattern: str, ids: str = "ids", out: str = "decoded") -> DataFrame:
    """``df`` with the bytes (binary) that each row's ids stand for; null ids decode to no bytes."""
    small_batches(df.sparkSession)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        c = coder(path, pattern)
        for b in batches:
            rows = [c.decode(np.asarray(x or [], dtype=np.int64)) for x in b.column(ids).to_pylist()]
            yield _with(b, [out], [pa.array(rows, pa.binary())])

    return df.mapInArrow(run, f"{_columns(df, [out])}`{out}` binary")


def digests(docs: DataFrame, path: str, pattern: str, text: str = "text") -> DataFrame:
    """(doc_id, n_tokens, ids_sha256, decoded_sha256): encode and decode in one pass, ids never leave the task."""
    small_batches(docs.sparkSession)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        c = coder(path, pattern)
        name = c.name.__getitem__
        for b in batches:
            for part in slices(b, "text", _SLICE):
                flat, off = c.encode_slice(part.column("text"))
                sums, back = [], []
                for x, y in zip(off.tolist(), off[1:].tolist()):
                    ids = flat[x:y]
                    sums.append(hashlib.sha256(",".join(map(name, ids.tolist())).encode()).hexdigest())
                    back.append(hashlib.sha256(c.decode(ids)).hexdigest())
                yield pa.RecordBatch.from_arrays([part.column("doc_id").combine_chunks(), pa.array(np.diff(off), pa.int64()),
                                                  pa.array(sums, pa.string()), pa.array(back, pa.string())],
                                                 names=["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"])

    rows = docs.select(F.col("doc_id"), F.col(text).cast("string").alias("text"))
    return rows.mapInArrow(run, f"doc_id {docs.schema['doc_id'].dataType.simpleString()}, n_tokens long, ids_sha256 string, decoded_sha256 string")
