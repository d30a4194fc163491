"""Plain restatements of the operators' definitions, for small tables."""

import hashlib
import re
from collections import Counter, defaultdict

import numpy as np

WORD = re.compile(r"[^\x20\x09-\x0D]+")
LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def substring_dedup(rows, window=50):
    """{(doc_id, text): (n_words, n_removed, sha256 of the kept words)}"""
    first = {}
    for i, t in rows:
        w = WORD.findall(t or "")
        for a in range(len(w) - window + 1):
            k = tuple(w[a:a + window])
            first[k] = min(first.get(k, i), i)
    out = {}
    for i, t in rows:
        w = WORD.findall(t or "")
        gone = [False] * len(w)
        for a in range(len(w) - window + 1):
            if first[tuple(w[a:a + window])] < i:
                gone[a:a + window] = [True] * window
        kept = " ".join(x for x, g in zip(w, gone) if not g)
        out[i, t] = len(w), sum(gone), hashlib.sha256(kept.encode()).hexdigest()
    return out


def near_duplicates(rows, percent=75):
    """{doc_id: (n_shingles, component)}"""
    sets, inverse = {}, defaultdict(list)
    for i, t in rows:
        w = WORD.findall((t or "").translate(LOWER))
        sets[i] = {tuple(w[a:a + 5]) for a in range(len(w) - 4)} if len(w) >= 5 else {tuple(w)} if w else set()
        for s in sets[i]:
            inverse[s].append(i)
    parent = {i: i for i in sets}

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for i, s in sets.items():
        for j, n in Counter(j for x in s for j in inverse[x] if j < i).items():
            if 100 * n >= percent * (len(s) + len(sets[j]) - n):
                a, b = find(i), find(j)
                parent[max(a, b)] = min(a, b)
    return {i: (len(sets[i]), find(i)) for i in sets}


def nearest(ids, m, query_ids, k, score):
    """{query: [(id, score), ...]}: the k best of every row but those of the query's own id."""
    out = {}
    for q in query_ids:
        s = score(m[list(ids).index(q)], m)
        best = sorted((-v, i) for i, v in zip(ids, s.tolist()) if i != q)[:k]
        out[q] = [(i, -v) for v, i in best]
    return out


def integers(m):
    return np.floor(1024 * m.astype(float)).astype(np.int64)
