"""Spelling variants against brute force."""

import random
import re
import zlib
from collections import Counter, defaultdict

import pytest

from churnlens.llm import spelling
from tests.conftest import SF_SMALL

RUN = re.compile("[A-Za-zÀ-ÿ]+")
LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def counted(rows, letters=6, least=5):
    n = Counter()
    for i, t in rows:
        for r in RUN.findall(t or ""):
            r = r.translate(LOWER)
            h = zlib.crc32(f"{'' if i is None else i}:{r}".encode())
            if h % 199 == 0:
                at = h % len(r)
                r = r[:at] + r[at + 1:]
            n[r] += 1
    return {w: c for w, c in n.items() if len(w) >= letters and c >= least}


def grouped(n, ratio=5):
    """{word: (n, n_near, form, form_n, root)}"""
    near, holes = defaultdict(set), defaultdict(set)
    for w in n:
        for i in range(len(w)):
            cut = w[:i] + w[i + 1:]
            if cut in n:
                near[w].add(cut)
                near[cut].add(w)
            holes[i, cut].add(w)
    for same in holes.values():
        for w in same:
            near[w] |= same - {w}
    form = {}
    for w in n:
        best = min(near[w], key=lambda x: (-n[x], x), default=None)
        form[w] = best if best is not None and n[best] >= ratio * n[w] else None

    def root(w):
        while form[w] is not None:
            w = form[w]
        return w

    return {w: (n[w], len(near[w]), form[w], n[form[w]] if form[w] else None, root(w)) for w in n}


def result(df):
    rows = df.collect()
    out = {r.word: (r.n, r.n_near, r.form, r.form_n, r.root) for r in rows}
    assert len(out) == len(rows)
    return out


@pytest.fixture(scope="module")
def words():
    rnd = random.Random(4)
    parts = ["an", "er", "th", "in", "é", "a", "ß", "e", "n"]
    out = {"".join(rnd.choice(parts) for _ in range(rnd.randint(3, 6))) for _ in range(1500)}
    for w in sorted(out)[:300]:  # one code point more, less or other
        at = rnd.randrange(len(w))
        out |= {w[:at] + rnd.choice("anetrx÷") + w[at:], w[:at] + w[at + 1:], w[:at] + rnd.choice("nat×") + w[at + 1:]}
    long = "ab" * 60
    out |= {long, long + "a", long[:70] + "x" + long[71:], "c" + long, "z" * 300, "z" * 301, "z" * 299 + "y"}
    return {w: 5 + int(rnd.paretovariate(0.4)) % 10 ** 9 for w in sorted(out) if w}


@pytest.mark.parametrize("cell, every", [(40_000, 1), (300, 1), (10, 20), (1, 60)])
def test_equals_brute_force(spark, words, cell, every):
    """Cells by no counts, by some, by many, and by halves."""
    kept = sorted(words)[::every]
    if every > 1:  # with an anagram, a replaced and a missing letter of each
        words = {w: 5 + len(w) ** 3 % 97 for k in kept for w in (k, k[:2] + k[2:4][::-1] + k[4:], k[:3] + "x" + k[4:], k[:2] + k[3:])}
    df = spark.createDataFrame(list(words.items()), "word string, n long").repartition(5)
    assert result(spelling.variants(df, cell=cell)) == grouped(words)


def test_words_of_documents(spark):
    rows = [(i, "Shining SHINING shininÉs, Étoiles×÷ abc42defghij " * (1 + i % 3)) for i in range(300)]
    rows += [(7, "repeated repeatid repeated")] * 200 + [(None, "nobody nobody"), (None, "nobody"), (5, None), (6, ""), (8, "longword " * 20_000), (9, "12 34")]
    df = spark.createDataFrame([(*r, "clash", "clash") for r in rows], "doc_id long, text string, word string, n string").repartition(4)
    want = counted(rows)
    got = {r.word: r.n for r in spelling.vocabulary(df).collect()}
    assert got == want and "shining" in want and len(want) > 5
    assert result(spelling.variants(spelling.vocabulary(df))) == grouped(want)


def test_whole_small_table(spark):
    docs = spark.read.parquet(f"{SF_SMALL}/documents.parquet")
    want = grouped(counted([(r.doc_id, r.text) for r in docs.select("doc_id", "text").collect()]))
    assert result(spelling.variants(spelling.vocabulary(docs))) == want


def test_no_words(spark):
    docs = spark.createDataFrame([(1, None), (2, "a b")], "doc_id long, text string")
    assert spelling.variants(spelling.vocabulary(docs)).count() == 0
    assert spelling.variants(spelling.vocabulary(docs.limit(0))).count() == 0
