import math
import random
import re

import numpy as np
import pytest
from pyspark.sql import functions as F

from canopy.llm import lexical as X

TERM = re.compile(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")


def terms(text):
    return TERM.findall("".join(c.lower() if "A" <= c <= "Z" else c for c in text or ""))


def brute(docs, items, top=10):
    counted = [(d, w) for d, t in docs if (w := terms(t))]
    n, length = len(counted), sum(len(w) for _, w in counted)
    df = {}
    for _, w in counted:
        for t in set(w):
            df[t] = df.get(t, 0) + 1
    asked = {}
    for i, t in items:
        asked.setdefault(i, set()).update(terms(t))
    out = []
    for i, own in asked.items():
        scores = []
        for d, w in counted:
            m = 10 + 90 * len(w) * n // length
            s = sum(math.floor(1000 * math.log((2 * n + 2) / (2 * df[t] + 1))) * (10 ** 9 * w.count(t) // (1000 * w.count(t) + 8 * m))
                    for t in own if t in w)
            if s > 0:
                scores.append((-s, d is not None, d or 0, d))
        scores.sort()
        out += [(i, k + 1, s[3], -s[0]) for k, s in enumerate(scores[:top])]
    return sorted(out, key=repr)


def corpus(seed=1, n=300):
    rng = random.Random(seed)
    words = [f"w{i}" for i in range(40)] + ["Äpfel", "a1b", "UPPER", "ÉTÉ", "你好", "x_y", "don't"]

    def text(k):
        return rng.choice([" ", "\n", "--", "\x7f"]).join(words[min(int(rng.expovariate(0.08)), len(words) - 1)] for _ in range(k))
    docs = [(i, text(rng.choice([1, 3, 20, 200]))) for i in range(n)]
    docs += [(i + n, docs[5][1]) for i in range(40)] + [docs[7], docs[7]]
    return docs, [(i, text(rng.choice([1, 5, 30]))) for i in range(25)]


ODD_ITEMS = [(None, "w1 w2 Äpfel"), (900, None), (901, ""), (902, "... --"), (903, "absent"), (904, "w3"), (904, "w5 w3"), (904, "w3")]


def result(spark, docs, items, **limits):
    d = spark.createDataFrame(docs, "doc_id long, text string").repartition(3).withColumns({c: F.lit("x") for c in ("n", "terms", "item", "score", "item_id")})
    i = spark.createDataFrame(items, "item_id long, text string").withColumns({c: F.lit("x") for c in ("term", "doc_id", "rank")})
    return sorted([tuple(r) for r in X.search(d, i, **limits).collect()], key=repr)


@pytest.mark.parametrize("limits", [{}, {"cell": 4, "most_postings": 300, "most_docs": 64, "item_chars": 200}])
def test_against_brute_force(spark, odd_rows, limits):
    docs, items = corpus()
    docs += [(r[0], r[1]) for r in odd_rows]
    assert result(spark, docs, items + ODD_ITEMS, **limits) == brute(docs, items + ODD_ITEMS)


def test_empty_tables(spark):
    docs, items = corpus(2, 10)
    assert result(spark, [], items) == [] and result(spark, docs, []) == []
    assert result(spark, [(1, None), (2, " ")], items) == []


def test_long_texts_are_cut_between_terms(monkeypatch):
    rng = random.Random(3)
    monkeypatch.setattr(X, "PIECE", 10)
    for _ in range(200):
        text = "".join(rng.choice(["a", "B", "é", " ", "-", "7", "你"]) for _ in range(rng.randrange(60)))
        assert [w.decode() for words in X.terms_of(text.encode()) for w in words] == terms(text)
    assert sum(len(w) for w in X.terms_of(b"x" * 20_000)) == 1


def test_range_maxima_and_pruning():
    """Sparse tables give the maximum of any range; a search that has its best leaves most cells alone."""
    rng = np.random.default_rng(4)
    size = 5000
    doc = np.concatenate([np.sort(rng.choice(size, k, replace=False)) for k in (5000, 700, 40, 1)])
    term = np.repeat(np.arange(4), (5000, 700, 40, 1))
    tf = rng.integers(1, 9, len(doc))
    n = rng.integers(5, 400, size)
    block = X.Block(list(range(size)), n, doc, term, tf, np.array([1, 900, 4000, 7000]), size, int(n.sum()))
    for _ in range(300):
        t = rng.integers(0, 4)
        a, b = np.searchsorted(block.key, [t * size, (t + 1) * size])
        lo = rng.integers(a, b)
        hi = rng.integers(lo + 1, b + 1)
        at = block.maxima(np.array([lo]), np.array([hi]))[0]
        assert lo <= at < hi and block.impact[at] == block.impact[lo:hi].max()
    best = []
    cells = block.search(np.arange(4), best, 10, 16)
    scores = np.zeros(size, np.int64)
    np.add.at(scores, block.doc, block.impact)
    assert sorted((s for s, _ in best), reverse=True) == np.sort(scores)[::-1][:10].tolist()
    assert cells < size / 16 / 2


def test_impacts_beyond_longs():
    got = X.impacts(np.array([3, 10 ** 10]), np.array([10 ** 9, 5]), np.array([7, 1]), 10 ** 11, 10 ** 13)
    want = [w * (10 ** 9 * f // (1000 * f + 8 * (10 + 90 * k * 10 ** 11 // 10 ** 13))) for f, k, w in ((3, 10 ** 9, 7), (10 ** 10, 5, 1))]
    assert got.tolist() == want
