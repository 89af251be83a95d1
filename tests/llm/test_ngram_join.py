import random
import re
from collections import Counter

import numpy as np
import pytest

from canopy.llm import ngram_join as N
from tests.llm.conftest import prose

LOWER = {c: c + 32 for c in range(65, 91)}


def shingles(text, size):
    w = re.findall(r"[^\x20\x09-\x0D]+", (text or "").translate(LOWER))
    return {" ".join(w[i:i + size]) for i in range(max(1, len(w) - size + 1))} if w else set()


def brute(rows, size, percent):
    sets = [shingles(t, size) for _, t in rows]
    root = list(range(len(rows)))

    def find(x):
        while root[x] != x:
            x = root[x]
        return x
    for i, a in enumerate(sets):
        for j in range(i):
            if a and sets[j] and 100 * len(a & sets[j]) >= percent * len(a | sets[j]):
                root[find(i)] = find(j)
    least: dict[int, int] = {}
    for i, (doc, _) in enumerate(rows):
        if doc is not None:
            least[find(i)] = min(least.get(find(i), doc), doc)
    return [(doc, len(sets[i]), least.get(find(i)) if sets[i] else doc) for i, (doc, _) in enumerate(rows)]


def copies(n=220):
    """Groups of near copies around the threshold, common passages and short texts."""
    rng = random.Random(11)
    bases = [prose(rng, k) for k in (30, 60, 120, 300)]
    common = prose(rng, 25)
    out = []
    for i in range(n):
        words = rng.choice(bases).split()
        for _ in range(rng.choice([0, 1, 1, 2, 3, 5, 8])):
            words[rng.randrange(len(words))] = f"edit{rng.randrange(1000)}"
        out.append((100 + i, " ".join(words)))
    out += [(1000 + i, common + " " + prose(rng, 3)) for i in range(40)]
    return out + [(2000 + i, prose(rng, rng.randrange(1, 6))) for i in range(30)] + [(3000, common), (3001, common.upper())]


@pytest.mark.parametrize("size,percent,tile", [(4, 85, 2048), (5, 80, 16)])
def test_components_against_brute_force(spark, odd, odd_rows, monkeypatch, size, percent, tile):
    monkeypatch.setattr(N, "SMALL_BUCKET", 4)
    monkeypatch.setattr(N.links, "__defaults__", (N.SHINGLE, N.PERCENT, tile))
    rows = copies()
    df = odd.select("doc_id", "text", "key", "th").unionByName(
        spark.createDataFrame(rows, "doc_id long, text string"), allowMissingColumns=True)
    want = brute([(r[0], r[1]) for r in odd_rows] + rows, size, percent)
    got = [tuple(r) for r in N.components(df, size, percent).collect()]
    assert sorted(got, key=repr) == sorted(want, key=repr)


def test_keep_one_of_each_group(spark, odd, odd_rows):
    rows = copies(60)
    df = odd.unionByName(spark.createDataFrame(rows, "doc_id long, text string"), allowMissingColumns=True)
    kept = N.keep_one(df, 4, 85)
    assert kept.columns == df.columns
    every = [(r[0], r[1]) for r in odd_rows] + rows
    out = [(r.doc_id, r.text) for r in kept.collect()]
    groups = Counter(c for (d, t), (_, n, c) in zip(every, brute(every, 4, 85)) if n)
    filled = [r for r in out if shingles(r[1], 4)]
    assert len(filled) == len(groups)
    assert len(out) - len(filled) == sum(1 for _, t in every if not shingles(t, 4))


def test_similar_is_exact_at_the_threshold():
    x = np.arange(100, dtype="uint64")
    assert N.similar(x, np.arange(15, 100, dtype="uint64"), 85)
    assert not N.similar(x, np.arange(16, 100, dtype="uint64"), 85)
    assert not N.similar(x[:0], x[:0], 85)


def test_parity_bounds_the_difference():
    rng = np.random.default_rng(2)
    for _ in range(50):
        x = np.unique(rng.integers(0, 1 << 40, 200).astype("uint64") << np.uint64(20))
        y = np.unique(np.concatenate((x[:150], rng.integers(0, 1 << 40, 60).astype("uint64") << np.uint64(20))))
        bits = 8 * min(len(N.parity(x)), len(N.parity(y)))
        a, b = N.fold_parity([N.parity(x), N.parity(y)], bits)
        assert np.bitwise_count(a ^ b).sum() <= len(np.setxor1d(x, y))


def test_forest_takes_the_closest_edges():
    a, b = np.array([1, 1, 2, 3]), np.array([2, 3, 3, 4])
    assert sorted(N.forest(a, b, np.array([5, 1, 2, 9])).tolist()) == [1, 2, 3]


def test_empty(none):
    assert N.components(none).count() == 0 and N.keep_one(none).count() == 0
