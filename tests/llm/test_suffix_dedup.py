import hashlib
import random

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from canopy.llm import suffix_dedup as D


@settings(max_examples=300, deadline=None)
@given(st.text(alphabet="abc", min_size=1, max_size=80))
def test_two_stages_sort_every_suffix(text):
    raw = text.encode()
    t = np.frombuffer(raw, "u1")
    order = D.suffix_array(t, 200)
    assert order.tolist() == sorted(range(len(raw)), key=lambda i: raw[i:])
    prefix = D.common_prefixes(order, D.words_at(t, 208), 200)
    for k in range(1, len(raw)):
        a, b = raw[order[k]:], raw[order[k - 1]:]
        assert prefix[k] == next((i for i, (x, y) in enumerate(zip(a, b)) if x != y), min(len(a), len(b)))


@settings(max_examples=100, deadline=None)
@given(st.lists(st.text(alphabet="ab", min_size=8, max_size=40), min_size=1, max_size=6))
def test_repeated_windows(texts):
    raw = [t.encode() for t in texts]
    got = D.repeated_windows(raw, 8)
    every = [r[i:i + 8] for r in raw for i in range(len(r) - 7)]
    for r, mask in zip(raw, got):
        assert mask.tolist() == [every.count(r[i:i + 8]) > 1 for i in range(len(r) - 7)]


@settings(max_examples=100, deadline=None)
@given(st.lists(st.text(alphabet="ab", max_size=60), min_size=1, max_size=5))
def test_equal_windows_have_equal_anchors(texts):
    raw = [t.encode() for t in texts]
    starts = np.cumsum([0, *(len(r) for r in raw[:-1])]).tolist()
    text, begin, n, anchor = D.contexts_of(b"".join(raw), starts, D.Grams(400), 12, 5)
    seen = {}
    for k, b, c, a in zip(text, begin, n, anchor):
        for i in range(b - starts[k], b - starts[k] + c):
            assert len(raw[k][i:i + 12]) == 12
            seen.setdefault(raw[k][i:i + 12], []).append(a)
    assert sum(map(len, seen.values())) == sum(max(0, len(r) - 11) for r in raw)
    assert all(len(set(a)) == 1 for a in seen.values())


def brute(texts, w):
    raws = [(t or "").encode() for t in texts]
    uses: dict[bytes, int] = {}
    for r in raws:
        for i in range(len(r) - w + 1):
            uses[r[i:i + w]] = uses.get(r[i:i + w], 0) + 1
    out = []
    for r in raws:
        gone = np.zeros(len(r) + 1, dtype=bool)
        for i in range(len(r) - w + 1):
            if uses[r[i:i + w]] > 1:
                gone[i:i + w] = True
        gone = gone[:len(r)]
        kept = bytes(x for x, g in zip(r, gone) if not g)
        out.append((len(r), int(gone.sum()), len(D.runs(gone)), hashlib.sha256(kept).hexdigest()))
    return out


@pytest.mark.parametrize("most", [D.MAX_CONTEXTS, 2])
def test_report_against_brute_force(spark, odd, odd_rows, monkeypatch, most):
    monkeypatch.setattr(D.repeated_spans, "__defaults__", (D.WINDOW, D.GRAM, most))
    rng = random.Random(9)
    base = ["".join(rng.choice("abcdefgh é你") for _ in range(900)) for _ in range(4)]
    made = []
    for i in range(40):
        a, b = rng.choice(base), rng.choice(base)
        x, y = rng.randrange(500), rng.randrange(500)
        made.append(a[x:x + rng.randrange(150, 400)] + str(i) + b[y:y + rng.randrange(150, 400)])
    rows = [(1000 + i, t) for i, t in enumerate(made + ["ab" * 300, "ab" * 250, base[0], base[0] + "!"])]
    df = odd.select("doc_id", "text", "hash").unionByName(spark.createDataFrame(rows, "doc_id long, text string"),
                                                          allowMissingColumns=True)
    every = [(r[0], r[1]) for r in odd_rows] + rows
    want = [(d, *b) for (d, _), b in zip(every, brute([t for _, t in every], 200))]
    got = [tuple(r) for r in D.report(df).collect()]
    assert sorted(got, key=repr) == sorted(want, key=repr)


def test_slices_of_a_long_text_meet(spark, monkeypatch):
    rng = random.Random(4)
    part = "".join(rng.choice("abcdef") for _ in range(700))
    text = "".join(rng.choice("abcdef") for _ in range(5000)) + part + "x" * 3 + part
    monkeypatch.setattr(D, "SLICE", 1000)
    import pyarrow as pa
    batch = pa.RecordBatch.from_arrays([pa.array([1]), pa.array([2]), pa.array([text])], ["a", "b", "c"])
    rows = [r for b in D._anchors(iter([batch]), 200, 64) for r in b.to_pylist()]
    covered = sorted(i for r in rows for i in range(r["st"], r["st"] + r["n"]))
    assert covered == list(range(len(text) - 199))


def test_empty(none):
    assert D.report(none.withColumn("ctx", F.lit(1))).count() == 0
