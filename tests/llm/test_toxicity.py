import random
import zlib
from collections import Counter

import numpy as np
import pytest

from canopy.llm import toxicity as T
from tests.llm.conftest import prose

BAD = "moron idiot scum loser pathetic".split()


def table(n=1200, seed=5):
    rng = random.Random(seed)
    rows, labels = [], []
    for i in range(n):
        words = prose(rng, 40).replace("0", "o").split()
        words = ["".join(c for c in w if c.isalpha()) + rng.choice(["", "s", "ed", "ing"]) for w in words]
        toxic = int(rng.random() < 0.25)
        if toxic:
            for _ in range(3):
                words.insert(rng.randrange(len(words)), rng.choice(BAD))
        rows.append((i, " ".join(words)))
        labels.append((i, toxic))
    return rows, labels


@pytest.fixture(scope="module")
def trained(spark):
    rows, labels = table()
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    truth = spark.createDataFrame(labels + labels[:5] + [(None, 1), (7, None), (5000, 1)], "doc_id long, toxic int")
    return docs, truth, dict(labels), T.learn(docs, truth, docs)


def test_held_out_accuracy(trained):
    docs, truth, labels, model = trained
    out = T.report(docs, truth).collect()
    assert len(out) == len(labels)
    held = [r for r in out if r.held_out]
    assert {r.doc_id for r in held} == {i for i in labels if zlib.crc32(str(i).encode()) % 4 == 2}
    assert all(0 <= r.score <= 1 and r.predicted == int(r.score >= 0.3) for r in out)
    right = sum(r.predicted == labels[r.doc_id] for r in held)
    assert right >= 0.97 * len(held)


def test_disguised_words_are_restored(spark, trained):
    _, _, _, model = trained
    restore = T.Restorer(*model[0].value)
    for written, word in [("m0r0n", "moron"), ("1d10t", "idiot"), ("$cum", "scum"), ("p@th3tic", "pathetic"),
                          ("loooooser", "loser"), ("i.d.i.o.t", "idiot"), ("mmmorooon", "moron")]:
        assert word in restore.words(written), (written, restore.words(written))
    assert restore.words("alpha") == ["alpha"]
    assert any("moron" in restore.words(t) for t in T.tokens_of("you m o r o n !"))
    texts = ["some 1d10t and a m0r0n alphas gammas", "what p@th3tic $cum betas", "alphas betas gammas zetas"]
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    score = {r.doc_id: r["__score"] for r in T.scores(df, model).collect()}
    assert score[0] >= 0.3 and score[1] >= 0.3 and score[2] < 0.3


def test_tables_count_every_letter_pair():
    pairs, triples = np.zeros((2, 1 << T.LM_BITS), dtype="int64")
    T.count_words(Counter({"ab": 3, "b": 2}), pairs, triples)
    assert pairs.sum() == 3 * 4 + 2 * 3 and triples.sum() == 3 * 3 + 2 * 2
    slot = int(T._slot(np.uint64(ord("a")), np.uint64(ord("b"))))
    assert pairs[slot] == 3


def test_odd_rows_and_no_labels(spark, odd, odd_rows, none, trained):
    _, truth, _, _ = trained
    out = T.report(odd.select("doc_id", "text", "score"), truth).collect()
    assert len(out) == len(odd_rows) and all(0 <= r.score <= 1 for r in out)
    assert all(r.score == 0 for r in T.report(odd, truth.where("false")).collect())
    assert T.report(none, truth).count() == 0


def test_drop_toxic_keeps_clean_documents(spark, trained):
    docs, truth, labels, _ = trained
    kept = T.drop_toxic(docs.selectExpr("*", "1 AS w"), truth)
    assert kept.columns == ["doc_id", "text", "w"]
    ids = {r.doc_id for r in kept.collect()}
    clean = {i for i, t in labels.items() if not t}
    assert len(clean - ids) <= 0.01 * len(clean) and len(ids - clean) <= 0.05 * len(labels)


def test_a_task_holds_bounded_features(monkeypatch):
    import pyarrow as pa

    rows, labels = table(60)
    batch = pa.RecordBatch.from_arrays([pa.array([t for _, t in rows]), pa.array([x for _, x in labels], pa.int32())], ["t", "toxic"])
    ones = np.ones(1 << T.LM_BITS, dtype="int64")
    tables = type("Shared", (), {"value": (ones, ones)})

    def run():
        parts = list(T._features(iter([batch]), tables))
        hit, miss = Counter(), Counter()
        for p in parts:
            for name, h, m in zip(*(c.to_pylist() for c in p.columns)):
                hit[name] += h
                miss[name] += m
        return hit, miss, parts
    whole = run()
    monkeypatch.setattr(T, "CACHE_FEATURES", 50)
    monkeypatch.setattr(T, "COUNTED_FEATURES", 200)
    cut = run()
    assert cut[:2] == whole[:2] and len(cut[2]) > len(whole[2]) == 1
    assert max(p.num_rows for p in cut[2]) < whole[2][0].num_rows


def test_a_feature_is_held_once_however_many_tokens_have_it():
    import tracemalloc

    import pyarrow as pa

    rng = random.Random(11)
    parts = ["ab", "cd", "ef", "gh"]
    texts = [" ".join("".join(rng.choice(parts) for _ in range(8)) for _ in range(50)) for _ in range(300)]
    batch = pa.RecordBatch.from_arrays([pa.array(texts), pa.array([i % 2 for i in range(300)], pa.int32())], ["t", "toxic"])
    ones = np.ones(1 << T.LM_BITS, dtype="int64")
    tables = type("Shared", (), {"value": (ones, ones)})
    tracemalloc.start()
    out, = T._features(iter([batch]), tables)
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    # 45 features of each of about 15,000 tokens, few of them different
    assert out.num_rows < 20_000 and peak < 16e6
    words = {t: set(t.split()) for t in texts}
    want = Counter(f for i, t in enumerate(texts) if i % 2 for f in set().union(*map(T.features_of, words[t])))
    assert {n: h for n, h in zip(out.column(0).to_pylist(), out.column(1).to_pylist()) if h} == want
