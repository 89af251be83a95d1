"""Stored topic models: versions, save and load, assignment of new texts against brute force."""

import math
import random
from collections import Counter

import pytest
from pyspark.errors import PySparkException
from pyspark.sql import functions as F

from canopy.operators import model_store as MS
from canopy.operators import topics as TP

ROWS = "doc_key string, text string, vec array<double>"
WORDS = {0: ["river", "boat", "water"], 1: ["engine", "wheel", "road"]}


@pytest.fixture(scope="module")
def fitted(spark):
    rng = random.Random(3)
    rows = [(f"{'cb'[g]}{i}", " ".join(rng.choices(WORDS[g], k=6)) + " common",
             [10.0 * g + rng.random() / 9, rng.random() / 9]) for g in (0, 1) for i in range(20 + 5 * g)]
    rows.append(("lone", "nothing like them", None))
    return MS.DensityTopics(eps=0.5, minPts=4, minTopicSize=10, dim=2).fit(spark.createDataFrame(rows, ROWS))


def test_save_load_transform(spark, fitted, tmp_path):
    path = MS.version_path(str(tmp_path), "text_2024-01")
    fitted.save(path)
    with pytest.raises(PySparkException, match="(?i)exists"):
        fitted.save(path)
    fitted.write().overwrite().save(path)
    other = spark.newSession()
    model = MS.DensityTopicsModel.read().session(other).load(path)
    assert model.uid == fitted.uid and set(model.tables) == set(MS.TABLES)
    assert {r.topic: r["count"] for r in model.tables["topic_info"].collect()} == {-1: 1, 0: 25, 1: 20}
    assert model.tables["docs_topic_info"].count() == 46
    new = [(1, "a boat on the river"), (2, "wheel and engine"), (3, "unheard words"), (4, None), (5, ""), (1, "a boat on the river"),
           (None, "ROAD")]
    out = model.transform(other.createDataFrame(new, "rank int, text string"))
    assert out.columns == ["rank", "text", "topic", "similarity"]
    assert Counter((r.rank, r.topic) for r in out.collect()) == Counter(
        [(1, 1), (2, 0), (3, -1), (4, -1), (5, -1), (1, 1), (None, 0)])
    assert all((r.similarity > 0) == (r.topic >= 0) for r in out.collect())
    assert model.transform(other.createDataFrame([], "text string")).count() == 0


def test_threshold_and_clashing_names(spark, fitted):
    rows = spark.createDataFrame([("river road",), ("river boat water",)], "text string")
    strict = MS.DensityTopicsModel(fitted.tables, minSimilarity=0.9, topicCol="t")
    assert {r.text: r.t for r in strict.transform(rows).collect()} == {"river road": -1, "river boat water": 1}
    with pytest.raises(ValueError, match="topic"):
        fitted.transform(rows.withColumn("topic", F.lit(1)))


def test_unfinished_save_does_not_load(fitted, tmp_path, spark):
    path = MS.version_path(str(tmp_path), "half")
    fitted.tables["weights"].write.parquet(f"{path}/weights")
    with pytest.raises(PySparkException):
        MS.DensityTopicsModel.load(path)
    with pytest.raises(ValueError):
        MS.version_path(str(tmp_path), "../up")


def test_nearest_topics_against_brute_force(spark):
    rng = random.Random(8)
    vocab = [f"w{i}" for i in range(40)]
    docs = [(f"d{i}", " ".join(rng.choices(vocab[(i % 5) * 6:], k=12))) for i in range(60)]
    assign = [(k, i % 5 - 1) for i, (k, _) in enumerate(docs)]
    d = spark.createDataFrame(docs, "doc_key string, text string")
    w = TP.ctfidf(TP.topic_term_counts(d, spark.createDataFrame(assign, "doc_key string, topic int"))).cache()
    new = [(i, " ".join(rng.choices(vocab + ["zz"], k=rng.randrange(0, 9)))) for i in range(80)]
    got = {r.id: (r.topic, round(r.similarity, 9)) for r in MS.nearest_topics(
        spark.createDataFrame(new, "id int, text string"), w, "id").collect()}
    topics, idf = {}, {}
    for r in w.collect():
        topics.setdefault(r.topic, {})[r.term] = r.ctfidf
        idf[r.term] = r.idf
    want = {}
    for i, text in new:
        x = {t: n * idf[t] for t, n in Counter(text.split()).items() if t in idf}
        size = math.sqrt(sum(v * v for v in x.values()))
        cos = {k: sum(v * m.get(t, 0) for t, v in x.items()) / math.sqrt(sum(v * v for v in m.values())) / size
               for k, m in topics.items() if k != -1} if size else {}
        if cos and max(cos.values()) > 0:
            best = min(cos, key=lambda k: (-round(cos[k] * size, 8), k))
            want[i] = (best, round(cos[best], 9))
    assert got == want and len(want) > 50
