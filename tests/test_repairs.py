"""Numbering, clustering, annotation and dedupe at sizes and ties that broke before."""

import tempfile

from pyspark.sql import functions as F

from canopy.operators import annotate as A
from canopy.operators import cluster as C
from canopy.operators import dedupe as D
from canopy.operators import records as R
from canopy.operators import topics as TP
from canopy.operators import vectors as V
from canopy.streaming import posts as ST


def test_global_index_is_dense_with_payload(spark):
    df = spark.range(300_000).select(F.xxhash64("id").alias("k"), F.concat_ws("-", "id", F.md5(F.col("id").cast("string"))).alias("payload"))
    out = R.global_index(df, ["k"], parts=8)
    assert out.agg(F.min("idx"), F.max("idx"), F.count_distinct("idx")).first() == (0, 299_999, 300_000)
    w = out.selectExpr("k", "lag(k) OVER (PARTITION BY idx DIV 1000 ORDER BY idx) AS before")
    assert w.where("before > k").isEmpty()
    sizes = R.batches_of(df, ["k"], 100).groupBy("batch_no").count()
    assert sizes.where("count != 100").isEmpty()


def test_renumber_keeps_every_cluster(spark):
    a = spark.range(60_000).select(F.col("id").alias("doc_key"), (F.col("id") % 40_000).alias("topic"))
    assert TP.renumber(a).select("topic").distinct().count() == 40_000


def test_membership_of_exact_copies(spark):
    rows = [(i, [1.0, 0.0]) for i in range(5)] + [(9, [1.05, 0.0]), (20, [9.0, 9.0])]
    pts = spark.createDataFrame(rows, "id long, vec array<double>")
    edges = C.eps_graph(pts, 0.1, 2)
    topics = C.topics_from_clusters(C.dbscan_star(pts, 0.1, 3, 2, edges=edges), 2)
    p = {r.id: r.probability for r in C.membership(topics, edges, 3).collect()}
    assert all(p[i] == 1.0 for i in range(5)) and p[20] == 0.0 and 0 <= p[9] <= 1


def test_zero_vectors(spark):
    df = spark.createDataFrame([([0.0, 0.0], [1.0, 0.0])], "a array<double>, b array<double>")
    r = df.select(V.cosine("a", "b").alias("c"), V.unit("a").alias("u")).first()
    assert r.c == 0.0 and r.u == [0.0, 0.0]


def test_model_is_called_once_per_topic(spark):
    calls = tempfile.mkdtemp(prefix="canopy-calls-", dir="/tmp")
    topics = spark.createDataFrame([("text", i, ["w"], ["d"], None) for i in range(6)],
                                   "modality string, topic_no int, representation array<string>, "
                                   "representative_docs array<string>, image_path string")

    def model(prompt, image):
        import uuid
        open(f"{calls}/{uuid.uuid4()}", "w").close()
        if len(prompt) % 2 > 5:
            return None
        return '{"topic_name": "x"}'

    ok, errors = A.annotate(topics, model)
    assert ok.count() + errors.count() == 6 and ok.union(ok).count() == 12
    import os
    assert len(os.listdir(calls)) == 6


def test_annotations_are_written_once_by_modality(spark, tmp_path):
    df = spark.createDataFrame([("text", 1, "a"), ("image", 1, "b")], "modality string, topic_no int, topic_name string")
    A.write_annotations(df, str(tmp_path / "a"))
    assert (tmp_path / "a" / "modality=image").is_dir()
    try:
        A.write_annotations(df, str(tmp_path / "a"))
    except Exception as e:
        assert "PATH_ALREADY_EXISTS" in str(e)
    else:
        raise AssertionError("a second write must fail")


def test_label_sets():
    assert "caption" not in A.IMAGE_TOPIC_TYPES and {"infographic", "map"} <= set(A.IMAGE_TYPES)


def test_null_keys_stay_without_a_window(spark):
    df = spark.range(40).selectExpr("id AS custom_id", "timestamp_ntz'2024-01-01 00:00:00' AS msg_date_dt",
                                    "if(id % 2 = 0, NULL, id % 4) AS h")
    out = D.keep_first(df, ["h"], null_key="keep")
    assert out.where("h IS NULL").count() == 20 and out.where("h IS NOT NULL").count() == 2
    assert D.keep_first(df, ["h"]).count() == 3


def test_a_late_post_and_a_late_replay(spark):
    root = tempfile.mkdtemp(prefix="canopy-late-", dir="/tmp")
    day = 86_400
    cols = [f.name for f in ST.POST_SCHEMA]

    def posts(rows):
        full = [("s", p, "t", at, "u", 1, 1, "http://x", None) for p, at in rows]
        return spark.createDataFrame(full, ST.POST_SCHEMA).select(*cols)

    status = spark.createDataFrame([("p1", "no image")], "post_id string, download_status string")
    for rows in ([("p1", 100 * day), ("p2", 101 * day)], [("p3", 97 * day), ("p1", 100 * day)]):
        ST.land(posts(rows), f"{root}/landing", n_flushes=1)
        ST.run_ingest(spark, f"{root}/landing", f"{root}/sink", f"{root}/ckpt", status)
    assert sorted(r.post_id for r in spark.read.parquet(f"{root}/sink").collect()) == ["p1", "p2", "p3"]


def test_topics_of_clusters_keep_the_type_of_their_ids(spark):
    """Ids of 2^31 and more, and ids that are strings."""
    from canopy.operators import cluster
    big = 3_000_000_000
    rows = [(big + i, big if i < 6 else big + 6) for i in range(8)]
    for ddl, turn in (("id long, component long", int), ("id string, component string", str)):
        df = spark.createDataFrame([(turn(a), turn(b), True) for a, b in rows], ddl.replace("component", "cluster") + ", is_core boolean")
        got = {r.id: r.topic for r in cluster.topics_from_clusters(df, 3).collect()}
        assert got == {turn(a): (0 if b == big else -1) for a, b in rows}


def test_string_and_large_keys_cluster(spark):
    for name in (lambda i: f"doc-{i:02d}", lambda i: 3_000_000_000_000 + i):
        rows = [(name(i), [float(i // 10 * 9), (i % 10) / 100]) for i in range(25)] + [(name(30), [500.0, 0.0])]
        pts = spark.createDataFrame(rows, f"id {'string' if isinstance(rows[0][0], str) else 'long'}, vec array<double>")
        clusters = C.dbscan_star(pts, 0.5, 3, 2)
        assert {r.id: r.topic for r in C.topics_from_clusters(clusters, 6).collect()} == {
            r[0]: (0 if i < 10 else 1 if i < 20 else -1) for i, r in enumerate(rows)}
        assert V.knn(pts, 2, 2, 0.5).count() == 2 * len(rows)
