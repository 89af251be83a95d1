"""Stage 3 queries on vectors: kNN, eps-edges, DBSCAN* topics, membership,
fusion, cross-modal contingency, representative images, sweep."""

from __future__ import annotations

from pyspark.ml.stat import Summarizer
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.sql import Window
from pyspark.sql import functions as F

from canopy.operators import cluster as C
from canopy.operators import topics as TP
from canopy.operators import vectors as V
from canopy.operators.util import materialize
from canopy.plans import sql as S
from canopy.plans.registry import register
from canopy.plans.topic_plans import TOPIC_WITH, label_assign, text_docs
from canopy.sources import tables as TB

# Density parameters, neighbour count and the topic-size sweep.
EPS = 1.15
MIN_PTS = 3
MIN_TOPIC_SIZE = 3
KNN_K = 5
SWEEP = (10, 20, 50)
N_REPR_IMAGES = 9
DIM = 64


def points(spark, sf):
    e = TB.table(spark, sf, "embeddings")
    return e.select(F.col("vec_id").alias("id"), V.as_double("embedding").alias("vec"), "label")


def cluster_state(spark, sf):
    p = points(spark, sf)
    core = materialize(C.core_points(p, EPS, MIN_PTS, DIM), "core")
    return p, core, C.dbscan_star(p, EPS, MIN_PTS, DIM, core=core)


_PTS = "pts AS (SELECT vec_id AS id, CAST(embedding AS DOUBLE[]) AS vec, label FROM embeddings)"
_EDGES = f"""edges AS (SELECT a.id AS src, b.id AS dst, list_distance(a.vec, b.vec) AS dist
  FROM pts a JOIN pts b ON a.id <> b.id WHERE list_distance(a.vec, b.vec) <= {EPS})"""
_DBSCAN = (
    _PTS, _EDGES,
    "deg AS (SELECT p.id, 1 + count(e.dst) AS degree FROM pts p LEFT JOIN edges e ON p.id = e.src GROUP BY p.id)",
    f"core AS (SELECT id FROM deg WHERE degree >= {MIN_PTS})",
    "ce AS (SELECT e.src, e.dst FROM edges e JOIN core c1 ON e.src = c1.id JOIN core c2 ON e.dst = c2.id)",
    "reach(id, comp) AS (SELECT id, id FROM core UNION SELECT ce.dst, reach.comp FROM reach JOIN ce ON reach.id = ce.src)",
    "comp AS (SELECT id, min(comp) AS cluster FROM reach GROUP BY id)",
    "clusters AS (SELECT p.id, coalesce(c.cluster, -1) AS cluster FROM pts p LEFT JOIN comp c USING (id))",
)


def _final(min_size: int, name: str = "final") -> tuple[str, ...]:
    return (
        f"""sized_{min_size} AS (SELECT id, CASE WHEN cluster <> -1 AND count(*) OVER (PARTITION BY cluster) >= {min_size}
                THEN cluster ELSE -1 END AS t FROM clusters)""",
        f"""ren_{min_size} AS (SELECT t, row_number() OVER (ORDER BY count(*) DESC, min(id)) - 1 AS nt
                FROM sized_{min_size} WHERE t <> -1 GROUP BY t)""",
        f"""{name} AS (SELECT s.id, CAST(coalesce(r.nt, -1) AS INTEGER) AS topic
                FROM sized_{min_size} s LEFT JOIN ren_{min_size} r USING (t))""",
    )


def _rec(*ctes: str) -> str:
    return "WITH RECURSIVE " + ",\n".join(ctes) + "\n"


@register("eps_edges", S.with_(_PTS, _EDGES) + "SELECT src, dst, round(dist, 8) AS dist FROM edges", "J10 M5")
def q_eps_edges(spark, sf):
    e = C.eps_graph(points(spark, sf), EPS, DIM)
    return e.select("src", "dst", F.round("dist", 8).alias("dist"))


@register("knn_exact", S.with_(_PTS) + f"""
SELECT src, dst, round(dist, 8) AS dist, rank FROM (
  SELECT a.id AS src, b.id AS dst, list_distance(a.vec, b.vec) AS dist,
         row_number() OVER (PARTITION BY a.id ORDER BY list_distance(a.vec, b.vec), b.id) AS rank
  FROM pts a JOIN pts b ON a.id <> b.id) WHERE rank <= {KNN_K}""", "J6 M5")
def q_knn_exact(spark, sf):
    k = V.knn(points(spark, sf), KNN_K, DIM, radius=EPS / 2)
    return k.select("src", "dst", F.round("dist", 8).alias("dist"), F.col("rank").cast("bigint").alias("rank"))


@register("density_clusters", _rec(*_DBSCAN, *_final(MIN_TOPIC_SIZE)) + "SELECT id AS vec_id, topic FROM final",
          "TM5 A7 W3 TM6")
def q_density_clusters(spark, sf):
    _, _, clusters = cluster_state(spark, sf)
    t = C.topics_from_clusters(clusters, MIN_TOPIC_SIZE)
    return t.select(F.col("id").alias("vec_id"), "topic")


@register("membership", _rec(*_DBSCAN, *_final(MIN_TOPIC_SIZE)) + f"""
, kth AS (SELECT src AS id, dist AS core_dist FROM (
    SELECT *, row_number() OVER (PARTITION BY src ORDER BY dist, dst) AS r FROM edges) WHERE r = {MIN_PTS - 1}),
t AS (SELECT f.id, f.topic, k.core_dist FROM final f LEFT JOIN kth k USING (id)),
best AS (SELECT topic, min(core_dist) AS b FROM t WHERE topic <> -1 GROUP BY topic)
SELECT id AS vec_id, topic, round(CASE WHEN topic = -1 THEN 0.0 WHEN core_dist = 0 THEN 1.0 ELSE b / core_dist END, 8) AS probability
FROM t LEFT JOIN best USING (topic)""",
          "TM13")
def q_membership(spark, sf):
    _, core, clusters = cluster_state(spark, sf)
    t = C.topics_from_clusters(clusters, MIN_TOPIC_SIZE)
    m = C.core_membership(t, core)
    return m.select(F.col("id").alias("vec_id"), "topic", F.round("probability", 8).alias("probability"))


_SWEEP_FINALS = tuple(c for s in SWEEP for c in _final(s, f"final_{s}"))
_SWEEP_SQL = _rec(*_DBSCAN, *_SWEEP_FINALS) + " UNION ALL ".join(
    f"SELECT 'dedupe_vec_{s}_nov' AS model_version, topic, count(*) AS count FROM final_{s} GROUP BY topic"
    for s in SWEEP)


@register("sweep_topic_sizes", _SWEEP_SQL, "U3 TM16 F11")
def q_sweep_topic_sizes(spark, sf):
    _, _, clusters = cluster_state(spark, sf)
    clusters = materialize(clusters)
    outs = []
    for s in SWEEP:
        t = C.topics_from_clusters(clusters, s)
        version = F.concat_ws("_", F.lit("dedupe"), F.lit("vec"), F.lit(str(s)), F.lit("nov"))
        outs.append(t.groupBy("topic").agg(F.count(F.lit(1)).alias("count")).select(
            version.alias("model_version"), "topic", "count"))
    out = outs[0]
    for o in outs[1:]:
        out = out.unionByName(o)
    return out


@register("fuse_embeddings", S.with_(_PTS) + """
SELECT id AS vec_id, CAST(len(f) AS BIGINT) AS n_dims, round(list_sum(f), 6) AS fused_sum,
       round(sqrt(list_sum(list_transform(f, lambda x: x * x))), 6) AS fused_norm, round(f[1], 6) AS first_value
FROM (SELECT t.id, list_transform(range(1, len(t.vec) + 1), lambda k: (t.vec[k] + i.vec[k]) / 2) AS f
      FROM pts t JOIN pts i ON i.id = CASE WHEN t.id = (SELECT max(id) FROM pts) THEN (SELECT min(id) FROM pts)
                                           ELSE t.id + 1 END)""", "J7 M4 TM3")
def q_fuse_embeddings(spark, sf):
    p = points(spark, sf)
    least, most = p.agg(F.min("id"), F.max("id")).first()
    before = F.when(F.col("id") == least, most).otherwise(F.col("id") - 1)
    img = p.select(before.alias("id"), F.col("vec").alias("img_vec"))
    f = p.join(img, "id").select("id", V.fuse("vec", "img_vec").alias("f"))
    return f.select(F.col("id").alias("vec_id"), F.size("f").cast("bigint").alias("n_dims"),
                    F.round(F.aggregate("f", F.lit(0.0), lambda a, x: a + x), 6).alias("fused_sum"),
                    F.round(V.norm("f"), 6).alias("fused_norm"), F.round(F.element_at("f", 1), 6).alias("first_value"))


@register("intermodal_crosstab", TOPIC_WITH + """,
ti AS (SELECT a.topic AS text_topic, e.label AS img_topic FROM assign a JOIN docs d USING (doc_key)
       JOIN embeddings e ON e.vec_id = d.message_id),
x AS (SELECT text_topic, img_topic, count(*) AS n FROM ti GROUP BY text_topic, img_topic)
SELECT x.text_topic, x.img_topic, x.n, round(x.n / sum(x.n) OVER (PARTITION BY x.text_topic), 8) AS row_share,
       round(x.n / (a.c + b.c - x.n), 8) AS jaccard
FROM x JOIN (SELECT text_topic, count(*) AS c FROM ti GROUP BY text_topic) a USING (text_topic)
JOIN (SELECT img_topic, count(*) AS c FROM ti GROUP BY img_topic) b USING (img_topic)""", "J8 A10")
def q_intermodal_crosstab(spark, sf):
    docs = text_docs(spark, sf)
    a = label_assign(docs).join(docs.select("doc_key", "message_id"), "doc_key")
    e = TB.table(spark, sf, "embeddings").select(F.col("vec_id").alias("message_id"), F.col("label").alias("img_topic"))
    ti = a.join(e, "message_id").select(F.col("topic").alias("text_topic"), "img_topic")
    return crosstab(ti)


def crosstab(ti):
    """A10: contingency counts, share of the text topic, Jaccard overlap."""
    x = ti.groupBy("text_topic", "img_topic").agg(F.count(F.lit(1)).alias("n"))
    a = ti.groupBy("text_topic").agg(F.count(F.lit(1)).alias("_a"))
    b = ti.groupBy("img_topic").agg(F.count(F.lit(1)).alias("_b"))
    j = x.join(a, "text_topic").join(b, "img_topic")
    return j.select("text_topic", "img_topic", "n",
                    F.round(F.col("n") / F.col("_a"), 8).alias("row_share"),
                    F.round(F.col("n") / (F.col("_a") + F.col("_b") - F.col("n")), 8).alias("jaccard"))


@register("representative_images", S.with_(_PTS) + f""",
cent AS (SELECT topic, list(a ORDER BY pos) AS c FROM (
  SELECT label AS topic, pos, avg(x) AS a FROM (
    SELECT label, unnest(vec) AS x, unnest(range(1, len(vec) + 1)) AS pos FROM pts) GROUP BY label, pos)
  GROUP BY topic)
SELECT topic, rank, vec_id, round(sim, 8) AS similarity FROM (
  SELECT c.topic, p.id AS vec_id, list_cosine_similarity(p.vec, c.c) AS sim,
         row_number() OVER (PARTITION BY c.topic ORDER BY round(list_cosine_similarity(p.vec, c.c), 8) DESC, p.id) AS rank
  FROM pts p JOIN cent c ON p.label = c.topic) WHERE rank <= {N_REPR_IMAGES}""", "T6 TM12 W5")
def q_representative_images(spark, sf):
    p = points(spark, sf).withColumnRenamed("label", "topic")
    return representative_images(p, N_REPR_IMAGES).select(
        "topic", F.col("rank").cast("bigint").alias("rank"), F.col("id").alias("vec_id"),
        F.round("similarity", 8).alias("similarity"))


def representative_images(p, k):
    """TM12: the ``k`` images closest (cosine) to their topic centroid.

    Centroids come from a partial-aggregating ``Summarizer.mean`` per topic
    (one vector per topic, so the join back is to a small table)."""
    cent = (p.select("topic", array_to_vector("vec").alias("_v")).groupBy("topic")
            .agg(Summarizer.mean(F.col("_v")).alias("_c"))
            .select("topic", vector_to_array("_c").alias("centroid")))
    s = p.join(cent, "topic").select("topic", "id", V.cosine("vec", "centroid").alias("similarity"))
    w = Window.partitionBy("topic").orderBy(F.round("similarity", 8).desc(), "id")
    return s.withColumn("rank", F.row_number().over(w)).where(F.col("rank") <= k)


@register("kmeans_topics", None, "TM5b")
def q_kmeans_topics(spark, sf):
    return C.kmeans_topics(points(spark, sf), 10).select(F.col("id").alias("vec_id"), "topic")


@register("reduce_pca", None, "TM4")
def q_reduce_pca(spark, sf):
    return C.reduce_pca(points(spark, sf), 2).select(F.col("id").alias("vec_id"), "reduced")


__all__ = ["TP"]


# ---------------------------------------------------------------- images (derived from the vectors)
from canopy.operators import images as IM  # noqa: E402
from canopy.operators import model as MD  # noqa: E402
from canopy.plans.topic_plans import text_docs as _text_docs  # noqa: E402
from canopy.session import scratch_path  # noqa: E402

_DHASH_SQL = """WITH px AS (
  SELECT vec_id, list_transform(list_concat(CAST(embedding AS DOUBLE[]), CAST(embedding AS DOUBLE[])[1:8]),
         lambda x: CAST(least(greatest(floor((x + 1.0) * 127.5), 0), 255) AS INTEGER)) AS p FROM embeddings),
bits AS (SELECT vec_id, list_transform(range(0, 64), lambda i: CASE WHEN p[(i // 8) * 9 + i % 8 + 2] >
         p[(i // 8) * 9 + i % 8 + 1] THEN 1 ELSE 0 END) AS b FROM px)
SELECT vec_id, array_to_string(list_transform(range(0, 16), lambda j: substr('0123456789abcdef',
       b[j * 4 + 1] * 8 + b[j * 4 + 2] * 4 + b[j * 4 + 3] * 2 + b[j * 4 + 4] + 1, 1)), '') AS dhash FROM bits"""


def _pixels(spark, sf):
    return points(spark, sf).select("id", IM.pixels_from_vector("vec").alias("pixels"))


@register("dhash_vector", _DHASH_SQL, "M1")
def q_dhash_vector(spark, sf):
    return _pixels(spark, sf).select(F.col("id").alias("vec_id"), IM.dhash_from_pixels("pixels").alias("dhash"))


def _landed_images(spark, sf, corrupt: bool = True):
    folder = scratch_path(spark, "images")
    IM.land_pngs(_pixels(spark, sf), folder)
    if corrupt:
        local = folder[len("file:"):] if folder.startswith("file:") else folder
        with open(f"{local}/corrupt.png", "wb") as fh:
            fh.write(b"\x89PNG\r\n\x1a\nnot an image")
    hashes = IM.hash_images(IM.scan_images(spark, folder))
    return hashes.withColumn("vec_id", F.regexp_extract("file_path", r"/(\d+)\.png$", 1).try_cast("bigint"))


@register("image_dhash", _DHASH_SQL, "S7 M1 M3 N5 V3")
def q_image_dhash(spark, sf):
    h = _landed_images(spark, sf, corrupt=False)
    return h.select("vec_id", "dhash")


@register("image_hash", None, "S7 M1 M2 M3 N5")
def q_image_hash(spark, sf):
    return _landed_images(spark, sf).select("vec_id", "file_path", "dhash", "phash")


@register("scan_images", None, "S7")
def q_scan_images(spark, sf):
    folder = scratch_path(spark, "images")
    IM.land_pngs(_pixels(spark, sf), folder)
    img = IM.scan_images(spark, folder)
    return img.select(F.col("image.origin").alias("origin"), F.col("image.height").alias("height"),
                      F.col("image.width").alias("width"), F.col("image.nChannels").alias("n_channels"))


# ---------------------------------------------------------------- the topic model end to end
def _model_docs(spark, sf):
    d = _text_docs(spark, sf).select(F.col("message_id").alias("doc_key"), "text")
    v = points(spark, sf).select(F.col("id").alias("doc_key"), "vec")
    return d, v


def _caption_docs(spark, sf):
    d = TB.table(spark, sf, "documents").select(F.col("doc_id").alias("doc_key"), "text")
    v = points(spark, sf).select(F.col("id").alias("doc_key"), "vec")
    return d, v


def _info_out(model):
    i = model.info
    return i.select("topic", "count", "name", F.array_join("representation", ", ").alias("representation"),
                    F.array_join(F.transform("representative_keys", lambda k: k.cast("string")), "|")
                    .alias("representative_docs"))


def _model_sql(docs_sql: str, tail: str) -> str:
    from canopy.plans.sql import topic_ctes
    pts = ("pts AS (SELECT vec_id AS id, CAST(embedding AS DOUBLE[]) AS vec, label FROM embeddings "
           "WHERE vec_id IN (SELECT doc_key FROM docs0))")
    dbscan = (pts,) + _DBSCAN[1:]
    ctes = topic_ctes("SELECT doc_key, text FROM docs0",
                      "SELECT d.doc_key, CAST(coalesce(f.topic, -1) AS INTEGER) AS topic "
                      "FROM docs0 d LEFT JOIN final f ON f.id = d.doc_key")
    return _rec(*S.STAGE2, S.keep_first_sql("tc", "prepared", "cleaned_text"), f"docs0 AS ({docs_sql})",
                *dbscan, *_final(MIN_TOPIC_SIZE), *ctes) + tail


_INFO_TAIL = """SELECT s.topic, s.count, r.name, array_to_string(r.representation, ', ') AS representation,
       array_to_string(d.keys, '|') AS representative_docs
FROM (SELECT topic, count(*) AS count FROM assign GROUP BY topic) s
LEFT JOIN rep r USING (topic)
LEFT JOIN (SELECT topic, list(doc_key ORDER BY rank) AS keys FROM rdocs GROUP BY topic) d USING (topic)"""
_TEXT_DOCS0 = "SELECT message_id AS doc_key, cleaned_text AS text FROM tc"
_CAPTION_DOCS0 = "SELECT doc_id AS doc_key, text FROM documents"


@register("topic_model_info", _model_sql(_TEXT_DOCS0, _INFO_TAIL), "TM5 TM9 TM10 TM11 TM14 TM3")
def q_topic_model_info(spark, sf):
    d, v = _model_docs(spark, sf)
    return _info_out(MD.fit(d, v, EPS, MIN_PTS, MIN_TOPIC_SIZE, DIM))


@register("topic_model_documents", _model_sql(_TEXT_DOCS0, f"""
, kth AS (SELECT src AS id, dist AS core_dist FROM (
    SELECT *, row_number() OVER (PARTITION BY src ORDER BY dist, dst) AS r FROM edges) WHERE r = {MIN_PTS - 1}),
t AS (SELECT f.id, f.topic, k.core_dist FROM final f LEFT JOIN kth k USING (id)),
best AS (SELECT topic, min(core_dist) AS b FROM t WHERE topic <> -1 GROUP BY topic),
prob AS (SELECT id AS doc_key, CASE WHEN topic = -1 THEN 0.0 WHEN core_dist = 0 THEN 1.0 ELSE b / core_dist END AS probability
         FROM t LEFT JOIN best USING (topic))
SELECT a.doc_key, a.topic, r.name, array_to_string(r.representation, ' - ') AS top_n_words,
       round(coalesce(p.probability, 0.0), 8) AS probability, rd.doc_key IS NOT NULL AS representative_document
FROM assign a LEFT JOIN rep r USING (topic) LEFT JOIN rdocs rd USING (doc_key) LEFT JOIN prob p USING (doc_key)"""),
          "TM15 TM13 J5")
def q_topic_model_documents(spark, sf):
    d, v = _model_docs(spark, sf)
    out = MD.document_info(MD.fit(d, v, EPS, MIN_PTS, MIN_TOPIC_SIZE, DIM))
    return out.select("doc_key", "topic", "name", "top_n_words", F.round("probability", 8).alias("probability"),
                      "representative_document")


TEXT_EPS, TEXT_DIM = 0.9, 64


@register("text_topics", None, "TM1 TM4 TM5 TM9 TM10 TM11 TM15")
def q_text_topics(spark, sf):
    """The whole chain on every corpus document: embed, cluster, describe."""
    d = _text_docs(spark, sf).select(F.col("message_id").alias("doc_key"), "text")
    out = MD.document_info(MD.fit_text(d, TEXT_EPS, MIN_PTS, MIN_TOPIC_SIZE, TEXT_DIM))
    return out.select("doc_key", "topic", "name", "top_n_words", F.round("probability", 6).alias("probability"),
                      "representative_document")


@register("topic_info_image", _model_sql(_CAPTION_DOCS0, _INFO_TAIL), "TM7 TM8 TM2")
def q_topic_info_image(spark, sf):
    d, v = _caption_docs(spark, sf)
    return _info_out(MD.fit(d, v, EPS, MIN_PTS, MIN_TOPIC_SIZE, DIM))


# ---------------------------------------------------------------- embeddings (TM1)
from canopy.operators import embed as EM  # noqa: E402


@register("embed_text", None, "TM1 TM4")
def q_embed_text(spark, sf):
    d = _text_docs(spark, sf).select(F.col("message_id").alias("doc_key"), "text")
    e = EM.embed_text(d, dim=16)
    return e.select("doc_key", F.size("vec").cast("bigint").alias("n_dims"), F.round(V.norm("vec"), 6).alias("norm"))


@register("topic_images", None, "S11 N7 N8 T6 TM12 P21 J1 J2")
def q_topic_images(spark, sf):
    """Per image topic: the best representative image as a Base64 picture
    (the Visual_Aspect stand-in), decoded and written as one file per topic;
    the path table joins back to the topics with no loss."""
    from pyspark.sql import Window as W
    p = points(spark, sf).withColumnRenamed("label", "topic")
    best = representative_images(p, 1).join(_pixels(spark, sf), "id")
    pics = best.select("topic", IM.png_udf("pixels").alias("_png"))
    pics = pics.select("topic", F.replace(F.base64("_png"), F.lit("\r\n"), F.lit("")).alias("visual_aspect"),
                       (F.row_number().over(W.orderBy("topic")) - 1).alias("index"))
    pics = materialize(pics, "visual_aspect")
    written = IM.write_topic_images(pics, scratch_path(spark, "topic_images"))
    return pics.join(written, "index").select("topic", "index", "image_path")


# ---------------------------------------------------------------- multi-level density topics (TM5, eps grid)
from canopy.operators import hierarchy as HI  # noqa: E402

EPS_LEVELS = (1.05, 1.10, 1.15, 1.20)


@register("hdbscan_topics", None, "TM5 TM6 A7")
def q_hdbscan_topics(spark, sf):
    t = HI.hdbscan_topics(points(spark, sf), EPS_LEVELS, MIN_PTS, MIN_TOPIC_SIZE, DIM)
    return t.select(F.col("id").alias("vec_id"), "topic")


# ---------------------------------------------------------------- exact density tree (TM5, TM13)
from canopy.operators import density_tree as DT  # noqa: E402

#: First radius of the neighbour search.
TREE_RADIUS = 1.1


@register("density_tree_topics", None, "TM5 TM6 TM13 A7")
def q_density_tree_topics(spark, sf):
    t = DT.density_topics(points(spark, sf), MIN_PTS, MIN_TOPIC_SIZE, DIM, TREE_RADIUS)
    return t.select(F.col("id").alias("vec_id"), "topic", F.round("probability", 6).alias("probability"))
