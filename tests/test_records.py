"""Record rules: message type edge cases, URL tests, window bounds,
gallery lookups, per-group limits and the global index."""

from pyspark.sql import functions as F

from canopy.functions import media as M
from canopy.operators import records as R

MEDIA = ("struct<kind:string, photo:struct<id:bigint, access_hash:bigint>, "
         "document:struct<id:bigint, access_hash:bigint, mime_type:string>>")


def test_message_type_edges(spark):
    rows = [
        (1, None, None), (2, "", None), (3, "hi", None),
        (4, None, ("photo", (1, 2), None)),
        (5, "x", ("document", None, (1, 2, "audio/ogg"))),
        (6, "x", ("document", None, (1, 2, "video/mp4"))),
        (7, "x", ("document", None, (1, 2, "application/pdf"))),
        (8, "x", ("webpage", None, None)),
        (9, "x", ("poll", None, None)),
    ]
    df = spark.createDataFrame(rows, f"i int, text string, media {MEDIA}")
    got = [r[0] for r in df.orderBy("i").select(M.message_type()).collect()]
    assert got == ["service", "service", "text", "image", "audio", "video", None, "web_page", "other"]


def test_url_kind_and_status(spark):
    df = spark.createDataFrame([("a.jpg",), ("x/gallery.png",), ("b.JPG",), ("cjpeg",)], "url string")
    got = df.select(M.is_image_url().alias("i"), M.is_gallery_url().alias("g")).collect()
    assert [(r.i, r.g) for r in got] == [(True, False), (True, True), (False, False), (True, False)]


def test_window_bounds(spark):
    df = spark.createDataFrame([("2024-11-01 00:00:00",), ("2024-11-30 00:00:00",), ("2024-11-30 00:00:00.000001",)],
                               "t string").select(F.col("t").cast("timestamp_ntz").alias("msg_date_dt"))
    assert R.in_window(df, "2024-11-01 00:00:00", "2024-11-30 00:00:00").count() == 2
    assert R.in_window(df, "2024-11-01 00:00:00", "2024-11-30 00:00:00", closed="left").count() == 1


def test_gallery_missing_key(spark):
    df = spark.createDataFrame(
        [("s", "p", [("m0",), ("m1",)], {"m0": (("u0",),)})],
        "subreddit string, post_id string, items array<struct<media_id:string>>, "
        "media_metadata map<string, struct<s:struct<u:string>>>")
    got = R.gallery_items(df).orderBy("idx").collect()
    assert [(r.idx, r.url, r.file_name) for r in got] == [(0, "u0", "s_p_gallery_0.png"), (1, None, "s_p_gallery_1.png")]


def test_global_index_dense(spark):
    df = spark.range(0, 1000).select((F.col("id") * 7 % 1000).alias("k"))
    ix = R.global_index(df, ["k"], "i").collect()
    assert sorted((r.k, r.i) for r in ix) == [(k, k) for k in range(1000)]


def test_top_per_group(spark):
    df = spark.createDataFrame([("a", 3), ("a", 2), ("a", 1), ("b", 5)], "g string, s int")
    got = R.top_per_group(df, "g", [F.col("s").desc()], 2).collect()
    assert sorted((r.g, r.s, r.rank) for r in got) == [("a", 2, 2), ("a", 3, 1), ("b", 5, 1)]
