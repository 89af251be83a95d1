"""Keep-first dedupe: unique keys, minimum order key kept, order of A2e,
NULL key handling, and the fixture counts of FIXTURES.md at sf0.01."""

from pyspark.sql import functions as F

from canopy.operators import dedupe as D
from canopy.sources.tables import messages
from tests.conftest import SF_MID


def test_fixture_counts(spark):
    got = {r["corpus"]: r["n_rows"] for r in D.corpus_sizes(messages(spark, SF_MID)).collect()}
    assert got == {"prepared": 655, "base": 600, "text": 563, "image": 235, "multimodal": 231,
                   "multimodal_text_first": 232}


def test_keeps_first_and_unique(spark):
    prep = D.prepared(messages(spark, SF_MID))
    text = D.text_corpus(prep)
    assert text.groupBy("cleaned_text").count().where("count > 1").count() == 0
    firsts = prep.groupBy("cleaned_text").agg(F.min(F.struct("msg_date_dt", "custom_id")).alias("m"))
    kept = text.select("cleaned_text", F.struct("msg_date_dt", "custom_id").alias("m"))
    assert firsts.exceptAll(kept).count() == 0


def test_multimodal_subset_of_image(spark):
    prep = D.prepared(messages(spark, SF_MID))
    mm = D.multimodal_corpus(prep).select("custom_id")
    img = D.image_corpus(prep).select("custom_id")
    assert mm.exceptAll(img).count() == 0


def test_null_key_modes(spark):
    df = spark.createDataFrame(
        [("a", None, 1), ("b", None, 2), ("c", "h", 3), ("d", "h", 4)],
        "custom_id string, dhash string, t int").withColumn("msg_date_dt", F.col("t").cast("timestamp"))
    collapse = D.keep_first(df, ["dhash"]).select("custom_id").collect()
    keep = D.keep_first(df, ["dhash"], null_key="keep").select("custom_id").collect()
    assert sorted(r[0] for r in collapse) == ["a", "c"]
    assert sorted(r[0] for r in keep) == ["a", "b", "c"]


def test_text_is_cleaned_once(spark):
    cols = "custom_id string, text string, msg_type string, dhash string, msg_date_dt timestamp"
    rows = [("a", "x https://u.v/w", "image", "h", None), ("a", "y", "image", "h", None), ("b", "https://u.v", "image", "h", None),
            ("c", None, "image", None, None), ("d", "z", "text", None, None)]
    df = spark.createDataFrame(rows, cols)
    out = D.image_messages(D.cleaned_messages(df))
    assert sorted((r.custom_id, r.cleaned_text) for r in out.collect()) == [("a", "x "), ("a", "y")]
    assert out.columns == [*df.columns, "cleaned_text"]
    plan = D.prepared(df)._jdf.queryExecution().executedPlan().toString()
    assert not any("Filter" in line and "regexp_replace" in line for line in plan.splitlines())
