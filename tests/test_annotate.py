"""Annotation: answer parsing, alias keys, failed calls, prompts."""

from pyspark.sql import functions as F

from canopy.operators import annotate as A


def test_parse_shapes(spark):
    rows = [(0, '```json\n{"topic_name": "a", "topic_type": "ad"}\n```'), (1, '{"Name": "b", "type": "caption"}'),
            (2, "not json"), (3, None), (4, ' {"topic_name": "c", "extra": "x"}\n')]
    df = spark.createDataFrame([("text", i, r) for i, r in rows], "modality string, topic_no int, response string")
    p = A.parse(df)
    ok = A.annotation_columns(p.where(F.col("raw").isNotNull())).orderBy("topic_no").collect()
    assert [(r.topic_no, r.topic_name, r.topic_type) for r in ok] == [(0, "a", "ad"), (1, "b", "caption"), (4, "c", None)]


def test_failed_model_goes_to_errors(spark):
    topics = spark.createDataFrame(
        [("text", 0, ["w1", "w2", "w3", "w4"], ["d"], None), ("text", 1, ["x"], ["d"], None)],
        "modality string, topic_no int, representation array<string>, representative_docs array<string>, "
        "image_path string")

    def flaky(prompt, image):
        if "'x'" in prompt:
            raise RuntimeError("quota")
        return A.offline_annotator(prompt, image)

    ok, errors = A.annotate(topics, flaky)
    assert [(r.topic_no, r.topic_name) for r in ok.collect()] == [(0, "w1 w2 w3")]
    assert [r.topic_no for r in errors.collect()] == [1]


def test_image_paths_index(spark):
    df = spark.createDataFrame([(-1,), (0,), (1,)], "topic int")
    got = dict(A.image_paths(df, "out").collect())
    assert got == {-1: "out/image_0.jpeg", 0: "out/image_1.jpeg", 1: "out/image_2.jpeg"}
