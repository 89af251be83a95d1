"""S8-S10, TM14: a topic model as an MLlib estimator / model pair whose tables
live under a named version and which assigns new texts to its topics.

A version is one folder ``model_version=<name>`` holding ``topic_info``,
``docs_topic_info``, ``weights`` (c-TF-IDF) and ``metadata``.  The metadata is
written last: a save that was cut off cannot be loaded.  A second save to the
same version fails, unless the writer was told to overwrite.

Assignment: the cosine between the text's c-TF-IDF vector (its term counts
times the fitted idf) and each topic's.  The fitted terms become one row per
term that carries all its topics, so the texts meet them in one many-to-one
join; the rest is two sums.  Equal texts are scored once.

Defined results: a null or empty text, or one without a fitted term, is an
outlier (-1) with similarity 0; of equally near topics the smallest id wins;
repeated rows each get their own answer; all input columns stay, and an input
that already has an output column is refused by name.
"""

from __future__ import annotations

import re

from pyspark.ml import Estimator, Model
from pyspark.ml.param import Param, Params, TypeConverters
from pyspark.ml.util import DefaultParamsReader, DefaultParamsWriter, MLReadable, MLReader, MLWritable, MLWriter
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from canopy.operators import model as MD
from canopy.operators import topics as TP
from canopy.operators.util import materialize

TABLES = ("topic_info", "docs_topic_info", "weights")


def version_path(root: str, version: str) -> str:
    """Folder of a model version; the name may hold letters, digits, ``.``, ``_`` and ``-``."""
    if not re.fullmatch(r"[A-Za-z0-9_-][A-Za-z0-9._-]*", version):
        raise ValueError(f"not a version name: {version!r}")
    return f"{root.rstrip('/')}/model_version={version}"


def nearest_topics(texts: DataFrame, weights: DataFrame, key: str, text: str = "text") -> DataFrame:
    """(key, topic, similarity): the nearest topic of every text that shares a
    weighted term with one; ``key`` must be unique.  Outliers are no target."""
    w = weights.where(F.col("topic") != TP.OUTLIER).withColumn("topic", F.col("topic").cast("int"))
    length = w.groupBy("topic").agg(F.sqrt(F.sum(F.col("ctfidf") * F.col("ctfidf"))).alias("_len"))
    unit = w.join(length, "topic").where(F.col("_len") > 0).select(
        "term", "topic", (F.col("ctfidf") / F.col("_len")).alias("_w"))
    targets = unit.groupBy("term").agg(F.collect_list(F.struct("topic", "_w")).alias("_targets"))
    # a term that only outliers hold still counts in the length of a text
    fitted = weights.groupBy("term").agg(F.max("idf").alias("idf")).join(targets, "term", "left")
    none = F.struct(F.lit(None).cast("int").alias("topic"), F.lit(0.0).alias("_w"))
    entries = F.concat(F.coalesce("_targets", F.array().cast("array<struct<topic:int,_w:double>>")), F.array(none))
    met = TP.doc_terms(texts, key, text).join(fitted, "term").select(
        key, (F.col("n") * F.col("idf")).alias("_x"), F.explode(entries).alias("_t"))
    # the entry without a topic sums the squares of the text's own vector
    part = F.when(F.col("_t.topic").isNull(), F.col("_x") * F.col("_x")).otherwise(F.col("_x") * F.col("_t._w"))
    sums = met.groupBy(key, F.col("_t.topic").alias("topic")).agg(F.sum(part).alias("_s"))
    best = sums.groupBy(key).agg(
        F.sqrt(F.max(F.when(F.col("topic").isNull(), F.col("_s")))).alias("_n"),
        F.max(F.when(F.col("topic").isNotNull(),
                     F.struct(F.round("_s", TP.SCORE_PLACES).alias("r"), (-F.col("topic")).alias("m"),
                              F.col("_s").alias("s")))).alias("_b"))
    return best.where((F.col("_n") > 0) & (F.col("_b.s") > 0)).select(
        key, (-F.col("_b.m")).alias("topic"), (F.col("_b.s") / F.col("_n")).alias("similarity"))


class _TopicParams(Params):
    textCol = Param(Params._dummy(), "textCol", "text column", TypeConverters.toString)
    topicCol = Param(Params._dummy(), "topicCol", "output: topic, -1 for outliers", TypeConverters.toString)
    similarityCol = Param(Params._dummy(), "similarityCol", "output: cosine to the topic", TypeConverters.toString)
    minSimilarity = Param(Params._dummy(), "minSimilarity", "below it a text is an outlier", TypeConverters.toFloat)

    def _defaults(self, given: dict) -> None:
        self._setDefault(textCol="text", topicCol="topic", similarityCol="similarity", minSimilarity=0.0)
        self._set(**given)


class DensityTopics(Estimator, _TopicParams):
    """Fits density topics over rows of (key, text, vector)."""

    keyCol = Param(Params._dummy(), "keyCol", "unique document key", TypeConverters.toString)
    vectorCol = Param(Params._dummy(), "vectorCol", "array<double>; null: no vector", TypeConverters.toString)
    eps = Param(Params._dummy(), "eps", "neighbour radius", TypeConverters.toFloat)
    minPts = Param(Params._dummy(), "minPts", "neighbours of a core point", TypeConverters.toInt)
    minTopicSize = Param(Params._dummy(), "minTopicSize", "smallest topic", TypeConverters.toInt)
    dim = Param(Params._dummy(), "dim", "length of a vector", TypeConverters.toInt)

    def __init__(self, **given):
        super().__init__()
        self._setDefault(keyCol="doc_key", vectorCol="vec", minPts=5, minTopicSize=10)
        self._defaults(given)

    def _fit(self, dataset: DataFrame) -> DensityTopicsModel:
        get = self.getOrDefault
        rows = materialize(dataset.select(F.col(get("keyCol")).alias("doc_key"), F.col(get("textCol")).alias("text"),
                                          F.col(get("vectorCol")).alias("vec")), "fit_rows")
        m = MD.fit(rows.select("doc_key", "text"), rows.where(F.col("vec").isNotNull()).select("doc_key", "vec"),
                   get("eps"), get("minPts"), get("minTopicSize"), get("dim"))
        model = DensityTopicsModel({"topic_info": m.info, "docs_topic_info": MD.document_info(m), "weights": m.weights})
        return self._copyValues(model)


class DensityTopicsModel(Model, _TopicParams, MLWritable, MLReadable):
    """The fitted tables by name (``TABLES``) and the assignment of new texts."""

    def __init__(self, tables: dict[str, DataFrame] | None = None, **given):
        super().__init__()
        self.tables = tables or {}
        self._defaults(given)

    def _transform(self, dataset: DataFrame) -> DataFrame:
        text, topic, similarity, floor = (self.getOrDefault(p) for p in
                                          ("textCol", "topicCol", "similarityCol", "minSimilarity"))
        if taken := {topic, similarity, "_sha"} & set(dataset.columns):
            raise ValueError(f"the input already has {sorted(taken)}")
        rows = dataset.withColumn("_sha", F.sha2(F.col(text), 256))
        once = rows.where(F.col(text).isNotNull()).groupBy("_sha").agg(F.any_value(text).alias("_text"))
        near = nearest_topics(once, self.tables["weights"], "_sha", "_text").where(F.col("similarity") >= floor)
        near = near.select("_sha", F.col("topic").alias("_t"), F.col("similarity").alias("_s"))
        return (rows.join(near, "_sha", "left")
                .select(*dataset.columns, F.coalesce("_t", F.lit(TP.OUTLIER)).cast("int").alias(topic),
                        F.coalesce("_s", F.lit(0.0)).alias(similarity)))

    def write(self) -> MLWriter:
        return _Writer(self)

    @classmethod
    def read(cls) -> MLReader:
        return _Reader()


class _Writer(MLWriter):
    def __init__(self, model: DensityTopicsModel):
        super().__init__()
        self.model = model

    def saveImpl(self, path: str) -> None:
        for name in TABLES:
            self.model.tables[name].write.mode("errorifexists").parquet(f"{path}/{name}")
        DefaultParamsWriter.saveMetadata(self.model, path, self.sparkSession)


class _Reader(MLReader):
    def load(self, path: str) -> DensityTopicsModel:
        metadata = DefaultParamsReader.loadMetadata(path, self.sparkSession)
        model = DensityTopicsModel({name: self.sparkSession.read.parquet(f"{path}/{name}") for name in TABLES})
        model._resetUid(metadata["uid"])
        DefaultParamsReader.getAndSetParams(model, metadata)
        return model
