"""Topic annotation: prompts, a pluggable model callable, answer parsing.

The model is any ``callable(prompt: str, image: str | None) -> str``.  It
runs inside ``mapInPandas`` over the (few) topic rows; the number of
partitions bounds the number of concurrent calls.  Answers are parsed on
the JVM side (fence strip + ``from_json`` to ``MAP<STRING,STRING>``); an
unparsable or missing answer adds no row, as in the reference, and is
kept in a separate error table by :func:`annotate`.
"""

from __future__ import annotations

import json
from collections.abc import Callable, Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from canopy.functions.text import strip_fence
from canopy.operators.util import materialize

Annotator = Callable[[str, "str | None"], "str | None"]

# The labels an answer may use.
TOPIC_TYPES = ("content", "content_unclear", "ad", "caption")
IMAGE_TOPIC_TYPES = ("content", "content_unclear", "ad")
IMAGE_TYPES = ("screenshot_news", "screenshot_social_media", "photo", "infographic", "map", "meme", "other")

# The prompt dimension, one row per modality.
INTRO = "Below is one cluster of posts that a topic model found in German messaging channels."
MEANING = {
    "content": "one clear subject", "content_unclear": "several subjects or none that stands out",
    "ad": "something is offered for sale", "caption": "the posts comment on other media",
    "screenshot_news": "a captured news page", "screenshot_social_media": "a captured social media post",
    "photo": "a photograph", "infographic": "a chart or diagram", "map": "a map", "meme": "a meme",
    "other": "none of these",
}


def _choice(what: str, labels: tuple[str, ...]) -> str:
    return f"{what}: pick one of " + "; ".join(f"{x} ({MEANING[x]})" for x in labels) + "."


def _ask(*fields: str) -> str:
    return "topic_name: at most five English words. " + " ".join(fields) + " Reply with one JSON object and these keys."


PROMPTS = (
    ("text", INTRO, _ask(_choice("topic_type", TOPIC_TYPES))),
    ("image", INTRO, _ask(_choice("topic_type", IMAGE_TOPIC_TYPES), _choice("image_type", IMAGE_TYPES))),
    ("multimodal", INTRO, _ask(_choice("topic_type", TOPIC_TYPES), _choice("image_type", IMAGE_TYPES))),
)
TASK = {
    "text": "Name and classify it from its key terms and a few of its posts.",
    "image": "Name and classify it from the attached collage of its pictures.",
    "multimodal": "Name and classify it from its key terms, a few of its posts and the attached collage.",
}
TERMS, POSTS = "Key terms: ", "Posts: "
KEY_ALIASES = {"name": "topic_name", "type": "topic_type", "topic": "topic_name"}
FIXED_KEYS = ("topic_name", "topic_type", "image_type")


def prompts_table(spark: SparkSession) -> DataFrame:
    """Prompt dimension (modality, intro, instructions); 3 rows."""
    return spark.createDataFrame(list(PROMPTS), "modality string, intro string, instructions string")


def py_list(col) -> Column:
    """Render an array of strings the way Python prints a list of str."""
    c = F.col(col) if isinstance(col, str) else col
    return F.when(c.isNull(), F.lit("None")).otherwise(
        F.concat(F.lit("['"), F.array_join(c, "', '"), F.lit("']")))


def build_prompts(topics: DataFrame, prompts: DataFrame) -> DataFrame:
    """one prompt per (modality, topic_no).

    ``topics`` has modality, topic_no, representation, representative_docs,
    image_path.  The prompt dimension is broadcast (fixed 3 rows).
    """
    j = topics.join(F.broadcast(prompts), "modality")
    rep = F.concat(F.lit(TERMS), py_list("representation"), F.lit("\n"),
                   F.lit(POSTS), py_list("representative_docs"), F.lit("\n"))
    text = F.concat(F.col("intro"), F.lit(" " + TASK["text"] + "\n"), rep, F.col("instructions"))
    image = F.concat(F.col("intro"), F.lit("\n" + TASK["image"] + "\n"), F.col("instructions"))
    mm = F.concat(F.col("intro"), F.lit("\n" + TASK["multimodal"] + "\n"), rep, F.col("instructions"))
    prompt = (F.when(F.col("modality") == "text", text).when(F.col("modality") == "image", image)
              .otherwise(mm))
    return j.select("modality", "topic_no", prompt.alias("prompt"),
                    F.when(F.col("modality") != "text", F.col("image_path")).alias("image_path"))


def offline_annotator(prompt: str, image: str | None) -> str:
    """Deterministic stand-in for a remote model: names the topic after the
    first three terms of its representation and answers in a fenced block."""
    words: list[str] = []
    marker = TERMS + "['"
    if marker in prompt:
        inner = prompt.split(marker, 1)[1].split("']", 1)[0]
        words = inner.split("', '")[:3]
    name = " ".join(words) if words else "unnamed topic"
    answer: dict[str, str] = {"topic_name": name}
    if "topic_type" in prompt:
        answer["topic_type"] = "content_unclear"
    if "image_type" in prompt:
        answer["image_type"] = "other"
    return "```json\n" + json.dumps(answer) + "\n```"


def call_model(prompts: DataFrame, model: Annotator = offline_annotator, parallelism: int = 4) -> DataFrame:
    """V6: run the model once per prompt row in Python workers (Arrow batches)."""
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            out = []
            for p, img in zip(pdf["prompt"], pdf["image_path"]):
                try:
                    out.append((model(p, None if pd.isna(img) else img), None))
                except Exception as e:  # noqa: BLE001 - a failed call adds no annotation; its text is kept
                    out.append((None, f"{type(e).__name__}: {e}"))
            yield pdf[["modality", "topic_no"]].assign(response=[r for r, _ in out], error=[e for _, e in out])

    schema = "modality string, topic_no int, response string, error string"
    return prompts.repartition(parallelism).mapInPandas(run, schema)


def parse(responses: DataFrame) -> DataFrame:
    """F13 + N1: strip fences, parse to a map; NULL when not a JSON object."""
    raw = F.from_json(strip_fence("response"), "map<string,string>")
    return responses.withColumn("raw", raw)


def canonical_keys(raw: str = "raw") -> Column:
    """Apply the key-alias map so answers land in the fixed columns."""
    c = F.col(raw)
    return F.transform_keys(c, lambda k, v: F.coalesce(
        F.element_at(F.create_map(*[x for kv in KEY_ALIASES.items() for x in map(F.lit, kv)]), F.lower(k)),
        F.lower(k)))


def annotation_columns(parsed: DataFrame) -> DataFrame:
    """The fixed columns pulled out of the answer map."""
    m = canonical_keys("raw")
    return parsed.select("modality", "topic_no", *[F.element_at(m, k).alias(k) for k in FIXED_KEYS], "raw")


def annotate(topics: DataFrame, model: Annotator = offline_annotator) -> tuple[DataFrame, DataFrame]:
    """TM17: (annotations, errors).  The model is called once per topic: its
    answers are written first, and both tables read them.  Failed calls and
    answers that cannot be parsed go to ``errors`` with the reason."""
    spark = topics.sparkSession
    prompts = build_prompts(topics, prompts_table(spark))
    parsed = parse(materialize(call_model(prompts, model), "answers"))
    ok = annotation_columns(parsed.where(F.col("raw").isNotNull()))
    errors = parsed.where(F.col("raw").isNull()).select(
        "modality", "topic_no", "response", F.coalesce("error", F.lit("no JSON object")).alias("error"))
    return ok, errors


def write_annotations(annotations: DataFrame, path: str) -> None:
    """One annotation table, partitioned by modality; fails if it exists."""
    annotations.write.mode("errorifexists").partitionBy("modality").parquet(path)


def image_tag(binary_col) -> Column:
    """HTML ``<img>`` tag with a Base64 JPEG payload (unchunked)."""
    b64 = F.replace(F.base64(binary_col), F.lit("\r\n"), F.lit(""))
    return F.concat(F.lit('<img src="data:image/jpeg;base64,'), b64, F.lit('">'))


def b64(binary_col) -> Column:
    """Unchunked Base64 text."""
    return F.replace(F.base64(binary_col), F.lit("\r\n"), F.lit(""))


def image_paths(topics: DataFrame, out_dir: str) -> DataFrame:
    """``image_{index}.jpeg`` where index is the row position in
    topic order (so the outlier topic -1 is image_0).  Numbered on the
    per-topic table."""
    from canopy.operators.records import global_index
    ix = global_index(topics.select("topic").distinct(), ["topic"], "_ix")
    return ix.select("topic", F.format_string(out_dir.rstrip("/") + "/image_%d.jpeg", F.col("_ix")).alias("image_path"))
