"""Stage 4 queries: prompts, annotation, answer parsing, unions, image
paths and payload encodings."""

from __future__ import annotations

from pyspark.sql import functions as F

from canopy.functions.text import WHITESPACE
from canopy.operators import annotate as A
from canopy.operators import topics as TP
from canopy.plans import sql as S
from canopy.plans.registry import register
from canopy.plans.topic_plans import TOPIC_WITH, _info
from canopy.session import scratch_path
from canopy.sources import tables as TB

# Output folder of the per-topic images and the answer variants.
IMG_DIR = "extracted_images/dedupe_mm_20_nov"


def annotation_topics(spark, sf, info=None):
    """(modality, topic_no, representation, representative_docs, image_path), of an already fitted ``info`` if given."""
    if info is None:
        *_, info = _info(spark, sf)
    text = info.select(F.lit("text").alias("modality"), F.col("topic").alias("topic_no"),
                       "representation", "representative_docs", F.lit(None).cast("string").alias("image_path"))
    tpaths = A.image_paths(info.select("topic"), IMG_DIR)
    mm = (info.join(tpaths, "topic").select(F.lit("multimodal").alias("modality"), F.col("topic").alias("topic_no"),
                                            "representation", "representative_docs", "image_path"))
    labels = TB.table(spark, sf, "embeddings").select(F.col("label").cast("int").alias("topic"))
    ipaths = A.image_paths(labels, IMG_DIR)
    image = ipaths.select(F.lit("image").alias("modality"), F.col("topic").alias("topic_no"),
                          F.lit(None).cast("array<string>").alias("representation"),
                          F.lit(None).cast("array<string>").alias("representative_docs"), "image_path")
    return text.unionByName(image).unionByName(mm)


def _pylist(x: str) -> str:
    return f"CASE WHEN {x} IS NULL THEN 'None' ELSE '[''' || array_to_string({x}, ''', ''') || ''']' END"


_PROMPT_ROWS = " UNION ALL ".join(
    f"SELECT {S.q(m)} AS modality, {S.q(i)} AS intro, {S.q(t)} AS instructions" for m, i, t in A.PROMPTS)
_REP = (f"'{A.TERMS}' || {_pylist('representation')} || chr(10) || '{A.POSTS}' || "
        f"{_pylist('docs')} || chr(10)")
_PROMPT = f"""CASE modality
  WHEN 'text' THEN intro || {S.q(' ' + A.TASK['text'])} || chr(10) || {_REP} || instructions
  WHEN 'image' THEN intro || chr(10) || {S.q(A.TASK['image'])} || chr(10) || instructions
  ELSE intro || chr(10) || {S.q(A.TASK['multimodal'])} || chr(10) || {_REP} || instructions END"""

ANNOT_WITH = TOPIC_WITH + f""",
info AS (SELECT s.topic, r.representation, d.docs FROM (SELECT DISTINCT topic FROM assign) s
         LEFT JOIN rep r USING (topic)
         LEFT JOIN (SELECT rd.topic, list(dc.text ORDER BY rd.rank) AS docs FROM rdocs rd JOIN docs dc USING (doc_key)
                    GROUP BY rd.topic) d USING (topic)),
tpaths AS (SELECT topic, '{IMG_DIR}/image_' || CAST(row_number() OVER (ORDER BY topic) - 1 AS VARCHAR) || '.jpeg'
           AS image_path FROM info),
ipaths AS (SELECT topic, '{IMG_DIR}/image_' || CAST(row_number() OVER (ORDER BY topic) - 1 AS VARCHAR) || '.jpeg'
           AS image_path FROM (SELECT DISTINCT label AS topic FROM embeddings)),
atopics AS (SELECT 'text' AS modality, topic AS topic_no, representation, docs, NULL AS image_path FROM info
            UNION ALL SELECT 'image', topic, NULL, NULL, image_path FROM ipaths
            UNION ALL SELECT 'multimodal', i.topic, i.representation, i.docs, p.image_path
                      FROM info i JOIN tpaths p USING (topic)),
prompts AS ({_PROMPT_ROWS}),
tprompts AS (SELECT t.modality, t.topic_no, {_PROMPT} AS prompt,
                    CASE WHEN t.modality <> 'text' THEN t.image_path END AS image_path,
                    t.representation FROM atopics t JOIN prompts p USING (modality)),
annotations AS (SELECT modality, topic_no,
                       coalesce(nullif(array_to_string(representation[1:3], ' '), ''), 'unnamed topic') AS topic_name,
                       'content_unclear' AS topic_type,
                       CASE WHEN modality IN ('image', 'multimodal') THEN 'other' END AS image_type
                FROM tprompts)
"""

# llm_responses: five answer shapes, chosen by topic number and modality.
_RESP = """responses AS (
  SELECT modality, topic_no, CASE (topic_no + length(modality) + 5) % 5
    WHEN 0 THEN '```json' || chr(10) || '{"topic_name": "topic ' || CAST(topic_no AS VARCHAR) || '", "topic_type": "content"}' || chr(10) || '```'
    WHEN 1 THEN '{"topic_name": "topic ' || CAST(topic_no AS VARCHAR) || '", "image_type": "meme"}'
    WHEN 2 THEN '  {"Name": "topic ' || CAST(topic_no AS VARCHAR) || '", "type": "ad", "confidence": "high"} ' || chr(10)
    WHEN 3 THEN 'I cannot annotate this topic.'
    ELSE NULL END AS response
  FROM atopics)"""


def responses(topics):
    """``llm_responses`` fixture: fenced JSON, bare JSON, JSON with alias and
    extra keys, garbage, NULL."""
    n = F.col("topic_no").cast("string")
    v = (F.col("topic_no") + F.length("modality") + 5) % 5
    r = (F.when(v == 0, F.concat(F.lit('```json\n{"topic_name": "topic '), n, F.lit('", "topic_type": "content"}\n```')))
         .when(v == 1, F.concat(F.lit('{"topic_name": "topic '), n, F.lit('", "image_type": "meme"}')))
         .when(v == 2, F.concat(F.lit('  {"Name": "topic '), n, F.lit('", "type": "ad", "confidence": "high"} \n')))
         .when(v == 3, F.lit("I cannot annotate this topic.")))
    return topics.select("modality", "topic_no", r.alias("response"))


_STRIP = (f"trim(replace(replace(response, '```json', ''), '```', ''), "
          f"{' || '.join('chr(%d)' % ord(c) for c in WHITESPACE)})")
_PARSED = f"""parsed AS (SELECT modality, topic_no, s,
  CASE WHEN json_valid(s) THEN json_type(s) = 'OBJECT' ELSE false END AS ok FROM (
  SELECT modality, topic_no, {_STRIP} AS s FROM responses))"""


@register("topic_prompts", ANNOT_WITH + "SELECT modality, topic_no, prompt, image_path FROM tprompts", "F14 N6")
def q_topic_prompts(spark, sf):
    p = A.build_prompts(annotation_topics(spark, sf), A.prompts_table(spark))
    return p.select("modality", "topic_no", "prompt", "image_path")


@register("annotate_topics", ANNOT_WITH + "SELECT modality, topic_no, topic_name, topic_type, image_type FROM annotations",
          "TM17 V6 S12")
def q_annotate_topics(spark, sf):
    ok, _ = A.annotate(annotation_topics(spark, sf))
    return ok.select("modality", "topic_no", *A.FIXED_KEYS)


@register("annotation_sink", ANNOT_WITH + """
SELECT modality, topic_no, topic_name, topic_type, image_type FROM annotations""", "S12")
def q_annotation_sink(spark, sf):
    ok, _ = A.annotate(annotation_topics(spark, sf))
    path = scratch_path(spark, "annotations")
    A.write_annotations(ok.select("modality", "topic_no", *A.FIXED_KEYS), path)
    return spark.read.parquet(path).select("modality", "topic_no", *A.FIXED_KEYS)


@register("union_annotations", ANNOT_WITH + """
SELECT 'text' AS modality, topic_no, topic_name, topic_type, NULL AS image_type FROM annotations WHERE modality = 'text'
UNION ALL SELECT 'image', topic_no, topic_name, topic_type, image_type FROM annotations WHERE modality = 'image'
UNION ALL SELECT modality, topic_no, topic_name, topic_type, image_type FROM annotations WHERE modality = 'multimodal'""",
          "U1")
def q_union_annotations(spark, sf):
    ok, _ = A.annotate(annotation_topics(spark, sf))
    per = {
        "text": ok.where(F.col("modality") == "text").select("modality", "topic_no", "topic_name", "topic_type"),
        "image": ok.where(F.col("modality") == "image").select("modality", "topic_no", *A.FIXED_KEYS),
        "multimodal": ok.where(F.col("modality") == "multimodal").select("modality", "topic_no", *A.FIXED_KEYS),
    }
    out = per["text"]
    for m in ("image", "multimodal"):
        out = out.unionByName(per[m], allowMissingColumns=True)
    return out


@register("parse_annotation", ANNOT_WITH + ", " + _RESP + ", " + _PARSED + """
SELECT modality, topic_no, ok, CAST(len(json_keys(CASE WHEN ok THEN s END)) AS BIGINT) AS n_keys FROM parsed""",
          "F13 N1")
def q_parse_annotation(spark, sf):
    p = A.parse(responses(annotation_topics(spark, sf)))
    return p.select("modality", "topic_no", F.col("raw").isNotNull().alias("ok"),
                    F.size("raw").cast("bigint").alias("n_keys")).withColumn(
        "n_keys", F.when(F.col("ok"), F.col("n_keys")))


@register("annotation_columns", ANNOT_WITH + ", " + _RESP + ", " + _PARSED + """
SELECT modality, topic_no,
       coalesce(json_extract_string(js, '$.topic_name'), json_extract_string(js, '$.Name')) AS topic_name,
       coalesce(json_extract_string(js, '$.topic_type'), json_extract_string(js, '$.type')) AS topic_type,
       json_extract_string(js, '$.image_type') AS image_type
FROM (SELECT *, CASE WHEN ok THEN s END AS js FROM parsed) WHERE ok""", "N2")
def q_annotation_columns(spark, sf):
    p = A.parse(responses(annotation_topics(spark, sf))).where(F.col("raw").isNotNull())
    return A.annotation_columns(p).select("modality", "topic_no", *A.FIXED_KEYS)


@register("annotation_summary", ANNOT_WITH + """,
sizes AS (SELECT 'text' AS modality, topic AS topic_no, count(*) AS n FROM assign GROUP BY topic
          UNION ALL SELECT 'multimodal', topic, count(*) FROM assign GROUP BY topic
          UNION ALL SELECT 'image', label, count(*) FROM embeddings GROUP BY label)
SELECT a.modality, coalesce(a.topic_type, a.image_type) AS label, count(*) AS n_topics, CAST(sum(s.n) AS BIGINT) AS n_docs
FROM annotations a JOIN sizes s USING (modality, topic_no)
GROUP BY a.modality, coalesce(a.topic_type, a.image_type)""", "A11")
def q_annotation_summary(spark, sf):
    _, assign, _, _, info = _info(spark, sf)
    ok, _ = A.annotate(annotation_topics(spark, sf, info))
    t = TP.topic_sizes(assign).select(F.col("topic").alias("topic_no"), F.col("count").alias("n"))
    sizes = (t.select(F.lit("text").alias("modality"), "topic_no", "n")
             .unionByName(t.select(F.lit("multimodal").alias("modality"), "topic_no", "n"))
             .unionByName(TB.table(spark, sf, "embeddings").groupBy(F.col("label").cast("int").alias("topic_no"))
                          .agg(F.count(F.lit(1)).alias("n")).select(F.lit("image").alias("modality"), "topic_no", "n")))
    j = ok.join(sizes, ["modality", "topic_no"])
    return j.groupBy("modality", F.coalesce("topic_type", "image_type").alias("label")).agg(
        F.count(F.lit(1)).alias("n_topics"), F.sum("n").alias("n_docs"))


@register("topic_image_paths", ANNOT_WITH + "SELECT topic, image_path FROM tpaths", "P21 S11")
def q_topic_image_paths(spark, sf):
    *_, info = _info(spark, sf)
    return A.image_paths(info.select("topic"), IMG_DIR)


@register("topic_with_image", ANNOT_WITH + """
SELECT s.topic, s.count, r.name, p.image_path FROM (SELECT topic, count(*) AS count FROM assign GROUP BY topic) s
JOIN rep r USING (topic) JOIN tpaths p USING (topic)""", "J1 P6")
def q_topic_with_image(spark, sf):
    *_, info = _info(spark, sf)
    paths = A.image_paths(info.select("topic"), IMG_DIR)
    return info.drop("representative_docs", "representative_keys").join(paths, "topic").select(
        "topic", "count", "name", "image_path")


@register("join_completeness", ANNOT_WITH + """
SELECT (SELECT count(*) FROM info) AS n_topics, (SELECT count(*) FROM info JOIN tpaths USING (topic)) AS n_joined,
       (SELECT count(*) FROM info WHERE topic NOT IN (SELECT topic FROM tpaths)) AS n_missing""", "J2")
def q_join_completeness(spark, sf):
    *_, info = _info(spark, sf)
    paths = A.image_paths(info.select("topic"), IMG_DIR)
    n = info.select(F.count(F.lit(1)).alias("n_topics"))
    joined = info.join(paths, "topic").select(F.count(F.lit(1)).alias("n_joined"))
    missing = info.join(paths, "topic", "left_anti").select(F.count(F.lit(1)).alias("n_missing"))
    return n.select("n_topics", joined.scalar().alias("n_joined"), missing.scalar().alias("n_missing"))


@register("image_tag", """SELECT doc_id, '<img src="data:image/jpeg;base64,' || to_base64(encode(text)) || '">' AS tag
FROM documents""", "F15 N7")
def q_image_tag(spark, sf):
    d = TB.table(spark, sf, "documents")
    return d.select("doc_id", A.image_tag(F.encode("text", "UTF-8")).alias("tag"))


@register("base64_roundtrip", """SELECT doc_id, from_base64(to_base64(encode(text))) = encode(text) AS ok,
       CAST(octet_length(encode(text)) AS BIGINT) AS n_bytes, CAST(length(to_base64(encode(text))) AS BIGINT) AS n_b64
FROM documents""", "N7 N8")
def q_base64_roundtrip(spark, sf):
    d = TB.table(spark, sf, "documents").select("doc_id", F.encode("text", "UTF-8").alias("b"))
    t = A.b64("b")
    return d.select("doc_id", (F.unbase64(t) == F.col("b")).alias("ok"), F.octet_length("b").cast("bigint").alias("n_bytes"),
                    F.length(t).cast("bigint").alias("n_b64"))


# ---------------------------------------------------------------- answers of any shape
from canopy.operators import answers as AN  # noqa: E402

# Fixture: answers per topic, by (topic number + length of the modality + 9) % 9; @ is the topic number.
_SHAPES = (
    '```json\n{"conf": {"high": 0.5, "low": 0.25}, "topic_name": "topic @"}\n```',
    '{"image_type": null, "topic_name": "t\\u00e4 \\"@\\"", "topic_type": ["ad", "content"]}',
    '{"topic_name": @, "topic_type": true}',
    '{"topic_name": "a", "topic_name": "b"}',
    '{"topic_name": "cut off',
    '["topic @"]',
    "{}",
    "   ",
)


def _any_answers(topics):
    v = (F.col("topic_no") + F.length("modality") + 9) % 9
    text = F.lit(None).cast("string")
    for i, shape in enumerate(_SHAPES):
        text = F.when(v == i, F.replace(F.lit(shape), F.lit("@"), F.col("topic_no").cast("string"))).otherwise(text)
    return topics.select("modality", "topic_no", text.alias("response"))


_ANY = "any_answers AS (SELECT modality, topic_no, CASE (topic_no + length(modality) + 9) % 9 " + " ".join(
    f"WHEN {i} THEN replace({S.q(shape)}, '@', CAST(topic_no AS VARCHAR))" for i, shape in enumerate(_SHAPES)) + """
  END AS response FROM atopics)"""
_ANY_PARSED = f"""any_parsed AS (SELECT modality, topic_no, s, CASE WHEN coalesce(s, '') = '' THEN 'no answer'
    WHEN NOT json_valid(s) THEN 'no JSON' WHEN json_type(s) <> 'OBJECT' THEN 'no object'
    WHEN len(json_keys(s)) <> len(list_distinct(json_keys(s))) THEN 'no JSON' END AS problem
  FROM (SELECT modality, topic_no, {_STRIP} AS s FROM any_answers))"""


@register("answer_problems", ANNOT_WITH + f", {_ANY}, {_ANY_PARSED} SELECT modality, topic_no, problem FROM any_parsed",
          "F13 N1")
def q_answer_problems(spark, sf):
    return AN.parse(_any_answers(annotation_topics(spark, sf))).select("modality", "topic_no", "problem")


@register("answer_fields", ANNOT_WITH + f""", {_ANY}, {_ANY_PARSED}
SELECT modality, topic_no, key, CASE json_type(s, p) WHEN 'VARCHAR' THEN 'string' WHEN 'OBJECT' THEN 'object'
         WHEN 'ARRAY' THEN 'array' WHEN 'BOOLEAN' THEN 'boolean' WHEN 'NULL' THEN 'null' ELSE 'number' END AS kind,
       coalesce(json_extract_string(s, p), 'null') AS value
FROM (SELECT *, '$.' || key AS p FROM (SELECT modality, topic_no, s, unnest(json_keys(s)) AS key FROM any_parsed
      WHERE problem IS NULL))""", "N1 N2")
def q_answer_fields(spark, sf):
    out = AN.fields(AN.parse(_any_answers(annotation_topics(spark, sf))))
    return out.select("modality", "topic_no", "key", "kind", "value")
