"""Model answers as VARIANT, so keys nobody planned for keep their type
and their nesting.

An answer counts if it is one JSON object (after the fence is stripped).  Its
fields become rows (:func:`fields`), and :func:`schema` infers per modality
what the answers hold, in one aggregate.  All of it is built-in JVM functions.

Defined results: a missing answer, text that is no JSON, an object that names
a key twice and JSON that is no object have ``answer`` null and a ``problem``;
a key with JSON null is a field of kind ``null``; an empty object has no
fields; repeated rows stay.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from canopy.functions.text import strip_fence

NO_ANSWER, NO_JSON, NO_OBJECT = "no answer", "no JSON", "no object"


def kind(value) -> Column:
    """Kind of a VARIANT: object, array, string, boolean, number or null."""
    name = F.regexp_extract(F.schema_of_variant(value), "^[A-Z]+", 0)
    return (F.when(name.isin("OBJECT", "ARRAY", "STRING", "BOOLEAN"), F.lower(name))
            .when(name == "VOID", "null").otherwise("number"))


def parse(responses: DataFrame, response: str = "response") -> DataFrame:
    """Adds ``answer`` (VARIANT object or null) and ``problem`` (null where there is an answer)."""
    text = strip_fence(response)
    whole = F.try_parse_json(text)
    rows = responses.withColumn("_whole", F.when(text != "", whole))
    is_object = kind("_whole") == "object"
    problem = (F.when(F.col(response).isNull() | (text == ""), NO_ANSWER).when(F.col("_whole").isNull(), NO_JSON)
               .when(~is_object, NO_OBJECT))
    return rows.withColumn("answer", F.when(is_object, F.col("_whole"))).withColumn("problem", problem).drop("_whole")


def fields(parsed: DataFrame) -> DataFrame:
    """One row per key of an answer, beside the other columns: ``key``, ``kind`` and
    ``value`` (plain text of a string, JSON of anything else)."""
    spark = parsed.sparkSession
    rows = parsed.where(F.col("answer").isNotNull())
    each = rows.lateralJoin(spark.tvf.variant_explode(F.col("answer").outer()))
    keep = [c for c in parsed.columns if c not in ("answer", "problem")]
    text = F.coalesce(F.when(kind("value") == "string", F.try_variant_get("value", "$", "string")), F.to_json("value"))
    return each.select(*keep, "key", kind("value").alias("kind"), text.alias("value"))


def schema(parsed: DataFrame, by: str = "modality") -> DataFrame:
    """(by, answers, schema): the type that all answers of a group fit."""
    return parsed.groupBy(by).agg(F.count("answer").alias("answers"), F.schema_of_variant_agg("answer").alias("schema"))
