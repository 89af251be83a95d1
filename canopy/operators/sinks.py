"""Writers that land tables in the shared folder and read them back.

Every sink writes with ``errorifexists`` into a fresh sub-folder of the
session's checkpoint root (never a machine-local path on a cluster).
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from canopy.operators.util import materialize
from canopy.session import scratch_path

# Declared output types of the corpus tables (strings but the timestamp).
CORPUS_TYPES = {
    "channel_name": "string", "message_id": "string", "custom_id": "string", "text": "string",
    "cleaned_text": "string", "msg_type": "string", "media_id": "string", "dhash": "string",
    "lang": "string", "msg_date_dt": "timestamp_ntz",
}

CSV_OPTIONS = {"header": "true", "multiLine": "true", "escape": '"', "quote": '"'}
#: With a mark of its own for null, a quoted empty field stays an empty text.
EXACT_CSV = {**CSV_OPTIONS, "nullValue": "\\N"}


def write_by_channel(df: DataFrame, fmt: str = "parquet") -> DataFrame:
    """One folder per (category, channel) instead of a loop per channel."""
    path = scratch_path(df.sparkSession, "by_channel")
    df.write.mode("errorifexists").partitionBy("category", "channel_name").format(fmt).save(path)
    return df.sparkSession.read.format(fmt).load(path)


def land_csv_and_reload(df: DataFrame) -> DataFrame:
    """Land raw CSV files per channel, then load the whole folder
    as one table with a declared schema and a parsed ``msg_date_dt``."""
    spark = df.sparkSession
    path = scratch_path(spark, "raw_csv")
    df.write.mode("errorifexists").partitionBy("channel_name").options(**CSV_OPTIONS).csv(path)
    schema = T.StructType([T.StructField(c.name, c.dataType) for c in df.schema if c.name != "channel_name"])
    raw = spark.read.schema(schema).options(**CSV_OPTIONS).csv(path)
    return raw.withColumn("msg_date_dt", F.to_timestamp_ntz("msg_date"))


def write_exact_csv(df: DataFrame) -> str:
    """A CSV folder that keeps blanks at field ends, line feeds, quotes, and nulls
    apart from empty texts.  (The parser turns ``\\r\\n`` inside a field into ``\\n``; a
    text that is the null mark alone reads as null.)"""
    path = scratch_path(df.sparkSession, "exact_csv")
    df.write.mode("errorifexists").options(**EXACT_CSV, ignoreLeadingWhiteSpace="false",
                                           ignoreTrailingWhiteSpace="false").csv(path)
    return path


def read_quarantined(spark: SparkSession, paths: str | list[str], schema: str) -> tuple[DataFrame, DataFrame]:
    """(good, broken) rows of CSV files under a declared schema.

    A row with a value of the wrong type, or with too few or too many fields, is
    broken: it keeps what could be read, with ``raw`` (the record as it stood)
    and ``file``.  The files are read once; nothing is dropped.
    """
    declared = T.StructType.fromDDL(schema).add("raw", "string")
    rows = spark.read.schema(declared).options(**EXACT_CSV, mode="PERMISSIVE", columnNameOfCorruptRecord="raw",
                                               enforceSchema="true").csv(paths)
    stored = materialize(rows.withColumn("file", F.col("_metadata.file_name")), "csv_rows")
    return stored.where(F.col("raw").isNull()).drop("raw", "file"), stored.where(F.col("raw").isNotNull())


def write_typed(df: DataFrame, types: dict[str, str] = CORPUS_TYPES) -> DataFrame:
    """Declared column types, fail if the target exists, no index."""
    cols = [F.col(c).cast(types[c]).alias(c) if c in types else F.col(c) for c in df.columns]
    path = scratch_path(df.sparkSession, "typed")
    df.select(*cols).write.mode("errorifexists").parquet(path)
    return df.sparkSession.read.parquet(path)


def roundtrip_model(parts: dict[str, DataFrame]) -> dict[str, DataFrame]:
    """A topic model is a set of Parquet tables (topics, c-TF-IDF,
    centroids...) written under one folder and read back by name."""
    spark = next(iter(parts.values())).sparkSession
    root = scratch_path(spark, "topic_model")
    for name, df in parts.items():
        df.write.mode("errorifexists").parquet(f"{root}/{name}")
    return {name: spark.read.parquet(f"{root}/{name}") for name in parts}
