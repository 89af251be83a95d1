"""Sharding by extendible hashing.

Every row has a hash of its key; a shard is a prefix of the hash's bits, and a
shard splits on one more bit only while it is over the byte limit.  Sizes are
summed once for the cells of a fine prefix, rolled up to every shorter prefix,
and each cell takes the shortest prefix that fits.  Cells that are still too
large go to another round with more bits, on their own rows alone.

Rows of one key share all 60 key bits.  When they exceed the limit, the bits
of a second hash, of the row's place in the written table, go on splitting
them, so a key that holds a third of all rows still ends in shards that fit.

Defined cases: a null key hashes as the empty text; null and empty texts weigh
nothing; a single row above the limit is a shard of its own, marked
``oversized``; repeated rows each get a shard; an empty table gives an empty
result; other columns are ignored.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from canopy.llm.common import materialize, read_table
from canopy.operators.util import discard

SHARD_BYTES = 32 << 20
MIN_SHARDS = 64
KEY_BITS = 60
MORE_BITS = 8


def key_hash(text: Column) -> Column:
    """The first 60 bits of the MD5 of a text, as a long."""
    return F.conv(F.substring(F.md5(text), 1, 15), 16, 10).cast("long")


def _prefix(depth: str) -> tuple[Column, Column]:
    """The first ``depth`` of a row's 120 hash bits: of the key's 60 and of the row's 60."""
    return (F.expr(f"shiftright(h, cast(greatest(60 - {depth}, 0) as int))"),
            F.expr(f"if({depth} <= 60, 0L, shiftright(r, cast(120 - {depth} as int)))"))


def _round(rows: DataFrame, low: int, high: int, limit: int) -> DataFrame:
    """Cells of ``high`` bits with the least depth in low..high whose prefix fits (null: none does)."""
    a, b = _prefix(str(high))
    cells = materialize(rows.groupBy(a.alias("h"), b.alias("r")).agg(F.sum("n_bytes").alias("n_bytes"),
                                                                     F.count("*").alias("n_docs")), "cells")
    up = (F.expr(f"if(d <= 60, shiftright(h, cast(least({high}, 60) - d as int)), h)"),
          F.expr(f"if(d <= 60, 0L, shiftright(r, cast({high} - d as int)))"))
    spread = cells.select("h", "r", "n_bytes", "n_docs", F.explode(F.sequence(F.lit(low), F.lit(high))).alias("d")) \
        .select("*", up[0].alias("a"), up[1].alias("b"))
    sizes = spread.groupBy("d", "a", "b").agg(F.sum("n_bytes").alias("shard_bytes"),
                                              F.sum("n_docs").alias("shard_docs")) \
        .where((F.col("shard_bytes") <= limit) | (F.col("shard_docs") == 1))
    fit = spread.select("h", "r", "d", "a", "b").join(sizes, ["d", "a", "b"], "left") \
        .groupBy("h", "r").agg(F.min(F.when(F.col("shard_docs").isNotNull(),
                                            F.struct("d", "shard_bytes", "shard_docs"))).alias("fit"))
    return materialize(fit.select(F.col("h").alias("cell_h"), F.col("r").alias("cell_r"), "fit.*"), "directory")


def row_hash() -> Column:
    """The first 60 bits of the MD5 of a row's place in a written table."""
    return key_hash(F.concat_ws(":", "_metadata.file_name", "_metadata.row_index"))


def assign(df: DataFrame, key: str = "doc_id", text: str = "text", limit: int = SHARD_BYTES,
           min_shards: int = 1) -> DataFrame:
    """Per row: key, bytes, shard (its hash prefix in bits), depth, the shard's bytes and rows.

    A shard holds at most ``limit`` bytes and at most the ``min_shards``-th part
    of all bytes, so that a table of any size is dealt to that many readers.
    """
    slim = df.select(F.col(key).alias("doc_id"), F.coalesce(F.octet_length(F.col(text)), F.lit(0)).cast("long")
                     .alias("n_bytes"))
    rows = materialize(slim.withColumn("h", key_hash(F.coalesce(F.col("doc_id").cast("string"), F.lit("")))), "rows")
    rows = rows.select("*", row_hash().alias("r"))
    total = rows.agg(F.sum("n_bytes")).first()[0] or 0
    limit = max(1, min(limit, total // min_shards))
    low, high = 0, min(KEY_BITS, max(1, -(-total // limit)).bit_length() + 4)
    done = []
    while True:
        directory = _round(rows, low, high, limit)
        a, b = _prefix(str(high))
        placed = rows.withColumns({"cell_h": a, "cell_r": b}).join(directory, ["cell_h", "cell_r"])
        done.append(placed.where(F.col("d").isNotNull() if high < 2 * KEY_BITS else F.lit(True)))
        if high >= 2 * KEY_BITS or directory.where(F.col("d").isNull()).isEmpty():
            break
        rows = placed.where(F.col("d").isNull()).drop("cell_h", "cell_r", "d", "shard_bytes", "shard_docs")
        low, high = high + 1, min(2 * KEY_BITS, high + MORE_BITS)
    every = reduce(DataFrame.unionByName, done)
    bits = F.concat(F.lpad(F.bin("h"), KEY_BITS, "0"), F.lpad(F.bin("r"), KEY_BITS, "0"))
    return every.select("doc_id", "n_bytes", F.concat(F.lit("s"), F.substr(bits, F.lit(1), F.col("d"))).alias("shard"),
                        F.col("d").cast("long").alias("depth"), "shard_bytes", "shard_docs",
                        (F.col("shard_bytes") > limit).alias("oversized"))


def write_shards(df: DataFrame, assigned: DataFrame, path: str, key: str = "doc_id") -> None:
    """Write the rows of ``df`` as one folder per shard (``shard=...``).

    A key that was split over shards by its row bits has its rows dealt evenly
    over these shards by a hash of the row's place in a stored copy of ``df``,
    which a task that runs again finds unchanged.
    """
    columns, stored = df.columns, materialize(df, "unsharded")
    placed = stored.withColumn("__place", row_hash())
    shard_of = assigned.groupBy(F.col("doc_id").alias("__key")).agg(F.sort_array(F.collect_set("shard")).alias("__all"))
    dealt = placed.join(shard_of, F.col(key).eqNullSafe(F.col("__key")))
    at = F.pmod("__place", F.size("__all"))
    dealt.select(*columns, F.element_at("__all", at.cast("int") + 1).alias("shard")) \
        .repartition("shard").write.mode("errorifexists").partitionBy("shard").parquet(path)
    discard(stored)


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents in shards of at most 32 MiB and a 64th of the table's text."""
    return assign(read_table(spark, sf_dir, "documents"), min_shards=MIN_SHARDS)


ORACLE_SQL = f"""
WITH r AS (SELECT doc_id, CAST(coalesce(strlen(text), 0) AS BIGINT) AS n_bytes,
                  CAST('0x' || substr(md5(CAST(doc_id AS VARCHAR)), 1, 15) AS BIGINT) AS h FROM documents),
most AS (SELECT greatest(1, least({SHARD_BYTES}, CAST(sum(n_bytes) AS BIGINT) // {MIN_SHARDS})) AS most FROM r),
p AS (SELECT doc_id, n_bytes, d, substr(lpad(bin(h), 60, '0'), 1, d) AS bits
      FROM r, (SELECT unnest(range(0, 33)) AS d)),
s AS (SELECT d, bits, sum(n_bytes) AS shard_bytes, count(*) AS shard_docs FROM p GROUP BY d, bits),
f AS (SELECT p.doc_id, p.n_bytes, p.d, p.bits, s.shard_bytes, s.shard_docs,
             row_number() OVER (PARTITION BY p.doc_id ORDER BY p.d) AS k
      FROM p JOIN s ON p.d = s.d AND p.bits = s.bits
      WHERE s.shard_bytes <= (SELECT most FROM most) OR s.shard_docs = 1)
SELECT doc_id, n_bytes, 's' || bits AS shard, CAST(d AS BIGINT) AS depth, CAST(shard_bytes AS BIGINT) AS shard_bytes,
       CAST(shard_docs AS BIGINT) AS shard_docs, shard_bytes > (SELECT most FROM most) AS oversized
FROM f WHERE k = 1
"""
