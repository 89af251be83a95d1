"""Perceptual image hashes (M1-M3), image scan (S7) and hash split.

- ``dhash_from_pixels``: the dHash bit step as native array expressions
  over a 9x8 grey pixel array (no Python).
- ``hash_images``: Arrow ``pandas_udf`` over Spark's ``image`` source rows:
  grey conversion, area-average resize, dHash (9x8, right > left) and pHash
  (32x32, 2-D DCT-II, low 8x8 above median).  Bits are packed MSB first
  into 16 hex characters.  Resizing is area averaging, so hashes are
  internally consistent rather than bit-equal to other libraries.
- ``png_bytes``: a minimal grey PNG encoder (zlib) used to land test
  images derived from the vectors; decoding is done by Spark.
"""

from __future__ import annotations

import os
import struct
import zlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

HEX = "0123456789abcdef"
DHASH_W, DHASH_H = 9, 8
PHASH_SIZE, PHASH_LOW = 32, 8


def pixels_from_vector(vec) -> Column:
    """8 rows x 9 grey pixels from a vector: its values followed by its
    first 8, mapped from [-1, 1] to 0..255."""
    v = F.col(vec) if isinstance(vec, str) else vec
    vals = F.concat(v, F.slice(v, 1, DHASH_W * DHASH_H - 64))
    return F.transform(vals, lambda x: F.least(F.greatest(F.floor((x + 1.0) * 127.5), F.lit(0)), F.lit(255))
                       .cast("int"))


def dhash_from_pixels(pixels) -> Column:
    """M1 bit step: bit (r, c) = p[r][c+1] > p[r][c]; 64 bits -> 16 hex."""
    p = F.col(pixels) if isinstance(pixels, str) else pixels
    bits = F.transform(F.sequence(F.lit(0), F.lit(63)), lambda i: F.when(
        F.element_at(p, (F.floor(i / 8) * DHASH_W + i % 8 + 2).cast("int"))
        > F.element_at(p, (F.floor(i / 8) * DHASH_W + i % 8 + 1).cast("int")), 1).otherwise(0))
    nibbles = F.transform(F.sequence(F.lit(0), F.lit(15)), lambda j: (
        F.element_at(bits, j * 4 + 1) * 8 + F.element_at(bits, j * 4 + 2) * 4
        + F.element_at(bits, j * 4 + 3) * 2 + F.element_at(bits, j * 4 + 4)))
    return F.array_join(F.transform(nibbles, lambda n: F.substring(F.lit(HEX), n + 1, 1)), "")


# ------------------------------------------------------------------ numpy helpers (per task)
def _area_matrix(n_in: int, n_out: int) -> np.ndarray:
    """Row-normalised overlap weights of output cells with input cells."""
    w = np.zeros((n_out, n_in))
    scale = n_in / n_out
    for i in range(n_out):
        lo, hi = i * scale, (i + 1) * scale
        for j in range(int(np.floor(lo)), min(int(np.ceil(hi)), n_in)):
            w[i, j] = max(0.0, min(hi, j + 1) - max(lo, j))
    return w / w.sum(axis=1, keepdims=True)


def resize(grey: np.ndarray, width: int, height: int) -> np.ndarray:
    return _area_matrix(grey.shape[0], height) @ grey @ _area_matrix(grey.shape[1], width).T


def _dct_matrix(n: int) -> np.ndarray:
    k = np.arange(n)[:, None]
    x = np.arange(n)[None, :]
    return 2.0 * np.cos(np.pi * k * (2 * x + 1) / (2 * n))


def _hex(bits: np.ndarray) -> str:
    v = 0
    for b in bits.flatten():
        v = (v << 1) | int(b)
    return format(v, "016x")


def dhash_array(grey: np.ndarray) -> str:
    small = resize(grey, DHASH_W, DHASH_H)
    return _hex(small[:, 1:] > small[:, :-1])


def phash_array(grey: np.ndarray) -> str:
    small = resize(grey, PHASH_SIZE, PHASH_SIZE)
    d = _dct_matrix(PHASH_SIZE)
    coef = d @ small @ d.T
    low = coef[:PHASH_LOW, :PHASH_LOW]
    return _hex(low > np.median(low))


def to_grey(data: bytes, height: int, width: int, channels: int) -> np.ndarray:
    """Spark image rows are BGR(A) or grey bytes, row-major."""
    a = np.frombuffer(data, dtype=np.uint8).astype(np.float64)
    if channels == 1:
        return a.reshape(height, width)
    a = a.reshape(height, width, channels)
    b, g, r = a[..., 0], a[..., 1], a[..., 2]
    return r * 299 / 1000 + g * 587 / 1000 + b * 114 / 1000


HASH_TYPE = T.StructType([T.StructField("dhash", T.StringType()), T.StructField("phash", T.StringType())])


@F.pandas_udf(HASH_TYPE)
def image_hash_udf(height: pd.Series, width: pd.Series, channels: pd.Series, data: pd.Series) -> pd.DataFrame:
    """M1+M2 over one Arrow batch; an undecodable image gives NULLs."""
    dh, ph = [], []
    for h, w, c, d in zip(height, width, channels, data):
        if h is None or h <= 0 or w <= 0 or d is None or len(d) == 0:
            dh.append(None)
            ph.append(None)
            continue
        g = to_grey(bytes(d), int(h), int(w), int(c))
        dh.append(dhash_array(g))
        ph.append(phash_array(g))
    return pd.DataFrame({"dhash": dh, "phash": ph})


def scan_images(spark, path: str) -> DataFrame:
    """Image files -> rows; a corrupt file yields height -1, not an error."""
    return spark.read.format("image").option("dropInvalid", False).load(path)


def hash_images(images: DataFrame) -> DataFrame:
    """(file_path, dhash, phash) for every scanned image."""
    i = images.select(F.col("image.origin").alias("file_path"), F.col("image.height").alias("h"),
                      F.col("image.width").alias("w"), F.col("image.nChannels").alias("c"),
                      F.col("image.data").alias("d"))
    hashed = i.select("file_path", image_hash_udf("h", "w", "c", "d").alias("hs"))
    return hashed.select("file_path", "hs.*")


def attach_hashes(messages: DataFrame, hashes: DataFrame, path_col: str = "file_path") -> DataFrame:
    """M3: hashes only for image rows, joined back by path; other rows NULL."""
    return messages.join(hashes.withColumnRenamed("file_path", path_col), path_col, "left").withColumn(
        "dhash", F.when(F.col("msg_type") == "image", F.col("dhash"))).withColumn(
        "phash", F.when(F.col("msg_type") == "image", F.col("phash")))


# ------------------------------------------------------------------ PNG landing
def png_bytes(pixels: np.ndarray) -> bytes:
    """Grey 8-bit PNG (filter 0 on every row)."""
    h, w = pixels.shape
    raw = b"".join(b"\x00" + bytes(pixels[r].astype(np.uint8)) for r in range(h))

    def chunk(tag: bytes, body: bytes) -> bytes:
        return struct.pack(">I", len(body)) + tag + body + struct.pack(">I", zlib.crc32(tag + body) & 0xFFFFFFFF)

    ihdr = struct.pack(">IIBBBBB", w, h, 8, 0, 0, 0, 0)
    return b"\x89PNG\r\n\x1a\n" + chunk(b"IHDR", ihdr) + chunk(b"IDAT", zlib.compress(raw)) + chunk(b"IEND", b"")


def land_pngs(df: DataFrame, folder: str, key: str = "id", pixels: str = "pixels",
              width: int = DHASH_W, height: int = DHASH_H) -> None:
    """Write one PNG per row from executors (``mapInPandas``).  ``folder``
    must be a path every executor can write (a mounted shared folder)."""
    local = folder[len("file:"):] if folder.startswith("file:") else folder

    def write(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        os.makedirs(local, exist_ok=True)
        for pdf in batches:
            for k, p in zip(pdf[key], pdf[pixels]):
                arr = np.asarray(p, dtype=np.int64).reshape(height, width)
                with open(os.path.join(local, f"{k}.png"), "wb") as fh:
                    fh.write(png_bytes(arr))
            yield pd.DataFrame({"n": [len(pdf)]})

    df.select(key, pixels).mapInPandas(write, "n long").agg(F.sum("n")).collect()


@F.pandas_udf(T.BinaryType())
def png_udf(pixels: pd.Series) -> pd.Series:
    """PNG bytes of 8x9 grey pixel arrays (one Arrow batch at a time)."""
    return pd.Series([None if p is None else png_bytes(np.asarray(p, dtype=np.int64).reshape(DHASH_H, DHASH_W))
                      for p in pixels])


def write_topic_images(df: DataFrame, folder: str, index: str = "index", payload: str = "visual_aspect") -> DataFrame:
    """Decode each topic's Base64 picture and write it as
    ``image_{index}.png`` from the executors; returns (index, image_path).
    ``folder`` must be writable by every executor (a mounted shared path)."""
    local = folder[len("file:"):] if folder.startswith("file:") else folder

    def write(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        os.makedirs(local, exist_ok=True)
        for pdf in batches:
            paths = []
            for i, b in zip(pdf[index], pdf["_bytes"]):
                path = os.path.join(local, f"image_{int(i)}.png")
                with open(path, "wb") as fh:
                    fh.write(bytes(b))
                paths.append(path)
            yield pd.DataFrame({index: pdf[index].astype("int64"), "image_path": paths})

    dec = df.select(F.col(index).cast("long").alias(index), F.unbase64(payload).alias("_bytes"))
    return dec.mapInPandas(write, f"{index} long, image_path string")
