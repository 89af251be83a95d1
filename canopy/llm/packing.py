"""Sequence packing: first-fit decreasing on a tournament tree of bin room.

Every document is tokenized once, where it lies; only piece lengths and check
sums are shuffled.  Pieces are dealt at random into groups of bounded size and
each group is packed on its own, so no task ever sees more than a group.

Defined cases: a null or empty text is the end token alone (one piece of
length 1); repeated rows and repeated ids are packed once per row; ties in
length are broken by id and start; a text of any length is cut every
``seq_len`` tokens; an empty table gives an empty result; other columns of the
input are ignored, so their names cannot clash.
"""

from __future__ import annotations

import base64
import re
import zlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from canopy.llm.common import arrow_rows, materialize, read_table

SEQ_LEN = 2048
END_ID = 1
TOKENIZER = "byte_bpe_50k"
GROUP_PIECES = 1 << 14
#: Chunks of more signs go through the tokenizer file itself.
LONG_CHUNK = 20_000

PIECES = pa.schema([("doc_id", pa.int64()), ("start", pa.int64()), ("length", pa.int64()),
                    ("ids_crc32", pa.int64()), ("doc_tokens", pa.int64())])
PACKED = ("doc_id long, start long, length long, ids_crc32 long, doc_tokens long, "
          "sequence_id long, offset long")


class ChunkEncoder:
    """Text -> token ids as little-endian uint32 bytes.

    A chunk starts at a space that precedes a character other than white
    space.  The byte-level pattern always starts a pre-token there, so the ids
    of a text are the ids of its chunks, one after the other; chunks that lie
    together are encoded together, up to ``LONG_CHUNK`` signs at a time.
    """

    _cut = re.compile(r"(?= \S)")

    def __init__(self, name: str = TOKENIZER):
        import public_tokenizers
        import tiktoken

        with open(public_tokenizers.path(f"{name}.tiktoken"), "rb") as f:
            ranks = {base64.b64decode(token): int(rank) for token, rank in map(bytes.split, f)}
        self._name, self._whole = name, None
        self._bpe = tiktoken.Encoding(name, pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks,
                                      special_tokens={})

    def _long(self, chunk: str) -> list[int]:
        """Ids of a chunk whose length the rank file's pattern may not stand."""
        if self._whole is None:
            import public_tokenizers
            import tokenizers

            self._whole = tokenizers.Tokenizer.from_file(str(public_tokenizers.path(f"{self._name}.json")))
        return self._whole.encode(chunk, add_special_tokens=False).ids

    def _parts(self, text: str) -> Iterator[str]:
        """The text cut between chunks; a part above ``LONG_CHUNK`` signs is one chunk."""
        if len(text) <= LONG_CHUNK:
            yield text
            return
        held, size = [], 0
        for chunk in self._cut.split(text):
            if held and size + len(chunk) > LONG_CHUNK:
                yield "".join(held)
                held, size = [], 0
            held.append(chunk)
            size += len(chunk)
        yield "".join(held)

    def encode(self, text: str) -> bytes:
        ids = (self._long(part) if len(part) > LONG_CHUNK else self._bpe.encode_ordinary(part) for part in self._parts(text))
        return b"".join(np.asarray(part, "<u4").tobytes() for part in ids)


def _cut_documents(seq_len: int, end_id: int, name: str):
    end = np.asarray([end_id], "<u4").tobytes()

    def make():
        encoder = ChunkEncoder(name)

        def work(batch: pa.RecordBatch) -> dict:
            out: dict[str, list] = {f.name: [] for f in PIECES}
            for doc, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                ids = (encoder.encode(text) if text else b"") + end
                total = len(ids) // 4
                for start in range(0, total, seq_len):
                    piece = ids[4 * start:4 * (start + seq_len)]
                    out["doc_id"].append(doc)
                    out["start"].append(start)
                    out["length"].append(len(piece) // 4)
                    out["ids_crc32"].append(zlib.crc32(piece))
                    out["doc_tokens"].append(total)
            return out
        return work
    return arrow_rows(make, PIECES)


def pieces(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", seq_len: int = SEQ_LEN,
           end_id: int = END_ID, tokenizer: str = TOKENIZER) -> DataFrame:
    """One row per piece of at most ``seq_len`` tokens; each token in exactly one."""
    slim = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    return slim.mapInArrow(_cut_documents(seq_len, end_id, tokenizer),
                           "doc_id long, start long, length long, ids_crc32 long, doc_tokens long")


def first_fit_decreasing(lengths, capacity: int) -> tuple[list[int], list[int]]:
    """(bin, offset) of each length, taken in the given order (largest first).

    ``room`` is a tournament tree: leaf ``b`` is the room left in bin ``b``,
    an inner node the larger of its children.  The first bin with enough room
    is found by going left whenever the left child has it.
    """
    leaves = 1
    while leaves < max(1, len(lengths)):
        leaves *= 2
    room = [capacity] * (2 * leaves)
    bins, offsets = [], []
    for size in lengths:
        if size > capacity:
            raise ValueError(f"a piece of {size} does not fit a bin of {capacity}")
        node = 1
        while node < leaves:
            node *= 2
            if room[node] < size:
                node += 1
        bins.append(node - leaves)
        offsets.append(capacity - room[node])
        room[node] -= size
        node //= 2
        while node:
            best = max(room[2 * node], room[2 * node + 1])
            if room[node] == best:
                break
            room[node] = best
            node //= 2
    return bins, offsets


def pack(piece_rows: DataFrame, seq_len: int = SEQ_LEN, group_pieces: int = GROUP_PIECES) -> DataFrame:
    """Pack pieces into sequences: ``sequence_id`` and gapless ``offset``.

    Groups are dealt by a hash that includes the row's place in the written
    table, so a third of all rows being one repeated row still spreads.
    """
    stored = materialize(piece_rows, "pieces")
    count = stored.count()
    groups = max(1, -(-count // group_pieces))
    dealt = stored.select("*", F.pmod(F.xxhash64("doc_id", "start", "ids_crc32", "_metadata.row_index"),
                                      F.lit(groups)).alias("grp"))

    def one_group(part: pd.DataFrame) -> pd.DataFrame:
        part = part.sort_values(["length", "doc_id", "start"], ascending=[False, True, True], kind="stable")
        bins, offsets = first_fit_decreasing(part["length"].tolist(), seq_len)
        part["sequence_id"] = np.asarray(bins, dtype="int64") * groups + part["grp"].to_numpy(dtype="int64")
        part["offset"] = np.asarray(offsets, dtype="int64")
        return part.drop(columns="grp")

    return dealt.groupBy("grp").applyInPandas(one_group, PACKED)


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents packed into sequences of at most 2048 tokens."""
    return pack(pieces(read_table(spark, sf_dir, "documents")))
