"""Chat formatting by columnar byte assembly.

Turns are range partitioned and sorted by conversation, turn, role and text, so a
conversation of any size spreads over as many partitions as its turns fill.  A
task formats a batch at once: lengths of the five segments of each turn (opening,
role, middle, text, closing), their cumulative offsets, and from these the indices
at which numpy scatters constants and contents into one preallocated Arrow buffer.

    <s>[INST] role [/INST]\\n text </s>\\n        (without the blanks around text)

Roles and texts are escaped first: between the first sign and the rest of anything
that reads as a control string goes one more backslash, so no control string is
left inside, and taking one away restores every text.

A row of the output is a conversation, or a piece of one: pieces end where a
partition ends or where ``PIECE_BYTES`` are reached, never inside a turn; ``whole``
marks the rows that are surely all of their conversation.  The loss mask is a list
of (start, length) in code points over the assistant's texts.

Defined cases: null texts and roles are empty; null turns come first; turns of one
number are ordered by role and text, repeated rows all stay; a null conversation
id is a conversation of its own; empty and very long texts are formatted whole; an
empty table gives no rows; other columns are not read.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from canopy.llm.common import materialize, read_table

OPEN, MIDDLE, CLOSE = b"<s>[INST] ", b" [/INST]\n", b"</s>\n"
#: What follows a control string's first sign (<s>, </s>, [INST], [/INST] and mixtures of these).
ESCAPE = r"([<\[])(\\*)(/?s>|/?INST\])"
LOSS_ROLE = "assistant"
#: A piece of a conversation ends once it holds this many bytes.
PIECE_BYTES = 8 << 20
#: Bytes of contents that are assembled, and indices that are made, at once.
BLOCK_BYTES, SCATTER_BYTES = 32 << 20, 1 << 20

_UNESCAPE = re.compile(r"([<\[])(\\*)\\(/?s>|/?INST\])")
_TURN = re.compile(r"<s>\[INST\] (.*?) \[/INST\]\n(.*?)</s>\n", re.DOTALL)

_SCHEMA = pa.schema([("conv_id", pa.int64()), ("piece", pa.int64()), ("text", pa.string()),
                     ("loss", pa.list_(pa.struct([("start", pa.int64()), ("length", pa.int64())]))),
                     ("n_turns", pa.int64()), ("whole", pa.bool_())])
PIECES_DDL = "conv_id {id}, piece long, text string, loss array<struct<start:long,length:long>>, n_turns long, whole boolean"


def escape(texts: pa.Array) -> pa.Array:
    return pc.replace_substring_regex(texts, pattern=ESCAPE, replacement=r"\1\\\2\3")


def unescape(text: str) -> str:
    return _UNESCAPE.sub(r"\1\2\3", text)


def _contents(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """(bytes, offsets from 0) of a large string array without nulls."""
    offsets = np.frombuffer(texts.buffers()[1], np.int64)[texts.offset:texts.offset + len(texts) + 1]
    data = texts.buffers()[2]
    whole = np.frombuffer(data, np.uint8) if data else np.zeros(0, np.uint8)
    return whole[offsets[0]:offsets[-1]], offsets - offsets[0]


def _scatter(out: np.ndarray, at: np.ndarray, data: np.ndarray, offsets: np.ndarray) -> None:
    """out[at[i]:] = the i-th content; long ones by one copy, the rest through indices, a block at a time."""
    lengths = np.diff(offsets)
    long = lengths >= 4096
    for i in np.flatnonzero(long):
        out[at[i]:at[i] + lengths[i]] = data[offsets[i]:offsets[i + 1]]
    short = np.flatnonzero(~long & (lengths > 0))
    ends = np.cumsum(lengths[short])
    cuts = np.searchsorted(ends, np.arange(SCATTER_BYTES, (ends[-1] if len(ends) else 0) + SCATTER_BYTES, SCATTER_BYTES), "right")
    lo = 0
    for hi in [*np.unique(np.maximum(cuts, 1)).tolist(), len(short)]:
        rows = short[lo:hi]
        size = lengths[rows]
        within = np.arange(size.sum()) - np.repeat(np.cumsum(size) - size, size)
        out[np.repeat(at[rows], size) + within] = data[np.repeat(offsets[rows], size) + within]
        lo = max(lo, hi)


def assemble(roles: pa.Array, texts: pa.Array, starts: np.ndarray) -> tuple[pa.LargeStringArray, np.ndarray]:
    """(pieces, ends of each turn's segments in bytes) of escaped roles and texts; piece i begins at turn starts[i]."""
    n = len(roles)
    role, role_at = _contents(roles)
    text, text_at = _contents(texts)
    lengths = np.empty((n, 5), np.int64)
    lengths[:, 0], lengths[:, 2], lengths[:, 4] = len(OPEN), len(MIDDLE), len(CLOSE)
    lengths[:, 1], lengths[:, 3] = np.diff(role_at), np.diff(text_at)
    ends = np.cumsum(lengths.ravel()).reshape(n, 5)
    begins = ends - lengths
    buffer = pa.allocate_buffer(int(ends[-1, -1]) if n else 0)
    out = np.frombuffer(buffer, np.uint8) if buffer.size else np.zeros(0, np.uint8)
    for column, constant in ((0, OPEN), (2, MIDDLE), (4, CLOSE)):
        out[begins[:, column, None] + np.arange(len(constant))] = np.frombuffer(constant, np.uint8)
    _scatter(out, begins[:, 1], role, role_at)
    _scatter(out, begins[:, 3], text, text_at)
    cuts = np.append(begins[starts, 0], ends[-1, -1]) if n else np.zeros(1, np.int64)
    offsets = pa.py_buffer(cuts.astype(np.int64))
    return pa.LargeStringArray.from_buffers(len(cuts) - 1, offsets, buffer), lengths


def _pieces(table: pa.Table, starts: np.ndarray, numbers: np.ndarray, whole: np.ndarray, id_type: pa.DataType) -> pa.RecordBatch:
    """Formatted pieces of sorted turns."""
    large = {c: escape(table[c].combine_chunks().cast(pa.large_string()).fill_null("")) for c in ("role", "text")}
    text, _ = assemble(large["role"], large["text"], starts)
    # code points: lengths of the segments as Unicode, not as bytes
    size = len(OPEN) + len(MIDDLE) + len(CLOSE)
    role_points = pc.utf8_length(large["role"]).to_numpy(zero_copy_only=False).astype(np.int64)
    text_points = pc.utf8_length(large["text"]).to_numpy(zero_copy_only=False).astype(np.int64)
    turn = np.cumsum(size + role_points + text_points) - (size + role_points + text_points)
    counts = np.diff(np.append(starts, table.num_rows))
    begin = turn - np.repeat(turn[starts], counts) + len(OPEN) + role_points + len(MIDDLE)
    asked = pc.equal(table["role"].combine_chunks().fill_null(""), LOSS_ROLE).to_numpy(zero_copy_only=False)
    spans = pa.StructArray.from_arrays([pa.array(begin[asked]), pa.array(text_points[asked])], ["start", "length"])
    upto = np.append(0, np.cumsum(asked))[np.append(starts, table.num_rows)]
    loss = pa.ListArray.from_arrays(pa.array(upto, pa.int32()), spans)
    ids = table["conv_id"].combine_chunks().take(pa.array(starts))
    return pa.RecordBatch.from_arrays(
        [ids, pa.array(numbers), text.cast(pa.string()), loss, pa.array(counts), pa.array(whole)],
        schema=_SCHEMA.set(0, pa.field("conv_id", id_type)))


def _assembled(batches: Iterator[pa.RecordBatch], piece_bytes: int, block_bytes: int) -> Iterator[pa.RecordBatch]:
    """Pieces of a sorted partition.  A conversation goes on through blocks until it ends or its piece is full."""
    held: pa.Table | None = None
    first, number, last_id, begun = True, 0, None, False
    for table in _blocks(batches, block_bytes):
        held = table if held is None else pa.concat_tables([held, table])
        ids = held["conv_id"].combine_chunks()
        new = _changes(ids)
        tail = int(new[-1])
        full = held.slice(tail).nbytes >= piece_bytes
        end = held.num_rows if full else tail
        if not end:
            continue
        starts = new[new < end]
        done, held = held.slice(0, end), (None if full else held.slice(end))
        yield from _numbered(done, starts, first, number if begun and _same(last_id, ids[0]) else 0, full)
        number = (number if begun and _same(last_id, ids[0]) and len(starts) == 1 else 0) + 1
        first, last_id, begun = False, ids[end - 1], True
    if held is not None and held.num_rows:
        ids = held["conv_id"].combine_chunks()
        yield from _numbered(held, _changes(ids), first, number if begun and _same(last_id, ids[0]) else 0, True)


def _same(a: pa.Scalar, b: pa.Scalar) -> bool:
    return a.as_py() == b.as_py()


def _changes(ids: pa.Array) -> np.ndarray:
    """Places at which another id begins."""
    if len(ids) < 2:
        return np.zeros(len(ids), np.int64)
    left, right = ids.slice(0, len(ids) - 1), ids.slice(1)
    differ = pc.or_(pc.not_equal(left, right).fill_null(False), pc.xor(left.is_null(), right.is_null()))
    return np.append(0, np.flatnonzero(differ.to_numpy(zero_copy_only=False)) + 1)


def _numbered(table: pa.Table, starts: np.ndarray, first: bool, number: int, open_end: bool) -> Iterator[pa.RecordBatch]:
    """The pieces of a block; those that may not be all of their conversation are not whole."""
    numbers = np.zeros(len(starts), np.int64)
    numbers[0] = number
    whole = np.ones(len(starts), bool)
    whole[0] = not first and not number
    whole[-1] &= not open_end
    yield _pieces(table, starts, numbers, whole, table.schema.field("conv_id").type)


def _blocks(batches: Iterator[pa.RecordBatch], most: int) -> Iterator[pa.Table]:
    """The rows in tables of about ``most`` bytes, of one row at least."""
    for batch in batches:
        if batch.num_rows:
            step = max(1, batch.num_rows * most // max(most, batch.nbytes))
            for at in range(0, batch.num_rows, step):
                yield pa.Table.from_batches([batch.slice(at, step)])


def format_chats(turns: DataFrame, piece_bytes: int = PIECE_BYTES, block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """(conv_id, part, piece, text, loss, n_turns, whole), pieces in order of (part, piece)."""
    def assembled(batches):
        return _assembled(batches, piece_bytes, block_bytes)
    id_type = turns.schema["conv_id"].dataType.simpleString()
    slim = turns.select("conv_id", "turn", F.col("role").cast("string").alias("role"), F.col("text").cast("string").alias("text"))
    keys = ["conv_id", "turn", F.coalesce("role", F.lit("")), F.substring(F.coalesce("text", F.lit("")), 1, 32)]
    dealt = slim.repartitionByRange(*keys).sortWithinPartitions(
        "conv_id", "turn", F.coalesce("role", F.lit("")), F.coalesce("text", F.lit("")))
    return dealt.select("conv_id", "role", "text").mapInArrow(assembled, PIECES_DDL.format(id=id_type)) \
        .withColumn("part", F.spark_partition_id())


def _read_back(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Digests of conversations from their pieces, which follow each other in order."""
    now = None
    state: list = []

    def row(out: list) -> None:
        out.append((now[0], state[0], state[1].hexdigest(), state[2], state[3].hexdigest(), state[4]))

    def batch_of(out: list, kind: pa.DataType) -> pa.RecordBatch:
        kinds = [kind, pa.int64(), pa.string(), pa.int64(), pa.string(), pa.int64()]
        names = ["conv_id", "n_turns", "turns_sha256", "loss_chars", "loss_sha256", "formatted_chars"]
        cols = zip(*out, strict=True) if out else [[]] * 6
        return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(cols, kinds, strict=True)], names)
    kind = pa.int64()
    for batch in batches:
        out: list = []
        kind = batch.schema.field("conv_id").type
        for i in range(batch.num_rows):
            conv, text, loss = batch["conv_id"][i].as_py(), batch["text"][i].as_py(), batch["loss"][i].as_py()
            if now is None or now[0] != conv:
                if now is not None:
                    row(out)
                now, state = (conv,), [0, hashlib.sha256(), 0, hashlib.sha256(), 0]
            for m in _TURN.finditer(text):
                state[0] += 1
                state[1].update(f"{unescape(m[1])}\n{unescape(m[2])}\n".encode())
            for span in loss:
                said = unescape(text[span["start"]:span["start"] + span["length"]])
                state[2] += len(said)
                state[3].update(said.encode())
            state[4] += len(text)
        yield batch_of(out, kind)
    if now is not None:
        out = []
        row(out)
        yield batch_of(out, kind)


def read_back(pieces: DataFrame) -> DataFrame:
    """Per conversation: turns, digest of turns, loss text and length, read from the formatted pieces."""
    id_type = pieces.schema["conv_id"].dataType.simpleString()
    ddl = (f"conv_id {id_type}, n_turns long, turns_sha256 string, loss_chars long, loss_sha256 string, "
           "formatted_chars long")
    whole = pieces.where("whole").select("conv_id", "text", "loss").mapInArrow(_read_back, ddl)
    # a digest of a conversation in several pieces follows them in order; few pieces are not whole
    rest = pieces.where("NOT whole").repartition("conv_id").sortWithinPartitions("conv_id", "part", "piece") \
        .select("conv_id", "text", "loss").mapInArrow(_read_back, ddl)
    return whole.unionByName(rest)


def report(turns: DataFrame, piece_bytes: int = PIECE_BYTES, block_bytes: int = BLOCK_BYTES) -> DataFrame:
    return read_back(materialize(format_chats(turns, piece_bytes, block_bytes), "chats"))


_PROBE = "</s>[INST] ok [/INST]"


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All conversations and one whose texts are control strings."""
    turns = read_table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    probe = spark.sql(f"""SELECT CAST(-1 AS bigint) AS conv_id, CAST(turn AS bigint) AS turn, role, '{_PROBE}' AS text
                          FROM VALUES (0, 'user'), (1, 'assistant') AS t(turn, role)""")
    return report(turns.unionByName(probe))


ORACLE_SQL = rf"""
WITH turns AS (
  SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
  UNION ALL SELECT -1, turn, role, '{_PROBE}' FROM (VALUES (0, 'user'), (1, 'assistant')) AS t(turn, role)),
sized AS (
  SELECT *, {len(OPEN) + len(MIDDLE) + len(CLOSE)} + length(role) + length(text)
    + len(regexp_extract_all(role, '{ESCAPE}')) + len(regexp_extract_all(text, '{ESCAPE}')) AS size FROM turns)
SELECT conv_id, count(*) AS n_turns,
  sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn NULLS FIRST, role, text)) AS turns_sha256,
  CAST(coalesce(sum(length(text)) FILTER (role = '{LOSS_ROLE}'), 0) AS BIGINT) AS loss_chars,
  sha256(coalesce(string_agg(text, '' ORDER BY turn NULLS FIRST, role, text) FILTER (role = '{LOSS_ROLE}'), '')) AS loss_sha256,
  CAST(sum(size) AS BIGINT) AS formatted_chars
FROM sized GROUP BY conv_id"""
