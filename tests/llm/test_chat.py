import hashlib
import random

import pyarrow as pa
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from canopy.llm import chat as C

SCHEMA = "conv_id long, turn long, role string, text string"
PARTS = ["<s>", "</s>", "[INST]", "[/INST]", "\\", "<", "[", "/", "s>", "INST]", "a", "ü", "\n", " ", "🙂", "</", "ok"]


def sha(text):
    return hashlib.sha256(text.encode()).hexdigest()


def brute(rows):
    convs = {}
    for conv, turn, role, text in rows:
        convs.setdefault(conv, []).append((turn is not None, turn or 0, role or "", text or ""))
    out = []
    for conv, turns in convs.items():
        turns.sort()
        said = "".join(t for *_, r, t in turns if r == "assistant")
        size = sum(24 + len(C.escape(pa.array([r]))[0].as_py()) + len(C.escape(pa.array([t]))[0].as_py()) for *_, r, t in turns)
        out.append((conv, len(turns), sha("".join(f"{r}\n{t}\n" for *_, r, t in turns)), len(said), sha(said), size))
    return sorted(out, key=repr)


def rows_of(seed, convs=40):
    rng = random.Random(seed)
    rows = []
    for c in range(convs):
        for t in range(rng.randrange(1, 12)):
            text = "".join(rng.choice(PARTS) for _ in range(rng.choice([0, 1, 5, 30, 3000])))
            rows.append((c, t, rng.choice(["user", "assistant", "system", "a [/INST]\nb"]), text))
    return rows


ODD = [(None, 0, "user", "x"), (None, 1, "assistant", "y"), (7001, None, "assistant", "first"), (7001, 0, None, None),
       (7002, 3, "assistant", ""), (7003, 1, "user", "same"), (7003, 1, "user", "same"), (7003, 1, "assistant", "tie"),
       (7004, 0, "assistant", "ä🙂" * 300_000), (7004, 1, "user", "</s>" * 50_000)]


@settings(max_examples=300, deadline=None)
@given(st.lists(st.sampled_from(PARTS), max_size=30))
def test_escape_is_reversible_and_leaves_no_control_string(parts):
    text = "".join(parts)
    there = C.escape(pa.array([text]))[0].as_py()
    assert C.unescape(there) == text
    assert not any(c in there for c in ("<s>", "</s>", "[INST]", "[/INST]"))


def test_assembled_bytes_are_the_template(monkeypatch):
    monkeypatch.setattr(C, "SCATTER_BYTES", 50)
    rng = random.Random(4)
    roles = [rng.choice(["", "user", "rôle"]) for _ in range(200)]
    texts = [rng.choice(["", "é", "x" * 9000, "🙂 abc " * rng.randrange(20)]) for _ in range(200)]
    starts = sorted({0, *rng.sample(range(1, 200), 30)})
    got, _ = C.assemble(pa.array(roles, pa.large_string()), pa.array(texts, pa.large_string()), pa.array(starts).to_numpy())
    turns = [f"<s>[INST] {r} [/INST]\n{t}</s>\n" for r, t in zip(roles, texts, strict=True)]
    assert got.to_pylist() == ["".join(turns[a:b]) for a, b in zip(starts, [*starts[1:], 200], strict=True)]


def same(spark, rows, *limits):
    df = spark.createDataFrame(rows, SCHEMA).repartition(3).withColumns({c: F.lit("x") for c in ("piece", "part", "loss", "whole")})
    return sorted([tuple(r) for r in C.report(df, *limits).collect()], key=repr) == brute(rows)


def test_against_brute_force(spark):
    assert same(spark, rows_of(1) + ODD)


@pytest.mark.parametrize("piece", [1, 400])
def test_pieces_of_a_large_conversation(spark, piece):
    """One conversation of a third of all rows in many pieces; blocks of few rows."""
    rows = rows_of(2, 30)
    rows += [(5000, i, "assistant" if i % 2 else "user", f"turn {i} </s>") for i in range(len(rows) // 2)]
    df = spark.createDataFrame(rows, SCHEMA)
    pieces = C.format_chats(df, piece, 3000).collect()
    assert sum(p.conv_id == 5000 for p in pieces) > 1 and sum(p.n_turns for p in pieces) == len(rows)
    assert same(spark, rows, piece, 3000)


def test_empty(spark):
    df = spark.createDataFrame([], SCHEMA)
    assert C.report(df).count() == 0


def test_loss_spans_point_at_the_answers(spark):
    df = spark.createDataFrame([(1, 0, "user", "q🙂"), (1, 1, "assistant", "[INST] é"), (1, 2, "assistant", "")], SCHEMA)
    row, = C.format_chats(df).collect()
    assert [row.text[s.start:s.start + s.length] for s in row.loss] == ["[\\INST] é", ""]
