import random
import zlib

import numpy as np
import public_tokenizers
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from canopy.llm import packing as P


def test_chunks_give_the_tokenizers_ids(odd_rows):
    t = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    t.encode_special_tokens = True
    mine = P.ChunkEncoder()
    texts = [r[1] for r in odd_rows if r[1]] + ["a  b", "a \n b", " \t x  y ", "it's  a'll b", "1 2  3\n\n 4", " a", "a "]
    for text in texts:
        assert np.frombuffer(mine.encode(text), "<u4").tolist() == t.encode(text, add_special_tokens=False).ids


@settings(max_examples=200, deadline=None)
@given(st.text(alphabet="ab1.'\n\t  \x1cé你", max_size=30))
def test_cutting_at_spaces_changes_no_id(text):
    mine = P.ChunkEncoder()
    assert np.frombuffer(mine.encode(text), "<u4").tolist() == mine._bpe.encode_ordinary(text)


def test_tournament_tree_is_first_fit():
    rng = random.Random(1)
    for _ in range(50):
        sizes = sorted((rng.randint(1, 20) for _ in range(rng.randint(0, 60))), reverse=True)
        bins, offsets = P.first_fit_decreasing(sizes, 20)
        used: list[int] = []
        for size, b, o in zip(sizes, bins, offsets):
            want = next((k for k, u in enumerate(used) if u + size <= 20), len(used))
            if want == len(used):
                used.append(0)
            assert (b, o) == (want, used[want])
            used[want] += size


def test_pack_covers_every_token_once(odd, odd_rows):
    rows = P.pack(P.pieces(odd), group_pieces=8).collect()
    mine = P.ChunkEncoder()
    assert len({(r.sequence_id, r.offset) for r in rows}) == len(rows)
    fill: dict[int, list] = {}
    for r in rows:
        fill.setdefault(r.sequence_id, []).append((r.offset, r.length))
    for parts in fill.values():
        at = 0
        for offset, length in sorted(parts):
            assert offset == at
            at += length
        assert at <= 2048
    want = []
    for doc, text, *_ in odd_rows:
        ids = mine.encode(text or "") + (1).to_bytes(4, "little")
        want += [(doc, s, len(ids[4 * s:4 * s + 8192]) // 4, zlib.crc32(ids[4 * s:4 * s + 8192]), len(ids) // 4)
                 for s in range(0, len(ids) // 4, 2048)]
    got = [(r.doc_id, r.start, r.length, r.ids_crc32, r.doc_tokens) for r in rows]
    assert sorted(got, key=repr) == sorted(want, key=repr)


def test_empty(none):
    assert P.pack(P.pieces(none)).count() == 0


def test_chunks_are_encoded_together(monkeypatch):
    mine, calls = P.ChunkEncoder(), []

    class Counting:
        def encode_ordinary(self, text, bpe=mine._bpe):
            calls.append(text)
            return bpe.encode_ordinary(text)
    mine._bpe = Counting()
    text = "one two  three\n four é " * 20
    whole = mine.encode(text)
    assert calls == [text]
    monkeypatch.setattr(P, "LONG_CHUNK", 30)
    assert mine.encode(text) == whole and "".join(calls[1:]) == text and max(map(len, calls[1:])) <= 30
    assert mine.encode(text + "x" * 31 + " y") == P.ChunkEncoder().encode(text + "x" * 31 + " y")
