"""No text may kill or stall a task: long runs of one sign, unclosed tags, huge tokens."""
import random
import re
import time

import numpy as np
import pytest
import tokenizers
from hypothesis import given, settings
from hypothesis import strategies as st

from canopy.llm import htmltext, packing, pii, toxicity

N = 1_000_000
_rng = random.Random(1)
HARD = {"spaces": " " * N, "line feeds": "\n" * N, "white": " \n\t" * (N // 3), "letters": "a" * N, "dots": "." * N,
        "zeros": "0" * N, "digits": "1" * N, "dashes": "-" * N, "leader": "Intro" + "." * 1000 + "12",
        "inner": "a" + "=" * 40_000 + "b", "zero ip": "0" * 5000 + "1.2.3.4",
        "base64": "".join(_rng.choices("ABCdef0123456789+/", k=N // 4)), "at": "@" * 50_000, "tags": "<a " * 100_000}
PAGES = {"unclosed": "<b>" * 3000 + "</i>" * 3000, "open tags": "<a " * 100_000, "paragraphs": "<b>" * 3000 + "<p>x" * 3000,
         "signs": "<" * N}


@pytest.fixture(scope="module")
def tools():
    ones = np.ones(1 << toxicity.LM_BITS)
    return packing.ChunkEncoder(), toxicity.Restorer(ones, ones)


@pytest.mark.parametrize("name", HARD)
def test_texts(tools, name):
    text, start = HARD[name], time.time()
    tools[0].encode(text)
    for token in toxicity.tokens_of(text):
        tools[1].words(token)
    spans = pii.base_spans(text)
    found = [text[a:b] for _, a, b in pii.tokens_of(text, spans)]
    for token in found:
        pii.features(token)
    pii.skip_edges(found)
    assert time.time() - start < 60


@pytest.mark.parametrize("name", PAGES)
def test_pages(name):
    start = time.time()
    htmltext.study(PAGES[name])
    assert time.time() - start < 10


def test_long_chunks_have_the_ids_of_the_file():
    import public_tokenizers
    file = tokenizers.Tokenizer.from_file(str(public_tokenizers.path("byte_bpe_50k.json")))
    for text in (" " * 30_000 + "x", "ab " * 9 + "\n" * 25_000 + " y z", "é" * 21_000 + " end"):
        assert np.frombuffer(packing.ChunkEncoder().encode(text), "<u4").tolist() == file.encode(text, add_special_tokens=False).ids


EDGE = re.compile(r"^(?:[^\w@$]+|([@$_])\1\1+)+|(?:[^\w@$]+|([@$_])\2\2+)+$")


@settings(max_examples=300, deadline=None)
@given(st.text(alphabet="a@$_.-!9ü", max_size=9))
def test_core_is_what_the_pattern_leaves(token):
    assert toxicity.core_of(token) == EDGE.sub("", token)


def test_zeros_before_an_address():
    text = "0" * 5000 + "1.2.3.4"
    assert pii.base_spans(text)[0] == ("ip", 0, len(text))
