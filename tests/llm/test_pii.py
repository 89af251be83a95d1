import hashlib
import re

from hypothesis import given, settings
from hypothesis import strategies as st

from canopy.llm import pii as P


def by_pattern(t):
    out = [("email", *m.span()) for m in re.finditer(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", t)]
    out += [("ip", *m.span()) for m in re.finditer(r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)", t)
            if all(int(x) <= 255 for x in m[0].split("."))]
    for m in re.finditer(r"[0-9]([\x20-]?[0-9])+", t):
        d = re.sub("[^0-9]", "", m[0])
        doubled = sum(int(c) if k % 2 == 0 else sum(map(int, str(2 * int(c)))) for k, c in enumerate(d[::-1]))
        if 13 <= len(d) <= 19 and doubled % 10 == 0:
            out.append(("card", *m.span()))
    out += [("phone", *m.span()) for m in re.finditer(r"\+[0-9][\x20().0-9-]+[0-9]", t)
            if 9 <= len(re.sub("[^0-9]", "", m[0])) <= 15]
    return out


@settings(max_examples=400, deadline=None)
@given(st.text(alphabet="a1@.+- (é", max_size=40))
def test_base_spans_are_the_patterns(text):
    assert P.base_spans(text) == by_pattern(text)


CARDS = "4111 1111 1111 1111, 4111-1111-1111-1111 and 4111111111111112, 00000000255.1.1.1 256.1.1.1 1.2.3.4.5.6.7.8"


def corpus():
    rows = []
    for i in range(300):
        rows.append(f"word{i % 7} x{i}.{i % 90:02d}@mail{i % 9}.example.com then +1 ({200 + i}) 555-{1000 + i} and more "
                    f"{i % 250}.{(7 * i) % 250}.3.{i % 99 + 1} Version 2.0. of A{i}B token=ab{i}cd")
    return rows + [CARDS] * 20


def test_known_cards():
    assert by_pattern(CARDS) == P.base_spans(CARDS)
    assert [s[0] for s in P.base_spans(CARDS)] == ["ip", "ip", "ip", "card", "card"]


def test_repeats_take_the_label_of_a_base_span(spark):
    text = "call +1 (988) 555-2485 now; far away " + "word " * 300 + "the same 988-555-2485 again, but not 12-34 or 2.0."
    ip = "from 42.144.35.254 " + "word " * 50 + "later 42-144-35-254 there"
    field = P.learn(spark.createDataFrame([(t,) for t in corpus()], "text string"))
    _, more = P.find_spans(text, field)
    assert [(k, text[a:b]) for k, a, b in more] == [("phone", "988-555-2485")]
    _, more = P.find_spans(ip, field)
    assert [(k, ip[a:b]) for k, a, b in more] == [("ip", "42-144-35-254")]
    assert P.find_spans("plain words, Version 2.0. of A1B and token=ab3cd", field) == ([], [])
    assert P.mask(ip, field).count("[ip]") == 2


def test_report(spark, odd, odd_rows, none):
    rows = [(100 + i, t) for i, t in enumerate(corpus())]
    df = odd.select("doc_id", "text", "spans").unionByName(
        spark.createDataFrame(rows, "doc_id long, text string"), allowMissingColumns=True)
    out = P.report(df).collect()
    want = {}
    for doc, text in [(r[0], r[1]) for r in odd_rows] + rows:
        spans = by_pattern(text or "")
        joined = ",".join(f"{k}:{a}:{b}" for k, a, b in spans)
        want.setdefault(doc, []).append((*(sum(s[0] == k for s in spans) for k in P.KINDS),
                                         hashlib.sha256(joined.encode()).hexdigest(), joined))
    got = {}
    for r in out:
        got.setdefault(r.doc_id, []).append((r.n_email, r.n_ip, r.n_card, r.n_phone, r.base_sha256))
        base = [w[5] for w in want[r.doc_id]]
        assert any(set(filter(None, b.split(","))) <= set(r.spans.split(",")) for b in base)
    assert {k: sorted(v) for k, v in got.items()} == {k: sorted(w[:5] for w in v) for k, v in want.items()}
    assert P.report(none).count() == 0


def test_many_repeats_stay_linear():
    names = ["555-2485"] * 5000
    assert len(P.skip_edges(names)) == 4999


def test_mail_names_without_digits_are_linked(spark):
    field = P.learn(spark.createDataFrame([(t,) for t in corpus()], "text string"))
    text = "Write to alice.smith@example.com; " + "word " * 60 + "alice.smith[at]example.com works, ask alice.smith then."
    _, more = P.find_spans(text, field)
    assert [(k, text[a:b]) for k, a, b in more] == [("email", "alice.smith[at]example.com"), ("email", "alice.smith")]
    text = "Mail Jane_Doe@example.com or " + "word " * 60 + "<jane_doe(at)example.com>."
    _, more = P.find_spans(text, field)
    assert [(k, text[a:b].strip("<>")) for k, a, b in more] == [("email", "jane_doe(at)example.com")]
    assert P.find_spans("no address here, alice.smith and smith", field) == ([], [])


def test_equal_tokens_are_linked():
    assert P.skip_edges(["12-34", "x", "12-34", "x@y.org", "bob@y.org", "Bob"]) == [(0, 2), (1, 3), (4, 5)]
