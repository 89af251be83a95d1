import re

from canopy.llm import quality as Q


def brute(text):
    text = text or ""
    w = re.findall(r"[^\x20\x09-\x0D]+", text)
    grams: dict[tuple, list] = {}
    for i in range(len(w) - 2):
        grams.setdefault(tuple(w[i:i + 3]), []).append(i)
    hit = {i + k for at in grams.values() if len(at) > 1 for i in at for k in range(3)}
    lines = [x for x in text.split("\n") if re.search(r"[^\x20\x09-\x0D]", x)]
    n = len(w)
    return (n, sum(map(len, w)), len(re.findall(r"[#*$%&|<>]", text)), len(lines) - len(set(lines)), len(hit),
            n < 50 or 100 * len(hit) > 50 * n)


def test_counts_against_brute_force(spark, odd, odd_rows, rng):
    extra = ["a b c a b c", "a b c\na b c\n\n \na b c", "# $ 1%\t\x0b&\x0c|", "x y x y x", "\n\n", "one", "one two"]
    extra += [" ".join(rng.choice("abcd") for _ in range(rng.randrange(0, 90))) for _ in range(40)]
    df = spark.createDataFrame([(100 + i, t) for i, t in enumerate(extra)], "doc_id long, text string")
    both = odd.select("doc_id", "text", "source").unionByName(df, allowMissingColumns=True)
    names = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed"]
    got = [(r.doc_id, *(r[n] for n in names)) for r in Q.verdicts(both).collect()]
    want = [(r[0], *brute(r[1])) for r in odd_rows] + [(100 + i, *brute(t)) for i, t in enumerate(extra)]
    assert sorted(got, key=repr) == sorted(want, key=repr)


def test_positions_beyond_the_packed_bits_change_nothing(spark, monkeypatch):
    monkeypatch.setattr(Q, "PLACE_BITS", 3)
    text = " ".join(str(i % 7) for i in range(40)) + " " + " ".join(f"u{i}" for i in range(30))
    df = spark.createDataFrame([(1, text, "s")], "doc_id long, text string, source string")
    assert Q.verdicts(df).first().n_repeat_words == brute(text)[4]


def test_a_bad_host_fails_whole_and_a_small_one_is_shrunk(spark):
    good = " ".join(f"word{i}" for i in range(60))
    rows = [(i, "short", "bad") for i in range(95)] + [(95 + i, good, "bad") for i in range(5)]
    rows += [(200 + i, good, f"host{i % 10}") for i in range(400)] + [(900, "tiny", "one"), (901, good, None)]
    out = {r.doc_id: r.kept for r in Q.verdicts(spark.createDataFrame(rows, "doc_id long, text string, source string"))
           .collect()}
    assert not any(out[i] for i in range(100))
    assert all(out[200 + i] for i in range(400)) and out[901] and not out[900]


def test_empty(none):
    assert Q.verdicts(none).count() == 0
