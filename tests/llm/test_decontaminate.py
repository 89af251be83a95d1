import hashlib
import re

import pytest
from pyspark.sql import functions as F

from canopy.llm import decontaminate as D

WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
LOWER = {c: c + 32 for c in range(65, 91)}


def brute(text, items):
    words = WORD.findall((text or "").translate(LOWER))
    hit, found = set(), set()
    for item, body in items:
        w = WORD.findall((body or "").translate(LOWER))
        n = min(10, len(w))
        grams = {tuple(w[i:i + n]) for i in range(len(w) - n + 1)} if n else set()
        for i in range(len(words) - n + 1):
            if n and tuple(words[i:i + n]) in grams:
                hit.update(range(i, i + n))
                found.add(item)
    named = sorted(str(i) for i in found if i is not None)
    return (len(words), len(hit), len(found), hashlib.sha256(",".join(named).encode()).hexdigest(), bool(hit))


@pytest.fixture(scope="module")
def items(odd_rows):
    same, long = odd_rows[0][1].split(), odd_rows[8][1].split()
    return [(1, " ".join(same[10:25])), (2, " ".join(same[20:32]).upper()), (3, "ha, HA"), (4, None), (5, ""), (6, "..."),
            (7, " ".join(long[4000:4009])), (8, " ".join(long[70:95]) + " nothing"), (9, " ".join(same[10:25])), (10, "a"), (10, "a"),
            (None, " ".join(same[60:72])), (None, " ".join(long[200:230])), (None, None)]


@pytest.mark.parametrize("block", [1_000_000, 15])
def test_report_against_brute_force(spark, odd, odd_rows, items, block):
    bench = spark.createDataFrame(items, "item_id long, text string").withColumn("n_hit", F.lit(1))
    got = [tuple(r) for r in D.report(odd, bench, block_words=block).collect()]
    want = [(r[0], *brute(r[1], items)) for r in odd_rows]
    assert sorted(got, key=repr) == sorted(want, key=repr)


@pytest.mark.parametrize("block", [1_000_000, 15])
def test_spans_are_cut_and_clean_texts_stay(spark, odd, odd_rows, items, block):
    bench = spark.createDataFrame([i for i in items if i[0] in (1, 2, 8)], "item_id long, text string")
    kept = D.remove_spans(odd, bench, block_words=block)
    assert kept.columns == odd.columns
    rows = [(r.doc_id, r.text) for r in kept.collect()]
    assert len(rows) == len(odd_rows)
    again = D.report(kept, bench).where("contaminated AND doc_id != 5").count()
    assert again == 0
    clean = [(r[0], r[1]) for r in odd_rows if not brute(r[1], [i for i in items if i[0] in (1, 2, 8)])[4]]
    assert all(c in rows for c in clean)


def test_mostly_benchmark_goes_and_empty_tables(spark, odd, none):
    bench = spark.createDataFrame([(1, "ha ha")], "item_id long, text string")
    assert 12 not in [r.doc_id for r in D.remove_spans(odd, bench).collect()]
    assert D.report(none, bench).count() == 0
    assert D.report(odd, bench.where("false")).where("contaminated").count() == 0
    assert D.remove_spans(odd, bench.where("false")).count() == odd.count()
