"""Terms are counted where a document's text is; a summary of annotations fits the topics once."""

from canopy.operators import topics as TP
from canopy.operators.util import materialize
from canopy.plans import annotate_plans as AP
from tests.conftest import SF_SMALL


def test_doc_terms_shuffles_texts_not_terms(spark):
    docs = spark.createDataFrame([(1, "aa bb aa"), (1, "aa cc"), (2, None), (3, "dd dd dd")], "doc_key long, text string")
    terms = TP.doc_terms(docs)
    assert sorted(map(tuple, terms.collect())) == [(1, "aa", 3), (1, "bb", 1), (1, "cc", 1), (3, "dd", 3)]
    plan = terms._jdf.queryExecution().executedPlan().toString()
    exchanges = [line for line in plan.splitlines() if "Exchange hashpartitioning" in line]
    assert exchanges and not any("term" in line for line in exchanges)


def test_annotation_summary_fits_once(spark, monkeypatch):
    calls, fit = [], AP._info
    monkeypatch.setattr(AP, "_info", lambda *a: calls.append(a) or fit(*a))
    AP.q_annotation_summary(spark, SF_SMALL)
    assert len(calls) == 1


def test_doc_terms_keeps_no_table_of_a_task_s_terms(spark):
    rows = [(None, "x1 x2 x1"), (None, "x1"), (4, ""), (5, "Zz zZ a b"), (5, None)]
    terms = TP.doc_terms(spark.createDataFrame(rows, "doc_key long, text string"))
    assert sorted(map(tuple, terms.collect()), key=str) == [(5, "zz", 2), (None, "x1", 3), (None, "x2", 1)]
    plan = terms._jdf.queryExecution().executedPlan().toString()
    assert not any("HashAggregate(keys=" in line and "term" in line for line in plan.splitlines())


def test_term_counts_are_made_once(spark, monkeypatch):
    written, write = [], TP.materialize
    monkeypatch.setattr(TP, "materialize", lambda df, name="stage": written.append(name) or write(df, name))
    counts = spark.createDataFrame([(0, "a", 2), (0, "b", 2), (1, "a", 4)], "topic int, term string, n long")
    weights = {(r.topic, r.term): r.tf for r in TP.ctfidf(counts).collect()}
    assert weights == {(0, "a"): 0.5, (0, "b"): 0.5, (1, "a"): 1.0} and written == ["counts"]


def test_stored_texts_stay_where_they_are(spark):
    rows = [(1, "one two two"), (1, "two three"), (2, "alpha beta alpha"), (3, None), (4, ""), (2, None), (None, "lost words"), (5, "alpha")]
    docs = materialize(spark.createDataFrame(rows, "doc_key long, text string"))
    named = TP.doc_terms(docs, stored=True)
    want = sorted(map(tuple, TP.doc_terms(docs).where("doc_key IS NOT NULL").collect()))
    assert sorted(map(tuple, named.where("doc_key IS NOT NULL").collect())) == want and (1, "two", 3) in want
    single = materialize(docs.where("doc_key = 5"))
    moved = TP.doc_terms(single, stored=True)
    assert moved.collect() == [(5, "alpha", 1)]
    # one exchange, of repeated keys alone; the other side of the union has none
    anti = moved._jdf.queryExecution().optimizedPlan().toString().split("LeftAnti")[1]
    assert "Repartition" not in anti
