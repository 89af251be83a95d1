"""CSV files: exact round trip and quarantine of broken rows."""

from pathlib import Path

from canopy.operators import sinks as K

SCHEMA = "id long, text string, n long"


def test_exact_round_trip(spark):
    rows = [(1, 'say "hi", twice', 1), (2, "two\nlines\n\nand more", 2), (3, None, None), (4, "", 4), (5, "  edges  ", 5),
            (6, "\\ back \\\"slash", 6), (7, "x" * 200_000, 7), (7, "x" * 200_000, 7), (None, "no id", None),
            (8, ",", 8), (9, "\u00fc \U0001F600", 9)]
    path = K.write_exact_csv(spark.createDataFrame(rows, SCHEMA))
    good, broken = K.read_quarantined(spark, path, SCHEMA)
    assert sorted(map(tuple, good.collect()), key=repr) == sorted(rows, key=repr)
    assert broken.count() == 0


def test_broken_rows_are_kept_apart_with_their_file(spark, tmp_path):
    Path(tmp_path / "a.csv").write_text("id,text,n\n1,fine,10\nx,bad id,11\n2,few\n")
    Path(tmp_path / "b.csv").write_text('id,text,n\n3,"fine, too",12\n4,many,13,14\n5,bad n,1.5.2\n6,,\n')
    good, broken = K.read_quarantined(spark, [str(tmp_path / "a.csv"), str(tmp_path / "b.csv")], SCHEMA)
    assert sorted(map(tuple, good.collect())) == [(1, "fine", 10), (3, "fine, too", 12), (6, None, None)]
    assert sorted((r.file, r.raw) for r in broken.collect()) == [
        ("a.csv", "2,few"), ("a.csv", "x,bad id,11"), ("b.csv", "4,many,13,14"), ("b.csv", "5,bad n,1.5.2")]


def test_empty_table(spark):
    path = K.write_exact_csv(spark.createDataFrame([], SCHEMA))
    good, broken = K.read_quarantined(spark, path, SCHEMA)
    assert good.count() == 0 and broken.count() == 0
