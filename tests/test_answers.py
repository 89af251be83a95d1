"""Model answers as VARIANT: shapes, broken answers, schema of all answers."""

from collections import Counter

from canopy.operators import answers as AN

ROWS = [(1, '```json\n{"a": {"b": [1, 2.5, null]}, "c": "x"}\n```'), (2, '{"a": null, "d": true}'), (3, '{"a": 1, "a": 2}'),
        (4, '{"a": '), (5, "[1]"), (6, '"text"'), (7, None), (8, ""), (9, "{}"), (2, '{"a": null, "d": true}'),
        (None, '{"": "no name", "ü\\n": "\\ud83d\\ude00", "n": 12345678901234567890123, "f": 1e3}'),
        (10, '{"long": "' + "y" * 300_000 + '"}'), (11, "null")]


def parsed(spark):
    return AN.parse(spark.createDataFrame([("text", *r) for r in ROWS], "modality string, key2 int, response string"))


def test_problems(spark):
    got = Counter((r.key2, r.problem) for r in parsed(spark).collect())
    assert got == Counter([(1, None), (2, None), (2, None), (9, None), (None, None), (10, None), (3, AN.NO_JSON), (4, AN.NO_JSON),
                           (5, AN.NO_OBJECT), (6, AN.NO_OBJECT), (7, AN.NO_ANSWER), (8, AN.NO_ANSWER), (11, AN.NO_OBJECT)])


def test_fields(spark):
    got = Counter((r.key2, r.key, r.kind, r.value) for r in AN.fields(parsed(spark)).collect())
    twice = [(2, "a", "null", "null"), (2, "d", "boolean", "true")] * 2
    assert got == Counter(twice + [
        (1, "a", "object", '{"b":[1,2.5,null]}'), (1, "c", "string", "x"), (None, "", "string", "no name"),
        (None, "ü\n", "string", "\U0001F600"), (None, "n", "number", "12345678901234567890123"), (None, "f", "number", "1000.0"),
        (10, "long", "string", "y" * 300_000)])


def test_schema_and_empty(spark):
    p = parsed(spark).where("key2 < 3")
    [row] = AN.schema(p).collect()
    assert (row.modality, row.answers) == ("text", 3)
    assert "c: STRING" in row.schema and "d: BOOLEAN" in row.schema
    none = p.where("false")
    assert AN.fields(none).count() == 0 and AN.schema(none).count() == 0
