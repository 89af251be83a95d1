"""Text cleaning and tokenising as native Column expressions (no UDFs).

Python's ``\\w`` / ``\\S`` are Unicode-aware while Java's default classes
are ASCII-only, so every pattern spells its class out explicitly.  The same
classes are used by the DuckDB oracle (see ``canopy.plans.sql``).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Character classes and patterns that define the cleaning rules.
WORD = r"[\p{L}\p{N}_]"
NON_SPACE = (r"[^\t-\r\x{1c}-\x{20}\x{85}\x{a0}\x{1680}\x{2000}-\x{200a}"
             r"\x{2028}\x{2029}\x{202f}\x{205f}\x{3000}]")
URL_PATTERN = rf"https?://{NON_SPACE}+|www\.{NON_SPACE}+"
HASHTAG_PATTERN = rf"#({WORD}+)"
MENTION_PATTERN = rf"@{NON_SPACE}+"
CAMEL_BOUNDARY = r"([a-z])([A-Z])"
TOKEN_PATTERN = r"[\p{L}\p{N}_]{2,}"
JSON_FENCE = "```json"
FENCE = "```"
# Characters Python's str.strip() removes (str.isspace).
WHITESPACE = ("\t\n\x0b\x0c\r\x1c\x1d\x1e\x1f \x85\xa0\u1680"
              + "".join(chr(c) for c in range(0x2000, 0x200B))
              + "\u2028\u2029\u202f\u205f\u3000")


def _c(col) -> Column:
    return F.col(col) if isinstance(col, str) else col


def remove_urls(col) -> Column:
    """every ``http(s)://…`` or ``www.…`` run of non-space becomes ''."""
    return F.regexp_replace(_c(col), URL_PATTERN, "")


def split_hashtags(col) -> Column:
    """``#FooBar`` -> ``Foo Bar``; the camel split applies inside tags only.

    The text is cut at the tags (``split``) and the tags are pulled out
    (``regexp_extract_all``); both arrays are then re-interleaved with
    ``zip_with`` so the whole text is processed in one JVM expression.
    """
    c = _c(col)
    parts = F.split(c, "#" + WORD + "+", -1)
    tags = F.regexp_extract_all(c, F.lit(HASHTAG_PATTERN), 1)
    split_tags = F.transform(tags, lambda t: F.regexp_replace(t, CAMEL_BOUNDARY, "$1 $2"))
    tail = F.slice(parts, 2, F.greatest(F.size(parts) - 1, F.lit(0)))
    glued = F.zip_with(split_tags, tail, lambda t, p: F.concat(t, p))
    return F.when(c.isNull(), F.lit(None)).otherwise(
        F.concat(F.element_at(parts, 1), F.array_join(glued, "")))


def remove_mentions(col) -> Column:
    """``@…`` up to the next space becomes one space."""
    return F.regexp_replace(_c(col), MENTION_PATTERN, " ")


def squeeze_spaces(col) -> Column:
    """three spaces -> one, then two -> one; one pass each, no trim."""
    return F.replace(F.replace(_c(col), F.lit("   "), F.lit(" ")), F.lit("  "), F.lit(" "))


def clean_text(col) -> Column:
    """F1 -> F2 -> F3 -> F4; NULL stays NULL.

    As one nested expression the URL-stripped text is an input of three
    sub-expressions of F2; prefer :func:`with_clean_text` on a DataFrame,
    which stages it so every regex runs once per row.
    """
    return squeeze_spaces(remove_mentions(split_hashtags(remove_urls(col))))


def with_clean_text(df: DataFrame, src: str = "text", out: str = "cleaned_text") -> DataFrame:
    """F5 as staged projections: URL strip, then tag split/extract, then the
    rest.  Catalyst does not collapse a projection whose non-trivial alias
    is read more than once, so each stage is evaluated once per row."""
    tmp = ("_cl_u", "_cl_p", "_cl_t")
    s1 = df.withColumn(tmp[0], remove_urls(src))
    s2 = s1.withColumns({tmp[1]: F.split(tmp[0], "#" + WORD + "+", -1),
                         tmp[2]: F.regexp_extract_all(tmp[0], F.lit(HASHTAG_PATTERN), 1)})
    split_tags = F.transform(tmp[2], lambda t: F.regexp_replace(t, CAMEL_BOUNDARY, "$1 $2"))
    tail = F.slice(tmp[1], 2, F.greatest(F.size(tmp[1]) - 1, F.lit(0)))
    glued = F.concat(F.element_at(tmp[1], 1), F.array_join(F.zip_with(split_tags, tail, lambda t, p: F.concat(t, p)), ""))
    h = F.when(F.col(tmp[0]).isNull(), F.lit(None)).otherwise(glued)
    return s2.withColumn(out, squeeze_spaces(remove_mentions(h))).drop(*tmp)


def tokens(col) -> Column:
    """lower-cased unigrams of two or more word characters (the
    maximal runs of word characters, found by splitting on non-word runs)."""
    parts = F.split(F.lower(_c(col)), r"[^\p{L}\p{N}_]+", -1)
    return F.filter(parts, lambda x: F.length(x) >= 2)


def strip_fence(col) -> Column:
    """drop Markdown code fences and surrounding whitespace."""
    return F.btrim(F.replace(F.replace(_c(col), F.lit(JSON_FENCE), F.lit("")),
                             F.lit(FENCE), F.lit("")), F.lit(WHITESPACE))


def char_length(col) -> Column:
    """length in code points."""
    return F.char_length(_c(col)).cast("bigint")
