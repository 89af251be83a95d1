"""DuckDB SQL fragments for the oracle side of every registered query.

Each oracle is a single ``WITH … SELECT`` statement over the driver's
pre-registered views.  The derived views (messages, channels, posts, …)
are restated here as CTEs with the same rules as ``canopy.sources``.
"""

from __future__ import annotations

from canopy.functions.text import (CAMEL_BOUNDARY, HASHTAG_PATTERN, MENTION_PATTERN, TOKEN_PATTERN,
                                   URL_PATTERN, WORD)


def q(s: str) -> str:
    """SQL string literal."""
    return "'" + s.replace("'", "''") + "'"


SRC = """src AS (
  WITH d AS (
    SELECT doc_id, text AS body, lang, cp,
           CASE WHEN cp = 2 THEN 'repost' ELSE source END AS channel_name,
           CASE doc_id % 10 WHEN 6 THEN 'audio' WHEN 7 THEN 'video' WHEN 8 THEN 'text'
                            WHEN 9 THEN 'web_page' ELSE 'image' END AS msg_type
    FROM documents CROSS JOIN (SELECT 0 AS cp UNION ALL SELECT 1 UNION ALL SELECT 2) AS c
    WHERE cp = 0 OR (cp = 1 AND doc_id % 7 = 0) OR (cp = 2 AND doc_id % 11 = 0))
  SELECT doc_id AS message_id, channel_name,
         concat(channel_name, '_', CAST(doc_id AS VARCHAR)) AS custom_id,
         concat(body, ' https://ex.org/', CAST(doc_id AS VARCHAR), ' #GutenMorgen #ÄrzteBlatt @',
                channel_name, '     ende') AS text,
         lang, msg_type,
         CAST('2024-10-01 00:00:00' AS TIMESTAMP) + doc_id * INTERVAL '1' HOUR + cp * INTERVAL '1' MINUTE
           AS msg_date_dt,
         CASE WHEN msg_type IN ('image', 'audio') THEN CAST(900000 + doc_id AS VARCHAR) END AS media_id,
         CASE WHEN msg_type = 'image' AND doc_id % 50 <> 0
              THEN substr(md5(CAST(doc_id % 390 AS VARCHAR)), 1, 16) END AS dhash
  FROM d)"""


def hashtag_sql(expr: str) -> str:
    """F2 in DuckDB: split at tags, camel-split each tag, re-interleave."""
    parts = f"regexp_split_to_array({expr}, {q('#' + WORD + '+')})"
    tags = f"regexp_extract_all({expr}, {q(HASHTAG_PATTERN)}, 1)"
    camel = f"regexp_replace(list_extract(_t, i), {q(CAMEL_BOUNDARY)}, '\\1 \\2', 'g')"
    return (f"(SELECT list_extract(_p, 1) || array_to_string(list_transform(range(1, len(_t) + 1), "
            f"lambda i: {camel} || list_extract(_p, i + 1)), '') "
            f"FROM (SELECT {parts} AS _p, {tags} AS _t))")


def clean_sql(expr: str) -> str:
    """F5 in DuckDB over a column expression (NULL in -> NULL out)."""
    u = f"regexp_replace({expr}, {q(URL_PATTERN)}, '', 'g')"
    h = hashtag_sql(u)
    m = f"regexp_replace({h}, {q(MENTION_PATTERN)}, ' ', 'g')"
    return f"CASE WHEN {expr} IS NULL THEN NULL ELSE replace(replace({m}, '   ', ' '), '  ', ' ') END"


def url_sql(expr: str) -> str:
    return f"regexp_replace({expr}, {q(URL_PATTERN)}, '', 'g')"


def mention_sql(expr: str) -> str:
    return f"regexp_replace({expr}, {q(MENTION_PATTERN)}, ' ', 'g')"


def tokens_sql(expr: str) -> str:
    return f"regexp_extract_all(lower({expr}), {q(TOKEN_PATTERN)}, 0)"


CLEAN = f"""clean AS (SELECT *, {clean_sql('text')} AS cleaned_text FROM src)"""

ORDER = "msg_date_dt, custom_id"

IMG = """img AS (
  SELECT * REPLACE (coalesce(cleaned_text, '') AS cleaned_text) FROM clean WHERE msg_type = 'image')"""

PREPARED = IMG + f""",
prepared AS (
  SELECT * FROM img WHERE length(cleaned_text) > 0
  QUALIFY row_number() OVER (PARTITION BY custom_id ORDER BY {ORDER}) = 1)"""


def keep_first_sql(name: str, source: str, keys: str) -> str:
    return (f"{name} AS (SELECT * FROM {source} "
            f"QUALIFY row_number() OVER (PARTITION BY {keys} ORDER BY {ORDER}) = 1)")


def with_(*ctes: str) -> str:
    return "WITH " + ",\n".join(ctes) + "\n"


STAGE2 = (SRC, CLEAN, PREPARED)

TS_FMT = "'%Y-%m-%d %H:%M:%S'"

CHANNELS = r"""channels AS (
  WITH names AS (SELECT DISTINCT channel_name FROM src
                 UNION ALL SELECT 'silent_channel' UNION ALL SELECT 'invalid_channel'),
  n AS (SELECT channel_name,
               coalesce(TRY_CAST(regexp_extract(channel_name, '(\d+)$', 1) AS BIGINT), 97) AS num FROM names)
  SELECT channel_name,
         CASE WHEN channel_name = 'invalid_channel' THEN -1
              ELSE 1000000 + num * 13 + length(channel_name) END AS channel_id,
         CAST(num * 7919 % 100003 AS VARCHAR) AS access_hash,
         'cat' || CAST(num % 4 AS VARCHAR) AS category,
         num * 101 + 5 AS participant_count,
         'About ' || channel_name AS channel_description
  FROM n)"""

RAW = """raw AS (
  SELECT message_id, channel_name, custom_id, msg_date_dt, lang, msg_type AS src_type,
         CASE WHEN message_id % 19 = 4 THEN NULL WHEN message_id % 23 = 6 THEN '' ELSE text END AS text,
         CASE WHEN msg_type = 'text' THEN NULL WHEN message_id % 13 = 3 THEN 'document'
              WHEN message_id % 17 = 5 THEN 'poll' WHEN msg_type = 'image' THEN 'photo'
              WHEN msg_type IN ('audio', 'video') THEN 'document' ELSE 'webpage' END AS kind,
         CASE WHEN message_id % 13 = 3 THEN 'application/pdf' WHEN msg_type = 'audio' THEN 'audio/ogg'
              ELSE 'video/mp4' END AS mime,
         CASE WHEN message_id % 6 = 0 THEN NULL ELSE message_id * 3 % 1000 END AS views,
         CASE WHEN message_id % 4 = 1 THEN NULL ELSE message_id % 50 END AS forwards,
         CASE WHEN message_id % 29 = 0 THEN message_id % 5 END AS via_bot_id,
         CASE WHEN message_id % 10 = 3 THEN msg_date_dt + INTERVAL 2 HOUR END AS edit_date,
         CASE WHEN message_id % 8 = 5 THEN message_id % 97 END AS fwd_from,
         CASE WHEN message_id % 5 <> 2 THEN message_id % 11 END AS replies,
         CASE WHEN message_id % 9 = 7 THEN message_id - 1 END AS reply_to
  FROM src),
typed AS (
  SELECT * EXCLUDE (t0), t0 AS msg_type,
         CASE WHEN t0 IN ('image', 'audio') THEN CAST(message_id * 7919 % 1000003 AS VARCHAR) END AS access_hash,
         CASE WHEN t0 IN ('image', 'audio') THEN CAST(900000 + message_id AS VARCHAR) END AS media_id
  FROM (SELECT *, CASE WHEN kind IS NULL AND coalesce(text, '') = '' THEN 'service'
                       WHEN kind IS NULL THEN 'text' WHEN kind = 'photo' THEN 'image'
                       WHEN kind = 'document' AND contains(mime, 'audio') THEN 'audio'
                       WHEN kind = 'document' AND contains(mime, 'video') THEN 'video'
                       WHEN kind = 'document' THEN NULL
                       WHEN kind = 'webpage' THEN 'web_page' ELSE 'other' END AS t0 FROM raw))"""

POSTS = """posts AS (
  SELECT 's' || CAST(page_id % 8 AS VARCHAR) AS subreddit, 'p' || CAST(page_id AS VARCHAR) AS post_id,
         regexp_extract(html, '<title>([^<]*)</title>', 1) AS title,
         regexp_extract(html, '<article>.*?<p>([^<]*)', 1) AS selftext,
         1704067200 + page_id * 60 AS created_utc,
         CASE WHEN page_id % 9 = 0 THEN NULL ELSE 'u' || CAST(page_id % 17 AS VARCHAR) END AS author_name,
         page_id * 37 % 101 AS score, page_id % 13 AS num_comments,
         url || CASE page_id % 4 WHEN 0 THEN '/a.jpg' WHEN 1 THEN '/gallery/x' WHEN 2 THEN '/gallery.png'
                ELSE '' END AS url,
         CASE WHEN page_id % 5 = 0 THEN NULL ELSE 'flair' || CAST(page_id % 3 AS VARCHAR) END AS flair,
         page_id
  FROM pages)"""

IS_IMAGE = "(suffix(url, 'jpg') OR suffix(url, 'png') OR suffix(url, 'jpeg'))"
IS_GALLERY = "contains(url, 'gallery')"

GALLERY_ITEMS = """gitems AS (
  SELECT subreddit, post_id, page_id, idx,
         post_id || 'm' || CAST(idx AS VARCHAR) AS media_id,
         CASE WHEN page_id % 7 = 1 AND idx = page_id % 4 THEN NULL
              ELSE 'https://i.ex/' || post_id || 'm' || CAST(idx AS VARCHAR) || '.jpg' END AS url,
         subreddit || '_' || post_id || '_gallery_' || CAST(idx AS VARCHAR) || '.png' AS file_name
  FROM (SELECT *, unnest(range(0, page_id % 4 + 1)) AS idx FROM posts WHERE contains(url, 'gallery')))"""

STATUS = f"""status AS (
  SELECT p.post_id,
         CASE WHEN {IS_GALLERY.replace('url', 'p.url')} THEN CASE WHEN g.ok THEN 'success' ELSE 'failed' END
              WHEN {IS_IMAGE.replace('url', 'p.url')} THEN CASE WHEN p.page_id % 3 <> 0 THEN 'success' ELSE 'failed' END
              ELSE 'no image' END AS download_status
  FROM posts p LEFT JOIN (
    SELECT post_id, bool_and(url IS NOT NULL AND (page_id + idx) % 5 <> 0) AS ok FROM gitems GROUP BY post_id) g
  ON p.post_id = g.post_id)"""


def topic_ctes(docs_sql: str, assign_sql: str) -> tuple[str, ...]:
    """CTEs ``docs(doc_key, text)``, ``assign(doc_key, topic)``, ``dterms``,
    ``counts``, ``weights`` (c-TF-IDF), ``sim`` (doc-topic cosine)."""
    return (
        f"docs AS ({docs_sql})",
        f"assign AS ({assign_sql})",
        f"""dterms AS (SELECT doc_key, term, count(*) AS n
                   FROM (SELECT doc_key, unnest({tokens_sql('text')}) AS term FROM docs) GROUP BY doc_key, term)""",
        """counts AS (SELECT a.topic, d.term, CAST(sum(d.n) AS BIGINT) AS n FROM dterms d JOIN assign a USING (doc_key)
                   GROUP BY a.topic, d.term)""",
        """pt AS (SELECT topic, sum(n) AS tw FROM counts GROUP BY topic)""",
        """fr AS (SELECT term, sum(n) AS f FROM counts GROUP BY term)""",
        """weights AS (SELECT c.topic, c.term, c.n, c.n / pt.tw AS tf,
                      ln((SELECT floor(avg(tw)) FROM pt) / fr.f + 1) AS idf,
                      c.n / pt.tw * ln((SELECT floor(avg(tw)) FROM pt) / fr.f + 1) AS ctfidf
                   FROM counts c JOIN pt USING (topic) JOIN fr USING (term))""",
        """dlen AS (SELECT doc_key, sum(n) AS len FROM dterms GROUP BY doc_key)""",
        """dv AS (SELECT d.doc_key, a.topic, d.term, d.n / l.len * i.idf AS w
                 FROM dterms d JOIN dlen l USING (doc_key) JOIN (SELECT DISTINCT term, idf FROM weights) i USING (term)
                 JOIN assign a USING (doc_key))""",
        """sim AS (SELECT x.doc_key, x.topic, x.dot / (dn.v * tn.v) AS similarity FROM
                   (SELECT dv.doc_key, dv.topic, sum(dv.w * w.ctfidf) AS dot FROM dv JOIN weights w USING (topic, term)
                    GROUP BY dv.doc_key, dv.topic) x
                   JOIN (SELECT doc_key, sqrt(sum(w * w)) AS v FROM dv GROUP BY doc_key) dn USING (doc_key)
                   JOIN (SELECT topic, sqrt(sum(ctfidf * ctfidf)) AS v FROM weights GROUP BY topic) tn USING (topic))""",
        """top AS (SELECT * FROM (SELECT topic, term, ctfidf,
                   row_number() OVER (PARTITION BY topic ORDER BY round(ctfidf, 8) DESC, term) AS rank FROM weights)
                   WHERE rank <= 10)""",
        """rdocs AS (SELECT * FROM (SELECT doc_key, topic, similarity,
                   row_number() OVER (PARTITION BY topic ORDER BY round(similarity, 8) DESC, doc_key) AS rank FROM sim)
                   WHERE rank <= 3)""",
        """rep AS (SELECT topic, list(term ORDER BY rank) AS representation,
                   CAST(topic AS VARCHAR) || '_' || array_to_string(list(term ORDER BY rank)[1:4], '_') AS name
                   FROM top GROUP BY topic)""",
    )
