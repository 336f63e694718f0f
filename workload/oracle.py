"""SQL counterparts of the queries, for DuckDB on the same tables."""

from __future__ import annotations

from workload.inputs import LEXICON

# Patterns of the cleaning rules, written out here so that the SQL does not lean on the engine's code.
_SPACE = r"\s\p{Z}\x1c-\x1f\x85"
URL = rf"http[^{_SPACE}]+|www[^{_SPACE}]+|https[^{_SPACE}]+"
SPECIAL = rf"[^A-Za-zåäöÅÄÖ{_SPACE}]"
DIGITS = r"\p{Nd}+"
SPACES = rf"[{_SPACE}]+"


def _replace(text: str, pattern: str, by: str = "") -> str:
    return f"regexp_replace({text}, '{pattern}', '{by}', 'g')"


def _clean(text: str, urls=True, special=True, digits=True) -> str:
    out = f"lower({text})"
    if urls:
        out = _replace(out, URL)
    if special:
        out = _replace(out, SPECIAL)
    if digits:
        out = _replace(out, DIGITS)
    return f"trim({_replace(out, SPACES, ' ')})"


def _words(text: str) -> str:
    return f"list_filter(string_split({_clean(text)}, ' '), lambda w: w <> '')"


TURNS = """
turns AS (
  SELECT conv_id * 1000 + turn AS tweet_id, text, role AS batch_name FROM conversations)"""

LINES = """
lines AS (
  SELECT doc_id, unnest(string_split(text, chr(10))) AS text,
         generate_subscripts(string_split(text, chr(10)), 1) - 1 AS unit_no
  FROM documents)"""


def _pairs(units: str, key: str, kmin: int = 2, kmax: int = 10) -> str:
    """CTE ``pairs`` from a relation with ``key`` and a list ``ws``."""
    return f"""
starts AS (
  SELECT {key}, ws, unnest(range(0, len(ws) - {kmin - 1})) AS pos
  FROM {units} WHERE len(ws) >= {kmin}),
windows AS (
  SELECT {key}, ws, pos, unnest(range({kmin}, least({kmax}, len(ws) - pos) + 1)) AS k FROM starts),
pairs AS (
  SELECT {key}, CAST(k AS INTEGER) AS window_size, pos, ws[pos + 1] AS a, ws[pos + k] AS b
  FROM windows)"""


COUNT = """
SELECT window_size, least(a, b) AS word1, greatest(a, b) AS word2, count(*) AS word_count
FROM pairs GROUP BY ALL"""


def _turn_pairs(where: str = "true", kmin: int = 2, kmax: int = 10) -> str:
    return f"""
WITH {TURNS},
spoken AS (SELECT tweet_id, {_words('text')} AS ws FROM turns WHERE {where}),
{_pairs('spoken', 'tweet_id', kmin, kmax)}
{COUNT}"""


LINE_PAIRS = f"""
WITH {LINES},
spoken AS (SELECT doc_id, unit_no, {_words('text')} AS ws FROM lines),
{_pairs('spoken', 'doc_id, unit_no')}"""

RECORD_PAIRS = f"""
WITH spoken AS (SELECT doc_id, 0 AS unit_no, {_words('text')} AS ws FROM documents),
{_pairs('spoken', 'doc_id, unit_no')}"""

_LITERAL_UNITS = """,
placed AS (
  SELECT *, least(a, b) AS lo, greatest(a, b) AS hi FROM pairs),
turned AS (
  SELECT *, CASE WHEN lag(a) OVER (
      PARTITION BY doc_id, unit_no, window_size, lo, hi ORDER BY pos) <> a
    THEN 1 ELSE 0 END AS turn
  FROM placed),
per_unit AS (
  SELECT window_size, lo, hi, count(*) AS n, sum(turn) AS turns,
         arg_max(a, pos) AS word1, arg_max(b, pos) AS word2
  FROM turned GROUP BY doc_id, unit_no, window_size, lo, hi)"""

LITERAL = LINE_PAIRS + _LITERAL_UNITS

LITERAL_COUNT = """
SELECT window_size, word1, word2, CAST(CASE WHEN lo = hi THEN n - 1 ELSE 0 END AS INTEGER) AS doublings,
       CAST(sum(CASE WHEN lo = hi THEN 1 ELSE n - turns END) AS BIGINT) AS word_count
FROM per_unit GROUP BY ALL"""

_LEXICON = ", ".join(
    f"('{form}', {'NULL' if lemma is None else repr(lemma)})" for form, lemma in LEXICON
)

LEMMAS = f"""
WITH {TURNS},
lexicon AS (
  SELECT form, min(lemma) AS lemma, true AS known
  FROM (VALUES {_LEXICON}) AS t(form, lemma) GROUP BY form),
spoken AS (SELECT tweet_id, {_words('text')} AS ws FROM turns),
forms AS (
  SELECT tweet_id, unnest(ws) AS form, generate_subscripts(ws, 1) AS pos FROM spoken),
found AS (
  SELECT tweet_id, pos, CASE WHEN known THEN lemma ELSE forms.form END AS lemma
  FROM forms LEFT JOIN lexicon USING (form)),
lemmas AS (
  SELECT tweet_id, string_agg(lemma, ' ' ORDER BY pos) AS lemmas
  FROM found WHERE lemma <> '' GROUP BY tweet_id)"""

HASHTAGS = """
hashtags AS (
  SELECT l_orderkey AS tweet_id, p_brand AS hashtag
  FROM lineitem JOIN part ON l_partkey = p_partkey)"""

EDGES = f"""
{HASHTAGS},
tags AS (SELECT DISTINCT tweet_id, lower(hashtag) AS hashtag FROM hashtags),
edges AS (
  SELECT x.hashtag AS hashtag1, y.hashtag AS hashtag2, count(*) AS weight
  FROM tags x JOIN tags y ON x.tweet_id = y.tweet_id AND x.hashtag < y.hashtag
  GROUP BY ALL)"""

FETCH = """
SELECT o_orderkey AS tweet_id, hashtag, o_custkey AS author_id, o_orderdate AS created_at,
       o_orderpriority AS batch_name
FROM hashtags JOIN orders ON tweet_id = o_orderkey"""

SET_PAIRS = f"""
WITH {HASHTAGS},
tags AS (SELECT DISTINCT tweet_id, lower(hashtag) AS hashtag FROM hashtags)
SELECT x.tweet_id, x.hashtag AS hashtag1, y.hashtag AS hashtag2
FROM tags x JOIN tags y ON x.tweet_id = y.tweet_id AND x.hashtag < y.hashtag"""

POSTS = """
posts AS (
  SELECT o_orderkey AS tweet_id, o_custkey AS conversation_id,
    CASE WHEN o_orderkey % 13 <> 0 AND o_orderkey % 11 <> 0 THEN o_custkey END AS author_id,
    o_orderstatus || ' ' || o_orderpriority AS text,
    CASE WHEN o_orderkey % 5 = 0 THEN 0 ELSE CAST(floor(o_totalprice) AS INTEGER) END
      AS retweet_count,
    CASE WHEN o_orderkey % 5 = 0 OR o_orderkey % 2 = 0 THEN 0 ELSE 7 END AS reply_count,
    CASE WHEN o_orderkey % 5 = 0 THEN 0 ELSE CAST(o_orderkey % 100 AS INTEGER) END AS like_count,
    0 AS quote_count, o_orderdate AS created_at, o_orderpriority AS batch_name
  FROM orders)"""

# Hashtags of the nested posts, one row per tag.
POST_TAGS = """
post_tags AS (
  SELECT o_orderkey AS tweet_id, 'batch_name=' || o_orderpriority AS batch_name,
         o_orderkey % 13 <> 0 AND o_orderkey % 11 <> 0 AS has_author,
         unnest([o_orderstatus, lower(o_orderstatus), substring(o_orderpriority, 3, 20),
                 'Cust' || (o_custkey % 40), 'Month' || month(o_orderdate)]) AS hashtag
  FROM orders WHERE o_orderkey % 7 <> 0 AND o_orderkey % 9 <> 0)"""

NEXT_FIT = """
WITH RECURSIVE items AS (
  SELECT doc_id, source, n_chars, row_number() OVER (PARTITION BY source ORDER BY doc_id) AS rn
  FROM documents),
fit AS (
  SELECT doc_id, source, n_chars, rn, n_chars AS total,
         CASE WHEN n_chars > 20480 THEN 2 ELSE 1 END AS batch_index
  FROM items WHERE rn = 1
  UNION ALL
  SELECT i.doc_id, i.source, i.n_chars, i.rn,
         CASE WHEN f.total + i.n_chars > 20480 THEN i.n_chars ELSE f.total + i.n_chars END,
         f.batch_index + CASE WHEN f.total + i.n_chars > 20480 THEN 1 ELSE 0 END
  FROM fit f JOIN items i ON i.source = f.source AND i.rn = f.rn + 1)
SELECT doc_id, source, n_chars, batch_index, source || batch_index AS batch_name FROM fit"""

REGISTERED = """
WITH names AS (
  SELECT DISTINCT source AS batch_name,
         CAST(regexp_extract(source, '([0-9]+)$', 1) AS INTEGER) AS number
  FROM documents),
registered AS (
  SELECT batch_name,
         CASE WHEN number % 2 = 0 THEN 'NEW' WHEN number % 3 = 0 THEN 'SUCCESS' ELSE 'FAILED' END
           AS batch_status
  FROM names WHERE number < 15 OR number % 2 = 0)"""

_LINE = "l_linenumber, l_partkey, l_suppkey, l_shipdate, l_extendedprice"
DUPLICATES = f"""
SELECT l_orderkey, {_LINE},
       rank() OVER (PARTITION BY l_orderkey ORDER BY {_LINE}) > 1 AS is_duplicate
FROM lineitem"""

ORACLE: dict[str, str] = {
    "clean_documents": f"SELECT doc_id, {_clean('text')} AS cleaned FROM documents",
    "clean_page_urls": f"""
SELECT page_id, {_clean('url')} AS cleaned,
       {_clean('url', urls=False)} AS with_urls,
       {_clean('url', urls=False, special=False)} AS with_special,
       {_clean('url', urls=False, special=False, digits=False)} AS with_digits
FROM pages""",
    "token_counts": f"""
SELECT doc_id,
       len(list_filter(regexp_split_to_array(text, '{SPACES}'), lambda w: w <> '')) AS raw_tokens,
       len({_words('text')}) AS clean_tokens
FROM documents""",
    "document_lines": f"WITH {LINES} SELECT doc_id, unit_no, text FROM lines",
    "lemmas": f"{LEMMAS} SELECT tweet_id, lemmas FROM lemmas",
    "endpoint_pairs": f"""
WITH {TURNS},
spoken AS (SELECT tweet_id, {_words('text')} AS ws FROM turns),
{_pairs('spoken', 'tweet_id')}
SELECT tweet_id, window_size, pos, a, b FROM pairs""",
    "pairs_by_line": LINE_PAIRS + COUNT,
    "pairs_by_record": _turn_pairs(kmin=3, kmax=4),
    "pairs_literal": LITERAL + LITERAL_COUNT,
    "pairs_literal_overflow": f"""{LITERAL}
SELECT window_size, lo AS word, n, count(*) AS units
FROM per_unit WHERE lo = hi AND n > 31 GROUP BY ALL""",
    "batch_pairs": _turn_pairs("batch_name = 'assistant'"),
    "lemmatised_pairs": f"""{LEMMAS},
units AS (SELECT tweet_id, string_split(lemmas, ' ') AS ws FROM lemmas),
{_pairs('units', 'tweet_id')}
{COUNT}""",
    "unpack_tweets": f"WITH {POSTS} SELECT * FROM posts",
    "unpack_hashtags": f"WITH {POST_TAGS} SELECT tweet_id, hashtag FROM post_tags",
    "read_tweets": f"WITH {POSTS} SELECT tweet_id, text, like_count, "
    "'batch_name=' || batch_name AS batch_name FROM posts",
    "bad_rows": """
SELECT o_orderkey AS tweet_id,
       CASE WHEN o_orderkey % 13 = 0 THEN 'author_id does not fit' ELSE 'author_id missing' END
         AS reasons
FROM orders WHERE o_orderkey % 13 = 0 OR o_orderkey % 11 = 0""",
    "bad_hashtags": "SELECT doc_id AS tweet_id, 'hashtag does not fit' AS reasons "
    "FROM documents WHERE length(text) > 255",
    "bad_rows_every_rule": """
SELECT o_orderkey::VARCHAR AS key, array_to_string(list_filter([
         CASE WHEN o_orderkey % 17 = 0 AND o_orderkey % 19 <> 0 THEN 'tweet_id missing' END,
         CASE WHEN o_orderkey % 19 = 0 THEN 'tweet_id does not fit' END,
         CASE WHEN o_orderkey % 13 = 0 AND o_orderkey % 11 <> 0 THEN 'author_id missing' END,
         CASE WHEN o_orderkey % 11 = 0 THEN 'author_id does not fit' END,
         CASE WHEN o_orderkey % 7 = 0 THEN 'conversation_id does not fit' END,
         CASE WHEN o_orderkey % 5 = 0 THEN 'created_at does not fit' END], lambda x: x IS NOT NULL), ';') AS reasons
FROM orders
WHERE o_orderkey % 17 = 0 OR o_orderkey % 19 = 0 OR o_orderkey % 13 = 0 OR o_orderkey % 11 = 0
   OR o_orderkey % 7 = 0 OR o_orderkey % 5 = 0""",
    "bad_hashtags_every_rule": """
SELECT doc_id AS key, array_to_string(list_filter([
         CASE WHEN doc_id % 7 = 0 THEN 'tweet_id missing' END,
         CASE WHEN doc_id % 3 = 0 OR text IS NULL THEN 'hashtag missing' END,
         CASE WHEN doc_id % 3 <> 0 AND length(text) > 255 THEN 'hashtag does not fit' END], lambda x: x IS NOT NULL), ';')
         AS reasons
FROM documents WHERE doc_id % 7 = 0 OR doc_id % 3 = 0 OR text IS NULL OR length(text) > 255""",
    "dup_tweets": DUPLICATES,
    "stored_dup_tweets": f"""
WITH marked AS ({DUPLICATES})
SELECT l_orderkey, {_LINE} FROM marked
WHERE NOT is_duplicate AND l_orderkey NOT IN (
  SELECT o_orderkey FROM orders WHERE o_orderstatus = 'F')""",
    "orphans": f"""
WITH {HASHTAGS}
SELECT tweet_id, hashtag FROM hashtags
WHERE tweet_id NOT IN (SELECT o_orderkey FROM orders WHERE o_orderpriority <> '5-LOW')""",
    "ingest_tweets": f"WITH {TURNS} SELECT tweet_id, text FROM turns",
    "ingest_hashtags": f"""
WITH {POST_TAGS} SELECT tweet_id, hashtag, batch_name FROM post_tags WHERE has_author""",
    "ingest_twice": f"""
WITH {TURNS}
SELECT tweet_id, text, 'batch_name=' || CASE WHEN tweet_id % 2 = 0 THEN 'first' ELSE 'second' END AS batch_name
FROM turns""",
    "stored_batch_cycle": f"""
WITH {TURNS}
SELECT tweet_id, text, CASE WHEN tweet_id % 2 = 0 THEN 'NONE' ELSE 'batch_name=second' END AS batch_name FROM turns""",
    "stored_batch_states": """
SELECT * FROM (VALUES ('batch_name=first', 'NEW'), ('batch_name=second', 'FAILED')) AS t(batch_name, batch_status)""",
    "stored_cycle_pairs": _turn_pairs("tweet_id % 2 = 0"),
    "ingested_batch_text": f"WITH {TURNS} SELECT tweet_id, text FROM turns WHERE tweet_id % 2 = 0",
    "ingested_batches": """
SELECT 'batch_name=' || unnest(['first', 'second']) AS batch_name, 'NEW' AS batch_status""",
    "next_fit_batches": NEXT_FIT,
    "batches_of_folder": r"""
SELECT DISTINCT source AS batch_name FROM documents
WHERE regexp_full_match(source, 'src[0-9]+')""",
    "max_batch_index": """
SELECT coalesce(max(CAST(regexp_extract(source, '^src([0-9]+)$', 1) AS INTEGER)), 0) AS max_index
FROM documents WHERE regexp_full_match(source, 'src[0-9]+')""",
    "register_batches": f"{REGISTERED} SELECT batch_name, batch_status FROM registered",
    "new_batches": f"{REGISTERED} SELECT batch_name FROM registered WHERE batch_status = 'NEW'",
    "set_batch_status": f"""{REGISTERED}
SELECT batch_name,
       CASE WHEN batch_name = 'src2' THEN 'PROCESSING' ELSE batch_status END AS batch_status
FROM registered""",
    "release_batch": """
SELECT doc_id AS tweet_id, CASE WHEN source = 'src7' THEN 'NONE' ELSE source END AS batch_name
FROM documents""",
    "batch_text": f"WITH {TURNS} SELECT tweet_id, text FROM turns WHERE batch_name = 'user'",
    "hashtag_fetch": f"""WITH {HASHTAGS} {FETCH}
WHERE o_orderpriority = '1-URGENT'
  AND o_orderdate BETWEEN TIMESTAMP '1996-01-01' AND TIMESTAMP '1998-12-31'""",
    "hashtag_fetch_all": f"WITH {HASHTAGS} {FETCH}",
    "multi_hashtag_tweets": f"""
WITH {HASHTAGS}
SELECT tweet_id, hashtag FROM hashtags
WHERE tweet_id IN (SELECT tweet_id FROM hashtags GROUP BY tweet_id HAVING count(*) > 1)""",
    "hashtag_sets": f"""
WITH {HASHTAGS},
sets AS (
  SELECT tweet_id, list_sort(list_distinct(list(lower(hashtag)))) AS tags
  FROM hashtags GROUP BY tweet_id)
SELECT tweet_id, array_to_string(tags, ',') AS hashtags FROM sets WHERE len(tags) > 1""",
    "set_pairs": SET_PAIRS,
    "hashtag_pairs": SET_PAIRS,
    "cooccurrence": f"WITH {EDGES} SELECT * FROM edges",
    "reset_and_fill": f"WITH {EDGES} SELECT *, '110' AS there, CAST(0 AS BIGINT) AS batches FROM edges",
    "hashtag_network": f"""
WITH {HASHTAGS},
tags AS (
  SELECT DISTINCT tweet_id, lower(hashtag) AS hashtag FROM hashtags JOIN orders
  ON tweet_id = o_orderkey AND o_orderdate BETWEEN TIMESTAMP '1997-01-01' AND TIMESTAMP '1999-12-31')
SELECT x.hashtag AS hashtag1, y.hashtag AS hashtag2, count(*) AS weight
FROM tags x JOIN tags y ON x.tweet_id = y.tweet_id AND x.hashtag < y.hashtag GROUP BY ALL""",
    "network_edges": f"""
WITH {EDGES}
SELECT hashtag1 AS from_actor, 'HT' AS from_layer, hashtag2 AS to_actor, 'HT' AS to_layer, weight
FROM edges""",
    "network_vertices": f"""
WITH {EDGES}
SELECT hashtag1 AS actor, 'HT' AS layer FROM edges
UNION SELECT hashtag2, 'HT' FROM edges""",
    "stored_cooccurrence": f"WITH {EDGES} SELECT * FROM edges",
    "merge_add_pairs": _turn_pairs(),
    "merge_add_edges": f"WITH {EDGES} SELECT * FROM edges",
    "merge_add_one_edge": f"""
WITH {EDGES}
SELECT hashtag1, hashtag2, CAST(sum(weight) AS BIGINT) AS weight
FROM (SELECT * FROM edges UNION ALL SELECT 'brand#1', 'brand#2', 5) GROUP BY ALL""",
    "stored_merge_pairs": _turn_pairs(),
    "stored_merge_edges": f"""
WITH {EDGES}
SELECT hashtag1, hashtag2, CAST(sum(weight) AS BIGINT) AS weight
FROM (SELECT * FROM edges UNION ALL SELECT 'brand#1', 'brand#2', 5) GROUP BY ALL""",
    "stream_pairs": _turn_pairs(),
    "stream_pairs_literal": RECORD_PAIRS + _LITERAL_UNITS + LITERAL_COUNT,
    "stream_batch_status": """
SELECT DISTINCT 'batch_name=' || role AS batch_name, 'SUCCESS' AS batch_status
FROM conversations""",
    "stream_cooccurrence": f"""
WITH {POST_TAGS},
tags AS (
  SELECT DISTINCT tweet_id, lower(hashtag) AS hashtag FROM post_tags WHERE has_author)
SELECT x.hashtag AS hashtag1, y.hashtag AS hashtag2, count(*) AS weight
FROM tags x JOIN tags y ON x.tweet_id = y.tweet_id AND x.hashtag < y.hashtag
GROUP BY ALL""",
    "running_pairs": _turn_pairs(),
}
