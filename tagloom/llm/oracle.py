"""DuckDB SQL for the queries that SQL can express."""

import functools

_WORD = r"[^\x20\x09-\x0D]+"

_EXACT = r"""
WITH d AS (
    SELECT doc_id, regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]+', ' ', 'g') AS norm FROM documents
)
SELECT doc_id, min(doc_id) OVER same AS keep_id, count(*) OVER same AS group_size,
       doc_id = min(doc_id) OVER same AS kept, sha256(norm) AS text_sha256
FROM d WINDOW same AS (PARTITION BY norm)
"""


def _draw(name: str, weight: int) -> str:
    bits = f"('0x' || substr(md5(coalesce(doc_id::VARCHAR, 'null') || '/{name}'), 1, 13))::BIGINT"
    return f"-ln(({bits} + 0.5) / 4503599627370496.0) / {weight}"


def _race(children: dict[str, int]) -> str:
    draws = ", ".join(f"{{'draw': {_draw(n, w)}, 'name': '{n}'}}" for n, w in children.items())
    return f"list_min([{draws}]).name"


# DuckDB has no checksum function: half a byte at a time, with the table of the reversed polynomial.
_CRC32 = """
xor(list_reduce(list_prepend(4294967295::BIGINT, list_transform(range(0, strlen(h)),
        lambda j: ('0x' || substr(h, j + 2 - 2 * (j % 2), 1))::BIGINT)),
    lambda c, b: xor(half[(xor(c, b) & 15) + 1], c >> 4)), 4294967295)
"""
_HALF = "[" + ", ".join(
    f"{functools.reduce(lambda c, _: c >> 1 ^ (0xEDB88320 if c & 1 else 0), range(4), n)}::BIGINT" for n in range(16)
) + "]"

_SHARDS = f"""
WITH texts AS (
    SELECT doc_id, coalesce(text, '') AS t, hex(encode(t)) AS h, {_HALF} AS half FROM documents
), a AS (
    SELECT doc_id, (strlen(t) + 1)::BIGINT AS size, {_CRC32} AS text_crc32,
           {_race({"r0": 4, "r1": 4})} AS region, {_race({"r0": 4, "r1": 4, "r-8": 1})} AS grown_region
    FROM texts
), b AS (
    SELECT *, CASE region WHEN 'r0' THEN {_race({"k0": 2, "k1": 2})} ELSE {_race({"k2": 2, "k3": 2})} END AS rack,
    FROM a
), c AS (
    SELECT *, (CASE rack {" ".join(f"WHEN 'k{k}' THEN {_race({str(2 * k): 1, str(2 * k + 1): 1})}" for k in range(4))}
              END)::INTEGER AS shard
    FROM b
)
SELECT doc_id, size, text_crc32, 'key' AS law, region, rack, shard,
       row_number() OVER (PARTITION BY shard ORDER BY doc_id) - 1 AS slot,
       CASE grown_region WHEN 'r-8' THEN 8 ELSE shard END AS grown_shard
FROM c
"""

# Schedules by number, as (start, share met by then, density, slope); see mixing.SCHEDULES.
_MIX = r"""
WITH d AS (
    SELECT doc_id, source, len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+'))::BIGINT AS size,
           ('0x' || substr(md5('mix/' || coalesce(doc_id::VARCHAR, 'null')), 1, 13))::BIGINT AS h
    FROM documents
), r AS (
    SELECT *, [5, 2, 1][(rank % 3 + 1)::INTEGER] AS weight, 2 * source_size AS cap
    FROM (SELECT source, sum(size)::BIGINT AS source_size, row_number() OVER (ORDER BY source NULLS LAST) - 1 AS rank
          FROM d GROUP BY source)
), l AS (
    SELECT *, (3 * sum(source_size) OVER ()
               - 2 * coalesce(sum(cap) OVER (o ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0))::DOUBLE
              / (2 * sum(weight) OVER (o ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING))::DOUBLE AS level
    FROM r WINDOW o AS (ORDER BY cap::DOUBLE / weight, rank)
), t AS (
    SELECT source, rank, source_size, least(cap::DOUBLE, max(level) OVER () * weight) AS target FROM l
), b AS (
    SELECT d.doc_id, d.size, t.*, coalesce(sum(size) OVER (PARTITION BY d.source ORDER BY h, doc_id, size
               ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0)::BIGINT AS before
    FROM d JOIN t ON d.source IS NOT DISTINCT FROM t.source
), c AS (
    SELECT *, CASE WHEN source_size > 0 AND 2 * target - 2 * before - size >= 0
                   THEN least(floor((2 * target - 2 * before - size) / (2 * source_size)) + 1, 2) ELSE 0 END::BIGINT AS copies,
           least((before + size / 2) / target, 1.0) AS share, rank % 3 AS schedule
    FROM b
), s AS (
    SELECT *, CASE schedule WHEN 0 THEN [0.0, 0.0, 1.0, 0.0]
                            WHEN 1 THEN CASE WHEN share >= {1} THEN [0.5, {1}, {2}, {3}] ELSE [0.0, 0.0, {2}, 0.0] END
                            ELSE CASE WHEN share >= {4} THEN [0.5, {4}, {2}, 0.0] ELSE [0.0, 0.0, {5}, {6}] END
              END::DOUBLE[] AS k
    FROM c
)
SELECT doc_id, size, source_size, target, size * copies AS taken,
       CASE WHEN copies > 0 THEN least(k[1] + 2.0::DOUBLE * (share - k[2])
            / (k[3] + sqrt(k[3] * k[3] + 2.0::DOUBLE * k[4] * (share - k[2]))), 1.0) END AS first_position
FROM s
"""
for _place, _value in {1: 0.5 / 1.5, 2: 1 / 1.5, 3: 2 / 1.5 / 0.5, 4: 1 / 1.5, 5: 3 / 1.5, 6: -2 / 1.5 / 0.5}.items():
    _MIX = _MIX.replace(f"{{{_place}}}", f"{_value!r}::DOUBLE")

_QUALITY = r"""
WITH d AS (
    SELECT doc_id, row_number() OVER () AS row_no, coalesce(text, '') AS t FROM documents
), w AS (
    SELECT row_no, regexp_extract_all(t, '[^\x20\x09-\x0D]+') AS words FROM d
), windows AS (
    SELECT row_no, i, array_to_string(words[i:i + 4], ' ') AS five
    FROM (SELECT row_no, words, unnest(range(1, len(words) - 3)) AS i FROM w)
), twice AS (
    SELECT row_no, i FROM windows QUALIFY count(*) OVER (PARTITION BY row_no, five) > 1
), repeated AS (
    SELECT row_no, count(DISTINCT place) AS n_repeat_words
    FROM (SELECT row_no, unnest(range(i, i + 5)) AS place FROM twice) GROUP BY row_no
), lines AS (
    SELECT row_no, list_filter(string_split(t, chr(10)), lambda x: regexp_matches(x, '[^\x20\x09-\x0D]')) AS l FROM d
), m AS (
    SELECT doc_id, len(words) AS n_words, length(array_to_string(words, '')) AS word_chars,
           length(t) - length(regexp_replace(t, '[#*$%&|<>]', '', 'g')) AS n_symbols,
           len(l) - len(list_distinct(l)) AS n_dup_lines, coalesce(n_repeat_words, 0) AS n_repeat_words,
           len(l) AS n_lines, length(t) - length(regexp_replace(t, '[A-Z]', '', 'g')) AS n_upper,
           length(t) - length(regexp_replace(t, '[A-Za-z]', '', 'g')) AS n_letters,
           length(t) - length(regexp_replace(t, '[!-@\[-`{-~]', '', 'g')) AS n_marks
    FROM d JOIN w USING (row_no) JOIN lines USING (row_no) LEFT JOIN repeated USING (row_no)
), bits AS (
    SELECT *, (n_words < 10)::BIGINT | (100 * n_repeat_words > 20 * n_words)::BIGINT * 2
           + (100 * n_symbols > 25 * n_words)::BIGINT * 4 + (100 * n_dup_lines > 30 * n_lines)::BIGINT * 8
           + (word_chars < 3 * n_words OR word_chars > 12 * n_words)::BIGINT * 16
           + (n_letters >= 40 AND 2 * n_upper > n_letters)::BIGINT * 32
           + (100 * n_marks > 40 * word_chars)::BIGINT * 64 AS fail_bits
    FROM m
)
SELECT *, (fail_bits & 3) <> 0 AS base_failed, fail_bits = 0 AS kept FROM bits
"""



# op11: parts are (vec_row, p, j, x), codebooks (p, e, j, c); j is a position within a part.
def _assign(book: str) -> str:
    """Each part's nearest entry of ``book``, ties to the lower index."""
    return f"""(
    SELECT vec_row, p, arg_min(e, dist * 64 + e) AS e, min(dist) AS dist FROM (
        SELECT x.vec_row, x.p, b.e, sum((x.x - b.c) * (x.x - b.c)) AS dist
        FROM comps x JOIN {book} b ON x.p = b.p AND x.j = b.j GROUP BY x.vec_row, x.p, b.e
    ) GROUP BY vec_row, p)"""


def _update(book: str, assigned: str) -> str:
    """Used entries become the componentwise floor of their parts' mean; unused ones stay."""
    return f"""(
    SELECT b.p, b.e, b.j, coalesce(n.c, b.c) AS c FROM {book} b LEFT JOIN (
        SELECT p, e, j, ((s - ((s % cnt) + cnt) % cnt) // cnt)::BIGINT AS c FROM (
            SELECT a.p, a.e, x.j, sum(x.x) AS s, count(*) AS cnt
            FROM {assigned} a JOIN comps x USING (vec_row, p) GROUP BY a.p, a.e, x.j
        )
    ) n USING (p, e, j))"""


_CODES = f"""
WITH kept0 AS (
    SELECT row_number() OVER () AS vec_row, vec_id, label,
           list_transform(embedding, lambda x: floor(x::DOUBLE * 256)::BIGINT) AS v
    FROM embeddings
    WHERE embedding IS NOT NULL AND len(embedding) > 0 AND len(embedding) % 16 = 0
      AND len(list_filter(embedding, lambda x: x IS NULL OR isnan(x) OR NOT abs(x) < 4096)) = 0
), first AS (
    SELECT len(v) AS d FROM kept0 ORDER BY vec_id NULLS LAST, v LIMIT 1
), kept AS (
    SELECT kept0.* FROM kept0, first WHERE len(v) = d
), comps AS (
    SELECT vec_row, (i - 1) // (d // 16) AS p, (i - 1) % (d // 16) AS j, v[i] AS x
    FROM (SELECT vec_row, v, generate_subscripts(v, 1) AS i FROM kept), first
), starts AS (
    SELECT vec_row, row_number() OVER (ORDER BY vec_id NULLS LAST, v) - 1 AS e
    FROM kept ORDER BY vec_id NULLS LAST, v LIMIT 64
), book0 AS (
    SELECT x.p, s.e, x.j, x.x AS c FROM starts s JOIN comps x USING (vec_row)
), book1 AS {_update("book0", _assign("book0"))},
book2 AS {_update("book1", _assign("book1"))},
final AS {_assign("book2")},
coded AS (
    SELECT vec_row, string_agg(printf('%02x', e), '' ORDER BY p) AS code, sum(dist)::BIGINT AS error
    FROM final GROUP BY vec_row
)
SELECT vec_id, code, error, (sum(error) OVER (PARTITION BY label))::BIGINT AS label_error,
       (SELECT sha256(string_agg(c::VARCHAR, ',' ORDER BY p, e, j)) FROM book2) AS codebooks_sha256
FROM coded JOIN kept USING (vec_row)
"""

_BENCH_WORDS = r"regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+')"

_LEAKS = f"""
WITH d AS MATERIALIZED (
    SELECT row_number() OVER () AS row_no, doc_id, {_BENCH_WORDS} AS w FROM documents
), b AS (
    SELECT item_id, {_BENCH_WORDS} AS w FROM benchmark
), win AS (
    SELECT DISTINCT item_id, w[i:i + 9] AS win, len(w[i:i + 9]) AS n
    FROM (SELECT item_id, w, unnest(range(1, greatest(len(w) - 9, 1) + 1)) AS i FROM b WHERE len(w) > 0)
), lengths AS (
    SELECT DISTINCT n FROM win
), dwin AS (
    SELECT row_no, i, n, w[i:i + n - 1] AS win
    FROM (SELECT row_no, w, unnest(range(1, len(w) + 1)) AS i FROM d), lengths WHERE i + n - 1 <= len(w)
), hits AS (
    SELECT dwin.row_no, dwin.i, dwin.n, win.item_id FROM dwin JOIN win ON dwin.n = win.n AND dwin.win = win.win
), hit_words AS (
    SELECT row_no, count(DISTINCT place) AS n_hit
    FROM (SELECT row_no, unnest(range(i, i + n)) AS place FROM hits) GROUP BY row_no
), items AS (
    SELECT row_no, count(*) AS n_items, string_agg(item_id::VARCHAR, ',' ORDER BY item_id::VARCHAR) AS names
    FROM (SELECT DISTINCT row_no, item_id FROM hits WHERE item_id IS NOT NULL) GROUP BY row_no
)
SELECT doc_id, len(w)::BIGINT AS n_words, coalesce(n_hit, 0)::BIGINT AS n_hit, coalesce(n_items, 0)::BIGINT AS n_items,
       sha256(coalesce(names, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AS contaminated
FROM d LEFT JOIN hit_words USING (row_no) LEFT JOIN items USING (row_no)
"""


# op13 by brute force: every kept term in every group, every ordered pair of sources.
_DIVERGENCE = r"""
WITH d AS MATERIALIZED (
    SELECT row_number() OVER () AS row_no, coalesce(lang, '') AS lang, coalesce(source, '') AS source,
           regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                              '[^\x00-\x40\x5B-\x60\x7B-\x7F]+') AS t
    FROM documents
), occ AS (
    SELECT lang, source, row_no, unnest(t) AS term FROM d
), kept AS (
    SELECT lang, term FROM occ GROUP BY lang, term HAVING count(DISTINCT row_no) >= 3
), v AS (
    SELECT lang, count(*) AS V FROM kept GROUP BY lang
), groups AS (
    SELECT DISTINCT lang, source FROM d
), gc AS (
    SELECT lang, source, term, count(*) AS c FROM occ JOIN kept USING (lang, term) GROUP BY ALL
), grid AS (
    SELECT g.lang, g.source, k.term, coalesce(gc.c, 0) AS c
    FROM groups g JOIN kept k USING (lang) LEFT JOIN gc USING (lang, source, term)
), gp AS (
    SELECT lang, source, term, c,
           (1 + (1000000000::HUGEINT * (c + 1)) // (sum(c) OVER (PARTITION BY lang, source) + V))::BIGINT AS p
    FROM grid JOIN v USING (lang)
), lp AS (
    SELECT lang, term, (1 + (1000000000::HUGEINT * (lc + 1)) // (sum(lc) OVER (PARTITION BY lang) + V))::BIGINT AS q
    FROM (SELECT lang, term, sum(c) AS lc FROM grid GROUP BY lang, term) JOIN v USING (lang)
), terms AS (
    SELECT lang, source, 'term' AS part, term AS item, (p - q) * (p - q) // q AS value
    FROM gp JOIN lp USING (lang, term) WHERE c > 0 AND p > q
), sums AS (
    SELECT x.lang, x.source, y.source AS item, sum((x.p - y.p) * (x.p - y.p) // y.p) AS value
    FROM gp x JOIN gp y ON x.lang = y.lang AND x.term = y.term AND x.source <> y.source GROUP BY ALL
), pairs AS (
    SELECT a.lang, a.source, 'pair' AS part, b.source AS item, coalesce(s.value, 0)::BIGINT AS value
    FROM groups a JOIN groups b ON a.lang = b.lang AND a.source <> b.source
    LEFT JOIN sums s ON s.lang = a.lang AND s.source = a.source AND s.item = b.source
), ranked AS (
    SELECT *, row_number() OVER (PARTITION BY lang, source, part ORDER BY value DESC, encode(item)) AS rank
    FROM (SELECT * FROM terms UNION ALL SELECT * FROM pairs)
)
SELECT lang, source, part, item, value::BIGINT AS value, rank::INTEGER AS rank FROM ranked WHERE part = 'pair' OR rank <= 200
"""


ORACLE = {
    "op13_source_divergence": _DIVERGENCE,
    "op12_benchmark_decontamination": _LEAKS,
    "op11_equal_average_codes": _CODES,
    "op3_exact_dedup": _EXACT, "op4_curriculum_mix": _MIX, "op5_rule_ledger": _QUALITY, "op6_hash_tree_shards": _SHARDS}
