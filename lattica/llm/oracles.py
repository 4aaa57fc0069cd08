"""DuckDB SQL for the queries that it can express."""

from __future__ import annotations

from lattica.llm import quality_rules as rules
from lattica.llm import secrets

OP2 = """
WITH v AS (SELECT vec_id, list_transform(embedding, lambda x: floor(64 * x::DOUBLE)) AS q FROM embeddings
    WHERE vec_id IS NOT NULL AND embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
  s AS (SELECT a.vec_id AS query_id, b.vec_id, list_inner_product(a.q, b.q)::BIGINT AS score FROM v a JOIN v b ON a.vec_id % 20 = 0 AND a.vec_id <> b.vec_id)
SELECT query_id, rank, vec_id, score FROM (SELECT *, (row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id))::INT AS rank FROM s) WHERE rank <= 20
"""

OP4 = """
WITH d AS (SELECT page_id, octet_length(encode(coalesce(html, ''))) AS n, sha1(coalesce(html, '')) AS x FROM pages),
  f AS (SELECT *, min(page_id) OVER (PARTITION BY x, n) AS first,
    array_to_string(list_transform(range(1, 41), lambda i: substr('0000000100100011010001010110011110001001101010111100110111101111', 4 * instr('0123456789abcdef', substr(x, i, 1)) - 3, 4)), '') AS bits FROM d)
SELECT page_id, n::BIGINT AS payload_bytes,
  array_to_string(list_transform(range(0, 32), lambda i: substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567', 1 + 16 * substr(bits, 5 * i + 1, 1)::INT + 8 * substr(bits, 5 * i + 2, 1)::INT + 4 * substr(bits, 5 * i + 3, 1)::INT + 2 * substr(bits, 5 * i + 4, 1)::INT + substr(bits, 5 * i + 5, 1)::INT, 1)), '') AS payload_digest,
  CASE WHEN page_id = first THEN 'response' ELSE 'revisit' END AS record_type, CASE WHEN page_id <> first THEN first END AS refers_to FROM f
"""

_BLANK = r"[\x20\x09-\x0D]+"
_PHRASES = ", ".join(f"'{p}'" for p in rules.PHRASES)
_WORDS = f"list_filter(regexp_split_to_array({{}}, '{_BLANK}'), lambda w: w <> '')"

OP9 = rf"""
WITH t AS (SELECT doc_id, coalesce(text, '') AS text, {_WORDS.format("coalesce(text, '')")} AS words FROM documents),
  w AS (SELECT doc_id, unnest(range(1, greatest(len(words) - 6, 1)::BIGINT)) AS i, words FROM t),
  g AS (SELECT doc_id, i, count(*) OVER (PARTITION BY doc_id, array_to_string(words[i:i + 7], ' ')) AS n FROM w),
  r AS (SELECT doc_id, count(DISTINCT j) AS n_repeat_words FROM (SELECT doc_id, unnest(range(i, i + 8)) AS j FROM g WHERE n > 1) GROUP BY doc_id),
  l AS (SELECT doc_id, unnest(string_split(text, chr(10))) AS s FROM t),
  m AS (SELECT doc_id, s, length(regexp_replace(s, '{_BLANK}', '', 'g')) AS chars, len({_WORDS.format('s')}) AS n, length(regexp_replace(s, '[^|»›•·]+', '', 'g')) AS menu,
    length(regexp_replace(s, '[^#*$%&|<>]+', '', 'g')) AS symbols, (length(s) - length(replace(s, '!!', ''))) // 2 AS shouts,
    len(list_filter([{_PHRASES}], lambda p: contains(lower(s), p))) > 0 AS phrase,
    regexp_matches(s, '[.,;:!?…。，、！？؟।"”’)]') OR contains(s, '''') AS pointed FROM l),
  k AS (SELECT doc_id, chars > 0 AS worded, s, CASE WHEN (menu >= 2 AND menu * 5 >= n) OR (symbols >= 6 AND symbols * 10 > chars) OR (shouts >= 3 AND shouts * 3 >= n) OR phrase OR (NOT pointed AND n >= 25) THEN 0 ELSE chars END AS stays FROM m),
  a AS (SELECT doc_id, sum(stays) AS remains, count(*) FILTER (worded) - count(DISTINCT CASE WHEN worded THEN s END) AS n_dup_lines FROM k GROUP BY doc_id),
  b AS (SELECT t.doc_id, len(words)::BIGINT AS n_words, length(regexp_replace(text, '{_BLANK}', '', 'g'))::BIGINT AS word_chars, length(regexp_replace(text, '[^#*$%&|<>]+', '', 'g'))::BIGINT AS n_symbols,
    n_dup_lines::BIGINT AS n_dup_lines, coalesce(n_repeat_words, 0)::BIGINT AS n_repeat_words, remains FROM t JOIN a USING (doc_id) LEFT JOIN r USING (doc_id))
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, n_words < 20 OR 100 * n_repeat_words > 30 * n_words AS base_failed,
  NOT (n_words < 20 OR 100 * n_repeat_words > 30 * n_words) AND remains > 0 AND remains >= 0.5 * word_chars AS kept FROM b
"""


def _re2(pattern: str) -> str:
    """A pattern in the dialect of DuckDB: ASCII word boundaries for the look-arounds."""
    return pattern.replace("(?<![A-Za-z0-9_])", r"\b").replace("(?![A-Za-z0-9_])", r"\b").replace("'", "''")


def _matches(kind: str, pattern: str, ok: str, group: int = 0) -> str:
    p = f"'{pattern}'"
    return f"""SELECT row, '{kind}' AS kind, {secrets.KINDS.index(kind)} AS rank, (list_sum(gaps[1:i]) + list_sum(lens[1:i]) - lens[i])::BIGINT AS start, (list_sum(gaps[1:i]) + list_sum(lens[1:i]))::BIGINT AS stop FROM (
    SELECT *, unnest(range(1, len(lens) + 1)) AS i FROM (SELECT row, list_transform(regexp_extract_all(text, {p}), lambda x: length(x)) AS lens, list_transform(regexp_split_to_array(text, {p}), lambda x: length(x)) AS gaps,
      list_transform(regexp_extract_all(text, {p}, {group}), lambda x: {ok}) AS oks FROM t WHERE regexp_matches(text, {p}))) WHERE oks[i]"""


_HIT = "b.row = a.row AND b.start < a.stop AND a.start < b.stop"
_NEAR = f"i.row = p.row AND p.start BETWEEN i.start - {secrets.SCOPE} AND i.stop + {secrets.SCOPE}"

OP8 = f"""
WITH t AS (SELECT row_number() OVER () AS row, doc_id, coalesce(text, '') AS text FROM documents),
  base AS ({_matches("assign", _re2(secrets.ASSIGN), f"length(x) >= {secrets.MIN_VALUE}", 2)} UNION ALL {_matches("access", secrets.ACCESS, f"length(x) >= {secrets.MIN_ACCESS}")} UNION ALL {_matches("hex", "[0-9a-f]+", "length(x) >= 32")}),
  named AS ({_matches("ident", _re2(secrets.IDENT), "true")}), place AS ({_matches("endpoint", _re2(secrets.ENDPOINT), "true")}),
  long AS ({_matches("weak", "[A-Za-z0-9+/_=-]+", "length(x) >= 20 AND regexp_matches(x, '[0-9]') AND regexp_matches(x, '[A-Za-z]')")}),
  ident AS (SELECT * FROM named a WHERE NOT EXISTS (SELECT 1 FROM base b WHERE {_HIT})),
  weak AS (SELECT * FROM long a WHERE NOT EXISTS (SELECT 1 FROM (SELECT * FROM base UNION ALL SELECT * FROM named UNION ALL SELECT * FROM place) b WHERE {_HIT})),
  endpoint AS (SELECT * FROM place a WHERE NOT EXISTS (SELECT 1 FROM (SELECT * FROM base UNION ALL SELECT * FROM named) b WHERE {_HIT})),
  keys AS (SELECT * FROM base WHERE kind <> 'access' UNION ALL SELECT * FROM weak),
  paired AS (SELECT * FROM keys i WHERE EXISTS (SELECT 1 FROM (SELECT * FROM ident UNION ALL SELECT * FROM base WHERE kind = 'access') p WHERE {_NEAR})),
  spans AS (SELECT * FROM base UNION ALL SELECT * FROM paired WHERE kind = 'weak' UNION ALL SELECT * FROM ident p WHERE EXISTS (SELECT 1 FROM keys i WHERE {_NEAR}) UNION ALL SELECT * FROM endpoint p WHERE EXISTS (SELECT 1 FROM paired i WHERE {_NEAR})),
  s AS (SELECT *, kind || ':' || start || ':' || stop AS span FROM spans)
SELECT doc_id, count(*) FILTER (kind = 'assign') AS n_assign, count(*) FILTER (kind = 'access') AS n_access, count(*) FILTER (kind = 'hex') AS n_hex,
  sha256(coalesce(string_agg(span, ',' ORDER BY start, rank) FILTER (rank < {len(secrets.BASE)}), '')) AS base_sha256, coalesce(string_agg(span, ',' ORDER BY start, rank), '') AS spans
FROM t LEFT JOIN s USING (row) GROUP BY t.row, doc_id
"""
