"""DuckDB SQL of the queries that SQL can express."""

from __future__ import annotations

from corpuscope.llm.licenses import NOTICES

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
ORACLE: dict[str, str] = {}

ORACLE["op6_decontamination"] = rf"""
WITH doc AS (
  SELECT row_number() OVER () AS r, doc_id,
         regexp_extract_all(translate(coalesce(text, ''), '{UPPER}', '{LOWER}'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w
  FROM documents
), item AS (
  SELECT item_id,
         regexp_extract_all(translate(coalesce(text, ''), '{UPPER}', '{LOWER}'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w
  FROM benchmark
), win AS (
  SELECT DISTINCT item_id, least(10, len(w)) AS k, array_to_string(w[p:p + least(10, len(w)) - 1], ' ') AS s
  FROM item, unnest(range(1, len(w) - least(10, len(w)) + 2)) AS u(p) WHERE len(w) > 0
), place AS (
  SELECT r, p, k, array_to_string(w[p:p + k - 1], ' ') AS s
  FROM doc, (SELECT DISTINCT k FROM win), unnest(range(1, len(w) - k + 2)) AS u(p)
), found AS (
  SELECT DISTINCT r, p, k, item_id FROM place JOIN win USING (k, s)
), hit AS (
  SELECT r, count(DISTINCT q) AS n_hit FROM found, unnest(range(p, p + k)) AS u(q) GROUP BY r
), held AS (
  SELECT r, count(DISTINCT item_id) AS n_items,
         sha256(string_agg(DISTINCT item_id::VARCHAR, ',' ORDER BY item_id::VARCHAR)) AS items_sha256
  FROM found GROUP BY r
)
SELECT doc_id, len(w)::BIGINT AS n_words, coalesce(n_hit, 0)::BIGINT AS n_hit, coalesce(n_items, 0)::BIGINT AS n_items,
       coalesce(items_sha256, sha256('')) AS items_sha256, coalesce(n_hit, 0) > 0 AS contaminated
FROM doc LEFT JOIN hit USING (r) LEFT JOIN held USING (r)
"""

ORACLE["op7_line_dedup"] = rf"""
WITH doc AS (
  SELECT row_number() OVER () AS r, doc_id, string_split(coalesce(text, ''), chr(10)) AS lines FROM documents
), line AS (
  SELECT r, doc_id, p, lines[p] AS line,
         translate(trim(lines[p], ' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)), '{UPPER}', '{LOWER}') AS k
  FROM doc, unnest(range(1, len(lines) + 1)) AS u(p)
), repeated AS (
  SELECT k, min(doc_id) AS first FROM line WHERE length(k) >= 10 GROUP BY k HAVING count(DISTINCT doc_id) > 1
)
SELECT doc_id, count(*)::BIGINT AS n_lines, count(*) FILTER (first IS NOT NULL AND doc_id <> first)::BIGINT AS n_dropped,
       sha256(coalesce(string_agg(line, chr(10) ORDER BY p) FILTER (NOT (first IS NOT NULL AND doc_id <> first)), '')) AS kept_sha256
FROM line LEFT JOIN repeated USING (k) GROUP BY r, doc_id
"""

_notices = ", ".join("('{}', '{}')".format(name, text.replace("'", "''")) for name, text in NOTICES.items())
ORACLE["op5_licenses"] = rf"""
WITH notice AS (
  SELECT license, list_transform(regexp_extract_all(text, '[A-Za-z0-9]+'), lambda w: lower(w)) AS w
  FROM (VALUES {_notices}) AS v(license, text)
), wanted AS (
  SELECT DISTINCT license, array_to_string(w[p:p + 4], ' ') AS s FROM notice, unnest(range(1, len(w) - 3)) AS u(p)
), size AS (
  SELECT license, count(*) AS n FROM wanted GROUP BY license
), doc AS (
  SELECT row_number() OVER () AS r, doc_id,
         list_transform(regexp_extract_all(coalesce(text, ''), '[A-Za-z0-9]+'), lambda w: lower(w)) AS w
  FROM documents
), place AS (
  SELECT r, doc_id, p - 1 AS p, array_to_string(w[p:p + 4], ' ') AS s FROM doc, unnest(range(1, len(w) - 3)) AS u(p)
)
SELECT doc_id, license, count(DISTINCT s)::BIGINT AS matched, round(count(DISTINCT s) / n, 4) AS containment,
       min(p)::BIGINT AS first_word
FROM place JOIN wanted USING (s) JOIN size USING (license) GROUP BY r, doc_id, license, n
HAVING count(DISTINCT s) >= 0.8 * n
"""

ORACLE["op10_search"] = rf"""
WITH word AS (
  SELECT r, doc_id, unnest(w) AS w, len(w) AS n FROM (
    SELECT row_number() OVER () AS r, doc_id,
           regexp_extract_all(translate(text, '{UPPER}', '{LOWER}'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w
    FROM documents WHERE text IS NOT NULL AND doc_id IS NOT NULL
  )
), total AS (
  SELECT count(*) AS docs, (SELECT count(*) FROM word) / count(*) AS average FROM documents
  WHERE text IS NOT NULL AND doc_id IS NOT NULL
), tf AS (
  SELECT r, doc_id, n, w, count(*) AS tf FROM word GROUP BY ALL
), df AS (
  SELECT w, ln(1 + (docs - count(*) + 0.5) / (count(*) + 0.5)) AS idf FROM tf, total GROUP BY w, docs
), asked AS (
  SELECT DISTINCT doc_id AS query, w, tf AS times FROM tf WHERE doc_id % 20 = 0
), scored AS (
  SELECT query, r, tf.doc_id, round(sum(times * idf * (tf * 2.2 / (tf + 1.2 * (0.25 + 0.75 * n / average)))), 6) AS score
  FROM asked JOIN df USING (w) JOIN tf USING (w), total GROUP BY query, r, tf.doc_id
), ranked AS (
  SELECT query, row_number() OVER (PARTITION BY query ORDER BY score DESC, doc_id)::INTEGER AS rank, doc_id, score FROM scored
)
SELECT * FROM ranked WHERE rank <= 10
"""

# Matches are marked with two control characters, so that their places follow from the lengths between the marks.
_ASSIGN = (
    """([Pp][Aa][Ss][Ss][Ww][Oo][Rr][Dd]|[Pp][Aa][Ss][Ss][Ww][Dd]|[Ss][Ee][Cc][Rr][Ee][Tt]|[Tt][Oo][Kk][Ee][Nn]|"""
    """[Aa][Pp][Ii]_?[Kk][Ee][Yy])["'']?\\x20*[:=]\\x20*["'']?([A-Za-z0-9+/_.=-]+)"""
)
_RULES = [
    ("assign", _ASSIGN, r"regexp_extract(m, '^.*?[:=]\x20*[\"'']?([A-Za-z0-9+/_.=-]+)$', 1)", 6),
    ("access", "AKIA[A-Z0-9]+", "m", 20), ("hex", "[0-9a-f]+", "m", 24),
    ("key_block", "-----BEGIN (?:[A-Z0-9]+ )*PRIVATE KEY-----", "m", 0), ("forge", "gh[oprsu]_[A-Za-z0-9]{36,}", "m", 0),
    ("chat", "xox[abprs]-[A-Za-z0-9-]{10,}", "m", 0),
]
_found = " UNION ALL ".join(f"""
  SELECT r, {k} AS o, '{kind}' AS kind, start, start + length(m) AS stop FROM (
    SELECT r, split_part(s, chr(2), 1) AS m,
           coalesce(sum(length(s) - CASE WHEN p > 1 THEN 1 ELSE 0 END) OVER (
             PARTITION BY r ORDER BY p ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS start, p
    FROM (
      SELECT r, parts[p] AS s, p FROM (
        SELECT r, string_split(regexp_replace(text, '{pattern}', chr(1) || '\\0' || chr(2), 'g'), chr(1)) AS parts
        FROM doc
      ), unnest(range(1, len(parts) + 1)) AS u(p)
    )
  ) WHERE p > 1 AND length({value}) >= {least}""" for k, (kind, pattern, value, least) in enumerate(_RULES))
ORACLE["op2_secrets"] = f"""
WITH doc AS (
  SELECT row_number() OVER () AS r, doc_id, coalesce(text, '') AS text FROM documents
), found AS ({_found}
), listed AS (
  SELECT r, count(*) FILTER (o = 0) AS a, count(*) FILTER (o = 1) AS k, count(*) FILTER (o = 2) AS h,
         string_agg(kind || ':' || start || ':' || stop, ',' ORDER BY start, o) FILTER (o < 3) AS base,
         string_agg(kind || ':' || start || ':' || stop, ',' ORDER BY start, o) AS spans
  FROM found GROUP BY r
)
SELECT doc_id, coalesce(a, 0)::BIGINT AS n_assign, coalesce(k, 0)::BIGINT AS n_access, coalesce(h, 0)::BIGINT AS n_hex,
       sha256(coalesce(base, '')) AS base_sha256, coalesce(spans, '') AS spans
FROM doc LEFT JOIN listed USING (r)
"""

ORACLE["op12_embedding_dedup"] = """
WITH RECURSIVE row AS (
  SELECT row_number() OVER () AS r, vec_id, label, embedding::DOUBLE[] AS e FROM embeddings
), v AS (
  SELECT *, len(e) AS dims, sqrt(list_sum(list_transform(e, lambda c: c * c))) AS norm FROM row
  WHERE vec_id IS NOT NULL AND label IS NOT NULL AND len(e) > 0
    AND len(list_filter(e, lambda c: c IS NULL OR isnan(c) OR isinf(c))) = 0 AND len(list_filter(e, lambda c: c <> 0)) > 0
), link AS (
  SELECT a.r, b.r AS other, b.vec_id AS other_id FROM v AS a JOIN v AS b ON a.label = b.label AND a.dims = b.dims AND a.r <> b.r
  WHERE list_inner_product(a.e, b.e) / (a.norm * b.norm) >= 0.93
), reach AS (
  SELECT r, vec_id FROM row
  UNION
  SELECT link.other, reach.vec_id FROM reach JOIN link USING (r)
), linked AS (
  SELECT r, count(*) AS n FROM link GROUP BY r
), component AS (
  SELECT r, min(vec_id) AS component_id FROM reach GROUP BY r
)
SELECT vec_id, coalesce(n, 0)::BIGINT AS n_links, component_id, coalesce(vec_id = component_id, true) AS kept
FROM row LEFT JOIN linked USING (r) LEFT JOIN component USING (r)
"""
