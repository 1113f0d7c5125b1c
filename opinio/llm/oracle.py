"""DuckDB SQL of the queries that SQL can express."""

from __future__ import annotations

SQL = {
    "op2_exact_dedup": r"""
WITH own AS (
  SELECT doc_id, length(coalesce(text, '')) AS chars, regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]+', '', 'g') AS norm FROM documents
), ranked AS (
  SELECT *, row_number() OVER w AS place, first_value(doc_id) OVER w AS keep_id, count(*) OVER (PARTITION BY norm) AS group_size
  FROM own WINDOW w AS (PARTITION BY norm ORDER BY chars DESC, doc_id NULLS LAST)
)
SELECT doc_id, keep_id, group_size, place = 1 AS kept, sha256(norm) AS text_sha256 FROM ranked
""",
    "op7_url_filter": r"""
WITH rules(rhost, rpath, verdict) AS (
  VALUES ('net', '/', 'block'), ('example.net', '/en/', 'allow'), ('example.com', '/de/', 'block'), ('org', '/fr/', 'allow')
), own AS (
  SELECT page_id,
    translate(coalesce(regexp_extract(url, '(?s)^.*?://([^/?#]*)([^?#]*)', 1), ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host,
    coalesce(regexp_extract(url, '(?s)^.*?://([^/?#]*)([^?#]*)', 2), '') AS path
  FROM pages
), met AS (
  SELECT own.*, rhost || rpath AS rule, verdict,
    row_number() OVER (PARTITION BY page_id ORDER BY length(rhost || rpath) DESC NULLS LAST, length(rhost) DESC) AS place
  FROM own LEFT JOIN rules ON (host = rhost OR ends_with(host, '.' || rhost)) AND starts_with(path, rpath)
)
SELECT page_id, host, path, rule, coalesce(verdict, 'allow') AS verdict FROM met WHERE place = 1
""",
    "op9_decontaminate": r"""
WITH words AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w
  FROM documents
), items AS (
  SELECT item_id, regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w
  FROM benchmark WHERE text IS NOT NULL
), sized AS (
  SELECT item_id, w, least(len(w), 10) AS size FROM items WHERE len(w) > 0
), windows AS (
  SELECT DISTINCT item_id, size, array_to_string(w[i : i + size - 1], ' ') AS gram
  FROM (SELECT item_id, w, size, unnest(generate_series(1, len(w) - size + 1)) AS i FROM sized)
), grams AS (
  SELECT doc_id, size, i, array_to_string(w[i : i + size - 1], ' ') AS gram
  FROM (SELECT doc_id, w, size, unnest(generate_series(1, len(w) - size + 1)) AS i
        FROM words, (SELECT DISTINCT size FROM windows) WHERE len(w) >= size)
), found AS (
  SELECT doc_id, i, g.size, item_id FROM grams g JOIN windows v ON g.gram = v.gram AND g.size = v.size
), hits AS (
  SELECT doc_id, count(DISTINCT k) AS n_hit FROM (SELECT doc_id, unnest(generate_series(i, i + size - 1)) AS k FROM found) GROUP BY doc_id
), listed AS (
  SELECT doc_id, count(*) AS n_items, string_agg(item, ',' ORDER BY item) AS items
  FROM (SELECT DISTINCT doc_id, item_id::VARCHAR AS item FROM found) GROUP BY doc_id
)
SELECT doc_id, len(w) AS n_words, coalesce(n_hit, 0) AS n_hit, coalesce(n_items, 0) AS n_items,
  sha256(coalesce(items, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AS contaminated
FROM words LEFT JOIN hits USING (doc_id) LEFT JOIN listed USING (doc_id)
""",
    "op11_warc": r"""
WITH own AS (
  SELECT page_id, encode(coalesce(html, '')) AS body FROM pages
), ranked AS (
  SELECT page_id, octet_length(body) AS payload_bytes, sha1(body) AS payload_digest, row_number() OVER w > 1 AND octet_length(body) >= 1000 AS again, first_value(page_id) OVER w AS lead
  FROM own WINDOW w AS (PARTITION BY body ORDER BY page_id DESC NULLS LAST)
)
SELECT page_id, payload_bytes, payload_digest, CASE WHEN again THEN 'revisit' ELSE 'response' END AS record_type, CASE WHEN again THEN lead END AS refers_to FROM ranked
""",
}
