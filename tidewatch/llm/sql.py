"""DuckDB SQL twins of the text queries that SQL can state, written independently of the operators."""

from __future__ import annotations

#: CRC-32 of the ASCII text ``{0}``, bit by bit; 3988292384 is its reversed polynomial.
_CRC32 = """xor(4294967295, list_reduce(
    list_prepend(CAST(4294967295 AS BIGINT), list_transform(string_split({0}, ''), lambda ch: CAST(ascii(ch) AS BIGINT))),
    lambda sofar, byte: list_reduce(
      list_prepend(xor(sofar, byte), [CAST(b AS BIGINT) FOR b IN range(8)]),
      lambda crc, bit: CASE WHEN crc & 1 = 1 THEN xor(crc >> 1, 3988292384) ELSE crc >> 1 END)))"""

CONVERSATION_TRIE = f"""
WITH turns AS (
  SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations WHERE conv_id IS NOT NULL
),
lists AS (
  SELECT conv_id, list({{'role': role, 'text': text}} ORDER BY turn NULLS FIRST, md5(length(role) || ':' || role || text)) AS own
  FROM turns GROUP BY conv_id
),
headed AS (
  SELECT conv_id, own, conv_id - conv_id % 100 AS base, {_CRC32.format("CAST(conv_id AS VARCHAR)")} % 6 AS h FROM lists
),
rebuilt AS (
  SELECT c.conv_id, list_concat(coalesce(b.own, [])[1:c.h], c.own[c.h + 1:]) AS path FROM headed c LEFT JOIN lists b ON b.conv_id = c.base
),
prefixes AS (
  SELECT conv_id, path[1:d] AS path, d, d = len(path) AS ends FROM (SELECT conv_id, path, unnest(range(len(path) + 1)) AS d FROM rebuilt)
),
nodes AS (
  SELECT path, d, min(conv_id) AS conv_id, count(*) AS n,
         sha256(coalesce(string_agg(CAST(conv_id AS VARCHAR), ',' ORDER BY conv_id) FILTER (WHERE ends), '')) AS ends_sha256
  FROM prefixes GROUP BY path, d
),
counted AS (
  SELECT p.path, p.d, p.conv_id, p.n, p.ends_sha256, count(c.d) AS children, CASE WHEN p.d = 0 THEN 0 ELSE (p.n - 1) * length(p.path[p.d].text) END AS own
  FROM nodes p LEFT JOIN nodes c ON c.d = p.d + 1 AND c.path[1:p.d] = p.path
  GROUP BY p.path, p.d, p.conv_id, p.n, p.ends_sha256
),
below AS (
  SELECT path[1:up] AS path, up AS d, sum(own) AS saved, count(*) FILTER (WHERE children = 0) AS leaves
  FROM (SELECT path, own, children, unnest(range(d + 1)) AS up FROM counted) GROUP BY ALL
)
SELECT n.conv_id, CAST(n.d AS BIGINT) AS depth, p.conv_id AS parent_conv_id, CAST(n.n AS BIGINT) AS n_convs, CAST(n.children AS BIGINT) AS n_children,
       CAST(b.leaves AS BIGINT) AS n_leaves, CAST(b.saved AS BIGINT) AS saved_tokens, n.ends_sha256
FROM counted n JOIN below b ON b.d = n.d AND b.path = n.path LEFT JOIN nodes p ON p.d = n.d - 1 AND p.path = n.path[1:n.d - 1]
"""

#: Upper-case base32 of a SHA-1 in hex: five hex digits are four characters.
_BASE32 = """array_to_string(list_transform(range(32), lambda i: substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567',
    CAST((CAST('0x' || substr({0}, CAST(i // 4 * 5 + 1 AS INTEGER), 5) AS BIGINT) >> (15 - 5 * (i % 4))) & 31 AS INTEGER) + 1, 1)), '')"""

WARC = f"""
WITH payloads AS (SELECT page_id, coalesce(html, '') AS html FROM pages),
digests AS (SELECT page_id, octet_length(encode(html)) AS payload_bytes, sha1(html) AS sha FROM payloads),
newest AS (SELECT *, max(page_id) OVER (PARTITION BY sha, payload_bytes) AS newest FROM digests)
SELECT page_id, CAST(payload_bytes AS BIGINT) AS payload_bytes, {_BASE32.format("sha")} AS payload_digest,
       CASE WHEN page_id = newest THEN 'response' ELSE 'revisit' END AS record_type, CASE WHEN page_id < newest THEN newest END AS refers_to
FROM newest
"""

#: Items and documents as sets of five-word shingles (shorter ones as one); containment of at least 0.8.
DECONTAMINATION = """
WITH words AS (
  SELECT 'item' AS kind, item_id AS id, regexp_extract_all(lower(coalesce(text, '')), '[\\p{L}\\p{N}_]+') AS w FROM benchmark
  UNION ALL SELECT 'doc', doc_id, regexp_extract_all(lower(coalesce(text, '')), '[\\p{L}\\p{N}_]+') FROM documents
),
items AS (SELECT id AS item_id, w, least(5, len(w)) AS width FROM words WHERE kind = 'item' AND len(w) > 0),
item_sets AS (
  SELECT DISTINCT item_id, width, array_to_string(w[CAST(i AS BIGINT):CAST(i + width - 1 AS BIGINT)], ' ') AS s
  FROM (SELECT item_id, w, width, unnest(range(1, len(w) - width + 2)) AS i FROM items)
),
sizes AS (SELECT item_id, count(*) AS n FROM item_sets GROUP BY item_id),
widths AS (SELECT DISTINCT width FROM items),
doc_sets AS (
  SELECT DISTINCT id AS doc_id, width, array_to_string(w[CAST(i AS BIGINT):CAST(i + width - 1 AS BIGINT)], ' ') AS s
  FROM (SELECT id, w, width, unnest(range(1, len(w) - width + 2)) AS i FROM words, widths WHERE kind = 'doc' AND len(w) >= width)
)
SELECT doc_id, item_id, count(*) AS shared, any_value(n) AS item_shingles, count(*) / any_value(n)::DOUBLE AS containment
FROM doc_sets JOIN item_sets USING (width, s) JOIN sizes USING (item_id)
GROUP BY doc_id, item_id HAVING count(*) >= 0.8 * any_value(n)
"""

#: Every byte with the 50-byte string that starts there, as hex digits.
REPEATS = """
WITH bytes AS (
  SELECT doc_id, unnest(range(CAST(octet_length(encode(text)) AS BIGINT))) AS pos, hex(encode(text)) AS h FROM documents WHERE text IS NOT NULL
),
strings AS (SELECT doc_id, pos, substr(h, CAST(2 * pos + 1 AS BIGINT), 2) AS byte, CASE WHEN length(h) >= 2 * (pos + 50) THEN md5(substr(h, CAST(2 * pos + 1 AS BIGINT), 100)) END AS s FROM bytes),
firsts AS (SELECT s, min(doc_id) AS first_doc FROM strings WHERE s IS NOT NULL GROUP BY s HAVING min(doc_id) < max(doc_id)),
marked AS (SELECT doc_id, pos, byte, coalesce(first_doc < doc_id, false) AS repeats FROM strings LEFT JOIN firsts USING (s)),
covered AS (SELECT *, bool_or(repeats) OVER (PARTITION BY doc_id ORDER BY pos ROWS BETWEEN 49 PRECEDING AND CURRENT ROW) AS gone FROM marked),
spans AS (SELECT *, gone AND NOT coalesce(lag(gone) OVER (PARTITION BY doc_id ORDER BY pos), false) AS opens FROM covered),
found AS (
  SELECT doc_id, count(*) AS n_bytes, count(*) FILTER (WHERE gone) AS n_removed, count(*) FILTER (WHERE opens) AS n_spans,
         sha256(unhex(coalesce(string_agg(byte, '' ORDER BY pos) FILTER (WHERE NOT gone), ''))) AS kept_sha256
  FROM spans GROUP BY doc_id
)
SELECT d.doc_id, coalesce(n_bytes, 0) AS n_bytes, coalesce(n_removed, 0) AS n_removed, coalesce(n_spans, 0) AS n_spans,
       coalesce(kept_sha256, sha256('')) AS kept_sha256
FROM documents d LEFT JOIN found USING (doc_id)
"""

ORACLE_SQL = {
    "op1_decontamination": DECONTAMINATION,
    "op4_warc": WARC,
    "op6_repeats": REPEATS,
    "op11_conversation_trie": CONVERSATION_TRIE,
}
