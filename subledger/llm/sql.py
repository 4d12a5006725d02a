"""SQL counterparts of the queries that SQL can express, for DuckDB: plain joins over all windows and pairs.

They are meant for small tables: some look at every pair of documents that share an n-gram, or at every byte.
"""

from __future__ import annotations

from subledger.llm.hard_negatives import SQL as OP12

# Words of a text, lower-cased, as the benchmark search reads them.
_WORDS = "regexp_extract_all(translate(COALESCE(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+')"

OP1 = """
WITH RECURSIVE texts AS (
    SELECT row_number() OVER () AS r, doc_id, regexp_extract_all(COALESCE(text, ''), '[^\\x20\\x09-\\x0D]+') AS w FROM documents
), grams AS (
    SELECT DISTINCT r, list_slice(w, i + 1, i + least(5, len(w))) AS gram
    FROM (SELECT r, w, UNNEST(range(len(w) - least(5, len(w)) + 1)) AS i FROM texts WHERE len(w) > 0)
), sizes AS (SELECT r, COUNT(*) AS n FROM grams GROUP BY r),
links AS (
    SELECT a.r AS x, b.r AS y, ANY_VALUE(s.n) AS n, ANY_VALUE(t.n) AS m, COUNT(*) AS common
    FROM grams a JOIN grams b ON a.gram = b.gram AND a.r <> b.r JOIN sizes s ON s.r = a.r JOIN sizes t ON t.r = b.r
    GROUP BY 1, 2 HAVING COUNT(*) >= 0.8 * (ANY_VALUE(s.n) + ANY_VALUE(t.n) - COUNT(*)) - 1e-9
), reach AS (
    SELECT r AS x, r AS y FROM texts UNION SELECT reach.x, links.y FROM reach JOIN links ON links.x = reach.y
), near AS (SELECT x, COUNT(*) AS n_links FROM links GROUP BY x)
SELECT d.doc_id, (SELECT MIN(e.doc_id) FROM reach JOIN texts e ON e.r = reach.y WHERE reach.x = d.r) AS class_id,
       COALESCE(near.n_links, 0) AS n_links,
       LEAST(d.doc_id, (SELECT MIN(e.doc_id) FROM links JOIN texts e ON e.r = links.y WHERE links.x = d.r AND links.common = links.n AND links.n = links.m)) AS rep_id,
       COALESCE(sizes.n, 0) AS n_grams
FROM texts d LEFT JOIN sizes ON sizes.r = d.r LEFT JOIN near ON near.x = d.r
"""

OP3 = """
WITH bodies AS (SELECT page_id, COALESCE(html, '') AS body FROM pages),
hashed AS (SELECT page_id, strlen(body) AS payload_bytes, sha1(body) AS hex, MAX(page_id) OVER (PARTITION BY body) AS lead FROM bodies),
digits AS (SELECT *, [CAST('0x' || substr(hex, 1 + 5 * j, 5) AS BIGINT) FOR j IN range(8)] AS parts FROM hashed)
SELECT page_id, payload_bytes,
       array_to_string([substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567', CAST((parts[1 + j // 4] >> (15 - 5 * (j % 4))) & 31 AS INTEGER) + 1, 1) FOR j IN range(32)], '') AS payload_digest,
       CASE WHEN lead IS NOT NULL AND page_id IS DISTINCT FROM lead THEN 'revisit' ELSE 'response' END AS record_type,
       CASE WHEN lead IS NOT NULL AND page_id IS DISTINCT FROM lead THEN lead END AS refers_to
FROM digits
"""

OP8 = """
WITH texts AS (SELECT row_number() OVER () AS r, doc_id, hex(encode(COALESCE(text, ''))) AS h FROM documents),
windows AS (
    SELECT r, doc_id, i, substr(h, 2 * i + 1, 100) AS s FROM (SELECT *, UNNEST(range(greatest(length(h) // 2 - 49, 0))) AS i FROM texts)
), owned AS (SELECT s, MIN(doc_id) AS lead FROM windows GROUP BY s HAVING MIN(doc_id) < MAX(doc_id)),
hits AS (SELECT r, i, i - lag(i) OVER (PARTITION BY r ORDER BY i) AS step FROM windows JOIN owned USING (s) WHERE lead < doc_id),
runs AS (SELECT r, i, COUNT(*) FILTER (WHERE step IS NULL OR step > 50) OVER (PARTITION BY r ORDER BY i) AS run FROM hits),
spans AS (SELECT r, run, MIN(i) AS start, MAX(i) + 50 AS stop FROM runs GROUP BY r, run),
gaps AS (SELECT *, COALESCE(lag(stop) OVER (PARTITION BY r ORDER BY start), 0) AS before FROM spans),
cut AS (
    SELECT r, SUM(stop - start) AS removed, COUNT(*) AS spans, MAX(stop) AS last,
           string_agg(substr(h, 2 * before + 1, 2 * (start - before)), '' ORDER BY start) AS kept
    FROM gaps JOIN texts USING (r) GROUP BY r
)
SELECT doc_id, CAST(length(h) // 2 AS BIGINT) AS n_bytes, CAST(COALESCE(removed, 0) AS BIGINT) AS n_removed,
       CAST(COALESCE(spans, 0) AS BIGINT) AS n_spans,
       sha256(unhex(CASE WHEN cut.r IS NULL THEN h ELSE kept || substr(h, 2 * last + 1) END)) AS kept_sha256
FROM texts LEFT JOIN cut USING (r)
"""

OP10 = f"""
WITH docs AS (SELECT row_number() OVER () AS r, doc_id, {_WORDS} AS w FROM documents),
items AS (SELECT DISTINCT item_id, {_WORDS} AS w FROM benchmark),
owners AS (
    SELECT DISTINCT item_id, list_slice(w, i + 1, i + least(10, len(w))) AS phrase
    FROM (SELECT item_id, w, UNNEST(range(len(w) - least(10, len(w)) + 1)) AS i FROM items WHERE len(w) > 0)
), phrases AS (SELECT DISTINCT phrase, len(phrase) AS k FROM owners),
words AS (SELECT r, UNNEST(range(len(w))) AS pos, UNNEST(w) AS word FROM docs),
found AS (
    SELECT r, pos, k, phrase FROM (
        SELECT r, pos, k, list_slice(w, pos + 1, pos + k) AS phrase
        FROM (SELECT r, w, k, UNNEST(range(len(w) - k + 1)) AS pos FROM docs, (SELECT DISTINCT k FROM phrases) WHERE len(w) >= k)
    ) JOIN phrases USING (k, phrase)
), hits AS (SELECT r, COUNT(DISTINCT pos + j) AS n_hit FROM (SELECT r, pos, UNNEST(range(k)) AS j FROM found) GROUP BY r),
hit_items AS (
    SELECT r, COUNT(DISTINCT item_id) AS n_items, string_agg(DISTINCT item_id, ',' ORDER BY item_id) AS listed
    FROM found JOIN owners USING (phrase) GROUP BY r
), often AS (SELECT word, COUNT(*) AS n FROM words GROUP BY word),
terms AS (SELECT phrase, k, UNNEST(range(k)) AS place, UNNEST(phrase) AS word FROM phrases),
rarest AS (SELECT phrase, k, arg_min(place, (COALESCE(n, 0), place)) AS place, arg_min(word, (COALESCE(n, 0), place)) AS word FROM terms LEFT JOIN often USING (word) GROUP BY phrase, k),
starts AS (SELECT DISTINCT r, phrase, k, pos - place AS start FROM rarest JOIN words USING (word)),
loose AS (
    SELECT r, phrase, start FROM starts JOIN terms USING (phrase, k) JOIN words USING (r, word)
    WHERE pos BETWEEN start + place - 2 AND start + place + 2 GROUP BY r, phrase, start, k HAVING COUNT(DISTINCT place) = k
), near AS (SELECT r, COUNT(DISTINCT item_id) AS n_near FROM loose JOIN owners USING (phrase) GROUP BY r)
SELECT doc_id, len(w) AS n_words, COALESCE(n_hit, 0) AS n_hit, COALESCE(n_items, 0) AS n_items, sha256(COALESCE(listed, '')) AS items_sha256,
       COALESCE(n_hit, 0) > 0 AS contaminated, COALESCE(n_near, 0) AS n_near
FROM docs LEFT JOIN hits USING (r) LEFT JOIN hit_items USING (r) LEFT JOIN near USING (r)
"""

ORACLES = {
    "op1_ngram_join": OP1,
    "op3_warc_round_trip": OP3,
    "op8_suffix_array_dedup": OP8,
    "op10_positional_index": OP10,
    "op12_multi_index_negatives": OP12,
}
