"""The queries that SQL can express, for the same tables."""

from __future__ import annotations

EXACT_DEDUP = r"""
WITH prints AS (
    SELECT doc_id, length(coalesce(text, '')) AS points,
           sha256(regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]', '', 'g')) AS text_sha256
    FROM documents
), ranked AS (
    SELECT *, count(*) OVER (PARTITION BY text_sha256) AS group_size,
           first_value(doc_id) OVER (PARTITION BY text_sha256 ORDER BY points DESC, doc_id NULLS LAST) AS keep_id,
           row_number() OVER (PARTITION BY text_sha256 ORDER BY points DESC, doc_id NULLS LAST) AS place
    FROM prints
)
SELECT doc_id, keep_id, group_size, place = 1 AS kept, text_sha256 FROM ranked
"""

# The digests of the payloads, and which page each refers to.
WARC = r"""
WITH prints AS (
    SELECT page_id, strlen(coalesce(html, '')) AS payload_bytes, sha1(coalesce(html, '')) AS payload_digest FROM pages
), ranked AS (
    SELECT *, max(page_id) OVER (PARTITION BY payload_digest) AS keep_id FROM prints
)
SELECT page_id, payload_bytes, payload_digest,
       CASE WHEN payload_bytes >= 1000 AND page_id < keep_id THEN 'revisit' ELSE 'response' END AS record_type,
       CASE WHEN payload_bytes >= 1000 AND page_id < keep_id THEN keep_id END AS refers_to
FROM ranked
"""

# Words of pieces, phrases of one to three of them with their counts, the lowest cut of each, and the best per language.
COLLOCATIONS = r"""
WITH pieces AS (
    SELECT coalesce(lang, 'und') AS lang,
           unnest(string_split_regex(
               translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[.,;:!?\x0A-\x0D]'
           )) AS piece
    FROM documents
), lists AS (
    SELECT lang, [word FOR word IN string_split_regex(piece, '[\x20\x09]+') IF word <> ''] AS words FROM pieces
), grams AS (
    SELECT lang, size, unnest([array_to_string(list_slice(words, first, first + size - 1), ' ') FOR first IN range(1, len(words) - size + 2)]) AS phrase
    FROM lists CROSS JOIN (VALUES (1), (2), (3)) AS sizes(size)
), counted AS MATERIALIZED (
    SELECT lang, size, phrase, count(*) AS f FROM grams GROUP BY ALL
), frequent AS MATERIALIZED (
    SELECT lang, phrase, f FROM counted WHERE f >= 10
), candidates AS MATERIALIZED (
    SELECT lang, size, phrase, string_split(phrase, ' ') AS words, f AS a FROM counted WHERE size > 1 AND f >= 10
), splits AS MATERIALIZED (
    SELECT lang, size, phrase, a, k, array_to_string(list_slice(words, 1, k), ' ') AS left_part,
           array_to_string(list_slice(words, k + 1, size), ' ') AS right_part
    FROM candidates CROSS JOIN (VALUES (1), (2)) AS places(k)
    WHERE k < size
), cuts AS (
    SELECT s.lang, s.size, s.phrase, s.a, s.k, l.f AS l, r.f AS r,
           (1000000::HUGEINT * s.a * s.a) // (l.f::HUGEINT * r.f) AS score
    FROM splits s
    JOIN frequent l ON l.lang = s.lang AND l.phrase = s.left_part
    JOIN frequent r ON r.lang = s.lang AND r.phrase = s.right_part
), lowest AS (
    SELECT * FROM cuts QUALIFY row_number() OVER (PARTITION BY lang, phrase ORDER BY score, k) = 1
), covered AS (
    SELECT lang, part AS phrase, max(a) AS longer
    FROM (SELECT lang, a, unnest([array_to_string(words[1:2], ' '), array_to_string(words[2:3], ' ')]) AS part
          FROM candidates WHERE size = 3)
    GROUP BY ALL
), left_over AS (
    SELECT lowest.* FROM lowest LEFT JOIN covered USING (lang, phrase)
    WHERE longer IS NULL OR lowest.size = 3 OR 100 * longer < 50 * a
), placed AS (
    SELECT *, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, phrase) AS rank FROM left_over
), totals AS (
    SELECT lang, sum(f) AS n FROM counted WHERE size = 1 GROUP BY lang
)
SELECT lang, rank, phrase, a, l, r, n::BIGINT AS n, score::BIGINT AS score FROM placed JOIN totals USING (lang) WHERE rank <= 2000
"""

ORACLE_SQL: dict[str, str] = {"op2_warc": WARC, "op7_exact_dedup": EXACT_DEDUP, "op13_collocations": COLLOCATIONS}
