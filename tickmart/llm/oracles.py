"""DuckDB SQL of the queries that SQL can express on whole tables."""

from __future__ import annotations

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
# letters, digits and all beyond ASCII
WORD = r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+"

DECONTAMINATION = f"""
WITH docs AS (
    SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), '{UPPER}', '{LOWER}'), '{WORD}') AS words FROM documents
), items AS (
    SELECT item_id, regexp_extract_all(translate(coalesce(text, ''), '{UPPER}', '{LOWER}'), '{WORD}') AS words FROM benchmark
), item_windows AS (
    SELECT DISTINCT item_id, least(len(words), 13) AS size, array_to_string(words[start:start + 12], ' ') AS content
    FROM items, unnest(generate_series(1, greatest(1, len(words) - 12))) AS s(start) WHERE len(words) > 0
), doc_windows AS (
    SELECT doc_id, start, size, array_to_string(words[start:start + size - 1], ' ') AS content
    FROM docs, (SELECT DISTINCT size FROM item_windows) AS sizes, unnest(generate_series(1, len(words) - size + 1)) AS s(start)
    WHERE len(words) >= size
), found AS (
    SELECT doc_id, start, size, item_id FROM doc_windows JOIN item_windows USING (size, content)
), hit AS (
    SELECT doc_id, count(DISTINCT place) AS n_hit FROM found, unnest(generate_series(start, start + size - 1)) AS p(place) GROUP BY doc_id
), named AS (
    SELECT doc_id, count(*) AS n_items, string_agg(item, ',' ORDER BY item) AS items
    FROM (SELECT DISTINCT doc_id, CAST(item_id AS VARCHAR) AS item FROM found) GROUP BY doc_id
)
SELECT doc_id, CAST(len(words) AS BIGINT) AS n_words, coalesce(n_hit, 0) AS n_hit, coalesce(n_items, 0) AS n_items,
    sha256(coalesce(items, '')) AS items_sha256,
    coalesce(n_hit, 0) > 0 AND 20 * coalesce(n_hit, 0) >= len(words) AS contaminated
FROM docs LEFT JOIN hit USING (doc_id) LEFT JOIN named USING (doc_id)
"""

URL_FILTERS = f"""
WITH parts AS (
    SELECT page_id,
        translate(regexp_extract(coalesce(url, ''), '(?s)^.*?://([^/?#]*)', 1), '{UPPER}', '{LOWER}') AS host,
        regexp_extract(coalesce(url, ''), '(?s)^.*?://[^/?#]*([^?#]*)', 1) AS path
    FROM pages
), rules(site, below, verdict) AS (
    VALUES ('com', '/', 'allow'), ('example.com', '/en/', 'block'), ('www.example.com', '/en/', 'allow'),
        ('net', '/es/', 'block'), ('net', '/fr/', 'block')
), judged AS (
    SELECT page_id, arg_max(site || below, length(site || below)) AS rule, arg_max(verdict, length(site || below)) AS verdict
    FROM parts, rules WHERE (host = site OR ends_with(host, '.' || site)) AND starts_with(path, below) GROUP BY page_id
)
SELECT page_id, host, path, rule, coalesce(verdict, 'allow') AS verdict FROM parts LEFT JOIN judged USING (page_id)
"""

# Addresses in these tables have no user, port, upper case or dot segments.
WARC_REVISITS = """
WITH steps(number, kind, version) AS (
    VALUES (0, 'revisit', 1), (1, 'response', 1), (2, 'revisit', 1), (3, 'response', 2), (4, 'revisit', 0), (5, 'revisit', 2)
), seen AS (
    SELECT 6 * page_id + 5 - number AS record_id, 6 * page_id + number AS second, kind, page_id % 4 AS way,
        regexp_replace(url, '#.*$', '') AS canonical_url, CAST(octet_length(encode(coalesce(html, ''))) AS VARCHAR) AS size,
        CASE WHEN version > 0 THEN version WHEN page_id % 3 = 0 THEN 1 ELSE 2 END AS about,
        NOT (number = 5 AND page_id % 5 = 4) AS named, md5(coalesce(html, '')) AS name
    FROM pages, steps
), records AS (
    SELECT *, name || '-' || about AS tag,
        strftime(TIMESTAMP '2024-01-01' + to_seconds(second), '%Y-%m-%d %H:%M:%S') AS day
    FROM seen
), responses AS (
    SELECT canonical_url, second, record_id AS source, size AS source_size, tag AS source_tag, about AS source_about, way AS source_way
    FROM records WHERE kind = 'response'
), judged AS (
    SELECT r.*, f.source, f.source_size, CASE
        WHEN f.source IS NULL THEN 'unknown'
        WHEN NOT named OR source_way = 3 THEN 'unproven'
        WHEN source_way = 1 AND about = source_about OR source_way <> 1 AND tag = source_tag THEN 'resolved'
        ELSE 'mismatch' END AS outcome
    FROM (FROM records WHERE kind = 'revisit') r
    ASOF LEFT JOIN responses f ON r.canonical_url = f.canonical_url AND r.second >= f.second
)
SELECT record_id, canonical_url,
    CASE WHEN outcome = 'resolved' THEN source END AS resolved_id,
    outcome,
    CASE WHEN outcome = 'resolved' THEN 'W/' || tag END AS etag,
    CASE WHEN outcome = 'resolved' THEN source_size END AS content_length,
    CASE WHEN outcome = 'resolved' THEN day END AS date,
    CASE WHEN outcome = 'resolved' THEN 'never' END AS expires
FROM judged
"""

HARD_NEGATIVES = """
WITH vectors AS (
    SELECT vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label,
        list_transform(embedding, lambda x: floor(256 * CAST(x AS DOUBLE))) AS v
    FROM embeddings
    WHERE vec_id IS NOT NULL AND label IS NOT NULL AND embedding IS NOT NULL
        AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
), pairs AS (
    SELECT a.vec_id AS anchor_id, b.vec_id AS other, a.label = b.label AS alike, CAST(list_inner_product(a.v, b.v) AS BIGINT) AS score
    FROM vectors a JOIN vectors b ON a.vec_id <> b.vec_id WHERE a.vec_id % 100 = 0
), positives AS (
    SELECT anchor_id, other AS positive_id, score AS positive_score FROM pairs WHERE alike
    QUALIFY row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, other) <= 5
)
SELECT anchor_id, positive_id,
    CAST(row_number() OVER (PARTITION BY anchor_id, positive_id ORDER BY score DESC, other) AS INT) AS rank,
    other AS negative_id, positive_score, score AS negative_score
FROM positives JOIN pairs USING (anchor_id)
WHERE NOT alike AND 80 * positive_score <= 100 * score AND 100 * score <= 100 * positive_score
QUALIFY rank <= 5
"""

ORACLES = {
    "op3_warc_revisits": WARC_REVISITS,
    "op8_decontamination": DECONTAMINATION,
    "op10_url_filters": URL_FILTERS,
    "op12_hard_negatives": HARD_NEGATIVES,
}
