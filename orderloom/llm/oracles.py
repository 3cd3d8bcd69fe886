"""SQL that gives the rows of a registered query, for DuckDB."""

SUBSTRING_DEDUP = r"""
WITH docs AS (
    SELECT row_number() OVER () AS rid, doc_id,
           regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS w
    FROM documents
),
starts AS (
    SELECT rid, doc_id, w, unnest(range(1, len(w) - 33)) AS p FROM docs WHERE len(w) >= 35
),
windows AS (
    SELECT rid, p, array_to_string(w[p : p + 34], ' ') AS span FROM starts
),
repeated AS (
    SELECT rid, p FROM windows WHERE span IN (SELECT span FROM windows GROUP BY span HAVING count(*) > 1)
),
gone AS (
    SELECT rid, list(DISTINCT i) AS gone
    FROM (SELECT rid, unnest(range(p, p + 35)) AS i FROM repeated)
    GROUP BY rid
),
kept AS (
    SELECT d.doc_id, len(w) AS n_words, coalesce(len(gone), 0) AS n_removed,
           CASE WHEN gone IS NULL THEN w
                ELSE list_transform(list_filter(range(1, len(w) + 1), lambda i: NOT list_contains(gone, i)), lambda i: w[i])
           END AS rest
    FROM docs d LEFT JOIN gone g ON d.rid = g.rid
)
SELECT doc_id, n_words::BIGINT AS n_words, n_removed::BIGINT AS n_removed,
       sha256(coalesce(array_to_string(rest, ' '), '')) AS kept_sha256
FROM kept
"""

DECONTAMINATION = r"""
WITH docs AS (
    SELECT row_number() OVER () AS rid, doc_id,
           regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                              '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w
    FROM documents
),
items AS (
    SELECT item_id,
           regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                              '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w
    FROM benchmark
),
item_spans AS (
    SELECT DISTINCT item_id, least(len(w), 10) AS width, array_to_string(w[p : p + least(len(w), 10) - 1], ' ') AS span
    FROM (SELECT item_id, w, unnest(range(1, len(w) - least(len(w), 10) + 2)) AS p FROM items WHERE len(w) > 0)
),
widths AS (SELECT DISTINCT width FROM item_spans),
doc_spans AS (
    SELECT rid, width, p, array_to_string(w[p : p + width - 1], ' ') AS span
    FROM (SELECT rid, w, width, unnest(range(1, len(w) - width + 2)) AS p FROM docs, widths WHERE len(w) >= width)
),
hits AS (
    SELECT rid, p, d.width, item_id FROM doc_spans d JOIN item_spans i ON d.width = i.width AND d.span = i.span
),
hit_words AS (
    SELECT rid, count(DISTINCT i) AS n_hit
    FROM (SELECT rid, unnest(range(p, p + width)) AS i FROM (SELECT DISTINCT rid, p, width FROM hits))
    GROUP BY rid
),
hit_items AS (
    SELECT rid, list_sort(list(DISTINCT item_id::VARCHAR)) AS ids FROM hits WHERE item_id IS NOT NULL GROUP BY rid
)
SELECT doc_id, len(w)::BIGINT AS n_words, coalesce(n_hit, 0)::BIGINT AS n_hit, coalesce(len(ids), 0)::BIGINT AS n_items,
       sha256(coalesce(array_to_string(ids, ','), '')) AS items_sha256, coalesce(n_hit, 0) > 0 AS contaminated
FROM docs d LEFT JOIN hit_words h ON d.rid = h.rid LEFT JOIN hit_items i ON d.rid = i.rid
"""
