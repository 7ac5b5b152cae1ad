"""DuckDB statements for those operator queries that SQL can express."""

_OP2 = r"""
WITH words AS (
    SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
           'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM documents
), items AS (
    SELECT item_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
           'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM benchmark
), windows AS (
    SELECT DISTINCT coalesce(CAST(item_id AS VARCHAR), '') AS item, least(10, len(w)) AS n,
           array_to_string(w[i : i + least(10, len(w)) - 1], ' ') AS win
    FROM items, unnest(range(1, len(w) - least(10, len(w)) + 2)) AS u(i) WHERE len(w) > 0
), lengths AS (SELECT DISTINCT n FROM windows),
places AS (
    SELECT doc_id, i, n, array_to_string(w[i : i + n - 1], ' ') AS win
    FROM words, lengths, unnest(range(1, len(w) - n + 2)) AS u(i)
), hits AS (SELECT p.doc_id, p.i, p.n, x.item FROM places p JOIN windows x ON x.n = p.n AND x.win = p.win),
covered AS (SELECT doc_id, count(DISTINCT j) AS n_hit FROM hits, unnest(range(i, i + n)) AS u(j) GROUP BY doc_id),
found AS (
    SELECT doc_id, count(DISTINCT item) AS n_items, string_agg(DISTINCT item, ',' ORDER BY item) AS list
    FROM hits GROUP BY doc_id
)
SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words, coalesce(n_hit, 0) AS n_hit, coalesce(n_items, 0) AS n_items,
       sha256(coalesce(list, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AS contaminated
FROM words LEFT JOIN covered USING (doc_id) LEFT JOIN found USING (doc_id)
"""

_OP11 = """
WITH taking AS (
    SELECT vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label,
           [floor(256 * CAST(x AS DOUBLE)) FOR x IN embedding] AS v
    FROM embeddings
    WHERE vec_id IS NOT NULL AND label IS NOT NULL AND embedding IS NOT NULL
          AND len([x FOR x IN embedding IF x IS NULL OR NOT isfinite(x)]) = 0
), scored AS (
    SELECT a.vec_id AS anchor_id, a.label AS wanted, r.vec_id, r.label,
           CAST(list_inner_product(a.v, r.v) AS BIGINT) AS score
    FROM taking a JOIN taking r ON a.vec_id % 100 = 0
), positives AS (
    SELECT anchor_id, wanted, vec_id AS positive_id, score AS positive_score
    FROM scored WHERE label = wanted AND vec_id <> anchor_id
    QUALIFY row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, vec_id) <= 5
)
SELECT anchor_id, positive_id, vec_id AS negative_id, positive_score, score AS negative_score,
       CAST(row_number() OVER (PARTITION BY anchor_id, positive_id ORDER BY score DESC, vec_id) AS INTEGER) AS rank
FROM positives JOIN scored USING (anchor_id)
WHERE label <> positives.wanted AND 80 * positive_score <= 100 * score AND 100 * score <= 100 * positive_score
QUALIFY row_number() OVER (PARTITION BY anchor_id, positive_id ORDER BY score DESC, vec_id) <= 5
"""

ORACLES = {"op2_decontamination": _OP2, "op11_hard_negatives": _OP11}
