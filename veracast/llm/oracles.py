"""SQL for another engine that recomputes the queries that SQL can express, from the given tables."""

from __future__ import annotations

_WORDS = (
    r"regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',"
    r" 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+')"
)

ORACLE_SQL = {
    "op7_prefix_decontamination": f"""
WITH items AS (SELECT item_id, {_WORDS} AS w FROM benchmark),
windows AS (
  SELECT DISTINCT item_id, array_to_string(w[s : s + 9], ' ') AS win, least(len(w), 10) AS n
  FROM (SELECT item_id, w, unnest(range(1, greatest(len(w) - 9, 1) + 1)) AS s
        FROM items WHERE len(w) > 0)
),
sizes AS (SELECT DISTINCT n FROM windows),
docs AS (SELECT doc_id, {_WORDS} AS w FROM documents),
spots AS (
  SELECT doc_id, s, n, array_to_string(w[s : s + n - 1], ' ') AS win
  FROM (SELECT doc_id, w, n, unnest(range(1, len(w) - n + 2)) AS s
        FROM docs, sizes WHERE len(w) >= n)
),
hits AS (SELECT doc_id, s, spots.n, item_id FROM spots JOIN windows USING (win)),
covered AS (
  SELECT doc_id, count(DISTINCT p) AS n_hit
  FROM (SELECT doc_id, unnest(range(s, s + n)) AS p FROM hits) GROUP BY doc_id
),
owners AS (
  SELECT doc_id, count(*) AS n_items, string_agg(item, ',' ORDER BY item) AS ids
  FROM (SELECT DISTINCT doc_id, CAST(item_id AS VARCHAR) AS item FROM hits) GROUP BY doc_id
)
SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words, coalesce(n_hit, 0) AS n_hit,
       coalesce(n_items, 0) AS n_items, sha256(coalesce(ids, '')) AS items_sha256,
       coalesce(n_hit, 0) > 0 AS contaminated
FROM docs LEFT JOIN covered USING (doc_id) LEFT JOIN owners USING (doc_id)
""",
    "op8_mtree_top_products": """
WITH whole AS (
  SELECT vec_id, list_transform(embedding, lambda x: floor(1024 * CAST(x AS DOUBLE))) AS v
  FROM embeddings
  WHERE vec_id IS NOT NULL AND embedding IS NOT NULL
    AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
),
scored AS (
  SELECT q.vec_id AS query_id, c.vec_id,
         CAST(list_inner_product(q.v, c.v) AS BIGINT) AS score
  FROM whole q JOIN whole c ON c.vec_id <> q.vec_id
  WHERE q.vec_id % 100 = 0
),
ranked AS (
  SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS rank
  FROM scored
)
SELECT query_id, CAST(rank AS INTEGER) AS rank, vec_id, score FROM ranked WHERE rank <= 10
""",
}
