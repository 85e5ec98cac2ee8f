"""SQL of joins whose plain form is too long to stand beside the operator."""

from __future__ import annotations

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"

JACCARD_JOIN = f"""
WITH RECURSIVE words AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), '{UPPER}', '{LOWER}'), '[^\\x20\\x09-\\x0D]+') AS w
  FROM documents
), shingles AS (
  SELECT DISTINCT doc_id, unnest(CASE
    WHEN len(w) >= 3 THEN list_transform(range(1, len(w) - 1), lambda i: w[i] || ' ' || w[i + 1] || ' ' || w[i + 2])
    WHEN len(w) > 0 THEN [array_to_string(w, ' ')] ELSE [] END) AS shingle
  FROM words
), sizes AS (
  SELECT doc_id, count(shingle) AS n FROM documents LEFT JOIN shingles USING (doc_id) GROUP BY doc_id
), shared AS (
  SELECT a.doc_id AS x, b.doc_id AS y, count(*) AS both_have
  FROM shingles a JOIN shingles b ON a.shingle = b.shingle AND a.doc_id <> b.doc_id GROUP BY 1, 2
), links AS (
  SELECT x, y FROM shared JOIN sizes p ON p.doc_id = x JOIN sizes q ON q.doc_id = y
  WHERE 100 * both_have >= 90 * (p.n + q.n - both_have)
), reach(doc_id, root) AS (
  SELECT doc_id, doc_id FROM documents UNION SELECT y, root FROM reach JOIN links ON x = doc_id
)
SELECT doc_id, any_value(n) AS n_shingles, min(root) AS component_id FROM sizes JOIN reach USING (doc_id) GROUP BY doc_id
"""

NEAR_VECTORS = """
WITH RECURSIVE usable AS (
  SELECT vec_id, label, embedding::DOUBLE[] AS e FROM embeddings
  WHERE label IS NOT NULL AND embedding IS NOT NULL
    AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
    AND len(list_filter(embedding, lambda x: x <> 0)) > 0
), scaled AS (
  SELECT vec_id, label, e, sqrt(list_dot_product(e, e)) AS norm FROM usable
), links AS (
  SELECT a.vec_id AS x, b.vec_id AS y FROM scaled a JOIN scaled b ON a.label = b.label AND a.vec_id <> b.vec_id
  WHERE len(a.e) = len(b.e) AND list_dot_product(a.e, b.e) / (a.norm * b.norm) >= 0.93
), reach(vec_id, root) AS (
  SELECT vec_id, vec_id FROM embeddings UNION SELECT y, root FROM reach JOIN links ON x = vec_id
), linked AS (
  SELECT x AS vec_id, count(*) AS n FROM links GROUP BY x
)
SELECT vec_id, coalesce(any_value(n), 0)::BIGINT AS n_links, min(root) AS component_id, vec_id = min(root) AS kept
FROM reach LEFT JOIN linked USING (vec_id) GROUP BY vec_id
"""

SUBSTRINGS = """
WITH words AS (
  SELECT doc_id, generate_subscripts(w, 1) AS i, unnest(w) AS word
  FROM (SELECT doc_id, regexp_extract_all(coalesce(text, ''), '[^\\x20\\x09-\\x0D]+') AS w FROM documents)
), windows AS (
  SELECT doc_id, i, word, string_agg(word, ' ') OVER ahead AS string, count(*) OVER ahead = 13 AS whole
  FROM words WINDOW ahead AS (PARTITION BY doc_id ORDER BY i ROWS BETWEEN CURRENT ROW AND 12 FOLLOWING)
), firsts AS (
  SELECT string, min(doc_id) AS first FROM windows WHERE whole GROUP BY string
), judged AS (
  SELECT doc_id, i, word, coalesce(max(CASE WHEN first < doc_id THEN 1 ELSE 0 END) OVER (
    PARTITION BY doc_id ORDER BY i ROWS BETWEEN 12 PRECEDING AND CURRENT ROW), 0) = 1 AS gone
  FROM windows LEFT JOIN firsts ON whole AND windows.string = firsts.string
), kept AS (
  SELECT doc_id, count(*) AS n, count(*) FILTER (gone) AS m, string_agg(word, ' ' ORDER BY i) FILTER (NOT gone) AS text
  FROM judged GROUP BY doc_id
)
SELECT doc_id, coalesce(n, 0) AS n_words, coalesce(m, 0) AS n_removed, sha256(coalesce(kept.text, '')) AS kept_sha256
FROM documents LEFT JOIN kept USING (doc_id)
"""
