"""SQL statements of the registered queries that SQL can express, on the same tables."""

from __future__ import annotations

_LOWER = "translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"
_WORDS = rf"regexp_extract_all({_LOWER}, '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+')"

#: Integer inner products of every query row with every other row.
TOP_K = """
WITH whole AS (
  SELECT vec_id, [floor(64 * x::DOUBLE) FOR x IN embedding] AS q FROM embeddings
  WHERE embedding IS NOT NULL
    AND len([x FOR x IN embedding IF x IS NULL OR NOT isfinite(x::DOUBLE)]) = 0
), scored AS (
  SELECT a.vec_id AS query_id, b.vec_id, list_dot_product(a.q, b.q)::BIGINT AS score
  FROM whole a JOIN whole b ON a.vec_id % 20 = 0 AND a.vec_id <> b.vec_id
), ranked AS (
  SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id)::INT AS rank FROM scored
)
SELECT query_id, rank, vec_id, score FROM ranked WHERE rank <= 20
"""

#: Document words covered by an occurrence of an item window, and the items that occur.
DECONTAMINATION = rf"""
WITH words AS (SELECT doc_id, {_WORDS} AS w FROM documents),
items AS (SELECT item_id, {_WORDS} AS w FROM benchmark),
windows AS (
  SELECT DISTINCT item_id, least(len(w), 10) AS k, array_to_string(w[i:i + 9], ' ') AS gram
  FROM (SELECT item_id, w, unnest(range(1, greatest(len(w) - 9, 1) + 1)) AS i FROM items WHERE len(w) > 0)
), places AS (SELECT doc_id, unnest(w) AS word, generate_subscripts(w, 1) AS i FROM words),
grams AS (
  SELECT doc_id, i, k, len(run) AS n, array_to_string(run[1:k], ' ') AS gram
  FROM (SELECT doc_id, i, list(word) OVER (
          PARTITION BY doc_id ORDER BY i ROWS BETWEEN CURRENT ROW AND 9 FOLLOWING) AS run FROM places)
  CROSS JOIN (SELECT DISTINCT k FROM windows)
), hits AS (SELECT doc_id, i, k, item_id FROM grams JOIN windows USING (k, gram) WHERE n >= k),
covered AS (
  SELECT doc_id, count(DISTINCT p) AS n_hit
  FROM (SELECT doc_id, unnest(range(i, i + k)) AS p FROM hits) GROUP BY doc_id
), found AS (
  SELECT doc_id, count(*) AS n_items, string_agg(item, ',' ORDER BY item) AS names
  FROM (SELECT DISTINCT doc_id, item_id::VARCHAR AS item FROM hits) GROUP BY doc_id
)
SELECT doc_id, coalesce(len(w), 0)::BIGINT AS n_words, coalesce(n_hit, 0)::BIGINT AS n_hit,
       coalesce(n_items, 0)::BIGINT AS n_items, sha256(coalesce(names, '')) AS items_sha256,
       coalesce(n_hit, 0) > 0 AS contaminated
FROM words LEFT JOIN covered USING (doc_id) LEFT JOIN found USING (doc_id)
"""

#: Every window of 35 words as a string; a word goes if one that covers it occurs twice.
PASSAGES = r"""
WITH words AS (SELECT doc_id, regexp_extract_all(text, '[^\x20\x09-\x0D]+') AS w FROM documents),
places AS (SELECT doc_id, unnest(w) AS word, generate_subscripts(w, 1) AS i, len(w) AS n FROM words),
windows AS (
  SELECT doc_id, i, word, n - i >= 34 AS full_window, md5(string_agg(word, ' ') OVER (
    PARTITION BY doc_id ORDER BY i ROWS BETWEEN CURRENT ROW AND 34 FOLLOWING)) AS gram FROM places
), repeats AS (SELECT gram FROM windows WHERE full_window GROUP BY gram HAVING count(*) > 1),
marked AS (
  SELECT doc_id, i, word, full_window AND gram IN (SELECT gram FROM repeats) AS starts FROM windows
), judged AS (
  SELECT doc_id, i, word, max(starts::INT) OVER (
    PARTITION BY doc_id ORDER BY i ROWS BETWEEN 34 PRECEDING AND CURRENT ROW) = 1 AS gone FROM marked
), cut AS (
  SELECT doc_id, count_if(gone) AS n_removed, string_agg(word, ' ' ORDER BY i) FILTER (NOT gone) AS kept
  FROM judged GROUP BY doc_id
)
SELECT doc_id, coalesce(len(w), 0)::BIGINT AS n_words, coalesce(n_removed, 0)::BIGINT AS n_removed,
       sha256(coalesce(kept, '')) AS kept_sha256
FROM words LEFT JOIN cut USING (doc_id)
"""

#: Every pair of groups over every kept term, zero counts written out; and the leading terms.
DIVERGENCE = rf"""
WITH docs AS (
  SELECT row_number() OVER () AS d, coalesce(lang, '') AS lang, coalesce(source, '') AS source,
         unnest(regexp_extract_all(coalesce({_LOWER}, ''), '[^\x00-\x60\x7B-\x7F]+')) AS term FROM documents
), kept AS (SELECT lang, term FROM docs GROUP BY lang, term HAVING count(DISTINCT d) >= 30),
groups AS (SELECT DISTINCT coalesce(lang, '') AS lang, coalesce(source, '') AS source FROM documents),
counts AS (SELECT lang, source, term, count(*) AS n FROM docs SEMI JOIN kept USING (lang, term) GROUP BY ALL),
sizes AS (SELECT lang, count(*) AS v FROM kept GROUP BY lang),
totals AS (SELECT lang, source, sum(n) AS total FROM counts GROUP BY ALL),
own AS (
  SELECT lang, source, term, coalesce(n, 0) AS n,
         1 + (1000000000 * (coalesce(n, 0) + 5)::HUGEINT) // (coalesce(total, 0) + 5 * v) AS p
  FROM groups JOIN kept USING (lang) JOIN sizes USING (lang)
  LEFT JOIN totals USING (lang, source) LEFT JOIN counts USING (lang, source, term)
), whole AS (
  SELECT lang, term, 1 + (1000000000 * (sum(n) + 5)::HUGEINT) // (any_value(total) + 5 * any_value(v)) AS q
  FROM counts JOIN sizes USING (lang) JOIN (SELECT lang, sum(n) AS total FROM counts GROUP BY lang) USING (lang)
  GROUP BY lang, term
), gaps AS (
  SELECT a.lang, a.source, b.source AS item, sum(abs(a.p - b.p)) AS value
  FROM own a JOIN own b ON a.lang = b.lang AND a.term = b.term AND a.source <> b.source GROUP BY ALL
), found AS (
  SELECT a.lang, a.source, 'pair' AS part, b.source AS item, coalesce(value, 0)::BIGINT AS value
  FROM groups a JOIN groups b ON a.lang = b.lang AND a.source <> b.source
  LEFT JOIN gaps g ON g.lang = a.lang AND g.source = a.source AND g.item = b.source
  UNION ALL
  SELECT lang, source, 'term', term, (p - q)::BIGINT FROM own JOIN whole USING (lang, term) WHERE n > 0 AND p > q
), ranked AS (
  SELECT *, row_number() OVER (PARTITION BY lang, source, part ORDER BY value DESC, item)::INT AS rank FROM found
)
SELECT lang, source, part, item, value, rank FROM ranked WHERE part = 'pair' OR rank <= 50
"""

#: Every item word against every document that holds it.
RANKED = rf"""
WITH docs AS (SELECT row_number() OVER () AS d, doc_id, {_WORDS} AS w FROM documents),
whole AS (SELECT count_if(len(w) > 0) AS n_docs, sum(len(w))::BIGINT AS n_words FROM docs),
items AS (SELECT row_number() OVER () AS i, item_id, {_WORDS} AS w FROM benchmark),
asked AS (SELECT i, item_id, term, count(*) AS times FROM (SELECT i, item_id, unnest(w) AS term FROM items) GROUP BY ALL),
held AS (
  SELECT d, doc_id, n, term, count(*) AS tf FROM (SELECT d, doc_id, len(w) AS n, unnest(w) AS term FROM docs)
  WHERE term IN (SELECT term FROM asked) GROUP BY ALL
), weights AS (
  SELECT term, floor(1000 * ln((2 * n_docs + 2)::DOUBLE / (2 * count(*) + 1)::DOUBLE))::BIGINT AS w
  FROM held, whole GROUP BY term, n_docs
), parts AS (
  SELECT d, doc_id, term, (1000000000 * tf) // (1000 * tf + 12 * (100 - 25 + (25 * n * n_docs) // n_words)) AS part
  FROM held, whole
), scored AS (
  SELECT i, item_id, d, doc_id, sum(times * w * part)::BIGINT AS score
  FROM asked JOIN parts USING (term) JOIN weights USING (term) GROUP BY ALL
), ranked AS (
  SELECT *, row_number() OVER (PARTITION BY i ORDER BY score DESC, doc_id NULLS LAST)::INT AS rank FROM scored WHERE score > 0
)
SELECT item_id, rank, doc_id, score FROM ranked WHERE rank <= 20
"""
