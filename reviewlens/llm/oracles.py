"""SQL equivalents of the registered queries, for DuckDB over the same tables."""

WORD = r"[^\x20\x09-\x0D]+"

#: Line rules as in ``quality``; the phrases are the same fixed values.
QUALITY = rf"""
WITH docs AS (SELECT doc_id, coalesce(text, '') AS text FROM documents),
lines AS (
  SELECT doc_id, line, number,
         regexp_extract_all(line, '{WORD}') AS words
  FROM (SELECT doc_id, unnest(string_split(text, chr(10))) AS line,
               generate_subscripts(string_split(text, chr(10)), 1) AS number FROM docs)
),
judged AS (
  SELECT doc_id, number, len(words) AS n, words,
         row_number() OVER (PARTITION BY doc_id, line ORDER BY number) > 1 AND len(words) > 0 AS again,
         len(regexp_extract_all(line, '[|>•·\t]')) AS cells,
         len([w FOR w IN words IF regexp_matches(w, '[0-9A-Za-z]|[^\x00-\x7F]')]) AS bare,
         len([w FOR w IN words IF regexp_matches(w, '[#*$%&|<>]')]) AS marked,
         len([w FOR w IN words IF regexp_matches(w, '[!?]$')]) AS shouted,
         regexp_matches(lower(line), 'all rights reserved|cookie policy|privacy policy|terms of service|terms of use|accept cookies|javascript is disabled|enable javascript|sign up for our newsletter|subscribe to our newsletter|click here to|lorem ipsum') AND len(words) <= 20 AS phrase
  FROM lines
),
failing AS (
  SELECT *, n > 0 AND (again OR phrase OR (cells >= 4 AND bare <= 2.0 * (cells + 1))
         OR (n >= 5 AND (marked > 0.3 * n OR 2 * shouted > n OR bare = 0))) AS failed
  FROM judged
),
by_doc AS (
  SELECT doc_id, sum(again::INT) AS n_dup_lines, sum(failed::INT) AS n_lines_removed,
         sum(CASE WHEN failed THEN 0 ELSE n END) AS n_words_left
  FROM failing GROUP BY doc_id
),
words AS (SELECT doc_id, text, regexp_extract_all(text, '{WORD}') AS w FROM docs),
windows AS (
  SELECT doc_id, i, w[i] AS a, w[i + 1] AS b, w[i + 2] AS c
  FROM (SELECT doc_id, w, unnest(generate_series(1, len(w) - 2)) AS i FROM words)
),
repeated AS (
  SELECT doc_id, i FROM (
    SELECT doc_id, i, count(*) OVER (PARTITION BY doc_id, a, b, c) AS n FROM windows) WHERE n > 1
),
repeats AS (
  SELECT doc_id, count(DISTINCT p) AS n_repeat_words
  FROM (SELECT doc_id, unnest([i, i + 1, i + 2]) AS p FROM repeated) GROUP BY doc_id
),
figures AS (
  SELECT doc_id, len(w)::BIGINT AS n_words,
         len(array_to_string(w, ''))::BIGINT AS word_chars,
         len(regexp_extract_all(text, '[#*$%&|<>]'))::BIGINT AS n_symbols,
         n_dup_lines::BIGINT AS n_dup_lines,
         coalesce(n_repeat_words, 0)::BIGINT AS n_repeat_words,
         n_lines_removed::BIGINT AS n_lines_removed, n_words_left::BIGINT AS n_words_left
  FROM words JOIN by_doc USING (doc_id) LEFT JOIN repeats USING (doc_id)
)
SELECT *, n_words < 50 OR 100 * n_repeat_words > 50 * n_words AS base_failed,
       NOT (n_words < 50 OR 100 * n_repeat_words > 50 * n_words)
         AND n_words_left >= 0.5 * n_words AS kept
FROM figures
"""

CONTAMINATION = r"""
WITH doc_words AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w
  FROM documents
),
items AS (
  SELECT item_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w
  FROM benchmark
),
windows AS (
  SELECT DISTINCT item_id, least(len(w), 10) AS size, array_to_string(w[i : i + 9], ' ') AS key
  FROM (SELECT item_id, w, unnest(generate_series(1, greatest(1, len(w) - 9))) AS i FROM items WHERE len(w) > 0)
),
places AS (
  SELECT doc_id, i, size, array_to_string(w[i : i + size - 1], ' ') AS key
  FROM (SELECT doc_id, w, unnest(generate_series(1, len(w))) AS i FROM doc_words),
       (SELECT DISTINCT size FROM windows)
  WHERE i + size - 1 <= len(w)
),
hits AS (SELECT doc_id, i, size, item_id FROM places JOIN windows USING (size, key)),
hit_words AS (
  SELECT doc_id, count(DISTINCT p) AS n_hit
  FROM (SELECT doc_id, unnest(generate_series(i, i + size - 1)) AS p FROM hits) GROUP BY doc_id
),
found AS (
  SELECT doc_id, count(*) AS n_items, string_agg(item, ',' ORDER BY item) AS names
  FROM (SELECT DISTINCT doc_id, item_id::VARCHAR AS item FROM hits) GROUP BY doc_id
)
SELECT doc_id, len(w)::BIGINT AS n_words, coalesce(n_hit, 0)::BIGINT AS n_hit,
       coalesce(n_items, 0)::BIGINT AS n_items, sha256(coalesce(names, '')) AS items_sha256,
       coalesce(n_hit, 0) > 0 AS contaminated
FROM doc_words LEFT JOIN hit_words USING (doc_id) LEFT JOIN found USING (doc_id)
"""

DIVERGENCE = r"""
WITH docs AS (
  SELECT row_number() OVER () AS k, coalesce(lang, '') AS lang, coalesce(source, '') AS source,
         regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x40\x5B-\x60\x7B-\x7F]+') AS w
  FROM documents
),
occurrences AS (SELECT k, lang, source, unnest(w) AS term FROM docs),
kept AS (
  SELECT lang, term, count(*) AS n FROM occurrences GROUP BY ALL HAVING count(DISTINCT k) >= 10
),
langs AS (SELECT lang, count(*) AS v, sum(n)::BIGINT AS mass FROM kept GROUP BY lang),
counts AS (
  SELECT lang, source, term, count(*) AS n FROM occurrences SEMI JOIN kept USING (lang, term) GROUP BY ALL
),
groups AS (
  SELECT d.lang, d.source, coalesce(l.v, 0) AS v, coalesce(l.mass, 0) AS lang_n,
         coalesce((SELECT sum(n) FROM counts c WHERE c.lang = d.lang AND c.source = d.source), 0)::BIGINT AS n
  FROM (SELECT DISTINCT lang, source FROM docs) d LEFT JOIN langs l USING (lang)
),
shares AS (
  SELECT g.lang, g.source, kept.term, coalesce(c.n, 0) AS n,
         1 + (1000000000::HUGEINT * (coalesce(c.n, 0) + 2)) // (g.n + 2 * g.v) AS p,
         1 + (1000000000::HUGEINT * (kept.n + 2)) // (g.lang_n + 2 * g.v) AS q
  FROM groups g JOIN kept USING (lang) LEFT JOIN counts c USING (lang, source, term)
),
pairs AS (
  SELECT a.lang, a.source, b.source AS item, sum((a.p - b.p) * (a.p - b.p) // (a.p + b.p))::BIGINT AS value
  FROM shares a JOIN shares b ON a.lang = b.lang AND a.term = b.term AND a.source <> b.source GROUP BY ALL
),
all_pairs AS (
  SELECT a.lang, a.source, 'pair' AS part, b.source AS item, coalesce(value, 0) AS value
  FROM groups a JOIN groups b ON a.lang = b.lang AND a.source <> b.source
  LEFT JOIN pairs ON pairs.lang = a.lang AND pairs.source = a.source AND pairs.item = b.source
),
parts AS (
  SELECT * FROM all_pairs UNION ALL
  SELECT lang, source, 'term', term, ((p - q) * (p - q) // (p + q))::BIGINT FROM shares WHERE n > 0 AND p > q
)
SELECT lang, source, part, item, value,
       row_number() OVER (PARTITION BY lang, source, part ORDER BY value DESC, item)::INTEGER AS rank
FROM parts QUALIFY part = 'pair' OR rank <= 10
"""

NEGATIVES = r"""
WITH rows AS (
  SELECT row_number() OVER () AS k, vec_id,
         (CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END) AS label,
         list_transform(embedding, lambda x: floor(256 * x::DOUBLE)) AS v
  FROM embeddings
  WHERE label IS NOT NULL AND embedding IS NOT NULL
    AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
),
scored AS (
  SELECT a.k AS ak, a.vec_id AS anchor_id, a.label AS anchor_label, b.k, b.vec_id, b.label,
         list_dot_product(a.v, b.v)::BIGINT AS score
  FROM rows a JOIN rows b ON a.vec_id % 100 = 0 AND a.vec_id IS DISTINCT FROM b.vec_id
),
positives AS (
  SELECT ak, anchor_id, anchor_label, vec_id AS positive_id, score AS positive_score,
         row_number() OVER (PARTITION BY ak ORDER BY score DESC, vec_id) AS choice
  FROM scored WHERE label = anchor_label QUALIFY choice <= 5
)
SELECT p.anchor_id, positive_id,
       row_number() OVER (PARTITION BY p.ak, choice ORDER BY score DESC, vec_id)::INTEGER AS rank,
       vec_id AS negative_id, positive_score, score AS negative_score
FROM positives p JOIN scored s
  ON s.ak = p.ak AND s.label <> p.anchor_label
 AND 80 * positive_score::HUGEINT <= 100 * score::HUGEINT AND score <= positive_score
QUALIFY rank <= 5
"""

ORACLES: dict[str, str] = {
    "op2_quality_line_rules": QUALITY,
    "op10_benchmark_automaton": CONTAMINATION,
    "op12_divergence_trees": DIVERGENCE,
    "op13_negatives_packed": NEGATIVES,
}
