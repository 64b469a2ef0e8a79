"""The corpus queries in SQL (DuckDB), where SQL can express them."""

SUBSTRING_DEDUP = r"""
WITH d AS (
  SELECT doc_id, list_filter(regexp_split_to_array(coalesce(text, ''), '[ \t\n\x0B\f\r]+'), lambda x: x <> '') AS w FROM documents
), starts AS (
  SELECT doc_id, i, sha256(array_to_string(w[i:i + 34], ' ')) AS h
  FROM d, unnest(range(1, len(w) - 33)) AS t(i) WHERE len(w) >= 35
), again AS (
  SELECT doc_id, i FROM starts WHERE h IN (SELECT h FROM starts GROUP BY h HAVING count(*) > 1)
), gone AS (
  SELECT DISTINCT doc_id, i + k AS p FROM again, range(0, 35) AS t(k)
), kept AS (
  SELECT d.doc_id, p, w[p] AS word FROM d, unnest(range(1, len(w) + 1)) AS t(p)
  WHERE NOT EXISTS (SELECT 1 FROM gone WHERE gone.doc_id = d.doc_id AND gone.p = t.p)
), text_of AS (SELECT doc_id, string_agg(word, ' ' ORDER BY p) AS s, count(*) AS n FROM kept GROUP BY doc_id)
SELECT d.doc_id, CAST(len(w) AS BIGINT) AS n_words, CAST(len(w) - coalesce(n, 0) AS BIGINT) AS n_removed,
  sha256(coalesce(s, '')) AS kept_sha256
FROM d LEFT JOIN text_of USING (doc_id)
"""

DECONTAMINATION = r"""
WITH d AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM documents
), b AS (
  SELECT item_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM benchmark
), item_windows AS (
  SELECT DISTINCT item_id, least(len(w), 10) AS n, array_to_string(w[i:i + least(len(w), 10) - 1], ' ') AS s
  FROM b, unnest(range(1, len(w) - least(len(w), 10) + 2)) AS t(i) WHERE len(w) > 0
), sizes AS (SELECT DISTINCT n FROM item_windows),
doc_windows AS (
  SELECT doc_id, n, i, array_to_string(w[i:i + n - 1], ' ') AS s
  FROM d, sizes, unnest(range(1, greatest(len(w) - n + 2, 1))) AS t(i)
), found AS (SELECT doc_id, item_id, n, i FROM doc_windows JOIN item_windows USING (n, s)),
hit AS (SELECT doc_id, count(DISTINCT i + k) AS n_hit FROM found, unnest(range(0, n)) AS t(k) GROUP BY doc_id),
items AS (
  SELECT doc_id, count(*) AS n_items, string_agg(item, ',' ORDER BY item) AS list
  FROM (SELECT DISTINCT doc_id, CAST(item_id AS VARCHAR) AS item FROM found) GROUP BY doc_id
)
SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words, CAST(coalesce(n_hit, 0) AS BIGINT) AS n_hit,
  CAST(coalesce(n_items, 0) AS BIGINT) AS n_items, sha256(coalesce(list, '')) AS items_sha256,
  coalesce(n_hit, 0) > 0 AS contaminated
FROM d LEFT JOIN hit USING (doc_id) LEFT JOIN items USING (doc_id)
"""

NGRAM_JOIN = r"""
WITH RECURSIVE d AS (
  SELECT doc_id, list_filter(regexp_split_to_array(coalesce(text, ''), '[ \t\n\x0B\f\r]+'), lambda x: x <> '') AS w FROM documents
), grams AS (
  SELECT DISTINCT doc_id, hash(array_to_string(w[i:i + 4], ' ')) AS g
  FROM d, unnest(range(1, greatest(len(w) - 4, 1) + 1)) AS t(i) WHERE len(w) > 0
), sizes AS (SELECT doc_id, count(*) AS n FROM grams GROUP BY doc_id),
shared AS (
  SELECT a.doc_id AS x, b.doc_id AS y, count(*) AS common FROM grams a JOIN grams b ON a.g = b.g AND a.doc_id <> b.doc_id GROUP BY ALL
), links AS (
  SELECT x, y FROM shared JOIN sizes p ON p.doc_id = x JOIN sizes q ON q.doc_id = y WHERE common >= 0.8 * (p.n + q.n - common)
), reached(x, y) AS (SELECT doc_id, doc_id FROM d UNION SELECT r.x, l.y FROM reached r JOIN links l ON l.x = r.y),
classes AS (SELECT x AS doc_id, min(y) AS class_id, count(*) AS class_size FROM reached GROUP BY x),
counted AS (SELECT x AS doc_id, count(*) AS n_links FROM links GROUP BY x)
SELECT doc_id, class_id, class_size, coalesce(n_links, 0) AS n_links, doc_id = class_id AS first
FROM classes LEFT JOIN counted USING (doc_id)
"""

TOP_K = r"""
WITH v AS (
  SELECT vec_id, list_transform(embedding, lambda x: floor(64 * CAST(x AS DOUBLE))) AS e FROM embeddings
  WHERE vec_id IS NOT NULL AND embedding IS NOT NULL
    AND len(list_filter(embedding, lambda x: x IS NULL OR isnan(x) OR isinf(x))) = 0
), pairs AS (
  SELECT q.vec_id AS query_id, c.vec_id, CAST(list_dot_product(q.e, c.e) AS BIGINT) AS score
  FROM v q, v c WHERE q.vec_id % 20 = 0 AND q.vec_id <> c.vec_id
), ranked AS (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS rank FROM pairs)
SELECT query_id, CAST(rank AS INTEGER) AS rank, vec_id, score FROM ranked WHERE rank <= 20
"""

RESAMPLING = r"""
WITH steps AS (
  SELECT list(CAST(list_reduce([n, 0, 0, 0, 0, 0, 0, 0, 0],
    lambda c, x: CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END) AS BIGINT) ORDER BY n) AS step
  FROM (SELECT CAST(n AS BIGINT) AS n FROM range(256) AS t(n))
), words AS (
  SELECT 'd' AS side, doc_id, unnest(regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+')) AS word FROM documents
  UNION ALL
  SELECT 'b', item_id, unnest(regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+')) FROM benchmark
), hexed AS (SELECT DISTINCT word, hex(encode(word)) AS h FROM words),
coded AS (
  SELECT word, xor(list_reduce(list_prepend(CAST(4294967295 AS BIGINT),
      list_transform(range(0, length(h) // 2), lambda i: CAST('0x' || substr(h, 2 * i + 1, 2) AS BIGINT))),
    lambda c, b: xor(c >> 8, step[(xor(c, b) & 255) + 1])), 4294967295) % 10000 AS bucket
  FROM hexed, steps
), counts AS (
  SELECT bucket, count(*) FILTER (side = 'd') AS s, count(*) FILTER (side = 'b') AS t FROM words JOIN coded USING (word) GROUP BY bucket
), totals AS (SELECT coalesce(sum(s), 0) AS ss, coalesce(sum(t), 0) AS tt FROM counts),
gains AS (
  SELECT bucket, CAST(floor(1000 * ln((CAST(t AS DOUBLE) + 1) * (CAST(ss AS DOUBLE) + 10000) / ((CAST(s AS DOUBLE) + 1) * (CAST(tt AS DOUBLE) + 10000)))) AS BIGINT) AS gain
  FROM counts, totals
), weighed AS (
  SELECT doc_id, count(*) AS n, sum(gain) AS w FROM words JOIN coded USING (word) JOIN gains USING (bucket) WHERE side = 'd' GROUP BY doc_id
), scored AS (
  SELECT doc_id, CAST(coalesce(n, 0) AS BIGINT) AS n_features, CAST(coalesce(w, 0) AS BIGINT) AS weight,
    CAST(coalesce(w, 0) + floor(-1000 * ln(-ln((CAST('0x' || substr(sha256('2024:' || doc_id), 1, 8) AS BIGINT) + 0.5::DOUBLE) / 4294967296::DOUBLE))) AS BIGINT) AS score
  FROM documents LEFT JOIN weighed USING (doc_id)
), placed AS (SELECT doc_id, row_number() OVER (ORDER BY score DESC, doc_id) AS place FROM scored WHERE n_features >= 20),
drawn AS (SELECT 10 * count(*) // 100 AS most FROM placed)
SELECT doc_id, n_features AS n_words, n_features, weight, score, CASE WHEN place <= most THEN place END AS rank
FROM scored LEFT JOIN placed USING (doc_id), drawn
"""

ORACLE = {
    "op1_substring_dedup": SUBSTRING_DEDUP,
    "op5_decontamination": DECONTAMINATION,
    "op7_top_k": TOP_K,
    "op10_ngram_join": NGRAM_JOIN,
    "op13_resampling": RESAMPLING,
}
