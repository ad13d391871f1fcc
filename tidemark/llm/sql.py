"""SQL counterparts of the registered queries, for DuckDB."""

FOLD = "translate({}, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"

EXACT = f"""
WITH t AS (SELECT doc_id, {FOLD.format("coalesce(text, '')")} AS body FROM documents),
g AS (SELECT body, max(doc_id) AS keep_id, count(*) AS group_size FROM t GROUP BY body)
SELECT doc_id, keep_id, group_size, doc_id IS NOT DISTINCT FROM keep_id AS kept, sha256(body) AS text_sha256
FROM t JOIN g USING (body)
"""

WORDS = r"'[^\x20\x09-\x0D]+'"

MIXING = f"""
WITH d AS (
  SELECT doc_id, source, coalesce(len(regexp_extract_all(text, {WORDS})), 0)::BIGINT AS size FROM documents
),
s AS (
  SELECT source, sum(size)::BIGINT AS source_size,
    (row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3 + 1 AS weight
  FROM d GROUP BY source
),
w AS (
  SELECT *, row_number() OVER (ORDER BY 3.0 * source_size::DOUBLE / weight, source NULLS LAST) AS step,
    sum(source_size) OVER () - coalesce(sum(3 * source_size) OVER
      (ORDER BY 3.0 * source_size::DOUBLE / weight, source NULLS LAST ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS left_size,
    sum(weight) OVER () - coalesce(sum(weight) OVER
      (ORDER BY 3.0 * source_size::DOUBLE / weight, source NULLS LAST ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS left_weight
  FROM s
),
l AS (SELECT *, left_size::DOUBLE / left_weight::DOUBLE AS level FROM w),
f AS (SELECT min(step) AS first_step, arg_min(level, step) AS level_at FROM l WHERE level * weight <= 3 * source_size),
t AS (
  SELECT source, source_size,
    CASE WHEN step < first_step THEN 3.0::DOUBLE * source_size ELSE least(level_at * weight, 3.0::DOUBLE * source_size) END AS target
  FROM l, f
),
r AS (
  SELECT doc_id, size, source_size, target,
    CASE WHEN source_size > 0 THEN target / source_size::DOUBLE ELSE 0.0 END AS rate
  FROM d JOIN t ON d.source IS NOT DISTINCT FROM t.source
)
SELECT doc_id, size, source_size, target,
  ((floor(rate) + CASE WHEN ('0x' || substr(md5('11|' || coalesce(doc_id::VARCHAR, '')), 1, 13))::BIGINT
      / 4503599627370496.0::DOUBLE < rate - floor(rate) THEN 1 ELSE 0 END) * size)::BIGINT AS taken
FROM r
"""

URLS = f"""
WITH p AS (
  SELECT page_id, url, {FOLD.format("regexp_extract(coalesce(url, ''), '://([^/?#]*)', 1)")} AS host,
    regexp_extract(coalesce(url, ''), '://[^/?#]*([^?#]*)', 1) AS path
  FROM pages
),
r(h, q, v) AS (VALUES ('net', '/', 'block'), ('example.net', '/en/', 'allow'),
  ('example.com', '/de/', 'block'), ('org', '/fr/', 'allow')),
u AS (SELECT DISTINCT host, path FROM p WHERE url IS NOT NULL AND host <> '' AND md5(page_id::VARCHAR)[1] = '0'),
m AS (
  SELECT host, path, arg_max(h || q, length(h || q)) AS rule, arg_max(v, length(h || q)) AS v
  FROM (SELECT DISTINCT host, path FROM p) JOIN r
    ON (host = h OR host LIKE '%.' || h) AND starts_with(path, q)
  GROUP BY host, path
)
SELECT page_id, p.host, p.path, m.rule, u.host IS NOT NULL AS listed,
  CASE WHEN m.rule IS NOT NULL THEN m.v WHEN u.host IS NOT NULL THEN 'block' ELSE 'allow' END AS verdict
FROM p LEFT JOIN m USING (host, path) LEFT JOIN u USING (host, path)
"""

PLAIN = r"'[^\x00-\x2F\x3A-\x60\x7B-\x7F]+'"

DECONTAMINATION = f"""
WITH d AS (
  SELECT row_number() OVER () AS rid, doc_id,
    coalesce(regexp_extract_all({FOLD.format("text")}, {PLAIN}), []) AS w FROM documents
),
b AS (SELECT item_id::VARCHAR AS item, regexp_extract_all({FOLD.format("text")}, {PLAIN}) AS w FROM benchmark),
win AS (
  SELECT DISTINCT item, len(x) AS n, x
  FROM (SELECT item, unnest(CASE WHEN len(w) < 13 THEN [w]
    ELSE list_transform(range(1, len(w) - 11), lambda i: w[i:i + 12]) END) AS x FROM b WHERE len(w) > 0)
),
pos AS (
  SELECT rid, n, i, w[i:i + n - 1] AS x
  FROM (SELECT rid, w, n, unnest(range(1, len(w) - n + 2)) AS i FROM d, (SELECT DISTINCT n FROM win))
),
hit AS (SELECT rid, i, pos.n, item FROM pos JOIN win ON pos.n = win.n AND pos.x = win.x),
covered AS (
  SELECT rid, count(DISTINCT k) AS n_hit
  FROM (SELECT rid, unnest(range(i, i + n)) AS k FROM (SELECT DISTINCT rid, i, n FROM hit)) GROUP BY rid
),
named AS (
  SELECT rid, count(DISTINCT item) AS n_items, sha256(string_agg(DISTINCT item, ',' ORDER BY item)) AS digest
  FROM hit GROUP BY rid
)
SELECT doc_id, len(w)::BIGINT AS n_words, coalesce(n_hit, 0)::BIGINT AS n_hit, coalesce(n_items, 0)::BIGINT AS n_items,
  coalesce(digest, sha256('')) AS items_sha256,
  coalesce(n_hit, 0) > 0 AND 20 * coalesce(n_hit, 0) >= len(w) AS contaminated
FROM d LEFT JOIN covered USING (rid) LEFT JOIN named USING (rid)
"""

PASSAGES = f"""
WITH d AS (
  SELECT row_number() OVER () AS rid, doc_id, coalesce(regexp_extract_all(text, {WORDS}), []) AS w FROM documents
),
p AS (
  SELECT rid, doc_id, i, md5(array_to_string(w[i:i + 49], ' ')) AS h
  FROM (SELECT rid, doc_id, w, unnest(range(1, len(w) - 48)) AS i FROM d)
),
hit AS (SELECT rid, i FROM p JOIN (SELECT h, min(doc_id) AS first FROM p GROUP BY h) USING (h) WHERE doc_id > first),
gone AS (SELECT DISTINCT rid, unnest(range(i, i + 50)) AS k FROM hit),
words AS (SELECT rid, unnest(w) AS word, generate_subscripts(w, 1) AS k FROM d),
kept AS (
  SELECT words.rid, count(*) AS n, string_agg(word, ' ' ORDER BY words.k) AS said
  FROM words ANTI JOIN gone USING (rid, k) GROUP BY words.rid
)
SELECT doc_id, len(w)::BIGINT AS n_words, (len(w) - coalesce(n, 0))::BIGINT AS n_removed,
  sha256(coalesce(said, '')) AS kept_sha256
FROM d LEFT JOIN kept USING (rid)
"""

JACCARD = f"""
WITH RECURSIVE d AS (
  SELECT doc_id, coalesce(regexp_extract_all({FOLD.format("text")}, {WORDS}), []) AS w FROM documents
),
s AS (
  SELECT DISTINCT doc_id, unnest(CASE WHEN len(w) = 0 THEN [] WHEN len(w) < 3 THEN [array_to_string(w, ' ')]
    ELSE list_transform(range(1, len(w) - 1), lambda i: array_to_string(w[i:i + 2], ' ')) END) AS g
  FROM d
),
n AS (SELECT doc_id, count(*) AS n FROM s GROUP BY doc_id),
pairs AS (SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS shared FROM s a JOIN s b ON a.g = b.g AND a.doc_id < b.doc_id GROUP BY ALL),
links AS (
  SELECT a, b FROM pairs JOIN n x ON x.doc_id = a JOIN n y ON y.doc_id = b
  WHERE 100 * shared >= 90 * (x.n + y.n - shared)
),
both_ways AS (SELECT a, b FROM links UNION ALL SELECT b, a FROM links),
reach(doc_id, other) AS (
  SELECT doc_id, doc_id FROM d UNION SELECT doc_id, b FROM reach JOIN both_ways ON other = a
)
SELECT d.doc_id, coalesce(n, 0)::BIGINT AS n_shingles, min(other) AS component_id
FROM d LEFT JOIN n USING (doc_id) JOIN reach USING (doc_id) GROUP BY ALL
"""

AUDIT = """
WITH d AS (
  SELECT doc_id, coalesce(lang, '') AS part, coalesce(text, '') AS body,
    regexp_extract_all(coalesce(text, ''), '[^\\x20\\x09-\\x0D]+') AS w
  FROM documents
),
e AS (SELECT body, min(doc_id) AS least FROM d GROUP BY body),
f AS (
  SELECT part, CASE WHEN len(w) < 100 THEN 1 ELSE 0 END
    + CASE WHEN 100 * len(list_distinct(w)) < 80 * len(w) THEN 2 ELSE 0 END
    + CASE WHEN 100 * length(regexp_replace(body, '[^A-Z]', '', 'g')) > 10 * length(body) THEN 4 ELSE 0 END
    + CASE WHEN regexp_matches(body, '[#$%&*|]') THEN 8 ELSE 0 END
    + CASE WHEN doc_id > least THEN 16 ELSE 0 END AS mask,
    CASE WHEN doc_id IN (SELECT doc_id FROM labels WHERE quality = 1) THEN 1 ELSE 0 END AS good,
    CASE WHEN doc_id IN (SELECT doc_id FROM labels WHERE toxic = 1) THEN 1 ELSE 0 END AS toxic
  FROM d JOIN e USING (body)
),
m AS (
  SELECT part, mask, count(*) AS n, sum(good) AS good, sum(toxic) AS toxic FROM f GROUP BY part, mask
),
l(x, b) AS (VALUES ('A', 1), ('B', 2), ('C', 4), ('D', 8), ('E', 16)),
o AS (
  SELECT l1.x || l2.x || l3.x || l4.x || l5.x AS filter_order
  FROM l l1, l l2, l l3, l l4, l l5
  WHERE l1.b + l2.b + l3.b + l4.b + l5.b = 31 AND l1.b | l2.b | l3.b | l4.b | l5.b = 31
),
p AS (
  SELECT filter_order, step::INTEGER AS step,
    (SELECT b FROM l WHERE x = substr(filter_order, step::INTEGER, 1)) AS bit,
    (SELECT coalesce(sum(b), 0)::INTEGER FROM l WHERE strpos(filter_order, x) < step) AS seen
  FROM o, generate_series(1, 5) g(step)
)
SELECT part, filter_order, step,
  sum(CASE WHEN mask & (bit | seen) = 0 THEN n ELSE 0 END)::BIGINT AS kept,
  sum(CASE WHEN mask & bit <> 0 AND mask & seen = 0 THEN n ELSE 0 END)::BIGINT AS removed,
  sum(CASE WHEN mask & bit <> 0 AND mask & seen <> 0 THEN n ELSE 0 END)::BIGINT AS redundant,
  sum(CASE WHEN mask = bit THEN n ELSE 0 END)::BIGINT AS unique_fails,
  sum(CASE WHEN mask & bit <> 0 AND mask & seen = 0 THEN good ELSE 0 END)::BIGINT AS good_lost,
  sum(CASE WHEN mask & bit <> 0 AND mask & seen = 0 THEN toxic ELSE 0 END)::BIGINT AS toxic_lost,
  sum(CASE WHEN mask & bit <> 0 THEN n * (120 // bit_count(mask)) ELSE 0 END)::BIGINT AS shapley
FROM m, p
GROUP BY part, filter_order, step, bit, seen
"""
