"""Reference SQL of the operators that SQL can express, by plain counting of all windows."""

WORDS = r"[^\x20\x09-\x0D]+"
LOWERED = "translate({}, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"

OP4 = rf"""
WITH w AS (
  SELECT doc_id, regexp_extract_all(coalesce(text, ''), '{WORDS}') AS words FROM documents
), s AS (
  SELECT doc_id, p, md5(array_to_string(words[p:p + 49], ' ')) AS h
  FROM (SELECT doc_id, words, unnest(range(1, len(words) - 48)) AS p FROM w)
), least AS (SELECT h, min(doc_id) AS first FROM s GROUP BY h),
gone AS (
  SELECT DISTINCT doc_id, unnest(range(p, p + 50)) AS p
  FROM s JOIN least USING (h) WHERE first < doc_id
), each AS (
  SELECT doc_id, unnest(words) AS word, unnest(range(1, len(words) + 1)) AS p FROM w
), kept AS (
  SELECT doc_id, string_agg(word, ' ' ORDER BY p) AS kept, count(*) AS n
  FROM each ANTI JOIN gone USING (doc_id, p) GROUP BY doc_id
)
SELECT doc_id, len(words)::BIGINT AS n_words, (len(words) - coalesce(n, 0))::BIGINT AS n_removed,
       sha256(coalesce(kept, '')) AS kept_sha256
FROM w LEFT JOIN kept USING (doc_id)
"""

OP5 = """
WITH b AS (SELECT doc_id, hex(encode(coalesce(text, ''))) AS x FROM documents),
s AS (
  SELECT doc_id, p, hash(substr(x, 2 * p + 1, 800)) AS h
  FROM (SELECT doc_id, x, unnest(range(0, length(x) // 2 - 399)) AS p FROM b)
), twice AS (SELECT h FROM s GROUP BY h HAVING count(*) > 1),
hits AS (SELECT doc_id, p FROM s SEMI JOIN twice USING (h)),
edges AS (
  SELECT doc_id, p, max(p + 400) OVER (PARTITION BY doc_id ORDER BY p ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS upto
  FROM hits
), numbered AS (
  SELECT doc_id, p, sum(CASE WHEN upto IS NULL OR p > upto THEN 1 ELSE 0 END) OVER (PARTITION BY doc_id ORDER BY p) AS g
  FROM edges
), spans AS (SELECT doc_id, g, min(p) AS a, max(p) + 400 AS b FROM numbered GROUP BY doc_id, g),
gaps AS (
  SELECT doc_id, a, b, lag(b, 1, 0) OVER (PARTITION BY doc_id ORDER BY a) AS before FROM spans
), pieces AS (
  SELECT doc_id, a, substr(x, 2 * before + 1, 2 * (a - before)) AS piece FROM gaps JOIN b USING (doc_id)
  UNION ALL
  SELECT doc_id, m, substr(x, 2 * m + 1)
  FROM (SELECT doc_id, max(b) AS m FROM spans GROUP BY doc_id) JOIN b USING (doc_id)
), kept AS (SELECT doc_id, string_agg(piece, '' ORDER BY a) AS kept FROM pieces GROUP BY doc_id),
sums AS (SELECT doc_id, sum(b - a) AS removed, count(*) AS n FROM spans GROUP BY doc_id)
SELECT doc_id, (length(x) // 2)::BIGINT AS n_bytes, coalesce(removed, 0)::BIGINT AS n_removed,
       coalesce(n, 0)::BIGINT AS n_spans, sha256(unhex(coalesce(kept, x))) AS kept_sha256
FROM b LEFT JOIN kept USING (doc_id) LEFT JOIN sums USING (doc_id)
"""

OP6 = rf"""
WITH RECURSIVE w AS (
  SELECT doc_id, regexp_extract_all({LOWERED.format("coalesce(text, '')")}, '{WORDS}') AS words FROM documents
), s AS (
  SELECT DISTINCT doc_id, md5(array_to_string(words[p:p + 3], ' ')) AS h
  FROM (SELECT doc_id, words, unnest(range(1, greatest(len(words) - 2, 2))) AS p FROM w WHERE len(words) > 0)
), n AS (SELECT doc_id, count(*) AS n FROM s GROUP BY doc_id),
shared AS (
  SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS k FROM s a JOIN s b USING (h)
  WHERE a.doc_id <> b.doc_id GROUP BY a.doc_id, b.doc_id
), links AS (
  SELECT a, b FROM shared JOIN n x ON x.doc_id = a JOIN n y ON y.doc_id = b
  WHERE 100 * k >= 80 * (x.n + y.n - k)
), reach(doc_id, r) AS (
  SELECT doc_id, doc_id FROM documents
  UNION
  SELECT reach.doc_id, links.b FROM reach JOIN links ON links.a = reach.r WHERE links.b < reach.doc_id OR links.b <> reach.r
), least AS (SELECT doc_id, min(r) AS component_id FROM reach GROUP BY doc_id)
SELECT doc_id, coalesce(n, 0)::BIGINT AS n_shingles, component_id, doc_id = component_id AS kept
FROM least LEFT JOIN n USING (doc_id)
"""

BENCH_WORDS = r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+"
OP10 = rf"""
WITH d AS (
  SELECT doc_id, regexp_extract_all({LOWERED.format("coalesce(text, '')")}, '{BENCH_WORDS}') AS words FROM documents
), i AS (
  SELECT item_id, regexp_extract_all({LOWERED.format("coalesce(text, '')")}, '{BENCH_WORDS}') AS words FROM benchmark
), g AS (
  SELECT DISTINCT item_id, l, array_to_string(words[p:p + l - 1], ' ') AS gram
  FROM (SELECT item_id, words, least(13, len(words)) AS l, unnest(range(1, len(words) - least(13, len(words)) + 2)) AS p
        FROM i WHERE len(words) > 0)
), s AS (
  SELECT doc_id, l, p, array_to_string(words[p:p + l - 1], ' ') AS gram
  FROM (SELECT doc_id, words, l, unnest(range(1, len(words) - l + 2)) AS p
        FROM d, (SELECT DISTINCT l FROM g))
), hits AS (SELECT doc_id, s.l, p, item_id FROM s JOIN g ON s.l = g.l AND s.gram = g.gram),
n AS (
  SELECT doc_id, count(*) AS n_hit
  FROM (SELECT DISTINCT doc_id, unnest(range(p, p + l)) AS p FROM hits) GROUP BY doc_id
), t AS (
  SELECT doc_id, count(*) AS n_items, string_agg(item, ',' ORDER BY item) AS items
  FROM (SELECT DISTINCT doc_id, item_id::VARCHAR AS item FROM hits) GROUP BY doc_id
)
SELECT doc_id, len(words)::BIGINT AS n_words, coalesce(n_hit, 0)::BIGINT AS n_hit, coalesce(n_items, 0)::BIGINT AS n_items,
       sha256(coalesce(items, '')) AS items_sha256, coalesce(n_hit > 0 AND 20 * n_hit >= len(words), false) AS contaminated
FROM d LEFT JOIN n USING (doc_id) LEFT JOIN t USING (doc_id)
"""

UNITS = r"[\x20\x09-\x0D]*[^\x20\x09-\x0D]+|[\x20\x09-\x0D]+"
OP11 = rf"""
WITH d AS (
  SELECT doc_id, coalesce(text, '') AS t, regexp_extract_all(coalesce(text, ''), '{UNITS}') AS u,
         sha256('42:' || coalesce(doc_id::VARCHAR, '')) AS h
  FROM documents
), k AS (
  SELECT *, len(u) AS n, ('0x' || h[1:8])::BIGINT AS h1, ('0x' || h[9:16])::BIGINT AS h2,
         ('0x' || h[17:24])::BIGINT AS h3, ('0x' || h[25:32])::BIGINT AS h4
  FROM d
), c AS (
  SELECT *, least(h1 % (n + 1), h2 % (n + 1)) AS a, greatest(h1 % (n + 1), h2 % (n + 1)) AS b,
         CASE WHEN t = '' OR contains(t, '<P>') OR contains(t, '<S>') OR contains(t, '<M>') OR h3 % 100 >= 50 THEN 'plain'
              WHEN h4 % 100 < 80 THEN 'spm' ELSE 'psm' END AS form
  FROM k
), p AS (
  SELECT *, array_to_string(u[1:a], '') AS prefix, array_to_string(u[a + 1:b], '') AS middle,
         array_to_string(u[b + 1:n], '') AS suffix
  FROM c
)
SELECT doc_id, n::BIGINT AS n, form, CASE WHEN form <> 'plain' THEN length(prefix) END::BIGINT AS prefix_chars,
       CASE WHEN form <> 'plain' THEN length(middle) END::BIGINT AS middle_chars,
       sha256(CASE form WHEN 'plain' THEN t WHEN 'psm' THEN '<P>' || prefix || '<S>' || suffix || '<M>' || middle
                        ELSE '<S>' || suffix || '<P>' || prefix || '<M>' || middle END) AS output_sha256,
       sha256(t) AS restored_sha256
FROM p
"""
