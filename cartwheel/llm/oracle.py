"""SQL counterparts of the queries that SQL can express."""

OP8 = """
WITH d AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+') AS w FROM documents),
i AS (
  SELECT CAST(item_id AS VARCHAR) AS item, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+') AS w FROM benchmark),
iw AS (
  SELECT DISTINCT item, least(len(w), 13) AS n, array_to_string(w[s : s + least(len(w), 13) - 1], ' ') AS win
  FROM i, unnest(range(1, greatest(2, len(w) - 11))) AS u(s) WHERE len(w) > 0),
sizes AS (SELECT DISTINCT n FROM iw),
dw AS (
  SELECT doc_id, s, n, array_to_string(w[s : s + n - 1], ' ') AS win
  FROM d, sizes, unnest(range(1, len(w) - n + 2)) AS u(s) WHERE len(w) >= n),
m AS (SELECT doc_id, s, dw.n AS n, item FROM dw JOIN iw ON dw.win = iw.win AND dw.n = iw.n),
h AS (SELECT doc_id, count(DISTINCT s + k) AS n_hit FROM m, unnest(range(0, m.n)) AS u(k) GROUP BY doc_id),
t AS (SELECT doc_id, count(DISTINCT item) AS n_items, string_agg(DISTINCT item, ',' ORDER BY item) AS items FROM m GROUP BY doc_id)
SELECT d.doc_id, CAST(len(w) AS BIGINT) AS n_words, CAST(coalesce(n_hit, 0) AS BIGINT) AS n_hit,
  CAST(coalesce(n_items, 0) AS BIGINT) AS n_items, sha256(coalesce(items, '')) AS items_sha256,
  coalesce(n_hit, 0) > 0 AND 20 * coalesce(n_hit, 0) >= len(w) AS contaminated
FROM d LEFT JOIN h USING (doc_id) LEFT JOIN t USING (doc_id)
"""

OP4 = """
WITH p AS (
  SELECT page_id, strlen(coalesce(html, '')) AS n, sha256(coalesce(html, '')) AS digest FROM pages),
f AS (SELECT digest, min(page_id) AS first FROM p WHERE n >= 100 GROUP BY digest)
SELECT page_id, n AS payload_bytes, p.digest AS payload_digest,
  CASE WHEN page_id <> first THEN 'revisit' ELSE 'response' END AS record_type,
  CASE WHEN page_id <> first THEN first END AS refers_to
FROM p LEFT JOIN f ON p.digest = f.digest
"""

OP7 = """
WITH RECURSIVE w AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[^\\x20\\x09-\\x0D]+') AS w FROM documents),
s AS (
  SELECT DISTINCT doc_id, array_to_string(w[i : i + least(len(w), 3) - 1], ' ') AS shingle
  FROM w, unnest(range(1, greatest(2, len(w) - 1))) AS u(i) WHERE len(w) > 0),
n AS (SELECT w.doc_id, count(shingle) AS n FROM w LEFT JOIN s USING (doc_id) GROUP BY w.doc_id),
p AS (
  SELECT a.doc_id AS x, b.doc_id AS y, count(*) AS i FROM s a JOIN s b ON a.shingle = b.shingle AND a.doc_id < b.doc_id GROUP BY ALL),
l AS (
  SELECT x, y FROM p JOIN n nx ON nx.doc_id = x JOIN n ny ON ny.doc_id = y WHERE 100 * i >= 90 * (nx.n + ny.n - i)),
e AS (SELECT x, y FROM l UNION ALL SELECT y, x FROM l),
r(doc_id, root) AS (SELECT doc_id, doc_id FROM n UNION SELECT e.y, r.root FROM r JOIN e ON r.doc_id = e.x)
SELECT n.doc_id, n.n AS n_shingles, c.root AS component_id
FROM n JOIN (SELECT doc_id, min(root) AS root FROM r GROUP BY doc_id) c ON c.doc_id = n.doc_id
"""

OP13 = """
WITH d AS (
  SELECT row_number() OVER () AS row, doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[^\\x00-\\x2F\\x3A-\\x40\\x5B-\\x60\\x7B-\\x7F]+') AS w FROM documents),
i AS (
  SELECT row_number() OVER () AS item, item_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[^\\x00-\\x2F\\x3A-\\x40\\x5B-\\x60\\x7B-\\x7F]+') AS w FROM benchmark),
q AS (SELECT item, item_id, term, count(*) AS r FROM (SELECT item, item_id, unnest(w) AS term FROM i) GROUP BY ALL),
s AS (SELECT count(*) AS docs, CAST(sum(len(w)) AS BIGINT) AS words FROM d WHERE len(w) > 0),
p AS (
  SELECT row, doc_id, n, term, count(*) AS tf FROM (SELECT row, doc_id, len(w) AS n, unnest(w) AS term FROM d)
  WHERE term IN (SELECT term FROM q) GROUP BY ALL),
f AS (SELECT term, count(*) AS df FROM p GROUP BY term),
c AS (
  SELECT p.row, p.doc_id, p.term, CAST(floor(1000 * ln(CAST(2 * docs + 2 AS DOUBLE) / (2 * df + 1))) AS BIGINT)
    * ((1000000000 * tf) // (1000 * tf + 8 * (25 + (75 * n * docs) // words))) AS impact
  FROM p JOIN f ON f.term = p.term CROSS JOIN s),
t AS (
  SELECT item, item_id, row, doc_id, CAST(sum(r * impact) AS BIGINT) AS score FROM q JOIN c ON c.term = q.term GROUP BY ALL HAVING sum(r * impact) > 0),
k AS (SELECT *, row_number() OVER (PARTITION BY item ORDER BY score DESC, doc_id NULLS LAST, row) AS rank FROM t)
SELECT item_id, CAST(rank AS INTEGER) AS rank, doc_id, score FROM k WHERE rank <= 10
"""

ORACLE = {"op4_warc": OP4, "op7_jaccard_join": OP7, "op8_decontamination": OP8, "op13_nra_search": OP13}
