"""The same rows in DuckDB SQL, for the operators that SQL can express over the whole test tables."""

NGRAM_JOIN = r"""
WITH RECURSIVE w AS (SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+') AS ws FROM documents),
s AS (SELECT doc_id, unnest(CASE WHEN len(ws) >= 4 THEN list_transform(range(1, len(ws) - 2), lambda i: array_to_string(ws[i:i + 3], ' ')) ELSE [array_to_string(ws, ' ')] END) AS g FROM w WHERE len(ws) > 0),
d AS (SELECT DISTINCT doc_id, g FROM s),
n AS (SELECT doc_id, count(*) AS n FROM d GROUP BY doc_id),
f AS (SELECT g FROM d GROUP BY g HAVING count(*) > 1),
e AS (SELECT * FROM d WHERE g IN (SELECT g FROM f)),
o AS (SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS i FROM e a JOIN e b ON a.g = b.g AND a.doc_id <> b.doc_id GROUP BY ALL),
l AS (SELECT a, b FROM o JOIN n x ON x.doc_id = a JOIN n y ON y.doc_id = b WHERE 100 * i >= 85 * (x.n + y.n - i)),
r(doc_id, reach) AS (SELECT doc_id, doc_id FROM documents UNION SELECT r.doc_id, l.b FROM r JOIN l ON l.a = r.reach)
SELECT documents.doc_id, coalesce(n.n, 0) AS n_shingles, c AS component_id, coalesce(k, 0) AS n_links
FROM documents JOIN (SELECT doc_id, min(reach) AS c FROM r GROUP BY doc_id) USING (doc_id) LEFT JOIN n USING (doc_id) LEFT JOIN (SELECT a AS doc_id, count(*) AS k FROM l GROUP BY a) USING (doc_id)
"""

SUBSTRING_DEDUP = r"""
WITH w AS (SELECT doc_id, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS ws FROM documents),
s AS (SELECT doc_id, ws, unnest(range(1, len(ws) - 48)) AS i FROM w WHERE len(ws) >= 50),
h AS (SELECT doc_id, i, sha256(array_to_string(ws[i:i + 49], ' ')) AS h FROM s),
f AS (SELECT h, min(doc_id) AS least FROM h GROUP BY h),
g AS (SELECT h.doc_id, i FROM h JOIN f USING (h) WHERE least < h.doc_id),
e AS (SELECT doc_id, i AS pos, 1 AS d FROM g UNION ALL SELECT doc_id, i + 50, -1 FROM g),
c AS (SELECT doc_id, pos, sum(d) AS d FROM e GROUP BY ALL),
p AS (SELECT w.doc_id, unnest(ws) AS word, generate_subscripts(ws, 1) AS pos FROM w),
q AS (SELECT p.doc_id, p.pos, word, sum(coalesce(d, 0)) OVER (PARTITION BY p.doc_id ORDER BY p.pos) > 0 AS gone FROM p LEFT JOIN c USING (doc_id, pos))
SELECT w.doc_id, len(ws)::BIGINT AS n_words, coalesce(r, 0)::BIGINT AS n_removed, sha256(coalesce(kept, '')) AS kept_sha256
FROM w LEFT JOIN (SELECT doc_id, count(*) FILTER (WHERE gone) AS r, string_agg(word, ' ' ORDER BY pos) FILTER (WHERE NOT gone) AS kept FROM q GROUP BY doc_id) USING (doc_id)
"""

LINE_DEDUP = r"""
WITH l AS (SELECT doc_id, unnest(ls) AS line, generate_subscripts(ls, 1) AS n FROM (SELECT doc_id, string_split(coalesce(text, ''), chr(10)) AS ls FROM documents)),
k AS (SELECT *, translate(trim(line, ' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS key FROM l),
r AS (SELECT key, max(doc_id) AS last FROM k WHERE length(key) >= 20 GROUP BY key HAVING count(DISTINCT doc_id) >= 3),
m AS (SELECT k.*, r.last IS NOT NULL AND k.doc_id < r.last AS gone FROM k LEFT JOIN r USING (key))
SELECT doc_id, count(*) AS n_lines, count(*) FILTER (WHERE gone) AS n_dropped, sha256(coalesce(string_agg(line, chr(10) ORDER BY n) FILTER (WHERE NOT gone), '')) AS kept_sha256 FROM m GROUP BY doc_id
"""

SUFFIX_DEDUP = r"""
WITH b AS (SELECT doc_id, hex(encode(coalesce(text, ''))) AS x FROM documents),
s AS (SELECT doc_id, x, unnest(range(length(x) // 2 - 199)) AS i FROM b WHERE length(x) >= 400),
h AS (SELECT doc_id, i, hash(substr(x, 2 * i + 1, 400)) AS h FROM s),
f AS (SELECT h FROM h GROUP BY h HAVING count(*) > 1),
g AS (SELECT doc_id, i, i - row_number() OVER (PARTITION BY doc_id ORDER BY i) AS run FROM h WHERE h IN (SELECT h FROM f)),
r AS (SELECT doc_id, min(i) AS a, max(i) + 200 AS z FROM g GROUP BY doc_id, run),
m AS (SELECT *, CASE WHEN a <= max(z) OVER (PARTITION BY doc_id ORDER BY a ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) THEN 0 ELSE 1 END AS fresh FROM r),
n AS (SELECT *, sum(fresh) OVER (PARTITION BY doc_id ORDER BY a) AS k FROM m),
t AS (SELECT doc_id, k, min(a) AS a, max(z) AS z FROM n GROUP BY ALL),
u AS (SELECT t.*, lead(a) OVER (PARTITION BY doc_id ORDER BY a) AS nxt FROM t),
v AS (SELECT u.doc_id, count(*) AS n_spans, sum(z - a) AS n_removed, substr(any_value(x), 1, 2 * min(a)::INT) || string_agg(substr(x, 2 * z::INT + 1, 2 * (coalesce(nxt, length(x) // 2) - z)::INT), '' ORDER BY a) AS kept FROM u JOIN b USING (doc_id) GROUP BY u.doc_id)
SELECT b.doc_id, (length(x) // 2)::BIGINT AS n_bytes, coalesce(n_removed, 0)::BIGINT AS n_removed, coalesce(n_spans, 0)::BIGINT AS n_spans, sha256(unhex(coalesce(kept, x))) AS kept_sha256 FROM b LEFT JOIN v USING (doc_id)
"""
