"""DuckDB SQL for the operators that SQL can express, over the whole shared tables."""

WORDS = r"'[^\x20\x09-\x0D]+'"
SUBSTRING_SQL = f"""
WITH w AS (SELECT doc_id, regexp_extract_all(coalesce(text, ''), {WORDS}) AS ws FROM documents),
windows AS (SELECT doc_id, i, array_to_string(ws[i:i + 34], ' ') AS k FROM (SELECT doc_id, ws, unnest(generate_series(1, len(ws) - 34)) AS i FROM w)),
found AS (SELECT doc_id, i FROM (SELECT doc_id, i, count(*) OVER (PARTITION BY k) AS c FROM windows) WHERE c > 1),
gone AS (SELECT DISTINCT doc_id, unnest(generate_series(i, i + 34)) AS j FROM found),
every AS (SELECT doc_id, unnest(ws) AS word, generate_subscripts(ws, 1) AS j FROM w),
marked AS (SELECT e.doc_id, e.j, e.word, g.j IS NOT NULL AS out FROM every e LEFT JOIN gone g ON g.doc_id = e.doc_id AND g.j = e.j),
edges AS (SELECT *, out AND NOT coalesce(lag(out) OVER (PARTITION BY doc_id ORDER BY j), false) AS starts FROM marked)
SELECT w.doc_id, CAST(len(w.ws) AS BIGINT) AS n_words, count(*) FILTER (WHERE e.out) AS n_removed, count(*) FILTER (WHERE e.starts) AS n_spans, sha256(coalesce(string_agg(e.word, ' ' ORDER BY e.j) FILTER (WHERE NOT e.out), '')) AS kept_sha256
FROM w LEFT JOIN edges e ON e.doc_id = w.doc_id GROUP BY w.doc_id, w.ws
"""
SUFFIX_SQL = """
WITH h AS (SELECT doc_id, hex(encode(coalesce(text, ''))) AS h FROM documents),
windows AS (SELECT doc_id, i, substr(h, 2 * i - 1, 200) AS k FROM (SELECT doc_id, h, unnest(generate_series(1, CAST(len(h) / 2 AS BIGINT) - 99)) AS i FROM h)),
found AS (SELECT doc_id, i FROM (SELECT doc_id, i, row_number() OVER (PARTITION BY k ORDER BY doc_id, i) AS n FROM windows) WHERE n > 1),
runs AS (SELECT doc_id, min(i) AS a, max(i) + 100 AS b FROM (SELECT doc_id, i, sum(fresh) OVER (PARTITION BY doc_id ORDER BY i) AS run FROM (SELECT doc_id, i, CASE WHEN i <= lag(i) OVER (PARTITION BY doc_id ORDER BY i) + 100 THEN 0 ELSE 1 END AS fresh FROM found)) GROUP BY doc_id, run),
gaps AS (SELECT doc_id, b AS a, lead(a) OVER (PARTITION BY doc_id ORDER BY a) AS b FROM (SELECT doc_id, a, b FROM runs UNION ALL SELECT doc_id, 0, 1 FROM h)),
kept AS (SELECT g.doc_id, string_agg(substr(h.h, 2 * g.a - 1, 2 * (coalesce(g.b, CAST(len(h.h) / 2 AS BIGINT) + 1) - g.a)), '' ORDER BY g.a) AS k FROM gaps g JOIN h ON h.doc_id = g.doc_id GROUP BY g.doc_id)
SELECT h.doc_id, CAST(len(h.h) / 2 AS BIGINT) AS n_bytes, CAST(len(h.h) / 2 - len(k.k) / 2 AS BIGINT) AS n_removed, (SELECT count(*) FROM runs r WHERE r.doc_id = h.doc_id) AS n_spans, sha256(unhex(k.k)) AS kept_sha256 FROM h JOIN kept k ON k.doc_id = h.doc_id
"""
NEAR_SQL = f"""
WITH RECURSIVE w AS (SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), {WORDS}) AS ws FROM documents),
s AS (SELECT DISTINCT doc_id, array_to_string(ws[i:i + 4], ' ') AS k FROM (SELECT doc_id, ws, unnest(generate_series(1, greatest(len(ws) - 4, 1))) AS i FROM w WHERE len(ws) > 0)),
n AS (SELECT w.doc_id, count(s.k) AS n FROM w LEFT JOIN s ON s.doc_id = w.doc_id GROUP BY w.doc_id),
common AS (SELECT a.doc_id AS x, b.doc_id AS y, count(*) AS c FROM s a JOIN s b ON a.k = b.k AND a.doc_id < b.doc_id GROUP BY ALL),
links AS (SELECT x, y FROM common JOIN n a ON a.doc_id = x JOIN n b ON b.doc_id = y WHERE 100 * c >= 85 * (a.n + b.n - c)),
ways AS (SELECT x, y FROM links UNION ALL SELECT y, x FROM links),
reach AS (SELECT doc_id AS x, doc_id AS y FROM n UNION SELECT r.x, b.y FROM reach r JOIN ways b ON b.x = r.y)
SELECT n.doc_id, n.n AS n_shingles, min(r.y) AS component_id, n.doc_id = min(r.y) AS kept FROM n JOIN reach r ON r.x = n.doc_id GROUP BY n.doc_id, n.n
"""
_FIVES = " || ".join(f"substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567', 1 + ((CAST('0x' || substr(h, {1 + 5 * i}, 5) AS INT) >> {15 - 5 * j}) & 31), 1)" for i in range(8) for j in range(4))
WARC_SQL = f"""
WITH p AS (SELECT page_id, encode(coalesce(html, '')) AS b FROM pages), d AS (SELECT page_id, octet_length(b) AS n, sha1(b) AS h FROM p), m AS (SELECT *, max(page_id) OVER (PARTITION BY h) AS last FROM d)
SELECT page_id, n AS payload_bytes, {_FIVES} AS payload_digest, CASE WHEN last = page_id THEN 'response' ELSE 'revisit' END AS record_type, CASE WHEN last <> page_id THEN last END AS refers_to FROM m
"""
