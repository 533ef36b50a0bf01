"""DuckDB SQL of the operators whose results SQL can express."""

from __future__ import annotations

# Linked documents by counting shared shingles, components by the smallest id within reach.
NGRAM_JACCARD = r"""
WITH RECURSIVE w AS (SELECT doc_id, list_filter(regexp_split_to_array(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[\x20\x09-\x0D]+'), lambda x: x <> '') AS ws FROM documents),
sh AS (SELECT DISTINCT doc_id, CASE WHEN len(ws) < 5 THEN array_to_string(ws, ' ') ELSE array_to_string(ws[i : i + 4], ' ') END AS s
  FROM (SELECT doc_id, ws, unnest(range(1, greatest(len(ws) - 4, 1) + 1)) AS i FROM w WHERE len(ws) > 0)),
n AS (SELECT doc_id, count(*) AS n FROM sh GROUP BY doc_id),
sets AS (SELECT doc_id, md5(string_agg(s, chr(10) ORDER BY s)) AS same FROM sh GROUP BY doc_id),
rep AS (SELECT doc_id, min(doc_id) OVER (PARTITION BY same) AS r FROM sets),
one AS (SELECT sh.* FROM sh JOIN (SELECT DISTINCT r FROM rep) ON r = doc_id),
p AS (SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS c FROM one a JOIN one b ON a.s = b.s AND a.doc_id < b.doc_id GROUP BY ALL),
l AS (SELECT a, b FROM p JOIN n x ON x.doc_id = a JOIN n y ON y.doc_id = b WHERE 100 * c >= 75 * (x.n + y.n - c)),
e AS (SELECT a, b FROM l UNION ALL SELECT b, a FROM l),
reach AS (SELECT DISTINCT r AS a, r AS b FROM rep UNION SELECT reach.a, e.b FROM reach JOIN e ON e.a = reach.b),
low AS (SELECT a, min(b) AS low FROM reach GROUP BY a)
SELECT d.doc_id, coalesce(n.n, 0) AS n_shingles, coalesce(low.low, d.doc_id) AS component_id
FROM documents d LEFT JOIN n USING (doc_id) LEFT JOIN rep USING (doc_id) LEFT JOIN low ON low.a = rep.r"""

_LETTERS = "'ABCDEFGHIJKLMNOPQRSTUVWXYZ234567'"
_BASE32 = " || ".join(f"substr({_LETTERS}, 1 + ((CAST('0x' || substr(h, {1 + 5 * g}, 5) AS INTEGER) >> {s}) & 31), 1)" for g in range(8) for s in (15, 10, 5, 0))

WARC = f"""
WITH p AS (SELECT page_id, encode(coalesce(html, '')) AS b, sha1(coalesce(html, '')) AS h FROM pages),
f AS (SELECT *, max(page_id) OVER (PARTITION BY h, octet_length(b)) AS first FROM p)
SELECT page_id, CAST(octet_length(b) AS BIGINT) AS payload_bytes, {_BASE32} AS payload_digest,
  CASE WHEN page_id = first THEN 'response' ELSE 'revisit' END AS record_type, CASE WHEN page_id <> first THEN first END AS refers_to FROM f"""

SLICED_TOP_K = """
WITH q AS (SELECT vec_id, list_transform(embedding, lambda x: CAST(floor(256 * CAST(x AS DOUBLE)) AS BIGINT)) AS v FROM embeddings
  WHERE vec_id IS NOT NULL AND embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
s AS (SELECT a.vec_id AS query_id, b.vec_id, CAST(coalesce(list_sum(list_transform(list_zip(a.v, b.v), lambda z: z[1] * z[2])), 0) AS BIGINT) AS score
  FROM q a JOIN q b ON a.vec_id % 50 = 0 AND b.vec_id <> a.vec_id AND len(a.v) = len(b.v)),
r AS (SELECT *, CAST(row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS INTEGER) AS rank FROM s)
SELECT query_id, rank, vec_id, score FROM r WHERE rank <= 5"""

# The best (cost, audit) of every place of the pattern, row after row; places: 0 start, 1 after s, 2 after u, 3 after a.
TURN_REPAIR = r"""
WITH RECURSIVE crc_bits AS (SELECT range AS i, range AS c, 0 AS k FROM range(256)
  UNION ALL SELECT i, CASE WHEN c & 1 = 1 THEN xor(3988292384, c >> 1) ELSE c >> 1 END, k + 1 FROM crc_bits WHERE k < 8),
crc_table AS (SELECT list(c ORDER BY i) AS t FROM crc_bits WHERE k = 8),
keyed AS (SELECT *, coalesce(CAST(conv_id AS VARCHAR), ' ') || ':' || coalesce(CAST(turn AS VARCHAR), ' ') AS key FROM conversations),
hashed AS (SELECT k.*, xor(4294967295, list_reduce(list_prepend(CAST(4294967295 AS BIGINT), list_transform(string_split(key, ''), lambda x: CAST(ascii(x) AS BIGINT))),
  lambda c, b: xor(c >> 8, t[CAST((xor(c, b) & 255) + 1 AS BIGINT)]))) % 20 AS h FROM keyed k, crc_table),
damaged AS (SELECT conv_id, turn, CASE WHEN h = 4 THEN 'user' ELSE coalesce(role, ' ') END AS role,
  CASE h WHEN 1 THEN '' WHEN 2 THEN regexp_replace(coalesce(text, ' '), '[.!?]', '', 'g') ELSE coalesce(text, ' ') END AS text
  FROM hashed JOIN (VALUES (1), (2)) v(n) ON n <= CASE h WHEN 0 THEN 0 WHEN 3 THEN 2 ELSE 1 END),
placed AS (SELECT *, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, text) AS i FROM damaged),
faulty AS (SELECT *, left(role, 1) AS c, regexp_replace(text, '[\x20\x09-\x0D]+$', '') AS shown,
  row_number() OVER (PARTITION BY conv_id, role, text ORDER BY i) AS nth, lag(left(role, 1)) OVER (PARTITION BY conv_id ORDER BY i) AS before FROM placed),
rows AS (SELECT *, CASE WHEN shown = '' THEN 'blank' WHEN nth > 1 THEN 'duplicate' WHEN right(shown, 1) NOT IN ('.', '!', '?') THEN 'truncated' ELSE 'fine' END AS fault FROM faulty),
totals AS (SELECT conv_id, max(i) AS n, coalesce(max(turn) - min(turn) + 1 - count(DISTINCT turn), 0) AS gaps, count(*) FILTER (fault = 'blank') AS blank,
  count(*) FILTER (fault = 'duplicate') AS duplicate, count(*) FILTER (fault = 'truncated') AS truncated,
  count(*) FILTER (i > 1 AND before || c NOT IN ('su', 'ua', 'au')) AS illegal FROM rows GROUP BY conv_id),
steps(p, c, q) AS (VALUES (0, 's', 1), (0, 'u', 2), (1, 'u', 2), (2, 'a', 3), (3, 'u', 2)),
inserted(p, q, cost, audit, lines) AS (VALUES (0, 0, 0, '', ''), (1, 1, 0, '', ''), (2, 2, 0, '', ''), (3, 3, 0, '', ''),
  (0, 2, 5, 'I', 'user:' || chr(10)), (1, 2, 5, 'I', 'user:' || chr(10)), (3, 2, 5, 'I', 'user:' || chr(10)), (2, 3, 5, 'I', 'assistant:' || chr(10)),
  (0, 3, 10, 'II', 'user:' || chr(10) || 'assistant:' || chr(10)), (1, 3, 10, 'II', 'user:' || chr(10) || 'assistant:' || chr(10))),
edits AS (SELECT conv_id, i, p, p AS q, 2 AS cost, 'D' AS audit, '' AS lines FROM rows, (VALUES (0), (1), (2), (3)) v(p)
  UNION ALL SELECT conv_id, i, p, q, CASE fault WHEN 'truncated' THEN 5 ELSE 0 END, 'K', role || ':' || text || chr(10)
  FROM rows JOIN steps USING (c) WHERE fault IN ('fine', 'truncated')
  UNION ALL SELECT conv_id, i, p, q, CASE fault WHEN 'truncated' THEN 6 ELSE 1 END, 'R', CASE s.c WHEN 'u' THEN 'user:' ELSE 'assistant:' END || text || chr(10)
  FROM rows, steps s WHERE fault IN ('fine', 'truncated') AND s.c <> 's'),
best AS (SELECT conv_id, CAST(0 AS BIGINT) AS i, 0 AS p, {'cost': 0, 'audit': '', 'lines': ''} AS way FROM totals
  UNION ALL SELECT b.conv_id, e.i, e.q, min({'cost': b.way.cost + j.cost + e.cost, 'audit': b.way.audit || j.audit || e.audit, 'lines': b.way.lines || j.lines || e.lines})
  FROM best b JOIN inserted j ON j.p = b.p JOIN edits e ON e.conv_id IS NOT DISTINCT FROM b.conv_id AND e.i = b.i + 1 AND e.p = j.q GROUP BY b.conv_id, e.i, e.q),
ended AS (SELECT b.conv_id, min({'cost': b.way.cost + j.cost, 'audit': b.way.audit || j.audit, 'lines': b.way.lines || j.lines}) AS way
  FROM best b JOIN totals t ON t.conv_id IS NOT DISTINCT FROM b.conv_id AND b.i = t.n JOIN inserted j ON j.p = b.p AND j.q IN (0, 3) GROUP BY b.conv_id),
ids AS (SELECT DISTINCT conv_id FROM conversations)
SELECT ids.conv_id, coalesce(t.gaps, 0) AS gaps, coalesce(t.blank, 0) AS blank, coalesce(t.duplicate, 0) AS duplicate, coalesce(t.truncated, 0) AS truncated,
  coalesce(t.illegal, 0) AS illegal, CAST(coalesce(e.way.cost, 0) AS BIGINT) AS cost, coalesce(e.way.audit, '') AS audit,
  sha256(CASE WHEN coalesce(e.way.lines, '') = '' THEN '' ELSE left(e.way.lines, length(e.way.lines) - 1) END) AS repaired_sha256
FROM ids LEFT JOIN totals t ON t.conv_id IS NOT DISTINCT FROM ids.conv_id LEFT JOIN ended e ON e.conv_id IS NOT DISTINCT FROM ids.conv_id"""

ORACLE_SQL = {"op4_ngram_jaccard": NGRAM_JACCARD.strip(), "op10_warc": WARC.strip(), "op11_sliced_top_k": SLICED_TOP_K.strip(), "op13_turn_repair": TURN_REPAIR.strip()}
