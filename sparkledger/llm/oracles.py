"""DuckDB SQL for the queries that SQL can express."""

from __future__ import annotations

_LOWER = "translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"

OP2 = rf"""
WITH d AS (
  SELECT doc_id, regexp_extract_all({_LOWER}, '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM documents
), b AS (
  SELECT coalesce(CAST(item_id AS VARCHAR), '') AS item, regexp_extract_all({_LOWER}, '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM benchmark
), windows AS (
  SELECT DISTINCT item, least(13, len(w)) AS size, array_to_string(w[i : i + least(13, len(w)) - 1], ' ') AS g
  FROM b, unnest(range(1, greatest(len(w) - 12, 1) + 1)) AS t(i) WHERE len(w) > 0
), sizes AS (SELECT DISTINCT size FROM windows), own AS (
  SELECT doc_id, size, i, array_to_string(w[i : i + size - 1], ' ') AS g
  FROM d, sizes, unnest(range(1, greatest(len(w) - size + 2, 1))) AS t(i)
), hits AS (SELECT own.doc_id, own.i, own.size, windows.item FROM own JOIN windows USING (g, size)),
marked AS (SELECT doc_id, count(DISTINCT i + k) AS n_hit FROM hits, unnest(range(0, size)) AS t(k) GROUP BY doc_id),
items AS (SELECT doc_id, count(*) AS n_items, string_agg(item, ',' ORDER BY item) AS ids FROM (SELECT DISTINCT doc_id, item FROM hits) GROUP BY doc_id)
SELECT d.doc_id, CAST(len(w) AS BIGINT) AS n_words, CAST(coalesce(n_hit, 0) AS BIGINT) AS n_hit, CAST(coalesce(n_items, 0) AS BIGINT) AS n_items,
  sha256(coalesce(ids, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AND 20 * coalesce(n_hit, 0) >= len(w) AS contaminated
FROM d LEFT JOIN marked USING (doc_id) LEFT JOIN items USING (doc_id)
"""

OP3 = r"""
WITH rows AS (
  SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
  UNION ALL SELECT -1, 0, 'user', '</s>[INST] ok [/INST]' UNION ALL SELECT -1, 1, 'assistant', '</s>[INST] ok [/INST]'
), t AS (
  SELECT *, len(regexp_extract_all(text, '[\p{L}\p{N}]+|[^\s\p{L}\p{N}]')) + 4 AS tokens,
    row_number() OVER w AS pos, first_value(role) OVER w = 'system' AS headed, first_value(text) OVER w AS head
  FROM rows WINDOW w AS (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, text)
), s AS (
  SELECT *, sum(tokens) OVER w AS total, CASE WHEN headed THEN first_value(tokens) OVER w ELSE 0 END AS head_tokens
  FROM t WINDOW w AS (PARTITION BY conv_id ORDER BY pos)
), o AS (
  SELECT *, CASE WHEN headed AND pos = 1 THEN NULL
    ELSE CAST(floor((total - head_tokens - 1) / greatest(floor((768 - head_tokens) / 2), 1)) AS BIGINT) END AS own FROM s
), l AS (
  SELECT *, lead(own, 1) OVER w AS a1, lead(own, 2) OVER w AS a2, lead(total, 1) OVER w AS t1
  FROM o WINDOW w AS (PARTITION BY conv_id ORDER BY pos)
), placed AS (
  SELECT conv_id, pos, role, text, headed, head, coalesce(own, a1, 0) AS win FROM l
  UNION ALL SELECT conv_id, pos, role, text, headed, head, a1 FROM l WHERE own IS NOT NULL AND a1 <> own AND tokens <= 256
  UNION ALL SELECT conv_id, pos, role, text, headed, head, a2 FROM l WHERE own IS NOT NULL AND a2 <> a1 AND t1 - (total - tokens) <= 256
), retained AS (
  SELECT * FROM placed
  UNION ALL SELECT conv_id, 1, 'system', any_value(head), true, any_value(head), win FROM placed WHERE headed GROUP BY conv_id, win HAVING min(pos) > 1
), sized AS (
  SELECT conv_id, win, 3 + sum(length(text) + len(regexp_extract_all(text, '<\\*/?s>')) + len(regexp_extract_all(text, '\[\\*/?(?:SYS|INST|ASST|ROLE)[^\[\]]*\]'))
    + CASE role WHEN 'system' THEN 13 WHEN 'user' THEN 15 WHEN 'assistant' THEN 12 ELSE 16 + 2 * strlen(role) END) AS chars
  FROM retained GROUP BY conv_id, win
), chars AS (SELECT conv_id, CAST(sum(chars) AS BIGINT) AS formatted_chars FROM sized GROUP BY conv_id)
SELECT t.conv_id, count(*) AS n_turns, sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY pos)) AS turns_sha256,
  CAST(coalesce(sum(length(text)) FILTER (role = 'assistant'), 0) AS BIGINT) AS loss_chars,
  sha256(coalesce(string_agg(text, '' ORDER BY pos) FILTER (role = 'assistant'), '')) AS loss_sha256, any_value(formatted_chars) AS formatted_chars
FROM t JOIN chars ON chars.conv_id IS NOT DISTINCT FROM t.conv_id GROUP BY t.conv_id
"""

OP4 = """
WITH v AS (
  SELECT vec_id, list_transform(embedding, lambda x: CAST(floor(256 * CAST(x AS DOUBLE)) AS BIGINT)) AS v FROM embeddings
  WHERE vec_id IS NOT NULL AND embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
), s AS (
  SELECT q.vec_id AS query_id, c.vec_id, CAST(list_sum(list_transform(list_zip(q.v, c.v), lambda p: p[1] * p[2])) AS BIGINT) AS score
  FROM v q JOIN v c ON q.vec_id % 50 = 0 AND c.vec_id <> q.vec_id
), r AS (SELECT *, CAST(row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS INTEGER) AS rank FROM s)
SELECT query_id, rank, vec_id, score FROM r WHERE rank <= 5
"""

OP13 = """
WITH RECURSIVE t AS (
  SELECT list_transform(range(256), lambda n: list_reduce(list_prepend(n, range(8)), lambda c, k: CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END)) AS crcs
), f AS (
  SELECT doc_id, source, text, coalesce(strlen(CAST(doc_id AS VARCHAR)) || ':' || doc_id, '-') || coalesce(strlen(source) || ':' || source, '-')
    || coalesce(strlen(lang) || ':' || lang, '-') || coalesce(strlen(CAST(n_chars AS VARCHAR)) || ':' || n_chars, '-') AS head,
    xor(list_reduce(list_prepend(4294967295, list_transform(string_split(CAST(doc_id AS VARCHAR), ''), lambda c: CAST(ord(c) AS BIGINT))),
      lambda a, b: xor(a >> 8, crcs[(xor(a, b) & 255) + 1])), 4294967295) AS crc
  FROM documents, t
), g AS (
  SELECT doc_id, source, sha256(head || coalesce(strlen(text) || ':' || text, '-')) AS leaf,
    sha256(head || coalesce(strlen(CASE WHEN crc % 2 = 0 THEN replace(text, chr(10), '') ELSE text END) || ':' || CASE WHEN crc % 2 = 0 THEN replace(text, chr(10), '') ELSE text END, '-')) AS found
  FROM f
), d AS (
  SELECT *, row_number() OVER (PARTITION BY source ORDER BY doc_id NULLS FIRST, leaf) - 1 AS i, count(*) OVER (PARTITION BY source) AS n, row_number() OVER () AS id FROM g
), up AS (
  SELECT source, 0 AS level, i, n, leaf AS h FROM d
  UNION ALL SELECT source, level + 1, i // 3, (n + 2) // 3, sha256(string_agg(h, '' ORDER BY i)) FROM up WHERE n > 1 GROUP BY source, level, i // 3, n
), s AS (
  SELECT source, level AS height, h AS subroot, row_number() OVER (ORDER BY source NULLS FIRST) - 1 AS i, count(*) OVER () AS n FROM up WHERE n = 1
), top AS (
  SELECT 0 AS level, i, n, subroot AS h FROM s
  UNION ALL SELECT level + 1, i // 3, (n + 2) // 3, sha256(string_agg(h, '' ORDER BY i)) FROM top WHERE n > 1 GROUP BY level, i // 3, n
), steps AS (
  SELECT d.id, up.level, coalesce(string_agg(up.h, '' ORDER BY up.i) FILTER (up.i < d.i // p.p), '') AS l, coalesce(string_agg(up.h, '' ORDER BY up.i) FILTER (up.i > d.i // p.p), '') AS r
  FROM d JOIN up ON up.source IS NOT DISTINCT FROM d.source AND up.n > 1 JOIN (SELECT k, CAST(pow(3, k) AS BIGINT) AS p FROM range(38) AS x(k)) p ON p.k = up.level AND up.i // 3 = d.i // p.p // 3
  GROUP BY d.id, up.level
  UNION ALL
  SELECT d.id, s.height + top.level, coalesce(string_agg(top.h, '' ORDER BY top.i) FILTER (top.i < s.i // p.p), ''), coalesce(string_agg(top.h, '' ORDER BY top.i) FILTER (top.i > s.i // p.p), '')
  FROM d JOIN s ON s.source IS NOT DISTINCT FROM d.source CROSS JOIN top JOIN (SELECT k, CAST(pow(3, k) AS BIGINT) AS p FROM range(38) AS x(k)) p ON p.k = top.level AND top.i // 3 = s.i // p.p // 3 AND top.n > 1
  GROUP BY d.id, s.height + top.level
), proofs AS (SELECT id, string_agg(l || r, '' ORDER BY level) AS proof, list({'l': l, 'r': r, 'h': ''} ORDER BY level) AS path FROM steps GROUP BY id)
SELECT *, folded_root = root AS verified FROM (
  SELECT d.doc_id, d.leaf, s.subroot, last.h AS root, sha256(coalesce(proof, '')) AS proof_sha256,
    list_reduce(list_prepend({'l': '', 'r': '', 'h': d.found}, coalesce(path, [])), lambda a, x: {'l': '', 'r': '', 'h': sha256(x.l || a.h || x.r)}).h AS folded_root
  FROM d JOIN s ON s.source IS NOT DISTINCT FROM d.source LEFT JOIN proofs ON proofs.id = d.id CROSS JOIN (SELECT h FROM top WHERE n = 1) AS last
)
"""
