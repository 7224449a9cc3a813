"""SQL for the text queries that SQL can express, as DuckDB reads it."""

from __future__ import annotations

# The damage, the faults, then all cheapest repairs row by row: per conversation and state one (cost, audit). An
# insertion is taken right before a kept or changed row or at the end, where it is ASCII-least among equals.
CONVERSATION_REPAIR = r"""
WITH RECURSIVE
src AS (
  SELECT conv_id, turn, coalesce(role, ' ') AS role, coalesce(text, ' ') AS text,
    coalesce(conv_id::VARCHAR, ' ') || ':' || coalesce(turn::VARCHAR, ' ') AS k
  FROM conversations),
hashed AS (
  SELECT *, xor(list_reduce(
      list_prepend(4294967295::BIGINT, flatten(list_transform(string_split(k, ''), lambda c: [ascii(c)::BIGINT, 0, 0, 0, 0, 0, 0, 0]))),
      lambda c, x: xor(xor(c, x) >> 1, 3988292384 * (xor(c, x) & 1))), 4294967295) % 20 AS h
  FROM src),
copies AS (
  SELECT conv_id, turn, CASE WHEN h = 4 THEN 'user' ELSE role END AS role,
    CASE h WHEN 1 THEN '' WHEN 2 THEN regexp_replace(text, '[.!?]', '', 'g') ELSE text END AS text,
    unnest(range(CASE h WHEN 0 THEN 0 WHEN 3 THEN 2 ELSE 1 END)) AS copy
  FROM hashed),
known AS (
  SELECT *, row_number() OVER (PARTITION BY conv_id, role, text ORDER BY turn NULLS FIRST) AS seen FROM copies),
ranked AS (
  SELECT conv_id, turn, role, text, seen, left(role, 1) AS initial,
    row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, text, seen) AS i
  FROM known),
judged AS (
  SELECT *, CASE WHEN NOT regexp_matches(text, '[^\x20\x09-\x0D]') THEN 'blank' WHEN seen > 1 THEN 'duplicate'
      WHEN NOT regexp_matches(text, '[.!?][\x20\x09-\x0D]*$') THEN 'truncated' ELSE '' END AS fault,
    lag(initial) OVER (PARTITION BY conv_id ORDER BY i) || initial AS pair
  FROM ranked),
step(p, letter, q) AS (VALUES (0, 's', 1), (0, 'u', 2), (1, 'u', 2), (2, 'a', 3), (3, 'u', 2)),
before(p, q, cost, audit) AS (VALUES (0, 0, 0, ''), (1, 1, 0, ''), (2, 2, 0, ''), (3, 3, 0, ''), (0, 2, 2, 'I'), (1, 2, 2, 'I'), (2, 3, 2, 'I'), (3, 2, 2, 'I')),
edit AS (
  SELECT j.conv_id, j.i, s.p, s.q,
    CASE WHEN initial = letter THEN 0 ELSE 2 END + CASE WHEN fault = 'truncated' THEN 1 ELSE 0 END AS cost,
    CASE WHEN initial = letter THEN 'K' ELSE 'R' END AS audit
  FROM judged j, step s WHERE fault NOT IN ('blank', 'duplicate') AND (initial = letter OR letter <> 's')
  UNION ALL SELECT conv_id, i, p, p, 3, 'D' FROM judged, range(4) AS r(p)),
part AS (
  SELECT conv_id, i, b.p, e.q, b.cost + e.cost AS cost, b.audit || e.audit AS audit
  FROM edit e JOIN before b ON b.q = e.p),
best AS (
  SELECT DISTINCT conv_id, 0::BIGINT AS i, 0 AS q, {'cost': 0, 'audit': ''} AS w FROM src
  UNION ALL
  SELECT b.conv_id, b.i + 1, p.q, min({'cost': b.w.cost + p.cost, 'audit': b.w.audit || p.audit})
  FROM best b JOIN part p ON p.conv_id IS NOT DISTINCT FROM b.conv_id AND p.i = b.i + 1 AND p.p = b.q
  GROUP BY b.conv_id, b.i, p.q),
size AS (SELECT conv_id, max(i) AS n FROM best GROUP BY conv_id),
chosen AS (
  SELECT b.conv_id, min({'cost': b.w.cost + e.cost, 'audit': b.w.audit || e.audit}) AS w
  FROM best b JOIN size s ON s.conv_id IS NOT DISTINCT FROM b.conv_id AND s.n = b.i
    JOIN (VALUES (0, 0, ''), (3, 0, ''), (2, 2, 'I'), (1, 4, 'II')) AS e(q, cost, audit) ON e.q = b.q
  GROUP BY b.conv_id),
piece AS (
  SELECT conv_id, unnest(range(1, len(pieces) + 1)) AS i, unnest(pieces) AS letters
  FROM (SELECT conv_id, regexp_extract_all(w.audit, 'I*[KRD]|I+$') AS pieces FROM chosen)),
letter AS (
  SELECT conv_id, i, unnest(range(1, len(letters) + 1)) AS j, unnest(string_split(letters, '')) AS l FROM piece),
emitted AS (
  SELECT l.conv_id, l.l, d.role, d.text,
    row_number() OVER w AS place, first(l.l = 'K' AND left(d.role, 1) = 's') OVER w AS opened
  FROM letter l LEFT JOIN judged d ON d.conv_id IS NOT DISTINCT FROM l.conv_id AND d.i = l.i
  WHERE l.l <> 'D' WINDOW w AS (PARTITION BY l.conv_id ORDER BY l.i, l.j)),
written AS (
  SELECT conv_id, string_agg(
      CASE WHEN l = 'K' THEN role WHEN (place - coalesce(opened, false)::INT) % 2 = 1 THEN 'user' ELSE 'assistant' END
      || ':' || CASE WHEN l = 'I' THEN '' ELSE text END, chr(10) ORDER BY place) AS body
  FROM emitted GROUP BY conv_id),
counted AS (
  SELECT conv_id, coalesce(max(turn) - min(turn) + 1 - count(DISTINCT turn), 0)::BIGINT AS gaps,
    count(*) FILTER (fault = 'blank') AS blank, count(*) FILTER (fault = 'duplicate') AS duplicate,
    count(*) FILTER (fault = 'truncated') AS truncated, count(*) FILTER (pair NOT IN ('su', 'ua', 'au')) AS illegal
  FROM judged GROUP BY conv_id)
SELECT c.conv_id, coalesce(n.gaps, 0) AS gaps, coalesce(n.blank, 0) AS blank, coalesce(n.duplicate, 0) AS duplicate,
  coalesce(n.truncated, 0) AS truncated, coalesce(n.illegal, 0) AS illegal, c.w.cost::BIGINT AS cost, c.w.audit AS audit,
  sha256(coalesce(t.body, '')) AS repaired_sha256
FROM chosen c
  LEFT JOIN counted n ON n.conv_id IS NOT DISTINCT FROM c.conv_id
  LEFT JOIN written t ON t.conv_id IS NOT DISTINCT FROM c.conv_id
"""

RANKED_SEARCH = r"""
WITH d AS (
  SELECT row_number() OVER () AS r, doc_id, unnest(regexp_extract_all(
    translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')) AS term
  FROM documents),
tf AS (SELECT r, doc_id, term, count(*)::BIGINT AS tf FROM d GROUP BY ALL),
len AS (SELECT r, sum(tf)::BIGINT AS n FROM tf GROUP BY r),
corpus AS (SELECT count(*)::BIGINT AS n_docs, sum(n)::BIGINT AS n_terms FROM len),
m AS (SELECT r, 100 - 50 + ((50 * n * n_docs) // n_terms) AS m FROM len, corpus),
weight AS (
  SELECT term, floor(1000 * ln((2 * n_docs + 2)::DOUBLE / (2 * count(*) + 1)::DOUBLE))::BIGINT AS w
  FROM tf, corpus GROUP BY term, n_docs),
item AS (
  SELECT DISTINCT item_id, text, unnest(regexp_extract_all(
    translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')) AS term
  FROM benchmark),
scored AS (
  SELECT item_id, text, r, doc_id, sum(w * ((1000000000 * tf) // (1000 * tf + 20 * m)))::BIGINT AS score
  FROM item JOIN tf USING (term) JOIN weight USING (term) JOIN m USING (r)
  GROUP BY item_id, text, r, doc_id)
SELECT item_id, rank::INTEGER AS rank, doc_id, score FROM (
  SELECT *, row_number() OVER (PARTITION BY item_id, text ORDER BY score DESC, doc_id NULLS LAST) AS rank FROM scored WHERE score > 0)
WHERE rank <= 50
"""

# Every pair that shares a shingle is counted, and components are what the links reach.
NEAR_DUPLICATES = r"""
WITH RECURSIVE
words AS (
  SELECT doc_id, regexp_extract_all(
    translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+') AS w
  FROM documents),
shingles AS (
  SELECT DISTINCT doc_id, unnest(CASE WHEN len(w) = 0 THEN [] WHEN len(w) < 5 THEN [array_to_string(w, ' ')]
    ELSE list_transform(range(1, len(w) - 3), lambda i: array_to_string(w[i:i + 4], ' ')) END) AS shingle
  FROM words),
size AS (SELECT doc_id, count(*) AS n FROM shingles GROUP BY doc_id),
common AS (
  SELECT x.doc_id AS a, y.doc_id AS b, count(*) AS c
  FROM shingles x JOIN shingles y ON x.shingle = y.shingle AND x.doc_id < y.doc_id GROUP BY x.doc_id, y.doc_id),
link AS (
  SELECT a, b FROM common JOIN size x ON x.doc_id = a JOIN size y ON y.doc_id = b WHERE 100 * c >= 85 * (x.n + y.n - c)),
step AS (SELECT a, b FROM link UNION SELECT b, a FROM link),
reached AS (
  SELECT a AS doc_id, b AS other FROM step
  UNION SELECT r.doc_id, s.b FROM reached r JOIN step s ON s.a = r.other)
SELECT doc_id, coalesce(n, 0) AS n_shingles, least(doc_id, coalesce(first, doc_id)) AS component_id,
  doc_id <= coalesce(first, doc_id) AS kept
FROM documents
  LEFT JOIN size USING (doc_id)
  LEFT JOIN (SELECT doc_id, min(other) AS first FROM reached GROUP BY doc_id) USING (doc_id)
"""
