"""Registered queries of this subpackage, and DuckDB SQL where SQL can express them."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from clinark.llm.contamination import op10_contamination
from clinark.llm.conversations import op11_conversation_repair
from clinark.llm.language import op2_language
from clinark.llm.lm_score import op9_lm_score
from clinark.llm.mixing import op8_mixing
from clinark.llm.near_dup import op5_near_dup
from clinark.llm.packing import op12_packing
from clinark.llm.phrases import op13_phrases
from clinark.llm.quality import op6_quality
from clinark.llm.suffix_dedup import op7_suffix_dedup
from clinark.llm.topk import op4_topk
from clinark.llm.toxicity import op3_toxicity
from clinark.llm.warc import op1_warc

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_warc": op1_warc,
    "op2_language": op2_language,
    "op3_toxicity": op3_toxicity,
    "op4_topk": op4_topk,
    "op5_near_dup": op5_near_dup,
    "op6_quality": op6_quality,
    "op7_suffix_dedup": op7_suffix_dedup,
    "op8_mixing": op8_mixing,
    "op9_lm_score": op9_lm_score,
    "op10_contamination": op10_contamination,
    "op11_conversation_repair": op11_conversation_repair,
    "op12_packing": op12_packing,
    "op13_phrases": op13_phrases,
}

ORACLE_SQL: dict[str, str] = {
    "op1_warc": """
WITH p AS (SELECT page_id, octet_length(encode(coalesce(html, ''))) AS payload_bytes,
                  sha1(coalesce(html, '')) AS h FROM pages),
f AS (SELECT h, min(page_id) AS first FROM p GROUP BY h)
SELECT page_id, CAST(payload_bytes AS BIGINT) AS payload_bytes,
  array_to_string(list_transform(range(32), lambda i: substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567', CAST(1 + ((
    CAST('0x' || substr(p.h, CAST((i // 4) * 5 + 1 AS INT), 5) AS INT) >> CAST(15 - 5 * (i % 4) AS INT)) & 31) AS INT),
    1)), '') AS payload_digest,
  CASE WHEN page_id = first THEN 'response' ELSE 'revisit' END AS record_type,
  CASE WHEN page_id = first THEN NULL ELSE first END AS refers_to
FROM p JOIN f USING (h)""",
    "op4_topk": """
WITH v AS (SELECT vec_id, list_transform(embedding, lambda x: floor(1024 * CAST(x AS DOUBLE))) AS w FROM embeddings
           WHERE embedding IS NOT NULL
             AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
s AS (SELECT q.vec_id AS query_id, c.vec_id, CAST(list_dot_product(q.w, c.w) AS BIGINT) AS score
      FROM v q, v c WHERE q.vec_id % 100 = 0 AND q.vec_id <> c.vec_id),
r AS (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS rank FROM s)
SELECT query_id, CAST(rank AS INT) AS rank, vec_id, score FROM r WHERE rank <= 10""",
    "op5_near_dup": """
WITH RECURSIVE w AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
                                              'abcdefghijklmnopqrstuvwxyz'), '[^\\x20\\x09-\\x0D]+') AS words
  FROM documents),
s AS (SELECT DISTINCT doc_id, unnest(CASE WHEN len(words) < 5 THEN [array_to_string(words, ' ')]
             ELSE list_transform(range(1, len(words) - 3), lambda i: array_to_string(words[i:i + 4], ' ')) END) AS g
      FROM w WHERE len(words) > 0),
n AS (SELECT doc_id, count(*) AS n FROM s GROUP BY doc_id),
pairs AS (SELECT x.doc_id AS a, y.doc_id AS b, count(*) AS inter FROM s x JOIN s y ON x.g = y.g AND x.doc_id < y.doc_id
          GROUP BY ALL),
links AS (SELECT a, b FROM pairs JOIN n p ON a = p.doc_id JOIN n q ON b = q.doc_id
          WHERE 100 * inter >= 85 * (p.n + q.n - inter)),
e AS (SELECT a AS u, b AS v FROM links UNION SELECT b, a FROM links),
reach(doc_id, r) AS (SELECT doc_id, doc_id FROM n UNION SELECT e.v, reach.r FROM reach JOIN e ON e.u = reach.doc_id),
c AS (SELECT doc_id, min(r) AS component_id FROM reach GROUP BY doc_id)
SELECT d.doc_id, coalesce(n.n, 0) AS n_shingles, coalesce(c.component_id, d.doc_id) AS component_id,
       d.doc_id = coalesce(c.component_id, d.doc_id) AS kept
FROM documents d LEFT JOIN n USING (doc_id) LEFT JOIN c USING (doc_id)""",
    "op10_contamination": """
WITH d AS (SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
               'abcdefghijklmnopqrstuvwxyz'), '[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+') AS w FROM documents),
b AS (SELECT item_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
               'abcdefghijklmnopqrstuvwxyz'), '[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+') AS w FROM benchmark),
win AS (SELECT DISTINCT item_id, least(len(w), 10) AS size,
               array_to_string(w[i:i + least(len(w), 10) - 1], ' ') AS phrase
        FROM (SELECT item_id, w, unnest(range(1, greatest(len(w) - 8, 2))) AS i FROM b WHERE len(w) > 0)),
sizes AS (SELECT DISTINCT size FROM win),
grams AS (SELECT doc_id, i, size, array_to_string(w[i:i + size - 1], ' ') AS phrase
          FROM (SELECT doc_id, w, size, unnest(range(1, len(w) - size + 2)) AS i FROM d, sizes)),
hits AS (SELECT doc_id, i, g.size, item_id FROM grams g JOIN win USING (size, phrase)),
covered AS (SELECT doc_id, count(DISTINCT p) AS n_hit
            FROM (SELECT doc_id, unnest(range(i, i + size)) AS p FROM hits) GROUP BY doc_id),
found AS (SELECT doc_id, count(*) AS n_items, string_agg(item, ',' ORDER BY item) AS items
          FROM (SELECT DISTINCT doc_id, CAST(item_id AS VARCHAR) AS item FROM hits) GROUP BY doc_id)
SELECT d.doc_id, CAST(len(w) AS BIGINT) AS n_words, coalesce(n_hit, 0) AS n_hit, coalesce(n_items, 0) AS n_items,
       sha256(coalesce(items, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AS contaminated
FROM d LEFT JOIN covered USING (doc_id) LEFT JOIN found USING (doc_id)""",
    "op11_conversation_repair": """
WITH RECURSIVE bits AS (
  SELECT *, coalesce(CAST(conv_id AS VARCHAR), ' ') || ':' || coalesce(CAST(turn AS VARCHAR), ' ') AS name,
         coalesce(role, ' ') AS r0, coalesce(text, ' ') AS t0 FROM conversations),
named AS (
  SELECT *, xor(list_reduce(list_transform(range(1, CAST(length(name) + 1 AS BIGINT)), lambda i: CAST(ascii(name[i]) AS BIGINT)),
    lambda c, b: list_reduce(list_prepend(xor(c, b), list_transform(range(8), lambda j: CAST(0 AS BIGINT))),
      lambda x, y: CASE WHEN x % 2 = 1 THEN xor(x // 2, 3988292384) ELSE x // 2 END), CAST(4294967295 AS BIGINT)),
    4294967295) % 20 AS fault FROM bits),
damaged AS (
  SELECT conv_id, turn, CASE WHEN fault = 4 THEN 'user' ELSE r0 END AS role,
         CASE WHEN fault = 1 THEN '' WHEN fault = 2 THEN regexp_replace(t0, '[.!?]', '', 'g') ELSE t0 END AS text,
         unnest(CASE WHEN fault = 3 THEN [0, 1] ELSE [0] END) AS copy FROM named WHERE fault <> 0),
placed AS (
  SELECT conv_id, turn, role, text, left(role, 1) AS ini,
    row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, sha256(text)) AS i,
    regexp_extract(text, '([^\\x20\\x09-\\x0D])[\\x20\\x09-\\x0D]*$', 1) AS last_char FROM damaged),
again AS (SELECT *, row_number() OVER (PARTITION BY conv_id, role, text ORDER BY i) AS seen FROM placed),
faulty AS (
  SELECT *, CASE WHEN NOT regexp_matches(text, '[^\\x20\\x09-\\x0D]') THEN 'blank' WHEN seen > 1 THEN 'duplicate'
                 WHEN last_char NOT IN ('.', '!', '?') THEN 'truncated' ELSE '' END AS fault,
    lag(ini) OVER (PARTITION BY conv_id ORDER BY i) AS before FROM again),
counted AS (
  SELECT conv_id, coalesce(max(turn) - min(turn) + 1 - count(DISTINCT turn), 0) AS gaps, sum(CAST(fault = 'blank' AS INT)) AS blank,
    sum(CAST(fault = 'duplicate' AS INT)) AS duplicate, sum(CAST(fault = 'truncated' AS INT)) AS truncated,
    sum(CAST(before IS NOT NULL AND before || ini NOT IN ('su', 'ua', 'au') AS INT)) AS illegal, count(*) AS rows
  FROM faulty GROUP BY conv_id),
-- states: 0 nothing yet, 1 after s, 2 after u, 3 after a; n rows are done
steps AS (
  SELECT * FROM (VALUES (0, 'u', 2), (1, 'u', 2), (2, 'a', 3), (3, 'u', 2)) AS v(f, ini, t)),
inserts AS (
  SELECT f, 0 AS k, f AS t, '' AS audit, '' AS script FROM steps UNION ALL
  SELECT f, 2, t, 'I', chr(10) || CASE ini WHEN 'u' THEN 'user:' ELSE 'assistant:' END FROM steps UNION ALL
  SELECT a.f, 4, b.t, 'II', chr(10) || CASE a.ini WHEN 'u' THEN 'user:' ELSE 'assistant:' END
         || chr(10) || CASE b.ini WHEN 'u' THEN 'user:' ELSE 'assistant:' END FROM steps a JOIN steps b ON a.t = b.f),
walk(conv_id, n, state, cost, audit, script) AS (
  SELECT conv_id, CAST(0 AS BIGINT), 0, CAST(0 AS BIGINT), '', '' FROM counted
  UNION ALL
  SELECT conv_id, n, state, arg_min(cost, o), arg_min(audit, o), arg_min(script, o) FROM (
    SELECT w.conv_id, w.n + 1 AS n, e.state, w.cost + x.k + e.k AS cost, w.audit || x.audit || e.letter AS audit,
           w.script || x.script || e.script AS script,
           lpad(CAST(w.cost + x.k + e.k AS VARCHAR), 12, '0') || w.audit || x.audit || e.letter AS o
    FROM walk w JOIN faulty r ON r.conv_id IS NOT DISTINCT FROM w.conv_id AND r.i = w.n + 1
    JOIN inserts x ON x.f = w.state
    JOIN LATERAL (
      SELECT x.t AS state, 3 AS k, 'D' AS letter, '' AS script
      UNION ALL SELECT s.t, CAST(r.fault = 'truncated' AS INT) + CASE WHEN s.ini = r.ini THEN 0 ELSE 2 END,
        CASE WHEN s.ini = r.ini THEN 'K' ELSE 'R' END,
        chr(10) || CASE WHEN s.ini = r.ini THEN r.role WHEN s.ini = 'u' THEN 'user' ELSE 'assistant' END || ':' || r.text
        FROM steps s WHERE s.f = x.t AND r.fault NOT IN ('blank', 'duplicate')
      UNION ALL SELECT 1, CAST(r.fault = 'truncated' AS INT), 'K', chr(10) || r.role || ':' || r.text
        WHERE x.t = 0 AND r.ini = 's' AND r.fault NOT IN ('blank', 'duplicate')) e ON true) c
  GROUP BY conv_id, n, state),
finished AS (
  SELECT w.conv_id, w.cost + x.k AS cost, w.audit || x.audit AS audit, w.script || x.script AS script,
    row_number() OVER (PARTITION BY w.conv_id ORDER BY w.cost + x.k, w.audit || x.audit) AS place
  FROM walk w JOIN counted c ON c.conv_id IS NOT DISTINCT FROM w.conv_id AND c.rows = w.n
  JOIN inserts x ON x.f = w.state WHERE x.t IN (0, 3))
SELECT o.conv_id, coalesce(gaps, 0) AS gaps, CAST(coalesce(blank, 0) AS BIGINT) AS blank,
  CAST(coalesce(duplicate, 0) AS BIGINT) AS duplicate, CAST(coalesce(truncated, 0) AS BIGINT) AS truncated,
  CAST(coalesce(illegal, 0) AS BIGINT) AS illegal, coalesce(f.cost, 0) AS cost, coalesce(audit, '') AS audit,
  sha256(coalesce(script[2:], '')) AS repaired_sha256
FROM (SELECT DISTINCT conv_id FROM conversations) o
LEFT JOIN counted c ON c.conv_id IS NOT DISTINCT FROM o.conv_id
LEFT JOIN (SELECT * FROM finished WHERE place = 1) f ON f.conv_id IS NOT DISTINCT FROM o.conv_id""",
    "op13_phrases": """
WITH pieces AS (
  SELECT coalesce(lang, 'und') AS lang, unnest(regexp_split_to_array(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
    'abcdefghijklmnopqrstuvwxyz'), '[.,;:!?\\x0A-\\x0D]')) AS piece FROM documents),
w AS (SELECT lang, regexp_extract_all(piece, '[^\\x20\\x09]+') AS w FROM pieces),
c AS (SELECT lang, size, p, count(*) AS f FROM (
        SELECT lang, size, w[i:i + size - 1] AS p FROM (
          SELECT lang, w, size, unnest(range(1, len(w) - size + 2)) AS i FROM w, (VALUES (1), (2), (3), (4)) AS s(size)))
      GROUP BY ALL),
total AS (SELECT lang, sum(f) AS n FROM c WHERE size = 1 GROUP BY lang),
big AS (SELECT * FROM c WHERE f >= 30),
cuts AS (SELECT *, p[1:k] AS head, p[k + 1:] AS tail FROM (SELECT *, unnest(range(1, size)) AS k FROM big WHERE size > 1)),
scored AS (
  SELECT lang, p, a, l, r, score FROM (
    SELECT u.lang, u.p, u.f AS a, x.f AS l, y.f AS r, CAST(2000000 AS HUGEINT) * u.f // (x.f + y.f) AS score,
           row_number() OVER (PARTITION BY u.lang, u.p ORDER BY CAST(2000000 AS HUGEINT) * u.f // (x.f + y.f), u.k) AS place
    FROM cuts u JOIN big x ON x.lang = u.lang AND x.p = u.head JOIN big y ON y.lang = u.lang AND y.p = u.tail)
  WHERE place = 1),
inside AS (
  SELECT lang, q, max(f) AS longer FROM (
    SELECT lang, f, unnest(list_transform(range(1, size - k + 2), lambda i: p[i:i + k - 1])) AS q
    FROM (SELECT *, unnest(range(2, size)) AS k FROM big WHERE size > 2)) GROUP BY ALL),
kept AS (SELECT s.*, array_to_string(s.p, ' ') AS phrase FROM scored s LEFT JOIN inside i ON i.lang = s.lang AND i.q = s.p
         WHERE longer IS NULL OR 100 * CAST(longer AS HUGEINT) < 80 * CAST(a AS HUGEINT)),
ranked AS (SELECT *, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, phrase) AS rank FROM kept)
SELECT lang, rank, phrase, a, l, r, CAST(n AS BIGINT) AS n, CAST(score AS BIGINT) AS score
FROM ranked JOIN total USING (lang) WHERE rank <= 2000""",
}
