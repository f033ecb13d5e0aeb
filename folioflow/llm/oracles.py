"""DuckDB SQL for the queries of this subpackage that plain SQL can state."""

from __future__ import annotations

P2_FOUND = """
SELECT document_id, page_number FROM (
  SELECT document_id, page_number, string_agg(text, chr(10) ORDER BY stream_index) AS page
  FROM (SELECT DISTINCT document_id, page_number, stream_index, text FROM page_lines) GROUP BY 1, 2)
WHERE length(page) > 2000
"""

# The least question that each one reaches over documents meant by both.
P1_FOUND = """
WITH RECURSIVE link AS (
  SELECT DISTINCT question_id, lower(regexp_replace(trim(l.document_id, chr(9) || chr(10) || chr(13) || ' '), '(?i)(\\.pdf)+$', '')) AS doc
  FROM (SELECT question_id, unnest(flatten(list_transform(gold_evidence, lambda g: g.locations))) AS l FROM questions)),
first AS (SELECT doc, min(question_id) AS q FROM link GROUP BY 1),
edge AS (SELECT DISTINCT question_id AS a, q AS b FROM link JOIN first USING (doc)),
both_ways AS (SELECT a, b FROM edge UNION SELECT b, a FROM edge),
reach AS (SELECT a AS q, b AS seen FROM both_ways UNION SELECT r.q, w.b FROM reach r JOIN both_ways w ON w.a = r.seen)
SELECT min(seen) AS first_question_id, q AS question_id FROM reach GROUP BY q HAVING min(seen) <> q
"""

# Likeness over all pairs that share a shingle, then its closure.
P5_FOUND = """
WITH RECURSIVE word AS (
  SELECT document_id, row_number() OVER (PARTITION BY document_id ORDER BY stream_index, k) AS n, w FROM (
    SELECT document_id, stream_index, unnest(range(1, len(ws) + 1)) AS k, unnest(ws) AS w FROM (
      SELECT document_id, stream_index, list_filter(regexp_split_to_array(regexp_replace(lower(replace(text, chr(173), '')), '[-!"#$%&()*+,./:;<=>?@\\[\\\\\\]^_`{}~''“”‘’«»—–•·।॥…‐¬§¶©¤€�]', ' ', 'g'), '[\\s\\x{00A0}]+'), lambda x: x <> '') AS ws
      FROM (SELECT DISTINCT document_id, stream_index, text FROM page_lines)))),
shingle AS (SELECT DISTINCT document_id, hash(w, w2, w3) AS h FROM (
  SELECT document_id, w, lead(w, 1) OVER d AS w2, lead(w, 2) OVER d AS w3 FROM word WINDOW d AS (PARTITION BY document_id ORDER BY n)) WHERE w3 IS NOT NULL),
size AS (SELECT document_id, count(*) AS n FROM shingle GROUP BY 1),
common AS (SELECT x.document_id AS a, y.document_id AS b, count(*) AS c FROM shingle x JOIN shingle y ON x.h = y.h AND x.document_id < y.document_id GROUP BY 1, 2),
alike AS (SELECT a, b FROM common JOIN size p ON p.document_id = a JOIN size q ON q.document_id = b WHERE 3 * c >= p.n + q.n),
both_ways AS (SELECT a, b FROM alike UNION SELECT b, a FROM alike),
reach AS (SELECT a, b FROM both_ways UNION SELECT r.a, w.b FROM reach r JOIN both_ways w ON w.a = r.b)
SELECT a AS document_id_a, b AS document_id_b FROM reach WHERE a < b
"""


P1_GROUPS = f"""
WITH found AS ({P1_FOUND}) SELECT coalesce(f.first_question_id, q.question_id) AS first_question_id, count(*) AS questions, CAST(1 AS BIGINT) AS splits
FROM (SELECT DISTINCT question_id FROM questions WHERE question_id IS NOT NULL) q LEFT JOIN found f ON f.question_id = q.question_id GROUP BY 1
"""

P2_TILING = """
SELECT document_id, page_number, length(page) AS chars, true AS within FROM (
  SELECT document_id, page_number, string_agg(text, chr(10) ORDER BY stream_index) AS page
  FROM (SELECT DISTINCT document_id, page_number, stream_index, text FROM page_lines) GROUP BY 1, 2)
WHERE page <> ''
"""

P5_GROUPS = f"SELECT document_id_b AS document_id, min(document_id_a) AS group_id FROM ({P5_FOUND}) GROUP BY 1 UNION SELECT document_id_a, document_id_a FROM ({P5_FOUND}) WHERE document_id_a NOT IN (SELECT document_id_b FROM ({P5_FOUND}))"


def oracles() -> dict[str, str]:
    return {"p1_found": P1_FOUND, "p1_groups": P1_GROUPS, "p2_found": P2_FOUND, "p2_tiling": P2_TILING, "p5_found": P5_FOUND, "p5_groups": P5_GROUPS}
