"""The same results as DuckDB SQL, written out from the rules alone (nothing of the operators is used here)."""

from __future__ import annotations

# conversations with the probe, as texts: turns in order, per conversation
OP1 = r"""
WITH turns AS (
  SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
  UNION ALL SELECT -1, * FROM (VALUES (0, 'user', '</s>[INST] ok [/INST]'), (1, 'assistant', '</s>[INST] ok [/INST]'))),
sized AS (
  SELECT *, -- a character is added to each backslash and to the first character of each control string
    length(text) + length(text) - length(replace(text, '\', ''))
      + (length(text) - length(replace(text, '<s>', ''))) // 3 + (length(text) - length(replace(text, '</s>', ''))) // 4
      + (length(text) - length(replace(text, '[INST]', ''))) // 6 + (length(text) - length(replace(text, '[/INST]', ''))) // 7 AS t,
    length(role) + length(role) - length(replace(role, '\', '')) + length(role) - length(replace(role, chr(10), ''))
      + (length(role) - length(replace(role, '<s>', ''))) // 3 + (length(role) - length(replace(role, '</s>', ''))) // 4
      + (length(role) - length(replace(role, '[INST]', ''))) // 6 + (length(role) - length(replace(role, '[/INST]', ''))) // 7 AS r
  FROM turns)
SELECT conv_id, count(*) AS n_turns,
  sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn NULLS FIRST, role, text)) AS turns_sha256,
  cast(coalesce(sum(length(text)) FILTER (role = 'assistant'), 0) AS bigint) AS loss_chars,
  sha256(coalesce(string_agg(text, '' ORDER BY turn NULLS FIRST, role, text) FILTER (role = 'assistant'), '')) AS loss_sha256,
  cast(sum(CASE role WHEN 'assistant' THEN 3 + t + 4 ELSE 7 + r + 1 + t + 8 END) AS bigint) AS formatted_chars
FROM sized GROUP BY conv_id"""

_CLOSURE = """
reach AS (
  SELECT a AS node, b AS other FROM links UNION SELECT b, a FROM links
  UNION SELECT reach.node, l.other FROM reach JOIN (SELECT a AS node, b AS other FROM links UNION SELECT b, a FROM links) l ON l.node = reach.other)"""

OP7 = f"""
WITH RECURSIVE good AS (
  SELECT vec_id, list_transform(embedding, lambda x: cast(x AS double)) AS v FROM embeddings
  WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR isnan(x) OR isinf(x))) = 0
    AND len(list_filter(embedding, lambda x: x <> 0)) > 0),
links AS (
  SELECT a.vec_id AS a, b.vec_id AS b FROM good a JOIN good b ON a.vec_id < b.vec_id AND len(a.v) = len(b.v)
  WHERE list_cosine_similarity(a.v, b.v) >= 0.9),{_CLOSURE},
counted AS (SELECT id, count(*) AS n FROM (SELECT a AS id FROM links UNION ALL SELECT b FROM links) GROUP BY id),
least AS (SELECT node, min(other) AS c FROM reach GROUP BY node)
SELECT vec_id, coalesce(n, 0) AS n_links, least(vec_id, coalesce(c, vec_id)) AS component_id, vec_id = least(vec_id, coalesce(c, vec_id)) AS kept
FROM embeddings LEFT JOIN counted ON id = vec_id LEFT JOIN least ON node = vec_id"""

OP9 = f"""
WITH RECURSIVE words AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\\x20\\x09-\\x0D]+') AS w
  FROM documents),
sets AS (
  SELECT doc_id, CASE WHEN len(w) = 0 THEN [] WHEN len(w) < 4 THEN [array_to_string(w, ' ')]
    ELSE list_distinct(list_transform(range(1, len(w) - 2), lambda i: array_to_string(w[i:i + 3], ' '))) END AS s FROM words),
one AS (SELECT doc_id, unnest(s) AS g FROM sets),
both_ AS (SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS n FROM one a JOIN one b USING (g) WHERE a.doc_id < b.doc_id GROUP BY 1, 2),
links AS (SELECT a, b FROM both_ JOIN sets x ON x.doc_id = a JOIN sets y ON y.doc_id = b WHERE 100 * n >= 85 * (len(x.s) + len(y.s) - n)),{_CLOSURE}
SELECT doc_id, cast(len(s) AS bigint) AS n_shingles, least(doc_id, coalesce(c, doc_id)) AS component_id
FROM sets LEFT JOIN (SELECT node, min(other) AS c FROM reach GROUP BY node) ON node = doc_id"""

# CRC-32 (reflected polynomial 0xEDB88320) of an ASCII string
_CRC = """xor(4294967295, list_reduce(list_transform(range(1, length({s}) + 1), lambda i: cast(ascii({s}[i]) AS bigint)),
    lambda c, b: list_reduce(range(8), lambda r, k: xor(r >> 1, 3988292384 * (r & 1)), xor(c, b)), cast(4294967295 AS bigint)))"""

OP11 = """
WITH RECURSIVE said AS (
  SELECT conv_id, turn, coalesce(role, ' ') AS role, coalesce(text, ' ') AS text,
    coalesce(cast(conv_id AS varchar), ' ') || ':' || coalesce(cast(turn AS varchar), ' ') AS k FROM conversations),
hurt AS (SELECT *, """ + _CRC.format(s="k") + """ % 20 AS f FROM said),
damaged AS (
  SELECT conv_id, turn, CASE f WHEN 4 THEN 'user' ELSE role END AS role,
    CASE f WHEN 1 THEN '' WHEN 2 THEN regexp_replace(text, '[.!?]', '', 'g') ELSE text END AS text,
    unnest(range(CASE f WHEN 3 THEN 2 ELSE 1 END)) AS copy
  FROM hurt WHERE f <> 0),
placed AS (
  SELECT conv_id, turn, role, text, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, text, copy) AS pos FROM damaged),
marked AS (
  SELECT *, CASE WHEN NOT regexp_matches(text, '[^\\x20\\x09-\\x0D]') THEN 'blank'
      WHEN row_number() OVER (PARTITION BY conv_id, role, text ORDER BY pos) > 1 THEN 'duplicate'
      WHEN NOT regexp_matches(text, '[.!?][\\x20\\x09-\\x0D]*$') THEN 'truncated' ELSE '' END AS fault,
    lag(left(role, 1)) OVER (PARTITION BY conv_id ORDER BY pos) || left(role, 1) AS pair
  FROM placed),
dp AS (
  SELECT DISTINCT conv_id, cast(0 AS bigint) AS pos, 'n' AS q, cast(0 AS bigint) AS cost, '' AS audit, cast([] AS varchar[]) AS lines FROM marked
  UNION ALL
  SELECT conv_id, pos, q2, c2, a2, l2 FROM (
    SELECT *, row_number() OVER (PARTITION BY conv_id, q2 ORDER BY c2, a2) AS rn FROM (
      SELECT dp.conv_id, r.pos,
        CASE e WHEN 'D' THEN q1 WHEN 'K' THEN left(r.role, 1) ELSE CASE q1 WHEN 'u' THEN 'a' ELSE 'u' END END AS q2,
        cost + 3 * m + CASE e WHEN 'D' THEN 4 WHEN 'R' THEN 3 ELSE 0 END + CASE WHEN e <> 'D' AND fault = 'truncated' THEN 3 ELSE 0 END AS c2,
        audit || repeat('I', m) || e AS a2,
        list_concat(lines, CASE m WHEN 0 THEN [] WHEN 1 THEN [CASE q1 WHEN 'u' THEN 'user:' ELSE 'assistant:' END]
            ELSE CASE q1 WHEN 'u' THEN ['assistant:', 'user:'] ELSE ['user:', 'assistant:'] END END,
          CASE e WHEN 'D' THEN [] WHEN 'K' THEN [r.role || ':' || r.text]
            ELSE [CASE q1 WHEN 'u' THEN 'assistant:' ELSE 'user:' END || r.text] END) AS l2
      FROM (SELECT *, CASE WHEN m = 0 THEN q WHEN (q = 'u') = (m = 1) THEN 'a' ELSE 'u' END AS q1
            FROM dp CROSS JOIN (VALUES (0), (1), (2)) i(m)) dp
      JOIN marked r ON r.conv_id = dp.conv_id AND r.pos = dp.pos + 1
      CROSS JOIN (VALUES ('D'), ('K'), ('R')) x(e)
      WHERE e = 'D' OR fault NOT IN ('blank', 'duplicate')
        AND (e = 'R' OR q1 || left(r.role, 1) IN ('ns', 'nu', 'su', 'ua', 'au')))) WHERE rn = 1),
ended AS (
  SELECT conv_id, cost + CASE q WHEN 's' THEN 6 WHEN 'u' THEN 3 ELSE 0 END AS cost, audit || CASE q WHEN 's' THEN 'II' WHEN 'u' THEN 'I' ELSE '' END AS audit,
    list_concat(lines, CASE q WHEN 's' THEN ['user:', 'assistant:'] WHEN 'u' THEN ['assistant:'] ELSE [] END) AS lines
  FROM dp WHERE pos = (SELECT max(pos) FROM marked m WHERE m.conv_id = dp.conv_id)),
best AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY conv_id ORDER BY cost, audit) AS rn FROM ended) WHERE rn = 1),
counts AS (
  SELECT conv_id, coalesce(max(turn) - min(turn) + 1 - count(DISTINCT turn), 0) AS gaps, count(*) FILTER (fault = 'blank') AS blank,
    count(*) FILTER (fault = 'duplicate') AS duplicate, count(*) FILTER (fault = 'truncated') AS truncated,
    count(*) FILTER (pair NOT IN ('su', 'ua', 'au')) AS illegal FROM marked GROUP BY conv_id)
SELECT conv_id, cast(coalesce(gaps, 0) AS bigint) AS gaps, coalesce(blank, 0) AS blank, coalesce(duplicate, 0) AS duplicate,
  coalesce(truncated, 0) AS truncated, coalesce(illegal, 0) AS illegal, coalesce(cost, 0) AS cost, coalesce(audit, '') AS audit,
  sha256(coalesce(array_to_string(lines, chr(10)), '')) AS repaired_sha256
FROM (SELECT DISTINCT conv_id FROM conversations) LEFT JOIN counts USING (conv_id) LEFT JOIN best USING (conv_id)"""


def op13(k: int = 40, rounds: int = 5) -> str:
    """One pair of tables (assignment, centroids) per round."""
    def assign(i: int) -> str:
        return f"""a{i} AS MATERIALIZED (
  SELECT rid, vec_id, v, c, d FROM (SELECT *, row_number() OVER (PARTITION BY rid ORDER BY d, c) AS rn FROM (
    SELECT rid, vec_id, kept.v, c, list_inner_product(kept.v, kept.v) - 2 * list_inner_product(kept.v, m.v) + list_inner_product(m.v, m.v) AS d
    FROM kept CROSS JOIN c{i} m)) WHERE rn = 1)"""

    parts = [f"""kept AS MATERIALIZED (
  SELECT row_number() OVER () AS rid, vec_id, list_transform(embedding, lambda x: floor(256 * cast(x AS double))) AS v FROM embeddings
  WHERE len(embedding) = 64 AND len(list_filter(embedding, lambda x: x IS NULL OR isnan(x) OR isinf(x))) = 0),
c0 AS MATERIALIZED (
  SELECT cast(row_number() OVER (ORDER BY h) - 1 AS integer) AS c, v FROM (SELECT sha256('2:' || vec_id) AS h, v FROM kept ORDER BY h LIMIT {k}))"""]
    for i in range(rounds):
        parts.append(assign(i))
        parts.append(f"""c{i + 1} AS MATERIALIZED (
  SELECT c{i}.c, coalesce(m.v, c{i}.v) AS v FROM c{i} LEFT JOIN (
    SELECT c, list(floor(s / n) ORDER BY i) AS v FROM (
      SELECT c, i, sum(x) AS s, count(*) AS n FROM (SELECT c, unnest(v) AS x, unnest(range(64)) AS i FROM a{i}) GROUP BY c, i) GROUP BY c) m USING (c))""")
    parts.append(assign(rounds))
    return f"""WITH {', '.join(parts)}
SELECT vec_id, a.c AS cluster, cast(d AS bigint) AS distance, cast(sum(d) OVER (PARTITION BY a.c) AS bigint) AS cluster_inertia,
  cast(sum(d) OVER () AS bigint) AS inertia, sha256(array_to_string(list_transform(m.v, lambda x: cast(cast(x AS bigint) AS varchar)), ',')) AS centroid_sha256
FROM a{rounds} a JOIN c{rounds} m ON m.c = a.c"""


__all__ = ["OP1", "OP7", "OP9", "OP11", "op13"]
