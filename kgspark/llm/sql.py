"""SQL for the queries that SQL can express. The others are tested against brute force on small fixtures."""

from __future__ import annotations

_P1 = """WITH RECURSIVE e AS (
  SELECT entity_type AS s, left_id AS a, right_id AS b FROM match_pairs WHERE left_id <> right_id AND entity_type IS NOT NULL
  UNION SELECT entity_type, right_id, left_id FROM match_pairs WHERE left_id <> right_id AND entity_type IS NOT NULL),
reach AS (
  SELECT s, a AS v, a AS g FROM e
  UNION SELECT r.s, e.b, r.g FROM reach r JOIN e ON e.s = r.s AND e.a = r.v WHERE r.g < e.b),
found AS (SELECT s AS entity_type, v AS record_id, min(g) AS group_id FROM reach GROUP BY s, v)
"""

_STATED = r"""p.v IS NOT NULL AND regexp_replace(lower(p.v), '^\s+|\s+$', '', 'g') NOT IN ('', 'n/a', 'na', 'none', 'unknown', 'unspecified', 'not reported', '-', '?')"""

_STRETCH = r"""list_max(list_transform(regexp_split_to_array(text, '[\s\x{00a0}\x{1680}\x{2000}-\x{200a}\x{2028}\x{2029}\x{202f}\x{205f}\x{3000}\x{0085}.!?。！？]'), lambda x: length(x)))"""


def oracle_sql() -> dict[str, str]:
    return {
        "p1_found": f"{_P1} SELECT * FROM found",
        "p1_group_sizes": f"""{_P1}, sizes AS (SELECT entity_type, group_id, count(*) AS n_records FROM found GROUP BY ALL)
SELECT entity_type, n_records, count(*) AS n_groups FROM sizes GROUP BY ALL""",
        "p3_found": rf"""WITH n AS (SELECT g.*, t.trust_rank FROM graph_nodes g LEFT JOIN source_trust t USING (source)),
several AS (SELECT id FROM graph_nodes GROUP BY id HAVING min(row_id) < max(row_id)),
props AS (SELECT n.id, p.k AS property_name, n.row_id, n.trust_rank, n.updated_at, 0 AS c
  FROM n, (SELECT row_id AS r, unnest(map_keys(properties)) AS k, unnest(map_values(properties)) AS v FROM graph_nodes) p
  WHERE p.r = n.row_id AND {_STATED}),
pm AS (SELECT row_id, count(DISTINCT trim(p)) AS c FROM (SELECT row_id, unnest(source_pmids) AS p FROM graph_nodes) WHERE trim(p) <> '' GROUP BY row_id),
offers AS (SELECT * FROM props UNION ALL SELECT n.id, 'source_pmids', n.row_id, n.trust_rank, n.updated_at, pm.c FROM n JOIN pm USING (row_id))
SELECT id, property_name, row_id FROM offers WHERE id IN (FROM several)
QUALIFY row_number() OVER (PARTITION BY id, property_name ORDER BY c DESC, trust_rank NULLS LAST, updated_at DESC NULLS LAST, row_id DESC) = 1""",
        "p5_found": rf"""WITH items AS (
  SELECT document_id, 'articles.body_text' AS item_kind, -1::BIGINT AS item_pos, body_text AS text FROM articles
  UNION ALL SELECT document_id, 'articles.sections', pos::BIGINT - 1, sections[pos].section_text
  FROM (SELECT document_id, sections, unnest(range(1, len(sections) + 1)) AS pos FROM articles))
SELECT document_id, item_kind, item_pos, CASE WHEN {_STRETCH} > max_size THEN 'forced' ELSE 'natural' END AS cut_kind
FROM items JOIN size_limits USING (item_kind) WHERE length(text) > max_size""",
    }
