"""SQL of the core's problem queries, for comparison."""

from __future__ import annotations

from . import plans

_KEY = r"nullif(trim(regexp_replace(lower({}), '[\s_-]+', ' ', 'g')), '')"


def _refs(cascade: bool) -> str:
    refs = [
        ("results", "result_id", "indicator_abbreviation", "indicators", "abbreviation"),
        ("results", "result_id", "tissue_site", "tissue_sites", "site_name"),
        ("interventions", "intervention_id", "intervention_target", "alternatives", "standard_name"),
    ] + ([("indicators", "indicator_id", "measured_in", "tissue_sites", "site_name")] if cascade else [])
    parents = {("indicators", "indicator_id", "abbreviation"), ("tissue_sites", "tissue_site_id", "site_name"), ("alternatives", "alternative_id", "standard_name")}
    c = " UNION ALL ".join(f"SELECT DISTINCT '{t}' AS ref_table, '{f}' AS ref_field, {i} AS record_id, document_id AS d, '{p}' AS p, {_KEY.format(f)} AS k, loaded_at AS l FROM {t}" for t, i, f, p, _ in refs)
    q = " UNION ALL ".join(f"SELECT '{p}' AS p, {i} AS pid, document_id AS d, {_KEY.format(f)} AS k, loaded_at AS a, deleted_at IS NOT NULL AS gone FROM {p}" for p, i, f in sorted(parents))
    return f"""c AS (SELECT * FROM ({c}) WHERE k IS NOT NULL), q AS (SELECT * FROM ({q}) WHERE k IS NOT NULL),
t AS (SELECT p, d, k, min(a) FILTER (WHERE NOT gone) AS first, true AS known FROM q GROUP BY p, d, k),
direct AS (SELECT ref_table, ref_field, record_id, strftime(l, '%Y-%m') AS ref_month,
  CASE WHEN known IS NULL THEN 'missing' WHEN first IS NULL THEN 'deleted' WHEN first > l THEN 'late' END AS reason
  FROM c LEFT JOIN t USING (p, d, k))"""


def oracle_sql() -> dict[str, str]:
    return plans.load()[1] | {
        "p4_found": f"WITH {_refs(False)} SELECT * FROM direct WHERE reason IS NOT NULL",
        "p4_cascade": f"""WITH {_refs(True)},
bad AS (SELECT DISTINCT record_id AS pid FROM direct WHERE reason IS NOT NULL AND ref_table = 'indicators'),
lost AS (SELECT p, d, k FROM q WHERE p = 'indicators' AND NOT gone GROUP BY p, d, k HAVING bool_and(pid IN (FROM bad))),
down AS (SELECT ref_table, ref_field, record_id, strftime(l, '%Y-%m') AS ref_month, 'inherited' AS reason
  FROM c JOIN lost USING (p, d, k) WHERE (ref_table, ref_field, record_id) NOT IN (SELECT (ref_table, ref_field, record_id) FROM direct WHERE reason IS NOT NULL)),
everything AS (SELECT *, 'direct' AS kind FROM direct WHERE reason IS NOT NULL UNION ALL SELECT *, 'inherited' FROM down)
SELECT ref_table, ref_field, ref_month, reason, kind, count(*) AS n_orphans FROM everything GROUP BY ALL""",
    }
