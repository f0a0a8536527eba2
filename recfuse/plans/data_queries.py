"""Queries of the general data problems."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from recfuse.operators.nested import nested_elements
from recfuse.operators.packed import explode_packed
from recfuse.session import table


def p2_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every filled nested element of the three tables, with its position."""
    return nested_elements(*[table(spark, sf_dir, t) for t in ("ats_sample", "output_ats_export", "raw_record")])


def p7_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One row per skill of the recruiters' packed field."""
    return explode_packed(table(spark, sf_dir, "recruiter_sample"), "row_id", "skills", "skill")


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {"p2_found": p2_found, "p7_found": p7_found}


def _filled(alias: str, fields: tuple[str, ...]) -> str:
    return f"regexp_matches(concat_ws('', {', '.join(f'{alias}.{f}' for f in fields)}), '[^\\s\\x{{00a0}}]')"


_JOB = ("company", "title", "start_date", "end_date", "description", "location")
_SCHOOL = ("institution", "degree", "field_of_study", "start_date", "end_date", "grade")
#: Whether a JSON text holds a non-blank value, after its member names are taken away.
_HAS = r"""regexp_matches(regexp_replace({0}::VARCHAR, '"(?:[^"\\]|\\.)*"\s*:', '', 'g'), '"(?:[^"\\]|\\.)*[^\s"\\](?:[^"\\]|\\.)*"|[0-9]|true|false')"""

_P2_SQL = f"""
WITH ok AS (SELECT row_id, raw_fields::JSON AS j FROM raw_record WHERE json_valid(raw_fields) AND trim(raw_fields) <> ''),
listed AS (SELECT row_id, CASE WHEN json_type(j) = 'ARRAY' THEN json_extract(j, '$[*]') WHEN json_type(j) <> 'OBJECT' THEN [] WHEN json_exists(j, '$.candidates') THEN json_extract(j, '$.candidates[*]')
  WHEN json_exists(j, '$.candidate') THEN [json_extract(j, '$.candidate')] WHEN json_exists(j, '$.Worker') THEN [json_extract(j, '$.Worker.Personal_Data')] WHEN json_exists(j, '$.data') THEN [json_extract(j, '$.data')] ELSE [j] END AS l FROM ok),
cand AS (SELECT row_id, unnest(l) AS c, generate_subscripts(l, 1) - 1 AS pos FROM listed),
good AS (SELECT * FROM cand WHERE json_type(c) = 'OBJECT' AND {_HAS.format('c')}),
held AS (SELECT row_id, pos, coalesce(json_extract(c, '$.experience'), json_extract(c, '$.employments'), json_extract(c, '$.work_history')) AS e FROM good),
read AS (SELECT row_id, pos, CASE WHEN json_type(e) = 'VARCHAR' THEN (CASE WHEN json_valid(json_extract_string(e, '$')) THEN json_extract_string(e, '$') ELSE 'null' END)::JSON ELSE e END AS e FROM held),
bare AS (SELECT row_id, pos, CASE WHEN json_type(e) = 'OBJECT' AND json_exists(e, '$.items') THEN json_extract(e, '$.items') ELSE e END AS e FROM read),
jobs AS (
  SELECT row_id, pos, unnest(json_extract(e, '$[*]')) AS x, generate_subscripts(json_extract(e, '$[*]'), 1) - 1 AS k FROM bare WHERE json_type(e) = 'ARRAY'
  UNION ALL SELECT row_id, pos, json_extract(e, '$."' || n || '"'), n::BIGINT FROM (SELECT row_id, pos, e, unnest(json_keys(e)) AS n FROM bare WHERE json_type(e) = 'OBJECT') WHERE regexp_full_match(n, '[0-9]+')
  UNION ALL SELECT row_id, pos, e, 0 FROM bare WHERE json_type(e) = 'OBJECT' AND len(list_filter(json_keys(e), lambda n: regexp_full_match(n, '[0-9]+'))) = 0),
nests AS (SELECT row_id, 'experience' AS node, unnest(experience) AS e, generate_subscripts(experience, 1) - 1 AS pos FROM ats_sample),
schools AS (SELECT row_id, unnest(education) AS e, generate_subscripts(education, 1) - 1 AS pos FROM ats_sample),
skilled AS (SELECT row_id, unnest(skills).sources AS l, generate_subscripts(skills, 1) - 1 AS pos FROM output_ats_export),
sourced AS (SELECT row_id, pos, unnest(l) AS s, generate_subscripts(l, 1) - 1 AS k FROM skilled)
SELECT 'ats_sample' AS tbl, row_id, 'position' AS node, 0::BIGINT AS pos, -1::BIGINT AS child_pos FROM ats_sample WHERE {_filled('current_position', _JOB)}
UNION ALL SELECT 'ats_sample', row_id, node, pos::BIGINT, -1 FROM nests WHERE {_filled('e', _JOB)}
UNION ALL SELECT 'ats_sample', row_id, 'education', pos::BIGINT, -1 FROM schools WHERE {_filled('e', _SCHOOL)}
UNION ALL SELECT 'output_ats_export', row_id, 'source', pos::BIGINT, k::BIGINT FROM sourced WHERE regexp_matches(s, '[^\\s\\x{{00a0}}]')
UNION ALL SELECT 'raw_record', row_id, 'candidate', pos::BIGINT, -1 FROM good
UNION ALL SELECT 'raw_record', row_id, 'experience', pos::BIGINT, k::BIGINT FROM jobs WHERE json_type(x) = 'OBJECT' AND {_HAS.format('x')}
"""


_SPAN = r"""("(?:[^"\\]|\\.|"")*"|\([^()]*\))"""
_P7_SQL = rf"""
WITH t AS (SELECT row_id, regexp_replace(skills, '^[\s\x{{00a0}}\x{{200b}}\x{{feff}}]+|[\s\x{{00a0}}\x{{200b}}\x{{feff}}]+$', '', 'g') AS s FROM recruiter_sample),
u AS (SELECT row_id, CASE WHEN lower(s) IN ('', '-', '--', '–', '—', 'n/a', 'na', 'none', 'null', 'nil', 'tbd', 'tba', 'unknown', '?', 'nan') THEN '' ELSE s END AS s FROM t WHERE s IS NOT NULL),
typed AS (SELECT row_id, s, regexp_matches(s, '^\[''') AS quoted FROM u),
plain AS (SELECT row_id, CASE WHEN regexp_matches(s, '(?s)^\[.*\]$') THEN s[2:-2] ELSE s END AS s FROM typed WHERE NOT quoted),
cut AS (SELECT row_id, regexp_extract_all(s, '{_SPAN}') AS spans, regexp_split_to_array(s, '{_SPAN}') AS gaps FROM plain),
masked AS (SELECT row_id, spans, array_to_string(list_transform(gaps, lambda g, i: g || CASE WHEN i <= len(spans) THEN chr(57344) || (i - 1) || chr(57345) ELSE '' END), '') AS m FROM cut),
parts AS (SELECT row_id, spans, regexp_split_to_array(regexp_replace(m, '\s+(\d{{1,3}}[.)]\s)', chr(10) || '\1', 'g'), '[,;|\t\n\r·•]+|\s/\s|\s&\s|\sand\s') AS p FROM masked),
clean AS (SELECT row_id, spans, list_transform(p, lambda x: regexp_replace(trim(x), '^(?:\d{{1,3}}[.)]|[-*–—])\s+', '')) AS p FROM parts),
back AS (SELECT row_id, list_transform(p, lambda x: CASE WHEN regexp_full_match(x, chr(57344) || '\d+' || chr(57345)) AND spans[regexp_extract(x, '\d+')::INT + 1][1] = '"'
    THEN trim(replace(regexp_replace(spans[regexp_extract(x, '\d+')::INT + 1][2:-2], '\\(["\\])', '\1', 'g'), '""', '"'))
    WHEN contains(x, chr(57344)) THEN trim(split_part(x, chr(57344), 1) || spans[split_part(split_part(x, chr(57344), 2), chr(57345), 1)::INT + 1] || split_part(x, chr(57345), 2)) ELSE x END) AS v FROM clean),
lists AS (SELECT row_id, list_transform(regexp_extract_all(s, '''([^'']*)''', 1), lambda x: trim(x)) AS v FROM typed WHERE quoted),
every AS (SELECT row_id, list_filter(v, lambda x: x <> '') AS v FROM (SELECT * FROM back UNION ALL SELECT * FROM lists))
SELECT row_id, generate_subscripts(v, 1)::BIGINT - 1 AS pos, unnest(v) AS skill FROM every
"""


def oracle_sql() -> dict[str, str]:
    return {"p2_found": _P2_SQL, "p7_found": _P7_SQL}
