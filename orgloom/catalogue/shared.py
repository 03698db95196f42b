"""SQL pieces that restate the rendered inputs over the base tables."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession

from orgloom.catalogue.inputs import HOST, KEYWORD_FLAG, RUN_TS
from orgloom.schemas import DATASETS, ExtractionSpec

SPEC = ExtractionSpec()


@dataclass(frozen=True)
class Query:
    run: Callable[[SparkSession, str], DataFrame]
    sql: str | None = None


ORGS = f"""
orgs AS (
  SELECT s_suppkey AS k, s_name AS name,
    CASE s_suppkey % 10
      WHEN 0 THEN 'https://{HOST}/company/' || s_suppkey || '/'
      WHEN 1 THEN 'https://{HOST}/company/' || s_suppkey
      WHEN 2 THEN 'http://{HOST}/company/' || s_suppkey || '/people/x'
      WHEN 3 THEN 'www.{HOST}/company/' || s_suppkey || '?trk=1'
      WHEN 4 THEN '{HOST}/company/' || s_suppkey
      WHEN 5 THEN '-'
      WHEN 6 THEN '   '
      WHEN 8 THEN 'https://{HOST}/o' || s_suppkey
      WHEN 9 THEN 'HTTP://{HOST}/company/' || s_suppkey
    END AS profile_url,
    CASE s_suppkey % 10
      WHEN 4 THEN 'invalid' WHEN 5 THEN 'blank' WHEN 6 THEN 'blank'
      WHEN 7 THEN 'null' WHEN 9 THEN 'invalid' ELSE 'valid'
    END AS url_status,
    CASE s_suppkey % 10
      WHEN 0 THEN 'https://{HOST}/company/' || s_suppkey
      WHEN 1 THEN 'https://{HOST}/company/' || s_suppkey
      WHEN 2 THEN 'https://{HOST}/company/' || s_suppkey
      WHEN 3 THEN 'https://www.{HOST}/company/' || s_suppkey || '?trk=1'
      WHEN 8 THEN 'https://{HOST}/o' || s_suppkey
    END AS base_url
  FROM supplier
)"""

BARS = f"""
counted AS (
  SELECT l_suppkey AS k, 'locations' AS facet, n_name AS label,
         count(*) AS n_all, count(*) FILTER (l_returnflag = '{KEYWORD_FLAG}') AS n_hit
  FROM lineitem JOIN orders ON l_orderkey = o_orderkey
       JOIN customer ON o_custkey = c_custkey JOIN nation ON c_nationkey = n_nationkey
  GROUP BY ALL
  UNION ALL
  SELECT l_suppkey, 'roles', p_type, count(*), count(*) FILTER (l_returnflag = '{KEYWORD_FLAG}')
  FROM lineitem JOIN part ON l_partkey = p_partkey GROUP BY ALL
),
bars AS (
  SELECT k, facet || '_all' AS dataset, label, n_all AS n FROM counted
  UNION ALL
  SELECT k, facet || '_kw', label, n_hit FROM counted WHERE n_hit > 0
),
placed AS (
  SELECT *, row_number() OVER (PARTITION BY k, dataset ORDER BY n DESC, label) - 1 AS pos,
         count(*) OVER (PARTITION BY k, dataset) AS n_bars
  FROM bars
),
totals AS (
  SELECT s_suppkey AS k, s_name AS name, n_name AS nation,
         coalesce(n_all, 0) AS n_all, coalesce(n_kw, 0) AS n_kw, coalesce(types, '') AS types
  FROM supplier JOIN nation ON s_nationkey = n_nationkey
  LEFT JOIN (
    SELECT k, sum(n_all)::BIGINT AS n_all, sum(n_hit)::BIGINT AS n_kw,
           string_agg(label, ', ' ORDER BY label) AS types
    FROM counted WHERE facet = 'roles' GROUP BY k
  ) ON s_suppkey = k
)"""

_KINDS = ", ".join(f"('{kind}', '{suffix}')" for kind, suffix in SPEC.suffixes.items())

# what was captured: no page for variant 3, a redirect for variants 4 and 5
PAGES = f"""
targets AS (
  SELECT k, name, base_url, page_kind, base_url || suffix AS target_url, (k // 10) % 10 AS variant
  FROM orgs CROSS JOIN (VALUES {_KINDS}) kinds(page_kind, suffix)
  WHERE url_status = 'valid'
),
visits AS (
  SELECT *, variant <> 3 AS captured,
    CASE variant WHEN 3 THEN NULL WHEN 4 THEN 'https://{HOST}/unavailable/'
                 WHEN 5 THEN target_url || '#moved' ELSE target_url END AS final_url,
    CASE WHEN variant <> 3 THEN
      strftime(TIMESTAMP '2024-05-01' + to_seconds(k % 86400), '%Y-%m-%dT%H:%M:%S')
      || CASE WHEN page_kind = 'people_kw' THEN '.250000' ELSE '' END
    END AS stamp
  FROM targets
)"""


def with_ctes(*ctes: str, select: str) -> str:
    """A query over some of the pieces; ``select`` may go on with more of its own."""
    return "WITH " + ",".join(ctes) + "\n" + select.strip()


def people_sql(facet: str, keyword: bool) -> str:
    """All records of one people dataset, from the base tables."""
    dataset = f"{facet}_{'kw' if keyword else 'all'}"
    kind, total = ("people_kw", "n_kw") if keyword else ("people", "n_all")
    bad = "variant = 9" if facet == "roles" else "false"
    more = "|| CASE WHEN variant = 1 THEN CASE WHEN n_bars > 0 THEN '|' ELSE '' END || 'No count=-|-=7' ELSE '' END"
    extra = more if facet == "locations" else ""
    return f"""
SELECT '{dataset}' AS dataset, outcome, name AS input_company_name,
  CASE WHEN outcome IN ('ok', 'no_bars') AND variant <> 6 THEN name || ' & Co' ELSE '-' END AS company_name,
  CASE WHEN outcome = 'unavailable' THEN base_url END AS profile_url,
  CASE WHEN outcome = 'unavailable' THEN target_url END AS targeted_url,
  CASE WHEN outcome <> 'exception' THEN final_url END AS redirected_url,
  CASE WHEN variant = 3 THEN 'page not captured'
       WHEN outcome = 'exception' THEN 'a bar has spans but no category' END AS error,
  coalesce(stamp, '{RUN_TS}') AS time_stamp,
  CASE WHEN outcome = 'unavailable' THEN NULL
       WHEN outcome IN ('ok', 'no_bars') AND variant <> 8 THEN format('{{:,}}', {total})
       ELSE '-' END AS members,
  CASE WHEN outcome = 'ok' THEN coalesce(bars_listed, '') {extra} END AS listed,
  outcome IN ('no_bars', 'exception') AS items_missing
FROM (
  SELECT visits.*, totals.*, n_bars, bars_listed,
    CASE WHEN variant = 3 THEN 'exception' WHEN variant = 4 THEN 'unavailable'
         WHEN variant = 7 THEN 'no_bars' WHEN {bad} THEN 'exception' ELSE 'ok' END AS outcome
  FROM visits JOIN totals USING (k, name)
  LEFT JOIN (
    SELECT k, count(*) AS n_bars, string_agg(label || '=' || format('{{:,}}', n), '|' ORDER BY pos) AS bars_listed
    FROM placed WHERE dataset = '{dataset}' GROUP BY k
  ) USING (k)
  WHERE page_kind = '{kind}'
)
UNION ALL
SELECT '{dataset}', 'placeholder', NULL, name, profile_url, NULL, NULL, NULL, '{RUN_TS}', NULL, NULL, false
FROM orgs WHERE url_status IN ('blank', 'invalid')"""


ABOUT_SQL = f"""
SELECT 'about' AS dataset, outcome, name AS input_company_name,
  CASE WHEN outcome = 'ok' THEN name || ' & Co' ELSE '-' END AS company_name,
  base_url AS profile_url,
  CASE WHEN outcome = 'unavailable' THEN target_url END AS targeted_url,
  CASE WHEN outcome IN ('ok', 'unavailable') THEN final_url END AS redirected_url,
  CASE outcome WHEN 'exception' THEN 'page not captured' WHEN 'not_loaded' THEN 'no h1 on page' END AS error,
  coalesce(stamp, '{RUN_TS}') AS time_stamp,
  CASE WHEN outcome = 'ok' THEN format('{{:,}}', n_all) END AS members,
  CASE WHEN outcome = 'ok' THEN 'https://www.' || k || '.example.com' END AS website,
  CASE WHEN outcome = 'ok' THEN nation END AS industry,
  CASE WHEN outcome = 'ok' THEN '''' || format('{{:,}}', n_kw) || '-' || format('{{:,}}', n_all) END AS company_size,
  CASE WHEN outcome = 'ok' THEN nation || 'City' END AS headquarters,
  CASE WHEN outcome = 'ok' THEN (1900 + k % 100)::VARCHAR END AS founded,
  CASE WHEN outcome = 'ok' THEN CASE WHEN variant = 8 THEN '-' ELSE types END END AS specialties
FROM (
  SELECT visits.*, totals.*,
    CASE variant WHEN 3 THEN 'exception' WHEN 4 THEN 'unavailable' WHEN 6 THEN 'not_loaded' ELSE 'ok' END AS outcome
  FROM visits JOIN totals USING (k, name) WHERE page_kind = 'about'
)
UNION ALL
SELECT 'about', 'placeholder', NULL, name, profile_url, NULL, NULL, NULL, '{RUN_TS}',
       NULL, NULL, NULL, NULL, NULL, NULL, NULL
FROM orgs WHERE url_status IN ('blank', 'invalid')"""


def items_sql(dataset: str) -> str:
    """``items``: the list of every rendered record, one row per item, with its place."""
    default = DATASETS[dataset].default_label
    return f"""
items AS (
  SELECT k, pos, label, format('{{:,}}', n) AS count, true AS is_entry
  FROM placed WHERE dataset = '{dataset}' AND k % 10 NOT IN (5, 6, 7)
  UNION ALL
  SELECT k, n_bars, label, '0', true FROM placed WHERE dataset = '{dataset}' AND k % 10 = 4 AND pos = 0
  UNION ALL
  SELECT k, 0, '-', '-', false FROM totals WHERE k % 10 = 6
  UNION ALL
  SELECT k, coalesce(n_bars, 0), '{default}', '7', true FROM totals
  LEFT JOIN (SELECT k, n_bars FROM placed WHERE dataset = '{dataset}' AND pos = 0) USING (k) WHERE k % 10 = 8
  UNION ALL
  SELECT k, coalesce(n_bars, 0) + step, CASE step WHEN 0 THEN 'No count' ELSE 'Freelance' END, '-', step = 0
  FROM totals LEFT JOIN (SELECT k, n_bars FROM placed WHERE dataset = '{dataset}' AND pos = 0) USING (k)
  CROSS JOIN (VALUES (0), (1)) steps(step) WHERE k % 10 = 9
),
records AS (
  SELECT k, name AS input_company_name,
    CASE WHEN k % 10 = 6 THEN '-' ELSE name || ' & Co' END AS company_name,
    CASE WHEN k % 4 = 3 THEN '{RUN_TS}' ELSE '2024-05-01T00:00:' || lpad((k % 60)::VARCHAR, 2, '0') END AS time_stamp,
    CASE WHEN k % 10 = 7 THEN '-' ELSE 'https://{HOST}/company/' || k END AS redirected_url,
    CASE WHEN k % 10 = 7 THEN '-' ELSE format('{{:,}}', {"n_kw" if dataset.endswith("kw") else "n_all"}) END AS members
  FROM totals
)"""
