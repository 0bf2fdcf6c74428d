"""SQL views that derive the same inputs as ``tallyloom.fixtures``, for the comparison queries."""

from __future__ import annotations

import re

_STANDARD = """CASE WHEN {h} BETWEEN 0 AND 5 THEN 'Overnight - Midnight-6AM' WHEN {h} BETWEEN 6 AND 8 THEN 'Early Morning - 6AM-9AM'
  WHEN {h} BETWEEN 9 AND 15 THEN 'Daytime - 9AM-4PM' WHEN {h} BETWEEN 16 AND 17 THEN 'Early Fringe - 4PM-6PM'
  WHEN {h} BETWEEN 18 AND 19 THEN 'Prime Access - 6PM-8PM' WHEN {h} BETWEEN 20 AND 22 THEN 'Prime - 8PM-11PM'
  WHEN {h} = 23 THEN 'Late Fringe - 11PM-12AM' END"""
_CUSTOM = """CASE WHEN {h} BETWEEN 0 AND 1 THEN 'Late Fringe - 12AM-2AM' WHEN {h} BETWEEN 2 AND 5 THEN 'Overnight – 2AM-6AM'
  WHEN {h} BETWEEN 6 AND 8 THEN 'Early Morning - 6AM-9AM' WHEN {h} BETWEEN 9 AND 15 THEN 'Daytime - 9AM-4PM'
  WHEN {h} BETWEEN 16 AND 19 THEN 'Early Fringe - 4PM-8PM' WHEN {h} BETWEEN 20 AND 23 THEN 'Prime - 8PM-12AM' END"""
_CLOCK = "(CASE WHEN hour % 12 = 0 THEN 12 ELSE hour % 12 END)::VARCHAR || ':00 ' || (CASE WHEN hour < 12 THEN 'AM' ELSE 'PM' END)"

_VIEWS: dict[str, str] = {
    "delivery": """
SELECT event_id, user_id,
  CASE user_id % 4 WHEN 0 THEN 'Comcast' WHEN 1 THEN 'Spectrum' WHEN 2 THEN 'Cox' ELSE 'Verizon' END AS mvpd,
  CASE WHEN user_id % 2 = 0 THEN 'BrandA' ELSE 'BrandB' END AS brand,
  CASE WHEN event_id % 3 = 0 THEN upper(event_type) ELSE event_type END AS raw_network,
  'NATION_' || (user_id % 25) || ', XX' AS raw_market,
  'NATION_' || (user_id % 25) AS city,
  CAST(ts AS DATE) AS event_date, CAST(hour(ts) AS BIGINT) AS hour,
  dayname(ts) AS day, CAST(isodow(ts) - 1 AS BIGINT) AS day_num,
  CASE WHEN event_id % 97 = 0 THEN 'n/a' WHEN event_id % 5 = 0 THEN format('{:,}', CAST(round(value * 100) AS BIGINT))
    ELSE CAST(CAST(round(value * 100) AS BIGINT) AS VARCHAR) END AS impressions_text,
  CASE WHEN event_id % 97 = 0 THEN NULL ELSE CAST(round(value * 100) AS DECIMAL(18,2)) END AS imp
FROM events""",
    "dayparted": f"SELECT *, {_STANDARD.format(h='hour')} AS daypart, {_CUSTOM.format(h='hour')} AS custom_daypart, {_CLOCK} AS clock FROM delivery",
    "net_map": """
SELECT * FROM (VALUES ('signup','Net S'), ('SIGNUP','Net S'), ('purchase','Net P'), ('PURCHASE','Net P'),
  ('view','Net V'), ('VIEW','Net V'), ('click','Net C'), ('CLICK','Net C')) AS v(feature_value, corrected_network)""",
    "dma_map": """
SELECT n_name AS geography, r_name || '-' || n_name AS corrected_dma, CAST(500 + n_nationkey AS BIGINT) AS dma_code
FROM nation JOIN region ON n_regionkey = r_regionkey WHERE n_nationkey NOT IN (3, 22, 23, 24)""",
    "mapped": """
SELECT d.*, coalesce(corrected_network, 'Unassigned') AS network, coalesce(corrected_dma, 'Unassigned') AS market
FROM dayparted d LEFT JOIN net_map n ON raw_network = feature_value LEFT JOIN dma_map m ON lower(city) = lower(geography)""",
    "titles": """
SELECT p_partkey AS show_id, CASE WHEN p_partkey % 3 > 0 THEN 'Movie' ELSE 'TV Show' END AS type, p_name AS title,
  CASE WHEN p_partkey % 50 <> 0 THEN p_brand END AS rating, CASE WHEN p_partkey % 11 <> 0 THEN p_type END AS country,
  CAST(1970 + p_size AS BIGINT) AS release_year, p_size || ' min' AS duration FROM part""",
    "indicators": """
SELECT o_orderkey AS row_id, CAST(year(o_orderdate) AS BIGINT) AS year_start, CAST(year(o_orderdate) AS BIGINT) AS year_end,
  n_name AS location_desc, o_orderpriority AS topic, c_mktsegment AS question,
  CASE WHEN o_orderkey % 4 <> 0 THEN o_totalprice END AS data_value
FROM orders JOIN customer ON o_custkey = c_custkey JOIN nation ON c_nationkey = n_nationkey""",
    "screening": """
SELECT o_custkey AS student_id, 'First' || o_custkey AS first_name, 'Last' || o_custkey AS last_name,
  CAST(o_custkey % 12 AS BIGINT) AS grade, 'Screening' AS activity_type,
  CASE WHEN o_orderstatus = 'F' THEN 'Fall Window' ELSE 'Other Window' END AS window_name,
  CASE o_orderpriority WHEN '1-URGENT' THEN 'Urgent Intervention' WHEN '2-HIGH' THEN 'Intervention' WHEN '3-MEDIUM' THEN 'On Watch'
    WHEN '4-NOT SPECIFIED' THEN 'At/Above Benchmark' ELSE 'Not Screened' END AS benchmark_category,
  CASE WHEN o_orderstatus = 'O' THEN 'FALL_WINTER' ELSE 'OTHER' END AS sgp_vector,
  CASE o_orderpriority WHEN '1-URGENT' THEN 1 WHEN '2-HIGH' THEN 2 WHEN '3-MEDIUM' THEN 3 WHEN '4-NOT SPECIFIED' THEN 4 END::BIGINT AS level
FROM orders""",
    "both_edges": """
SELECT user_id AS "from", event_id % 150 AS "to", CASE WHEN user_id % 2 = 0 THEN 'male' ELSE 'female' END AS gender_from, event_id AS edge_id
FROM events""",
    "attention": """
SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, l_quantity / 50 AS eyes, l_discount * 10 AS face_forward, l_tax * 10 AS chin_up,
  CASE WHEN l_returnflag = 'R' THEN 1.0::DOUBLE ELSE 0.0::DOUBLE END AS attention FROM lineitem""",
    "document_words": "SELECT doc_id, text, string_split(text, ' ') AS items FROM documents",
    "day_sheet": """
SELECT mvpd, coalesce(day, 'Total') AS display_by, sum(imp) AS n, format('{:,}', CAST(coalesce(sum(imp), 0) AS BIGINT)) AS impressions_text
FROM delivery GROUP BY ROLLUP (mvpd, day) HAVING mvpd IS NOT NULL""",
    "hour_sheet": """
SELECT mvpd, coalesce(clock, 'Total') AS display_by, sum(imp) AS n, format('{:,}', CAST(coalesce(sum(imp), 0) AS BIGINT)) AS impressions_text
FROM dayparted GROUP BY ROLLUP (mvpd, clock) HAVING mvpd IS NOT NULL""",
    "source_cells": """
SELECT mvpd || ' report' AS file, 'Day' AS sheet, display_by AS c0, impressions_text AS c1 FROM day_sheet
UNION ALL SELECT mvpd || ' report', 'Hour', display_by, impressions_text FROM hour_sheet""",
    "source_lines": """
SELECT * FROM source_cells
UNION ALL SELECT s.file, s.sheet, l.c0, l.c1 FROM (SELECT DISTINCT file, sheet FROM source_cells) s,
  (VALUES ('Delivery report', NULL), ('All dates,' || chr(10) || 'as "agreed"', NULL), ('Display By', 'Imp' || chr(10) || 'ressions')) AS l(c0, c1)""",
    "latin_lines": """
SELECT 'Agence rapport' AS file, 'Réseaux' AS sheet, 'Réseau ' || raw_network AS c0, CAST(coalesce(sum(imp), 0) AS BIGINT)::VARCHAR AS c1 FROM delivery GROUP BY raw_network
UNION ALL SELECT 'Agence rapport', 'Réseaux', 'Réseau', 'Total;' || chr(10) || 'délivré'""",
    "provider_sheets": """
SELECT brand || ' ' || mvpd || ' report' AS file, sheet, position FROM (SELECT DISTINCT brand, mvpd FROM delivery) d
JOIN (VALUES ('Comcast','Network',1), ('Comcast','DMA',2), ('Comcast','Week',3), ('Comcast','Week Hour',4), ('Comcast','Day of Week',5), ('Comcast','Summary',6),
  ('Comcast','Network by Week',7),
  ('Spectrum','Networks',1), ('Spectrum','Geography',2), ('Spectrum','Daily Delivery',3), ('Spectrum','Daypart',4), ('Spectrum','Day of Week',5),
  ('Cox','VOD Network',1), ('Cox','Geo',2), ('Cox','Daily',3), ('Cox','Hourly',4), ('Cox','Reach-Frequency',5),
  ('Verizon','Network',1), ('Verizon','Market',2), ('Verizon','Date',3), ('Verizon','Hourly',4), ('Verizon','DOW',5), ('Verizon','Order Summary',6)) AS s(provider, sheet, position) ON mvpd = provider""",
    "spans": "SELECT brand, mvpd, min(event_date) AS first, max(event_date) AS last FROM delivery GROUP BY ALL",
    # Shared weeks: the providers report from their own first day on, one of them whole calendar weeks.
    "week_first": """
SELECT brand, CASE WHEN a IS NULL THEN f ELSE a - CAST(7 * ceil(greatest(a - f, 0) / 7) AS INTEGER) END AS first, last FROM (
  SELECT brand, min(first) AS f, min(CASE WHEN mvpd = 'Comcast' THEN first END) AS a, max(last) AS last FROM (
    SELECT brand, mvpd, first, last FROM spans WHERE mvpd <> 'Comcast'
    UNION ALL SELECT brand, mvpd, CAST(date_trunc('week', first) AS DATE), CAST(date_trunc('week', last) AS DATE) + 6 FROM spans WHERE mvpd = 'Comcast') GROUP BY brand)""",
    "flights": """
SELECT CASE WHEN k % 2 = 0 THEN 'BrandA' ELSE 'BrandB' END AS brand, 'flight ' || k AS flight,
  CASE WHEN k = 11 THEN DATE '2021-05-01' ELSE first END AS first_date,
  CASE WHEN k = 11 THEN DATE '2024-01-12' WHEN k <> 6 THEN first + CAST((k * k) % 5 - 1 AS INTEGER) END AS last_date
FROM (SELECT n_nationkey AS k, DATE '2024-01-03' + CAST((n_nationkey * 7) % 23 AS INTEGER) AS first FROM nation)""",
    "provider_fact": """
SELECT feature_value, brand, coalesce(sum(imp), 0)::DECIMAL(28,2) AS imp, mvpd, data_type FROM (
  SELECT network AS feature_value, brand, imp, mvpd, 'Network' AS data_type FROM mapped
  UNION ALL SELECT market, brand, imp, mvpd, 'Market' FROM mapped
  UNION ALL SELECT day, brand, imp, mvpd, 'Day' FROM mapped
  UNION ALL SELECT daypart, brand, imp, mvpd, 'Daypart' FROM mapped
  UNION ALL SELECT 'Total', brand, imp, mvpd, 'Summary' FROM mapped
  UNION ALL SELECT CAST(CASE WHEN mvpd = 'Comcast' THEN CAST(date_trunc('week', event_date) AS DATE)
      ELSE first + CAST(7 * floor((event_date - first) / 7) AS INTEGER) END AS VARCHAR), brand, imp, mvpd, 'Week' FROM mapped JOIN week_first USING (brand)
) GROUP BY feature_value, brand, mvpd, data_type""",
    "households": "SELECT brand, mvpd, sum(imp) AS n, count(DISTINCT user_id) AS hh FROM delivery GROUP BY ALL",
    # One provider reports households and a rounded frequency instead of impressions; another has a second reach file
    # with one row per brand, and campaign rows in its dimension-tagged report; two files of each brand that name no provider count as its own.
    "reach": """
SELECT brand, mvpd, sum(imp) AS imp, sum(hh) AS hh FROM (
  SELECT brand, mvpd, CASE WHEN mvpd = 'Cox' THEN CAST(round_even(n::DOUBLE / hh, 2) * hh AS DECIMAL(18,2)) ELSE n END AS imp, hh FROM households
  UNION ALL SELECT brand, mvpd, 5000, 1000 FROM households WHERE mvpd = 'Comcast'
  UNION ALL SELECT DISTINCT brand, 'Comcast', 2190, 730 FROM households
  UNION ALL SELECT 'BrandA', 'Comcast', sum(n), sum(hh) FROM (SELECT sum(imp) AS n, count(DISTINCT user_id) AS hh FROM delivery GROUP BY brand))
GROUP BY brand, mvpd""",
    "frequency_lines": """
SELECT brand || ' Cox report' AS file, 'Display By' AS c0, 'Households' AS c6, 'Note' AS c9 FROM households WHERE mvpd = 'Cox'
UNION ALL SELECT brand || ' Cox report', 'Campaign', hh::VARCHAR, 'end' FROM households WHERE mvpd = 'Cox'""",
    "reach_rows": """
SELECT brand, mvpd, imp::DOUBLE AS imp, hh::DOUBLE AS hh FROM reach
UNION ALL SELECT brand, 'Total', sum(imp)::DOUBLE, sum(hh)::DOUBLE FROM reach GROUP BY brand""",
    "reach_metrics": """
SELECT brand, mvpd, 'Impressions' AS metric_type, imp AS metric FROM reach_rows
UNION ALL SELECT brand, mvpd, 'Reach', hh FROM reach_rows
UNION ALL SELECT brand, mvpd, 'Frequency', round_even(imp / hh, 2) FROM reach_rows""",
    # A fifth source, in one dimension-tagged report.
    "tagged_fact": """
SELECT feature_value, 'BrandA' AS brand, coalesce(sum(imp), 0)::DECIMAL(28,2) AS imp, 'Agency' AS mvpd, data_type FROM (
  SELECT network AS feature_value, imp, 'Network' AS data_type FROM mapped UNION ALL SELECT market, imp, 'Market' FROM mapped
  UNION ALL SELECT day, imp, 'Day' FROM mapped UNION ALL SELECT daypart, imp, 'Daypart' FROM mapped
  UNION ALL SELECT strftime(date_trunc('week', event_date), '%Y-%m-%d'), imp, 'Week' FROM mapped
  UNION ALL SELECT 'Total', imp, 'Summary' FROM mapped) GROUP BY feature_value, data_type""",
    "merged_sources": "SELECT * FROM provider_fact UNION ALL SELECT * FROM tagged_fact",
    "fact_totals": """
SELECT feature_value, brand, imp, mvpd, data_type FROM merged_sources
UNION ALL SELECT feature_value, brand, sum(imp), 'Total', data_type FROM merged_sources GROUP BY feature_value, brand, data_type""",
    "fact": """
SELECT feature_value, brand, imp::DOUBLE AS metric, mvpd, data_type, 'Impressions' AS metric_type FROM fact_totals
UNION ALL SELECT 'Total', brand, sum(imp)::DOUBLE, mvpd, data_type, 'Impressions' FROM fact_totals WHERE data_type <> 'Summary' GROUP BY brand, mvpd, data_type
UNION ALL SELECT 'Total', brand, metric, mvpd, 'Reach and Frequency', metric_type FROM reach_metrics""",
}


def with_views(sql: str) -> str:
    """Put the views a statement uses, directly or through others, in front of it."""
    needed: set[str] = set()
    todo = [sql]
    while todo:
        text = todo.pop()
        for name, body in _VIEWS.items():
            if name not in needed and re.search(rf"\b{name}\b", text):
                needed.add(name)
                todo.append(body)
    if not needed:
        return sql
    views = ",\n".join(f"{n} AS ({_VIEWS[n].strip()})" for n in _VIEWS if n in needed)
    return f"WITH {views}\n{sql.strip()}"
