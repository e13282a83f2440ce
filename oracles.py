"""DuckDB statements that state each registered query a second time, for the value check.

They are written from the relation rules, not from the Spark plans: pairs are listed instead of counted
algebraically, ranks use RANK(), bridges use DISTINCT, and so on.
"""

from __future__ import annotations

import re

# ------------------------------------------------------------------ building blocks
# Each block is one CTE; `statement` puts the needed ones, in this order, in front of a query.

BLOCKS: dict[str, str] = {}

BLOCKS["brand"] = "SELECT DISTINCT CAST(substr(p_brand, 7) AS INT) AS id, p_brand AS name FROM part"
BLOCKS["cpu_model"] = """
SELECT CAST(concat('0x', substr(md5(name), 1, 7)) AS INT) AS id, name
FROM (SELECT DISTINCT p_type AS name FROM part)"""
BLOCKS["gpu_model"] = """
SELECT CAST(concat('0x', substr(md5(name), 1, 7)) AS INT) AS id, name
FROM (SELECT DISTINCT split_part(p_name, ' ', 1) AS name FROM part)"""
BLOCKS["laptop_model"] = """
SELECT CAST(p.p_partkey + 1 AS INT) AS id, concat(' ', replace(p.p_name, ' ', '  '), ' ') AS name,
  CAST(substr(p.p_brand, 7) AS INT) AS brand_id,
  CASE WHEN p.p_partkey % 17 = 0 THEN NULL ELSE c.id END AS cpu_model_id,
  CASE WHEN p.p_partkey % 19 = 0 THEN NULL ELSE g.id END AS gpu_model_id,
  CAST(p.p_size AS DECIMAL(18,4)) AS screen_size,
  CASE WHEN p.p_partkey % 13 = 0 THEN NULL ELSE CAST(p.p_size % 4 + 1 AS DECIMAL(18,4)) END AS laptop_weight,
  CASE WHEN p.p_partkey % 11 = 0 THEN NULL ELSE CAST(p.p_partkey % 90 AS DECIMAL(18,4)) END AS battery_capacity_whr,
  p.p_partkey % 10 <> 0 AS is_visible, p.p_partkey % 7 <> 0 AS is_active
FROM part p JOIN cpu_model c ON c.name = p.p_type JOIN gpu_model g ON g.name = split_part(p.p_name, ' ', 1)"""
BLOCKS["laptop_benchmark_result"] = """
SELECT o_orderkey AS id, CASE WHEN o_orderkey % 41 = 0 THEN NULL ELSE CAST(o_custkey + 1 AS INT) END AS laptop_model_id,
  CAST(floor(o_totalprice / 1000) AS DECIMAL(18,4)) AS office_battery_result_minutes,
  CAST(floor(o_totalprice / 3000) AS DECIMAL(18,4)) AS gaming_battery_result_minutes,
  CAST(500 + o_orderkey % 2500 AS INT) AS geekbench_6_cpu_single_core_plugged_in,
  CASE WHEN o_orderpriority = '4-NOT SPECIFIED' THEN NULL ELSE CAST(floor(o_totalprice / 30) AS INT) END
    AS geekbench_6_cpu_multi_core_plugged_in,
  CASE WHEN o_orderstatus = 'P' THEN NULL ELSE CAST(floor(o_totalprice / 40) AS INT) END
    AS geekbench_6_cpu_multi_core_battery
FROM orders"""
BLOCKS["user_event_tracking"] = """
SELECT event_id AS id,
  CASE WHEN event_id % 50 = 0 THEN NULL ELSE concat('s', CAST(user_id AS VARCHAR)) END AS session_id,
  CASE WHEN event_id % 333 = 0 THEN NULL WHEN event_type = 'view' THEN 'pageview' WHEN event_type = 'click' THEN 'click'
       WHEN event_type = 'purchase' THEN 'select_device_for_comparison' WHEN event_type = 'signup' THEN 'search_for_device'
       ELSE 'comparison_chart_sort_selection' END AS event_name,
  CAST(epoch_us(ts) AS DOUBLE) / 1e6 - 10 AS event_local_timestamp,
  CAST(epoch_us(ts) AS DOUBLE) / 1e6 AS event_received_on_server_timestamp,
  concat('{', CASE WHEN k % 6 = 0 THEN '"page_name":"Home",' WHEN k % 6 IN (1, 2) THEN '"page_name":"DeviceDetail",'
                   WHEN k % 6 = 3 THEN '"page_name":"DeviceComparison",' WHEN k % 6 = 4 THEN '"page_name":"CompareDevice",'
                   ELSE '' END,
    CASE WHEN event_type = 'error'
         THEN concat('"device_ids":["', event_id % 150 + 1, '","', event_id % 149 + 1, '","', event_id % 150 + 1,
                     '"],"sort_by":"', CASE WHEN k % 3 = 0 THEN ' ' ELSE 'performance' END, '","sort_direction":"desc",')
         ELSE '' END,
    CASE WHEN event_type = 'signup'
         THEN concat('"keyword":"', CASE WHEN k % 20 = 7 THEN ' ' ELSE concat(' Key ', k % 20, ' ') END, '",') ELSE '' END,
    '"device_id":"', CASE WHEN k % 10 = 9 THEN '99999999999' ELSE CAST(event_id % 150 + 1 AS VARCHAR) END, '"}')
    AS event_data,
  CASE WHEN user_id % 13 = 5 THEN '{}'
       ELSE concat('{', CASE WHEN user_id % 4 = 0 THEN '"os":"Windows",' WHEN user_id % 4 = 1 THEN '"os_name":"macOS",'
                             WHEN k % 4 = 2 THEN '"os_name":" ",' WHEN k % 4 = 3 THEN '"os":"Linux",' ELSE '' END,
                   '"device_type":"', CASE WHEN k % 2 = 0 THEN 'Desktop' ELSE 'Mobile' END, '"}') END AS device
FROM (SELECT *, CAST(json_extract_string(props, '$.k') AS INT) AS k FROM events)"""

# Versioning inputs: every event, stale copies of the clicks, exact copies of the errors; the store holds
# the events of the first half of the period, some in an older and some in a newer version.
BLOCKS["versions_batch"] = """
SELECT * FROM user_event_tracking
UNION ALL
SELECT id, session_id, event_name, event_local_timestamp, event_received_on_server_timestamp - 3600, '{}', device
FROM user_event_tracking WHERE event_name = 'click'
UNION ALL
SELECT * FROM user_event_tracking WHERE event_name = 'comparison_chart_sort_selection'"""
BLOCKS["versions_target"] = """
SELECT id, session_id, event_name, event_local_timestamp,
  event_received_on_server_timestamp
    + CASE WHEN event_name = 'pageview' THEN -3600 WHEN event_name = 'search_for_device' THEN 3600 ELSE 0 END
    AS event_received_on_server_timestamp,
  event_data, device
FROM user_event_tracking WHERE event_received_on_server_timestamp < epoch(TIMESTAMP '2024-01-16 00:00:00')"""
BLOCKS["versions_latest"] = """
SELECT DISTINCT b.* FROM versions_batch b
JOIN (SELECT id, max(event_received_on_server_timestamp) AS newest FROM versions_batch GROUP BY id) n
  ON b.id = n.id AND b.event_received_on_server_timestamp = n.newest"""

BLOCKS["s_brand"] = r"""
SELECT id AS brand_id, trim(regexp_replace(name, '\s+', ' ', 'g')) AS brand_name FROM brand WHERE id IS NOT NULL"""
BLOCKS["s_cpu"] = r"""
SELECT id AS cpu_id, trim(regexp_replace(name, '\s+', ' ', 'g')) AS cpu_name FROM cpu_model WHERE id IS NOT NULL"""
BLOCKS["s_gpu"] = "SELECT id AS gpu_id, trim(name) AS gpu_name FROM gpu_model WHERE id IS NOT NULL"
BLOCKS["s_laptop"] = r"""
SELECT l.id AS laptop_model_id, trim(regexp_replace(l.name, '\s+', ' ', 'g')) AS laptop_name,
  l.brand_id, b.brand_name, l.cpu_model_id AS cpu_id, c.cpu_name, l.gpu_model_id AS gpu_id, g.gpu_name,
  l.screen_size, l.laptop_weight AS laptop_weight_kg, l.battery_capacity_whr, l.is_visible, l.is_active
FROM laptop_model l LEFT JOIN s_brand b ON b.brand_id = l.brand_id
LEFT JOIN s_cpu c ON c.cpu_id = l.cpu_model_id LEFT JOIN s_gpu g ON g.gpu_id = l.gpu_model_id"""
BLOCKS["s_bench"] = """
SELECT CAST(r.id AS INT) AS benchmark_id, r.laptop_model_id,
  r.office_battery_result_minutes AS office_battery_minutes, r.gaming_battery_result_minutes AS gaming_battery_minutes,
  r.geekbench_6_cpu_single_core_plugged_in AS geekbench6_single,
  r.geekbench_6_cpu_multi_core_plugged_in AS geekbench6_multi,
  r.geekbench_6_cpu_multi_core_battery AS geekbench6_multi_battery,
  {div(r.office_battery_result_minutes, 60, 1)} AS office_battery_hours,
  {div(r.gaming_battery_result_minutes, 60, 1)} AS gaming_battery_hours
FROM laptop_benchmark_result r
WHERE r.id = (SELECT max(o.id) FROM laptop_benchmark_result o WHERE o.laptop_model_id = r.laptop_model_id)"""

_PARSED = r"""
SELECT id, event_name, session_id,
  make_timestamp(CAST(round_even((event_local_timestamp - 946684800) * 1000000, 0) AS BIGINT) + 946684800000000) AS event_timestamp,
  make_timestamp(CAST(round_even((event_received_on_server_timestamp - 946684800) * 1000000, 0) AS BIGINT) + 946684800000000) AS server_timestamp,
  CASE WHEN regexp_full_match(json_extract_string(event_data, '$.device_id'), '[0-9]{1,10}')
        AND TRY_CAST(json_extract_string(event_data, '$.device_id') AS BIGINT) BETWEEN 1 AND 2147483647
       THEN json_extract_string(event_data, '$.device_id') END AS device_id,
  CASE WHEN event_name IN ('comparison_chart_sort_selection', 'comparison_chart_geekbench_version_selection')
         OR json_extract_string(event_data, '$.page_name') IN ('DeviceComparisonHome', 'DeviceComparison')
       THEN 'CompareDevice' ELSE json_extract_string(event_data, '$.page_name') END AS page_name,
  json_extract_string(event_data, '$.page_name') AS source_page_name,
  json_extract_string(event_data, '$.keyword') AS search_keyword,
  json_extract_string(event_data, '$.sort_by') AS sort_by,
  json_extract_string(event_data, '$.sort_direction') AS sort_direction,
  json_extract_string(event_data, '$.device_ids') AS device_ids_raw,
  coalesce(json_extract_string(device, '$.os'), json_extract_string(device, '$.os_name')) AS user_os,
  json_extract_string(device, '$.os_version') AS user_os_version,
  json_extract_string(device, '$.browser') AS user_browser,
  json_extract_string(device, '$.device_type') AS user_device_type, event_data, device
FROM {source} WHERE event_name IS NOT NULL AND session_id IS NOT NULL
QUALIFY row_number() OVER (PARTITION BY id ORDER BY event_received_on_server_timestamp DESC) = 1"""
BLOCKS["ev"] = (
    f"SELECT *, CAST(server_timestamp + INTERVAL 7 HOUR AS DATE) AS event_date FROM ({_PARSED})".replace(
        "{source}", "user_event_tracking"
    )
)
BLOCKS["s_day"] = """
SELECT event_date, session_id, count(*) AS event_count, max(server_timestamp) AS latest_event_at,
  count(*) FILTER (event_name = 'pageview') AS pageview_count,
  count(*) FILTER (event_name = 'pageview' AND page_name = 'DeviceDetail') AS detail_pageview_count,
  count(*) FILTER (event_name = 'pageview' AND page_name = 'CompareDevice') AS comparison_pageview_count,
  bool_or(event_name = 'pageview') AS has_pageview,
  bool_or(event_name = 'pageview' AND page_name = 'DeviceDetail') AS has_detail,
  bool_or(event_name = 'select_device_for_comparison' OR event_name = 'add_to_comparison'
          OR (event_name = 'click' AND page_name = 'DeviceDetail')) AS has_select_compare,
  bool_or(event_name = 'pageview' AND page_name = 'CompareDevice') AS has_comparison,
  bool_or((event_name = 'comparison_chart_sort_selection' OR (event_name = 'click' AND page_name = 'CompareDevice'))
          AND coalesce(trim(sort_by), '') <> '') AS has_sort
FROM ev GROUP BY ALL"""
BLOCKS["s_activity"] = """
SELECT session_id, min(server_timestamp) AS session_start, min(event_date) AS session_start_date,
  max(server_timestamp) AS session_end, count(*) AS event_count, count(DISTINCT event_name) AS distinct_event_types,
  count(*) FILTER (event_name = 'pageview') > 0 AS has_pageview,
  count(*) FILTER (event_name = 'pageview' AND page_name = 'DeviceDetail') > 0 AS has_product_detail_view,
  count(*) FILTER ((event_name = 'pageview' AND page_name = 'CompareDevice') OR event_name IN
    ('select_device_for_comparison', 'add_to_comparison', 'comparison_chart_sort_selection')) > 0 AS has_comparison,
  coalesce(arg_min(trim(user_os), (server_timestamp, id)) FILTER (trim(user_os) <> ''), 'Unknown') AS user_os,
  coalesce(arg_min(trim(user_device_type), (server_timestamp, id)) FILTER (trim(user_device_type) <> ''), 'Unknown')
    AS user_device_type
FROM ev GROUP BY session_id"""
BLOCKS["s_bridge"] = r"""
SELECT DISTINCT event_id, session_id, event_date, server_timestamp, TRY_CAST(candidate AS INT) AS laptop_model_id
FROM (
  SELECT id AS event_id, session_id, event_date, server_timestamp, page_name, event_name, device_id AS candidate FROM ev
  UNION ALL
  SELECT id, session_id, event_date, server_timestamp, page_name, event_name,
    unnest(CAST(json_extract_string(device_ids_raw, '$[*]') AS VARCHAR[]))
  FROM ev WHERE json_type(device_ids_raw) = 'ARRAY'
)
WHERE (event_name IN ('select_device_for_comparison', 'add_to_comparison', 'comparison_chart_sort_selection',
                      'comparison_chart_geekbench_version_selection')
       OR (event_name = 'pageview' AND page_name = 'CompareDevice'))
  AND regexp_full_match(candidate, '[0-9]{1,10}') AND TRY_CAST(candidate AS INT) >= 1"""
BLOCKS["s_day_laptop"] = """
SELECT session_id, laptop_model_id, event_date, min(server_timestamp) AS first_seen_at, count(*) AS interaction_count
FROM s_bridge GROUP BY ALL"""

BLOCKS["g_daily"] = """
SELECT event_date, count(*) AS total_sessions, CAST(sum(event_count) AS BIGINT) AS total_events,
  CAST(sum(pageview_count) AS BIGINT) AS total_pageviews, CAST(sum(detail_pageview_count) AS BIGINT) AS detail_pageviews,
  CAST(sum(comparison_pageview_count) AS BIGINT) AS comparison_pageviews, max(latest_event_at) AS latest_event_at,
  count(*) FILTER (has_pageview) AS sessions_with_pageview, count(*) FILTER (has_detail) AS sessions_with_detail_view,
  count(*) FILTER (has_comparison) AS sessions_with_comparison, count(*) FILTER (has_sort) AS sessions_with_sort,
  count(*) FILTER (has_pageview AND has_detail) AS pageview_and_detail,
  count(*) FILTER (has_detail AND has_comparison) AS detail_and_comparison,
  {pct(count(*) FILTER (has_pageview AND has_detail), count(*) FILTER (has_pageview), 2)} AS detail_rate_pct,
  {pct(count(*) FILTER (has_detail AND has_comparison), count(*) FILTER (has_detail), 2)} AS comparison_rate_pct
FROM s_day GROUP BY event_date"""
BLOCKS["g_funnel"] = """
SELECT event_date, count(*) AS total_sessions, CAST(sum(CAST(has_pageview AS INT)) AS BIGINT) AS step_1_pageview,
  CAST(sum(CAST(has_detail AS INT)) AS BIGINT) AS step_2_product_detail,
  CAST(sum(CAST(has_select_compare AS INT)) AS BIGINT) AS step_3_select_compare,
  CAST(sum(CAST(has_comparison AS INT)) AS BIGINT) AS step_4_comparison_page,
  CAST(sum(CAST(has_sort AS INT)) AS BIGINT) AS step_5_sort_action
FROM s_day GROUP BY event_date"""
BLOCKS["views"] = """
SELECT e.id, e.session_id, date_trunc('month', e.event_date)::DATE AS month, l.*
FROM ev e JOIN s_laptop l ON l.laptop_model_id = CAST(e.device_id AS INT)
WHERE e.event_name = 'pageview' AND e.page_name = 'DeviceDetail'"""
BLOCKS["g_brand"] = """
SELECT b.brand_id, b.brand_name, p.total_products, p.active_products,
  coalesce(v.view_sessions, 0) AS view_sessions, coalesce(v.total_views, 0) AS total_views,
  coalesce(c.comparison_sessions, 0) AS comparison_sessions, coalesce(c.total_comparisons, 0) AS total_comparisons,
  coalesce(x.both_sessions, 0) AS detail_and_comparison_sessions,
  {div(coalesce(v.total_views, 0), (SELECT max(n) FROM (SELECT count(*) AS n FROM views GROUP BY brand_id)), 3)}
    AS view_interest_score,
  {pct(coalesce(x.both_sessions, 0), coalesce(v.view_sessions, 0), 2)} AS comparison_rate_pct,
  {div(coalesce(v.total_views, 0), p.active_products, 0)} AS views_per_product
FROM s_brand b
JOIN (SELECT brand_id, count(*) AS total_products, count(*) FILTER (is_active) AS active_products
      FROM s_laptop GROUP BY brand_id) p ON p.brand_id = b.brand_id
LEFT JOIN (SELECT brand_id, count(*) AS total_views, count(DISTINCT session_id) AS view_sessions
           FROM views GROUP BY brand_id) v ON v.brand_id = b.brand_id
LEFT JOIN (SELECT brand_id, count(DISTINCT session_id) AS comparison_sessions,
             count(DISTINCT event_id) AS total_comparisons
           FROM s_bridge JOIN s_laptop USING (laptop_model_id) GROUP BY brand_id) c ON c.brand_id = b.brand_id
LEFT JOIN (SELECT brand_id, count(*) AS both_sessions
           FROM (SELECT DISTINCT brand_id, session_id FROM views
                 INTERSECT SELECT DISTINCT brand_id, session_id FROM s_bridge JOIN s_laptop USING (laptop_model_id))
           GROUP BY brand_id) x ON x.brand_id = b.brand_id"""
BLOCKS["g_pairs"] = """
SELECT brand_a_id, brand_b_id, a.brand_name AS brand_a, b.brand_name AS brand_b,
  count(DISTINCT session_id) AS comparison_sessions, count(DISTINCT concat(session_id, '|', event_date)) AS comparison_session_days,
  count(*) AS comparison_count, if(brand_a_id = brand_b_id, 'Same Brand', 'Cross Brand') AS comparison_type
FROM (
  SELECT x.session_id, x.event_date, least(lx.brand_id, ly.brand_id) AS brand_a_id,
    greatest(lx.brand_id, ly.brand_id) AS brand_b_id
  FROM s_day_laptop x
  JOIN s_day_laptop y ON y.session_id = x.session_id AND y.event_date = x.event_date
    AND y.laptop_model_id > x.laptop_model_id
  JOIN s_laptop lx ON lx.laptop_model_id = x.laptop_model_id
  JOIN s_laptop ly ON ly.laptop_model_id = y.laptop_model_id
) JOIN s_brand a ON a.brand_id = brand_a_id JOIN s_brand b ON b.brand_id = brand_b_id
GROUP BY ALL"""
BLOCKS["g_cpu"] = """
SELECT month, cpu_name, brand_name, count(*) AS total_views, count(DISTINCT session_id) AS unique_sessions,
  count(DISTINCT laptop_model_id) AS products_viewed
FROM views WHERE cpu_name <> '' GROUP BY month, cpu_name, brand_name"""
BLOCKS["g_gpu"] = """
SELECT month, gpu_name, brand_name, count(*) AS total_views, count(DISTINCT session_id) AS unique_sessions,
  count(DISTINCT laptop_model_id) AS products_viewed
FROM views WHERE gpu_name <> '' GROUP BY month, gpu_name, brand_name"""
BLOCKS["g_spec"] = """
SELECT cpu_name, gpu_name, CAST(screen_size AS DOUBLE) AS screen_size,
  CAST(battery_capacity_whr AS DOUBLE) AS battery_capacity_whr, count(DISTINCT laptop_model_id) AS product_count,
  count(*) AS total_views, {div(count(*), count(DISTINCT laptop_model_id), 0)} AS avg_views_per_product
FROM views WHERE cpu_name <> '' GROUP BY cpu_name, gpu_name, views.screen_size, views.battery_capacity_whr"""

_TIER = """CASE WHEN m.geekbench6_multi IS NULL THEN 'No Benchmark' WHEN m.geekbench6_multi < 4000 THEN 'Budget'
       WHEN m.geekbench6_multi < 8000 THEN 'Entry Level' WHEN m.geekbench6_multi < 12000 THEN 'Mid-Range'
       ELSE 'High Performance' END AS performance_tier"""
BLOCKS["g_rank"] = f"""
SELECT l.laptop_model_id, l.laptop_name, l.brand_name, l.cpu_name, l.gpu_name,
  CAST(l.screen_size AS DOUBLE) AS screen_size, CAST(l.battery_capacity_whr AS DOUBLE) AS battery_capacity_whr,
  CAST(l.laptop_weight_kg AS DOUBLE) AS laptop_weight_kg,
  CAST(m.office_battery_minutes AS DOUBLE) AS office_battery_minutes, m.office_battery_hours,
  CAST(m.gaming_battery_minutes AS DOUBLE) AS gaming_battery_minutes, m.gaming_battery_hours,
  m.geekbench6_single, m.geekbench6_multi,
  rank() OVER (PARTITION BY l.brand_name ORDER BY m.geekbench6_multi DESC NULLS LAST) AS geekbench_rank_in_brand,
  rank() OVER (PARTITION BY l.brand_name ORDER BY m.office_battery_minutes DESC NULLS LAST) AS battery_rank_in_brand,
  rank() OVER (ORDER BY m.geekbench6_multi DESC NULLS LAST) AS geekbench_rank_overall,
  rank() OVER (ORDER BY m.office_battery_minutes DESC NULLS LAST) AS battery_rank_overall,
  {_TIER}
FROM s_laptop l LEFT JOIN s_bench m ON m.laptop_model_id = l.laptop_model_id WHERE l.is_active"""
BLOCKS["g_eff"] = """
SELECT l.laptop_model_id, l.laptop_name, l.brand_name, CAST(l.laptop_weight_kg AS DOUBLE) AS laptop_weight_kg,
  CAST(l.battery_capacity_whr AS DOUBLE) AS battery_capacity_whr, m.office_battery_hours,
  CAST(m.office_battery_minutes AS DOUBLE) AS office_battery_minutes, m.geekbench6_multi, m.geekbench6_multi_battery,
  {div(m.geekbench6_multi, l.battery_capacity_whr, 2)} AS performance_per_wh,
  {div(m.geekbench6_multi, l.laptop_weight_kg, 2)} AS performance_per_kg,
  {div(m.office_battery_minutes, l.battery_capacity_whr, 2)} AS battery_efficiency_mins_per_wh,
  CASE WHEN m.geekbench6_multi > 0 AND m.geekbench6_multi_battery IS NOT NULL
       THEN CAST(CAST(100 AS DECIMAL(9,2)) - CAST(100 * {div(m.geekbench6_multi_battery, m.geekbench6_multi, 4)}
            AS DECIMAL(18,2)) AS DOUBLE) END AS performance_drop_pct
FROM s_laptop l JOIN s_bench m USING (laptop_model_id)
WHERE l.is_active AND l.is_visible AND m.geekbench6_multi IS NOT NULL"""
BLOCKS["g_battery"] = f"""
SELECT l.laptop_model_id, l.laptop_name, l.brand_name, l.cpu_name, l.gpu_name, m.office_battery_hours,
  m.gaming_battery_hours, m.geekbench6_single, m.geekbench6_multi,
  coalesce(v.n, 0) AS total_views, coalesce(v.sessions, 0) AS view_sessions, coalesce(c.n, 0) AS comparison_events,
  CASE WHEN m.office_battery_hours IS NULL THEN 'No Data' WHEN m.office_battery_hours < 4 THEN '<4h (Poor)'
       WHEN m.office_battery_hours < 6 THEN '4-6h (Average)' WHEN m.office_battery_hours < 8 THEN '6-8h (Good)'
       ELSE '8h+ (Excellent)' END AS battery_tier,
  {_TIER}
FROM s_laptop l LEFT JOIN s_bench m ON m.laptop_model_id = l.laptop_model_id
LEFT JOIN (SELECT laptop_model_id, count(*) AS n, count(DISTINCT session_id) AS sessions FROM views
           GROUP BY laptop_model_id) v ON v.laptop_model_id = l.laptop_model_id
LEFT JOIN (SELECT laptop_model_id, count(DISTINCT event_id) AS n FROM s_bridge GROUP BY laptop_model_id) c
  ON c.laptop_model_id = l.laptop_model_id
WHERE l.is_active"""
BLOCKS["g_search"] = """
SELECT lower(trim(search_keyword)) AS search_keyword, count(*) AS search_volume,
  count(DISTINCT session_id) AS unique_sessions
FROM ev WHERE event_name = 'search_for_device' AND trim(search_keyword) <> '' GROUP BY lower(trim(search_keyword))"""
BLOCKS["g_os"] = """
SELECT user_os, user_device_type AS device_type, count(*) AS sessions,
  {pct(count(*), (SELECT count(*) FROM s_activity), 1)} AS session_pct
FROM s_activity GROUP BY user_os, user_device_type"""


# ------------------------------------------------------------------ assembling


def _arguments(text: str) -> list[str]:
    parts, depth, current = [], 0, ""
    for char in text:
        depth += char in "([" 
        depth -= char in ")]"
        if char == "," and depth == 0:
            parts.append(current.strip())
            current = ""
        else:
            current += char
    return [*parts, current.strip()]


def _half_up(numerator: str, denominator: str, places: int) -> str:
    # Exact rounding, half away from zero, of a non-negative quotient: whole-number division throughout.
    scale = 10**places
    top, bottom = f"CAST({numerator} AS DECIMAL(18,4))", f"CAST({denominator} AS DECIMAL(18,4))"
    whole = lambda value: f"CAST(({value}) * 10000 AS HUGEINT)"
    return (
        f"(CASE WHEN ({denominator}) <> 0 THEN CAST(({2 * scale} * {whole(top)} + {whole(bottom)}) "
        f"// (2 * {whole(bottom)}) AS DOUBLE) / {scale} END)"
    )


def _expand(text: str) -> str:
    """Writes out {div(a, b, places)} and {pct(a, b, places)}."""
    while match := re.search(r"\{(div|pct)\(", text):
        depth, end = 1, match.end()
        while depth:
            depth += {"(": 1, ")": -1}.get(text[end], 0)
            end += 1
        numerator, denominator, places = _arguments(text[match.end() : end - 1])
        if match[1] == "pct":
            numerator = f"100 * ({numerator})"
        text = text[: match.start()] + _half_up(numerator, denominator, int(places)) + text[end + 1 :]
    return text


def statement(query: str, **extra: str) -> str:
    """The query with every block it names, directly or through other blocks, put in front."""
    blocks = {**BLOCKS, **extra}
    needed: set[str] = set()
    todo = [query]
    while todo:
        text = todo.pop()
        for name in blocks:
            if name not in needed and re.search(rf"\b(?:FROM|JOIN)\s+{name}\b", text):
                needed.add(name)
                todo.append(blocks[name])
    parts = [f"{name} AS ({blocks[name].strip()})" for name in blocks if name in needed]
    text = ("WITH " + ",\n".join(parts) + "\n" if parts else "") + query.strip()
    return _expand(text)


_SILVER = {
    "silver_brand": "SELECT * FROM s_brand",
    "silver_cpu_model": "SELECT * FROM s_cpu",
    "silver_gpu_model": "SELECT * FROM s_gpu",
    "silver_laptop_model": """
SELECT * REPLACE (CAST(screen_size AS DOUBLE) AS screen_size, CAST(laptop_weight_kg AS DOUBLE) AS laptop_weight_kg,
  CAST(battery_capacity_whr AS DOUBLE) AS battery_capacity_whr) FROM s_laptop""",
    "silver_laptop_benchmark_result": """
SELECT * REPLACE (CAST(office_battery_minutes AS DOUBLE) AS office_battery_minutes,
  CAST(gaming_battery_minutes AS DOUBLE) AS gaming_battery_minutes) FROM s_bench""",
    "silver_user_event_tracking": "SELECT * EXCLUDE (event_date) FROM ev",
    "silver_session_day": "SELECT * FROM s_day",
    "silver_session_funnel": """
SELECT session_id, event_date, has_pageview AS reached_pageview, has_detail AS reached_product_detail,
  has_select_compare AS reached_select_for_comparison, has_comparison AS reached_comparison_page,
  has_sort AS reached_sort_in_comparison FROM s_day""",
    "silver_session_activity": "SELECT * FROM s_activity",
    "silver_comparison_event_device": "SELECT * FROM s_bridge",
    "silver_comparison_session_device": "SELECT * FROM s_day_laptop",
    "silver_comparison_sort_event": """
SELECT session_id, sort_by, sort_direction, server_timestamp, event_date FROM ev
WHERE page_name = 'CompareDevice' AND sort_by IS NOT NULL AND length(sort_by) > 0""",
    "silver_device_traffic_event": """
SELECT session_id, event_date, ifnull(user_os, 'Unknown') AS user_os, ifnull(user_device_type, 'Unknown') AS device_type,
  ifnull(user_browser, 'Unknown') AS browser, CAST(device_id AS INT) AS laptop_model_id
FROM ev WHERE event_name = 'pageview'""",
}
_GOLD = {
    "gold_daily_site_kpis": "SELECT * FROM g_daily",
    "gold_behavior_funnel_daily": "SELECT * FROM g_funnel",
    "gold_brand_interest": "SELECT * FROM g_brand",
    "gold_brand_comparison": "SELECT * FROM g_pairs",
    "gold_cpu_trend": "SELECT * FROM g_cpu",
    "gold_gpu_trend": "SELECT * FROM g_gpu",
    "gold_spec_popularity": "SELECT * FROM g_spec",
    "gold_performance_ranking": "SELECT * FROM g_rank",
    "gold_performance_efficiency": "SELECT * FROM g_eff",
    "gold_battery_vs_interest": "SELECT * FROM g_battery",
    "gold_search_analytics": "SELECT * FROM g_search",
    "gold_user_os": "SELECT * FROM g_os",
}
_BRONZE = {
    "bronze_brand": "SELECT * FROM brand",
    "bronze_cpu_model": "SELECT * FROM cpu_model",
    "bronze_gpu_model": "SELECT * FROM gpu_model",
    "bronze_laptop_model": """
SELECT * REPLACE (CAST(screen_size AS DOUBLE) AS screen_size, CAST(laptop_weight AS DOUBLE) AS laptop_weight,
  CAST(battery_capacity_whr AS DOUBLE) AS battery_capacity_whr) FROM laptop_model""",
    "bronze_laptop_benchmark_result": """
SELECT * REPLACE (CAST(office_battery_result_minutes AS DOUBLE) AS office_battery_result_minutes,
  CAST(gaming_battery_result_minutes AS DOUBLE) AS gaming_battery_result_minutes) FROM laptop_benchmark_result""",
    "bronze_user_event_tracking": "SELECT * FROM user_event_tracking",
}

_TS = "event_received_on_server_timestamp"
BLOCKS["stored_ev"] = _PARSED.replace("{source}", "versions_target")
BLOCKS["recent_raw"] = f"""
SELECT l.* FROM versions_latest l
WHERE l.{_TS} >= (SELECT max(t.{_TS}) - 7200 FROM versions_target t WHERE t.session_id IS NOT NULL AND t.event_name IS NOT NULL)"""
BLOCKS["recent_ev"] = _PARSED.replace("{source}", "recent_raw")

_INGESTION = {
    "scan_snapshot": _BRONZE["bronze_laptop_model"],
    "scan_range": f"SELECT * FROM user_event_tracking WHERE {_TS} >= 1705363200 AND {_TS} < 1705622400",
    "scan_incremental": f"""
SELECT e.* FROM user_event_tracking e, (SELECT max({_TS}) AS newest FROM versions_target) m
WHERE e.{_TS} >= m.newest - 7200""",
    "watermark": f"SELECT max({_TS}) AS watermark FROM user_event_tracking",
    "batch_violations": """
SELECT count(*) FILTER (session_id IS NULL) AS missing_key, count(*) FILTER (event_name IS NULL) AS bad_timestamp
FROM user_event_tracking""",
    "batch_latest": "SELECT * FROM versions_latest",
    "batch_conflicts": """
SELECT id FROM user_event_tracking WHERE event_name = 'search_for_device' AND event_data <> '{}'""",
    "upsert_versions": f"""
SELECT l.* FROM versions_latest l LEFT JOIN versions_target t ON t.id = l.id
WHERE t.id IS NULL OR l.{_TS} >= t.{_TS}
UNION ALL
SELECT t.* FROM versions_target t LEFT JOIN versions_latest l ON t.id = l.id
WHERE l.id IS NULL OR l.{_TS} < t.{_TS}""",
    "upsert_counts": f"""
SELECT (SELECT count(*) FROM versions_batch) AS source_rows, count(*) AS source_ids,
  count(*) FILTER (t.{_TS} > l.{_TS}) AS older_ids_skipped,
  count(*) - count(*) FILTER (t.{_TS} > l.{_TS}) AS written_ids
FROM versions_latest l LEFT JOIN versions_target t ON t.id = l.id""",
    "upsert_conflicts": f"""
SELECT id FROM user_event_tracking WHERE event_name = 'click' AND {_TS} < 1705363200 AND event_data <> '{{}}'""",
    "silver_incremental": """
SELECT * FROM recent_ev UNION ALL SELECT * FROM stored_ev WHERE id NOT IN (SELECT id FROM recent_ev)""",
    "stored_events": "SELECT * FROM user_event_tracking",
    "built_daily_kpis": "SELECT * FROM g_daily",
}

_QUALITY = {
    "dq_unique": "SELECT id AS value, count(*) AS n_rows FROM versions_batch GROUP BY id HAVING count(*) > 1",
    "dq_not_null": "SELECT count(*) AS n_rows FROM user_event_tracking WHERE session_id IS NULL HAVING count(*) > 0",
    "dq_relationships": """
SELECT laptop_model_id AS value, count(*) AS n_rows FROM s_laptop
WHERE laptop_model_id NOT IN (SELECT laptop_model_id FROM s_bench) GROUP BY laptop_model_id""",
    "dq_accepted_values": """
SELECT event_name AS value, count(*) AS n_rows FROM user_event_tracking
WHERE event_name NOT IN ('pageview', 'click') GROUP BY event_name""",
    "dq_freshness": f"""
SELECT latest_at, age AS age_hours, CASE WHEN age > 48 THEN 'error' WHEN age > 24 THEN 'warn' ELSE 'pass' END AS status
FROM (SELECT latest_at,
        CAST(epoch_us(TIMESTAMP '2024-01-31 12:00:00') - epoch_us(latest_at) AS DOUBLE) / 1e6 / 3600 AS age
      FROM (SELECT make_timestamp(CAST(round_even((max({_TS}) - 946684800) * 1000000, 0) AS BIGINT) + 946684800000000)
              AS latest_at FROM user_event_tracking))""",
    "json_valid": """
SELECT id FROM (SELECT id, CASE WHEN session_id IS NULL THEN left(event_data, -1) ELSE event_data END AS event_data, device
                FROM user_event_tracking)
WHERE NOT json_valid(event_data) OR NOT json_valid(device)""",
    "dq_raw_to_silver_stale": f"""
SELECT coalesce(e.id, t.id) AS id
FROM (SELECT * FROM user_event_tracking WHERE event_name IS NOT NULL AND session_id IS NOT NULL) e
FULL JOIN (SELECT * FROM versions_target WHERE event_name IS NOT NULL AND session_id IS NOT NULL) t ON t.id = e.id
WHERE e.id IS NULL OR t.id IS NULL OR e.{_TS} <> t.{_TS}""",
    "dq_daily_event_counts_seeded": "SELECT event_date FROM g_daily WHERE day(event_date) % 2 = 1",
    "dq_daily_rates_seeded": """
SELECT * REPLACE (total_events + 1 AS total_sessions) FROM g_daily WHERE day(event_date) % 2 = 1""",
    "dq_gold_definitions_seeded": "SELECT 'brand_pair_direction' AS failure FROM g_pairs WHERE brand_a_id < brand_b_id",
    "dq_gold_totals_seeded": """
SELECT 'os_sessions' AS metric, (SELECT count(DISTINCT session_id) FROM ev) AS expected,
  (SELECT CAST(2 * sum(sessions) AS BIGINT) FROM g_os) AS actual""",
    "dq_source_taxonomy_seeded": "SELECT 'source_os_mapping' AS failure FROM ev WHERE user_os = 'Windows'",
    "dq_daily_event_counts": """
SELECT event_date FROM (SELECT event_date, count(*) AS n FROM ev GROUP BY event_date)
FULL JOIN g_daily USING (event_date) WHERE n IS DISTINCT FROM total_events""",
    "dq_daily_rates": """
SELECT * FROM g_daily WHERE total_sessions > total_events OR detail_rate_pct < 0 OR detail_rate_pct > 100
  OR comparison_rate_pct < 0 OR comparison_rate_pct > 100
  OR (detail_rate_pct IS NULL AND sessions_with_pageview <> 0)
  OR (comparison_rate_pct IS NULL AND sessions_with_detail_view <> 0)""",
    "dq_gold_definitions": """
SELECT 'brand_rate' AS failure FROM g_brand WHERE comparison_rate_pct > 100 OR comparison_rate_pct < 0
  OR view_sessions < detail_and_comparison_sessions
UNION ALL SELECT 'brand_pair_direction' FROM g_pairs WHERE brand_b_id < brand_a_id
UNION ALL SELECT 'funnel_daily_grain' FROM (SELECT event_date FROM g_funnel GROUP BY event_date HAVING count(*) <> 1)
UNION ALL SELECT 'daily_timezone' FROM (SELECT session_id, event_date FROM s_day
                                        EXCEPT SELECT session_id, event_date FROM ev)""",
    "gold_totals": """
SELECT 'daily_events' AS metric, (SELECT count(*) FROM ev) AS expected,
  (SELECT CAST(sum(total_events) AS BIGINT) FROM g_daily) AS actual
UNION ALL SELECT 'session_days', (SELECT count(*) FROM (SELECT DISTINCT session_id, event_date FROM ev)),
  (SELECT CAST(sum(total_sessions) AS BIGINT) FROM g_daily)
UNION ALL SELECT 'funnel_session_days', (SELECT count(*) FROM (SELECT DISTINCT session_id, event_date FROM ev)),
  (SELECT CAST(sum(total_sessions) AS BIGINT) FROM g_funnel)
UNION ALL SELECT 'os_sessions', (SELECT count(DISTINCT session_id) FROM ev),
  (SELECT CAST(sum(sessions) AS BIGINT) FROM g_os)
UNION ALL SELECT 'search_events',
  (SELECT count(*) FROM ev WHERE event_name = 'search_for_device' AND trim(search_keyword) <> ''),
  (SELECT CAST(sum(search_volume) AS BIGINT) FROM g_search)
UNION ALL SELECT 'cpu_detail_views', (SELECT count(*) FROM views WHERE cpu_name <> ''),
  (SELECT CAST(sum(total_views) AS BIGINT) FROM g_cpu)
UNION ALL SELECT 'gpu_detail_views', (SELECT count(*) FROM views WHERE gpu_name <> ''),
  (SELECT CAST(sum(total_views) AS BIGINT) FROM g_gpu)
UNION ALL SELECT 'brand_detail_views', (SELECT count(*) FROM views), (SELECT CAST(sum(total_views) AS BIGINT) FROM g_brand)
UNION ALL SELECT 'spec_detail_views', (SELECT count(*) FROM views WHERE cpu_name <> ''),
  (SELECT CAST(sum(total_views) AS BIGINT) FROM g_spec)""",
    "dq_raw_to_silver": f"""
SELECT coalesce(r.id, s.id) AS id
FROM (SELECT * FROM user_event_tracking WHERE event_name IS NOT NULL AND session_id IS NOT NULL) r
FULL JOIN ev s ON s.id = r.id
WHERE r.id IS NULL OR s.id IS NULL OR r.event_name <> s.event_name OR r.session_id <> s.session_id
  OR r.event_data IS DISTINCT FROM s.event_data OR r.device IS DISTINCT FROM s.device
  OR r.{_TS} <> epoch(s.server_timestamp)""",
    "dq_source_taxonomy": """
SELECT 'source_os_mapping' AS failure FROM user_event_tracking r JOIN ev s ON s.id = r.id
WHERE ifnull(json_extract_string(r.device, '$.os'), json_extract_string(r.device, '$.os_name')) IS DISTINCT FROM s.user_os
UNION ALL
SELECT 'selection_reach' FROM (SELECT sum(step_3_select_compare) AS reported FROM g_funnel)
WHERE reported <> (SELECT count(*) FROM s_day WHERE has_select_compare)
UNION ALL
SELECT 'comparison_bridge_duplicate' FROM (SELECT event_id, laptop_model_id FROM s_bridge GROUP BY ALL HAVING count(*) > 1)""",
}
_QUALITY["dq_gold_totals"] = f"SELECT * FROM ({_QUALITY['gold_totals']}) WHERE expected IS DISTINCT FROM actual"

_RELATIONS = {
    **{name: f"SELECT * FROM {name}" for name in (
        "brand", "cpu_model", "gpu_model", "laptop_model", "laptop_benchmark_result", "user_event_tracking")},
    **_BRONZE, **_SILVER, **_GOLD,
}
_RECONCILIATION = {
    "row_counts": " UNION ALL ".join(
        f"SELECT '{name}' AS relation, count(*) AS n_rows FROM ({query.strip()})" for name, query in _RELATIONS.items()
    ),
    "reconcile_duplicates": "SELECT count(*) - count(DISTINCT id) AS duplicate_raw_ids FROM versions_batch",
    "reconcile_raw_silver": """
SELECT count(*) FILTER (event_name IS NOT NULL AND session_id IS NOT NULL) AS expected_silver,
  (SELECT count(*) FROM ev) AS silver_events FROM user_event_tracking""",
    "reconcile_daily": """
SELECT count(*) AS daily_metric_mismatches
FROM (SELECT event_date, count(*) AS n, count(DISTINCT session_id) AS s FROM ev GROUP BY event_date)
FULL JOIN g_daily USING (event_date) WHERE n IS DISTINCT FROM total_events OR s IS DISTINCT FROM total_sessions""",
    "reconcile_totals": """
SELECT (SELECT count(*) FROM user_event_tracking) AS raw_events, (SELECT count(*) FROM user_event_tracking) AS bronze_events,
  (SELECT count(*) FROM ev) AS silver_events, (SELECT CAST(sum(total_events) AS BIGINT) FROM g_daily) AS gold_daily_events""",
    "reconcile_report": """
SELECT raw_events, raw_events AS bronze_events, silver_events, gold_daily_events, raw_events - ids AS duplicate_raw_ids,
  expected_silver, wrong_days AS daily_metric_mismatches,
  raw_events = ids AND wrong_days = 0 AND expected_silver = silver_events AND gold_daily_events = silver_events AS reconciled
FROM (SELECT count(*) AS raw_events, count(DISTINCT id) AS ids,
        count(*) FILTER (event_name IS NOT NULL AND session_id IS NOT NULL) AS expected_silver FROM user_event_tracking),
  (SELECT count(*) AS silver_events FROM ev),
  (SELECT CAST(sum(total_events) AS BIGINT) AS gold_daily_events FROM g_daily),
  (SELECT count(*) AS wrong_days
   FROM (SELECT event_date, count(*) AS n, count(DISTINCT session_id) AS s FROM ev GROUP BY event_date)
   FULL JOIN g_daily USING (event_date) WHERE n IS DISTINCT FROM total_events OR s IS DISTINCT FROM total_sessions)""",
    "independent_daily": f"""
SELECT CAST(make_timestamp(CAST(round_even(({_TS} + 25200) * 1000000, 0) AS BIGINT)) AS DATE) AS event_date, count(*) AS total_events,
  count(DISTINCT session_id) AS total_sessions
FROM user_event_tracking WHERE event_name IS NOT NULL AND session_id IS NOT NULL GROUP BY 1""",
    "replay_equal": """
SELECT 'user_event_tracking' AS relation, (SELECT count(*) FROM user_event_tracking) AS rows_before,
  (SELECT count(*) FROM versions_batch) AS rows_after""",
    "raw_range_snapshot": f"""
SELECT count(*) AS events, max({_TS}) AS watermark,
  count(*) FILTER ({_TS} >= 1705363200 AND {_TS} < 1705622400) AS events_in_range FROM user_event_tracking""",
}

_SERVING = {
    "serve_period": "SELECT * FROM g_daily WHERE event_date = DATE '2024-01-28'",
    "serve_period_all": "SELECT * FROM g_daily WHERE event_date BETWEEN DATE '2024-01-10' AND DATE '2024-01-28'",
    "serve_period_available": """
SELECT * FROM g_daily WHERE event_date BETWEEN (SELECT min(event_date) FROM g_daily)
  AND (SELECT greatest(DATE '2024-01-28', max(event_date)) FROM g_daily)""",
    "serve_period_custom": "SELECT * FROM g_daily WHERE event_date BETWEEN DATE '2024-01-03' AND DATE '2024-01-06'",
    "serve_filter_days": "SELECT * FROM g_daily WHERE event_date >= DATE '2024-01-22' AND event_date < DATE '2024-01-29'",
    "serve_summarize_daily": """
SELECT * , CASE WHEN sessions_with_pageview > 0 THEN 100 * CAST(pageview_and_detail AS DOUBLE) / sessions_with_pageview END
    AS detail_reach_pct,
  CASE WHEN sessions_with_detail_view > 0 THEN 100 * CAST(detail_and_comparison AS DOUBLE) / sessions_with_detail_view END
    AS comparison_reach_pct
FROM (SELECT CAST(coalesce(sum(total_events), 0) AS BIGINT) AS total_events,
  CAST(coalesce(sum(total_sessions), 0) AS BIGINT) AS total_sessions,
  CAST(coalesce(sum(total_pageviews), 0) AS BIGINT) AS total_pageviews,
  CAST(coalesce(sum(detail_pageviews), 0) AS BIGINT) AS detail_pageviews,
  CAST(coalesce(sum(comparison_pageviews), 0) AS BIGINT) AS comparison_pageviews,
  CAST(coalesce(sum(sessions_with_pageview), 0) AS BIGINT) AS sessions_with_pageview,
  CAST(coalesce(sum(sessions_with_detail_view), 0) AS BIGINT) AS sessions_with_detail_view,
  CAST(coalesce(sum(pageview_and_detail), 0) AS BIGINT) AS pageview_and_detail,
  CAST(coalesce(sum(detail_and_comparison), 0) AS BIGINT) AS detail_and_comparison
  FROM g_daily WHERE event_date BETWEEN DATE '2024-01-22' AND DATE '2024-01-28')""",
    "serve_recency": """
SELECT latest_at, age AS age_hours, CASE WHEN age > 48 THEN 'error' WHEN age > 24 THEN 'warn' ELSE 'pass' END AS status
FROM (SELECT latest_at, CAST(epoch_us(TIMESTAMP '2024-01-31 12:00:00') - epoch_us(latest_at) AS DOUBLE) / 1e6 / 3600 AS age
      FROM (SELECT max(latest_event_at) AS latest_at FROM g_daily))""",
    "top_brands": "SELECT * FROM g_brand QUALIFY row_number() OVER (ORDER BY total_views DESC, brand_name) <= 10",
    "brand_share": """
SELECT CASE WHEN place <= 6 THEN brand_name ELSE 'Other brands (remaining)' END AS brand_name,
  CAST(sum(total_views) AS BIGINT) AS total_views
FROM (SELECT *, row_number() OVER (ORDER BY total_views DESC, brand_name, brand_id) AS place FROM g_brand)
GROUP BY CASE WHEN place <= 6 THEN place ELSE 7 END, 1""",
    "top_component_trend": """
SELECT month, gpu_name, CAST(sum(total_views) AS BIGINT) AS total_views FROM g_gpu
WHERE gpu_name IN (SELECT gpu_name FROM g_gpu GROUP BY gpu_name ORDER BY sum(total_views) DESC, gpu_name LIMIT 5)
GROUP BY month, gpu_name""",
    "serve_pairs": "SELECT * FROM g_pairs",
    "serve_specs": "SELECT * FROM g_spec",
    "serve_funnel_totals": " UNION ALL ".join(
        f"SELECT '{label}' AS step, CAST(coalesce(sum({column}), 0) AS BIGINT) AS session_days FROM g_funnel"
        for label, column in (
            ("Pageview", "step_1_pageview"), ("Product detail", "step_2_product_detail"),
            ("Select for comparison", "step_3_select_compare"), ("Comparison page", "step_4_comparison_page"),
            ("Sort action", "step_5_sort_action"))
    ),
    "top_searches": "SELECT * FROM g_search QUALIFY row_number() OVER (ORDER BY search_volume DESC, search_keyword) <= 25",
    "serve_os_totals": "SELECT user_os, count(*) AS sessions FROM s_activity GROUP BY user_os",
    "serve_benchmark_coverage": """
SELECT count(*) AS models, count(office_battery_hours) AS battery_measurements,
  round(avg(office_battery_hours), 4) AS mean_battery_hours, format('{:,.1f} h', avg(office_battery_hours)) AS mean_battery_label,
  count(*) FILTER (office_battery_hours IS NOT NULL AND geekbench6_multi IS NOT NULL) AS measured_models FROM g_rank""",
    "serve_measured": """
SELECT laptop_name, brand_name, office_battery_hours, geekbench6_multi FROM g_rank
WHERE office_battery_hours IS NOT NULL AND geekbench6_multi IS NOT NULL""",
    "top_perf_per_kg": """
SELECT * FROM g_eff WHERE performance_per_kg IS NOT NULL
QUALIFY row_number() OVER (ORDER BY performance_per_kg DESC, laptop_model_id) <= 10""",
    "serve_interest_points": """
SELECT laptop_name, brand_name, office_battery_hours, total_views FROM g_battery WHERE office_battery_hours IS NOT NULL""",
    "serve_catalog": """
SELECT r.laptop_name, r.brand_name, r.cpu_name, r.gpu_name, r.screen_size, r.office_battery_hours, r.geekbench6_multi,
  b.total_views
FROM g_rank r JOIN g_battery b ON b.laptop_model_id = r.laptop_model_id
WHERE r.brand_name = 'Brand#7' AND contains(lower(r.laptop_name), 'ring')""",
    "serve_catalog_all": """
SELECT r.laptop_name, r.brand_name, r.cpu_name, r.gpu_name, r.screen_size, r.office_battery_hours, r.geekbench6_multi,
  b.total_views
FROM g_rank r JOIN g_battery b ON b.laptop_model_id = r.laptop_model_id""",
    "serve_brand_options": "SELECT DISTINCT brand_name FROM g_rank WHERE brand_name IS NOT NULL",
}
# After an incremental run every relation is what it is over all events; these are the days that the run changed.
_KEPT_UP = (
    "silver_session_day", "silver_comparison_event_device", "silver_device_traffic_event", "gold_daily_site_kpis",
    "gold_behavior_funnel_daily", "gold_brand_interest", "gold_brand_comparison", "gold_cpu_trend", "gold_gpu_trend",
    "gold_spec_popularity", "gold_battery_vs_interest", "gold_search_analytics", "gold_user_os",
)
_INCREMENTAL = {f"incremental_{name}": {**_SILVER, **_GOLD}[name] for name in _KEPT_UP}
_INCREMENTAL["incremental_changed_days"] = f"""
SELECT DISTINCT CAST(to_timestamp(ts) AT TIME ZONE 'Asia/Ho_Chi_Minh' AS DATE) AS event_date FROM (
  SELECT {_TS} AS ts FROM user_event_tracking
  WHERE session_id IS NOT NULL AND (event_name IS NOT NULL AND {_TS} >= 1706140800
    OR event_name = 'pageview' AND {_TS} >= 1705017600 AND {_TS} < 1705190400)
  UNION ALL
  SELECT {_TS} - 43200 FROM user_event_tracking
  WHERE session_id IS NOT NULL AND event_name = 'pageview' AND {_TS} >= 1705017600 AND {_TS} < 1705190400
  UNION ALL
  SELECT {_TS} - 60 FROM user_event_tracking
  WHERE session_id IS NULL AND event_name IS NOT NULL AND {_TS} >= 1705190400 AND {_TS} < 1705276800)"""
QUERIES: dict[str, str] = {
    **_BRONZE, **_SILVER, **_GOLD, **_INGESTION, **_INCREMENTAL, **_QUALITY, **_RECONCILIATION, **_SERVING,
}


def oracle_sql() -> dict[str, str]:
    return {name: statement(query) for name, query in QUERIES.items()}
