"""DuckDB oracle SQL for every registered query.

Each statement computes from the driver's *base* tables (not from our
views), so it is an independent check of the Spark plan.
"""

from __future__ import annotations

# --- J1: area Top-N ---------------------------------------------------------

_CLICKS = """
  SELECT CAST(c.c_nationkey AS BIGINT) AS city_id,
         CAST(json_extract_string(e.props, '$.k') AS BIGINT) AS product_id
  FROM events e JOIN customer c ON e.user_id = c.c_custkey
  WHERE e.event_type = 'click' AND json_extract_string(e.props, '$.k') IS NOT NULL
    AND e.ts >= TIMESTAMP '2024-01-01 00:00:00' AND e.ts <= TIMESTAMP '2024-01-31 00:00:00'
"""

_BIG_CLICKS = """
  SELECT CAST(c.c_nationkey AS BIGINT) AS city_id, l.l_partkey AS product_id
  FROM lineitem l JOIN orders o ON l.l_orderkey = o.o_orderkey
       JOIN customer c ON o.o_custkey = c.c_custkey
  WHERE l.l_shipdate >= TIMESTAMP '1990-01-01 00:00:00'
    AND l.l_shipdate <= TIMESTAMP '2030-12-31 00:00:00'
"""

_CITY = """
  SELECT CAST(n.n_nationkey AS BIGINT) AS city_id, n.n_name AS city_name, r.r_name AS area
  FROM nation n JOIN region r ON n.n_regionkey = r.r_regionkey
"""


def _area_chain(clicks: str) -> dict[str, str]:
    basic = f"""SELECT k.city_id, ci.city_name, ci.area, k.product_id
  FROM ({clicks}) k JOIN ({_CITY}) ci ON k.city_id = ci.city_id"""
    counts = f"""SELECT area, product_id, COUNT(*) AS click_count,
         string_agg(DISTINCT CAST(city_id AS VARCHAR) || ';' || city_name, ',' ORDER BY CAST(city_id AS VARCHAR) || ';' || city_name) AS city_infos
  FROM ({basic}) b GROUP BY area, product_id"""
    full = f"""SELECT a.area, a.product_id, a.click_count, a.city_infos, p.p_name AS product_name,
         CASE WHEN p.p_size % 2 = 0 THEN '自营商品' ELSE '第三方商品' END AS product_status
  FROM ({counts}) a JOIN part p ON a.product_id = p.p_partkey"""
    level = f"""SELECT f.*,
         CASE WHEN area IN ('ASIA', 'EUROPE') THEN 'A级' WHEN area IN ('AMERICA') THEN 'B级'
              WHEN area IN ('AFRICA') THEN 'C级' WHEN area IN ('MIDDLE EAST') THEN 'D级'
              ELSE 'E级' END AS area_level
  FROM ({full}) f"""
    top = f"""SELECT area, area_level, product_id, click_count, city_infos, product_name, product_status
  FROM (SELECT l.*, ROW_NUMBER() OVER (PARTITION BY area ORDER BY click_count DESC, product_id ASC) AS rn
        FROM ({level}) l) t
  WHERE rn <= 10"""
    return {"basic": basic, "counts": counts, "full": full, "level": level, "top": top}


_TASK_CLICKS = """
  SELECT CAST(c.c_nationkey AS BIGINT) AS city_id, l.l_partkey AS product_id
  FROM lineitem l JOIN orders o ON l.l_orderkey = o.o_orderkey
       JOIN customer c ON o.o_custkey = c.c_custkey
  WHERE l.l_shipdate >= (SELECT CAST(CAST(o_orderdate AS DATE) AS TIMESTAMP) FROM orders WHERE o_orderkey = 0)
    AND l.l_shipdate <= (SELECT CAST(CAST(o_orderdate AS DATE) + INTERVAL 30 DAY AS TIMESTAMP)
                         FROM orders WHERE o_orderkey = 0)
"""

_WEEK_CLICKS = f"""{_CLICKS}
    AND e.ts >= TIMESTAMP '2024-01-05 00:00:00' AND e.ts <= TIMESTAMP '2024-01-25 00:00:00'
"""

_EV = _area_chain(_CLICKS)
_WEEKS = _area_chain(_WEEK_CLICKS)
_TASK = _area_chain(_TASK_CLICKS)
_BIG = _area_chain(_BIG_CLICKS)

_ALL_TASKS = f"""
WITH wins AS (SELECT DISTINCT CAST(o_orderdate AS DATE) AS first FROM orders),
clk AS (
  SELECT l.l_shipdate AS t, l.l_partkey AS product_id, ci.area, CAST(ci.city_id AS VARCHAR) || ';' || ci.city_name AS label
  FROM lineitem l JOIN orders o ON l.l_orderkey = o.o_orderkey JOIN customer c ON o.o_custkey = c.c_custkey
       JOIN ({_CITY}) ci ON c.c_nationkey = ci.city_id),
cnt AS (
  SELECT first, area, product_id, COUNT(*) AS click_count, string_agg(DISTINCT label, ',' ORDER BY label) AS city_infos
  FROM wins JOIN clk ON t >= first AND t <= first + INTERVAL 30 DAY GROUP BY first, area, product_id),
top AS (
  SELECT * FROM (
    SELECT cnt.*, p_name AS product_name, p_size, ROW_NUMBER() OVER (PARTITION BY first, area ORDER BY click_count DESC, product_id) AS rn
    FROM cnt JOIN part ON product_id = p_partkey) x WHERE rn <= 10)
SELECT o_orderkey AS task_id, area,
       CASE WHEN area IN ('ASIA', 'EUROPE') THEN 'A级' WHEN area = 'AMERICA' THEN 'B级' WHEN area = 'AFRICA' THEN 'C级'
            WHEN area = 'MIDDLE EAST' THEN 'D级' ELSE 'E级' END AS area_level,
       product_id, click_count, city_infos, product_name,
       CASE WHEN p_size % 2 = 0 THEN '自营商品' ELSE '第三方商品' END AS product_status
FROM orders JOIN top ON CAST(o_orderdate AS DATE) = first
"""

AREA = {
    "area_top10_all_tasks": _ALL_TASKS,
    "area_top10_day_pruned": _WEEKS["top"],
    "area_counts_incremental": _EV["counts"],
    "visit_click_filter": _CLICKS,
    "click_city_join": _EV["basic"],
    "area_product_click_count": _EV["counts"],
    "area_full_product": _EV["full"],
    "area_level": _EV["level"],
    "area_top10_product": _EV["top"],
    "area_top10_product_lineitem": _BIG["top"],
    "area_top10_bucketed": _BIG["top"],
    "area_top10_product_sql": _EV["top"],
    "area_top10_persist": f"SELECT CAST(1 AS BIGINT) AS task_id, t.* FROM ({_EV['top']}) t",
    "area_top10_task": f"SELECT CAST(0 AS BIGINT) AS task_id, t.* FROM ({_TASK['top']}) t",
    "task_params": """
  SELECT o_orderkey AS task_id, strftime(o_orderdate, '%Y-%m-%d') AS start_date,
         strftime(o_orderdate + INTERVAL 30 DAY, '%Y-%m-%d') AS end_date
  FROM orders""",
}


# --- J2: ad-click stream ----------------------------------------------------
# Two arrivals split at 2024-01-16 12:00:00, blacklist seeded with customers in
# debt, threshold 4; batch 1 excludes users flagged by batch 0.

_AD = """
WITH log AS (
  SELECT epoch_us(e.ts) // 1000 AS ts_ms,
         strftime(e.ts, '%Y-%m-%d') AS date, strftime(e.ts, '%Y%m%d') AS date_key,
         replace(r.r_name, ' ', '-') AS province, n.n_name AS city, e.user_id,
         CAST(list_position(['click', 'view', 'purchase', 'signup', 'error'], e.event_type) AS BIGINT) AS ad_id,
         CAST(CASE WHEN e.ts < TIMESTAMP '2024-01-16 12:00:00' THEN 0 ELSE 1 END AS BIGINT) AS batch_id
  FROM events e JOIN customer c ON e.user_id = c.c_custkey
       JOIN nation n ON c.c_nationkey = n.n_nationkey
       JOIN region r ON n.n_regionkey = r.r_regionkey),
seed AS (SELECT c_custkey AS user_id FROM customer WHERE c_acctbal < 0),
f0 AS (SELECT * FROM log WHERE batch_id = 0
       AND NOT EXISTS (SELECT 1 FROM seed s WHERE s.user_id = log.user_id)),
d0 AS (SELECT 0 AS batch_id, date, user_id, ad_id, COUNT(*) AS click_count FROM f0 GROUP BY date, user_id, ad_id),
new0 AS (SELECT DISTINCT user_id FROM d0 WHERE click_count >= 4),
f1 AS (SELECT * FROM log WHERE batch_id = 1
       AND NOT EXISTS (SELECT 1 FROM seed s WHERE s.user_id = log.user_id)
       AND NOT EXISTS (SELECT 1 FROM new0 s WHERE s.user_id = log.user_id)),
d1 AS (SELECT 1 AS batch_id, date, user_id, ad_id, COUNT(*) AS click_count FROM f1 GROUP BY date, user_id, ad_id),
deltas AS (SELECT * FROM d0 UNION ALL SELECT * FROM d1),
tot AS (SELECT date, user_id, ad_id, CAST(SUM(click_count) AS BIGINT) AS click_count
        FROM deltas GROUP BY date, user_id, ad_id),
new1 AS (SELECT DISTINCT t.user_id FROM tot t
         WHERE t.click_count >= 4
           AND EXISTS (SELECT 1 FROM d1 WHERE d1.date = t.date AND d1.user_id = t.user_id AND d1.ad_id = t.ad_id)
           AND NOT EXISTS (SELECT 1 FROM seed s WHERE s.user_id = t.user_id)
           AND NOT EXISTS (SELECT 1 FROM new0 s WHERE s.user_id = t.user_id)),
filtered AS (SELECT * FROM f0 UNION ALL SELECT * FROM f1),
city AS (SELECT date_key, province, city, ad_id, COUNT(*) AS click_count
         FROM filtered GROUP BY date_key, province, city, ad_id),
prov AS (SELECT date_key, province, ad_id, CAST(SUM(click_count) AS BIGINT) AS click_count
         FROM city GROUP BY date_key, province, ad_id)
"""

AD = {
    "ad_log_parse": _AD + "SELECT ts_ms, date, province, city, user_id, ad_id FROM log",
    "ad_blacklist_filter": _AD + "SELECT ts_ms, date, province, city, user_id, ad_id, batch_id FROM filtered",
    "daily_user_ad_count": _AD + "SELECT CAST(batch_id AS BIGINT) AS batch_id, date, user_id, ad_id, click_count FROM deltas",
    "ad_user_click_total": _AD + "SELECT date, user_id, ad_id, click_count FROM tot",
    "ad_blacklist_update": _AD + """SELECT user_id, CAST(0 AS BIGINT) AS batch_id FROM new0
UNION ALL SELECT user_id, CAST(1 AS BIGINT) AS batch_id FROM new1""",
    "ad_realtime_stat": _AD + "SELECT date_key, province, city, ad_id, click_count FROM city",
    "ad_province_top3": _AD + """SELECT date_key AS date, province, ad_id, click_count
FROM (SELECT *, ROW_NUMBER() OVER (PARTITION BY date_key, province
                                   ORDER BY click_count DESC, ad_id ASC) AS rn FROM prov) t
WHERE rn <= 3""",
}

# Every seventh event from before the split lands with the second arrival, whose clicks are late
# if their day ended two days or more before the newest click of the first.
_LATE = """
WITH log AS (
  SELECT epoch_us(e.ts) // 1000 AS ts_ms, strftime(e.ts, '%Y-%m-%d') AS date, strftime(e.ts, '%Y%m%d') AS date_key,
         replace(r.r_name, ' ', '-') AS province, n.n_name AS city, e.user_id,
         CAST(list_position(['click', 'view', 'purchase', 'signup', 'error'], e.event_type) AS BIGINT) AS ad_id, e.ts,
         CAST(CASE WHEN e.ts < TIMESTAMP '2024-01-16 12:00:00' AND (epoch_us(e.ts) // 1000) % 7 <> 0 THEN 0 ELSE 1 END AS BIGINT) AS batch_id
  FROM events e JOIN customer c ON e.user_id = c.c_custkey
       JOIN nation n ON c.c_nationkey = n.n_nationkey
       JOIN region r ON n.n_regionkey = r.r_regionkey),
judged AS (
  SELECT *, batch_id = 1 AND date_trunc('day', ts) + INTERVAL 1 DAY
            <= (SELECT make_timestamp(max(ts_ms) * 1000) FROM log WHERE batch_id = 0) - INTERVAL 2 DAY AS late
  FROM log),
kept AS (SELECT * FROM judged WHERE coalesce(NOT late, TRUE)
         AND NOT EXISTS (SELECT 1 FROM customer c WHERE c.c_acctbal < 0 AND c.c_custkey = judged.user_id))
"""

AD |= {
    "ad_late_clicks": _LATE + "SELECT ts_ms, date, province, city, user_id, ad_id, batch_id FROM judged WHERE late",
    "ad_admitted_totals": _LATE + "SELECT date, user_id, ad_id, COUNT(*) AS click_count FROM kept GROUP BY ALL",
    "ad_admitted_city_counts": _LATE + "SELECT date_key, province, city, ad_id, COUNT(*) AS click_count FROM kept GROUP BY ALL",
}


# --- J4 / J5 / J3: sessions, behaviour, cells ---------------------------------

_SESS = """
WITH acts AS (
  SELECT user_id, ts, event_type, CAST(json_extract_string(props, '$.k') AS BIGINT) AS k FROM events),
users AS (
  SELECT c_custkey AS user_id, 18 + c_custkey % 50 AS age, c_mktsegment AS professional,
         n_name AS city, CASE WHEN c_custkey % 2 = 0 THEN 'male' ELSE 'female' END AS sex
  FROM customer JOIN nation ON c_nationkey = n_nationkey),
sess AS (
  SELECT user_id, CAST(user_id AS VARCHAR) || '_' || strftime(CAST(ts AS DATE), '%Y%m%d') AS session_id,
         date_trunc('second', MIN(ts)) AS st, date_trunc('second', MAX(ts)) AS et,
         COUNT(*) AS step_length,
         array_to_string(list_sort(list_distinct(list(event_type))), ',') AS search_keywords,
         NULLIF(array_to_string(list_sort(list_distinct(list(k) FILTER (WHERE event_type = 'click'))), ','), '')
           AS click_category_ids
  FROM acts GROUP BY user_id, CAST(ts AS DATE)),
s AS (
  SELECT sess.session_id, sess.search_keywords, sess.click_category_ids, sess.step_length,
         strftime(st, '%Y-%m-%d %H:%M:%S') AS start_time, strftime(et, '%Y-%m-%d %H:%M:%S') AS end_time,
         CAST(epoch(et) - epoch(st) AS BIGINT) AS visit_length, st < et AS multi_second,
         u.age, u.professional, u.city, u.sex
  FROM sess JOIN users u ON sess.user_id = u.user_id),
plain AS (
  SELECT session_id, search_keywords, click_category_ids, step_length,
         strftime(st, '%Y-%m-%d %H:%M:%S') AS start_time, strftime(et, '%Y-%m-%d %H:%M:%S') AS end_time,
         CAST(epoch(et) - epoch(st) AS BIGINT) AS visit_length, st < et AS multi_second
  FROM sess),
slot AS (
  SELECT CAST(epoch(date_trunc('second', MAX(ts))) - epoch(date_trunc('second', MIN(ts))) AS BIGINT) AS visit_length,
         COUNT(*) AS step_length
  FROM acts GROUP BY epoch_us(ts) // 600000000),
kinds AS (
  SELECT 'user_day' AS session_kind, visit_length, step_length FROM plain
  UNION ALL SELECT 'slot10m', visit_length, step_length FROM slot)
"""


def _ratio(cond: str) -> str:
    return f"CAST((COUNT(*) FILTER (WHERE {cond}) * 200 + COUNT(*)) // (2 * COUNT(*)) AS DOUBLE) / 100"


_VISIT = [("1s_4s", 1, 4), ("4s_7s", 4, 7), ("7s_10s", 7, 10), ("10s_30s", 10, 30),
          ("30s_60s", 30, 60), ("1m_3m", 60, 180), ("3m_10m", 180, 600), ("10m_30m", 600, 1800),
          ("30m", 1800, None)]
_STEP = [("1_3", 1, 3), ("4_6", 4, 6), ("7_9", 7, 9), ("10_29", 10, 29), ("30_59", 30, 59),
         ("60", 60, None)]
_STAT_COLS = ",\n  ".join(
    [f"{_ratio(f'visit_length >= {lo}' + (f' AND visit_length < {hi}' if hi else ''))} AS visit_length_{n}_ratio"
     for n, lo, hi in _VISIT]
    + [f"{_ratio(f'step_length >= {lo}' + (f' AND step_length <= {hi}' if hi else ''))} AS step_length_{n}_ratio"
       for n, lo, hi in _STEP])

_BAG = ("'sessionid=' || session_id || '|searchKeywords=' || search_keywords || "
        "'|clickCategoryIds=' || COALESCE(click_category_ids, '') || '|age=' || CAST(age AS VARCHAR) || "
        "'|professional=' || professional || '|city=' || city || '|sex=' || sex || "
        "'|visitLength=' || CAST(visit_length AS VARCHAR) || '|stepLength=' || CAST(step_length AS VARCHAR) || "
        "'|startTime=' || start_time")

_TASK_CITIES = ", ".join(f"'NATION_{(3 + i) % 25}'" for i in range(12))
_CITIES = ", ".join(f"'NATION_{i}'" for i in range(13))

_SEGMENT_TASKS = _SESS + """, tasks AS (
  SELECT c_custkey AS task_id, DATE '2024-01-01' + CAST(c_custkey % 11 AS INT) AS first,
         DATE '2024-01-01' + CAST(c_custkey % 11 + 5 + c_custkey % 17 AS INT) AS last,
         CASE WHEN c_custkey % 4 <> 0 AND c_custkey % 5 <> 0 THEN 18 + c_custkey % 30 END AS low,
         18 + c_custkey % 30 + c_custkey % 25 AS high,
         CASE WHEN c_custkey % 3 = 0 THEN NULL WHEN c_custkey % 2 = 0 THEN [c_mktsegment, 'BUILDING'] ELSE [c_mktsegment] END AS jobs,
         CASE WHEN c_custkey % 7 <> 0 THEN list_transform(range(0, c_custkey % 9 + 1), lambda i: 'NATION_' || ((c_custkey + i * 3) % 25)) END AS towns,
         CASE WHEN c_custkey % 12 = 1 THEN 'male' WHEN c_custkey % 6 = 1 THEN 'female' END AS wanted_sex,
         CASE WHEN c_custkey % 6 <> 2 THEN list_slice(['click', 'view', 'purchase', 'signup', 'error'],
                                                      c_custkey % 5 + 1, c_custkey % 5 + 2) END AS kinds,
         CASE WHEN c_custkey % 5 = 2 THEN list_transform(range(0, c_custkey % 20 + 1), lambda i: CAST((c_custkey * 7 + i * 13) % 100 AS VARCHAR)) END AS cats
  FROM customer),
dated AS (SELECT s.*, strptime(split_part(session_id, '_', 2), '%Y%m%d')::DATE AS day,
                 string_split(search_keywords, ',') AS words, string_split(click_category_ids, ',') AS ids FROM s),
passed AS (
  SELECT task_id, visit_length, step_length
  FROM tasks t JOIN dated d ON d.day >= t.first AND d.day < t.last
  WHERE (low IS NULL OR age BETWEEN low AND high) AND (jobs IS NULL OR list_contains(jobs, professional))
    AND (towns IS NULL OR list_contains(towns, city)) AND (wanted_sex IS NULL OR sex = wanted_sex)
    AND (kinds IS NULL OR list_has_any(words, kinds)) AND (cats IS NULL OR coalesce(list_has_any(ids, cats), false))),
counted AS (SELECT task_id, COUNT(*) AS session_count,
  """ + _STAT_COLS + """
  FROM passed GROUP BY task_id)
SELECT t.task_id, coalesce(session_count, 0) AS session_count, c.* EXCLUDE (task_id, session_count)
FROM tasks t LEFT JOIN counted c ON t.task_id = c.task_id
"""

SESSIONS = {
    "session_stat_all_tasks": _SEGMENT_TASKS,
    "session_attr_extract": _SESS + """SELECT session_id, search_keywords, click_category_ids, age,
  professional, city, sex, visit_length, step_length, start_time FROM s""",
    "session_attr_update": _SESS + f"SELECT session_id, {_BAG} AS bag FROM s",
    "session_keywords": _SESS + """SELECT session_id, search_keywords,
  COALESCE(click_category_ids, '') AS click_category_ids,
  click_category_ids IS NOT NULL AS has_click_categories FROM plain""",
    "session_filter": _SESS + f"""SELECT session_id, age, professional, city, sex, search_keywords FROM s
WHERE age BETWEEN 20 AND 40 AND professional IN ('BUILDING', 'MACHINERY')
  AND city IN ({_CITIES}) AND sex = 'female'
  AND list_has_any(string_split(search_keywords, ','), ['click', 'purchase'])""",
    "session_visit_length": _SESS + """SELECT session_id, start_time, end_time, visit_length, step_length,
  multi_second FROM plain""",
    "session_aggr_stat": _SESS + f"""SELECT session_kind, COUNT(*) AS session_count,
  {_STAT_COLS}
FROM kinds GROUP BY session_kind""",
    "session_aggr_stat_task": _SESS.replace(
        "FROM events)", "FROM events WHERE ts >= TIMESTAMP '2024-01-05' AND ts <= TIMESTAMP '2024-01-25')") + f"""
SELECT CAST(3 AS BIGINT) AS task_id, COUNT(*) AS session_count,
  {_STAT_COLS}
FROM s
WHERE professional IN ('BUILDING', 'MACHINERY', 'AUTOMOBILE') AND city IN ({_TASK_CITIES})
  AND list_has_any(string_split(search_keywords, ','), ['click', 'purchase'])
  AND list_has_any(string_split(click_category_ids, ','), list_transform(range(0, 99, 2), lambda x: CAST(x AS VARCHAR)))""",
    "json_array_first": """SELECT p_partkey AS product_id, p_name AS first_name,
  CAST(p_size AS VARCHAR) AS first_size FROM part""",
    "visit_hourly": """SELECT strftime(ts, '%Y-%m-%d_%H') AS date_hour, strftime(ts, '%H') AS hour,
  COUNT(*) AS action_count, COUNT(*) FILTER (WHERE event_type = 'click') AS click_count
FROM events GROUP BY 1, 2""",
    "visit_minutely": """SELECT strftime(ts, '%Y%m%d%H%M') AS minute_key, COUNT(*) AS action_count
FROM events GROUP BY 1""",
    "category_behavior_count": """SELECT CAST(json_extract_string(props, '$.k') AS BIGINT) AS category_id,
  COUNT(*) FILTER (WHERE event_type = 'click') AS click_count,
  COUNT(*) FILTER (WHERE event_type = 'purchase') AS order_count,
  COUNT(*) FILTER (WHERE event_type = 'signup') AS pay_count
FROM events WHERE json_extract_string(props, '$.k') IS NOT NULL GROUP BY 1""",
    "kv_cells": """SELECT hex(event_type) AS row_key_hex, 'info' AS family, 'count' AS qualifier,
  lpad(hex(COUNT(*)), 16, '0') AS value_hex
FROM events GROUP BY event_type""",
    "kv_range_scan": """WITH users AS (SELECT CAST(user_id AS VARCHAR) AS k, COUNT(*) AS n FROM events GROUP BY 1)
SELECT 'range' AS scan, hex(k) AS row_key_hex, 'info' AS family, 'count' AS qualifier, n
FROM users WHERE k >= '15' AND k < '3'
UNION ALL SELECT 'prefix', hex(k), 'info', 'count', n FROM users WHERE k LIKE '7%'""",
}


def all_oracles() -> dict[str, str]:
    out: dict[str, str] = {}
    out.update(AREA)
    out.update(AD)
    out.update(SESSIONS)
    out["session_filter_sql"] = SESSIONS["session_filter"]
    return out
