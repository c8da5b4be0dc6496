"""SQL surface: the reference's registered function names and tables for
users who write Spark SQL, and J1 written as one SQL statement.

Scalar helpers are SQL functions (``CREATE TEMPORARY FUNCTION ... RETURN``)
that Catalyst inlines, so they stay inside whole-stage codegen. The
distinct-string aggregate has no SQL-function form; in SQL it is
``listagg(DISTINCT x, ',') WITHIN GROUP (ORDER BY x)``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from footfall.operators import area_top as at
from footfall.session import ensure_utc
from footfall.sources import tables as tb

SQL_FUNCTIONS = {
    "concat_long_string": (
        "id BIGINT, name STRING, delim STRING", "STRING",
        "concat(CAST(id AS STRING), delim, name)"),
    "trim_comma": ("s STRING", "STRING", "regexp_replace(s, '^,|,$', '')"),
    "fulfill": ("s STRING", "STRING", "IF(length(s) = 2, s, concat('0', s))"),
    # the reference's argument order: text, delimiter (a regex), field
    "get_field_from_concat_string": (
        "bag STRING, delimiter STRING, field STRING", "STRING",
        "get(regexp_extract_all(concat('|', array_join(split(bag, delimiter), '|')), "
        "concat('\\\\|\\\\Q', field, '\\\\E=([^=|]+)=*(?=\\\\||$)'), 1), 0)"),
    "set_field_in_concat_string": (
        "bag STRING, delimiter STRING, field STRING, value STRING", "STRING",
        "regexp_replace(regexp_replace(array_join(split(bag, delimiter), '|'), '\\\\|+$', ''), "
        "concat('^((?:[^|]*\\\\|)*?)\\\\Q', field, '\\\\E(?:=[^|]*)?(?=\\\\||$)'), "
        "concat('$1', regexp_replace(field, '([\\\\\\\\$])', '\\\\\\\\$1'), '=', "
        "regexp_replace(value, '([\\\\\\\\$])', '\\\\\\\\$1')))"),
    # a comma list by Java's rules: trailing empty pieces are dropped
    "split_comma_list": (
        "s STRING", "ARRAY<STRING>",
        "CASE WHEN s = '' THEN array('') WHEN regexp_replace(s, ',+$', '') = '' "
        "THEN CAST(array() AS ARRAY<STRING>) ELSE split(regexp_replace(s, ',+$', ''), ',') END"),
    "json_array_first_field": (
        "js STRING, field STRING", "STRING",
        "try_element_at(get(from_json(js, 'array<map<string,string>>'), 0), field)"),
    "valid_between": (
        "data STRING, data_field STRING, params STRING, start_field STRING, end_field STRING",
        "BOOLEAN",
        "get_field_from_concat_string(params, '\\\\|', start_field) IS NULL "
        "OR get_field_from_concat_string(params, '\\\\|', end_field) IS NULL "
        "OR coalesce(try_cast(get_field_from_concat_string(data, '\\\\|', data_field) AS INT) "
        "BETWEEN try_cast(get_field_from_concat_string(params, '\\\\|', start_field) AS INT) "
        "AND try_cast(get_field_from_concat_string(params, '\\\\|', end_field) AS INT), false)"),
    "valid_in": (
        "data STRING, data_field STRING, params STRING, param_field STRING", "BOOLEAN",
        "get_field_from_concat_string(params, '\\\\|', param_field) IS NULL "
        "OR coalesce(arrays_overlap(split_comma_list(get_field_from_concat_string(data, '\\\\|', data_field)), "
        "split_comma_list(get_field_from_concat_string(params, '\\\\|', param_field))), false)"),
    "valid_equal": (
        "data STRING, data_field STRING, params STRING, param_field STRING", "BOOLEAN",
        "get_field_from_concat_string(params, '\\\\|', param_field) IS NULL "
        "OR coalesce(get_field_from_concat_string(data, '\\\\|', data_field) = "
        "get_field_from_concat_string(params, '\\\\|', param_field), false)"),
    "product_status_label": (
        "extend_info STRING", "STRING",
        f"IF(try_cast(get_json_object(extend_info, '$.product_status') AS DOUBLE) = 0, "
        f"'{at.SELF_OPERATED}', '{at.THIRD_PARTY}')"),
}


def register_functions(spark: SparkSession) -> None:
    for name, (params, returns, body) in SQL_FUNCTIONS.items():
        spark.sql(f"CREATE OR REPLACE TEMPORARY FUNCTION {name}({params}) "
                  f"RETURNS {returns} RETURN {body}")


TESTDATA = "footfall_testdata_"


def register_views(spark: SparkSession, sf_dir: str) -> None:
    """The test data as temp views of names that no catalog table has."""
    tb.user_visit_action(spark, sf_dir).createOrReplaceTempView(f"{TESTDATA}user_visit_action")
    tb.city_info(spark, sf_dir).createOrReplaceTempView(f"{TESTDATA}city_info")
    tb.product_info(spark, sf_dir).createOrReplaceTempView(f"{TESTDATA}product_info")


def _level_case(levels: dict[str, str], default: str) -> str:
    by_level: dict[str, list[str]] = {}
    for area, lv in levels.items():
        by_level.setdefault(lv, []).append(area)
    arms = " ".join(
        "WHEN area IN (" + ", ".join("'" + a.replace("'", "''") + "'" for a in areas) + f") THEN '{lv}'"
        for lv, areas in sorted(by_level.items()))
    return f"CASE {arms} ELSE '{default}' END"


AREA_TOP_SQL = """
WITH clk AS (
  SELECT city_id, try_cast(click_product_id AS BIGINT) AS product_id
  FROM {views}user_visit_action
  WHERE click_product_id IS NOT NULL AND click_product_id != 'null' AND click_product_id != 'NULL'
    AND action_time >= CAST(:start_time AS TIMESTAMP_NTZ)
    AND action_time <= CAST(:end_time AS TIMESTAMP_NTZ)),
basic AS (
  SELECT c.city_id, ci.city_name, ci.area, c.product_id
  FROM clk c JOIN {views}city_info ci ON c.city_id = ci.city_id),
per_city AS (
  SELECT area, product_id, concat_long_string(city_id, city_name, ';') AS city_info, COUNT(*) AS n
  FROM basic GROUP BY area, product_id, city_id, city_name),
cnt AS (
  SELECT area, product_id, SUM(n) AS click_count,
         -- labels are already distinct per group (per_city), so no DISTINCT
         -- (which would add one more aggregation and shuffle)
         listagg(city_info, ',') WITHIN GROUP (ORDER BY city_info) AS city_infos
  FROM per_city GROUP BY area, product_id),
fullp AS (
  SELECT a.area, a.product_id, a.click_count, a.city_infos, p.product_name,
         product_status_label(p.extend_info) AS product_status
  FROM cnt a JOIN {views}product_info p ON a.product_id = p.product_id),
ranked AS (
  SELECT *, {level_case} AS area_level,
         ROW_NUMBER() OVER (PARTITION BY area ORDER BY click_count DESC, product_id ASC) AS rn
  FROM fullp)
SELECT area, area_level, product_id, click_count, city_infos, product_name, product_status
FROM ranked WHERE rn <= :top_n
"""


def area_top_sql(spark: SparkSession, start: str, end: str, n: int = 10,
                 levels: dict[str, str] = at.REFERENCE_AREA_LEVELS, views: str = "") -> DataFrame:
    """J1 over the catalog's tables (or views whose names start with ``views``), as
    one parameterised statement."""
    register_functions(spark)
    sql = AREA_TOP_SQL.replace("{level_case}", _level_case(levels, at.DEFAULT_AREA_LEVEL)).replace("{views}", views)
    return spark.sql(sql, args={"start_time": start, "end_time": end, "top_n": n})


def area_top10_product_sql(spark: SparkSession, sf_dir: str) -> DataFrame:
    from footfall.plans.area_jobs import END, START, TOP_N

    ensure_utc(spark)
    register_views(spark, sf_dir)
    return area_top_sql(spark, START, END, TOP_N, at.TESTDATA_AREA_LEVELS, TESTDATA)


def session_filter_sql(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The session filter written with the SQL validators over session bags."""
    from footfall.plans import session_jobs as sj

    register_functions(spark)
    sj.session_bags(spark, sf_dir).createOrReplaceTempView(f"{TESTDATA}session_bags")
    get = "get_field_from_concat_string(bag, '\\\\|', '{}')".format
    return spark.sql(f"""
SELECT {get('sessionid')} AS session_id, CAST({get('age')} AS BIGINT) AS age, {get('professional')} AS professional,
       {get('city')} AS city, {get('sex')} AS sex, {get('searchKeywords')} AS search_keywords
FROM {TESTDATA}session_bags
WHERE valid_between(bag, 'age', :p, 'startAge', 'endAge') AND valid_in(bag, 'professional', :p, 'professionals')
  AND valid_in(bag, 'city', :p, 'cities') AND valid_equal(bag, 'sex', :p, 'sex')
  AND valid_in(bag, 'searchKeywords', :p, 'keywords') AND valid_in(bag, 'clickCategoryIds', :p, 'categoryIds')""",
                     args={"p": sj.FILTER_PARAMS})
