"""Registered queries: key -> callable(spark, sf_dir) -> DataFrame."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from footfall.plans import ad_jobs, area_jobs, session_jobs, sql_surface

Query = Callable[[SparkSession, str], DataFrame]


def all_queries() -> dict[str, Query]:
    return {
        # J1 area Top-N
        "visit_click_filter": area_jobs.visit_click_filter,
        "click_city_join": area_jobs.click_city_join,
        "area_product_click_count": area_jobs.area_product_click_count,
        "area_full_product": area_jobs.area_full_product,
        "area_level": area_jobs.area_level,
        "area_top10_product": area_jobs.area_top10_product,
        "area_top10_product_lineitem": area_jobs.area_top10_product_lineitem,
        "area_top10_persist": area_jobs.area_top10_persist,
        "area_top10_task": area_jobs.area_top10_task,
        "area_top10_day_pruned": area_jobs.area_top10_day_pruned,
        "area_counts_incremental": area_jobs.area_counts_incremental,
        "area_top10_bucketed": area_jobs.area_top10_bucketed,
        "area_top10_all_tasks": area_jobs.area_top10_all_tasks,
        "area_top10_product_sql": sql_surface.area_top10_product_sql,
        "task_params": area_jobs.task_params,
        # J2 ad-click stream
        "ad_log_parse": ad_jobs.ad_log_parse,
        "ad_blacklist_filter": ad_jobs.ad_blacklist_filter,
        "daily_user_ad_count": ad_jobs.daily_user_ad_count,
        "ad_user_click_total": ad_jobs.ad_user_click_total,
        "ad_blacklist_update": ad_jobs.ad_blacklist_update,
        "ad_realtime_stat": ad_jobs.ad_realtime_stat,
        "ad_province_top3": ad_jobs.ad_province_top3,
        "ad_late_clicks": ad_jobs.ad_late_clicks,
        "ad_admitted_totals": ad_jobs.ad_admitted_totals,
        "ad_admitted_city_counts": ad_jobs.ad_admitted_city_counts,
        # J4 / J5 sessions and behaviour, J3 cells
        "session_attr_extract": session_jobs.session_attr_extract,
        "session_attr_update": session_jobs.session_attr_update,
        "session_keywords": session_jobs.session_keywords,
        "session_filter": session_jobs.session_filter,
        "session_visit_length": session_jobs.session_visit_length,
        "session_aggr_stat": session_jobs.session_aggr_stat,
        "session_aggr_stat_task": session_jobs.session_aggr_stat_task,
        "session_stat_all_tasks": session_jobs.session_stat_all_tasks,
        "session_filter_sql": sql_surface.session_filter_sql,
        "json_array_first": session_jobs.json_array_first,
        "visit_hourly": session_jobs.visit_hourly,
        "visit_minutely": session_jobs.visit_minutely,
        "category_behavior_count": session_jobs.category_behavior_count,
        "kv_cells": session_jobs.kv_cells,
        "kv_range_scan": session_jobs.kv_range_scan,
    }
