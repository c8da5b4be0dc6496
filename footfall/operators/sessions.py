"""Session statistics and filters (J4) and category behaviour (J5).

A session row carries its attributes both as columns and as the
reference's ``k=v|k=v`` bag. Filters read their parameters from a bag too
(``startAge=20|endAge=40|cities=a,b|sex=female``) with the reference's
rules: a missing parameter accepts everything, a missing session field
rejects. Everything is a column expression; sessions are built with one
partial/final aggregate whose buffers are bounded by the domain (event
types, category ids), never by the size of a session.
"""

from __future__ import annotations

import re

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from footfall.functions import columns as fc
from footfall.functions.aggregates import count_if

# Bag field names of a session (the reference's constants).
FIELD_SESSION_ID = "sessionid"
FIELD_SEARCH_KEYWORDS = "searchKeywords"
FIELD_CLICK_CATEGORY_IDS = "clickCategoryIds"
FIELD_AGE = "age"
FIELD_PROFESSIONAL = "professional"
FIELD_CITY = "city"
FIELD_SEX = "sex"
FIELD_VISIT_LENGTH = "visitLength"
FIELD_STEP_LENGTH = "stepLength"
FIELD_START_TIME = "startTime"

# Filter parameter names (the reference's constants).
PARAM_START_AGE = "startAge"
PARAM_END_AGE = "endAge"
PARAM_PROFESSIONALS = "professionals"
PARAM_CITIES = "cities"
PARAM_SEX = "sex"
PARAM_KEYWORDS = "keywords"
PARAM_CATEGORY_IDS = "categoryIds"

# Visit-length buckets in seconds, half-open [lo, hi); the reference only
# names them (1s_4s ... 30m), the edges are ours. Sessions under 1 s fall in
# none.
VISIT_BUCKETS = [
    ("visit_length_1s_4s_ratio", 1, 4),
    ("visit_length_4s_7s_ratio", 4, 7),
    ("visit_length_7s_10s_ratio", 7, 10),
    ("visit_length_10s_30s_ratio", 10, 30),
    ("visit_length_30s_60s_ratio", 30, 60),
    ("visit_length_1m_3m_ratio", 60, 180),
    ("visit_length_3m_10m_ratio", 180, 600),
    ("visit_length_10m_30m_ratio", 600, 1800),
    ("visit_length_30m_ratio", 1800, None),
]
# Step-length buckets, inclusive on both ends.
STEP_BUCKETS = [
    ("step_length_1_3_ratio", 1, 3),
    ("step_length_4_6_ratio", 4, 6),
    ("step_length_7_9_ratio", 7, 9),
    ("step_length_10_29_ratio", 10, 29),
    ("step_length_30_59_ratio", 30, 59),
    ("step_length_60_ratio", 60, None),
]
AGGR_STAT_COLUMNS = ["session_count"] + [b[0] for b in VISIT_BUCKETS] + [b[0] for b in STEP_BUCKETS]


def session_facts(actions: DataFrame, session_key: list[str],
                  time_col: str = "action_time",
                  partition_by: list[str] | None = None) -> DataFrame:
    """One row per session: start/end time, step count, sorted distinct
    action types and clicked category ids.

    ``actions`` needs ``action_type`` and ``category_id`` besides the time
    and the key columns (names). Two levels: a codegen'd hash aggregate per
    (session, type, category) with map-side combine reduces the raw actions
    first; the distinct sets are collected over those rows only (bounded
    per session by types x categories), so a hot session never makes an
    object aggregate sort raw rows.

    ``partition_by`` (a subset of the key) redistributes the reduced rows
    before the second level, so a later join on those columns reuses the
    partitioning instead of shuffling the sessions again.
    """
    t = F.col(time_col)
    per_kind = (actions.groupBy(*session_key, "action_type", "category_id")
                .agg(F.min(t).alias("_first"), F.max(t).alias("_last"),
                     F.count(F.lit(1)).alias("_n")))
    if partition_by:
        per_kind = per_kind.repartition(*partition_by)
    clicked = F.when(F.col("action_type") == "click", F.col("category_id"))
    return (per_kind.groupBy(*session_key)
            .agg(F.min("_first").alias("start_ts"), F.max("_last").alias("end_ts"),
                 F.sum("_n").alias("step_length"),
                 F.array_join(F.array_sort(F.collect_set("action_type")), ",").alias("search_keywords"),
                 F.array_join(F.array_sort(F.collect_set(clicked)).cast("array<string>"), ",")
                 .alias("click_category_ids")))


def visit_facts(actions: DataFrame, session_key: list[str],
                time_col: str = "action_time") -> DataFrame:
    """Start/end time and step count of each session: one aggregate with map-side
    combine, for statistics that need none of the sets of ``session_facts``."""
    t = F.col(time_col)
    return actions.groupBy(*session_key).agg(F.min(t).alias("start_ts"), F.max(t).alias("end_ts"),
                                             F.count(F.lit(1)).alias("step_length"))


def with_visit_length(sessions: DataFrame) -> DataFrame:
    """start/end as 'yyyy-MM-dd HH:mm:ss' text and the whole-second visit
    length between them (DT3 + DT5); ``multi_second`` = start before end (DT4)."""
    start, end = fc.format_time("start_ts"), fc.format_time("end_ts")
    return (sessions.withColumn("start_time", start).withColumn("end_time", end)
            .withColumn("visit_length", fc.time_minus_seconds(F.col("end_time"), F.col("start_time")))
            .withColumn("multi_second", fc.time_before(F.col("start_time"), F.col("end_time"))))


def session_bag(df: DataFrame) -> Column:
    """The reference's aggregated session record as a ``k=v|...`` bag."""
    return fc.bag_of(**{
        FIELD_SESSION_ID: F.col("session_id"),
        FIELD_SEARCH_KEYWORDS: F.col("search_keywords"),
        FIELD_CLICK_CATEGORY_IDS: F.col("click_category_ids"),
        FIELD_AGE: F.col("age"),
        FIELD_PROFESSIONAL: F.col("professional"),
        FIELD_CITY: F.col("city"),
        FIELD_SEX: F.col("sex"),
        FIELD_VISIT_LENGTH: F.col("visit_length"),
        FIELD_STEP_LENGTH: F.col("step_length"),
        FIELD_START_TIME: F.col("start_time"),
    })


def extract_bag(bags: DataFrame, bag: str = "bag") -> DataFrame:
    """ST1 over every session field."""
    g = lambda f: fc.bag_get(F.col(bag), f)
    return bags.select(
        g(FIELD_SESSION_ID).alias("session_id"),
        g(FIELD_SEARCH_KEYWORDS).alias("search_keywords"),
        g(FIELD_CLICK_CATEGORY_IDS).alias("click_category_ids"),
        g(FIELD_AGE).try_cast("bigint").alias("age"),
        g(FIELD_PROFESSIONAL).alias("professional"),
        g(FIELD_CITY).alias("city"),
        g(FIELD_SEX).alias("sex"),
        g(FIELD_VISIT_LENGTH).try_cast("bigint").alias("visit_length"),
        g(FIELD_STEP_LENGTH).try_cast("bigint").alias("step_length"),
        g(FIELD_START_TIME).alias("start_time"),
    )


# --- filters over bags (FIL4-FIL6) -----------------------------------------

def between_param(data: Column, data_field: str, params: Column,
                  start_field: str, end_field: str) -> Column:
    """FIL4: both bounds present -> integer value within [lo, hi]; a missing
    bound accepts; a missing value rejects."""
    lo = fc.bag_get(params, start_field).try_cast("int")
    hi = fc.bag_get(params, end_field).try_cast("int")
    v = fc.bag_get(data, data_field).try_cast("int")
    return lo.isNull() | hi.isNull() | F.coalesce(v.between(lo, hi), F.lit(False))


def in_param(data: Column, data_field: str, params: Column, param_field: str) -> Column:
    """FIL5: the comma lists of value and parameter share an element."""
    p = fc.bag_get(params, param_field)
    v = fc.bag_get(data, data_field)
    return p.isNull() | F.coalesce(F.arrays_overlap(fc.split_list(v), fc.split_list(p)), F.lit(False))


def equal_param(data: Column, data_field: str, params: Column, param_field: str) -> Column:
    """FIL6: the value equals the parameter."""
    p = fc.bag_get(params, param_field)
    v = fc.bag_get(data, data_field)
    return p.isNull() | F.coalesce(v == p, F.lit(False))


FILTER_PARAM_NAMES = [PARAM_START_AGE, PARAM_END_AGE, PARAM_PROFESSIONALS, PARAM_CITIES,
                 PARAM_SEX, PARAM_KEYWORDS, PARAM_CATEGORY_IDS]


def filter_params_of_task(tasks: DataFrame, task_id: int) -> str:
    """The parameter bag of one task ('' if there is no such task); a task id that
    occurs twice is an error."""
    rows = (tasks.where(F.col("task_id") == F.lit(task_id))
            .select(fc.task_params_bag("task_param", FILTER_PARAM_NAMES)).limit(2).collect())
    if len(rows) > 1:
        raise ValueError(f"task id {task_id} occurs more than once")
    return rows[0][0] if rows else ""


USER_FIELDS = (FIELD_AGE, FIELD_PROFESSIONAL, FIELD_CITY, FIELD_SEX)
SESSION_FIELDS = (FIELD_SEARCH_KEYWORDS, FIELD_CLICK_CATEGORY_IDS)


def filter_condition(data: Column, params: str, fields=USER_FIELDS + SESSION_FIELDS) -> Column:
    """The conditions of ``params`` on the given bag fields, all required."""
    p = F.lit(params)
    conds = {
        FIELD_AGE: lambda: between_param(data, FIELD_AGE, p, PARAM_START_AGE, PARAM_END_AGE),
        FIELD_PROFESSIONAL: lambda: in_param(data, FIELD_PROFESSIONAL, p, PARAM_PROFESSIONALS),
        FIELD_CITY: lambda: in_param(data, FIELD_CITY, p, PARAM_CITIES),
        FIELD_SEX: lambda: equal_param(data, FIELD_SEX, p, PARAM_SEX),
        FIELD_SEARCH_KEYWORDS: lambda: in_param(data, FIELD_SEARCH_KEYWORDS, p, PARAM_KEYWORDS),
        FIELD_CLICK_CATEGORY_IDS: lambda: in_param(data, FIELD_CLICK_CATEGORY_IDS, p,
                                                   PARAM_CATEGORY_IDS),
    }
    out = F.lit(True)
    for f in fields:
        out = out & conds[f]()
    return out


def session_filter(bags: DataFrame, params: str, bag: str = "bag") -> DataFrame:
    """Sessions of ``bags`` accepted by every parameter of ``params``."""
    return bags.where(filter_condition(F.col(bag), params))


def bag_value(bag: str, field: str) -> str | None:
    """``bag_get`` of a bag that is at hand on the driver."""
    for piece in bag.split("|"):
        name, *values = re.sub("=+$", "", piece).split("=")
        if name == field and len(values) == 1 and values[0]:
            return values[0]
    return None


def list_value(bag: str, field: str) -> list[str] | None:
    """The comma list of a parameter, without trailing empty pieces; None if absent."""
    value = bag_value(bag, field)
    return None if value is None else [x for x in re.sub(",+$", "", value).split(",")] if value.strip(",") else []


def typed_conditions(params: str) -> tuple[Column, Column]:
    """The conditions of a parameter bag on the user columns (age, professional,
    city, sex: one value each) and on the activity columns (search_keywords,
    click_category_ids: comma lists).

    The bag is read once, on the driver, so what reaches the plan are plain
    comparisons that scans can take over. Same rules as for bags: an absent
    parameter, or a range without two whole-number bounds, accepts; a missing or
    empty value rejects."""

    def whole(field):
        value = (bag_value(params, field) or "").strip()
        return int(value) if re.fullmatch(r"[+-]?\d+", value) else None

    user, activity = F.lit(True), F.lit(True)
    lo, hi = whole(PARAM_START_AGE), whole(PARAM_END_AGE)
    if lo is not None and hi is not None:
        user = user & F.col("age").between(lo, hi)
    for column, field in (("professional", PARAM_PROFESSIONALS), ("city", PARAM_CITIES)):
        some = list_value(params, field)
        if some is not None:
            user = user & F.col(column).isin(*[x for x in some if x]) if any(some) else F.lit(False)
    sex = bag_value(params, PARAM_SEX)
    if sex is not None:
        user = user & (F.col("sex") == sex)
    for column, field in (("search_keywords", PARAM_KEYWORDS), ("click_category_ids", PARAM_CATEGORY_IDS)):
        some = list_value(params, field)
        if some is not None:
            wanted = F.array(*[F.lit(x) for x in some]).cast("array<string>")
            has = F.arrays_overlap(fc.split_list(F.nullif(F.col(column), F.lit(""))), wanted)
            activity = activity & F.coalesce(has, F.lit(False))
    return user, activity


# --- statistics --------------------------------------------------------------

def _in_range(c: Column, lo: int, hi: int | None, inclusive_hi: bool) -> Column:
    if hi is None:
        return c >= lo
    return (c >= lo) & ((c <= hi) if inclusive_hi else (c < hi))


def aggr_stat(sessions: DataFrame, group_cols: list[str] | None = None) -> DataFrame:
    """AG8 + MA1: session count and the share of sessions per visit-length
    and step-length bucket, rounded HALF_UP to 2 decimals."""
    group_cols = group_cols or []
    vl, sl = F.col("visit_length"), F.col("step_length")
    counts = ([F.count(F.lit(1)).alias("session_count")]
              + [count_if(_in_range(vl, lo, hi, False)).alias(name) for name, lo, hi in VISIT_BUCKETS]
              + [count_if(_in_range(sl, lo, hi, True)).alias(name) for name, lo, hi in STEP_BUCKETS])
    agg = sessions.groupBy(*group_cols).agg(*counts)
    ratios = [fc.ratio_2dp(F.col(name), F.col("session_count")).alias(name)
              for name, _, _ in VISIT_BUCKETS + STEP_BUCKETS]
    return agg.select(*group_cols, "session_count", *ratios)


def hourly_visits(actions: DataFrame, time_col: str = "action_time") -> DataFrame:
    """Actions and clicks per hour: 'yyyy-MM-dd_HH' (DT6) and the two-digit
    hour (ST4)."""
    t = F.col(time_col)
    return (actions.groupBy(fc.date_hour(t).alias("date_hour"),
                            fc.fulfill(F.hour(t).cast("string")).alias("hour"))
            .agg(F.count(F.lit(1)).alias("action_count"),
                 count_if(F.col("action_type") == "click").alias("click_count")))


def minutely_visits(actions: DataFrame, time_col: str = "action_time") -> DataFrame:
    """Actions per minute keyed 'yyyyMMddHHmm' (DT7)."""
    return (actions.groupBy(fc.format_time_minute(time_col).alias("minute_key"))
            .agg(F.count(F.lit(1)).alias("action_count")))


def category_behavior(actions: DataFrame, click: str = "click", order: str = "order",
                      pay: str = "pay") -> DataFrame:
    """AG9: clicks, orders and payments per category, one pass."""
    a = F.col("action_type")
    return (actions.where(F.col("category_id").isNotNull())
            .groupBy("category_id")
            .agg(count_if(a == click).alias("click_count"),
                 count_if(a == order).alias("order_count"),
                 count_if(a == pay).alias("pay_count")))
