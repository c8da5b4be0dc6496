"""J4 / J5 / J3 as registered queries: session bags, filters, visit
lengths, bucketed statistics, hourly/minutely activity, category behaviour
and the wide-column cell export."""

from __future__ import annotations

import hashlib

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from footfall.functions import columns as fc
from footfall.operators import cells as kv
from footfall.operators import filter_index as fi
from footfall.operators.area_windows import instant
from footfall.operators import sessions as ss
from footfall.plans.area_jobs import one_task
from footfall.session import ensure_utc, new_run_dir, shared_dir
from footfall.sources import tables as tb
from footfall.sources.behaviour import user_actions, user_info
from footfall.sources.tables import load

# Filter used by ``session_filter``: women aged 20-40 in two professions and
# the first thirteen cities, who clicked or purchased.
FILTER_PARAMS = ("startAge=20|endAge=40|professionals=BUILDING,MACHINERY|"
                 "cities=" + ",".join(f"NATION_{i}" for i in range(13)) +
                 "|sex=female|keywords=click,purchase")

# Action types standing for the reference's click / order / pay.
BEHAVIOUR_TYPES = {"click": "click", "order": "purchase", "pay": "signup"}


def session_id() -> Column:
    return F.concat(F.col("user_id").cast("string"), F.lit("_"), fc.format_date_key("day"))


def day_facts(actions: DataFrame) -> DataFrame:
    """One session per user and day of ``actions``, with sets and visit length."""
    acts = actions.withColumn("day", F.to_date("action_time"))
    facts = ss.with_visit_length(ss.session_facts(acts, ["user_id", "day"], partition_by=["user_id"]))
    return facts.withColumn("session_id", session_id())


def user_day_facts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One session per user and day with its visit length (no user attributes)."""
    ensure_utc(spark)
    return day_facts(user_actions(spark, sf_dir))


def user_day_sessions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One session per user and day, with visit length and user attributes."""
    return user_day_facts(spark, sf_dir).join(user_info(spark, sf_dir), "user_id")


def slot_sessions(spark: SparkSession, sf_dir: str, minutes: int = 10) -> DataFrame:
    """Sessions as fixed time slots over all users (short visit lengths)."""
    ensure_utc(spark)
    acts = user_actions(spark, sf_dir).withColumn(
        "slot", F.window("action_time", f"{minutes} minutes").start)
    return ss.with_visit_length(ss.visit_facts(acts, ["slot"]))


def session_bags(spark: SparkSession, sf_dir: str) -> DataFrame:
    s = user_day_sessions(spark, sf_dir)
    return s.select("session_id", ss.session_bag(s).alias("bag"))


def session_attr_extract(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ss.extract_bag(session_bags(spark, sf_dir))


def session_attr_update(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Bags first written with zero lengths, then completed field by field (ST2)."""
    s = user_day_sessions(spark, sf_dir)
    draft = s.select("session_id", "visit_length", "step_length",
                     ss.session_bag(s.withColumn("visit_length", F.lit(0))
                                    .withColumn("step_length", F.lit(0))).alias("bag"))
    bag = fc.bag_set(fc.bag_set(F.col("bag"), ss.FIELD_VISIT_LENGTH, F.col("visit_length")),
                     ss.FIELD_STEP_LENGTH, F.col("step_length"))
    return draft.select("session_id", bag.alias("bag"))


def session_keywords(spark: SparkSession, sf_dir: str) -> DataFrame:
    """ST3 + ST5: comma-wrapped lists trimmed back; empty category lists flagged."""
    s = user_day_facts(spark, sf_dir)
    wrap = lambda c: F.concat(F.lit(","), F.coalesce(F.col(c), F.lit("")), F.lit(","))
    cats = fc.trim_comma(wrap("click_category_ids"))
    return s.select("session_id",
                    fc.trim_comma(wrap("search_keywords")).alias("search_keywords"),
                    cats.alias("click_category_ids"),
                    fc.is_not_empty(cats).alias("has_click_categories"))


def filtered_sessions(spark: SparkSession, actions: DataFrame, users: DataFrame, params: str) -> DataFrame:
    """User-day sessions that a parameter bag accepts. Every condition concerns one
    side (user or activity), so each side is filtered before the join."""
    of_user, of_activity = ss.typed_conditions(params)
    facts = day_facts(actions).where(of_activity)
    return facts.join(users.where(of_user), "user_id")


def session_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    ensure_utc(spark)
    s = filtered_sessions(spark, user_actions(spark, sf_dir), user_info(spark, sf_dir), FILTER_PARAMS)
    return s.select("session_id", F.col("age").cast("bigint").alias("age"), "professional", "city", "sex",
                    "search_keywords")


def user_day_visits(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Visit length and steps of each user and day: one shuffle, no user table."""
    ensure_utc(spark)
    acts = user_actions(spark, sf_dir).withColumn("day", F.to_date("action_time"))
    return ss.with_visit_length(ss.visit_facts(acts, ["user_id", "day"]))


def session_visit_length(spark: SparkSession, sf_dir: str) -> DataFrame:
    s = user_day_visits(spark, sf_dir)
    return s.select(session_id().alias("session_id"), "start_time", "end_time", "visit_length", "step_length",
                    "multi_second")


def session_aggr_stat(spark: SparkSession, sf_dir: str) -> DataFrame:
    day = user_day_visits(spark, sf_dir).withColumn("session_kind", F.lit("user_day"))
    slot = slot_sessions(spark, sf_dir).withColumn("session_kind", F.lit("slot10m"))
    cols = ["session_kind", "visit_length", "step_length"]
    return ss.aggr_stat(day.select(*cols).unionByName(slot.select(*cols)), ["session_kind"])


# --- J4 as one job: task row -> parameters -> filter -> statistics -> table ----

STAT_SCHEMA = ", ".join(["session_count BIGINT", *[f"{c} DOUBLE" for c in ss.AGGR_STAT_COLUMNS[1:]],
                         "task_id BIGINT"])


def run_session_task(spark: SparkSession, sf_dir: str, task_id: int, path: str) -> DataFrame:
    """The statistics of the sessions that one task's parameters accept, persisted
    in the task's own partition (a re-run replaces it) and read back."""
    ensure_utc(spark)
    row = one_task(tb.session_tasks(spark, sf_dir), task_id)
    if row is None or row["start_date"] is None or row["end_date"] is None:
        raise ValueError(f"task {task_id} has no startDate/endDate")
    params = ss.filter_params_of_task(tb.session_tasks(spark, sf_dir), task_id)
    at = F.col("action_time")
    actions = user_actions(spark, sf_dir)
    of = actions.schema["action_time"].dataType
    actions = actions.where((at >= F.lit(row["start_date"]).cast(of)) & (at <= F.lit(row["end_date"]).cast(of)))
    stat = ss.aggr_stat(filtered_sessions(spark, actions, user_info(spark, sf_dir), params))
    (stat.withColumn("task_id", F.lit(task_id).cast("bigint")).select("task_id", *ss.AGGR_STAT_COLUMNS)
     .write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("task_id").parquet(path))
    kept = spark.read.schema(STAT_SCHEMA).parquet(path).where(F.col("task_id") == task_id)
    return kept.select("task_id", *ss.AGGR_STAT_COLUMNS)


# The registered run: categories and keywords set, the upper age bound missing.
SESSION_TASK_ID = 3


def session_aggr_stat_task(spark: SparkSession, sf_dir: str) -> DataFrame:
    tag = hashlib.sha1(sf_dir.encode()).hexdigest()[:10]
    return run_session_task(spark, sf_dir, SESSION_TASK_ID, shared_dir(spark, "tables", f"session_aggr_stat-{tag}"))


def session_classes(actions: DataFrame, users: DataFrame) -> DataFrame:
    """``filter_index.class_counts`` of the user-day sessions, whole and of first instants alone."""
    def facts(some: DataFrame, whole: bool) -> DataFrame:
        return (day_facts(some).select("user_id", F.unix_date("day").alias("day"), *fi.ACTIVITY, "visit_length", "step_length")
                .withColumn("whole", F.lit(whole)))
    first = actions.where(instant(F.col("action_time").cast("timestamp_ntz")) % 2 == 0)
    return fi.class_counts(facts(actions, True).unionByName(facts(first, False)), users)


def session_stat_all_tasks(spark: SparkSession, sf_dir: str) -> DataFrame:
    """J4 for every task of a table of filters at once."""
    ensure_utc(spark)
    path = new_run_dir(spark, "session_classes")
    session_classes(user_actions(spark, sf_dir), user_info(spark, sf_dir)).write.parquet(f"{path}/classes")
    tb.segment_tasks(spark, sf_dir).write.parquet(f"{path}/tasks")
    fi.filter_specs(spark.read.parquet(f"{path}/tasks")).write.parquet(f"{path}/specs")
    return fi.all_tasks_stat(spark.read.parquet(f"{path}/specs"), spark.read.parquet(f"{path}/classes"))


def json_array_first(spark: SparkSession, sf_dir: str) -> DataFrame:
    """SC3: a field of the first object of a JSON array."""
    part = load(spark, sf_dir, "part")
    js = F.to_json(F.array(F.struct(F.col("p_name").alias("name"), F.col("p_size").alias("size")),
                           F.struct(F.lit("other").alias("name"), F.lit(0).alias("size"))))
    return part.select(F.col("p_partkey").alias("product_id"),
                       fc.json_array_first_field(js, "name").alias("first_name"),
                       fc.json_array_first_field(js, "size").alias("first_size"))


def visit_hourly(spark: SparkSession, sf_dir: str) -> DataFrame:
    ensure_utc(spark)
    return ss.hourly_visits(user_actions(spark, sf_dir))


def visit_minutely(spark: SparkSession, sf_dir: str) -> DataFrame:
    ensure_utc(spark)
    return ss.minutely_visits(user_actions(spark, sf_dir))


def category_behavior_count(spark: SparkSession, sf_dir: str) -> DataFrame:
    acts = user_actions(spark, sf_dir)
    by_type = {v: k for k, v in BEHAVIOUR_TYPES.items()}
    t = F.col("action_type")
    mapped = F.lit(None).cast("string")
    for src, dst in by_type.items():
        mapped = F.when(t == src, F.lit(dst)).otherwise(mapped)
    return ss.category_behavior(acts.withColumn("action_type", mapped))


def kv_cells(spark: SparkSession, sf_dir: str) -> DataFrame:
    """J3: count per event type exported as wide-column cells, read back."""
    counts = kv.word_counts(load(spark, sf_dir, "events"), "event_type")
    tag = hashlib.sha1(sf_dir.encode()).hexdigest()[:10]
    path = shared_dir(spark, "tables", f"kv_cells-{tag}")
    kv.write_cells(kv.to_cells(counts, "word", "count"), path)
    cells = spark.read.parquet(path)
    return cells.select(F.hex("row_key").alias("row_key_hex"), "family", "qualifier",
                        F.hex("value").alias("value_hex"))


# The registered scans: a range of user ids in text order, and a prefix of them.
SCAN_START, SCAN_STOP, SCAN_PREFIX = b"15", b"3", b"7"


def kv_range_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """J3 read path: events per user as cells in row-key order, then a range and a prefix scan."""
    counts = kv.word_counts(load(spark, sf_dir, "events"), "user_id")
    path = new_run_dir(spark, "kv_cells")
    kv.write_cells(kv.to_cells(counts, "word", "count"), path)
    cells = spark.read.parquet(path)

    def rows(name, found):
        return found.select(F.lit(name).alias("scan"), F.hex("row_key").alias("row_key_hex"), "family", "qualifier",
                            kv.be_bytes_long("value").alias("n"))

    return (rows("range", kv.scan_cells(cells, SCAN_START, SCAN_STOP))
            .unionByName(rows("prefix", kv.scan_cells(cells, prefix=SCAN_PREFIX))))
