"""J1 as registered queries: each stage of the area Top-N job on the
driver's tables, plus the task-driven run that persists its result."""

from __future__ import annotations

import hashlib
import uuid

from pyspark.sql import DataFrame, Observation, SparkSession, Window
from pyspark.sql import functions as F

from footfall.functions.columns import task_param
from footfall.operators import area_top as at
from footfall.operators import area_windows as aw
from footfall.operators import day_partitions as dp
from footfall.operators.area_partials import AreaPartials
from footfall.operators.bucketed import keep_bucketed
from footfall.session import ensure_utc, new_run_dir, shared_dir
from footfall.sources import tables as tb
from footfall.streaming.folded import fs_path

# Analysis window of the registered queries: the whole event month.
START = "2024-01-01 00:00:00"
END = "2024-01-31 00:00:00"
# The line-item variant spans every ship date.
BIG_START = "1990-01-01 00:00:00"
BIG_END = "2030-12-31 00:00:00"
TOP_N = 10


def _clicks(spark: SparkSession, sf_dir: str) -> DataFrame:
    ensure_utc(spark)
    return at.click_actions(tb.user_visit_action(spark, sf_dir), START, END)


def visit_click_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _clicks(spark, sf_dir)


def click_city_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return at.join_city(_clicks(spark, sf_dir), tb.city_info(spark, sf_dir))


def area_product_click_count(spark: SparkSession, sf_dir: str) -> DataFrame:
    return at.area_product_clicks(click_city_join(spark, sf_dir))


def area_full_product(spark: SparkSession, sf_dir: str) -> DataFrame:
    return at.with_product(area_product_click_count(spark, sf_dir), tb.product_info(spark, sf_dir))


def area_level(spark: SparkSession, sf_dir: str) -> DataFrame:
    return at.with_area_level(area_full_product(spark, sf_dir), at.TESTDATA_AREA_LEVELS)


def area_top10_product(spark: SparkSession, sf_dir: str) -> DataFrame:
    ensure_utc(spark)
    return at.area_top_products(tb.user_visit_action(spark, sf_dir), tb.city_info(spark, sf_dir),
                                tb.product_info(spark, sf_dir), START, END, TOP_N,
                                at.TESTDATA_AREA_LEVELS)


def area_top10_product_lineitem(spark: SparkSession, sf_dir: str) -> DataFrame:
    ensure_utc(spark)
    return at.area_top_products(tb.user_visit_action_big(spark, sf_dir), tb.city_info(spark, sf_dir),
                                tb.product_info(spark, sf_dir), BIG_START, BIG_END, TOP_N,
                                at.TESTDATA_AREA_LEVELS)


def task_params(spark: SparkSession, sf_dir: str) -> DataFrame:
    """SRC7 + SC4: every task with its parsed date range."""
    t = tb.tasks(spark, sf_dir)
    return t.select("task_id",
                    task_param("task_param", "startDate").alias("start_date"),
                    task_param("task_param", "endDate").alias("end_date"))


def one_task(tasks: DataFrame, task_id: int):
    """The row of a task (None if there is none): start_date, end_date, task_param.
    A task id that occurs twice is an error."""
    rows = (tasks.where(F.col("task_id") == F.lit(task_id))
            .select(task_param("task_param", "startDate").alias("start_date"),
                    task_param("task_param", "endDate").alias("end_date"), "task_param")
            .limit(2).collect())
    if len(rows) > 1:
        raise ValueError(f"task id {task_id} occurs more than once")
    return rows[0] if rows else None


def task_window(tasks: DataFrame, task_id: int) -> tuple[str | None, str | None]:
    """One task's (startDate, endDate)."""
    row = one_task(tasks, task_id)
    return (row["start_date"], row["end_date"]) if row else (None, None)


def persist_top_n(result: DataFrame, task_id: int, path: str) -> None:
    """SNK1: write the Top-N of one task, keyed by task_id.

    The rows are written beside the table, and their number and their repeated keys (the
    reference's composite primary key: task, area, product) are observed by that same write.
    Without a repeated or null key the finished folder replaces this task's partition, so a
    retried or re-run task never duplicates rows; with one, nothing changes and a
    ``ValueError`` says how many. Other tasks' rows are untouched.
    """
    spark = result.sparkSession
    # the Top-N is already dealt by area, so this window needs no exchange of its own
    by_key = Window.partitionBy("area", "product_id").orderBy("click_count")
    seen = Observation()
    bad = (F.col("_nth") > 1) | F.col("area").isNull() | F.col("product_id").isNull()
    rows = (result.select(*at.TOP_N_COLUMNS, F.row_number().over(by_key).alias("_nth"))
            .observe(seen, F.count(F.lit(1)).alias("rows"), F.count_if(bad).alias("bad")).drop("_nth"))
    staged, fs = fs_path(spark, f"{path}/_staged-{uuid.uuid4().hex[:12]}")
    try:
        rows.write.parquet(staged.toString())
        if found := seen.get["bad"]:
            raise ValueError(f"task {task_id}: {found} of {seen.get['rows']} rows repeat a key or lack one")
        final, _ = fs_path(spark, f"{path}/task_id={int(task_id)}")
        fs.delete(final, True)
        if not fs.rename(staged, final):
            raise OSError(f"could not publish {final.toString()}")
    finally:
        fs.delete(staged, True)


PERSIST_SCHEMA = ("area STRING, area_level STRING, product_id BIGINT, click_count BIGINT, "
                  "city_infos STRING, product_name STRING, product_status STRING, task_id BIGINT")


def read_persisted(spark: SparkSession, path: str, task_id: int) -> DataFrame:
    """The persisted rows of one task (partition pruned on task_id)."""
    df = spark.read.schema(PERSIST_SCHEMA).parquet(path).where(F.col("task_id") == F.lit(task_id))
    return df.select("task_id", *at.TOP_N_COLUMNS)


# The registered persist query runs as this task id over the event month.
PERSIST_TASK_ID = 1


def area_top10_persist(spark: SparkSession, sf_dir: str) -> DataFrame:
    tag = hashlib.sha1(sf_dir.encode()).hexdigest()[:10]
    path = shared_dir(spark, "tables", f"area_top10_product-{tag}")
    persist_top_n(area_top10_product(spark, sf_dir), PERSIST_TASK_ID, path)
    return read_persisted(spark, path, PERSIST_TASK_ID)


def run_task_on_tables(spark: SparkSession, task_id: int, path: str, n: int = TOP_N,
                       actions: str = "user_visit_action", cities: str = "city_info",
                       products: str = "product_info", tasks: str = "task",
                       levels: dict[str, str] = at.REFERENCE_AREA_LEVELS) -> DataFrame:
    """The same job over catalog tables in the reference's own shape
    (Hive/JDBC-backed tables or temp views), with its area levels."""
    start, end = task_window(spark.table(tasks), task_id)
    if start is None or end is None:
        raise ValueError(f"task {task_id} has no startDate/endDate")
    result = at.area_top_products(spark.table(actions), spark.table(cities), spark.table(products),
                                  start, end, n, levels)
    persist_top_n(result, task_id, path)
    return read_persisted(spark, path, task_id)


def run_task(spark: SparkSession, sf_dir: str, task_id: int, path: str,
             n: int = TOP_N, source: str = "events") -> DataFrame:
    """The task-parameterised job: task row -> date window -> Top-N -> persist.

    ``source`` picks the visit actions: "events" or "lineitem".
    """
    ensure_utc(spark)
    start, end = task_window(tb.tasks(spark, sf_dir), task_id)
    if start is None or end is None:
        raise ValueError(f"task {task_id} has no startDate/endDate")
    actions = (tb.user_visit_action_big if source == "lineitem" else tb.user_visit_action)(spark, sf_dir)
    result = at.area_top_products(actions, tb.city_info(spark, sf_dir),
                                  tb.product_info(spark, sf_dir), start, end, n,
                                  at.TESTDATA_AREA_LEVELS)
    persist_top_n(result, task_id, path)
    return read_persisted(spark, path, task_id)


# The registered task-driven run: task 0 (order 0 exists at every scale)
# over the line-item actions, whose ship dates overlap the task windows.
REGISTERED_TASK_ID = 0


def area_top10_task(spark: SparkSession, sf_dir: str) -> DataFrame:
    """SRC7 -> SC4 -> J1 -> SNK1 end to end for one task."""
    tag = hashlib.sha1(sf_dir.encode()).hexdigest()[:10]
    path = shared_dir(spark, "tables", f"area_top10_task-{tag}")
    return run_task(spark, sf_dir, REGISTERED_TASK_ID, path, source="lineitem")


def area_top10_all_tasks(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The Top-N of every task over the line-item actions, which are counted once."""
    ensure_utc(spark)
    path = new_run_dir(spark, "area_daily")
    products = tb.product_info(spark, sf_dir)
    aw.daily_clicks(tb.user_visit_action_big(spark, sf_dir), tb.city_info(spark, sf_dir), products).write.parquet(path)
    return aw.all_tasks_top(tb.tasks(spark, sf_dir), spark.read.parquet(path), products, TOP_N, at.TESTDATA_AREA_LEVELS)


def area_top10_day_pruned(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A task of three weeks over visit actions in day folders; those outside its window are pruned."""
    ensure_utc(spark)
    path = new_run_dir(spark, "actions_by_day")
    actions = tb.user_visit_action(spark, sf_dir)
    dp.write_by_day(actions, path)
    by_day = dp.read_by_day(spark, path, actions.schema["action_time"].dataType.simpleString())
    return dp.task_top_products(by_day, dp.window_days(tb.session_tasks(spark, sf_dir), REGISTERED_TASK_ID),
                                tb.city_info(spark, sf_dir), tb.product_info(spark, sf_dir), TOP_N,
                                at.TESTDATA_AREA_LEVELS)


# The registered arrivals of visit actions: before and from this time.
ARRIVAL_SPLIT = "2024-01-16 12:00:00"


def area_counts_incremental(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Visit actions land in two arrivals, each counted once as it lands; the merged counts."""
    ensure_utc(spark)
    folder = new_run_dir(spark, "area_partials")
    actions = tb.user_visit_action(spark, sf_dir)
    early = F.col("action_time") < F.lit(ARRIVAL_SPLIT).cast(actions.schema["action_time"].dataType)
    kept = AreaPartials(spark, folder, START, END)
    for arrival in (actions.where(early), actions.where(~early | early.isNull())):
        arrival.write.mode("append").parquet(f"{folder}/landed")
        kept.absorb(spark.read.parquet(f"{folder}/landed"), tb.city_info(spark, sf_dir))
    return kept.area_product_clicks()


def bucketed_actions(spark: SparkSession, sf_dir: str, folder: str, buckets: int | None = None) -> DataFrame:
    """Line-item actions from line items and orders kept bucketed by order key; as many buckets
    as shuffle partitions unless told otherwise."""
    buckets = buckets or int(spark.conf.get("spark.sql.shuffle.partitions"))
    li = keep_bucketed(tb.line_items(spark, sf_dir), "l_orderkey", f"{folder}/line_items", buckets)
    orders = keep_bucketed(tb.order_cities(spark, sf_dir), "o_orderkey", f"{folder}/order_cities", buckets)
    return tb.line_actions(li, orders)


def area_top10_bucketed(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The Top-N over line-item actions whose large join needs no exchange."""
    ensure_utc(spark)
    actions = bucketed_actions(spark, sf_dir, new_run_dir(spark, "bucketed"))
    return at.area_top_products(actions, tb.city_info(spark, sf_dir), tb.product_info(spark, sf_dir),
                                BIG_START, BIG_END, TOP_N, at.TESTDATA_AREA_LEVELS)
