"""Visit actions in one folder for each day (SRC1 + FIL2 with partition pruning).

The task row is a side of the join: its window, one row for each day, meets the
actions on the day column, so Spark prunes the day folders while the query runs and
the driver looks nothing up.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from footfall.functions.columns import task_param
from footfall.operators import area_top as at

ACTION_SCHEMA = "user_id BIGINT, action_time TIMESTAMP_NTZ, city_id BIGINT, click_product_id STRING, day DATE"


def write_by_day(actions: DataFrame, path: str) -> None:
    """Actions with a time, once, by day. Ranges over (day, user) split a day that holds
    many rows over several tasks, and no task writes more days than its range has."""
    (actions.where("action_time IS NOT NULL")
     .select("user_id", "action_time", "city_id", "click_product_id",
             F.to_date("action_time").alias("day"))
     .repartitionByRange("day", "user_id")
     .write.mode("overwrite").partitionBy("day").parquet(path))


def read_by_day(spark: SparkSession, path: str, time_type: str = "TIMESTAMP_NTZ") -> DataFrame:
    return spark.read.schema(ACTION_SCHEMA.replace("TIMESTAMP_NTZ", time_type)).parquet(path)


def window_days(tasks: DataFrame, task_id: int) -> DataFrame:
    """day, start, end: the days of a task's window, none if the task or one of its dates is
    missing or the window is empty. A task id that occurs twice covers the days of both rows."""
    bounds = tasks.where(F.col("task_id") == F.lit(task_id)).select(
        task_param("task_param", "startDate").cast("timestamp").alias("start"),
        task_param("task_param", "endDate").cast("timestamp").alias("end"))
    days = F.sequence(F.to_date("start"), F.to_date("end"))
    return (bounds.where("start <= end").select("start", "end", F.explode(days).alias("day"))
            .groupBy("day").agg(F.min("start").alias("start"), F.max("end").alias("end")))


def task_clicks(by_day: DataFrame, days: DataFrame) -> DataFrame:
    """FIL1 + FIL2 + PRJ1 of one task over the day folders. ``days`` has one row for each
    day of one window, which bounds what is broadcast."""
    t = F.col("action_time").cast("timestamp")
    return (by_day.where(at.usable_click()).join(F.broadcast(days), "day")
            .where((t >= F.col("start")) & (t <= F.col("end")))
            .select("city_id", F.col("click_product_id").try_cast("bigint").alias("product_id")))


def task_top_products(by_day: DataFrame, days: DataFrame, cities: DataFrame, products: DataFrame,
                      n: int, levels: dict[str, str]) -> DataFrame:
    """The J1 chain over the day folders that the window needs."""
    counts = at.area_product_clicks(at.join_city(task_clicks(by_day, days), cities))
    full = at.with_area_level(at.with_product(counts, products), levels)
    return at.top_n_per_area(full, n).select(*at.TOP_N_COLUMNS)
