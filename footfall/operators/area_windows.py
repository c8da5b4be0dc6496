"""Area Top-N of all tasks in one pass (SRC7, FIL2, AG1, AG2, WN1).

Tasks differ in their date window only, and windows overlap, so the clicks are counted
once per (day, area, product, city) and no click is joined with a task:

* Windows of one length slide over the days. A day's count enters the window that
  ends with it and leaves the one that starts behind it; the running sum of these changes,
  per (length, area, product), is the count of each window as a step function of its
  start. Its steps are met only with starts that some task has, and spread over those
  alone at which fewer than N products of the area have a larger count for certain.
* The Top-N of each (window, area) is cut before the shuffle by window.
* City lists are made for the rows of the Top-N alone, from the daily counts of their
  days.
* Tasks join last, on their window; equal windows are computed once.

Days are numbered twice: 2 * day stands for its first instant and 2 * day + 1 for
the rest. A window from one bare date to another, both inclusive, holds the first
instant of its last day and no more of it, as in the job that runs one task.

Bounds are bare dates; another text is an error. A task without a bound, or whose end lies
before its start, has no rows; a task id that occurs twice has its rows twice.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from footfall.functions.aggregates import group_concat_distinct
from footfall.functions.columns import concat_long_string, task_param
from footfall.operators import area_top as at

# Counts up to here have a level of their own.
FINE = 64


def _day(text: Column) -> Column:
    bare = text.rlike(r"^\d{4}-\d{2}-\d{2}$")
    wrong = F.raise_error(F.concat(F.lit("a task bound is no date: "), text))
    return F.when(text.isNull(), F.lit(None).cast("int")).when(bare, F.unix_date(F.to_date(text))).otherwise(wrong)


def task_windows(tasks: DataFrame) -> DataFrame:
    """task_id, first, last: the days of each task that has a window."""
    return tasks.select("task_id", _day(task_param("task_param", "startDate")).alias("first"),
                        _day(task_param("task_param", "endDate")).alias("last")).where("first <= last")


def instant(time: Column) -> Column:
    """2 * day for the first instant of a day, 2 * day + 1 for any other."""
    day = F.to_date(time)
    return F.unix_date(day) * 2 + (time != day.cast("timestamp_ntz")).cast("int")


def daily_clicks(actions: DataFrame, cities: DataFrame, products: DataFrame) -> DataFrame:
    """half (see ``instant``), area, product_id, city_id, city_name, n: usable clicks of known
    cities and products, counted once for all windows."""
    clicks = actions.where(at.usable_click()).select(
        F.col("city_id").cast("bigint").alias("city_id"),
        F.col("click_product_id").try_cast("bigint").alias("product_id"),
        instant(F.col("action_time").cast("timestamp_ntz")).alias("half"))
    placed = clicks.join(cities.select(F.col("city_id").cast("bigint").alias("city_id"), "city_name", "area"), "city_id")
    counted = placed.groupBy("half", "area", "product_id", "city_id", "city_name").agg(F.count(F.lit(1)).alias("n"))
    known = products.select(F.col("product_id").cast("bigint").alias("product_id"))
    return counted.join(known, "product_id", "left_semi")


def window_steps(daily: DataFrame, windows: DataFrame) -> DataFrame:
    """span, area, product_id, click_count, low, high: the windows of length ``span`` that start
    from day ``low`` to day ``high`` have ``click_count`` clicks; ``base`` is the first start that
    a task has, and ``days`` how many there are up to the last. The distinct lengths, at most one for each day of the
    longest window, are read to the driver."""
    spans = windows.select((F.col("last") - F.col("first")).alias("span"), "first")
    edge = spans.groupBy("span").agg(F.min("first").alias("base"), F.max("first").alias("end")).collect()
    lengths = F.array(*[F.struct(F.lit(r.span).alias("span"), F.lit(r.base).alias("base"), F.lit(r.end).alias("end"))
                        for r in edge]).cast("array<struct<span: int, base: int, end: int>>")
    counts = daily.groupBy("half", "area", "product_id").agg(F.sum("n").alias("n"))
    each = counts.select("half", "area", "product_id", "n", F.inline(lengths))
    changes = each.select(
        "span", "base", "end", "area", "product_id",
        F.inline(F.array(F.struct((F.col("half") - 2 * F.col("span")).alias("start"), F.col("n").alias("change")),
                         F.struct((F.col("half") + 1).alias("start"), (-F.col("n")).alias("change")))))
    key = ["span", "base", "end", "area", "product_id"]
    by_start = Window.partitionBy(*key).orderBy("start")
    steps = (changes.groupBy(*key, "start").agg(F.sum("change").alias("change"))
             .select(*key, F.col("start"), F.lead("start").over(by_start).alias("until"),
                     F.sum("change").over(by_start).alias("click_count"))
             .where("click_count > 0"))
    # the days on which a window of this step can start
    low = F.greatest(F.ceil(F.col("start") / 2).cast("int"), F.col("base"))
    high = F.least(F.floor((F.col("until") - 1) / 2).cast("int"), F.col("end"))
    return steps.select("span", "base", (F.col("end") - F.col("base") + 1).alias("days"), "area", "product_id",
                        "click_count", low.alias("low"), high.alias("high")).where("low <= high")


def least_counts(steps: DataFrame, n: int) -> DataFrame:
    """span, area and ``least``: for each start from ``base`` on, a count that ``n`` products of the
    window reach, so that products below it are not among its Top-N (1 where there are fewer).
    Steps are counted by level (counts up to ``FINE``, powers of two beyond), never spread over
    their days; there is a row for each length and area."""
    count = F.col("click_count")
    level = F.when(count <= FINE, count).otherwise(F.expr("shiftleft(1L, int(floor(log2(click_count + 0.5D))))"))
    marks = steps.select("span", "base", "days", "area", level.cast("bigint").alias("level"), F.inline(F.array(
        F.struct(F.col("low").alias("day"), F.lit(1).alias("change")),
        F.struct((F.col("high") + 1).alias("day"), F.lit(-1).alias("change")))))
    key = ["span", "base", "days", "area"]
    by_day = Window.partitionBy(*key, "level").orderBy("day")
    held = (marks.groupBy(*key, "level", "day").agg(F.sum("change").alias("change"))
            .select(*key, "level", "day", F.lead("day").over(by_day).alias("until"), F.sum("change").over(by_day).alias("held"))
            .where("held > 0").select(*key, "level", "held", F.explode(F.sequence("day", F.col("until") - 1)).alias("day")))
    above = F.sum("held").over(Window.partitionBy(*key, "day").orderBy(F.col("level").desc()))
    reached = (held.withColumn("above", above).where(F.col("above") >= n)
               .groupBy(*key, "day").agg(F.max("level").alias("level")))
    of_day = F.map_from_entries(F.collect_list(F.struct("day", "level")))
    return (reached.groupBy(*key).agg(of_day.alias("of_day")).select("span", "area", F.transform(
        F.sequence(F.lit(0), F.col("days") - 1), lambda i: F.coalesce(F.try_element_at("of_day", F.col("base") + i), F.lit(1))).alias("least")))


def window_counts(daily: DataFrame, windows: DataFrame, n: int) -> DataFrame:
    """first, last, area, product_id, click_count of each distinct window (first, last) with
    clicks: of the products that can be among its ``n`` largest."""
    steps = window_steps(daily, windows)
    # a row for each length and area, an entry for each start
    steps = steps.join(F.broadcast(least_counts(steps, n)), ["span", "area"], "left")
    least = F.array_min(F.slice("least", F.col("low") - F.col("base") + 1, F.col("high") - F.col("low") + 1))
    some = steps.where(F.col("click_count") >= F.coalesce(least, F.lit(1)))
    starts = some.select("span", "area", "product_id", "click_count", F.explode(F.filter(
        F.sequence("low", "high"),
        lambda d: F.col("click_count") >= F.coalesce(F.get("least", d - F.col("base")), F.lit(1)))).alias("first"))
    wanted = windows.select("first", "last").distinct().withColumn("span", F.col("last") - F.col("first"))
    return starts.join(wanted, ["span", "first"]).select("first", "last", "area", "product_id", "click_count")


def top_of_windows(counts: DataFrame, n: int) -> DataFrame:
    """WN1 for each (window, area); ties by product id."""
    order = Window.partitionBy("first", "last", "area").orderBy(F.col("click_count").desc(), F.col("product_id"))
    return counts.withColumn("rn", F.row_number().over(order)).where(F.col("rn") <= n).drop("rn")


def with_cities(top: DataFrame, daily: DataFrame) -> DataFrame:
    """AG2 for the rows of the Top-N: the cities with clicks inside the window."""
    key = ["first", "last", "area", "product_id"]
    days = top.select(*key, F.explode(F.sequence("first", "last")).alias("day"))
    labels = daily.select(F.floor(F.col("half") / 2).cast("int").alias("day"), "half", "area", "product_id",
                          concat_long_string("city_id", "city_name", ";").alias("label"))
    lists = (days.join(labels, ["day", "area", "product_id"]).where("half <= 2 * last")
             .groupBy(*key).agg(group_concat_distinct("label").alias("city_infos")))
    return top.join(lists, key)


def all_tasks_top(tasks: DataFrame, daily: DataFrame, products: DataFrame, n: int = 10,
                  levels: dict[str, str] = at.REFERENCE_AREA_LEVELS) -> DataFrame:
    """task_id and the columns of the Top-N job for every task. ``daily`` is read several
    times and should be stored."""
    windows = task_windows(tasks)
    top = with_cities(top_of_windows(window_counts(daily, windows, n), n), daily)
    full = products.select(F.col("product_id").cast("bigint").alias("product_id"), "product_name",
                           at.product_status_label(F.col("extend_info")).alias("product_status"))
    rows = at.with_area_level(top.join(full, "product_id"), levels)
    return windows.join(rows, ["first", "last"]).select("task_id", *at.TOP_N_COLUMNS)
