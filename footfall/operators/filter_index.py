"""Session statistics of all filter tasks in one pass (FIL4 to FIL7, AG8).

Instead of holding every session against every task, both sides are reduced and meet
through an inverted index of conditions:

* Sessions that agree in what filters look at and in their statistics buckets form classes
  (age, professional, city, sex, keyword and category lists, by day) with their number.
* A task is a user filter, an activity filter and a date window; equal ones are
  kept once. An activity filter is a number of conditions, each with the elements that satisfy it;
  elements join the classes of lists, and a class passes if the conditions met are as many as
  the filter has. Absent parameters are no conditions, so they accept; a filter
  without any has the one condition that all classes meet.
* A user filter sums over keys (professional, city, sex): one for each of its listed values, and
  ``ANY`` where it has no condition. Classes are counted under the keys they fall in (at most
  eight), for each activity filter that they pass; so filters join counts by key and no filter
  meets a class of sessions.
* The age range is tested on the counts of a key (at most one for each age, day and bucket), the
  window on the counts per day of a pair of filters; both are bounded by the days and
  ages there are, not by sessions.

The rules are those of ``sessions.typed_conditions``: a range needs two whole
bounds, a missing or empty value rejects, and a list parameter without elements rejects all.
A session is a user's actions of a day inside the task's window; a window that ends with
a bare date holds the first instant of that day, so such first instants are kept as classes
of their own. Bounds that are no bare dates are an error; a task without them has no row.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from footfall.functions import columns as fc
from footfall.operators import sessions as ss
from footfall.operators.area_windows import task_windows

USER, ACTIVITY = ["age", "professional", "city", "sex"], ["search_keywords", "click_category_ids"]
KEY, ANY = ["professional", "city", "sex"], "*"
BUCKETS = [name for name, _, _ in ss.VISIT_BUCKETS + ss.STEP_BUCKETS]


def points_inside(points: DataFrame, ranges: DataFrame, keys: list[str]) -> DataFrame:
    """``keys`` and ``value`` for each of the distinct ``points`` (value) inside each of the
    ``ranges`` (keys, low, high).

    Bounds and points are swept in order of value, which gives each point its rank, and each
    bound the first rank not below it or the last not above it. The sweep is over
    distinct values, never over rows of a table."""
    marks = (points.select("value", F.lit(1).alias("kind"))
             .unionByName(ranges.select(F.col("low").alias("value"), F.lit(0).alias("kind")).distinct())
             .unionByName(ranges.select(F.col("high").alias("value"), F.lit(2).alias("kind")).distinct()))
    # a lower bound comes before a point of its value, an upper one behind it
    swept = marks.withColumn("rank", F.sum((F.col("kind") == 1).cast("int")).over(
        Window.orderBy("value", "kind").rowsBetween(Window.unboundedPreceding, 0)))
    low = swept.where("kind = 0").select(F.col("value").alias("low"), (F.col("rank") + 1).alias("from"))
    high = swept.where("kind = 2").select(F.col("value").alias("high"), F.col("rank").alias("to"))
    ranked = swept.where("kind = 1").select("rank", "value")
    spread = ranges.join(low, "low").join(high, "high").where(F.col("from") <= F.col("to")).select(
        *keys, F.explode(F.sequence("from", "to")).alias("rank"))
    return spread.join(ranked, "rank").select(*keys, "value")


def _bucket(c: str, buckets: list, closed: bool) -> Column:
    """The number of the bucket that holds ``c``, null if none does."""
    x = F.col(c)
    return F.coalesce(*[F.when((x >= low) if high is None else
                               (x >= low) & ((x <= high) if closed else (x < high)), F.lit(i))
                        for i, (_, low, high) in enumerate(buckets)])


def class_counts(facts: DataFrame, users: DataFrame) -> DataFrame:
    """day, whole (false: first instants alone), the attributes, visit and step (numbers of the
    buckets, which exclude each other) and n, the sessions. ``facts`` has a row for each user and
    day, with ``whole``."""
    return (facts.withColumn("visit", _bucket("visit_length", ss.VISIT_BUCKETS, False))
            .withColumn("step", _bucket("step_length", ss.STEP_BUCKETS, True)).join(users, "user_id")
            .groupBy("day", "whole", *USER, *ACTIVITY, "visit", "step").agg(F.count(F.lit(1)).alias("n")))


def filter_specs(tasks: DataFrame) -> DataFrame:
    """task_id, first, last (days), user and activity: the parameters of each task, by name; null
    if absent."""
    bag = fc.task_params_bag("task_param", ss.FILTER_PARAM_NAMES)
    got = tasks.select("task_id", "task_param", bag.alias("bag"))

    def whole(field: str) -> Column:
        text = F.trim(fc.bag_get(F.col("bag"), field))
        return F.when(text.rlike(r"^[+-]?\d+$"), text.try_cast("bigint"))

    def listed(field: str) -> Column:
        return fc.split_list(fc.bag_get(F.col("bag"), field))

    low, high = whole(ss.PARAM_START_AGE), whole(ss.PARAM_END_AGE)
    ranged = low.isNotNull() & high.isNotNull()
    user = F.struct(F.when(ranged, low).alias("low"), F.when(ranged, high).alias("high"),
                    listed(ss.PARAM_PROFESSIONALS).alias("professional"), listed(ss.PARAM_CITIES).alias("city"),
                    fc.bag_get(F.col("bag"), ss.PARAM_SEX).alias("sex"))
    activity = F.struct(listed(ss.PARAM_KEYWORDS).alias("search_keywords"),
                        listed(ss.PARAM_CATEGORY_IDS).alias("click_category_ids"))
    params = got.select("task_id", F.to_json(user, {"ignoreNullFields": "false"}).alias("user"),
                        F.to_json(activity, {"ignoreNullFields": "false"}).alias("activity"))
    return task_windows(tasks).join(params, "task_id")


def _pair(field: str, value: Column) -> Column:
    return F.struct(F.lit(field).alias("field"), value.cast("string").alias("value"))


def _hash(name: str) -> Column:
    """Stands for the text of a filter in joins and groups."""
    return F.unhex(F.sha2(name, 256))


def _value_key(value: Column) -> Column:
    return F.concat(F.lit("="), value)


def asked_keys(pairs: DataFrame) -> DataFrame:
    """u, a, low, high and KEY: a row for each key that the user filter of a pair (user,
    activity, u, a) sums over. A list without elements has no key and so accepts nobody."""
    shape = "struct<low: bigint, high: bigint, professional: array<string>, city: array<string>, sex: string>"

    def listed(field: str) -> Column:
        values = F.filter(F.array_distinct(f"p.{field}"), lambda x: x != "")
        return F.when(F.col(f"p.{field}").isNull(), F.array(F.lit(ANY))).otherwise(F.transform(values, _value_key))

    return (pairs.withColumn("p", F.from_json("user", shape))
            .select("u", "a", "p.low", "p.high", F.explode(listed("professional")).alias("professional"),
                    listed("city").alias("city"), F.coalesce(_value_key(F.col("p.sex")), F.lit(ANY)).alias("sex"))
            .select("u", "a", "low", "high", "professional", F.explode("city").alias("city"), "sex"))


def keyed_classes(classes: DataFrame) -> DataFrame:
    """``classes`` counted under each key that they fall in; a missing value has no key but ANY."""
    out = classes
    for c in KEY:
        out = out.withColumn(c, F.explode(F.array_compact(F.array(F.lit(ANY), _value_key(F.col(c))))))
    return out.groupBy(*KEY, "age", "day", "whole", *ACTIVITY, "visit", "step").agg(F.sum("n").alias("n"))


def passing_activities(specs: DataFrame, classes: DataFrame) -> DataFrame:
    """activity (a filter) and the lists of the activity classes that it accepts."""
    shape = "struct<search_keywords: array<string>, click_category_ids: array<string>>"
    filters = specs.select("activity").distinct().withColumn("p", F.from_json("activity", shape))
    number, elements = F.lit(0), None
    for field in ACTIVITY:
        number = number + F.col(f"p.{field}").isNotNull().cast("int")
        more = filters.select("activity", F.lit(field).alias("field"), F.explode(f"p.{field}").alias("value"))
        elements = more if elements is None else elements.unionByName(more)

    def pairs(field: str) -> Column:
        pieces = F.coalesce(fc.split_list(F.nullif(F.col(field), F.lit(""))), F.array().cast("array<string>"))
        return F.transform(pieces, lambda x: _pair(field, x))

    every = F.struct(F.lit("*").alias("field"), F.lit("*").alias("value"))
    wanted = filters.select("activity", number.alias("needed"))
    elements = elements.unionByName(wanted.where("needed = 0").select("activity", F.inline(F.array(every))))
    held = F.concat(*[pairs(field) for field in ACTIVITY], F.array(every))
    of_class = classes.select(*ACTIVITY).distinct().select(*ACTIVITY, F.inline(F.array_distinct(held)))
    field = F.when(F.col("field") == ACTIVITY[0], 1).when(F.col("field") == ACTIVITY[1], 2).otherwise(4)
    met = of_class.join(elements.distinct(), ["field", "value"]).groupBy("activity", *ACTIVITY).agg(
        F.bit_count(F.bit_or(field)).alias("met"))
    return (met.join(wanted, "activity").where(F.col("met") == F.greatest("needed", F.lit(1)))
            .select("activity", *ACTIVITY))


def _eq(a: DataFrame, b: DataFrame, columns: list[str]) -> Column:
    out = F.lit(True)
    for c in columns:
        out = out & a[c].eqNullSafe(b[c])
    return out


def all_tasks_stat(specs: DataFrame, classes: DataFrame) -> DataFrame:
    """task_id and the statistics of the sessions that its filters and window accept; a task
    whom no session suits has a count of 0. Both ``specs`` (of ``filter_specs``) and ``classes`` are
    read several times and should be stored."""
    specs = specs.withColumn("u", _hash("user")).withColumn("a", _hash("activity"))
    asked = asked_keys(specs.select("user", "activity", "u", "a").distinct())
    keyed = keyed_classes(classes).join(asked.select(*KEY).distinct(), KEY, "left_semi")
    activities = passing_activities(specs, classes).withColumn("a", _hash("activity"))
    # dealt as the join below needs them
    counts = (keyed.join(activities, _eq(keyed, activities, ACTIVITY)).select("a", *KEY, "age", "day", "whole", "visit", "step", "n")
              .repartition("a", *KEY)
              .groupBy("a", *KEY, "age", "day", "whole", "visit", "step").agg(F.sum("n").alias("n")))
    of_pair = asked.join(counts, ["a", *KEY]).where("low is null or age between low and high")
    totals = [F.sum("n").alias("session_count")]
    for c, buckets in (("visit", ss.VISIT_BUCKETS), ("step", ss.STEP_BUCKETS)):
        totals += [F.sum(F.when(F.col(c) == i, F.col("n")).otherwise(0)).alias(name) for i, (name, _, _) in enumerate(buckets)]
    days = of_pair.groupBy("u", "a", "day", "whole").agg(*totals)
    # the last day counts with its first instants, the others whole
    met = days.join(specs.select("u", "a", "first", "last").distinct(), ["u", "a"]).where(
        F.col("day").between(F.col("first"), F.col("last")) & (F.col("whole") == (F.col("day") < F.col("last"))))
    stat = met.groupBy("u", "a", "first", "last").agg(*[F.sum(c).alias(c) for c in ("session_count", *BUCKETS)])
    out = specs.join(stat, ["u", "a", "first", "last"], "left")
    n = F.coalesce("session_count", F.lit(0)).cast("bigint")
    return out.select("task_id", n.alias("session_count"),
                      *[fc.ratio_2dp(F.coalesce(c, F.lit(0)), n).alias(c) for c in BUCKETS])
