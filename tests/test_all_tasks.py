"""All tasks in one pass against the jobs that run one task."""

from __future__ import annotations

import datetime as dt
import json
import random

import pytest
from pyspark.sql import functions as F

from footfall.operators import area_top as at
from footfall.operators import area_windows as aw
from footfall.operators import filter_index as fi
from footfall.operators import sessions as ss
from footfall.plans import session_jobs as sj

START = dt.datetime(2024, 1, 1)


def _tasks(spark, params):
    return spark.createDataFrame([(i, json.dumps(p)) for i, p in enumerate(params)], "task_id long, task_param string")


def _days(first, last):
    return {"startDate": [f"{START + dt.timedelta(first):%Y-%m-%d}"], "endDate": [f"{START + dt.timedelta(last):%Y-%m-%d}"]}


def _area_tables(spark, n=1500):
    rng = random.Random(5)
    times = [START + dt.timedelta(days=rng.randrange(25), seconds=rng.choice([0, 0, 1, 40_000])) for _ in range(n)]
    # one product holds a third of all clicks; some ids are unknown, texts or missing
    ids = ["1"] * (n // 3) + [rng.choice(["1", "2", "3", "4", "5", "9", "x", "null", "NULL", None]) for _ in range(n)]
    actions = spark.createDataFrame([(1, t, rng.randrange(7), p) for t, p in zip(times, ids, strict=False)],
                                    "user_id long, action_time timestamp_ntz, city_id long, click_product_id string")
    cities = spark.createDataFrame([(i, f"c{i}", "ASIA" if i % 2 else "AFRICA") for i in range(6)],
                                   "city_id long, city_name string, area string")
    products = spark.createDataFrame([(i, f"p{i}", json.dumps({"product_status": i % 2})) for i in range(1, 7)],
                                     "product_id long, product_name string, extend_info string")
    return actions, cities, products


@pytest.mark.parametrize("n", [2, 10])
def test_windows_equal_single_task_runs(spark, n):
    actions, cities, products = _area_tables(spark)
    windows = [(0, 4), (0, 4), (3, 3), (-5, 40), (10, 14), (11, 15), (24, 30), (30, 33), (7, 20), (20, 7)]
    tasks = _tasks(spark, [_days(*w) for w in windows] + [{"startDate": ["2024-01-01"]}, {}])
    daily = aw.daily_clicks(actions, cities, products).cache()
    got = aw.all_tasks_top(tasks, daily, products, n, at.TESTDATA_AREA_LEVELS).collect()
    for i, (first, last) in enumerate(windows):
        day = [_days(first, last)[k][0] for k in ("startDate", "endDate")]
        alone = at.area_top_products(actions, cities, products, *day, n, at.TESTDATA_AREA_LEVELS).collect()
        assert sorted(tuple(r)[1:] for r in got if r.task_id == i) == sorted(map(tuple, alone)), windows[i]
    assert not [r for r in got if r.task_id >= len(windows)]


def test_a_bound_that_is_no_date_is_an_error(spark):
    tasks = _tasks(spark, [{"startDate": ["2024-01-01 10:00:00"], "endDate": ["2024-01-02"]}])
    with pytest.raises(Exception, match="is no date"):
        aw.task_windows(tasks).collect()


def test_no_tasks_no_rows(spark):
    actions, cities, products = _area_tables(spark, 30)
    daily = aw.daily_clicks(actions, cities, products)
    assert aw.all_tasks_top(_tasks(spark, [{}]), daily, products).count() == 0


def test_no_click_is_joined_with_a_task(spark, run_dir):
    actions, cities, products = _area_tables(spark, 200)
    aw.daily_clicks(actions, cities, products).write.parquet(run_dir)
    out = aw.all_tasks_top(_tasks(spark, [_days(0, 3)]), spark.read.parquet(run_dir), products)
    plan = out._jdf.queryExecution().optimizedPlan().toString()
    assert "Cross" not in plan and "click_product_id" not in plan
    physical = out._jdf.queryExecution().executedPlan().toString()
    assert "NestedLoop" not in physical and "Cartesian" not in physical
    assert "WindowGroupLimit" in physical


PARAMS = [
    {}, {"startAge": ["20"]}, {"startAge": ["20"], "endAge": ["30"]}, {"startAge": ["x"], "endAge": ["30"]},
    {"startAge": ["40"], "endAge": ["20"]}, {"startAge": ["-5"], "endAge": ["99999999999"]},
    {"professionals": ["dev,ops"]}, {"professionals": [","]}, {"cities": ["Rome"], "sex": ["male"]},
    {"keywords": ["click"]}, {"keywords": ["nothing"]}, {"keywords": ["view,buy"], "categoryIds": ["3,5"]},
    {"categoryIds": ["1"], "professionals": ["ops"], "startAge": ["18"], "endAge": ["25"], "sex": ["female"]},
    {"professionals": ["dev,,ops"], "cities": ["Rome,Oslo,Rome"]}, {"sex": ["none"]},
]


def _session_tables(spark):
    rng = random.Random(11)
    users = [(i, rng.choice([18, 20, 25, 30, 31, None]), rng.choice(["dev", "ops", "law", None, ""]),
              rng.choice(["Rome", "Oslo", None]), rng.choice(["male", "female", None])) for i in range(40)]
    rows = [(rng.randrange(45), START + dt.timedelta(days=rng.randrange(6), seconds=rng.choice([0, 0, 3, 90, 4000, 80_000])),
             rng.choice(["click", "click", "view", "buy"]), rng.choice([1, 2, 3, 5, None])) for _ in range(900)]
    return (spark.createDataFrame(rows, "user_id long, action_time timestamp_ntz, action_type string, category_id long"),
            spark.createDataFrame(users, "user_id long, age int, professional string, city string, sex string"))


def test_filters_equal_single_task_runs(spark, run_dir):
    actions, users = _session_tables(spark)
    windows = [(1, 3), (2, 2)]
    params = [(p, w) for p in PARAMS for w in windows]
    tasks = _tasks(spark, [p | _days(*w) for p, w in params])
    sj.session_classes(actions, users).write.parquet(run_dir)
    got = {r.task_id: tuple(r)[1:] for r in fi.all_tasks_stat(fi.filter_specs(tasks).cache(), spark.read.parquet(run_dir)).collect()}
    at_time = F.col("action_time")
    every = {}
    for w in windows:
        first, last = (F.lit(_days(*w)[k][0]).cast("timestamp_ntz") for k in ("startDate", "endDate"))
        every[w] = sj.day_facts(actions.where((at_time >= first) & (at_time <= last))).join(users, "user_id").cache()
    bags = {r.task_id: r.bag for r in tasks.select("task_id", ss.fc.task_params_bag(
        "task_param", ss.FILTER_PARAM_NAMES).alias("bag")).collect()}
    wanted = None
    for i, (_, w) in enumerate(params):
        user, activity = ss.typed_conditions(bags[i])
        one = ss.aggr_stat(every[w].where(user & activity)).withColumn("task_id", F.lit(i))
        wanted = one if wanted is None else wanted.unionByName(one)
    wanted = {r.task_id: tuple(r[c] for c in ss.AGGR_STAT_COLUMNS) for r in wanted.collect()}
    assert got == wanted
    assert sum(v[0] > 0 for v in got.values()) > len(got) / 3


def test_filters_join_by_key_only(spark, run_dir):
    actions, users = _session_tables(spark)
    sj.session_classes(actions, users).write.parquet(run_dir)
    out = fi.all_tasks_stat(fi.filter_specs(_tasks(spark, [PARAMS[2] | _days(0, 3)])).cache(),
                            spark.read.parquet(run_dir))
    plan = out._jdf.queryExecution().executedPlan().toString()
    assert "NestedLoop" not in plan and "Cartesian" not in plan


def test_points_inside_ranges(spark):
    points = spark.createDataFrame([(x,) for x in (1, 3, 5, 9)], "value long")
    ranges = spark.createDataFrame([("a", 0, 10), ("b", 3, 5), ("c", 4, 4), ("d", 9, 9), ("e", 5, 3), ("f", 10, 20)],
                                   "name string, low long, high long")
    got = fi.points_inside(points, ranges, ["name"]).collect()
    assert sorted(map(tuple, got)) == [("a", 1), ("a", 3), ("a", 5), ("a", 9), ("b", 3), ("b", 5), ("d", 9)]


def test_a_user_filter_sums_over_keys_not_classes(spark):
    """A filter asks for a key per listed value, a class is counted under eight keys at most."""
    tasks = _tasks(spark, [p | _days(0, 3) for p in (
        {"professionals": ["dev,,ops,dev"], "cities": ["Rome"]}, {"sex": ["male"], "startAge": ["20"], "endAge": ["30"]},
        {"professionals": [","]})])
    specs = fi.filter_specs(tasks).withColumn("u", F.col("user")).withColumn("a", F.col("activity"))
    asked = fi.asked_keys(specs.select("user", "activity", "u", "a").distinct()).collect()
    assert sorted((r.low, r.high, r.professional, r.city, r.sex) for r in asked if r.low is None) == [
        (None, None, "=dev", "=Rome", "*"), (None, None, "=ops", "=Rome", "*")]
    assert [(r.low, r.high, r.professional, r.city, r.sex) for r in asked if r.low] == [(20, 30, "*", "*", "=male")]
    classes = spark.createDataFrame(
        [(0, True, 20 + i % 3, "dev", f"c{i}", None if i % 2 else "male", "click", None, 1, 0, 2) for i in range(50)],
        "day int, whole boolean, age int, professional string, city string, sex string, search_keywords string, "
        "click_category_ids string, visit int, step int, n long")
    keyed = fi.keyed_classes(classes).where("professional = '=dev' and city = '*'").groupBy("sex").agg(F.sum("n")).collect()
    assert sorted(map(tuple, keyed)) == [("*", 100), ("=male", 50)]


def test_only_products_that_can_be_on_top_are_spread_over_their_windows(spark):
    """Of a window with many products clicked once and three clicked twice or more, a Top-2 needs the three."""
    rows = [(2 * 19_700 + 1, "ASIA", p, 1, "c1", 1) for p in range(100, 400)]
    rows += [(2 * 19_700 + 1, "ASIA", p, 1, "c1", p) for p in (2, 3, 70, 80)] + [(2 * 19_800 + 1, "ASIA", 9, 1, "c1", 1)]
    daily = spark.createDataFrame(rows, "half int, area string, product_id long, city_id long, city_name string, n long")
    windows = spark.createDataFrame([(i, f, f + 5) for i, f in enumerate((19_698, 19_699, 19_797, 19_900))],
                                    "task_id long, first int, last int")
    got = sorted(tuple(r) for r in aw.window_counts(daily, windows, 2).collect())
    assert got == [(19_698, 19_703, "ASIA", 70, 70), (19_698, 19_703, "ASIA", 80, 80),
                   (19_699, 19_704, "ASIA", 70, 70), (19_699, 19_704, "ASIA", 80, 80), (19_797, 19_802, "ASIA", 9, 1)]
    assert aw.window_counts(daily, windows, 400).count() == 2 * 304 + 1
