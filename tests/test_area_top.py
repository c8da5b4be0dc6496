"""Area Top-N on hand-made reference-shaped tables (FIXTURES.md section 1)."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import functions as F

from footfall.operators import area_top as at
from footfall.plans import area_jobs

T = dt.datetime


def _tables(spark):
    cities = spark.createDataFrame([
        (1, "上海", "华东"), (11, "上海", "华东"), (2, "北京", "华北"), (3, "广州", "华南"),
        (4, "成都", "西南"), (5, "沈阳", "东北"), (6, "台北", "台湾"),
    ], "city_id long, city_name string, area string")
    products = spark.createDataFrame(
        [(i, f"p{i}", '{"product_status":%d}' % (i % 2)) for i in range(1, 30)]
        + [(100, "p100", None), (101, "p101", '{"x":1}'), (102, "p102", "{bad"),
           (103, "p103", '{"product_status":"abc"}'), (104, "p104", '{"product_status":"0"}')],
        "product_id long, product_name string, extend_info string")
    start, end = T(2016, 8, 1), T(2016, 8, 30)
    rows = []
    # click-id spellings: only real ids survive
    for pid in [None, "null", "NULL", "Null", "abc"]:
        rows.append((2, pid, T(2016, 8, 10)))
    # boundaries: both ends inclusive, one second outside each dropped
    rows += [(2, "1", start), (2, "1", end), (2, "1", T(2016, 7, 31, 23, 59, 59)),
             (2, "1", T(2016, 8, 30, 0, 0, 1))]
    # unknown city / unknown product
    rows += [(999, "1", T(2016, 8, 10)), (2, "777", T(2016, 8, 10))]
    # 1;上海 and 11;上海 on the same product (exact dedup keeps both)
    rows += [(1, "5", T(2016, 8, 5)), (11, "5", T(2016, 8, 6)), (11, "5", T(2016, 8, 7))]
    # 华北: 12 products, counts 12..1 -> ranks 10/11 tie broken by product id
    for i, pid in enumerate(range(6, 18)):
        rows += [(2, str(pid), T(2016, 8, 3))] * (14 - i)
    rows += [(2, "18", T(2016, 8, 3))] * 5   # same count as product 15 and 16
    # statuses
    for pid in ["100", "101", "102", "103", "104"]:
        rows.append((3, pid, T(2016, 8, 4)))
    # an area outside the level table
    rows.append((6, "2", T(2016, 8, 4)))
    actions = spark.createDataFrame(rows, "city_id long, click_product_id string, action_time timestamp")
    return actions, cities, products, start, end


def test_click_filter_and_join(spark):
    actions, cities, _, start, end = _tables(spark)
    clicks = at.click_actions(actions, str(start), str(end))
    pids = sorted(r.product_id for r in clicks.collect() if r.product_id is not None)
    # 'Null' and 'abc' pass the text filter; 'abc' becomes NULL
    assert clicks.where(F.col("product_id").isNull()).count() == 2
    assert pids.count(1) == 3   # start, end, unknown city; not the two outside
    joined = at.join_city(clicks, cities)
    assert joined.where("city_id = 999").count() == 0


def test_area_product_counts_exact_city_list(spark):
    actions, cities, _, start, end = _tables(spark)
    counts = at.area_product_clicks(at.join_city(at.click_actions(actions, str(start), str(end)), cities))
    row = counts.where("area = '华东' AND product_id = 5").first()
    assert row.click_count == 3
    assert row.city_infos == "11;上海,1;上海"


def test_top_n_labels_levels_and_ties(spark):
    actions, cities, products, start, end = _tables(spark)
    top = at.area_top_products(actions, cities, products, str(start), str(end), n=10)
    assert top.columns == at.TOP_N_COLUMNS
    rows = top.collect()
    north = [r for r in rows if r.area == "华北"]
    assert len(north) == 10
    ranked = sorted(north, key=lambda r: (-r.click_count, r.product_id))
    assert [r.product_id for r in ranked] == [6, 7, 8, 9, 10, 11, 12, 13, 14, 15]
    assert all(r.area_level == "A级" for r in north)
    south = {r.product_id: r for r in rows if r.area == "华南"}
    assert south[100].product_status == at.THIRD_PARTY     # NULL JSON
    assert south[101].product_status == at.THIRD_PARTY     # field missing
    assert south[102].product_status == at.THIRD_PARTY     # malformed
    assert south[103].product_status == at.THIRD_PARTY     # not a number
    assert south[104].product_status == at.SELF_OPERATED   # "0"
    assert all(r.area_level == "B级" for r in south.values())
    other = [r for r in rows if r.area == "台湾"]
    assert [r.area_level for r in other] == ["E级"]
    # unknown product 777 never appears
    assert all(r.product_id != 777 for r in rows)


def test_click_count_conservation(spark):
    actions, cities, products, start, end = _tables(spark)
    basic = at.join_city(at.click_actions(actions, str(start), str(end)), cities)
    counts = at.area_product_clicks(basic)
    assert counts.agg(F.sum("click_count")).first()[0] == basic.count()


def test_top_n_plan_limits_before_shuffle(spark):
    df = area_jobs.area_top10_product(spark, "/root/testdata/sf0.001")
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert "WindowGroupLimit" in plan
    # the date range reaches the parquet scan of events
    assert "GreaterThanOrEqual(ts," in plan and "LessThanOrEqual(ts," in plan


def test_persist_is_idempotent(spark, run_dir):
    sf = "/root/testdata/sf0.001"
    res = area_jobs.area_top10_product(spark, sf)
    path = f"{run_dir}/area_top"
    area_jobs.persist_top_n(res, 7, path)
    area_jobs.persist_top_n(res, 7, path)        # re-run: replaced, not duplicated
    area_jobs.persist_top_n(res.limit(3), 8, path)
    back = area_jobs.read_persisted(spark, path, 7)
    assert back.count() == res.count()
    assert area_jobs.read_persisted(spark, path, 8).count() == 3


def test_task_driven_run(spark, run_dir):
    sf = "/root/testdata/sf0.001"
    tasks = area_jobs.tb.tasks(spark, sf)
    task_id = tasks.where("create_time >= '1996-01-01'").select("task_id").orderBy("task_id").first()[0]
    start, end = area_jobs.task_window(tasks, task_id)
    assert start and end and start < end
    out = area_jobs.run_task(spark, sf, task_id, f"{run_dir}/tasks", source="lineitem")
    assert out.columns[0] == "task_id"
    assert out.count() > 0
    assert out.where(F.col("task_id") != task_id).count() == 0
    # the events month lies outside this task's window: empty, still readable
    empty = area_jobs.run_task(spark, sf, task_id, f"{run_dir}/tasks_ev", source="events")
    assert empty.count() == 0


from hypothesis import given, settings  # noqa: E402
from hypothesis import strategies as st  # noqa: E402


@settings(max_examples=12, deadline=None)
@given(st.lists(st.tuples(st.sampled_from(["华北", "华东", "西北"]), st.integers(1, 12),
                          st.integers(1, 6)), min_size=1, max_size=60),
       st.integers(1, 4))
def test_top_n_properties(spark, rows, n):
    counts = spark.createDataFrame(rows, "area string, product_id long, click_count long") \
        .dropDuplicates(["area", "product_id"])
    top = at.top_n_per_area(counts, n).collect()
    full = counts.collect()
    for area in {r.area for r in full}:
        mine = sorted(((r.click_count, -r.product_id) for r in top if r.area == area), reverse=True)
        want = sorted(((r.click_count, -r.product_id) for r in full if r.area == area), reverse=True)[:n]
        assert mine == want


@settings(max_examples=10, deadline=None)
@given(st.lists(st.integers(0, 9), max_size=40), st.lists(st.integers(0, 9), max_size=10))
def test_anti_join_never_grows(spark, users, listed):
    from footfall.operators.ad_click import drop_blacklisted

    clicks = spark.createDataFrame([(u,) for u in users], "user_id long")
    bl = spark.createDataFrame([(u,) for u in listed], "user_id long")
    kept = [r.user_id for r in drop_blacklisted(clicks, bl).collect()]
    assert sorted(kept) == sorted(u for u in users if u not in set(listed))


def test_reference_shaped_catalog_run(spark, run_dir):
    actions, cities, products, start, end = _tables(spark)
    actions.createOrReplaceTempView("user_visit_action")
    cities.createOrReplaceTempView("city_info")
    products.createOrReplaceTempView("product_info")
    spark.createDataFrame(
        [(5, '{"startDate":["2016-08-01 00:00:00"],"endDate":["2016-08-30 00:00:00"]}')],
        "task_id long, task_param string").createOrReplaceTempView("task")
    from footfall.plans.cli import main

    assert main(["area-top", "5", "--catalog", "--out", f"{run_dir}/top", "--profile", "local"]) == 0
    out = area_jobs.read_persisted(spark, f"{run_dir}/top", 5).collect()
    want = at.area_top_products(actions, cities, products, str(start), str(end)).collect()
    assert sorted(tuple(r)[1:] for r in out) == sorted(map(tuple, want))
    assert {r.area_level for r in out if r.area == "华东"} == {"A级"}
