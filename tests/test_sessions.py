"""Session filters, buckets and behaviour counts on hand-made rows."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import functions as F

from footfall.operators import sessions as ss

T = dt.datetime


def test_filter_parameter_rules(spark):
    bags = spark.createDataFrame([
        ("s1", "sessionid=s1|age=25|city=上海|sex=female|professional=teacher|searchKeywords=火锅,蛋糕"),
        ("s2", "sessionid=s2|age=45|city=上海|sex=female|professional=teacher"),
        ("s3", "sessionid=s3|city=上海|sex=female"),                 # no age -> rejected by the range
        ("s4", "sessionid=s4|age=30|city=北京|sex=male|professional=cook"),
        ("s5", "sessionid=s5|age=30|city=北京,上海|sex=female|searchKeywords="),
    ], "id string, bag string")

    def kept(params):
        return sorted(r.id for r in ss.session_filter(bags, params).collect())

    assert kept("") == ["s1", "s2", "s3", "s4", "s5"]                 # nothing set: all pass
    assert kept("startAge=20|endAge=40") == ["s1", "s4", "s5"]
    assert kept("startAge=20") == ["s1", "s2", "s3", "s4", "s5"]     # one bound only: ignored
    assert kept("cities=上海,广州") == ["s1", "s2", "s3", "s5"]         # list overlap
    assert kept("sex=female|startAge=20|endAge=40") == ["s1", "s5"]
    assert kept("keywords=蛋糕") == ["s1"]                             # empty value counts as missing
    assert kept("professionals=cook,chef") == ["s4"]


def _sessions(spark, pairs):
    return spark.createDataFrame(pairs, "visit_length long, step_length long")


def test_bucket_edges_and_ratios(spark):
    # visit edges: 0 (none), 1, 3, 4, 1799, 1800; steps 3, 4, 59, 60
    rows = [(0, 1), (1, 3), (3, 4), (4, 59), (1799, 60), (1800, 2)]
    out = ss.aggr_stat(_sessions(spark, rows)).first().asDict()
    assert out["session_count"] == 6
    assert out["visit_length_1s_4s_ratio"] == 0.33       # 2/6
    assert out["visit_length_4s_7s_ratio"] == 0.17       # 1/6 = 0.1666.. -> 0.17
    assert out["visit_length_10m_30m_ratio"] == 0.17
    assert out["visit_length_30m_ratio"] == 0.17
    assert out["step_length_1_3_ratio"] == 0.5
    assert out["step_length_4_6_ratio"] == 0.17
    assert out["step_length_30_59_ratio"] == 0.17
    assert out["step_length_60_ratio"] == 0.17
    assert out["visit_length_7s_10s_ratio"] == 0.0


def test_half_up_on_exact_halves(spark):
    # 1/8 = 0.125 -> 0.13 (HALF_UP), 3/8 = 0.375 -> 0.38
    rows = [(2, 1)] + [(100, 10)] * 7
    out = ss.aggr_stat(_sessions(spark, rows)).first()
    assert out["visit_length_1s_4s_ratio"] == 0.13
    rows = [(2, 1)] * 3 + [(100, 10)] * 5
    assert ss.aggr_stat(_sessions(spark, rows)).first()["visit_length_1s_4s_ratio"] == 0.38


def test_session_facts_and_visit_length(spark):
    acts = spark.createDataFrame([
        (1, T(2024, 1, 1, 10, 0, 0, 900000), "view", 5),
        (1, T(2024, 1, 1, 10, 0, 59, 100000), "click", 7),
        (1, T(2024, 1, 1, 10, 1, 5), "click", 3),
        (1, T(2024, 1, 1, 10, 1, 6), "click", 7),
        (2, T(2024, 1, 1, 9, 0, 0), "purchase", 9),
    ], "user_id long, action_time timestamp, action_type string, category_id long")
    s = ss.with_visit_length(ss.session_facts(acts, ["user_id"]))
    r = {x.user_id: x for x in s.collect()}
    assert r[1].step_length == 4
    assert r[1].search_keywords == "click,view"
    assert r[1].click_category_ids == "3,7"            # numeric order, distinct
    assert r[1].visit_length == 66                       # whole seconds of the truncated times
    assert r[1].multi_second is True
    assert r[2].click_category_ids == "" and r[2].visit_length == 0 and r[2].multi_second is False


def test_hourly_and_category_counts(spark):
    acts = spark.createDataFrame([
        (1, T(2024, 1, 1, 5, 0), "click", 1), (1, T(2024, 1, 1, 5, 30), "order", 1),
        (2, T(2024, 1, 1, 14, 0), "pay", 1), (2, T(2024, 1, 1, 14, 1), "click", 2),
        (2, T(2024, 1, 1, 14, 2), "view", None),
    ], "user_id long, action_time timestamp, action_type string, category_id long")
    hours = {(r.date_hour, r.hour): (r.action_count, r.click_count) for r in ss.hourly_visits(acts).collect()}
    assert hours == {("2024-01-01_05", "05"): (2, 1), ("2024-01-01_14", "14"): (3, 1)}
    cats = {r.category_id: (r.click_count, r.order_count, r.pay_count)
            for r in ss.category_behavior(acts).collect()}
    assert cats == {1: (1, 1, 1), 2: (1, 0, 0)}
    minutes = ss.minutely_visits(acts).agg(F.sum("action_count")).first()[0]
    assert minutes == 5


def test_filter_params_from_task_json(spark):
    tasks = spark.createDataFrame([
        (1, '{"startAge":["20"],"endAge":["40"],"cities":["上海,北京"],"sex":["female"]}'),
        (2, '{"startDate":["2024-01-01"]}'),
    ], "task_id long, task_param string")
    assert ss.filter_params_of_task(tasks, 1) == "startAge=20|endAge=40|cities=上海,北京|sex=female"
    assert ss.filter_params_of_task(tasks, 2) == ""
    assert ss.filter_params_of_task(tasks, 3) == ""


def test_sql_validators_match_dataframe_filter(spark):
    from footfall.plans.sql_surface import register_functions

    register_functions(spark)
    bags = spark.createDataFrame([
        ("s1", "age=25|city=上海|sex=female|searchKeywords=火锅,蛋糕"),
        ("s2", "age=45|city=上海|sex=female"),
        ("s3", "city=北京|sex=male"),
    ], "id string, bag string")
    bags.createOrReplaceTempView("bags_v")
    params = "startAge=20|endAge=40|cities=上海,广州|sex=female"
    sql = spark.sql("""SELECT id FROM bags_v
        WHERE valid_between(bag, 'age', :p, 'startAge', 'endAge')
          AND valid_in(bag, 'city', :p, 'cities') AND valid_equal(bag, 'sex', :p, 'sex')""",
                    args={"p": params})
    assert sorted(r.id for r in sql.collect()) == sorted(r.id for r in ss.session_filter(bags, params).collect()) == ["s1"]


from hypothesis import given, settings  # noqa: E402
from hypothesis import strategies as st  # noqa: E402


def _jsplit(s):
    parts = s.split(",")
    while parts and parts[-1] == "" and s != "":
        parts.pop()
    return parts


def _py_get(bag, field):
    for piece in [p for p in bag.split("|")]:
        kv = piece.split("=")
        while kv and kv[-1] == "":
            kv.pop()
        if len(kv) == 2 and kv[0] == field:
            return kv[1]
    return None


def _py_in(data, param):
    p = _py_get(param, "f")
    if p is None:
        return True
    v = _py_get(data, "f")
    return v is not None and bool(set(_jsplit(v)) & set(_jsplit(p)))


lists = st.text(alphabet="ab,", max_size=5)


@settings(max_examples=40, deadline=None)
@given(lists, lists)
def test_in_param_matches_java_rules(spark, dv, pv):
    data, param = f"f={dv}", f"f={pv}"
    df = spark.createDataFrame([(data,)], "bag string")
    got = df.select(ss.in_param(F.col("bag"), "f", F.lit(param), "f")).first()[0]
    assert got == _py_in(data, param)


def test_typed_conditions_match_bag_conditions(spark):
    """The typed filter accepts the sessions that the bag filter accepts."""
    rows = [(a, p, c, x, k, g) for a in (None, 19, 20, 40) for p in ("X", "Y", None) for c in ("a", "b")
            for x in ("male", None) for k, g in (("click,view", "1,2"), ("", None), ("view", "22"))]
    df = spark.createDataFrame([(str(i), *r) for i, r in enumerate(rows)],
                               "session_id string, age long, professional string, city string, sex string, "
                               "search_keywords string, click_category_ids string")
    df = df.selectExpr("*", "0 as visit_length", "0 as step_length", "'t' as start_time")
    for params in ("", "startAge=20|endAge=40", "startAge=20", "endAge=x|startAge=1", "startAge=+20|endAge=30",
                   "professionals=X,Z|cities=a,", "cities=,", "sex=male|keywords=click", "categoryIds=2,9",
                   "sex=|cities==|keywords=view=x", "professionals=,X", "keywords=,view"):
        user, activity = ss.typed_conditions(params)
        typed = sorted(r.session_id for r in df.where(user & activity).collect())
        bags = df.select("session_id", ss.session_bag(df).alias("bag"))
        assert typed == sorted(r.session_id for r in ss.session_filter(bags, params).collect()), params


def test_task_ids_are_unique(spark):
    import pytest

    from footfall.plans.area_jobs import task_window

    tasks = spark.createDataFrame([(1, "{}"), (1, "{}")], "task_id long, task_param string")
    for f in (lambda: ss.filter_params_of_task(tasks, 1), lambda: task_window(tasks, 1)):
        with pytest.raises(ValueError, match="more than once"):
            f()


def test_statistics_read_no_user_table(spark):
    from footfall.plans import session_jobs as sj

    for job in (sj.session_visit_length, sj.session_aggr_stat, sj.session_keywords):
        plan = job(spark, "/root/testdata/sf0.001")._jdf.queryExecution().executedPlan().toString()
        assert "customer" not in plan and "nation" not in plan


def test_session_filter_is_pushed_into_the_scans(spark):
    from footfall.plans import session_jobs as sj

    plan = sj.session_filter(spark, "/root/testdata/sf0.001")._jdf.queryExecution() \
        .executedPlan().toString()
    assert "regexp_extract_all" not in plan and "In(c_mktsegment, [BUILDING,MACHINERY])" in plan
    assert "In(n_name" in plan


def test_plans_are_built_without_running_jobs(spark):
    from footfall.plans import area_jobs

    before = spark.sparkContext.statusTracker().getJobIdsForGroup(None)
    area_jobs.area_top10_product(spark, "/root/testdata/sf0.001")
    jobs = set(spark.sparkContext.statusTracker().getJobIdsForGroup(None)) - set(before)
    # reading a Parquet schema is a job of Spark's own; one for each table at most
    assert len(jobs) <= 5
