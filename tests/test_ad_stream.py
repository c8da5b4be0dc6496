"""Ad-click stream on hand-made log lines."""

from __future__ import annotations

import datetime as dt
import os

import pandas as pd
from pyspark.sql import functions as F

from footfall.operators import ad_click as ac
from footfall.sources.adlog import ad_log_lines
from footfall.streaming import click_state as cs
from footfall.streaming.ad_stream import AdClickStream
from tests.conftest import SF_SMALL

DAY0 = 1703980800000   # 2023-12-31 00:00 UTC
DAY1 = 1704067200000   # 2024-01-01
DAY2 = 1704153600000   # 2024-01-02


def line(ms, user, ad, province="Jiangsu", city="Nanjing"):
    return f"{ms} {province} {city} {user} {ad}"


BATCH0 = ([line(DAY1 + i, 1, 10) for i in range(2)]
          + [line(DAY1 + 100 + i, 2, 10, city="Suzhou") for i in range(3)]
          + [line(DAY1 + 5, 900, 10)]
          + ["garbage", f"{DAY1} P C x 1", "123 P C"])
BATCH1 = ([line(DAY1 + 50, 1, 10)]
          + [line(DAY1 + 200 + i, 2, 11) for i in range(5)]
          + [line(DAY0 + 7, 3, 12, province="Hebei", city="Baoding")]
          + [line(DAY2 + i, 4, 13) for i in range(2)])


def _land(spark, p, lines):
    p.append_log(spark.createDataFrame([(x,) for x in lines], "value string"))


def _stream(spark, run_dir, threshold=3):
    p = AdClickStream(spark, run_dir, threshold=threshold)
    p.seed_blacklist(spark.createDataFrame([(900,)], "user_id long"))
    return p


def _replay(p, query, batch):
    """Deliver a micro-batch again, as after a crash before its commit."""
    from footfall.session import local_path

    for name in (f"{batch}", f".{batch}.crc"):
        path = local_path(f"{p.root}/checkpoints/{query}/commits/{name}")
        if os.path.exists(path):
            os.remove(path)


def _key(df):
    return sorted(map(tuple, df.collect()))


def _views(p):
    return {v: _key(getattr(p, v)().drop("stamps")) for v in (
        "filtered_clicks", "daily_user_ad_count", "ad_user_click_total", "black_list", "ad_realtime_stat",
        "ad_province_top3", "bad_lines")}


def test_parse_quarantines_bad_lines(spark):
    df = spark.createDataFrame([(x,) for x in BATCH0], "value string")
    parsed = ac.parse_log(df)
    assert ac.good_clicks(parsed).count() == 6
    assert sorted(r.line for r in ac.bad_lines(parsed).collect()) == sorted(BATCH0[-3:])
    r = ac.good_clicks(parsed).orderBy("ts_ms").first()
    assert (r.date_key, str(r.date), r.user_id, r.ad_id) == ("20240101", "2024-01-01", 1, 10)


def test_two_batches_blacklist_and_totals(spark, run_dir):
    p = _stream(spark, run_dir)
    _land(spark, p, BATCH0)
    p.run_available()
    _land(spark, p, BATCH1)
    p.run_available()

    added = {(r.user_id, r.batch_id) for r in p.blacklist_additions().collect()}
    # user 2 reaches 3 in batch 0; user 1 reaches 3 only with batch 1's click
    # (its batch-0 clicks are counted once, not twice)
    assert added == {(2, 0), (1, 1)}
    totals = {(str(r.date), r.user_id, r.ad_id): r.click_count for r in p.ad_user_click_total().collect()}
    assert totals == {("2024-01-01", 1, 10): 3, ("2024-01-01", 2, 10): 3,
                      ("2023-12-31", 3, 12): 1, ("2024-01-02", 4, 13): 2}
    # batch 1 no longer sees user 2 (listed by batch 0); 900 is never seen
    f = p.filtered_clicks()
    assert f.where("user_id = 2 AND batch_id = 1").count() == 0
    assert f.where("user_id = 900").count() == 0
    assert f.count() == 9
    assert p.bad_lines().count() == 3
    stat = {(r.date_key, r.province, r.city, r.ad_id): r.click_count for r in p.ad_realtime_stat().collect()}
    assert stat[("20240101", "Jiangsu", "Nanjing", 10)] == 3
    assert stat[("20240101", "Jiangsu", "Suzhou", 10)] == 3
    assert stat[("20231231", "Hebei", "Baoding", 12)] == 1   # the late click updated its own day
    top = {(r.date, r.province): (r.ad_id, r.click_count) for r in p.ad_province_top3().collect()}
    assert top[("20240101", "Jiangsu")] == (10, 6)
    assert top[("20240102", "Jiangsu")] == (13, 2)


def test_restart_without_new_data_changes_nothing(spark, run_dir):
    p = _stream(spark, run_dir)
    _land(spark, p, BATCH0)
    p.run_available()
    before = sorted(map(tuple, p.ad_user_click_total().drop("stamps").collect()))
    stat_before = sorted(map(tuple, p.ad_realtime_stat().collect()))
    p.run_available()
    assert sorted(map(tuple, p.ad_user_click_total().drop("stamps").collect())) == before
    assert sorted(map(tuple, p.ad_realtime_stat().collect())) == stat_before


def test_replayed_batches_are_idempotent(spark, run_dir):
    p = _stream(spark, run_dir)
    for lines in (BATCH0, BATCH1):
        _land(spark, p, lines)
        p.run_available()
    before = _views(p)
    for query in ("filter", "bad", "stat", "top"):
        _replay(p, query, 1)
    p.run_available()
    assert _views(p) == before


def test_lines_with_impossible_times_are_quarantined(spark, run_dir):
    p = _stream(spark, run_dir)
    odd = ["9223372036854775807 p c 1 2", "253402300800000 p c 1 2", "4102444800000 p c 1 2", "-1 p c 1 2",
           "-9223372036854775808 p c 1 2", "99999999999999999999 p c 1 2"]
    _land(spark, p, odd + BATCH0)
    p.run_available()
    assert sorted(r.line for r in p.bad_lines().collect()) == sorted(odd + BATCH0[-3:])
    assert p.filtered_clicks().count() == 5
    _land(spark, p, BATCH1)
    p.run_available()                            # the stream goes on
    assert p.filtered_clicks().count() == 9


def test_leftover_folder_is_replaced(spark, run_dir):
    from footfall.streaming.folded import make_dirs

    p = _stream(spark, run_dir)
    make_dirs(spark, f"{p.filtered}/batch_id=0")
    _land(spark, p, BATCH0)
    p.run_available()
    assert p.filtered_clicks().count() == 5
    assert p.ad_realtime_stat().agg(F.sum("click_count")).first()[0] == 5


def test_one_file_or_many_same_totals(spark, run_dir):
    lines = BATCH0[:-3] + BATCH1
    one = AdClickStream(spark, run_dir + "/one", threshold=100)
    _land(spark, one, lines)
    one.run_available()
    many = AdClickStream(spark, run_dir + "/many", threshold=100)
    for chunk in (lines[:3], lines[3:8], lines[8:]):
        _land(spark, many, chunk)
        many.run_available()
    key = lambda df: sorted(map(tuple, df.collect()))
    assert key(one.ad_user_click_total().drop("stamps")) == key(many.ad_user_click_total().drop("stamps"))
    assert key(one.ad_realtime_stat()) == key(many.ad_realtime_stat())
    assert key(one.ad_province_top3()) == key(many.ad_province_top3())


def test_province_top_n_ties_by_ad(spark):
    rows = [("20240101", "P", "a", 5, 4), ("20240101", "P", "b", 6, 4), ("20240101", "P", "a", 7, 4),
            ("20240101", "P", "a", 8, 1), ("20240102", "P", "a", 8, 9)]
    df = spark.createDataFrame(rows, "date_key string, province string, city string, ad_id long, click_count long")
    out = [(r.date, r.ad_id, r.click_count) for r in ac.province_top_n(df, 3).orderBy("date", F.desc("click_count"), "ad_id").collect()]
    assert out == [("20240101", 5, 4), ("20240101", 6, 4), ("20240101", 7, 4), ("20240102", 8, 9)]


def test_state_retention_drops_very_late_clicks(spark, run_dir):
    p = AdClickStream(spark, run_dir, threshold=100, state_retention="1 hour")
    _land(spark, p, [line(DAY2 + i, 5, 20) for i in range(3)])
    p.run_available()
    _land(spark, p, [line(DAY0 + 1, 6, 21), line(DAY2 + 10, 5, 20)])   # day 0 is > 1 hour late
    p.run_available()
    stat = {(r.date_key, r.ad_id): r.click_count for r in p.ad_realtime_stat().collect()}
    assert stat[("20240102", 20)] == 4
    assert ("20231231", 21) not in stat
    # the per-user totals do not depend on the watermark
    assert p.ad_user_click_total().where("user_id = 6").count() == 1


def test_late_clicks_are_set_apart_before_any_count(spark, run_dir):
    p = AdClickStream(spark, run_dir, threshold=100, state_retention="1 day", late_apart=True)
    log = [[line(DAY2 + i, 5, 20) for i in range(3)] + [line(DAY0, 8, 20), "garbage"],   # first batch: none is late
           [line(DAY0 + 1, 6, 21), line(DAY1 + 7, 6, 22), line(DAY2 + 10, 5, 20)],
           [line(DAY2 + 2 * 86_400_000, 5, 20)],
           [line(DAY2 + 11, 5, 20), line(DAY1 + 8, 6, 22), line(DAY2 + 86_400_000, 5, 23)]]
    for lines in log:
        _land(spark, p, lines)
        p.run_available()
    late = sorted((r.batch_id, r.user_id, r.ad_id) for r in p.late_clicks().collect())
    assert late == [(1, 6, 21), (3, 5, 20), (3, 6, 22)]
    totals = p.ad_user_click_total().agg(F.sum("click_count")).first()[0]
    cities = p.ad_realtime_stat().agg(F.sum("click_count")).first()[0]
    assert totals == cities == p.filtered_clicks().count() == sum(map(len, log)) - 1 - len(late)
    # a replay of a batch judges alike and publishes nothing twice
    again = ac.good_clicks(ac.parse_log(spark.createDataFrame([(x,) for x in log[3]], "value string")))
    p._admit_batch(again, 3)
    assert sorted((r.batch_id, r.user_id, r.ad_id) for r in p.late_clicks().collect()) == late
    assert spark.read.parquet(p.admitted).count() == totals


def test_compaction_keeps_every_view_and_folds_partitions(spark, run_dir):
    from footfall.session import local_path

    arrivals = [BATCH0, BATCH1, [line(DAY1 + 900 + i, 7, 10) for i in range(2)]
                + [line(DAY2 + 900, 4, 13)] + [line(DAY1 + 950, 1, 14)]]
    plain, packed = _stream(spark, run_dir + "/plain"), _stream(spark, run_dir + "/packed")
    for i, lines in enumerate(arrivals):
        for p in (plain, packed):
            _land(spark, p, lines)
            p.run_available()
        if i >= 1:
            packed.compact(grace=0)              # keeps the newest batch of each query
            assert _views(plain) == _views(packed)
    opened = packed.ad_user_click_total().drop("stamps")
    listed = packed.black_list()
    opened._jdf.queryExecution().executedPlan()            # planned: it has listed its files
    listed._jdf.queryExecution().executedPlan()
    packed.compact(upto_batch=2, upto_stat_batch=2)         # within the grace period nothing goes
    assert _key(opened) == _key(plain.ad_user_click_total().drop("stamps"))
    assert _key(listed) == _key(plain.black_list())
    assert _views(plain) == _views(packed)
    packed.compact(upto_batch=2, upto_stat_batch=2, grace=0)
    assert _views(plain) == _views(packed)
    day1 = os.listdir(local_path(f"{packed.counts.live}/date=2024-01-01"))
    assert not [d for d in day1 if d.startswith("batch_id=")]          # all folded into the base
    assert [d for d in os.listdir(local_path(f"{packed.counts.base}/date=2024-01-01"))
            if d.startswith("upto=")] == ["upto=2"]
    # a replay of a folded batch changes nothing
    _replay(packed, "filter", 2)
    packed.run_available()
    assert _views(plain) == _views(packed)
    assert sorted(map(tuple, packed.blacklist_additions().collect())) == [(1, 1), (2, 0), (4, 2)]


def test_work_of_a_batch_does_not_grow_with_the_day(spark, run_dir):
    """Batches read their input and one Top-N partition of each day they touch."""
    from footfall.streaming import ad_stream

    p = _stream(spark, run_dir, threshold=100)
    read: list[int] = []
    real = ad_stream.partitions

    def counted(spark_, parent, column):
        found = real(spark_, parent, column)
        read.append(len(found))
        return found

    rows = spark.createDataFrame([("20240101", "P", i % 5, i) for i in range(10)],
                                 "date_key string, province string, ad_id long, click_count long")
    ad_stream.partitions = counted
    try:
        for n in range(ad_stream.TOP_KEPT + 8):
            p._top_batch(rows.limit(1) if n else rows, n)
    finally:
        ad_stream.partitions = real
    assert max(read) <= ad_stream.TOP_KEPT + 1
    assert [(r.ad_id, r.click_count) for r in p.ad_province_top3().orderBy(F.desc("click_count")).collect()] == \
        [(4, 9), (3, 8), (2, 7)]
    # the filter's micro-batch plan reads no table but the seed list
    _land(spark, p, BATCH0)
    q = p.filter_query(availableNow=True)
    q.awaitTermination()
    plan = q._jsq.explainInternal(True) if hasattr(q._jsq, "explainInternal") else ""
    assert "black_list" not in plan and "ad_user_click" not in plan


def test_default_threshold_99_100_101(spark, run_dir):
    p = AdClickStream(spark, run_dir)                       # reference threshold: 100
    assert p.threshold == 100
    p.seed_blacklist(spark.createDataFrame([(50,), (50,)], "user_id long"))   # listed twice
    b0 = ([line(DAY1 + i, 31, 1) for i in range(99)]          # 99, +1 later -> 100
          + [line(DAY1 + i, 32, 1) for i in range(101)]       # 101 at once
          + [line(DAY1 + i, 33, 1) for i in range(99)]        # stays at 99
          + [line(DAY1 + i, 50, 1) for i in range(200)])      # already listed
    _land(spark, p, b0)
    p.run_available()
    _land(spark, p, [line(DAY1 + 500, 31, 1), line(DAY1 + 501, 32, 1), line(DAY2, 33, 1)])
    p.run_available()
    added = sorted((r.user_id, r.batch_id) for r in p.blacklist_additions().collect())
    assert added == [(31, 1), (32, 0)]
    assert p.black_list().where("user_id = 50").count() == 1
    totals = {(r.user_id, str(r.date)): r.click_count for r in p.ad_user_click_total().collect()}
    assert totals[(31, "2024-01-01")] == 100 and totals[(32, "2024-01-01")] == 101
    assert totals[(33, "2024-01-01")] == 99 and (50, "2024-01-01") not in totals


def test_overlapped_arrivals_match_sequential(spark, run_dir):
    seq, ovl = _stream(spark, run_dir + "/seq"), _stream(spark, run_dir + "/ovl")
    for lines in (BATCH0, BATCH1):
        _land(spark, seq, lines)
        seq.run_available()
    ovl.run_arrivals([spark.createDataFrame([(x,) for x in b], "value string") for b in (BATCH0, BATCH1)])
    key = _key
    for view in ("black_list", "ad_realtime_stat", "ad_province_top3", "filtered_clicks"):
        assert key(getattr(seq, view)()) == key(getattr(ovl, view)()), view


def test_stream_partitions_hold_in_every_batch(spark, run_dir):
    import json

    from footfall.session import local_path

    p = AdClickStream(spark, run_dir, threshold=100, stream_partitions=3)
    before = spark.conf.get("spark.sql.shuffle.partitions")
    seen = []
    for table in (p.counts, p.listed, p.updates):
        real = table.write

        def write(rows, n, real=real):
            seen.append(rows.sparkSession.conf.get("spark.sql.shuffle.partitions"))
            real(rows, n)
        table.write = write
    publish, top = p.publish_filtered, p._top_batch
    p.publish_filtered = lambda rows, n: (seen.append(rows.sparkSession.conf.get("spark.sql.shuffle.partitions")),
                                          publish(rows, n))
    p._top_batch = lambda rows, n: (seen.append(rows.sparkSession.conf.get("spark.sql.shuffle.partitions")),
                                    top(rows, n))
    _land(spark, p, BATCH0[:-3])
    p.run_available()
    assert len(seen) >= 5 and set(seen) == {"3"}
    assert spark.conf.get("spark.sql.shuffle.partitions") == before      # session untouched
    for query in ("filter", "stat", "top"):
        offsets = open(local_path(f"{p.root}/checkpoints/{query}/offsets/0")).read().splitlines()
        assert json.loads(offsets[1])["conf"]["spark.sql.shuffle.partitions"] == "3"


def test_a_backlog_is_taken_in_bounded_batches_and_survives_a_stop(spark, run_dir):
    """Six landed files become six micro-batches; a run that ends half-way and goes on in a
    new deployment gives what one that was never stopped gives."""
    logs = [[line(DAY1 + 60_000 * i + j, 10 + (i + j) % 4, 10 + j % 2, city=f"C{i % 3}") for j in range(5)]
            + ["bad line"] * (i == 3) for i in range(6)]

    def deployment(name):
        p = AdClickStream(spark, f"{run_dir}/{name}", threshold=8, max_files_per_trigger=1)
        p.seed_blacklist(spark.createDataFrame([(900,)], "user_id long"))
        return p

    def land(p, some):
        for lines in some:
            p.append_log(spark.createDataFrame([(x,) for x in lines], "value string").coalesce(1))

    steady, stopped = deployment("steady"), deployment("stopped")
    land(steady, logs)
    query = steady.filter_query(availableNow=True)
    query.awaitTermination()
    steps = [p for p in query.recentProgress if p.numInputRows]
    assert len(steps) == 6 and max(p.numInputRows for p in steps) <= 6
    assert sum(p.numInputRows for p in steps) == sum(map(len, logs))
    steady.run_available()

    land(stopped, logs[:3])
    stopped.run_available()
    again = deployment("stopped")
    land(again, logs[3:])
    again.run_available()
    for view in ("filtered_clicks", "daily_user_ad_count", "ad_user_click_total", "black_list", "ad_realtime_stat",
                 "ad_province_top3", "bad_lines"):
        a, b = (getattr(p, view)().drop("stamps", "batch_id") for p in (steady, again))
        assert _key(a) == _key(b), view


def test_a_user_of_a_batch_is_one_frame():
    """Counts and listing of a user leave the state step together."""
    class State:
        exists, value = False, None

        def update(self, value):
            self.exists, self.value = True, value

        @property
        def get(self):
            return self.value

    day, state = dt.date(2024, 1, 2), State()
    batch = pd.DataFrame({"user_id": [5, 5, 5], "date": [day, day, day], "ad_id": [1, 2, 1], "click_count": [2, 1, 1]})
    frames = list(cs.user_step(3, None)((5,), iter([batch]), state))
    assert len(frames) == 1 and list(frames[0].columns) == cs.OUTPUT_COLUMNS
    assert [tuple(r) for r in frames[0].itertuples(index=False)] == [
        (cs.COUNT, 5, 1, day, 3, 3), (cs.COUNT, 5, 2, day, 1, 1), (cs.LISTED, 5, 0, cs.NO_DAY, 0, 0)]
    assert state.value == (True, "{}")
    barred = list(cs.user_step(3, None)((5,), iter([batch]), state))
    assert [tuple(r) for f in barred for r in f.itertuples(index=False)] == [(cs.BARRED, 5, 0, cs.NO_DAY, 0, 0)]


def test_customers_of_the_log_are_not_broadcast(spark):
    plan = ad_log_lines(spark, SF_SMALL)._jdf.queryExecution().executedPlan().toString()
    join = next(line for line in plan.splitlines() if "Join" in line and "c_custkey" in line)
    assert "SortMergeJoin" in join
