"""Day folders, incremental counts, key scans and observed publishing."""

from __future__ import annotations

import datetime as dt
import os
import random

import pandas as pd
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from footfall.operators import area_top as at
from footfall.operators import cells as kv
from footfall.operators import day_partitions as dp
from footfall.operators.area_partials import AreaPartials
from footfall.plans import area_jobs
from footfall.session import local_path
from footfall.streaming import click_state as cs

ACTIONS = "user_id BIGINT, action_time TIMESTAMP_NTZ, city_id BIGINT, click_product_id STRING"
CITIES = [(1, "Nanjing", "East"), (2, "Suzhou", "East"), (3, "Xian", "West")]


def _actions(spark, n, seed=3):
    rng = random.Random(seed)
    rows = [(rng.randrange(9), dt.datetime(2024, 1, 1) + dt.timedelta(hours=rng.randrange(24 * 40)),
             rng.randrange(1, 5), rng.choice(["1", "2", "3", "null", "x", None])) for _ in range(n)]
    return spark.createDataFrame(rows + [(1, None, 1, "1")], ACTIONS)


def _cities(spark):
    return spark.createDataFrame(CITIES, "city_id BIGINT, city_name STRING, area STRING")


def _rows(df):
    return sorted(map(tuple, df.collect()), key=str)


def test_only_the_days_of_the_window_are_read(spark, run_dir):
    actions = _actions(spark, 400)
    dp.write_by_day(actions, run_dir)
    tasks = spark.createDataFrame(
        [(4, '{"startDate":["2024-01-10"],"endDate":["2024-01-12"]}'), (5, '{"startDate":["2024-02-03"]}'),
         (6, '{"startDate":["2024-01-12"],"endDate":["2024-01-10"]}')], "task_id BIGINT, task_param STRING")
    for name in os.listdir(local_path(run_dir)):
        if name.startswith("day=") and not "day=2024-01-10" <= name <= "day=2024-01-12":
            for file in os.listdir(f"{local_path(run_dir)}/{name}"):
                with open(f"{local_path(run_dir)}/{name}/{file}", "wb") as f:
                    f.write(b"not parquet")       # a read of this file would fail
    by_day = dp.read_by_day(spark, run_dir)
    got = dp.task_clicks(by_day, dp.window_days(tasks, 4))
    assert "dynamicpruning" in got._jdf.queryExecution().toString().lower()
    want = at.click_actions(actions, "2024-01-10 00:00:00", "2024-01-12 00:00:00")
    assert _rows(got) == _rows(want) and got.count() > 0
    for empty in (5, 6, 99):
        assert dp.task_clicks(by_day, dp.window_days(tasks, empty)).count() == 0


def test_arrivals_add_up_and_old_files_are_not_read_again(spark, run_dir):
    kept, landed = AreaPartials(spark, run_dir, "2024-01-01", "2024-02-01"), f"{run_dir}/landed"
    assert kept.area_product_clicks().count() == 0
    for seed, files in ((3, 2), (4, 1)):
        _actions(spark, 150, seed).coalesce(files).write.mode("append").parquet(landed)
        assert kept.absorb(spark.read.parquet(landed), _cities(spark)) == files
        whole = at.area_product_clicks(at.join_city(at.click_actions(
            spark.read.parquet(landed), "2024-01-01", "2024-02-01"), _cities(spark)))
        assert _rows(kept.area_product_clicks().select(*whole.columns)) == _rows(whole)
    assert kept.absorb(spark.read.parquet(landed), _cities(spark)) == 0
    before = _rows(kept.area_product_clicks())
    # counts of an arrival that did not reach the ledger are not read
    spark.createDataFrame([("f", "East", 1, 1, "Nanjing", 99)], "source STRING, area STRING, product_id BIGINT, "
                          "city_id BIGINT, city_name STRING, n BIGINT").write.parquet(f"{kept.partials}/arrival=2")
    assert _rows(kept.area_product_clicks()) == before


def _scanned(df):
    df.collect()
    leaf = df._jdf.queryExecution().executedPlan().collectLeaves().head()
    return leaf.metrics().apply("numOutputRows").value()


def test_scans_open_only_the_files_of_their_range(spark, run_dir):
    words = [bytes([a, b]) for a in range(32, 127) for b in range(32, 127, 5)]
    counts = spark.createDataFrame([(w.decode(), i) for i, w in enumerate(words)], "word STRING, count BIGINT")
    kv.write_cells(kv.to_cells(counts, "word", "count"), run_dir, 16)
    cells = spark.read.parquet(run_dir)
    for found, want in ((kv.scan_cells(cells, b"A", b"D"), [w for w in words if b"A" <= w < b"D"]),
                        (kv.scan_cells(cells, prefix=b"q"), [w for w in words if w.startswith(b"q")]),
                        (kv.get_cells(cells, b"zz"), [w for w in words if w == b"zz"])):
        assert sorted(bytes(r.row_key) for r in found.collect()) == want
        assert _scanned(found) <= len(words) / 4
    assert kv.scan_cells(cells).count() == kv.scan_cells(cells, prefix=b"").count() == len(words)


@pytest.mark.parametrize("prefix, end", [(b"a", b"b"), (b"a\xff", b"b"), (b"\xff\xff", None), (b"", None)])
def test_prefix_end(prefix, end):
    assert kv.prefix_end(prefix) == end


def test_a_repeated_key_leaves_the_old_rows(spark, run_dir):
    def top(*rows):
        return spark.createDataFrame([(a, "A级", p, n, "1;x", "name", "status") for a, p, n in rows],
                                     "area STRING, area_level STRING, product_id BIGINT, click_count BIGINT, "
                                     "city_infos STRING, product_name STRING, product_status STRING")
    path = f"{run_dir}/top"
    area_jobs.persist_top_n(top(("East", 1, 5), ("West", 1, 4)), 7, path)
    old = _rows(area_jobs.read_persisted(spark, path, 7))
    for bad in (top(("East", 1, 5), ("East", 1, 4)), top((None, 1, 5)), top(("East", None, 5))):
        with pytest.raises(ValueError, match="1 of"):
            area_jobs.persist_top_n(bad, 7, path)
    assert _rows(area_jobs.read_persisted(spark, path, 7)) == old and len(old) == 2
    assert os.listdir(local_path(path)) == ["task_id=7"]
    area_jobs.persist_top_n(top(("East", 2, 1)).limit(0), 7, path)
    assert area_jobs.read_persisted(spark, path, 7).count() == 0


def test_a_hot_user_reaches_the_state_as_counts(monkeypatch):
    """A third of all clicks are one user's; what leaves a task is one row a key, or a bounded
    number of partial ones."""
    rng = random.Random(1)
    day = dt.date(2024, 1, 5)
    clicks = pd.DataFrame([(0 if i % 3 == 0 else rng.randrange(1, 500), day, i % 4) for i in range(30_000)],
                          columns=cs.COUNT_KEY)
    batches = pa.Table.from_pandas(clicks, preserve_index=False).to_batches(max_chunksize=1000)
    want = clicks.groupby(cs.COUNT_KEY).size()
    for held in (cs.HELD_KEYS, 600):
        monkeypatch.setattr(cs, "HELD_KEYS", held)
        out = pa.Table.from_batches(list(cs.task_counts(iter(batches)))).to_pandas()
        assert out.groupby(cs.COUNT_KEY)["click_count"].sum().equals(want.rename("click_count"))
        assert (out["user_id"] == 0).sum() <= 4 * (1 if held > 600 else 30)
    assert list(cs.task_counts(iter([]))) == []


def test_the_state_step_adds_partial_counts():
    class State:
        exists, get = False, None

        def update(self, value):
            self.exists, self.get = True, value

    state, step = State(), cs.user_step(5, None)
    day = dt.date(2024, 1, 5)
    part = pd.DataFrame({"user_id": 1, "date": [day, day], "ad_id": [1, 1], "click_count": [2, 2]})
    first = pd.concat(step((1,), iter([part]), state))
    assert list(first["kind"]) == [cs.COUNT] and list(first["total"]) == [4]
    second = pd.concat(step((1,), iter([part[:1], part[:1]]), state))
    assert list(second["kind"]) == [cs.COUNT, cs.LISTED] and list(second["total"])[0] == 8
    third = pd.concat(step((1,), iter([part]), state))
    assert list(third["kind"]) == [cs.BARRED]


def test_bucketed_line_items_join_without_an_exchange(spark, run_dir):
    from footfall.sources import tables as tb
    sf = "/root/testdata/sf0.001"
    kept = {k: spark.conf.get(k) for k in ("spark.sql.autoBroadcastJoinThreshold", "spark.sql.adaptive.enabled")}
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        got = area_jobs.bucketed_actions(spark, sf, run_dir, buckets=6)
        plan = got._jdf.queryExecution().executedPlan().toString()
        assert "SortMergeJoin" in plan and "Exchange" not in plan and "Bucketed: true" in plan
        want = tb.user_visit_action_big(spark, sf)
        assert "Exchange" in want._jdf.queryExecution().executedPlan().toString()
    finally:
        for k, v in kept.items():
            spark.conf.set(k, v)
    assert _rows(got) == _rows(want)
    files = [f for f in os.listdir(local_path(f"{run_dir}/line_items")) if f.endswith(".parquet")]
    assert len(files) <= 6


def test_a_hot_key_is_kept_without_buckets(spark, run_dir, monkeypatch):
    from footfall.operators import bucketed as bk
    monkeypatch.setattr(bk, "LEAST_ROWS", 10)
    rows = spark.range(3000).select(F.when(F.col("id") % 3 == 0, 7).otherwise(F.col("id")).alias("k"), "id")
    assert not bk.even(rows, "k", 32) and bk.even(rows.select("id"), "id", 32)
    assert bk.even(rows.limit(0), "k", 32)
    hot = bk.keep_bucketed(rows, "k", f"{run_dir}/hot", 32)
    assert hot.count() == 3000 and "Bucketed: true" not in hot._jdf.queryExecution().executedPlan().toString()
    assert bk.keep_bucketed(rows.limit(0), "k", f"{run_dir}/none", 4).count() == 0
    nulls = bk.keep_bucketed(spark.createDataFrame([(None, 1), (2, 2)], "k long, id long"), "k", f"{run_dir}/nulls", 4)
    assert _rows(nulls) == _rows(spark.createDataFrame([(None, 1), (2, 2)], "k long, id long"))
