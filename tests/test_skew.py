"""A user holding a third of all events: the flagship job still gives the
same answer when AQE splits the hot sort-merge-join partition."""

from __future__ import annotations

from pyspark.sql import functions as F

from footfall.plans import area_jobs

SKEW_CONF = {
    "spark.sql.autoBroadcastJoinThreshold": "-1",          # force shuffled joins
    "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "1k",
    "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "2",
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": "4k",
}


def _write_fixture(spark, root):
    n = 30000
    ids = spark.range(n)
    ev = ids.select(
        F.col("id").alias("event_id"),
        (F.lit("2024-01-01 00:00:00").cast("timestamp_ntz") + F.make_dt_interval(secs=F.col("id") % 86400))
        .alias("ts"),
        F.when(F.col("id") % 3 == 0, F.lit(7)).otherwise(F.col("id") % 400).cast("bigint").alias("user_id"),
        F.when(F.col("id") % 2 == 0, F.lit("click")).otherwise(F.lit("view")).alias("event_type"),
        F.lit(1.0).alias("value"),
        F.to_json(F.named_struct(F.lit("k"), F.col("id") % 37)).alias("props"))
    cust = spark.range(400).select(F.col("id").alias("c_custkey"),
                                   (F.col("id") % 25).cast("int").alias("c_nationkey"))
    nation = spark.range(25).select(F.col("id").cast("int").alias("n_nationkey"),
                                    F.concat(F.lit("N"), F.col("id").cast("string")).alias("n_name"),
                                    (F.col("id") % 5).cast("int").alias("n_regionkey"))
    region = spark.createDataFrame([(0, "AFRICA"), (1, "AMERICA"), (2, "ASIA"), (3, "EUROPE"),
                                    (4, "MIDDLE EAST")], "r_regionkey int, r_name string")
    part = spark.range(37).select(F.col("id").alias("p_partkey"),
                                  F.concat(F.lit("p"), F.col("id").cast("string")).alias("p_name"),
                                  (F.col("id") % 7).cast("int").alias("p_size"))
    for name, df in [("events", ev), ("customer", cust), ("nation", nation), ("region", region),
                     ("part", part)]:
        df.write.mode("overwrite").parquet(f"{root}/{name}.parquet")


def test_hot_user_split_gives_same_top10(spark, run_dir):
    _write_fixture(spark, run_dir)
    saved = {k: spark.conf.get(k, None) for k in [*SKEW_CONF, "spark.sql.adaptive.skewJoin.enabled"]}
    try:
        for k, v in SKEW_CONF.items():
            spark.conf.set(k, v)
        spark.conf.set("spark.sql.adaptive.skewJoin.enabled", "false")
        plain = sorted(map(tuple, area_jobs.area_top10_product(spark, run_dir).collect()))
        spark.conf.set("spark.sql.adaptive.skewJoin.enabled", "true")
        df = area_jobs.area_top10_product(spark, run_dir)
        split = sorted(map(tuple, df.collect()))
        plan = df._jdf.queryExecution().executedPlan().toString().split("+- == Initial Plan ==")[0]
    finally:
        for k, v in saved.items():
            if v is None:
                spark.conf.unset(k)
            else:
                spark.conf.set(k, v)
    assert "SortMergeJoin(skew=true)" in plan
    assert split == plain and len(plain) == 50


def test_line_items_shuffled_once_when_nothing_is_broadcast(spark):
    import re

    from footfall.sources import tables as tb

    keys = ["spark.sql.autoBroadcastJoinThreshold", "spark.sql.adaptive.enabled"]
    saved = {k: spark.conf.get(k, None) for k in keys}
    try:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
        spark.conf.set("spark.sql.adaptive.enabled", "false")     # the static plan
        plan = tb.user_visit_action_big(spark, "/root/testdata/sf0.001") \
            ._jdf.queryExecution().executedPlan().toString()
    finally:
        for k, v in saved.items():
            spark.conf.unset(k) if v is None else spark.conf.set(k, v)
    exchanged = re.findall(r"Exchange hashpartitioning\((\w+)#", plan)
    assert sorted(exchanged) == ["c_custkey", "l_orderkey", "o_custkey", "o_orderkey"]
