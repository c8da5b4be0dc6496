"""Behaviour sources: user actions and user attributes from the driver's
tables, in the shape the session jobs expect."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from footfall.functions.columns import json_field
from footfall.sources.tables import load


def user_actions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(user_id, action_time, action_type, category_id): every event, its
    type, and the category ``k`` it concerns."""
    ev = load(spark, sf_dir, "events")
    return ev.select("user_id", F.col("ts").alias("action_time"),
                     F.col("event_type").alias("action_type"),
                     json_field("props", "k").try_cast("bigint").alias("category_id"))


def user_info(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(user_id, age, professional, city, sex) from customer and nation.

    The tables hold no age or sex; they are derived from the key so that
    both are spread evenly (age 18-67, alternating sex).
    """
    cust = load(spark, sf_dir, "customer").select("c_custkey", "c_mktsegment", "c_nationkey")
    nation = load(spark, sf_dir, "nation").select("n_nationkey", "n_name")
    key = F.col("c_custkey")
    return (cust.join(nation, cust.c_nationkey == nation.n_nationkey)
            .select(key.alias("user_id"),
                    (F.lit(18) + key % 50).alias("age"),
                    F.col("c_mktsegment").alias("professional"),
                    F.col("n_name").alias("city"),
                    F.when(key % 2 == 0, F.lit("male")).otherwise(F.lit("female")).alias("sex")))
