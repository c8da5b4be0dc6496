"""Table sources.

``load`` reads one parquet table. ``city_info``, ``user_visit_action``,
``user_visit_action_big``, ``product_info`` and ``tasks`` shape the driver's
TPC-H-like tables into the reference's data model, purely
with DataFrame expressions, so every job downstream works unchanged on the
reference's own tables too.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from footfall.functions.columns import format_date, json_field

TABLES = ("region", "nation", "customer", "supplier", "part", "orders", "lineitem",
          "events", "documents", "embeddings", "pages", "benchmark", "labels",
          "conversations")


def load(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def city_info(spark: SparkSession, sf_dir: str) -> DataFrame:
    """city_info(city_id, city_name, area) = nation joined to region."""
    nation = load(spark, sf_dir, "nation")
    region = load(spark, sf_dir, "region")
    return (nation.join(region, nation.n_regionkey == region.r_regionkey)
            .select(F.col("n_nationkey").cast("bigint").alias("city_id"),
                    F.col("n_name").alias("city_name"),
                    F.col("r_name").alias("area")))


def user_visit_action(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Visit actions: events placed in the customer's city.

    ``click_product_id`` is the ``k`` of a click; error and view actions carry
    the texts 'null' and 'NULL' the reference must filter out; others NULL.
    """
    events = load(spark, sf_dir, "events")
    customer = load(spark, sf_dir, "customer").select("c_custkey", "c_nationkey")
    et = F.col("event_type")
    click_pid = (F.when(et == "click", json_field("props", "k"))
                 .when(et == "error", F.lit("null"))
                 .when(et == "view", F.lit("NULL")))
    return (events.join(customer, events.user_id == customer.c_custkey)
            .select(F.col("user_id"),
                    F.col("event_id").alias("action_id"),
                    F.col("ts").alias("action_time"),
                    F.col("c_nationkey").cast("bigint").alias("city_id"),
                    click_pid.alias("click_product_id")))


def user_visit_action_big(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Bench-scale visit actions: every line item is a click on its part,
    in the ordering customer's city, at the ship date.

    Orders are placed in their city first and line items joined last, so the
    largest table is shuffled once (on the order key); joining line items to
    orders first would shuffle the joined line items again by customer.
    """
    return line_actions(line_items(spark, sf_dir), order_cities(spark, sf_dir))


def line_items(spark: SparkSession, sf_dir: str) -> DataFrame:
    return load(spark, sf_dir, "lineitem").select("l_orderkey", "l_partkey", "l_shipdate")


def order_cities(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders placed in their customer's city."""
    orders = load(spark, sf_dir, "orders").select("o_orderkey", "o_custkey")
    customer = load(spark, sf_dir, "customer").select("c_custkey", "c_nationkey")
    return (orders.join(customer, orders.o_custkey == customer.c_custkey)
            .select("o_orderkey", "o_custkey", "c_nationkey"))


def line_actions(li: DataFrame, order_city: DataFrame) -> DataFrame:
    """Visit actions of line items and of orders with their city."""
    return (li.join(order_city, li.l_orderkey == order_city.o_orderkey)
            .select(F.col("o_custkey").alias("user_id"),
                    F.col("l_shipdate").alias("action_time"),
                    F.col("c_nationkey").cast("bigint").alias("city_id"),
                    F.col("l_partkey").cast("string").alias("click_product_id")))


def product_info(spark: SparkSession, sf_dir: str) -> DataFrame:
    """product_info(product_id, product_name, extend_info JSON)."""
    part = load(spark, sf_dir, "part")
    extend = F.to_json(F.named_struct(F.lit("product_status"), F.col("p_size") % 2))
    return part.select(F.col("p_partkey").alias("product_id"),
                       F.col("p_name").alias("product_name"),
                       extend.alias("extend_info"))


def tasks(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Task control table: one task per order, analysing the 30 days that
    follow the order date. ``task_param`` is the reference's JSON shape."""
    orders = load(spark, sf_dir, "orders")
    start = format_date("o_orderdate")
    end = format_date(F.date_add(F.col("o_orderdate").cast("date"), 30))
    param = F.to_json(F.named_struct(F.lit("startDate"), F.array(start),
                                     F.lit("endDate"), F.array(end)))
    return orders.select(F.col("o_orderkey").alias("task_id"),
                         F.concat(F.lit("order-"), F.col("o_orderkey").cast("string")).alias("task_name"),
                         format_date("o_orderdate").alias("create_time"),
                         F.lit("area_top_product").alias("task_type"),
                         F.col("o_orderstatus").alias("task_status"),
                         param.alias("task_param"))


def session_tasks(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Task control table of session statistics: one task per nation, about the
    sessions of its users and of the next eleven nations', with some parameters absent (no upper
    age bound, no sex)."""
    nation = load(spark, sf_dir, "nation")
    key = F.col("n_nationkey")
    cities = F.array_join(F.transform(F.sequence(F.lit(0), F.lit(11)), lambda i: F.concat(
        F.lit("NATION_"), F.pmod(key + i, F.lit(25)).cast("string"))), ",")
    param = F.to_json(F.named_struct(
        F.lit("startDate"), F.array(F.lit("2024-01-05")), F.lit("endDate"), F.array(F.lit("2024-01-25")),
        F.lit("startAge"), F.array(F.lit("30")),
        F.lit("professionals"), F.array(F.lit("BUILDING,MACHINERY,AUTOMOBILE")),
        F.lit("cities"), F.array(cities), F.lit("keywords"), F.array(F.lit("click,purchase")),
        F.lit("categoryIds"), F.array(F.array_join(F.transform(
            F.sequence(F.lit(0), F.lit(98), F.lit(2)), lambda x: x.cast("string")), ","))))
    return nation.select(key.cast("bigint").alias("task_id"), param.alias("task_param"))


def segment_tasks(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Task control table of session statistics by many analysts: one task per customer, each with
    a date window and its own choice of filter parameters, some absent."""
    key = F.col("c_custkey")

    def day(n):
        return F.date_format(F.date_add(F.lit("2024-01-01").cast("date"), n.cast("int")), "yyyy-MM-dd")

    def when(cond, value):
        return F.when(cond, F.array(value.cast("string")))

    def listed(values):
        return F.array_join(values, ",")

    types = F.array(*[F.lit(x) for x in ("click", "view", "purchase", "signup", "error")])
    cities = F.transform(F.sequence(F.lit(0).cast("bigint"), key % 9),
                         lambda i: F.concat(F.lit("NATION_"), F.pmod(key + i * 3, F.lit(25)).cast("string")))
    numbers = F.transform(F.sequence(F.lit(0).cast("bigint"), key % 20), lambda i: F.pmod(key * 7 + i * 13, F.lit(100)).cast("string"))
    param = F.to_json(F.struct(
        F.array(day(key % 11)).alias("startDate"), F.array(day(key % 11 + 5 + key % 17)).alias("endDate"),
        when(key % 4 != 0, 18 + key % 30).alias("startAge"), when(key % 5 != 0, 18 + key % 30 + key % 25).alias("endAge"),
        when(key % 3 != 0, F.when(key % 2 == 0, F.concat(F.col("c_mktsegment"), F.lit(",BUILDING")))
             .otherwise(F.col("c_mktsegment"))).alias("professionals"),
        when(key % 7 != 0, listed(cities)).alias("cities"),
        when(key % 6 == 1, F.when(key % 12 == 1, F.lit("male")).otherwise(F.lit("female"))).alias("sex"),
        when(key % 6 != 2, listed(F.slice(types, (key % 5 + 1).cast("int"), F.lit(2)))).alias("keywords"),
        when(key % 5 == 2, listed(numbers)).alias("categoryIds")))
    return load(spark, sf_dir, "customer").select(key.cast("bigint").alias("task_id"), param.alias("task_param"))
