"""Ad-click log sources.

* ``ad_log_lines`` derives the reference's text log
  ``timestamp_ms province city userId adId`` from the driver's tables
  (events placed in the customer's nation and region).
* ``text_log_stream`` / ``kafka_log_stream`` are the streaming readers. The
  Kafka reader needs the spark-sql-kafka package on the classpath; it is
  not bundled here, so only the file source is exercised by the tests.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from footfall.functions.columns import epoch_millis
from footfall.sources.tables import load

# Ad id of each event type (its position in this list).
AD_EVENT_TYPES = ["click", "view", "purchase", "signup", "error"]


def ad_log_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(value, ts) rows: one log line per event, plus its event time."""
    events = load(spark, sf_dir, "events").select("ts", "user_id", "event_type")
    customer = load(spark, sf_dir, "customer").select("c_custkey", "c_nationkey")
    nation = load(spark, sf_dir, "nation").select("n_nationkey", "n_name", "n_regionkey")
    region = load(spark, sf_dir, "region").select("r_regionkey", "r_name")
    geo = nation.join(region,
                                        nation.n_regionkey == region.r_regionkey)
    ad_id = F.array_position(F.array(*[F.lit(t) for t in AD_EVENT_TYPES]), F.col("event_type"))
    line = F.concat_ws(" ",
                       epoch_millis("ts").cast("string"),
                       F.regexp_replace("r_name", " ", "-"),   # the separator is a space
                       F.col("n_name"),
                       F.col("user_id").cast("string"),
                       ad_id.cast("string"))
    # customers grow with the log: neither side goes through the driver
    return (events.join(customer.hint("merge"), events.user_id == customer.c_custkey)
            .join(geo, F.col("c_nationkey") == geo.n_nationkey)
            .select(line.alias("value"), F.col("ts")))


def text_log_stream(spark: SparkSession, path: str, max_files_per_trigger: int | None = None) -> DataFrame:
    reader = spark.readStream.format("text")
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", str(max_files_per_trigger))
    return reader.load(path)


def kafka_log_stream(spark: SparkSession, bootstrap_servers: str, topics: str,
                     starting_offsets: str = "latest") -> DataFrame:
    """SRC4: value-only Kafka stream; ``topics`` is comma separated."""
    return (spark.readStream.format("kafka")
            .option("kafka.bootstrap.servers", bootstrap_servers)
            .option("subscribe", ",".join(t.strip() for t in topics.split(",")))
            .option("startingOffsets", starting_offsets)
            .load()
            .select(F.col("value").cast("string").alias("value")))


def initial_blacklist(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Users blacklisted before the stream starts: accounts in debt."""
    return (load(spark, sf_dir, "customer").where(F.col("c_acctbal") < 0)
            .select(F.col("c_custkey").alias("user_id")))
