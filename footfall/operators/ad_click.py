"""Ad-click statistics (job J2) as plain DataFrame functions.

They are used unchanged inside the streaming ``foreachBatch`` sinks and as
batch jobs. Keys are real typed columns (date, user_id, ad_id, ...), never
strings packed with ``_``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from footfall.functions.columns import format_date_key, from_epoch_millis

# The reference's threshold: a user with >= 100 clicks on one ad in one day
# is blacklisted.
DEFAULT_BLACKLIST_THRESHOLD = 100
DEFAULT_TOP_N = 3

PARSED_SCHEMA = ("ts_ms BIGINT, province STRING, city STRING, user_id BIGINT, ad_id BIGINT, "
                 "click_time TIMESTAMP, date DATE, date_key STRING")
USER_AD_KEY = ["date", "user_id", "ad_id"]
CITY_AD_KEY = ["date_key", "province", "city", "ad_id"]


# Click times that are accepted, in epoch milliseconds: 1970 to 2099. The bound
# also limits how many day partitions a log of arbitrary numbers can make.
MIN_TS_MS, MAX_TS_MS = 0, 4_102_444_799_999


def parse_log(lines: DataFrame, value: str = "value") -> DataFrame:
    """PRJ5: 'timestamp_ms province city userId adId' -> typed columns.

    Adds ``ok``: false for lines with fewer than 5 fields, numbers that do not
    parse, or times out of range (the reference would fail the whole batch on
    them). Times are converted only after the range check, so no line can
    overflow the conversion.
    """
    parts = F.split(F.col(value), " ")
    ts_ms = F.get(parts, 0).try_cast("bigint")
    user_id = F.get(parts, 3).try_cast("bigint")
    ad_id = F.get(parts, 4).try_cast("bigint")
    in_range = ts_ms.between(MIN_TS_MS, MAX_TS_MS)
    click_time = from_epoch_millis(F.when(in_range, ts_ms))
    ok = (F.size(parts) >= 5) & in_range & user_id.isNotNull() & ad_id.isNotNull()
    return lines.select(
        ts_ms.alias("ts_ms"),
        F.get(parts, 1).alias("province"),
        F.get(parts, 2).alias("city"),
        user_id.alias("user_id"),
        ad_id.alias("ad_id"),
        click_time.alias("click_time"),
        F.to_date(click_time).alias("date"),
        format_date_key(click_time).alias("date_key"),
        F.coalesce(ok, F.lit(False)).alias("ok"),
        F.col(value).alias("line"),
    )


def good_clicks(parsed: DataFrame) -> DataFrame:
    return parsed.where("ok").drop("ok", "line")


def bad_lines(parsed: DataFrame) -> DataFrame:
    return parsed.where(~F.col("ok")).select("line")


def drop_blacklisted(clicks: DataFrame, blacklist: DataFrame) -> DataFrame:
    """JN3: anti join on user_id (a NULL user never matches, so it stays).

    No hint: the blacklist grows with the user base, so Spark's own size
    check chooses broadcast or sort-merge. An anti join needs no distinct list.
    """
    return clicks.join(blacklist.select("user_id"), "user_id", "left_anti")


def daily_user_ad_counts(clicks: DataFrame) -> DataFrame:
    """AG3: clicks per (date, user, ad) in one batch."""
    return clicks.groupBy(*USER_AD_KEY).agg(F.count(F.lit(1)).alias("click_count"))


def user_ad_totals(deltas: DataFrame) -> DataFrame:
    """AG4: running total per (date, user, ad) = sum of the per-batch deltas."""
    return deltas.groupBy(*USER_AD_KEY).agg(F.sum("click_count").alias("click_count"))


def users_over_threshold(totals: DataFrame, threshold: int = DEFAULT_BLACKLIST_THRESHOLD) -> DataFrame:
    """FIL3 + AG5: distinct users with some (date, ad) total >= threshold."""
    return totals.where(F.col("click_count") >= threshold).select("user_id").distinct()


def city_ad_counts(clicks: DataFrame) -> DataFrame:
    """AG6 (one batch): clicks per (day, province, city, ad)."""
    return clicks.groupBy(*CITY_AD_KEY).agg(F.count(F.lit(1)).alias("click_count"))


def province_ad_counts(city_counts: DataFrame) -> DataFrame:
    """AG7: cities rolled up to (day, province, ad)."""
    return (city_counts.groupBy("date_key", "province", "ad_id")
            .agg(F.sum("click_count").alias("click_count")))


def top_n_ads(province_counts: DataFrame, n: int = DEFAULT_TOP_N) -> DataFrame:
    """WN2: the n most clicked ads per (day, province); ties by ad id."""
    w = Window.partitionBy("date_key", "province").orderBy(F.col("click_count").desc(),
                                                           F.col("ad_id").asc())
    return (province_counts.withColumn("rn", F.row_number().over(w)).where(F.col("rn") <= n)
            .select(F.col("date_key").alias("date"), "province", "ad_id", "click_count"))


def province_top_n(city_counts: DataFrame, n: int = DEFAULT_TOP_N) -> DataFrame:
    """AG7 + WN2 over one table of city counts."""
    return top_n_ads(province_ad_counts(city_counts), n)
