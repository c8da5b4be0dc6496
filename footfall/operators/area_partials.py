"""AG1 + AG2 kept up to date while files of visit actions arrive.

Each arrival is counted once, per (file, area, product, city); the counts merge by
addition and the city lists by set union, so the clicks per (area, product) never
need an old file again. A ledger names the files that have been counted. It is written
after the counts: an arrival that stops half-way is not in the ledger, its
counts are not read, and the next call counts its files again in the same place.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from footfall.functions.aggregates import group_concat_distinct
from footfall.functions.columns import concat_long_string
from footfall.operators import area_top as at

PARTIAL_SCHEMA = ("source STRING, area STRING, product_id BIGINT, city_id BIGINT, city_name STRING, n BIGINT, "
                  "arrival BIGINT")
LEDGER_SCHEMA = "source STRING, arrival BIGINT"


class AreaPartials:
    """Partial counts under ``root``, a folder that all executors share. One writer at a time."""

    def __init__(self, spark: SparkSession, root: str, start: str, end: str):
        self.spark, self.start, self.end = spark, start, end
        self.partials, self.ledger = f"{root}/partials", f"{root}/ledger"
        # both folders exist from the start, so that a reader finds empty tables
        for path, schema in ((self.partials, PARTIAL_SCHEMA), (self.ledger, LEDGER_SCHEMA)):
            spark.createDataFrame([], schema).drop("arrival").write.mode("ignore").parquet(f"{path}/arrival=-1")

    def _ledger(self) -> DataFrame:
        return self.spark.read.schema(LEDGER_SCHEMA).parquet(self.ledger)

    def last_arrival(self) -> int:
        n = self._ledger().agg(F.max("arrival")).first()[0]
        return -1 if n is None else n

    def absorb(self, actions: DataFrame, cities: DataFrame) -> int:
        """Count the files behind ``actions`` (a plain file read) that the ledger does not name;
        returns their number. Only file names pass the driver, as in any file listing."""
        done = {r["source"] for r in self._ledger().select("source").collect()}
        new = sorted(set(actions.inputFiles()) - done)
        if not new:
            return 0
        arrival = self.last_arrival() + 1
        rows = self.spark.read.schema(actions.schema).parquet(*new)
        t = F.col("action_time")
        clicks = (rows.select("*", F.col("_metadata.file_path").alias("source"))
                  .where(at.usable_click() & (t >= F.lit(self.start).cast(rows.schema["action_time"].dataType))
                         & (t <= F.lit(self.end).cast(rows.schema["action_time"].dataType)))
                  .select("source", F.col("city_id").cast("bigint").alias("city_id"),
                          F.col("click_product_id").try_cast("bigint").alias("product_id")))
        dim = cities.select(F.col("city_id").cast("bigint").alias("city_id"), "city_name", "area")
        (clicks.groupBy("source", "city_id", "product_id").agg(F.count(F.lit(1)).alias("n"))
         .join(dim, "city_id").select("source", "area", "product_id", "city_id", "city_name", "n")
         .write.mode("overwrite").parquet(f"{self.partials}/arrival={arrival}"))
        (self.spark.createDataFrame([(f,) for f in new], "source STRING").coalesce(1)
         .write.mode("overwrite").parquet(f"{self.ledger}/arrival={arrival}"))
        return len(new)

    def area_product_clicks(self) -> DataFrame:
        """Clicks and sorted distinct cities per (area, product) over all counted files."""
        counted = (self.spark.read.schema(PARTIAL_SCHEMA).parquet(self.partials)
                   .where(F.col("arrival") <= self.last_arrival()))
        per_city = counted.groupBy("area", "product_id", "city_id", "city_name").agg(F.sum("n").alias("n"))
        return per_city.groupBy("area", "product_id").agg(
            F.sum("n").alias("click_count"),
            group_concat_distinct(concat_long_string("city_id", "city_name", ";")).alias("city_infos"))
