"""Tables kept bucketed by a join key, so that later joins on it need no exchange (JN1, JN2).

A table is written once: dealt by the key, one file for each bucket, sorted inside it.
Two tables of the same key and number of buckets are then joined bucket by bucket, each
read by one task. A bucket cannot be split, so a key that holds a great part of the rows
would be one long task: the rows of each bucket are counted first (the key column
alone is read), and a table with a bucket above ``HOT`` times the mean is kept without
buckets, where adaptive execution splits the skewed partition of an ordinary join.

Defined results: null keys share a bucket and join nothing; an empty table is kept as one.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

HOT = 4
LEAST_ROWS = 100_000        # buckets of fewer rows are never hot


def even(table: DataFrame, key: str, buckets: int) -> bool:
    """Whether no bucket holds more than ``HOT`` times the mean. The count is partial
    before its exchange, so it ships at most ``buckets`` rows a task."""
    per_bucket = table.groupBy(F.pmod(F.hash(key), F.lit(buckets)).alias("bucket")).count()
    most, total = per_bucket.agg(F.max("count"), F.sum("count")).first()
    return (most or 0) <= max(HOT * (total or 0) / buckets, LEAST_ROWS)


def keep_bucketed(table: DataFrame, key: str, path: str, buckets: int) -> DataFrame:
    """Write ``table`` below ``path`` and return it as it is read from there."""
    spark = table.sparkSession
    if not even(table, key, buckets):
        table.write.parquet(path)
        return spark.read.parquet(path)
    name = f"bucketed_{uuid.uuid4().hex[:12]}"
    # dealt as the buckets are, so each task writes one file of one bucket
    (table.repartition(buckets, key).write.bucketBy(buckets, key).sortBy(key)
     .format("parquet").option("path", path).saveAsTable(name))
    return spark.table(name)
