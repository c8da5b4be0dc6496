"""JDBC sources and sinks through Spark's own JDBC data source.

Replaces the reference's pooled single-machine JDBC client: reads are
partitioned range scans (``partitionColumn`` / bounds / ``numPartitions``)
with predicate and column pushdown, writes are batched per partition with
one transaction per partition, and errors propagate instead of returning 0.
Credentials come from the caller (options or environment), never from files
in the repository.

Not exercised by the tests: that needs a database reachable from the
cluster, and no database server is started here.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def _opts(url: str, user: str | None, password: str | None, driver: str | None,
          extra: dict[str, str] | None) -> dict[str, str]:
    o = {"url": url}
    if user is not None:
        o["user"] = user
    if password is not None:
        o["password"] = password
    if driver:
        o["driver"] = driver
    o.update(extra or {})
    return o


def read_table(spark: SparkSession, url: str, table: str, *, user: str | None = None,
               password: str | None = None, driver: str | None = None,
               partition_column: str | None = None, lower_bound: int | None = None,
               upper_bound: int | None = None, num_partitions: int | None = None,
               fetch_size: int = 10_000, small: bool = False,
               extra: dict[str, str] | None = None) -> DataFrame:
    """SRC2/SRC5: a table, read in ``num_partitions`` parallel range scans over a
    numeric partition column and its bounds. Only a table declared ``small`` is
    read by a single task."""
    if not partition_column and not small:
        raise ValueError("give partition_column, bounds and num_partitions, or small=True")
    r = spark.read.format("jdbc").options(**_opts(url, user, password, driver, extra))
    r = r.option("dbtable", table).option("fetchsize", str(fetch_size))
    if partition_column:
        if lower_bound is None or upper_bound is None or not num_partitions:
            raise ValueError("partitioned JDBC read needs lower_bound, upper_bound and num_partitions")
        r = (r.option("partitionColumn", partition_column)
             .option("lowerBound", str(lower_bound)).option("upperBound", str(upper_bound))
             .option("numPartitions", str(num_partitions)))
    return r.load()


def read_query(spark: SparkSession, url: str, query: str, *, user: str | None = None,
               password: str | None = None, driver: str | None = None, small: bool = False,
               extra: dict[str, str] | None = None) -> DataFrame:
    """SRC8: rows of an arbitrary query as a DataFrame (no row callback). One task
    reads it, so the caller states that the result is ``small``; a large one is
    read as a table ``(query) AS t`` with bounds."""
    if not small:
        raise ValueError("a query is read by one task: small=True, or read_table('(query) AS t', ...)")
    return (spark.read.format("jdbc").options(**_opts(url, user, password, driver, extra))
            .option("query", query).load())


def find_by_key(df: DataFrame, key: str, value) -> DataFrame:
    """SRC7: point lookup; on a JDBC relation the predicate is pushed down."""
    return df.where(F.col(key) == F.lit(value))


def write_table(df: DataFrame, url: str, table: str, *, mode: str = "append",
                user: str | None = None, password: str | None = None,
                driver: str | None = None, batch_size: int = 1_000,
                num_partitions: int | None = None, truncate: bool = False,
                extra: dict[str, str] | None = None) -> None:
    """SNK7 and the result-table sinks: batched inserts, one transaction
    per partition; ``num_partitions`` caps concurrent connections (by a shuffle,
    so the work above keeps its own parallelism).

    Two attempts of one task could both commit, so inserts are refused while
    speculation is on."""
    if df.sparkSession.conf.get("spark.speculation", "false").lower() == "true":
        raise ValueError("JDBC inserts are not idempotent: turn spark.speculation off for this job")
    if num_partitions:
        df = df.repartition(num_partitions)
    w = (df.write.format("jdbc").options(**_opts(url, user, password, driver, extra))
         .option("dbtable", table).option("batchsize", str(batch_size))
         .option("isolationLevel", "READ_COMMITTED"))
    if truncate:
        w = w.option("truncate", "true")
    w.mode(mode).save()
