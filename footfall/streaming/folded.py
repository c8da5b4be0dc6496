"""A table of per-batch partitions that can be folded while it is read.

  live/[day=D/]batch_id=N     what micro-batch N wrote; a replay overwrites exactly it
  base/[day=D/]upto=B         the rows of batches up to B, written by ``fold`` only

Readers take the newest base (of each day) and the batches after it. A base never
replaces what it covers: covered partitions stay for a grace period and are deleted
by a later sweep, so a reader that has already listed them can finish. No batch
writes into a base, so a replay of a folded batch changes nothing that is read.
"""

from __future__ import annotations

import time
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

GRACE_SECONDS = 3600.0


def fs_path(spark: SparkSession, path: str):
    p = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return p, p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())


def make_dirs(spark: SparkSession, path: str) -> None:
    p, fs = fs_path(spark, path)
    fs.mkdirs(p)


def partitions(spark: SparkSession, parent: str, column: str) -> list[tuple[str, str, float]]:
    """(value, path, modification time in seconds) of the ``column=...`` folders."""
    p, fs = fs_path(spark, parent)
    if not fs.exists(p):
        return []
    return [(st.getPath().getName().split("=", 1)[1], st.getPath().toString(), st.getModificationTime() / 1000)
            for st in fs.listStatus(p) if st.isDirectory() and st.getPath().getName().startswith(column + "=")]


def delete(spark: SparkSession, path: str) -> None:
    p, fs = fs_path(spark, path)
    fs.delete(p, True)


def overwrite_partitions(df: DataFrame, path: str, *columns: str) -> None:
    (df.write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
     .partitionBy(*columns).parquet(path))


class FoldedTable:
    """``schema`` is of the rows with ``batch_id`` and, where there is one, ``day``."""

    def __init__(self, spark: SparkSession, path: str, schema: str, day: str | None = None):
        self.spark, self.path, self.schema, self.day = spark, path, schema, day
        self.live, self.base = f"{path}/live", f"{path}/base"
        make_dirs(spark, self.live)
        make_dirs(spark, self.base)

    def write(self, rows: DataFrame, batch: int) -> None:
        """The rows of one batch (without batch_id)."""
        rows = rows.withColumn("batch_id", F.lit(batch).cast("bigint"))
        overwrite_partitions(rows, self.live, *([self.day] if self.day else []), "batch_id")

    def read(self, spark: SparkSession | None = None, upto: int | None = None) -> DataFrame:
        """All rows (of batches up to ``upto``), whether folded or not."""
        spark = spark or self.spark
        live = spark.read.schema(self.schema).parquet(self.live)
        base = spark.read.schema(f"{self.schema}, upto BIGINT").parquet(self.base)
        if upto is not None:
            live, base = live.where(F.col("batch_id") <= upto), base.where(F.col("upto") <= upto)
        if self.day:              # a row for each folded day
            newest = base.groupBy(self.day).agg(F.max("upto").alias("newest"))
            live, base = live.join(newest, self.day, "left"), base.join(newest, self.day, "left")
        else:
            folded = [int(v) for v, _, _ in partitions(spark, self.base, "upto")]
            last = max((u for u in folded if upto is None or u <= upto), default=None)
            newest = F.lit(last).cast("bigint")
            live, base = live.withColumn("newest", newest), base.withColumn("newest", newest)
        old = base.where(F.col("upto") == F.col("newest"))
        new = live.where(F.col("newest").isNull() | (F.col("batch_id") > F.col("newest")))
        columns = [f.name for f in live.schema.fields if f.name != "newest"]
        return old.select(*columns).unionByName(new.select(*columns))

    def fold(self, upto: int | None = None, reduce: Callable[[DataFrame], DataFrame] | None = None,
             grace: float = GRACE_SECONDS) -> None:
        """Sweep what earlier folds cover, then write new bases of batches up to ``upto``
        (default: all but the newest) for the days that have batches to fold.
        ``reduce`` may combine rows (it keeps batch_id)."""
        self.sweep(grace)
        days = [(v, p) for v, p, _ in partitions(self.spark, self.live, self.day)] if self.day \
            else [(None, self.live)]
        batches = {d: sorted(int(v) for v, _, _ in partitions(self.spark, p, "batch_id")) for d, p in days}
        if upto is None:
            newest = max((b[-1] for b in batches.values() if b), default=0)
            upto = newest - 1
        changed = []
        for d, b in batches.items():
            done = max((int(v) for v, _, _ in partitions(self.spark, self._of(self.base, d), "upto")), default=-1)
            if any(done < n <= upto for n in b):
                changed.append(d)
        if changed:
            rows = self.read(upto=upto)
            if self.day:
                rows = rows.where(F.col(self.day).cast("string").isin(changed))
            rows = reduce(rows) if reduce else rows
            overwrite_partitions(rows.withColumn("upto", F.lit(upto).cast("bigint")), self.base,
                                 *([self.day] if self.day else []), "upto")
        if grace <= 0:
            self.sweep(grace)

    def _of(self, parent: str, day: str | None) -> str:
        return parent if day is None else f"{parent}/{self.day}={day}"

    def sweep(self, grace: float = GRACE_SECONDS) -> None:
        """Delete partitions that a base written ``grace`` seconds ago or earlier covers."""
        limit = time.time() - grace
        days = [v for v, _, _ in partitions(self.spark, self.base, self.day)] if self.day else [None]
        for d in days:
            bases = [(int(v), p, t) for v, p, t in partitions(self.spark, self._of(self.base, d), "upto")]
            old = max((u for u, _, t in bases if t <= limit), default=None)
            if old is None:
                continue
            for v, p, _ in partitions(self.spark, self._of(self.live, d), "batch_id"):
                if 0 <= int(v) <= old:
                    delete(self.spark, p)
            for u, p, _ in bases:
                if u < old:
                    delete(self.spark, p)
