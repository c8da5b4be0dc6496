"""Ad-click real-time statistics and blacklist as Structured Streaming.

Three chained queries (one checkpoint each):

* **filter query** - text log -> parse -> seed-list anti join -> one state per
  user (``click_state``): whether the user is listed, and the running clicks per
  (day, ad). Clicks are counted in each task before they reach the state; the clicks
  themselves go beside it. Micro-batch N yields all its clicks, its counts
  with their running totals, the users it lists and those of its users whom an earlier
  batch listed; ``foreachBatch`` drops the clicks of the latter by an anti join and writes each
  output into its own partition of batch N. Work per batch is bounded by the batch: the
  state store replaces reading totals or the blacklist back.
* **stat query** - file stream over the filtered clicks ->
  ``groupBy(window(click_time, 1 day), province, city, ad_id).count()`` in
  the state store, ``update`` mode -> appends the updated running counts.
* **top query** - the same per (day, province, ad). Counts only grow, so the new
  Top-N of a (day, province) are among its last Top-N and the ads that this
  batch updated; a batch reads one partition of the Top-N table for each
  day it touches, the last one, and nothing else.

With ``late_apart`` an **admit query** comes first: clicks whose day had ended
``state_retention`` or more before the newest click of all earlier micro-batches go to a side
table, and the filter query reads the others. So user totals, city counts and Top-N count the
same clicks, and the side table has the rest. The newest time is one row for each batch, kept
by batch, so a replay judges alike. A click from the future moves that time, as it would a watermark.

Filtered clicks are published by renaming a finished folder, which holds Spark's
completion mark; a folder without the mark is a leftover and is replaced. A
replayed batch skips a published folder, so the next queries never read a batch twice.

Views (``ad_user_click_total``, ``ad_realtime_stat``, ...) read those
partitions. ``compact()`` folds them (see ``folded``).
"""

from __future__ import annotations

import uuid

from pyspark import InheritableThread
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from footfall.functions.columns import format_date_key
from footfall.operators import ad_click as ac
from footfall.sources.adlog import text_log_stream
from footfall.streaming import click_state as cs
from footfall.streaming.folded import (GRACE_SECONDS, FoldedTable, delete, fs_path, make_dirs,
                                       overwrite_partitions, partitions)

FILTERED_SCHEMA = ("ts_ms BIGINT, province STRING, city STRING, user_id BIGINT, ad_id BIGINT, "
                   "click_time TIMESTAMP, date DATE, date_key STRING, batch_id BIGINT")
COUNT_SCHEMA = ("user_id BIGINT, ad_id BIGINT, click_count BIGINT, total BIGINT, stamps BIGINT, "
                "date DATE, batch_id BIGINT")
BLACKLIST_SCHEMA = "user_id BIGINT, listed_batch BIGINT, batch_id BIGINT"
UPDATES_SCHEMA = ("province STRING, city STRING, ad_id BIGINT, click_count BIGINT, "
                  "date_key STRING, batch_id BIGINT")
TOP_SCHEMA = "province STRING, ad_id BIGINT, click_count BIGINT, date STRING, batch_id BIGINT"
BAD_SCHEMA = "line STRING, batch_id BIGINT"

SEED_BATCH = -1
# Top-N partitions kept behind the newest one of a day (readers that listed them)
TOP_KEPT = 50


def _run_concurrently(*actions) -> list:
    """Run independent Spark actions as concurrent jobs; results in order,
    the first failure re-raised. The threads inherit the caller's job group, so
    stopping the query cancels their jobs."""
    results: list = [None] * len(actions)
    errors: list = [None] * len(actions)

    def run(i):
        try:
            results[i] = actions[i]()
        except BaseException as e:  # noqa: BLE001 - re-raised below
            errors[i] = e

    threads = [InheritableThread(target=run, args=(i,)) for i in range(len(actions))]
    for t in threads:
        t.start()
    for t in threads:
        t.join()
    for e in errors:
        if e is not None:
            raise e
    return results


class AdClickStream:
    """Paths, queries and views of one ad-click deployment rooted at ``root``
    (a folder under the cluster's shared checkpoint dir)."""

    def __init__(self, spark: SparkSession, root: str,
                 threshold: int = ac.DEFAULT_BLACKLIST_THRESHOLD,
                 top_n: int = ac.DEFAULT_TOP_N,
                 state_retention: str | None = None,
                 stream_partitions: int | None = None,
                 keep_days: int | None = None,
                 max_files_per_trigger: int | None = None,
                 late_apart: bool = False):
        self.spark = spark
        self.root = root.rstrip("/")
        self.threshold = threshold
        self.top_n = top_n
        # None keeps every day's counts in the stat and top state (a late click
        # still updates its day, as in the reference); a delay such as "2 days"
        # bounds that state and drops clicks that arrive later than that from
        # the city counts and the Top-N, but not from the user totals.
        self.state_retention = state_retention
        # Days of counts kept in a user's state; None keeps all.
        self.keep_days = keep_days
        # Shuffle partitions of all queries (their micro-batch jobs and the
        # state store), captured when each query starts. AQE cannot coalesce
        # stateful partitions, so a batch-sized setting (e.g. 20,000) would
        # launch that many tasks per micro-batch.
        self.stream_partitions = stream_partitions
        # Admission control: files of the log, or folders' files of filtered clicks, that one
        # micro-batch of any query takes; None takes all that have landed.
        self.max_files_per_trigger = max_files_per_trigger
        # Admitted clicks stay in their batches behind the admit query (a batch split over two
        # would be judged by its own first half), so the setting above bounds that query only.
        self.late_apart = late_apart
        if late_apart and not state_retention:
            raise ValueError("late_apart needs state_retention")
        self._files_behind = None if late_apart else max_files_per_trigger
        if late_apart:
            for p in (self.admitted, self.late, self.newest):
                make_dirs(spark, p)
        for p in (self.source, self.filtered, self.seed, self.top, self.bad):
            make_dirs(spark, p)
        self.counts = FoldedTable(spark, self._p("tables/ad_user_click_count"), COUNT_SCHEMA, "date")
        self.listed = FoldedTable(spark, self._p("tables/black_list"), BLACKLIST_SCHEMA)
        self.updates = FoldedTable(spark, self._p("tables/ad_realtime_updates"), UPDATES_SCHEMA, "date_key")

    # --- layout -------------------------------------------------------------
    def _p(self, name: str) -> str:
        return f"{self.root}/{name}"

    source = property(lambda self: self._p("source"))
    filtered = property(lambda self: self._p("tables/filtered_clicks"))
    seed = property(lambda self: self._p("tables/seed_list"))
    top = property(lambda self: self._p("tables/ad_province_top"))
    bad = property(lambda self: self._p("tables/bad_lines"))
    admitted = property(lambda self: self._p("tables/admitted_clicks"))
    late = property(lambda self: self._p("tables/late_clicks"))
    newest = property(lambda self: self._p("tables/newest_click"))

    def _read(self, path: str, schema: str, spark: SparkSession | None = None) -> DataFrame:
        return (spark or self.spark).read.schema(schema).parquet(path)

    # --- setup --------------------------------------------------------------
    def seed_blacklist(self, users: DataFrame) -> None:
        """Users listed before the first batch."""
        users.select(F.col("user_id").cast("bigint").alias("user_id")).distinct() \
            .write.mode("overwrite").parquet(self.seed)

    def append_log(self, lines: DataFrame) -> None:
        """Land new log files (``value`` column) in the source folder."""
        lines.select("value").write.mode("append").text(self.source)

    def log_stream(self) -> DataFrame:
        return text_log_stream(self.spark, self.source, self.max_files_per_trigger)

    # --- query 0, with late_apart: late clicks to a side table ---------------
    def admit_query(self, lines: DataFrame | None = None, **trigger) -> StreamingQuery:
        lines = lines if lines is not None else self.log_stream()
        return self._start(ac.good_clicks(ac.parse_log(lines)).writeStream
                           .foreachBatch(self._admit_batch)
                           .option("checkpointLocation", self._p("checkpoints/admit"))
                           .trigger(**(trigger or {"processingTime": "5 seconds"})))

    def _admit_batch(self, clicks: DataFrame, batch_id: int) -> None:
        n = int(batch_id)
        spark = clicks.sparkSession
        older = [(int(v), p) for v, p, _ in partitions(spark, self.newest, "batch_id") if int(v) < n]
        before = spark.read.schema("newest TIMESTAMP").parquet(max(older)[1]) if older else None
        last = before.first()["newest"] if before is not None else None
        for v, p in sorted(older)[:-TOP_KEPT]:
            delete(spark, p)
        clicks = clicks.select(*cs.CLICK_COLUMNS).persist()
        try:
            horizon = F.lit(last).cast("timestamp") - F.expr(f"interval {self.state_retention}")
            is_late = F.coalesce(F.date_add("date", 1).cast("timestamp") <= horizon, F.lit(False))
            batch = F.lit(n).cast("bigint").alias("batch_id")
            newest = clicks.agg(F.greatest(F.max("click_time"), F.lit(last).cast("timestamp")).alias("newest"))
            _run_concurrently(
                lambda: overwrite_partitions(clicks.where(is_late).select("*", batch), self.late, "batch_id"),
                lambda: overwrite_partitions(newest.select("newest", batch), self.newest, "batch_id"))
            # last, so that a batch is admitted once all else of it is kept
            self._publish(clicks.where(~is_late), n, self.admitted)
        finally:
            clicks.unpersist()

    def late_clicks(self) -> DataFrame:
        """Clicks that no count has, by the batch of the admit query that met them."""
        return self._read(self.late, FILTERED_SCHEMA)

    # --- query 1: blacklist filter, daily counts, blacklist update ---------
    def _clicks(self, lines: DataFrame | None) -> DataFrame:
        if self.late_apart:
            return self.spark.readStream.schema(FILTERED_SCHEMA).parquet(self.admitted).drop("batch_id")
        return ac.good_clicks(ac.parse_log(lines if lines is not None else self.log_stream()))

    def filter_query(self, lines: DataFrame | None = None, **trigger) -> StreamingQuery:
        """``lines`` is for a deployment without an admit query, which reads the log otherwise."""
        seed = self._read(self.seed, "user_id BIGINT")
        # both uses of the clicks have this exchange and its columns in common, so Spark runs it once
        # and reads the log once; the time in its key spreads a hot user
        clicks = ac.drop_blacklisted(self._clicks(lines), seed).repartition("user_id", "ts_ms")
        counts = clicks.mapInArrow(cs.task_counts, cs.COUNTS_SCHEMA)
        steps = counts.groupBy("user_id").applyInPandasWithState(
            cs.user_step(self.threshold, self.keep_days), cs.OUTPUT_SCHEMA, cs.STATE_SCHEMA, "update", "NoTimeout")
        both = (clicks.select(F.lit(cs.CLICK).alias("kind"), *cs.CLICK_COLUMNS)
                .unionByName(steps, allowMissingColumns=True))
        return self._start(both.writeStream.outputMode("update")
                           .foreachBatch(self._filter_batch)
                           .option("checkpointLocation", self._p("checkpoints/filter"))
                           .trigger(**(trigger or {"processingTime": "5 seconds"})))

    def quarantine_query(self, lines: DataFrame | None = None, **trigger) -> StreamingQuery:
        """Lines that do not parse, as they came."""
        lines = lines if lines is not None else self.log_stream()
        return self._start(ac.bad_lines(ac.parse_log(lines)).writeStream
                           .foreachBatch(self._bad_batch)
                           .option("checkpointLocation", self._p("checkpoints/bad"))
                           .trigger(**(trigger or {"processingTime": "5 seconds"})))

    def _bad_batch(self, bad: DataFrame, batch_id: int) -> None:
        overwrite_partitions(bad.withColumn("batch_id", F.lit(int(batch_id)).cast("bigint")), self.bad, "batch_id")

    def _filter_batch(self, steps: DataFrame, batch_id: int) -> None:
        n = int(batch_id)
        steps = steps.persist()
        try:
            counts = steps.where(F.col("kind") == cs.COUNT).select(
                "date", "user_id", "ad_id", "click_count", "total", F.unix_timestamp().alias("stamps"))
            new = steps.where(F.col("kind") == cs.LISTED).select(
                "user_id", F.lit(n).cast("bigint").alias("listed_batch"))
            clicks = steps.where(F.col("kind") == cs.CLICK)
            barred = steps.where(F.col("kind") == cs.BARRED)
            # independent outputs: submitted as concurrent Spark jobs
            _run_concurrently(
                lambda: self.publish_filtered(ac.drop_blacklisted(clicks, barred).select(*cs.CLICK_COLUMNS), n),
                lambda: self.counts.write(counts, n),
                lambda: self.listed.write(new, n))
        finally:
            steps.unpersist()

    def publish_filtered(self, clicks: DataFrame, batch: int) -> None:
        self._publish(clicks, batch, self.filtered)

    def _publish(self, clicks: DataFrame, batch: int, table: str) -> None:
        """Write a batch's clicks beside the table and rename the finished folder into it."""
        final, fs = fs_path(self.spark, f"{table}/batch_id={batch}")
        mark, _ = fs_path(self.spark, f"{table}/batch_id={batch}/_SUCCESS")
        if fs.exists(mark):
            return
        staged = self._p(f"staging/filtered-{batch}-{uuid.uuid4().hex[:8]}")
        (clicks.write.option("mapreduce.fileoutputcommitter.marksuccessfuljobs", "true").parquet(staged))
        fs.delete(final, True)              # a leftover without the mark
        if not fs.rename(fs_path(self.spark, staged)[0], final):
            raise OSError(f"could not publish {final.toString()}")

    # --- queries 2 and 3: running city counts, province Top-N ---------------
    def _filtered_stream(self) -> DataFrame:
        reader = self.spark.readStream.schema(FILTERED_SCHEMA)
        if self._files_behind:
            reader = reader.option("maxFilesPerTrigger", str(self._files_behind))
        clicks = reader.parquet(self.filtered)
        return clicks.withWatermark("click_time", self.state_retention) if self.state_retention else clicks

    def _counting(self, name: str, keys: list[str], write, **trigger) -> StreamingQuery:
        counts = (self._filtered_stream().groupBy(F.window("click_time", "1 day").alias("day"), *keys)
                  .agg(F.count(F.lit(1)).alias("click_count"))
                  .select(format_date_key(F.col("day.start")).alias("date_key"), *keys, "click_count"))
        return self._start(counts.writeStream.outputMode("update")
                           .foreachBatch(write)
                           .option("checkpointLocation", self._p(f"checkpoints/{name}"))
                           .trigger(**(trigger or {"processingTime": "5 seconds"})))

    def stat_query(self, **trigger) -> StreamingQuery:
        return self._counting("stat", ["province", "city", "ad_id"],
                              lambda rows, n: self.updates.write(rows, int(n)), **trigger)

    def top_query(self, **trigger) -> StreamingQuery:
        return self._counting("top", ["province", "ad_id"], self._top_batch, **trigger)

    def _start(self, writer) -> StreamingQuery:
        if not self.stream_partitions:
            return writer.start()
        # a query clones the session at start, so the setting applies to it only
        key = "spark.sql.shuffle.partitions"
        previous = self.spark.conf.get(key)
        self.spark.conf.set(key, str(self.stream_partitions))
        try:
            return writer.start()
        finally:
            self.spark.conf.set(key, previous)

    def _top_batch(self, rows: DataFrame, batch_id: int) -> None:
        """Each touched day's whole Top-N table, from its last one and this batch's counts."""
        n = int(batch_id)
        spark = rows.sparkSession           # the query's own session and partition count
        rows = rows.persist()
        try:
            # parsed times bound the number of days; a batch has those of its clicks
            days = [r["date_key"] for r in rows.select("date_key").distinct().collect()]
            last = []
            for day in days:
                before = [(int(v), p) for v, p, _ in partitions(spark, f"{self.top}/date={day}", "batch_id")]
                older = [(v, p) for v, p in before if v < n]
                if older:
                    last.append(max(older)[1])
                for v, p in sorted(before)[:-TOP_KEPT]:
                    if v < n:
                        delete(spark, p)
            counts = rows.select("date_key", "province", "ad_id", "click_count")
            if last:
                kept = (spark.read.schema(TOP_SCHEMA).option("basePath", self.top).parquet(*last)
                        .select(F.col("date").alias("date_key"), "province", "ad_id", "click_count"))
                counts = counts.unionByName(kept).groupBy("date_key", "province", "ad_id").agg(
                    F.max("click_count").alias("click_count"))
            overwrite_partitions(ac.top_n_ads(counts, self.top_n).withColumn("batch_id", F.lit(n).cast("bigint")),
                                 self.top, "date", "batch_id")
        finally:
            rows.unpersist()

    # --- parsed-log archive (file sink, exactly-once via its metadata log) ----
    parsed = property(lambda self: self._p("tables/parsed_log"))

    def archive_query(self, **trigger) -> StreamingQuery:
        lines = self.log_stream()
        return (ac.good_clicks(ac.parse_log(lines)).writeStream.format("parquet")
                .option("path", self.parsed)
                .option("checkpointLocation", self._p("checkpoints/archive"))
                .partitionBy("date")
                .trigger(**(trigger or {"processingTime": "5 seconds"}))
                .start())

    def parsed_log(self) -> DataFrame:
        return self.spark.read.parquet(self.parsed)

    def run_arrivals(self, arrivals: list[DataFrame]) -> None:
        """Land and process several log arrivals in order, overlapping the
        downstream queries of one arrival with the filter query of the next (as
        they run side by side in production). The result does not depend on how
        the downstream queries split batches."""
        behind: list[StreamingQuery] = []
        for lines in arrivals:
            self.append_log(lines)
            if self.late_apart:
                self.admit_query(availableNow=True).awaitTermination()
            self.filter_query(availableNow=True).awaitTermination()
            for q in behind:
                q.awaitTermination()
            behind = [self.stat_query(availableNow=True), self.top_query(availableNow=True)]
        behind.append(self.quarantine_query(availableNow=True))
        for q in behind:
            q.awaitTermination()

    def run_available(self) -> None:
        """Process everything that has landed, then stop (tests, backfills)."""
        # the downstream queries must start after the filter query has committed
        quarantine = self.quarantine_query(availableNow=True)
        if self.late_apart:
            self.admit_query(availableNow=True).awaitTermination()
        self.filter_query(availableNow=True).awaitTermination()
        for q in (self.stat_query(availableNow=True), self.top_query(availableNow=True), quarantine):
            q.awaitTermination()

    # --- maintenance: fold per-batch partitions -----------------------------
    def compact(self, upto_batch: int | None = None, upto_stat_batch: int | None = None,
                grace: float = GRACE_SECONDS) -> None:
        """Fold the per-batch partitions of counts, listings and city updates.

        Defaults leave the newest batch of each query alone. Views stay the same
        before, during and after; folded partitions are deleted by a later call,
        once ``grace`` seconds have passed (see ``folded``)."""
        self.counts.fold(upto_batch, grace=grace)
        self.listed.fold(upto_batch, grace=grace)
        self.updates.fold(upto_stat_batch, self._newest_updates, grace=grace)

    @staticmethod
    def _newest_updates(rows: DataFrame) -> DataFrame:
        """Running counts only grow: the largest one of a key is the current one."""
        return rows.groupBy(*ac.CITY_AD_KEY).agg(F.max("click_count").alias("click_count"),
                                                 F.max("batch_id").alias("batch_id"))

    # --- read-side views ----------------------------------------------------
    def filtered_clicks(self) -> DataFrame:
        return self._read(self.filtered, FILTERED_SCHEMA)

    def daily_user_ad_count(self) -> DataFrame:
        """Per-batch counts, folded or not."""
        return self.counts.read()

    def ad_user_click_total(self) -> DataFrame:
        """SNK2 table: total clicks per (date, user, ad) and last update time."""
        return (self.counts.read().groupBy(*ac.USER_AD_KEY)
                .agg(F.sum("click_count").alias("click_count"), F.max("stamps").alias("stamps")))

    def black_list(self) -> DataFrame:
        """(user_id, batch_id): every listed user and the batch that listed it
        (-1 for the seed list)."""
        seed = self._read(self.seed, "user_id BIGINT").withColumn("batch_id", F.lit(SEED_BATCH).cast("bigint"))
        return seed.unionByName(self.blacklist_additions())

    def blacklist_additions(self) -> DataFrame:
        """SNK3: users added by the stream (not the seed list)."""
        return self.listed.read().select("user_id", F.col("listed_batch").alias("batch_id"))

    def ad_realtime_stat(self) -> DataFrame:
        return self._newest_updates(self.updates.read()).select(*ac.CITY_AD_KEY, "click_count")

    def ad_province_top3(self) -> DataFrame:
        """The newest Top-N of each day."""
        t = self._read(self.top, TOP_SCHEMA)
        newest = t.groupBy("date").agg(F.max("batch_id").alias("batch_id"))
        return t.join(newest, ["date", "batch_id"], "left_semi").select("date", "province", "ad_id", "click_count")

    def bad_lines(self) -> DataFrame:
        return self._read(self.bad, BAD_SCHEMA)
