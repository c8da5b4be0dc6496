"""Job entry points for ``spark-submit``.

    spark-submit footfall/plans/cli.py area-top <task_id> --data DIR --out PATH
    spark-submit footfall/plans/cli.py session-stat <task_id> --data DIR --out PATH
    spark-submit footfall/plans/cli.py ad-stream --root PATH (--source DIR | --kafka HOSTS --topics T)
    spark-submit footfall/plans/cli.py ad-compact --root PATH

``area-top`` and ``session-stat`` run the task-parameterised J1 and J4 and
persist them; ``ad-stream`` starts the ad-click streaming queries with a 5-second
trigger and blocks until one stops; ``ad-compact`` folds the stream's per-batch
partitions beside the live stream and deletes those that an earlier run folded
at least ``--grace`` seconds ago.
"""

from __future__ import annotations

import argparse
import sys

from footfall.session import build_session, shared_dir


def parse_task_id(argv: list[str]) -> int | None:
    """SC5: the first argument as a task id; None when absent or not a number."""
    if not argv:
        return None
    try:
        return int(argv[0])
    except ValueError:
        return None


def main(argv: list[str] | None = None) -> int:
    argv = list(sys.argv[1:] if argv is None else argv)
    ap = argparse.ArgumentParser(prog="footfall")
    sub = ap.add_subparsers(dest="cmd", required=True)
    a = sub.add_parser("area-top")
    a.add_argument("task_id")
    a.add_argument("--data", default=None, help="folder with the parquet tables")
    a.add_argument("--catalog", action="store_true",
                   help="read user_visit_action / city_info / product_info / task from the catalog")
    a.add_argument("--out", default=None, help="result table path (default: shared dir)")
    a.add_argument("--source", default="events", choices=["events", "lineitem"])
    s = sub.add_parser("ad-stream")
    s.add_argument("--root", default=None, help="deployment folder (default: shared dir)")
    s.add_argument("--source", default=None, help="folder receiving text log files")
    s.add_argument("--kafka", default=None, help="bootstrap servers")
    s.add_argument("--topics", default=None, help="comma-separated topics")
    s.add_argument("--threshold", type=int, default=100)
    s.add_argument("--trigger", default="5 seconds")
    s.add_argument("--state-retention", default=None,
                   help="drop clicks later than this from city counts and Top-N (not from user totals)")
    s.add_argument("--late-apart", action="store_true",
                   help="with --state-retention: late clicks go to a side table before any count")
    s.add_argument("--keep-days", type=int, default=None, help="days of counts kept in a user's state")
    s.add_argument("--max-files-per-trigger", type=int, default=None,
                   help="files that one micro-batch takes (default: all that have landed)")
    s.add_argument("--stream-partitions", type=int, default=400,
                   help="shuffle/state partitions of the stream (fixed at the first start)")
    c = sub.add_parser("ad-compact")
    c.add_argument("--root", default=None, help="deployment folder (default: shared dir)")
    c.add_argument("--grace", type=float, default=3600.0, help="seconds that folded partitions stay")
    t = sub.add_parser("session-stat")
    t.add_argument("task_id")
    t.add_argument("--data", required=True, help="folder with the parquet tables")
    t.add_argument("--out", default=None, help="result table path (default: shared dir)")
    for p in (a, s, c, t):
        p.add_argument("--profile", default="cluster", choices=["cluster", "local"])
    args = ap.parse_args(argv)

    spark = build_session(app_name=f"footfall-{args.cmd}", profile=args.profile)
    if args.cmd == "area-top":
        from footfall.plans.area_jobs import run_task, run_task_on_tables

        task_id = parse_task_id([args.task_id])
        if task_id is None:
            ap.error("task_id must be a number")
        out = args.out or shared_dir(spark, "tables", "area_top10_product")
        if args.catalog:
            run_task_on_tables(spark, task_id, out)
        elif args.data:
            run_task(spark, args.data, task_id, out, source=args.source)
        else:
            ap.error("give --data DIR or --catalog")
        return 0

    if args.cmd == "session-stat":
        from footfall.plans.session_jobs import run_session_task

        task_id = parse_task_id([args.task_id])
        if task_id is None:
            ap.error("task_id must be a number")
        run_session_task(spark, args.data, task_id, args.out or shared_dir(spark, "tables", "session_aggr_stat"))
        return 0

    from footfall.sources.adlog import kafka_log_stream, text_log_stream
    from footfall.streaming.ad_stream import AdClickStream

    if args.cmd == "ad-compact":
        p = AdClickStream(spark, args.root or shared_dir(spark, "ad_click"))
        p.compact(grace=args.grace)
        return 0

    p = AdClickStream(spark, args.root or shared_dir(spark, "ad_click"),
                        threshold=args.threshold, state_retention=args.state_retention,
                        stream_partitions=args.stream_partitions, keep_days=args.keep_days,
                        max_files_per_trigger=args.max_files_per_trigger, late_apart=args.late_apart)
    if args.kafka:
        lines = kafka_log_stream(spark, args.kafka, args.topics or "")
    else:
        lines = text_log_stream(spark, args.source or p.source, args.max_files_per_trigger)
    queries = [p.admit_query(lines, processingTime=args.trigger)] if args.late_apart else []
    queries += [p.filter_query(lines, processingTime=args.trigger),
                p.quarantine_query(lines, processingTime=args.trigger),
                p.stat_query(processingTime=args.trigger), p.top_query(processingTime=args.trigger)]
    try:
        spark.streams.awaitAnyTermination()
    finally:
        for q in queries:
            q.stop()
    return 0


if __name__ == "__main__":
    sys.exit(main())
