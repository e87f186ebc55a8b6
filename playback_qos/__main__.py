"""Command line: run the streaming chain, or export Gold.

  python -m playback_qos [--shuffle-partitions N] run --base DIR
        [--trigger "30 seconds" | --available-now] [--late-days N]
        [--gold-mode complete|merge] [--salt-buckets N] [--telemetry-in DIR] [--telemetry-pattern GLOB] [--telemetry-late DELAY] [--fmt parquet]
  python -m playback_qos batch --base DIR [--since YYYY-MM-DD] [--fmt parquet]
  python -m playback_qos export --src DIR --dst DIR
"""

from __future__ import annotations

import argparse

from pyspark.sql import types as T

from playback_qos.plans.layers import write_layers
from playback_qos.schema import DISTRIBUTION, raw_schema
from playback_qos.session import get_spark
from playback_qos.sources.tables import export_gold, read_table
from playback_qos.streaming import jobs
from playback_qos.streaming.layout import Layout
from playback_qos.streaming.sinks import ensure_dir

TIER_TYPES = {"struct": DISTRIBUTION, "long": T.LongType(), "int": T.IntegerType()}


def main(argv=None) -> None:
    ap = argparse.ArgumentParser(prog="playback_qos")
    ap.add_argument("--shuffle-partitions", type=int, default=None,
                    help="spark.sql.shuffle.partitions (a stateful stream keeps the value of "
                         "its first start)")
    sub = ap.add_subparsers(dest="cmd", required=True)
    run = sub.add_parser("run", help="start the bronze/validation/silver/gold streams")
    run.add_argument("--base", required=True, help="shared base directory of all tables")
    run.add_argument("--fmt", default="parquet")
    run.add_argument("--trigger", default="30 seconds")
    run.add_argument("--available-now", action="store_true",
                     help="drain the available input through the four stages in order, then stop")
    run.add_argument("--late-days", type=int, default=None)
    run.add_argument("--gold-mode", choices=["complete", "merge"], default="merge")
    run.add_argument("--tier-type", choices=sorted(TIER_TYPES), default="struct")
    run.add_argument("--salt-buckets", type=int, default=None,
                     help="split hot keys in the streaming dedupes over N buckets")
    run.add_argument("--max-files-per-trigger", type=int, default=None,
                     help="bound every micro-batch to N input files")
    run.add_argument("--silver-dedupe", choices=["first_seen", "first_by_order"],
                     default="first_seen",
                     help="first_by_order keeps the earliest row per key (needs --late-days)")
    run.add_argument("--telemetry-in", default=None,
                     help="directory of player JSON-lines logs, or one log, which may grow: also run "
                          "the contract split and the buffering-interval pairing")
    run.add_argument("--telemetry-pattern", default="*", help="names of the logs in that directory")
    run.add_argument("--telemetry-late", default=jobs.LATE,
                     help="how late an event may come and still be paired (event time)")
    bat = sub.add_parser("batch", help="rebuild every layer table from source_raw, each once")
    bat.add_argument("--base", required=True)
    bat.add_argument("--fmt", default="parquet")
    bat.add_argument("--since", default=None, help="only rebuild days >= this date")
    bat.add_argument("--tier-type", choices=sorted(TIER_TYPES), default="struct")
    exp = sub.add_parser("export", help="copy a Gold table to Parquet")
    exp.add_argument("--src", required=True)
    exp.add_argument("--dst", required=True)
    exp.add_argument("--fmt", default="parquet")
    args = ap.parse_args(argv)

    conf = {}
    if args.shuffle_partitions:
        conf["spark.sql.shuffle.partitions"] = str(args.shuffle_partitions)
    spark = get_spark(conf=conf)
    for key, value in conf.items():  # also when the session already existed
        spark.conf.set(key, value)
    if args.cmd == "export":
        export_gold(spark, args.src, args.dst, args.fmt)
        return
    layout = Layout(args.base)
    tier = TIER_TYPES[args.tier_type]
    if args.cmd == "batch":
        raw = read_table(spark, layout.source_raw, args.fmt, schema=raw_schema(tier),
                         since=args.since)
        write_layers(spark, raw, layout, args.fmt, since=args.since)
        return
    if args.available_now:
        jobs.run_available_now(spark, layout, args.fmt, late_days=args.late_days,
                               tier_type=tier, gold_mode=args.gold_mode,
                               salt_buckets=args.salt_buckets,
                               max_files_per_trigger=args.max_files_per_trigger,
                               silver_dedupe=args.silver_dedupe)
        if args.telemetry_in:
            now = "available_now"
            jobs.await_all([jobs.stream_telemetry(spark, args.telemetry_in, layout, args.fmt, now,
                                                  pattern=args.telemetry_pattern)])
            jobs.await_all([jobs.stream_buffering_intervals(spark, layout, args.fmt, now,
                                                            late=args.telemetry_late)])
        return
    # long-running: every stage at once; each reads its input table as it grows
    for path in (layout.source_raw, layout.bronze, layout.validated, layout.silver):
        ensure_dir(spark, path)
    mf = args.max_files_per_trigger
    queries = [
        jobs.stream_bronze(spark, layout, args.fmt, args.trigger, args.late_days, mf,
                           tier_type=tier, salt_buckets=args.salt_buckets),
        jobs.stream_validation(spark, layout, fmt=args.fmt, trigger=args.trigger,
                               max_files_per_trigger=mf, tier_type=tier),
        jobs.stream_silver(spark, layout, args.fmt, args.trigger, args.late_days, mf,
                           tier_type=tier, dedupe_mode=args.silver_dedupe,
                           salt_buckets=args.salt_buckets),
        *jobs.stream_gold(spark, layout, args.fmt, args.trigger, max_files_per_trigger=mf,
                          tier_type=tier, mode=args.gold_mode, late_days=args.late_days),
    ]
    if args.telemetry_in:
        ensure_dir(spark, args.telemetry_in)
        ensure_dir(spark, layout.telemetry)
        queries += [
            jobs.stream_telemetry(spark, args.telemetry_in, layout, args.fmt, args.trigger,
                                  pattern=args.telemetry_pattern),
            jobs.stream_buffering_intervals(spark, layout, args.fmt, args.trigger, pending_days=7,
                                            late=args.telemetry_late,
                                            max_files_per_trigger=mf or jobs.TELEMETRY_FILES_PER_TRIGGER),
        ]
    spark.streams.awaitAnyTermination()
    jobs.await_all(queries, timeout=1)


if __name__ == "__main__":
    main()
