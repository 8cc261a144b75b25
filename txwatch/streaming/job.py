"""Command-line entry for the speed layer: start both queries and block until one
of them stops (``awaitAnyTermination``), as a long-running service would.

    python -m txwatch.streaming.job --source kafka --servers host:9092 --topic t \\
        --tables hdfs:///tables --checkpoints hdfs:///ckpt --state-partitions 400
    python -m txwatch.streaming.job --source files --path /data/inbox ...
"""

from __future__ import annotations

import argparse

from txwatch.session import build_session
from txwatch.sources import envelope
from txwatch.streaming import detector


def main(argv: list[str] | None = None) -> None:
    ap = argparse.ArgumentParser(description=__doc__)
    ap.add_argument("--source", choices=["kafka", "files"], default="kafka")
    ap.add_argument("--servers")
    ap.add_argument("--topic", default="transactions")
    ap.add_argument("--path", help="folder of envelope files (files source)")
    ap.add_argument("--tables", required=True, help="root folder of the stored tables")
    ap.add_argument("--checkpoints", required=True, help="root folder of query checkpoints")
    ap.add_argument("--state-partitions", type=int, default=None,
                    help="partitions of the travel state, kept in the checkpoint for life; "
                         "required with --profile cluster")
    ap.add_argument("--ledger-trigger", default="5 seconds")
    ap.add_argument("--travel-trigger", default="30 seconds")
    ap.add_argument("--available-now", action="store_true",
                    help="backfill: drain what is there (ledger first, then travel) and exit")
    ap.add_argument("--profile", choices=["cluster", "local"], default="cluster")
    args = ap.parse_args(argv)
    if args.profile == "cluster" and args.state_partitions is None:
        ap.error("--state-partitions is required: executors may still be joining at start-up")

    spark = build_session(profile=args.profile)
    if args.source == "kafka":
        messages = envelope.kafka_stream(spark, args.servers, args.topic)
    else:
        messages = envelope.file_stream(spark, args.path)
    tx = envelope.parse_envelope(messages)
    job = detector.start(tx, detector.SinkPaths(args.tables), args.checkpoints,
                         available_now=args.available_now,
                         ledger_trigger=args.ledger_trigger, travel_trigger=args.travel_trigger,
                         state_partitions=args.state_partitions or spark.sparkContext.defaultParallelism)
    if args.available_now:
        job.wait()
    else:
        spark.streams.awaitAnyTermination()


if __name__ == "__main__":
    main()
