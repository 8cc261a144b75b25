"""Streaming keys: the speed layer run over the ``events`` feed to completion.

Each key starts both streaming queries on the feed (file source, ``availableNow``),
waits for them, and returns one of the sink tables read back.  Stored times follow
the feed's event time (detected_at = +1 minute, batch_processed_at = +2 minutes) so
the tables equal the batch derivation when nothing arrives late.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from txwatch import config
from txwatch.operators.reports import amounts_as_double
from txwatch.plans.catalog import RECENT_K
from txwatch.schema import ALERT_COLUMNS, LEDGER_COLUMNS
from txwatch.session import configure, shared_dir
from txwatch.sinks.writers import move_folder
from txwatch.sources import events_feed
from txwatch.streaming import detector, stored_reports, user_activity

FEED_CLOCK = detector.event_time_clock(
    {"detected_at": 1, "batch_processed_at": 2, "ingested_at": 0})


def feed_stream(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The events table as a file stream of transactions."""
    configure(spark)
    events_schema = events_feed.read_events(spark, sf_dir).schema
    events = (spark.readStream.schema(events_schema)
              .option("pathGlobFilter", "events.parquet")
              .parquet(sf_dir.rstrip("/")))
    return events_feed.transactions_from_events(events)


def run_feed(spark: SparkSession, sf_dir: str, travel: bool = True) -> detector.SinkPaths:
    """Run the speed layer over the whole feed once; return where it wrote.

    ``travel=False`` runs only the ledger query (enough for the stateless tables).
    """
    root = shared_dir(spark, "txwatch-stream")
    sinks = detector.SinkPaths(f"{root}/tables")
    tx = feed_stream(spark, sf_dir)
    if travel:
        # window state spread over one partition per core of the application
        detector.start(tx, sinks, f"{root}/checkpoints", clock=FEED_CLOCK,
                       available_now=True,
                       state_partitions=spark.sparkContext.defaultParallelism).wait()
    else:
        detector.start_ledger(tx, sinks, f"{root}/checkpoints/ledger", clock=FEED_CLOCK,
                              available_now=True).awaitTermination()
    return sinks


def stream_high_value(spark, sf_dir):
    sinks = run_feed(spark, sf_dir, travel=False)
    alerts = detector.read_alerts(spark, sinks)
    return amounts_as_double(alerts.where(F.col("fraud_reason") == config.HIGH_VALUE)
                             .select(*ALERT_COLUMNS, "detected_at"))


def stream_travel(spark, sf_dir):
    sinks = run_feed(spark, sf_dir)
    alerts = detector.read_alerts(spark, sinks)
    return amounts_as_double(alerts.where(F.col("fraud_reason") == config.IMPOSSIBLE_TRAVEL)
                             .select(*ALERT_COLUMNS, "detected_at"))


def stream_validated(spark, sf_dir):
    sinks = run_feed(spark, sf_dir, travel=False)
    return amounts_as_double(detector.read_validated(spark, sinks).select(*LEDGER_COLUMNS))


def stream_rejected(spark, sf_dir):
    """The feed with broken rows through the ledger query: what no table can hold."""
    root = shared_dir(spark, "txwatch-stream")
    sinks = detector.SinkPaths(f"{root}/tables")
    tx = events_feed.dirty_transactions(feed_stream(spark, sf_dir))
    detector.start_ledger(tx, sinks, f"{root}/checkpoints/ledger", clock=FEED_CLOCK,
                          available_now=True).awaitTermination()
    return detector.read_rejected(spark, sinks)


def stream_late(spark, sf_dir):
    """The feed in instalments, some messages an instalment late, through the ledger query:
    the stored rows whose travel window had closed."""
    root = shared_dir(spark, "txwatch-stream")
    sinks = detector.SinkPaths(f"{root}/tables")
    configure(spark)
    events = events_feed.read_events(spark, sf_dir)
    # the events are dealt to their instalments in one pass
    events.withColumn("part", events_feed.instalment()).write.partitionBy("part").parquet(f"{root}/instalments")
    for n in range(events_feed.INSTALMENTS + 1):
        # each run of the query takes what has come as one micro-batch
        move_folder(spark, f"{root}/instalments/part={n}", f"{root}/inbox/part={n}")
        tx = events_feed.transactions_from_events(
            spark.readStream.schema(events.schema).option("recursiveFileLookup", "true")
            .option("pathGlobFilter", "*.parquet").parquet(f"{root}/inbox"))
        detector.start_ledger(tx, sinks, f"{root}/checkpoints/ledger", clock=FEED_CLOCK,
                              available_now=True).awaitTermination()
    return amounts_as_double(detector.read_late(spark, sinks).drop("event_date"))


def _activity(spark, sf_dir) -> str:
    root = shared_dir(spark, "txwatch-stream")
    user_activity.start_activity(feed_stream(spark, sf_dir), f"{root}/user_windows", f"{root}/checkpoints/activity",
                                 available_now=True).awaitTermination()
    return f"{root}/user_windows"


def stream_last_location(spark, sf_dir):
    """Last location per user from the running state's groups."""
    return user_activity.last_location(spark, _activity(spark, sf_dir))


def stream_flag_rate(spark, sf_dir):
    """Share of flagged transactions from the running state's groups."""
    return user_activity.flag_rate(spark, _activity(spark, sf_dir))


def _refreshed(spark, sf_dir):
    sinks = run_feed(spark, sf_dir)
    stored_reports.refresh(spark, sinks)
    return sinks


def stored_fraud_by_category(spark, sf_dir):
    """The category report from the stored days' partials."""
    return amounts_as_double(stored_reports.fraud_by_category(spark, _refreshed(spark, sf_dir)))


def stored_reconcile_windows(spark, sf_dir):
    """All 6-hour reconciliations from the stored days' partials."""
    return amounts_as_double(stored_reports.reconciled_windows(spark, _refreshed(spark, sf_dir)))


def stored_recent_alerts(spark, sf_dir):
    """The newest alerts, opening the newest days only."""
    return amounts_as_double(stored_reports.recent_alerts(spark, _refreshed(spark, sf_dir), RECENT_K))


STREAM_QUERIES = {
    "stream_rejected": stream_rejected,
    "stream_high_value": stream_high_value,
    "stream_validated": stream_validated,
    "stream_travel": stream_travel,
    "stream_late": stream_late,
    "stream_last_location": stream_last_location,
    "stream_flag_rate": stream_flag_rate,
    "stored_fraud_by_category": stored_fraud_by_category,
    "stored_reconcile_windows": stored_reconcile_windows,
    "stored_recent_alerts": stored_recent_alerts,
}
