"""Every query the pipeline answers, as ``(spark, sf_dir) -> DataFrame``.

Inputs are the given tables (``events`` read as a transaction feed); the stored tables
are derived from it by the same operators the streaming job uses.  Money leaves as
double (exact sums of NUMERIC(12,2) cast at the end) so results compare across
engines.  Streaming keys live in ``txwatch.streaming.catalog``.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from txwatch import config, schema
from txwatch.functions.columns import to_ts, window_start
from txwatch.operators import alerts as alert_ops
from txwatch.operators import ledger, reconcile, reports, rules
from txwatch.operators.reports import amounts_as_double
from txwatch.session import configure, shared_dir
from txwatch.sources import envelope, events_feed

# The batch window used by the single-window keys (the DAG's logical date).
WINDOW_END = "2024-01-15 00:00:00"
RECENT_K = 20


def _tx(spark: SparkSession, sf_dir: str, event_range=None) -> DataFrame:
    configure(spark)
    return events_feed.transactions(spark, sf_dir, event_range)


def _tables(spark: SparkSession, sf_dir: str) -> events_feed.StoredTables:
    return events_feed.stored_tables(_tx(spark, sf_dir))


def _window():
    start, end = reconcile.window_bounds(WINDOW_END)
    return to_ts(start), to_ts(end)


def _window_tables(spark: SparkSession, sf_dir: str) -> events_feed.StoredTables:
    """Stored tables as far as one batch window can see them.

    The window reads ingress at event time, alerts at event + 1 minute and validated
    rows at event + 2 minutes, so it needs events in [start - 2 min, end).  Widened
    to whole travel windows, [floor10(start - 2 min), ceil10(end)), the travel rule
    flags exactly the same groups, and the range reaches the Parquet scan instead of
    the rule running over all history.
    """
    start, end = reconcile.window_bounds(WINDOW_END)
    lo, hi = travel_aligned_range(start, end, lead_minutes=2)
    return events_feed.stored_tables(_tx(spark, sf_dir, (lo, hi)))


def travel_aligned_range(start: str, end: str, lead_minutes: int):
    """[floor(start - lead), ceil(end)) on the travel-window grid, as text."""
    from datetime import datetime, timedelta
    step = int(config.TRAVEL_WINDOW.split()[0]) * 60
    epoch = datetime(1970, 1, 1)
    s = (datetime.fromisoformat(start) - timedelta(minutes=lead_minutes) - epoch).total_seconds()
    e = (datetime.fromisoformat(end) - epoch).total_seconds()
    lo = epoch + timedelta(seconds=(s // step) * step)
    hi = epoch + timedelta(seconds=-(-e // step) * step)
    return lo.isoformat(sep=" "), hi.isoformat(sep=" ")


# --- parse and rules -----------------------------------------------------------

def parse_transactions(spark, sf_dir):
    """events -> JSON messages -> parsed transactions (the decode path end to end)."""
    messages = envelope.encode_messages(_tx(spark, sf_dir))
    return envelope.parse_envelope(messages)


def encode_messages(spark, sf_dir):
    """Messages as text; the producer's label columns are in the input and must not leave."""
    tx = _tx(spark, sf_dir).withColumn("is_fraud_injected", F.lit(True)).withColumn("fraud_type", F.lit("x"))
    return envelope.encode_messages(tx).select(
        F.col("key").cast("string").alias("key"), F.col("value").cast("string").alias("value"), "timestamp")


def derive_country(spark, sf_dir):
    return _tx(spark, sf_dir).select("transaction_id", "location", "country")


def high_value(spark, sf_dir):
    return amounts_as_double(ledger.ledger_rows(rules.high_value(_tx(spark, sf_dir))))


def validated(spark, sf_dir):
    return amounts_as_double(ledger.ledger_rows(rules.validated(_tx(spark, sf_dir))))


def _conformed(spark, sf_dir):
    return ledger.conform(events_feed.dirty_transactions(_tx(spark, sf_dir)))


def conform_accepted(spark, sf_dir):
    return amounts_as_double(_conformed(spark, sf_dir)[0])


def conform_rejected(spark, sf_dir):
    return _conformed(spark, sf_dir)[1]


TRAVEL_ROW_COLUMNS = ["transaction_id", "user_id", "window_start", "event_timestamp",
                      "merchant_category", "amount", "location", "country"]


def travel_windows(spark, sf_dir):
    return rules.travel_windows(_tx(spark, sf_dir))


def impossible_travel(spark, sf_dir):
    return rules.impossible_travel(_tx(spark, sf_dir)).select(*TRAVEL_ROW_COLUMNS)


def impossible_travel_semi(spark, sf_dir):
    return rules.impossible_travel_semi(_tx(spark, sf_dir)).select(*TRAVEL_ROW_COLUMNS)


def impossible_travel_reduced(spark, sf_dir):
    return rules.impossible_travel_reduced(_tx(spark, sf_dir)).select(*TRAVEL_ROW_COLUMNS)


# --- alerts --------------------------------------------------------------------

def _detected_at():
    return F.col("event_timestamp") + F.expr("INTERVAL 1 MINUTE")


def alerts_high_value(spark, sf_dir):
    tx = _tx(spark, sf_dir)
    return amounts_as_double(alert_ops.detected(alert_ops.high_value_alerts(tx), _detected_at()))


def alerts_travel(spark, sf_dir):
    tx = _tx(spark, sf_dir)
    return amounts_as_double(alert_ops.detected(alert_ops.travel_alerts(tx), _detected_at()))


def fraud_alerts(spark, sf_dir):
    return amounts_as_double(_tables(spark, sf_dir).alerts)


def alert_feed(spark, sf_dir):
    return alert_ops.alert_feed(_tables(spark, sf_dir).alerts)


def recent_alerts(spark, sf_dir):
    return amounts_as_double(alert_ops.recent_alerts(_tables(spark, sf_dir).alerts, RECENT_K))


# --- ledgers -------------------------------------------------------------------

def raw_ledger(spark, sf_dir):
    """transactions_raw filled from a replayed load by both writers."""
    load = events_feed.replayed_load(_tx(spark, sf_dir))
    return amounts_as_double(ledger.raw_ledger(rules.high_value(load), rules.validated(load)))


def insert_or_ignore(spark, sf_dir):
    """validated rows of a replayed load that are not stored yet (the rows inserted)."""
    tx = _tx(spark, sf_dir)
    stored = events_feed.stored_before(ledger.ledger_rows(rules.validated(tx)))
    incoming = ledger.ledger_rows(rules.validated(events_feed.replayed_load(tx)))
    return amounts_as_double(ledger.insert_or_ignore(incoming, stored))


# --- window scans and totals ----------------------------------------------------

def scan_ingress_window(spark, sf_dir):
    start, end = _window()
    return amounts_as_double(
        reports.window_scan(_window_tables(spark, sf_dir).raw, "event_timestamp", start, end))


def scan_alerts_window(spark, sf_dir):
    start, end = _window()
    return amounts_as_double(
        reports.window_scan(_window_tables(spark, sf_dir).alerts, "detected_at", start, end))


def scan_validated_window(spark, sf_dir):
    start, end = _window()
    return amounts_as_double(
        reports.window_scan(_window_tables(spark, sf_dir).validated, "batch_processed_at", start, end))


def _partition_values(ts_col):
    return [F.date_format(ts_col, "yyyy-MM-dd").alias("date"),
            F.date_format(ts_col, "HH").alias("hour")]


def extract_validated(spark, sf_dir):
    """The warehouse extract of one window: 8 columns + its date/hour partition."""
    start, end = _window()
    rows = reports.window_scan(_window_tables(spark, sf_dir).validated, "batch_processed_at", start, end)
    return amounts_as_double(rows.select(*schema.WAREHOUSE_COLUMNS, *_partition_values(start)))


def warehouse_partitions(spark, sf_dir):
    """Every window's warehouse rows with the partition they are written to."""
    validated_rows = _tables(spark, sf_dir).validated
    ws = window_start("batch_processed_at", f"{config.BATCH_WINDOW_HOURS} hours")
    return amounts_as_double(validated_rows.select(*schema.WAREHOUSE_COLUMNS, *_partition_values(ws)))


def ingress_totals(spark, sf_dir):
    start, end = _window()
    rows = reports.window_scan(_window_tables(spark, sf_dir).raw, "event_timestamp", start, end)
    return amounts_as_double(reports.count_and_sum(rows, "total_count", "total_amount"))


def fraud_totals(spark, sf_dir):
    start, end = _window()
    rows = reports.window_scan(_window_tables(spark, sf_dir).alerts, "detected_at", start, end)
    return amounts_as_double(
        reports.count_and_sum(rows, "fraud_count", "fraud_amount", "transaction_id"))


def validated_totals(spark, sf_dir):
    start, end = _window()
    rows = reports.window_scan(_window_tables(spark, sf_dir).validated, "batch_processed_at", start, end)
    return amounts_as_double(reports.count_and_sum(rows, "validated_count", "validated_amount"))


def table_counts(spark, sf_dir):
    return reports.table_counts(_tables(spark, sf_dir).as_dict())


def fraud_report(spark, sf_dir):
    start, end = _window()
    rows = reports.window_scan(_window_tables(spark, sf_dir).alerts, "detected_at", start, end)
    return amounts_as_double(reports.category_report(rows, rounded=True))


def fraud_by_category(spark, sf_dir):
    return amounts_as_double(reports.category_report(_tables(spark, sf_dir).alerts, rounded=False))


def last_location(spark, sf_dir):
    return reports.last_location(_tx(spark, sf_dir))


def flag_rate(spark, sf_dir):
    return reports.flag_rate(_tx(spark, sf_dir))


# --- reconciliation -------------------------------------------------------------

def reconcile_window(spark, sf_dir):
    t = _window_tables(spark, sf_dir)
    return amounts_as_double(reconcile.reconcile_window(t.raw, t.alerts, t.validated, WINDOW_END))


def _all_windows(spark, sf_dir):
    t = _tables(spark, sf_dir)
    return reconcile.reconcile_all_windows(t.raw, t.alerts, t.validated)


def reconcile_all_windows(spark, sf_dir):
    return amounts_as_double(_all_windows(spark, sf_dir))


def _report_rows(spark, sf_dir):
    # a run for window [s, e) is stamped at e (injected clock: results are stable); the
    # rows are written once and numbered as stored, so the tables are scanned once
    path = shared_dir(spark, "reports")
    _all_windows(spark, sf_dir).withColumn("generated_at", F.col("window_end")).write.parquet(path)
    return reconcile.number_reports(spark.read.parquet(path))


def reconciliation_report_rows(spark, sf_dir):
    return amounts_as_double(_report_rows(spark, sf_dir))


def reconciliation_report(spark, sf_dir):
    return reconcile.reconciliation_report(_report_rows(spark, sf_dir))


def reconciliation_summary(spark, sf_dir):
    return amounts_as_double(reconcile.reconciliation_summary(_report_rows(spark, sf_dir)))


BATCH_QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "parse_transactions": parse_transactions,
    "derive_country": derive_country,
    "high_value": high_value,
    "validated": validated,
    "conform_accepted": conform_accepted,
    "conform_rejected": conform_rejected,
    "travel_windows": travel_windows,
    "impossible_travel": impossible_travel,
    "impossible_travel_semi": impossible_travel_semi,
    "impossible_travel_reduced": impossible_travel_reduced,
    "alerts_high_value": alerts_high_value,
    "alerts_travel": alerts_travel,
    "fraud_alerts": fraud_alerts,
    "alert_feed": alert_feed,
    "raw_ledger": raw_ledger,
    "insert_or_ignore": insert_or_ignore,
    "scan_ingress_window": scan_ingress_window,
    "scan_alerts_window": scan_alerts_window,
    "scan_validated_window": scan_validated_window,
    "extract_validated": extract_validated,
    "ingress_totals": ingress_totals,
    "fraud_totals": fraud_totals,
    "validated_totals": validated_totals,
    "table_counts": table_counts,
    "fraud_report": fraud_report,
    "fraud_by_category": fraud_by_category,
    "recent_alerts": recent_alerts,
    "reconcile_window": reconcile_window,
    "reconcile_all_windows": reconcile_all_windows,
    "reconciliation_report": reconciliation_report,
    "reconciliation_report_rows": reconciliation_report_rows,
    "reconciliation_summary": reconciliation_summary,
    "warehouse_partitions": warehouse_partitions,
    "last_location": last_location,
    "flag_rate": flag_rate,
    "encode_messages": encode_messages,
}
