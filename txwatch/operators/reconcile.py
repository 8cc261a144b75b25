"""6-hour reconciliation of ingress, flagged and validated amounts.

Each stored table is read on its own time axis: ingress by ``event_timestamp``,
alerts by ``detected_at``, validated rows by ``batch_processed_at``.
"""

from __future__ import annotations

from datetime import datetime, timedelta

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from txwatch import config
from txwatch.functions.columns import money, money_sum, pct, to_ts, window_start
from txwatch.operators.numbering import dense_number
from txwatch.operators.reports import count_and_sum, side_by_side, window_scan

TIME_AXES = {
    "ingress": ("event_timestamp", "total_ingress_count", "total_ingress_amount", None),
    "fraud": ("detected_at", "fraud_count", "fraud_amount", "transaction_id"),
    "validated": ("batch_processed_at", "validated_count", "validated_amount", None),
}
RECONCILED_COLUMNS = [
    "window_start", "window_end", "total_ingress_count", "total_ingress_amount",
    "fraud_count", "fraud_amount", "validated_count", "validated_amount",
]


def window_bounds(window_end, hours: int = config.BATCH_WINDOW_HOURS):
    """[window_end - hours, window_end) as two timestamps (text in, text out)."""
    end = window_end if isinstance(window_end, datetime) else datetime.fromisoformat(str(window_end))
    start = end - timedelta(hours=hours)
    return start.isoformat(sep=" "), end.isoformat(sep=" ")


def _totals(raw: DataFrame, alerts: DataFrame, validated: DataFrame):
    return {"ingress": raw, "fraud": alerts, "validated": validated}


def reconcile_window(raw: DataFrame, alerts: DataFrame, validated: DataFrame,
                     window_end, hours: int = config.BATCH_WINDOW_HOURS,
                     distinct_amount: bool = False) -> DataFrame:
    """One row for one window: counts and amounts of the three tables.

    The fraud count is distinct by transaction but its amount is a plain sum over
    alert rows (a row matching both rules counts its amount twice), as the reference
    computes it; ``distinct_amount`` counts each flagged transaction's amount once.
    Empty ranges give 0, not NULL.
    """
    start, end = window_bounds(window_end, hours)
    parts = []
    for name, table in _totals(raw, alerts, validated).items():
        time_col, n_alias, amount_alias, distinct = TIME_AXES[name]
        rows = window_scan(table, time_col, to_ts(start), to_ts(end))
        parts.append(count_and_sum(rows, n_alias, amount_alias, distinct,
                                   distinct_amount=distinct_amount))
    return (
        side_by_side(*parts)
        .select(to_ts(start).alias("window_start"), to_ts(end).alias("window_end"),
                *[F.col(c) for c in RECONCILED_COLUMNS[2:]])
        .transform(typed)
    )


def reconcile_all_windows(raw: DataFrame, alerts: DataFrame, validated: DataFrame,
                          hours: int = config.BATCH_WINDOW_HOURS) -> DataFrame:
    """Every epoch-aligned window that has rows on any axis, in one pass per table.

    Each table is aggregated per window on its own (partial aggregation keeps the
    shuffle at one row per window and task); the three small results are stacked and
    merged per window.  No join.
    """
    duration = f"{int(hours)} hours"
    parts = []
    for name, table in _totals(raw, alerts, validated).items():
        time_col, n_alias, amount_alias, distinct = TIME_AXES[name]
        rows = table.where(F.col(time_col).isNotNull()) \
            .withColumn("window_start", window_start(time_col, duration))
        if distinct:
            # per (window, key) then per window: distinct count and plain sum from two
            # hash aggregations (no row-duplicating distinct rewrite)
            rows = rows.groupBy("window_start", distinct).agg(
                F.sum(money("amount")).alias("amount"))
            n = F.count(distinct)
        else:
            n = F.count(F.lit(1))
        parts.append(rows.groupBy("window_start").agg(
            n.cast("long").alias(n_alias),
            F.coalesce(F.sum(money("amount")), F.lit(0)).alias(amount_alias)))
    stacked = parts[0]
    for p in parts[1:]:
        stacked = stacked.unionByName(p, allowMissingColumns=True)
    merged = stacked.groupBy("window_start").agg(
        *[F.coalesce(F.sum(c), F.lit(0)).alias(c) for c in RECONCILED_COLUMNS[2:]])
    return (
        merged.withColumn("window_end", F.col("window_start") + F.expr(f"INTERVAL {duration}"))
        .select(*RECONCILED_COLUMNS)
        .transform(typed)
    )


def typed(df: DataFrame) -> DataFrame:
    return df.select(*[
        F.col(c).cast(config.TOTAL_TYPE).alias(c) if c.endswith("_amount")
        else F.col(c).cast("long").alias(c) if c.endswith("_count")
        else F.col(c)
        for c in df.columns
    ])


def report_rows(reconciled: DataFrame, generated_at: Column) -> DataFrame:
    """Rows of the reconciliation table: + generated_at, + report_id.

    report_id numbers the rows by (window_start, generated_at), as a sequence
    would for runs in window order; numbering goes per day of window start.
    """
    return number_reports(reconciled.withColumn("generated_at", generated_at))


def number_reports(rows: DataFrame) -> DataFrame:
    """Stored reconciliation rows (history, one per run) with their report_id."""
    return dense_number(rows, ["window_start", "generated_at"],
                        F.to_date("window_start"), "report_id") \
        .select("report_id", *RECONCILED_COLUMNS, "generated_at")


def latest_per_window(rows: DataFrame) -> DataFrame:
    """The newest report of each window from a history where re-runs add rows
    (one partial aggregation per window; no window function over the table)."""
    latest = F.max_by(F.struct(*[c for c in rows.columns if c != "window_start"]),
                      F.col("generated_at"))
    return (rows.groupBy("window_start").agg(latest.alias("_r"))
            .select("window_start", "_r.*").select(*rows.columns))


def reconciliation_report(rows: DataFrame) -> DataFrame:
    """The 11-column report file: display headers, cents, shares of ingress amount."""
    h = config.RECONCILIATION_HEADERS
    fmt = "yyyy-MM-dd HH:mm:ss"
    amount = lambda c: F.col(c).cast("double")
    return rows.select(
        F.col("report_id").alias(h[0]),
        F.date_format("window_start", fmt).alias(h[1]),
        F.date_format("window_end", fmt).alias(h[2]),
        F.col("total_ingress_count").alias(h[3]),
        amount("total_ingress_amount").alias(h[4]),
        F.col("fraud_count").alias(h[5]),
        amount("fraud_amount").alias(h[6]),
        pct("fraud_amount", "total_ingress_amount").alias(h[7]),
        F.col("validated_count").alias(h[8]),
        amount("validated_amount").alias(h[9]),
        pct("validated_amount", "total_ingress_amount").alias(h[10]),
    )


def reconciliation_summary(rows: DataFrame) -> DataFrame:
    """All reports with fraud_percentage, newest first."""
    return (
        rows.withColumn("fraud_percentage", pct("fraud_amount", "total_ingress_amount"))
        .select("report_id", *RECONCILED_COLUMNS, "fraud_percentage", "generated_at")
        .orderBy(F.desc("generated_at"), F.desc("report_id"))
    )


__all__ = ["window_bounds", "reconcile_window", "reconcile_all_windows", "report_rows",
           "number_reports", "latest_per_window", "reconciliation_report",
           "reconciliation_summary", "money"]
