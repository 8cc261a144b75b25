"""The 6-hour batch chain for one window: extract, reconcile, warehouse, report row,
two CSV reports.

Every step is a Spark job on distributed frames; nothing passes through the driver
but paths and the window's two timestamps.  Re-running a window replaces its
warehouse partition and its CSV files and adds one more row to the report history
(latest-per-window is a read-side choice).
"""

from __future__ import annotations

from dataclasses import dataclass
from datetime import datetime, timezone

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from txwatch import schema
from txwatch.functions.columns import to_ts
from txwatch.operators import reconcile, reports
from txwatch.sinks.claims import next_number
from txwatch.sinks.writers import read_table, table_exists, write_csv_report, write_warehouse


@dataclass
class WindowRun:
    window_start: str
    window_end: str
    warehouse: str
    reports_table: str
    fraud_csv: str
    reconciliation_csv: str
    reconciliation: DataFrame       # this run's report row, with report_id


def run_window(spark: SparkSession, raw: DataFrame, alerts: DataFrame, validated: DataFrame,
               window_end, out_root: str, generated_at: datetime | None = None,
               hours: int = 6) -> WindowRun:
    """Run the chain for [window_end - hours, window_end)."""
    start, end = reconcile.window_bounds(window_end, hours)
    generated = generated_at or datetime.now(timezone.utc).replace(tzinfo=None)
    root = out_root.rstrip("/")
    stamp = f"{start[:10]}_{start[11:13]}"

    # T1+T2: the three totals of the window as one row (three time axes)
    reconciled = reconcile.reconcile_window(raw, alerts, validated, end, hours)

    # T3: validated rows of the window into date=/hour= of the window start
    extract = (reports.window_scan(validated, "batch_processed_at", to_ts(start), to_ts(end))
               .select(*schema.WAREHOUSE_COLUMNS))
    warehouse = f"{root}/warehouse"
    write_warehouse(extract, warehouse, start)

    # T4: one more row in the report history; its id is given once and kept
    reports_table = f"{root}/reconciliation_reports"
    last = 0
    if table_exists(spark, reports_table):
        last = read_table(spark, reports_table, schema.RECONCILIATION_TABLE) \
            .agg(F.max("report_id")).first()[0] or 0
    # claimed: two runs at once get two ids
    report_id = next_number(spark, f"{root}/_report_ids", above=last)
    (reconciled.withColumn("generated_at", F.lit(generated).cast("timestamp"))
     .withColumn("report_id", F.lit(report_id).cast("long"))
     .write.mode("append").parquet(reports_table))
    history = read_table(spark, reports_table, schema.RECONCILIATION_TABLE) \
        .where(F.col("report_id") == report_id)
    this_run = history.where((F.col("window_start") == to_ts(start))
                             & (F.col("generated_at") == F.lit(generated).cast("timestamp")))

    # T5: fraud by category (header only when the window has no alerts)
    fraud_csv = f"{root}/reports/fraud_by_category_{stamp}"
    in_window = reports.window_scan(alerts, "detected_at", to_ts(start), to_ts(end))
    write_csv_report(reports.amounts_as_double(reports.category_report(in_window)), fraud_csv)

    # T6: reconciliation report with display headers
    reconciliation_csv = f"{root}/reports/reconciliation_{stamp}"
    write_csv_report(reconcile.reconciliation_report(this_run), reconciliation_csv)

    return WindowRun(start, end, warehouse, reports_table, fraud_csv, reconciliation_csv, this_run)
