"""The serving layer in SQL: stored tables and the two analytical views as temp views
(built from the DataFrame operators), and the ad-hoc queries analysts type against
them, run through ``spark.sql``."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from txwatch.operators import reconcile, reports

RECENT_ALERTS = """
SELECT fraud_reason, merchant_category, amount, location, detected_at
FROM fraud_alerts
ORDER BY detected_at DESC, transaction_id, fraud_reason
LIMIT 20
"""
TABLE_COUNTS = """
SELECT 'transactions_raw' AS table_name, count(*) AS row_count FROM transactions_raw
UNION ALL SELECT 'fraud_alerts', count(*) FROM fraud_alerts
UNION ALL SELECT 'validated_transactions', count(*) FROM validated_transactions
"""


def register(spark: SparkSession, raw: DataFrame, alerts: DataFrame, validated: DataFrame,
             report_history: DataFrame | None = None) -> None:
    """Register the stored tables and the views over them (views carry no order; the
    queries below order their output)."""
    raw.createOrReplaceTempView("transactions_raw")
    alerts.createOrReplaceTempView("fraud_alerts")
    validated.createOrReplaceTempView("validated_transactions")
    reports.category_report(alerts, rounded=False).createOrReplaceTempView("fraud_by_category")
    if report_history is not None:
        rows = reconcile.number_reports(report_history)
        rows.createOrReplaceTempView("reconciliation_reports")
        reconcile.reconciliation_summary(rows).createOrReplaceTempView("reconciliation_summary")


def fraud_by_category(spark: SparkSession) -> DataFrame:
    return spark.sql("SELECT * FROM fraud_by_category "
                     "ORDER BY attempt_count DESC, merchant_category, fraud_reason")


def reconciliation_summary(spark: SparkSession) -> DataFrame:
    return spark.sql("SELECT * FROM reconciliation_summary "
                     "ORDER BY generated_at DESC, report_id DESC")


def recent_alerts(spark: SparkSession) -> DataFrame:
    return spark.sql(RECENT_ALERTS)


def table_counts(spark: SparkSession) -> DataFrame:
    return spark.sql(TABLE_COUNTS)
