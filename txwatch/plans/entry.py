"""The flagship query: HIGH_VALUE alerts of the feed, by merchant category."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from txwatch.operators import alerts as alert_ops
from txwatch.operators import reports
from txwatch.session import configure
from txwatch.sources import events_feed


def flagship(spark: SparkSession, sf_dir: str) -> DataFrame:
    """events -> transactions -> amount > 5000 -> alerts -> count/sum/avg/max per
    category, biggest first."""
    configure(spark)
    tx = events_feed.transactions(spark, sf_dir)
    alerts = alert_ops.detected(alert_ops.high_value_alerts(tx),
                                F.col("event_timestamp") + F.expr("INTERVAL 1 MINUTE"))
    return reports.amounts_as_double(reports.category_report(alerts, rounded=True))
