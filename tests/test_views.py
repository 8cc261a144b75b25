"""The SQL serving layer gives the same answers as the DataFrame operators."""

from pyspark.sql import functions as F

from conftest import SF_SMALL
from helpers import canonical
from txwatch.operators import alerts as alert_ops, reconcile, reports
from txwatch.plans import views
from txwatch.sources import events_feed


def test_views_match_operators(spark):
    t = events_feed.stored_tables(events_feed.transactions(spark, SF_SMALL))
    history = reconcile.reconcile_all_windows(t.raw, t.alerts, t.validated) \
        .withColumn("generated_at", F.col("window_end"))
    views.register(spark, t.raw, t.alerts, t.validated, history)

    got = views.fraud_by_category(spark).select(
        "merchant_category", "fraud_reason", "attempt_count", "total_amount", "max_amount",
        "first_detected", "last_detected")
    want = reports.category_report(t.alerts, rounded=False).select(*got.columns)
    assert canonical(reports.amounts_as_double(got).toPandas()) == \
        canonical(reports.amounts_as_double(want).toPandas())

    assert canonical(views.recent_alerts(spark).toPandas()) == \
        canonical(alert_ops.recent_alerts(t.alerts).toPandas())
    assert canonical(views.table_counts(spark).toPandas()) == \
        canonical(reports.table_counts(t.as_dict()).toPandas())
    summary = views.reconciliation_summary(spark)
    assert summary.count() == 120
    assert summary.first()["report_id"] == 120
