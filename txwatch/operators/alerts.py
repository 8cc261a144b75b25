"""Alert rows, the alert table, the alert feed and the recent-alert list."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from txwatch import config
from txwatch.functions.columns import money
from txwatch.operators import rules


def alert_rows(flagged: DataFrame, reason: str) -> DataFrame:
    """The 7 alert columns of flagged transactions, reason as a literal."""
    return flagged.select(
        "transaction_id",
        "user_id",
        F.lit(reason).alias("fraud_reason"),
        money("amount").alias("amount"),
        "location",
        "merchant_category",
        "event_timestamp",
    )


def high_value_alerts(tx: DataFrame) -> DataFrame:
    return alert_rows(rules.high_value(tx), config.HIGH_VALUE)


def travel_alerts(tx: DataFrame, **skew_options) -> DataFrame:
    return alert_rows(rules.impossible_travel(tx, **skew_options), config.IMPOSSIBLE_TRAVEL)


def detected(alerts: DataFrame, detected_at: Column) -> DataFrame:
    """Stamp the detection time (the table default NOW(), injectable for tests)."""
    return alerts.withColumn("detected_at", detected_at)


def fraud_alerts(tx: DataFrame, detected_at: Column, **skew_options) -> DataFrame:
    """Both writers' rows in one table (UNION ALL: a row may match both rules)."""
    return (
        high_value_alerts(tx)
        .unionByName(travel_alerts(tx, **skew_options))
        .withColumn("detected_at", detected_at)
    )


def dedup_alerts(alerts: DataFrame) -> DataFrame:
    """One alert per (transaction_id, fraud_reason); the earliest detection wins.

    Partial aggregation first, so a replayed transaction with many copies shuffles one
    row per map task, not its copies.
    """
    value_cols = [c for c in alerts.columns if c not in ("transaction_id", "fraud_reason")]
    first = F.min_by(F.struct(*value_cols), F.col("detected_at"))
    return (
        alerts.groupBy("transaction_id", "fraud_reason")
        .agg(first.alias("_first"))
        .select("transaction_id", "fraud_reason", "_first.*")
        .select(*alerts.columns)
    )


def alert_feed(alerts: DataFrame) -> DataFrame:
    """One text line per alert (amount shown for HIGH_VALUE only); no driver collect."""
    line = F.when(
        F.col("fraud_reason") == config.HIGH_VALUE,
        F.format_string("ALERT | %s | %s | $%,.2f | %s", "transaction_id", "user_id",
                        F.col("amount").cast("double"), "location"),
    ).otherwise(
        F.format_string("TRAVEL ALERT | %s | %s | %s", "transaction_id", "user_id", "location")
    )
    return alerts.select("transaction_id", "fraud_reason", line.alias("line"))


def recent_alerts(alerts: DataFrame, k: int = 20) -> DataFrame:
    """Top-k newest alerts (ORDER BY detected_at DESC LIMIT k), ties broken by id.

    Planned as TakeOrderedAndProject: each task keeps its own top k, one merge of
    k x tasks rows.
    """
    return (
        alerts.orderBy(F.desc("detected_at"), F.asc("transaction_id"), F.asc("fraud_reason"))
        .limit(k)
        .select("fraud_reason", "merchant_category", "amount", "location", "detected_at")
    )
