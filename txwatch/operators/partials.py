"""Mergeable partial results per day, from which reports over all history are read.

A day's partials (counts, exact sums, maxima, first and last times) come from that day's
stored rows alone and replace what was there, so days can be refreshed in any order and any
number of times.  Reports merge one row per day and group instead of scanning the tables.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from txwatch import config
from txwatch.functions.columns import avg_cents, money, window_start
from txwatch.operators.reconcile import RECONCILED_COLUMNS, TIME_AXES, typed

DAY = "event_date"
_TOTAL = T.DecimalType(38, 2)
CATEGORY_SCHEMA = T.StructType([
    T.StructField("merchant_category", T.StringType()), T.StructField("fraud_reason", T.StringType()),
    T.StructField("attempt_count", T.LongType()), T.StructField("total_amount", _TOTAL),
    T.StructField("n_amount", T.LongType()), T.StructField("max_amount", T.DecimalType(12, 2)),
    T.StructField("first_detected", T.TimestampType()), T.StructField("last_detected", T.TimestampType()),
    T.StructField(DAY, T.DateType())])
WINDOW_SCHEMA = T.StructType([
    T.StructField("axis", T.StringType()), T.StructField("window_start", T.TimestampType()),
    T.StructField("n", T.LongType()), T.StructField("amount", _TOTAL), T.StructField(DAY, T.DateType())])


def category_partials(alerts: DataFrame) -> DataFrame:
    """Per day, category and reason: what the category report adds up."""
    rows = alerts.groupBy(DAY, "merchant_category", "fraud_reason").agg(
        F.count(F.lit(1)).alias("attempt_count"),
        F.coalesce(F.sum(money("amount")), F.lit(0)).cast(_TOTAL).alias("total_amount"),
        F.count("amount").alias("n_amount"), F.max(money("amount")).alias("max_amount"),
        F.min("detected_at").alias("first_detected"), F.max("detected_at").alias("last_detected"))
    return rows.select(*CATEGORY_SCHEMA.fieldNames())


def category_report(partials: DataFrame) -> DataFrame:
    """``reports.category_report(alerts, rounded=False)`` from the days' partials."""
    return (
        partials.groupBy("merchant_category", "fraud_reason")
        .agg(F.sum("attempt_count").alias("attempt_count"),
             F.sum("total_amount").cast(_TOTAL).alias("total_amount"),
             F.sum("n_amount").alias("_n"), F.max("max_amount").alias("max_amount"),
             F.min("first_detected").alias("first_detected"), F.max("last_detected").alias("last_detected"))
        .withColumn("avg_amount", avg_cents("total_amount", "_n"))
        .select("merchant_category", "fraud_reason", "attempt_count", "total_amount", "avg_amount",
                "max_amount", "first_detected", "last_detected")
        .orderBy(F.desc("attempt_count"), "merchant_category", "fraud_reason")
    )


def window_partials(raw: DataFrame, alerts: DataFrame, validated: DataFrame,
                    hours: int = config.BATCH_WINDOW_HOURS) -> DataFrame:
    """Per day, time axis and window: rows (alerts: distinct transactions) and amount.  A
    transaction lies on one day, so distinct counts of days add up."""
    parts = []
    for axis, table in (("ingress", raw), ("fraud", alerts), ("validated", validated)):
        time_col, _, _, distinct = TIME_AXES[axis]
        rows = table.where(F.col(time_col).isNotNull()) \
            .withColumn("window_start", window_start(time_col, f"{int(hours)} hours"))
        amount = F.sum(money("amount"))
        if distinct:
            rows = rows.groupBy(DAY, "window_start", distinct).agg(amount.alias("amount"))
            amount = F.sum("amount")
        parts.append(rows.groupBy(DAY, "window_start").agg(
            F.count(distinct or F.lit(1)).alias("n"), F.coalesce(amount, F.lit(0)).cast(_TOTAL).alias("amount"))
            .withColumn("axis", F.lit(axis)).select(*WINDOW_SCHEMA.fieldNames()))
    return parts[0].unionByName(parts[1]).unionByName(parts[2])


def reconciled_windows(partials: DataFrame, hours: int = config.BATCH_WINDOW_HOURS) -> DataFrame:
    """``reconcile.reconcile_all_windows`` from the days' partials."""
    sums = []
    for axis, (_, n_alias, amount_alias, _) in TIME_AXES.items():
        own = F.col("axis") == axis
        sums += [F.coalesce(F.sum(F.when(own, F.col("n"))), F.lit(0)).alias(n_alias),
                 F.coalesce(F.sum(F.when(own, F.col("amount"))), F.lit(0)).alias(amount_alias)]
    return (partials.groupBy("window_start").agg(*sums)
            .withColumn("window_end", F.col("window_start") + F.expr(f"INTERVAL {int(hours)} HOURS"))
            .select(*RECONCILED_COLUMNS).transform(typed))
