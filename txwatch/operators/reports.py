"""Aggregate reports over the stored tables."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from txwatch.functions.columns import (
    as_double, avg_cents, in_range, is_high_value, money, money_sum,
)
from txwatch.operators import rules


def side_by_side(*one_row_frames: DataFrame) -> DataFrame:
    """Put the columns of several one-row frames into one row.

    A union (missing columns NULL) and one global aggregate, so no join of any kind;
    each input is a global aggregate and has exactly one row.
    """
    stacked = one_row_frames[0]
    for frame in one_row_frames[1:]:
        stacked = stacked.unionByName(frame, allowMissingColumns=True)
    return stacked.agg(*[F.max(c).alias(c) for c in stacked.columns])


def window_scan(table: DataFrame, time_col: str, start, end) -> DataFrame:
    """Rows of one half-open time range; the predicate reaches the Parquet scan."""
    return table.where(in_range(time_col, start, end))


def count_and_sum(rows: DataFrame, count_alias: str, amount_alias: str,
                  distinct_key: str | None = None, distinct_amount: bool = False) -> DataFrame:
    """One row: COUNT(*) (or COUNT(DISTINCT key)) and COALESCE(SUM(amount), 0).

    With a distinct key the amount is still summed over all rows (an alert per rule),
    unless ``distinct_amount``: then each key's amount counts once.
    """
    if distinct_key:
        # per key first, then over keys: COUNT(DISTINCT key) and SUM(amount) from two
        # hash aggregations, without the row-duplicating rewrite of a mixed distinct agg
        per_key = rows.groupBy(distinct_key).agg(
            (F.max(money("amount")) if distinct_amount else F.sum(money("amount")))
            .alias("amount"))
        return per_key.agg(F.count(distinct_key).cast("long").alias(count_alias),
                           F.coalesce(F.sum("amount"), F.lit(0)).alias(amount_alias))
    return rows.agg(F.count(F.lit(1)).cast("long").alias(count_alias),
                    money_sum("amount").alias(amount_alias))


def category_report(alerts: DataFrame, rounded: bool = True) -> DataFrame:
    """Alerts by (merchant_category, fraud_reason): count, sum, avg, max; biggest first.

    ``rounded`` gives the CSV form (cents); otherwise the view form with first and last
    detection times.
    """
    aggs = [
        F.count(F.lit(1)).alias("attempt_count"),
        money_sum("amount").alias("total_amount"),
        F.count("amount").alias("_n"),
        F.max(money("amount")).alias("max_amount"),
    ]
    if not rounded:
        aggs += [F.min("detected_at").alias("first_detected"),
                 F.max("detected_at").alias("last_detected")]
    out = ["merchant_category", "fraud_reason", "attempt_count", "total_amount",
           "avg_amount", "max_amount"] + ([] if rounded else ["first_detected", "last_detected"])
    return (
        alerts.groupBy("merchant_category", "fraud_reason").agg(*aggs)
        .withColumn("avg_amount", avg_cents("total_amount", "_n"))
        .select(*out)
        .orderBy(F.desc("attempt_count"), "merchant_category", "fraud_reason")
    )


def table_counts(tables: dict[str, DataFrame]) -> DataFrame:
    """COUNT(*) of each named table, one row per table."""
    parts = [df.agg(F.count(F.lit(1)).alias("row_count"))
             .select(F.lit(name).alias("table_name"), "row_count")
             for name, df in tables.items()]
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


def last_location(tx: DataFrame) -> DataFrame:
    """Latest location and time per user (ties on time broken by transaction id)."""
    latest = F.max_by(F.col("location"), F.struct("event_timestamp", "transaction_id"))
    return (
        tx.where(F.col("user_id").isNotNull() & F.col("event_timestamp").isNotNull())
        .groupBy("user_id")
        .agg(latest.alias("last_location"),
             F.max("event_timestamp").alias("last_seen"),
             F.count(F.lit(1)).alias("n_transactions"))
    )


def flag_rate(tx: DataFrame) -> DataFrame:
    """Share of transactions flagged by either rule (one row).

    Two one-row aggregates set side by side; no per-row join back to ``tx``:
    flagged = high value + travel - (travel and high value).
    """
    hv = is_high_value("amount")
    overall = tx.agg(F.count(F.lit(1)).alias("n_transactions"),
                     F.count_if(hv).alias("n_high_value"))
    travel = rules.impossible_travel(tx).agg(F.count(F.lit(1)).alias("n_travel"),
                                             F.count_if(hv).alias("_n_both"))
    n_flagged = F.col("n_high_value") + F.col("n_travel") - F.col("_n_both")
    return (
        side_by_side(overall, travel)
        .withColumn("n_flagged", n_flagged)
        .withColumn("flag_rate", F.when(F.col("n_transactions") > 0,
                                        F.col("n_flagged") / F.col("n_transactions"))
                    .otherwise(F.lit(0.0)))
        .select("n_transactions", "n_high_value", "n_travel", "n_flagged", "flag_rate")
    )


def amounts_as_double(df: DataFrame) -> DataFrame:
    """Decimal columns as double (for report files and cross-engine comparison)."""
    return df.select(*[as_double(f.name).alias(f.name)
                       if f.dataType.typeName() == "decimal" else F.col(f.name)
                       for f in df.schema.fields])
