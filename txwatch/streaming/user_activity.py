"""Running state per user: last location and flag rate, kept while messages come.

One streaming query (update mode) keeps a group per (10-minute window, user) in built-in
state: its rows, its high-value rows, its least and greatest country and its latest row.
Messages sent again are dropped by id.  A group lives until the watermark passes its window;
nothing is kept per user for ever.  Each micro-batch writes the groups it changed.  A group
only grows, so of its versions the one with most rows is the newest, whatever batch or replay
wrote it.  Both reports merge one row per group.

Rows that no table can hold do not count, nor do rows that come after their window closed
(``late_rows`` keeps those of the ledger).
"""

from __future__ import annotations

import zlib

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from txwatch import config
from txwatch.functions.columns import country_of, is_high_value
from txwatch.operators import ledger
from txwatch.schema import LEDGER_COLUMNS

GROUP = ["user_id", "window_start"]
GROUPS_SCHEMA = ("user_id string, window_start timestamp, n bigint, n_high bigint, least_country string, "
                 "greatest_country string, last_seen timestamp, last_id string, last_location string")


def activity_stream(tx: DataFrame, window: str = config.TRAVEL_WINDOW,
                    watermark: str = config.WATERMARK) -> DataFrame:
    """Changed groups of each micro-batch (update mode)."""
    rows, _ = ledger.conform(tx.withColumn("is_high", is_high_value("amount")), LEDGER_COLUMNS + ["is_high"])
    rows = (
        rows.withWatermark("event_timestamp", watermark)
        .withColumn("window", F.window("event_timestamp", window))
        .withColumn("at", F.timestamp_micros(F.unix_micros("event_timestamp")))
        .withColumn("country", country_of("location"))
        .select("window", "user_id", "transaction_id", "at", "is_high", "country", "location")
        .dropDuplicates(["window", "user_id", "transaction_id"])
    )
    return (
        rows.groupBy("window", "user_id")
        .agg(F.count(F.lit(1)).alias("n"), F.count_if("is_high").alias("n_high"),
             F.min("country").alias("least_country"), F.max("country").alias("greatest_country"),
             F.max(F.struct("at", "transaction_id", "location")).alias("last"))
        .select("user_id", F.col("window.start").alias("window_start"), "n", "n_high", "least_country",
                "greatest_country", F.col("last.at").alias("last_seen"),
                F.col("last.transaction_id").alias("last_id"), F.col("last.location").alias("last_location"))
    )


def start_activity(tx: DataFrame, table: str, checkpoint: str, available_now: bool = False,
                   trigger: str = "30 seconds") -> StreamingQuery:
    """Keep ``table`` up to date.  A folder per run and micro-batch: a retry replaces its
    own, a run with another checkpoint none."""
    run = f"{table.rstrip('/')}/run={zlib.crc32(checkpoint.encode()):08x}"

    def write(batch: DataFrame, batch_id: int) -> None:
        batch.write.mode("overwrite").parquet(f"{run}/batch_id={batch_id}")

    writer = (activity_stream(tx).writeStream.outputMode("update")
              .option("checkpointLocation", checkpoint).foreachBatch(write))
    return (writer.trigger(availableNow=True) if available_now
            else writer.trigger(processingTime=trigger)).start()


def read_groups(spark: SparkSession, table: str) -> DataFrame:
    """The newest version of each group."""
    versions = (spark.read.schema(GROUPS_SCHEMA).option("recursiveFileLookup", "true")
                .option("pathGlobFilter", "*.parquet").parquet(table))
    rest = [c for c in versions.columns if c not in GROUP]
    return versions.groupBy(*GROUP).agg(F.max(F.struct(*rest)).alias("g")).select(*GROUP, "g.*")


def last_location(spark: SparkSession, table: str) -> DataFrame:
    """Latest location and time per user, as ``operators.reports.last_location``."""
    latest = F.max_by(F.col("last_location"), F.struct("last_seen", "last_id"))
    return (read_groups(spark, table).groupBy("user_id")
            .agg(latest.alias("last_location"), F.max("last_seen").alias("last_seen"),
                 F.sum("n").alias("n_transactions")))


def flag_rate(spark: SparkSession, table: str) -> DataFrame:
    """Share of transactions flagged by either rule, as ``operators.reports.flag_rate``."""
    travel = F.col("least_country") < F.col("greatest_country")

    def total(c) -> Column:
        return F.coalesce(F.sum(c), F.lit(0).cast("bigint"))

    sums = read_groups(spark, table).agg(
        total("n").alias("n_transactions"), total("n_high").alias("n_high_value"),
        total(F.when(travel, F.col("n"))).alias("n_travel"),
        total(F.when(travel, F.col("n")).otherwise(F.col("n_high"))).alias("n_flagged"))
    return sums.withColumn("flag_rate", F.when(F.col("n_transactions") > 0,
                                               F.col("n_flagged") / F.col("n_transactions")).otherwise(F.lit(0.0)))
