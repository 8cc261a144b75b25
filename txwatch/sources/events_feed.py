"""The given ``events`` table read as a transaction feed, and the tables it fills.

The test data carries no payment messages, so ``events`` is mapped to the payload's
columns.  The mapping is fixed (every oracle query repeats it in SQL):

    transaction_id     'txn_' + event_id left-padded with 0 to 12 digits
    user_id            'user_' + user_id left-padded with 0 to 6 digits
    event_timestamp    ts (as a timestamp in UTC)
    merchant_category  event_type
    amount             value as NUMERIC(12,2) times 50, as NUMERIC(12,2)
    location           'City-' + k + ', ' + country code, k = props.k,
                       code = 'C' and k mod 8
    currency           'USD'

Stored-table times: ingested_at = event time, detected_at = event time + 1 minute,
batch_processed_at = event time + 2 minutes (three distinct time axes).
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from txwatch import config
from txwatch.functions.columns import country_of
from txwatch.operators import alerts as alert_ops
from txwatch.operators import ledger, rules


def read_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/events.parquet")


def k_of(props="props") -> Column:
    """props.k (from_json with a one-field schema: a streaming parse that skips the
    rest of the document, cheaper than a JSON-path lookup)."""
    return F.from_json(F.col(props), "k INT").getField("k")


def location_of(k: Column) -> Column:
    code = F.concat(F.lit("C"), F.pmod(k, F.lit(8)).cast("string"))
    return F.concat(F.lit("City-"), k.cast("string"), F.lit(config.LOCATION_SEPARATOR), code)


def amount_of(value="value") -> Column:
    return (F.col(value).cast(config.MONEY_TYPE) * F.lit(50)).cast(config.MONEY_TYPE)


def transactions_from_events(events: DataFrame) -> DataFrame:
    """Events as parsed transactions (same columns as ``envelope.parse_envelope``)."""
    k = k_of()
    event_time = F.col("ts").cast("timestamp")
    return events.select(
        F.concat(F.lit("txn_"), F.lpad(F.col("event_id").cast("string"), 12, "0"))
        .alias("transaction_id"),
        F.concat(F.lit("user_"), F.lpad(F.col("user_id").cast("string"), 6, "0"))
        .alias("user_id"),
        F.col("event_type").alias("merchant_category"),
        amount_of().cast("double").alias("amount"),
        location_of(k).alias("location"),
        F.lit(config.DEFAULT_CURRENCY).alias("currency"),
        event_time.alias("kafka_timestamp"),
        event_time.alias("event_timestamp"),
    ).withColumn("country", country_of("location"))


def transactions(spark: SparkSession, sf_dir: str, event_range=None) -> DataFrame:
    """The feed; ``event_range=(lo, hi)`` keeps lo <= ts < hi, filtered on the stored
    column itself so Parquet skips row groups outside it (pushdown)."""
    events = read_events(spark, sf_dir)
    if event_range is not None:
        lo, hi = event_range
        events = events.where((F.col("ts") >= F.lit(str(lo)).cast("timestamp_ntz"))
                              & (F.col("ts") < F.lit(str(hi)).cast("timestamp_ntz")))
    return transactions_from_events(events)


def dirty_transactions(tx: DataFrame) -> DataFrame:
    """A feed with broken rows, chosen by the data (props.k), for conformance:

    k = 13 amount NULL; k = 42 user NULL; k = 77 currency NULL;
    k = 99 location 130 characters; k = 7 amount x 1e9 (over NUMERIC(12,2)).
    """
    k = F.regexp_extract(F.col("location"), r"City-(\d+),", 1).cast("int")
    return tx.select(
        "transaction_id",
        F.when(k == 42, F.lit(None).cast("string")).otherwise(F.col("user_id")).alias("user_id"),
        "event_timestamp",
        "merchant_category",
        F.when(k == 13, F.lit(None).cast("double"))
        .when(k == 7, F.col("amount") * F.lit(1e9)).otherwise(F.col("amount")).alias("amount"),
        F.when(k == 99, F.rpad(F.col("location"), 130, "x")).otherwise(F.col("location"))
        .alias("location"),
        F.when(k == 77, F.lit(None).cast("string")).otherwise(F.col("currency")).alias("currency"),
    )


# Replay fixture: what was stored before, and an incoming load of the whole feed in which
# the later messages come twice (replays overlap the stored period and themselves).
STORED_BEFORE = "2024-01-15 00:00:00"
REPLAYED_FROM = "2024-01-20 00:00:00"


# Late fixture: the feed comes in instalments of some days; messages with k mod 16 = 5 come
# one instalment after their own.
FIRST_DAY = "2024-01-01"
DAYS = 8
INSTALMENTS = 4


def instalment() -> Column:
    """Number of the instalment that an event comes in, from 0."""
    days = F.datediff(F.to_date("ts"), F.lit(FIRST_DAY).cast("date"))
    due = F.greatest(F.lit(0), F.least(F.lit(INSTALMENTS - 1), F.floor(days / DAYS).cast("int")))
    return due + F.when(F.pmod(k_of(), F.lit(16)) == 5, 1).otherwise(0)


def replayed_load(tx: DataFrame) -> DataFrame:
    """Every message of the feed, those from ``REPLAYED_FROM`` on twice."""
    again = F.col("event_timestamp") >= F.lit(REPLAYED_FROM).cast("timestamp")
    return tx.unionByName(tx.where(again))


def stored_before(table: DataFrame, time_col: str = "event_timestamp") -> DataFrame:
    return table.where(F.col(time_col) < F.lit(STORED_BEFORE).cast("timestamp"))


@dataclass
class StoredTables:
    """The pipeline's tables as the speed layer fills them from one feed."""
    raw: DataFrame
    alerts: DataFrame
    validated: DataFrame

    def as_dict(self) -> dict[str, DataFrame]:
        return {"transactions_raw": self.raw, "fraud_alerts": self.alerts,
                "validated_transactions": self.validated}


def stored_tables(tx: DataFrame) -> StoredTables:
    event_time = F.col("event_timestamp")
    raw = (ledger.ledger_rows(tx.where(F.col("amount").isNotNull()))
           .withColumn("ingested_at", event_time))
    alerts = alert_ops.fraud_alerts(tx, detected_at=event_time + F.expr("INTERVAL 1 MINUTE"))
    validated = (ledger.ledger_rows(rules.validated(tx))
                 .withColumn("batch_processed_at", event_time + F.expr("INTERVAL 2 MINUTES")))
    return StoredTables(raw=raw, alerts=alerts, validated=validated)
