"""Keyed JSON transaction messages: sources, decode and encode.

A message is a Kafka-style envelope (``schema.ENVELOPE``): key = user id bytes,
value = UTF-8 JSON payload.  On a cluster the source is a Kafka topic; without the
Kafka connector (tests, replays) the same envelope columns are read from files.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from txwatch import schema
from txwatch.functions.columns import country_of, event_time_of, iso_event_time


def kafka_stream(spark: SparkSession, servers: str, topic: str,
                 starting_offsets: str = "latest", fail_on_data_loss: bool = False,
                 **options) -> DataFrame:
    """Subscribe to one topic.  Offsets that the broker has already deleted are skipped
    unless ``fail_on_data_loss`` is set.  No fixed consumer group: each query tracks its own
    offsets in its checkpoint, so several queries on one topic all see every message."""
    reader = (
        spark.readStream.format("kafka")
        .option("kafka.bootstrap.servers", servers)
        .option("subscribe", topic)
        .option("startingOffsets", starting_offsets)
        .option("failOnDataLoss", str(fail_on_data_loss).lower())
    )
    for key, value in options.items():
        reader = reader.option(key, value)
    return reader.load()


def file_stream(spark: SparkSession, path: str, fmt: str = "parquet",
                max_files_per_trigger: int | None = None, **options) -> DataFrame:
    """Envelope rows from files (one micro-batch per new file when throttled)."""
    reader = spark.readStream.format(fmt).schema(schema.ENVELOPE)
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", str(max_files_per_trigger))
    for key, value in options.items():
        reader = reader.option(key, value)
    return reader.load(path)


def parse_envelope(messages: DataFrame) -> DataFrame:
    """Envelope -> typed transactions.

    Malformed JSON gives an all-NULL payload; a wrong-typed field is NULL on its own;
    an event time without exactly three fraction digits is NULL (no exception).
    """
    read = messages.withColumn("message", F.from_json(F.decode("value", "UTF-8"), schema.PAYLOAD))
    derived = {
        "kafka_timestamp": F.col("timestamp"),
        "event_timestamp": event_time_of("message.timestamp"),
        "country": country_of("message.location"),
    }
    return read.select(*[derived.get(c, F.col(f"message.{c}")).alias(c)
                         for c in schema.TRANSACTION_COLUMNS])


def encode_messages(transactions: DataFrame, key_col: str = "user_id",
                    ts_col: str = "event_timestamp",
                    drop: tuple[str, ...] = ("is_fraud_injected", "fraud_type")) -> DataFrame:
    """Transactions -> envelope rows (key = user, value = JSON incl. explicit nulls).

    Label fields that must not leave the producer are dropped first.
    """
    tx = transactions.drop(*[c for c in drop if c in transactions.columns])
    payload = F.struct(
        F.col("transaction_id"),
        F.col("user_id"),
        iso_event_time(ts_col).alias("timestamp"),
        F.col("merchant_category"),
        F.col("amount").cast("double").alias("amount"),
        F.col("location"),
        F.col("currency"),
    )
    return tx.select(
        F.col(key_col).cast("binary").alias("key"),
        F.to_json(payload, {"ignoreNullFields": "false"}).cast("binary").alias("value"),
        F.col(ts_col).alias("timestamp"),
    )


def write_kafka(messages: DataFrame, servers: str, topic: str) -> None:
    """Publish envelope rows to a topic (needs the Kafka connector on the classpath)."""
    (messages.select("key", "value").write.format("kafka")
     .option("kafka.bootstrap.servers", servers).option("topic", topic).save())
