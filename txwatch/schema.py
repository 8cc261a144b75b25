"""Declared schemas: message envelope, JSON payload and stored tables."""

from pyspark.sql.types import (
    BinaryType, DecimalType, DoubleType, IntegerType, LongType, StringType,
    StructField, StructType, TimestampType,
)

# Field and column names of the message contract and the stored tables.
# The JSON payload of one transaction message; every field nullable, extra fields ignored.
PAYLOAD = StructType([
    StructField("transaction_id", StringType(), True),
    StructField("user_id", StringType(), True),
    StructField("timestamp", StringType(), True),
    StructField("merchant_category", StringType(), True),
    StructField("amount", DoubleType(), True),
    StructField("location", StringType(), True),
    StructField("currency", StringType(), True),
])

# What a Kafka source yields; the file source in tests carries the same columns.
ENVELOPE = StructType([
    StructField("key", BinaryType(), True),
    StructField("value", BinaryType(), True),
    StructField("topic", StringType(), True),
    StructField("partition", IntegerType(), True),
    StructField("offset", LongType(), True),
    StructField("timestamp", TimestampType(), True),
    StructField("timestampType", IntegerType(), True),
])

# Parsed transaction stream (after from_json, event-time parse and country derivation).
TRANSACTION_COLUMNS = [
    "transaction_id", "user_id", "merchant_category", "amount", "location",
    "currency", "kafka_timestamp", "event_timestamp", "country",
]

# The 7 transaction columns every ledger table stores.
LEDGER_COLUMNS = [
    "transaction_id", "user_id", "event_timestamp", "merchant_category",
    "amount", "location", "currency",
]

# fraud_alerts columns (alert_id is assigned on read, see operators.numbering).
ALERT_COLUMNS = [
    "transaction_id", "user_id", "fraud_reason", "amount", "location",
    "merchant_category", "event_timestamp",
]

MONEY = DecimalType(12, 2)
TOTAL = DecimalType(38, 2)  # wide enough for any sum of MONEY

RAW_TABLE = StructType([
    StructField("transaction_id", StringType(), False),
    StructField("user_id", StringType(), False),
    StructField("event_timestamp", TimestampType(), False),
    StructField("merchant_category", StringType(), False),
    StructField("amount", MONEY, False),
    StructField("location", StringType(), False),
    StructField("currency", StringType(), False),
    StructField("ingested_at", TimestampType(), False),
])

VALIDATED_TABLE = StructType(
    [f for f in RAW_TABLE.fields if f.name != "ingested_at"]
    + [StructField("batch_processed_at", TimestampType(), False)]
)

ALERT_TABLE = StructType([
    StructField("transaction_id", StringType(), False),
    StructField("user_id", StringType(), False),
    StructField("fraud_reason", StringType(), False),
    StructField("amount", MONEY, False),
    StructField("location", StringType(), False),
    StructField("merchant_category", StringType(), False),
    StructField("event_timestamp", TimestampType(), False),
    StructField("detected_at", TimestampType(), False),
])

RECONCILIATION_TABLE = StructType([
    StructField("window_start", TimestampType(), False),
    StructField("window_end", TimestampType(), False),
    StructField("total_ingress_count", LongType(), False),
    StructField("total_ingress_amount", TOTAL, False),
    StructField("fraud_count", LongType(), False),
    StructField("fraud_amount", TOTAL, False),
    StructField("validated_count", LongType(), False),
    StructField("validated_amount", TOTAL, False),
    StructField("generated_at", TimestampType(), False),
    StructField("report_id", LongType(), True),
])

# transactions no table can hold, with every failed check
REJECT_TABLE = StructType([
    StructField(f.name, DoubleType() if f.name == "amount" else f.dataType, True)
    for f in RAW_TABLE.fields if f.name != "ingested_at"
] + [StructField("reject_reason", StringType(), False)])

WAREHOUSE_COLUMNS = LEDGER_COLUMNS + ["batch_processed_at"]
