"""The speed layer: two streaming queries.

1. ``ledger`` (stateless, append) reads the parsed message stream.  Each micro-batch
   is de-duplicated by transaction once, persisted once, and fans out to HIGH_VALUE
   alerts, validated rows and the raw ledger, each an insert-or-ignore sink, so a
   replayed batch writes nothing twice.
2. ``travel`` reads the raw rows the ledger publishes per micro-batch (each batch
   appears whole, and only after its rows are stored) and joins the stream with itself
   per (10-minute window, user) in built-in streaming state (watermark 5 minutes, append
   mode): each row of a flagged window comes out once, also those of earlier
   micro-batches, and nothing stored is read again.  The insert-or-ignore alert sink keeps
   one alert per (transaction_id, fraud_reason) across replays.

``travel_stream`` is a second form of rule 2 that reads the message stream directly
and keeps the held rows in keyed state (``travel_state``); it emits each row once.

Sinks are Parquet tables under one root, partitioned by event date; the clock that
stamps detected_at / batch_processed_at / ingested_at is injectable.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.types import DateType, LongType, StringType, StructField, StructType, TimestampType

from txwatch import config, schema
from txwatch.functions.columns import country_of, is_high_value, is_validated, window_start
from txwatch.operators import alerts as alert_ops
from txwatch.operators import ledger
from txwatch.schema import ALERT_COLUMNS, LEDGER_COLUMNS
from txwatch.sinks.compaction import compact
from txwatch.sinks.key_index import KeyIndex
from txwatch.sinks.writers import (
    batch_bounds, insert_or_ignore_parquet, publish_batch, read_folders, read_table, table_exists,
)
from txwatch.session import ship_package
from txwatch.streaming import late_rows
from txwatch.streaming.late_rows import interval_ms
from txwatch.streaming.metrics import BatchMetricsListener, observed, observed_travel
from txwatch.streaming.stored_reports import note_days
from txwatch.streaming.travel_state import OUTPUT_SCHEMA, TravelProcessor


def _dated(table: StructType) -> StructType:
    """A stored table's schema as written by the speed layer (+ event_date partition)."""
    return StructType(list(table.fields) + [StructField("event_date", DateType(), True)])


RAW_STREAM_SCHEMA = _dated(schema.RAW_TABLE)
ALERT_STREAM_SCHEMA = _dated(schema.ALERT_TABLE)
VALIDATED_STREAM_SCHEMA = _dated(schema.VALIDATED_TABLE)
LATE_STREAM_SCHEMA = _dated(StructType([
    *[schema.RAW_TABLE[c] for c in LEDGER_COLUMNS],
    StructField("late_reason", StringType(), True), StructField("watermark", TimestampType(), True)]))

# A clock gives the value of a stored time column ("detected_at",
# "batch_processed_at" or "ingested_at") for the rows being written.
Clock = Callable[[str], Column]


def processing_time(_: str) -> Column:
    """NOW() of the stored tables: the time the batch is written."""
    return F.current_timestamp()


def event_time_clock(offsets_minutes: dict[str, int]) -> Clock:
    """A clock tied to each row's event time (replays and tests give stable rows)."""
    def clock(name: str) -> Column:
        return F.col("event_timestamp") + F.expr(f"INTERVAL {offsets_minutes.get(name, 0)} MINUTES")
    return clock


@dataclass
class SinkPaths:
    root: str
    alerts: str = field(init=False)
    validated: str = field(init=False)
    raw: str = field(init=False)
    feed: str = field(init=False)
    rejected: str = field(init=False)
    late: str = field(init=False)
    marks: str = field(init=False)
    keys: str = field(init=False)
    notes: str = field(init=False)
    by_category: str = field(init=False)
    by_window: str = field(init=False)

    def __post_init__(self):
        base = self.root.rstrip("/")
        self.alerts = f"{base}/fraud_alerts"
        self.validated = f"{base}/validated_transactions"
        self.raw = f"{base}/transactions_raw"
        # raw rows per micro-batch, each batch published atomically (travel input)
        self.feed = f"{base}/_feeds/raw_batches"
        # messages no table can hold, one folder per micro-batch
        self.rejected = f"{base}/rejected_transactions"
        # rows whose travel window had closed, and the event time each batch reached
        self.late = f"{base}/late_transactions"
        self.marks = f"{base}/_marks/ledger"
        # every stored transaction_id with its event time (sinks.key_index)
        self.keys = f"{base}/_keys/transactions"
        # days touched since the reports' partials were refreshed, and the partials
        self.notes = f"{base}/_notes/days"
        self.by_category = f"{base}/partials_by_category"
        self.by_window = f"{base}/partials_by_window"

    def alerts_of(self, reason: str) -> str:
        """Each rule's query appends to a root of its own, so neither commits (or cleans
        up) under the other's feet."""
        return f"{self.alerts}/reason={reason}"


KEY_SCHEMA = StructType([
    StructField("transaction_id", schema.RAW_TABLE["transaction_id"].dataType),
    StructField("event_timestamp", schema.RAW_TABLE["event_timestamp"].dataType),
])
SECOND_TIME = "transaction_id already stored with another event_timestamp"


def _judged(batch: DataFrame) -> DataFrame:
    """The batch's distinct rows as they can be stored (amounts in cents, flags of the row
    rules, which look at the amount as sent) or as they were sent, with ``reject_reason``.
    Constraints come before any cast, alert or dedup; copies combine before the shuffle."""
    good = F.col("reject_reason") == ""
    rows = ledger.with_reject_reason(batch, LEDGER_COLUMNS)
    return rows.select(
        *[c for c in LEDGER_COLUMNS if c != "amount"], "reject_reason",
        F.when(good, F.col("stored_amount")).alias("stored_amount"),
        F.when(~good, F.col("amount").cast("double")).alias("sent_amount"),
        F.when(good, F.coalesce(is_high_value("amount"), F.lit(False))).alias("is_high"),
        F.when(good, F.coalesce(is_validated("amount"), F.lit(False))).alias("is_valid")).distinct()


def _amount_named(rows: DataFrame, amount: str, *more: str) -> DataFrame:
    return rows.select(*[F.col(amount).alias(c) if c == "amount" else F.col(c) for c in LEDGER_COLUMNS], *more)


def _first_of_each_id(rows: DataFrame) -> DataFrame:
    """One row per transaction_id: the earliest, ties by all columns.  The aggregation
    combines copies before the shuffle, so a message replayed many times is one row."""
    rest = ["event_timestamp", *[c for c in rows.columns if c not in ("transaction_id", "event_timestamp")]]
    return (rows.groupBy("transaction_id").agg(F.min(F.struct(*rest)).alias("first"))
            .select("transaction_id", "first.*").select(*rows.columns))


def _with_event_date(df: DataFrame) -> DataFrame:
    return df.withColumn("event_date", F.to_date("event_timestamp"))


def write_ledger_batch(batch: DataFrame, batch_id: int, sinks: SinkPaths,
                       clock: Clock = processing_time) -> None:
    """Fan one stateless micro-batch out to alerts, validated, raw and rejected tables.

    Rows that cannot be stored (NULL in a NOT NULL column, too long, amount out of
    NUMERIC(12,2)) go to ``rejected_transactions`` instead of failing the query, and so
    does a transaction_id that is already stored (or comes in the batch) with another
    event time: the id alone is the key.  A bad copy never displaces a good one.
    """
    spark = batch.sparkSession
    # Contiguous time slices per task: every task writes few files per date, and their
    # min/max statistics make later key checks cheap.  Micro-batch plans run without AQE,
    # so the shuffle is sized to the cores of the application and to the batch.
    judged = _judged(batch).persist()             # the batch is read once
    accepted = _amount_named(judged.where(F.col("reject_reason") == ""), "stored_amount", "is_high", "is_valid")
    refused = _amount_named(judged.where(F.col("reject_reason") != ""), "sent_amount", "reject_reason")
    index = KeyIndex(spark, sinks.keys, KEY_SCHEMA, config.KEYS_PER_FILE)
    checked = rows = None
    try:
        size = accepted.count()
        n = max(spark.sparkContext.defaultParallelism, -(-size // config.ROWS_PER_SLICE))
        # ids with one accepted row, as a rule all of them, are their own first row
        single = accepted.groupBy("transaction_id").count().where("count > 1").limit(1).count() == 0
        if single and index.is_empty():
            checked = accepted.withColumn("known_time", F.lit(None).cast("timestamp"))
        else:
            known = index.known(accepted).withColumnRenamed("event_timestamp", "known_time")
            first = accepted if single else _first_of_each_id(accepted)
            checked = first.join(known, "transaction_id", "left").persist()
            if single:
                second = checked.where(F.col("event_timestamp") != F.col("known_time"))
            else:
                kept_time = checked.select("transaction_id", F.coalesce("known_time", "event_timestamp").alias("kept_time"))
                second = accepted.join(kept_time, "transaction_id").where(F.col("event_timestamp") != F.col("kept_time"))
            second = second.withColumn("reject_reason", F.lit(SECOND_TIME))
            refused = refused.unionByName(second.select(*[F.col(c).cast("double").alias(c) if c == "amount" else F.col(c)
                                                          for c in refused.columns])).distinct()
        refused = refused.persist()
        folder = f"{sinks.rejected}/batch_id={batch_id}"
        # one folder per micro-batch that has rejects: a retry replaces it
        if refused.count() or table_exists(spark, folder):
            refused.write.mode("overwrite").parquet(folder)
        refused.unpersist()
        rows = _with_event_date(
            checked.where(F.col("known_time").isNull() | (F.col("known_time") == F.col("event_timestamp"))))
        # sorted once, for the sinks' date folders and for the feed's slices
        rows = (rows.repartitionByRange(n, "event_date", "event_timestamp")
                .sortWithinPartitions("event_date", "event_timestamp").persist())
        bounds = batch_bounds(rows, "event_date", "event_timestamp")
        for done in (checked, judged):            # what is no longer read leaves the memory
            done.unpersist()
        before = late_rows.latest_before(spark, sinks.marks, batch_id)
        if bounds["lo"] is None:
            late_rows.note_latest(spark, sinks.marks, batch_id, before, None)
            return
        sink = dict(partition_col="event_date", time_col="event_timestamp",
                    bounds=bounds, deduplicated=True)
        keep = ["event_date"]
        hv_alerts, _ = ledger.conform(
            alert_ops.alert_rows(rows.where("is_high"), config.HIGH_VALUE)
            .withColumn("event_date", F.col("event_timestamp").cast("date")),
            ALERT_COLUMNS + keep)
        insert_or_ignore_parquet(hv_alerts.withColumn("detected_at", clock("detected_at")),
                                 sinks.alerts_of(config.HIGH_VALUE),
                                 ["transaction_id", "fraud_reason"], **sink)
        valid = rows.where("is_valid").select(*LEDGER_COLUMNS, *keep)
        insert_or_ignore_parquet(valid.withColumn("batch_processed_at", clock("batch_processed_at")),
                                 sinks.validated, ["transaction_id"], **sink)
        raw = rows.select(*LEDGER_COLUMNS, *keep)
        raw = raw.withColumn("ingested_at", clock("ingested_at"))
        insert_or_ignore_parquet(raw, sinks.raw, ["transaction_id"], **sink)
        # the batch's storable rows whose window is open, published whole for the travel
        # query once they are stored (replayed ones included: they only repeat countries
        # already counted); new rows of closed windows go to the late table
        watermark = late_rows.watermark_ms(before)
        if late_rows.any_late(bounds["lo_ms"], watermark):
            late = rows.where(F.col("known_time").isNull()).select(*LEDGER_COLUMNS, *keep)
            insert_or_ignore_parquet(late_rows.side_output(late, watermark), sinks.late,
                                     ["transaction_id"], **sink)
            raw = raw.where(~late_rows.window_closed(watermark))
        publish_batch(raw, sinks.feed, batch_id)
        late_rows.note_latest(spark, sinks.marks, batch_id, before, bounds["hi_ms"])
        note_days(spark, sinks.notes, "ledger", batch_id, bounds["values"])
        # last, so that a retry after a crash still finds its rows missing or equal
        index.add(rows.where(F.col("known_time").isNull()))
    finally:
        for kept in (judged, checked, refused, rows):
            if kept is not None:
                kept.unpersist()


def write_travel_batch(batch: DataFrame, batch_id: int, sinks: SinkPaths,
                       clock: Clock = processing_time) -> None:
    """Rows of a travel stream -> IMPOSSIBLE_TRAVEL alerts (insert-or-ignore).  The batch is
    run once: its plan moves streaming state."""
    alerts, _ = ledger.conform(
        _with_event_date(alert_ops.alert_rows(batch, config.IMPOSSIBLE_TRAVEL)),
        ALERT_COLUMNS + ["event_date"])
    alerts = alerts.persist()
    try:
        bounds = batch_bounds(alerts, "event_date", "event_timestamp")
        if bounds["lo"] is not None:
            insert_or_ignore_parquet(alerts.withColumn("detected_at", clock("detected_at")),
                                     sinks.alerts_of(config.IMPOSSIBLE_TRAVEL),
                                     ["transaction_id", "fraud_reason"], bounds=bounds,
                                     partition_col="event_date", time_col="event_timestamp",
                                     partitions=batch.sparkSession.sparkContext.defaultParallelism)
            note_days(batch.sparkSession, sinks.notes, "travel", batch_id, bounds["values"])
    finally:
        alerts.unpersist()


def read_alerts(spark, sinks: SinkPaths) -> DataFrame:
    """Alerts of both rules (the ``reason`` folders), as one table."""
    roots = [sinks.alerts_of(reason) for reason in (config.HIGH_VALUE, config.IMPOSSIBLE_TRAVEL)]
    parts = [read_table(spark, r, ALERT_STREAM_SCHEMA) for r in roots if table_exists(spark, r)]
    out = parts[0] if parts else spark.createDataFrame([], ALERT_STREAM_SCHEMA)
    return out.unionByName(parts[1]) if len(parts) > 1 else out


def compact_tables(spark, sinks: SinkPaths, days: list[str] | None = None, **limits) -> dict[str, list[str]]:
    """Pack the small files that micro-batches leave in the date folders of all tables."""
    tables = {sinks.raw: RAW_STREAM_SCHEMA, sinks.validated: VALIDATED_STREAM_SCHEMA,
              sinks.alerts_of(config.HIGH_VALUE): ALERT_STREAM_SCHEMA,
              sinks.alerts_of(config.IMPOSSIBLE_TRAVEL): ALERT_STREAM_SCHEMA}
    return {path: compact(spark, path, "event_date", table, "event_timestamp", days, **limits)
            for path, table in tables.items()}


def read_rejected(spark, sinks: SinkPaths) -> DataFrame:
    """Messages no table could hold, each once however often it was sent."""
    stored = StructType([*schema.REJECT_TABLE, StructField("batch_id", LongType())])
    if not table_exists(spark, sinks.rejected):
        return spark.createDataFrame([], stored).drop("batch_id")
    return read_table(spark, sinks.rejected, stored).drop("batch_id").distinct()


def read_late(spark, sinks: SinkPaths) -> DataFrame:
    """Stored rows that came after their travel window had closed."""
    if not table_exists(spark, sinks.late):
        return spark.createDataFrame([], LATE_STREAM_SCHEMA)
    return read_table(spark, sinks.late, LATE_STREAM_SCHEMA)


def read_validated(spark, sinks: SinkPaths) -> DataFrame:
    return read_table(spark, sinks.validated, VALIDATED_STREAM_SCHEMA)


def read_raw(spark, sinks: SinkPaths) -> DataFrame:
    return read_table(spark, sinks.raw, RAW_STREAM_SCHEMA)


def travel_stream(tx: DataFrame, window: str = config.TRAVEL_WINDOW,
                  watermark: str = config.WATERMARK) -> DataFrame:
    """Streaming rows of flagged (user, window) groups, each row once."""
    keyed = (
        tx.where(F.col("event_timestamp").isNotNull() & F.col("user_id").isNotNull())
        .withWatermark("event_timestamp", watermark)
        .dropDuplicatesWithinWatermark(["transaction_id"])
        .withColumn("window_start", window_start("event_timestamp", window))
        .select("user_id", "window_start", "transaction_id", "event_timestamp",
                "merchant_category", "amount", "location", "country")
    )
    ship_package(tx.sparkSession)      # the processor is imported by the Python workers
    return keyed.groupBy("user_id", "window_start").transformWithStateInPandas(
        statefulProcessor=TravelProcessor(interval_ms(window)),
        outputStructType=OUTPUT_SCHEMA,
        outputMode="Append",
        timeMode="EventTime",
    )


def travel_rows_stream(tx: DataFrame, window: str = config.TRAVEL_WINDOW,
                       watermark: str = config.WATERMARK) -> DataFrame:
    """Streaming rows of flagged (user, window) groups, each row once, from a built-in
    stream-stream join (append mode; all state goes when the watermark passes its window).

    One side keeps each country of a group once; a row that meets a country other than its
    own is flagged, in whichever micro-batch either came.  So a row meets as many rows as its
    group has countries, not as many as it has rows, and is passed on the first time only,
    also when its message is replayed.  Rows of the ledger always have a country.
    """
    rows = (
        tx.where(F.col("event_timestamp").isNotNull() & F.col("user_id").isNotNull() & F.col("country").isNotNull())
        .withWatermark("event_timestamp", watermark)
        .withColumn("window", F.window("event_timestamp", window))
        # the window alone carries the watermark: a stream has one event-time column
        .withColumn("at", F.timestamp_micros(F.unix_micros("event_timestamp")))
        .select("user_id", "window", "transaction_id", "at", "merchant_category",
                "amount", "location", "country")
    )
    group = ["user_id", "window"]
    countries = (rows.select(*group, F.col("country").alias("other")).dropDuplicates([*group, "other"]))
    return (rows.join(countries, group).where(F.col("country") != F.col("other"))
            .dropDuplicates([*group, "transaction_id"])
            .select("user_id", "window", "transaction_id", F.col("at").alias("event_timestamp"),
                    "merchant_category", "amount", "location", "country"))


def raw_ledger_stream(spark, sinks: SinkPaths) -> DataFrame:
    """Newly stored raw rows as a stream: the ledger's per-batch feed, where each
    micro-batch appears whole (see ``sinks.writers.publish_batch``)."""
    # a batch's files are slices in time order, listed in that order: wherever a micro-batch
    # ends, the watermark stays behind the rows that are still to come, and the state holds
    # a slice or two of a large batch instead of all its rows.  Files are deleted once their
    # micro-batch is committed, so the feed stays short
    return (spark.readStream.schema(RAW_STREAM_SCHEMA)
            .option("recursiveFileLookup", "true").option("pathGlobFilter", "*.parquet")
            .option("cleanSource", "delete")
            .option("maxBytesPerTrigger", config.FEED_BYTES_PER_CORE * spark.sparkContext.defaultParallelism)
            .parquet(sinks.feed)
            .withColumn("country", country_of("location")))


@dataclass
class Detector:
    ledger: StreamingQuery | None = None
    travel: StreamingQuery | None = None
    metrics: BatchMetricsListener | None = None

    def queries(self) -> list[StreamingQuery]:
        return [q for q in (self.ledger, self.travel) if q is not None]

    def wait(self) -> None:
        for q in self.queries():
            q.awaitTermination()

    def stop(self) -> None:
        for q in self.queries():
            q.stop()


def _trigger(writer, available_now: bool, every: str):
    return writer.trigger(availableNow=True) if available_now \
        else writer.trigger(processingTime=every)


def start_ledger(tx: DataFrame, sinks: SinkPaths, checkpoint: str,
                 clock: Clock = processing_time, available_now: bool = False,
                 trigger: str = "5 seconds", dedup_within: str | None = None
                 ) -> StreamingQuery:
    """The stateless query.  ``dedup_within`` (e.g. "1 hour") also drops replayed
    messages upstream with ``dropDuplicatesWithinWatermark``; off by default, because
    its watermark would also drop late rows that the row rules accept.  The sinks'
    insert-or-ignore makes replays harmless either way."""
    if dedup_within:
        tx = (tx.withWatermark("event_timestamp", dedup_within)
              .dropDuplicatesWithinWatermark(["transaction_id"]))
    return _trigger(
        tx.writeStream.outputMode("append").option("checkpointLocation", checkpoint)
        .foreachBatch(lambda df, bid: write_ledger_batch(df, bid, sinks, clock)),
        available_now, trigger).start()


def start_travel(spark, sinks: SinkPaths, checkpoint: str,
                 clock: Clock = processing_time, available_now: bool = False,
                 trigger: str = "30 seconds", state_partitions: int | None = None
                 ) -> StreamingQuery:
    """The travel rule over the raw ledger stream; the feed may still be empty.

    ``state_partitions`` fixes how many partitions the window state is spread over
    (kept in the checkpoint for the life of the query); by default the session's
    shuffle partitions.
    """
    feed = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(sinks.feed)
    feed.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).mkdirs(feed)
    flagged = observed_travel(travel_rows_stream(raw_ledger_stream(spark, sinks)))
    writer = _trigger(
        flagged.writeStream.outputMode("append").option("checkpointLocation", checkpoint)
        .foreachBatch(lambda df, bid: write_travel_batch(df, bid, sinks, clock)),
        available_now, trigger)
    if state_partitions is None:
        return writer.start()
    key = "spark.sql.shuffle.partitions"
    before = spark.conf.get(key)
    spark.conf.set(key, str(state_partitions))
    try:
        return writer.start()          # the query copies the session conf at start
    finally:
        spark.conf.set(key, before)


def start_travel_stateful(tx: DataFrame, sinks: SinkPaths, checkpoint: str,
                          clock: Clock = processing_time, available_now: bool = False,
                          trigger: str = "30 seconds") -> StreamingQuery:
    """The travel rule with rows held in keyed state (no ledger dependency)."""
    return _trigger(
        travel_stream(tx).writeStream.outputMode("append").option("checkpointLocation", checkpoint)
        .foreachBatch(lambda df, bid: write_travel_batch(df, bid, sinks, clock)),
        available_now, trigger).start()


def start(tx: DataFrame, sinks: SinkPaths, checkpoint_root: str,
          clock: Clock = processing_time, available_now: bool = False,
          ledger_trigger: str = "5 seconds", travel_trigger: str = "30 seconds",
          state_partitions: int | None = None) -> Detector:
    """Start the speed layer; each query has its own checkpoint under ``checkpoint_root``.

    With ``available_now`` (backfill, tests) the ledger is drained first and the travel
    query then drains its feed.  Otherwise both start at once, also on an empty source,
    and run until stopped.  Rows and alert counts per micro-batch are in ``metrics``.
    """
    base = checkpoint_root.rstrip("/")
    spark = tx.sparkSession
    metrics = BatchMetricsListener()
    spark.streams.addListener(metrics)
    ledger_q = start_ledger(observed(tx), sinks, f"{base}/ledger", clock, available_now, ledger_trigger)
    if available_now:
        ledger_q.awaitTermination()
    travel_q = start_travel(spark, sinks, f"{base}/travel", clock, available_now,
                            travel_trigger, state_partitions)
    return Detector(ledger=ledger_q, travel=travel_q, metrics=metrics)
