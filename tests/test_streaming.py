"""Speed layer: micro-batch script (FIXTURES §4), replays, late rows, restart."""

import json
import os

import pytest
from pyspark.sql import functions as F

from txwatch import schema
from txwatch.sources import envelope
from txwatch.streaming import detector, late_rows


def write_batch(spark, folder, n, rows):
    """One JSON-envelope parquet file per micro-batch: rows = [(id, 'HH:MM', country)]."""
    data = []
    for tid, hhmm, cc in rows:
        payload = {"transaction_id": tid, "user_id": "u", "timestamp": f"2024-01-01T00:{hhmm}:00.000Z",
                   "merchant_category": "Dining", "amount": 10.0, "location": f"City, {cc}",
                   "currency": "USD"}
        data.append((b"u", json.dumps(payload).encode(), "t", 0, n, None, 0))
    df = spark.createDataFrame(data, schema.ENVELOPE)
    df.coalesce(1).write.mode("overwrite").parquet(os.path.join(folder, f"batch={n:03d}"))


def alert_ids(spark, sinks, reason="IMPOSSIBLE_TRAVEL"):
    if not detector.table_exists(spark, sinks.alerts):
        return []
    return sorted(r[0] for r in detector.read_alerts(spark, sinks)
                  .where(F.col("fraud_reason") == reason).select("transaction_id").collect())


SCRIPT = [
    [("a", "01", "US"), ("b", "02", "GB")],
    [("c", "03", "US")],
    [("d", "16", "US")],
    [("e", "04", "JP"), ("f", "12", "JP")],
    [("g", "40", "JP")],
]


@pytest.fixture()
def layer(spark, tmp_path):
    inbox = str(tmp_path / "inbox")
    os.makedirs(inbox)
    sinks = detector.SinkPaths(str(tmp_path / "tables"))
    return inbox, sinks, str(tmp_path / "ckpt")


def _source(spark, inbox):
    raw = (spark.readStream.schema(schema.ENVELOPE).option("maxFilesPerTrigger", "1")
           .option("recursiveFileLookup", "true").parquet(inbox))
    return envelope.parse_envelope(raw)


def test_travel_script_and_late_drop(spark, layer):
    inbox, sinks, ckpt = layer
    clock = detector.event_time_clock({"detected_at": 1})
    write_batch(spark, inbox, 0, SCRIPT[0])
    led = detector.start_ledger(_source(spark, inbox), sinks, ckpt + "/ledger", clock,
                                trigger="1 second")
    led.processAllAvailable()
    trav = detector.start_travel(spark, sinks, ckpt + "/travel", clock, trigger="1 second")
    try:
        trav.processAllAvailable()
        seen = [alert_ids(spark, sinks)]
        for n, rows in enumerate(SCRIPT[1:], start=1):
            write_batch(spark, inbox, n, rows)
            led.processAllAvailable()
            trav.processAllAvailable()
            seen.append(alert_ids(spark, sinks))
        assert seen[0] == ["a", "b"]                  # window 00:00 flagged
        assert seen[1] == ["a", "b", "c"]             # grown window: new row alerted
        assert seen[2] == ["a", "b", "c"]
        # after d (00:16) the watermark is 00:11 and window 00:00 has been closed by a
        # no-data batch, so e (00:04) is late: stored in the ledger, never alerted
        assert seen[3] == ["a", "b", "c", "d", "f"]
        assert seen[-1] == ["a", "b", "c", "d", "f"]
        raw = detector.read_raw(spark, sinks)
        assert raw.where("transaction_id = 'e'").count() == 1
        late = detector.read_late(spark, sinks).collect()
        assert [(r.transaction_id, r.late_reason) for r in late] == [("e", late_rows.REASON)]
        assert str(late[0].watermark) == "2024-01-01 00:11:00"
        # the late row was not passed on, so streaming state had nothing to drop unseen
        assert sum(s["numRowsDroppedByWatermark"] for p in trav.recentProgress
                   for s in p["stateOperators"]) == 0
    finally:
        led.stop()
        trav.stop()


def test_replays_and_restart_write_nothing_twice(spark, layer):
    inbox, sinks, ckpt = layer
    clock = detector.event_time_clock({"detected_at": 1, "batch_processed_at": 2})
    write_batch(spark, inbox, 0, SCRIPT[0] + SCRIPT[1])
    write_batch(spark, inbox, 1, SCRIPT[0])          # replayed messages
    tx = _source(spark, inbox)
    job = detector.start(tx, sinks, ckpt, clock, available_now=True)
    job.wait()
    first = detector.read_raw(spark, sinks).count()
    assert first == 3
    assert alert_ids(spark, sinks) == ["a", "b", "c"]
    # restart from the same checkpoints with one more file: only the new row lands
    write_batch(spark, inbox, 2, [("d", "05", "US"), ("a", "01", "US")])
    job = detector.start(_source(spark, inbox), sinks, ckpt, clock, available_now=True)
    job.wait()
    assert detector.read_raw(spark, sinks).count() == 4
    assert detector.read_validated(spark, sinks).count() == 4
    assert alert_ids(spark, sinks) == ["a", "b", "c", "d"]
    # a fresh checkpoint replays everything: the sinks still hold each key once
    job = detector.start(_source(spark, inbox), sinks, ckpt + "-fresh", clock, available_now=True)
    job.wait()
    assert detector.read_raw(spark, sinks).count() == 4
    alerts = detector.read_alerts(spark, sinks)
    assert alerts.count() == alerts.select("transaction_id", "fraud_reason").distinct().count()


def test_keyed_state_form_emits_each_row_once(spark, layer):
    inbox, sinks, ckpt = layer
    for n, rows in enumerate(SCRIPT[:4]):
        write_batch(spark, inbox, n, rows)
    q = (detector.travel_stream(_source(spark, inbox)).writeStream
         .format("memory").queryName("travel_rows").outputMode("append")
         .option("checkpointLocation", ckpt + "/tws").trigger(availableNow=True).start())
    q.awaitTermination()
    got = [r[0] for r in spark.sql("select transaction_id from travel_rows").collect()]
    assert sorted(got) == sorted(set(got))            # no re-emission
    assert {"a", "b", "c"} <= set(got)
    assert {"d", "f"} <= set(got)


def test_stream_in_many_batches_equals_batch_rule(spark, tmp_path):
    """The feed cut into time-ordered files, one micro-batch each, the travel query
    triggered after every ledger batch: the final alert set equals the batch
    derivation (nothing is late)."""
    from conftest import SF_SMALL
    from txwatch.sources import events_feed
    from txwatch.streaming.catalog import FEED_CLOCK

    inbox = str(tmp_path / "events")
    os.makedirs(inbox)
    events = events_feed.read_events(spark, SF_SMALL)
    bounds = ["2024-01-01", "2024-01-06", "2024-01-11", "2024-01-16", "2024-01-21",
              "2024-01-26", "2024-02-01"]
    stream = (spark.readStream.schema(events.schema)
              .option("recursiveFileLookup", "true").option("pathGlobFilter", "*.parquet")
              .parquet(inbox))
    sinks = detector.SinkPaths(str(tmp_path / "tables"))
    ck = tmp_path / "ck"
    led = trav = None
    try:
        for i, (lo, hi) in enumerate(zip(bounds, bounds[1:])):
            (events.where((F.col("ts") >= lo) & (F.col("ts") < hi)).coalesce(1)
             .write.parquet(os.path.join(inbox, f"part={i}")))
            if led is None:
                led = detector.start_ledger(events_feed.transactions_from_events(stream), sinks,
                                            str(ck / "ledger"), FEED_CLOCK, trigger="1 second")
            led.processAllAvailable()
            if trav is None:
                trav = detector.start_travel(spark, sinks, str(ck / "travel"), FEED_CLOCK,
                                             trigger="1 second")
            trav.processAllAvailable()
        assert len([p for p in trav.recentProgress if p["numInputRows"] > 0]) == 6
        dropped = sum(s["numRowsDroppedByWatermark"] for p in trav.recentProgress
                      for s in p["stateOperators"])
        assert dropped == 0
    finally:
        for q in (led, trav):
            if q is not None:
                q.stop()

    want = events_feed.stored_tables(events_feed.transactions(spark, SF_SMALL)).alerts
    got = detector.read_alerts(spark, sinks)
    key = ["transaction_id", "fraud_reason", "detected_at"]
    assert got.count() == want.count()
    assert got.select(*key).exceptAll(want.select(*key)).count() == 0


def test_travel_stream_emits_each_row_once_and_forgets(spark, layer):
    """The joined stream alone: no row twice (a replayed one neither), nothing stored is
    read, and the state of passed windows goes."""
    inbox, sinks, ckpt = layer
    for n, rows in enumerate([*SCRIPT, SCRIPT[2] + SCRIPT[3][1:]]):
        write_batch(spark, inbox, n, rows)
    q = (detector.travel_rows_stream(_source(spark, inbox)).writeStream
         .format("memory").queryName("joined_rows").outputMode("append")
         .option("checkpointLocation", ckpt + "/joined").trigger(availableNow=True).start())
    q.awaitTermination()
    got = [r[0] for r in spark.sql("select transaction_id from joined_rows").collect()]
    # e is late, but no micro-batch closed its window before it came (FIXTURES 4)
    assert sorted(got) == ["a", "b", "c", "d", "e", "f"]
    plan = spark.streams.get(q.id) if q.isActive else q
    assert "transactions_raw" not in plan._jsq.explainInternal(True)
    assert sum(s["numRowsTotal"] for s in q.lastProgress["stateOperators"]) <= 4      # g alone is left


def test_upstream_dedup_within_watermark(spark, layer):
    inbox, sinks, ckpt = layer
    write_batch(spark, inbox, 0, SCRIPT[0] + SCRIPT[1])
    write_batch(spark, inbox, 1, SCRIPT[0])                # replayed messages
    q = detector.start_ledger(_source(spark, inbox), sinks, ckpt + "/ledger",
                              detector.event_time_clock({}), available_now=True,
                              dedup_within="1 hour")
    q.awaitTermination()
    ops = {s["operatorName"] for p in q.recentProgress for s in p["stateOperators"]}
    assert "dedupeWithinWatermark" in ops
    assert detector.read_raw(spark, sinks).count() == 3


def test_job_entry_point_backfill(spark, layer):
    """The command-line entry drains a folder of envelope files and exits."""
    from txwatch.streaming import job
    inbox, sinks, ckpt = layer
    write_batch(spark, inbox, 0, SCRIPT[0] + SCRIPT[1])
    job.main(["--source", "files", "--path", inbox + "/batch=000", "--tables", sinks.root,
              "--checkpoints", ckpt, "--available-now", "--profile", "local"])
    assert detector.read_raw(spark, sinks).count() == 3
    assert alert_ids(spark, sinks) == ["a", "b", "c"]


def _wait_for(check, seconds=90):
    import time
    end = time.time() + seconds
    while time.time() < end:
        if check():
            return True
        time.sleep(0.5)
    return False


def test_both_queries_start_on_an_empty_source(spark, layer):
    """Continuous mode: both queries run before anything arrives, rows come in several
    files while both are running, each writer appends to a root of its own."""
    inbox, sinks, ckpt = layer
    clock = detector.event_time_clock({"detected_at": 1})
    job = detector.start(_source(spark, inbox), sinks, ckpt, clock,
                         ledger_trigger="1 second", travel_trigger="1 second")
    try:
        assert job.travel is not None and all(q.isActive for q in job.queries())
        for n, rows in enumerate(SCRIPT[:3]):
            write_batch(spark, inbox, n, rows)
        write_batch(spark, inbox, 3, [("h", "17", "GB")])
        assert _wait_for(lambda: alert_ids(spark, sinks) == ["a", "b", "c", "d", "h"])
        assert all(q.isActive for q in job.queries())
        seen = [b["metrics"]["rows"] for b in job.metrics.batches if b["metrics"]]
        assert _wait_for(lambda: sum(b["metrics"]["rows"] for b in job.metrics.batches if b["metrics"]) == 5), seen
    finally:
        job.stop()


LONG = "x" * 130


@pytest.mark.parametrize("order", [0, 1])
def test_rejects_go_to_their_table(spark, tmp_path, order):
    from datetime import datetime
    t = datetime(2024, 1, 1)
    columns = "transaction_id string, user_id string, merchant_category string, amount double, " \
              "location string, currency string, event_timestamp timestamp"
    rows = [("good", "u", "m", 6000.0, "City, US", "USD", t), ("good", "u", "m", 6000.0, None, "USD", t),
            ("huge", "u", "m", 99999999999.99, "City, US", "USD", t), (None, "u", "m", 1.0, "City, US", "USD", t),
            ("long", "u", "m", 1.0, LONG, "USD", t), ("nan", "u", "m", float("nan"), "City, US", "USD", t),
            ("good", "u", "m", 6000.0, "City, US", "USD", t)]
    df = spark.createDataFrame(rows[::-1] if order else rows, columns)
    sinks = detector.SinkPaths(str(tmp_path / "tables"))
    for _ in range(2):                                   # a retried batch changes nothing
        detector.write_ledger_batch(df, 0, sinks)
        assert [r["transaction_id"] for r in detector.read_raw(spark, sinks).collect()] == ["good"]
        got = {(r["transaction_id"], r["reject_reason"]) for r in detector.read_rejected(spark, sinks).collect()}
        assert got == {("good", "location is null"), ("huge", "amount out of range"),
                       (None, "transaction_id is null"), ("long", "location longer than 128"),
                       ("nan", "amount out of range")}
        assert alert_ids(spark, sinks, "HIGH_VALUE") == ["good"]
    # the id alone is the key: another event time is a reject, in a later batch or the same
    later = [("good", "u", "m", 6000.0, "City, US", "USD", datetime(2024, 1, 2)),
             ("new", "u", "m", 1.0, "City, US", "USD", datetime(2024, 1, 3)),
             ("new", "u", "m", 1.0, "City, US", "USD", datetime(2024, 1, 2))]
    detector.write_ledger_batch(spark.createDataFrame(later, columns), 1, sinks)
    stored = {(r["transaction_id"], r["event_timestamp"].day) for r in detector.read_raw(spark, sinks).collect()}
    assert stored == {("good", 1), ("new", 2)}
    again = {(r["transaction_id"], r["event_timestamp"].day) for r in detector.read_rejected(spark, sinks)
             .where(F.col("reject_reason") == detector.SECOND_TIME).collect()}
    assert again == {("good", 2), ("new", 3)}


def test_only_touched_folders_are_read(spark, tmp_path):
    from txwatch.sinks import writers
    path = str(tmp_path / "t")
    days = spark.range(5).select("id", F.concat(F.lit("2024-01-0"), (F.col("id") + 1).cast("string")).alias("d"))
    days.write.partitionBy("d").parquet(path)
    part = writers.read_folders(spark, path, "d", ["2024-01-02", "2030-01-01"])
    assert len(part.inputFiles()) == 1 and "d=2024-01-02" in part.inputFiles()[0] and part.first()["id"] == 1


def test_window_totals_beyond_a_trillion(spark):
    from datetime import datetime
    from decimal import Decimal
    from txwatch.operators import reconcile
    from txwatch.sources import events_feed
    rows = [(f"t{i}", "u", datetime(2024, 1, 1, 1), "m", 9_999_999_999.99, "City, US", "USD", "US") for i in range(200)]
    tx = spark.createDataFrame(rows, "transaction_id string, user_id string, event_timestamp timestamp, "
                                     "merchant_category string, amount double, location string, currency string, country string")
    t = events_feed.stored_tables(tx)
    got = reconcile.reconcile_window(t.raw, t.alerts, t.validated, "2024-01-01 06:00:00").first()
    assert got["total_ingress_amount"] == Decimal("1999999999998.00")
