"""Large micro-batches: the feed's time slices, lookups in an empty index, instalments."""
import os
from datetime import datetime, timedelta

from pyspark.sql import functions as F

from txwatch import config, schema
from txwatch.schema import LEDGER_COLUMNS
from txwatch.sinks.key_index import KeyIndex
from txwatch.sinks.writers import move_folder, publish_batch
from txwatch.streaming import detector

START = datetime(2024, 3, 1)


def _raw(spark, n):
    """A row a minute by one user; every seventh comes from another country."""
    rows = [(f"t{i:04d}", "u", START + timedelta(minutes=i), "shop", 10.0, f"Town, {'AB'[i % 7 == 0]}", "USD")
            for i in range(n)]
    df = spark.createDataFrame(rows, "transaction_id string, user_id string, event_timestamp timestamp, "
                               "merchant_category string, amount double, location string, currency string")
    return df.select(*[F.col(c).cast(schema.RAW_TABLE[c].dataType) for c in LEDGER_COLUMNS]).withColumns(
        {"ingested_at": F.col("event_timestamp"), "event_date": F.to_date("event_timestamp")})


def test_a_batch_is_taken_in_slices_of_time(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(config, "FEED_BYTES_PER_CORE", 1)      # a file at a time
    sinks = detector.SinkPaths(f"file:{tmp_path}/tables")
    raw = _raw(spark, 200)
    publish_batch(raw.repartitionByRange(6, "event_timestamp"), sinks.feed, 0)
    query = detector.start_travel(spark, sinks, f"{tmp_path}/checkpoint", available_now=True)
    query.awaitTermination()
    taken = [p["numInputRows"] for p in query.recentProgress if p["numInputRows"]]
    assert len(taken) == 6
    assert sum(s["numRowsDroppedByWatermark"] for p in query.recentProgress for s in p["stateOperators"]) == 0
    countries = {}
    for i in range(200):
        countries.setdefault(i // 10, set()).add(i % 7 == 0)
    got = {r["transaction_id"] for r in detector.read_alerts(spark, sinks).collect()}
    assert got == {f"t{i:04d}" for i in range(200) if len(countries[i // 10]) > 1}


def test_feed_files_are_listed_in_order(spark, tmp_path):
    feed = str(tmp_path / "feed")
    for batch in (0, 1):
        publish_batch(spark.range(1000).repartitionByRange(16, "id"), feed, batch)
    files = sorted((os.path.getmtime(f"{feed}/batch_id={b}/{f}"), b, f) for b in (0, 1)
                   for f in os.listdir(f"{feed}/batch_id={b}") if f.startswith("part-"))
    assert [x[1:] for x in files] == sorted(x[1:] for x in files)
    assert len({x[0] for x in files}) == len(files) == 32


def test_an_empty_index_joins_nothing(spark, tmp_path):
    index = KeyIndex(spark, str(tmp_path / "none"), detector.KEY_SCHEMA)
    rows = _raw(spark, 3).select("transaction_id", "amount")
    plan = rows.join(index.known(rows), "transaction_id", "left")._jdf.queryExecution().optimizedPlan().toString()
    assert index.is_empty() and "Join" not in plan


def test_folders_of_no_rows_are_empty(spark, tmp_path):
    spark.range(3).write.parquet(str(tmp_path / "a"))
    move_folder(spark, str(tmp_path / "a"), str(tmp_path / "to/a"))
    move_folder(spark, str(tmp_path / "b"), str(tmp_path / "to/b"))
    assert spark.read.parquet(str(tmp_path / "to/a")).count() == 3 and os.listdir(tmp_path / "to/b") == []
