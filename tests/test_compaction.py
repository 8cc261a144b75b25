"""Packing small files: same rows, bounded files, running readers and writers, vacuum."""
from datetime import datetime, timedelta

import pytest

from helpers import canonical
from txwatch.functions.columns import country_of
from txwatch.sinks import compaction
from txwatch.streaming import detector, stored_reports

COLUMNS = "transaction_id string, user_id string, merchant_category string, amount double, " \
          "location string, currency string, event_timestamp timestamp"
CLOCK = detector.event_time_clock({"detected_at": 1, "batch_processed_at": 2})


def batch(spark, number, days=(1, 2)):
    rows = [(f"t{number}-{d}-{i}", f"u{i}", "Fuel", 4000.0 + 600 * i, f"City, {'US' if i % 2 else 'GB'}", "USD",
             datetime(2024, 1, d, number) + timedelta(minutes=i)) for d in days for i in range(6)]
    return spark.createDataFrame(rows, COLUMNS).withColumn("country", country_of("location")).coalesce(2)


def rows_of(spark, sinks):
    return [canonical(f(spark, sinks).toPandas()) for f in (detector.read_raw, detector.read_validated, detector.read_alerts)]


def files(df, day):
    return [f for f in df.inputFiles() if f"event_date=2024-01-0{day}/" in f]


def test_packed_tables_keep_their_rows(spark, tmp_path):
    sinks = detector.SinkPaths(str(tmp_path / "t"))
    assert not any(detector.compact_tables(spark, sinks).values())            # nothing is there yet
    for number in range(4):
        detector.write_ledger_batch(batch(spark, number), number, sinks, CLOCK)
    before, running = rows_of(spark, sinks), detector.read_raw(spark, sinks)
    assert len(files(running, 1)) >= 4
    packed = detector.compact_tables(spark, sinks, max_files=2, rows_per_file=20)
    assert packed[sinks.raw] == ["2024-01-01", "2024-01-02"]
    assert rows_of(spark, sinks) == before
    now = detector.read_raw(spark, sinks)
    assert 2 <= len(files(now, 1)) <= 3 and all("_packed" in f for f in now.inputFiles())
    assert running.count() == len(before[0])                                  # a reader from before reads on
    assert detector.compact_tables(spark, sinks, max_files=3, rows_per_file=20)[sinks.raw] == []
    # appends and replays go on over the packed table; other days stay as they are
    detector.write_ledger_batch(batch(spark, 3), 4, sinks, CLOCK)             # replayed
    assert rows_of(spark, sinks) == before
    detector.write_ledger_batch(batch(spark, 5, (1, 3)), 5, sinks, CLOCK)
    raw = detector.read_raw(spark, sinks)
    assert raw.count() == len(before[0]) + 12 and files(raw, 3)
    after = rows_of(spark, sinks)
    assert stored_reports.refresh(spark, sinks) == ["2024-01-01", "2024-01-02", "2024-01-03"]
    total = stored_reports.reconciled_windows(spark, sinks).groupBy().sum("total_ingress_count").first()[0]
    assert total == raw.count()
    # packed again with what came since, then the old files go
    assert detector.compact_tables(spark, sinks, max_files=2, rows_per_file=100)[sinks.raw] == ["2024-01-01"]
    assert rows_of(spark, sinks) == after
    assert compaction.vacuum(spark, sinks.raw) > 0 and compaction.vacuum(spark, sinks.raw) == 0
    assert rows_of(spark, sinks) == after
    detector.write_ledger_batch(batch(spark, 6, (1,)), 6, sinks, CLOCK)
    assert detector.read_raw(spark, sinks).count() == len(after[0]) + 6


def test_a_file_that_comes_meanwhile_stays_visible(spark, tmp_path, monkeypatch):
    sinks = detector.SinkPaths(str(tmp_path / "t"))
    for number in range(2):
        detector.write_ledger_batch(batch(spark, number, (1,)), number, sinks, CLOCK)
    publish = compaction._publish

    def late(*args):
        monkeypatch.setattr(compaction, "_publish", publish)
        detector.write_ledger_batch(batch(spark, 7, (1,)), 7, sinks, CLOCK)   # appended while the job ran
        publish(*args)

    monkeypatch.setattr(compaction, "_publish", late)
    compaction.compact(spark, sinks.raw, "event_date", detector.RAW_STREAM_SCHEMA, "event_timestamp", max_files=1)
    assert detector.read_raw(spark, sinks).count() == 18
    compaction.vacuum(spark, sinks.raw)
    assert detector.read_raw(spark, sinks).count() == 18


def test_two_packers(spark, tmp_path):
    root = str(tmp_path / "t")
    compaction._publish(spark, root, 0, {"column": "d", "packed": {}})
    with pytest.raises(RuntimeError):
        compaction._publish(spark, root, 0, {"column": "d", "packed": {}})
