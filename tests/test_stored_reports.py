"""Reports from stored partials: any order of late batches, retries, newest days only."""
from datetime import datetime, timedelta

import pytest
from pyspark.sql import functions as F

from helpers import canonical
from txwatch import config
from txwatch.functions.columns import country_of
from txwatch.operators import reconcile, reports
from txwatch.streaming import detector, stored_reports

COLUMNS = "transaction_id string, user_id string, merchant_category string, amount double, " \
          "location string, currency string, event_timestamp timestamp"
CLOCK = detector.event_time_clock({"detected_at": 400, "batch_processed_at": 2})     # detection falls into other windows


def batch(spark, day, n, start=0):
    t = datetime(2024, 1, day, 3)
    rows = [(f"t{day}-{i}", f"u{i % 4}", ["Fuel", "Travel"][i % 2], 10.25 + 1500.0 * (i % 9), f"City, {'US' if i % 3 else 'GB'}",
             "USD", t + timedelta(minutes=7 * i)) for i in range(start, n)]
    return spark.createDataFrame(rows, COLUMNS).withColumn("country", country_of("location"))


def store(spark, sinks, number, rows):
    detector.write_ledger_batch(rows, number, sinks, CLOCK)
    detector.write_travel_batch(rows.where("user_id = 'u1'"), number, sinks, CLOCK)   # alerts of the other rule


@pytest.mark.parametrize("order", [[1, 2, 3, 4], [4, 2, 1, 3]])
def test_partials_equal_the_scans_after_late_batches(spark, tmp_path, order):
    sinks = detector.SinkPaths(str(tmp_path / "t"))
    assert stored_reports.refresh(spark, sinks) == []
    assert stored_reports.fraud_by_category(spark, sinks).count() == 0
    for number, day in enumerate(order):
        store(spark, sinks, number, batch(spark, day, 40))
        if number != 1:                                      # two batches are refreshed at once
            assert f"2024-01-0{day}" in stored_reports.refresh(spark, sinks)
    store(spark, sinks, 9, batch(spark, 2, 60))              # late rows of an old day, partly replays
    assert stored_reports.refresh(spark, sinks) == ["2024-01-02"]
    assert stored_reports.refresh(spark, sinks) == []
    raw, alerts, valid = (f(spark, sinks) for f in (detector.read_raw, detector.read_alerts, detector.read_validated))
    assert raw.count() == 4 * 40 + 20
    for got, want in (
            (stored_reports.fraud_by_category(spark, sinks), reports.category_report(alerts, rounded=False)),
            (stored_reports.reconciled_windows(spark, sinks), reconcile.reconcile_all_windows(raw, alerts, valid))):
        assert got.columns == want.columns
        assert canonical(got.toPandas()) == canonical(want.toPandas())


def test_a_note_that_comes_meanwhile_stays(spark, tmp_path):
    sinks = detector.SinkPaths(str(tmp_path / "t"))
    store(spark, sinks, 0, batch(spark, 1, 10))
    stored_reports.refresh(spark, sinks)
    stored_reports.note_days(spark, sinks.notes, "ledger", 7, ["2024-01-01"])
    stored_reports.note_days(spark, sinks.notes, "ledger", 7, ["2024-01-01"])          # a retried batch
    assert stored_reports.refresh(spark, sinks) == ["2024-01-01"]


def test_recent_alerts_open_the_newest_days_only(spark, tmp_path):
    sinks = detector.SinkPaths(str(tmp_path / "t"))
    for day in range(1, 9):
        store(spark, sinks, day, batch(spark, day, 20))
    stored_reports.refresh(spark, sinks)
    for k in (1, 5, 20, 1000):
        got = stored_reports.recent_alerts(spark, sinks, k)
        want = detector.read_alerts(spark, sinks).orderBy(F.desc("detected_at"), "transaction_id", "fraud_reason").limit(k)
        assert canonical(got.toPandas()) == canonical(want.select(*got.columns).toPandas())
        days = {f.split("event_date=")[1][:10] for f in got.inputFiles()}
        assert days == {f"2024-01-0{d}" for d in (range(1, 9) if k == 1000 else (8,) if k < 20 else range(9 - len(days), 9))}
        assert k == 1000 or len(days) <= 3
    # a day with notes is opened whatever its partials say
    store(spark, sinks, 20, batch(spark, 1, 25))
    got = stored_reports.recent_alerts(spark, sinks, 1)
    assert {f.split("event_date=")[1][:10] for f in got.inputFiles()} == {"2024-01-01", "2024-01-08"}
    assert config.HIGH_VALUE in {r["fraud_reason"] for r in detector.read_alerts(spark, sinks).collect()}
