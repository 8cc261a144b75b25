"""Sinks and the batch chain: Parquet warehouse, CSV reports, JDBC (embedded Derby)."""

import csv
import glob
import os
from datetime import datetime

import pytest
from pyspark.sql import functions as F

from conftest import SF_SMALL
from txwatch.plans.window_run import run_window
from txwatch.sinks import writers
from txwatch.sources import events_feed, tables


def _csv_rows(folder):
    files = glob.glob(os.path.join(folder.replace("file:", ""), "*.csv"))
    assert len(files) == 1
    with open(files[0]) as fh:
        return list(csv.reader(fh))


@pytest.fixture(scope="module")
def stored(spark):
    return events_feed.stored_tables(events_feed.transactions(spark, SF_SMALL))


def test_run_window_chain_and_rerun(spark, stored, tmp_path):
    out = str(tmp_path / "out")
    t = stored
    run = run_window(spark, t.raw, t.alerts, t.validated, "2024-01-15 00:00:00", out,
                     generated_at=datetime(2024, 1, 15, 0, 5))
    wh = tables.read_warehouse(spark, run.warehouse, dates=["2024-01-14"])
    n = wh.count()
    assert n > 0
    assert {r["hour"] for r in wh.select("hour").distinct().collect()} == {"18"}
    assert wh.where(F.col("batch_processed_at") < "2024-01-14 18:00:00").count() == 0
    rec = _csv_rows(run.reconciliation_csv)
    assert rec[0][0] == "Report ID" and rec[0][-1] == "Validated Amount %"
    assert rec[1][0] == "1" and int(rec[1][8]) == n          # validated count = warehouse rows
    fraud = _csv_rows(run.fraud_csv)
    assert fraud[0] == ["merchant_category", "fraud_reason", "attempt_count",
                        "total_amount", "avg_amount", "max_amount"]
    # rerun: same warehouse partition content, a second history row
    run2 = run_window(spark, t.raw, t.alerts, t.validated, "2024-01-15 00:00:00", out,
                      generated_at=datetime(2024, 1, 15, 1, 0))
    assert tables.read_warehouse(spark, run2.warehouse, dates=["2024-01-14"]).count() == n
    assert spark.read.parquet(run2.reports_table).count() == 2
    assert run2.reconciliation.first()["report_id"] == 2
    from txwatch.operators import reconcile
    history = reconcile.number_reports(spark.read.parquet(run2.reports_table))
    latest = reconcile.latest_per_window(history).collect()
    assert len(latest) == 1 and latest[0]["report_id"] == 2


def test_empty_window_writes_header_only_and_keeps_warehouse(spark, stored, tmp_path):
    out = str(tmp_path / "out")
    t = stored
    run_window(spark, t.raw, t.alerts, t.validated, "2024-01-15 00:00:00", out,
               generated_at=datetime(2024, 1, 15, 0, 5))
    before = spark.read.parquet(f"{out}/warehouse").count()
    run = run_window(spark, t.raw, t.alerts, t.validated, "2030-01-01 00:00:00", out,
                     generated_at=datetime(2030, 1, 1, 0, 5))
    assert _csv_rows(run.fraud_csv) == [["merchant_category", "fraud_reason", "attempt_count",
                                         "total_amount", "avg_amount", "max_amount"]]
    rec = _csv_rows(run.reconciliation_csv)
    assert rec[1][3] == "0" and rec[1][7] == "0.0"
    assert spark.read.parquet(f"{out}/warehouse").count() == before


def test_insert_or_ignore_parquet_is_idempotent(spark, tmp_path):
    path = str(tmp_path / "t")
    first = spark.createDataFrame([(3, "old", "2024-01-01")], "transaction_id int, v string, d string")
    writers.insert_or_ignore_parquet(first, path, ["transaction_id"], partition_col="d")
    new = spark.createDataFrame([(i, "new", "2024-01-01") for i in [2, 4, 5, 1, 3, 6]],
                                "transaction_id int, v string, d string").repartition(2)
    writers.insert_or_ignore_parquet(new, path, ["transaction_id"], partition_col="d")
    writers.insert_or_ignore_parquet(new, path, ["transaction_id"], partition_col="d")
    got = {r["transaction_id"]: r["v"] for r in spark.read.parquet(path).collect()}
    assert sorted(got) == [1, 2, 3, 4, 5, 6] and got[3] == "old"


DERBY = {"driver": "org.apache.derby.iapi.jdbc.AutoloadedDriver"}


def test_jdbc_insert_or_ignore_duplicate_key_script(spark):
    """Target holds key 3; rows 1-6 arrive in two partitions: all land, 3 unchanged."""
    url = "jdbc:derby:memory:txwatch_dup;create=true"
    spark.createDataFrame([(3, "old")], "transaction_id int, v string") \
        .write.jdbc(url, "ledger", mode="overwrite", properties=DERBY)
    new = spark.createDataFrame([(2, "n"), (4, "n"), (5, "n"), (1, "n"), (3, "n"), (6, "n")],
                                "transaction_id int, v string").repartition(2)
    writers.insert_or_ignore_jdbc(new, url, "ledger", DERBY, ["transaction_id"])
    back = tables.read_jdbc_table(spark, url, "ledger", DERBY, partition_column="transaction_id",
                                  lower=1, upper=7, num_partitions=3)
    got = {r["TRANSACTION_ID"] if "TRANSACTION_ID" in r else r["transaction_id"]: r
           for r in back.collect()}
    assert sorted(got) == [1, 2, 3, 4, 5, 6]
    assert back.rdd.getNumPartitions() == 3


def test_scan_range_pushes_down(spark, tmp_path):
    path = str(tmp_path / "raw")
    tx = events_feed.transactions(spark, SF_SMALL)
    tx.write.parquet(path)
    df = tables.scan_range(spark.read.parquet(path), "event_timestamp",
                           "2024-01-14 18:00:00", "2024-01-15 00:00:00").select("transaction_id")
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert "PushedFilters: [IsNotNull(event_timestamp), GreaterThanOrEqual(event_timestamp" in plan
    assert "ReadSchema: struct<transaction_id:string,event_timestamp:timestamp>" in plan


def test_publish_batch_is_all_or_nothing(spark, tmp_path):
    feed = str(tmp_path / "feed")
    rows = spark.range(100).repartition(4)
    writers.publish_batch(rows, feed, 0)
    # what a crashed attempt leaves behind (a staging folder) is invisible to readers
    rows.write.parquet(feed + "/_staging-1-crashed")
    reader = spark.read.option("recursiveFileLookup", "true").option("pathGlobFilter", "*.parquet")
    assert reader.parquet(feed).count() == 100
    writers.publish_batch(rows.limit(10), feed, 0)        # a retried batch replaces its folder
    assert reader.parquet(feed).count() == 10
    writers.publish_batch(rows, feed, 1)
    assert reader.parquet(feed).count() == 110
