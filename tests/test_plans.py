"""Plan shape checks: top-k, no Python in batch plans, hash aggregation, broadcast of
the bounded hot-key table, column pruning; batch metrics via observe."""

import pytest

import __spark_entry__ as entry
from conftest import SF_SMALL
from txwatch.operators import rules
from txwatch.operators.numbering import dense_number
from txwatch.sources import events_feed


def plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


def test_recent_alerts_is_take_ordered(spark):
    df = entry.queries()["recent_alerts"](spark, SF_SMALL)
    assert "TakeOrderedAndProject" in df._jdf.queryExecution().sparkPlan().toString()


@pytest.mark.parametrize("key", list(entry.BATCH_QUERIES))
def test_batch_plans_stay_in_the_jvm(spark, key):
    p = plan(entry.queries()[key](spark, SF_SMALL))
    for node in ("BatchEvalPython", "ArrowEvalPython", "FlatMapGroupsInPandas",
                 "MapInPandas", "PythonUDF"):
        assert node not in p


def test_travel_flags_use_hash_aggregation(spark):
    tx = events_feed.transactions(spark, SF_SMALL)
    sp = rules.flagged_groups(tx)._jdf.queryExecution().sparkPlan().toString()
    assert "HashAggregate" in sp and "SortAggregate" not in sp


def test_hot_key_table_is_bounded(spark):
    tx = events_feed.transactions(spark, SF_SMALL)
    sp = rules.impossible_travel(tx)._jdf.queryExecution().sparkPlan().toString()
    assert "TakeOrderedAndProject" not in sp      # every hot group is split, none is cut off
    assert "n_transactions" in sp and "1000000" in sp   # bound: total rows / HOT_GROUP_ROWS


def test_scan_prunes_columns(spark):
    df = entry.queries()["derive_country"](spark, SF_SMALL)
    p = plan(df)
    assert "ReadSchema: struct<event_id:bigint,props:string>" in p


def test_dense_number_matches_row_number(spark):
    from pyspark.sql import Window, functions as F
    df = spark.range(0, 500).selectExpr("id", "timestamp_seconds(id * 7919 % 100000) AS ts")
    got = dense_number(df, ["ts", "id"], F.to_date("ts"), "n")
    want = df.withColumn("n", F.row_number().over(Window.orderBy("ts", "id")))
    assert got.select("id", "n").exceptAll(want.select("id", "n")).count() == 0


def test_observe_counts_per_batch(spark, tmp_path):
    from txwatch.streaming.catalog import feed_stream
    from txwatch.streaming.metrics import BatchMetricsListener, observed
    listener = BatchMetricsListener()
    spark.streams.addListener(listener)
    try:
        q = (observed(feed_stream(spark, SF_SMALL)).writeStream.format("noop")
             .option("checkpointLocation", str(tmp_path / "ck"))
             .trigger(availableNow=True).start())
        q.awaitTermination()
        rows = [p["observedMetrics"]["txwatch_batch"] for p in q.recentProgress
                if p.get("observedMetrics")]
        assert sum(r["rows"] for r in rows) == 1000
        assert sum(r["high_value"] for r in rows) == 136
        import time
        deadline = time.time() + 20           # listener events arrive asynchronously
        while not listener.batches and time.time() < deadline:
            time.sleep(0.2)
        assert listener.batches and listener.batches[0]["input_rows"] == 1000
    finally:
        spark.streams.removeListener(listener)


def test_bloom_filter_reduces_rows_before_the_shuffle(spark):
    """With broadcasts off the rows that reach the join's exchange are about the flagged ones."""
    from pyspark.sql import functions as F
    from txwatch.operators import bloom

    tx = events_feed.transactions(spark, SF_SMALL)
    flagged = rules.flagged_groups(tx).select(*rules.GROUP_KEYS)
    rows = rules.windowed(tx)
    want = rules.impossible_travel(tx)
    n, kept = want.count(), rows.where(bloom.may_hold(bloom.filter_of(flagged), rules.GROUP_KEYS)).count()
    assert n <= kept <= n + 0.01 * rows.count()
    small = rows.where(bloom.may_hold(bloom.filter_of(flagged, 1), rules.GROUP_KEYS, 1))   # overfull: more pass, none is lost
    assert flagged.join(small, rules.GROUP_KEYS, "left_anti").count() == 0 and kept < small.count() <= rows.count()
    keys = ["spark.sql.autoBroadcastJoinThreshold", "spark.sql.adaptive.autoBroadcastJoinThreshold"]
    before = [spark.conf.get(k, None) for k in keys]
    try:
        for k in keys:
            spark.conf.set(k, "-1")
        for words in (1, bloom.WORDS):
            got = rules.impossible_travel_reduced(tx, words=words, hot_rows=1)
            assert got.count() == n and got.select("transaction_id").exceptAll(want.select("transaction_id")).count() == 0
        assert "Subquery" in plan(got) and "BroadcastHashJoin" not in plan(got)
        assert got.where(F.col("user_id").isNull()).count() == 0
    finally:
        for k, v in zip(keys, before):
            spark.conf.unset(k) if v is None else spark.conf.set(k, v)
