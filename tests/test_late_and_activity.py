"""Late rows as a side output, and running state per user, over scripted micro-batches."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from txwatch.operators import rules
from txwatch.streaming import detector, late_rows, user_activity

from test_streaming import _source, alert_ids, layer, write_batch  # noqa: F401 - layer is a fixture

BATCHES = [
    [("a", "01", "US"), ("b", "02", "GB")],
    [("d", "26", "US")],
    [("a", "01", "US"), ("e", "04", "JP"), ("f", "12", "JP"), ("g", "21", "JP")],
    [("h", "27", "FR"), ("e", "04", "JP")],
]


def drained(spark, inbox, sinks, ckpt, travel_each):
    """Ledger batch by batch; the travel query after each, or once over all of them."""
    for n, rows in enumerate(BATCHES):
        write_batch(spark, inbox, n, rows)
        detector.start_ledger(_source(spark, inbox), sinks, ckpt + "/ledger", available_now=True).awaitTermination()
        if travel_each or n == len(BATCHES) - 1:
            trav = detector.start_travel(spark, sinks, ckpt + "/travel", available_now=True)
            trav.awaitTermination()
            for p in trav.recentProgress:
                assert all(s["numRowsDroppedByWatermark"] == 0 for s in p["stateOperators"])


@pytest.mark.parametrize("travel_each", [True, False])
def test_late_rows_do_not_depend_on_the_travel_querys_batches(spark, layer, travel_each):  # noqa: F811
    inbox, sinks, ckpt = layer
    drained(spark, inbox, sinks, ckpt, travel_each)
    late = {r.transaction_id: r for r in detector.read_late(spark, sinks).collect()}
    # watermark 00:21 before the third batch; a was stored in time, its copy is no late row
    assert sorted(late) == ["e", "f"]
    assert {str(r.watermark) for r in late.values()} == {"2024-01-01 00:21:00"}
    assert alert_ids(spark, sinks) == ["a", "b", "d", "g", "h"]
    stored = {r.transaction_id for r in detector.read_raw(spark, sinks).collect()}
    assert stored == {"a", "b", "d", "e", "f", "g", "h"}
    # a replay from fresh checkpoints finds every row stored: nothing more is late
    detector.start_ledger(_source(spark, inbox), sinks, ckpt + "/again", available_now=True).awaitTermination()
    assert detector.read_late(spark, sinks).count() == 2


def test_a_retried_batch_decides_alike(spark, layer):  # noqa: F811
    inbox, sinks, ckpt = layer
    for n, rows in enumerate(BATCHES):
        write_batch(spark, inbox, n, rows)
    batch = [_read(spark, inbox, n) for n in range(len(BATCHES))]
    for n in (0, 0, 1, 1, 2, 2, 2, 3):
        detector.write_ledger_batch(batch[n], n, sinks)
    assert sorted(r.transaction_id for r in detector.read_late(spark, sinks).collect()) == ["e", "f"]


def _read(spark, inbox, n):
    from txwatch import schema
    from txwatch.sources import envelope
    return envelope.parse_envelope(spark.read.schema(schema.ENVELOPE).parquet(f"{inbox}/batch={n:03d}"))


def test_any_late_agrees_with_the_column(spark):
    df = spark.range(0, 40).select(F.timestamp_millis(F.col("id") * 60_000 + 7).alias("event_timestamp"), "id")
    for mark in (0, 599_999, 600_000, 1_200_000, 1_500_001):
        late = {r.id for r in df.where(late_rows.window_closed(mark)).collect()}
        assert late == {i for i in range(40) if late_rows.any_late(i * 60_000 + 7, mark)}
    assert not late_rows.any_late(0, None)


def test_user_state_grows_by_batch_and_survives_replays(spark, layer, tmp_path):  # noqa: F811
    inbox, _, ckpt = layer
    table = str(tmp_path / "user_windows")
    steps = [[("a", "01", "US"), ("b", "02", "US")], [("c", "03", "GB"), ("a", "01", "US")], [("d", "14", "FR")]]
    seen = []
    for n, rows in enumerate(steps):
        write_batch(spark, inbox, n, rows)
        user_activity.start_activity(_source(spark, inbox), table, ckpt + "/one", available_now=True).awaitTermination()
        rate = user_activity.flag_rate(spark, table).first()
        last = user_activity.last_location(spark, table).first()
        seen.append((rate.n_transactions, rate.n_travel, rate.n_flagged, last.last_location, last.n_transactions))
    assert seen == [(2, 0, 0, "City, US", 2), (3, 3, 3, "City, GB", 3), (4, 3, 3, "City, FR", 4)]
    # another run over all of it, with a checkpoint of its own, changes nothing
    user_activity.start_activity(_source(spark, inbox), table, ckpt + "/two", available_now=True).awaitTermination()
    rate = user_activity.flag_rate(spark, table).first()
    assert (rate.n_transactions, rate.n_flagged, rate.flag_rate) == (4, 3, 0.75)


def test_user_state_is_evicted(spark, layer, tmp_path):  # noqa: F811
    inbox, _, ckpt = layer
    write_batch(spark, inbox, 0, [("a", "01", "US"), ("b", "02", "GB")])
    write_batch(spark, inbox, 1, [("c", "40", "GB")])
    q = user_activity.start_activity(_source(spark, inbox), str(tmp_path / "t"), ckpt, available_now=True)
    q.awaitTermination()
    # only the open window of c is left in either operator
    assert [s["numRowsTotal"] for s in q.recentProgress[-1]["stateOperators"]] == [1, 1]


def test_only_flagged_groups_are_collected(spark):
    at = dt.datetime(2024, 1, 1)
    rows = [("u", at, "US"), ("u", at, "US"), ("u", at, "GB"), ("v", at, "US"), ("w", at, None), ("w", at, "US")]
    tx = spark.createDataFrame(rows, "user_id string, event_timestamp timestamp, country string")
    groups = {r.user_id: (sorted(r.country_set), r.n_transactions) for r in rules.travel_groups(tx).collect()}
    assert groups == {"u": (["GB", "US"], 3)}
    plan = rules.travel_groups(tx)._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange hashpartitioning(user_id") == 2   # per country, then per group


def test_empty_table_gives_zero_rate(spark, tmp_path):
    spark.createDataFrame([], user_activity.GROUPS_SCHEMA).write.parquet(str(tmp_path / "none"))
    rate = user_activity.flag_rate(spark, str(tmp_path / "none")).first()
    assert (rate.n_transactions, rate.n_flagged, rate.flag_rate) == (0, 0, 0.0)
