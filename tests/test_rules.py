"""Rules, parsing and conformance on hand-made rows."""

from datetime import datetime

from pyspark.sql import functions as F

from fixtures_rows import ROWS, expected, ids, messages
from txwatch.operators import ledger, rules
from txwatch.sources import envelope


def parsed(spark):
    return envelope.parse_envelope(messages(spark))


def test_parse_edge_semantics(spark):
    rows = {r["transaction_id"]: r for r in parsed(spark).collect() if r["transaction_id"]}
    assert rows["g1"]["event_timestamp"] is None            # no milliseconds -> NULL
    assert rows["c1"]["event_timestamp"] == datetime(2024, 1, 1, 0, 9, 59, 999000)
    assert rows["a1"]["country"] == "LK"
    assert rows["e1"]["country"] is None and rows["e1"]["location"] is None
    assert rows["j1"]["currency"] is None
    assert rows["l1"]["amount"] == 12.345                   # extra field ignored
    assert parsed(spark).where(F.col("transaction_id").isNull()).count() == 1  # not json


def test_country_edge_cases(spark):
    from txwatch.functions.columns import country_of
    df = spark.createDataFrame([("London",), ("",), ("A, B, US",), ("X,LK",), (None,)], "loc string")
    got = [r[0] for r in df.select(country_of("loc")).collect()]
    assert got == ["London", "", "US", "X,LK", None]


def test_high_value_and_validated(spark):
    tx = parsed(spark)
    assert ids(rules.high_value(tx)) == sorted(expected(0))
    assert ids(rules.validated(tx)) == sorted(expected(1))


def test_travel_batch_forms_agree(spark):
    tx = parsed(spark)
    want = sorted(expected(2))
    assert ids(rules.impossible_travel(tx)) == want
    assert ids(rules.impossible_travel_semi(tx)) == want
    # every row keeps its own values (no list shifting around the NULL location)
    got = {r["transaction_id"]: r["location"] for r in rules.impossible_travel(tx).collect()}
    assert got["e1"] is None and got["e2"] == "Miami, US" and got["e3"] == "London, GB"


def test_travel_hot_group_split_is_exact(spark):
    tx = parsed(spark)
    split = rules.impossible_travel(tx, hot_rows=1)
    assert ids(split) == sorted(expected(2))
    assert split.count() == len(expected(2))


def test_travel_windows(spark):
    w = {r["user_id"]: r for r in rules.travel_windows(parsed(spark)).collect()}
    assert sorted(w) == ["u2", "u4", "u5"]
    assert w["u5"]["countries"] == "GB,US" and w["u5"]["n_transactions"] == 3


def test_conform_routes_bad_rows(spark):
    from txwatch.schema import LEDGER_COLUMNS
    acc, rej = ledger.conform(parsed(spark).select(*LEDGER_COLUMNS))
    ok = sorted(expected(3))
    assert ids(acc) == ok
    reasons = {r["transaction_id"]: r["reject_reason"] for r in rej.collect() if r["transaction_id"]}
    assert reasons["f1"] == "amount is null"
    assert reasons["k1"] == "amount out of range"
    assert reasons["i1"] == "amount out of range"
    assert reasons["j1"] == "currency is null"
    assert reasons["e1"] == "location is null"
    assert reasons["g1"] == "event_timestamp is null"
    l1 = acc.where("transaction_id = 'l1'").first()
    assert str(l1["amount"]) == "12.35"


def test_conform_defaults_missing_currency_column(spark):
    df = spark.createDataFrame([("t", "u", datetime(2024, 1, 1), "c", 1.0, "X, US")],
                               "transaction_id string, user_id string, event_timestamp timestamp, "
                               "merchant_category string, amount double, location string")
    acc, rej = ledger.conform(df)
    assert acc.first()["currency"] == "USD" and rej.count() == 0


def test_insert_or_ignore_keeps_stored_rows(spark):
    stored = spark.createDataFrame([(3, "old")], "transaction_id int, v string")
    new = spark.createDataFrame([(i, "new") for i in [2, 4, 5, 1, 3, 6, 6]],
                                "transaction_id int, v string").repartition(2)
    inserted = ledger.insert_or_ignore(new, stored)
    assert sorted(r[0] for r in inserted.collect()) == [1, 2, 4, 5, 6]


def test_fraud_amount_counts_both_rules(spark):
    """A row matching both rules counts once in fraud_count, twice in fraud_amount."""
    from txwatch.operators import alerts as alert_ops, reports
    tx = parsed(spark)
    alerts = alert_ops.fraud_alerts(tx, F.col("event_timestamp"))
    row = reports.count_and_sum(alerts.where("transaction_id = 'd1'"), "n", "amt",
                                "transaction_id").first()
    assert row["n"] == 1 and float(row["amt"]) == 18000.0


def test_reconcile_empty_window_is_zero(spark):
    from txwatch.operators import reconcile
    from txwatch.sources import events_feed
    t = events_feed.stored_tables(parsed(spark))
    r = reconcile.reconcile_window(t.raw, t.alerts, t.validated, "2030-01-01 00:00:00").first()
    assert r["total_ingress_count"] == 0 and float(r["total_ingress_amount"]) == 0
    assert r["fraud_count"] == 0 and r["validated_count"] == 0
    rep = reconcile.reconciliation_report(
        reconcile.report_rows(reconcile.reconcile_window(
            t.raw, t.alerts, t.validated, "2030-01-01 00:00:00"), F.col("window_end"))).first()
    assert rep["Fraud Amount %"] == 0.0 and rep["Report ID"] == 1


def test_percent_and_average_round_half_up(spark):
    from txwatch.functions.columns import avg_cents, pct
    df = spark.createDataFrame([("100.50", 20, "1.00", "8.00")],
                               "s string, n long, p string, w string").selectExpr(
        "cast(s as decimal(22,2)) s", "n", "cast(p as decimal(14,2)) p", "cast(w as decimal(14,2)) w")
    r = df.select(avg_cents("s", "n").alias("a"), pct("p", "w").alias("q")).first()
    assert r["a"] == 5.03          # 5.025 -> 5.03 (half up, exact)
    assert r["q"] == 12.5


def test_options_distinct_amount_and_exclude_travel(spark):
    from txwatch.operators import alerts as alert_ops, reports
    tx = parsed(spark)
    alerts = alert_ops.fraud_alerts(tx, F.col("event_timestamp"))
    row = reports.count_and_sum(alerts.where("transaction_id = 'd1'"), "n", "amt",
                                "transaction_id", distinct_amount=True).first()
    assert row["n"] == 1 and float(row["amt"]) == 9000.0
    kept = ids(rules.validated(tx, exclude_travel=True))
    assert "b1" not in kept and "d2" not in kept and "a1" in kept


def test_dedup_alerts_keeps_first_detection(spark):
    from txwatch.operators import alerts as alert_ops
    rows = [("t1", "u", "IMPOSSIBLE_TRAVEL", "2024-01-01 00:05:00"),
            ("t1", "u", "IMPOSSIBLE_TRAVEL", "2024-01-01 00:01:00"),
            ("t1", "u", "HIGH_VALUE", "2024-01-01 00:09:00"),
            ("t2", "v", "IMPOSSIBLE_TRAVEL", "2024-01-01 00:02:00")]
    df = spark.createDataFrame(rows, "transaction_id string, user_id string, fraud_reason string, "
                                     "detected_at string") \
        .withColumn("detected_at", F.col("detected_at").cast("timestamp"))
    got = {(r[0], r[1]): r[2] for r in alert_ops.dedup_alerts(df)
           .select("transaction_id", "fraud_reason", "detected_at").collect()}
    assert len(got) == 3
    assert got[("t1", "IMPOSSIBLE_TRAVEL")] == datetime(2024, 1, 1, 0, 1)


def test_salted_travel_equals_plain_semi_join_on_feed(spark):
    """Every flagged group made 'hot' (1 row per slice): same rows as the plain join."""
    from conftest import SF_SMALL
    from txwatch.sources import events_feed
    tx = events_feed.transactions(spark, SF_SMALL)
    salted = rules.impossible_travel(tx, hot_rows=1).select("transaction_id")
    plain = rules.impossible_travel_semi(tx).select("transaction_id")
    assert salted.count() == plain.count() == 20
    assert salted.exceptAll(plain).count() == 0 and plain.exceptAll(salted).count() == 0


def test_hot_group_split_through_shuffle_join(spark):
    """One (user, window) holding a third of all rows, broadcasts off so the salted
    sort-merge path runs: every row comes back exactly once, and the hot group's rows
    are spread over its slices."""
    from pyspark.sql import functions as G
    n_hot, n_cold = 30_000, 60_000
    hot = (spark.range(n_hot).select(
        G.concat(G.lit("h"), G.col("id").cast("string")).alias("transaction_id"),
        G.lit("hot_user").alias("user_id"),
        (G.lit("2024-01-01 00:00:00").cast("timestamp")
         + G.make_dt_interval(G.lit(0), G.lit(0), G.lit(0), (G.col("id") % 500).cast("decimal(10,6)")))
        .alias("event_timestamp"),
        G.when(G.col("id") % 2 == 0, "US").otherwise("GB").alias("country")))
    cold = (spark.range(n_cold).select(
        G.concat(G.lit("c"), G.col("id").cast("string")).alias("transaction_id"),
        G.concat(G.lit("u"), (G.col("id") % 5000).cast("string")).alias("user_id"),
        (G.lit("2024-01-01 00:00:00").cast("timestamp")
         + G.make_dt_interval(G.lit(0), G.lit(0), (G.col("id") % 600).cast("int"), G.lit(0)))
        .alias("event_timestamp"),
        G.when(G.col("id") % 7 == 0, "JP").otherwise("LK").alias("country")))
    tx = hot.unionByName(cold).withColumn("location", G.concat(G.lit("X, "), G.col("country"))) \
        .withColumn("amount", G.lit(1.0)).withColumn("merchant_category", G.lit("Dining"))
    keys = ["spark.sql.autoBroadcastJoinThreshold", "spark.sql.adaptive.autoBroadcastJoinThreshold"]
    before = {k: spark.conf.get(k, None) for k in keys}
    try:
        for k in keys:
            spark.conf.set(k, "-1")
        salted = rules.impossible_travel(tx, hot_rows=2_000)
        plain = rules.impossible_travel_semi(tx)
        assert "SortMergeJoin" in salted._jdf.queryExecution().executedPlan().toString()
        got = salted.select("transaction_id")
        want = plain.select("transaction_id")
        n = want.count()
        assert n >= n_hot and got.count() == n
        assert got.exceptAll(want).count() == 0
        # the hot group's rows take 15 slices (30,000 / 2,000), evenly by hash
        per_slice = (tx.where("user_id = 'hot_user'")
                     .select(G.pmod(G.xxhash64("transaction_id"), G.lit(15)).alias("s"))
                     .groupBy("s").count().collect())
        assert len(per_slice) == 15 and max(r["count"] for r in per_slice) < 3 * n_hot / 15
    finally:
        for k, v in before.items():
            if v is None:
                spark.conf.unset(k)
            else:
                spark.conf.set(k, v)
