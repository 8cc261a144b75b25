"""Key index: bounded lookups however long the history, merges, retries; claims."""
import random
from concurrent.futures import ThreadPoolExecutor
from datetime import datetime, timedelta

import pytest
from pyspark.sql import types as T

from txwatch.sinks import claims, key_index
from txwatch.sinks.key_index import KeyIndex

SCHEMA = T.StructType([T.StructField("transaction_id", T.StringType()), T.StructField("event_timestamp", T.TimestampType())])
T0 = datetime(2024, 1, 1)


def rows(spark, ids):
    return spark.createDataFrame([(i, T0 + timedelta(seconds=n)) for n, i in enumerate(ids)], SCHEMA)


def opened(df):
    return len(df.inputFiles())


def test_time_ordered_ids_open_no_old_file(spark, tmp_path):
    index = KeyIndex(spark, str(tmp_path / "k"), SCHEMA, keys_per_file=20, fan_out=3)
    seen = []
    for batch in range(9):
        ids = [f"txn_{batch * 50 + i:09d}" for i in range(50)]
        assert opened(index.known(rows(spark, ids))) == 0            # new ids: nothing is opened
        index.add(rows(spark, ids))
        seen += ids
        assert len(index.runs()) <= 3 * 3
    assert sum(f.n for fences in index.runs().values() for f in fences) == len(seen)
    # replayed and new ids together open the few files that can hold the replayed ones
    found = index.known(rows(spark, [seen[3], seen[411], "txn_999999999"]))
    assert sorted(r[0] for r in found.collect()) == [seen[3], seen[411]] and opened(found) <= 2


def test_random_ids_open_at_most_a_file_each_and_run(spark, tmp_path):
    rng = random.Random(5)
    index = KeyIndex(spark, str(tmp_path / "k"), SCHEMA, keys_per_file=10, fan_out=2)
    stored = []
    for _ in range(6):
        ids = [f"txn_{rng.getrandbits(48):012x}" for _ in range(60)]
        index.add(rows(spark, ids))
        stored += ids
    files = sum(len(f) for f in index.runs().values())
    assert files >= 36
    probe = [stored[0], stored[-1], "txn_zzz"]
    found = index.known(rows(spark, probe))
    assert {r[0] for r in found.collect()} == set(probe[:2])
    assert opened(found) <= 2 * len(index.runs()) < files


def test_small_lookups_reach_the_scan_and_large_ones_join(spark, tmp_path, monkeypatch):
    index = KeyIndex(spark, str(tmp_path / "k"), SCHEMA)
    index.add(rows(spark, [f"a{i:03d}" for i in range(100)]))
    few = index.known(rows(spark, ["a005", "a006"]))
    plan = few._jdf.queryExecution().executedPlan().toString()
    assert "In(transaction_id, [a005,a006])" in plan
    monkeypatch.setattr(key_index, "LOOKUP_KEYS", 1)
    many = rows(spark, ["a005", "a006", "b"])
    got = many.join(index.known(many).withColumnRenamed("event_timestamp", "t"), "transaction_id")
    assert sorted(r[0] for r in got.collect()) == ["a005", "a006"]


def test_retries_and_crashes(spark, tmp_path):
    root = str(tmp_path / "k")
    index = KeyIndex(spark, root, SCHEMA, fan_out=2)
    index.add(rows(spark, ["a", "b"]))
    index.add(rows(spark, ["a", "b"]))                              # a retried batch
    assert index.known(rows(spark, ["a"])).count() == 1
    version = index._live()[0]
    assert claims.put_if_absent(spark, f"{root}/versions/{version + 1:012d}", '{"run-0-x": [')   # cut short
    assert index._live()[0] == version and index.known(rows(spark, ["b"])).count() == 1
    for i in range(5):
        index.add(rows(spark, [f"c{i}"]))
    assert index.known(rows(spark, ["a", "c0", "c4", "d"])).count() == 3
    index.add(rows(spark, []))
    assert KeyIndex(spark, str(tmp_path / "none"), SCHEMA).known(rows(spark, ["a"])).count() == 0


def test_one_writer_at_a_time(spark, tmp_path):
    a = KeyIndex(spark, str(tmp_path / "k"), SCHEMA)
    a.add(rows(spark, ["a"]))
    version, runs = a._live()
    a.add(rows(spark, ["b"]))
    with pytest.raises(RuntimeError):
        a._publish(version, runs)                                   # based on what is no longer the newest


def test_numbers_are_claimed_once(spark, tmp_path):
    folder = str(tmp_path / "ids")
    with ThreadPoolExecutor(8) as pool:
        got = list(pool.map(lambda _: claims.next_number(spark, folder), range(24)))
    assert sorted(got) == list(range(1, 25))
    assert claims.next_number(spark, folder, above=100) == 101


def test_thousands_of_ids_overflow_no_stack(spark, tmp_path):
    index = KeyIndex(spark, str(tmp_path / "many"), SCHEMA, 100_000)
    rows = spark.range(9_000).selectExpr("concat('t', lpad(id, 6, '0')) AS transaction_id",
                                         "timestamp_seconds(id) AS event_timestamp")
    index.add(rows)
    assert index.known(rows.where("event_timestamp >= timestamp_seconds(500)")).count() == 8_500
