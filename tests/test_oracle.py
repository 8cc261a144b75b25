"""Every registered key against its DuckDB twin, at sf0.001."""

import pytest

import __spark_entry__ as entry
from helpers import canonical, duck
from conftest import SF_SMALL

QUERIES = entry.queries()
ORACLE = entry.oracle_sql()
BATCH_KEYS = [k for k in QUERIES if not k.startswith("stream_")]
STREAM_KEYS = [k for k in QUERIES if k.startswith("stream_")]


@pytest.fixture(scope="module")
def con():
    return duck(SF_SMALL)


def test_every_key_has_an_oracle():
    own = {**entry.BATCH_QUERIES, **entry.STREAM_QUERIES}
    assert set(own) <= set(QUERIES) and set(own) <= set(ORACLE)
    assert len(own) == 46


def test_replays_cut_nothing(spark):
    from txwatch.sources import events_feed
    tx = events_feed.transactions(spark, SF_SMALL).where("amount is not null")
    assert QUERIES["raw_ledger"](spark, SF_SMALL).count() == tx.select("transaction_id").distinct().count()


def _check(spark, con, key):
    got = QUERIES[key](spark, SF_SMALL).toPandas()
    want = con.execute(ORACLE[key]).df()
    assert sorted(got.columns) == sorted(want.columns)
    assert len(got) == len(want)
    assert canonical(got) == canonical(want)


@pytest.mark.parametrize("key", [k for k in BATCH_KEYS if k in ORACLE])
def test_batch_key_matches_oracle(spark, con, key):
    _check(spark, con, key)


@pytest.mark.parametrize("key", STREAM_KEYS)
def test_stream_key_matches_oracle(spark, con, key):
    _check(spark, con, key)


def test_entry_flagship(spark):
    rows = entry.entry(spark).collect()
    assert sum(r["attempt_count"] for r in rows) == 136
    assert round(sum(r["total_amount"] for r in rows), 2) == 973081.50


def test_encode_messages_round_trip(spark):
    from txwatch.sources import envelope, events_feed
    tx = events_feed.transactions(spark, SF_SMALL)
    back = envelope.parse_envelope(envelope.encode_messages(tx))
    assert back.count() == tx.count() == 1000
    diff = (back.select("transaction_id", "user_id", "amount", "location", "country")
            .exceptAll(tx.select("transaction_id", "user_id", "amount", "location", "country")))
    assert diff.count() == 0
