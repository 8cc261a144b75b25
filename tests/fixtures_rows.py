"""Hand-made messages with known outcomes (FIXTURES.md §3) and builders."""

import json
from datetime import datetime

from txwatch import schema


def msg(tid, user, time, amount, location, category="Dining", currency="USD", extra=None,
        raw=None, ms=True):
    if raw is not None:
        return raw
    payload = {"transaction_id": tid, "user_id": user,
               "timestamp": None if time is None else
               (f"2024-01-01T{time}Z" if ms else f"2024-01-01T{time}Z"),
               "merchant_category": category, "amount": amount, "location": location}
    if currency is not None:
        payload["currency"] = currency
    if extra:
        payload.update(extra)
    return json.dumps(payload, allow_nan=True)


# id, user, time, amount, location, overrides; then expected HV, VAL, TR, OK
ROWS = [
    ("a1", "u1", "00:01:00.000", 5000.00, "Colombo, LK", {}, (0, 1, 0, 1)),
    ("a2", "u1", "00:02:00.000", 5000.01, "Colombo, LK", {"category": "Travel"}, (1, 0, 0, 1)),
    ("b1", "u2", "00:03:00.000", 10.00, "New York, US", {}, (0, 1, 1, 1)),
    ("b2", "u2", "00:04:00.000", 20.00, "London, GB", {"category": "Fuel"}, (0, 1, 1, 1)),
    ("c1", "u3", "00:09:59.999", 10.00, "Tokyo, JP", {}, (0, 1, 0, 1)),
    ("c2", "u3", "00:10:00.000", 10.00, "Dubai, AE", {}, (0, 1, 0, 1)),
    ("d1", "u4", "00:05:00.000", 9000.00, "Delhi, IN", {"category": "Travel"}, (1, 0, 1, 1)),
    ("d2", "u4", "00:05:00.000", 30.00, "Sydney, AU", {}, (0, 1, 1, 1)),
    ("e1", "u5", "00:06:00.000", 15.00, None, {}, (0, 1, 1, 0)),
    ("e2", "u5", "00:06:10.000", 16.00, "Miami, US", {}, (0, 1, 1, 1)),
    ("e3", "u5", "00:06:20.000", 17.00, "London, GB", {}, (0, 1, 1, 1)),
    ("f1", "u6", "00:06:30.000", None, "Osaka, JP", {}, (0, 0, 0, 0)),
    (None, None, None, None, None, {"raw": "not json"}, (0, 0, 0, 0)),
    ("g1", "u7", "00:07:00", 7.00, "Osaka, JP", {}, (0, 1, 0, 0)),
    ("h1", None, "00:08:00.000", 5.00, "Mumbai, IN", {}, (0, 1, 0, 0)),
    ("h2", None, "00:08:30.000", 6.00, "Osaka, JP", {}, (0, 1, 0, 0)),
    ("a1", "u1", "00:01:00.000", 5000.00, "Colombo, LK", {}, (0, 1, 0, 1)),
    ("i1", "u8", "00:08:40.000", float("nan"), "Osaka, JP", {}, (1, 0, 0, 0)),
    ("j1", "u9", "00:08:50.000", 8.00, "Osaka, JP", {"currency": None}, (0, 1, 0, 0)),
    ("k1", "u10", "00:09:00.000", 99999999999.99, "Osaka, JP", {}, (1, 0, 0, 0)),
    ("l1", "u11", "00:09:10.000", 12.345, "Osaka, JP", {"extra": {"zzz": 1}}, (0, 1, 0, 1)),
]


def messages(spark, rows=ROWS, start=datetime(2024, 1, 1, 0, 0, 0)):
    data = []
    for i, (tid, user, time, amount, loc, over, _) in enumerate(rows):
        over = dict(over)
        value = msg(tid, user, time, amount, loc, **over)
        data.append((None if user is None else user.encode(), value.encode(), "transactions",
                     0, i, start, 0))
    return spark.createDataFrame(data, schema.ENVELOPE)


def expected(flag_index):
    out = []
    for tid, *_, flags in ROWS:
        if flags[flag_index] and tid is not None:
            out.append(tid)
    return out


def ids(df):
    return sorted(r[0] for r in df.select("transaction_id").collect())

