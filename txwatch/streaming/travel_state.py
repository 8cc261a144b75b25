"""Streaming IMPOSSIBLE_TRAVEL as a keyed stateful processor.

Key: (user_id, window_start).  State per key, in the RocksDB state store:

- ``seen``: lowest and highest country so far and whether the window is flagged;
- ``held``: the window's rows while it has seen a single country.

When a second country shows up, the held rows and the new rows are emitted and the
list is cleared; from then on rows of that window pass straight through.  Each row is
emitted once (the reference re-emits whole windows in update mode).  An event-time
timer at the window end drops the key's state once the watermark passes it; rows
older than the watermark never reach the processor.  Rows arrive, are held and are
emitted in Arrow batches, never as one list per window.
"""

from __future__ import annotations

import sys
from collections.abc import Iterator

import pandas as pd
from pyspark import cloudpickle
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle
from pyspark.sql.types import (
    BooleanType, DoubleType, StringType, StructField, StructType, TimestampType,
)

HELD_FIELDS = ["transaction_id", "event_timestamp", "merchant_category", "amount",
               "location", "country"]
HELD_SCHEMA = StructType([
    StructField("transaction_id", StringType(), True),
    StructField("event_timestamp", TimestampType(), True),
    StructField("merchant_category", StringType(), True),
    StructField("amount", DoubleType(), True),
    StructField("location", StringType(), True),
    StructField("country", StringType(), True),
])
SEEN_SCHEMA = StructType([
    StructField("lo", StringType(), True),
    StructField("hi", StringType(), True),
    StructField("flagged", BooleanType(), True),
])
OUTPUT_SCHEMA = StructType([
    StructField("user_id", StringType(), True),
    StructField("window_start", TimestampType(), True),
    *HELD_SCHEMA.fields,
])
OUTPUT_COLUMNS = [f.name for f in OUTPUT_SCHEMA.fields]
EMIT_CHUNK = 10_000


def _naive(ts):
    ts = pd.Timestamp(ts)
    return ts.tz_convert("UTC").tz_localize(None) if ts.tzinfo is not None else ts


class TravelProcessor(StatefulProcessor):
    """Flag every row of a (user, window) once it has seen two countries."""

    def __init__(self, window_ms: int):
        self.window_ms = window_ms

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.seen = handle.getValueState("seen", SEEN_SCHEMA)
        self.held = handle.getListState("held", HELD_SCHEMA)

    def _out(self, key, pdf: pd.DataFrame) -> pd.DataFrame:
        out = pdf[HELD_FIELDS].copy()
        out.insert(0, "window_start", _naive(key[1]))
        out.insert(0, "user_id", key[0])
        return out[OUTPUT_COLUMNS]

    def _release_held(self, key) -> Iterator[pd.DataFrame]:
        chunk = []
        for row in self.held.get():
            chunk.append(row)
            if len(chunk) >= EMIT_CHUNK:
                yield self._out(key, pd.DataFrame(chunk, columns=HELD_FIELDS))
                chunk = []
        if chunk:
            yield self._out(key, pd.DataFrame(chunk, columns=HELD_FIELDS))
        self.held.clear()

    def handleInputRows(self, key, rows, timerValues) -> Iterator[pd.DataFrame]:
        if self.seen.exists():
            lo, hi, flagged = self.seen.get()
        else:
            lo, hi, flagged = None, None, False
            window_end_ms = int(_naive(key[1]).value // 1_000_000) + self.window_ms
            self.handle.registerTimer(window_end_ms)
        for pdf in rows:
            countries = pdf["country"].dropna()
            if len(countries):
                b_lo, b_hi = countries.min(), countries.max()
                lo = b_lo if lo is None else min(lo, b_lo)
                hi = b_hi if hi is None else max(hi, b_hi)
            if flagged:
                yield self._out(key, pdf)
            elif lo is not None and lo != hi:
                flagged = True
                yield from self._release_held(key)
                yield self._out(key, pdf)
            else:
                held = pdf[HELD_FIELDS].astype(object).where(pdf[HELD_FIELDS].notna(), None)
                self.held.appendList([tuple(r) for r in held.itertuples(index=False, name=None)])
        self.seen.update((lo, hi, flagged))

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[pd.DataFrame]:
        self.seen.clear()
        self.held.clear()
        return iter([])

    def close(self) -> None:
        pass


# The processor is sent to Python workers by value, so they need not import txwatch
# (the driver-side stateful worker does not see files added with addPyFile).
cloudpickle.register_pickle_by_value(sys.modules[__name__])
