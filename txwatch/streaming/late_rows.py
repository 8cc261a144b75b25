"""Side output of late rows.

A row is late for the travel rule when its window had closed before its micro-batch began:
the window's end is not after the watermark, which is the latest event time of all earlier
micro-batches less the allowed delay.  The ledger decides that itself, by the rule that
streaming state uses, and publishes only the other rows to the travel query.  That query's
own watermark comes from the published rows and never runs ahead of the ledger's, however
many batches it reads at once, so it drops nothing: every stored row either takes part in
the rule or is in the late table with the watermark it missed.

The latest event time after each micro-batch is one small file.  A batch reads its
predecessor's file only, so a retry decides as the first try did, and a replay from a fresh
checkpoint starts without a watermark, as its streaming state does.  Both queries have to
start afresh together.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from txwatch import config
from txwatch.functions.columns import window_start
from txwatch.sinks.claims import hadoop, put, text_of

REASON = "window closed before the row came"


def interval_ms(duration: str) -> int:
    n, unit = duration.split()
    factor = {"second": 1_000, "minute": 60_000, "hour": 3_600_000}[unit.rstrip("s")]
    return int(n) * factor


def latest_before(spark: SparkSession, marks: str, batch_id: int) -> int | None:
    """Latest event time (epoch milliseconds) of the micro-batches before this one."""
    path = f"{marks}/{batch_id - 1}"
    target, fs = hadoop(spark, path)
    text = text_of(spark, path) if batch_id > 0 and fs.exists(target) else ""
    return int(text) if text else None


def note_latest(spark: SparkSession, marks: str, batch_id: int, before: int | None, own: int | None) -> None:
    """Keep the latest event time after this micro-batch; files before its predecessor go."""
    known = [ms for ms in (before, own) if ms is not None]
    put(spark, f"{marks}/{batch_id}", str(max(known)) if known else "")
    target, fs = hadoop(spark, f"{marks}/{batch_id - 2}")
    if batch_id > 1 and fs.exists(target):
        fs.delete(target, False)


def watermark_ms(latest: int | None, delay: str = config.WATERMARK) -> int | None:
    return None if latest is None else latest - interval_ms(delay)


def window_closed(watermark: int, window: str = config.TRAVEL_WINDOW) -> Column:
    end = window_start("event_timestamp", window) + F.expr(f"INTERVAL {window}")
    return F.unix_millis(end) <= F.lit(watermark)


def any_late(lo_ms: int, watermark: int | None, window: str = config.TRAVEL_WINDOW) -> bool:
    """Whether a batch whose earliest row is at ``lo_ms`` can hold late rows."""
    size = interval_ms(window)
    return watermark is not None and (lo_ms // size + 1) * size <= watermark


def side_output(rows: DataFrame, watermark: int, window: str = config.TRAVEL_WINDOW) -> DataFrame:
    """The late rows, with the reason and the watermark they missed."""
    return (rows.where(window_closed(watermark, window))
            .withColumn("late_reason", F.lit(REASON))
            .withColumn("watermark", F.timestamp_millis(F.lit(watermark))))
