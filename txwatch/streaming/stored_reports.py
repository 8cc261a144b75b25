"""Reports over all stored history, kept up by days.

Each micro-batch notes the days it touched in one small file.  ``refresh`` computes the
partials of the noted days again (from those days' folders alone) and then forgets the notes
it has read; a note that comes meanwhile stays for the next time, and a crash only repeats
work.  ``fraud_by_category`` and ``reconciled_windows`` merge the partials; ``recent_alerts``
uses them to open the newest days only.
"""

from __future__ import annotations

import json

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from txwatch import config, schema
from txwatch.operators import alerts as alert_ops
from txwatch.operators import partials
from txwatch.sinks.claims import hadoop, names, put_if_absent, text_of
from txwatch.sinks.writers import read_folders

_DAY = T.StructField(partials.DAY, T.DateType())


def note_days(spark: SparkSession, notes: str, source: str, batch_id: int, days: list) -> None:
    put_if_absent(spark, f"{notes}/{source}-{batch_id}", json.dumps(sorted(str(d) for d in days)) + "\n")


def _noted(spark: SparkSession, notes: str) -> tuple[list[str], list[str]]:
    """The notes and the days in them."""
    found, days = names(spark, notes), set()
    for name in found:
        text = text_of(spark, f"{notes}/{name}")
        if text.endswith("\n"):
            days.update(json.loads(text))
    return found, sorted(days)


def _alerts(spark: SparkSession, sinks, days: list[str]) -> DataFrame:
    table = T.StructType([*schema.ALERT_TABLE, _DAY])
    high, travel = (read_folders(spark, sinks.alerts_of(reason), partials.DAY, days, table)
                    for reason in (config.HIGH_VALUE, config.IMPOSSIBLE_TRAVEL))
    return high.unionByName(travel)


def refresh(spark: SparkSession, sinks) -> list[str]:
    """Bring the partials of the noted days up to date; returns those days."""
    notes, days = _noted(spark, sinks.notes)
    if days:
        raw, valid = (read_folders(spark, path, partials.DAY, days, T.StructType([*table, _DAY]))
                      for path, table in ((sinks.raw, schema.RAW_TABLE), (sinks.validated, schema.VALIDATED_TABLE)))
        alerts = _alerts(spark, sinks, days)
        # few rows a day: a file a day; only the folders of these days are replaced
        for rows, path in ((partials.category_partials(alerts), sinks.by_category),
                           (partials.window_partials(raw, alerts, valid), sinks.by_window)):
            (rows.repartition(partials.DAY).write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
             .partitionBy(partials.DAY).parquet(path))
    for name in notes:
        target, fs = hadoop(spark, f"{sinks.notes}/{name}")
        fs.delete(target, False)
    return days


def _partials(spark: SparkSession, path: str, table: T.StructType) -> DataFrame:
    return spark.read.schema(table).parquet(path) if names(spark, path) else spark.createDataFrame([], table)


def fraud_by_category(spark: SparkSession, sinks) -> DataFrame:
    return partials.category_report(_partials(spark, sinks.by_category, partials.CATEGORY_SCHEMA))


def reconciled_windows(spark: SparkSession, sinks) -> DataFrame:
    return partials.reconciled_windows(_partials(spark, sinks.by_window, partials.WINDOW_SCHEMA))


def recent_alerts(spark: SparkSession, sinks, k: int = 20) -> DataFrame:
    """The ``k`` newest alerts, opening only days that can hold one of them.

    The partials give each day's number of alerts and latest detection (one row a day on the
    driver).  Days with notes are always opened, then those with the latest detections until
    they hold k alerts; any other day whose latest detection reaches the k-th is opened too.
    """
    _, noted = _noted(spark, sinks.notes)
    days = (_partials(spark, sinks.by_category, partials.CATEGORY_SCHEMA).groupBy(partials.DAY)
            .agg(F.max("last_detected").alias("newest"), F.sum("attempt_count").alias("n")).collect())
    rest = sorted((d for d in days if str(d[partials.DAY]) not in noted), key=lambda d: d["newest"], reverse=True)
    chosen, held = list(noted), 0
    while rest and held < k:
        held += rest[0]["n"]
        chosen.append(str(rest.pop(0)[partials.DAY]))
    kth = (_alerts(spark, sinks, chosen).select("detected_at").orderBy(F.desc("detected_at")).limit(k)
           .agg(F.min("detected_at"), F.count(F.lit(1))).first())
    if kth[1] >= k:
        rest = [d for d in rest if d["newest"] >= kth[0]]
    chosen += [str(d[partials.DAY]) for d in rest]
    return alert_ops.recent_alerts(_alerts(spark, sinks, chosen), k)
