"""Per-batch row counts without extra jobs: ``observe`` + a streaming listener."""

from __future__ import annotations

from collections import Counter, deque

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQueryListener

from txwatch.functions.columns import is_high_value, is_validated


def observed(tx: DataFrame, name: str = "txwatch_batch") -> DataFrame:
    """Count rows, HIGH_VALUE and validated rows per micro-batch as a side effect of
    the query itself (reported in ``lastProgress['observedMetrics']``)."""
    return tx.observe(
        name,
        F.count(F.lit(1)).alias("rows"),
        F.count_if(is_high_value("amount")).alias("high_value"),
        F.count_if(is_validated("amount")).alias("validated"),
    )


def observed_travel(rows: DataFrame, name: str = "txwatch_travel") -> DataFrame:
    """Count the rows that the travel rule flags per micro-batch."""
    return rows.observe(name, F.count(F.lit(1)).alias("travel_alerts"))


class BatchMetricsListener(StreamingQueryListener):
    """Per query (batch id, observed metrics, state rows dropped as late) of the last ``keep``
    micro-batches, and totals over all of them: a service runs for months."""

    def __init__(self, name: str = "txwatch_batch", travel: str = "txwatch_travel", keep: int = 1000):
        self.name, self.travel = name, travel
        self.batches: deque[dict] = deque(maxlen=keep)
        self.totals: Counter = Counter()

    def onQueryStarted(self, event) -> None:
        pass

    def onQueryProgress(self, event) -> None:
        p = event.progress
        found = p.observedMetrics or {}
        metrics, travel = found.get(self.name), found.get(self.travel)
        for row in (metrics, travel):
            self.totals.update(row.asDict() if row is not None else {})
        dropped = sum(s.numRowsDroppedByWatermark for s in p.stateOperators)
        self.totals.update(batches=1, dropped_late=dropped)
        self.batches.append({
            "query": str(p.id),
            "run": str(p.runId),
            "batch": p.batchId,
            "input_rows": p.numInputRows,
            "metrics": metrics.asDict() if metrics is not None else None,
            "travel_alerts": travel["travel_alerts"] if travel is not None else None,
            "dropped_late": dropped,
        })

    def onQueryIdle(self, event) -> None:
        pass

    def onQueryTerminated(self, event) -> None:
        pass
