"""txwatch: payment-transaction fraud analytics on Spark.

Keyed JSON transaction messages are parsed against a declared schema, checked by
two rules (HIGH_VALUE row by row, IMPOSSIBLE_TRAVEL per user and 10-minute
event-time window), written to duplicate-free ledger and alert tables, and rolled
up into category reports and 6-hour reconciliations.  Everything is expressed with
the public DataFrame / SQL / Structured Streaming API.
"""

__version__ = "0.1.0"
