"""The two fraud rules, in batch form.  (Streaming forms: ``txwatch.streaming``.)

HIGH_VALUE is a row predicate.  IMPOSSIBLE_TRAVEL flags every row of a
(user, 10-minute window) group that saw two or more countries.  The batch form never
builds per-group row lists: a group is flagged by a partial aggregation
(count(DISTINCT country) > 1, NULLs ignored), and its rows are brought back with a
semi join that splits hot groups.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from txwatch import config
from txwatch.functions.columns import is_high_value, is_validated, window_start
from txwatch.operators import bloom
from txwatch.operators.skew import semi_join_split_hot

GROUP_KEYS = ["user_id", "window_start"]


def high_value(tx: DataFrame) -> DataFrame:
    """Rows with amount > 5000 (NULL never, NaN always)."""
    return tx.where(is_high_value("amount"))


def validated(tx: DataFrame, exclude_travel: bool = False) -> DataFrame:
    """Rows with amount <= 5000.  Travel-flagged rows are included by default (so
    fraud + validated can exceed ingress); ``exclude_travel`` leaves them out."""
    rows = tx.where(is_validated("amount"))
    if exclude_travel:
        flagged = impossible_travel(tx).select("transaction_id").distinct()
        rows = rows.join(flagged, "transaction_id", "left_anti")
    return rows


def windowed(tx: DataFrame, window: str = config.TRAVEL_WINDOW) -> DataFrame:
    """Rows that can take part in the travel rule, tagged with their window start.

    Rows without event time cannot be placed in a window; rows without a user cannot be
    stored as alerts, so they are not grouped (the reference groups them together).
    """
    # window_start IS NOT NULL is implied; stating it keeps every consumer of the
    # grouped rows on one identical plan (a join would otherwise add it to one side
    # only and the shared aggregation could not be reused)
    return (
        tx.where(F.col("event_timestamp").isNotNull() & F.col("user_id").isNotNull())
        .withColumn("window_start", window_start("event_timestamp", window))
        .where(F.col("window_start").isNotNull())
    )


def travel_groups(tx: DataFrame, window: str = config.TRAVEL_WINDOW) -> DataFrame:
    """One row per flagged (user, window): its set of countries and its row count."""
    whole = Window.partitionBy(*GROUP_KEYS)
    return (
        windowed(tx, window)
        # one row per country first (hash aggregation with partials), so that the list
        # of a group holds each country once and never grows with its rows
        .groupBy(*GROUP_KEYS, "country")
        .agg(F.count(F.lit(1)).alias("n"))
        # one row per country; a window over the keys that the last step groups by, so both
        # need one shuffle, and only flagged groups are ever collected
        .withColumn("several", F.min("country").over(whole) < F.max("country").over(whole))
        .where("several")
        .groupBy(*GROUP_KEYS)
        .agg(
            F.collect_list("country").alias("country_set"),
            F.sum("n").alias("n_transactions"),
        )
    )


def flagged_groups(tx: DataFrame, window: str = config.TRAVEL_WINDOW) -> DataFrame:
    """(user, window) groups with two or more countries, with their row counts.

    count(DISTINCT country) keeps every step a hash aggregation (string min/max would
    need a sort-based one): partial counts per (user, window, country) map-side, one
    shuffle on (user, window).
    """
    return (
        windowed(tx, window)
        .groupBy(*GROUP_KEYS)
        .agg(
            F.countDistinct("country").alias("n_countries"),
            F.count(F.lit(1)).alias("n_transactions"),
        )
        .where(F.col("n_countries") > 1)
    )


def travel_windows(tx: DataFrame, window: str = config.TRAVEL_WINDOW) -> DataFrame:
    """Flagged windows: user, bounds, sorted country list, counts (HAVING size > 1)."""
    countries = F.sort_array(F.col("country_set"))
    return (
        travel_groups(tx, window)
        .select(
            "user_id",
            "window_start",
            (F.col("window_start") + F.expr(f"INTERVAL {window}")).alias("window_end"),
            F.array_join(countries, ",").alias("countries"),
            F.size(countries).cast("long").alias("n_countries"),
            "n_transactions",
        )
    )


def impossible_travel(tx: DataFrame, window: str = config.TRAVEL_WINDOW,
                      **skew_options) -> DataFrame:
    """Every row of every flagged (user, window), each with its own values.

    Flagging is a partial aggregation; rows come back through a semi join whose hot
    groups are split across tasks (``operators.skew``).
    """
    rows = windowed(tx, window)
    return semi_join_split_hot(
        rows, flagged_groups(tx, window), GROUP_KEYS,
        rows_col="n_transactions", salt_col="transaction_id", **skew_options,
    )


def impossible_travel_reduced(tx: DataFrame, window: str = config.TRAVEL_WINDOW,
                              words: int = bloom.WORDS, **skew_options) -> DataFrame:
    """Same rows as ``impossible_travel``, for flagged groups too many to broadcast: a Bloom
    filter of the groups drops other rows before the join shuffles them."""
    flagged = flagged_groups(tx, window)
    rows = windowed(tx, window)
    rows = rows.where(bloom.may_hold(bloom.filter_of(flagged.select(*GROUP_KEYS), words), GROUP_KEYS, words))
    return semi_join_split_hot(
        rows, flagged, GROUP_KEYS,
        rows_col="n_transactions", salt_col="transaction_id", **skew_options,
    )


def impossible_travel_semi(tx: DataFrame, window: str = config.TRAVEL_WINDOW) -> DataFrame:
    """Same rows as ``impossible_travel`` through a plain left semi join (AQE splits
    skewed partitions at run time)."""
    flagged = flagged_groups(tx, window).select(*GROUP_KEYS)
    return windowed(tx, window).join(flagged, GROUP_KEYS, "left_semi")
