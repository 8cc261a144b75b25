"""Joins that stay balanced when one key holds a large share of the rows."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from txwatch import config


def hot_groups(groups: DataFrame, keys: list[str], rows_col: str,
               hot_rows: int = config.HOT_GROUP_ROWS) -> DataFrame:
    """The groups above ``hot_rows`` rows, with the number of slices each is split into:
    ceil(rows / hot_rows).  There are at most total rows / hot_rows of them."""
    slices = F.ceil(F.col(rows_col) / F.lit(hot_rows)).cast("int")
    return groups.where(F.col(rows_col) > hot_rows).select(*keys, slices.alias("_slices"))


def semi_join_split_hot(rows: DataFrame, groups: DataFrame, keys: list[str],
                        rows_col: str, salt_col: str,
                        hot_rows: int = config.HOT_GROUP_ROWS) -> DataFrame:
    """``rows LEFT SEMI JOIN groups USING (keys)`` with hot keys salted.

    ``groups`` has one row per key and, in ``rows_col``, how many rows of ``rows``
    carry that key (it comes from the aggregation that selected the groups, so
    knowing it costs nothing).  A group above ``hot_rows`` rows is split into
    ceil(rows / hot_rows) slices: the group's key is repeated once per slice on the
    groups side, and each of its rows goes to slice hash(salt_col) mod slices, so the
    join on (keys, slice) spreads the group over that many tasks.

    The rows side learns the slice count of its group from the hot groups only, a table
    of at most total rows / ``hot_rows`` rows; Spark picks that join by its measured
    size.  A row of any other group takes slice 0, which every group has, so no row is
    lost or duplicated.
    """
    # both consumers read the same projection, so the aggregation behind it is
    # planned once and its shuffle reused
    groups = groups.select(*keys, rows_col)
    hot = hot_groups(groups, keys, rows_col, hot_rows)
    left = (
        rows.join(hot, keys, "left")
        .withColumn("_slice", F.pmod(F.xxhash64(F.col(salt_col)),
                                     F.coalesce(F.col("_slices"), F.lit(1))).cast("int"))
        .drop("_slices")
    )
    own_slices = F.greatest(F.lit(1), F.ceil(F.col(rows_col) / F.lit(hot_rows))).cast("int")
    right = groups.select(*keys, F.explode(F.sequence(F.lit(0), own_slices - 1)).alias("_slice"))
    return left.join(right, keys + ["_slice"], "left_semi").drop("_slice")
