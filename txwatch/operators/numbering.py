"""Dense 1..n numbering in a global order, without moving all rows to one task."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def dense_number(df: DataFrame, order_cols: list[str], bucket: Column,
                 id_col: str) -> DataFrame:
    """Add ``id_col`` = row_number() OVER (ORDER BY order_cols), computed per bucket.

    ``bucket`` must be monotone in the order (e.g. the day of a time column), so all
    rows of an earlier bucket come first.  Rows are numbered inside their bucket (one
    task per bucket, not one task for the table); each bucket's offset is the running
    total of the earlier buckets' sizes, computed over one row per bucket.  The sizes
    are a second, narrower read of ``df``: meant for small stored tables (the report
    history holds one row per run).
    """
    order = [F.col(c) for c in order_cols]
    tagged = df.withColumn("_bucket", bucket)
    local = tagged.withColumn(
        "_local", F.row_number().over(Window.partitionBy("_bucket").orderBy(*order)))
    sizes = tagged.groupBy("_bucket").agg(F.count(F.lit(1)).alias("_size"))
    before = Window.orderBy("_bucket").rowsBetween(Window.unboundedPreceding, -1)
    offsets = sizes.select("_bucket", F.coalesce(F.sum("_size").over(before), F.lit(0))
                           .alias("_offset"))
    return (
        local.join(offsets, "_bucket")
        .withColumn(id_col, (F.col("_offset") + F.col("_local")).cast("long"))
        .drop("_bucket", "_local", "_offset")
    )
