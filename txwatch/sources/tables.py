"""Readers for the stored tables: Parquet (default), JDBC, and the warehouse."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from txwatch.functions.columns import in_range, to_ts


def read_parquet_table(spark: SparkSession, path: str,
                       schema: StructType | None = None) -> DataFrame:
    reader = spark.read
    if schema is not None:
        reader = reader.schema(schema)
    return reader.parquet(path)


def read_jdbc_table(spark: SparkSession, url: str, table: str, properties: dict,
                    partition_column: str | None = None, lower=None, upper=None,
                    num_partitions: int | None = None, predicates: list[str] | None = None
                    ) -> DataFrame:
    """A database table read in parallel: by a numeric/time column range split
    into ``num_partitions`` queries, or by explicit ``predicates`` (one per task)."""
    if predicates:
        return spark.read.jdbc(url, table, predicates=predicates, properties=properties)
    if partition_column:
        return spark.read.jdbc(url, table, column=partition_column,
                               lowerBound=lower, upperBound=upper,
                               numPartitions=num_partitions or 8, properties=properties)
    return spark.read.jdbc(url, table, properties=properties)


def scan_range(table: DataFrame, time_col: str, start, end) -> DataFrame:
    """Half-open time range; Parquet and JDBC sources receive the predicate."""
    return table.where(in_range(time_col, to_ts(start), to_ts(end)))


def read_warehouse(spark: SparkSession, root: str, dates: list[str] | None = None,
                   schema: StructType | None = None) -> DataFrame:
    """The partitioned warehouse (date=YYYY-MM-DD/hour=HH); a date list prunes
    directories before any file is opened."""
    df = read_parquet_table(spark, root, schema)
    if dates:
        df = df.where(F.col("date").isin(list(dates)))
    return df
