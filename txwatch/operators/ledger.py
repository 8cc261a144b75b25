"""Ledger tables: projections, schema conformance and insert-or-ignore."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from txwatch import config, schema
from txwatch.functions.columns import money


def ledger_rows(tx: DataFrame) -> DataFrame:
    """The 7 stored transaction columns; amount as NUMERIC(12,2)."""
    return tx.select(*[money(c).alias(c) if c == "amount" else F.col(c)
                       for c in schema.LEDGER_COLUMNS])


def conform(df: DataFrame, columns: list[str] | None = None) -> tuple[DataFrame, DataFrame]:
    """Split rows into (accepted, rejected) by the stored-table constraints.

    NOT NULL on every column, NUMERIC(12,2) precision (try_cast: an out-of-range or
    NaN amount becomes NULL and is rejected), VARCHAR(n) lengths, and currency
    'USD' when the column is absent altogether.  Rejected rows keep their input
    values plus ``reject_reason``: every failed check, ';'-separated, in column order.
    Accepted amounts are rounded half-up to cents.
    """
    columns = columns or schema.LEDGER_COLUMNS
    tagged = with_reject_reason(df, columns)
    accepted = (
        tagged.where(F.col("reject_reason") == "")
        .select(*[F.col("stored_amount").alias(c) if c == "amount" else F.col(c) for c in columns])
    )
    rejected = tagged.where(F.col("reject_reason") != "").select(*columns, "reject_reason")
    return accepted, rejected


def with_reject_reason(df: DataFrame, columns: list[str]) -> DataFrame:
    """All rows with ``reject_reason`` (empty: accepted) and, where ``amount`` is among the
    columns, ``stored_amount``."""
    if "currency" in columns and "currency" not in df.columns:
        df = df.withColumn("currency", F.lit(config.DEFAULT_CURRENCY))
    stored_amount = F.expr(f"try_cast(amount AS {config.MONEY_TYPE})")

    checks: list[Column] = []
    for c in columns:
        if c == "amount":
            checks.append(F.when(F.col("amount").isNull(), F.lit("amount is null"))
                          .when(stored_amount.isNull(), F.lit("amount out of range")))
            continue
        check = F.when(F.col(c).isNull(), F.lit(f"{c} is null"))
        limit = config.VARCHAR_LIMITS.get(c)
        if limit:
            check = check.when(F.length(c) > limit, F.lit(f"{c} longer than {limit}"))
        checks.append(check)
    df = df.withColumn("reject_reason", F.concat_ws(";", *checks))
    return df.withColumn("stored_amount", stored_amount) if "amount" in columns else df


def insert_or_ignore(new: DataFrame, target: DataFrame, key: str = "transaction_id") -> DataFrame:
    """Rows of ``new`` whose key is not yet stored: the rows an INSERT with a
    primary key would keep, without failing the batch on the first duplicate.

    Duplicates inside ``new`` collapse through a partial aggregation (many copies of
    one key are combined map-side), then a left anti join against the stored keys.
    """
    fresh = new.dropDuplicates([key])
    return fresh.join(target.select(key), key, "left_anti")


def raw_ledger(high_value_rows: DataFrame, validated_rows: DataFrame,
               key: str = "transaction_id") -> DataFrame:
    """transactions_raw as both writers fill it: the union, one row per id."""
    return (ledger_rows(high_value_rows)
            .unionByName(ledger_rows(validated_rows))
            .dropDuplicates([key]))
