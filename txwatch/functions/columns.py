"""Column expressions shared by batch and streaming plans (all JVM built-ins)."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from txwatch import config


def col_or_name(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def country_of(location) -> Column:
    """Last ', '-separated token of a location, trimmed ("Colombo, LK" -> "LK")."""
    return F.trim(F.element_at(F.split(col_or_name(location), config.LOCATION_SEPARATOR), -1))


def event_time_of(text) -> Column:
    """ISO text with exactly three fraction digits -> timestamp; anything else -> NULL."""
    return F.try_to_timestamp(col_or_name(text), F.lit(config.EVENT_TIME_FORMAT))


def iso_event_time(ts) -> Column:
    """Timestamp -> payload text (milliseconds, literal Z)."""
    return F.date_format(col_or_name(ts), config.EVENT_TIME_FORMAT)


def is_high_value(amount="amount") -> Column:
    """amount > 5000; NULL is not high value, NaN is."""
    return F.coalesce(col_or_name(amount) > F.lit(config.HIGH_VALUE_THRESHOLD), F.lit(False))


def is_validated(amount="amount") -> Column:
    """amount <= 5000; NULL and NaN are not validated."""
    return F.coalesce(col_or_name(amount) <= F.lit(config.HIGH_VALUE_THRESHOLD), F.lit(False))


def money(c) -> Column:
    """Stored money value, NUMERIC(12,2)."""
    return col_or_name(c).cast(config.MONEY_TYPE)


def as_double(c) -> Column:
    return col_or_name(c).cast("double")


def money_sum(c) -> Column:
    """Exact sum of NUMERIC(12,2) values; 0 (not NULL) over no rows."""
    return F.coalesce(F.sum(money(c)), F.lit(0).cast(config.MONEY_TYPE))


def cents(name: str) -> str:
    """SQL text: a money column as whole cents (exact decimal, no float)."""
    return f"CAST({name} * 100 AS DECIMAL(20,0))"


def half_up_quotient(num_sql: str, den_sql: str) -> str:
    """SQL text: num / den rounded half away from zero, in exact integer arithmetic."""
    return (f"(signum({num_sql}) * ((2 * abs({num_sql}) + {den_sql}) div (2 * {den_sql})))")


def avg_cents(sum_col: str, n_col: str) -> Column:
    """avg = sum / n rounded half-up to cents, exactly (both engines agree on ties)."""
    q = half_up_quotient(cents(sum_col), n_col)
    return F.expr(f"CASE WHEN {n_col} > 0 THEN CAST({q} AS DOUBLE) / 100 END")


def pct(part: str, whole: str) -> Column:
    """part / whole * 100 rounded half-up to 2 places; 0 when whole is not positive."""
    q = half_up_quotient(f"({cents(part)} * 10000)", cents(whole))
    return F.expr(f"CASE WHEN {whole} > 0 THEN CAST({q} AS DOUBLE) / 100 ELSE 0.0 END")


def window_start(ts, duration: str) -> Column:
    """Start of the epoch-aligned tumbling window holding ts."""
    return F.window(col_or_name(ts), duration).start


def in_range(c, start, end) -> Column:
    """Half-open range start <= c < end."""
    c = col_or_name(c)
    return (c >= start) & (c < end)


def to_ts(value) -> Column:
    """Literal timestamp from text or datetime."""
    if isinstance(value, Column):
        return value
    return F.lit(str(value)).cast("timestamp")
