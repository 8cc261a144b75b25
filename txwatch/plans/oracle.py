"""DuckDB SQL twins of the catalog's queries, over the same parquet views.

Every statement starts from the ``events`` view and repeats the feed mapping and the
stored-table derivation in plain SQL, written independently of the Spark plans.
"""

from __future__ import annotations

from txwatch.plans.catalog import RECENT_K, WINDOW_END
from txwatch.operators.reconcile import window_bounds
from txwatch.sources.events_feed import DAYS, FIRST_DAY, INSTALMENTS

W_START, W_END = window_bounds(WINDOW_END)

BASE = """
ev AS (
  SELECT *, CAST(json_extract_string(props, '$.k') AS INTEGER) AS k FROM events
),
tx AS (
  SELECT
    'txn_' || lpad(CAST(event_id AS VARCHAR), 12, '0') AS transaction_id,
    'user_' || lpad(CAST(user_id AS VARCHAR), 6, '0') AS user_id,
    event_type AS merchant_category,
    CAST(CAST(CAST(value AS DECIMAL(12,2)) * 50 AS DECIMAL(12,2)) AS DOUBLE) AS amount,
    'City-' || CAST(k AS VARCHAR) || ', ' || 'C' || CAST(k % 8 AS VARCHAR) AS location,
    'USD' AS currency,
    CAST(ts AS TIMESTAMP) AS kafka_timestamp,
    CAST(ts AS TIMESTAMP) AS event_timestamp
  FROM ev
),
txc AS (
  SELECT *, trim(split_part(location, ', ', -1)) AS country FROM tx
),
tw_rows AS (
  SELECT *, time_bucket(INTERVAL 10 MINUTE, event_timestamp) AS window_start
  FROM txc WHERE user_id IS NOT NULL AND event_timestamp IS NOT NULL
),
tw AS (
  SELECT user_id, window_start, count(*) AS n_transactions,
         count(DISTINCT country) AS n_countries,
         string_agg(DISTINCT country, ',' ORDER BY country) AS countries
  FROM tw_rows GROUP BY user_id, window_start
  HAVING count(DISTINCT country) > 1
),
travel AS (
  SELECT r.* FROM tw_rows r JOIN tw USING (user_id, window_start)
),
raw AS (
  SELECT transaction_id, user_id, event_timestamp, merchant_category,
         CAST(amount AS DECIMAL(12,2)) AS amount, location, currency,
         event_timestamp AS ingested_at
  FROM txc WHERE amount IS NOT NULL
),
alerts AS (
  SELECT transaction_id, user_id, 'HIGH_VALUE' AS fraud_reason,
         CAST(amount AS DECIMAL(12,2)) AS amount, location, merchant_category,
         event_timestamp, event_timestamp + INTERVAL 1 MINUTE AS detected_at
  FROM txc WHERE amount > 5000
  UNION ALL
  SELECT transaction_id, user_id, 'IMPOSSIBLE_TRAVEL' AS fraud_reason,
         CAST(amount AS DECIMAL(12,2)) AS amount, location, merchant_category,
         event_timestamp, event_timestamp + INTERVAL 1 MINUTE AS detected_at
  FROM travel
),
validated AS (
  SELECT transaction_id, user_id, event_timestamp, merchant_category,
         CAST(amount AS DECIMAL(12,2)) AS amount, location, currency,
         event_timestamp + INTERVAL 2 MINUTE AS batch_processed_at
  FROM txc WHERE amount <= 5000
),
win AS (
  SELECT TIMESTAMP '{ws}' AS window_start, TIMESTAMP '{we}' AS window_end
)""".format(ws=W_START, we=W_END)


def _in_window(col: str) -> str:
    return f"{col} >= TIMESTAMP '{W_START}' AND {col} < TIMESTAMP '{W_END}'"


LEDGER = ("transaction_id, user_id, event_timestamp, merchant_category, "
          "CAST(amount AS DOUBLE) AS amount, location, currency")
ALERT = ("transaction_id, user_id, fraud_reason, CAST(amount AS DOUBLE) AS amount, location, "
         "merchant_category, event_timestamp, detected_at")

ALL_WINDOWS = """
all_windows AS (
  SELECT window_start,
         window_start + INTERVAL 6 HOUR AS window_end,
         CAST(coalesce(sum(total_ingress_count), 0) AS BIGINT) AS total_ingress_count,
         CAST(coalesce(sum(total_ingress_amount), 0) AS DECIMAL(14,2)) AS total_ingress_amount,
         CAST(coalesce(sum(fraud_count), 0) AS BIGINT) AS fraud_count,
         CAST(coalesce(sum(fraud_amount), 0) AS DECIMAL(14,2)) AS fraud_amount,
         CAST(coalesce(sum(validated_count), 0) AS BIGINT) AS validated_count,
         CAST(coalesce(sum(validated_amount), 0) AS DECIMAL(14,2)) AS validated_amount
  FROM (
    SELECT time_bucket(INTERVAL 6 HOUR, event_timestamp) AS window_start,
           count(*) AS total_ingress_count, sum(amount) AS total_ingress_amount,
           NULL AS fraud_count, NULL AS fraud_amount, NULL AS validated_count, NULL AS validated_amount
    FROM raw GROUP BY 1
    UNION ALL
    SELECT time_bucket(INTERVAL 6 HOUR, detected_at), NULL, NULL,
           count(DISTINCT transaction_id), sum(amount), NULL, NULL
    FROM alerts GROUP BY 1
    UNION ALL
    SELECT time_bucket(INTERVAL 6 HOUR, batch_processed_at), NULL, NULL, NULL, NULL,
           count(*), sum(amount)
    FROM validated GROUP BY 1
  ) parts
  GROUP BY window_start
),
report_rows AS (
  SELECT row_number() OVER (ORDER BY window_start, window_end) AS report_id,
         window_start, window_end, total_ingress_count, total_ingress_amount,
         fraud_count, fraud_amount, validated_count, validated_amount,
         window_end AS generated_at
  FROM all_windows
)"""


def _cents(x: str) -> str:
    return f"CAST({x} * 100 AS HUGEINT)"


def _half_up(num: str, den: str) -> str:
    return f"(sign({num}) * ((2 * abs({num}) + {den}) // (2 * {den})))"


def _pct(part: str, whole: str) -> str:
    q = _half_up(f"({_cents(part)} * 10000)", _cents(whole))
    return f"CASE WHEN {whole} > 0 THEN CAST({q} AS DOUBLE) / 100 ELSE 0.0 END"


def _avg(x: str) -> str:
    q = _half_up(_cents(f"sum({x})"), f"count({x})")
    return f"CASE WHEN count({x}) > 0 THEN CAST({q} AS DOUBLE) / 100 END"


def _with(*extra: str) -> str:
    return "WITH " + ",\n".join([BASE.strip(), *[e.strip() for e in extra]]) + "\n"


STORED_BEFORE = "2024-01-15 00:00:00"
REPLAY = """
replayed AS (
  SELECT * FROM txc
  UNION ALL
  SELECT * FROM txc WHERE event_timestamp >= TIMESTAMP '2024-01-20 00:00:00'
)"""

DIRTY = """
dirty AS (
  SELECT transaction_id,
         CASE WHEN k = 42 THEN NULL ELSE user_id END AS user_id,
         event_timestamp, merchant_category,
         CASE WHEN k = 13 THEN NULL WHEN k = 7 THEN amount * 1e9 ELSE amount END AS amount,
         CASE WHEN k = 99 THEN rpad(location, 130, 'x') ELSE location END AS location,
         CASE WHEN k = 77 THEN NULL ELSE currency END AS currency
  FROM (SELECT *, CAST(regexp_extract(location, 'City-(\\d+),', 1) AS INTEGER) AS k FROM txc) t
),
checked AS (
  SELECT *, concat_ws(';',
    CASE WHEN transaction_id IS NULL THEN 'transaction_id is null'
         WHEN length(transaction_id) > 64 THEN 'transaction_id longer than 64' END,
    CASE WHEN user_id IS NULL THEN 'user_id is null'
         WHEN length(user_id) > 32 THEN 'user_id longer than 32' END,
    CASE WHEN event_timestamp IS NULL THEN 'event_timestamp is null' END,
    CASE WHEN merchant_category IS NULL THEN 'merchant_category is null'
         WHEN length(merchant_category) > 64 THEN 'merchant_category longer than 64' END,
    CASE WHEN amount IS NULL THEN 'amount is null'
         WHEN isnan(amount) OR abs(amount) >= 9999999999.995 THEN 'amount out of range' END,
    CASE WHEN location IS NULL THEN 'location is null'
         WHEN length(location) > 128 THEN 'location longer than 128' END,
    CASE WHEN currency IS NULL THEN 'currency is null'
         WHEN length(currency) > 8 THEN 'currency longer than 8' END
  ) AS reject_reason
  FROM dirty
)"""


def oracle_sql() -> dict[str, str]:
    win = _in_window
    q: dict[str, str] = {}
    q["parse_transactions"] = _with() + """
SELECT transaction_id, user_id, merchant_category, amount, location, currency,
       kafka_timestamp, date_trunc('millisecond', event_timestamp) AS event_timestamp, country
FROM txc"""
    q["derive_country"] = _with() + "SELECT transaction_id, location, country FROM txc"
    q["high_value"] = _with() + f"SELECT {LEDGER} FROM txc WHERE amount > 5000"
    q["validated"] = _with() + f"SELECT {LEDGER} FROM txc WHERE amount <= 5000"
    q["conform_accepted"] = _with(DIRTY) + """
SELECT transaction_id, user_id, event_timestamp, merchant_category,
       CAST(CAST(amount AS DECIMAL(12,2)) AS DOUBLE) AS amount, location, currency
FROM checked WHERE reject_reason = ''"""
    q["conform_rejected"] = _with(DIRTY) + """
SELECT transaction_id, user_id, event_timestamp, merchant_category, amount, location,
       currency, reject_reason
FROM checked WHERE reject_reason <> ''"""
    q["travel_windows"] = _with() + """
SELECT user_id, window_start, window_start + INTERVAL 10 MINUTE AS window_end, countries,
       n_countries, n_transactions
FROM tw"""
    travel_rows = """
SELECT transaction_id, user_id, window_start, event_timestamp, merchant_category, amount,
       location, country
FROM travel"""
    q["impossible_travel"] = _with() + travel_rows
    q["impossible_travel_semi"] = _with() + travel_rows
    q["impossible_travel_reduced"] = _with() + travel_rows
    q["alerts_high_value"] = _with() + f"SELECT {ALERT} FROM alerts WHERE fraud_reason = 'HIGH_VALUE'"
    q["alerts_travel"] = _with() + f"SELECT {ALERT} FROM alerts WHERE fraud_reason = 'IMPOSSIBLE_TRAVEL'"
    q["fraud_alerts"] = _with() + f"SELECT {ALERT} FROM alerts"
    q["alert_feed"] = _with() + """
SELECT transaction_id, fraud_reason,
       CASE WHEN fraud_reason = 'HIGH_VALUE'
            THEN 'ALERT | ' || transaction_id || ' | ' || user_id || ' | $'
                 || format('{:,.2f}', CAST(amount AS DOUBLE)) || ' | ' || location
            ELSE 'TRAVEL ALERT | ' || transaction_id || ' | ' || user_id || ' | ' || location
       END AS line
FROM alerts"""
    q["recent_alerts"] = _with() + f"""
SELECT fraud_reason, merchant_category, CAST(amount AS DOUBLE) AS amount, location, detected_at
FROM alerts ORDER BY detected_at DESC, transaction_id ASC, fraud_reason ASC LIMIT {RECENT_K}"""
    q["raw_ledger"] = _with(REPLAY) + f"""
SELECT DISTINCT {LEDGER} FROM replayed WHERE amount IS NOT NULL"""
    q["encode_messages"] = _with() + """
SELECT user_id AS key,
       '{"transaction_id":"' || transaction_id || '","user_id":"' || user_id
       || '","timestamp":"' || strftime(event_timestamp, '%Y-%m-%dT%H:%M:%S.%g') || 'Z'
       || '","merchant_category":"' || merchant_category
       || '","amount":' || coalesce(CAST(amount AS VARCHAR), 'null')
       || ',"location":"' || location || '","currency":"' || currency || '"}' AS value,
       event_timestamp AS timestamp
FROM txc"""
    q["stream_rejected"] = _with(DIRTY) + f"""
SELECT transaction_id, user_id, event_timestamp, merchant_category, amount, location, currency, reject_reason
FROM checked WHERE reject_reason <> ''"""
    q["insert_or_ignore"] = _with(REPLAY) + f"""
SELECT DISTINCT {LEDGER} FROM replayed
WHERE amount <= 5000
  AND transaction_id NOT IN (
    SELECT transaction_id FROM validated
    WHERE event_timestamp < TIMESTAMP '{STORED_BEFORE}')"""
    q["scan_ingress_window"] = _with() + f"""
SELECT transaction_id, user_id, event_timestamp, merchant_category, CAST(amount AS DOUBLE) AS amount,
       location, currency, ingested_at
FROM raw WHERE {win('event_timestamp')}"""
    q["scan_alerts_window"] = _with() + f"SELECT {ALERT} FROM alerts WHERE {win('detected_at')}"
    q["scan_validated_window"] = _with() + f"""
SELECT transaction_id, user_id, event_timestamp, merchant_category, CAST(amount AS DOUBLE) AS amount,
       location, currency, batch_processed_at
FROM validated WHERE {win('batch_processed_at')}"""
    q["extract_validated"] = _with() + f"""
SELECT transaction_id, user_id, event_timestamp, merchant_category, CAST(amount AS DOUBLE) AS amount,
       location, currency, batch_processed_at,
       strftime(TIMESTAMP '{W_START}', '%Y-%m-%d') AS date, strftime(TIMESTAMP '{W_START}', '%H') AS hour
FROM validated WHERE {win('batch_processed_at')}"""
    q["warehouse_partitions"] = _with() + """
SELECT transaction_id, user_id, event_timestamp, merchant_category, CAST(amount AS DOUBLE) AS amount,
       location, currency, batch_processed_at,
       strftime(time_bucket(INTERVAL 6 HOUR, batch_processed_at), '%Y-%m-%d') AS date,
       strftime(time_bucket(INTERVAL 6 HOUR, batch_processed_at), '%H') AS hour
FROM validated"""
    q["ingress_totals"] = _with() + f"""
SELECT count(*) AS total_count, CAST(coalesce(sum(amount), 0) AS DOUBLE) AS total_amount
FROM raw WHERE {win('event_timestamp')}"""
    q["fraud_totals"] = _with() + f"""
SELECT count(DISTINCT transaction_id) AS fraud_count,
       CAST(coalesce(sum(amount), 0) AS DOUBLE) AS fraud_amount
FROM alerts WHERE {win('detected_at')}"""
    q["validated_totals"] = _with() + f"""
SELECT count(*) AS validated_count, CAST(coalesce(sum(amount), 0) AS DOUBLE) AS validated_amount
FROM validated WHERE {win('batch_processed_at')}"""
    q["table_counts"] = _with() + """
SELECT 'transactions_raw' AS table_name, count(*) AS row_count FROM raw
UNION ALL SELECT 'fraud_alerts', count(*) FROM alerts
UNION ALL SELECT 'validated_transactions', count(*) FROM validated"""
    report_cols = f"""merchant_category, fraud_reason, count(*) AS attempt_count,
       CAST(sum(amount) AS DOUBLE) AS total_amount,
       {_avg('amount')} AS avg_amount,
       CAST(max(amount) AS DOUBLE) AS max_amount"""
    q["fraud_report"] = _with() + f"""
SELECT {report_cols}
FROM alerts WHERE {win('detected_at')}
GROUP BY merchant_category, fraud_reason
ORDER BY attempt_count DESC, merchant_category, fraud_reason"""
    q["fraud_by_category"] = _with() + f"""
SELECT {report_cols},
       min(detected_at) AS first_detected, max(detected_at) AS last_detected
FROM alerts GROUP BY merchant_category, fraud_reason
ORDER BY attempt_count DESC, merchant_category, fraud_reason"""
    q["last_location"] = _with() + """
SELECT user_id, arg_max(location, (event_timestamp, transaction_id)) AS last_location,
       max(event_timestamp) AS last_seen, count(*) AS n_transactions
FROM txc WHERE user_id IS NOT NULL AND event_timestamp IS NOT NULL
GROUP BY user_id"""
    q["flag_rate"] = _with() + """
SELECT n_transactions, n_high_value, n_travel, n_flagged,
       CASE WHEN n_transactions > 0 THEN CAST(n_flagged AS DOUBLE) / n_transactions ELSE 0.0 END AS flag_rate
FROM (
  SELECT count(*) AS n_transactions,
         count(*) FILTER (WHERE amount > 5000) AS n_high_value,
         count(*) FILTER (WHERE t.transaction_id IS NOT NULL) AS n_travel,
         count(*) FILTER (WHERE amount > 5000 OR t.transaction_id IS NOT NULL) AS n_flagged
  FROM txc LEFT JOIN (SELECT DISTINCT transaction_id FROM travel) t USING (transaction_id)
) s"""
    q["reconcile_window"] = _with() + f"""
SELECT (SELECT window_start FROM win) AS window_start, (SELECT window_end FROM win) AS window_end,
  (SELECT count(*) FROM raw WHERE {win('event_timestamp')}) AS total_ingress_count,
  (SELECT CAST(coalesce(sum(amount), 0) AS DOUBLE) FROM raw WHERE {win('event_timestamp')}) AS total_ingress_amount,
  (SELECT count(DISTINCT transaction_id) FROM alerts WHERE {win('detected_at')}) AS fraud_count,
  (SELECT CAST(coalesce(sum(amount), 0) AS DOUBLE) FROM alerts WHERE {win('detected_at')}) AS fraud_amount,
  (SELECT count(*) FROM validated WHERE {win('batch_processed_at')}) AS validated_count,
  (SELECT CAST(coalesce(sum(amount), 0) AS DOUBLE) FROM validated WHERE {win('batch_processed_at')}) AS validated_amount"""
    money_out = """CAST(total_ingress_amount AS DOUBLE) AS total_ingress_amount,
       fraud_count, CAST(fraud_amount AS DOUBLE) AS fraud_amount,
       validated_count, CAST(validated_amount AS DOUBLE) AS validated_amount"""
    q["reconcile_all_windows"] = _with(ALL_WINDOWS) + f"""
SELECT window_start, window_end, total_ingress_count, {money_out}
FROM all_windows"""
    q["reconciliation_report_rows"] = _with(ALL_WINDOWS) + f"""
SELECT report_id, window_start, window_end, total_ingress_count, {money_out}, generated_at
FROM report_rows"""
    q["reconciliation_summary"] = _with(ALL_WINDOWS) + f"""
SELECT report_id, window_start, window_end, total_ingress_count, {money_out},
       {_pct('fraud_amount', 'total_ingress_amount')} AS fraud_percentage, generated_at
FROM report_rows ORDER BY generated_at DESC, report_id DESC"""
    q["reconciliation_report"] = _with(ALL_WINDOWS) + f"""
SELECT report_id AS "Report ID",
       strftime(window_start, '%Y-%m-%d %H:%M:%S') AS "Window Start",
       strftime(window_end, '%Y-%m-%d %H:%M:%S') AS "Window End",
       total_ingress_count AS "Total Ingress Transactions",
       CAST(total_ingress_amount AS DOUBLE) AS "Total Ingress Amount (USD)",
       fraud_count AS "Fraud Transactions",
       CAST(fraud_amount AS DOUBLE) AS "Fraud Amount (USD)",
       {_pct('fraud_amount', 'total_ingress_amount')} AS "Fraud Amount %",
       validated_count AS "Validated Transactions",
       CAST(validated_amount AS DOUBLE) AS "Validated Amount (USD)",
       {_pct('validated_amount', 'total_ingress_amount')} AS "Validated Amount %"
FROM report_rows"""
    # streaming keys: with nothing late, a stream's final output equals the batch rule
    q["stream_high_value"] = _with() + f"SELECT {ALERT} FROM alerts WHERE fraud_reason = 'HIGH_VALUE'"
    q["stream_travel"] = _with() + f"SELECT {ALERT} FROM alerts WHERE fraud_reason = 'IMPOSSIBLE_TRAVEL'"
    for stored, scanned in (("stored_fraud_by_category", "fraud_by_category"),
                            ("stored_reconcile_windows", "reconcile_all_windows"),
                            ("stored_recent_alerts", "recent_alerts")):
        q[stored] = q[scanned]
    q["stream_last_location"], q["stream_flag_rate"] = q["last_location"], q["flag_rate"]
    q["stream_late"] = _with() + f"""
, fed AS (
  SELECT *, greatest(0, least({INSTALMENTS - 1},
              CAST(floor(date_diff('day', DATE '{FIRST_DAY}', CAST(event_timestamp AS DATE)) / {DAYS}) AS INTEGER)))
            + CASE WHEN CAST(regexp_extract(location, 'City-([0-9]+),', 1) AS INTEGER) % 16 = 5 THEN 1 ELSE 0 END AS part
  FROM txc
),
reached AS (
  SELECT p.part, date_trunc('milliseconds', max(f.event_timestamp)) - INTERVAL 5 MINUTE AS watermark
  FROM (SELECT DISTINCT part FROM fed) p JOIN fed f ON f.part < p.part GROUP BY p.part
)
SELECT transaction_id, user_id, event_timestamp, merchant_category, amount, location, currency,
       'window closed before the row came' AS late_reason, watermark
FROM fed JOIN reached USING (part)
WHERE time_bucket(INTERVAL 10 MINUTE, event_timestamp) + INTERVAL 10 MINUTE <= watermark"""
    q["stream_validated"] = _with() + f"""
SELECT transaction_id, user_id, event_timestamp, merchant_category, CAST(amount AS DOUBLE) AS amount,
       location, currency
FROM validated"""
    return q
