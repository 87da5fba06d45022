"""The same results in SQL over the driver tables, written the direct way.

Where the library reduces, spreads or joins in a particular order for scale,
the SQL here states the definition: range joins for trailing windows, a window
over all rows for newest versions, and so on.
"""

from __future__ import annotations

# --- lineitem as payments -------------------------------------------------------

LINES = """lines AS (
  SELECT l_orderkey || '-' || l_linenumber AS transaction_id,
         CAST(l_suppkey AS VARCHAR) AS merchant_id,
         l_extendedprice AS amount,
         CASE l_linenumber % 3 WHEN 0 THEN 'USD' WHEN 1 THEN 'GBP' ELSE 'EUR' END AS currency,
         CASE WHEN l_returnflag = 'A' THEN 'APPROVED' WHEN l_returnflag = 'R' THEN 'REVERSED'
              WHEN l_linestatus = 'O' THEN 'DECLINED' ELSE 'PENDING' END AS status,
         CASE l_partkey % 3 WHEN 0 THEN 'CARD' WHEN 1 THEN 'WALLET' ELSE 'BANK_TRANSFER' END AS payment_method,
         CAST(l_shipdate AS DATE) AS event_date,
         l_partkey AS part, l_suppkey AS merchant, l_quantity AS quantity,
         l_returnflag AS return_flag, l_linestatus AS line_status
  FROM lineitem)"""

CURRENT = (
    LINES
    + """,
payments AS (
  SELECT * FROM lines
  QUALIFY row_number() OVER (
    PARTITION BY transaction_id
    ORDER BY event_date DESC, part DESC, merchant DESC, amount DESC, quantity DESC,
             return_flag DESC, line_status DESC) = 1)"""
)

LINE_MERCHANTS = """shops AS (
  SELECT CAST(s_suppkey AS VARCHAR) AS merchant_id, s_name AS merchant_name, n_name AS merchant_category
  FROM supplier JOIN nation ON s_nationkey = n_nationkey
  WHERE s_acctbal >= 0)"""

APPROVED_CARDS = "count(*) FILTER (payment_method = 'CARD' AND status = 'APPROVED')"
DECIDED_CARDS = "count(*) FILTER (payment_method = 'CARD' AND status IN ('APPROVED', 'DECLINED'))"
REVERSALS = "count(*) FILTER (status = 'REVERSED')"


def rate(part: str, whole: str) -> str:
    return f"round(CAST({part} AS DOUBLE) / nullif({whole}, 0), 4)"


def daily_summary(payments: str, shops: str) -> str:
    """Daily summary of a payments CTE joined with a merchants CTE."""
    return f"""
grouped AS (
  SELECT event_date, merchant_id, currency, status, count(transaction_id) AS n,
         CAST(sum(CAST(amount AS DECIMAL(18,2))) AS DOUBLE) AS total, count(amount) AS amounts, max(amount) AS most,
         {APPROVED_CARDS} AS approved, {DECIDED_CARDS} AS decided
  FROM {payments} GROUP BY ALL)
SELECT CAST(event_date AS VARCHAR) AS event_date, g.merchant_id, merchant_name, merchant_category, currency, status,
       n AS transaction_count, round(total, 2) AS total_amount, round(total / amounts, 4) AS avg_amount, most AS max_amount,
       CASE WHEN g.merchant_id IS NOT NULL AND currency IS NOT NULL THEN
         {rate("sum(approved) OVER day", "sum(decided) OVER day")} END AS merchant_daily_approval_rate
FROM grouped g LEFT JOIN {shops} s ON s.merchant_id = g.merchant_id
WINDOW day AS (PARTITION BY event_date, g.merchant_id, currency)"""


def performance(payments: str, shops: str, days: int) -> str:
    """Trailing merchant performance by a plain range join."""
    return f"""
snapshots AS (SELECT DISTINCT event_date AS snapshot_date FROM {payments}),
windows AS (
  SELECT d.snapshot_date, p.merchant_id,
         count(*) AS total_transactions_{days}d,
         round(CAST(sum(CASE WHEN p.status = 'APPROVED' THEN CAST(p.amount AS DECIMAL(18,2)) ELSE 0 END) AS DOUBLE), 2) AS total_approved_amount_{days}d,
         {rate(APPROVED_CARDS, DECIDED_CARDS)} AS merchant_daily_approval_rate_{days}d,
         {rate(f"nullif({REVERSALS}, 0)", "count(*)")} AS reversal_rate_{days}d,
         count(DISTINCT p.event_date) AS active_days_{days}d
  FROM snapshots d JOIN {payments} p
    ON p.event_date BETWEEN d.snapshot_date - INTERVAL {days - 1} DAY AND d.snapshot_date
  GROUP BY d.snapshot_date, p.merchant_id)
SELECT w.* REPLACE (CAST(w.snapshot_date AS VARCHAR) AS snapshot_date), s.merchant_name
FROM windows w LEFT JOIN {shops} s ON s.merchant_id = w.merchant_id"""


LINE_HASH = """sha256(concat_ws('|',
  'amount=' || CAST(CAST(amount AS DECIMAL(18,2)) AS VARCHAR), 'currency=' || currency,
  'event_date=' || CAST(event_date AS VARCHAR), 'line_status=' || line_status, 'merchant_id=' || merchant_id,
  'part=' || part, 'payment_method=' || payment_method,
  'quantity=' || CAST(CAST(quantity AS DECIMAL(18,2)) AS VARCHAR), 'return_flag=' || return_flag,
  'status=' || status, 'transaction_id=' || transaction_id))"""

# --- events as delivery text ----------------------------------------------------

TEXT = """clean AS (
  SELECT 'TXN-' || event_id AS transaction_id,
         'M' || user_id AS merchant_id,
         'C' || user_id AS customer_id,
         'u' || user_id || '@mail.test' AS customer_email,
         '+1555' || lpad(CAST(user_id AS VARCHAR), 7, '0') AS customer_phone,
         CAST(CAST(value AS DECIMAL(18,2)) AS VARCHAR) AS amount,
         CASE user_id % 3 WHEN 0 THEN 'USD' WHEN 1 THEN 'GBP' ELSE 'EUR' END AS currency,
         CASE WHEN event_type IN ('purchase', 'view') THEN 'APPROVED' WHEN event_type = 'error' THEN 'DECLINED'
              WHEN event_type = 'click' THEN 'REVERSED' ELSE 'PENDING' END AS status,
         strftime(ts, '%Y-%m-%d %H:%M:%S.%f') AS transaction_ts,
         CASE event_id % 3 WHEN 0 THEN 'CARD' WHEN 1 THEN 'WALLET' ELSE 'BANK_TRANSFER' END AS payment_method,
         CASE event_id % 3 WHEN 0 THEN lpad(CAST(user_id AS VARCHAR), 4, '0') ELSE '' END AS card_last4,
         'GW-' || event_id AS gateway_ref,
         'delivery=week' || ((day(ts) - 1) // 7 + 1) AS source_file,
         props AS device, event_id, ts
  FROM events)"""

SOILED = (
    TEXT
    + """,
soiled AS (
  SELECT * REPLACE (
    CASE event_id % 8 WHEN 0 THEN 'N/A' WHEN 1 THEN '' WHEN 2 THEN '1,' || amount WHEN 3 THEN 'nan'
         WHEN 4 THEN ' ' || amount || ' ' WHEN 5 THEN amount || 'd' WHEN 6 THEN amount || 'e1'
         ELSE amount END AS amount,
    CASE event_id % 5 WHEN 1 THEN replace(transaction_ts, ' ', 'T') || 'Z' WHEN 2 THEN 'x'
         WHEN 3 THEN '2024-13-45 00:00:00' WHEN 4 THEN '' ELSE transaction_ts END AS transaction_ts)
  FROM clean)"""
)


def typed(source: str) -> str:
    """CTE `typed` over text: lenient casts, NULL where the text is no value."""
    return f"""
typed AS (
  SELECT * REPLACE (
      CASE WHEN isnan(try_cast(amount AS DOUBLE)) THEN NULL ELSE try_cast(amount AS DOUBLE) END AS amount,
      try_cast(rtrim(replace(transaction_ts, 'T', ' '), 'Z') AS TIMESTAMP) AS transaction_ts),
    CAST(CAST(try_cast(rtrim(replace(transaction_ts, 'T', ' '), 'Z') AS TIMESTAMP) AS DATE) AS VARCHAR) AS event_date
  FROM {source})"""


FATE = """CASE WHEN amount IS NULL THEN 'bad_amount' WHEN event_date IS NULL THEN 'bad_timestamp'
  ELSE 'accepted' END"""

EVENT_HASH = """sha256(concat_ws('|',
  'amount=' || coalesce(CAST(CAST(amount AS DECIMAL(18,2)) AS VARCHAR), '\\N'), 'card_last4=' || card_last4,
  'currency=' || currency, 'customer_email=' || customer_email, 'customer_id=' || customer_id,
  'customer_phone=' || customer_phone, 'event_date=' || coalesce(event_date, '\\N'), 'gateway_ref=' || gateway_ref,
  'merchant_id=' || merchant_id, 'payment_method=' || payment_method, 'status=' || status,
  'transaction_id=' || transaction_id,
  'transaction_ts=' || coalesce(CAST(epoch_us(transaction_ts) AS VARCHAR), '\\N')))"""

EVENT_PAYMENTS = (
    TEXT
    + """,
payments AS (
  SELECT * REPLACE (CAST(amount AS DOUBLE) AS amount), CAST(ts AS DATE) AS event_date FROM clean)"""
)

CUSTOMERS = """customers AS (
  SELECT 'M' || c_custkey AS merchant_id, c_name AS merchant_name, c_mktsegment AS merchant_category,
         n_name AS country, c_acctbal,
         CASE WHEN c_mktsegment = 'MACHINERY' THEN NULL
              ELSE DATE '2020-01-01' + CAST(c_custkey % 1000 AS INTEGER) END AS onboarding_date,
         CASE WHEN c_mktsegment = 'BUILDING' THEN NULL ELSE c_acctbal >= 0 END AS is_active
  FROM customer JOIN nation ON c_nationkey = n_nationkey),
shops AS (SELECT * FROM customers WHERE c_acctbal >= 0)"""

# Deliveries of the ingest counts: weeks, and weeks 1 and 2 once more in between.
RESUBMITTED = """
sent AS (
  SELECT * FROM typed
  UNION ALL
  SELECT * REPLACE ('delivery=week1_resubmit' AS source_file) FROM typed
  WHERE source_file IN ('delivery=week1', 'delivery=week2')),
judged AS (
  SELECT source_file, fate,
         fate = 'accepted' AND source_file = min(source_file) OVER (PARTITION BY transaction_id) AS stored
  FROM (SELECT *, """ + FATE + """ AS fate FROM sent))"""

# What the audited run reports per delivery.
AUDITED = """
judged AS (
  SELECT source_file,
         CASE source_file WHEN 'delivery=week2' THEN 'overflowing' WHEN 'delivery=week5' THEN 'missing_columns'
              ELSE 'ingested' END AS outcome,
         """ + FATE + """ AS fate
  FROM typed),
counted AS (
  SELECT source_file, outcome, count(*) AS rows_read,
         count(*) FILTER (outcome = 'ingested' AND fate = 'accepted') AS rows_written,
         count(*) FILTER (outcome = 'ingested' AND fate = 'bad_amount') AS rows_quarantined,
         count(*) FILTER (outcome = 'ingested' AND fate = 'bad_timestamp') AS rows_undated
  FROM judged GROUP BY ALL)"""

MOVED = """newest AS (
  SELECT * REPLACE (
    CASE WHEN late THEN 'REVERSED' ELSE status END AS status,
    CASE WHEN late AND event_id % 2 = 0 THEN DATE '2024-01-20' ELSE event_date END AS event_date)
  FROM (SELECT *, status = 'PENDING' AND event_date BETWEEN DATE '2024-01-10' AND DATE '2024-01-16' AS late FROM payments))"""

ORACLES = {
    "daily_payment_summary": f"WITH {CURRENT}, {LINE_MERCHANTS}, {daily_summary('payments', 'shops')}",
    **{
        f"merchant_performance_{n}d": f"WITH {CURRENT}, {LINE_MERCHANTS}, {performance('payments', 'shops', n)}"
        for n in (7, 30, 1, 90)
    },
    "latest_status_per_txn": f"""WITH {CURRENT}
        SELECT transaction_id, CAST(event_date AS VARCHAR) AS event_date, merchant_id, currency, status,
               payment_method, amount
        FROM payments""",
    "approval_rate": f"""WITH {CURRENT}
        SELECT CAST(event_date AS VARCHAR) AS event_date, merchant_id, currency,
               {rate(APPROVED_CARDS, DECIDED_CARDS)} AS approval_rate
        FROM payments GROUP BY event_date, merchant_id, currency""",
    "reversal_rate": f"""WITH {CURRENT}
        SELECT CAST(event_date AS VARCHAR) AS event_date, merchant_id,
               {rate(f"nullif({REVERSALS}, 0)", "count(*)")} AS reversal_rate
        FROM payments GROUP BY event_date, merchant_id""",
    "active_days": f"""WITH {CURRENT}
        SELECT merchant_id, count(DISTINCT event_date) AS active_days FROM payments GROUP BY merchant_id""",
    "date_merchant_spine": f"""WITH {CURRENT}, {LINE_MERCHANTS},
        days AS (SELECT DISTINCT event_date AS snapshot_date FROM payments),
        sellers AS (SELECT DISTINCT merchant_id FROM payments)
        SELECT CAST(d.snapshot_date AS VARCHAR) AS snapshot_date, s.merchant_id, m.merchant_name
        FROM days d CROSS JOIN sellers s LEFT JOIN shops m ON m.merchant_id = s.merchant_id
        WHERE EXISTS (SELECT 1 FROM payments p WHERE p.merchant_id = s.merchant_id
                      AND p.event_date BETWEEN d.snapshot_date - INTERVAL 6 DAY AND d.snapshot_date)""",
    "left_join_dimension": f"""WITH {LINES}, {LINE_MERCHANTS}
        SELECT l.transaction_id, l.merchant_id, l.amount, CAST(l.event_date AS VARCHAR) AS event_date,
               m.merchant_name, m.merchant_category
        FROM lines l LEFT JOIN shops m ON m.merchant_id = l.merchant_id""",
    "dedup_anti_join": f"""WITH {LINES}
        SELECT transaction_id, {LINE_HASH} AS record_hash, CAST(event_date AS VARCHAR) AS event_date
        FROM lines WHERE event_date >= DATE '1998-07-01'""",
    "first_file_wins": f"""WITH {LINES}
        SELECT transaction_id, {LINE_HASH} AS record_hash,
               CASE WHEN status = 'REVERSED' THEN 'b.csv' ELSE 'a.csv' END AS source_file,
               CAST(CASE WHEN status <> 'REVERSED' AND line_status = 'F' THEN 2 ELSE 1 END AS BIGINT) AS copies
        FROM lines""",
    "code_lists": f"""WITH {LINES}
        SELECT payment_method, count(*) AS payments, CASE payment_method WHEN 'CASH' THEN 'false' ELSE 'true' END AS allowed
        FROM (SELECT CASE WHEN part % 7 = 0 THEN 'CASH' ELSE payment_method END AS payment_method FROM lines) GROUP BY payment_method""",
    "empty_write": f"WITH {LINES} SELECT status, count(*) AS rows, 'false' AS written_before FROM lines GROUP BY status",
    "run_ids": f"""WITH {TEXT}
        SELECT CASE WHEN source_file < 'delivery=week4' THEN '2024-02-01' ELSE '2024-02-02' END AS ingest_day, count(*) AS rows
        FROM clean GROUP BY ALL""",
    "exact_sums": """SELECT CAST(l_suppkey AS VARCHAR) AS merchant_id,
               round(fsum(CAST(l_extendedprice AS DOUBLE) * (1 - CAST(l_discount AS DOUBLE)) * (1 + CAST(l_tax AS DOUBLE)) / 7), 4) AS total_amount
        FROM lineitem GROUP BY l_suppkey""",
    "cast_amount": f"WITH {SOILED}, {typed('soiled')} SELECT transaction_id, amount FROM typed",
    "cast_timestamp": f"""WITH {SOILED}, {typed('soiled')}
        SELECT transaction_id, CAST(epoch_us(transaction_ts) AS VARCHAR) AS transaction_micros FROM typed""",
    "derive_event_date": f"WITH {SOILED}, {typed('soiled')} SELECT transaction_id, event_date FROM typed",
    "quarantine_split": f"WITH {SOILED}, {typed('soiled')} SELECT transaction_id, {FATE} AS fate FROM typed",
    "backfill_filter": f"""WITH {SOILED}, {typed('soiled')}
        SELECT transaction_id, event_date, amount FROM typed
        WHERE amount IS NOT NULL AND event_date BETWEEN '2024-01-10' AND '2024-01-16'""",
    "record_hash": f"""WITH {SOILED},
        amounts AS (SELECT s.* REPLACE (c.transaction_ts AS transaction_ts)
                    FROM soiled s JOIN clean c USING (event_id)), {typed('amounts')}
        SELECT transaction_id, {EVENT_HASH} AS record_hash FROM typed""",
    "enrich_metadata": f"""WITH {SOILED},
        amounts AS (SELECT s.* REPLACE (c.transaction_ts AS transaction_ts)
                    FROM soiled s JOIN clean c USING (event_id)), {typed('amounts')}
        SELECT transaction_id, {EVENT_HASH} AS record_hash,
               epoch_us(TIMESTAMP '2024-02-01 00:00:00') AS ingest_micros, 'run-1' AS ingest_run_id,
               replace(source_file, 'delivery=', '') || '.csv' AS source_file
        FROM typed""",
    "merchant_typing": f"""WITH {CUSTOMERS}
        SELECT merchant_id, merchant_name, CAST(onboarding_date AS VARCHAR) AS onboarding_date,
               CAST(is_active AS VARCHAR) AS is_active
        FROM customers""",
    "pii_free_projection": f"""WITH {EVENT_PAYMENTS}
        SELECT transaction_id, CAST(event_date AS VARCHAR) AS event_date, merchant_id, currency, status,
               payment_method, amount
        FROM payments""",
    "csv_scan_strings": f"WITH {TEXT} SELECT * EXCLUDE (source_file, device, event_id, ts) FROM clean",
    "csv_lineage_counts": f"WITH {TEXT} SELECT source_file, count(*) AS rows FROM clean GROUP BY source_file",
    "csv_skip_bad_files": f"""WITH {TEXT}
        SELECT source_file, transaction_id, amount, gateway_ref FROM clean WHERE source_file <> 'delivery=week2'""",
    "csv_schema_gate": f"""WITH {TEXT}
        SELECT source_file, count(*) AS rows,
               CASE source_file WHEN 'delivery=week5' THEN 'false' ELSE 'true' END AS passed,
               CASE source_file WHEN 'delivery=week5' THEN 'amount,currency' ELSE '' END AS missing_columns,
               CASE WHEN source_file IN ('delivery=week4', 'delivery=week5') THEN 'device' ELSE '' END AS extra_columns
        FROM clean GROUP BY source_file""",
    "bronze_ingest_counts": f"""WITH {SOILED}, {typed('soiled')}, {RESUBMITTED}
        SELECT source_file, 'ingested' AS outcome, count(*) AS rows_read,
               count(*) FILTER (stored) AS rows_written,
               count(*) FILTER (fate = 'accepted' AND NOT stored) AS rows_skipped,
               count(*) FILTER (fate = 'bad_amount') AS rows_quarantined,
               count(*) FILTER (fate = 'bad_timestamp') AS rows_undated
        FROM judged GROUP BY source_file""",
    "bronze_roundtrip": f"""WITH {TEXT}, {typed('clean')}
        SELECT * EXCLUDE (transaction_ts, device, event_id, ts), epoch_us(transaction_ts) AS transaction_micros,
               {EVENT_HASH} AS record_hash
        FROM typed""",
    "idempotent_rerun": f"""WITH {EVENT_PAYMENTS}
        SELECT CAST(event_date AS VARCHAR) AS event_date, count(*) AS rows, count(DISTINCT transaction_id) AS hashes
        FROM payments GROUP BY event_date""",
    "scan_partition_prune": f"""WITH {EVENT_PAYMENTS}
        SELECT transaction_id, amount, CAST(event_date AS VARCHAR) AS event_date FROM payments
        WHERE event_date BETWEEN DATE '2024-01-10' AND DATE '2024-01-16'""",
    "scan_project": f"WITH {TEXT} SELECT transaction_id, status FROM clean",
    "schema_evolution_union": f"""WITH {EVENT_PAYMENTS}
        SELECT transaction_id, amount, CAST(event_date AS VARCHAR) AS event_date,
               CASE WHEN source_file = 'delivery=week4' THEN device END AS device
        FROM payments WHERE source_file <> 'delivery=week5'""",
    "merchant_dedup": f"""WITH {CUSTOMERS}
        SELECT merchant_id, CAST(CASE WHEN is_active THEN 1 ELSE 2 END AS BIGINT) AS versions,
               CAST(1 AS BIGINT) AS active_versions
        FROM customers""",
    "audit_file_counts": f"""WITH {SOILED}, {typed('soiled')}, {AUDITED}
        SELECT 'run-1' AS run_id, 'PARTIAL' AS status, *,
               CASE outcome WHEN 'missing_columns' THEN 'amount' ELSE '' END AS missing_columns,
               rows_read - rows_written - rows_quarantined - rows_undated AS rows_skipped
        FROM counted""",
    "audit_stage_report": f"""WITH {SOILED}, {typed('soiled')}, {AUDITED}
        SELECT 'run-1' AS run_id, 'bronze' AS pipeline_stage, 'PARTIAL' AS status, source_file AS table_name,
               rows_read, rows_written,
               CASE outcome WHEN 'ingested' THEN rows_quarantined ELSE rows_read END AS rows_quarantined
        FROM counted""",
    "gold_partition_overwrite": f"""WITH {EVENT_PAYMENTS}, {CUSTOMERS},
        remaining AS (
          SELECT * FROM payments
          WHERE status <> 'PENDING' OR event_date NOT BETWEEN DATE '2024-01-10' AND DATE '2024-01-16'),
        {daily_summary('remaining', 'shops')}""",
    "adhoc_gold_select": f"""WITH {EVENT_PAYMENTS}
        SELECT CAST(event_date AS VARCHAR) AS event_date, merchant_id, currency, status,
               count(*) AS transaction_count, round(sum(amount), 2) AS total_amount
        FROM payments GROUP BY event_date, merchant_id, currency, status
        ORDER BY event_date, merchant_id, currency, status""",
    "adhoc_rows_per_date": f"""WITH {EVENT_PAYMENTS}
        SELECT CAST(event_date AS VARCHAR) AS event_date, count(*) AS rows
        FROM payments GROUP BY event_date ORDER BY event_date""",
    "backfill_rolling_lookback": f"""WITH {EVENT_PAYMENTS}, {CUSTOMERS},
        newest AS (
          SELECT * REPLACE (
            CASE WHEN status = 'PENDING' AND event_date BETWEEN DATE '2024-01-10' AND DATE '2024-01-16'
                 THEN 'REVERSED' ELSE status END AS status)
          FROM payments),
        {performance('newest', 'shops', 7)}""",
    "current_state_merge": f"""WITH {EVENT_PAYMENTS}, {MOVED}
        SELECT transaction_id, merchant_id, currency, status, payment_method, amount, CAST(event_date AS VARCHAR) AS event_date
        FROM newest""",
    "incremental_reports": f"""WITH {EVENT_PAYMENTS}, {CUSTOMERS}, {MOVED}, {performance('newest', 'shops', 7)}""",
    "publish_after_failure": f"""WITH {EVENT_PAYMENTS}, {CUSTOMERS}, {daily_summary('payments', 'shops')}""",
    "bronze_damaged_file": f"""WITH {EVENT_PAYMENTS}, {CUSTOMERS},
        readable AS (SELECT * FROM payments WHERE event_date <> DATE '2024-01-10'),
        {daily_summary('readable', 'shops')}""",
    "adhoc_performance_select": f"""SELECT snapshot_date, merchant_id, total_transactions_7d, total_approved_amount_7d, active_days_7d
        FROM (WITH {EVENT_PAYMENTS}, {CUSTOMERS}, {performance('payments', 'shops', 7)})
        ORDER BY snapshot_date, merchant_id""",
    "quarantine_rerun": f"""WITH {SOILED}, {typed('soiled')}
        SELECT transaction_id, reason, count(*) AS rows
        FROM (SELECT transaction_id, {FATE} AS reason FROM typed)
        WHERE reason IN ('bad_amount', 'bad_timestamp') GROUP BY ALL""",
    "audit_empty_run": f"""WITH {TEXT}
        SELECT 'run-1' AS run_id, 'SUCCESS' AS status, source_file, 'ingested' AS outcome,
               n AS rows_read, n AS rows_written, CAST(0 AS BIGINT) AS rows_skipped,
               CAST(0 AS BIGINT) AS rows_quarantined, CAST(0 AS BIGINT) AS rows_undated
        FROM (SELECT source_file, count(*) AS n FROM clean GROUP BY source_file
              UNION ALL SELECT DISTINCT replace(source_file, 'delivery=', 'delivery=void-'), CAST(0 AS BIGINT) FROM clean)""",
    "strict_contract_report": f"""WITH {EVENT_PAYMENTS}, {CUSTOMERS},
        stored AS (SELECT count(*) AS n FROM payments),
        written AS (SELECT count(*) AS n FROM (WITH {performance('payments', 'shops', 7).lstrip()}))
        SELECT 'run-1' AS run_id, 'gold' AS pipeline_stage, 'PARTIAL' AS status, table_name, rows_read, rows_written, rows_quarantined
        FROM (SELECT 'daily_payment_summary' AS table_name, n AS rows_read, CAST(0 AS BIGINT) AS rows_written, n AS rows_quarantined
              FROM stored
              UNION ALL
              SELECT 'merchant_performance_7d', stored.n, written.n, CAST(0 AS BIGINT) FROM stored, written)""",
    "failed_run_report": """SELECT 'run-1' AS run_id, 'bronze' AS pipeline_stage, 'FAILED' AS status, CAST(NULL AS VARCHAR) AS table_name,
               CAST(0 AS BIGINT) AS rows_read, CAST(0 AS BIGINT) AS rows_written, CAST(0 AS BIGINT) AS rows_quarantined""",
}
