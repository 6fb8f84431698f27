"""The registered queries as SQL over the sample tables, for an independent check."""

from __future__ import annotations

# ---- the sample tables as payments --------------------------------------------------------

SALES = """sales AS (
  SELECT o_custkey AS customer_id, l_suppkey AS merchant_id, l_partkey AS device_id,
         CAST(substr(o_orderpriority, 1, 1) AS INTEGER) AS payment_method_id,
         CAST(l_shipdate AS DATE) AS txn_date, l_extendedprice AS transaction_amount,
         l_quantity * 60 AS processing_time,
         CASE WHEN l_returnflag = 'R' THEN 'Fraud' ELSE 'Success' END AS status
  FROM lineitem LEFT JOIN orders ON l_orderkey = o_orderkey)"""

DIMS = """customers AS (
  SELECT c_custkey AS customer_id, c_name AS name, c_mktsegment AS customer_segment,
         c_acctbal AS total_lifetime_spend FROM customer),
merchants AS (
  SELECT s_suppkey AS merchant_id, r_name AS business_category
  FROM supplier JOIN nation ON s_nationkey = n_nationkey JOIN region ON n_regionkey = r_regionkey),
devices AS (SELECT p_partkey AS device_id, p_type AS device_type FROM part),
methods AS (
  SELECT DISTINCT CAST(substr(o_orderpriority, 1, 1) AS INTEGER) AS payment_method_id,
         substr(o_orderpriority, 3) AS method_type FROM orders)"""

FEED = """feed AS (
  SELECT CAST(event_id AS VARCHAR) AS transaction_id, user_id AS customer_id, CAST(k % 10 AS BIGINT) AS merchant_id,
         CAST(k AS BIGINT) AS device_id, CAST(1 + k % 5 AS INTEGER) AS payment_method_id,
         strftime(ts, '%Y-%m-%d %H:%M:%S') AS transaction_timestamp, value AS transaction_amount,
         50 + 30 * CAST(k AS DOUBLE) AS processing_time, CAST(k AS DOUBLE) / 100 AS fraud_score,
         CASE WHEN event_type = 'error' THEN 'Fraud' ELSE 'Success' END AS status, ts, CAST(ts AS DATE) AS txn_date
  FROM (SELECT *, CAST(json_extract_string(props, '$.k') AS INTEGER) AS k FROM events))"""

FAULTY = (
    FEED
    + """,
faulty AS (
  SELECT transaction_id,
         CASE WHEN e % 83 = 0 THEN NULL WHEN e % 79 = 0 THEN customer_id + 10000000 ELSE customer_id END AS customer_id,
         merchant_id, device_id, payment_method_id,
         CASE WHEN e % 97 = 0 THEN 'junk' ELSE transaction_timestamp END AS transaction_timestamp,
         CASE WHEN e % 89 = 0 THEN -transaction_amount ELSE transaction_amount END AS transaction_amount,
         processing_time, fraud_score,
         CASE WHEN e % 71 = 0 THEN 'Pending' WHEN e % 73 = 0 THEN NULL ELSE status END AS status
  FROM (SELECT *, CAST(transaction_id AS BIGINT) AS e FROM feed)),
checked AS (
  SELECT *, concat_ws(',',
           CASE WHEN try_strptime(transaction_timestamp, '%Y-%m-%d %H:%M:%S') IS NULL THEN 'bad_timestamp' END,
           CASE WHEN transaction_id IS NULL OR customer_id IS NULL OR merchant_id IS NULL OR device_id IS NULL
                  OR payment_method_id IS NULL THEN 'null_key' END,
           CASE WHEN transaction_amount IS NULL OR transaction_amount < 0 THEN 'bad_amount' END,
           CASE WHEN status IS NULL OR status NOT IN ('Success', 'Fraud') THEN 'unknown_status' END) AS reasons
  FROM faulty)"""
)

FEED_COLUMNS = """transaction_id, customer_id, merchant_id, device_id, payment_method_id, transaction_timestamp,
  transaction_amount, processing_time, fraud_score, status, ts, txn_date"""

# Both snapshots and the live rows, copies included.
OVERLAP = (
    FEED
    + """,
copies AS (
  SELECT * FROM feed WHERE ts < TIMESTAMP '2024-01-10'
  UNION ALL
  SELECT * FROM feed WHERE ts >= TIMESTAMP '2024-01-09 21:00:00' AND ts < TIMESTAMP '2024-01-20'
  UNION ALL
  SELECT * FROM feed WHERE ts >= TIMESTAMP '2024-01-19 21:00:00')"""
)

# ---- building blocks ----------------------------------------------------------------------


def total(column: str = "transaction_amount", digits: int = 6) -> str:
    return f"CAST(SUM(CAST({column} AS DECIMAL(18,{digits}))) AS DOUBLE)"


def mean(column: str = "transaction_amount", digits: int = 6) -> str:
    return f"{total(column, digits)} / COUNT({column})"


def star(dim: str, key: str, label: str, sums: str, average: str) -> str:
    return f"""WITH {SALES}, {DIMS}
SELECT {label}, COUNT(*) AS transactions, {total()} AS {sums}, {mean()} AS {average}
FROM sales JOIN {dim} USING ({key}) GROUP BY {label}"""


DIMENSION_KPIS = {
    "merchant": ("merchants", "merchant_id", "business_category"),
    "customer": ("customers", "customer_id", "customer_segment"),
    "payment": ("methods", "payment_method_id", "method_type"),
    "device": ("devices", "device_id", "device_type"),
}


def every_kpi(measures: str, *dimensions: str, fact: str = "sales") -> str:
    parts = [
        f"SELECT 'global' AS kpi, CAST(NULL AS VARCHAR) AS dim_value, {measures} FROM {fact}",
        f"SELECT 'daily', CAST(txn_date AS VARCHAR), {measures} FROM {fact} GROUP BY txn_date",
    ]
    for kpi in dimensions:
        dim, key, label = DIMENSION_KPIS[kpi]
        parts.append(f"SELECT '{kpi}', {label}, {measures} FROM {fact} JOIN {dim} USING ({key}) GROUP BY {label}")
    return f"WITH {SALES if fact == 'sales' else FEED}, {DIMS}\n" + "\nUNION ALL\n".join(parts)


AMOUNTS = f"COUNT(*) AS transactions, {total()} AS total, {mean()} AS average"
FRAUD = """COUNT(*) AS transactions, COUNT(*) FILTER (status = 'Fraud') AS fraud_transactions,
  CAST(100 AS DOUBLE) * COUNT(*) FILTER (status = 'Fraud') / COUNT(*) AS fraud_rate_pct"""

DAILY = f"""SELECT txn_date, COUNT(*) AS transactions, {total()} AS total_volume, {mean()} AS avg_value
FROM {{}} GROUP BY txn_date"""

CLOSED = "window_end <= (SELECT MAX(ts) FROM feed) - INTERVAL 10 MINUTES"
AS_OF = "(SELECT MAX(ts) FROM feed)"


def profile(column: str, numeric: bool) -> str:
    low, high = (f"CAST(MIN({column}) AS DOUBLE)", f"CAST(MAX({column}) AS DOUBLE)") if numeric else ("NULL", "NULL")
    if numeric:
        low, high = (f"CASE WHEN {edge} = 0 THEN CAST(0 AS DOUBLE) ELSE {edge} END" for edge in (low, high))
    return f"""SELECT '{column}' AS "column", COUNT(*) AS "rows", COUNT(*) - COUNT({column}) AS nulls,
  COUNT(DISTINCT {column}) AS distinct_values, CAST({low} AS DOUBLE) AS min_value, CAST({high} AS DOUBLE) AS max_value
FROM faulty"""


def orphans(key: str, dim: str) -> str:
    missing = f"f.{key} IS NOT NULL AND NOT EXISTS (SELECT 1 FROM {dim} d WHERE d.{key} = f.{key})"
    return f"""SELECT '{key}' AS dim, COUNT(DISTINCT CASE WHEN {missing} THEN f.{key} END) AS orphan_keys,
  CAST(COALESCE(SUM(CASE WHEN {missing} THEN 1 ELSE 0 END), 0) AS BIGINT) AS orphan_rows,
  COUNT(*) - COUNT(f.{key}) AS null_rows
FROM faulty f"""


def band(column: str, normal: tuple, fraud: tuple) -> str:
    return f"""CASE WHEN {column} BETWEEN {normal[0]} AND {normal[1]} THEN 'normal'
     WHEN {column} BETWEEN {fraud[0]} AND {fraud[1]} THEN 'fraud' ELSE 'other' END"""


ORACLE: dict[str, str] = {
    "kpi_global": f"""WITH {SALES}
SELECT COUNT(*) AS total_transactions, {total()} AS total_volume, {mean()} AS avg_transaction_value FROM sales""",
    "kpi_daily_fine": "WITH taxed AS (SELECT CAST(l_shipdate AS DATE) AS txn_date, l_extendedprice * (1 - l_discount) * (1 + l_tax)"
    f" AS transaction_amount FROM lineitem) {DAILY.format('taxed')}",
    "kpi_daily": f"WITH {SALES}\n{DAILY.format('sales')}",
    "kpi_by_merchant_category": star("merchants", "merchant_id", "business_category", "total_revenue", "avg_ticket_size"),
    "kpi_by_customer_segment": star("customers", "customer_id", "customer_segment", "total_spend", "avg_spend"),
    "kpi_by_payment_method": star("methods", "payment_method_id", "method_type", "total_volume", "avg_value"),
    "kpi_by_device": star("devices", "device_id", "device_type", "total_volume", "avg_value"),
    "kpi_by_calendar": f"""WITH {FEED}
SELECT strftime(ts, '%a') AS day_of_week, CAST(hour(ts) AS INTEGER) AS "hour", isodow(ts) >= 6 AS is_weekend,
  COUNT(*) AS transactions, {total()} AS total_volume, {mean()} AS avg_value
FROM feed GROUP BY ALL""",
    "kpi_all_one_pass": every_kpi(AMOUNTS, "merchant", "customer", "payment", "device"),
    "kpi_fraud_rate": every_kpi(FRAUD, "merchant", "customer", "payment", "device"),
    "kpi_latency": f"""WITH {SALES}
SELECT COUNT(*) AS transactions, {mean("processing_time")} AS avg_latency, MAX(processing_time) AS max_latency,
  quantile_cont(processing_time, 0.5) AS p50_latency, quantile_cont(processing_time, 0.95) AS p95_latency
FROM sales""",
    "kpi_tpm": f"""WITH {FEED}
SELECT date_trunc('minute', ts) AS "minute", COUNT(*) AS transactions FROM feed GROUP BY 1""",
    "kpi_velocity": f"""WITH {FEED},
hourly AS (
  SELECT date_trunc('hour', ts) AS "hour", COUNT(*) AS transactions,
         SUM(CAST(transaction_amount AS DECIMAL(18,6))) AS volume FROM feed GROUP BY 1)
SELECT "hour", transactions, CAST(volume AS DOUBLE) AS revenue,
  CAST(volume - LAG(volume) OVER (ORDER BY "hour") AS DOUBLE) AS revenue_delta
FROM hourly""",
    # The quiet hours are written out here, unlike in the query.
    "kpi_fraud_spikes": f"""WITH {FEED},
hours AS (
  SELECT unnest(generate_series(date_trunc('hour', MIN(ts)), date_trunc('hour', MAX(ts)), INTERVAL 1 HOUR)) AS "hour"
  FROM feed),
counted AS (
  SELECT h."hour", COUNT(*) FILTER (status = 'Fraud') AS n
  FROM hours h LEFT JOIN feed f ON date_trunc('hour', f.ts) = h."hour" GROUP BY h."hour"),
framed AS (
  SELECT "hour", n, CAST(SUM(n) OVER earlier AS DOUBLE) / COUNT(*) OVER earlier AS trailing_mean
  FROM counted WINDOW earlier AS (ORDER BY "hour" ROWS BETWEEN 24 PRECEDING AND 1 PRECEDING))
SELECT "hour", n AS fraud_transactions, trailing_mean FROM framed WHERE n > 2 * trailing_mean""",
    "hot_cold_union": f"WITH {OVERLAP}\nSELECT {FEED_COLUMNS} FROM copies",
    "hot_cold_dedup": f"WITH {FEED}\nSELECT {FEED_COLUMNS} FROM feed",
    "hot_cold_dedup_cutoff": f"WITH {OVERLAP}\nSELECT DISTINCT {FEED_COLUMNS} FROM copies",
    "kpi_daily_double_counted": f"WITH {OVERLAP}\n{DAILY.format('copies')}",
    "kpi_daily_hot_cold": f"WITH {FEED}\n{DAILY.format('feed')}",
    "archive_snapshot": f"WITH {FEED}\nSELECT {FEED_COLUMNS} FROM feed",
    "archive_expired": f"WITH {FEED}\nSELECT {FEED_COLUMNS} FROM feed WHERE ts < {AS_OF} - INTERVAL 3 HOURS",
    "retain_hot": f"WITH {FEED}\nSELECT {FEED_COLUMNS} FROM feed WHERE ts >= {AS_OF} - INTERVAL 3 HOURS",
    "archive_two_runs_external": f"""WITH {FEED}
SELECT transaction_id, ts, CASE
    WHEN ts < TIMESTAMP '2024-01-09 21:00:00' AND CAST(transaction_id AS BIGINT) % 50 <> 0 THEN '2024-01-10'
    WHEN ts < TIMESTAMP '2024-01-10' THEN '2024-01-20'
    WHEN ts < TIMESTAMP '2024-01-19 21:00:00' AND CAST(transaction_id AS BIGINT) % 50 <> 0 THEN '2024-01-20'
    ELSE 'hot' END AS place FROM feed""",
    "archive_with_ingest": f"""WITH {FEED}
SELECT transaction_id, ts, CASE
    WHEN ts < TIMESTAMP '2024-01-09 21:00:00' AND CAST(transaction_id AS BIGINT) % 50 <> 0 THEN '2024-01-10'
    WHEN ts < TIMESTAMP '2024-01-19 21:00:00' THEN '2024-01-20'
    ELSE 'hot' END AS place FROM feed""",
    "retain_by_size": f"""WITH {FEED},
sized AS (
  SELECT transaction_id, ts, CAST(64 + strlen(transaction_id) + strlen(transaction_timestamp) + strlen(status) AS BIGINT)
         AS row_bytes FROM feed),
running AS (
  SELECT *, SUM(row_bytes) OVER (ORDER BY ts DESC, transaction_id ROWS UNBOUNDED PRECEDING) AS upto,
         SUM(row_bytes) OVER () AS everything FROM sized)
SELECT transaction_id, ts, row_bytes, upto <= everything // 2000 AS tight FROM running WHERE upto <= everything // 7""",
    "archive_manifest": f"""WITH {FEED},
run AS (SELECT MAX(ts) AS as_of FROM feed)
SELECT CAST(floor(epoch(MAX(as_of))) AS BIGINT) AS batch_id, MAX(as_of) - INTERVAL 3 HOURS AS cutoff,
  MIN(ts) AS min_ts, MAX(ts) AS max_ts, COUNT(*) AS "rows",
  COUNT(*) FILTER (ts >= as_of - INTERVAL 3 HOURS) AS kept, COUNT(*) FILTER (ts < as_of - INTERVAL 3 HOURS) AS expired
FROM feed, run""",
    "clean_valid": f"""WITH {FAULTY},
valid AS (
  SELECT * REPLACE (try_strptime(transaction_timestamp, '%Y-%m-%d %H:%M:%S') AS ts) FROM (
    SELECT *, CAST(NULL AS TIMESTAMP) AS ts FROM checked WHERE reasons = ''))
SELECT transaction_id, customer_id, merchant_id, device_id, payment_method_id, transaction_timestamp,
  transaction_amount, processing_time, fraud_score, status, ts, CAST(ts AS DATE) AS txn_date FROM valid""",
    "quarantine": f"""WITH {FAULTY}
SELECT transaction_id, customer_id, transaction_timestamp, transaction_amount, reasons
FROM checked WHERE reasons <> ''""",
    "ri_orphans": f"WITH {FAULTY}, {DIMS}\n"
    + "\nUNION ALL\n".join(
        orphans(key, dim)
        for key, dim in (
            ("customer_id", "customers"),
            ("merchant_id", "merchants"),
            ("device_id", "devices"),
            ("payment_method_id", "methods"),
        )
    ),
    "label_consistency": f"""WITH {FEED},
banded AS (
  SELECT CASE WHEN e % 71 = 0 THEN 'Pending' WHEN e % 73 = 0 THEN NULL ELSE status END AS status,
    {band("transaction_amount", (10, 500), (5000, 20000))} AS amount_band,
    {band("processing_time", (50, 200), (1000, 3000))} AS latency_band,
    {band("fraud_score", (0, 0.2), (0.8, 1.0))} AS score_band FROM (SELECT *, CAST(transaction_id AS BIGINT) AS e FROM feed))
SELECT * EXCLUDE (wanted), COALESCE(amount_band = wanted AND latency_band = wanted AND score_band = wanted, FALSE) AS agrees FROM (
  SELECT status, amount_band, latency_band, score_band, COUNT(*) AS transactions FROM banded GROUP BY ALL)
LEFT JOIN (VALUES ('Fraud', 'fraud'), ('Success', 'normal')) w(status, wanted) USING (status)""",
    "column_profile": f"WITH {FAULTY}\n"
    + "\nUNION ALL\n".join(
        profile(column, numeric)
        for column, numeric in (
            ("transaction_id", False),
            ("customer_id", True),
            ("merchant_id", True),
            ("device_id", True),
            ("payment_method_id", True),
            ("transaction_timestamp", False),
            ("transaction_amount", True),
            ("processing_time", True),
            ("fraud_score", True),
            ("status", False),
        )
    ),
    "dim_upsert": f"""WITH {DIMS},
spend AS (
  SELECT o_custkey AS customer_id, CASE WHEN o_orderstatus <> 'P' THEN o_totalprice END AS spend FROM orders
  QUALIFY row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderkey DESC) = 1),
segments AS (
  SELECT user_id AS customer_id, CASE WHEN event_type = 'signup' THEN 'New' ELSE 'Risky' END AS segment FROM events
  WHERE event_type IN ('signup', 'error')
  QUALIFY row_number() OVER (PARTITION BY user_id ORDER BY event_id DESC) = 1)
SELECT c.customer_id, name, CASE WHEN s.customer_id IS NULL THEN customer_segment ELSE segment END AS customer_segment,
  CASE WHEN p.customer_id IS NULL THEN total_lifetime_spend ELSE spend END AS total_lifetime_spend
FROM customers c LEFT JOIN spend p USING (customer_id) LEFT JOIN segments s ON s.customer_id = c.customer_id
UNION ALL
SELECT -s_suppkey - 1, s_name, 'Occasional', s_acctbal FROM supplier""",
    "datetime_dim": f"""WITH {FEED}
SELECT date_trunc('hour', ts) AS hour_start, CAST(MIN(ts) AS DATE) AS txn_date, CAST(hour(MIN(ts)) AS INTEGER) AS "hour",
  strftime(MIN(ts), '%a') AS day_of_week, isodow(MIN(ts)) >= 6 AS is_weekend, COUNT(*) AS transactions,
  {total()} AS total_volume
FROM feed GROUP BY 1""",
    "kpi_refresh": every_kpi(AMOUNTS, "merchant", "customer", "payment"),
    "kpi_refresh_incremental": every_kpi(AMOUNTS, "merchant", "customer", "payment", "device", fact="feed"),
    "serving_roundtrip": every_kpi(AMOUNTS, "merchant", "customer", "payment"),
    "chart_series": f"""WITH {SALES}, {DIMS}
SELECT 'Daily Transaction Volume' AS title, CAST(txn_date AS VARCHAR) AS x, CAST(COUNT(*) AS DOUBLE) AS y
FROM sales GROUP BY txn_date
UNION ALL SELECT 'Daily Revenue Trend', CAST(txn_date AS VARCHAR), {total()} FROM sales GROUP BY txn_date
UNION ALL SELECT 'Revenue by Merchant Category', business_category, {total()}
FROM sales JOIN merchants USING (merchant_id) GROUP BY business_category
UNION ALL SELECT 'Spending by Customer Segment', customer_segment, {total()}
FROM sales JOIN customers USING (customer_id) GROUP BY customer_segment
UNION ALL SELECT 'Payment Method Share', method_type, {total()}
FROM sales JOIN methods USING (payment_method_id) GROUP BY method_type""",
    "overview_cards": f"""WITH {SALES},
daily AS (
  SELECT txn_date, COUNT(*) AS n, COUNT(transaction_amount) AS priced,
         SUM(CAST(transaction_amount AS DECIMAL(18,6))) AS volume, {mean()} AS avg_value FROM sales GROUP BY txn_date)
SELECT CAST(SUM(n) AS BIGINT) AS total_transactions, CAST(SUM(volume) AS DOUBLE) AS total_revenue,
  CAST(trunc(AVG(avg_value)) AS INTEGER) AS avg_of_daily_avg, CAST(SUM(volume) AS DOUBLE) / SUM(priced) AS avg_value,
  format('{{:,}}', CAST(SUM(n) AS BIGINT)) AS transactions_text,
  printf('%.2f B', CAST(SUM(volume) AS DOUBLE) / 1e9) AS revenue_text
FROM daily""",
    "payment_share": f"""WITH {SALES}, {DIMS},
volumes AS (
  SELECT method_type, SUM(CAST(transaction_amount AS DECIMAL(18,6))) AS volume
  FROM sales JOIN methods USING (payment_method_id) GROUP BY method_type)
SELECT method_type, CAST(volume AS DOUBLE) AS total_volume,
  CAST(volume AS DOUBLE) / CAST(SUM(volume) OVER () AS DOUBLE) AS share FROM volumes""",
    "latest_kpi_run": f"""WITH {FEED}
SELECT time_bucket(INTERVAL 3 HOURS, MAX(ts)) + INTERVAL 3 HOURS AS run_ts, COUNT(*) AS total_transactions,
  {total()} AS total_volume, {mean()} AS avg_transaction_value FROM feed""",
    "run_cards": f"""WITH {FEED}
SELECT format('{{:,}}', COUNT(*)) AS transactions_text, format('{{:,.2f}}', {total()}) AS revenue_text,
  printf('%.2f', {mean()}) AS average_text FROM feed""",
    "live_count_hot": f"""WITH {FEED}
SELECT COUNT(*) AS live_transactions FROM feed WHERE ts >= {AS_OF} - INTERVAL 3 HOURS""",
    "live_count_60s": f"""WITH {FEED}
SELECT COUNT(*) AS live_transactions FROM feed WHERE ts >= {AS_OF} - INTERVAL 60 SECONDS""",
    "stream_ingest": f"WITH {FEED}\nSELECT {FEED_COLUMNS} FROM feed",
    "stream_dedup": f"WITH {FEED}\nSELECT transaction_id, ts, transaction_amount, status FROM feed",
    # Windows the watermark has closed.
    "stream_tpm": f"""WITH {FEED}
SELECT * FROM (
  SELECT date_trunc('minute', ts) AS window_start, date_trunc('minute', ts) + INTERVAL 1 MINUTE AS window_end,
         COUNT(*) AS transactions FROM feed GROUP BY 1, 2) WHERE {CLOSED}""",
    "stream_sliding": f"""WITH {FEED}
SELECT * FROM (
  SELECT start AS window_start, start + INTERVAL 60 SECONDS AS window_end, COUNT(*) AS transactions
  FROM (SELECT time_bucket(INTERVAL 10 SECONDS, ts) - o * INTERVAL 10 SECONDS AS start FROM feed, range(6) r(o))
  GROUP BY start) WHERE {CLOSED}""",
    "stream_fraud": f"""WITH {FEED}
SELECT * FROM (
  SELECT date_trunc('hour', ts) AS window_start, date_trunc('hour', ts) + INTERVAL 1 HOUR AS window_end, {FRAUD},
         {mean("processing_time")} AS avg_latency FROM feed GROUP BY 1, 2) WHERE {CLOSED}""",
    "stream_kpi_segment": f"""WITH {FEED}, {DIMS}
SELECT customer_segment, COUNT(*) AS transactions, {total()} AS total_spend, {mean()} AS avg_spend
FROM feed JOIN customers USING (customer_id) GROUP BY customer_segment""",
    "stream_enriched": f"""WITH {FEED}, {DIMS}
SELECT transaction_id, ts, transaction_amount, business_category, customer_segment, method_type, device_type
FROM feed LEFT JOIN merchants USING (merchant_id) LEFT JOIN customers USING (customer_id)
  LEFT JOIN methods USING (payment_method_id) LEFT JOIN devices USING (device_id)""",
}

ORACLE["stream_kpi_all"] = ORACLE["kpi_refresh_incremental"]

ORACLE["serving_order"] = f"""SELECT 'kpi:' || kpi AS "key", dim_value AS label, transactions,
  CAST(row_number() OVER (PARTITION BY kpi ORDER BY CASE WHEN kpi <> 'daily' THEN -total END, dim_value) - 1 AS INTEGER) AS "position"
FROM ({every_kpi(AMOUNTS, "merchant", "customer", "payment")})"""

ORACLE["kpi_sql_views"] = f"""WITH {FEED}, {DIMS}
SELECT customer_segment, status, COUNT(*) AS transactions, MAX(transaction_amount) AS largest,
  COUNT(DISTINCT merchant_id) AS merchants
FROM feed JOIN customers USING (customer_id) GROUP BY ALL"""

ORACLE["kpi_table_text_days"] = ORACLE["kpi_daily"]

ORACLE["merchant_tenure"] = """SELECT s_suppkey AS merchant_id, day AS registration_date,
  CAST(DATE '2024-01-01' - day AS INTEGER) AS tenure_days, round(s_acctbal / 7, 2) AS avg_dispute_rate
FROM (SELECT *, CASE WHEN s_suppkey % 17 = 0 OR s_suppkey % 19 = 0 THEN NULL
                     ELSE DATE '2020-01-01' + CAST(s_suppkey % 1000 AS INTEGER) END AS day FROM supplier)"""

ORACLE["feed_try_cast"] = f"""WITH {FEED}
SELECT transaction_id, CASE WHEN e % 59 <> 0 THEN customer_id END AS customer_id,
  CASE WHEN e % 61 <> 0 THEN transaction_amount END AS transaction_amount,
  CASE WHEN e % 67 <> 0 THEN processing_time END AS processing_time, fraud_score
FROM (SELECT *, CAST(transaction_id AS BIGINT) AS e FROM feed)"""

ORACLE["latest_stored_run"] = f"""WITH {FEED}
SELECT CAST(2 AS BIGINT) AS run, TIMESTAMP '2024-01-20' AS run_at, {AMOUNTS} FROM feed WHERE ts < TIMESTAMP '2024-01-20'"""

ORACLE["stream_windows_corrected"] = f"""WITH {FEED}
SELECT date_trunc('minute', ts) AS window_start, date_trunc('minute', ts) + INTERVAL 1 MINUTE AS window_end,
  COUNT(*) AS transactions FROM feed GROUP BY 1, 2"""

ORACLE["stream_fraud_spikes"] = f"""SELECT * FROM ({ORACLE["kpi_fraud_spikes"]})
WHERE "hour" + INTERVAL 1 HOUR <= (SELECT MAX(ts) FROM events) - INTERVAL 10 MINUTES"""

ORACLE["kpi_latency_sketched"] = f"""WITH {FEED}
SELECT txn_date, COUNT(*) AS transactions, {mean("processing_time")} AS avg_latency, TRUE AS p50_within, TRUE AS p95_within
FROM feed GROUP BY txn_date"""

ORACLE["kpi_by_segment_then"] = f"""WITH {FEED},
change AS (
  SELECT user_id AS customer_id, ts AS since, CASE WHEN event_type = 'signup' THEN 'New' ELSE 'Risky' END AS customer_segment
  FROM events WHERE event_type IN ('signup', 'error')
  QUALIFY row_number() OVER (PARTITION BY user_id, ts ORDER BY event_id DESC) = 1)
SELECT customer_segment, COUNT(*) AS transactions, {total()} AS total_spend, {mean()} AS avg_spend
FROM feed ASOF LEFT JOIN change ON feed.customer_id = change.customer_id AND feed.ts >= change.since
GROUP BY customer_segment"""

ORACLE["tables_with_rows"] = f"""WITH {FEED}, {DIMS}
SELECT part, "rows" > 0 AS has_rows, "rows" FROM (
  SELECT 'transactions' AS part, COUNT(*) AS "rows" FROM feed
  UNION ALL SELECT 'customers', COUNT(*) FROM customers
  UNION ALL SELECT 'merchants', COUNT(*) FROM merchants
  UNION ALL SELECT 'refused', COUNT(*) FROM feed WHERE status = 'Refused')"""
