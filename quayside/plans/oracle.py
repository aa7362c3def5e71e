"""Independent DuckDB SQL for every registered query (the correctness gate).

Written by hand as plain SQL over the pre-registered test-table views; it
shares no code with the Spark operators, only the run parameters. Money is
computed as DECIMAL(18,9) and cast to DOUBLE at the end, like the Spark
side.
"""

from __future__ import annotations

AS_OF = "DATE '2024-01-30'"
NOW = "TIMESTAMP '2024-01-31 00:00:00'"
EMPTY_DAY = "DATE '2024-02-29'"

def ratio9(num: str, den: str) -> str:
    """Exact ``num / den`` rounded half away from zero to 9 decimals, as
    DECIMAL(38,9) (integer arithmetic; DuckDB's decimal division is double)."""
    n = f"CAST(({num}) * 1000000000 AS HUGEINT)"
    d = f"CAST(({den}) AS HUGEINT)"
    q = f"sign({n}) * ((2 * abs({n}) + {d}) // nullif(2 * {d}, 0))"
    return f"(CAST({q} AS DECIMAL(38,0)) * CAST(0.000000001 AS DECIMAL(18,9)))"


def avg9(x: str) -> str:
    """Exact average of a decimal, rounded half away from zero to 9 decimals."""
    return ratio9(f"sum({x})", f"count({x})")


# The transaction adapter (see quayside.sources.testdata) plus the send time.
RAW = """
raw AS (
  SELECT
    e.event_id,
    e.ts AS sent_at,
    printf('txn_%012d', e.event_id) AS transaction_id,
    printf('cust_%05d', e.user_id) AS customer_id,
    c.c_name || ' v' || CAST(e.event_id % 3 AS VARCHAR) AS customer_name,
    c.c_name || '@example.com' AS customer_email,
    n.n_name AS customer_country,
    CAST(round(CAST(e.value AS DECIMAL(18,2)) *
      CASE e.user_id % 4 WHEN 0 THEN 0.10 WHEN 1 THEN 1.00 WHEN 2 THEN 10.00 ELSE 100.00 END, 2) AS DOUBLE) AS amount,
    'USD' AS currency,
    CASE WHEN e.event_type IN ('view', 'click', 'purchase') THEN 'success'
         WHEN e.event_type = 'error' THEN 'failed'
         WHEN e.event_type = 'signup' AND e.event_id % 3 = 0 THEN 'refunded'
         WHEN e.event_type = 'signup' THEN 'pending' END AS status,
    p.p_type AS product_category,
    p.p_name AS product_name,
    CAST(e.event_id % 10 + 1 AS INTEGER) AS quantity,
    strftime(e.ts, '%Y-%m-%dT%H:%M:%S.%f+00:00') AS "timestamp",
    CAST(e.ts AS TIMESTAMP) AS event_ts,
    '10.0.' || CAST(e.user_id % 256 AS VARCHAR) || '.' || CAST(e.event_id % 256 AS VARCHAR) AS ip_address,
    CASE e.event_id % 3 WHEN 0 THEN 'mobile' WHEN 1 THEN 'desktop' ELSE 'tablet' END AS device_type,
    CASE e.user_id % 4 + e.event_id % 2 WHEN 0 THEN 'credit_card' WHEN 1 THEN 'debit_card'
         WHEN 2 THEN 'paypal' ELSE 'bank_transfer' END AS payment_method
  FROM events e
  JOIN customer c ON e.user_id = c.c_custkey
  JOIN nation n ON c.c_nationkey = n.n_nationkey
  LEFT JOIN part p ON p.p_partkey = e.event_id % (SELECT nullif(count(*), 0) FROM part)
)"""

# Messages with defects, parsed back (what from_json + the rules yield).
PARSED = """
wire AS (
  SELECT r.*,
    CASE WHEN event_id % 97 = 1 THEN 'null_id'
         WHEN event_id % 83 = 3 THEN 'unparsable'
         WHEN event_id % 89 = 2 THEN 'negated_amount'
         WHEN event_id % 71 = 6 THEN 'garbage_timestamp'
         WHEN event_id % 79 = 4 THEN 'amount_too_large'
         WHEN event_id % 73 = 5 THEN 'padded_status'
         ELSE 'clean' END AS defect
  FROM raw r
),
parsed0 AS (
  SELECT
    event_id, sent_at, defect,
    CASE WHEN defect IN ('null_id', 'unparsable') THEN NULL ELSE transaction_id END AS transaction_id,
    CASE WHEN defect = 'unparsable' THEN NULL ELSE customer_id END AS customer_id,
    CASE WHEN defect = 'unparsable' THEN NULL ELSE customer_name END AS customer_name,
    CASE WHEN defect = 'unparsable' THEN NULL ELSE customer_email END AS customer_email,
    CASE WHEN defect = 'unparsable' THEN NULL ELSE customer_country END AS customer_country,
    CASE defect WHEN 'unparsable' THEN NULL WHEN 'negated_amount' THEN -amount
                WHEN 'amount_too_large' THEN 2000000.0 ELSE amount END AS amount,
    CASE WHEN defect = 'unparsable' THEN NULL ELSE currency END AS currency,
    CASE defect WHEN 'unparsable' THEN NULL WHEN 'padded_status' THEN ' Success ' ELSE status END AS status,
    CASE WHEN defect = 'unparsable' THEN NULL ELSE product_category END AS product_category,
    CASE WHEN defect = 'unparsable' THEN NULL ELSE product_name END AS product_name,
    CASE WHEN defect = 'unparsable' THEN NULL ELSE quantity END AS quantity,
    CASE defect WHEN 'unparsable' THEN NULL WHEN 'garbage_timestamp' THEN 'garbage' ELSE "timestamp" END AS "timestamp",
    CASE WHEN defect = 'unparsable' THEN NULL ELSE ip_address END AS ip_address,
    CASE WHEN defect = 'unparsable' THEN NULL ELSE device_type END AS device_type,
    CASE WHEN defect = 'unparsable' THEN NULL ELSE payment_method END AS payment_method,
    CASE WHEN defect IN ('unparsable', 'garbage_timestamp') THEN NULL ELSE event_ts END AS event_ts
  FROM wire
),
parsed AS (
  SELECT *,
    CAST(year(event_ts) AS INTEGER) AS year,
    CAST(month(event_ts) AS INTEGER) AS month,
    CAST(day(event_ts) AS INTEGER) AS day,
    CAST(hour(event_ts) AS INTEGER) AS hour,
    CASE WHEN transaction_id IS NULL THEN 'missing_transaction_id'
         WHEN amount IS NULL OR amount <= 0 THEN 'invalid_amount' END AS dlq_reason
  FROM parsed0
),
valid AS (SELECT * FROM parsed WHERE dlq_reason IS NULL)"""

EVENT_COLS = (
    "transaction_id, customer_id, customer_name, customer_email, customer_country, amount, currency, "
    'status, product_category, product_name, quantity, "timestamp", ip_address, device_type, payment_method'
)
LAKE_COLS = EVENT_COLS + ", event_ts AS event_timestamp, year, month, day, hour"


def stg_cte(name: str, source: str) -> str:
    return f"""
{name} AS (
  SELECT
    transaction_id,
    customer_id,
    lower(trim(customer_name)) AS customer_name,
    lower(trim(customer_email)) AS customer_email,
    upper(trim(customer_country)) AS customer_country,
    CAST(amount AS DECIMAL(18,9)) AS amount,
    upper(trim(currency)) AS currency,
    lower(trim(status)) AS status,
    lower(trim(product_category)) AS product_category,
    trim(product_name) AS product_name,
    quantity,
    event_ts AS event_timestamp,
    ip_address,
    lower(trim(device_type)) AS device_type,
    lower(trim(payment_method)) AS payment_method,
    CAST(event_ts AS DATE) AS transaction_date,
    CAST(hour(event_ts) AS INTEGER) AS transaction_hour
  FROM {source}
  WHERE transaction_id IS NOT NULL
    AND customer_id IS NOT NULL
    AND amount > 0
    AND amount < 1000000
    AND status IN ('success', 'failed', 'pending', 'refunded')
)"""


def dim_cte(name: str, stg: str, now: str = NOW, where: str = "TRUE") -> str:
    return f"""
{name}_m AS (
  SELECT
    customer_id,
    arg_max(customer_name, {{'t': event_timestamp, 'i': transaction_id}}) FILTER (WHERE customer_name IS NOT NULL) AS customer_name,
    arg_max(customer_email, {{'t': event_timestamp, 'i': transaction_id}}) FILTER (WHERE customer_email IS NOT NULL) AS customer_email,
    arg_max(customer_country, {{'t': event_timestamp, 'i': transaction_id}}) FILTER (WHERE customer_country IS NOT NULL) AS customer_country,
    count(DISTINCT transaction_id) AS total_transactions,
    sum(CASE WHEN status = 'success' THEN amount ELSE 0 END) AS spend,
    {avg9("CASE WHEN status = 'success' THEN amount END")} AS avg_value,
    count(DISTINCT transaction_date) AS active_days,
    min(event_timestamp) AS first_seen_at,
    max(event_timestamp) AS last_seen_at,
    count(DISTINCT product_category) AS categories_purchased,
    count(*) FILTER (WHERE status = 'failed') AS failed_transactions,
    count(*) AS n_rows
  FROM {stg}
  WHERE {where}
  GROUP BY customer_id
),
{name} AS (
  SELECT
    customer_id, customer_name, customer_email, customer_country, total_transactions,
    round(spend, 2) AS total_spend,
    round(avg_value, 2) AS avg_transaction_value,
    active_days, first_seen_at, last_seen_at, categories_purchased, failed_transactions,
    round(failed_transactions / n_rows * 100, 2) AS failure_rate_pct,
    CASE WHEN spend >= 10000 THEN 'VIP' WHEN spend >= 1000 THEN 'Regular' ELSE 'Casual' END AS customer_segment,
    {now} AS loaded_at
  FROM {name}_m
)"""


def fct_cte(name: str, stg: str, dim: str) -> str:
    return f"""
{name} AS (
  SELECT
    t.transaction_id, t.customer_id,
    d.customer_name, d.customer_email, d.customer_country, d.customer_segment,
    t.amount, t.currency, t.status, t.product_category, t.product_name, t.quantity,
    round(t.amount * t.quantity, 2) AS total_line_value,
    t.device_type, t.payment_method, t.ip_address,
    t.transaction_date, t.transaction_hour, t.event_timestamp,
    coalesce(t.amount > 10000, false) AS is_high_value,
    coalesce(t.status = 'failed' AND d.failure_rate_pct > 20, false) AS is_potential_fraud,
    {NOW} AS loaded_at
  FROM {stg} t
  LEFT JOIN {dim} d ON t.customer_id = d.customer_id
)"""


def daily_cte(name: str, fct: str) -> str:
    return f"""
{name} AS (
  SELECT
    transaction_date,
    product_category,
    count(*) AS order_count,
    count(CASE WHEN status = 'success' THEN 1 END) AS successful_orders,
    count(CASE WHEN status = 'failed' THEN 1 END) AS failed_orders,
    count(CASE WHEN status = 'refunded' THEN 1 END) AS refunded_orders,
    count(CASE WHEN status = 'pending' THEN 1 END) AS pending_orders,
    count(CASE WHEN is_high_value THEN 1 END) AS high_value_orders,
    round(sum(amount), 2) AS total_revenue,
    round(sum(CASE WHEN status = 'success' THEN amount ELSE 0 END), 2) AS successful_revenue,
    round({avg9('amount')}, 2) AS avg_order_value,
    CAST(sum(quantity) AS BIGINT) AS total_quantity_sold,
    round(count(CASE WHEN status = 'failed' THEN 1 END) / count(*) * 100, 2) AS failure_rate_pct,
    {NOW} AS loaded_at
  FROM {fct}
  GROUP BY transaction_date, product_category
)"""


MARTS = ",".join([RAW, stg_cte("stg", "raw"), dim_cte("dim", "stg"), fct_cte("fct", "stg", "dim"), daily_cte("daily", "fct")])
STREAM = ",".join([RAW, PARSED])


def w(ctes: str, body: str) -> str:
    return f"WITH {ctes}\n{body}"


STG_OUT = """
SELECT transaction_id, customer_id, customer_name, customer_email, customer_country,
  CAST(amount AS DOUBLE) AS amount, currency, status, product_category, product_name, quantity,
  event_timestamp, ip_address, device_type, payment_method, transaction_date, transaction_hour
FROM {src}"""

DIM_OUT = """
SELECT customer_id, customer_name, customer_email, customer_country, total_transactions,
  CAST(total_spend AS DOUBLE) AS total_spend, CAST(avg_transaction_value AS DOUBLE) AS avg_transaction_value,
  active_days, first_seen_at, last_seen_at, categories_purchased, failed_transactions,
  failure_rate_pct, customer_segment, loaded_at
FROM {src}"""


def _dq(stg: str, dim: str, fct: str, daily: str) -> str:
    def nn(t: str, tn: str, c: str) -> str:
        return f"SELECT '{tn}' AS \"table\", 'not_null' AS test, '{c}' AS \"column\", count(*) AS failures FROM {t} WHERE {c} IS NULL"

    def uq(t: str, tn: str, c: str) -> str:
        return (
            f"SELECT '{tn}' AS \"table\", 'unique' AS test, '{c}' AS \"column\", count(*) AS failures FROM "
            f"(SELECT {c} FROM {t} WHERE {c} IS NOT NULL GROUP BY {c} HAVING count(*) > 1)"
        )

    def av(t: str, tn: str, c: str, values: str) -> str:
        return (
            f"SELECT '{tn}' AS \"table\", 'accepted_values' AS test, '{c}' AS \"column\", count(*) AS failures FROM "
            f"(SELECT {c} FROM {t} GROUP BY {c} HAVING {c} NOT IN ({values}))"
        )

    parts = [
        uq(stg, "stg_transactions", "transaction_id"),
        nn(stg, "stg_transactions", "transaction_id"),
        nn(stg, "stg_transactions", "customer_id"),
        nn(stg, "stg_transactions", "amount"),
        av(stg, "stg_transactions", "status", "'success', 'failed', 'pending', 'refunded'"),
        nn(stg, "stg_transactions", "transaction_date"),
        uq(dim, "dim_customers", "customer_id"),
        nn(dim, "dim_customers", "customer_id"),
        nn(dim, "dim_customers", "total_spend"),
        av(dim, "dim_customers", "customer_segment", "'VIP', 'Regular', 'Casual'"),
        uq(fct, "fct_transactions", "transaction_id"),
        nn(fct, "fct_transactions", "transaction_id"),
        nn(fct, "fct_transactions", "amount"),
        nn(fct, "fct_transactions", "customer_id"),
        nn(daily, "fct_daily_revenue", "transaction_date"),
        nn(daily, "fct_daily_revenue", "product_category"),
        nn(daily, "fct_daily_revenue", "total_revenue"),
        nn(daily, "fct_daily_revenue", "order_count"),
        nn(daily, "fct_daily_revenue", "failure_rate_pct"),
    ]
    return "\nUNION ALL\n".join(parts)


BROKEN = ",".join(
    [
        RAW,
        stg_cte("clean", "raw"),
        """
stg AS (
  SELECT * REPLACE (CASE WHEN status = 'pending' THEN 'held' ELSE status END AS status) FROM clean
  UNION ALL SELECT * FROM clean WHERE status = 'failed'
)""",
        dim_cte("built", "stg"),
        fct_cte("fct", "stg", "built"),
        daily_cte("daily", "fct"),
        """
dim AS (
  SELECT * REPLACE (CASE WHEN customer_segment = 'VIP' THEN 'Gold' ELSE customer_segment END AS customer_segment,
                    CASE WHEN customer_segment <> 'Casual' THEN total_spend END AS total_spend) FROM built
)""",
    ]
)

# Snapshot runs: load times and what each run sees (FIXTURES.md section 5).
CUTS = [f"TIMESTAMP '{day} 00:00:00'" for day in ("2024-01-10", "2024-01-20", "2024-01-31", "2024-02-01")]
SEEN_LATER = f"""customer_country >= 'NATION_1' AND ((customer_country < 'NATION_2' AND event_timestamp < {CUTS[0]})
    OR (customer_country >= 'NATION_2' AND event_timestamp < {CUTS[1]}))"""
SEEN = [f"customer_country < 'NATION_3' AND event_timestamp < {CUTS[0]}", SEEN_LATER, SEEN_LATER, "TRUE"]
SNAP = ",".join(
    [RAW, stg_cte("stg", "raw")]
    + [dim_cte(f"d{i + 1}", "stg", now=cut, where=seen) for i, (cut, seen) in enumerate(zip(CUTS, SEEN))]
)
DIM_COLS = (
    "customer_id, customer_name, customer_email, customer_country, total_transactions, total_spend, "
    "avg_transaction_value, active_days, first_seen_at, last_seen_at, categories_purchased, failed_transactions, "
    "failure_rate_pct, customer_segment, loaded_at"
)


def _changed(new: str, old: str) -> str:
    cols = ["customer_segment", "total_spend", "total_transactions", "failure_rate_pct"]
    same = " AND ".join(f"{new}.{c} IS NOT DISTINCT FROM {old}.{c}" for c in cols)
    return f"({old}.customer_id IS NULL OR NOT ({same}))"


HISTORY_OUT = """
SELECT customer_id, customer_name, customer_email, customer_country, total_transactions,
  CAST(total_spend AS DOUBLE) AS total_spend, CAST(avg_transaction_value AS DOUBLE) AS avg_transaction_value,
  active_days, first_seen_at, last_seen_at, categories_purchased, failed_transactions,
  failure_rate_pct, customer_segment, loaded_at,
  md5(customer_id || '|' || strftime(now_ts, '%Y-%m-%d %H:%M:%S.%f')) AS scd_id,
  now_ts AS valid_from,
  lead(now_ts) OVER (PARTITION BY customer_id ORDER BY run) AS valid_to
FROM versions"""

# A customer that a run does not see keeps its open version: the last run compares with the last version seen.
LAST_SEEN = """
, seen AS (SELECT * FROM d3 UNION ALL SELECT d1.* FROM d1 LEFT JOIN d3 ON d1.customer_id = d3.customer_id WHERE d3.customer_id IS NULL)"""

SCD2_HISTORY = w(
    SNAP,
    f"""
{LAST_SEEN}
, versions AS (
  SELECT 1 AS run, {CUTS[0]} AS now_ts, d1.* FROM d1
  UNION ALL
  SELECT 2, {CUTS[1]}, d2.* FROM d2 LEFT JOIN d1 ON d2.customer_id = d1.customer_id WHERE {_changed("d2", "d1")}
  UNION ALL
  SELECT 3, {CUTS[2]}, d3.* FROM d3 LEFT JOIN d2 ON d3.customer_id = d2.customer_id WHERE {_changed("d3", "d2")}
  UNION ALL
  SELECT 4, {CUTS[3]}, d4.* FROM d4 LEFT JOIN seen ON d4.customer_id = seen.customer_id WHERE {_changed("d4", "seen")}
)
{HISTORY_OUT}""",
)

BATCH_CUT = "TIMESTAMP '2024-01-16 00:00:00'"
BATCH_HISTORY = w(
    ",".join([RAW, stg_cte("stg", "raw"), dim_cte("d1", "stg", now=BATCH_CUT, where=f"event_timestamp < {BATCH_CUT}"), dim_cte("d2", "stg")]),
    f"""
, versions AS (
  SELECT 1 AS run, {BATCH_CUT} AS now_ts, d1.* FROM d1
  UNION ALL
  SELECT 2, {NOW}, d2.* FROM d2 LEFT JOIN d1 ON d2.customer_id = d1.customer_id WHERE {_changed("d2", "d1")}
)
{HISTORY_OUT}""",
)


def _change_types(new: str, old: str, run: int) -> str:
    return f"""
SELECT coalesce({new}.customer_id, {old}.customer_id) AS customer_id,
  CASE WHEN {old}.customer_id IS NULL THEN 'insert'
       WHEN {new}.customer_id IS NULL THEN 'absent'
       WHEN {_changed(new, old)} THEN 'change'
       ELSE 'same' END AS change_type,
  {run} AS run
FROM {old} FULL OUTER JOIN {new} ON {old}.customer_id = {new}.customer_id"""


SCD2_CHANGES = w(SNAP, f"{LAST_SEEN}{_change_types('d2', 'd1', 2)} UNION ALL {_change_types('d4', 'seen', 4)}")

CONTRACT = w(
    STREAM,
    r""",
msg AS (
  SELECT p.*,
    CASE WHEN defect = 'unparsable' THEN 'not json: ' || r.transaction_id
         ELSE to_json({'transaction_id': p.transaction_id, 'customer_id': p.customer_id,
           'customer_name': p.customer_name, 'customer_email': p.customer_email,
           'customer_country': p.customer_country, 'amount': p.amount, 'currency': p.currency,
           'status': p.status, 'product_category': p.product_category, 'product_name': p.product_name,
           'quantity': p.quantity, 'timestamp': p."timestamp", 'ip_address': p.ip_address,
           'device_type': p.device_type, 'payment_method': p.payment_method})::VARCHAR END AS raw_value
  FROM parsed p JOIN raw r ON p.event_id = r.event_id
),
msgj AS (SELECT *, CASE WHEN json_valid(raw_value) THEN raw_value END AS j FROM msg),
flags AS (
  SELECT
    count(*) FILTER (WHERE j IS NULL OR json_type(j) <> 'OBJECT') AS type_object,
    count(*) FILTER (WHERE json_type(j) = 'OBJECT' AND len(list_filter(json_keys(CASE WHEN json_type(j) = 'OBJECT' THEN j ELSE '{}' END),
      lambda k: k NOT IN ('transaction_id', 'customer_id', 'customer_name', 'customer_email', 'customer_country', 'amount',
      'currency', 'status', 'product_category', 'product_name', 'quantity', 'timestamp', 'ip_address',
      'device_type', 'payment_method'))) > 0) AS additional_properties,
    count(*) FILTER (WHERE transaction_id IS NULL) AS rq_transaction_id,
    count(*) FILTER (WHERE customer_id IS NULL) AS rq_customer_id,
    count(*) FILTER (WHERE customer_name IS NULL) AS rq_customer_name,
    count(*) FILTER (WHERE customer_email IS NULL) AS rq_customer_email,
    count(*) FILTER (WHERE customer_country IS NULL) AS rq_customer_country,
    count(*) FILTER (WHERE amount IS NULL) AS rq_amount,
    count(*) FILTER (WHERE currency IS NULL) AS rq_currency,
    count(*) FILTER (WHERE status IS NULL) AS rq_status,
    count(*) FILTER (WHERE product_category IS NULL) AS rq_product_category,
    count(*) FILTER (WHERE product_name IS NULL) AS rq_product_name,
    count(*) FILTER (WHERE quantity IS NULL) AS rq_quantity,
    count(*) FILTER (WHERE "timestamp" IS NULL) AS rq_timestamp,
    count(*) FILTER (WHERE ip_address IS NULL) AS rq_ip_address,
    count(*) FILTER (WHERE device_type IS NULL) AS rq_device_type,
    count(*) FILTER (WHERE payment_method IS NULL) AS rq_payment_method,
    count(*) FILTER (WHERE NOT regexp_matches(transaction_id, '^txn_[0-9a-f]{12}$')) AS p_transaction_id,
    count(*) FILTER (WHERE NOT regexp_matches(customer_id, '^cust_[0-9]{5}$')) AS p_customer_id,
    count(*) FILTER (WHERE length(customer_name) < 1) AS ml_customer_name,
    count(*) FILTER (WHERE NOT regexp_matches(customer_email, '^[^@\s]+@[^@\s]+\.[^@\s]+$')) AS f_email,
    count(*) FILTER (WHERE NOT regexp_matches(customer_country, '^[A-Z]{2}$')) AS p_country,
    count(*) FILTER (WHERE amount <= 0) AS amount_min,
    count(*) FILTER (WHERE amount > 50000) AS amount_max,
    count(*) FILTER (WHERE currency <> 'USD') AS currency_const,
    count(*) FILTER (WHERE status NOT IN ('success', 'failed', 'pending', 'refunded')) AS status_enum,
    count(*) FILTER (WHERE product_category NOT IN ('electronics', 'clothing', 'food', 'books', 'sports', 'home',
      'beauty', 'toys', 'automotive', 'jewelry')) AS category_enum,
    count(*) FILTER (WHERE length(product_name) < 1) AS ml_product_name,
    count(*) FILTER (WHERE quantity < 1) AS quantity_min,
    count(*) FILTER (WHERE quantity > 10) AS quantity_max,
    count(*) FILTER (WHERE NOT regexp_matches("timestamp",
      '^[0-9]{4}-[0-9]{2}-[0-9]{2}[Tt ][0-9]{2}:[0-9]{2}:[0-9]{2}(\.[0-9]+)?([Zz]|[+-][0-9]{2}:[0-9]{2})$')) AS f_ts,
    count(*) FILTER (WHERE NOT regexp_matches(ip_address,
      '^((25[0-5]|2[0-4][0-9]|1[0-9][0-9]|[1-9]?[0-9])\.){3}(25[0-5]|2[0-4][0-9]|1[0-9][0-9]|[1-9]?[0-9])$')) AS f_ip,
    count(*) FILTER (WHERE device_type NOT IN ('mobile', 'desktop', 'tablet')) AS device_enum,
    count(*) FILTER (WHERE payment_method NOT IN ('credit_card', 'debit_card', 'paypal', 'bank_transfer')) AS pay_enum
  FROM msgj
)
SELECT field, rule, violations FROM flags, (VALUES
  ('$', 'type_object', 0), ('$', 'additional_properties', 1),
  ('transaction_id', 'required', 2), ('customer_id', 'required', 3), ('customer_name', 'required', 4),
  ('customer_email', 'required', 5), ('customer_country', 'required', 6), ('amount', 'required', 7),
  ('currency', 'required', 8), ('status', 'required', 9), ('product_category', 'required', 10),
  ('product_name', 'required', 11), ('quantity', 'required', 12), ('timestamp', 'required', 13),
  ('ip_address', 'required', 14), ('device_type', 'required', 15), ('payment_method', 'required', 16),
  ('transaction_id', 'pattern', 17), ('customer_id', 'pattern', 18), ('customer_name', 'min_length', 19),
  ('customer_email', 'format_email', 20), ('customer_country', 'pattern', 21),
  ('amount', 'exclusive_minimum', 22), ('amount', 'maximum', 23), ('currency', 'const', 24),
  ('status', 'enum', 25), ('product_category', 'enum', 26), ('product_name', 'min_length', 27),
  ('quantity', 'minimum', 28), ('quantity', 'maximum', 29), ('timestamp', 'format_date_time', 30),
  ('ip_address', 'format_ipv4', 31), ('device_type', 'enum', 32), ('payment_method', 'enum', 33)
) AS r(field, rule, i),
LATERAL (SELECT CAST([type_object, additional_properties, rq_transaction_id, rq_customer_id, rq_customer_name,
  rq_customer_email, rq_customer_country, rq_amount, rq_currency, rq_status, rq_product_category,
  rq_product_name, rq_quantity, rq_timestamp, rq_ip_address, rq_device_type, rq_payment_method,
  p_transaction_id, p_customer_id, ml_customer_name, f_email, p_country, amount_min, amount_max,
  currency_const, status_enum, category_enum, ml_product_name, quantity_min, quantity_max, f_ts, f_ip,
  device_enum, pay_enum][r.i + 1] AS BIGINT) AS violations)""",
)


ORACLE: dict[str, str] = {
    "stg_transactions": w(MARTS, STG_OUT.format(src="stg")),
    "dim_customers": w(MARTS, DIM_OUT.format(src="dim")),
    "dim_customers_from_day_groups": w(MARTS, DIM_OUT.format(src="dim")),
    "fct_transactions": w(
        MARTS,
        """
SELECT transaction_id, customer_id, customer_name, customer_email, customer_country, customer_segment,
  CAST(amount AS DOUBLE) AS amount, currency, status, product_category, product_name, quantity,
  CAST(total_line_value AS DOUBLE) AS total_line_value, device_type, payment_method, ip_address,
  transaction_date, transaction_hour, event_timestamp, is_high_value, is_potential_fraud, loaded_at
FROM fct""",
    ),
    "fct_daily_revenue": w(
        MARTS,
        """
SELECT transaction_date, product_category, order_count, successful_orders, failed_orders, refunded_orders,
  pending_orders, high_value_orders, CAST(total_revenue AS DOUBLE) AS total_revenue,
  CAST(successful_revenue AS DOUBLE) AS successful_revenue, CAST(avg_order_value AS DOUBLE) AS avg_order_value,
  total_quantity_sold, failure_rate_pct, loaded_at
FROM daily""",
    ),
    "q1_revenue_today": w(
        MARTS,
        f"""
SELECT CAST(event_timestamp AS DATE) AS date,
  CAST(sum(amount) AS DOUBLE) AS total_revenue,
  count(*) AS transaction_count,
  CAST({avg9('amount')} AS DOUBLE) AS avg_transaction_value
FROM fct
WHERE status = 'success' AND transaction_date = {AS_OF}
GROUP BY 1""",
    ),
    "q2_category_7d": w(
        MARTS,
        f"""
SELECT product_category,
  CAST(sum(amount) AS DOUBLE) AS total_revenue,
  count(*) AS transaction_count,
  CAST({avg9('amount')} AS DOUBLE) AS avg_order_value,
  count(*) FILTER (WHERE status = 'failed') AS failed_transactions
FROM fct
WHERE transaction_date >= {AS_OF} - 7
GROUP BY product_category
ORDER BY total_revenue DESC""",
    ),
    "q3_top_customers": w(
        MARTS,
        """
SELECT customer_id, customer_name, customer_country, customer_segment,
  CAST(total_spend AS DOUBLE) AS total_spend, total_transactions,
  CAST(avg_transaction_value AS DOUBLE) AS avg_transaction_value
FROM dim
ORDER BY total_spend DESC, customer_id
LIMIT 10""",
    ),
    "q4_hourly_today": w(
        MARTS,
        f"""
SELECT transaction_hour,
  count(*) AS transactions,
  CAST(sum(amount) AS DOUBLE) AS revenue,
  count(*) FILTER (WHERE status = 'success') AS successful,
  count(*) FILTER (WHERE status = 'failed') AS failed
FROM fct
WHERE transaction_date = {AS_OF}
GROUP BY transaction_hour
ORDER BY transaction_hour""",
    ),
    "q5_failure_by_payment_30d": w(
        MARTS,
        f"""
SELECT payment_method,
  count(*) AS total,
  count(*) FILTER (WHERE status = 'failed') AS failed,
  round(count(*) FILTER (WHERE status = 'failed') / count(*) * 100, 2) AS failure_rate_pct
FROM fct
WHERE transaction_date >= {AS_OF} - 30
GROUP BY payment_method
ORDER BY failure_rate_pct DESC""",
    ),
    "q6_flagged": w(
        MARTS,
        """
SELECT transaction_id, customer_id, customer_name, CAST(amount AS DOUBLE) AS amount, product_category,
  device_type, ip_address, event_timestamp
FROM fct
WHERE is_high_value OR is_potential_fraud
ORDER BY amount DESC, transaction_id
LIMIT 50""",
    ),
    "q7_segments": w(
        MARTS,
        f"""
SELECT customer_segment,
  count(*) AS customer_count,
  CAST(sum(total_spend) AS DOUBLE) AS segment_revenue,
  CAST({avg9('total_spend')} AS DOUBLE) AS avg_spend_per_customer
FROM dim
GROUP BY customer_segment
ORDER BY segment_revenue DESC""",
    ),
    "q8_daily_trend_30d": w(
        MARTS,
        f"""
SELECT transaction_date,
  CAST(sum(CASE WHEN status = 'success' THEN amount ELSE 0 END) AS DOUBLE) AS daily_revenue,
  count(*) AS total_transactions,
  count(DISTINCT customer_id) AS unique_customers
FROM fct
WHERE transaction_date >= {AS_OF} - 30
GROUP BY transaction_date
ORDER BY transaction_date""",
    ),
    "d1_kpis_today": w(
        MARTS,
        f"""
SELECT
  CAST(coalesce(sum(total_revenue), 0) AS DOUBLE) AS revenue_today,
  coalesce(CAST(sum(order_count) AS BIGINT), 0) AS orders_today,
  CAST(coalesce(round({avg9('avg_order_value')}, 2), 0) AS DOUBLE) AS avg_order_value,
  coalesce(round(avg(failure_rate_pct), 2), 0) AS avg_failure_rate
FROM daily
WHERE transaction_date = {AS_OF}""",
    ),
    "d1_kpis_empty_day": w(
        MARTS,
        f"""
SELECT
  CAST(coalesce(sum(total_revenue), 0) AS DOUBLE) AS revenue_today,
  coalesce(CAST(sum(order_count) AS BIGINT), 0) AS orders_today,
  CAST(coalesce(round({avg9('avg_order_value')}, 2), 0) AS DOUBLE) AS avg_order_value,
  CAST(coalesce(round(avg(failure_rate_pct), 2), 0) AS DOUBLE) AS avg_failure_rate
FROM daily
WHERE transaction_date = {EMPTY_DAY}""",
    ),
    "d2_revenue_trend": w(
        MARTS,
        f"""
SELECT transaction_date, product_category,
  CAST(sum(total_revenue) AS DOUBLE) AS daily_revenue,
  CAST(sum(order_count) AS BIGINT) AS daily_orders
FROM daily
WHERE transaction_date >= {AS_OF} - 30
GROUP BY transaction_date, product_category
ORDER BY transaction_date""",
    ),
    "d2b_daily_total": w(
        MARTS,
        f"""
SELECT transaction_date, CAST(sum(daily_revenue) AS DOUBLE) AS daily_revenue
FROM (
  SELECT transaction_date, product_category, sum(total_revenue) AS daily_revenue
  FROM daily
  WHERE transaction_date >= {AS_OF} - 30
  GROUP BY transaction_date, product_category
)
GROUP BY transaction_date""",
    ),
    "d3_category_breakdown": w(
        MARTS,
        f"""
SELECT product_category,
  CAST(sum(total_revenue) AS DOUBLE) AS revenue,
  CAST(sum(order_count) AS BIGINT) AS orders,
  round(sum(failed_orders) / nullif(sum(order_count), 0) * 100, 2) AS failure_rate_pct,
  CAST(round({ratio9('sum(total_revenue)', 'sum(order_count)')}, 2) AS DOUBLE) AS avg_order_value
FROM daily
WHERE transaction_date >= {AS_OF} - 30
GROUP BY product_category
ORDER BY revenue DESC""",
    ),
    "d4_top_customers": w(
        MARTS,
        """
SELECT customer_id, customer_name, customer_country, customer_segment,
  CAST(round(total_spend, 2) AS DOUBLE) AS total_spend, total_transactions,
  CAST(round(avg_transaction_value, 2) AS DOUBLE) AS avg_transaction_value,
  failure_rate_pct, active_days
FROM dim
ORDER BY total_spend DESC, customer_id
LIMIT 20""",
    ),
    "d5_payment_failure": w(
        MARTS,
        f"""
SELECT payment_method,
  count(*) AS total_orders,
  count(*) FILTER (WHERE status = 'failed') AS failed_orders,
  round(count(*) FILTER (WHERE status = 'failed') / count(*) * 100, 2) AS failure_rate_pct,
  CAST(round(sum(amount), 2) AS DOUBLE) AS total_revenue,
  CAST(round({avg9('amount')}, 2) AS DOUBLE) AS avg_order_value
FROM fct
WHERE transaction_date >= {AS_OF} - 30
GROUP BY payment_method
ORDER BY failure_rate_pct DESC""",
    ),
    "d6_segments": w(
        MARTS,
        f"""
SELECT customer_segment,
  count(*) AS customer_count,
  CAST(round(sum(total_spend), 2) AS DOUBLE) AS segment_revenue,
  CAST(round({avg9('total_spend')}, 2) AS DOUBLE) AS avg_spend
FROM dim
GROUP BY customer_segment
ORDER BY segment_revenue DESC""",
    ),
    "encode_roundtrip": w(
        RAW,
        f"""
SELECT {EVENT_COLS}, event_ts AS event_timestamp, CAST(NULL AS VARCHAR) AS dlq_reason
FROM raw
WHERE amount > 0
UNION ALL
SELECT {EVENT_COLS}, event_ts AS event_timestamp, 'invalid_amount' AS dlq_reason
FROM raw
WHERE NOT (amount > 0)""",
    ),
    "parse_transactions": w(STREAM, f"SELECT {LAKE_COLS}, dlq_reason FROM parsed"),
    "split_valid": w(STREAM, f"SELECT {LAKE_COLS} FROM valid"),
    "split_invalid": w(STREAM, f"SELECT {LAKE_COLS}, dlq_reason FROM parsed WHERE dlq_reason IS NOT NULL"),
    "dlq_payload": w(
        STREAM,
        f"""
SELECT dlq_reason AS error_reason, {NOW} AS error_timestamp, transaction_id AS raw_transaction_id
FROM parsed WHERE dlq_reason IS NOT NULL""",
    ),
    "contract_violations": CONTRACT,
    "contract_violation_rows": f"SELECT * FROM ({CONTRACT}) WHERE violations > 0",
    "lake_roundtrip": w(STREAM, f"SELECT {EVENT_COLS}, event_ts AS event_timestamp, hour FROM valid"),
    "dlq_roundtrip": w(
        STREAM,
        f"""
SELECT dlq_reason AS error_reason, {NOW} AS error_timestamp, transaction_id AS raw_transaction_id
FROM parsed WHERE dlq_reason IS NOT NULL""",
    ),
    "batch_two_loads": w(
        RAW,
        f"SELECT {EVENT_COLS}, event_ts AS event_timestamp, CAST(hour(event_ts) AS INTEGER) AS hour FROM raw WHERE amount > 0",
    ),
    "batch_history": BATCH_HISTORY,
    "ingest_stream": w(STREAM, f"SELECT {EVENT_COLS}, event_ts AS event_timestamp, hour FROM valid"),
    "stg_from_stream": w(STREAM + "," + stg_cte("s", "valid"), STG_OUT.format(src="s")),
    "dedupe_by_key": w(STREAM, f"SELECT {LAKE_COLS} FROM valid"),
    "insert_if_absent": w(STREAM, f"SELECT {LAKE_COLS} FROM valid"),
    "scd2_history": SCD2_HISTORY,
    "scd2_history_from_log": SCD2_HISTORY,
    "scd2_changes": SCD2_CHANGES,
    "dq_report": w(MARTS, _dq("stg", "dim", "fct", "daily")),
    "dq_report_broken": w(BROKEN, _dq("stg", "dim", "fct", "daily")),
    "dq_report_stream": w(
        ",".join([STREAM, stg_cte("stg", "valid"), dim_cte("dim", "stg"), fct_cte("fct", "stg", "dim"), daily_cte("daily", "fct")]),
        _dq("stg", "dim", "fct", "daily"),
    ),
}
# From day states: the same answers, from the same SQL over the events.
for _name in (
    "q1_revenue_today",
    "q2_category_7d",
    "q4_hourly_today",
    "q5_failure_by_payment_30d",
    "q6_flagged",
    "q8_daily_trend_30d",
    "d5_payment_failure",
):
    ORACLE[f"{_name}_served"] = ORACLE[_name]
