"""DuckDB reference SQL for every registered query.

The gold tables are restated as flat SQL over the driver tables (the
mapping of ``sources.driver_tables``, without the text round trip the
Spark builders go through), and each query is the plain SQL of its view,
measure or check on top.  Run on the pre-registered views ``orders``,
``lineitem`` ... ``events``.
"""

from __future__ import annotations

ORDERS_AS_OF = "TIMESTAMP '2001-08-02 00:00:00'"
EVENTS_AS_OF = "TIMESTAMP '2024-01-31 00:00:00'"


def _dk(ts: str) -> str:
    return f"COALESCE(CAST(strftime({ts}, '%Y%m%d') AS INTEGER), 0)"


def _key(*parts: str) -> str:
    return "left(md5(concat_ws('|', " + ", ".join(f"COALESCE(CAST({p} AS VARCHAR), 'None')" for p in parts) + ")), 16)"


CTE = {}
DEPS = {}

CTE["ord"] = """
  SELECT o.*, o_orderkey % 3 AS s, CAST(o_orderkey AS VARCHAR) AS order_id,
    CASE WHEN o_orderkey % 97 = 5 THEN '' ELSE CAST(o_orderkey AS VARCHAR) END AS transaction_id,
    CASE WHEN o_orderkey % 10 = 0 THEN NULL WHEN o_orderstatus = 'F' THEN 'completed'
         WHEN o_orderstatus = 'O' THEN 'pending'
         WHEN o_orderstatus = 'P' AND o_orderkey % 7 = 0 THEN 'refunded'
         WHEN o_orderstatus = 'P' THEN 'cancelled' END AS status,
    CAST(trunc(o_totalprice * 25000) AS BIGINT) AS total_vnd,
    CASE o_orderkey % 3 WHEN 0 THEN 'shopify' WHEN 1 THEN 'sapo_pos' ELSE 'online' END AS source,
    CASE o_orderkey % 3 WHEN 0 THEN 'shopify' WHEN 1 THEN 'sapo_pos'
         ELSE (CASE WHEN o_orderkey % 6 = 2 THEN 'lazada' ELSE 'tiki' END) END AS channel
  FROM orders o"""

CTE["fact_orders"] = f"""
  SELECT {_key('order_id', 'source', 'channel')} AS order_key, order_id,
    CASE s WHEN 0 THEN 'SH-' || order_id WHEN 1 THEN 'SP-' || order_id END AS order_number,
    transaction_id, o_custkey AS customer_id,
    CASE WHEN s = 1 THEN o_orderkey % 25 END AS location_id,
    o_orderdate AS order_date, {_dk('o_orderdate')} AS order_date_key, channel, source, status,
    CASE WHEN s = 0 THEN (CASE o_orderstatus WHEN 'F' THEN 'paid' WHEN 'O' THEN 'pending' ELSE 'voided' END)
         ELSE status END AS payment_status,
    CASE s WHEN 0 THEN 'shopify_payments' WHEN 1 THEN (CASE WHEN o_orderkey % 2 = 0 THEN 'cash' ELSE 'card' END)
         ELSE 'cod' END AS payment_gateway,
    CASE s WHEN 0 THEN NULL WHEN 1 THEN (CASE WHEN o_orderkey % 2 = 0 THEN 'cash' ELSE 'card' END)
         ELSE 'cod' END AS payment_method,
    total_vnd, CASE WHEN s = 2 THEN 0.0 ELSE o_totalprice END AS total_usd
  FROM ord"""
DEPS["fact_orders"] = ["ord"]

CTE["fact_order_items"] = f"""
  SELECT {_key('order_key', 'product_id', 'l_linenumber')} AS order_item_key, order_key, order_id,
    transaction_id, product_id, product_name, quantity, unit_price_vnd,
    CASE WHEN given_total = 0 AND unit_price_vnd <> 0 AND quantity <> 0 THEN unit_price_vnd * quantity
         ELSE given_total END AS line_total_vnd,
    order_date, order_date_key
  FROM (
    SELECT {_key('o.order_id', 'o.source', 'o.channel')} AS order_key, o.order_id, o.transaction_id,
      l.l_partkey AS product_id, 'part-' || CAST(l.l_partkey AS VARCHAR) AS product_name,
      l.l_linenumber,
      CAST(trunc(l.l_quantity) AS BIGINT) AS quantity,
      COALESCE(CAST(trunc(l.l_extendedprice * 25000 / NULLIF(l.l_quantity, 0)) AS BIGINT), 0) AS unit_price_vnd,
      CASE WHEN l.l_linenumber % 2 = 0 THEN CAST(trunc(l.l_extendedprice * 25000) AS BIGINT) ELSE 0 END
        AS given_total,
      o.o_orderdate AS order_date, {_dk('o.o_orderdate')} AS order_date_key
    FROM lineitem l JOIN ord o ON l.l_orderkey = o.o_orderkey) x"""
DEPS["fact_order_items"] = ["ord"]

CTE["fact_payments"] = f"""
  SELECT {_key('transaction_id', 'payment_gateway')} AS payment_key, transaction_id, order_id, customer_id,
    payment_gateway, payment_method, amount_vnd, amount_usd, payment_status, payment_date,
    {_dk('payment_date')} AS payment_date_key, payment_gateway AS source
  FROM (
    SELECT CASE WHEN transaction_id <> '' AND o_orderkey % 4 = 0 THEN 'X-' || order_id ELSE transaction_id END
        AS transaction_id, order_id,
      CASE WHEN s = 0 THEN o_custkey END AS customer_id,
      CASE s WHEN 0 THEN 'paypal' WHEN 1 THEN 'momo' ELSE 'zalopay' END AS payment_gateway,
      CASE s WHEN 0 THEN 'paypal' WHEN 1 THEN 'qr'
           ELSE 'zalopay_ch' || (CASE WHEN o_orderkey % 2 = 0 THEN '36' ELSE '38' END) END AS payment_method,
      CASE WHEN o_orderkey % 5 = 0 THEN CAST(trunc(o_totalprice * 12500) AS BIGINT) ELSE total_vnd END
        AS amount_vnd,
      CASE WHEN s = 0 THEN o_totalprice ELSE 0.0 END AS amount_usd,
      CASE s WHEN 0 THEN (CASE WHEN o_orderkey % 7 = 0 THEN 'DENIED' ELSE 'COMPLETED' END)
             WHEN 1 THEN (CASE WHEN o_orderkey % 13 = 0 OR o_orderkey % 7 = 0 THEN 'failed' ELSE 'success' END)
             ELSE (CASE WHEN o_orderkey % 7 = 0 THEN 'failed' ELSE 'success' END) END AS payment_status,
      o_orderdate + to_hours(CAST(o_orderkey % 72 AS INTEGER)) AS payment_date
    FROM ord) p"""
DEPS["fact_payments"] = ["ord"]

CTE["fact_cart_events"] = f"""
  SELECT {_key('event_id', 'session_id')} AS event_key, event_id, session_id, customer_id, event_type,
    event_timestamp, {_dk('event_timestamp')} AS event_date_key, product_id, source, device, browser,
    utm_source, utm_campaign
  FROM (
    SELECT CAST(event_id AS VARCHAR) AS event_id,
      's' || CAST(user_id AS VARCHAR) || '-' || strftime(ts, '%Y%m%d') AS session_id,
      CASE WHEN event_id % 50 <> 0 THEN user_id END AS customer_id,
      CASE event_type WHEN 'signup' THEN 'page_view' WHEN 'view' THEN 'view_item'
           WHEN 'click' THEN 'add_to_cart' WHEN 'error' THEN 'begin_checkout' ELSE event_type END AS event_type,
      ts AS event_timestamp,
      TRY_CAST(json_extract_string(props, '$.k') AS BIGINT) AS product_id,
      CASE WHEN user_id % 2 = 0 THEN 'web' ELSE 'app' END AS source,
      CASE event_id % 3 WHEN 0 THEN 'mobile' WHEN 1 THEN 'desktop' ELSE 'tablet' END AS device,
      CASE WHEN event_id % 2 = 0 THEN 'chrome' ELSE 'safari' END AS browser,
      CASE user_id % 5 WHEN 0 THEN 'google' WHEN 1 THEN 'facebook' ELSE 'direct' END AS utm_source,
      'camp-' || CAST(user_id % 4 AS VARCHAR) AS utm_campaign
    FROM events) e"""

CTE["fact_bank_transactions"] = f"""
  SELECT {_key('transaction_id', 'account_id')} AS transaction_key, transaction_id, account_id,
    transaction_type, amount_usd, amount_vnd, status, description, counterparty, transaction_date,
    {_dk('transaction_date')} AS transaction_date_key, 'mercury_bank' AS source
  FROM (
    SELECT 'MT-' || CAST(c_custkey AS VARCHAR) AS transaction_id,
      'acct-' || CAST(c_custkey % 3 AS VARCHAR) AS account_id,
      CASE WHEN c_acctbal < 0 THEN 'outgoing' ELSE 'incoming' END AS transaction_type,
      c_acctbal AS amount_usd,
      CASE WHEN c_custkey % 2 = 0 THEN (CASE WHEN c_acctbal <> 0 THEN CAST(trunc(c_acctbal * 25000) AS BIGINT)
                                             ELSE 0 END)
           ELSE CAST(trunc(abs(c_acctbal) * 25000) AS BIGINT) END AS amount_vnd,
      CASE c_custkey % 3 WHEN 0 THEN 'posted' WHEN 1 THEN 'pending' ELSE 'failed' END AS status,
      'Transfer ' || CAST(c_custkey AS VARCHAR) AS description,
      CASE WHEN c_custkey % 10 <> 0 THEN c_name ELSE '' END AS counterparty,
      TIMESTAMP '1994-12-01 00:00:00' + to_days(CAST(c_custkey AS INTEGER)) AS transaction_date
    FROM customer) b"""

CTE["dim_customers"] = """
  SELECT c_custkey AS customer_id,
    CASE WHEN c_custkey % 100 <> 7 THEN 'user' || CAST(c_custkey AS VARCHAR) || '@example.com' END AS email,
    c_name AS full_name, '+84' || lpad(CAST(c_custkey AS VARCHAR), 9, '0') AS phone,
    'City-' || CAST(c_nationkey AS VARCHAR) AS city, 'VN' AS country,
    TIMESTAMP '1994-01-01 00:00:00' + to_days(CAST(c_custkey % 365 AS INTEGER)) AS created_at,
    'New' AS customer_segment, CAST(0 AS BIGINT) AS lifetime_value_vnd, CAST(0 AS BIGINT) AS total_orders,
    CAST(NULL AS TIMESTAMP) AS first_order_date, CAST(NULL AS TIMESTAMP) AS last_order_date
  FROM customer"""

CTE["dim_products"] = """
  SELECT p_partkey AS product_id, p_name AS product_name, 'SKU-' || CAST(p_partkey AS VARCHAR) AS sku,
    '893' || lpad(CAST(p_partkey AS VARCHAR), 10, '0') AS barcode, p_type AS category, p_brand AS brand,
    CAST(trunc(p_retailprice * 25000) AS BIGINT) AS price_vnd, p_retailprice AS price_usd,
    CAST(p_size * 10 AS BIGINT) AS stock_quantity, TRUE AS is_active
  FROM part"""

CTE["dim_locations"] = """
  SELECT CAST(n_nationkey AS BIGINT) AS location_id, 'LOC-' || CAST(n_nationkey AS VARCHAR) AS location_code,
    n_name AS location_name, 'store' AS location_type, r_name AS city, n_name || ' street' AS address,
    '028' || lpad(CAST(n_nationkey AS VARCHAR), 7, '0') AS phone, TRUE AS is_active
  FROM nation LEFT JOIN region ON n_regionkey = r_regionkey"""

CTE["dim_staff"] = """
  SELECT sid AS staff_id, 'ST' || CAST(sid AS VARCHAR) AS staff_code, 'Staff ' || CAST(sid AS VARCHAR) AS full_name,
    CASE WHEN sid % 3 = 0 THEN 'Cashier' ELSE 'Staff' END AS position,
    'staff' || CAST(sid AS VARCHAR) || '@shop.vn' AS email, '090' || lpad(CAST(sid AS VARCHAR), 7, '0') AS phone,
    arg_min(o_orderkey % 25, o_orderkey) AS location_id, CAST(NULL AS TIMESTAMP) AS hire_date, TRUE AS is_active
  FROM (SELECT o_custkey % 40 AS sid, o_orderkey FROM ord WHERE s = 1 AND o_custkey % 40 <> 0) t
  GROUP BY sid"""
DEPS["dim_staff"] = ["ord"]

CTE["dim_date"] = f"""
  SELECT {_dk('d')} AS date_key, CAST(d AS DATE) AS full_date, CAST(year(d) AS INTEGER) AS year,
    CAST(quarter(d) AS INTEGER) AS quarter, CAST(month(d) AS INTEGER) AS month,
    strftime(d, '%B') AS month_name, CAST(weekofyear(d) AS INTEGER) AS week,
    CAST(day(d) AS INTEGER) AS day_of_month, CAST(isodow(d) - 1 AS INTEGER) AS day_of_week,
    strftime(d, '%A') AS day_name, isodow(d) >= 6 AS is_weekend,
    strftime(d, '%m-%d') IN ('01-01', '04-30', '05-01', '09-02') AS is_holiday,
    CAST(year(d) AS INTEGER) AS fiscal_year, CAST(quarter(d) AS INTEGER) AS fiscal_quarter
  FROM (SELECT unnest(generate_series(CAST(min(order_date) AS DATE), CAST(max(order_date) AS DATE),
                                      INTERVAL 1 DAY)) AS d FROM fact_orders) c"""
DEPS["dim_date"] = ["fact_orders"]

CTE["rfm_cust"] = f"""
  SELECT d.customer_id, d.email, d.full_name, d.phone, d.city, d.country, d.created_at,
    COALESCE(a.lifetime_value_vnd, 0) AS lifetime_value_vnd, COALESCE(a.total_orders, 0) AS total_orders,
    a.first_order_date, a.last_order_date
  FROM dim_customers d LEFT JOIN (
    SELECT customer_id + CASE WHEN customer_id % 11 = 0 THEN 1 ELSE 0 END AS customer_id,
      CAST(SUM(total_vnd) AS BIGINT) AS lifetime_value_vnd, COUNT(order_key) AS total_orders,
      MIN(order_date) AS first_order_date, MAX(order_date) AS last_order_date
    FROM fact_orders WHERE customer_id IS NOT NULL GROUP BY 1) a
  ON d.customer_id = a.customer_id"""
DEPS["rfm_cust"] = ["dim_customers", "fact_orders"]


def _q(r: str) -> str:
    return f"CAST(CASE WHEN n <= 1 THEN 1 ELSE greatest(1, floor((5 * ({r} - 1) + n - 2) / (n - 1))) END AS INTEGER)"


CTE["rfm_scored"] = f"""
  SELECT *, 6 - {_q('rr')} AS r_score, {_q('rf')} AS f_score, {_q('rm')} AS m_score
  FROM (
    SELECT *, row_number() OVER (ORDER BY recency_days, customer_id) AS rr,
      row_number() OVER (ORDER BY total_orders, customer_id) AS rf,
      row_number() OVER (ORDER BY lifetime_value_vnd, customer_id) AS rm, count(*) OVER () AS n
    FROM (SELECT *, COALESCE(date_sub('day', last_order_date, {ORDERS_AS_OF}), 9999) AS recency_days
          FROM rfm_cust WHERE total_orders > 0) a) b"""
DEPS["rfm_scored"] = ["rfm_cust"]

_SEGMENT_ROWS = """
    (1, ['Lost', 'Lost', 'Hibernating', 'Cannot Lose Them', 'Cannot Lose Them']),
    (2, ['Hibernating', 'About To Sleep', 'Lost', 'At Risk', 'At Risk']),
    (3, ['About To Sleep', 'About To Sleep', 'Need Attention', 'Loyal', 'Loyal']),
    (4, ['New Customer', 'Promising', 'Potential Loyalist', 'Champions', 'Champions']),
    (5, ['New Customer', 'Promising', 'Potential Loyalist', 'Champions', 'Champions'])"""
CTE["rfm_named"] = f"""
  SELECT s.*, t.names[s.f_score] AS customer_segment
  FROM rfm_scored s JOIN (VALUES {_SEGMENT_ROWS}) AS t(r, names) ON s.r_score = t.r"""
DEPS["rfm_named"] = ["rfm_scored"]

CTE["customer_aggregates"] = """
  SELECT c.customer_id, c.email, c.full_name, c.phone, c.city, c.country, c.created_at,
    COALESCE(s.customer_segment, 'New') AS customer_segment, c.lifetime_value_vnd, c.total_orders,
    c.first_order_date, c.last_order_date
  FROM rfm_cust c LEFT JOIN rfm_named s
  ON c.customer_id = s.customer_id"""
DEPS["customer_aggregates"] = ["rfm_cust", "rfm_named"]


def with_ctes(*names: str) -> str:
    order: list[str] = []

    def visit(n: str) -> None:
        for d in DEPS.get(n, []):
            visit(d)
        if n not in order:
            order.append(n)

    for n in names:
        visit(n)
    return "WITH " + ",\n".join(f"{n} AS ({CTE[n]})" for n in order) + "\n"


def _table(name: str) -> str:
    return with_ctes(name) + f"SELECT * FROM {name}"


def _nulls(table: str, cols: list[str]) -> str:
    return " UNION ALL ".join(
        f"SELECT '{table}' AS table_name, '{c}' AS column_name, count_if({c} IS NULL) AS null_count, "
        f"COUNT(*) AS row_count, CASE WHEN COUNT(*) > 0 THEN count_if({c} IS NULL) / COUNT(*) * 100.0 END "
        f"AS null_pct FROM {table}" for c in cols)


NULL_CHECKS = [
    ("fact_orders", ["order_id", "customer_id", "total_vnd"]),
    ("fact_order_items", ["order_key", "product_id"]),
    ("fact_payments", ["transaction_id", "amount_vnd"]),
    ("fact_cart_events", ["event_id", "event_type", "session_id"]),
    ("fact_bank_transactions", ["transaction_id", "account_id", "amount_vnd"]),
    ("dim_customers", ["customer_id", "email"]),
    ("dim_products", ["product_id", "product_name", "sku"]),
    ("dim_locations", ["location_id", "location_name"]),
]
DUP_CHECKS = [
    ("lineitem", ["l_orderkey", "l_linenumber"]),
    ("fact_order_items", ["order_item_key"]),
    ("fact_payments", ["payment_key"]),
    ("fact_orders", ["order_key"]),
]
RANGE_CHECKS = [
    ("fact_orders", "order_date", ORDERS_AS_OF),
    ("fact_payments", "payment_date", ORDERS_AS_OF),
    ("fact_cart_events", "event_timestamp", EVENTS_AS_OF),
    ("fact_bank_transactions", "transaction_date", ORDERS_AS_OF),
    ("dim_customers", "created_at", ORDERS_AS_OF),
]
AMOUNT_CHECKS = [
    ("fact_orders", ["total_vnd", "total_usd"], False),
    ("fact_order_items", ["unit_price_vnd", "line_total_vnd"], False),
    ("fact_payments", ["amount_vnd", "amount_usd"], False),
    ("fact_bank_transactions", ["amount_vnd", "amount_usd"], True),
    ("dim_products", ["price_vnd", "price_usd"], False),
]


def _dups(table: str, keys: list[str]) -> str:
    k = ", ".join(keys)
    return (f"SELECT '{table}' AS table_name, '{','.join(keys)}' AS key_columns, "
            f"CAST(SUM(c) AS BIGINT) AS row_count, COUNT(*) AS distinct_keys, "
            f"CAST(SUM(c) AS BIGINT) - COUNT(*) AS duplicate_count "
            f"FROM (SELECT COUNT(*) AS c FROM {table} GROUP BY {k}) g")


def _range(table: str, col: str, as_of: str) -> str:
    hi = f"CAST(CAST({as_of} AS DATE) + INTERVAL 1 DAY AS TIMESTAMP)"
    return (f"SELECT '{table}' AS table_name, '{col}' AS column_name, MIN({col}) AS min_value, "
            f"MAX({col}) AS max_value, "
            f"count_if({col} < TIMESTAMP '2020-01-01 00:00:00' OR {col} > {hi}) AS out_of_range_count, "
            f"count_if({col} > {as_of}) AS future_count FROM {table}")


def _amounts(table: str, cols: list[str], allow_negative: bool) -> str:
    parts = []
    for c in cols:
        neg = "CAST(NULL AS BIGINT)" if allow_negative else f"count_if({c} < 0)"
        parts.append(
            f"SELECT '{table}' AS table_name, '{c}' AS column_name, value_count, round(m, 4) AS mean, median, "
            f"round(sd, 2) AS std, negative_count, "
            f"(SELECT count_if(sd > 0 AND abs(CAST(t.{c} AS DOUBLE) - m) > 3 * sd) FROM {table} t) "
            f"AS outlier_count FROM (SELECT COUNT({c}) AS value_count, avg(CAST({c} AS DOUBLE)) AS m, "
            f"CAST(quantile_cont({c}, 0.5) AS DOUBLE) AS median, stddev_samp(CAST({c} AS DOUBLE)) AS sd, "
            f"{neg} AS negative_count FROM {table}) s")
    return " UNION ALL ".join(parts)


def _gold_for(tables) -> list[str]:
    return [t for t in tables if t in CTE]


SQL: dict[str, str] = {}

# V2: one long table of daily flows, summed per day and pivoted.
SQL["cashflow_daily"] = with_ctes("fact_orders", "fact_payments", "fact_bank_transactions") + """
, flows AS (
  SELECT 1 AS kind, CAST(order_date AS DATE) AS day, total_vnd AS vnd, TRUE AS good
  FROM fact_orders WHERE status <> 'cancelled' AND status <> 'refunded'
  UNION ALL
  SELECT 2, CAST(payment_date AS DATE), amount_vnd, payment_status = 'success' FROM fact_payments
  UNION ALL
  SELECT 3, CAST(transaction_date AS DATE),
    CASE WHEN amount_vnd = 0 OR amount_vnd IS NULL THEN CAST(round(amount_usd * 25000) AS BIGINT) ELSE amount_vnd END, TRUE
  FROM fact_bank_transactions WHERE status = 'posted' OR status = 'pending'),
totals AS (
  SELECT day AS report_date,
    CAST(sum(vnd) FILTER (kind = 1) AS BIGINT) AS sales, count(*) FILTER (kind = 1) AS orders,
    CAST(sum(vnd) FILTER (kind = 2 AND good) AS BIGINT) AS paid, count(*) FILTER (kind = 2 AND good) AS n_good,
    count(*) FILTER (kind = 2 AND NOT good) AS n_bad,
    CAST(sum(vnd) FILTER (kind = 3 AND vnd > 0) AS BIGINT) AS bank_in,
    CAST(-sum(vnd) FILTER (kind = 3 AND vnd < 0) AS BIGINT) AS bank_out
  FROM flows GROUP BY day)
SELECT report_date, ifnull(sales, 0) AS sales_revenue_vnd, orders AS order_count,
  ifnull(paid, 0) AS payments_received_vnd, n_good AS successful_payments, n_bad AS failed_payments,
  ifnull(bank_in, 0) AS bank_inflow_vnd, ifnull(bank_out, 0) AS bank_outflow_vnd,
  ifnull(sales, 0) - ifnull(bank_out, 0) AS net_cashflow_vnd
FROM totals ORDER BY report_date"""

# V3: ages and payments prepared first, the categories from a small table.
SQL["payment_status"] = with_ctes("fact_orders", "dim_customers", "fact_payments") + f"""
, aged AS (
  SELECT *, date_sub('day', order_date, {ORDERS_AS_OF}) AS age, nullif(trim(transaction_id), '') AS tid FROM fact_orders),
named AS (SELECT * FROM (VALUES ('success', 'Paid'), ('failed', 'Failed')) AS t(state, category)),
paid AS (
  SELECT nullif(trim(transaction_id), '') AS tid, payment_key, payment_date, payment_status AS state, amount_vnd
  FROM fact_payments),
joined AS (
  SELECT a.*, p.payment_key, p.payment_date, p.state, p.amount_vnd, n.category, p.payment_date IS NULL AS unpaid
  FROM aged a LEFT JOIN paid p ON p.tid = a.tid LEFT JOIN named n ON n.state = p.state)
SELECT j.order_key, j.order_id, j.order_number, j.customer_id, c.full_name AS customer_name, c.email AS customer_email,
  j.order_date, j.channel, j.total_vnd, j.payment_status AS order_payment_status, j.payment_gateway, j.payment_key,
  j.payment_date, j.state AS gateway_payment_status, j.amount_vnd AS paid_amount_vnd,
  coalesce(j.category, if(NOT j.unpaid, 'Unknown', if(j.age > 30, 'Overdue', 'Pending'))) AS payment_status_category,
  date_sub('hour', j.order_date, j.payment_date) AS payment_delay_hours,
  if(j.state = 'success', 0, j.total_vnd - ifnull(j.amount_vnd, 0)) AS outstanding_amount_vnd,
  if(j.unpaid AND j.age > 30, j.age, 0) AS days_overdue
FROM joined j LEFT JOIN dim_customers c USING (customer_id)"""

# V1: facts of a customer in one row each, then the numbered events.
SQL["customer_journey"] = with_ctes("fact_cart_events", "dim_customers", "fact_orders") + """
, bought AS (
  SELECT customer_id, min(order_date) AS first_day, count(*) AS n, CAST(sum(total_vnd) AS BIGINT) AS vnd
  FROM fact_orders GROUP BY customer_id),
began AS (SELECT customer_id, min(event_timestamp) AS first_event FROM fact_cart_events GROUP BY customer_id),
people AS (
  SELECT b.customer_id, d.full_name, d.customer_segment, o.first_day, o.n, o.vnd,
    date_sub('day', b.first_event, o.first_day) AS days
  FROM began b LEFT JOIN dim_customers d USING (customer_id) LEFT JOIN bought o USING (customer_id))
SELECT p.customer_id, p.full_name, p.customer_segment, e.session_id, e.event_type, e.event_timestamp,
  rank() OVER (PARTITION BY p.customer_id ORDER BY e.event_timestamp NULLS FIRST, e.event_key) AS touchpoint_sequence,
  e.product_id, e.source AS traffic_source, e.device, e.utm_source, e.utm_campaign,
  p.first_day AS first_purchase_date, p.n AS total_purchases, p.vnd AS total_revenue_vnd, p.days AS days_to_first_purchase
FROM people p JOIN fact_cart_events e ON e.customer_id = p.customer_id"""

SQL["rfm_segments"] = with_ctes("rfm_named") + """
SELECT customer_id, recency_days, total_orders, lifetime_value_vnd, r_score, f_score, m_score, customer_segment
FROM rfm_named"""

SQL["customer_aggregates"] = _table("customer_aggregates")

SQL["rfm_distribution"] = with_ctes("customer_aggregates") + """
SELECT customer_segment, COUNT(*) AS customer_count FROM customer_aggregates GROUP BY customer_segment
ORDER BY customer_count DESC, customer_segment"""

for _n in ("dim_date", "dim_customers", "dim_products", "dim_locations", "dim_staff",
           "fact_payments", "fact_cart_events", "fact_bank_transactions"):
    SQL[_n] = _table(_n)
SQL["fact_orders_union"] = _table("fact_orders")
SQL["order_items_explode"] = _table("fact_order_items")

SQL["dq_nulls"] = with_ctes(*_gold_for(t for t, _ in NULL_CHECKS)) + \
    " UNION ALL ".join(_nulls(t, cs) for t, cs in NULL_CHECKS)
SQL["dq_duplicates"] = with_ctes(*_gold_for(t for t, _ in DUP_CHECKS)) + \
    " UNION ALL ".join(_dups(t, ks) for t, ks in DUP_CHECKS)
SQL["dedup_first"] = """
SELECT l_orderkey, l_partkey, l_suppkey, l_linenumber, l_quantity, l_extendedprice, l_discount, l_tax,
  l_returnflag, l_linestatus, l_shipdate
FROM (SELECT *, row_number() OVER (PARTITION BY l_orderkey, l_linenumber ORDER BY l_partkey NULLS FIRST,
        l_suppkey NULLS FIRST, l_quantity NULLS FIRST, l_extendedprice NULLS FIRST, l_discount NULLS FIRST,
        l_tax NULLS FIRST, l_returnflag NULLS FIRST, l_linestatus NULLS FIRST, l_shipdate NULLS FIRST) AS rn
      FROM lineitem) t
WHERE rn = 1"""
SQL["dq_date_range"] = with_ctes(*_gold_for(t for t, _, _ in RANGE_CHECKS)) + \
    " UNION ALL ".join(_range(t, c, a) for t, c, a in RANGE_CHECKS)
SQL["dq_amounts"] = with_ctes(*_gold_for(t for t, _, _ in AMOUNT_CHECKS)) + \
    " UNION ALL ".join(_amounts(t, cs, a) for t, cs, a in AMOUNT_CHECKS)

_ALL_DQ = {t for t, _ in NULL_CHECKS} | {t for t, _ in DUP_CHECKS} | {t for t, _, _ in RANGE_CHECKS} | \
    {t for t, _, _ in AMOUNT_CHECKS}
SQL["quality_report"] = with_ctes(*_gold_for(sorted(_ALL_DQ))) + f"""
, n AS ({" UNION ALL ".join(_nulls(t, cs) for t, cs in NULL_CHECKS)}),
d AS ({" UNION ALL ".join(_dups(t, ks) for t, ks in DUP_CHECKS)}),
r AS ({" UNION ALL ".join(_range(t, c, a) for t, c, a in RANGE_CHECKS)}),
a AS ({" UNION ALL ".join(_amounts(t, cs, al) for t, cs, al in AMOUNT_CHECKS)})
SELECT table_name, 'nulls' AS check_name, column_name, CAST(null_count AS DOUBLE) AS value FROM n
UNION ALL SELECT table_name, 'duplicates', key_columns, CAST(duplicate_count AS DOUBLE) FROM d
UNION ALL SELECT table_name, 'out_of_range_count', column_name, CAST(out_of_range_count AS DOUBLE) FROM r
UNION ALL SELECT table_name, 'future_count', column_name, CAST(future_count AS DOUBLE) FROM r
UNION ALL SELECT table_name, 'mean', column_name, mean FROM a
UNION ALL SELECT table_name, 'median', column_name, median FROM a
UNION ALL SELECT table_name, 'std', column_name, std FROM a
UNION ALL SELECT table_name, 'negative_count', column_name, CAST(negative_count AS DOUBLE) FROM a
UNION ALL SELECT table_name, 'outlier_count', column_name, CAST(outlier_count AS DOUBLE) FROM a"""

SQL["surrogate_keys"] = with_ctes("fact_orders") + "SELECT order_key, order_id, source, channel FROM fact_orders"
SQL["date_keys"] = with_ctes("fact_cart_events") + \
    "SELECT event_id, event_timestamp, event_date_key FROM fact_cart_events"
SQL["usd_to_vnd"] = with_ctes("fact_bank_transactions") + \
    "SELECT transaction_id, amount_usd, amount_vnd FROM fact_bank_transactions"

_GOLD_TABLES = ["dim_customers", "dim_products", "dim_locations", "dim_staff", "dim_date", "fact_orders",
                "fact_order_items", "fact_payments", "fact_cart_events", "fact_bank_transactions"]
SQL["table_row_counts"] = with_ctes(*_GOLD_TABLES) + " UNION ALL ".join(
    f"SELECT '{t}' AS table_name, COUNT(*) AS row_count FROM {t}" for t in _GOLD_TABLES)

SQL["measure_sales"] = with_ctes("fact_orders") + """
SELECT CAST(COALESCE(SUM(total_vnd), 0) AS DECIMAL(38,0)) AS total_revenue_vnd,
  COUNT(DISTINCT order_id) AS total_orders, COUNT(DISTINCT customer_id) AS distinct_customers,
  COALESCE(CAST(SUM(total_vnd) AS DOUBLE) / NULLIF(COUNT(DISTINCT order_id), 0), 0.0) AS avg_order_value_vnd,
  COUNT(DISTINCT CASE WHEN status = 'completed' THEN order_id END) AS completed_orders
FROM fact_orders"""

SQL["measure_items_revenue"] = with_ctes("fact_order_items") + """
SELECT CAST(COALESCE(SUM(CAST(unit_price_vnd AS HUGEINT) * quantity), 0) AS DECIMAL(38,0)) AS items_revenue_vnd,
  CAST(COALESCE(SUM(line_total_vnd), 0) AS DECIMAL(38,0)) AS line_total_revenue_vnd, COUNT(*) AS item_count
FROM fact_order_items"""

SQL["measure_payments"] = with_ctes("fact_payments") + """
SELECT CAST(COALESCE(SUM(amount_vnd), 0) AS DECIMAL(38,0)) AS total_payment_vnd,
  count_if(payment_status = 'success') AS successful_transactions, COUNT(*) AS transaction_count,
  COALESCE(count_if(payment_status = 'success') / NULLIF(COUNT(*), 0), 0.0) AS payment_success_rate,
  CAST(COALESCE(SUM(CASE WHEN payment_status = 'refunded' THEN amount_vnd END), 0) AS DECIMAL(38,0)) AS refund_vnd
FROM fact_payments"""

SQL["measure_journey"] = with_ctes("fact_cart_events", "fact_orders") + """
SELECT total_views, total_add_to_cart, total_orders,
  1.0 - COALESCE(total_orders / NULLIF(total_add_to_cart, 0), 0.0) AS cart_abandonment_rate
FROM (SELECT count_if(event_type = 'view_item') AS total_views,
        count_if(event_type = 'add_to_cart') AS total_add_to_cart,
        (SELECT COUNT(DISTINCT order_id) FROM fact_orders) AS total_orders
      FROM fact_cart_events) t"""

SQL["revenue_ytd"] = with_ctes("dim_date") + """
SELECT c.full_date, c.year, COALESCE(r.revenue_vnd, 0) AS revenue_vnd,
  CAST(SUM(COALESCE(r.revenue_vnd, 0)) OVER (PARTITION BY c.year ORDER BY c.full_date
       ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS BIGINT) AS revenue_ytd_vnd
FROM dim_date c LEFT JOIN (
  SELECT CAST(order_date AS DATE) AS full_date, CAST(SUM(total_vnd) AS BIGINT) AS revenue_vnd
  FROM fact_orders GROUP BY 1) r ON c.full_date = r.full_date"""

SQL["revenue_mom"] = with_ctes("dim_date") + """
SELECT month_start, revenue_vnd, prev AS revenue_prev_month_vnd,
  CASE WHEN prev IS NULL OR prev = 0 THEN 0.0 ELSE (revenue_vnd - prev) / prev END AS mom_growth
FROM (
  SELECT m.month_start, COALESCE(r.revenue_vnd, 0) AS revenue_vnd,
    lag(COALESCE(r.revenue_vnd, 0)) OVER (ORDER BY m.month_start) AS prev
  FROM (SELECT DISTINCT CAST(date_trunc('month', full_date) AS DATE) AS month_start FROM dim_date) m
  LEFT JOIN (SELECT CAST(date_trunc('month', order_date) AS DATE) AS month_start,
               CAST(SUM(total_vnd) AS BIGINT) AS revenue_vnd FROM fact_orders GROUP BY 1) r
  ON m.month_start = r.month_start) t"""

SQL["event_funnel"] = with_ctes("fact_cart_events") + """
SELECT CASE event_type WHEN 'page_view' THEN 1 WHEN 'view_item' THEN 2 WHEN 'add_to_cart' THEN 3
         WHEN 'begin_checkout' THEN 4 WHEN 'purchase' THEN 5 END AS step_order,
  event_type AS step, COUNT(DISTINCT session_id) AS sessions
FROM fact_cart_events
WHERE event_type IN ('page_view', 'view_item', 'add_to_cart', 'begin_checkout', 'purchase')
GROUP BY 1, 2 ORDER BY 1"""

# the stored views compute what the DataFrame views do
for _view in ("cashflow_daily", "payment_status", "customer_journey"):
    SQL[f"{_view}_stored_view"] = SQL[_view]

# tables dealt out by customer compute what plain ones do
for _query in ("customer_journey", "customer_aggregates"):
    SQL[f"{_query}_colocated"] = SQL[_query]

SQL["distinct_customers_ytd"] = with_ctes("fact_orders") + """
, seen AS (SELECT DISTINCT CAST(date_trunc('month', order_date) AS DATE) AS month, customer_id FROM fact_orders
           WHERE order_date IS NOT NULL AND customer_id IS NOT NULL),
months AS (SELECT month, COUNT(*) AS distinct_count FROM seen GROUP BY 1)
SELECT m.month, m.distinct_count, COUNT(DISTINCT s.customer_id) AS distinct_ytd
FROM months m JOIN seen s ON year(s.month) = year(m.month) AND s.month <= m.month
GROUP BY 1, 2"""

_STEPS = ("page_view", "view_item", "add_to_cart", "begin_checkout", "purchase")
SQL["event_funnel_passed"] = with_ctes("fact_cart_events") + """
, sessions AS (SELECT session_id, list(DISTINCT event_type) AS had FROM fact_cart_events WHERE session_id IS NOT NULL GROUP BY 1)
""" + " UNION ALL ".join(
    f"SELECT {i + 1} AS step_order, '{s}' AS step, COUNT(*) FILTER (WHERE list_contains(had, '{s}')) AS reached, "
    f"COUNT(*) FILTER (WHERE list_has_all(had, {list(_STEPS[:i + 1])!r})) AS passed FROM sessions" for i, s in enumerate(_STEPS))

SQL["amount_quantiles"] = with_ctes("fact_orders") + """
SELECT year(order_date) AS year, r AS rank, COUNT(*) AS n, TRUE AS within_error
FROM fact_orders, (VALUES (CAST(0.25 AS DOUBLE)), (0.5), (0.75)) AS t(r)
WHERE order_date IS NOT NULL AND total_vnd IS NOT NULL GROUP BY 1, 2"""
