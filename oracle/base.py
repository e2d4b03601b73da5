"""Shared CTEs: driver tables -> raw -> cleaned -> checked -> valid -> order lines.

Written independently of the Spark code, as plain SQL text.
"""

from __future__ import annotations

import re


def rnd(x: str, n: int) -> str:
    return f"CAST(ROUND(CAST({x} AS DECIMAL(28,8)), {n}) AS DOUBLE)"


def dbl(x: str) -> str:
    return f"CAST({x} AS DOUBLE)"


def big(x: str) -> str:
    return f"CAST({x} AS BIGINT)"


def ratio(a: str, b: str) -> str:
    return f"({dbl(a)} / NULLIF({dbl(b)}, 0))"


def pct(a: str, b: str, n: int = 2) -> str:
    return rnd(f"({dbl(a)} * 100.0::DOUBLE / NULLIF({dbl(b)}, 0))", n)


def scaled(a: str, b: str, n: int = 2) -> str:
    """Quotient first, then times 100."""
    return rnd(f"({ratio(a, b)} * 100.0::DOUBLE)", n)


def title(x: str) -> str:
    runs = f"regexp_extract_all(lower({x}), '[a-z]+|[^a-z]+')"
    return f"array_to_string(list_transform({runs}, lambda t: upper(t[1]) || t[2:]), '')"


def strip(x: str) -> str:
    return f"regexp_replace({x}, '^\\s+|\\s+$', '', 'g')"


CTES: dict[str, str] = {}

CTES["sales_orders"] = """
SELECT o_orderkey, o_orderpriority, ck AS custkey,
  DATE '1995-01-01' + CAST(CASE WHEN ck % 7 = 1 THEN day % 540 WHEN ck % 3 = 0 THEN day % 1825
                                ELSE day END AS INTEGER) AS order_date
FROM (SELECT o_orderkey, o_orderpriority,
        CASE WHEN o_custkey % 20 = 9 THEN o_custkey - 1 ELSE o_custkey END AS ck,
        date_diff('day', DATE '1995-01-01', CAST(o_orderdate AS DATE)) AS day
      FROM orders)"""

CTES["raw_customers"] = """
SELECT k * 2 + copy AS src_seq, 'CUST_' || lpad(CAST(k AS VARCHAR), CAST(greatest(12, length(CAST(k AS VARCHAR))) AS INTEGER), '0') AS customer_id,
  CASE WHEN copy = 1 THEN nm || ' Dup' ELSE nm END AS name,
  CASE WHEN k % 100 = 7 THEN NULL WHEN k % 30 = 2 THEN 'M' WHEN k % 30 = 4 THEN 'FEMALE'
       WHEN k % 90 = 6 THEN 'n/a' WHEN k % 2 = 0 THEN 'Male' ELSE 'Female' END AS gender,
  CASE WHEN k % 67 = 3 THEN NULL WHEN k % 211 = 5 THEN 150.0::DOUBLE
       ELSE CAST(18 + (k * 7) % 63 AS DOUBLE) END AS age,
  lower(n_name) AS city, lower(substr(r_name, 1, 2)) AS state,
  COALESCE(d0, DATE '1995-01-01')
    + CAST(CASE WHEN k % 97 = 11 THEN 5 ELSE -(k % 60) END AS INTEGER) AS signup_date
FROM (
  SELECT c_custkey AS k, n_name, r_name, d0,
    CASE WHEN c_custkey % 40 = 1 THEN '  ' || upper(c_name) || ' ' ELSE c_name END AS nm,
    unnest(CASE WHEN c_custkey % 125 = 0 THEN [0, 1] ELSE [0] END) AS copy
  FROM customer
  JOIN nation ON c_nationkey = n_nationkey
  JOIN region ON n_regionkey = r_regionkey
  LEFT JOIN (SELECT custkey, min(order_date) AS d0 FROM sales_orders GROUP BY custkey) f
    ON c_custkey = f.custkey)"""

CTES["raw_products"] = """
SELECT k * 2 + copy AS src_seq,
  'PROD_' || lpad(CAST(k - copy AS VARCHAR), CAST(greatest(12, length(CAST(k - copy AS VARCHAR))) AS INTEGER), '0') AS product_id, p_name AS product_name,
  CASE WHEN copy = 1 THEN p_type WHEN k % 100 = 7 THEN NULL
       WHEN k % 50 = 3 THEN ' ' || lower(p_type) ELSE p_type END AS category,
  CASE WHEN k % 400 = 11 THEN 0.00::DECIMAL(18,2) ELSE list_price END AS price,
  CASE WHEN copy = 1 THEN list_price WHEN k % 170 = 13 THEN NULL
       WHEN k % 600 = 21 THEN 0.00::DECIMAL(18,2)
       WHEN k % 500 = 17 THEN CAST(list_price + 10 AS DECIMAL(18,2))
       ELSE CAST(list_price * CAST(35 + p_size AS DECIMAL(5,0)) * CAST(0.01 AS DECIMAL(3,2))
                 AS DECIMAL(18,2)) END AS cost
FROM (
  SELECT p_partkey AS k, p_name, p_type, p_size,
    CAST(p_retailprice AS DECIMAL(18,2)) AS list_price,
    unnest(CASE WHEN p_partkey % 450 = 1 THEN [0, 1] ELSE [0] END) AS copy
  FROM part)"""

CTES["raw_orders"] = """
SELECT CAST((CAST(l_partkey AS DECIMAL(19,0)) * 1000000000000 + l_suppkey) * 64 + CAST(l_quantity AS INTEGER) AS DECIMAL(38,0)) AS src_seq,
  'ORD_' || lpad(CAST(l_orderkey AS VARCHAR), CAST(greatest(12, length(CAST(l_orderkey AS VARCHAR))) AS INTEGER), '0') || '_' || CAST(l_linenumber AS VARCHAR) ||
    CASE WHEN l_orderkey % 40 = 0 THEN ''
         ELSE '_' || CAST(l_partkey AS VARCHAR) || '_' || CAST(l_suppkey AS VARCHAR)
              || '_' || CAST(CAST(l_quantity AS INTEGER) AS VARCHAR) END AS order_id,
  CASE WHEN l_orderkey % 997 = 5 THEN 'CUST_GHOST'
       ELSE 'CUST_' || lpad(CAST(custkey AS VARCHAR), CAST(greatest(12, length(CAST(custkey AS VARCHAR))) AS INTEGER), '0') END AS customer_id,
  'PROD_' || lpad(CAST(l_partkey AS VARCHAR), CAST(greatest(12, length(CAST(l_partkey AS VARCHAR))) AS INTEGER), '0') AS product_id,
  order_date,
  CAST(CASE WHEN (l_orderkey * 7 + l_linenumber) % 300 = 1 THEN -1 - CAST(l_quantity AS INTEGER) % 3
       WHEN (l_orderkey * 7 + l_linenumber) % 600 = 2 THEN 0
       ELSE 1 + CAST(l_quantity AS INTEGER) % 8 END AS INTEGER) AS quantity,
  CASE WHEN l_orderkey % 200 = 9 THEN NULL
       WHEN o_orderpriority LIKE '1%' THEN CASE WHEN l_orderkey % 3 = 0 THEN 'CC' ELSE 'Credit Card' END
       WHEN o_orderpriority LIKE '2%' THEN CASE WHEN l_orderkey % 3 = 0 THEN ' paypal ' ELSE 'PayPal' END
       WHEN o_orderpriority LIKE '3%' THEN 'Debit_Card'
       WHEN o_orderpriority LIKE '4%' THEN 'COD'
       ELSE CASE WHEN l_orderkey % 7 = 0 THEN 'Bank Transfer' ELSE 'apple pay' END
       END AS payment_method,
  CASE WHEN custkey % 20 = 19 THEN 'Cancelled'
       WHEN l_returnflag = 'R' AND l_linestatus = 'O' AND l_linenumber <= 3 THEN 'cancelled'
       WHEN l_returnflag = 'R' AND l_linenumber <= 3 THEN 'Refunded'
       WHEN l_linestatus = 'O' THEN 'Shipped' ELSE ' completed' END AS order_status
FROM lineitem JOIN sales_orders ON l_orderkey = o_orderkey"""

CTES["age_median"] = "SELECT COALESCE(median(age), 38.0) AS med FROM raw_customers"

CTES["clean_customers"] = f"""
SELECT src_seq, customer_id, {title(strip('name'))} AS name,
  CASE lower({strip('gender')}) WHEN 'm' THEN 'Male' WHEN 'male' THEN 'Male'
       WHEN 'f' THEN 'Female' WHEN 'female' THEN 'Female' ELSE 'Unknown' END AS gender,
  {rnd('COALESCE(age, med)', 1)} AS age, {title(strip('city'))} AS city,
  upper({strip('state')}) AS state, signup_date, age IS NULL AS is_age_imputed
FROM raw_customers, age_median"""

CTES["clean_products"] = f"""
SELECT src_seq, product_id, {strip('product_name')} AS product_name,
  {title(strip('category'))} AS category, price, cost,
  CASE WHEN price > 0 THEN {rnd(f"({dbl('price - cost')} / {dbl('price')} * 100.0::DOUBLE)", 2)} END
    AS gross_margin_pct
FROM raw_products"""

CTES["clean_orders"] = f"""
SELECT src_seq, order_id, customer_id, product_id, order_date, quantity,
  CASE WHEN pm IN ('cc', 'credit_card', 'credit card') THEN 'Credit Card'
       WHEN pm = 'paypal' THEN 'PayPal' WHEN pm IN ('cod', 'cash on delivery') THEN 'Cash on Delivery'
       WHEN pm IN ('debit_card', 'debit card') THEN 'Debit Card'
       WHEN pm IN ('apple pay', 'apple_pay') THEN 'Apple Pay' ELSE 'Unknown' END AS payment_method,
  {title(strip('order_status'))} AS order_status
FROM (SELECT *, lower({strip('payment_method')}) AS pm FROM raw_orders)"""

CTES["checked_customers"] = """
SELECT * EXCLUDE rn, CASE WHEN rn > 1 THEN 'DUPLICATE_CUSTOMER_ID'
  WHEN age < 18 OR age > 100 THEN 'INVALID_AGE_OUT_OF_BOUNDS' END AS rejection_reason
FROM (SELECT *, row_number() OVER (PARTITION BY customer_id ORDER BY src_seq) AS rn
      FROM clean_customers)"""

CTES["checked_products"] = """
SELECT * EXCLUDE rn, CASE WHEN rn > 1 THEN 'DUPLICATE_PRODUCT_ID'
  WHEN category IS NULL THEN 'MISSING_PRODUCT_CATEGORY'
  WHEN cost IS NULL THEN 'MISSING_PRODUCT_COST'
  WHEN price IS NULL OR price <= 0 THEN 'INVALID_PRICE_NON_POSITIVE'
  WHEN cost <= 0 THEN 'INVALID_COST_NON_POSITIVE'
  WHEN cost > price THEN 'INVALID_COST_EXCEEDS_PRICE' END AS rejection_reason
FROM (SELECT *, row_number() OVER (PARTITION BY product_id ORDER BY src_seq) AS rn
      FROM clean_products)"""

CTES["vc"] = "SELECT * EXCLUDE (rejection_reason, src_seq) FROM checked_customers WHERE rejection_reason IS NULL"
CTES["vp"] = "SELECT * EXCLUDE (rejection_reason, src_seq) FROM checked_products WHERE rejection_reason IS NULL"

CTES["checked_orders"] = """
SELECT o.* EXCLUDE rn, CASE WHEN rn > 1 THEN 'DUPLICATE_ORDER_ID'
  WHEN quantity < 0 THEN 'INVALID_QUANTITY_NEGATIVE_RETURN'
  WHEN quantity = 0 THEN 'INVALID_QUANTITY_ZERO'
  WHEN NOT EXISTS (SELECT 1 FROM vc WHERE vc.customer_id = o.customer_id)
    THEN 'ORPHAN_CUSTOMER_FOREIGN_KEY'
  WHEN NOT EXISTS (SELECT 1 FROM vp WHERE vp.product_id = o.product_id)
    THEN 'ORPHAN_PRODUCT_FOREIGN_KEY' END AS rejection_reason
FROM (SELECT *, row_number() OVER (PARTITION BY order_id ORDER BY src_seq) AS rn
      FROM clean_orders) o"""

CTES["vo"] = "SELECT * EXCLUDE (rejection_reason, src_seq) FROM checked_orders WHERE rejection_reason IS NULL"

CTES["reasons"] = """
SELECT 'customers' AS table_name, customer_id AS record_identifier, rejection_reason FROM checked_customers
UNION ALL SELECT 'products', product_id, rejection_reason FROM checked_products
UNION ALL SELECT 'orders', order_id, rejection_reason FROM checked_orders"""


def _payload(**columns: str) -> str:
    """JSON text of a row: quoted text and dates, bare numbers and booleans, null for NULL."""
    cells = []
    for name, kind in columns.items():
        value = f"CAST({name} AS VARCHAR)"
        quoted = f"'\"' || {value} || '\"'" if kind == "text" else value
        cells.append(f"'\"{name}\":' || COALESCE({quoted}, 'null')")
    return "'{' || " + " || ',' || ".join(cells) + " || '}'"


_PAYLOADS = {
    "customers": _payload(customer_id="text", name="text", gender="text", age="number", city="text", state="text",
                          signup_date="text", is_age_imputed="number"),
    "products": _payload(product_id="text", product_name="text", category="text", price="number", cost="number",
                         gross_margin_pct="number"),
    "orders": _payload(order_id="text", customer_id="text", product_id="text", order_date="text", quantity="number",
                       payment_method="text", order_status="text"),
}
CTES["dlq"] = "\nUNION ALL ".join(
    f"""SELECT '{t}' AS table_name, {t[:-1]}_id AS record_identifier, rejection_reason,
  TIMESTAMP '2001-08-02 00:00:00' AS rejected_at, {payload} AS raw_payload
FROM checked_{t} WHERE rejection_reason IS NOT NULL"""
    for t, payload in _PAYLOADS.items()
)

CTES["v"] = f"""
SELECT order_id, o.customer_id, o.product_id, order_date,
  strftime(order_date, '%Y') AS order_year, strftime(order_date, '%Y-%m') AS order_month,
  order_status, payment_method, quantity, price AS unit_price, cost AS unit_cost,
  CAST(quantity * price AS DECIMAL(18,2)) AS gross_revenue,
  CAST(quantity * cost AS DECIMAL(18,2)) AS total_cost,
  CAST(quantity * (price - cost) AS DECIMAL(18,2)) AS gross_profit,
  {rnd(f"({dbl('price - cost')} / {dbl('price')} * 100.0::DOUBLE)", 2)} AS margin_pct,
  CASE WHEN order_status IN ('Completed', 'Shipped') THEN 1 ELSE 0 END AS is_completed,
  CASE WHEN order_status = 'Refunded' THEN 1 ELSE 0 END AS is_refunded,
  CASE WHEN order_status = 'Cancelled' THEN 1 ELSE 0 END AS is_cancelled,
  CASE WHEN order_status IN ('Completed', 'Shipped') THEN CAST(quantity * price AS DECIMAL(18,2))
       ELSE 0 END AS net_revenue,
  CASE WHEN order_status IN ('Completed', 'Shipped') THEN CAST(quantity * (price - cost) AS DECIMAL(18,2))
       ELSE 0 END AS net_profit,
  CASE WHEN order_status = 'Refunded' THEN CAST(quantity * price AS DECIMAL(18,2)) ELSE 0 END
    AS refunded_amount,
  CASE WHEN order_status = 'Cancelled' THEN CAST(quantity * price AS DECIMAL(18,2)) ELSE 0 END
    AS cancelled_amount,
  name AS customer_name, gender AS customer_gender, age AS customer_age, city AS customer_city,
  state AS customer_state, signup_date AS customer_signup_date,
  is_age_imputed AS customer_is_age_imputed, product_name, category AS product_category
FROM vo o JOIN vc USING (customer_id) JOIN vp USING (product_id)"""


def _features(name: str, orders: str, customers: str, as_of: str, recent: str) -> None:
    """Feature CTEs <name>_agg and <name> over order lines ``orders``."""
    CTES[f"{name}_agg"] = f"""
SELECT customer_id, count(*) AS total_orders,
  count(*) FILTER (is_completed = 1) AS completed_orders,
  {big('SUM(CASE WHEN is_completed = 1 THEN quantity ELSE 0 END)')} AS total_units,
  COUNT(DISTINCT order_month) AS active_months,
  min(order_date) AS first_order_date, max(order_date) AS last_order_date,
  max(CASE WHEN is_completed = 1 THEN order_date END) AS last_completed_order_date,
  SUM(gross_revenue) AS total_gross_revenue, SUM(net_revenue) AS total_revenue,
  SUM(net_profit) AS total_profit, count(*) FILTER (is_refunded = 1) AS refund_count,
  SUM(refunded_amount) AS refund_amount, count(*) FILTER (is_cancelled = 1) AS cancellation_count,
  SUM(cancelled_amount) AS cancellation_amount,
  count(*) FILTER (is_completed = 1 AND {recent}) AS recent_order_count,
  SUM(CASE WHEN {recent} THEN net_revenue ELSE 0 END) AS recent_revenue
FROM {orders} GROUP BY customer_id"""
    CTES[f"{name}_base"] = f"""
SELECT c.*, COALESCE(total_orders, 0) AS total_orders, COALESCE(completed_orders, 0) AS completed_orders,
  COALESCE(total_units, 0) AS total_units, COALESCE(active_months, 0) AS active_months,
  first_order_date, last_order_date, last_completed_order_date,
  CAST(COALESCE(date_diff('day', last_completed_order_date, {as_of}), 999) AS INTEGER) AS recency_days,
  CAST(date_diff('day', signup_date, {as_of}) AS INTEGER) AS account_age_days,
  CAST(COALESCE(date_diff('day', first_order_date, last_order_date), 0) AS INTEGER)
    AS customer_lifetime_days,
  COALESCE(total_gross_revenue, 0) AS total_gross_revenue, COALESCE(total_revenue, 0) AS total_revenue,
  COALESCE(total_profit, 0) AS total_profit, COALESCE(refund_count, 0) AS refund_count,
  COALESCE(refund_amount, 0) AS refund_amount, COALESCE(cancellation_count, 0) AS cancellation_count,
  COALESCE(cancellation_amount, 0) AS cancellation_amount,
  COALESCE(recent_order_count, 0) AS recent_order_count, COALESCE(recent_revenue, 0) AS recent_revenue,
  greatest(COALESCE(total_revenue, 0) - COALESCE(recent_revenue, 0), 0) AS historical_revenue,
  greatest(COALESCE(completed_orders, 0) - COALESCE(recent_order_count, 0), 0) AS historical_order_count
FROM {customers} c LEFT JOIN {name}_agg USING (customer_id)"""

    def share(a: str, b: str, n: int, scale: str = "1.0") -> str:
        value = f"({dbl(a)} * {scale}::DOUBLE / {dbl(b)})"
        return f"CASE WHEN {b} > 0 THEN {rnd(value, n)} ELSE 0.0::DOUBLE END"

    trend = (
        f"(({dbl('recent_revenue')} - {dbl('historical_revenue')} / 3.0::DOUBLE) / "
        f"({dbl('total_revenue')} + 10.0::DOUBLE))"
    )
    freq = f"({dbl('completed_orders')} / ({dbl('account_age_days')} / 30.0::DOUBLE))"
    CTES[name] = f"""
SELECT *, {share('total_revenue', 'completed_orders', 2)} AS average_order_value,
  CASE WHEN account_age_days > 0 THEN {rnd(freq, 3)} ELSE 0.0::DOUBLE END AS order_frequency_monthly,
  {share('total_profit', 'total_revenue', 2, '100.0')} AS gross_margin_pct,
  {share('refund_count', 'total_orders', 4)} AS refund_rate,
  {share('cancellation_count', 'total_orders', 4)} AS cancellation_rate,
  {share('recent_revenue', 'total_revenue', 4)} AS recent_revenue_ratio,
  {share('recent_order_count', 'completed_orders', 4)} AS recent_order_ratio,
  CASE WHEN total_revenue > 0 THEN {rnd(trend, 4)} ELSE 0.0::DOUBLE END AS revenue_trend
FROM {name}_base"""


CTES["snap"] = "SELECT max(order_date) AS d FROM vo"
_features("feat", "v", "vc", "(SELECT d FROM snap)", "order_date > (SELECT d FROM snap) - 90")
_features("featv", "v", "vc", "DATE '2001-08-01'", "order_date >= DATE '2001-05-03'")
TEST_CUTOFF = "DATE '2001-05-03'"
CTES["v_upto"] = f"SELECT * FROM v WHERE order_date <= {TEST_CUTOFF}"
CTES["vc_upto"] = f"SELECT * FROM vc WHERE signup_date <= {TEST_CUTOFF}"
_features("featc", "v_upto", "vc_upto", TEST_CUTOFF, f"order_date > {TEST_CUTOFF} - 90")

TRAIN_CUTOFF = "DATE '2001-02-02'"
CTES["v_train"] = f"SELECT * FROM v WHERE order_date <= {TRAIN_CUTOFF}"
CTES["vc_train"] = f"SELECT * FROM vc WHERE signup_date <= {TRAIN_CUTOFF}"
_features("feat_train", "v_train", "vc_train", TRAIN_CUTOFF, f"order_date > {TRAIN_CUTOFF} - 90")
CTES["churn_train"] = """
SELECT f.*, CASE WHEN EXISTS (SELECT 1 FROM v WHERE v.customer_id = f.customer_id AND is_completed = 1
    AND order_date BETWEEN DATE '2001-02-03' AND DATE '2001-05-03') THEN 0 ELSE 1 END AS is_churned
FROM feat_train f WHERE completed_orders >= 1"""
CTES["churn"] = """
SELECT f.*, CASE WHEN EXISTS (SELECT 1 FROM v WHERE v.customer_id = f.customer_id AND is_completed = 1
    AND order_date BETWEEN DATE '2001-05-04' AND DATE '2001-08-01') THEN 0 ELSE 1 END AS is_churned
FROM featc f WHERE completed_orders >= 1"""


def _risk(name: str, features: str) -> None:
    """Points and driver text are written as two separate CASE chains."""
    CTES[f"{name}_pts"] = f"""
SELECT *, CASE WHEN completed_orders = 0 THEN 85 ELSE least(100, greatest(0,
    (CASE WHEN recency_days > 365 THEN 40 WHEN recency_days > 180 THEN 25 WHEN recency_days > 90 THEN 15 ELSE 0 END)
  + (CASE WHEN historical_order_count >= 5 AND recent_order_count = 0 THEN 25
          WHEN historical_order_count >= 2 AND recent_order_count = 0 THEN 15 ELSE 0 END)
  + (CASE WHEN total_revenue > 3000 AND recency_days > 90 THEN 20
          WHEN total_revenue > 1500 AND recency_days > 90 THEN 10 ELSE 0 END)
  + (CASE WHEN refund_rate > 0.15::DOUBLE THEN 15 ELSE 0 END))) END AS risk_score
FROM {features}"""
    CTES[name] = f"""
SELECT * REPLACE (CAST(risk_score AS INTEGER) AS risk_score),
  CASE WHEN risk_score <= 24 THEN 'LOW' WHEN risk_score <= 49 THEN 'MEDIUM'
       WHEN risk_score <= 74 THEN 'HIGH' ELSE 'CRITICAL' END AS risk_level,
  CASE WHEN completed_orders = 0 THEN 'Unactivated Account (0 Completed Purchases)'
       WHEN recency_days > 365 THEN 'Severe Inactivity (>365 Days)'
       WHEN recency_days > 180 THEN 'High Inactivity (181-365 Days)'
       WHEN recency_days > 90 THEN 'Cooling Purchase Cadence (91-180 Days)'
       WHEN historical_order_count >= 5 AND recent_order_count = 0 THEN 'Discontinued Repeat Purchase Cadence'
       WHEN historical_order_count >= 2 AND recent_order_count = 0 THEN 'Zero Orders in Last 90 Days'
       WHEN refund_rate > 0.15::DOUBLE
         THEN 'High Return Friction (' || printf('%.1f', refund_rate * 100) || '% Refund Rate)'
       ELSE 'Healthy Engagement Cadence' END AS key_risk_driver,
  CASE WHEN risk_score >= 75 THEN 'High-Touch Re-engagement / VIP Concierge Win-Back Promo'
       WHEN risk_score >= 50 THEN 'Automated Multi-Channel Retention Flow (15% Reactivation Offer)'
       WHEN risk_score >= 25 THEN 'Personalized Cross-Sell Campaign & Replenishment Nudge'
       ELSE 'Loyalty Points Acceleration & Exclusive Product Previews' END AS recommended_action
FROM {name}_pts"""


def avg_pct_rank(c: str) -> str:
    return (
        f"((rank() OVER (ORDER BY {c}) + (count(*) OVER (PARTITION BY {c}) - 1) / 2.0::DOUBLE)"
        f" / CAST(count(*) OVER () AS DOUBLE))"
    )


def _bin(p: str) -> str:
    return (
        f"CASE WHEN {p} <= 0.2::DOUBLE THEN 1 WHEN {p} <= 0.4::DOUBLE THEN 2 "
        f"WHEN {p} <= 0.6::DOUBLE THEN 3 WHEN {p} <= 0.8::DOUBLE THEN 4 ELSE 5 END"
    )


CTES["paying"] = f"""
SELECT customer_id, 1.0::DOUBLE - {avg_pct_rank('recency_days')} AS rp,
  {avg_pct_rank('completed_orders')} AS fp, {avg_pct_rank('total_revenue')} AS mp
FROM feat WHERE completed_orders > 0"""
CTES["rfm_scored"] = f"""
SELECT f.*, CAST(CASE WHEN rp IS NULL THEN 0 ELSE {_bin('rp')} END AS INTEGER) AS r_score,
  CAST(CASE WHEN fp IS NULL THEN 0 ELSE {_bin('fp')} END AS INTEGER) AS f_score,
  CAST(CASE WHEN mp IS NULL THEN 0 ELSE {_bin('mp')} END AS INTEGER) AS m_score
FROM feat f LEFT JOIN paying USING (customer_id)"""
CTES["rfm"] = """
SELECT *, CAST(r_score AS VARCHAR) || CAST(f_score AS VARCHAR) || CAST(m_score AS VARCHAR) AS rfm_score,
  CASE WHEN f_score = 0 OR completed_orders = 0 THEN 'Inactive / Unactivated'
       WHEN r_score >= 4 AND f_score >= 4 AND m_score >= 4 THEN 'Champions'
       WHEN r_score = 1 AND f_score >= 4 AND m_score >= 4 THEN 'Cannot Lose Them'
       WHEN r_score <= 2 AND f_score >= 3 AND m_score >= 3 THEN 'At Risk'
       WHEN r_score >= 3 AND f_score >= 3 AND m_score >= 3 THEN 'Loyal Customers'
       WHEN r_score >= 4 AND f_score IN (2, 3) THEN 'Potential Loyalists'
       WHEN r_score >= 4 AND f_score = 1 THEN 'New Customers'
       WHEN r_score <= 2 AND f_score <= 2 AND m_score <= 2 THEN 'Hibernating'
       ELSE 'Promising' END AS customer_segment
FROM rfm_scored"""
_risk("scored", "rfm")
_risk("scoredc", "churn")
CTES["score_table"] = """
SELECT customer_id, is_churned, CAST(risk_score AS DOUBLE) / 100.0::DOUBLE AS churn_probability
FROM scoredc"""

_NAMES = list(CTES)


def with_ctes(sql: str) -> str:
    """Prefix the query with exactly the CTEs it needs, in definition order."""
    needed: set[str] = set()

    def visit(text: str) -> None:
        for name in _NAMES:
            if name not in needed and re.search(rf"\b(FROM|JOIN|,)\s+{name}\b", text):
                needed.add(name)
                visit(CTES[name])

    visit(sql)
    parts = [f"{name} AS ({CTES[name]})" for name in _NAMES if name in needed]
    if not parts:
        return sql
    glue = ", " if sql.lstrip().upper().startswith("WITH ") else " "
    body = sql.lstrip()[5:] if glue == ", " else sql
    return "WITH " + ",\n".join(parts) + glue + body
