"""One SQL text per registered query that SQL can express."""

from __future__ import annotations

from oracle.base import avg_pct_rank, big, dbl, pct, ratio, rnd, scaled, with_ctes

Q: dict[str, str] = {}

# ------------------------------------------------------------- cleaning and validation
_CUST = "src_seq, customer_id, name, gender, age, city, state, signup_date, is_age_imputed"
_PROD = f"src_seq, product_id, product_name, category, {dbl('price')} AS price, {dbl('cost')} AS cost, gross_margin_pct"
_ORD = "order_id, customer_id, product_id, order_date, quantity, payment_method, order_status"
Q["cln_customers"] = f"SELECT {_CUST} FROM clean_customers"
Q["cln_products"] = f"SELECT {_PROD} FROM clean_products"
Q["cln_orders"] = f"SELECT CAST(src_seq AS VARCHAR) AS src_seq, {_ORD} FROM clean_orders"
Q["cln12_customer_stats"] = """SELECT count(*) AS input_rows,
  count(*) FILTER (is_age_imputed) AS ages_imputed, count(*) FILTER (gender = 'Unknown') AS unknown_genders,
  (SELECT med FROM age_median) AS median_imputed_age FROM clean_customers"""
Q["cln12_product_stats"] = f"""SELECT count(*) AS input_rows,
  count(*) FILTER (category IS NULL) AS missing_categories, count(*) FILTER (cost IS NULL) AS missing_costs,
  {rnd(ratio('SUM(CAST(gross_margin_pct AS DECIMAL(18,2)))', 'count(gross_margin_pct)'), 4)} AS average_margin_pct
  FROM clean_products"""
Q["cln12_order_stats"] = """SELECT count(*) AS input_rows,
  count(*) FILTER (payment_method = 'Unknown') AS unknown_payment_methods FROM clean_orders"""
Q["cln12_status_distribution"] = (
    "SELECT order_status, count(*) AS order_count FROM clean_orders GROUP BY order_status"
)
Q["val1_customers"] = f"SELECT {_CUST}, rejection_reason FROM checked_customers"
Q["val3_products"] = f"SELECT {_PROD}, rejection_reason FROM checked_products"
Q["val4_orders"] = f"SELECT CAST(src_seq AS VARCHAR) AS src_seq, {_ORD}, rejection_reason FROM checked_orders"
Q["val6_valid_orders"] = f"SELECT {_ORD} FROM vo"
Q["val7_dead_letters"] = "SELECT * FROM dlq"
Q["val8_reason_counts"] = (
    "SELECT table_name, rejection_reason, count(*) AS n FROM dlq GROUP BY table_name, rejection_reason"
)
_STATS = f"""SELECT table_name, count(*) AS total_input, count(*) FILTER (rejection_reason IS NULL) AS valid_count,
  count(rejection_reason) AS rejected_count, {pct('count(*) FILTER (rejection_reason IS NULL)', 'count(*)')} AS pass_rate_pct
  FROM reasons GROUP BY table_name"""
Q["val9_table_stats"] = _STATS


def _constraints() -> str:
    required = {
        "customers": ("name", "gender", "age", "city", "state", "signup_date", "is_age_imputed"),
        "products": ("product_name", "category", "price", "cost", "gross_margin_pct"),
        "orders": ("customer_id", "product_id", "order_date", "quantity", "payment_method", "order_status"),
    }
    broken = {
        "customers": {"age_between_18_and_120": "age < 18 OR age > 120"},
        "products": {"price_positive": "price <= 0", "cost_positive": "cost <= 0",
                     "cost_at_most_price": "cost > price"},
        "orders": {"quantity_positive": "quantity <= 0", "status_in_domain":
                   "order_status NOT IN ('Completed', 'Shipped', 'Cancelled', 'Refunded')"},
    }
    ids = {"customers": "customer_id", "products": "product_id", "orders": "order_id"}
    parts = []
    for table, columns in required.items():
        rules = {**{f"{c}_not_null": f"{c} IS NULL" for c in columns}, **broken[table]}
        for rule, cond in rules.items():
            parts.append(f"SELECT '{table}' AS table_name, '{rule}' AS rule, "
                         f"count(*) FILTER ({cond}) AS violations FROM clean_{table}")
        key = ids[table]
        parts.append(f"SELECT '{table}', 'primary_key', count(*) - count(DISTINCT {key}) FROM clean_{table}")
    for key, parent in (("customer_id", "customers"), ("product_id", "products")):
        parts.append(f"SELECT 'orders', '{key}_foreign_key', count(*) FROM clean_orders o WHERE {key} IS NOT NULL "
                     f"AND NOT EXISTS (SELECT 1 FROM clean_{parent} p WHERE p.{key} = o.{key})")
    return "\nUNION ALL ".join(parts)


Q["val10_declared_constraints"] = _constraints()

# ------------------------------------------------------------------------------- facts
_MONEY_V = ("unit_price", "unit_cost", "gross_revenue", "total_cost", "gross_profit", "net_revenue",
            "net_profit", "refunded_amount", "cancelled_amount")
Q["fct1_order_view"] = (
    "SELECT * REPLACE (" + ", ".join(f"{dbl(c)} AS {c}" for c in _MONEY_V) + ") FROM v"
)
_FACT = ("unit_price", "unit_cost", "gross_revenue", "gross_profit", "net_revenue", "net_profit",
         "refunded_amount", "cancelled_amount")
Q["fct2_star_fact"] = f"""SELECT order_id, customer_id, product_id, order_date,
  CAST(strftime(order_date, '%Y%m%d') AS INTEGER) AS order_date_id, quantity,
  {', '.join(f'{dbl(c)} AS {c}' for c in _FACT)}, payment_method, order_status,
  is_completed, is_refunded, is_cancelled FROM v"""

# ----------------------------------------------------------------------------- reports
_C_UNITS = big("SUM(CASE WHEN is_completed = 1 THEN quantity ELSE 0 END)")
Q["rpt01_executive_scorecard"] = f"""SELECT count(order_id) AS total_order_volume,
  {big('SUM(quantity)')} AS total_gross_units, {big('SUM(is_completed)')} AS completed_order_count,
  {big('SUM(is_refunded)')} AS refunded_order_count, {big('SUM(is_cancelled)')} AS cancelled_order_count,
  {pct('SUM(is_completed)', 'count(order_id)')} AS fulfillment_rate_pct,
  {pct('SUM(is_refunded)', 'count(order_id)')} AS refund_rate_pct,
  {pct('SUM(is_cancelled)', 'count(order_id)')} AS cancellation_rate_pct,
  {dbl('SUM(gross_revenue)')} AS total_gross_invoiced_revenue,
  {dbl('SUM(refunded_amount)')} AS total_refunded_amount,
  {dbl('SUM(cancelled_amount)')} AS total_cancelled_amount,
  {dbl('SUM(net_revenue)')} AS total_net_realized_revenue,
  {dbl('SUM(CASE WHEN is_completed = 1 THEN total_cost ELSE 0 END)')} AS total_realized_cogs,
  {dbl('SUM(net_profit)')} AS total_net_profit,
  {scaled('SUM(net_profit)', 'SUM(net_revenue)')} AS realized_gross_margin_pct,
  {rnd(ratio('SUM(net_revenue)', 'SUM(is_completed)'), 2)} AS average_order_value_aov FROM v"""


def _trend(key: str, prefix: str, prev: str, growth: str, extra: str = "") -> str:
    rev = f"{prefix}_net_revenue"
    return f"""WITH p AS (SELECT {key}, {big('SUM(is_completed)')} AS completed_orders, {_C_UNITS} AS completed_units,
    SUM(net_revenue) AS rev, SUM(net_profit) AS prof FROM v GROUP BY {key}),
  q AS (SELECT *, lag(rev) OVER (ORDER BY {key}) AS prev, SUM(rev) OVER (ORDER BY {key}) AS cum FROM p)
SELECT {key}, completed_orders, completed_units, {dbl('rev')} AS {rev}, {dbl('prof')} AS {prefix}_net_profit,
  {scaled('prof', 'rev')} AS {prefix}_margin_pct, {rnd(ratio('rev', 'completed_orders'), 2)} AS {prefix}_aov,
  {dbl('prev')} AS {prev}, {pct('rev - prev', 'prev')} AS {growth}{extra} FROM q"""


Q["rpt02_monthly_trend"] = _trend("order_month", "monthly", "prev_month_net_revenue", "mom_revenue_growth_pct",
                                  f", {dbl('cum')} AS cumulative_run_rate_revenue")
Q["rpt03_annual_trend"] = _trend("order_year", "annual", "prev_year_revenue", "yoy_revenue_growth_pct")
Q["rpt04_status_funnel"] = f"""WITH p AS (SELECT order_status, count(order_id) AS order_count,
    {big('SUM(quantity)')} AS total_quantity, SUM(gross_revenue) AS g, count(gross_revenue) AS lines FROM v GROUP BY order_status)
SELECT order_status, order_count, {pct('order_count', 'SUM(order_count) OVER ()')} AS pct_of_total_orders, total_quantity,
  {dbl('g')} AS total_invoiced_gross_revenue, {pct('g', 'SUM(g) OVER ()')} AS pct_of_total_revenue,
  {rnd(ratio('g', 'lines'), 2)} AS avg_order_gross_value FROM p"""
Q["rpt05_payment_mix"] = f"""WITH p AS (SELECT payment_method, {big('SUM(is_completed)')} AS n, SUM(net_revenue) AS r FROM v GROUP BY payment_method)
SELECT payment_method, n AS completed_transactions, {pct('n', 'SUM(n) OVER ()')} AS pct_of_transactions,
  {dbl('r')} AS realized_revenue, {pct('r', 'SUM(r) OVER ()')} AS pct_of_realized_revenue,
  {rnd(ratio('r', 'n'), 2)} AS average_ticket_size FROM p"""
Q["rpt06_category_matrix"] = f"""WITH p AS (SELECT product_category, count(DISTINCT product_id) AS active_products,
    {big('SUM(is_completed)')} AS completed_orders, {_C_UNITS} AS units_sold, SUM(net_revenue) AS r, SUM(net_profit) AS pr
    FROM v GROUP BY product_category)
SELECT product_category, active_products, completed_orders, units_sold, {dbl('r')} AS total_net_revenue,
  {pct('r', 'SUM(r) OVER ()')} AS category_revenue_share_pct, {dbl('pr')} AS total_net_profit,
  {pct('pr', 'SUM(pr) OVER ()')} AS category_profit_share_pct, {scaled('pr', 'r')} AS realized_gross_margin_pct,
  {rnd(ratio('r', 'units_sold'), 2)} AS avg_realized_price_per_unit FROM p"""
_PSUM = f"""WITH p AS (SELECT product_id, product_name, product_category, unit_price, unit_cost,
    {big('SUM(is_completed)')} AS completed_orders, {_C_UNITS} AS total_units_sold, SUM(net_revenue) AS r, SUM(net_profit) AS pr
    FROM v GROUP BY ALL)"""
_PCOLS = f"""product_id, product_name, product_category, {dbl('unit_price')} AS unit_price, {dbl('unit_cost')} AS unit_cost,
  completed_orders, {dbl('r')} AS product_net_revenue, {dbl('pr')} AS product_net_profit,
  {scaled('pr', 'r')} AS realized_margin_pct"""
Q["rpt07_top_products"] = f"""{_PSUM}
SELECT CAST(dense_rank() OVER (ORDER BY r DESC) AS INTEGER) AS revenue_rank, {_PCOLS}, total_units_sold,
  {pct('r', 'SUM(r) OVER ()')} AS share_of_total_catalog_revenue FROM p ORDER BY r DESC, product_id LIMIT 15"""
Q["rpt08_bottom_products"] = f"""{_PSUM}
SELECT CAST(dense_rank() OVER (ORDER BY r) AS INTEGER) AS tail_rank, {_PCOLS}, total_units_sold
FROM p ORDER BY r, product_id LIMIT 15"""
Q["rpt09_product_pareto"] = f"""WITH p AS (SELECT product_id, product_name, product_category, SUM(net_revenue) AS r
    FROM v WHERE is_completed = 1 GROUP BY ALL),
  k AS (SELECT *, row_number() OVER (ORDER BY r DESC, product_id) AS rn, count(*) OVER () AS n, SUM(r) OVER () AS tot,
    SUM(r) OVER (ORDER BY r DESC, product_id ROWS UNBOUNDED PRECEDING) AS cum FROM p)
SELECT rn AS product_rank, product_id, product_name, product_category, {dbl('r')} AS net_revenue,
  {pct('rn', 'n')} AS cumulative_product_pct, {pct('cum', 'tot')} AS cumulative_revenue_pct
FROM k WHERE rn IN (1, 10, 25, 50, 100, 150, 200, 250, 300, 350, 400, 450, n)"""
Q["rpt10_top_completed_products"] = f"""{_PSUM}
SELECT {_PCOLS} FROM p WHERE completed_orders > 0 ORDER BY r DESC, product_id LIMIT 5"""
Q["rpt11_customer_lifecycle"] = f"""WITH s AS (SELECT c.customer_id, count(order_id) AS o,
    COALESCE(SUM(is_completed), 0) AS d, SUM(net_revenue) AS r FROM vc c LEFT JOIN v ON c.customer_id = v.customer_id GROUP BY c.customer_id)
SELECT count(*) AS total_customers, count(*) FILTER (o > 0) AS active_customers_with_orders,
  count(*) FILTER (o = 0) AS dormant_customers_zero_orders, {pct('count(*) FILTER (o = 0)', 'count(*)')} AS zero_order_rate_pct,
  count(*) FILTER (d > 0) AS customers_with_completed_orders, count(*) FILTER (d = 1) AS one_time_buyers,
  count(*) FILTER (d >= 2) AS repeat_buyers, {pct('count(*) FILTER (d >= 2)', 'count(*) FILTER (d > 0)')} AS repeat_buyer_rate_pct,
  {dbl('SUM(r)')} AS total_realized_revenue,
  {rnd(ratio('SUM(r)', 'count(*) FILTER (d > 0)'), 2)} AS avg_revenue_per_paying_customer FROM s"""
_DAYS = "CAST(date_diff('day', max(order_date), DATE '2001-08-01') AS INTEGER)"
Q["rpt12_customer_ltv"] = f"""SELECT customer_id, customer_name, customer_gender, customer_city, customer_state,
  customer_signup_date AS signup_date, count(order_id) AS total_order_count, {big('SUM(is_completed)')} AS completed_order_count,
  {dbl('SUM(net_revenue)')} AS total_spend, {dbl('SUM(net_profit)')} AS total_profit,
  {rnd(ratio('SUM(net_revenue)', 'SUM(is_completed)'), 2)} AS average_order_value,
  min(order_date) AS first_order_date, max(order_date) AS last_order_date, {_DAYS} AS recency_days
FROM v WHERE is_completed = 1
GROUP BY customer_id, customer_name, customer_gender, customer_city, customer_state, customer_signup_date
ORDER BY SUM(net_revenue) DESC, customer_id LIMIT 100"""
_TILES = """SELECT customer_id, r AS customer_revenue, CAST(ntile(10) OVER (ORDER BY r DESC, customer_id) AS INTEGER) AS revenue_decile
  FROM (SELECT customer_id, SUM(net_revenue) AS r FROM v WHERE is_completed = 1 GROUP BY customer_id)"""
Q["rpt13_customer_pareto"] = f"""WITH t AS ({_TILES}),
  d AS (SELECT revenue_decile, count(*) AS customer_count, SUM(customer_revenue) AS r, min(customer_revenue) AS lo,
    max(customer_revenue) AS hi FROM t GROUP BY revenue_decile)
SELECT revenue_decile, customer_count, {dbl('r')} AS decile_revenue, {dbl('lo')} AS min_spend_in_decile,
  {dbl('hi')} AS max_spend_in_decile, {pct('r', 'SUM(r) OVER ()')} AS pct_of_total_revenue,
  {pct('SUM(r) OVER (ORDER BY revenue_decile)', 'SUM(r) OVER ()')} AS cumulative_revenue_pct FROM d"""
Q["rpt14_top_customers"] = f"""SELECT customer_id, customer_name, customer_city, customer_state, customer_signup_date,
  count(order_id) AS completed_orders, {dbl('SUM(net_revenue)')} AS total_revenue, {dbl('SUM(net_profit)')} AS total_profit,
  {scaled('SUM(net_profit)', 'SUM(net_revenue)')} AS realized_margin_pct,
  {rnd(ratio('SUM(net_revenue)', 'count(order_id)'), 2)} AS avg_order_value
FROM v WHERE is_completed = 1
GROUP BY customer_id, customer_name, customer_city, customer_state, customer_signup_date
ORDER BY SUM(net_revenue) DESC, customer_id LIMIT 20"""
Q["rpt15_dormant_customers"] = f"""WITH a AS (SELECT customer_id, customer_name, customer_state, customer_signup_date,
    count(order_id) AS lifetime_completed_orders, SUM(net_revenue) AS r, max(order_date) AS last_purchase_date,
    {_DAYS} AS days_since_last_purchase FROM v WHERE is_completed = 1
    GROUP BY customer_id, customer_name, customer_state, customer_signup_date)
SELECT * EXCLUDE r, {dbl('r')} AS lifetime_revenue,
  CASE WHEN days_since_last_purchase > 365 THEN 'Severe Churn (>1 Year)'
       WHEN days_since_last_purchase > 180 THEN 'High Inactivity (6-12 Months)'
       WHEN days_since_last_purchase > 90 THEN 'Moderate Inactivity (3-6 Months)' ELSE 'Active (<90 Days)' END AS inactivity_tier
FROM a WHERE days_since_last_purchase > 180 ORDER BY r DESC, customer_id LIMIT 50"""
Q["rpt16_activity_cohorts"] = f"""WITH a AS (SELECT customer_id, SUM(net_revenue) AS r, {_DAYS} AS d FROM v WHERE is_completed = 1 GROUP BY customer_id),
  b AS (SELECT CASE WHEN d > 365 THEN 'Dormant (>365d)' WHEN d > 180 THEN 'At-Risk (181-365d)'
    WHEN d > 90 THEN 'Cooling (91-180d)' ELSE 'Active (<=90d)' END AS activity_cohort, count(*) AS customer_count, SUM(r) AS r FROM a GROUP BY 1)
SELECT activity_cohort, customer_count, {dbl('r')} AS cohort_historical_spend, {pct('r', 'SUM(r) OVER ()')} AS pct_of_cumulative_spend FROM b"""
Q["rpt17_leakage"] = f"""SELECT count(order_id) AS total_orders, {dbl('SUM(gross_revenue)')} AS gross_revenue,
  {dbl('SUM(refunded_amount)')} AS refunded_amount, {pct('SUM(refunded_amount)', 'SUM(gross_revenue)')} AS refund_revenue_rate_pct,
  {dbl('SUM(cancelled_amount)')} AS cancelled_amount, {pct('SUM(cancelled_amount)', 'SUM(gross_revenue)')} AS cancellation_revenue_rate_pct,
  {dbl('SUM(net_revenue)')} AS net_revenue FROM v"""
Q["rpt18_leakage_by_category"] = f"""SELECT product_category, {dbl('SUM(refunded_amount)')} AS refunded_amount,
  {dbl('SUM(cancelled_amount)')} AS cancelled_amount, {dbl('SUM(refunded_amount) + SUM(cancelled_amount)')} AS leaked_amount
FROM v GROUP BY product_category"""
Q["rpt19_dq_throughput"] = f"""WITH s AS (SELECT table_name, count(*) AS total, count(*) FILTER (rejection_reason IS NULL) AS ok,
    count(rejection_reason) AS bad FROM reasons GROUP BY table_name)
SELECT table_name, ok AS valid_count, bad AS quarantined_in_dlq, total AS total_extracted_records,
  {pct('ok', 'total')} AS data_quality_pass_rate_pct, {pct('bad', 'total')} AS rejection_quarantine_rate_pct FROM s"""
Q["rpt20_dlq_root_causes"] = f"""WITH c AS (SELECT table_name, rejection_reason, count(*) AS n, min(rejected_at) AS lo,
    max(rejected_at) AS hi FROM dlq GROUP BY table_name, rejection_reason)
SELECT table_name, rejection_reason, n AS quarantined_record_count, {pct('n', 'SUM(n) OVER ()')} AS pct_of_total_dlq,
  lo AS first_rejection_timestamp, hi AS last_rejection_timestamp FROM c"""
Q["rpt22_run_scorecard"] = f"""WITH s AS ({_STATS}),
  c AS (SELECT table_name, rejection_reason, count(*) AS n FROM dlq GROUP BY table_name, rejection_reason)
SELECT 'throughput' AS section, table_name, CAST(NULL AS VARCHAR) AS rejection_reason, total_input, valid_count, rejected_count,
  pass_rate_pct AS pct FROM s
UNION ALL SELECT 'dead_letters', table_name, rejection_reason, NULL, NULL, n, {rnd(pct('n', 'SUM(n) OVER ()'), 1)} FROM c"""
Q["rpt23_population_scorecard"] = f"""SELECT count(*) AS total_customers, count(*) FILTER (completed_orders > 0) AS active_customers,
  count(*) FILTER (completed_orders = 0) AS unactivated_customers, {dbl('SUM(total_revenue)')} AS total_net_revenue,
  {dbl('SUM(total_profit)')} AS total_net_profit FROM feat"""
Q["rpt24_seasonal_averages"] = f"""WITH m AS (SELECT order_month, SUM(net_revenue) AS r FROM v GROUP BY order_month),
  s AS (SELECT CASE substr(order_month, 6) WHEN '11' THEN 'Nov-Dec' WHEN '12' THEN 'Nov-Dec' WHEN '01' THEN 'Jan-Feb'
    WHEN '02' THEN 'Jan-Feb' WHEN '03' THEN NULL WHEN '10' THEN NULL ELSE 'Apr-Sep' END AS season, r FROM m)
SELECT season, count(*) AS months, {rnd(ratio('SUM(r)', 'count(*)'), 2)} AS avg_monthly_net_revenue
FROM s WHERE season IS NOT NULL GROUP BY season"""
Q["rpt25_customer_table"] = f"""SELECT customer_id, name, age, state, customer_segment, risk_level, {dbl('total_revenue')} AS total_revenue,
  CASE WHEN age < 35 THEN '25-34' WHEN age < 45 THEN '35-44' ELSE '45-54' END AS age_group
FROM scored WHERE customer_segment IN ('Champions', 'At Risk', 'Cannot Lose Them')
  AND risk_level IN ('HIGH', 'CRITICAL', 'LOW') AND age >= 25 AND age < 55"""

# ---------------------------------------------------------------------------- features
_MONEY_F = ("total_gross_revenue", "total_revenue", "total_profit", "refund_amount",
            "cancellation_amount", "recent_revenue", "historical_revenue")
_FEAT = "* REPLACE (" + ", ".join(f"{dbl(c)} AS {c}" for c in _MONEY_F) + ")"
Q["fea_customer_features"] = f"SELECT {_FEAT} FROM feat"
Q["fea1_features_at_cutoff"] = f"SELECT {_FEAT} FROM featc"
_OPEN = {  # ratio -> (numerator, denominator, digits, scale) of the NULL-keeping flavour
    "average_order_value": ("total_revenue", "completed_orders", 2, 1.0),
    "gross_margin_pct": ("total_profit", "total_revenue", 2, 100.0),
    "refund_rate": ("refund_count", "total_orders", 4, 1.0),
    "cancellation_rate": ("cancellation_count", "total_orders", 4, 1.0),
    "recent_revenue_ratio": ("recent_revenue", "total_revenue", 4, 1.0),
    "recent_order_ratio": ("recent_order_count", "completed_orders", 4, 1.0),
}
Q["fea16_feature_view"] = (
    "SELECT * EXCLUDE (name, is_age_imputed, revenue_trend) REPLACE ("
    + ", ".join(f"{dbl(c)} AS {c}" for c in _MONEY_F)
    + "".join(
        f", {rnd(f'({dbl(a)} * {s}::DOUBLE / NULLIF({dbl(b)}, 0))', n)} AS {name}"
        for name, (a, b, n, s) in _OPEN.items()
    )
    + f", {rnd(ratio('completed_orders', '(' + dbl('account_age_days') + ' / 30.0::DOUBLE)'), 3)} AS order_frequency_monthly"
    + "), name AS customer_name FROM featv"
)
Q["fea17_churn_dataset"] = f"SELECT {_FEAT} FROM churn"
Q["fea17_train_dataset"] = f"SELECT {_FEAT} FROM churn_train"
Q["fea17_churn_metadata"] = f"""SELECT '2001-05-03' AS feature_cutoff, '2001-05-04' AS outcome_start, '2001-08-01' AS outcome_end,
  count(*) AS eligible_customers, count(*) FILTER (is_churned = 1) AS churned_customers,
  count(*) FILTER (is_churned = 0) AS retained_customers,
  {scaled('count(*) FILTER (is_churned = 1)', 'count(*)')} AS churn_rate_pct,
  {rnd(ratio('count(*) FILTER (is_churned = 1)', 'greatest(1, count(*) FILTER (is_churned = 0))'), 2)} AS imbalance_ratio FROM churn"""
Q["fea18_labelled_cohort"] = f"""WITH h AS (SELECT customer_id, count(*) AS o, {big('SUM(is_completed)')} AS hist_completed_orders,
    SUM(net_revenue) AS r, SUM(net_profit) AS p, max(CASE WHEN is_completed = 1 THEN order_date END) AS last_d, SUM(is_refunded) AS rf
    FROM v_upto GROUP BY customer_id),
  x AS (SELECT customer_id, count(*) AS n FROM v WHERE is_completed = 1
    AND order_date BETWEEN DATE '2001-05-04' AND DATE '2001-08-01' GROUP BY customer_id)
SELECT h.customer_id, c.signup_date, hist_completed_orders,
  CAST(date_diff('day', last_d, DATE '2001-05-03') AS INTEGER) AS hist_recency_days, {dbl('r')} AS hist_net_revenue,
  {dbl('p')} AS hist_net_profit, {rnd(ratio('r', 'hist_completed_orders'), 2)} AS hist_aov, {rnd(ratio('rf', 'o'), 4)} AS hist_refund_rate,
  COALESCE(n, 0) AS outcome_completed_orders, CASE WHEN COALESCE(n, 0) = 0 THEN 1 ELSE 0 END AS is_churned
FROM h JOIN vc c ON h.customer_id = c.customer_id LEFT JOIN x ON h.customer_id = x.customer_id WHERE hist_completed_orders > 0"""

# ----------------------------------------------------------------------- segments, risk
Q["rfm1_scores"] = "SELECT customer_id, r_score, f_score, m_score, rfm_score, customer_segment FROM rfm"
Q["rfm4_segment_summary"] = f"""WITH s AS (SELECT customer_segment, count(*) AS n, SUM(total_revenue) AS r, SUM(total_profit) AS p,
    SUM(completed_orders) AS o, SUM(recency_days) AS d FROM rfm GROUP BY customer_segment)
SELECT customer_segment, n AS customer_count, {dbl('r')} AS total_revenue, {dbl('p')} AS total_profit,
  {rnd(ratio('r', 'n'), 2)} AS avg_revenue_per_customer, {rnd(ratio('o', 'n'), 1)} AS avg_completed_orders,
  {rnd(ratio('d', 'n'), 1)} AS avg_recency_days, {pct('n', 'SUM(n) OVER ()')} AS pct_of_customers,
  {pct('r', 'greatest(SUM(r) OVER (), 1)')} AS pct_of_revenue FROM s"""
Q["rfm5_concentration"] = f"""WITH s AS (SELECT customer_segment, count(*) AS n, SUM(total_revenue) AS r FROM rfm GROUP BY customer_segment),
  k AS (SELECT *, row_number() OVER (ORDER BY r DESC, customer_segment) AS rn FROM s)
SELECT {big('SUM(n) FILTER (rn <= 2)')} AS top_customers, {dbl('SUM(r) FILTER (rn <= 2)')} AS top_revenue,
  {pct('SUM(n) FILTER (rn <= 2)', 'SUM(n)')} AS pct_of_customers,
  {pct('SUM(r) FILTER (rn <= 2)', 'greatest(SUM(r), 1)')} AS pct_of_revenue FROM k"""
Q["rfm6_segment_profit"] = f"""SELECT customer_segment, {rnd(ratio('SUM(total_profit)', 'count(*)'), 2)} AS avg_profit_per_customer
FROM rfm GROUP BY customer_segment"""
Q["rsk1_scores"] = "SELECT customer_id, risk_score, risk_level, key_risk_driver, recommended_action FROM scored"
Q["rsk5_tier_summary"] = f"""WITH s AS (SELECT risk_level, count(*) AS n, SUM(total_revenue) AS r, SUM(recency_days) AS d,
    SUM(completed_orders) AS o FROM scored GROUP BY risk_level)
SELECT risk_level, n AS customer_count, {dbl('r')} AS total_revenue, {rnd(ratio('r', 'n'), 2)} AS avg_revenue,
  {rnd(ratio('d', 'n'), 1)} AS avg_recency, {rnd(ratio('o', 'n'), 1)} AS avg_completed_orders,
  {pct('n', 'SUM(n) OVER ()')} AS pct_of_customers, {pct('r', 'greatest(SUM(r) OVER (), 1)')} AS pct_of_revenue FROM s"""
Q["rsk6_exposure"] = f"""SELECT count(*) FILTER (risk_level IN ('HIGH', 'CRITICAL')) AS customers_at_risk,
  {dbl("SUM(CASE WHEN risk_level IN ('HIGH', 'CRITICAL') THEN total_revenue ELSE 0 END)")} AS revenue_at_risk FROM scored"""
Q["rsk7_intervention_list"] = f"""SELECT customer_id, name, customer_segment, {dbl('total_revenue')} AS total_revenue, recency_days,
  risk_score, risk_level, key_risk_driver, recommended_action FROM scored
WHERE risk_level IN ('HIGH', 'CRITICAL') ORDER BY scored.total_revenue DESC, customer_id LIMIT 50"""
_CELLS = ", ".join(
    f"count(*) FILTER (risk_level = '{t}') AS {t.lower()}_customers, "
    f"{dbl(f'''COALESCE(SUM(total_revenue) FILTER (risk_level = '{t}'), 0)''')} AS {t.lower()}_revenue"
    for t in ("CRITICAL", "HIGH", "MEDIUM", "LOW")
)
Q["ag13_segment_by_tier"] = f"SELECT customer_segment, {_CELLS} FROM scored GROUP BY customer_segment"
Q["wn6_customer_tiles"] = f"SELECT * REPLACE ({dbl('customer_revenue')} AS customer_revenue) FROM ({_TILES})"
Q["wn7_percent_rank"] = f"""SELECT customer_id, {dbl('total_revenue')} AS total_revenue,
  {avg_pct_rank('feat.total_revenue')} AS pct_rank FROM feat"""

# --------------------------------------------------------------------------------- star
_SPAN = """SELECT CAST(unnest(generate_series(date_trunc('year', min(order_date)),
  date_trunc('year', max(order_date)) + INTERVAL 1 YEAR - INTERVAL 1 DAY, INTERVAL 1 DAY)) AS DATE) AS date FROM vo"""
Q["str1_dim_date"] = f"""SELECT date, CAST(strftime(date, '%Y%m%d') AS INTEGER) AS date_id, strftime(date, '%Y-%m-%d') AS date_str,
  CAST(year(date) AS INTEGER) AS year, CAST(quarter(date) AS INTEGER) AS quarter, 'Q' || quarter(date) AS quarter_name,
  year(date) || '-Q' || quarter(date) AS year_quarter, CAST(month(date) AS INTEGER) AS month, strftime(date, '%B') AS month_name,
  strftime(date, '%b') AS month_short, strftime(date, '%Y-%m') AS month_year, CAST(day(date) AS INTEGER) AS day_of_month,
  CAST(isodow(date) AS INTEGER) AS day_of_week, strftime(date, '%A') AS day_name,
  CASE WHEN isodow(date) >= 6 THEN 1 ELSE 0 END AS is_weekend, 'FY' || year(date) AS fiscal_year, 'FQ' || quarter(date) AS fiscal_quarter
FROM ({_SPAN})"""
Q["str2_dim_products"] = f"""SELECT product_id, product_name, category, {dbl('price')} AS price, {dbl('cost')} AS cost,
  {rnd(f"({dbl('price - cost')} * 100.0::DOUBLE / {dbl('price')})", 2)} AS margin_pct FROM vp"""
Q["str3_dim_customers"] = """SELECT customer_id, name, gender, age, city, state, signup_date,
  CAST(strftime(signup_date, '%Y%m%d') AS INTEGER) AS signup_date_id, is_age_imputed FROM vc"""
Q["str6_reconciliation"] = f"""SELECT count(*) AS fact_orders_count, {dbl('SUM(net_revenue)')} AS total_net_revenue,
  {dbl('SUM(net_profit)')} AS total_net_profit, (SELECT count(*) FROM vc) AS dim_customers_count,
  (SELECT count(*) FROM vp) AS dim_products_count, (SELECT count(*) FROM ({_SPAN})) AS dim_date_count FROM v"""


# ----------------------------------------------------------------------------- measures
def _zero(a: str, b: str, n: int) -> str:
    return f"CASE WHEN {b} > 0 THEN {rnd(f'({dbl(a)} / {dbl(b)})', n)} ELSE 0.0::DOUBLE END"


def _measures(by: str, alias: str) -> str:
    key, group = (f"{by} AS {alias}, ", f"GROUP BY {by}") if by else ("", "")
    out = f"{alias}, " if by else ""
    return f"""WITH life AS (SELECT customer_id, SUM(is_completed) AS l FROM v GROUP BY customer_id),
  g AS (SELECT {key}SUM(gross_revenue) AS gr, SUM(net_revenue) AS nr, SUM(net_profit) AS np, {_C_UNITS} AS total_units_sold,
    count(*) AS total_orders, {big('SUM(is_completed)')} AS completed_orders, {big('SUM(is_refunded)')} AS refunded_orders,
    {big('SUM(is_cancelled)')} AS cancelled_orders, SUM(refunded_amount) AS ra, SUM(cancelled_amount) AS ca,
    count(DISTINCT CASE WHEN is_completed = 1 THEN v.customer_id END) AS active_customers,
    count(DISTINCT CASE WHEN is_completed = 1 AND l >= 2 THEN v.customer_id END) AS rep
    FROM v JOIN life ON v.customer_id = life.customer_id {group})
SELECT {out}{dbl('gr')} AS total_gross_revenue, {dbl('nr')} AS net_revenue, {dbl('np')} AS gross_profit, total_units_sold, total_orders,
  completed_orders, refunded_orders, cancelled_orders, {dbl('ra')} AS refunded_revenue, {dbl('ca')} AS cancelled_revenue,
  active_customers, (SELECT count(*) FROM vc) AS total_customers, {_zero('np', 'nr', 4)} AS gross_margin_pct,
  {_zero('refunded_orders', 'total_orders', 4)} AS refund_rate_pct, {_zero('cancelled_orders', 'total_orders', 4)} AS cancellation_rate_pct,
  {_zero('nr', 'completed_orders', 2)} AS average_order_value, {_zero('nr', 'active_customers', 2)} AS revenue_per_customer,
  {_zero('rep', 'active_customers', 4)} AS repeat_buyer_rate_pct FROM g"""


Q["msr_total"] = _measures("", "")
Q["msr_by_month"] = _measures("order_month", "month_year")
Q["msr_by_category"] = _measures("product_category", "category")
Q["msr_by_state"] = _measures("customer_state", "state")


def _grow(prior: str) -> str:
    value = rnd(f"({dbl(f'm.r - {prior}')} / {dbl(prior)})", 4)
    return f"CASE WHEN {prior} > 0 THEN {value} ELSE 0.0::DOUBLE END"


Q["msr19_time_intelligence"] = f"""WITH m AS (SELECT CAST(date_trunc('month', order_date) AS DATE) AS month, SUM(net_revenue) AS r FROM v GROUP BY 1)
SELECT m.month, {dbl('m.r')} AS net_revenue, {dbl('p.r')} AS net_revenue_prior_month, {_grow('p.r')} AS mom_growth_pct,
  {_grow('y.r')} AS yoy_growth_pct, {dbl('SUM(m.r) OVER (ORDER BY m.month)')} AS running_net_revenue
FROM m LEFT JOIN m p ON p.month = m.month - INTERVAL 1 MONTH LEFT JOIN m y ON y.month = m.month - INTERVAL 12 MONTH"""
Q["msr23_risk_measures"] = f"""SELECT count(*) FILTER (risk_level = 'HIGH') AS high_risk_customers,
  count(*) FILTER (risk_level = 'CRITICAL') AS critical_risk_customers,
  {dbl("SUM(CASE WHEN risk_level IN ('HIGH', 'CRITICAL') THEN total_revenue ELSE 0 END)")} AS historical_revenue_at_risk FROM scored"""

# ------------------------------------------------------------------------- data quality
_RAW = {
    "customers": {"customer_id": "string", "name": "string", "gender": "string", "age": "double", "city": "string",
                  "state": "string", "signup_date": "date"},
    "products": {"product_id": "string", "product_name": "string", "category": "string", "price": "decimal(18,2)",
                 "cost": "decimal(18,2)"},
    "orders": {"order_id": "string", "customer_id": "string", "product_id": "string", "order_date": "date",
               "quantity": "int", "payment_method": "string", "order_status": "string"},
}
_IDS = {"customers": "customer_id", "products": "product_id", "orders": "order_id"}
Q["dq1_table_profile"] = "\nUNION ALL ".join(
    f"SELECT '{t}' AS table_name, count(*) AS row_count, CAST({len(cols)} AS INTEGER) AS column_count, '{c}' AS column_name, "
    f"'{kind}' AS data_type, (SELECT CAST({c} AS VARCHAR) FROM raw_{t} WHERE {c} IS NOT NULL "
    f"ORDER BY src_seq, CAST({c} AS VARCHAR) LIMIT 1) AS sample_value FROM raw_{t}"
    for t, cols in _RAW.items() for c, kind in cols.items()
)
Q["dq2_null_profile"] = "\nUNION ALL ".join(
    f"SELECT '{t}' AS table_name, count(*) AS row_count, '{c}' AS column_name, count(*) - count({c}) AS null_count, "
    f"{pct(f'count(*) - count({c})', 'count(*)')} AS null_pct FROM raw_{t}"
    for t, cols in _RAW.items() for c in cols
)
Q["dq3_duplicates"] = "\nUNION ALL ".join(
    f"SELECT '{t}' AS table_name, count(*) - (SELECT count(*) FROM (SELECT DISTINCT {', '.join(cols)} FROM raw_{t})) AS exact_duplicates, "
    f"count(*) - count(DISTINCT {_IDS[t]}) AS duplicate_ids FROM raw_{t}"
    for t, cols in _RAW.items()
)
Q["dq4_quantity_profile"] = f"""WITH s AS (SELECT CASE WHEN quantity < 0 THEN 'negative' WHEN quantity = 0 THEN 'zero' WHEN quantity > 0 THEN 'positive'
    ELSE 'missing' END AS quantity_sign, count(*) AS n,
    array_to_string(list_sort(list(DISTINCT quantity) FILTER (quantity < 0)), ',') AS neg FROM raw_orders GROUP BY 1)
SELECT quantity_sign, n AS order_count, COALESCE(neg, '') AS negative_values, {pct('n', 'SUM(n) OVER ()')} AS pct_of_orders FROM s"""
_CAP = "upper(substr(order_status, 1, 1)) || lower(substr(order_status, 2))"
Q["dq5_raw_revenue"] = f"""WITH l AS (SELECT o.quantity AS q, o.quantity * p.price AS r, o.quantity * p.cost AS c
    FROM raw_orders o LEFT JOIN raw_products p ON o.product_id = p.product_id
    WHERE {_CAP} IN ('Completed', 'Shipped') AND o.quantity > 0)
SELECT count(*) AS completed_lines, {big('SUM(q)')} AS total_units_sold, {dbl('SUM(r)')} AS total_gross_revenue, {dbl('SUM(c)')} AS total_cost,
  {dbl('SUM(r - c)')} AS gross_profit, {scaled('SUM(r - c)', 'SUM(r)')} AS gross_margin_pct,
  {rnd(ratio('SUM(r)', 'count(r)'), 2)} AS average_order_value FROM l"""
Q["dq6_distributions"] = f"""WITH s AS (SELECT 'order_status' AS field, {_CAP} AS value, count(*) AS n FROM raw_orders GROUP BY 2
  UNION ALL SELECT 'payment_method', payment_method, count(*) FROM raw_orders GROUP BY 2)
SELECT field, value, n, {pct('n', 'SUM(n) OVER (PARTITION BY field)')} AS pct_of_rows FROM s"""
Q["dq7_foreign_keys"] = "\nUNION ALL ".join(
    f"""SELECT '{k}' AS relation, unique_keys, used_keys, unused_keys, orphan_keys, {pct('unused_keys', 'unique_keys')} AS unused_pct FROM (SELECT
  (SELECT count(DISTINCT {k}) FROM raw_{t}) AS unique_keys, (SELECT count(DISTINCT {k}) FROM raw_orders) AS used_keys,
  (SELECT count(DISTINCT {k}) FROM raw_{t} WHERE {k} NOT IN (SELECT {k} FROM raw_orders)) AS unused_keys,
  (SELECT count(DISTINCT {k}) FROM raw_orders WHERE {k} NOT IN (SELECT {k} FROM raw_{t})) AS orphan_keys)"""
    for t, k in (("customers", "customer_id"), ("products", "product_id"))
)
Q["dq8_temporal_violations"] = f"""WITH f AS (SELECT customer_id, arg_min(signup_date, src_seq) AS d FROM raw_customers GROUP BY customer_id)
SELECT count(*) AS orders_checked, count(*) FILTER (order_date < d) AS orders_before_signup
FROM raw_orders o LEFT JOIN f ON o.customer_id = f.customer_id"""
Q["dq9_reconciliation"] = """WITH c AS (SELECT table_name, count(*) FILTER (rejection_reason IS NULL) AS valid_count, count(rejection_reason) AS rejected_count
    FROM reasons GROUP BY table_name),
  r AS (SELECT 'customers' AS table_name, count(*) AS raw_count FROM raw_customers UNION ALL SELECT 'products', count(*) FROM raw_products
    UNION ALL SELECT 'orders', count(*) FROM raw_orders),
  j AS (SELECT table_name, raw_count, valid_count, rejected_count FROM r JOIN c USING (table_name)),
  a AS (SELECT * FROM j UNION ALL SELECT 'total', CAST(SUM(raw_count) AS BIGINT), CAST(SUM(valid_count) AS BIGINT), CAST(SUM(rejected_count) AS BIGINT) FROM j)
SELECT *, valid_count + rejected_count AS sum_valid_rejected, raw_count = valid_count + rejected_count AS reconciled,
  CASE WHEN table_name = 'orders' THEN (SELECT count(*) FROM v) END AS view_rows,
  CASE WHEN table_name = 'orders' THEN (SELECT count(*) FROM v) = valid_count END AS view_matches_valid FROM a"""
Q["dq10_orphan_root_causes"] = """SELECT product_id, count(*) AS referencing_orders, count(*) FILTER (quantity <= 0) AS orders_with_bad_quantity
FROM raw_orders WHERE product_id IN (SELECT product_id FROM raw_products) AND product_id NOT IN (SELECT product_id FROM vp) GROUP BY product_id"""
Q["dq11_negative_quantities"] = """SELECT quantity, order_status, count(*) AS order_count FROM raw_orders WHERE quantity < 0 GROUP BY quantity, order_status"""
Q["dq12_margin_divergence"] = f"""SELECT {rnd(f"max(abs(gross_margin_pct - ({dbl('price')} - {dbl('cost')}) / {dbl('price')} * 100.0::DOUBLE))", 6)} AS max_divergence,
  COALESCE(bool_or(gross_margin_pct < 0), false) AS any_negative, COALESCE(bool_or(gross_margin_pct > 100), false) AS any_above_100 FROM vp"""
Q["dq13_dead_letter_completeness"] = "\nUNION ALL ".join(
    f"SELECT '{c}_missing' AS rule, count(*) FILTER ({c} IS NULL OR trim(CAST({c} AS VARCHAR)) = '') AS violations FROM dlq"
    for c in ("table_name", "record_identifier", "rejection_reason", "rejected_at", "raw_payload")
) + "\nUNION ALL SELECT 'payload_not_json', count(*) FILTER (NOT json_valid(raw_payload)) FROM dlq"
Q["dq14_status_units"] = f"SELECT order_status, count(*) AS order_count, {big('SUM(quantity)')} AS total_units FROM vo GROUP BY order_status"
Q["dq14_refund_quantities"] = "SELECT quantity, count(*) AS order_count FROM vo WHERE order_status = 'Refunded' GROUP BY quantity"
Q["dq15_payload_fields"] = """SELECT rejection_reason, order_id, customer_id, product_id, quantity, order_status
FROM checked_orders WHERE rejection_reason IS NOT NULL"""
Q["dq16_revenue_identities"] = f"""WITH s AS (SELECT SUM(gross_revenue) AS g, SUM(net_revenue) AS n, SUM(refunded_amount) AS r, SUM(cancelled_amount) AS c,
    SUM(net_profit) AS p, SUM(CASE WHEN is_completed = 1 THEN total_cost ELSE 0 END) AS k,
    SUM(CASE WHEN order_status NOT IN ('Completed', 'Shipped', 'Refunded', 'Cancelled') THEN gross_revenue ELSE 0 END) AS o FROM v)
SELECT {dbl('g')} AS gross, {dbl('n')} AS net, {dbl('r')} AS refunded, {dbl('c')} AS cancelled, {dbl('p')} AS profit, {dbl('k')} AS cogs, {dbl('o')} AS other,
  {dbl('g - n - r - c')} AS gross_difference, {dbl('n - p - k')} AS net_difference FROM s"""
Q["dq17_cross_totals"] = "\nUNION ALL ".join(
    f"SELECT '{d}' AS dimension, count(DISTINCT {k}) AS members, {dbl('SUM(net_revenue)')} AS net_revenue, {dbl('SUM(net_profit)')} AS net_profit FROM v"
    for d, k in (("customer", "customer_id"), ("product", "product_id"), ("day", "order_date"), ("month", "order_month"))
)
Q["dq18_quarantine_isolation"] = "\nUNION ALL ".join(
    f"SELECT '{t}' AS table_name, count(*) AS leaked_rows FROM {v} WHERE {k} IN (SELECT record_identifier FROM dlq "
    f"WHERE table_name = '{t}' AND rejection_reason NOT LIKE 'DUPLICATE%')"
    for t, v, k in (("customers", "vc", "customer_id"), ("products", "vp", "product_id"), ("orders", "vo", "order_id"))
)
_D = f"({_SPAN})"
Q["dq19_star_integrity"] = f"""SELECT 'fact_without_customer' AS rule, count(*) AS violations FROM vo WHERE customer_id NOT IN (SELECT customer_id FROM vc)
UNION ALL SELECT 'fact_without_product', count(*) FROM vo WHERE product_id NOT IN (SELECT product_id FROM vp)
UNION ALL SELECT 'fact_without_date', count(*) FROM vo WHERE order_date NOT IN (SELECT date FROM {_D})
UNION ALL SELECT 'customer_without_analytics', count(*) FROM vc WHERE customer_id NOT IN (SELECT customer_id FROM feat)
UNION ALL SELECT 'analytics_without_customer', count(*) FROM feat WHERE customer_id NOT IN (SELECT customer_id FROM vc)
UNION ALL SELECT 'repeated_customer', count(*) - count(DISTINCT customer_id) FROM vc
UNION ALL SELECT 'repeated_product', count(*) - count(DISTINCT product_id) FROM vp
UNION ALL SELECT 'repeated_date', count(*) - count(DISTINCT date) FROM {_D}
UNION ALL SELECT 'repeated_order', count(*) - count(DISTINCT order_id) FROM vo"""
Q["dq20_view_completeness"] = """SELECT 'customer_name_blank' AS rule, count(*) FILTER (customer_name IS NULL OR trim(customer_name) = '') AS violations FROM v
UNION ALL SELECT 'product_name_blank', count(*) FILTER (product_name IS NULL OR trim(product_name) = '') FROM v
UNION ALL SELECT 'completed_flag_wrong', count(*) FILTER ((is_completed = 1) <> (order_status IN ('Completed', 'Shipped'))) FROM v"""
_BOUNDS = {
    "last_order_after_cutoff": "last_order_date > DATE '2001-05-03'",
    "signup_after_cutoff": "signup_date > DATE '2001-05-03'",
    **{f"{c}_negative": f"{c} < 0" for c in ("recency_days", "account_age_days", "customer_lifetime_days")},
    **{f"{c}_out_of_range": f"{c} < 0 OR {c} > 1"
       for c in ("refund_rate", "cancellation_rate", "recent_revenue_ratio", "recent_order_ratio")},
}
Q["dq21_feature_bounds"] = "\nUNION ALL ".join(
    f"SELECT '{rule}' AS rule, count(*) FILTER ({cond}) AS violations FROM featc" for rule, cond in _BOUNDS.items()
)
_DOMAINS = {
    "segment_missing": "customer_segment IS NULL",
    "segment_unknown": "customer_segment NOT IN ('Inactive / Unactivated', 'Champions', 'Cannot Lose Them', 'At Risk', "
                       "'Loyal Customers', 'Potential Loyalists', 'New Customers', 'Hibernating', 'Promising')",
    "unactivated_but_paying": "customer_segment = 'Inactive / Unactivated' AND completed_orders > 0",
    "paying_but_score_zero": "completed_orders > 0 AND f_score = 0",
    "score_out_of_range": "NOT (r_score BETWEEN 0 AND 5 AND f_score BETWEEN 0 AND 5 AND m_score BETWEEN 0 AND 5)",
    "inactive_score_not_000": "completed_orders = 0 AND rfm_score <> '000'",
}
Q["dq22_segment_domains"] = "\nUNION ALL ".join(
    f"SELECT '{rule}' AS rule, count(*) FILTER ({cond}) AS violations FROM rfm" for rule, cond in _DOMAINS.items()
)
Q["sl5_dead_letter_samples"] = """SELECT rejection_reason, any_value(table_name) AS table_name, min(record_identifier) AS record_identifier,
  substr(arg_min(raw_payload, (record_identifier, raw_payload)), 1, 120) AS payload_preview FROM dlq GROUP BY rejection_reason"""

# -------------------------------------------------------------------- model evaluation
_ONES = "count(*) FILTER (is_churned = 1)"


def _cells(t: str) -> dict[str, str]:
    hit = f"churn_probability >= {t}::DOUBLE"
    return {
        "tn": f"count(*) FILTER (NOT ({hit}) AND is_churned = 0)", "fp": f"count(*) FILTER ({hit} AND is_churned = 0)",
        "fn": f"count(*) FILTER (NOT ({hit}) AND is_churned = 1)", "tp": f"count(*) FILTER ({hit} AND is_churned = 1)",
    }


def _cm(t: str) -> str:
    return ", ".join(f"{sql} AS {name}" for name, sql in _cells(t).items())


_PREC, _REC, _F1 = _zero("tp", "tp + fp", 4), _zero("tp", "tp + fn", 4), _zero("2 * tp", "2 * tp + fp + fn", 4)
_PREC, _REC, _F1 = (x.replace("WHEN tp + fp >", "WHEN (tp + fp) >").replace("WHEN tp + fn >", "WHEN (tp + fn) >")
                    for x in (_PREC, _REC, _F1))
Q["chn5_rule_score_metrics"] = f"""WITH k AS (SELECT *, rank() OVER (ORDER BY churn_probability) +
    (count(*) OVER (PARTITION BY churn_probability) - 1) / 2.0::DOUBLE AS rk FROM score_table),
  a AS (SELECT SUM(CASE WHEN is_churned = 1 THEN rk ELSE 0 END) AS s, {dbl(_ONES)} AS p, {dbl('count(*)')} - {dbl(_ONES)} AS q, {_cm('0.5')} FROM k)
SELECT tn AS true_negative, fp AS false_positive, fn AS false_negative, tp AS true_positive,
  {_zero('tp + tn', '(tp + tn + fp + fn)', 4)} AS accuracy, {_PREC} AS precision, {_REC} AS recall, {_F1} AS f1,
  {rnd('(s - p * (p + 1) / 2.0::DOUBLE) / NULLIF(p * q, 0)', 4)} AS roc_auc FROM a"""
Q["chn6_rule_score_thresholds"] = "\nUNION ALL ".join(
    f"""SELECT {t}::DOUBLE AS threshold, {_PREC} AS precision, {_REC} AS recall, {_F1} AS f1, tp + fp AS targeted_count, fp AS false_alarms
FROM (SELECT {_cm(t)} FROM score_table)"""
    for t in ("0.3", "0.4", "0.5", "0.6", "0.7")
)

# A fit is no SQL; its proofs are: exact sums over the training rows, and rows without disagreement.
_INPUTS = """recency_days completed_orders total_revenue total_profit average_order_value active_months refund_rate
cancellation_rate recent_revenue_ratio recent_order_ratio revenue_trend customer_lifetime_days account_age_days
order_frequency_monthly""".split()
Q["chn2_scaler"] = "\nUNION ALL ".join(
    f"""SELECT '{c}' AS feature, n AS train_rows, {rnd('m', 4)} AS mean, {rnd('sqrt(greatest(q / n - m * m, 0))', 4)} AS deviation, TRUE AS scaler_agrees
FROM (SELECT count(*) AS n, {dbl(f'SUM(CAST({c} AS DECIMAL(18,4)))')} / {dbl('count(*)')} AS m,
  {dbl(f'SUM(CAST(CAST({c} AS DECIMAL(18,4)) AS DECIMAL(38,8)) * CAST({c} AS DECIMAL(18,4)))')} AS q FROM churn_train)"""
    for c in _INPUTS
)
Q["chn3_optimality"] = """SELECT count(*) AS train_rows, CAST(SUM(is_churned) AS BIGINT) AS churned_rows, TRUE AS weights_balanced,
  TRUE AS slopes_vanish FROM churn_train"""
Q["chn8_score_expression"] = "SELECT count(*) AS rows_scored, 0::BIGINT AS rows_apart, 0::BIGINT AS rows_out_of_range FROM vc"
Q["snk7_models_survive"] = f"SELECT 'logistic' AS model, * FROM ({Q['chn8_score_expression']}) UNION ALL SELECT 'forest', * FROM ({Q['chn8_score_expression']})"
Q["chn4_forest_table"] = "SELECT *, 100::BIGINT AS trees FROM (" + Q["chn8_score_expression"] + ")"

# ---------------------------------------------------------------------- sources and sinks
_ANALYTICS = """customer_id name gender age city state signup_date total_orders completed_orders total_units active_months
first_order_date last_order_date last_completed_order_date recency_days account_age_days customer_lifetime_days
total_gross_revenue total_revenue total_profit average_order_value order_frequency_monthly gross_margin_pct refund_count
refund_amount refund_rate cancellation_count cancellation_amount cancellation_rate recent_revenue recent_order_count
historical_revenue historical_order_count recent_revenue_ratio recent_order_ratio revenue_trend r_score f_score m_score
rfm_score customer_segment risk_score risk_level key_risk_driver recommended_action""".split()
_MONEY = """total_gross_revenue total_revenue total_profit refund_amount cancellation_amount recent_revenue
historical_revenue""".split()
Q["src1_csv_round_trip"] = f"""SELECT CAST(src_seq AS VARCHAR) AS src_seq, * EXCLUDE (src_seq) FROM (SELECT src_seq, {_ORD.replace("order_status", """
  CASE quantity WHEN 3 THEN order_status || chr(10) || '"x" ' || chr(92) || 'n' || chr(92) WHEN 4 THEN ''
  WHEN 5 THEN chr(13) || chr(10) || ',' ELSE order_status END AS order_status""")} FROM raw_orders)"""
Q["src2_extract_counts"] = """SELECT TIMESTAMP '2001-08-02 00:00:00' AS extracted_at, (SELECT count(*) FROM raw_customers) AS customers,
  (SELECT count(*) FROM raw_products) AS products, (SELECT count(*) FROM raw_orders) AS orders"""
Q["snk1_processed_files"] = Q["rpt01_executive_scorecard"]
Q["src6_dead_letter_file"] = Q["val7_dead_letters"]
_LOADED = """SELECT 'customers' AS table_name, count(*) AS {n} FROM vc UNION ALL SELECT 'products', count(*) FROM vp
UNION ALL SELECT 'orders', count(*) FROM vo"""
Q["snk3_load_tables"] = _LOADED.format(n="rows_loaded") + " UNION ALL SELECT 'rejected_records', count(*) FROM dlq"
Q["snk9_list_tables"] = _LOADED.format(n="row_count")
_PAIRS = "(SELECT string_agg(k || '=' || n, ';' ORDER BY k || '=' || n) FROM ({}))"
_AUDIT = f"""(SELECT count(*) FROM reasons) AS extracted_rows,
  {_PAIRS.format("SELECT table_name AS k, count(*) AS n FROM reasons GROUP BY 1")} AS source_counts,
  a.ages_imputed, a.unknown_genders, a.median_imputed_age, b.missing_categories, b.missing_costs, b.average_margin_pct,
  c.unknown_payment_methods, a.input_rows AS cleaned_customers, b.input_rows AS cleaned_products, c.input_rows AS cleaned_orders,
  {_PAIRS.format("SELECT COALESCE(order_status, 'missing') AS k, count(*) AS n FROM clean_orders GROUP BY 1")} AS status_distribution,
  (SELECT count(*) FROM reasons WHERE rejection_reason IS NULL) AS valid_rows, (SELECT count(*) FROM dlq) AS rejected_rows,
  (SELECT {pct('count(*) FILTER (rejection_reason IS NULL)', 'count(*)')} FROM reasons) AS overall_pass_rate_pct, """ + ", ".join(
    f"(SELECT {c} FROM ({_STATS}) WHERE table_name = '{t}') AS {t}_{c}"
    for t in ("customers", "products", "orders") for c in ("total_input", "valid_count", "rejected_count", "pass_rate_pct")
) + f""",
  {_PAIRS.format("SELECT rejection_reason AS k, count(*) AS n FROM dlq GROUP BY 1")} AS dead_letter_queue_breakdown"""
_STATS3 = f"({Q['cln12_customer_stats']}) a, ({Q['cln12_product_stats']}) b, ({Q['cln12_order_stats']}) c"
Q["snk2_audit_summary"] = f"""SELECT 'RUN_TEST' AS pipeline_run_id, TIMESTAMP '2001-08-02 00:00:00' AS run_timestamp,
  0.0::DOUBLE AS duration_seconds, {_AUDIT} FROM {_STATS3}"""
Q["rpt21_audit_log"] = f"""WITH s AS (SELECT count(*) AS total_extracted, count(*) FILTER (rejection_reason IS NULL) AS total_valid,
    count(rejection_reason) AS total_rejected FROM reasons)
SELECT i AS pipeline_run_id, t AS run_timestamp, 'parquet' AS database_type, total_extracted, total_valid, total_rejected,
  {pct('total_valid', 'total_extracted')} AS pass_rate_pct, {_AUDIT}
FROM {_STATS3}, s JOIN (VALUES ('RUN_A', TIMESTAMP '2001-08-01 00:00:00'), ('RUN_B', TIMESTAMP '2001-08-02 00:00:00')) x(i, t) ON true"""
Q["snk6_star_export"] = f"""SELECT 'dim_date' AS table_name, count(*) AS rows_loaded FROM {_D} UNION ALL SELECT 'dim_products', count(*) FROM vp
UNION ALL SELECT 'dim_customers', count(*) FROM vc UNION ALL SELECT 'fact_orders', count(*) FROM vo
UNION ALL SELECT 'dim_customer_analytics', count(*) FROM vc"""
# The stored customer table; SQL cannot fit the model, so its probability counts as present or not.
Q["snk5_customer_analytics"] = f"""SELECT {", ".join(dbl(c) + " AS " + c if c in _MONEY else c for c in _ANALYTICS)},
  TRUE AS has_probability FROM scored"""
Q["chn9_customer_analytics"] = Q["snk5_customer_analytics"]
Q["msr26_scored_risk_measures"] = Q["msr23_risk_measures"].replace(" FROM scored", ", TRUE AS avg_probability_checked FROM scored")
Q["src5_star_import"] = f"""SELECT table_name, rows_loaded AS rows_imported, rows_loaded AS rows_exported, 0::BIGINT AS rows_missing,
  0::BIGINT AS rows_added FROM ({Q['snk6_star_export']})"""
Q["src4_sql_over_view"] = f"""SELECT customer_state, product_category, count(order_id) AS orders, {dbl('SUM(net_revenue)')} AS net_revenue
FROM v WHERE is_completed = 1 GROUP BY customer_state, product_category"""

ORACLE: dict[str, str] = {name: with_ctes(sql) for name, sql in Q.items()}
