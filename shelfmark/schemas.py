"""Explicit schemas of every table; nothing is inferred on the main path."""

from __future__ import annotations

from pyspark.sql import types as T

MONEY = T.DecimalType(18, 2)


def _struct(**fields: T.DataType) -> T.StructType:
    return T.StructType([T.StructField(name, dtype, True) for name, dtype in fields.items()])


S, I, L, D = T.StringType(), T.IntegerType(), T.LongType(), T.DoubleType()
DATE, TS, B = T.DateType(), T.TimestampType(), T.BooleanType()

RAW_CUSTOMERS = _struct(
    customer_id=S, name=S, gender=S, age=D, city=S, state=S, signup_date=DATE
)
RAW_PRODUCTS = _struct(product_id=S, product_name=S, category=S, price=MONEY, cost=MONEY)
RAW_ORDERS = _struct(
    order_id=S, customer_id=S, product_id=S, order_date=DATE, quantity=I,
    payment_method=S, order_status=S,
)
RAW = {"customers": RAW_CUSTOMERS, "products": RAW_PRODUCTS, "orders": RAW_ORDERS}

CUSTOMERS = _struct(
    customer_id=S, name=S, gender=S, age=D, city=S, state=S, signup_date=DATE, is_age_imputed=B
)
PRODUCTS = _struct(
    product_id=S, product_name=S, category=S, price=MONEY, cost=MONEY, gross_margin_pct=D
)
ORDERS = RAW_ORDERS
REJECTED = _struct(
    table_name=S, record_identifier=S, rejection_reason=S, rejected_at=TS, raw_payload=S
)
CLEAN = {
    "customers": CUSTOMERS, "products": PRODUCTS, "orders": ORDERS, "rejected_records": REJECTED,
}

AUDIT_LOG = _struct(
    pipeline_run_id=S, run_timestamp=TS, database_type=S, total_extracted=L, total_valid=L,
    total_rejected=L, pass_rate_pct=D, audit_json=S,
)

_TABLE_STATS = _struct(total_input=L, valid_count=L, rejected_count=L, pass_rate_pct=D)
AUDIT = _struct(
    pipeline_run_id=S, run_timestamp=TS, duration_seconds=D,
    extraction=_struct(total_extracted=L, counts=T.MapType(S, L)),
    transformation=_struct(
        customers=_struct(input_rows=L, ages_imputed=L, unknown_genders=L, median_imputed_age=D),
        products=_struct(input_rows=L, missing_categories=L, missing_costs=L, average_margin_pct=D),
        orders=_struct(input_rows=L, unknown_payment_methods=L),
        status_distribution=T.MapType(S, L),
    ),
    validation=_struct(
        total_valid=L, total_rejected=L, overall_pass_rate_pct=D,
        tables=T.MapType(S, _TABLE_STATS), dead_letter_queue_breakdown=T.MapType(S, L),
    ),
)

DIM_DATE = _struct(
    date=DATE, date_id=I, date_str=S, year=I, quarter=I, quarter_name=S, year_quarter=S,
    month=I, month_name=S, month_short=S, month_year=S, day_of_month=I, day_of_week=I,
    day_name=S, is_weekend=I, fiscal_year=S, fiscal_quarter=S,
)
DIM_PRODUCTS = _struct(
    product_id=S, product_name=S, category=S, price=MONEY, cost=MONEY, margin_pct=D
)
DIM_CUSTOMERS = _struct(
    customer_id=S, name=S, gender=S, age=D, city=S, state=S, signup_date=DATE,
    signup_date_id=I, is_age_imputed=B,
)
FACT_ORDERS = _struct(
    order_id=S, customer_id=S, product_id=S, order_date=DATE, order_date_id=I, quantity=I,
    unit_price=MONEY, unit_cost=MONEY, gross_revenue=MONEY, gross_profit=MONEY,
    net_revenue=MONEY, net_profit=MONEY, refunded_amount=MONEY, cancelled_amount=MONEY,
    payment_method=S, order_status=S, is_completed=I, is_refunded=I, is_cancelled=I,
)

# Column order of the unified customer table.
CUSTOMER_ANALYTICS = _struct(
    customer_id=S, name=S, gender=S, age=D, city=S, state=S, signup_date=DATE,
    total_orders=L, completed_orders=L, total_units=L, active_months=L,
    first_order_date=DATE, last_order_date=DATE, last_completed_order_date=DATE,
    recency_days=I, account_age_days=I, customer_lifetime_days=I,
    total_gross_revenue=MONEY, total_revenue=MONEY, total_profit=MONEY,
    average_order_value=D, order_frequency_monthly=D, gross_margin_pct=D,
    refund_count=L, refund_amount=MONEY, refund_rate=D,
    cancellation_count=L, cancellation_amount=MONEY, cancellation_rate=D,
    recent_revenue=MONEY, recent_order_count=L, historical_revenue=MONEY,
    historical_order_count=L, recent_revenue_ratio=D, recent_order_ratio=D, revenue_trend=D,
    r_score=I, f_score=I, m_score=I, rfm_score=S, customer_segment=S,
    risk_score=I, risk_level=S, key_risk_driver=S, recommended_action=S,
    churn_probability=D,
)

STAR = {
    "dim_date": DIM_DATE, "dim_products": DIM_PRODUCTS, "dim_customers": DIM_CUSTOMERS,
    "fact_orders": FACT_ORDERS, "dim_customer_analytics": CUSTOMER_ANALYTICS,
}
