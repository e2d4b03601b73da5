"""Sales, product, customer and data-quality reports.

Sales and product reports start from ``order_rollup``: units are summed per product before
the catalogue is joined. Customer reports aggregate lines per customer first and attach
customer attributes to the result. Windows without a partition only ever see rows already
reduced to months, years, statuses, payment methods, categories, reasons or deciles; ranks
over products and customers use ``ranking.numbered``.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from shelfmark.functions.exprs import count_where, pct, ratio, rnd
from shelfmark.operators.facts import REALISED, order_lines, order_rollup
from shelfmark.operators.ranking import numbered, tile
from shelfmark.operators.validate import REASON
from shelfmark.session import durable
from shelfmark.sources.adapter import Tables

def _share(c: str) -> Column:
    return pct(c, F.sum(c).over(Window.partitionBy()))


def _sum(c: str, name: str | None = None) -> Column:
    return F.sum(c).alias(name or c)


def _margin(profit: str, revenue: str) -> Column:
    """Percentage of revenue; the quotient is formed first, then scaled."""
    return rnd(
        f"cast({profit} as double) / nullif(cast({revenue} as double), 0) * 100.0D", 2
    )


# ------------------------------------------------------------------------------ sales
def executive_scorecard(t: Tables) -> DataFrame:
    totals = order_rollup(t.orders, t.products).agg(
        _sum("order_count", "total_order_volume"),
        _sum("units", "total_gross_units"),
        _sum("completed_orders", "completed_order_count"),
        _sum("refunded_orders", "refunded_order_count"),
        _sum("cancelled_orders", "cancelled_order_count"),
        _sum("gross_revenue", "total_gross_invoiced_revenue"),
        _sum("refunded_amount", "total_refunded_amount"),
        _sum("cancelled_amount", "total_cancelled_amount"),
        _sum("net_revenue", "total_net_realized_revenue"),
        _sum("realised_cost", "total_realized_cogs"),
        _sum("net_profit", "total_net_profit"),
    )
    volume = "total_order_volume"
    return totals.withColumns(
        {
            "fulfillment_rate_pct": pct("completed_order_count", volume),
            "refund_rate_pct": pct("refunded_order_count", volume),
            "cancellation_rate_pct": pct("cancelled_order_count", volume),
            "realized_gross_margin_pct": _margin("total_net_profit", "total_net_realized_revenue"),
            "average_order_value_aov": rnd(
                ratio("total_net_realized_revenue", "completed_order_count"), 2
            ),
        }
    )


def _period_totals(t: Tables, pattern: str, key: str, prefix: str) -> DataFrame:
    per_period = order_rollup(
        t.orders, t.products, by=[F.date_format("order_date", pattern).alias(key)]
    )
    return (
        per_period.groupBy(key)
        .agg(
            _sum("completed_orders"),
            _sum("completed_units"),
            _sum("net_revenue", f"{prefix}_net_revenue"),
            _sum("net_profit", f"{prefix}_net_profit"),
        )
        .withColumns(
            {
                f"{prefix}_margin_pct": _margin(f"{prefix}_net_profit", f"{prefix}_net_revenue"),
                f"{prefix}_aov": rnd(ratio(f"{prefix}_net_revenue", "completed_orders"), 2),
            }
        )
    )


def _growth(current: str, previous: str) -> Column:
    return pct(f"({current} - {previous})", previous)


def monthly_trend(t: Tables) -> DataFrame:
    """Growth against the previous month that has orders, and the running total."""
    by_month = Window.orderBy("order_month")
    return (
        _period_totals(t, "yyyy-MM", "order_month", "monthly")
        .withColumn("prev_month_net_revenue", F.lag("monthly_net_revenue").over(by_month))
        .withColumns(
            {
                "mom_revenue_growth_pct": _growth("monthly_net_revenue", "prev_month_net_revenue"),
                "cumulative_run_rate_revenue": F.sum("monthly_net_revenue").over(
                    by_month.rowsBetween(Window.unboundedPreceding, 0)
                ),
            }
        )
        .orderBy("order_month")
    )


def annual_trend(t: Tables) -> DataFrame:
    return (
        _period_totals(t, "yyyy", "order_year", "annual")
        .withColumn(
            "prev_year_revenue", F.lag("annual_net_revenue").over(Window.orderBy("order_year"))
        )
        .withColumn("yoy_revenue_growth_pct", _growth("annual_net_revenue", "prev_year_revenue"))
        .orderBy("order_year")
    )


def status_funnel(t: Tables) -> DataFrame:
    return (
        order_rollup(t.orders, t.products, by=[F.col("order_status")])
        .groupBy("order_status")
        .agg(
            _sum("order_count"),
            _sum("units", "total_quantity"),
            _sum("gross_revenue", "total_invoiced_gross_revenue"),
            _sum("priced_lines", "_lines"),
        )
        .withColumns(
            {
                "pct_of_total_orders": _share("order_count"),
                "pct_of_total_revenue": _share("total_invoiced_gross_revenue"),
                "avg_order_gross_value": rnd(ratio("total_invoiced_gross_revenue", "_lines"), 2),
            }
        )
        .drop("_lines")
        .orderBy(F.desc("order_count"), "order_status")
    )


def payment_mix(t: Tables) -> DataFrame:
    return (
        order_rollup(t.orders, t.products, by=[F.col("payment_method")])
        .groupBy("payment_method")
        .agg(
            _sum("completed_orders", "completed_transactions"),
            _sum("net_revenue", "realized_revenue"),
        )
        .withColumns(
            {
                "pct_of_transactions": _share("completed_transactions"),
                "pct_of_realized_revenue": _share("realized_revenue"),
                "average_ticket_size": rnd(ratio("realized_revenue", "completed_transactions"), 2),
            }
        )
        .orderBy(F.desc("realized_revenue"), "payment_method")
    )


# --------------------------------------------------------------------------- products
def category_matrix(t: Tables) -> DataFrame:
    """One rollup row is one sold product, so products are counted without DISTINCT."""
    return (
        order_rollup(t.orders, t.products)
        .groupBy("product_category")
        .agg(
            F.count("product_id").alias("active_products"),
            _sum("completed_orders"),
            _sum("completed_units", "units_sold"),
            _sum("net_revenue", "total_net_revenue"),
            _sum("net_profit", "total_net_profit"),
        )
        .withColumns(
            {
                "category_revenue_share_pct": _share("total_net_revenue"),
                "category_profit_share_pct": _share("total_net_profit"),
                "realized_gross_margin_pct": _margin("total_net_profit", "total_net_revenue"),
                "avg_realized_price_per_unit": rnd(ratio("total_net_revenue", "units_sold"), 2),
            }
        )
        .orderBy(F.desc("total_net_revenue"), "product_category")
    )


def _product_summary(t: Tables) -> DataFrame:
    return order_rollup(t.orders, t.products).select(
        "product_id",
        "product_name",
        "product_category",
        "unit_price",
        "unit_cost",
        F.col("completed_units").alias("total_units_sold"),
        "completed_orders",
        F.col("net_revenue").alias("product_net_revenue"),
        F.col("net_profit").alias("product_net_profit"),
        _margin("net_profit", "net_revenue").alias("realized_margin_pct"),
    )


def top_products(t: Tables, limit: int = 15) -> DataFrame:
    """The dense rank inside the top rows equals the global one: every product with more
    revenue is itself among them. The per-product summary is read twice, so it is kept."""
    summary = durable(_product_summary(t))
    catalogue = summary.agg(F.sum("product_net_revenue")).scalar()
    best = summary.orderBy(F.desc("product_net_revenue"), "product_id").limit(limit)
    return best.withColumns(
        {
            "revenue_rank": F.dense_rank().over(Window.orderBy(F.desc("product_net_revenue"))),
            "share_of_total_catalog_revenue": pct("product_net_revenue", catalogue),
        }
    )


def bottom_products(t: Tables, limit: int = 15) -> DataFrame:
    worst = _product_summary(t).orderBy("product_net_revenue", "product_id").limit(limit)
    return worst.withColumn(
        "tail_rank", F.dense_rank().over(Window.orderBy("product_net_revenue"))
    )


def top_completed_products(t: Tables, limit: int = 5) -> DataFrame:
    return (
        _product_summary(t)
        .where("completed_orders > 0")
        .drop("total_units_sold")
        .orderBy(F.desc("product_net_revenue"), "product_id")
        .limit(limit)
    )


# Ranks the product concentration report shows besides the last one.
CHECKPOINTS = (1, 10, 25, 50, 100, 150, 200, 250, 300, 350, 400, 450)


def product_pareto(t: Tables, checkpoints: tuple[int, ...] = CHECKPOINTS) -> DataFrame:
    sold = order_rollup(t.orders, t.products).where("completed_orders > 0").select(
        "product_id", "product_name", "product_category", "net_revenue"
    )
    ranked = numbered(sold, [F.desc("net_revenue"), F.col("product_id")], running=["net_revenue"])
    at_checkpoint = F.col("row_num").isin(*checkpoints) | (
        F.col("row_num") == F.col("total_rows")
    )
    return (
        ranked.where(at_checkpoint)
        .select(
            F.col("row_num").alias("product_rank"),
            "product_id",
            "product_name",
            "product_category",
            "net_revenue",
            pct("row_num", "total_rows").alias("cumulative_product_pct"),
            pct("cum_net_revenue", "total_net_revenue").alias("cumulative_revenue_pct"),
        )
        .orderBy("product_rank")
    )


# -------------------------------------------------------------------------- customers
def _per_customer(t: Tables, realised_only: bool = True) -> DataFrame:
    """Order and money totals per customer, before any customer attribute is attached."""
    orders = t.orders.where(REALISED) if realised_only else t.orders
    return order_lines(orders, t.products).groupBy("customer_id").agg(
        F.count("order_id").alias("order_count"),
        count_where(REALISED).alias("completed_orders"),
        F.sum("net_revenue").alias("revenue"),
        F.sum("net_profit").alias("profit"),
        F.min("order_date").alias("first_order_date"),
        F.max("order_date").alias("last_order_date"),
    )


def customer_lifecycle(t: Tables) -> DataFrame:
    """Active and dormant customers by any order, buyers by realised orders."""
    summary = t.customers.select("customer_id").join(
        _per_customer(t, realised_only=False), "customer_id", "left"
    )
    return summary.agg(
        F.count("*").alias("total_customers"),
        count_where("order_count > 0").alias("active_customers_with_orders"),
        count_where("coalesce(order_count, 0) = 0").alias("dormant_customers_zero_orders"),
        count_where("completed_orders > 0").alias("customers_with_completed_orders"),
        count_where("completed_orders = 1").alias("one_time_buyers"),
        count_where("completed_orders >= 2").alias("repeat_buyers"),
        F.sum("revenue").alias("total_realized_revenue"),
    ).withColumns(
        {
            "zero_order_rate_pct": pct("dormant_customers_zero_orders", "total_customers"),
            "repeat_buyer_rate_pct": pct("repeat_buyers", "customers_with_completed_orders"),
            "avg_revenue_per_paying_customer": rnd(
                ratio("total_realized_revenue", "customers_with_completed_orders"), 2
            ),
        }
    )


def _leading(df: DataFrame, t: Tables, limit: int, *attributes: Column | str) -> DataFrame:
    """The ``limit`` customers with the most revenue, then their attributes.

    Spark broadcasts those rows if their size allows; ``limit`` is the caller's.
    """
    best = df.orderBy(F.desc("revenue"), "customer_id").limit(limit)
    return t.customers.select("customer_id", *attributes).join(best, "customer_id")


def customer_ltv(t: Tables, snapshot: str, limit: int = 100) -> DataFrame:
    return _leading(
        _per_customer(t),
        t,
        limit,
        F.col("name").alias("customer_name"),
        F.col("gender").alias("customer_gender"),
        F.col("city").alias("customer_city"),
        F.col("state").alias("customer_state"),
        "signup_date",
    ).select(
        "customer_id", "customer_name", "customer_gender", "customer_city", "customer_state",
        "signup_date",
        F.col("order_count").alias("total_order_count"),
        F.col("completed_orders").alias("completed_order_count"),
        F.col("revenue").alias("total_spend"),
        F.col("profit").alias("total_profit"),
        rnd(ratio("revenue", "completed_orders"), 2).alias("average_order_value"),
        "first_order_date",
        "last_order_date",
        F.datediff(F.lit(snapshot).cast("date"), "last_order_date").alias("recency_days"),
    ).orderBy(F.desc("total_spend"), "customer_id")


def customer_tiles(t: Tables, k: int = 10) -> DataFrame:
    """NTILE(k) of every paying customer by revenue, highest first."""
    spend = _per_customer(t).select("customer_id", F.col("revenue").alias("customer_revenue"))
    ranked = numbered(spend, [F.desc("customer_revenue"), F.col("customer_id")])
    return ranked.select("customer_id", "customer_revenue", tile(k).alias("revenue_decile"))


def customer_pareto(t: Tables, k: int = 10) -> DataFrame:
    upto = Window.orderBy("revenue_decile").rowsBetween(Window.unboundedPreceding, 0)
    return (
        customer_tiles(t, k)
        .groupBy("revenue_decile")
        .agg(
            F.count("customer_id").alias("customer_count"),
            F.sum("customer_revenue").alias("decile_revenue"),
            F.min("customer_revenue").alias("min_spend_in_decile"),
            F.max("customer_revenue").alias("max_spend_in_decile"),
        )
        .withColumns(
            {
                "pct_of_total_revenue": _share("decile_revenue"),
                "cumulative_revenue_pct": pct(
                    F.sum("decile_revenue").over(upto), F.sum("decile_revenue").over(Window.partitionBy())
                ),
            }
        )
        .orderBy("revenue_decile")
    )


def top_customers(t: Tables, limit: int = 20) -> DataFrame:
    return _leading(
        _per_customer(t),
        t,
        limit,
        F.col("name").alias("customer_name"),
        F.col("city").alias("customer_city"),
        F.col("state").alias("customer_state"),
        F.col("signup_date").alias("customer_signup_date"),
    ).select(
        "customer_id", "customer_name", "customer_city", "customer_state", "customer_signup_date",
        "completed_orders",
        F.col("revenue").alias("total_revenue"),
        F.col("profit").alias("total_profit"),
        _margin("profit", "revenue").alias("realized_margin_pct"),
        rnd(ratio("revenue", "order_count"), 2).alias("avg_order_value"),
    ).orderBy(F.desc("total_revenue"), "customer_id")


def _inactivity(days: str) -> Column:
    d = F.col(days)
    return (
        F.when(d > 365, "Severe Churn (>1 Year)")
        .when(d > 180, "High Inactivity (6-12 Months)")
        .when(d > 90, "Moderate Inactivity (3-6 Months)")
        .otherwise("Active (<90 Days)")
    )


def dormant_customers(t: Tables, snapshot: str, days: int = 180, limit: int = 50) -> DataFrame:
    idle = F.datediff(F.lit(snapshot).cast("date"), "last_order_date")
    dormant = _per_customer(t).withColumn("days_since_last_purchase", idle).where(
        F.col("days_since_last_purchase") > days
    )
    return _leading(
        dormant,
        t,
        limit,
        F.col("name").alias("customer_name"),
        F.col("state").alias("customer_state"),
        F.col("signup_date").alias("customer_signup_date"),
    ).select(
        "customer_id", "customer_name", "customer_state", "customer_signup_date",
        F.col("completed_orders").alias("lifetime_completed_orders"),
        F.col("revenue").alias("lifetime_revenue"),
        F.col("last_order_date").alias("last_purchase_date"),
        "days_since_last_purchase",
        _inactivity("days_since_last_purchase").alias("inactivity_tier"),
    ).orderBy(F.desc("lifetime_revenue"), "customer_id")


def activity_cohorts(t: Tables, snapshot: str) -> DataFrame:
    idle = F.datediff(F.lit(snapshot).cast("date"), "last_order_date")
    cohort = (
        F.when(idle > 365, "Dormant (>365d)")
        .when(idle > 180, "At-Risk (181-365d)")
        .when(idle > 90, "Cooling (91-180d)")
        .otherwise("Active (<=90d)")
    )
    return (
        _per_customer(t)
        .groupBy(cohort.alias("activity_cohort"))
        .agg(
            F.count("*").alias("customer_count"),
            F.sum("revenue").alias("cohort_historical_spend"),
        )
        .withColumn("pct_of_cumulative_spend", _share("cohort_historical_spend"))
        .orderBy(F.desc("customer_count"), "activity_cohort")
    )


def leakage(t: Tables) -> DataFrame:
    return (
        order_rollup(t.orders, t.products)
        .agg(
            _sum("order_count", "total_orders"),
            _sum("gross_revenue"),
            _sum("refunded_amount"),
            _sum("cancelled_amount"),
            _sum("net_revenue"),
        )
        .withColumns(
            {
                "refund_revenue_rate_pct": pct("refunded_amount", "gross_revenue"),
                "cancellation_revenue_rate_pct": pct("cancelled_amount", "gross_revenue"),
            }
        )
    )


def leakage_by_category(t: Tables) -> DataFrame:
    return (
        order_rollup(t.orders, t.products)
        .groupBy("product_category")
        .agg(_sum("refunded_amount"), _sum("cancelled_amount"))
        .withColumn("leaked_amount", F.col("refunded_amount") + F.col("cancelled_amount"))
        .orderBy(F.desc("leaked_amount"), "product_category")
    )


def seasonal_averages(t: Tables) -> DataFrame:
    """Average monthly net revenue in peak, base and post-holiday months."""
    monthly = (
        order_rollup(t.orders, t.products, by=[F.trunc("order_date", "month").alias("month")])
        .groupBy("month")
        .agg(_sum("net_revenue"))
    )
    m = F.month("month")
    season = (
        F.when(m >= 11, "Nov-Dec").when(m <= 2, "Jan-Feb").when(m.between(4, 9), "Apr-Sep")
    )
    return (
        monthly.withColumn("season", season)
        .where("season is not null")
        .groupBy("season")
        .agg(
            F.count("*").alias("months"),
            rnd(ratio(F.sum("net_revenue"), F.count("*")), 2).alias("avg_monthly_net_revenue"),
        )
    )


# ----------------------------------------------------------------------- data quality
def dq_throughput(t: Tables, rejected: DataFrame) -> DataFrame:
    """Valid and quarantined rows per table, from the stored tables."""
    valid = None
    for name, df in t.items().items():
        part = df.agg(F.count("*").alias("valid_count")).select(
            F.lit(name).alias("table_name"), "valid_count"
        )
        valid = part if valid is None else valid.unionByName(part)
    quarantined = rejected.groupBy("table_name").agg(F.count("*").alias("_n"))
    total = "total_extracted_records"
    return (
        valid.join(quarantined, "table_name", "left")
        .withColumn("quarantined_in_dlq", F.coalesce("_n", F.lit(0)))
        .withColumn("total_extracted_records", F.col("valid_count") + F.col("quarantined_in_dlq"))
        .withColumns(
            {
                "data_quality_pass_rate_pct": pct("valid_count", total),
                "rejection_quarantine_rate_pct": pct("quarantined_in_dlq", total),
            }
        )
        .drop("_n")
    )


def dlq_root_causes(rejected: DataFrame) -> DataFrame:
    return (
        rejected.groupBy("table_name", REASON)
        .agg(
            F.count("*").alias("quarantined_record_count"),
            F.min("rejected_at").alias("first_rejection_timestamp"),
            F.max("rejected_at").alias("last_rejection_timestamp"),
        )
        .withColumn("pct_of_total_dlq", _share("quarantined_record_count"))
        .orderBy(F.desc("quarantined_record_count"), "table_name", REASON)
    )


def audit_history(log: DataFrame) -> DataFrame:
    return log.orderBy(F.desc("run_timestamp"), "pipeline_run_id")


def audit_details(audit: DataFrame, prefix: str = "") -> DataFrame:
    """Every number of nested audits as a column; maps as sorted ``key=value`` texts.

    ``prefix``: the struct column that holds the audits, with a dot; all other columns stay.
    """
    x, v = f"{prefix}transformation", f"{prefix}validation"
    own = [c for c in audit.columns if prefix and c != prefix[:-1]] or ["pipeline_run_id", "run_timestamp", "duration_seconds"]
    stats = ("total_input", "valid_count", "rejected_count", "pass_rate_pct")

    def listed(entries: str) -> Column:
        pairs = F.transform(F.map_entries(entries), lambda e: F.concat(e["key"], F.lit("="), e["value"].cast("string")))
        return F.array_join(F.array_sort(pairs), ";")

    return audit.select(
        *own,
        F.col(f"{prefix}extraction.total_extracted").alias("extracted_rows"),
        listed(f"{prefix}extraction.counts").alias("source_counts"),
        F.col(f"{x}.customers.ages_imputed"), F.col(f"{x}.customers.unknown_genders"),
        F.col(f"{x}.customers.median_imputed_age"), F.col(f"{x}.products.missing_categories"),
        F.col(f"{x}.products.missing_costs"), F.col(f"{x}.products.average_margin_pct"),
        F.col(f"{x}.orders.unknown_payment_methods"),
        *[F.col(f"{x}.{t}.input_rows").alias(f"cleaned_{t}") for t in ("customers", "products", "orders")],
        listed(f"{x}.status_distribution").alias("status_distribution"),
        F.col(f"{v}.total_valid").alias("valid_rows"), F.col(f"{v}.total_rejected").alias("rejected_rows"),
        F.col(f"{v}.overall_pass_rate_pct"),
        *[F.col(f"{v}.tables")[t][c].alias(f"{t}_{c}") for t in ("customers", "products", "orders") for c in stats],
        listed(f"{v}.dead_letter_queue_breakdown").alias("dead_letter_queue_breakdown"),
    )


def run_scorecard(stats: DataFrame, reasons: DataFrame) -> DataFrame:
    """Throughput per table and share of each rejection reason, as one long table."""
    tables = stats.select(
        F.lit("throughput").alias("section"),
        "table_name",
        F.lit(None).cast("string").alias(REASON),
        "total_input",
        "valid_count",
        "rejected_count",
        "pass_rate_pct",
    )
    dlq = (
        reasons.withColumn("_share", rnd(_share("n"), 1))
        .select(
            F.lit("dead_letters").alias("section"),
            "table_name",
            REASON,
            F.lit(None).cast("long").alias("total_input"),
            F.lit(None).cast("long").alias("valid_count"),
            F.col("n").alias("rejected_count"),
            F.col("_share").alias("pass_rate_pct"),
        )
    )
    return tables.unionByName(dlq).withColumnRenamed("pass_rate_pct", "pct")


def population_scorecard(features: DataFrame) -> DataFrame:
    return features.agg(
        F.count("*").alias("total_customers"),
        count_where("completed_orders > 0").alias("active_customers"),
        count_where("completed_orders = 0").alias("unactivated_customers"),
        F.sum("total_revenue").alias("total_net_revenue"),
        F.sum("total_profit").alias("total_net_profit"),
    )


AGE_GROUPS = {"18-24": (18, 25), "25-34": (25, 35), "35-44": (35, 45), "45-54": (45, 55),
              "55-64": (55, 65), "65+": (65, 1000)}


def age_group(c: str = "age") -> Column:
    out = None
    for label, (low, high) in AGE_GROUPS.items():
        hit = (F.col(c) >= low) & (F.col(c) < high)
        out = F.when(hit, label) if out is None else out.when(hit, label)
    return out


def customer_table(
    analytics: DataFrame,
    segments: list[str] | None = None,
    risk_levels: list[str] | None = None,
    states: list[str] | None = None,
    age_groups: list[str] | None = None,
) -> DataFrame:
    """The customer table under the given filters; an omitted filter keeps everything."""
    out = analytics.withColumn("age_group", age_group())
    for column, wanted in (
        ("customer_segment", segments),
        ("risk_level", risk_levels),
        ("state", states),
        ("age_group", age_groups),
    ):
        if wanted is not None:
            out = out.where(F.col(column).isin(*wanted))
    return out
