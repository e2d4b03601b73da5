"""Named measures over the star schema, usable under any grouping.

``measures(fact, ...)`` works at two levels: additive sums per (group, customer), then per
group. Distinct customers become a count of flags, so there is no distinct aggregate and a
hot customer or group is combined before the shuffle.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from shelfmark.functions.exprs import count_where, ratio_or_zero, sum_where
from shelfmark.operators.risk import AT_RISK
from shelfmark.operators.facts import CANCELLED, REALISED, REFUNDED

_SUMS = (
    "total_gross_revenue", "net_revenue", "gross_profit", "total_units_sold", "total_orders",
    "completed_orders", "refunded_orders", "cancelled_orders", "refunded_revenue",
    "cancelled_revenue",
)


def _additive() -> list[Column]:
    return [
        F.sum("gross_revenue").alias("total_gross_revenue"),
        sum_where(REALISED, "gross_revenue").alias("net_revenue"),
        sum_where(REALISED, "gross_profit").alias("gross_profit"),
        sum_where(REALISED, "quantity").alias("total_units_sold"),
        F.count("*").alias("total_orders"),
        count_where(REALISED).alias("completed_orders"),
        count_where(REFUNDED).alias("refunded_orders"),
        count_where(CANCELLED).alias("cancelled_orders"),
        sum_where(REFUNDED, "gross_revenue").alias("refunded_revenue"),
        sum_where(CANCELLED, "gross_revenue").alias("cancelled_revenue"),
    ]


def _ratios() -> dict[str, Column]:
    """Fractions, 0 when the denominator is blank or zero."""
    return {
        "gross_margin_pct": ratio_or_zero("gross_profit", "net_revenue", 4),
        "refund_rate_pct": ratio_or_zero("refunded_orders", "total_orders", 4),
        "cancellation_rate_pct": ratio_or_zero("cancelled_orders", "total_orders", 4),
        "average_order_value": ratio_or_zero("net_revenue", "completed_orders", 2),
        "revenue_per_customer": ratio_or_zero("net_revenue", "active_customers", 2),
        "repeat_buyer_rate_pct": ratio_or_zero("_repeat_customers", "active_customers", 4),
    }


def measures(
    fact: DataFrame, customers: DataFrame, by: list[str] | None = None
) -> DataFrame:
    """Order, revenue and customer measures under the grouping ``by``.

    ``fact`` must already carry the ``by`` columns. Lifetime orders (for repeat buyers) and
    the customer count are not filtered by the group, only by the whole fact.
    """
    by = by or []
    per_customer = fact.groupBy(*by, "customer_id").agg(*_additive())
    # At most one row per group and customer is left, so a hot customer is small by now.
    lifetime = F.sum("completed_orders").over(Window.partitionBy("customer_id"))
    flagged = per_customer.withColumn("_lifetime", lifetime).selectExpr(
        "*",
        "if(completed_orders > 0, 1, 0) as _active",
        "if(completed_orders > 0 AND _lifetime >= 2, 1, 0) as _repeat",
    )
    grouped = flagged.groupBy(*by).agg(
        *[F.sum(c).alias(c) for c in _SUMS],
        F.sum("_active").alias("active_customers"),
        F.sum("_repeat").alias("_repeat_customers"),
    )
    return (
        grouped.withColumn("total_customers", customers.agg(F.count("*")).scalar())
        .withColumns(_ratios())
        .drop("_repeat_customers")
    )


def net_revenue_by_month(fact: DataFrame) -> DataFrame:
    return fact.groupBy(F.trunc("order_date", "month").alias("month")).agg(
        sum_where(REALISED, "gross_revenue").alias("net_revenue")
    )


def time_intelligence(fact: DataFrame) -> DataFrame:
    """Per calendar month: prior month and year by calendar shift, growth, running total.

    A month without sales has no row, and the month after it gets no prior value: that is
    the calendar rule, unlike "the row before" of the monthly report.
    """
    monthly = net_revenue_by_month(fact).withColumn(
        "_no", F.year("month") * 12 + F.month("month"))
    # Windows over one row per month.
    at = Window.orderBy("_no")

    def shifted(months: int) -> Column:
        """Net revenue of the month so many calendar months back; NULL if it has no row."""
        return F.max("net_revenue").over(at.rangeBetween(-months, -months))

    def growth(prior: str) -> Column:
        return ratio_or_zero(f"(net_revenue - {prior})", prior, 4)

    upto = at.rowsBetween(Window.unboundedPreceding, 0)
    return (
        monthly.withColumns(
            {
                "net_revenue_prior_month": shifted(1),
                "_prior_year": shifted(12),
                "running_net_revenue": F.sum("net_revenue").over(upto),
            }
        )
        .select(
            "month",
            "net_revenue",
            "net_revenue_prior_month",
            growth("net_revenue_prior_month").alias("mom_growth_pct"),
            growth("_prior_year").alias("yoy_growth_pct"),
            "running_net_revenue",
        )
        .orderBy("month")
    )


def risk_measures(analytics: DataFrame) -> DataFrame:
    """Customer-risk measures of the analytics dimension.

    The mean probability is reported when the table has been scored.
    """
    aggs = [
        count_where("risk_level = 'HIGH'").alias("high_risk_customers"),
        count_where("risk_level = 'CRITICAL'").alias("critical_risk_customers"),
        sum_where(AT_RISK, "total_revenue").alias("historical_revenue_at_risk"),
    ]
    if "churn_probability" in analytics.columns:
        exact = F.col("churn_probability").cast("decimal(10,6)")
        aggs.append(F.avg(exact).cast("double").alias("avg_churn_probability"))
    return analytics.agg(*aggs)
