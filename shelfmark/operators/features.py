"""Customer features, cutoff-safe by construction, and labelled churn datasets."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, functions as F

from shelfmark.functions.exprs import count_where, ratio, ratio_or_zero, rnd, sum_where
from shelfmark.operators.facts import CANCELLED, REALISED, REFUNDED, order_lines, until

NO_ORDER_RECENCY = 999


@dataclass(frozen=True)
class ChurnWindow:
    """Features up to ``cutoff``; the label looks at [start, end], both inclusive."""

    cutoff: str
    start: str
    end: str

    @property
    def history(self) -> str:
        return f"order_date <= date'{self.cutoff}'"

    def orders(self, orders: DataFrame) -> DataFrame:
        """The orders that features or label look at."""
        return until(orders, max(self.cutoff, self.end)).where(f"{self.history} OR {self.outcome}")

    @property
    def outcome(self) -> str:
        return f"order_date BETWEEN date'{self.start}' AND date'{self.end}'"


def _order_aggregates(
    lines: DataFrame, history: str = "true", outcome: str | None = None
) -> DataFrame:
    """One row per customer from a single pass over the lines.

    ``lines`` carry ``is_recent``. Every feature is guarded by ``history``; only the
    outcome count may look past it.
    """
    realised, refunded, cancelled = (
        f"({history}) AND {status}" for status in (REALISED, REFUNDED, CANCELLED)
    )
    recent = f"{realised} AND is_recent"
    aggs = [
        count_where(f"({history}) AND order_id IS NOT NULL").alias("total_orders"),
        count_where(f"{realised} AND order_id IS NOT NULL").alias("completed_orders"),
        sum_where(realised, "quantity").alias("total_units"),
        F.count_distinct(F.expr(f"if({history}, trunc(order_date, 'MM'), null)")).alias(
            "active_months"
        ),
        F.expr(f"min(if({history}, order_date, null))").alias("first_order_date"),
        F.expr(f"max(if({history}, order_date, null))").alias("last_order_date"),
        F.expr(f"max(if({realised}, order_date, null))").alias("last_completed_order_date"),
        sum_where(history, "gross_revenue").alias("total_gross_revenue"),
        sum_where(realised, "gross_revenue").alias("total_revenue"),
        sum_where(realised, "gross_profit").alias("total_profit"),
        count_where(refunded).alias("refund_count"),
        sum_where(refunded, "gross_revenue").alias("refund_amount"),
        count_where(cancelled).alias("cancellation_count"),
        sum_where(cancelled, "gross_revenue").alias("cancellation_amount"),
        count_where(recent).alias("recent_order_count"),
        sum_where(recent, "gross_revenue").alias("recent_revenue"),
    ]
    if outcome is not None:
        aggs.append(count_where(f"({outcome}) AND {REALISED}").alias("outcome_orders"))
    return lines.groupBy("customer_id").agg(*aggs)


COUNTS = (
    "total_orders", "completed_orders", "total_units", "active_months", "refund_count",
    "cancellation_count", "recent_order_count",
)
AMOUNTS = (
    "total_gross_revenue", "total_revenue", "total_profit", "refund_amount",
    "cancellation_amount", "recent_revenue",
)


def _share(num: str, den: str, digits: int, null_ratios: bool) -> Column:
    return rnd(ratio(num, den), digits) if null_ratios else ratio_or_zero(num, den, digits)


def _assemble(
    customers: DataFrame, aggregates: DataFrame, as_of: Column, null_ratios: bool = False
) -> DataFrame:
    """Attach the aggregates to every customer and derive the ratio features."""
    money = "decimal(18,2)"
    kept = [c for c in customers.columns if c != "src_seq"]
    spans = {
        "recency_days": f"coalesce(datediff(_as_of, last_completed_order_date), {NO_ORDER_RECENCY})",
        "account_age_days": "datediff(_as_of, signup_date)",
        "customer_lifetime_days": "coalesce(datediff(last_order_date, first_order_date), 0)",
        "historical_revenue": f"cast(greatest(total_revenue - recent_revenue, 0) as {money})",
        "historical_order_count": "greatest(completed_orders - recent_order_count, 0L)",
    }
    dates = ("first_order_date", "last_order_date", "last_completed_order_date")
    outcome = [c for c in aggregates.columns if c == "outcome_orders"]
    base = (
        customers.join(aggregates, "customer_id", "left")
        .selectExpr(
            *kept,
            *dates,
            *outcome,
            *[f"cast(coalesce({c}, 0) as bigint) as {c}" for c in COUNTS],
            *[f"cast(coalesce({c}, 0) as {money}) as {c}" for c in AMOUNTS],
        )
        .withColumn("_as_of", as_of)
        .selectExpr("*", *[f"{sql} as {name}" for name, sql in spans.items()])
        .drop("_as_of")
    )
    months = "(cast(account_age_days as double) / 30.0D)"
    derived = {
        "average_order_value": _share("total_revenue", "completed_orders", 2, null_ratios),
        "order_frequency_monthly": _share("completed_orders", months, 3, null_ratios),
        "gross_margin_pct": _share(
            "(cast(total_profit as double) * 100.0D)", "total_revenue", 2, null_ratios
        ),
        "refund_rate": _share("refund_count", "total_orders", 4, null_ratios),
        "cancellation_rate": _share("cancellation_count", "total_orders", 4, null_ratios),
        "recent_revenue_ratio": _share("recent_revenue", "total_revenue", 4, null_ratios),
        "recent_order_ratio": _share("recent_order_count", "completed_orders", 4, null_ratios),
    }
    if not null_ratios:
        trend = (
            "(cast(recent_revenue as double) - cast(historical_revenue as double) / 3.0D)"
            " / (cast(total_revenue as double) + 10.0D)"
        )
        derived["revenue_trend"] = rnd(f"if(total_revenue > 0, {trend}, 0.0D)", 4)
    return base.withColumns(derived)


def customer_features(
    orders: DataFrame,
    customers: DataFrame,
    products: DataFrame,
    cutoff: str | None = None,
    recent_days: int = 90,
) -> DataFrame:
    """One row per customer. Nothing dated after ``cutoff`` is read.

    Without a cutoff the snapshot is the latest order date of any status.
    """
    if cutoff is None:
        as_of = orders.agg(F.max("order_date")).scalar()
    else:
        as_of = F.lit(cutoff).cast("date")
        orders = until(orders, cutoff)
        customers = customers.where(f"signup_date <= date'{cutoff}'")
    recent = F.col("order_date") > F.date_sub(as_of, recent_days)
    lines = order_lines(orders, products, how="left").withColumn("is_recent", recent)
    return _assemble(customers, _order_aggregates(lines), as_of)


def customer_feature_view(
    orders: DataFrame,
    customers: DataFrame,
    products: DataFrame,
    snapshot: str,
    recent_from: str,
) -> DataFrame:
    """SQL-view flavour: fixed snapshot, inclusive recent start, NULL for empty ratios."""
    lines = order_lines(orders, products).selectExpr(
        "*", f"order_date >= date'{recent_from}' as is_recent"
    )
    as_of = F.lit(snapshot).cast("date")
    return (
        _assemble(customers, _order_aggregates(lines), as_of, null_ratios=True)
        .withColumnRenamed("name", "customer_name")
        .drop("is_age_imputed")
    )


def churn_dataset(
    orders: DataFrame,
    customers: DataFrame,
    products: DataFrame,
    window: ChurnWindow,
    recent_days: int = 90,
) -> DataFrame:
    """Features of customers with a realised order by the cutoff, plus ``is_churned``.

    Label 1 means no realised order inside the outcome window.
    """
    lines = order_lines(
        window.orders(orders), products, how="left"
    ).selectExpr(
        "*", f"order_date > date_sub(date'{window.cutoff}', {recent_days}) as is_recent"
    )
    aggregates = _order_aggregates(lines, window.history, window.outcome)
    known = customers.where(f"signup_date <= date'{window.cutoff}'")
    return (
        _assemble(known, aggregates, F.lit(window.cutoff).cast("date"))
        .where("completed_orders >= 1")
        .withColumn("is_churned", F.expr("if(outcome_orders > 0, 0, 1)"))
        .drop("outcome_orders")
    )


def churn_metadata(dataset: DataFrame, window: ChurnWindow) -> DataFrame:
    """Cohort size, churn rate and class imbalance of a labelled dataset."""
    return dataset.agg(
        F.count("*").alias("eligible_customers"),
        count_where("is_churned = 1").alias("churned_customers"),
        count_where("is_churned = 0").alias("retained_customers"),
    ).select(
        F.lit(window.cutoff).alias("feature_cutoff"),
        F.lit(window.start).alias("outcome_start"),
        F.lit(window.end).alias("outcome_end"),
        "*",
        rnd(
            "cast(churned_customers as double)"
            " / nullif(cast(eligible_customers as double), 0) * 100.0D",
            2,
        ).alias("churn_rate_pct"),
        rnd(ratio("churned_customers", "greatest(1L, retained_customers)"), 2).alias(
            "imbalance_ratio"
        ),
    )


def labelled_cohort(
    orders: DataFrame, customers: DataFrame, products: DataFrame, window: ChurnWindow
) -> DataFrame:
    """The compact SQL flavour of the labelled cohort (ten columns, one pass)."""
    history = f"({window.history})"
    realised = f"{history} AND {REALISED}"
    per_customer = (
        order_lines(window.orders(orders), products)
        .groupBy("customer_id")
        .agg(
            count_where(history).alias("_orders"),
            count_where(realised).alias("hist_completed_orders"),
            F.expr(f"max(if({realised}, order_date, null))").alias("_last"),
            sum_where(realised, "gross_revenue").alias("hist_net_revenue"),
            sum_where(realised, "gross_profit").alias("hist_net_profit"),
            count_where(f"{history} AND {REFUNDED}").alias("_refunds"),
            count_where(f"{window.outcome} AND {REALISED}").alias("outcome_completed_orders"),
        )
        .where("hist_completed_orders > 0")
    )
    return per_customer.join(customers.select("customer_id", "signup_date"), "customer_id").select(
        "customer_id",
        "signup_date",
        "hist_completed_orders",
        F.expr(f"datediff(date'{window.cutoff}', _last)").alias("hist_recency_days"),
        "hist_net_revenue",
        "hist_net_profit",
        rnd(ratio("hist_net_revenue", "hist_completed_orders"), 2).alias("hist_aov"),
        rnd(ratio("_refunds", "_orders"), 4).alias("hist_refund_rate"),
        "outcome_completed_orders",
        F.expr("if(outcome_completed_orders = 0, 1, 0)").alias("is_churned"),
    )
