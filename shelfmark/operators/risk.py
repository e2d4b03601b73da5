"""Rule-based customer risk: score, tier, driver, action and exposure reports."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window, functions as F

from shelfmark.functions.exprs import as_double, pct, ratio, rnd, sum_where
from shelfmark.operators.rfm import share_base

# Tiers from worst to best, and the texts shown to users.
TIERS = ("CRITICAL", "HIGH", "MEDIUM", "LOW")
ACTIONS = {
    "CRITICAL": "High-Touch Re-engagement / VIP Concierge Win-Back Promo",
    "HIGH": "Automated Multi-Channel Retention Flow (15% Reactivation Offer)",
    "MEDIUM": "Personalized Cross-Sell Campaign & Replenishment Nudge",
    "LOW": "Loyalty Points Acceleration & Exclusive Product Previews",
}
NO_DRIVER = "Healthy Engagement Cadence"
UNACTIVATED_SCORE = 85


@dataclass(frozen=True)
class RiskLimits:
    """Spend and refund limits of the rules; prices differ between catalogues."""

    high_value: float = 3000.0
    mid_value: float = 1500.0
    refund_rate: float = 0.15


def percent_text(rate: str) -> Column:
    """A four-digit rate as percent with one decimal, rounded as the binary double is.

    ``format_string`` rounds the shortest decimal text of a double, so 0.1765 would give
    17.7; the double next to 17.65 is below it and must give 17.6. A tie in the last digit
    is therefore decided on the exact value, scaled by 2^52 to an integer; a true tie goes
    to the even digit.
    """
    units = f"cast(round({rate} * 10000) as bigint)"
    scale = 2**52
    exact = f"cast(cast({rate} * 100 * {scale}D as bigint) as decimal(20,0)) * 100"
    tie = f"cast({units} as decimal(10,0)) * {scale}"
    up = (
        f"{units} % 10 > 5 OR ({units} % 10 = 5 AND ({exact} > {tie}"
        f" OR ({exact} = {tie} AND ({units} div 10) % 2 = 1)))"
    )
    tenths = f"({units} div 10 + if({up}, 1, 0))"
    return F.expr(f"concat({tenths} div 10, '.', {tenths} % 10)")


# A rule family is an ordered list of (condition, points, reason); its first hit counts.
Family = list[tuple[Column, int, Column]]


def _families(limits: RiskLimits) -> list[Family]:
    recency = F.col("recency_days")
    revenue, refunds = as_double("total_revenue"), F.col("refund_rate")
    quiet = F.col("recent_order_count") == 0
    earlier = F.col("historical_order_count")
    text = F.lit
    refund_text = F.concat(
        text("High Return Friction ("), percent_text("refund_rate"), text("% Refund Rate)")
    )
    return [
        [
            (recency > 365, 40, text("Severe Inactivity (>365 Days)")),
            (recency > 180, 25, text("High Inactivity (181-365 Days)")),
            (recency > 90, 15, text("Cooling Purchase Cadence (91-180 Days)")),
        ],
        [
            ((earlier >= 5) & quiet, 25, text("Discontinued Repeat Purchase Cadence")),
            ((earlier >= 2) & quiet, 15, text("Zero Orders in Last 90 Days")),
        ],
        [
            (
                (revenue > limits.high_value) & (recency > 90),
                20,
                text("High-Value Revenue Exposure ($3K+ Spend Dormant)"),
            ),
            (
                (revenue > limits.mid_value) & (recency > 90),
                10,
                text("Mid-Value Revenue Cooling"),
            ),
        ],
        [(refunds > limits.refund_rate, 15, refund_text)],
    ]


def _first(family: Family, pick: int) -> Column:
    out = None
    for rule in family:
        value = rule[pick] if isinstance(rule[pick], Column) else F.lit(rule[pick])
        out = F.when(rule[0], value) if out is None else out.when(rule[0], value)
    return out


def tier_of(score: Column) -> Column:
    return (
        F.when(score <= 24, "LOW").when(score <= 49, "MEDIUM").when(score <= 74, "HIGH")
        .otherwise("CRITICAL")
    )


def risk_scores(features: DataFrame, limits: RiskLimits = RiskLimits()) -> DataFrame:
    """Add risk_score, risk_level, key_risk_driver and recommended_action."""
    families = _families(limits)
    points = [F.coalesce(_first(family, 1), F.lit(0)) for family in families]
    drivers = [_first(family, 2) for family in families]
    unactivated = F.col("completed_orders") == 0
    total = F.least(F.lit(100), F.greatest(F.lit(0), sum(points[1:], points[0])))
    action = None
    for tier, label in ACTIONS.items():
        hit = F.col("risk_level") == tier
        action = F.when(hit, label) if action is None else action.when(hit, label)
    return (
        features.withColumn(
            "risk_score", F.when(unactivated, UNACTIVATED_SCORE).otherwise(total).cast("int")
        )
        .withColumn("risk_level", tier_of(F.col("risk_score")))
        .withColumn(
            "key_risk_driver",
            F.when(unactivated, "Unactivated Account (0 Completed Purchases)").otherwise(
                F.coalesce(*drivers, F.lit(NO_DRIVER))
            ),
        )
        .withColumn("recommended_action", action)
    )


def _tier_rank() -> Column:
    out = F.when(F.col("risk_level") == TIERS[0], 0)
    for i, tier in enumerate(TIERS[1:], start=1):
        out = out.when(F.col("risk_level") == tier, i)
    return out


def tier_summary(scored: DataFrame) -> DataFrame:
    """Size, revenue and averages per tier, worst tier first."""
    everything = Window.partitionBy()  # four rows at most
    n, revenue = F.col("customer_count"), F.col("total_revenue")
    return (
        scored.groupBy("risk_level")
        .agg(
            F.count("customer_id").alias("customer_count"),
            F.sum("total_revenue").alias("total_revenue"),
            F.sum("recency_days").alias("_recency"),
            F.sum("completed_orders").alias("_orders"),
        )
        .select(
            "risk_level",
            "customer_count",
            "total_revenue",
            rnd(ratio(revenue, n), 2).alias("avg_revenue"),
            rnd(ratio("_recency", n), 1).alias("avg_recency"),
            rnd(ratio("_orders", n), 1).alias("avg_completed_orders"),
            pct(n, F.sum(n).over(everything)).alias("pct_of_customers"),
            pct(revenue, share_base(F.sum(revenue).over(everything))).alias("pct_of_revenue"),
        )
        .orderBy(_tier_rank())
    )


AT_RISK = "risk_level IN ('HIGH', 'CRITICAL')"


def exposure(scored: DataFrame) -> DataFrame:
    """Customers in the two worst tiers and the revenue they have brought so far."""
    return scored.agg(
        F.count_if(F.expr(AT_RISK)).alias("customers_at_risk"),
        sum_where(AT_RISK, "total_revenue").alias("revenue_at_risk"),
    )


def intervention_list(scored: DataFrame, limit: int = 50, *extra: str) -> DataFrame:
    """The most valuable customers of the two worst tiers."""
    return (
        scored.where(AT_RISK)
        .select(
            "customer_id", "name", "customer_segment", "total_revenue", "recency_days",
            "risk_score", "risk_level", "key_risk_driver", "recommended_action", *extra,
        )
        .orderBy(F.desc("total_revenue"), "customer_id")
        .limit(limit)
    )


def segment_by_tier(scored: DataFrame) -> DataFrame:
    """Customers and revenue per segment, one column pair per tier."""
    return (
        scored.groupBy("customer_segment")
        .pivot("risk_level", list(TIERS))
        .agg(
            F.count("customer_id").alias("customers"), F.sum("total_revenue").alias("revenue")
        )
        .select(
            "customer_segment",
            *[
                F.coalesce(f"{t}_{what}", F.lit(0)).alias(f"{t.lower()}_{what}")
                for t in TIERS
                for what in ("customers", "revenue")
            ],
        )
    )
