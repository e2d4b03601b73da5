"""Recency-frequency-monetary scores, segments and their summaries."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from shelfmark.functions.exprs import as_double, count_where, pct, ratio, rnd
from shelfmark.operators.ranking import value_ranks

UNACTIVATED = "Inactive / Unactivated"
# Right edges of the score bins 1..4; 5 is everything above.
SCORE_EDGES = (0.2, 0.4, 0.6, 0.8)
METRICS = {"r": "recency_days", "f": "completed_orders", "m": "total_revenue"}


def _score_of_percentile(p: Column) -> Column:
    out = None
    for score, edge in enumerate(SCORE_EDGES, start=1):
        out = F.when(p <= edge, score) if out is None else out.when(p <= edge, score)
    return out.otherwise(5)


def score_limits(paying: DataFrame) -> DataFrame:
    """One row: per metric and score 1..4 the largest (recency: smallest) value in the bin.

    A score is monotone in its metric, so these twelve numbers decide every customer. The
    customers are then scored by comparison, without a join on a possibly hot value.
    """
    ranks = value_ranks(paying, list(METRICS.values()))
    aggs = []
    for letter, metric in METRICS.items():
        own = F.col("metric") == metric
        percentile = 1.0 - F.col("pct_rank") if letter == "r" else F.col("pct_rank")
        score = _score_of_percentile(percentile)
        for s in range(1, 5):
            if letter == "r":
                edge = F.min(F.when(own & (score <= s), F.col("value")))
            else:
                edge = F.max(F.when(own & (score <= s), F.col("value")))
            aggs.append(edge.alias(f"{letter}{s}"))
    return ranks.agg(F.struct(*aggs).alias("limits"))


def rfm_scores(features: DataFrame) -> DataFrame:
    """Add r_score, f_score, m_score, rfm_score and customer_segment to every customer."""
    paying = features.where("completed_orders > 0")
    limits = score_limits(paying.select(*METRICS.values())).scalar()
    scored = features.withColumn("_limits", limits)
    for letter, metric in METRICS.items():
        value = as_double(metric)
        # 5 minus the number of bins at or below which the value falls; NULL limits
        # belong to empty bins and never match.
        below = [
            F.when(
                (value >= F.col(f"_limits.{letter}{s}"))
                if letter == "r"
                else (value <= F.col(f"_limits.{letter}{s}")),
                1,
            ).otherwise(0)
            for s in range(1, 5)
        ]
        score = F.lit(5) - sum(below[1:], below[0])
        scored = scored.withColumn(
            f"{letter}_score", F.when(F.col("completed_orders") > 0, score).otherwise(0)
        )
    return (
        scored.drop("_limits")
        .withColumn(
            "rfm_score", F.concat(*[F.col(f"{x}_score").cast("string") for x in METRICS])
        )
        .withColumn("customer_segment", segment())
    )


def segment() -> Column:
    """Nine exclusive segments; the order of the rules matters."""
    r, f, m = F.col("r_score"), F.col("f_score"), F.col("m_score")
    return (
        F.when((f == 0) | (F.col("completed_orders") == 0), UNACTIVATED)
        .when((r >= 4) & (f >= 4) & (m >= 4), "Champions")
        .when((r == 1) & (f >= 4) & (m >= 4), "Cannot Lose Them")
        .when((r <= 2) & (f >= 3) & (m >= 3), "At Risk")
        .when((r >= 3) & (f >= 3) & (m >= 3), "Loyal Customers")
        .when((r >= 4) & f.isin(2, 3), "Potential Loyalists")
        .when((r >= 4) & (f == 1), "New Customers")
        .when((r <= 2) & (f <= 2) & (m <= 2), "Hibernating")
        .otherwise("Promising")
    )


def share_base(total: Column) -> Column:
    """Denominator of a revenue share: at least 1, so that no revenue gives 0 %."""
    return F.greatest(as_double(total), F.lit(1.0))


def segment_summary(scored: DataFrame) -> DataFrame:
    """Size, revenue, profit and averages per segment, largest revenue first."""
    everything = Window.partitionBy()  # nine rows at most
    n, revenue = F.col("customer_count"), F.col("total_revenue")
    return (
        scored.groupBy("customer_segment")
        .agg(
            F.count("customer_id").alias("customer_count"),
            F.sum("total_revenue").alias("total_revenue"),
            F.sum("total_profit").alias("total_profit"),
            F.sum("completed_orders").alias("_orders"),
            F.sum("recency_days").alias("_recency"),
        )
        .select(
            "customer_segment",
            "customer_count",
            "total_revenue",
            "total_profit",
            rnd(ratio(revenue, n), 2).alias("avg_revenue_per_customer"),
            rnd(ratio("_orders", n), 1).alias("avg_completed_orders"),
            rnd(ratio("_recency", n), 1).alias("avg_recency_days"),
            pct(n, F.sum(n).over(everything)).alias("pct_of_customers"),
            pct(revenue, share_base(F.sum(revenue).over(everything))).alias("pct_of_revenue"),
        )
        .orderBy(F.desc("total_revenue"), "customer_segment")
    )


def segment_concentration(scored: DataFrame, top: int = 2) -> DataFrame:
    """Share of customers and revenue held by the ``top`` segments by revenue."""
    per_segment = scored.groupBy("customer_segment").agg(
        F.count("customer_id").alias("customer_count"), F.sum("total_revenue").alias("revenue")
    )
    rank = F.row_number().over(Window.orderBy(F.desc("revenue"), "customer_segment"))
    leading = F.col("rank") <= top
    return (
        per_segment.withColumn("rank", rank)
        .agg(
            F.sum(F.when(leading, F.col("customer_count"))).alias("top_customers"),
            F.sum(F.when(leading, F.col("revenue"))).alias("top_revenue"),
            F.sum("customer_count").alias("_customers"),
            F.sum("revenue").alias("_revenue"),
        )
        .select(
            "top_customers",
            "top_revenue",
            pct("top_customers", "_customers").alias("pct_of_customers"),
            pct("top_revenue", share_base(F.col("_revenue"))).alias("pct_of_revenue"),
        )
    )


def segment_profit(scored: DataFrame) -> DataFrame:
    return scored.groupBy("customer_segment").agg(
        rnd(ratio(F.sum("total_profit"), F.count("*")), 2).alias("avg_profit_per_customer")
    )


def segment_domain_checks(scored: DataFrame) -> DataFrame:
    """Violations of segment coverage, exclusivity and score domains."""
    # All segment names.
    names = (
        UNACTIVATED, "Champions", "Cannot Lose Them", "At Risk", "Loyal Customers",
        "Potential Loyalists", "New Customers", "Hibernating", "Promising",
    )
    seg, paying = F.col("customer_segment"), F.col("completed_orders") > 0
    in_range = [F.col(f"{x}_score").between(0, 5) for x in METRICS]
    rules = {
        "segment_missing": seg.isNull(),
        "segment_unknown": ~seg.isin(*names),
        "unactivated_but_paying": (seg == UNACTIVATED) & paying,
        "paying_but_score_zero": paying & (F.col("f_score") == 0),
        "score_out_of_range": ~(in_range[0] & in_range[1] & in_range[2]),
        "inactive_score_not_000": ~paying & (F.col("rfm_score") != "000"),
    }
    counted = scored.agg(*[count_where(cond).alias(name) for name, cond in rules.items()])
    return counted.unpivot([], list(rules), "rule", "violations")
