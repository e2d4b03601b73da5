"""Cleaning projections and per-table cleaning statistics."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from shelfmark.functions.exprs import (
    count_where, lookup_sql, rnd, strip_sql, title_case_sql,
)

from shelfmark.operators.ranking import numbered

# Canonical names and their accepted aliases (lower case).
GENDERS = {"m": "Male", "male": "Male", "f": "Female", "female": "Female"}
PAYMENT_METHODS = {
    "cc": "Credit Card",
    "credit_card": "Credit Card",
    "credit card": "Credit Card",
    "paypal": "PayPal",
    "cod": "Cash on Delivery",
    "cash on delivery": "Cash on Delivery",
    "debit_card": "Debit Card",
    "debit card": "Debit Card",
    "apple pay": "Apple Pay",
    "apple_pay": "Apple Pay",
}
CATEGORIES = {
    "electronics": "Electronics",
    "apparel & accessories": "Apparel & Accessories",
    "home & kitchen": "Home & Kitchen",
    "beauty & personal care": "Beauty & Personal Care",
    "sports & outdoors": "Sports & Outdoors",
    "books & media": "Books & Media",
}
UNKNOWN = "Unknown"
FALLBACK_AGE = 38.0


def median_age(raw_customers: DataFrame) -> Column:
    """Exact median of the parsable ages as a one-row scalar subquery.

    Ages are counted per value first and the values numbered in one range sort; the two middle
    rows are those whose running count passes half of all. No task sees more than its share of
    the values, even if all ages differ.
    """
    counts = (
        raw_customers.selectExpr("try_cast(age as double) as age")
        .where("age is not null")
        .groupBy("age")
        .agg(F.count("*").alias("n"))
    )
    ranked = numbered(counts, [F.col("age")], running=["n"])
    holds = "cum_n - n < {k} AND cum_n >= {k}"
    low, high = (holds.format(k=k) for k in ("(total_n + 1) div 2", "total_n div 2 + 1"))
    middle = ranked.agg(F.max(F.expr(f"if({low}, age, null)")).alias("lo"), F.max(F.expr(f"if({high}, age, null)")).alias("hi"))
    return middle.select(F.expr(f"coalesce((lo + hi) / 2.0D, {FALLBACK_AGE}D)")).scalar()


def _stripped(raw: DataFrame, *columns: str) -> DataFrame:
    """Text columns without surrounding whitespace.

    In a projection of their own: the expressions on top use each several times, and it is
    computed once that way.
    """
    return raw.withColumns({c: F.expr(strip_sql(c)) for c in columns})


def clean_customers(raw: DataFrame, median: Column | None = None) -> DataFrame:
    """Canonical names, gender and dates; missing ages take the median of the input."""
    median = median_age(raw) if median is None else median
    return _stripped(raw, "name", "gender", "city", "state").withColumns(
        {
            "name": F.expr(title_case_sql("name")),
            "gender": F.expr(f"coalesce({lookup_sql('gender', GENDERS)}, '{UNKNOWN}')"),
            "age": rnd(F.coalesce(F.expr("try_cast(age as double)"), median), 1),
            "city": F.expr(title_case_sql("city")),
            "state": F.upper("state"),
            "signup_date": F.expr("cast(signup_date as date)"),
            "is_age_imputed": F.expr("try_cast(age as double) is null"),
        }
    )


def clean_products(raw: DataFrame) -> DataFrame:
    """Canonical categories, money at two digits, derived margin."""
    category = f"coalesce({lookup_sql('category', CATEGORIES)}, {title_case_sql('category')})"
    return _stripped(raw, "product_name", "category").withColumns(
        {
            "category": F.expr(category),
            "price": F.expr("try_cast(price as decimal(18,2))"),
            "cost": F.expr("try_cast(cost as decimal(18,2))"),
        }
    ).withColumn(
        "gross_margin_pct",
        rnd("if(price > 0, cast(price - cost as double) / cast(price as double) * 100.0D, null)", 2),
    )


def clean_orders(raw: DataFrame) -> DataFrame:
    """Canonical payment methods, statuses and dates."""
    payment = f"coalesce({lookup_sql('payment_method', PAYMENT_METHODS)}, '{UNKNOWN}')"
    return _stripped(raw, "payment_method", "order_status").withColumns(
        {
            "order_date": F.expr("cast(order_date as date)"),
            "payment_method": F.expr(payment),
            "order_status": F.expr(title_case_sql("order_status")),
        }
    )


def customer_clean_stats(cleaned: DataFrame, raw: DataFrame) -> DataFrame:
    return cleaned.agg(
        F.count("*").alias("input_rows"),
        count_where("is_age_imputed").alias("ages_imputed"),
        count_where(f"gender = '{UNKNOWN}'").alias("unknown_genders"),
    ).withColumn("median_imputed_age", median_age(raw))


def product_clean_stats(cleaned: DataFrame) -> DataFrame:
    # The mean is taken over exact decimals so that it does not depend on row order.
    margin = "cast(gross_margin_pct as decimal(18,2))"
    return cleaned.agg(
        F.count("*").alias("input_rows"),
        count_where("category is null").alias("missing_categories"),
        count_where("cost is null").alias("missing_costs"),
        rnd(f"cast(sum({margin}) as double) / nullif(count({margin}), 0)", 4).alias("average_margin_pct"),
    )


def order_clean_stats(cleaned: DataFrame) -> DataFrame:
    return cleaned.agg(
        F.count("*").alias("input_rows"),
        count_where(f"payment_method = '{UNKNOWN}'").alias("unknown_payment_methods"),
    )


def status_distribution(cleaned: DataFrame) -> DataFrame:
    return cleaned.groupBy("order_status").agg(F.count("*").alias("order_count"))
