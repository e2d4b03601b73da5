"""Order fact: the wide view, the star-schema fact and the pre-aggregated rollup."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from shelfmark.functions.exprs import count_where, rnd, sum_where

# Fixed value: statuses whose revenue counts as realised.
REALISED = "order_status IN ('Completed', 'Shipped')"
REFUNDED = "order_status = 'Refunded'"
CANCELLED = "order_status = 'Cancelled'"

# Money and status measures from quantity, unit_price, unit_cost and order_status. Money is
# DECIMAL(18,2), so sums are exact and do not depend on row order.
_GROSS = "cast(quantity * unit_price as decimal(18,2))"
_PROFIT = "cast(quantity * (unit_price - unit_cost) as decimal(18,2))"
_ZERO = "cast(0 as decimal(18,2))"
ORDER_MEASURES = {
    "gross_revenue": _GROSS,
    "total_cost": "cast(quantity * unit_cost as decimal(18,2))",
    "gross_profit": _PROFIT,
    "is_completed": f"if({REALISED}, 1, 0)",
    "is_refunded": f"if({REFUNDED}, 1, 0)",
    "is_cancelled": f"if({CANCELLED}, 1, 0)",
    "net_revenue": f"if({REALISED}, {_GROSS}, {_ZERO})",
    "net_profit": f"if({REALISED}, {_PROFIT}, {_ZERO})",
    "refunded_amount": f"if({REFUNDED}, {_GROSS}, {_ZERO})",
    "cancelled_amount": f"if({CANCELLED}, {_GROSS}, {_ZERO})",
}


def with_order_measures(df: DataFrame) -> DataFrame:
    return df.selectExpr("*", *[f"{sql} as {name}" for name, sql in ORDER_MEASURES.items()])


def _unit_economics(products: DataFrame, *extra: str) -> DataFrame:
    return products.selectExpr(
        "product_id", "price as unit_price", "cost as unit_cost", *extra
    )


def until(orders: DataFrame, last: str) -> DataFrame:
    """Orders up to a day; where the year is a column, later years are not even opened."""
    kept = orders.where(f"order_date <= date'{last}'")
    return kept.where(f"order_year <= year(date'{last}')") if "order_year" in orders.columns else kept


def _priced(orders: DataFrame, products: DataFrame, how: str, *attributes: str) -> DataFrame:
    """Orders with unit price, unit cost and product attributes.

    Orders that carry their prices need no product join unless attributes are asked for.
    """
    if not {"unit_price", "unit_cost"} <= set(orders.columns):
        return orders.join(_unit_economics(products, *attributes), "product_id", how)
    if not attributes:
        return orders
    return orders.join(products.selectExpr("product_id", *attributes), "product_id", how)


def order_lines(orders: DataFrame, products: DataFrame, how: str = "inner") -> DataFrame:
    """Order lines with unit economics and measures, without dimension attributes."""
    return with_order_measures(_priced(orders, products, how))


def order_analytics(orders: DataFrame, customers: DataFrame, products: DataFrame) -> DataFrame:
    """The wide order view: one row per order line with both dimensions attached."""
    attributes = ("name", "gender", "age", "city", "state", "signup_date", "is_age_imputed")
    customer_attrs = customers.selectExpr(
        "customer_id", *[f"{c} as customer_{c}" for c in attributes]
    )
    catalogue = ("product_name", "category as product_category")
    lines = with_order_measures(_priced(orders, products, "inner", *catalogue)).withColumns(
        {
            "order_year": F.date_format("order_date", "yyyy"),
            "order_month": F.date_format("order_date", "yyyy-MM"),
            "margin_pct": rnd(
                "cast(unit_price - unit_cost as double) / cast(unit_price as double) * 100.0D", 2
            ),
        }
    )
    return lines.join(customer_attrs, "customer_id").select(
        "order_id", "customer_id", "product_id", "order_date", "order_year", "order_month",
        "order_status", "payment_method", "quantity", "unit_price", "unit_cost",
        "gross_revenue", "total_cost", "gross_profit", "margin_pct",
        "is_completed", "is_refunded", "is_cancelled",
        "net_revenue", "net_profit", "refunded_amount", "cancelled_amount",
        "customer_name", "customer_gender", "customer_age", "customer_city", "customer_state",
        "customer_signup_date", "customer_is_age_imputed", "product_name", "product_category",
    )


def date_id(c: str) -> Column:
    return F.date_format(c, "yyyyMMdd").cast("int")


def fact_orders(orders: DataFrame, products: DataFrame) -> DataFrame:
    """Star-schema fact: every order line, also one whose product is unknown."""
    return (
        order_lines(orders, products, how="left")
        .withColumn("order_date_id", date_id("order_date"))
        .select(
            "order_id", "customer_id", "product_id", "order_date", "order_date_id", "quantity",
            "unit_price", "unit_cost", "gross_revenue", "gross_profit", "net_revenue",
            "net_profit", "refunded_amount", "cancelled_amount", "payment_method",
            "order_status", "is_completed", "is_refunded", "is_cancelled",
        )
    )


def order_rollup(
    orders: DataFrame, products: DataFrame, by: list[Column] | None = None
) -> DataFrame:
    """Order measures per product and ``by`` columns, aggregated *before* the product join.

    Price and cost depend on the product only, so revenue = units x price and summing the
    units first is exact. The order side shuffles as partial sums per (product, by), not
    as raw lines, which also defuses a hot product; the catalogue is joined afterwards.
    """
    per_product = orders.groupBy("product_id", *(by or [])).agg(
        F.count("order_id").alias("order_count"),
        F.sum("quantity").alias("units"),
        F.count("quantity").alias("priced_lines"),
        count_where(REALISED).alias("completed_orders"),
        count_where(REFUNDED).alias("refunded_orders"),
        count_where(CANCELLED).alias("cancelled_orders"),
        sum_where(REALISED, "quantity").alias("completed_units"),
        sum_where(REFUNDED, "quantity").alias("refunded_units"),
        sum_where(CANCELLED, "quantity").alias("cancelled_units"),
    )
    catalogue = _unit_economics(products, "product_name", "category as product_category")
    amounts = {
        "gross_revenue": "units * unit_price",
        "net_revenue": "completed_units * unit_price",
        "realised_cost": "completed_units * unit_cost",
        "net_profit": "completed_units * (unit_price - unit_cost)",
        "refunded_amount": "refunded_units * unit_price",
        "cancelled_amount": "cancelled_units * unit_price",
    }
    return per_product.join(catalogue, "product_id").selectExpr(
        "*", *[f"cast({sql} as decimal(28,2)) as {name}" for name, sql in amounts.items()]
    )
