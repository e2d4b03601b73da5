"""Star schema: calendar, product, customer and customer-analytics dimensions."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from shelfmark.functions.exprs import as_double, rnd
from shelfmark.operators.facts import date_id
from shelfmark.operators.validate import union_all


def _calendar(days: DataFrame) -> DataFrame:
    """Calendar attributes of a ``date`` column; the fiscal year is the calendar year."""
    day = "date"
    year, quarter = F.year(day), F.quarter(day)
    weekday = F.weekday(day) + 1  # 1 = Monday
    q, y = quarter.cast("string"), year.cast("string")
    return days.select(
        day,
        date_id(day).alias("date_id"),
        F.date_format(day, "yyyy-MM-dd").alias("date_str"),
        year.alias("year"),
        quarter.alias("quarter"),
        F.concat(F.lit("Q"), q).alias("quarter_name"),
        F.concat(y, F.lit("-Q"), q).alias("year_quarter"),
        F.month(day).alias("month"),
        F.date_format(day, "MMMM").alias("month_name"),
        F.date_format(day, "MMM").alias("month_short"),
        F.date_format(day, "yyyy-MM").alias("month_year"),
        F.dayofmonth(day).alias("day_of_month"),
        weekday.alias("day_of_week"),
        F.date_format(day, "EEEE").alias("day_name"),
        F.when(weekday >= 6, 1).otherwise(0).alias("is_weekend"),
        F.concat(F.lit("FY"), y).alias("fiscal_year"),
        F.concat(F.lit("FQ"), q).alias("fiscal_quarter"),
    )


def date_dimension(spark: SparkSession, start: str, end: str) -> DataFrame:
    """One row per day of the closed range."""
    bounds = F.sequence(F.lit(start).cast("date"), F.lit(end).cast("date"))
    return _calendar(spark.range(1).select(F.explode(bounds).alias("date")))


def date_dimension_of(orders: DataFrame) -> DataFrame:
    """Whole calendar years around the order dates."""
    span = orders.agg(
        F.trunc(F.min("order_date"), "year").alias("first"),
        F.last_day(F.add_months(F.trunc(F.max("order_date"), "year"), 11)).alias("last"),
    )
    return _calendar(span.select(F.explode(F.sequence("first", "last")).alias("date")))


def dim_products(products: DataFrame) -> DataFrame:
    margin: Column = rnd(
        as_double(F.col("price") - F.col("cost")) * 100.0 / as_double("price"), 2
    )
    return products.select(
        "product_id", "product_name", "category", "price", "cost", margin.alias("margin_pct")
    )


def dim_customers(customers: DataFrame) -> DataFrame:
    return customers.select(
        "customer_id", "name", "gender", "age", "city", "state", "signup_date",
        date_id("signup_date").alias("signup_date_id"), "is_age_imputed",
    )


def star_reconciliation(
    fact: DataFrame, customers: DataFrame, products: DataFrame, dates: DataFrame
) -> DataFrame:
    """Row counts of the five tables and the two money totals, as one row."""

    def rows(df: DataFrame) -> Column:
        return df.agg(F.count("*")).scalar()

    return fact.agg(
        F.count("*").alias("fact_orders_count"),
        F.sum("net_revenue").alias("total_net_revenue"),
        F.sum("net_profit").alias("total_net_profit"),
    ).withColumns(
        {
            "dim_customers_count": rows(customers),
            "dim_products_count": rows(products),
            "dim_date_count": rows(dates),
        }
    )


def import_differences(imported: dict[str, DataFrame], exported: dict[str, DataFrame]) -> DataFrame:
    """Per table: rows on both sides, and rows that only one of them has.

    Rows are counted per value on either side and compared once, so repeats count and each side
    is shuffled once, combined in its tasks first. 128 bits stand for a row, so that rows are not on
    disk once more; nulls have flags, as hashes leave them out.
    """
    parts = []
    for name, back in imported.items():
        columns = back.columns
        sides = [df.select(*columns, F.lit(i).alias("_i"), F.lit(o).alias("_o")) for df, i, o in ((back, 1, 0), (exported[name], 0, 1))]
        hashed = [*columns, *[F.isnull(c) for c in columns]]
        both = sides[0].unionByName(sides[1]).select(F.xxhash64(*hashed).alias("h1"), F.xxhash64(F.lit(1), *hashed).alias("h2"), "_i", "_o")
        counted = both.groupBy("h1", "h2").agg(F.sum("_i").alias("i"), F.sum("_o").alias("o"))
        parts.append(counted.agg(
            F.lit(name).alias("table_name"),
            F.coalesce(F.sum("i"), F.lit(0)).cast("long").alias("rows_imported"),
            F.coalesce(F.sum("o"), F.lit(0)).cast("long").alias("rows_exported"),
            F.coalesce(F.sum(F.greatest(F.col("o") - F.col("i"), F.lit(0))), F.lit(0)).cast("long").alias("rows_missing"),
            F.coalesce(F.sum(F.greatest(F.col("i") - F.col("o"), F.lit(0))), F.lit(0)).cast("long").alias("rows_added"),
        ))
    return union_all(parts)
