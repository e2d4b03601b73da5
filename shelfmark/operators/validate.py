"""Rule validation: every row gets at most one rejection reason, first rule wins.

Each ``check_*`` returns its input plus ``rejection_reason`` (NULL for valid rows).
Valid rows, dead letters and statistics are all read from that one annotated plan.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, functions as F

from shelfmark.functions.exprs import count_where, pct, sum_where

REASON = "rejection_reason"
SEQ = "src_seq"

# The ids of the three tables.
ID_COLUMNS = {"customers": "customer_id", "products": "product_id", "orders": "order_id"}


def repeated_ids(df: DataFrame, id_col: str, seq: str = SEQ) -> DataFrame:
    """``_id`` and ``_first``: the ids that several rows have, and the first place of each.

    Rows are counted with map-side combine, so a hot id is one row for each task. All rows
    without id count as one id.
    """
    return (
        df.groupBy(F.col(id_col).alias("_id"))
        .agg(F.min(seq).alias("_first"), F.count("*").alias("_n"))
        .where("_n > 1")
        .drop("_n")
    )


def repeated_hashes(df: DataFrame, id_col: str) -> DataFrame:
    """``_hash``: the hashes that several rows have in place of their id."""
    return df.groupBy(F.xxhash64(id_col).alias("_hash")).agg(F.count("*").alias("_n")).where("_n > 1").drop("_n")


def with_hashes(df: DataFrame, id_col: str, hashes: DataFrame) -> DataFrame:
    """The rows whose id has one of ``hashes``: all rows of repeated ids, and few others."""
    return df.join(hashes, F.xxhash64(id_col) == F.col("_hash"), "left_semi")


def flag_repeats(
    df: DataFrame, id_col: str, seq: str = SEQ, repeated: DataFrame | None = None
) -> DataFrame:
    """Add ``is_repeat``: true for every row of an id but its first in input order, and
    ``is_first``: true for the first row of an id that has several.

    Only repeated ids are joined back (``repeated``, if they are stored already), so that side
    is small in clean data (AQE then broadcasts it after seeing its size) and holds one row
    per id in dirty data. Rows without id are compared with one number and match nothing in
    the join. A window over the id would sort all rows of one hot id in a single task; here
    AQE can split the row side of the join. ``seq`` must be unique within an id: see
    ``Etl.checked``, which counts the first rows.
    """
    if repeated is None:
        repeated = repeated_ids(df, id_col, seq)
    unnamed = repeated.where("_id IS NULL").select("_first").scalar()
    first = F.coalesce(F.col("_first"), F.when(F.col(id_col).isNull(), unnamed))
    return (
        df.join(repeated.where("_id IS NOT NULL"), F.expr(f"{id_col} = _id"), "left")
        .withColumn("_first", first)
        .withColumns(
            {
                "is_repeat": F.expr(f"coalesce({seq} > _first, false)"),
                "is_first": F.expr(f"coalesce({seq} = _first, false)"),
            }
        )
        .drop("_id", "_first")
    )


def _first_reason(rules: dict[str, str]) -> Column:
    """Name of the first rule that is TRUE; a rule that evaluates to NULL does not fire."""
    return F.expr(
        "CASE " + " ".join(f"WHEN {cond} THEN '{name}'" for name, cond in rules.items()) + " END"
    )


# Rules per table in order of precedence, as (name, rejecting condition).
CUSTOMER_RULES = {
    "DUPLICATE_CUSTOMER_ID": "is_repeat",
    "INVALID_AGE_OUT_OF_BOUNDS": "age < 18 OR age > 100",
}
PRODUCT_RULES = {
    "DUPLICATE_PRODUCT_ID": "is_repeat",
    "MISSING_PRODUCT_CATEGORY": "category IS NULL",
    "MISSING_PRODUCT_COST": "cost IS NULL",
    "INVALID_PRICE_NON_POSITIVE": "price IS NULL OR price <= 0",
    "INVALID_COST_NON_POSITIVE": "cost <= 0",
    "INVALID_COST_EXCEEDS_PRICE": "cost > price",
}
ORDER_RULES = {
    "DUPLICATE_ORDER_ID": "is_repeat",
    "INVALID_QUANTITY_NEGATIVE_RETURN": "quantity < 0",
    "INVALID_QUANTITY_ZERO": "quantity = 0",
    "ORPHAN_CUSTOMER_FOREIGN_KEY": "known_customer IS NULL",
    "ORPHAN_PRODUCT_FOREIGN_KEY": "known_product IS NULL",
}


RULES = {"customers": CUSTOMER_RULES, "products": PRODUCT_RULES, "orders": ORDER_RULES}
FIRST = "is_first"


def check_customers(cleaned: DataFrame, repeated: DataFrame | None = None) -> DataFrame:
    flagged = flag_repeats(cleaned, "customer_id", repeated=repeated)
    return flagged.withColumn(REASON, _first_reason(CUSTOMER_RULES)).drop("is_repeat")


def check_products(cleaned: DataFrame, repeated: DataFrame | None = None) -> DataFrame:
    flagged = flag_repeats(cleaned, "product_id", repeated=repeated)
    return flagged.withColumn(REASON, _first_reason(PRODUCT_RULES)).drop("is_repeat")


def check_orders(
    cleaned: DataFrame, valid_customers: DataFrame, valid_products: DataFrame,
    repeated: DataFrame | None = None, dealt: tuple[int, str] | None = None,
) -> DataFrame:
    """Orders are checked against *validated* dimensions, whose ids are unique.

    The product join also brings ``unit_price`` and ``unit_cost``, so that no later step has
    to join order lines with products for them.

    The customer join comes last: reports group by product or join the catalogue next, so
    each of the three joins is followed by another exchange and AQE is free to split a hot
    key in any of them. With ``dealt`` (number, column) rows are dealt by that column before it: by
    customer, the join needs no other exchange of them then.
    """
    customer_ids = valid_customers.selectExpr("customer_id as known_customer")
    product_ids = valid_products.selectExpr(
        "product_id as known_product", "price as unit_price", "cost as unit_cost"
    )
    priced = flag_repeats(cleaned, "order_id", repeated=repeated).join(
        product_ids, F.expr("product_id = known_product"), "left")
    # whether there is one, so that the id does not move twice
    priced = priced.withColumn("known_product", F.expr("if(known_product IS NULL, NULL, true)"))
    if dealt:
        priced = priced.repartition(*dealt)
    return (
        priced.join(customer_ids, F.expr("customer_id = known_customer"), "left")
        .withColumn(REASON, _first_reason(ORDER_RULES))
        .drop("is_repeat", "known_customer", "known_product")
    )


REJECTED = "is_rejected"
YEAR = "order_year"


def split(checked: DataFrame) -> DataFrame:
    """``checked`` with the columns it is stored by: the outcome, and the year of an order."""
    out = checked.withColumn(REJECTED, F.col(REASON).isNotNull())
    return out.withColumn(YEAR, F.year("order_date")) if "order_date" in checked.columns else out


def outcome_counts(table: str) -> list[Column]:
    """Rows, rows per rejection reason and first rows of repeated ids, to observe on a write."""
    reasons = [count_where(f"{REASON} = '{name}'").alias(name) for name in RULES[table]]
    return [F.count(F.lit(1)).alias("rows"), *reasons, count_where(FIRST).alias(FIRST)]


def valid_rows(checked: DataFrame) -> DataFrame:
    """Rows without a reason; of a stored table, only its valid directories are read."""
    if REJECTED in checked.columns:
        checked = checked.where(f"NOT {REJECTED}")
    return checked.where(F.col(REASON).isNull()).drop(REASON, REJECTED, FIRST)


def rejected_rows(checked: DataFrame) -> DataFrame:
    """Rows with a reason; of a stored table, only its rejected directories are read."""
    return checked.where(REJECTED if REJECTED in checked.columns else f"{REASON} IS NOT NULL")


def dead_letters(
    checked: DataFrame, table_name: str, rejected_at: str, id_col: str | None = None
) -> DataFrame:
    """Rejected rows in the dead-letter layout; the payload is the cleaned row as JSON."""
    id_col = id_col or ID_COLUMNS[table_name]
    added = (REASON, SEQ, FIRST, REJECTED, YEAR, "unit_price", "unit_cost")
    payload = [c for c in checked.columns if c not in added]
    known = F.col(id_col).cast("string") if id_col in checked.columns else F.lit(None)
    identifier = F.coalesce(known, F.lit("UNKNOWN"))
    return rejected_rows(checked).select(
        F.lit(table_name).alias("table_name"),
        identifier.alias("record_identifier"),
        F.col(REASON),
        F.lit(rejected_at).cast("timestamp").alias("rejected_at"),
        F.to_json(F.struct(*payload), {"ignoreNullFields": "false"}).alias("raw_payload"),
    )


def reason_counts(checked: DataFrame, table_name: str) -> DataFrame:
    """Rows per outcome of one table; NULL reason is the valid bucket."""
    return checked.groupBy(REASON).agg(F.count("*").alias("n")).select(
        F.lit(table_name).alias("table_name"), REASON, "n"
    )


def union_all(frames: list[DataFrame]) -> DataFrame:
    return reduce(DataFrame.unionByName, frames)


def validation_stats(outcomes: DataFrame) -> DataFrame:
    """Input, valid and rejected rows per table with the pass rate, from reason counts."""
    return (
        outcomes.groupBy("table_name")
        .agg(
            F.sum("n").alias("total_input"),
            sum_where(f"{REASON} IS NULL", "n").alias("valid_count"),
            sum_where(f"{REASON} IS NOT NULL", "n").alias("rejected_count"),
        )
        .withColumn("pass_rate_pct", pct("valid_count", "total_input"))
    )


# ---------------------------------------------------------------- declared constraints
# The order statuses a table constraint allows.
STATUSES = ("Completed", "Shipped", "Cancelled", "Refunded")


def declared_rules(table: str) -> dict[str, str]:
    """Row-level constraints of the relational schema."""
    required = {
        "customers": ("name", "gender", "age", "city", "state", "signup_date", "is_age_imputed"),
        "products": ("product_name", "category", "price", "cost", "gross_margin_pct"),
        "orders": (
            "customer_id", "product_id", "order_date", "quantity", "payment_method", "order_status",
        ),
    }[table]
    statuses = ", ".join(f"'{s}'" for s in STATUSES)
    domain = {
        "customers": {"age_between_18_and_120": "age BETWEEN 18 AND 120"},
        "products": {
            "price_positive": "price > 0",
            "cost_positive": "cost > 0",
            "cost_at_most_price": "cost <= price",
        },
        "orders": {
            "quantity_positive": "quantity > 0",
            "status_in_domain": f"order_status IN ({statuses})",
        },
    }[table]
    return {**{f"{name}_not_null": f"{name} IS NOT NULL" for name in required}, **domain}


def check_constraints(df: DataFrame, table: str, rules: dict[str, str]) -> DataFrame:
    """Violations per rule in one pass, unpivoted to (table_name, rule, violations).

    As in SQL, a CHECK passes when it evaluates to NULL.
    """
    counted = df.agg(*[count_where(f"NOT ({cond})").alias(n) for n, cond in rules.items()])
    return counted.unpivot([], list(rules), "rule", "violations").select(
        F.lit(table).alias("table_name"), "rule", "violations"
    )


def key_violations(df: DataFrame, table: str, id_col: str) -> DataFrame:
    """Rows beyond the first of each key, plus rows without a key."""
    per_key = df.groupBy(id_col).agg(F.count("*").alias("n"))
    return per_key.agg(
        F.sum(F.when(F.col(id_col).isNull(), F.col("n")).otherwise(F.col("n") - 1)).alias("v")
    ).select(
        F.lit(table).alias("table_name"),
        F.lit("primary_key").alias("rule"),
        F.coalesce("v", F.lit(0).cast("long")).alias("violations"),
    )


def foreign_key_violations(
    df: DataFrame, table: str, key: str, parent: DataFrame
) -> DataFrame:
    """Rows whose non-null key has no parent; keys are counted before the join."""
    used = df.where(F.col(key).isNotNull()).groupBy(key).agg(F.count("*").alias("n"))
    orphans = used.join(parent.select(key).distinct(), key, "left_anti")
    return orphans.agg(F.coalesce(F.sum("n"), F.lit(0).cast("long")).alias("violations")).select(
        F.lit(table).alias("table_name"), F.lit(f"{key}_foreign_key").alias("rule"), "violations"
    )


def declared_constraints(tables: dict[str, DataFrame]) -> DataFrame:
    """All declared constraints over customers, products and orders."""
    parts = []
    for name, df in tables.items():
        parts.append(check_constraints(df, name, declared_rules(name)))
        parts.append(key_violations(df, name, ID_COLUMNS[name]))
    for key, parent in (("customer_id", "customers"), ("product_id", "products")):
        parts.append(foreign_key_violations(tables["orders"], "orders", key, tables[parent]))
    return union_all(parts)
