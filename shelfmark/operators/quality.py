"""Profiling of raw tables, root-cause analysis and reconciliation checks."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from shelfmark.functions.exprs import (
    capitalize, count_where, pct, ratio, rnd, strip_sql, sum_where,
)
from shelfmark.operators.facts import REALISED
from shelfmark.operators.validate import REASON, repeated_hashes, union_all, with_hashes
from shelfmark.session import freed_shuffles, fresh_dir, stored_counted
from shelfmark.sources.adapter import Tables

BROADCAST_HASHES = 2_000_000  # hashes that valid and rejected rows share, or that repeat, up to which they are broadcast


def _named(table: str, df: DataFrame) -> DataFrame:
    return df.select(F.lit(table).alias("table_name"), "*")


def _rules(df: DataFrame, rules: dict[str, str]) -> DataFrame:
    """Violations per rule in one pass."""
    counted = df.agg(*[count_where(cond).alias(name) for name, cond in rules.items()])
    return counted.unpivot([], list(rules), "rule", "violations")


# ------------------------------------------------------------------------- profiling
def table_profile(tables: dict[str, DataFrame], seq: str = "src_seq") -> DataFrame:
    """Row count, and per column its type and first non-null value in input order."""

    def profile(df: DataFrame) -> DataFrame:
        columns = [f for f in df.schema.fields if f.name != seq]
        samples = [
            F.min(
                F.when(F.col(f.name).isNotNull(), F.struct(seq, F.col(f.name).cast("string")))
            )["col2"]
            for f in columns
        ]
        cells = [
            F.struct(
                F.lit(f.name).alias("column_name"),
                F.lit(f.dataType.simpleString()).alias("data_type"),
                F.col(f"_sample_{i}").alias("sample_value"),
            )
            for i, f in enumerate(columns)
        ]
        one_row = df.agg(
            F.count("*").alias("row_count"),
            *[s.alias(f"_sample_{i}") for i, s in enumerate(samples)],
        )
        return one_row.select(
            "row_count", F.lit(len(columns)).alias("column_count"), F.inline(F.array(*cells))
        )

    return union_all([_named(name, profile(df)) for name, df in tables.items()])


def null_profile(tables: dict[str, DataFrame], seq: str = "src_seq") -> DataFrame:
    """Null count and percentage per column, one pass per table."""

    def profile(df: DataFrame) -> DataFrame:
        columns = [c for c in df.columns if c != seq]
        counted = df.agg(
            F.count("*").alias("row_count"),
            *[count_where(F.col(c).isNull()).alias(c) for c in columns],
        )
        return counted.unpivot(["row_count"], columns, "column_name", "null_count").withColumn(
            "null_pct", pct("null_count", "row_count")
        )

    return union_all([_named(name, profile(df)) for name, df in tables.items()])


def duplicate_profile(
    tables: dict[str, DataFrame], ids: dict[str, str], seq: str = "src_seq"
) -> DataFrame:
    """Surplus rows by whole row and by id; groups are combined before the shuffle."""

    def surplus(df: DataFrame, keys: list[str], name: str) -> DataFrame:
        per_key = df.groupBy(*keys).agg((F.count("*") - 1).alias("extra"))
        return per_key.agg(F.coalesce(F.sum("extra"), F.lit(0).cast("long")).alias(name))

    parts = []
    for table, df in tables.items():
        columns = [c for c in df.columns if c != seq]
        id_dups = surplus(df, [ids[table]], "duplicate_ids").scalar()
        parts.append(
            _named(
                table,
                surplus(df, columns, "exact_duplicates").withColumn("duplicate_ids", id_dups),
            )
        )
    return union_all(parts)


def quantity_profile(orders: DataFrame) -> DataFrame:
    """Orders by sign of the quantity with the distinct negative values.

    Quantities are counted per value first; the list holds distinct values only.
    """
    q = F.col("quantity")
    sign = F.when(q < 0, "negative").when(q == 0, "zero").when(q > 0, "positive").otherwise(
        "missing"
    )
    per_value = orders.groupBy("quantity").agg(F.count("*").alias("n"))
    total = F.sum("order_count").over(Window.partitionBy())
    return (
        per_value.groupBy(sign.alias("quantity_sign"))
        .agg(
            F.sum("n").alias("order_count"),
            F.array_join(F.sort_array(F.collect_set(F.when(q < 0, q))).cast("array<string>"), ",")
            .alias("negative_values"),
        )
        .withColumn("pct_of_orders", pct("order_count", total))
    )


def raw_revenue(orders: DataFrame, products: DataFrame) -> DataFrame:
    """Revenue statistics on unvalidated data: realised lines with a positive quantity.

    The raw status is compared after capitalising only; padded texts do not count.

    Units are summed per product before the catalogue is joined. A repeated product id
    multiplies its lines, as a plain left join on raw data does.
    """
    status = capitalize("order_status")
    lines = orders.where(status.isin("Completed", "Shipped") & (F.col("quantity") > 0))
    per_product = lines.groupBy("product_id").agg(
        F.count("*").alias("n"), F.sum("quantity").alias("units")
    )
    priced = per_product.join(products.select("product_id", "price", "cost"), "product_id", "left")
    revenue, cost = (F.col("units") * F.col(c) for c in ("price", "cost"))
    return priced.agg(
        F.sum("n").alias("completed_lines"),
        F.sum("units").alias("total_units_sold"),
        F.sum(revenue).alias("total_gross_revenue"),
        F.sum(cost).alias("total_cost"),
        F.sum(revenue - cost).alias("gross_profit"),
        F.sum(F.when(F.col("price").isNotNull(), F.col("n"))).alias("_priced"),
    ).select(
        "completed_lines",
        "total_units_sold",
        "total_gross_revenue",
        "total_cost",
        "gross_profit",
        rnd(
            "cast(gross_profit as double) / nullif(cast(total_gross_revenue as double), 0)"
            " * 100.0D",
            2,
        ).alias("gross_margin_pct"),
        rnd(ratio("total_gross_revenue", "_priced"), 2).alias("average_order_value"),
    )


def value_distribution(df: DataFrame, value: Column, field: str) -> DataFrame:
    """Counts per value with its own row for NULL. The total is a scalar subquery, so raw texts
    that are all distinct never meet in one task."""
    counts = df.groupBy(value.alias("value")).agg(F.count("*").alias("n"))
    total = counts.agg(F.sum("n").alias("total")).scalar()
    return counts.withColumn("pct_of_rows", pct("n", total)).select(
        F.lit(field).alias("field"), "value", "n", "pct_of_rows"
    )


def order_distributions(raw_orders: DataFrame) -> DataFrame:
    status = capitalize("order_status")
    return value_distribution(raw_orders, status, "order_status").unionByName(
        value_distribution(raw_orders, F.col("payment_method"), "payment_method")
    )


def foreign_key_audit(orders: DataFrame, parent: DataFrame, key: str) -> DataFrame:
    """Unique, used, unused and orphan keys of one relation, on distinct key lists."""
    known = parent.select(key).distinct().withColumn("known", F.lit(1))
    used = orders.select(key).distinct().withColumn("used", F.lit(1))
    both = known.join(used, known[key].eqNullSafe(used[key]), "full")
    is_known, is_used = F.col("known").isNotNull(), F.col("used").isNotNull()
    return both.agg(
        count_where(is_known).alias("unique_keys"),
        count_where(is_used).alias("used_keys"),
        count_where(is_known & ~is_used).alias("unused_keys"),
        count_where(is_used & ~is_known).alias("orphan_keys"),
    ).select(
        F.lit(key).alias("relation"), "*", pct("unused_keys", "unique_keys").alias("unused_pct")
    )


def foreign_key_audits(raw: Tables) -> DataFrame:
    return foreign_key_audit(raw.orders, raw.customers, "customer_id").unionByName(
        foreign_key_audit(raw.orders, raw.products, "product_id")
    )


def temporal_violations(orders: DataFrame, customers: DataFrame) -> DataFrame:
    """Orders before the sign-up of their customer; the first customer row counts.

    Orders are counted per (customer, day) first, so a hot customer joins as its days.
    """
    signup = customers.groupBy("customer_id").agg(
        F.min(F.struct("src_seq", "signup_date"))["signup_date"].alias("signup")
    )
    per_day = orders.groupBy("customer_id", "order_date").agg(F.count("*").alias("n"))
    return per_day.join(signup, "customer_id", "left").agg(
        F.sum("n").alias("orders_checked"),
        sum_where("order_date < signup", "n").alias("orders_before_signup"),
    )


# ------------------------------------------------------------------------ root causes
def orphan_root_causes(raw: Tables, valid_products: DataFrame) -> DataFrame:
    """Raw orders per product that exists in the raw catalogue but failed validation."""
    failed = raw.products.select("product_id").distinct().join(
        valid_products.select("product_id"), "product_id", "left_anti"
    )
    per_product = raw.orders.groupBy("product_id").agg(
        F.count("*").alias("referencing_orders"),
        count_where(F.col("quantity") <= 0).alias("orders_with_bad_quantity"),
    )
    return per_product.join(failed, "product_id", "left_semi")


def negative_quantities(raw_orders: DataFrame) -> DataFrame:
    return (
        raw_orders.where("quantity < 0")
        .groupBy("quantity", "order_status")
        .agg(F.count("*").alias("order_count"))
    )


def margin_divergence(products: DataFrame) -> DataFrame:
    """Largest gap between stored and recomputed margin, and impossible margins."""
    price, cost = F.col("price").cast("double"), F.col("cost").cast("double")
    stored = F.col("gross_margin_pct")
    gap = F.abs(stored - (price - cost) / price * 100.0)
    return products.agg(
        rnd(F.max(gap), 6).alias("max_divergence"),
        F.coalesce(F.max(stored < 0), F.lit(False)).alias("any_negative"),
        F.coalesce(F.max(stored > 100), F.lit(False)).alias("any_above_100"),
    )


def dead_letter_completeness(rejected: DataFrame) -> DataFrame:
    """Missing or blank cells per column, and payloads that are not JSON."""
    fields = ("table_name", "record_identifier", REASON, "rejected_at", "raw_payload")

    def blank(c: str) -> str:
        return f"coalesce({strip_sql(f'cast({c} as string)')}, '') = ''"

    return _rules(
        rejected,
        {**{f"{c}_missing": blank(c) for c in fields}, "payload_not_json": "try_parse_json(raw_payload) IS NULL"},
    )


PAYLOAD = "order_id string, customer_id string, product_id string, quantity int, order_status string"


def payload_fields(rejected: DataFrame, reason: str | None = None) -> DataFrame:
    """Typed fields of quarantined orders, parsed back from their payload."""
    orders = rejected.where("table_name = 'orders'")
    if reason is not None:
        orders = orders.where(F.col(REASON) == reason)
    return orders.select(REASON, F.from_json("raw_payload", PAYLOAD).alias("p")).select(
        REASON, "p.*"
    )


def dead_letter_samples(rejected: DataFrame, preview: int = 120) -> DataFrame:
    """One record per reason, the smallest by identifier and payload, with a short preview.

    ``min`` over a struct combines on the map side; no group is collected.
    """
    pick = F.min(F.struct("record_identifier", "raw_payload", "table_name")).alias("s")
    return rejected.groupBy(REASON).agg(pick).select(
        REASON,
        "s.table_name",
        "s.record_identifier",
        F.substring("s.raw_payload", 1, preview).alias("payload_preview"),
    )


def status_units(orders: DataFrame) -> DataFrame:
    return orders.groupBy("order_status").agg(
        F.count("*").alias("order_count"), F.sum("quantity").alias("total_units")
    )


def refund_quantities(orders: DataFrame) -> DataFrame:
    return (
        orders.where("order_status = 'Refunded'")
        .groupBy("quantity")
        .agg(F.count("*").alias("order_count"))
    )


# --------------------------------------------------------------------- reconciliation
def revenue_identities(lines: DataFrame) -> DataFrame:
    """gross - (net + refunded + cancelled) - other, and net - (profit + cost of goods)."""
    other = f"NOT ({REALISED} OR order_status IN ('Refunded', 'Cancelled'))"
    sums = lines.agg(
        F.sum("gross_revenue").alias("gross"),
        F.sum("net_revenue").alias("net"),
        F.sum("refunded_amount").alias("refunded"),
        F.sum("cancelled_amount").alias("cancelled"),
        F.sum("net_profit").alias("profit"),
        sum_where(REALISED, "total_cost").alias("cogs"),
        sum_where(other, "gross_revenue").alias("other"),
    )
    return sums.select(
        "*",
        (F.col("gross") - F.col("net") - F.col("refunded") - F.col("cancelled")).alias(
            "gross_difference"
        ),
        (F.col("net") - F.col("profit") - F.col("cogs")).alias("net_difference"),
    )


def _per_key(lines: DataFrame, keys: dict[str, Column], sums: list[Column]) -> DataFrame:
    """``kind`` and ``key`` (as text) with the sums of each key of every kind, in one pass.

    The rows are grouped by one key column at a time; partial sums are formed in each task.
    """
    names = list(keys)
    sets = lines.select(*[k.cast("string").alias(n) for n, k in keys.items()], "_r", "_p")
    grouped = sets.groupingSets([[n] for n in names], *names).agg(F.grouping_id().alias("_g"), *sums)
    # of k columns, the one that is grouped by has the only bit that is not set
    bits = {n: (1 << len(names)) - 1 - (1 << (len(names) - 1 - i)) for i, n in enumerate(names)}
    kind = F.coalesce(*[F.when(F.col("_g") == bit, n) for n, bit in bits.items()])
    return grouped.withColumns({"kind": kind, "key": F.coalesce(*names)}).drop("_g", *names)


def cross_totals(lines: DataFrame) -> DataFrame:
    """Net revenue and profit re-summed per customer, product, day and month."""
    keys = {
        "customer": F.col("customer_id"),
        "product": F.col("product_id"),
        "day": F.col("order_date"),
        "month": F.trunc("order_date", "month"),
    }
    values = lines.withColumns({"_r": F.col("net_revenue"), "_p": F.col("net_profit")})
    sums = [F.sum("_r").alias("r"), F.sum("_p").alias("p")]
    of = lambda kind, c: F.when(F.col("kind") == kind, F.col(c))
    cells = [
        F.struct(
            F.lit(kind).alias("dimension"),
            count_where(F.col("kind") == kind).alias("members"),
            F.sum(of(kind, "r")).alias("net_revenue"),
            F.sum(of(kind, "p")).alias("net_profit"),
        )
        for kind in keys
    ]
    return _per_key(values, keys, sums).agg(F.array(*cells).alias("cells")).select(F.inline("cells"))


def with_met_hashes(df: DataFrame, id_col: str, ids: DataFrame) -> DataFrame:
    """The rows whose id has the hash of one of ``ids``: all rows that share an id with it, and few others."""
    of = F.xxhash64(F.col(id_col).cast("string"))
    met = df.where(F.col(id_col).isNotNull()).select(of.alias("_hash")).join(ids.select(of.alias("_hash")), "_hash", "left_semi").distinct()
    met, n = stored_counted(met, fresh_dir(df.sparkSession, "met-hashes"))
    return df.join(F.broadcast(met) if n <= BROADCAST_HASHES else met, of == F.col("_hash"), "left_semi")


def quarantine_isolation(valid: Tables, rejected: DataFrame, ids: dict[str, str]) -> DataFrame:
    """Valid rows whose id was also rejected for another reason than being a repeat.

    Hashes of the ids move first; ids move only of rows whose hash both sides have.
    """
    parts = []
    for table, df in valid.items().items():
        bad = (
            rejected.where((F.col("table_name") == table) & ~F.col(REASON).startswith("DUPLICATE"))
            .select(F.col("record_identifier").alias(ids[table]))
            .distinct()
        )
        met = with_met_hashes(df.select(ids[table]), ids[table], bad)
        leaked = met.join(bad, ids[table], "left_semi").agg(F.count("*").alias("leaked_rows"))
        parts.append(_named(table, leaked))
    return union_all(parts)


def repeated_rows(df: DataFrame, id_col: str) -> DataFrame:
    """``n``: rows beyond the first of each id; rows without id count as one id.

    Only a hash of each id moves, then the ids of the rows whose hash is not their own.
    """
    spark = df.sparkSession
    with freed_shuffles(spark):
        hashes, n = stored_counted(repeated_hashes(df, id_col), fresh_dir(spark, "repeated-hashes"))
    met = with_hashes(df.select(id_col), id_col, F.broadcast(hashes) if n <= BROADCAST_HASHES else hashes)
    return met.groupBy(id_col).agg((F.count("*") - 1).alias("n")).agg(F.coalesce(F.sum("n"), F.lit(0)).cast("long").alias("n"))


def star_integrity(
    fact: DataFrame, customers: DataFrame, products: DataFrame, dates: DataFrame,
    analytics: DataFrame,
) -> DataFrame:
    """Orphans, repeated keys, 1:1 analytics and calendar coverage of the star schema."""

    keys = {k: F.col(k) for k in ("customer_id", "product_id", "order_date_id")}
    counted = fact.withColumns({"_r": F.lit(1), "_p": F.lit(0)})
    per_key = _per_key(counted, keys, [F.count("*").alias("n")])

    def listed(df: DataFrame, key: str, kind: str) -> DataFrame:
        return df.groupBy(F.col(key).cast("string").alias("_key")).agg(F.count("*").alias("_rows")).withColumn("_kind", F.lit(kind))

    parents = union_all([
        listed(customers, "customer_id", "customer_id"),
        listed(products, "product_id", "product_id"),
        listed(dates, "date_id", "order_date_id"),
    ])
    # the fact's keys of all kinds meet the dimensions' in one join
    met = per_key.join(
        parents, (F.col("kind") == F.col("_kind")) & (F.col("key") == F.col("_key")), "full")
    kind, extra = F.coalesce("kind", "_kind"), F.col("_rows") - 1

    def total(rule: str, of: str, when: Column, value: Column) -> Column:
        found = F.sum(F.when((kind == of) & when, value))
        return F.struct(F.lit(rule).alias("rule"), F.coalesce(found, F.lit(0)).cast("long").alias("violations"))

    unknown, known = F.col("_key").isNull(), F.col("_key").isNotNull()
    cells = met.agg(F.array(
        total("fact_without_customer", "customer_id", unknown, F.col("n")),
        total("fact_without_product", "product_id", unknown, F.col("n")),
        total("fact_without_date", "order_date_id", unknown, F.col("n")),
        total("repeated_customer", "customer_id", known, extra),
        total("repeated_product", "product_id", known, extra),
        total("repeated_date", "order_date_id", known, extra),
    ).alias("cells"))
    orders = repeated_rows(fact, "order_id").select(F.lit("repeated_order").alias("rule"), F.col("n").alias("violations"))
    sides = listed(customers, "customer_id", "c").join(
        listed(analytics, "customer_id", "a").withColumnsRenamed({"_key": "_other", "_rows": "_others", "_kind": "_side"}),
        F.col("_key") == F.col("_other"), "full")
    pairs = sides.agg(F.array(
        F.struct(F.lit("customer_without_analytics").alias("rule"), F.coalesce(F.sum(F.when(F.col("_others").isNull(), F.col("_rows"))), F.lit(0)).cast("long").alias("violations")),
        F.struct(F.lit("analytics_without_customer").alias("rule"), F.coalesce(F.sum(F.when(F.col("_rows").isNull(), F.col("_others"))), F.lit(0)).cast("long").alias("violations")),
    ).alias("cells"))
    return union_all([cells.select(F.inline("cells")), orders, pairs.select(F.inline("cells"))])


def view_completeness(view: DataFrame) -> DataFrame:
    """Blank names in the order view, and completed flags outside the realised statuses."""

    def blank(c: str) -> str:
        return f"coalesce({strip_sql(c)}, '') = ''"

    return _rules(
        view,
        {
            "customer_name_blank": blank("customer_name"),
            "product_name_blank": blank("product_name"),
            "completed_flag_wrong": f"(is_completed = 1) <> ({REALISED})",
        },
    )


def feature_bounds(features: DataFrame, cutoff: str) -> DataFrame:
    """Features dated after the cutoff, negative spans, shares outside [0, 1]."""
    shares = ("refund_rate", "cancellation_rate", "recent_revenue_ratio", "recent_order_ratio")
    spans = ("recency_days", "account_age_days", "customer_lifetime_days")
    return _rules(
        features,
        {
            "last_order_after_cutoff": f"last_order_date > date'{cutoff}'",
            "signup_after_cutoff": f"signup_date > date'{cutoff}'",
            **{f"{c}_negative": f"{c} < 0" for c in spans},
            **{f"{c}_out_of_range": f"{c} NOT BETWEEN 0 AND 1" for c in shares},
        },
    )
