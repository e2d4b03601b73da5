"""Clean, validate and split: raw tables in, validated store and dead letters out."""

from __future__ import annotations

from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass
from functools import cached_property

from pyspark.sql import DataFrame, Observation, functions as F

from shelfmark import schemas
from shelfmark.functions.exprs import count_where, pct
from shelfmark.operators import clean, validate
from shelfmark.operators.validate import REASON
from shelfmark.session import freed_shuffles, fresh_dir, parts_for, stored_counted, stored_split, wide_shuffles
from shelfmark.sources.adapter import Tables


HOT_SHARE = 4  # times an even bucket that one customer's orders may fill
SHARE_ROWS, SHARES = 3_000_000, 4  # order lines from which they are checked in shares, and most shares
BROADCAST_IDS = 2_000_000  # repeated order ids up to which they are broadcast: about 400 MB, computed


def _sent(ids: DataFrame, n: int) -> DataFrame:
    """``ids``, broadcast if they are at most BROADCAST_IDS rows; else Spark decides by their size."""
    return F.broadcast(ids) if n <= BROADCAST_IDS else ids


@dataclass(frozen=True)
class Etl:
    """Cleaning and validation of one set of raw tables.

    The annotated tables are written once to the shared folder (``store_dir``, by default
    a new one), split into valid and rejected rows, orders by year as well. Valid rows and dead
    letters are read from there, so a report never repeats the cleaning and opens only the
    rows it is about, and every join sees the true size of a dimension: below Spark's
    threshold it is broadcast, above it is shuffled. Outcomes are counted while the rows are written.

    Orders carry their unit price and cost and are dealt into buckets by customer, the more the
    larger the table, so that a bucket is sorted in memory. If one customer has more orders than HOT_SHARE even buckets, they are left undealt: then Spark
    shuffles by customer, after combining rows in each task.
    """

    raw: Tables
    run_timestamp: str = "1970-01-01 00:00:00"
    store_dir: str | None = None

    @cached_property
    def cleaned(self) -> Tables:
        return Tables(
            clean.clean_customers(self.raw.customers),
            clean.clean_products(self.raw.products),
            clean.clean_orders(self.raw.orders),
        )

    @cached_property
    def _out(self) -> str:
        return self.store_dir or fresh_dir(self.raw.orders.sparkSession, "checked")

    def _repeated(self, name: str, cleaned: DataFrame) -> tuple[DataFrame, int]:
        ids = validate.repeated_ids(cleaned, validate.ID_COLUMNS[name])
        return stored_counted(ids, f"{self._out}/repeated-{name}")

    def _repeated_orders(self, cleaned: DataFrame) -> tuple[DataFrame, int]:
        """As ``_repeated``, in two steps: only a hash of each id is moved, then the ids and places of the
        rows whose hash is not their own. Up to BROADCAST_IDS of either move no order line."""
        id_col = validate.ID_COLUMNS["orders"]
        hashes = stored_counted(validate.repeated_hashes(cleaned, id_col), f"{self._out}/repeated-hashes")
        ids, n = self._repeated("orders", validate.with_hashes(cleaned, id_col, _sent(*hashes)))
        return _sent(ids, n), n

    def _store(
        self, name: str, shares: list[DataFrame], repeated: int, by: list[str],
        buckets: tuple[int, str] | None = None,
    ) -> tuple[DataFrame, dict[str, int]]:
        """Write the shares of one annotated table, dealt by its bucket column if there is one; its
        counts are taken on the way, in the writing stages."""
        seen = [Observation() for _ in shares]
        watched = [validate.split(df).observe(o, *validate.outcome_counts(name)).drop(validate.FIRST) for df, o in zip(shares, seen)]
        table = stored_split(watched[0], f"{self._out}/{name}", by, buckets, watched[1:])
        counts = {what: sum(o.get[what] for o in seen) for what in seen[0].get}
        if counts[validate.FIRST] != repeated:
            raise ValueError(f"{name}: rows of one id share their {validate.SEQ}")
        return table, counts

    def _store_dimension(self, name: str, cleaned: DataFrame, check) -> tuple[DataFrame, dict[str, int]]:
        repeated, n = self._repeated(name, cleaned)
        return self._store(name, [check(cleaned, repeated)], n, [validate.REJECTED])

    @cached_property
    def _customer_rows(self) -> tuple[int, int]:
        """Orders of the customer with most of them, and of all."""
        per_customer = self.raw.orders.groupBy("customer_id").agg(F.count("*").alias("n"))
        most, total = per_customer.agg(F.max("n"), F.sum("n")).first()
        return most or 0, total or 0

    def _buckets(self) -> tuple[int, str] | None:
        """Buckets by customer, unless a customer would fill too much of one."""
        most, total = self._customer_rows
        n = parts_for(self.raw.orders.sparkSession, total)
        return None if most * n > HOT_SHARE * total else (n, "customer_id")

    def _shares(self, orders: DataFrame, buckets: tuple[int, str] | None) -> list[DataFrame]:
        """Orders in shares by customer, whole buckets each, of which every core has one. The shuffle files
        of one share's joins go before the next one is read, so that order lines are not on disk twice over."""
        n = min(SHARES, -(-self._customer_rows[1] // SHARE_ROWS))
        if buckets:
            n = min(n, buckets[0] // orders.sparkSession.sparkContext.defaultParallelism)
        if n <= 1:
            return [orders]
        of = F.pmod(F.hash("customer_id"), F.lit(buckets[0] if buckets else n)) % n
        return [orders.where(of == i) for i in range(n)]

    @cached_property
    def _checked(self) -> dict[str, tuple[DataFrame, dict[str, int]]]:
        cleaned = self.cleaned
        with freed_shuffles(self.raw.orders.sparkSession), ThreadPoolExecutor(4) as jobs:  # independent Spark jobs
            dims = {
                "customers": jobs.submit(
                    self._store_dimension, "customers", cleaned.customers, validate.check_customers),
                "products": jobs.submit(
                    self._store_dimension, "products", cleaned.products, validate.check_products),
            }
            buckets = self._buckets()
            with wide_shuffles(self.raw.orders.sparkSession, self._customer_rows[1]):
                repeated = jobs.submit(self._repeated_orders, cleaned.orders)
                out = {name: job.result() for name, job in dims.items()}
                ids, n = repeated.result()
                dimensions = [validate.valid_rows(df) for df, _ in out.values()]
                shares = [
                    validate.check_orders(df, *dimensions, ids, buckets) for df in self._shares(cleaned.orders, buckets)
                ]
                by = [validate.REJECTED, validate.YEAR]
                out["orders"] = self._store("orders", shares, n, by, buckets)
        return out

    @cached_property
    def checked(self) -> Tables:
        return Tables(**{name: df for name, (df, _) in self._checked.items()})

    @cached_property
    def valid(self) -> Tables:
        """The validated tables in their published columns."""
        return Tables(**{
            n: validate.valid_rows(df).select(*schemas.CLEAN[n].names)
            for n, df in self.checked.items().items()
        })

    @cached_property
    def priced(self) -> Tables:
        """The validated tables; orders with their prices, year and bucketing."""
        orders = validate.valid_rows(self.checked.orders).drop(validate.SEQ)
        return Tables(self.valid.customers, self.valid.products, orders)

    @cached_property
    def rejected(self) -> DataFrame:
        return validate.union_all(
            [
                validate.dead_letters(df, name, self.run_timestamp)
                for name, df in self.checked.items().items()
            ]
        )

    @cached_property
    def outcomes(self) -> DataFrame:
        """Rows per table and rejection reason; NULL is the valid bucket. One row per rule."""
        rows = []
        for name, (_, counts) in self._checked.items():
            reasons = {rule: counts[rule] for rule in validate.RULES[name]}
            valid = counts["rows"] - sum(reasons.values())
            rows += [(name, rule, n) for rule, n in ((None, valid), *reasons.items()) if n]
        spark = self.raw.orders.sparkSession
        return spark.createDataFrame(rows, f"table_name string, {REASON} string, n long")

    @cached_property
    def stats(self) -> DataFrame:
        return validate.validation_stats(self.outcomes)

    @cached_property
    def reasons(self) -> DataFrame:
        return self.outcomes.where(F.col(REASON).isNotNull())


def run_audit(
    etl: Etl, run_id: str, run_timestamp: str | None = None, duration_seconds: float = 0.0
) -> DataFrame:
    """One nested row describing a run: extraction, cleaning and validation."""
    raw, cleaned = etl.raw, etl.cleaned
    tables = etl.stats.agg(
        F.sum("total_input").alias("total_extracted"),
        F.sum("valid_count").alias("total_valid"),
        F.sum("rejected_count").alias("total_rejected"),
        F.map_from_entries(F.collect_list(F.struct("table_name", "total_input"))).alias("counts"),
        F.map_from_entries(
            F.collect_list(
                F.struct(
                    "table_name",
                    F.struct("total_input", "valid_count", "rejected_count", "pass_rate_pct"),
                )
            )
        ).alias("tables"),
    )
    breakdown = etl.reasons.agg(
        F.map_from_entries(F.collect_list(F.struct(REASON, "n")))
    ).scalar()  # one entry per rule
    statuses = clean.status_distribution(cleaned.orders).agg(
        F.map_from_entries(
            F.collect_list(
                F.struct(F.coalesce("order_status", F.lit("missing")), "order_count")
            )
        )
    ).scalar()

    def one(df: DataFrame):
        return df.select(F.struct(*df.columns)).scalar()

    return tables.select(
        F.lit(run_id).alias("pipeline_run_id"),
        F.lit(run_timestamp or etl.run_timestamp).cast("timestamp").alias("run_timestamp"),
        F.lit(duration_seconds).alias("duration_seconds"),
        F.struct("total_extracted", "counts").alias("extraction"),
        F.struct(
            one(clean.customer_clean_stats(cleaned.customers, raw.customers)).alias("customers"),
            one(clean.product_clean_stats(cleaned.products)).alias("products"),
            one(clean.order_clean_stats(cleaned.orders)).alias("orders"),
            statuses.alias("status_distribution"),
        ).alias("transformation"),
        F.struct(
            "total_valid",
            "total_rejected",
            pct("total_valid", "total_extracted").alias("overall_pass_rate_pct"),
            "tables",
            breakdown.alias("dead_letter_queue_breakdown"),
        ).alias("validation"),
    )


def audit_log_row(audit: DataFrame, database_type: str) -> DataFrame:
    """The flat log row of a run, with the whole audit as JSON text."""
    return audit.select(
        "pipeline_run_id",
        "run_timestamp",
        F.lit(database_type).alias("database_type"),
        F.col("extraction.total_extracted").alias("total_extracted"),
        F.col("validation.total_valid").alias("total_valid"),
        F.col("validation.total_rejected").alias("total_rejected"),
        F.col("validation.overall_pass_rate_pct").alias("pass_rate_pct"),
        F.to_json(F.struct(*audit.columns)).alias("audit_json"),
    )


def reconciliation(etl: Etl, view: DataFrame) -> DataFrame:
    """Raw = valid + rejected per table and in total; order view rows = valid orders."""
    stats = etl.stats.select("table_name", "valid_count", "rejected_count")
    raw = validate.union_all(
        [
            df.agg(F.count("*").alias("raw_count")).select(F.lit(n).alias("table_name"), "*")
            for n, df in etl.raw.items().items()
        ]
    )
    per_table = raw.join(stats, "table_name")
    # One row per table from here on.
    total = per_table.agg(
        F.lit("total").alias("table_name"),
        *[F.sum(c).alias(c) for c in ("raw_count", "valid_count", "rejected_count")],
    )
    view_rows = view.agg(count_where(F.lit(True))).scalar()
    is_orders = F.col("table_name") == "orders"
    return per_table.unionByName(total).withColumns(
        {
            "sum_valid_rejected": F.col("valid_count") + F.col("rejected_count"),
            "reconciled": F.col("raw_count") == F.col("valid_count") + F.col("rejected_count"),
            "view_rows": F.when(is_orders, view_rows),
            "view_matches_valid": F.when(is_orders, view_rows == F.col("valid_count")),
        }
    )
