"""Headline queries, timed on the driver tables.

Prints one JSON line. ``raw_store`` turns the driver tables into raw retail tables, which a user
has as files. ``etl_transform_validate`` reads, cleans and validates these without a sink, and
``etl_rows_per_second`` is that of this entry; ``etl_store`` does the same and stores the annotated tables;
``etl_load`` writes the four result tables from those; ``registry_store`` is the stored copy of the
registered queries. The other entries are the registered queries, which read the tables the chain has stored; each
full result is written to the no-op sink.
"""

from __future__ import annotations

import json
import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

SF_DIR = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
CPUS = os.environ.get("BENCH_CPUS", "8")

HEADLINES = (
    "val9_table_stats",
    "fct1_order_view",
    "rpt01_executive_scorecard",
    "rpt02_monthly_trend",
    "rpt06_category_matrix",
    "rpt07_top_products",
    "rpt09_product_pareto",
    "rpt11_customer_lifecycle",
    "rpt13_customer_pareto",
    "rpt16_activity_cohorts",
    "rpt20_dlq_root_causes",
    "fea_customer_features",
    "fea17_churn_dataset",
    "rfm4_segment_summary",
    "rsk5_tier_summary",
    "msr_by_month",
    "dq9_reconciliation",
    "dq17_cross_totals",
    "chn3_logistic_metrics",
)


def main() -> None:
    from shelfmark.operators import validate
    from shelfmark.plans import registry
    from shelfmark.plans.etl import Etl
    from shelfmark.session import build_session, fresh_dir
    from shelfmark.sources.adapter import Tables

    spark = build_session(
        "shelfmark-bench",
        **{
            "spark.master": f"local[{CPUS}]",
            "spark.driver.memory": "16g",
            "spark.sql.shuffle.partitions": CPUS,
            "spark.ui.enabled": "false",
            "spark.ui.showConsoleProgress": "false",
        },
    )
    spark.sparkContext.setLogLevel("ERROR")

    def run(df) -> None:
        df.write.format("noop").mode("overwrite").save()

    seconds: dict[str, float] = {}

    def timed(name: str, work) -> None:
        start = time.perf_counter()
        work()
        seconds[name] = round(time.perf_counter() - start, 3)

    def suite(sf_dir: str) -> None:
        etls: list[Etl] = []
        raws: list[Tables] = []

        def transform_validate() -> None:
            cleaned = Etl(raws[0]).cleaned
            customers = validate.check_customers(cleaned.customers)
            products = validate.check_products(cleaned.products)
            orders = validate.check_orders(
                cleaned.orders, validate.valid_rows(customers), validate.valid_rows(products))
            for checked in (customers, products, orders):
                run(checked)

        def store() -> None:
            etls.append(Etl(raws[0], registry.RUN_TIMESTAMP))
            run(etls[0].stats)

        def load() -> None:
            out = fresh_dir(spark, "bench")
            for name, df in {**etls[0].valid.items(), "rejected": etls[0].rejected}.items():
                df.write.parquet(f"{out}/{name}")

        timed("raw_store", lambda: raws.append(registry.stored_raw(spark, sf_dir)))
        timed("etl_transform_validate", transform_validate)
        timed("etl_store", store)
        timed("etl_load", load)
        # the stored copy that the headline queries below read
        timed("registry_store", lambda: registry.etl_of(spark, sf_dir).checked)
        for name in HEADLINES:
            timed(name, lambda: run(registry.QUERIES[name](spark, sf_dir)))

    # Warm the JVM on the smallest data; only the second pass is reported.
    warm_dir = os.path.join(os.path.dirname(SF_DIR.rstrip("/")), "sf0.001")
    suite(warm_dir if os.path.isdir(warm_dir) else SF_DIR)
    seconds.clear()
    suite(SF_DIR)

    rows = {
        n: df.count() for n, df in registry.etl_of(spark, SF_DIR).raw.items().items()
    }
    etl_seconds = seconds["etl_transform_validate"]
    print(json.dumps({
        "metric": "total_headline_seconds",
        "value": round(sum(seconds.values()), 3),
        "unit": "sec",
        "queries": seconds,
        "sf": os.path.basename(SF_DIR.rstrip("/")).removeprefix("sf"),
        "raw_rows": rows,
        "etl_rows_per_second": round(sum(rows.values()) / etl_seconds),
    }))


if __name__ == "__main__":
    main()
