"""What the order store and star integrity hold on disk."""

import glob
import os

from pyspark.sql import functions as F

from shelfmark import session
from shelfmark.operators import quality
from shelfmark.plans import etl as plan
from shelfmark.plans.registry import etl_of, stored_raw


def _shuffle_files(spark):
    local = spark._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager().localDirsString()
    return {f for d in local for f in glob.glob(f"{d}/*/shuffle_*.data") if os.path.getsize(f) > 1000}


def _same(a, b):
    return a.exceptAll(b).isEmpty() and b.exceptAll(a).isEmpty()


def test_orders_are_checked_in_shares_of_whole_buckets(spark, sf_dir, monkeypatch):
    known = etl_of(spark, sf_dir)
    monkeypatch.setattr(plan, "SHARE_ROWS", 1000, raising=False)
    monkeypatch.setattr(session, "TASK_ROWS", 100)
    etl = plan.Etl(known.raw, known.run_timestamp)
    n, of = etl._buckets()
    shares = etl._shares(etl.cleaned.orders, (n, of))
    buckets = [{r[0] for r in df.select(F.pmod(F.hash(of), F.lit(n))).distinct().collect()} for df in shares]
    assert len(shares) == 4 and sum(map(len, buckets)) == len(set().union(*buckets)) > 30
    assert _same(etl.checked.orders, known.checked.orders)
    assert sorted(map(tuple, etl.stats.collect())) == sorted(map(tuple, known.stats.collect()))
    name = r"_(\d{5})\.c"
    files = etl.checked.orders.select(F.regexp_extract(F.input_file_name(), name, 1).alias("in_file"), F.pmod(F.hash(of), F.lit(n)).alias("bucket"))
    assert files.where(F.col("in_file").cast("int") != F.col("bucket")).isEmpty()


def test_shares_without_buckets_hold_all_orders(spark, make, monkeypatch):
    from shelfmark.sources.adapter import Tables

    rows = [(i, f"O{i % 25}" if i % 5 else None, f"C{i % 3}" if i % 4 else None, "P1", "2024-01-01", i % 3, "COD", "Shipped") for i in range(30)]
    customers = make.customers([(1, "C1", "A", "Male", 30.0, "X", "YY", "2023-01-01")])
    raw = Tables(customers, make.products([(1, "P1", "a", "Books & Media", "9.00", "5.00")]), make.orders(rows))
    found = []
    for most in (100, 10):
        monkeypatch.setattr(plan, "SHARE_ROWS", most, raising=False)
        monkeypatch.setattr(plan, "HOT_SHARE", 0)
        etl = plan.Etl(raw, "2024-01-01")
        assert len(etl._shares(etl.cleaned.orders, None)) == (1 if most == 100 else 3)
        found.append((sorted(map(tuple, etl.checked.orders.collect())), sorted(map(tuple, etl.outcomes.collect()), key=str)))
    assert found[0] == found[1] and len(found[0][0]) == 30


def test_the_store_leaves_no_shuffle_files(spark, sf_dir):
    before = _shuffle_files(spark)
    etl = plan.Etl(stored_raw(spark, sf_dir), "2024-01-01")
    assert etl.checked.orders.count() == etl.raw.orders.count() > 1000
    assert not {f for f in _shuffle_files(spark) - before if os.path.exists(f)}
    assert spark.conf.get(session.SHUFFLE_CLEANUP) == "false"


def test_repeated_orders_are_found_by_hash(spark, make):
    ids = spark.createDataFrame([("a",), ("a",), ("b",), (None,), (None,), (None,), ("a",)], "order_id string")
    assert [tuple(r) for r in quality.repeated_rows(ids, "order_id").collect()] == [(4,)]
    assert [tuple(r) for r in quality.repeated_rows(ids.where("order_id = 'b'"), "order_id").collect()] == [(0,)]
    fact = spark.createDataFrame([("O1", "C1", "P1", 20240101), ("O1", "C9", "P1", 20240101)], "order_id string, customer_id string, product_id string, order_date_id int")
    customers, products, dates = fact.select("customer_id").limit(1), fact.select("product_id").limit(1), fact.select(F.col("order_date_id").alias("date_id")).limit(1)
    out = quality.star_integrity(fact, customers, products, dates, customers)
    assert {r.rule: r.violations for r in out.collect() if r.violations} == {"repeated_order": 1, "fact_without_customer": 1}
    expands = [line for line in out._jdf.queryExecution().optimizedPlan().toString().splitlines() if "Expand" in line]
    assert expands and all("order_id" not in line for line in expands)
