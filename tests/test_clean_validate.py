import json
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from shelfmark.operators import clean, validate
from shelfmark.operators.validate import REASON
from shelfmark.plans.etl import Etl
from shelfmark.sources.adapter import Tables


def customer(seq, cid, age=30.0, name="ann lee", gender="F", city="x", state="ny", day="2024-01-01"):
    return (seq, cid, name, gender, age, city, state, day)


def product(seq, pid, category="Electronics", price="100", cost="40"):
    return (seq, pid, " lamp ", category, price, cost)


def order(seq, oid, cid="C1", pid="P1", day="2024-02-01", qty=1, pay="cc", status=" completed"):
    return (seq, oid, cid, pid, day, qty, pay, status)


def reasons(df, key):
    return sorted((r[key], r[REASON]) for r in df.collect())


@pytest.mark.parametrize("raw,want", [
    (" o'neil jean-luc\t", "O'Neil Jean-Luc"),
    ("ANN  LEE", "Ann  Lee"),
    (" émile zola", "Émile Zola"),
    ("3d print", "3D Print"),
    ("", ""),
    (None, None),
])
def test_title_case(spark, make, raw, want):
    df = clean.clean_customers(make.customers([customer(1, "C1", name=raw)]))
    assert df.first()["name"] == want


def test_customer_cleaning(make):
    rows = [
        customer(1, "C1", age=20.0, gender=" m ", state=" ca "),
        customer(2, "C2", age=None, gender="FEMALE"),
        customer(3, "C3", age=31.0, gender="x"),
        customer(4, "C4", age=50.0, gender=None),
        customer(5, "C5", age=40.0, gender="Female"),
    ]
    got = {r.customer_id: r for r in clean.clean_customers(make.customers(rows)).collect()}
    assert [got[f"C{i}"].gender for i in range(1, 6)] == [
        "Male", "Female", "Unknown", "Unknown", "Female"]
    assert got["C2"].age == 35.5 and got["C2"].is_age_imputed
    assert got["C1"].state == "CA" and not got["C1"].is_age_imputed


def test_age_falls_back_without_any_age(make):
    df = clean.clean_customers(make.customers([customer(1, "C1", age=None)]))
    assert df.first()["age"] == clean.FALLBACK_AGE


def test_product_and_order_cleaning(make):
    p = clean.clean_products(make.products([
        product(1, "P1", " HOME & kitchen", "10", "4"),
        product(2, "P2", "garden-tools", "0", "4"),
        product(3, "P3", None, "10", None),
    ])).orderBy("product_id").collect()
    assert [r.category for r in p] == ["Home & Kitchen", "Garden-Tools", None]
    assert [r.gross_margin_pct for r in p] == [60.0, None, None]
    assert p[0].product_name == "lamp"
    o = clean.clean_orders(make.orders([
        order(1, "O1", pay=" COD ", status="SHIPPED"),
        order(2, "O2", pay="Bank Transfer", status="on-hold"),
        order(3, "O3", pay=None, status=None),
    ])).orderBy("order_id").collect()
    assert [r.payment_method for r in o] == ["Cash on Delivery", "Unknown", "Unknown"]
    assert [r.order_status for r in o] == ["Shipped", "On-Hold", None]


def test_first_customer_is_kept(make):
    rows = [customer(1, "C9", 30.0), customer(2, "C9", 30.0), customer(3, "C9", 32.0),
            customer(4, "C8", 101.0), customer(5, "C7", 17.9), customer(6, "C6", 100.0)]
    checked = validate.check_customers(make.customers(rows))
    assert sorted((r.src_seq, r[REASON]) for r in checked.collect()) == [
        (1, None), (2, "DUPLICATE_CUSTOMER_ID"), (3, "DUPLICATE_CUSTOMER_ID"),
        (4, "INVALID_AGE_OUT_OF_BOUNDS"), (5, "INVALID_AGE_OUT_OF_BOUNDS"), (6, None)]


def test_repeats_of_null_id_and_rejected_first_row(make):
    rows = [customer(1, None), customer(2, None), customer(3, "C1", 150.0), customer(4, "C1", 30.0)]
    checked = validate.check_customers(make.customers(rows))
    got = {r.src_seq: r[REASON] for r in checked.collect()}
    assert got == {1: None, 2: "DUPLICATE_CUSTOMER_ID", 3: "INVALID_AGE_OUT_OF_BOUNDS",
                   4: "DUPLICATE_CUSTOMER_ID"}


def test_product_rules_in_order(make):
    rows = [product(1, "P1", None), product(2, "P2", cost=None), product(3, "P3", price="0"),
            product(4, "P4", price="-50"), product(5, "P5", cost="0"),
            product(6, "P6", price="50", cost="80"), product(7, "P7"),
            product(8, "P8", None, "0", None), product(9, "P9", price=None)]
    got = dict(reasons(validate.check_products(make.products(rows)), "product_id"))
    assert got == {
        "P1": "MISSING_PRODUCT_CATEGORY", "P2": "MISSING_PRODUCT_COST",
        "P3": "INVALID_PRICE_NON_POSITIVE", "P4": "INVALID_PRICE_NON_POSITIVE",
        "P5": "INVALID_COST_NON_POSITIVE", "P6": "INVALID_COST_EXCEEDS_PRICE", "P7": None,
        "P8": "MISSING_PRODUCT_CATEGORY", "P9": "INVALID_PRICE_NON_POSITIVE"}


@pytest.fixture(scope="module")
def etl(spark, make):
    raw = Tables(
        make.customers([customer(1, "C1"), customer(2, "C2", 150.0)]),
        make.products([product(1, "P1"), product(2, "P2", cost=None)]),
        make.orders([
            order(1, "O1", qty=-2), order(2, "O2", qty=0), order(3, "O3", cid="GHOST"),
            order(4, "O4", pid="GHOST"), order(5, "O5"), order(6, "O5"),
            order(7, "O6", pid="P2", qty=-1), order(8, "O7", cid=None), order(9, "O8", qty=None),
            order(10, "O9", cid="C2"), order(11, "O10", pid="P2"),
        ]),
    )
    return Etl(raw, "2024-03-01 00:00:00")


def test_order_rules(etl):
    got = {(r.src_seq, r.order_id): r[REASON] for r in etl.checked.orders.collect()}
    assert got == {
        (1, "O1"): "INVALID_QUANTITY_NEGATIVE_RETURN", (2, "O2"): "INVALID_QUANTITY_ZERO",
        (3, "O3"): "ORPHAN_CUSTOMER_FOREIGN_KEY", (4, "O4"): "ORPHAN_PRODUCT_FOREIGN_KEY",
        (5, "O5"): None, (6, "O5"): "DUPLICATE_ORDER_ID",
        (7, "O6"): "INVALID_QUANTITY_NEGATIVE_RETURN", (8, "O7"): "ORPHAN_CUSTOMER_FOREIGN_KEY",
        (9, "O8"): None, (10, "O9"): "ORPHAN_CUSTOMER_FOREIGN_KEY",
        (11, "O10"): "ORPHAN_PRODUCT_FOREIGN_KEY"}


def test_dead_letters_keep_nulls_in_json(etl):
    rows = etl.rejected.collect()
    assert len(rows) == 11  # one customer, one product, nine orders
    payload = json.loads([r for r in rows if r.record_identifier == "O7"][0].raw_payload)
    assert payload["customer_id"] is None and payload["payment_method"] == "Credit Card"
    assert "src_seq" not in payload and REASON not in payload


def test_identifier_is_unknown_without_id_column(spark):
    df = spark.createDataFrame([("x", "R")], f"a string, {REASON} string")
    assert validate.dead_letters(df, "orders", "2024-01-01").first().record_identifier == "UNKNOWN"


def test_stats_reconcile(etl):
    stats = {r.table_name: r for r in etl.stats.collect()}
    assert (stats["orders"].total_input, stats["orders"].valid_count) == (11, 2)
    assert stats["orders"].pass_rate_pct == pytest.approx(18.18)
    for r in stats.values():
        assert r.total_input == r.valid_count + r.rejected_count


@pytest.mark.parametrize("partitions", [1, 7, 64])
def test_split_does_not_depend_on_partitioning(spark, make, partitions):
    rows = [customer(i, f"C{i % 5}") for i in range(40)]
    shuffled = make.customers(rows[::-1]).repartition(partitions)
    kept = validate.valid_rows(validate.check_customers(shuffled))
    assert sorted(r.src_seq for r in kept.collect()) == [0, 1, 2, 3, 4]


def test_hot_id(spark):
    """A third of all rows share one id; exactly one of them stays."""
    df = spark.range(9000).select(
        F.col("id").alias("src_seq"),
        F.when(F.col("id") % 3 == 0, "HOT").otherwise(F.col("id").cast("string")).alias("k"))
    flagged = validate.flag_repeats(df, "k")
    assert flagged.where("not is_repeat").count() == 6001
    assert flagged.where("k = 'HOT' and not is_repeat").first().src_seq == 0


def test_declared_constraints_report_what_rules_let_pass(make):
    tables = {
        "customers": clean.clean_customers(make.customers([customer(1, "C1", 110.0)])),
        "products": clean.clean_products(make.products([product(1, "P1")])),
        "orders": clean.clean_orders(make.orders([
            order(1, "O1", qty=None, status="Lost"), order(2, "O1", cid="X")])),
    }
    got = {(r.table_name, r.rule): r.violations
           for r in validate.declared_constraints(tables).collect() if r.violations}
    assert got == {("orders", "quantity_not_null"): 1, ("orders", "status_in_domain"): 1,
                   ("orders", "primary_key"): 1, ("orders", "customer_id_foreign_key"): 1}


def test_money_is_exact(make):
    p = clean.clean_products(make.products([product(1, "P1", price="10.005", cost="4.444")])).first()
    assert (p.price, p.cost) == (Decimal("10.01"), Decimal("4.44"))
