"""What a task holds does not grow with the tables."""

import pytest
from pyspark.sql import functions as F

from shelfmark import session
from shelfmark.operators import quality, validate
from shelfmark.plans.etl import Etl
from shelfmark.plans.registry import etl_of
from shelfmark.sources.adapter import Tables


def test_buckets_and_shuffles_grow_with_the_table(spark, sf_dir, monkeypatch):
    raw, known = etl_of(spark, sf_dir).raw, etl_of(spark, sf_dir).checked.orders
    rows = raw.orders.count()
    monkeypatch.setattr(session, "TASK_ROWS", 500, raising=False)
    etl = Etl(raw, "2024-01-01")
    stored = etl.checked.orders
    assert etl._buckets() == (-(-rows // 500), "customer_id") and rows > 2000
    # a bucket's files name it; the largest holds few rows more than it should
    bucket = F.regexp_extract(F.input_file_name(), r"_(\d{5})\.c", 1)
    most = stored.groupBy(bucket.alias("bucket")).count().agg(F.max("count"), F.count("*")).first()
    assert most[0] <= 2 * 500 and most[1] == -(-rows // 500)
    assert stored.exceptAll(known).isEmpty() and known.exceptAll(stored).isEmpty()
    assert spark.conf.get("spark.sql.shuffle.partitions") == "4"


def test_the_own_number_of_partitions_comes_back(spark):
    with pytest.raises(KeyError), session.wide_shuffles(spark, 10**9):
        assert int(spark.conf.get("spark.sql.shuffle.partitions")) == 10**9 // session.TASK_ROWS
        raise KeyError
    assert spark.conf.get("spark.sql.shuffle.partitions") == "4"


def test_a_star_table_is_computed_once(spark, tmp_path):
    from shelfmark.sources import readers, writers

    drawn = spark.range(20).selectExpr("id", "java_method('java.util.UUID', 'randomUUID') as drawn")
    loaded = writers.export_star({"drawn": drawn}, str(tmp_path / "csv"), "once_", str(tmp_path / "tables"))
    back = readers.read_csv(spark, str(tmp_path / "csv/drawn.csv"), drawn.schema)
    assert loaded.first().rows_loaded == 20
    assert back.exceptAll(spark.table("once_drawn")).isEmpty() and back.count() == 20


def _odd_orders(make):
    """Orders whose ids repeat, hold one row or are missing; five products and three customers."""
    ids = ["a", "b", "a", None, "c", None, "a", "d"]
    rows = [(i, k, f"c{i % 3}", f"p{i % 5}", "2000-01-01", 1, "CC", "Shipped") for i, k in enumerate(ids)]
    customers = [(i, f"c{i}", "N", "M", 30.0, "x", "y", "1999-01-01") for i in range(3)]
    products = [(i, f"p{i}", "N", "Books", "2.00", "1.00") for i in range(5)]
    return make.customers(customers), make.products(products), make.orders(rows)


def _moved(df):
    """The exchanges that a plan has, as text."""
    return [line for line in df._jdf.queryExecution().executedPlan().toString().splitlines() if "Exchange" in line]


def test_repeated_ids_are_found_by_hash(spark, make, monkeypatch):
    from shelfmark.operators import validate
    from shelfmark.plans import etl as plan
    from shelfmark.sources.adapter import Tables

    raw = Tables(*_odd_orders(make))
    for most in (plan.BROADCAST_IDS, 0):
        monkeypatch.setattr(plan, "BROADCAST_IDS", most)
        etl = Etl(raw, "2024-01-01")
        ids, n = etl._repeated_orders(etl.cleaned.orders)
        known = validate.repeated_ids(etl.cleaned.orders, "order_id")
        assert n == 2 and sorted(ids.collect(), key=str) == sorted(known.collect(), key=str)
        repeats = etl.checked.orders.where("rejection_reason = 'DUPLICATE_ORDER_ID'")
        assert {r.src_seq for r in repeats.collect()} == {2, 5, 6}
    # only hashes move, not the ids
    assert all("order_id" not in line for line in _moved(validate.repeated_hashes(raw.orders, "order_id")))


def test_repeated_ids_move_no_order_lines(spark, make):
    from shelfmark.operators import validate
    from shelfmark.sources.adapter import Tables

    etl = Etl(Tables(*_odd_orders(make)), "2024-01-01")
    limit = "spark.sql.autoBroadcastJoinThreshold"
    before = spark.conf.get(limit)
    spark.conf.set(limit, "-1")
    try:
        ids, _ = etl._repeated_orders(etl.cleaned.orders)
        flagged = validate.flag_repeats(etl.cleaned.orders, "order_id", repeated=ids)
        assert not any("hashpartitioning(order_id" in line for line in _moved(flagged))
    finally:
        spark.conf.set(limit, before)


def test_files_are_read_in_as_many_tasks(spark):
    before = spark.conf.get("spark.sql.files.minPartitionNum", None)
    with session.wide_shuffles(spark, 100 * session.TASK_ROWS):
        assert spark.conf.get("spark.sql.files.minPartitionNum") == "100"
    assert spark.conf.get("spark.sql.files.minPartitionNum", None) == before


def test_product_ids_of_order_lines_move_once(spark, make):
    orders = make.orders([(1, "O1", "C1", "P1", "2024-01-01", 1, "COD", "Shipped"), (2, "O2", "C1", "P2", "2024-01-01", 1, "COD", "Shipped")])
    customers = make.customers([(1, "C1", "A", "Male", 30.0, "X", "YY", "2023-01-01")])
    products = make.products([(1, "P1", "a", "Books & Media", "9.00", "5.00")])
    checked = validate.check_orders(orders, customers, products, dealt=(3, "customer_id"))
    assert {r.order_id: r[validate.REASON] for r in checked.collect()} == {"O1": None, "O2": "ORPHAN_PRODUCT_FOREIGN_KEY"}
    dealt = checked._jdf.queryExecution().optimizedPlan().toString().split("RepartitionByExpression")[1]
    assert "isnotnull(known_product" in dealt.splitlines()[1]


def test_quarantine_moves_hashes_of_ids(spark):
    valid = spark.createDataFrame([(f"O{k}",) for k in range(50)] + [("O7",), (None,)], "order_id string")
    rejected = spark.createDataFrame(
        [("orders", "O7", "INVALID_QUANTITY_ZERO"), ("orders", "O7", "INVALID_QUANTITY_ZERO"), ("orders", "O9", "DUPLICATE_ORDER_ID"), ("orders", None, "INVALID_QUANTITY_ZERO"), ("customers", "O8", "INVALID_AGE_OUT_OF_BOUNDS")],
        "table_name string, record_identifier string, rejection_reason string")
    none = valid.where("false")
    tables = Tables(none.withColumnRenamed("order_id", "customer_id"), none.withColumnRenamed("order_id", "product_id"), valid)
    out = quality.quarantine_isolation(tables, rejected, validate.ID_COLUMNS)
    assert [tuple(r) for r in out.collect()] == [("customers", 0), ("products", 0), ("orders", 2)]
    assert "BroadcastHashJoin [xxhash64(" in out._jdf.queryExecution().executedPlan().toString()
