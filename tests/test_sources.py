import pytest
from pyspark.sql import functions as F

from shelfmark import schemas
from shelfmark.plans.etl import Etl, audit_log_row, run_audit
from shelfmark.plans.registry import etl_of
from shelfmark.plans.reports import audit_history
from shelfmark.sources import readers, writers


def write_text(path, text):
    path.write_text(text)
    return str(path)


PRODUCTS = "product_id,product_name,category,price,cost\n"


def test_missing_file(spark, tmp_path):
    with pytest.raises(readers.RawDataExtractionError):
        readers.extract_raw_table(spark, str(tmp_path / "none.csv"), "products")


def test_malformed_line(spark, tmp_path):
    path = write_text(tmp_path / "p.csv", PRODUCTS + "P1,lamp,x,not-a-price,3\n")
    with pytest.raises(readers.RawDataExtractionError):
        readers.extract_raw_table(spark, path, "products")


def test_input_order_is_kept(spark, tmp_path):
    lines = "".join(f"P{i % 7},name {i},Books,10,{i}\n" for i in range(200))
    df = readers.extract_raw_table(spark, write_text(tmp_path / "p.csv", PRODUCTS + lines), "products")
    got = [int(r.cost) for r in df.orderBy("src_seq").collect()]
    assert got == list(range(200))
    checked = Etl(etl_like(spark, df), "2024-01-01").checked.products
    assert {int(r.cost) for r in checked.where("rejection_reason is null").collect()} <= set(range(7))


def etl_like(spark, products):
    from shelfmark.sources.adapter import Tables

    empty = [spark.createDataFrame([], schemas.RAW[n]).withColumn("src_seq", F.lit(0))
             for n in ("customers", "orders")]
    return Tables(empty[0], products, empty[1])


def test_csv_keeps_blanks_quotes_and_nulls(spark, tmp_path):
    rows = [(' a "quoted", b ', "y"), (None, " x"), ("multi word", None), ("", "a\nb"), ("\\", "\\n"), ("\r\n\\\n", ""),
            ("\\\\n\\", '"\n"'), ("\n", "\\r\\\r"), (None, None), ("x,y", "\\-")]
    df = spark.createDataFrame(rows, "a string, b string")
    path = writers.write_csv(df, str(tmp_path / "t.csv"))
    assert sorted(map(tuple, readers.read_csv(spark, path, df.schema).collect()), key=str) == sorted(
        rows, key=str)


def test_one_line_for_each_row(spark, tmp_path):
    df = spark.createDataFrame([("a\nb\r\nc",), ('"\n"',)], "a string").coalesce(1)
    path = writers.write_csv(df, str(tmp_path / "t.csv"))
    assert spark.read.text(path).count() == 3


def test_foreign_files_may_hold_line_breaks(spark, tmp_path):
    path = write_text(tmp_path / "p.csv", PRODUCTS + 'P1,"desk\nlamp \\n",Books,10,3\nP2,x,y,1,1\n')
    rows = readers.extract_raw_table(spark, path, "products").orderBy("src_seq").collect()
    assert [r.product_name for r in rows] == ["desk\nlamp \\n", "x"]


def test_rows_that_share_id_and_place_are_refused(spark, sf_dir):
    raw = etl_of(spark, sf_dir).raw
    twice = type(raw)(raw.customers, raw.products, raw.orders.limit(5).unionByName(raw.orders.limit(5)))
    with pytest.raises(ValueError, match="src_seq"):
        Etl(twice, "2024-01-01").checked


def test_a_hot_customer_is_left_undealt(spark, sf_dir):
    """The same results whether orders are dealt into buckets or one customer has a third of them."""
    from shelfmark.operators.features import customer_features

    raw = etl_of(spark, sf_dir).raw
    hot = raw.orders.withColumn("customer_id", F.when(F.crc32("order_id") % 3 == 0, "CUST_000000000001").otherwise(F.col("customer_id")))
    etl = Etl(type(raw)(raw.customers, raw.products, hot), "2024-01-01")
    spark.conf.set("spark.sql.shuffle.partitions", "16")
    try:
        assert etl._buckets() is None and etl_like_dealt(etl.raw, raw.orders)._buckets() == (16, "customer_id")
        t = etl.priced
        plain = customer_features(etl.valid.orders, t.customers, t.products)
        assert customer_features(t.orders, t.customers, t.products).exceptAll(plain).count() == 0
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", "4")


def etl_like_dealt(tables, orders):
    return Etl(type(tables)(tables.customers, tables.products, orders), "2024-01-01")


def test_plans_open_only_what_they_need(spark, sf_dir):
    """Prices, buckets and directories: no exchange or product join of order lines, pruned scans."""
    from shelfmark.operators.features import customer_features

    etl = etl_of(spark, sf_dir)
    t = etl.priced
    plan = lambda df: df._jdf.queryExecution().executedPlan().toString()
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        lines = [x for x in plan(customer_features(t.orders, t.customers, t.products)).splitlines()]
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    scan = next(i for i, x in enumerate(lines) if "Bucketed: true" in x)
    depth = lambda x: len(x) - len(x.lstrip(" :+-*"))
    above, at = [], depth(lines[scan])
    for x in reversed(lines[:scan]):
        if depth(x) < at:
            at = depth(x)
            above.append(x)
    assert any("SortMergeJoin [customer_id" in x for x in above)
    below = above[: next(i for i, x in enumerate(above) if "SortMergeJoin [customer_id" in x)]
    assert not any("Exchange" in x for x in below) and not any("product_id" in x for x in below)
    early = customer_features(t.orders, t.customers, t.products, cutoff="1997-05-03")
    scans = early._jdf.queryExecution().optimizedPlan().toString()
    assert "order_year" in scans
    assert "PartitionFilters: [isnotnull(order_year" in early._jdf.queryExecution().executedPlan().toString() or "order_year" in plan(early).split("PartitionFilters", 1)[1]
    assert "is_rejected" in plan(etl.rejected).split("PartitionFilters", 1)[1].split("]")[0]


def test_star_schemas_round_trip(spark, sf_dir, tmp_path):
    from shelfmark.operators import facts, star

    t = etl_of(spark, sf_dir).valid
    for name, df in {"dim_customers": star.dim_customers(t.customers),
                     "fact_orders": facts.fact_orders(t.orders, t.products),
                     "dim_date": star.date_dimension_of(t.orders)}.items():
        path = writers.write_csv(df, str(tmp_path / name))
        back = readers.read_csv(spark, path, schemas.STAR[name])
        assert df.columns == schemas.STAR[name].names
        assert back.exceptAll(df).count() == 0 and back.count() == df.count()


def test_audit_log_appends(spark, sf_dir, tmp_path):
    etl = etl_of(spark, sf_dir)
    name = "audit_append_test"
    for run, stamp in (("A", "2024-01-01 00:00:00"), ("B", "2024-01-02 00:00:00")):
        row = audit_log_row(run_audit(etl, run, stamp), "parquet")
        assert row.columns == schemas.AUDIT_LOG.names
        writers.append_audit_row(row, name, str(tmp_path / "audit"))
    assert [r.pipeline_run_id for r in audit_history(spark.table(name)).collect()] == ["B", "A"]
    text = spark.table(name).first().audit_json
    assert '"dead_letter_queue_breakdown"' in text and '"source_counts"' not in text


def test_cleaned_tables_fall_back_to_the_store(spark, sf_dir, tmp_path):
    t = etl_of(spark, sf_dir).valid
    loaded = writers.load_tables(t.items(), "fallback_", str(tmp_path / "tables"))
    counts = {r.table_name: r.rows_loaded for r in loaded.collect()}
    stored = readers.load_cleaned(spark, str(tmp_path / "nowhere"), prefix="fallback_")
    assert stored.orders.count() == counts["orders"] == t.orders.count()
    listed = {r.table_name for r in writers.list_tables(spark, "fallback_").collect()}
    assert listed == {"fallback_customers", "fallback_products", "fallback_orders"}
