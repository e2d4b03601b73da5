"""Keys, sequences, identifiers and stored tables that earlier rounds got wrong."""

from pyspark.sql import functions as F

from shelfmark.operators import validate
from shelfmark.plans import registry
from shelfmark.sources.adapter import _key, raw_orders


def test_long_keys_are_padded_and_never_cut(spark):
    rows = spark.createDataFrame([(7,), (1234567890123,), (1234567890124,)], "k long").selectExpr(_key("C_", "k") + " as id").collect()
    assert [r.id for r in rows] == ["C_000000000007", "C_1234567890123", "C_1234567890124"]


def test_sequence_tells_all_suppliers_apart(spark):
    lines = spark.createDataFrame(
        [(40, 1, 10**11, 5, 3), (40, 1, 10**11, 5 + (1 << 22), 3), (40, 1, 10**11, 5 + (1 << 23), 3)],
        "l_orderkey long, l_linenumber int, l_partkey long, l_suppkey long, l_quantity int",
    ).withColumns({"l_returnflag": F.lit("N"), "l_linestatus": F.lit("O")})
    orders = spark.createDataFrame([(40, "1-URGENT", 3, "1996-01-01")], "o_orderkey long, o_orderpriority string, o_custkey long, o_orderdate string")
    raw = raw_orders(lines, orders)
    flagged = validate.flag_repeats(raw, "order_id").collect()
    assert len({r.src_seq for r in flagged}) == 3 and sum(not r.is_repeat for r in flagged) == 1


def test_dead_letters_name_every_row(spark):
    checked = spark.createDataFrame([(1, None, "MISSING"), (2, "a", "MISSING")], "src_seq long, customer_id string, rejection_reason string")
    got = validate.dead_letters(checked, "customers", "2024-07-01 00:00:00").collect()
    assert sorted(r.record_identifier for r in got) == ["UNKNOWN", "a"]


def test_results_follow_the_files(spark, sf_dir, tmp_path):
    """Tables that change under the same path are read anew."""
    for t in registry.RETAIL:
        df = spark.read.parquet(f"{sf_dir}/{t}.parquet")
        df.write.parquet(f"{tmp_path}/{t}.parquet")
    before = registry.etl_of(spark, str(tmp_path)).raw.customers.count()
    spark.read.parquet(f"{sf_dir}/customer.parquet").limit(10).write.mode("overwrite").parquet(f"{tmp_path}/customer.parquet")
    assert registry.etl_of(spark, str(tmp_path)).raw.customers.count() < before
