import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from shelfmark.session import build_session  # noqa: E402

SF_DIR = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    session = build_session(
        "shelfmark-tests",
        **{
            "spark.master": "local[8]",
            "spark.sql.shuffle.partitions": "4",
            "spark.ui.enabled": "false",
            "spark.driver.memory": "8g",
            "spark.sql.warehouse.dir": str(tmp_path_factory.mktemp("warehouse")),
        },
    )
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


@pytest.fixture(scope="session")
def sf_dir():
    return SF_DIR


@pytest.fixture(scope="session")
def make(spark):
    """Small retail tables from tuples; dates are ISO text."""
    from pyspark.sql import functions as F

    def customers(rows):
        df = spark.createDataFrame(
            rows, "src_seq long, customer_id string, name string, gender string, age double, "
            "city string, state string, signup_date string")
        return df.withColumn("signup_date", F.to_date("signup_date"))

    def products(rows):
        df = spark.createDataFrame(
            rows, "src_seq long, product_id string, product_name string, category string, "
            "price string, cost string")
        return df.withColumns({c: F.col(c).cast("decimal(18,2)") for c in ("price", "cost")})

    def orders(rows):
        df = spark.createDataFrame(
            rows, "src_seq long, order_id string, customer_id string, product_id string, "
            "order_date string, quantity int, payment_method string, order_status string")
        return df.withColumn("order_date", F.to_date("order_date"))

    class Make:
        pass

    m = Make()
    m.customers, m.products, m.orders = customers, products, orders
    return m
