"""Single-pass aggregates, calendar windows, the median by selection and the proofs of the models."""

import random
import re
import statistics

import pytest
from pyspark.sql import functions as F

from shelfmark.operators import churn, clean, measures, quality, star
from shelfmark.operators.features import ChurnWindow, churn_dataset
from shelfmark.plans import registry
from shelfmark.plans.registry import etl_of

LINES = "customer_id string, product_id string, order_date date, order_id string, order_date_id int, net_revenue decimal(18,2), net_profit decimal(18,2)"


@pytest.mark.parametrize("ages", [[30.0], [30.0, 41.0], [1.0, 2.0, 2.0, 9.0], [5.0] * 7 + [8.0], list(range(1, 1002))])
def test_median_by_selection(spark, ages):
    rng = random.Random(1)
    values = [float(a) + (rng.random() if len(ages) > 100 else 0) for a in ages]
    df = spark.createDataFrame([(v,) for v in values] + [(None,)], "age double").repartition(5)
    got = df.limit(1).select(clean.median_age(df).alias("m")).first().m
    assert got == pytest.approx(statistics.median(values))


def test_median_without_ages(spark):
    df = spark.createDataFrame([(None,), (None,)], "age double")
    assert df.limit(1).select(clean.median_age(df).alias("m")).first().m == clean.FALLBACK_AGE


def lines_of(spark, rows):
    from datetime import date
    from decimal import Decimal

    return spark.createDataFrame([(c, p, date.fromisoformat(d), o, int(d.replace("-", "")), Decimal(r), Decimal(q)) for c, p, d, o, r, q in rows], LINES)


def test_cross_totals_of_rows_without_key(spark):
    df = lines_of(spark, [("a", "x", "2024-01-05", "1", "10", "1"), (None, "x", "2024-01-09", "2", "20", "2"), ("a", None, "2024-02-01", "2", "5", "0")])
    got = {r.dimension: (r.members, int(r.net_revenue), int(r.net_profit)) for r in quality.cross_totals(df).collect()}
    assert got == {"customer": (2, 35, 3), "product": (2, 35, 3), "day": (3, 35, 3), "month": (2, 35, 3)}
    empty = {r.dimension: r.members for r in quality.cross_totals(df.where("false")).collect()}
    assert empty == {"customer": 0, "product": 0, "day": 0, "month": 0}


def test_star_integrity_finds_each_fault(spark):
    fact = lines_of(spark, [("a", "x", "2024-01-05", "1", "1", "1"), ("ghost", "x", "2024-01-05", "1", "1", "1"), (None, "z", "2024-01-09", "2", "1", "1"), ("a", "x", "2024-01-05", None, "1", "1")])
    make = lambda name, *ids: spark.createDataFrame([(i,) for i in ids], f"{name} {'int' if name == 'date_id' else 'string'}")
    got = {r.rule: r.violations for r in quality.star_integrity(
        fact, make("customer_id", "a", "a", "b"), make("product_id", "x"), make("date_id", 20240105), make("customer_id", "a", "c")).collect()}
    assert got == {"fact_without_customer": 2, "fact_without_product": 1, "fact_without_date": 1, "repeated_customer": 1, "repeated_product": 0,
                   "repeated_date": 0, "repeated_order": 1, "customer_without_analytics": 1, "analytics_without_customer": 1}


def test_calendar_shift_leaves_gaps(spark):
    rows = [("2023-01-10", 100), ("2023-03-01", 300), ("2023-04-01", 330), ("2024-01-20", 150), ("2024-03-03", 600)]
    fact = spark.createDataFrame([(d, "Completed", r) for d, r in rows], "order_date string, order_status string, gross_revenue int").withColumns(
        {"order_date": F.to_date("order_date"), "gross_revenue": F.col("gross_revenue").cast("decimal(18,2)")})
    df = measures.time_intelligence(fact)
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Scan ") == 1 and "Join" not in plan
    got = {str(r.month)[:7]: (r.net_revenue_prior_month and int(r.net_revenue_prior_month), r.mom_growth_pct, r.yoy_growth_pct, int(r.running_net_revenue)) for r in df.collect()}
    assert got == {"2023-01": (None, 0.0, 0.0, 100), "2023-03": (None, 0.0, 0.0, 400), "2023-04": (300, 0.1, 0.0, 730),
                   "2024-01": (None, 0.0, 0.5, 880), "2024-03": (None, 0.0, 1.0, 1480)}


@pytest.fixture(scope="module")
def fitted(spark, sf_dir):
    train = registry._cohorts(spark, sf_dir)[0]
    return train, registry._model(spark, sf_dir, "logistic"), registry._model(spark, sf_dir, "forest")


def test_a_worse_fit_is_no_optimum(fitted):
    train, logistic, _ = fitted
    assert churn.optimality(logistic, train).first().slopes_vanish
    flipped = train.withColumn(churn.LABEL, 1 - F.col(churn.LABEL))
    assert not churn.optimality(logistic, flipped).first().slopes_vanish


def test_forest_table_scores_like_the_forest(spark, fitted):
    train, _, forest = fitted
    nodes = churn.forest_nodes(forest, spark)
    own, table = churn.probability(forest, train, "customer_id"), churn.score_by_nodes(nodes, train, "customer_id")
    assert churn.disagreements(own, table, "customer_id").first().rows_apart == 0
    other = table.withColumn(churn.PROBABILITY, F.col(churn.PROBABILITY) + 0.01).limit(3)
    assert churn.disagreements(own, other, "customer_id").first().rows_apart == train.count()


def test_import_differences_count_repeats(spark):
    a = spark.createDataFrame([(1, "x"), (1, "x"), (2, None)], "i int, s string")
    b = spark.createDataFrame([(1, "x"), (2, None), (3, "")], "i int, s string")
    r = star.import_differences({"t": a}, {"t": b}).first()
    assert (r.rows_imported, r.rows_exported, r.rows_missing, r.rows_added) == (3, 3, 1, 1)


def test_windows_prune_years(spark, sf_dir):
    t = etl_of(spark, sf_dir).priced
    early = churn_dataset(t.orders, t.customers, t.products, ChurnWindow("1996-05-03", "1996-05-04", "1996-08-01"))
    spark.conf.set("spark.sql.maxMetadataStringLength", "5000")
    try:
        plan = early._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.unset("spark.sql.maxMetadataStringLength")
    assert any("order_year" in x for x in re.findall(r"PartitionFilters: \[(.*?)\]", plan))
