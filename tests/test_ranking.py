import pandas as pd
import pytest
from pyspark.sql import functions as F

from shelfmark.operators.ranking import numbered, percent_rank_average, tile, value_ranks


@pytest.fixture(scope="module")
def values():
    # A third of the rows share one value; the rest has ties and singles.
    return [0 if i % 3 == 0 else (i * i) % 57 for i in range(500)]


@pytest.mark.parametrize("partitions", [1, 5, 16])
def test_percent_rank_equals_pandas(spark, values, partitions):
    df = spark.createDataFrame(list(enumerate(values)), "id int, v int").repartition(partitions)
    got = {r.id: r.pct_rank for r in percent_rank_average(df, "v").collect()}
    want = pd.Series(values).rank(pct=True, method="average")
    assert got == want.to_dict()


def test_percent_rank_keeps_null_rows(spark):
    df = spark.createDataFrame([(1, None), (2, 5.0), (3, 6.0)], "id int, v double")
    got = {r.id: r.pct_rank for r in percent_rank_average(df, "v").collect()}
    assert got == {1: None, 2: 0.5, 3: 1.0}


def test_equal_values_share_the_middle(spark):
    df = spark.createDataFrame([(7,)] * 9, "v int")
    row = value_ranks(df, ["v"]).first()
    assert row.pct_rank == pytest.approx((9 + 1) / (2 * 9))


def test_metrics_share_one_sort(spark, values):
    pdf = pd.DataFrame({"a": values, "b": [v % 7 for v in values]})
    ranks = value_ranks(spark.createDataFrame(pdf), ["a", "b"]).collect()
    for metric in ("a", "b"):
        want = dict(zip(pdf[metric].astype(float), pdf[metric].rank(pct=True)))
        got = {r.value: r.pct_rank for r in ranks if r.metric == metric}
        assert got == want


def test_numbered_running_total(spark, values):
    pdf = pd.DataFrame({"id": range(len(values)), "v": values})
    df = spark.createDataFrame(pdf)
    got = numbered(df, [F.desc("v"), F.col("id")], running=["v"]).orderBy("row_num").collect()
    want = pdf.sort_values(["v", "id"], ascending=[False, True])
    assert [r.id for r in got] == want["id"].tolist()
    assert [r.row_num for r in got] == list(range(1, len(values) + 1))
    assert [r.cum_v for r in got] == want["v"].cumsum().tolist()
    assert {r.total_v for r in got} == {sum(values)} and {r.total_rows for r in got} == {500}


@pytest.mark.parametrize("n", [1, 3, 9, 10, 23, 100])
def test_tile_equals_ntile(spark, n):
    from pyspark.sql import Window

    df = spark.range(n).withColumn("row_num", F.col("id") + 1).withColumn("total_rows", F.lit(n))
    w = Window.orderBy("id")
    got = df.select(tile(10).alias("a"), F.ntile(10).over(w).alias("b")).collect()
    assert all(r.a == r.b for r in got)


def test_plan_has_no_global_window_over_rows(spark, values):
    df = spark.createDataFrame([(v,) for v in values], "v int")
    plan = numbered(df, [F.col("v")])._jdf.queryExecution().executedPlan().toString()
    # The only single-partition exchange sits below the per-partition totals.
    assert plan.count("SinglePartition") == 1
