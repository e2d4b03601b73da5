"""The shared folder: what is refused on a cluster, and what is deleted."""

import os
from types import SimpleNamespace

import pytest
from pyspark.sql import functions as F

from shelfmark import session
from shelfmark.operators.quality import value_distribution


class Elsewhere:
    """A session whose master is another one and whose shared folder is not set."""

    def __init__(self, spark, master):
        self._jvm, self._jsc, self.made = spark._jvm, spark._jsc, []
        self.conf = SimpleNamespace(get=lambda key, default=None: default if key == "spark.checkpoint.dir" else spark.conf.get(key))
        self.sparkContext = SimpleNamespace(master=master, getCheckpointDir=lambda: self.made[-1] if self.made else None, setCheckpointDir=self.made.append)


@pytest.mark.parametrize("master", ["yarn", "spark://host:7077", "local-cluster[2,1,1024]"])
def test_local_warehouse_is_refused_on_a_cluster(spark, master):
    with pytest.raises(ValueError, match="spark.checkpoint.dir"):
        session.shared_dir(Elsewhere(spark, master))


@pytest.mark.parametrize("master", ["local", "local[8]"])
def test_local_warehouse_is_used_on_one_machine(spark, master):
    assert session.shared_dir(Elsewhere(spark, master)).endswith("/shelfmark-work")


def test_cleanup_deletes_the_tables_of_this_application(spark, monkeypatch):
    monkeypatch.setattr(session, "_MADE", {})
    monkeypatch.setattr(session, "_TABLES", {})
    rows = spark.range(20).withColumn("part", F.col("id") % 2)
    paths = [session.fresh_dir(spark, name) for name in ("plain", "split", "never-written")]
    session.stored(rows, paths[0])
    buckets = session.stored_split(rows, paths[1], ["part"], (3, "id"))
    (name,) = session._TABLES[spark.sparkContext.applicationId]
    assert buckets.count() == 20 and spark.catalog.tableExists(name)
    local = [p.removeprefix("file:") for p in paths[:2]]
    assert all(os.path.isdir(p) for p in local)
    assert session.cleanup(spark) == 2
    assert not any(os.path.exists(p) for p in local) and not spark.catalog.tableExists(name)
    assert session.cleanup(spark) == 0


def test_value_distribution_has_no_window(spark):
    df = spark.createDataFrame([("a",), ("a",), (None,), ("b",)], "v string")
    out = value_distribution(df, F.col("v"), "v")
    assert {(r.value, r.n, r.pct_of_rows) for r in out.collect()} == {("a", 2, 50.0), (None, 1, 25.0), ("b", 1, 25.0)}
    assert "Window" not in out._jdf.queryExecution().executedPlan().toString()
    assert value_distribution(df.where("false"), F.col("v"), "v").collect() == []
