"""What the star export and its import hold on disk."""

import glob

from shelfmark.operators import star
from shelfmark.sources import readers, writers


def test_an_import_is_compared_by_hashes(spark):
    schema = "a string, b string, n double"
    rows = [("x", None, 1.0), (None, "x", 1.0), ("x", None, 1.0), ("", None, 0.0), (None, None, None), ("y", "z", float("nan"))]
    own, other = spark.createDataFrame(rows, schema), spark.createDataFrame([*rows[:2], (None, "x", 1.0), ("", None, -0.0), *rows[4:]], schema)
    of = lambda back, out: tuple(star.import_differences({"t": back}, {"t": out}).first())
    assert of(own, own) == ("t", 6, 6, 0, 0) and of(own, other) == ("t", 6, 6, 1, 1) and of(own, own.limit(4)) == ("t", 6, 4, 0, 2)
    plan_ = star.import_differences({"t": own}, {"t": other})._jdf.queryExecution().executedPlan().toString()
    assert "hashpartitioning(h1" in plan_ and "hashpartitioning(row" not in plan_


def test_a_star_is_exported_compressed(spark, tmp_path):
    rows = spark.range(500).selectExpr("id", "concat('name ', id) as name")
    writers.export_star({"small": rows}, str(tmp_path / "csv"), "packed_", str(tmp_path / "tables")).collect()
    assert glob.glob(f"{tmp_path}/csv/small.csv/*.csv.gz") and glob.glob(f"{tmp_path}/tables/small/*.zstd.parquet")
    back = readers.read_csv(spark, f"{tmp_path}/csv/small.csv", rows.schema)
    assert sorted(back.collect()) == sorted(spark.table("packed_small").collect()) == rows.collect()
