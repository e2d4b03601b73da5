"""Run registered queries in Spark and their SQL in DuckDB and compare every row.

Usage: python checks/compare.py <sf_dir> [name-substring ...]
"""

from __future__ import annotations

import os
import sys
import time

import duckdb
import pandas as pd

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from oracle import ORACLE  # noqa: E402
from shelfmark.plans.registry import QUERIES  # noqa: E402
from shelfmark.session import build_session  # noqa: E402

TABLES = ("region nation customer supplier part orders lineitem events documents embeddings "
          "pages benchmark labels conversations").split()


def duck(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{sf_dir}/{t}.parquet'")
    return con


def canonical(rows: list[tuple], columns: list[str]) -> list[tuple]:
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return sorted(
        (tuple(r[i] for i in order) for r in rows),
        key=lambda r: tuple((v is None, str(v)) for v in r),
    )


def kinds(types: list[str]) -> list[str]:
    out = []
    for t in types:
        t = t.lower()
        t = {"varchar": "string", "integer": "int", "bool": "boolean"}.get(t, t)
        out.append("timestamp" if t.startswith("timestamp") else t)
    return out


def compare(spark, con, name: str, sf_dir: str) -> str:
    start = time.time()
    df = QUERIES[name](spark, sf_dir)
    rows = [tuple(r) for r in df.collect()]
    took = time.time() - start
    if name not in ORACLE:
        return f"rows-only {len(rows):>7} rows {took:6.2f}s"
    rel = con.sql(ORACLE[name])
    want = rel.fetchall()
    cols = rel.columns
    if sorted(cols) != sorted(df.columns):
        return f"MISMATCH columns {sorted(set(cols) ^ set(df.columns))}"
    got_types = dict(zip(df.columns, kinds([t for _, t in df.dtypes])))
    want_types = dict(zip(cols, kinds([str(t) for t in rel.types])))
    type_diff = {c: (got_types[c], want_types[c]) for c in cols if got_types[c] != want_types[c]}
    a, b = canonical(rows, df.columns), canonical(want, cols)
    if len(a) != len(b):
        return f"MISMATCH rows {len(a)} vs {len(b)}"
    for x, y in zip(a, b):
        if x != y:
            names = sorted(cols)
            diff = [(n, p, q) for n, p, q in zip(names, x, y) if p != q]
            return f"MISMATCH {diff[:4]}"
    note = f" TYPES {type_diff}" if type_diff else ""
    return f"ok {len(rows):>7} rows {took:6.2f}s{note}"


def main() -> None:
    sf_dir, wanted = sys.argv[1], sys.argv[2:]
    spark = build_session(**{
        "spark.master": "local[8]", "spark.sql.shuffle.partitions": "8",
        "spark.ui.enabled": "false", "spark.driver.memory": "16g",
    })
    spark.sparkContext.setLogLevel("ERROR")
    con = duck(sf_dir)
    pd.set_option("display.width", 200)
    bad = 0
    for name in QUERIES:
        if wanted and not any(w in name for w in wanted):
            continue
        try:
            result = compare(spark, con, name, sf_dir)
        except Exception as err:  # report and go on with the next query
            result = f"ERROR {type(err).__name__}: {str(err)[:400]}"
        bad += result.startswith(("MISMATCH", "ERROR"))
        print(f"{name:34} {result}", flush=True)
    print("differences:", bad)


if __name__ == "__main__":
    main()
