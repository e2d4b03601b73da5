"""The queries of mining, manifest and sharding against their SQL, row by row."""

import pytest

from checks.compare import canonical, duck
from shelfmark.llm.queries import ORACLE, QUERIES


@pytest.mark.parametrize("name", ["op11_hard_negatives", "op12_manifest", "op13_sharding"])
def test_query_equals_its_sql(spark, sf_dir, name):
    df = QUERIES[name](spark, sf_dir)
    want = duck(sf_dir).sql(ORACLE[name])
    assert sorted(df.columns) == sorted(want.columns)
    got = canonical([tuple(r) for r in df.collect()], df.columns)
    assert got == canonical(want.fetchall(), want.columns) and got
