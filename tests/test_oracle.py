"""Every registered query against its SQL on the smallest driver tables."""

import pytest

from checks.compare import compare, duck
from oracle import ORACLE
from shelfmark.plans.registry import QUERIES


@pytest.fixture(scope="module")
def con(sf_dir):
    return duck(sf_dir)


@pytest.mark.parametrize("name", list(QUERIES))
def test_query(spark, con, sf_dir, name):
    result = compare(spark, con, name, sf_dir)
    assert result.startswith(("ok", "rows-only")) and "TYPES" not in result, result


def test_every_oracle_belongs_to_a_query():
    assert set(ORACLE) <= set(QUERIES)
