"""Every query with SQL equals DuckDB on the smallest tables; all operators are registered."""

import re

import pytest

import __spark_entry__ as entry
from turnstile.llm.queries import ORACLE, QUERIES
from turnstile.oracle import compare, duck_connect

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def con():
    return duck_connect(SF)


@pytest.mark.parametrize("name", sorted(ORACLE))
def test_query_matches_oracle(spark, con, name):
    res = compare(QUERIES[name](spark, SF), con, ORACLE[name])
    assert res["match"], res
    assert not res["type_differences"], res


def test_registered():
    names = set(entry.queries())
    assert "pipeline" in names
    assert sorted(int(m[1]) for n in names if (m := re.match(r"op(\d+)_", n))) == list(range(1, 14))
