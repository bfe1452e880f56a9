"""Every query with a SQL oracle equals DuckDB on sf0.001; the rows-only
queries run and return rows.  The flagship ``entry`` runs."""

import pytest

import __spark_entry__ as entry
from turnstile.oracle import compare, duck_connect

from .conftest import SF_SMALL

SQL = entry.oracle_sql()
QUERIES = entry.queries()
# large MLlib jobs run with small models here
HEAVY = {"demand_model", "kmeans_elbow", "cv_scores", "cluster_compare", "staff_model", "feature_corr"}
# queries of the optional subpackage are checked in tests/llm
OTHERS = {n for n in QUERIES if n == "pipeline" or n[:2] == "op" and n[2:3].isdigit()}


@pytest.fixture(scope="module")
def con():
    return duck_connect(SF_SMALL)


@pytest.mark.parametrize("name", sorted(set(SQL) - OTHERS))
def test_query_matches_oracle(spark, con, name):
    res = compare(QUERIES[name](spark, SF_SMALL), con, SQL[name])
    assert res["match"], res
    assert not res["type_differences"], res


@pytest.mark.parametrize("name", sorted(set(QUERIES) - set(SQL) - HEAVY - OTHERS))
def test_rows_only_query_runs(spark, name):
    assert QUERIES[name](spark, SF_SMALL).count() > 0


@pytest.mark.parametrize("name", sorted(HEAVY))
def test_small_models(spark, monkeypatch, name):
    from turnstile.plans import models as PM
    for size, value in (("BOOSTED_TREES", 5), ("FOREST_TREES", 5), ("CV_TREES", 2), ("KMEANS_STARTS", 2)):
        monkeypatch.setattr(PM, size, value)
    rows = QUERIES[name](spark, SF_SMALL).collect()
    assert rows and all(v is not None for r in rows for k, v in r.asDict().items() if k != "corr")


def test_entry_smoke(spark):
    df = entry.entry(spark)
    assert df.count() >= 0 and "review_volume_change" in df.columns
