"""Every query with SQL agrees with it on the smallest tables; the others give rows."""

import pytest

import __spark_entry__ as entry
from checks import compare

ORACLE = entry.oracle_sql()
SLOW = {"hybrid_full", "hybrid_explain", "model_comparison", "retrain", "svd_recommend", "svd_similar", "svd_variance", "side_feature_joint"}


@pytest.fixture(scope="module")
def con(tiny):
    return compare.duck(tiny)


@pytest.mark.parametrize("name", sorted(ORACLE))
def test_matches_sql(spark, tiny, con, name):
    df = entry.queries()[name](spark, tiny)
    rows = [tuple(r) for r in df.collect()]
    assert compare.differences(df.columns, rows, *compare.expected(con, ORACLE[name])) == []


@pytest.mark.parametrize("name", sorted(set(entry.queries()) - set(ORACLE) - SLOW))
def test_gives_rows(spark, tiny, name):
    assert entry.queries()[name](spark, tiny).count() > 0


def test_every_sql_has_a_query():
    assert set(ORACLE) <= set(entry.queries())


def test_entry(spark):
    assert entry.entry(spark).count() > 0
