"""Queries that use the loans several times join lines with orders once, or once per form of the loans."""

import pytest

from checks import queries
from stacklens.sources import testdata


@pytest.mark.parametrize("name, most", [("system_status", 2), ("incremental_etl_master", 1)])
def test_loans_are_joined_once(spark, tiny, monkeypatch, name, most):
    joined, kept = testdata.loans, queries.cut_lineage
    read, written = [], []

    def counted(df):
        found = kept(df)
        written.append({"checkout_date", "book_id"} <= set(df.columns))
        return found

    monkeypatch.setattr(testdata, "loans", lambda *a, **k: read.append(a) or joined(*a, **k))
    monkeypatch.setattr(queries, "cut_lineage", counted)
    queries.QUERIES[name](spark, tiny)
    assert len(read) == most
    assert written.count(True) == most
