"""Loads one after the other against one load of everything."""

from datetime import datetime, timedelta

import pytest

from stacklens import schemas
from stacklens.operators import behavioral, temporal
from stacklens.plans import incremental_etl as etl

START = datetime(2024, 1, 1, 10)


def loan(patron, book, day, genre="Fiction"):
    values = {"patron_id": patron, "book_id": book, "checkout_date": START + timedelta(days=day), "genre": genre, "loan_status": "returned",
              "times_renewed": day % 3, "loan_duration_days": 7 + day % 5}
    return tuple(values.get(f) for f in schemas.LOANS.fieldNames())


def sale(patron, number, amount):
    values = {"transaction_id": f"T{number}", "patron_id": patron, "amount": amount, "transaction_type": "donation", "payment_method": "card",
              "items_purchased": 1, "transaction_date": START}
    return tuple(values.get(f) for f in schemas.POS.fieldNames())


@pytest.fixture()
def frames(spark):
    def build(loans, sales=()):
        return (spark.createDataFrame(list(loans), schemas.LOANS), spark.createDataFrame(list(sales), schemas.POS),
                spark.createDataFrame([], schemas.ACTIVITY))
    return build


def files(spark, path):
    return {f for f in spark.read.parquet(path).inputFiles()}


def master(loans, pos, activity):
    return behavioral.master_features(temporal.temporal_features(loans), behavioral.behavioral_features(loans, pos, activity))


def rows(df):
    columns = sorted(df.columns)
    return columns, sorted(map(repr, df.select(*[behavioral.quoted(c) for c in columns]).collect()))


def test_loads_add_up(spark, frames, tmp_path):
    """A hot patron, a null one, a sale before the first loan, a new genre, a corrected load, an empty load."""
    out = str(tmp_path / "store")
    first = [loan("HOT", f"B{i}", i % 100) for i in range(200)] + [loan(f"P{i}", "B1", i) for i in range(12)] + [loan(None, "B1", 3)]
    wrong = [loan("GONE", "B3", 150), loan("P1", "B3", 150)]
    right = [loan("P2", "B4", 160, "fiction"), loan("NEW", "B5", 130, "Poetry")]
    sales = [sale("NEW", 1, 5.0), sale("P2", 2, 2.5)]
    assert etl.load_day(spark, 1, *frames(first, sales), out, 8)
    etl.load_day(spark, 2, *frames(wrong), out)
    assert "GONE" in {r.patron_id for r in etl.current_master(spark, out).collect()}
    before = files(spark, f"{out}/behavioral")
    hit = etl.load_day(spark, 2, *frames(right, [sale("P2", 3, 4.0)]), out)
    after = files(spark, f"{out}/behavioral")
    untouched = {f for f in before if int(f.split("bucket=")[1].split("/")[0]) not in hit}
    assert untouched and untouched <= after and not (after & before) - untouched
    assert etl.load_day(spark, 3, *frames([]), out) == []
    whole = frames(first + right, [*sales, sale("P2", 3, 4.0)])
    assert rows(etl.current_master(spark, out)) == rows(master(*whole))
