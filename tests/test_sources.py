import pytest
from pyspark.sql import functions as F

from stacklens import schemas
from stacklens.operators import validation
from stacklens.schemas import SchemaError
from stacklens.sources import readers, testdata, writers


def test_unknown_source(spark):
    with pytest.raises(ValueError, match="Unknown source"):
        readers.load_loans(spark, "ftp", "x")


def test_missing_path(spark):
    with pytest.raises(ValueError, match="filepath required"):
        readers.load_pos(spark, "csv")


def test_missing_column(spark, loans, tmp_path):
    loans.drop("genre").limit(5).write.option("header", True).csv(str(tmp_path / "l"))
    with pytest.raises(ValueError, match="Schema validation failed"):
        readers.load_loans(spark, "csv", str(tmp_path / "l"))


@pytest.mark.parametrize("kind", ["pos", "activity"])
def test_csv_round_trip(spark, tiny, tmp_path, kind):
    table = getattr(testdata, kind)(spark, tiny)
    write = table.write.option("header", True).option("escape", '"')
    write.option("timestampFormat", "yyyy-MM-dd HH:mm:ss.SSSSSS").csv(str(tmp_path / kind))
    back = getattr(readers, f"load_{kind}")(spark, "csv", str(tmp_path / kind), check_rows=True)
    assert back.schema == getattr(schemas, kind.upper())
    assert back.exceptAll(table).count() == 0 and back.count() == table.count()


def test_csv_columns_in_another_order(spark, loans, tmp_path):
    loans.select(*reversed(loans.columns)).write.option("header", True).csv(str(tmp_path / "r"))
    assert readers.load_loans(spark, "csv", str(tmp_path / "r")).exceptAll(loans).count() == 0


BROKEN = "P1,B1,t,g,31/12/2023,2024-01-02T00:00:00.000Z,returned,abc,0,18-25,basic"


@pytest.mark.parametrize("check_rows", [False, True])
def test_malformed_csv_is_refused(spark, loans, tmp_path, check_rows):
    loans.limit(3).coalesce(1).write.option("header", True).csv(str(tmp_path / "l"))
    (tmp_path / "l" / "part-broken.csv").write_text(",".join(loans.columns) + "\n" + BROKEN + "\n")
    with pytest.raises(Exception, match="MALFORMED|Malformed|malformed"):
        readers.load_loans(spark, "csv", str(tmp_path / "l"), check_rows).select("patron_id").collect()


def test_malformed_csv_rows_can_be_kept_aside(spark, loans, tmp_path):
    loans.limit(3).coalesce(1).write.option("header", True).csv(str(tmp_path / "l"))
    (tmp_path / "l" / "part-broken.csv").write_text(",".join(loans.columns) + "\n" + BROKEN + "\n")
    rows = readers.load_loans(spark, "csv", str(tmp_path / "l"), rejects=str(tmp_path / "bad"))
    assert rows.count() == 3
    assert [r.value for r in spark.read.text(str(tmp_path / "bad")).collect()] == [BROKEN]


def test_typed_sources_must_have_timestamps(spark, loans, tmp_path):
    loans.limit(2).withColumn("checkout_date", F.lit("2024-01-01")).write.parquet(str(tmp_path / "p"))
    with pytest.raises(SchemaError, match="checkout_date must be a timestamp"):
        readers.load_loans(spark, "parquet", str(tmp_path / "p"))


def test_parquet_by_month(spark, loans, tmp_path):
    path = writers.write_table(loans, str(tmp_path / "loans"), month_of="checkout_date")
    back = spark.read.parquet(path)
    assert back.select(loans.columns).exceptAll(loans).count() == 0
    assert "checkout_date_month" in back.columns


def test_reports_append(spark, tmp_path):
    path = str(tmp_path / "report")
    for i in (1, 2):
        writers.append_report(spark.range(1).select(F.lit(i).alias("run"), F.lit(0.5 * i).alias("psi")), path)
    assert writers.latest_report(spark, path, "run int, psi double", "run").first().psi == 1.0


@pytest.mark.parametrize("column,value", [("patron_id", None), ("book_id", None)])
def test_null_keys_are_refused(spark, loans, column, value):
    broken = loans.limit(3).withColumn(column, F.lit(value).cast("string"))
    with pytest.raises(SchemaError, match=f"null {column}"):
        validation.require_rows(broken, not_null=("patron_id", "book_id"))


def test_negative_amount_and_duplicate_ids(spark, tiny):
    pos = testdata.pos(spark, tiny)
    with pytest.raises(SchemaError, match="negative amount"):
        validation.require_rows(pos.withColumn("amount", -F.col("amount")), non_negative=("amount",))
    with pytest.raises(SchemaError, match="duplicate transaction_id"):
        validation.require_rows(pos.union(pos.limit(1)), unique="transaction_id")


def test_checkout_must_be_a_timestamp(loans):
    with pytest.raises(SchemaError):
        validation.require_timestamp(loans.withColumn("checkout_date", F.lit("x")), "checkout_date")


def test_null_status_is_invalid_and_null_dates_are_not(spark):
    rows = spark.createDataFrame(
        [("P1", "B1", None, None, None, None, None, 3, 0, None, None)], schemas.LOANS)
    failed = {r.check: r.failed for r in validation.check_loans(rows).collect()}
    assert failed["valid_loan_status"] == 1 and failed["return_after_checkout"] == 0


def test_two_null_ids_are_duplicates(spark, tiny):
    pos = testdata.pos(spark, tiny).limit(3).withColumn("transaction_id", F.lit(None).cast("string"))
    failed = {r.check: r.failed for r in validation.check_pos(pos).collect()}
    assert failed["no_duplicate_transactions"] == 2


def test_gate(spark, tiny):
    report = validation.check_loans(testdata.loans(spark, tiny, dirty=True))
    assert validation.gate(report, "warn") is False
    with pytest.raises(SchemaError, match="return_after_checkout"):
        validation.gate(report)
    assert validation.gate(validation.check_loans(testdata.loans(spark, tiny)))
