"""Data-quality checks: one aggregate pass per table, one report row per check."""

from __future__ import annotations

import functools
from collections.abc import Iterable, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from stacklens import schemas
from stacklens.schemas import SchemaError


def require_columns(columns: Iterable[str], schema: T.StructType) -> None:
    """Raise when a required column is missing (metadata only, no job)."""
    missing = sorted(set(schema.fieldNames()) - set(columns))
    if missing:
        raise SchemaError(f"Schema validation failed: missing columns {missing}")


def require_timestamp(df: DataFrame, column: str) -> None:
    if not isinstance(df.schema[column].dataType, (T.TimestampType, T.TimestampNTZType, T.DateType)):
        raise SchemaError(f"Schema validation failed: {column} must be a timestamp")


def duplicate_count(df: DataFrame, column: str) -> DataFrame:
    """Rows beyond the first of each value; two NULLs count as equal."""
    per_value = df.groupBy(column).agg(F.count(F.lit(1)).alias("n"))
    return per_value.agg(F.coalesce(F.sum(F.col("n") - 1), F.lit(0)).cast("long").alias("failed"))


def require_rows(
    df: DataFrame,
    not_null: Sequence[str] = (),
    non_negative: Sequence[str] = (),
    unique: str | None = None,
) -> DataFrame:
    """Raise on the first contract breach; return the frame unchanged otherwise."""
    checks = {f"null {c}": F.count_if(F.col(c).isNull()) for c in not_null}
    checks |= {f"negative {c}": F.count_if(F.col(c) < 0) for c in non_negative}
    found = df.agg(*[expr.alias(name) for name, expr in checks.items()]).first().asDict() if checks else {}
    if unique is not None:
        found[f"duplicate {unique}"] = duplicate_count(df, unique).first()["failed"]
    broken = {name: n for name, n in found.items() if n}
    if broken:
        raise SchemaError(f"Schema validation failed: {broken}")
    return df


def _outside(column: str, allowed: list[str]) -> Column:
    return ~F.coalesce(F.col(column).isin(allowed), F.lit(False))


def _report(counts: DataFrame, source: str, labels: dict[str, str]) -> DataFrame:
    """One-row frame of failure counts → rows (source, check, failed, passed, detail)."""
    rows = F.array(*[
        F.struct(
            F.lit(name).alias("check"),
            F.col(name).alias("failed"),
            F.concat(F.col(name).cast("string"), F.lit(f" {text}")).alias("detail"),
        )
        for name, text in labels.items()
    ])
    return counts.select(F.inline(rows)).select(
        F.lit(source).alias("source"), "check", "failed", (F.col("failed") == 0).alias("passed"), "detail"
    )


def _with_duplicates(df: DataFrame, key: str, checks: dict[str, Column], name: str) -> DataFrame:
    """All row checks plus the duplicate count of ``key`` in one aggregation by key.

    The per-key stage is hash-partitioned on the key and pre-aggregated, the final
    stage adds up one row per key.
    """
    per_key = df.groupBy(key).agg(
        F.count(F.lit(1)).alias("rows_of_key"), *[F.count_if(c).alias(n) for n, c in checks.items()]
    )
    return per_key.agg(
        F.coalesce(F.sum(F.col("rows_of_key") - 1), F.lit(0)).cast("long").alias(name),
        *[F.coalesce(F.sum(n), F.lit(0)).cast("long").alias(n) for n in checks],
    )


def check_loans(loans: DataFrame) -> DataFrame:
    counts = loans.agg(
        F.count_if(F.col("patron_id").isNull()).alias("no_null_patron_ids"),
        F.count_if(F.col("return_date") < F.col("checkout_date")).alias("return_after_checkout"),
        F.count_if(F.col("loan_duration_days") <= 0).alias("positive_loan_duration"),
        F.count_if(_outside("loan_status", schemas.LOAN_STATUSES)).alias("valid_loan_status"),
        F.count_if(F.col("times_renewed") < 0).alias("non_negative_renewals"),
    )
    return _report(counts, "loans", {
        "no_null_patron_ids": "null patron ids",
        "return_after_checkout": "loans returned before checkout",
        "positive_loan_duration": "loans with a duration of 0 or less",
        "valid_loan_status": "loans with an unknown status",
        "non_negative_renewals": "loans with negative renewals",
    })


def check_pos(pos: DataFrame) -> DataFrame:
    counts = _with_duplicates(pos, "transaction_id", {
        "no_negative_amounts": F.col("amount") < 0,
        "valid_transaction_types": _outside("transaction_type", schemas.TRANSACTION_TYPES),
        "positive_items_purchased": F.col("items_purchased") <= 0,
    }, "no_duplicate_transactions")
    return _report(counts, "pos", {
        "no_duplicate_transactions": "repeated transaction ids",
        "no_negative_amounts": "sales with a negative amount",
        "valid_transaction_types": "sales of an unknown type",
        "positive_items_purchased": "sales without items",
    })


def check_activity(activity: DataFrame) -> DataFrame:
    counts = _with_duplicates(activity, "event_id", {
        "valid_event_types": _outside("event_type", schemas.EVENT_TYPES),
        "no_null_patron_ids": F.col("patron_id").isNull(),
    }, "no_duplicate_events")
    return _report(counts, "activity", {
        "no_duplicate_events": "repeated event ids",
        "valid_event_types": "events of an unknown type",
        "no_null_patron_ids": "null patron ids",
    })


def patrons_missing_from(table: DataFrame, loans: DataFrame) -> DataFrame:
    """Distinct patrons of ``table`` without a loan (a NULL patron counts as one)."""
    known = loans.select(F.col("patron_id").alias("known")).distinct()
    patrons = table.select("patron_id").distinct()
    return patrons.join(known, patrons.patron_id.eqNullSafe(known.known), "left_anti")


def check_cross_source(loans: DataFrame, pos: DataFrame, activity: DataFrame) -> DataFrame:
    def span(df: DataFrame, column: str) -> Column:
        return df.agg(F.struct(F.min(column).alias("first"), F.max(column).alias("last"))).scalar()

    def missing(df: DataFrame, check: str, label: str) -> DataFrame:
        return patrons_missing_from(df, loans).agg(F.count(F.lit(1)).alias("failed")).select(
            F.lit(check).alias("check"), "failed",
            F.concat(F.col("failed").cast("string"), F.lit(f" patrons of {label} without loans")).alias("detail"),
        )

    def days(s: Column) -> Column:
        return F.concat(F.date_format(s["first"], "yyyy-MM-dd"), F.lit(" to "), F.date_format(s["last"], "yyyy-MM-dd"))

    one = loans.sparkSession.range(1)
    spans = one.select(span(loans, "checkout_date").alias("l"), span(pos, "transaction_date").alias("p"))
    apart = ~((F.col("p.first") <= F.col("l.last")) & (F.col("p.last") >= F.col("l.first")))
    overlap = spans.select(
        F.lit("date_range_overlap").alias("check"),
        F.coalesce(apart, F.lit(True)).cast("long").alias("failed"),
        F.concat(F.lit("loans "), days(F.col("l")), F.lit(", pos "), days(F.col("p"))).alias("detail"),
    )
    rows = functools.reduce(DataFrame.unionByName, [
        missing(pos, "pos_patrons_in_lms", "pos"),
        missing(activity, "activity_patrons_in_lms", "activity"),
        overlap,
    ])
    return rows.select(
        F.lit("cross_source").alias("source"), "check", "failed", (F.col("failed") == 0).alias("passed"), "detail"
    )


def check_all(loans: DataFrame, pos: DataFrame, activity: DataFrame) -> DataFrame:
    return functools.reduce(DataFrame.unionByName, [
        check_loans(loans), check_pos(pos), check_activity(activity), check_cross_source(loans, pos, activity)
    ])


def gate(report: DataFrame, mode: str = "strict") -> bool:
    """True when every check passed; otherwise raise (``strict``) or return False (``warn``)."""
    failed = [f"{r.source}.{r.check}: {r.detail}" for r in report.where(~F.col("passed")).collect()]
    if failed and mode == "strict":
        raise SchemaError("Validation failed: " + "; ".join(failed))
    return not failed
