"""Parquet and JSON sinks."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def write_table(df: DataFrame, path: str, month_of: str | None = None) -> str:
    """Overwrite a parquet table; ``month_of`` names the timestamp to partition by month.

    Rows are rebalanced by month before the write: adaptive execution packs small
    months together and splits a month that holds a large part of the rows.
    """
    if month_of is None:
        df.write.mode("overwrite").parquet(path)
        return path
    month = f"{month_of}_month"
    by_month = df.withColumn(month, F.date_format(month_of, "yyyy-MM")).hint("rebalance", month)
    by_month.write.mode("overwrite").partitionBy(month).parquet(path)
    return path


def append_report(report: DataFrame, path: str) -> str:
    """Append report rows as JSON lines."""
    report.write.mode("append").json(path)
    return path


def latest_report(spark: SparkSession, path: str, schema, order_column: str) -> DataFrame:
    """Newest row of an append-only JSON report."""
    return spark.read.schema(schema).json(path).orderBy(F.desc(order_column)).limit(1)
