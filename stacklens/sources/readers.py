"""Batch readers: CSV and parquet in, a checked table with the declared types out."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from stacklens import schemas
from stacklens.operators.validation import require_columns, require_rows, require_timestamp

FORMATS = ("csv", "parquet", "table")


MALFORMED = "_malformed"


def _read(spark: SparkSession, source: str, path: str | None, schema: T.StructType, rejects: str | None = None) -> DataFrame:
    """The columns of ``schema``, with its types.

    A CSV value that does not parse fails the job when its row is read; with ``rejects``, the text of
    such rows is written to that folder instead and the others are returned. In typed
    sources the columns that must be timestamps have to be.
    """
    if source not in FORMATS:
        raise ValueError(f"Unknown source: {source!r}; expected one of {FORMATS}")
    if not path:
        raise ValueError(f"filepath required for source {source!r}")
    if source == "csv":
        # Quotes inside a field are doubled, as most writers do (event metadata is JSON text).
        reader = spark.read.option("header", True).option("escape", '"')
        header = reader.csv(path).columns
        require_columns(header, schema)
        # Read as text and parsed here, all columns of every row, so that pruning cannot hide a malformed one.
        text = T.StructType([T.StructField(c, T.StringType()) for c in [*header, MALFORMED]])
        df = reader.option("columnNameOfCorruptRecord", MALFORMED).option("columnPruning", False).schema(text).csv(path)
        bad = F.col(MALFORMED).isNotNull()
        for field in schema.fields:
            bad = bad | (df[field.name].isNotNull() & df[field.name].try_cast(field.dataType).isNull())
        row = F.coalesce(MALFORMED, F.to_csv(F.struct(*header)))
        if rejects is None:
            df = df.where(F.when(bad, F.raise_error(F.concat(F.lit("malformed row: "), row)).cast("boolean")).otherwise(True))
        else:
            df.where(bad).select(row.alias("row")).write.mode("append").text(rejects)
            df = df.where(~bad)
        return df.select(*[df[f.name].try_cast(f.dataType).alias(f.name) for f in schema.fields])
    df = spark.read.parquet(path) if source == "parquet" else spark.table(path)
    require_columns(df.columns, schema)
    for field in schema.fields:
        if isinstance(field.dataType, T.TimestampType):
            require_timestamp(df, field.name)
    return df.select(*[df[f.name].cast(f.dataType).alias(f.name) for f in schema.fields])


def load_loans(
    spark: SparkSession, source: str, path: str | None = None, check_rows: bool = False, rejects: str | None = None
) -> DataFrame:
    df = _read(spark, source, path, schemas.LOANS, rejects)
    return require_rows(df, not_null=("patron_id", "book_id")) if check_rows else df


def load_pos(
    spark: SparkSession, source: str, path: str | None = None, check_rows: bool = False, rejects: str | None = None
) -> DataFrame:
    df = _read(spark, source, path, schemas.POS, rejects)
    return require_rows(df, non_negative=("amount",), unique="transaction_id") if check_rows else df


def load_activity(
    spark: SparkSession, source: str, path: str | None = None, check_rows: bool = False, rejects: str | None = None
) -> DataFrame:
    df = _read(spark, source, path, schemas.ACTIVITY, rejects)
    return require_rows(df, not_null=("patron_id",), unique="event_id") if check_rows else df


def parse_metadata(activity: DataFrame) -> DataFrame:
    """Turn the JSON text of ``event_metadata`` into a map of int values."""
    return activity.withColumn("metadata", F.from_json("event_metadata", schemas.METADATA))
