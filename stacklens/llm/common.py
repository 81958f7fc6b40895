"""Shared pieces: written intermediates, words, row ids, joins with small tables."""

from __future__ import annotations

import uuid

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from stacklens.session import configure, shared_dir

# Fixed value: the white space of all contracts.
SPACE = r"[\x20\x09-\x0D]"

#: Largest row count of a table that may be broadcast.
BROADCAST_ROWS = 10_000


#: Bytes that one batch for a Python worker holds, beyond a single long row.
BATCH_BYTES = 4 << 20


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """A table, with batches for Python workers that are small enough for whole texts."""
    configure(spark).conf.set("spark.sql.execution.arrow.maxBytesPerBatch", str(BATCH_BYTES))
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "documents")


#: Paths given out in this driver and not yet deleted.
_SCRATCH: list[str] = []


def scratch_path(spark: SparkSession, name: str) -> str:
    """A new path in the shared folder, deleted when the driver ends."""
    path = f"{shared_dir(spark).rstrip('/')}/llm-{name}-{uuid.uuid4().hex}"
    hadoop = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    files = hadoop.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    files.mkdirs(hadoop)
    files.deleteOnExit(hadoop)
    _SCRATCH.append(path)
    return path


def tidy(docs: DataFrame) -> None:
    """Deletes all scratch tables that ``docs`` does not read.

    For a job of stages whose results are written: at the start of a stage the intermediates of
    the ones before are no longer needed.
    """
    spark = docs.sparkSession
    read = docs.inputFiles()
    for path in list(_SCRATCH):
        name = path.rsplit("/", 1)[-1]
        if not any(f"/{name}/" in f for f in read):
            hadoop = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
            hadoop.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(hadoop, True)
            _SCRATCH.remove(path)


def written(df: DataFrame, name: str) -> DataFrame:
    """``df`` as a Parquet table in the shared folder.

    Cuts the lineage: a lost executor costs no recomputation of what is written.
    """
    path = f"{scratch_path(df.sparkSession, name)}/rows"
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def numbered(docs: DataFrame, name: str, **columns: Column) -> DataFrame:
    """Table of ``rid`` (unique, fixed by being written), ``row`` (all columns of ``docs``) and ``columns``.

    The struct keeps clashing names of extra columns apart from those an operator adds.
    """
    row = F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row")
    return written(docs.select(F.monotonically_increasing_id().alias("rid"), row,
                               *[c.alias(k) for k, c in columns.items()]), name)


def unpacked(df: DataFrame) -> DataFrame:
    """The columns of ``row`` again."""
    return df.select("row.*")


def whole(text: str | Column = "text") -> Column:
    """Null text counts as empty."""
    return F.coalesce(F.col(text) if isinstance(text, str) else text, F.lit(""))


def words(text: Column) -> Column:
    """Array of the maximal runs of anything but white space."""
    return F.array_remove(F.split(text, f"{SPACE}+"), "")


def n_words(text: Column) -> Column:
    return F.size(words(text)).cast("long")


def join_checked(big: DataFrame, small: DataFrame, on: Column, how: str = "inner", rows: int | None = None) -> DataFrame:
    """Broadcast ``small`` only if its counted rows are few; else both sides are shuffled.

    The shuffled form is a plain sort-merge join, whose hot partitions adaptive execution splits.
    """
    rows = small.count() if rows is None else rows
    return big.join(F.broadcast(small) if rows <= BROADCAST_ROWS else small, on, how)


def per_task(spark: SparkSession, rows: int, size: int) -> int:
    """Number of groups of about ``size`` rows."""
    return max(1, -(-rows // size))


#: Equal rows that one task writes out at a time.
REPEATS = 100_000


def told_apart(rows: DataFrame, name: str, at_once: int = REPEATS) -> DataFrame:
    """``rows``, written, with ``repeat`` that counts equal rows from 0.

    Equal rows are counted first, so a row that occurs very often meets in no task; it is
    written out by many. Neither partitions nor the order of rows matter.
    """
    columns = rows.columns
    counted = written(rows.groupBy(*columns).agg(F.count(F.lit(1)).alias("n_equal")), f"{name}-counts")
    few = counted.where(F.col("n_equal") <= at_once).select(*columns, F.explode(F.sequence(F.lit(0).cast("long"), F.col("n_equal") - 1)).alias("repeat"))
    blocks = F.explode(F.sequence(F.lit(0).cast("long"), F.expr(f"(n_equal - 1) DIV {at_once}")))
    many = counted.where(F.col("n_equal") > at_once).select("*", blocks.alias("block")).repartition("block")
    begin = F.col("block") * at_once
    many = many.select(*columns, F.explode(F.sequence(begin, F.least(begin + at_once, "n_equal") - 1)).alias("repeat"))
    return written(few.unionByName(many), name)


def whole_groups(batches, keys: tuple[str, ...], rows: int):
    """Tables of about ``rows`` rows of sorted batches; no group of equal ``keys`` is parted."""
    held, n, want = [], 0, rows
    for batch in batches:
        held.append(batch)
        n += len(batch)
        if n < want:
            continue
        table = pa.Table.from_batches(held).combine_chunks()
        new = np.zeros(n, dtype=bool)
        for k in keys:
            column = table[k].to_numpy()
            new[1:] |= column[1:] != column[:-1]
        cut = int(n - 1 - np.argmax(new[::-1])) if new.any() else 0
        if cut:
            yield table.slice(0, cut)
        rest = table.slice(cut)
        held, n = rest.to_batches(), len(rest)
        want = max(rows, 2 * n)
    if n:
        yield pa.Table.from_batches(held).combine_chunks()
