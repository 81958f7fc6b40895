"""Streaming activity: source, de-duplication, quarantine and live sums."""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from stacklens import schemas
from stacklens.operators.behavioral import engagement_counts, engagement_from_counts
from stacklens.session import numbered_folders, remove


def from_kafka(spark: SparkSession, servers: str, topic: str, max_per_trigger: int | None = None) -> DataFrame:
    """Activity rows from JSON messages of a Kafka topic."""
    reader = (
        spark.readStream.format("kafka").option("kafka.bootstrap.servers", servers).option("subscribe", topic)
        .option("startingOffsets", "earliest")
    )
    if max_per_trigger:
        reader = reader.option("maxOffsetsPerTrigger", max_per_trigger)
    return parse_messages(reader.load())


def parse_messages(messages: DataFrame) -> DataFrame:
    """``value`` (JSON text or bytes) → activity columns and ``raw_message``.

    ``raw_message`` has the whole text of a message that does not parse, else NULL, so that
    quarantine can keep it.
    """
    schema = T.StructType([*schemas.ACTIVITY.fields, T.StructField("raw_message", T.StringType())])
    options = {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": "raw_message"}
    parsed = F.from_json(F.col("value").cast("string"), schema, options)
    return messages.select(parsed.alias("a"), F.col("value").cast("string").alias("text")).select(
        *[f"a.{f.name}" for f in schemas.ACTIVITY.fields],
        F.when(F.col("a").isNull(), F.col("text")).otherwise(F.col("a.raw_message")).alias("raw_message"))


def from_files(
    spark: SparkSession, path: str, schema: T.StructType, file_filter: str | None = None,
    max_files: int | None = None,
) -> DataFrame:
    """Rows of parquet files as they arrive in a folder."""
    reader = spark.readStream.schema(schema)
    if file_filter:
        reader = reader.option("pathGlobFilter", file_filter)
    if max_files:
        reader = reader.option("maxFilesPerTrigger", max_files)
    return reader.parquet(path)


def unique_events(stream: DataFrame, out: str, checkpoint: str, lateness: str = "1 day") -> StreamingQuery:
    """First event of each id into ``out/rows``; late events into ``out/late``. Nothing is dropped but repeats.

    An event is late if it is older than the newest one seen before its batch by more than ``lateness``.
    Others are compared with the accepted ids of that span only, found by the time
    statistics of the files, so a batch reads no more than the span. Late events are settled
    against all rows when they are read (``settled_events``). Events without an id are kept.
    """
    def accept(batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        before = [n for n in numbered_folders(spark, f"{out}/newest", "batch_id=") if n < batch_id]
        newest = spark.read.parquet(f"{out}/newest/batch_id={before[-1]}").first()["newest"] if before else None
        bound = F.lit(newest) - F.expr(f"INTERVAL {lateness}") if newest else F.lit(None).cast("timestamp")
        fresh = F.coalesce(F.col("event_timestamp") >= bound, F.lit(True))
        once = _first_of_each(batch).withColumn("fresh", fresh).persist()
        rows = once.where("fresh").drop("fresh")
        if before:
            known = spark.read.parquet(f"{out}/rows").where(F.col("batch_id") < batch_id).where(
                (F.col("event_timestamp") >= bound) | F.col("event_timestamp").isNull())
            rows = rows.join(known.select("event_id"), "event_id", "left_anti").select(batch.columns)
        rows.write.mode("overwrite").parquet(f"{out}/rows/batch_id={batch_id}")
        once.where("NOT fresh").drop("fresh").write.mode("overwrite").parquet(f"{out}/late/batch_id={batch_id}")
        newest_now = once.agg(F.greatest(F.max("event_timestamp"), F.lit(newest).cast("timestamp")).alias("newest"))
        newest_now.write.mode("overwrite").parquet(f"{out}/newest/batch_id={batch_id}")
        once.unpersist()

    return _start(stream, "append", accept, checkpoint)


def _first_of_each(events: DataFrame) -> DataFrame:
    """One row of each id, and all rows without one."""
    return events.where("event_id IS NOT NULL").dropDuplicates(["event_id"]).unionByName(events.where("event_id IS NULL"))


def settled_events(spark: SparkSession, out: str) -> DataFrame:
    """All accepted events and the late ones that repeat none of them."""
    rows, late = (spark.read.parquet(f"{out}/{part}").drop("batch_id") for part in ("rows", "late"))
    more = _first_of_each(late).join(rows.select("event_id"), "event_id", "left_anti").select(rows.columns)
    return rows.unionByName(more)


def is_valid() -> F.Column:
    known = F.coalesce(F.col("event_type").isin(schemas.EVENT_TYPES), F.lit(False))
    return known & F.col("patron_id").isNotNull() & F.col("event_id").isNotNull()


def _start(df: DataFrame, mode: str, work: Callable, checkpoint: str) -> StreamingQuery:
    return (
        df.writeStream.outputMode(mode).foreachBatch(work).option("checkpointLocation", checkpoint)
        .trigger(availableNow=True).start()
    )


def quarantine(stream: DataFrame, out: str, checkpoint: str) -> StreamingQuery:
    """Split every batch into ``out/valid`` and ``out/quarantine``.

    Each batch owns the folder with its id and overwrites it, so a repeated batch
    leaves no duplicates.
    """

    def split(batch: DataFrame, batch_id: int) -> None:
        marked = batch.withColumn("ok", is_valid()).persist()
        marked.where("ok").drop("ok").write.mode("overwrite").parquet(f"{out}/valid/batch_id={batch_id}")
        marked.where("NOT ok").drop("ok").write.mode("overwrite").parquet(f"{out}/quarantine/batch_id={batch_id}")
        marked.unpersist()

    return _start(stream, "append", split, checkpoint)


def additive_updates(
    stream: DataFrame, counts: Callable[[DataFrame], DataFrame], keys: Sequence[str], out: str, checkpoint: str,
    compact_every: int = 10,
) -> StreamingQuery:
    """Running sums of ``counts(batch)`` by ``keys``; all its other columns are added up.

    A batch writes its own sums to ``out/delta``. After ``compact_every`` batches they are added to
    the table of all before, ``out/base``, so what a reader adds up stays bounded. A
    repeated batch overwrites its folder; sums need no watermark and lose no late event.
    """
    def write(batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        counts(batch).write.mode("overwrite").parquet(f"{out}/delta/batch_id={batch_id}")
        if (batch_id + 1) % compact_every:
            return
        old = [n for n in numbered_folders(spark, f"{out}/base", "upto=") if n < batch_id]
        current_sums(spark, keys, out, batch_id - 1, batch_id).write.mode("overwrite").parquet(f"{out}/base/upto={batch_id}")
        # One earlier table stays for readers that have begun.
        for n in old[:-1]:
            remove(spark, f"{out}/base/upto={n}")
        for n in numbered_folders(spark, f"{out}/delta", "batch_id="):
            if old and n <= old[-1]:
                remove(spark, f"{out}/delta/batch_id={n}")

    return _start(stream, "append", write, checkpoint)


def current_sums(spark: SparkSession, keys: Sequence[str], out: str, base: int | None = None, upto: int | None = None) -> DataFrame:
    """The newest table of sums plus the batches after it."""
    bases = [n for n in numbered_folders(spark, f"{out}/base", "upto=") if base is None or n <= base]
    deltas = [n for n in numbered_folders(spark, f"{out}/delta", "batch_id=") if (not bases or n > bases[-1]) and (upto is None or n <= upto)]
    paths = [f"{out}/base/upto={bases[-1]}"] if bases else []
    rows = spark.read.parquet(*paths, *[f"{out}/delta/batch_id={n}" for n in deltas])
    return rows.groupBy(*keys).agg(*[F.sum(c).alias(c) for c in rows.columns if c not in keys])


ENGAGEMENT_KEYS = ("patron_id", "event_type", "device_type")


def engagement_updates(stream: DataFrame, out: str, checkpoint: str, compact_every: int = 10) -> StreamingQuery:
    """Running engagement counts per patron, event type and device."""
    return additive_updates(stream, engagement_counts, ENGAGEMENT_KEYS, out, checkpoint, compact_every)


def latest_engagement(spark: SparkSession, out: str) -> DataFrame:
    """Engagement features from the counts of all batches."""
    return engagement_from_counts(current_sums(spark, ENGAGEMENT_KEYS, out))


def append_batches(stream: DataFrame, out: str, checkpoint: str) -> StreamingQuery:
    """Plain exactly-once copy of a stream into parquet."""
    return (
        stream.writeStream.format("parquet").option("path", out).option("checkpointLocation", checkpoint)
        .trigger(availableNow=True).start()
    )
