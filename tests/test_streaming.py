import json
import math
import random
from datetime import datetime as dt

import pytest
from pyspark.sql import functions as F

from stacklens import schemas
from stacklens.operators.behavioral import engagement_features
from stacklens.session import numbered_folders
from stacklens.sources import testdata
from stacklens.streaming import activity as live
from stacklens.streaming import metrics


def files_of(spark, tiny, path, n):
    """The activity table as n files that arrive one per batch."""
    testdata.activity(spark, tiny).repartitionByRange(n, "event_timestamp").write.parquet(path)
    return live.from_files(spark, path, schemas.ACTIVITY, max_files=1)


def test_engagement_over_many_batches_equals_batch(spark, tiny, tmp_path):
    stream = files_of(spark, tiny, str(tmp_path / "in"), 7)
    live.engagement_updates(stream, str(tmp_path / "out"), str(tmp_path / "cp"), compact_every=2).awaitTermination()
    got = live.latest_engagement(spark, str(tmp_path / "out"))
    want = engagement_features(testdata.activity(spark, tiny))
    assert got.exceptAll(want).count() == 0 and got.count() == want.count()
    # Batches that a table of sums covers are gone, but for those of its last predecessor.
    assert numbered_folders(spark, str(tmp_path / "out/base"), "upto=") == [3, 5]
    assert numbered_folders(spark, str(tmp_path / "out/delta"), "batch_id=") == [4, 5, 6]


@pytest.mark.parametrize("lateness", ["1 day", "60 days"])
@pytest.mark.parametrize("n", [1, 4])
def test_rows_do_not_depend_on_the_batch_size(spark, tiny, tmp_path, n, lateness):
    rows = testdata.activity(spark, tiny)
    rows.union(rows.limit(50)).repartition(n).write.parquet(str(tmp_path / "in"))
    stream = live.from_files(spark, str(tmp_path / "in"), schemas.ACTIVITY, max_files=1)
    live.unique_events(stream, str(tmp_path / "out"), str(tmp_path / "cp"), lateness).awaitTermination()
    got = live.settled_events(spark, str(tmp_path / "out"))
    assert got.exceptAll(rows).count() == 0 and got.count() == rows.count()
    assert (spark.read.parquet(str(tmp_path / "out/late")).count() > 0) == (n > 1 and lateness == "1 day")


def test_events_without_id_or_time_are_kept(spark, tmp_path):
    rows = [(None, "P1", "book_view", dt(2024, 1, 1), "B1", "S", "mobile", "{}")] * 2 + [("E1", "P1", "book_view", None, "B1", "S", "mobile", "{}")] * 2
    for i in range(2):
        spark.createDataFrame(rows, schemas.ACTIVITY).coalesce(1).write.mode("append").parquet(str(tmp_path / "in"))
    stream = live.from_files(spark, str(tmp_path / "in"), schemas.ACTIVITY, max_files=1)
    live.unique_events(stream, str(tmp_path / "out"), str(tmp_path / "cp")).awaitTermination()
    got = [r.event_id for r in live.settled_events(spark, str(tmp_path / "out")).collect()]
    assert sorted(map(str, got)) == ["E1"] + ["None"] * 4


def test_quarantine_keeps_every_row(spark, tiny, tmp_path):
    rows = testdata.activity(spark, tiny)
    rows.withColumn("patron_id", F.when(F.col("event_type") != "book_view", F.col("patron_id"))).write.parquet(str(tmp_path / "in"))
    live.quarantine(live.from_files(spark, str(tmp_path / "in"), schemas.ACTIVITY), str(tmp_path / "out"), str(tmp_path / "cp")).awaitTermination()
    bad = spark.read.parquet(str(tmp_path / "out/quarantine"))
    good = spark.read.parquet(str(tmp_path / "out/valid"))
    assert bad.count() == rows.where("event_type = 'book_view'").count()
    assert bad.count() + good.count() == rows.count()


def test_json_messages(spark):
    message = json.dumps({"event_id": "E1", "patron_id": "P1", "event_type": "book_view",
                          "event_timestamp": "2024-01-01T10:00:00", "book_id": None, "session_id": "S",
                          "device_type": "mobile", "event_metadata": '{"rating": 4}'})
    row = live.parse_messages(spark.createDataFrame([(bytearray(message.encode()),)], "value binary")).first()
    assert (row.event_id, row.book_id, row.event_timestamp.hour, row.raw_message) == ("E1", None, 10, None)


@pytest.mark.parametrize("message", ["{broken", '{"event_id": "E1", "event_timestamp": "soon"}', "[]", ""])
def test_malformed_messages_keep_their_text(spark, message):
    rows = live.parse_messages(spark.createDataFrame([(message,)], "value string"))
    row = rows.withColumn("ok", live.is_valid()).first()
    assert row.raw_message == message and not row.ok


def test_windows_work_on_a_stream(spark, tiny, tmp_path):
    requests = testdata.request_log(spark, tiny)
    requests.write.parquet(str(tmp_path / "in"))
    stream = live.from_files(spark, str(tmp_path / "in"), requests.schema).withWatermark("request_ts", "1 minute")
    live.append_batches(metrics.windowed_rate(stream, "1 hour"), str(tmp_path / "out"), str(tmp_path / "cp")).awaitTermination()
    closed = spark.read.parquet(str(tmp_path / "out"))
    batch = metrics.windowed_rate(requests, "1 hour")
    # The last window stays open, so only closed ones are compared.
    assert closed.exceptAll(batch).count() == 0
    assert batch.count() - closed.count() <= 5


def test_counts_of_many_batches_give_increase_and_changes(spark, tiny, tmp_path):
    requests = testdata.request_log(spark, tiny)
    requests.repartition(6, F.xxhash64("latency_ms")).write.parquet(str(tmp_path / "in"))
    stream = live.from_files(spark, str(tmp_path / "in"), requests.schema, max_files=1)
    metrics.rate_updates(stream, str(tmp_path / "out"), str(tmp_path / "cp")).awaitTermination()
    want = metrics.windowed_rate(requests, "24 hours", "1 hour").drop("per_second")
    got = metrics.current_increase(spark, str(tmp_path / "out"))
    assert got.exceptAll(want).count() == 0 and got.count() == want.count()
    want = metrics.counter_changes(metrics.counter_samples(requests))
    got = metrics.current_changes(spark, str(tmp_path / "out"))
    assert got.exceptAll(want).count() == 0 and got.count() == want.count()


def near(got, want, error):
    return abs(got - want) <= error * abs(want) * (1 + 1e-9)


@pytest.mark.parametrize("error", [0.01, 0.05])
def test_percentiles_of_a_stream_in_any_order(spark, tmp_path, error):
    pick = random.Random(4)
    values = [pick.lognormvariate(2, 2) for _ in range(700)] + [-pick.lognormvariate(0, 3) for _ in range(200)] + [0.0] * 60 + [1.0] * 40
    pick.shuffle(values)
    rows = [(dt(2024, 1, 1, k % 3, 7 * k % 60), "a", v) for k, v in enumerate(values)]
    rows += [(dt(2024, 1, 1, 5), "a", None), (dt(2024, 1, 1, 5), "a", float("nan")), (dt(2024, 1, 1, 6), "a", float("inf")), (dt(2024, 1, 1, 6), "a", 1e-300)]
    df = spark.createDataFrame(rows, "request_ts timestamp, endpoint string, latency_ms double")
    results = []
    for k, order in enumerate((F.col("request_ts"), F.col("request_ts").desc(), F.rand(3))):
        df.repartitionByRange(5, order).write.parquet(str(tmp_path / f"in{k}"))
        stream = live.from_files(spark, str(tmp_path / f"in{k}"), df.schema, max_files=1)
        metrics.percentile_updates(stream, "latency_ms", str(tmp_path / f"out{k}"), str(tmp_path / f"cp{k}"), "1 hour", error).awaitTermination()
        results.append(sorted(metrics.current_percentiles(spark, str(tmp_path / f"out{k}"), error=error).collect()))
    assert results[0] == results[1] == results[2]
    by_hour = {r.window_start.hour: r for r in results[0]}
    assert sorted(by_hour) == [0, 1, 2, 6] and by_hour[6].n == 2
    for hour in range(3):
        exact = sorted(v for k, v in enumerate(values) if k % 3 == hour)
        row = by_hour[hour]
        assert row.n == len(exact)
        for p, got in ((0.5, row.p50), (0.95, row.p95), (0.99, row.p99)):
            assert near(got, exact[math.ceil(p * len(exact)) - 1], error)
    spread = metrics.percentiles_from_bins(metrics.value_bins(df, "latency_ms", "1 hour", error), [k / 100 for k in range(1, 101)], error).collect()
    for row in (r for r in spread if r.window_start.hour < 3):
        exact = sorted(v for k, v in enumerate(values) if k % 3 == row.window_start.hour)
        assert all(near(row[f"p{k}"], exact[math.ceil(k / 100 * len(exact)) - 1], error) for k in range(1, 101))
