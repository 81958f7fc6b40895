"""Service metrics over event-time windows.

Counts are additive: streams keep sums per window (``*_updates``) that are read with ``current_*``.
So are the counts of value bins from which a stream's percentiles are read: late rows enter
their window whenever they come, and neither the order nor the size of batches matters.
"""

from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from stacklens.operators import drift
from stacklens.streaming.activity import additive_updates, current_sums

PERCENTILES = (0.50, 0.95, 0.99)


def window_counts(requests: DataFrame, length: str = "1 minute") -> DataFrame:
    """(window_start, endpoint, requests) of tumbling windows; additive over batches."""
    counted = requests.groupBy(F.window("request_ts", length).alias("w"), "endpoint").agg(F.count(F.lit(1)).alias("requests"))
    return counted.select(F.col("w.start").alias("window_start"), "endpoint", "requests")


def rates(counts: DataFrame, seconds: float) -> DataFrame:
    return counts.withColumn("per_second", F.round(F.col("requests") / seconds, 6))


def windowed_rate(requests: DataFrame, length: str = "1 minute", slide: str | None = None) -> DataFrame:
    """Requests and requests per second by endpoint and window.

    Sliding windows are spread from counts of tumbling ones as long as the slide, not from
    the requests; ``length`` must be a multiple of ``slide``.
    """
    seconds = _seconds(length)
    if slide is None:
        return rates(window_counts(requests, length), seconds)
    step = _seconds(slide)
    if seconds % step:
        raise ValueError(f"{length} is no multiple of {slide}")
    return rates(sliding_counts(window_counts(requests, slide), length, slide), seconds)


def sliding_counts(counts: DataFrame, length: str, slide: str) -> DataFrame:
    """Requests of windows of ``length`` that begin every ``slide``, from counts of windows no longer than the slide."""
    seconds, step = _seconds(length), _seconds(slide)
    small = counts.groupBy(F.window("window_start", slide)["start"].alias("window_start"), "endpoint").agg(F.sum("requests").alias("requests"))
    back = F.explode(F.transform(F.sequence(F.lit(0), F.lit(seconds // step - 1)), lambda k: F.make_interval(secs=k * step)))
    spread = small.select("endpoint", "requests", "window_start", back.alias("back"))
    return spread.groupBy((F.col("window_start") - F.col("back")).alias("window_start"), "endpoint").agg(
        F.sum("requests").alias("requests"))


def _seconds(length: str) -> int:
    number, unit = length.split()
    return int(number) * {"second": 1, "minute": 60, "hour": 3600, "day": 86400}[unit.rstrip("s")]


RATE_KEYS = ("window_start", "endpoint")


def rate_updates(stream: DataFrame, out: str, checkpoint: str, length: str = "1 minute"):
    """Running counts per window; late requests are added to their window whenever they come."""
    return additive_updates(stream, lambda batch: window_counts(batch, length), RATE_KEYS, out, checkpoint)


def current_rates(spark: SparkSession, out: str, length: str = "1 minute") -> DataFrame:
    return rates(current_sums(spark, RATE_KEYS, out), _seconds(length))


def current_increase(spark: SparkSession, out: str, length: str = "24 hours", slide: str = "1 hour") -> DataFrame:
    """Requests of the last ``length``, every ``slide``, from the running counts of ``rate_updates``."""
    return sliding_counts(current_sums(spark, RATE_KEYS, out), length, slide)


def current_changes(spark: SparkSession, out: str, length: str = "1 hour", reset: str = "1 day") -> DataFrame:
    """Changes and increase of the running total, from the running counts of ``rate_updates``."""
    return counter_changes(samples_from_counts(current_sums(spark, RATE_KEYS, out), reset), length)


def windowed_percentiles(
    requests: DataFrame, value: str, length: str = "5 minutes", probs: Sequence[float] = PERCENTILES,
    accuracy: int = 10_000,
) -> DataFrame:
    """Percentiles of ``value`` per window from a mergeable sketch (bounded state)."""
    at = F.percentile_approx(value, F.array(*[F.lit(p) for p in probs]), F.lit(accuracy))
    found = requests.groupBy(F.window("request_ts", length).alias("w")).agg(
        F.count(F.lit(1)).alias("n"), at.alias("p")
    )
    return found.select(
        F.col("w.start").alias("window_start"), "n",
        *[F.col("p")[i].alias(f"p{round(p * 100)}") for i, p in enumerate(probs)],
    )


#: Largest relative error of a percentile read from value bins.
BIN_ERROR = 0.01
BIN_KEYS = ("window_start", "sign", "bin")


def _growth(error: float) -> float:
    """Ratio of the bounds of a bin whose middle is off by no more than ``error`` of any value in it."""
    return (1 + error) / (1 - error)


def value_bins(requests: DataFrame, value: str, length: str = "5 minutes", error: float = BIN_ERROR) -> DataFrame:
    """(window_start, sign, bin, n): how many values fall between two powers of a growth factor; additive over batches.

    A bin is the least power that is not below the absolute value. Zero has sign 0 and bin 0. Null and NaN
    are not counted. The number of bins grows with the logarithm of the range of values only.
    """
    v = F.col(value).cast("double")
    power = F.ceil(F.greatest(F.least(F.ln(F.abs(v)) / F.lit(math.log(_growth(error))), F.lit(1e6)), F.lit(-1e6)))
    known = requests.where(v.isNotNull() & ~F.isnan(v)).select(
        F.window("request_ts", length)["start"].alias("window_start"), F.signum(v).cast("int").alias("sign"),
        F.when(v == 0, 0).otherwise(power).cast("long").alias("bin"))
    return known.groupBy(*BIN_KEYS).agg(F.count(F.lit(1)).alias("n"))


def percentiles_from_bins(bins: DataFrame, probs: Sequence[float] = PERCENTILES, error: float = BIN_ERROR) -> DataFrame:
    """(window_start, n, p…): the middle of the bin that holds the value of rank ⌈p·n⌉.

    The rank is exact, the value is off by ``error`` of itself at most.
    """
    growth = _growth(error)
    middle = F.col("sign") * F.lit(2 / (growth + 1)) * F.pow(F.lit(growth), F.col("bin"))
    order = Window.partitionBy("window_start").orderBy("sign", F.col("sign") * F.col("bin"))
    # One row per window and bin, however many values there were.
    upto = bins.select("window_start", middle.alias("middle"), F.sum("n").over(order).alias("upto"),
                       F.sum("n").over(Window.partitionBy("window_start")).alias("total"))
    at = [F.min(F.when(F.col("upto") >= F.ceil(F.lit(p) * F.col("total")), F.struct("upto", "middle")))["middle"].alias(f"p{round(p * 100)}")
          for p in probs]
    return upto.groupBy("window_start").agg(F.max("total").alias("n"), *at)


def percentile_updates(stream: DataFrame, value: str, out: str, checkpoint: str, length: str = "5 minutes", error: float = BIN_ERROR):
    """Running counts of value bins per window."""
    return additive_updates(stream, lambda batch: value_bins(batch, value, length, error), BIN_KEYS, out, checkpoint)


def current_percentiles(spark: SparkSession, out: str, probs: Sequence[float] = PERCENTILES, error: float = BIN_ERROR) -> DataFrame:
    return percentiles_from_bins(current_sums(spark, BIN_KEYS, out), probs, error)


PSI_KEYS = ("day", "feature", "bin")


def psi_updates(stream: DataFrame, profile: DataFrame, ts: str, features: Sequence[str], out: str, checkpoint: str):
    """Running bin counts per day and feature against the edges of a stored baseline profile."""
    def counts(batch: DataFrame) -> DataFrame:
        return drift.bin_counts(profile, drift.to_long(batch.withColumn("day", F.to_date(ts)), features, "day"), ["day"])

    return additive_updates(stream, counts, PSI_KEYS, out, checkpoint)


def current_psi(spark: SparkSession, profile: DataFrame, out: str) -> DataFrame:
    """PSI per day and feature from the counts of all batches."""
    return drift.psi_from_counts(profile, current_sums(spark, PSI_KEYS, out), ["day"])


def counter_samples(requests: DataFrame, length: str = "1 minute", reset: str = "1 day") -> DataFrame:
    """(period, window_start, endpoint, value): a running total of requests that starts anew every ``reset``.

    Ordered within endpoint and period over the counts of windows, not over requests.
    """
    return samples_from_counts(window_counts(requests, length), reset)


def samples_from_counts(counts: DataFrame, reset: str = "1 day") -> DataFrame:
    """The same from counts of windows."""
    counted = counts.withColumn("period", F.window("window_start", reset)["start"])
    upto = Window.partitionBy("endpoint", "period").orderBy("window_start")
    return counted.select("period", "window_start", "endpoint", F.sum("requests").over(upto).alias("value"))


def counter_changes(samples: DataFrame, length: str = "1 hour") -> DataFrame:
    """Changes and increase of a counter by endpoint and window.

    A sample that differs from the one before is a change; one below it means that the
    counter began anew, and counts in full. The first sample of an endpoint is neither.
    """
    order = Window.partitionBy("endpoint").orderBy("window_start")
    before, value = F.lag("value").over(order), F.col("value")
    # One row per endpoint and window of the counter, however many requests there were.
    steps = samples.withColumn("before", before)
    grown = F.when(F.col("before").isNull(), 0).when(value < F.col("before"), value).otherwise(value - F.col("before"))
    return steps.groupBy(F.window("window_start", length).alias("w"), "endpoint").agg(
        F.count_if(value != F.col("before")).alias("changes"), F.sum(grown).alias("increase"),
    ).select(F.col("w.start").alias("window_start"), "endpoint", "changes", "increase")
