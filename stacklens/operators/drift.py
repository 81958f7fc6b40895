"""Distribution drift between a baseline and the current data.

Numeric inputs are long tables (feature, value): all features go through one plan.
A baseline is reduced to a profile with one row per feature (bin edges and counts),
which is what later checks and the streaming job compare against.
"""

from __future__ import annotations

import functools
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from stacklens.functions.numeric import chi2_upper_tail, clip, steady_round
from stacklens.operators.quantiles import exact_quantiles, value_counts
from stacklens.session import cut_lineage

# Thresholds and smoothing of the drift checks.
PSI_OK = 0.10
PSI_CRITICAL = 0.20
KL_CRITICAL = 0.15
KL_WARNING = 0.15 * 0.7
CHI2_P_VALUE = 0.05
MIN_SHIFT = 0.05
WEEKS_BEFORE_RETRAIN = 5
EPSILON = 1e-6


def to_long(df: DataFrame, features: Sequence[str], *keep: str) -> DataFrame:
    """(feature, value[, keep…]) of the numeric columns."""
    pairs = F.array(*[F.struct(F.lit(f).alias("feature"), F.col(f).cast("double").alias("value")) for f in features])
    return df.select(*keep, F.inline(pairs)).where(F.col("value").isNotNull())


def _bin(edges: Column, value: Column) -> Column:
    """0 … n-1: the number of inner edges at or below the value."""
    return F.size(F.filter(edges, lambda e: e <= value))


def baseline_profile(baseline: DataFrame, n_bins: int = 10) -> DataFrame:
    """(feature, edges, bin_counts, total, mean) with decile-like inner edges of the baseline."""
    counts = cut_lineage(value_counts(baseline))
    edges = exact_quantiles(baseline, [i / n_bins for i in range(1, n_bins)], counts)
    binned = counts.join(F.broadcast(edges), "feature").withColumn("bin", _bin(F.col("quantiles"), F.col("value")))
    per_feature = binned.groupBy("feature").agg(
        *[F.sum(F.when(F.col("bin") == i, F.col("n")).otherwise(0)).alias(f"_{i}") for i in range(n_bins)],
        F.sum("n").alias("total"),
        (F.sum(F.col("n") * F.col("value")) / F.sum("n")).alias("mean"),
    )
    # One row per feature, joined twice by every check.
    return cut_lineage(per_feature.join(edges, "feature").select(
        "feature", F.col("quantiles").alias("edges"),
        F.array(*[F.col(f"_{i}") for i in range(n_bins)]).alias("bin_counts"), "total", "mean",
    ))


def bin_counts(profile: DataFrame, current: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    """(by…, feature, bin, n, total): additive, so batches of a stream add up.

    The profile has one row per feature and is broadcast; the data need one aggregation
    with map-side combine.
    """
    binned = current.join(F.broadcast(profile.select("feature", "edges")), "feature")
    return binned.groupBy(*by, "feature", _bin(F.col("edges"), F.col("value")).alias("bin")).agg(
        F.count(F.lit(1)).alias("n"), F.sum("value").alias("total"))


def psi(
    profile: DataFrame, current: DataFrame, by: Sequence[str] = (), smoothing: str = "full", n_bins: int = 10
) -> DataFrame:
    """Population stability index per feature (and per ``by`` group) against a baseline profile.

    ``smoothing`` is "full" or "simple" (the epsilon is not added to the total).
    """
    return psi_from_counts(profile, bin_counts(profile, current, by), by, smoothing, n_bins)


def psi_from_counts(
    profile: DataFrame, counts: DataFrame, by: Sequence[str] = (), smoothing: str = "full", n_bins: int = 10
) -> DataFrame:
    now = counts.groupBy(*by, "feature").agg(
        *[F.sum(F.when(F.col("bin") == i, F.col("n")).otherwise(0)).alias(f"_{i}") for i in range(n_bins)],
        F.sum("n").alias("current_total"), (F.sum("total") / F.sum("n")).alias("current_mean"),
    )
    joined = now.join(F.broadcast(profile), "feature")
    extra = n_bins * EPSILON if smoothing == "full" else 0.0
    share = lambda c, total: (c + F.lit(EPSILON)) / (F.col(total) + F.lit(extra))
    parts = F.zip_with(
        "bin_counts", F.array(*[F.col(f"_{i}") for i in range(n_bins)]),
        lambda b, c: (share(c, "current_total") - share(b, "total"))
        * F.ln(share(c, "current_total") / share(b, "total")),
    )
    value = F.aggregate(parts, F.lit(0.0), lambda acc, x: acc + x)
    scored = joined.withColumn("raw", F.round(value, 9))
    return scored.select(
        *by, "feature",
        F.round("raw", 4).alias("psi"),
        F.when(F.col("raw") < PSI_OK, "OK").when(F.col("raw") < PSI_CRITICAL, "WARNING").otherwise("CRITICAL").alias("status"),
        steady_round(F.col("mean"), 4).alias("baseline_mean"),
        steady_round(F.col("current_mean"), 4).alias("current_mean"),
        steady_round(F.col("current_mean") - F.col("mean"), 4).alias("mean_shift"),
    )


def mean_psi(values: Column) -> Column:
    return steady_round(F.avg(values), 4)


def kl_drift(scores: DataFrame, n_bins: int = 20) -> DataFrame:
    """One row: KL divergence of current from baseline scores over equal bins of [0, 1].

    ``scores`` has (score, is_baseline). Values outside [0, 1] count at the ends.
    """
    step = 1.0 / n_bins
    lower_edges = F.array(*[F.lit(i * step) for i in range(1, n_bins)])
    side = lambda flag: F.when(F.col("is_baseline") == flag, F.col("score"))
    binned = scores.withColumn("bin", _bin(lower_edges, clip(F.col("score"), 0.0, 1.0)))
    one = binned.agg(
        *[F.count_if(F.col("is_baseline") & (F.col("bin") == i)).alias(f"b_{i}") for i in range(n_bins)],
        *[F.count_if(~F.col("is_baseline") & (F.col("bin") == i)).alias(f"c_{i}") for i in range(n_bins)],
        F.count(side(True)).alias("nb"), F.count(side(False)).alias("nc"),
        F.avg(side(True)).alias("mb"), F.avg(side(False)).alias("mc"),
        F.stddev_pop(side(True)).alias("sb"), F.stddev_pop(side(False)).alias("sc"),
    )
    share = lambda c, n: (F.col(c) + F.lit(EPSILON)) / (F.col(n) + F.lit(n_bins * EPSILON))
    terms = [share(f"c_{i}", "nc") * F.ln(share(f"c_{i}", "nc") / share(f"b_{i}", "nb")) for i in range(n_bins)]
    raw = F.round(sum(terms[1:], terms[0]), 9)
    return one.select(
        F.round(raw, 4).alias("kl_divergence"),
        F.when(raw > KL_CRITICAL, "CRITICAL").when(raw > KL_WARNING, "WARNING").otherwise("OK").alias("status"),
        steady_round(F.col("mb"), 4).alias("baseline_score_mean"), steady_round(F.col("mc"), 4).alias("current_score_mean"),
        steady_round(F.col("sb"), 4).alias("baseline_score_std"), steady_round(F.col("sc"), 4).alias("current_score_std"),
    )


def category_counts(df: DataFrame, features: Sequence[str], is_baseline: Column) -> DataFrame:
    """(feature, category, base, cur): the two histograms side by side."""
    pairs = F.array(*[F.struct(F.lit(f).alias("feature"), F.col(f).alias("category")) for f in features])
    return df.select(is_baseline.alias("_base"), F.inline(pairs)).groupBy("feature", "category").agg(
        F.count_if(F.col("_base")).alias("base"), F.count_if(~F.col("_base")).alias("cur")
    )


def align_histograms(baseline: DataFrame, current: DataFrame) -> DataFrame:
    """Outer join of two (feature, category, n) histograms; a missing category counts 0."""
    b, c = baseline.withColumnRenamed("n", "base"), current.withColumnRenamed("n", "cur")
    joined = b.join(c, (b.feature == c.feature) & b.category.eqNullSafe(c.category), "full_outer")
    return joined.select(
        F.coalesce(b.feature, c.feature).alias("feature"), F.coalesce(b.category, c.category).alias("category"),
        F.coalesce("base", F.lit(0)).alias("base"), F.coalesce("cur", F.lit(0)).alias("cur"),
    )


def _category_shares(counts: DataFrame) -> DataFrame:
    totals = counts.groupBy("feature").agg(
        F.sum(F.col("base") + F.lit(EPSILON)).alias("tb"), F.sum(F.col("cur") + F.lit(EPSILON)).alias("tc")
    )
    return counts.join(totals, "feature").select(
        "feature", "category", "tc",
        ((F.col("base") + F.lit(EPSILON)) / F.col("tb")).alias("p"),
        ((F.col("cur") + F.lit(EPSILON)) / F.col("tc")).alias("q"),
    )


def chi2_drift(counts: DataFrame, scale: str = "counts") -> DataFrame:
    """Goodness of fit of the current categories to the baseline shares, per feature.

    ``scale="proportion"`` compares shares (a statistic N times too small, hence
    almost never significant); ``"counts"`` compares counts with expected counts.
    """
    if scale not in ("counts", "proportion"):
        raise ValueError(f"unknown scale {scale!r}")
    p, q = F.col("p"), F.col("q")
    term = (q - p) * (q - p) / p * (F.col("tc") if scale == "counts" else F.lit(1.0))
    tested = _category_shares(counts).groupBy("feature").agg(
        F.sum(term).alias("stat"), (F.count(F.lit(1)) - 1).alias("dof")
    )
    with_p = tested.withColumn("p_raw", chi2_upper_tail(F.col("stat"), F.col("dof")))
    return with_p.select(
        "feature", steady_round(F.col("stat"), 4).alias("chi2_statistic"), "dof", steady_round(F.col("p_raw"), 6).alias("p_value"),
        (F.round("p_raw", 9) < CHI2_P_VALUE).alias("drift_detected"),
        F.when(F.round("p_raw", 9) < CHI2_P_VALUE, "CRITICAL").otherwise("OK").alias("status"),
    )


def category_shifts(counts: DataFrame, min_shift: float = MIN_SHIFT) -> DataFrame:
    """Categories whose share moved by more than ``min_shift``."""
    moved = F.round(F.col("q") - F.col("p"), 9)
    return _category_shares(counts).where(F.abs(moved) > min_shift).select(
        "feature", "category", F.round(moved, 4).alias("shift")
    )


def drift_rows(psi_rows: DataFrame, chi2_rows: DataFrame, kl_row: DataFrame) -> DataFrame:
    """(kind, feature, value, status) of all checks."""
    return functools.reduce(DataFrame.unionByName, [
        psi_rows.select(F.lit("numeric").alias("kind"), "feature", F.col("psi").alias("value"), "status"),
        chi2_rows.select(F.lit("categorical").alias("kind"), "feature", F.col("chi2_statistic").alias("value"), "status"),
        kl_row.select(F.lit("prediction").alias("kind"), F.lit("score").alias("feature"),
                      F.col("kl_divergence").alias("value"), "status"),
    ])


def drift_summary(rows: DataFrame, days_since_baseline: int = 0) -> DataFrame:
    """One row: overall status, critical and warning features, mean PSI.

    A prediction WARNING does not raise the overall status. After five weeks the
    status is CRITICAL regardless of the checks.
    """
    kind, status = F.col("kind"), F.col("status")
    named = lambda cond: F.array_sort(F.collect_set(F.when(cond, F.col("feature"))))
    overdue = days_since_baseline / 7 >= WEEKS_BEFORE_RETRAIN
    one = rows.agg(
        named((status == "CRITICAL") & (kind != "prediction")).alias("critical"),
        named((status == "WARNING") & (kind == "numeric")).alias("warning"),
        F.coalesce(F.max((status == "CRITICAL") & (kind == "prediction")), F.lit(False)).alias("kl_critical"),
        F.coalesce(mean_psi(F.when(kind == "numeric", F.col("value"))), F.lit(0.0)).alias("overall_psi"),
    )
    is_critical = (F.size("critical") > 0) | F.col("kl_critical") | F.lit(overdue)
    return one.select(
        F.when(is_critical, "CRITICAL").when(F.size("warning") > 0, "WARNING").otherwise("OK").alias("overall_status"),
        is_critical.alias("retraining_recommended"),
        "overall_psi",
        F.array_join("critical", ",").alias("critical_features"),
        F.array_join("warning", ",").alias("warning_features"),
    )


MONITORED = 6
MIN_VALUES = 10


def monitored_features(master: DataFrame, limit: int = MONITORED) -> list[str]:
    """The first numeric columns of the master table, of any numeric type."""
    from pyspark.sql import types as T

    return [f.name for f in master.schema.fields if isinstance(f.dataType, T.NumericType)][:limit]


def feature_drift(baseline: DataFrame, current: DataFrame, features: Sequence[str]) -> DataFrame:
    """Simple-smoothing PSI and flag of each monitored feature with at least ten current values."""
    long = to_long(current, features)
    enough = long.groupBy("feature").agg(F.count(F.lit(1)).alias("n")).where(F.col("n") >= MIN_VALUES)
    scored = psi(baseline_profile(to_long(baseline, features)), long, smoothing="simple")
    flag = F.when(F.col("psi") > PSI_CRITICAL, "CRITICAL").when(F.col("psi") > PSI_OK, "WARNING").otherwise("OK")
    return scored.join(enough, "feature", "left_semi").select("feature", "psi", flag.alias("flag"))
