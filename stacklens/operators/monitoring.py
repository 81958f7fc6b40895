"""Health, diversity and overall status."""

from __future__ import annotations

import functools

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Monitoring limits.
STALE_HOURS = 26
MIN_DIVERSITY = 0.30
PSI_WARNING, PSI_CRITICAL = 0.10, 0.20
HEALTH_WARNING, HEALTH_CRITICAL = 0.9, 0.7


def table_health(tables: dict[str, tuple[DataFrame, str]], as_of: Column, max_age_hours: float = STALE_HOURS) -> DataFrame:
    """Rows (table, check, passed) for: has rows, newest timestamp younger than the limit."""
    def checks(name: str, df: DataFrame, ts: str) -> DataFrame:
        stats = df.agg(F.count(F.lit(1)).alias("n"), F.max(F.col(ts).cast("timestamp")).alias("newest"))
        age_hours = (F.unix_micros(as_of) - F.unix_micros("newest")) / F.lit(3.6e9)
        fresh = F.coalesce(age_hours < max_age_hours, F.lit(False))
        return stats.select(F.lit(name).alias("table"), F.inline(F.array(
            F.struct(F.lit("has_rows").alias("check"), (F.col("n") > 0).alias("passed")),
            F.struct(F.lit("fresh").alias("check"), fresh.alias("passed")),
        )))

    return functools.reduce(DataFrame.unionByName, [checks(n, df, ts) for n, (df, ts) in tables.items()])


def health_score(checks: DataFrame) -> DataFrame:
    return checks.agg(
        F.count_if("passed").alias("passed"), F.count(F.lit(1)).alias("total"),
        F.round(F.count_if("passed") / F.count(F.lit(1)), 4).alias("health_score"),
    )


def diversity(recommendations: DataFrame, *by: str) -> DataFrame:
    """1 - share of the most frequent genre, per ``by`` group; fine from 0.30 on."""
    counts = recommendations.where("genre IS NOT NULL").groupBy(*by, "genre").agg(F.count(F.lit(1)).alias("n"))
    top = counts.groupBy(*by).agg(
        F.min(F.struct((-F.col("n")).alias("neg"), "genre"))["genre"].alias("top_genre"),
        F.max("n").alias("most"), F.sum("n").alias("total"),
    )
    ratio = F.col("most") / F.col("total")
    return top.select(
        *by, F.col("total").alias("n_recommendations"), "top_genre",
        F.round(ratio, 6).alias("top_genre_ratio"),
        F.round(1 - ratio, 6).alias("diversity_score"),
        (F.round(1 - ratio, 9) >= MIN_DIVERSITY).alias("diversity_ok"),
    )


def system_status(psi: Column, health: Column, diversity_score: Column, one_row: DataFrame) -> DataFrame:
    """Roll three scores up to a status. A missing score counts as fine, a score of 0 does not."""
    values = one_row.select(
        F.coalesce(psi, F.lit(0.0)).alias("overall_psi"),
        F.coalesce(health, F.lit(1.0)).alias("health_score"),
        F.coalesce(diversity_score, F.lit(1.0)).alias("diversity_score"),
    )
    p, h, d = F.col("overall_psi"), F.col("health_score"), F.col("diversity_score")
    critical = (p > PSI_CRITICAL) | (h < HEALTH_CRITICAL) | (d < MIN_DIVERSITY)
    warning = (p > PSI_WARNING) | (h < HEALTH_WARNING)
    return values.select(
        "*", F.when(critical, "CRITICAL").when(warning, "WARNING").otherwise("HEALTHY").alias("system_status"),
        (p > PSI_CRITICAL).alias("retraining_recommended"),
    )
