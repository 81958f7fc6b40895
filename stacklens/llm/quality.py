"""Quality rules per document and verdicts per host."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from stacklens.llm.common import SPACE, join_checked, unpacked, whole, words, written

SYMBOLS = "#*$%&|<>"  # fixed value
WINDOW = 8


@dataclass(frozen=True)
class HostRules:
    """Limits of the rules whose failures are counted by host, and of a host's shrunk rate."""

    min_words: int = 20
    max_repeat_pct: int = 30
    max_symbols_per_word: float = 0.5
    max_dup_lines_pct: int = 50
    max_rate: float = 0.5
    max_prior: float = 1e6


RULES = ("short", "repeats", "symbols", "dup_lines")


def _later(column: str, by: int) -> tuple[Column, Column]:
    """The array without its last ``by`` elements, and without its first."""
    left = F.greatest(F.size(column) - by, F.lit(0))
    return F.slice(column, F.lit(1), left), F.slice(column, F.lit(by + 1), left)


def measured(docs: DataFrame, text: Column, *keep: Column) -> DataFrame:
    """``keep`` and n_words, word_chars, n_symbols, n_dup_lines, n_lines, n_repeat_words.

    Windows of eight words are compared by 64-bit hashes, built from those of one word by
    doubling (1, 2, 4, 8), so the work is linear in the text. Only texts with a repeated
    window sort theirs. All steps are array functions on the row: no shuffle.
    """
    names = [f"k{i}" for i in range(len(keep))]
    df = docs.select(*[c.alias(n) for c, n in zip(keep, names)], whole(text).alias("t"))
    df = df.select("*", words(F.col("t")).alias("w"),
                   F.filter(F.split("t", "\n"), lambda x: x.rlike(rf"[^{SPACE[1:-1]}]")).alias("lines"))
    df = df.select(
        *names, F.size("w").cast("long").alias("n_words"), F.length(F.array_join("w", "")).cast("long").alias("word_chars"),
        (F.length("t") - F.length(F.regexp_replace("t", f"[{SYMBOLS}]", ""))).cast("long").alias("n_symbols"),
        (F.size("lines") - F.size(F.array_distinct("lines"))).cast("long").alias("n_dup_lines"),
        F.size("lines").cast("long").alias("n_lines"), F.transform("w", lambda x: F.xxhash64(x)).alias("h"),
    )
    rest = [c for c in df.columns if c != "h"]
    for by in (1, 2, 4):
        a, b = _later("h", by)
        df = df.select(*rest, F.zip_with(a, b, lambda x, y: F.xxhash64(x, y)).alias("h"))
    pair = "array<struct<h:bigint,i:int>>"
    at = F.transform("h", lambda x, i: F.struct(x.alias("h"), i.alias("i")))
    df = df.select(*rest, F.when(F.size(F.array_distinct("h")) < F.size("h"), F.sort_array(at))
                   .otherwise(F.array().cast(pair)).alias("s"))
    a, b = _later("s", 1)
    df = df.select("*", F.zip_with(a, b, lambda x, y: x["h"] == y["h"]).alias("eq"))
    no = F.array(F.lit(False))
    df = df.select(*rest, "s", F.zip_with(F.concat(no, "eq"), F.concat("eq", no), lambda x, y: x | y).alias("twice"))
    at = F.zip_with("s", "twice", lambda x, f: F.when(f, x["i"]))
    df = df.select(*rest, F.sort_array(F.filter(at, lambda x: x.isNotNull())).alias("p"))
    a, b = _later("p", 1)
    steps = F.aggregate(F.zip_with(a, b, lambda x, y: F.least(y - x, F.lit(WINDOW))), F.lit(0), lambda s, x: s + x)
    df = df.select(*rest, F.when(F.size("p") == 0, 0).otherwise(steps + WINDOW).cast("long").alias("n_repeat_words"))
    return df


def _flags(rules: HostRules) -> dict[str, Column]:
    return {
        "short": F.col("n_words") < rules.min_words,
        "repeats": 100 * F.col("n_repeat_words") > rules.max_repeat_pct * F.col("n_words"),
        "symbols": F.col("n_symbols") > rules.max_symbols_per_word * F.col("n_words"),
        "dup_lines": 100 * F.col("n_dup_lines") > rules.max_dup_lines_pct * F.col("n_lines"),
    }


def host_verdicts(scored: DataFrame, rules: HostRules = HostRules()) -> DataFrame:
    """host, n_docs, rate_<rule> (shrunk), host_kept; one row per host, null a host of its own.

    The prior of each rule is a beta distribution fitted to the hosts' own rates by its
    moments, so a host with few documents stays near the mean and one with many keeps its
    rate. A host goes when more than ``max_rate`` of its documents break one rule.
    """
    flags = _flags(rules)
    hosts = written(scored.groupBy("host").agg(
        F.count(F.lit(1)).alias("n"), *[F.count_if(c).alias(r) for r, c in flags.items()]), "hosts")
    moments = hosts.agg(
        *[(F.sum(r) / F.sum("n")).alias(f"m_{r}") for r in RULES],
        *[F.var_pop(F.col(r) / F.col("n")).alias(f"v_{r}") for r in RULES])
    fitted = moments.first()
    df = hosts
    for r in RULES:
        mean, var = fitted[f"m_{r}"] or 0.0, fitted[f"v_{r}"] or 0.0
        spread = mean * (1 - mean)
        strength = rules.max_prior if var <= spread / (rules.max_prior + 1) else max(spread / var - 1, 1.0)
        df = df.withColumn(f"rate_{r}", (F.col(r) + F.lit(mean * strength)) / (F.col("n") + F.lit(strength)))
    bad = F.greatest(*[F.col(f"rate_{r}") for r in RULES]) > rules.max_rate
    return df.select("host", F.col("n").alias("n_docs"), *[f"rate_{r}" for r in RULES], (~bad).alias("host_kept"))


def _judged(scored: DataFrame, rules: HostRules) -> DataFrame:
    flags = _flags(rules)
    hosts = host_verdicts(scored, rules).select(F.col("host").alias("vh"), "host_kept")
    base = flags["short"] | flags["repeats"]
    joined = join_checked(scored, hosts, F.col("host").eqNullSafe(F.col("vh")))
    return joined.withColumn("base_failed", base).withColumn("kept", ~F.col("base_failed") & F.col("host_kept"))


def quality_rules(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", host_col: str = "source",
                  rules: HostRules = HostRules()) -> DataFrame:
    """One row per document: id, the five counts, base_failed, host_kept, kept.

    A null text has no words and fails; a null host is a host of its own. Repeated rows are
    judged alike. An empty table gives no rows; other columns are ignored.
    """
    df = measured(docs, F.col(text_col), F.col(id_col), F.col(host_col)).withColumnsRenamed({"k0": "id", "k1": "host"})
    out = _judged(written(df, "quality"), rules)
    return out.select(F.col("id").alias(id_col), "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words",
                      "base_failed", "host_kept", "kept")


def keep_quality(docs: DataFrame, text_col: str = "text", host_col: str = "source",
                 rules: HostRules = HostRules()) -> DataFrame:
    """The kept rows with all their columns; rows are scored once and written with their scores."""
    row = F.struct(*[F.col(f"`{c}`") for c in docs.columns])
    df = measured(docs, F.col(text_col), row, F.col(host_col)).withColumnsRenamed({"k0": "row", "k1": "host"})
    return unpacked(_judged(written(df, "quality"), rules).where("kept"))
