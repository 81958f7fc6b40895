"""A corpus from ``documents``: rules, exact and near copies out, sources mixed, sequences packed.

The result of a stage has to be written before the next one starts: a stage deletes the
intermediate tables of those before it. All stages take null texts as empty, keep extra columns
whatever their names (the last returns its own columns only), take null ids and repeated ids as
rows like others, and give no rows for an empty table.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from stacklens.llm import exact_dedup, mixing, packing, quality, simhash
from stacklens.llm.common import documents, tidy, written
from stacklens.session import configure


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that no rule rejects, whose host is not rejected either; empty texts go, repeated rows share a verdict."""
    tidy(docs)
    return quality.keep_quality(docs)


def exact_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of equal texts one row, that of the smallest id; of equal ids any one, a null id last. Empty texts are equal."""
    tidy(docs)
    return exact_dedup.drop_exact_duplicates(docs)


def near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of texts linked by SimHash fingerprints one row, that of the smallest id; of equal ids any one, a null id last.

    Shingles have three words, links two differing bits at most. Texts without words share the fingerprint zero.
    """
    tidy(docs)
    return simhash.drop_near_duplicates(docs, shingle=3, budget=2)


def mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents as often as the mix takes them, not at all to twice; a null source is a source, the last."""
    tidy(docs)
    return mixing.mixed(docs)


def sequences(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of documents with their bins; texts without words have none."""
    tidy(docs)
    return packing.pack(docs)


STAGES = [("quality_rules", quality_rules), ("exact_dedup", exact_copies), ("simhash_near_dedup", near_copies),
          ("mix_sources", mix), ("best_fit_packing", sequences)]

#: SQL can express neither the balanced draw nor the packing; tests compare with brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages in order; each but the last is written and read again."""
    docs = documents(configure(spark), sf_dir)
    for name, stage in STAGES[:-1]:
        docs = written(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
