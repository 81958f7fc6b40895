"""The registered queries of this package: one per operator, over its whole table, and the pipeline."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from stacklens.llm import (
    chunked_bpe, exact_dedup, fill_middle, html_text, mixing, packing, quality, secret_scan, simhash, suffix_dedup, token_output,
    tokenizer_alignment, toxicity,
)
from stacklens.llm.common import documents, scratch_path, table

Query = Callable[[SparkSession, str], DataFrame]


def op1_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return suffix_dedup.passage_digests(documents(spark, sf_dir))


def op2_token_output(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers

    docs = documents(spark, sf_dir)
    files = token_output.token_files(docs, public_tokenizers.path("word_bpe_49k.json"), scratch_path(spark, "ids"))
    return token_output.digests(files)


def op9_html_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    return html_text.extract_text(table(spark, sf_dir, "pages"))


def op10_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return secret_scan.digests(secret_scan.secret_spans(documents(spark, sf_dir)))


def op3_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact_dedup.exact_duplicates(documents(spark, sf_dir))


def op4_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.quality_rules(documents(spark, sf_dir))


def op5_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = documents(spark, sf_dir)
    return toxicity.fit(docs, table(spark, sf_dir, "labels")).score(docs)


def op6_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack(documents(spark, sf_dir))


def op7_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash.simhash_components(documents(spark, sf_dir))


def op8_mix_sources(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.mix_sources(documents(spark, sf_dir))


def op11_tokenizer_alignment(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers

    return tokenizer_alignment.alignment(
        documents(spark, sf_dir), public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.path("piece_bpe_32k.model"))


def op12_fill_in_middle(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fill_middle.digests(fill_middle.fill_in_middle(documents(spark, sf_dir)))


def op13_bpe_chunks(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers

    path = public_tokenizers.path("word_bpe_49k.json")
    return chunked_bpe.digests(chunked_bpe.decode(chunked_bpe.encode(documents(spark, sf_dir), path), path))


def pipeline(spark: SparkSession, sf_dir: str) -> DataFrame:
    import corpus_pipeline

    return corpus_pipeline.run(spark, sf_dir)


QUERIES: dict[str, Query] = {f.__name__: f for f in (
    op1_suffix_dedup, op2_token_output, op3_exact_dedup, op4_quality_rules, op5_toxicity, op6_best_fit_packing, op7_simhash, op8_mix_sources,
    op9_html_text, op10_secret_scan, op11_tokenizer_alignment, op12_fill_in_middle, op13_bpe_chunks, pipeline)}
