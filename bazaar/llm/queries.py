"""Registered queries of the subpackage: each takes (spark, sf_dir) and reads whole tables."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from bazaar.llm import (
    compression,
    exact_dedup,
    filter_audit,
    fuzzy_lines,
    html_labeller,
    mixing,
    neighbours,
    packing,
    repeats,
    signature_trees,
    simhash,
    toxicity,
    whitening,
)
from bazaar.llm.staging import read_table


def op1_html_extraction(spark: SparkSession, sf_dir: str) -> DataFrame:
    return html_labeller.extract(read_table(spark, sf_dir, "pages"))


def op2_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.mixture(read_table(spark, sf_dir, "documents"))


def op3_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack(read_table(spark, sf_dir, "documents"))


def op4_quality_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    return neighbours.quality_scores(read_table(spark, sf_dir, "documents"), read_table(spark, sf_dir, "labels"))


def op5_simhash_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash.simhash_components(read_table(spark, sf_dir, "documents"), shingle=3, distance=3)


def op6_fuzzy_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fuzzy_lines.dedup_lines(read_table(spark, sf_dir, "documents"))


def op7_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return repeats.remove_repeats(read_table(spark, sf_dir, "documents"))


def op8_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return compression.compression_rules(read_table(spark, sf_dir, "documents"))


def op9_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact_dedup.exact_groups(read_table(spark, sf_dir, "documents"))


def op10_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    return toxicity.toxicity_scores(read_table(spark, sf_dir, "documents"), read_table(spark, sf_dir, "labels"))


def op11_embedding_whitening(spark: SparkSession, sf_dir: str) -> DataFrame:
    return whitening.whiten(read_table(spark, sf_dir, "embeddings"))


def op12_filter_audit(spark: SparkSession, sf_dir: str) -> DataFrame:
    return filter_audit.audit(read_table(spark, sf_dir, "documents"), read_table(spark, sf_dir, "labels"))


def op13_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return signature_trees.jaccard_components(read_table(spark, sf_dir, "documents"))


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    every = (
        op1_html_extraction, op2_mixing, op3_packing, op4_quality_classifier, op5_simhash_near_dedup,
        op6_fuzzy_line_dedup, op7_suffix_dedup, op8_quality_rules, op9_exact_dedup, op10_toxicity,
        op11_embedding_whitening, op12_filter_audit, op13_jaccard_join,
    )
    return {f.__name__: f for f in every}


def oracle_sql() -> dict[str, str]:
    return {
        "op2_mixing": mixing.MIX_SQL,
        "op9_exact_dedup": exact_dedup.EXACT_SQL,
        "op12_filter_audit": filter_audit.AUDIT_SQL,
    }
