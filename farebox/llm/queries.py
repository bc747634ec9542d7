"""The operators over their whole tables, with production parameters."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from farebox.llm import centroids, credentials, ctw, decontaminate, jaccard, language, lines, packing, pii, quality, repeats, rules, whitening
from farebox.llm.common import documents


def op1_quality_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.scored(documents(spark, sf_dir), spark.read.parquet(f"{sf_dir}/labels.parquet"))


def op2_context_tree(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ctw.scored(documents(spark, sf_dir))


def op3_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rules.judged(documents(spark, sf_dir))


def op4_near_copies(spark: SparkSession, sf_dir: str) -> DataFrame:
    return jaccard.joined(documents(spark, sf_dir)).select("doc_id", "class_id", "n_links")


def op5_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lines.report(documents(spark, sf_dir))


def op6_secrets(spark: SparkSession, sf_dir: str) -> DataFrame:
    return credentials.report(documents(spark, sf_dir))


def op7_repeated_strings(spark: SparkSession, sf_dir: str) -> DataFrame:
    return repeats.digest(repeats.without_repeats(documents(spark, sf_dir)))


def op8_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontaminate.judged(documents(spark, sf_dir), spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def op9_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.digest(packing.pack(documents(spark, sf_dir)))


def op10_personal_data(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pii.report(documents(spark, sf_dir))


def op11_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    return language.identified(documents(spark, sf_dir))


def embeddings(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/embeddings.parquet")


def op12_whitening(spark: SparkSession, sf_dir: str) -> DataFrame:
    return whitening.whitened(embeddings(spark, sf_dir))


def op13_centroids(spark: SparkSession, sf_dir: str) -> DataFrame:
    return centroids.clustered(embeddings(spark, sf_dir))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_quality_classifier": op1_quality_classifier,
    "op2_context_tree": op2_context_tree,
    "op3_quality_rules": op3_quality_rules,
    "op4_near_copies": op4_near_copies,
    "op5_line_dedup": op5_line_dedup,
    "op6_secrets": op6_secrets,
    "op7_repeated_strings": op7_repeated_strings,
    "op8_decontamination": op8_decontamination,
    "op9_packing": op9_packing,
    "op10_personal_data": op10_personal_data,
    "op11_language": op11_language,
    "op12_whitening": op12_whitening,
    "op13_centroids": op13_centroids,
}
