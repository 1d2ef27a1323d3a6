"""The named queries of this subpackage and their SQL."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from . import (
    binary,
    classifier,
    decontam,
    dialogs,
    mixing,
    pagediff,
    pieces,
    quality,
    secrets,
    simhash,
    sql,
    suffixdedup,
    tokencount,
    vectorcodes,
)
from .common import read


def op1_secret_scan(spark: SparkSession, folder: str) -> DataFrame:
    return secrets.secret_spans(read(spark, folder, "documents"))


def op2_pareto_mix(spark: SparkSession, folder: str) -> DataFrame:
    return mixing.mixed_words(read(spark, folder, "documents"))


def op3_simhash_golay(spark: SparkSession, folder: str) -> DataFrame:
    return simhash.fingerprint_components(read(spark, folder, "documents"))


def op4_line_quality(spark: SparkSession, folder: str) -> DataFrame:
    return quality.apply_rules(read(spark, folder, "documents"))


def op5_token_counts(spark: SparkSession, folder: str) -> DataFrame:
    return tokencount.token_counts(read(spark, folder, "documents"))


def op6_suffix_dedup(spark: SparkSession, folder: str) -> DataFrame:
    return suffixdedup.removed_bytes(read(spark, folder, "documents"))


def op7_quality_classifier(spark: SparkSession, folder: str) -> DataFrame:
    return classifier.quality_scores(read(spark, folder, "documents"), read(spark, folder, "labels"))


def op8_token_files(spark: SparkSession, folder: str) -> DataFrame:
    return binary.token_files(read(spark, folder, "documents"))


def op9_page_differencing(spark: SparkSession, folder: str) -> DataFrame:
    return pagediff.extract(read(spark, folder, "pages"))


def op10_decontamination(spark: SparkSession, folder: str) -> DataFrame:
    return decontam.overlap_counts(read(spark, folder, "documents"), read(spark, folder, "benchmark"))


def op11_dialog_repair(spark: SparkSession, folder: str) -> DataFrame:
    return dialogs.damaged_repairs(read(spark, folder, "conversations"))


def op12_sentencepiece(spark: SparkSession, folder: str) -> DataFrame:
    return pieces.piece_digests(read(spark, folder, "documents"))


def op13_vector_codes(spark: SparkSession, folder: str) -> DataFrame:
    return vectorcodes.compress(read(spark, folder, "embeddings"))


QUERIES = (
    op1_secret_scan,
    op2_pareto_mix,
    op3_simhash_golay,
    op4_line_quality,
    op5_token_counts,
    op6_suffix_dedup,
    op7_quality_classifier,
    op8_token_files,
    op9_page_differencing,
    op10_decontamination,
    op11_dialog_repair,
    op12_sentencepiece,
    op13_vector_codes,
)


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {q.__name__: q for q in QUERIES}


def oracle_sql() -> dict[str, str]:
    return dict(sql.ORACLES)
