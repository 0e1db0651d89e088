"""The registered queries ``opN_<name>`` over the given tables, with production parameters."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from candela.llm.chat import chat_roundtrip, chat_roundtrip_sql
from candela.llm.common import table
from candela.llm.decontamination import contamination_digest, contamination_sql
from candela.llm.hard_negatives import hard_negatives, hard_negatives_sql
from candela.llm.html_extraction import html_extraction
from candela.llm.jaccard_join import jaccard_components
from candela.llm.licenses import license_scan_digest, license_scan_sql
from candela.llm.packing import best_fit_packing
from candela.llm.pii import pii_digest
from candela.llm.pu_classifier import pu_quality
from candela.llm.quality_rules import quality_rules
from candela.llm.spelling import spelling_variants
from candela.llm.suffix_dedup import suffix_dedup_digest
from candela.llm.warc import warc_roundtrip, warc_roundtrip_sql

Query = Callable[[SparkSession, str], DataFrame]


def op1_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return license_scan_digest(table(spark, sf_dir, "documents"))


def op2_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return best_fit_packing(table(spark, sf_dir, "documents"))


def op3_pu_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pu_quality(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op4_warc_members(spark: SparkSession, sf_dir: str) -> DataFrame:
    return warc_roundtrip(table(spark, sf_dir, "pages")).drop("url")


def op5_html_extraction(spark: SparkSession, sf_dir: str) -> DataFrame:
    return html_extraction(table(spark, sf_dir, "pages"))


def op6_chat_format(spark: SparkSession, sf_dir: str) -> DataFrame:
    return chat_roundtrip(table(spark, sf_dir, "conversations"))


def op7_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return suffix_dedup_digest(table(spark, sf_dir, "documents"))


def op8_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return contamination_digest(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def op9_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return jaccard_components(table(spark, sf_dir, "documents"))


def op10_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality_rules(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"), "doc_id")


def op11_personal_data(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pii_digest(table(spark, sf_dir, "documents"))


def op12_spelling_variants(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spelling_variants(table(spark, sf_dir, "documents"))


def op13_hard_negatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    return hard_negatives(table(spark, sf_dir, "embeddings"))


QUERIES: dict[str, Query] = {
    "op1_license_scan": op1_license_scan,
    "op2_best_fit_packing": op2_best_fit_packing,
    "op3_pu_quality": op3_pu_quality,
    "op4_warc_members": op4_warc_members,
    "op5_html_extraction": op5_html_extraction,
    "op6_chat_format": op6_chat_format,
    "op7_suffix_dedup": op7_suffix_dedup,
    "op8_decontamination": op8_decontamination,
    "op9_jaccard_join": op9_jaccard_join,
    "op10_quality_rules": op10_quality_rules,
    "op11_personal_data": op11_personal_data,
    "op12_spelling_variants": op12_spelling_variants,
    "op13_hard_negatives": op13_hard_negatives,
}

#: DuckDB SQL where it can express the operator.
ORACLES: dict[str, str] = {
    "op1_license_scan": license_scan_sql(),
    "op4_warc_members": warc_roundtrip_sql(),
    "op6_chat_format": chat_roundtrip_sql(),
    "op8_decontamination": contamination_sql(),
    "op13_hard_negatives": hard_negatives_sql(),
}
