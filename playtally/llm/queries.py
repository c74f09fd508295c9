"""The operators' registered queries and their SQL."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from playtally.llm import op01_quality_gam as op01
from playtally.llm import op02_quality_rules as op02
from playtally.llm import op03_jaccard_join as op03
from playtally.llm import op04_decontamination as op04
from playtally.llm import op05_warc as op05
from playtally.llm import op06_html_extraction as op06
from playtally.llm import op07_token_output as op07
from playtally.llm import op08_mixing as op08
from playtally.llm import op09_license_scan as op09
from playtally.llm import op10_line_dedup as op10
from playtally.llm import op11_suffix_dedup as op11
from playtally.llm import op12_token_alignment as op12
from playtally.llm import op13_embedding_whitening as op13
from playtally.llm.common import read_table


def op1_quality_gam(spark: SparkSession, sf_dir: str) -> DataFrame:
    return op01.classify(read_table(spark, sf_dir, "documents"), read_table(spark, sf_dir, "labels"))


def op2_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return op02.apply_policy(op02.ledger(read_table(spark, sf_dir, "documents")))


def op3_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return op03.similar_documents(read_table(spark, sf_dir, "documents")).select(
        "doc_id", "n_shingles", "component_id", "n_links")


def op4_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = op04.contamination(read_table(spark, sf_dir, "documents"), read_table(spark, sf_dir, "benchmark"))
    return found.select("doc_id", "n_words", "n_hit", "n_items", "items_sha256", "contaminated")


def op5_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    return op05.archive_round_trip(read_table(spark, sf_dir, "pages"))


def op6_html_extraction(spark: SparkSession, sf_dir: str) -> DataFrame:
    return op06.extract_pages(read_table(spark, sf_dir, "pages"))


def op7_token_output(spark: SparkSession, sf_dir: str) -> DataFrame:
    return op07.token_output(read_table(spark, sf_dir, "documents"))


def op8_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return op08.taken_words(op08.plan_mix(read_table(spark, sf_dir, "documents")))


def op9_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return op09.scan_licenses(read_table(spark, sf_dir, "documents"))


def op10_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return op10.clean_documents(read_table(spark, sf_dir, "documents"))


def op11_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return op11.digests(op11.remove_repeats(read_table(spark, sf_dir, "documents")))


def op12_token_alignment(spark: SparkSession, sf_dir: str) -> DataFrame:
    return op12.align(read_table(spark, sf_dir, "documents")).drop("groups")


def op13_embedding_whitening(spark: SparkSession, sf_dir: str) -> DataFrame:
    return op13.component_rows(op13.whiten(read_table(spark, sf_dir, "embeddings")))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_quality_gam": op1_quality_gam,
    "op2_quality_rules": op2_quality_rules,
    "op3_jaccard_join": op3_jaccard_join,
    "op4_decontamination": op4_decontamination,
    "op5_warc": op5_warc,
    "op6_html_extraction": op6_html_extraction,
    "op7_token_output": op7_token_output,
    "op8_mixing": op8_mixing,
    "op9_license_scan": op9_license_scan,
    "op10_line_dedup": op10_line_dedup,
    "op11_suffix_dedup": op11_suffix_dedup,
    "op12_token_alignment": op12_token_alignment,
    "op13_embedding_whitening": op13_embedding_whitening,
}
ORACLES: dict[str, str] = {
    "op2_quality_rules": op02.ORACLE,
    "op4_decontamination": op04.ORACLE,
    "op5_warc": op05.ORACLE,
    "op10_line_dedup": op10.ORACLE,
}
