"""Corpus pipeline: five operators of ``playtally.llm`` applied to ``documents`` in turn.

Each stage takes (spark, docs, sf_dir) and returns a DataFrame that is written as
Parquet and read again as the next one's docs. All stages but the last return
the columns of ``documents``:

1. quality rules: rows that the standard policy rejects go;
2. n-gram Jaccard join: of documents linked by 85 % similarity, directly or
   through others, the one with the smallest doc_id stays;
3. benchmark decontamination: rows that hold a benchmark window go;
4. mixing: rows are left out or repeated to the sources' target weights;
5. token output: ids are written in the binary format; the rows read back from
   the files (doc_id, start, n_tokens, ids_crc32) are the result.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from playtally.llm import op02_quality_rules as op02
from playtally.llm import op03_jaccard_join as op03
from playtally.llm import op04_decontamination as op04
from playtally.llm import op07_token_output as op07
from playtally.llm import op08_mixing as op08
from playtally.llm.common import read_table
from playtally.session import materialize


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return op02.keep_documents(docs)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return op03.keep_one_per_component(docs)


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return op04.remove_contaminated(docs, read_table(spark, sf_dir, "benchmark"))


def mixing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return op08.mix_documents(docs)


def token_output(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return op07.token_output(docs)


STAGES: list[tuple[str, Callable[[SparkSession, DataFrame, str], DataFrame]]] = [
    ("quality_rules", quality_rules),
    ("jaccard_join", near_duplicates),
    ("decontamination", decontamination),
    ("mixing", mixing),
    ("token_output", token_output),
]

# Similarity, hash draws and tokens are beyond SQL: tests hold the stages against brute force.
ORACLE_SQL: str | None = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read_table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = materialize(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return docs
