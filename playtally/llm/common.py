"""Helpers shared by the operators: table readers and word expressions."""

from __future__ import annotations

import os

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

# Fixed value: the six white-space characters that separate words.
WORD_BREAK = r"[\x20\x09-\x0D]+"


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def words(text: Column) -> Column:
    """Words of a text: maximal runs free of the six ASCII white-space characters.

    Null and empty texts have no words.
    """
    return F.array_remove(F.split(F.coalesce(text, F.lit("")), WORD_BREAK), "")


def shuffle_width(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


def share_package(spark: SparkSession) -> None:
    """Let Python workers import this package from where the driver did.

    Enough for local runs and for clusters whose nodes share or hold the code; elsewhere submit
    the package with ``--py-files``.
    """
    root = os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
    env = spark.sparkContext.environment
    known = [p for p in env.get("PYTHONPATH", "").split(os.pathsep) if p]
    if root not in known:
        env["PYTHONPATH"] = os.pathsep.join([root, *known])
