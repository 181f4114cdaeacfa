"""The training-data pipeline over ``documents``."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from vaultloom.llm.common import table
from vaultloom.llm.stages import STAGES
from vaultloom.sources.scratch import scratch_folder, written

__all__ = ["ORACLE_SQL", "STAGES", "run"]

ORACLE_SQL = None
"""Language ID and packing can't be expressed in SQL; tests/llm compares brute force."""


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the whole table; each stage's result is written and read back."""
    docs, folder = table(spark, sf_dir, "documents"), scratch_folder(spark)
    for name, stage in STAGES:
        docs = written(stage(spark, docs, sf_dir), folder, name)
    return docs
