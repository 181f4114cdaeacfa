"""The stages of the pipeline: each takes (spark, docs, folder) and returns a DataFrame.

All but the last return the columns of ``docs``. Each stage keeps what its operator's
docstring says for nulls, empty texts, repeated rows and extra columns.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from vaultloom.llm import decontaminate, langid, line_dedup, packing, simhash
from vaultloom.llm.common import stored_rows, table


LEAST_SCORE = 0.5


def language_id(spark: SparkSession, docs: DataFrame, folder: str) -> DataFrame:
    """Drops documents without text or without a letter, and those in no one language: where
    the likeliest has less than ``LEAST_SCORE`` of the probability. A table from which no
    language can be learned keeps its rows."""
    decided = (F.col("lang_pred") == langid.UNKNOWN) | (F.col("score") >= LEAST_SCORE)
    found = langid.predicted(docs, keep_rows=True).filter(langid.has_letter(F.col("d")["text"])).filter(decided)
    return found.select(*[F.col("d")[c].alias(c) for c in docs.columns])


def line_deduplication(spark: SparkSession, docs: DataFrame, folder: str) -> DataFrame:
    """Cuts later occurrences of repeated three-line windows from the texts."""
    return line_dedup.deduplicated(docs)


def near_duplicates(spark: SparkSession, docs: DataFrame, folder: str) -> DataFrame:
    """Keeps one row of each component of op5's SimHash links (three-word shingles, 2 bits):
    the one with the least (doc_id, row), null ids last. Texts without words form one
    component, as equal fingerprints do."""
    return simhash.kept_rows(stored_rows(docs)).select(*[
        (F.col("text") if c == "text" else F.col("d")[c]).alias(c) for c in docs.columns])


def decontamination(spark: SparkSession, docs: DataFrame, folder: str) -> DataFrame:
    """Drops documents that hold a benchmark item."""
    return decontaminate.clean_documents(docs, table(spark, folder, "benchmark"))


def best_fit_packing(spark: SparkSession, docs: DataFrame, folder: str) -> DataFrame:
    """The bin and offset of each piece of each document."""
    return packing.best_fit(docs)


STAGES = [
    ("language_id", language_id),
    ("line_dedup", line_deduplication),
    ("near_duplicates", near_duplicates),
    ("decontamination", decontamination),
    ("packing", best_fit_packing),
]
