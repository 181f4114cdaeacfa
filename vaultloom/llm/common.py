"""What several operators share."""

from __future__ import annotations

import os
import uuid
from collections.abc import Iterator
from pathlib import Path

import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from vaultloom.sources.scratch import scratch_folder

ARROW_ROWS = 256
"""Rows of a batch that Spark hands to Python: whole texts, so only a few."""

WORD_BREAK = "[\\x20\\x09-\\x0D]+"


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def python_tasks(spark: SparkSession) -> None:
    """Before Python functions are sent to tasks: bound the memory of a worker that reads
    whole texts, and let workers import this package from where the driver has it."""
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(ARROW_ROWS))
    root = str(Path(__file__).resolve().parents[2])
    paths = spark.sparkContext.environment.get("PYTHONPATH", "").split(os.pathsep)
    if root not in paths:
        spark.sparkContext.environment["PYTHONPATH"] = os.pathsep.join([root, *filter(None, paths)])


def text_bytes(text: str = "text"):
    """The text as UTF-8 bytes; a null is empty."""
    return F.coalesce(F.col(text), F.lit("")).cast("binary")


def _packed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    pack = zstandard.ZstdCompressor(level=1)
    for b in batches:
        texts = [pack.compress(t.as_py()) for t in b.column(2)]
        yield pa.RecordBatch.from_arrays([b.column(0), b.column(1), pa.array(texts, pa.binary())],
                                         ["row", "doc_id", "packed"])


def unpacked(decompressor: zstandard.ZstdDecompressor, text: bytes) -> bytes:
    return decompressor.decompress(text)


def _stored(rows: DataFrame, compression: str) -> DataFrame:
    spark, name = rows.sparkSession, f"rows_{uuid.uuid4().hex}"
    buckets = int(spark.conf.get("spark.sql.shuffle.partitions"))
    (rows.repartition(buckets, "row").write.option("compression", compression)
     .option("path", f"{scratch_folder(spark)}/rows").bucketBy(buckets, "row").saveAsTable(name))
    return spark.table(name)


def packed_texts(docs: DataFrame) -> DataFrame:
    """(row, doc_id, packed): the text as UTF-8, each compressed; stored in buckets of row.

    ``row`` is unique where ``doc_id`` is null or repeated. The table lies in the shared
    scratch folder, so its row numbers are fixed, and later joins by ``row`` move the
    other side only.
    """
    python_tasks(docs.sparkSession)
    rows = docs.select(
        F.monotonically_increasing_id().alias("row"), F.col("doc_id").cast("long").alias("doc_id"), text_bytes())
    return _stored(rows.mapInArrow(_packed, "row long, doc_id long, packed binary"), "uncompressed")


def stored_rows(docs: DataFrame) -> DataFrame:
    """(row, doc_id, text, d): rows of ``docs`` as a struct ``d`` under a fixed number.

    Stored in buckets of ``row``, like ``packed_texts``, which says why.
    """
    others = [F.col(c) if c != "text" else F.lit(None).cast("string").alias(c) for c in docs.columns]
    return _stored(docs.select(
        F.monotonically_increasing_id().alias("row"), F.col("doc_id").cast("long").alias("doc_id"),
        F.col("text").cast("string").alias("text"), F.struct(*others).alias("d")), "zstd")
