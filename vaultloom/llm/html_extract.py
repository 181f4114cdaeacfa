"""Main text of HTML pages (operator 13).

``html_blocks`` cuts a page into the leaf blocks of its element tree; a linear-chain
conditional random field (``crf``) labels them main or not by the elements, classes and
roles around them, their text and their neighbours, and Viterbi finds the best labelling
of the whole page. It is trained on ``TRAINED_PAGES`` labelled pages (``labelled_pages``),
at every run with the same result; the weights, some hundred numbers, go to the tasks.

A page's text is its main blocks, joined by one line feed. Nothing else is dropped: a
page whose blocks are all main is kept whole. Null or empty html, and pages without
text, have an empty text. Repeated rows give repeated rows; a null page_id or url stays
null. A very long page is read once and needs a few times its size in one task. Extra
columns are ignored, whatever their names; no rows give no rows.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import lru_cache

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from vaultloom.llm import crf
from vaultloom.llm.common import python_tasks, table
from vaultloom.llm.html_blocks import features, leaf_blocks
from vaultloom.llm.labelled_pages import labelled_sequences

TRAINED_PAGES = 1000
TRAINING_ROUNDS = 100


@lru_cache(maxsize=2)
def model(pages: int = TRAINED_PAGES, rounds: int = TRAINING_ROUNDS) -> crf.Model:
    return crf.trained(labelled_sequences(pages), rounds)


def main_text(page: str, trained: crf.Model) -> str:
    blocks = leaf_blocks(page)
    labels = crf.decoded(trained, features(blocks))
    return "\n".join(b.text for b, main in zip(blocks, labels, strict=True) if main)


def _extractor(trained: crf.Model):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            texts = [main_text(p.as_py(), trained) for p in b.column(2)]
            yield pa.RecordBatch.from_arrays(
                [b.column(0), b.column(1), pa.array(texts, pa.string()), pa.array(map(len, texts), pa.int64())],
                ["page_id", "url", "text", "n_chars"])

    return run


def extracted(pages: DataFrame, trained: crf.Model | None = None) -> DataFrame:
    """(page_id, url, text, n_chars) of every page."""
    python_tasks(pages.sparkSession)
    rows = pages.select(F.col("page_id").cast("long").alias("page_id"), F.col("url").cast("string").alias("url"),
                        F.coalesce(F.col("html").cast("string"), F.lit("")).alias("html"))
    return rows.mapInArrow(_extractor(trained or model()), "page_id long, url string, text string, n_chars long")


def op13_html_text(spark: SparkSession, folder: str) -> DataFrame:
    return extracted(table(spark, folder, "pages"))
