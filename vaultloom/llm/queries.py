"""The operators' queries and, where SQL can express them, their DuckDB SQL."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from vaultloom.llm import (
    classlm, decontaminate, fill_middle, html_extract, langid, line_dedup, packing, recompression,
    simhash, spelling, suffix_dedup, vector_dedup, warc)

Query = Callable[[SparkSession, str], DataFrame]


def llm_queries() -> dict[str, Query]:
    found = [
        suffix_dedup.op1_suffix_dedup, recompression.op2_recompression, warc.op3_warc,
        line_dedup.op4_line_dedup, simhash.op5_simhash, langid.op6_langid, packing.op7_packing,
        vector_dedup.op8_vector_dedup, classlm.op9_classlm, decontaminate.op10_decontaminate,
        fill_middle.op11_fill_middle, spelling.op12_spelling, html_extract.op13_html_text]
    return {f.__name__: f for f in found}


def llm_oracles() -> dict[str, str]:
    return {**warc.ORACLE, **line_dedup.ORACLE, **decontaminate.ORACLE, **fill_middle.ORACLE,
            **spelling.ORACLE}
