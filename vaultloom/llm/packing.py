"""Best-fit packing into sequences of several permitted lengths (operator 7).

Documents are measured in words; one longer than the largest permitted length is cut
into pieces of that length. Pieces are dealt by hash into shards of about
``SHARD_PIECES``; a shard is packed by one task, whose memory that bounds:

- pieces are taken in falling length (ties by row and piece);
- a piece goes into the open bin that it leaves the least room in (ties: the oldest);
- if none has room, a bin is opened. For each permitted length that holds the piece,
  the largest remaining pieces that still fit are reckoned in, and the length with the
  least cost per word, (length + OVERHEAD) / words, is opened (ties: the longer);
- at the end every bin is cut down to the least permitted length that holds it.

A document without words (null, empty, blanks) has one row without a bin. Repeated rows
and null ids are packed like others. Extra columns are ignored; no rows give no rows.
"""

from __future__ import annotations

from bisect import bisect_left, bisect_right, insort

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from vaultloom.llm.common import WORD_BREAK, python_tasks, stored_rows, table
from vaultloom.sources.scratch import scratch_folder, written

LENGTHS = (512, 1024, 2048, 4096)
OVERHEAD = 16
SHARD_PIECES = 100_000
WORD = "[^\\x20\\x09-\\x0D]+"


def _reckoned(room: int, rest: list[int]) -> int:
    """Words that the largest of the sorted ``rest`` fill of ``room``, taken greedily."""
    filled, end = 0, len(rest)
    while end and filled < room:
        end = min(end, bisect_right(rest, room - filled))
        if not end:
            break
        end -= 1
        filled += rest[end]
    return filled


def packed(lengths: list[int], permitted: tuple[int, ...] = LENGTHS, overhead: int = OVERHEAD):
    """(bin, offset) of each piece, in the given order, which is falling; then the bins' lengths."""
    permitted = sorted(permitted)
    rest = sorted(lengths)
    rooms: list[tuple[int, int]] = []  # (room, bin), sorted
    places, opened, filled = [], [], []
    for size in lengths:
        del rest[bisect_left(rest, size)]
        at = bisect_left(rooms, (size, -1))
        if at < len(rooms):
            room, number = rooms.pop(at)
        else:
            costs = [((c + overhead) / (size + _reckoned(c - size, rest)), -c) for c in permitted if c >= size]
            room = -min(costs)[1]
            number = len(opened)
            opened.append(room)
            filled.append(0)
        places.append((number, filled[number]))
        filled[number] += size
        if room > size:
            insort(rooms, (room - size, number))
    return places, [permitted[bisect_left(permitted, n)] for n in filled]


def _packer(permitted: tuple[int, ...], overhead: int):
    def run(shard: pd.DataFrame) -> pd.DataFrame:
        shard = shard.sort_values(["piece_words", "row", "piece"], ascending=[False, True, True])
        places, sizes = packed(shard["piece_words"].tolist(), permitted, overhead)
        first = int(shard["shard"].iloc[0]) << 32
        return shard[["row", "doc_id", "piece", "piece_words"]].assign(
            bin_id=[first + b for b, _ in places], bin_length=[sizes[b] for b, _ in places],
            bin_offset=[at for _, at in places]).astype({"doc_id": "Int64"})

    return run


def assigned(rows: DataFrame, permitted: tuple[int, ...] = LENGTHS, overhead: int = OVERHEAD) -> DataFrame:
    """(row, doc_id, piece, piece_words, bin_id, bin_length, bin_offset) for rows with
    ``row``, ``doc_id`` and ``text``; piece k begins at word k times the largest length."""
    most = max(permitted)
    python_tasks(rows.sparkSession)
    pieces = rows.select(
        "row", "doc_id", F.coalesce(F.regexp_count(F.col("text").cast("string"), F.lit(WORD)), F.lit(0)).alias("n"))
    pieces = written(pieces, scratch_folder(rows.sparkSession), "lengths")
    cut = pieces.filter("n > 0").select("row", "doc_id", "n", F.explode(
        F.sequence(F.lit(0), F.floor((F.col("n") - 1) / most).cast("int"))).alias("piece")).select(
        "row", "doc_id", "piece", F.least(F.lit(most), F.col("n") - F.col("piece") * most).alias("piece_words"))
    total = cut.agg(F.count(F.lit(1))).first()[0]
    shards = max(1, -(-total // SHARD_PIECES))
    dealt = cut.withColumn("shard", F.pmod(F.xxhash64("row", "piece"), F.lit(shards)))
    binned = dealt.groupBy("shard").applyInPandas(
        _packer(tuple(permitted), overhead),
        "row long, doc_id long, piece int, piece_words int, bin_id long, bin_length int, bin_offset int")
    none = pieces.filter("n = 0").selectExpr(
        "row", "doc_id", "0 AS piece", "0 AS piece_words", "cast(NULL AS bigint) AS bin_id",
        "cast(NULL AS int) AS bin_length", "cast(NULL AS int) AS bin_offset")
    return binned.unionByName(none)


def _numbered(docs: DataFrame) -> DataFrame:
    return docs.select(F.monotonically_increasing_id().alias("row"), F.col("doc_id").cast("long").alias("doc_id"),
                       F.col("text").cast("string").alias("text"))


def best_fit(docs: DataFrame, permitted: tuple[int, ...] = LENGTHS, overhead: int = OVERHEAD) -> DataFrame:
    """(doc_id, piece, piece_words, bin_id, bin_length, bin_offset) for every piece."""
    return assigned(_numbered(docs), permitted, overhead).drop("row")


def sequences(docs: DataFrame, permitted: tuple[int, ...] = LENGTHS, overhead: int = OVERHEAD) -> DataFrame:
    """(bin_id, bin_length, n_words, texts): the packed sequences, pieces in order."""
    rows = stored_rows(docs)
    rows_packed = assigned(rows, permitted, overhead).filter("bin_id IS NOT NULL").drop("doc_id")
    words = rows.select("row", F.filter(F.split("text", WORD_BREAK), lambda w: w != "").alias("w"))
    return rows_packed.join(words, "row").select(
        "bin_id", "bin_length", "piece_words", "bin_offset", F.array_join(F.slice(
            "w", F.col("piece") * max(permitted) + 1, F.col("piece_words")), " ").alias("text")).groupBy(
        "bin_id", "bin_length").agg(
        F.sum("piece_words").alias("n_words"),
        F.array_sort(F.collect_list(F.struct("bin_offset", "text"))).alias("t")).select(
        "bin_id", "bin_length", "n_words", F.col("t.text").alias("texts"))


def op7_packing(spark: SparkSession, folder: str) -> DataFrame:
    return best_fit(table(spark, folder, "documents"))
