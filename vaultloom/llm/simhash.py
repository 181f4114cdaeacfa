"""SimHash near-duplicates (operator 5).

A fingerprint has 64 bits: bit i is set if it is set in over half of the XXH64 values
(seed 42) of the text's shingles, repeats included. Two texts are linked where their
fingerprints differ in at most ``RADIUS`` = 2 bits.

Pigeonhole: cut in four blocks of 16 bits, two such fingerprints agree in at least two
blocks, so they meet under one of six pairs of blocks (32 bits). Buckets of at most
``PAIRED`` fingerprints are joined with themselves and verified by Hamming distance.
In a larger bucket, where pairs would grow with the square, each fingerprint is sent
to the 33 points within one bit of it among the free 32 bits: two of them are within
two bits exactly if they share a point, and a point has at most 33 visitors. Both ways
are exact; no bucket is capped.

Equal fingerprints are folded first, so copies cost nothing. Fingerprints, pairs and
components stay in Spark.

Null or empty text: no words, fingerprint zero, linked like any other. Fewer words than
a shingle has: the whole sequence is the one shingle. Rows with a null id count like
others but name no component (one of only such rows has a null component). Repeated
rows are linked with each other. Extra columns are ignored; no rows give no rows.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from vaultloom.llm.common import python_tasks, table, text_bytes
from vaultloom.llm.components import components
from vaultloom.sources.scratch import scratch_folder, written

RADIUS = 2
SHINGLE_WORDS = 3
SEED = 42
BLOCK_BITS = 16
PAIRED = 64
HASHED_AT_ONCE = 1 << 16


def fingerprint(text: bytes, shingle_words: int = SHINGLE_WORDS) -> int:
    """The 64-bit fingerprint, as an unsigned number."""
    words = text.lower().split()  # bytes: only A-Z are lowered, only ASCII blanks split
    if not words:
        return 0
    joined = b" ".join(words)
    ends = np.cumsum(np.fromiter(map(len, words), np.int64, len(words)) + 1) - 1
    starts = np.concatenate(([0], ends[:-1] + 1))
    span = min(shingle_words, len(words))
    starts, ends = starts[:len(words) - span + 1].tolist(), ends[span - 1:].tolist()
    hashed, counts = xxhash.xxh64_intdigest, np.zeros(64, np.int64)
    for at in range(0, len(starts), HASHED_AT_ONCE):
        part = slice(at, at + HASHED_AT_ONCE)
        h = np.array([hashed(joined[a:b], SEED) for a, b in zip(starts[part], ends[part], strict=True)],
                     np.uint64)
        bits = np.unpackbits(h.astype("<u8").view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
        counts += bits.sum(axis=0, dtype=np.int64)
    return int.from_bytes(np.packbits(2 * counts > len(starts), bitorder="little").tobytes(), "little")


def _fingerprints(shingle_words: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            *kept, texts = b.columns
            found = np.array([fingerprint(t.as_py(), shingle_words) for t in texts], np.uint64)
            yield pa.RecordBatch.from_arrays(
                [*kept, pa.array(found.view(np.int64))], [*b.schema.names[:-1], "fp"])

    return run


def fingerprints(docs: DataFrame, *keep, shingle_words: int = SHINGLE_WORDS) -> DataFrame:
    """Columns ``keep`` and fp, the fingerprint as a signed long."""
    python_tasks(docs.sparkSession)
    rows = docs.select(*keep, text_bytes().alias("_text"))
    kept = [f"`{f.name}` {f.dataType.simpleString()}" for f in rows.schema[:-1]]
    return rows.mapInArrow(_fingerprints(shingle_words), ", ".join([*kept, "fp long"]))


def _signed(mask: int) -> str:
    """A 64-bit mask as SQL for a signed long."""
    if mask == 1 << 63:
        return "(-9223372036854775807L - 1L)"
    return f"{mask - (1 << 64) if mask >> 63 else mask}L"


def close_links(fps: DataFrame) -> DataFrame:
    """Links (a, b) whose transitive closure joins all distinct ``fp`` within RADIUS bits.

    Every link is verified. From small buckets come all pairs; from large ones, a link
    of each visitor of a point to the point's least visitor.
    """
    folder, blocks = scratch_folder(fps.sparkSession), 64 // BLOCK_BITS
    keys, flips = [], []
    for n, kept in enumerate(combinations(range(blocks), blocks - RADIUS)):
        mask = sum(((1 << BLOCK_BITS) - 1) << (BLOCK_BITS * k) for k in kept)
        keys.append(f"struct({n} AS part, fp & {_signed(mask)} AS block)")
        free = ", ".join(_signed(1 << i) for i in range(64) if not mask >> i & 1)
        flips.append(f"array({free})")
    blocked = fps.select("fp", F.explode(F.expr(f"array({', '.join(keys)})")).alias("k")).select(
        "fp", "k.part", "k.block")
    points_near = (f"concat(array(fp), transform(element_at(array({', '.join(flips)}), part + 1),"
                   " f -> fp ^ f))")
    sizes = written(blocked.groupBy("part", "block").agg(
        F.count(F.lit(1)).alias("members")).filter("members > 1"), folder, "sizes")
    met = written(blocked.join(sizes, ["part", "block"]), folder, "met")
    few = met.filter(F.col("members") <= PAIRED)
    pairs = (
        few.select("part", "block", F.col("fp").alias("a"))
        .join(few.select("part", "block", F.col("fp").alias("b")), ["part", "block"])
        .filter("a < b").filter(f"bit_count(a ^ b) <= {RADIUS}").select("a", "b"))
    points = (
        met.filter(F.col("members") > PAIRED)
        .select("part", "fp", F.explode(F.expr(points_near)).alias("point"))
        .groupBy("part", "point").agg(F.collect_set("fp").alias("visitors")).filter("size(visitors) > 1")
        .select(F.array_min("visitors").alias("a"), F.explode("visitors").alias("b")).filter("a <> b"))
    return pairs.unionByName(points).distinct()


def _rooted(fps: DataFrame) -> DataFrame:
    """(fp, root) for distinct fingerprints ``fp``."""
    roots = components(close_links(fps)).withColumnRenamed("node", "fp")
    return fps.join(roots, "fp", "left").select("fp", F.coalesce("root", "fp").alias("root"))


def near_duplicates(docs: DataFrame, shingle_words: int = SHINGLE_WORDS) -> DataFrame:
    """(doc_id, fp, component_id) for every row of ``docs``."""
    folder = scratch_folder(docs.sparkSession)
    doc_id = F.col("doc_id").cast("long").alias("doc_id")
    found = written(fingerprints(docs, doc_id, shingle_words=shingle_words), folder, "fingerprints")
    distinct = written(
        found.groupBy("fp").agg(F.min("doc_id").alias("first_id")), folder, "distinct")
    rooted = written(_rooted(distinct.select("fp")).join(distinct, "fp"), folder, "rooted")
    firsts = written(rooted.groupBy("root").agg(F.min("first_id").alias("component_id")), folder, "firsts")
    names = rooted.join(firsts, "root").select("fp", "component_id")
    return found.join(names, "fp").select("doc_id", "fp", "component_id")


def kept_rows(rows: DataFrame, shingle_words: int = SHINGLE_WORDS) -> DataFrame:
    """The row of each component with the least doc_id, nulls last, then the least row.

    ``rows`` has a unique ``row`` beside ``doc_id`` and ``text``; all columns are returned.
    """
    folder = scratch_folder(rows.sparkSession)
    found = written(
        fingerprints(rows, "row", "doc_id", shingle_words=shingle_words), folder, "fingerprints")
    place = F.struct(F.col("doc_id").isNull().alias("last"), F.col("doc_id"), F.col("row"))
    distinct = written(found.groupBy("fp").agg(F.min(place).alias("place")), folder, "distinct")
    rooted = written(_rooted(distinct.select("fp")).join(distinct, "fp"), folder, "rooted")
    kept = rooted.groupBy("root").agg(F.min("place").alias("place")).select(F.col("place.row").alias("row"))
    return rows.join(written(kept, folder, "kept"), "row", "left_semi")


def op5_simhash(spark: SparkSession, folder: str) -> DataFrame:
    return near_duplicates(table(spark, folder, "documents")).select(
        "doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")
