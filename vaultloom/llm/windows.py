"""All windows of T units that occur at least twice, found through anchors.

A unit is a byte (operator 1) or a word (operator 2). An operator names, for every
window, an *anchor*: a place in the window that depends on the window's units alone, with
a key made of units inside the window. Equal windows therefore meet under equal keys, at
equal offsets from their anchors. Neighbouring windows share anchors, so there are far
fewer anchors than windows. Then, digit by digit, groups are refined, most significant
first, and what is alone in its group is left out of the next pass:

1. the anchor's key. Where all anchors of a key have equal surroundings (all their
   windows, ``full``), every window of theirs is repeated and they are done. The same
   holds for each class of anchors with equal key and surroundings.
2. For other keys one anchor of each class goes on. Its windows are taken in blocks of
   at most ``BLOCK`` offsets: the units that all windows of a block share are the digit. A block
   alone in its group is out; a group with equal blocks is done.
3. the windows of what remains, one by one: two in a group are repeats.

Digits are compared by 64-bit hashes within groups that share the digits before, so a
wrong match needs two of these to agree by chance.

A hot key is counted with partial sums in the tasks and joined back by a join that the
planner may split; its occurrences are never gathered. Copies go on as one class.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from vaultloom.llm.common import python_tasks, unpacked
from vaultloom.llm.rolling import Rolling, mixed
from vaultloom.sources.scratch import scratch_folder, written

BLOCK = 32
_OFFSET_BITS = 12


@dataclass(frozen=True)
class Units:
    """How an operator reads a text.

    anchors(text) yields, for pieces of the text, arrays (key, full, place, first, last):
    the anchor's place and its windows' first and last starts, in units of the whole text.
    slices(text, starts, ends) gives these spans as bytes; values(slice) is their units.
    ``window`` is T; an anchor's windows start at most ``reach`` units before its place.
    """

    anchors: Callable[[bytes], Iterator[tuple[np.ndarray, ...]]]
    slices: Callable[[bytes, np.ndarray, np.ndarray], list[bytes]]
    values: Callable[[bytes], np.ndarray]
    window: int
    reach: int


def surroundings(rolling: Rolling, place: np.ndarray, first: np.ndarray, last: np.ndarray, window: int) -> np.ndarray:
    """A hash of all units of an anchor's windows, and of where they lie around it."""
    where = ((place - first) << _OFFSET_BITS | (last - first)).astype(np.uint64)
    return mixed(rolling.spans(first, last + window) + mixed(where))


def _longs(x: np.ndarray) -> pa.Array:
    return pa.array(x.view(np.int64) if x.dtype == np.uint64 else x.astype(np.int64))


def _anchor_rows(units: Units):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        unpack = zstandard.ZstdDecompressor()
        for b in batches:
            found = []
            for row, packed in zip(b.column(0).to_pylist(), b.column(1), strict=True):
                for key, full, place, first, last in units.anchors(unpacked(unpack, packed.as_py())):
                    at = first << 2 * _OFFSET_BITS | (place - first) << _OFFSET_BITS | (last - first)
                    found.append((key, full, np.full(len(key), row), at))
            if found:
                yield pa.RecordBatch.from_arrays(
                    [_longs(np.concatenate(c)) for c in zip(*found, strict=True)], ["key", "full", "row", "at"])

    return run


_FIRST = f"shiftright(at, {2 * _OFFSET_BITS})"
_LAST = f"{_FIRST} + (at & {(1 << _OFFSET_BITS) - 1})"
_PLACE = f"{_FIRST} + (shiftright(at, {_OFFSET_BITS}) & {(1 << _OFFSET_BITS) - 1})"


def _slices(units: Units):
    """Rows of (row, packed, list of (key, at)) to the spans of the anchors' windows."""
    low = (1 << _OFFSET_BITS) - 1

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        unpack = zstandard.ZstdDecompressor()
        for b in batches:
            for i in range(b.num_rows):
                wanted = b.column(2)[i].as_py()
                at = np.array([w["at"] for w in wanted], np.int64)
                first = at >> 2 * _OFFSET_BITS
                spans = units.slices(
                    unpacked(unpack, b.column(1)[i].as_py()), first, first + (at & low) + units.window)
                yield pa.RecordBatch.from_arrays(
                    [pa.array([w["key"] for w in wanted], pa.int64()),
                     pa.array([b.column(0)[i].as_py()] * len(wanted), pa.int64()),
                     pa.array(at), pa.array(spans, pa.binary())], ["key", "row", "at", "span"])

    return run


def _blocks(units: Units):
    """Of each anchor, per block of offsets: the shared units, and all units, hashed."""
    low, t = (1 << _OFFSET_BITS) - 1, units.window
    size = max(1, min(BLOCK, t // 2))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            out = []
            for key, row, at, span in zip(*(c.to_pylist() for c in b.columns), strict=True):
                first, before, width = at >> 2 * _OFFSET_BITS, at >> _OFFSET_BITS & low, at & low
                lowest = units.reach - before  # offset of the first start
                block = np.arange(lowest // size, (lowest + width) // size + 1)
                lo = np.maximum(block * size, lowest) - lowest
                hi = np.minimum(block * size + size - 1, lowest + width) - lowest
                rolling = Rolling(units.values(span))
                core = rolling.spans(block * size + size - 1 - lowest, block * size - lowest + t)
                whole = mixed(rolling.spans(lo, hi + t) + mixed(((lo + lowest) * 4096 + hi - lo).astype(np.uint64)))
                n = len(block)
                out.append((np.full(n, key), block, core, whole, np.full(n, row), np.full(n, at), first + lo, first + hi))
            if out:
                yield pa.RecordBatch.from_arrays(
                    [_longs(np.concatenate(c)) for c in zip(*out, strict=True)],
                    ["key", "block", "core", "whole", "row", "at", "first", "last"])

    return run


def _singles(units: Units):
    """Every window of the blocks asked for: (key, offset, hash, row, first)."""
    low, t = (1 << _OFFSET_BITS) - 1, units.window

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            out = []
            for key, row, at, span, blocks in zip(*(c.to_pylist() for c in b.columns), strict=True):
                start, before = at >> 2 * _OFFSET_BITS, at >> _OFFSET_BITS & low
                rolling = Rolling(units.values(span))
                for x in blocks:
                    s = np.arange(x["first"] - start, x["last"] - start + 1)
                    out.append((np.full(len(s), key), s + units.reach - before, rolling.spans(s, s + t),
                                np.full(len(s), row), s + start))
            if out:
                yield pa.RecordBatch.from_arrays(
                    [_longs(np.concatenate(c)) for c in zip(*out, strict=True)], ["key", "offset", "hash", "row", "first"])

    return run


def repeated_windows(texts: DataFrame, units: Units) -> DataFrame:
    """(row, first, last): starts of repeated windows, as ranges that may overlap.

    ``texts`` is what ``common.packed_texts`` returns.
    """
    python_tasks(texts.sparkSession)
    folder = scratch_folder(texts.sparkSession)

    def mapped(rows: DataFrame, run, schema: str) -> DataFrame:
        return rows.mapInArrow(run, ", ".join(f"{c} binary" if c == "span" else f"{c} long" for c in schema.split()))

    anchors = written(mapped(texts.select("row", "packed"), _anchor_rows(units), "key full row at"), folder, "anchors")
    # counts are written before they are joined: then both sides of the join are plain
    # exchanges, which the planner may split where a key is hot
    groups = written(anchors.groupBy("key").agg(
        F.count(F.lit(1)).alias("n"), F.min("full").alias("a"), F.max("full").alias("b")).filter("n > 1")
        .selectExpr("key", "a = b AS same"), folder, "groups")
    shared = written(anchors.join(groups, "key"), folder, "shared")
    other = shared.filter("NOT same").select("key", "full", "row", "at")
    place = F.struct("row", "at")
    classes = written(
        other.groupBy("key", "full").agg(F.count(F.lit(1)).alias("n"), F.min(place).alias("one")), folder, "classes")
    done = [shared.filter("same").select("row", "at"),
            other.join(classes.filter("n > 1").select("key", "full"), ["key", "full"]).select("row", "at")]

    asked = classes.selectExpr("key", "one.row AS row", "one.at AS at").groupBy("row").agg(
        F.collect_list(F.struct("key", "at")).alias("wanted"))
    spans = written(
        mapped(texts.join(asked, "row").select("row", "packed", "wanted"), _slices(units), "key row at span"),
        folder, "spans")
    blocks = written(mapped(spans, _blocks(units), "key block core whole row at first last"), folder, "blocks")
    by = ["key", "block", "core"]
    alike = written(blocks.groupBy(*by).agg(
        F.count(F.lit(1)).alias("n"), F.min("whole").alias("a"), F.max("whole").alias("b")).filter("n > 1")
        .selectExpr(*by, "a = b AS same"), folder, "alike")
    judged = written(
        blocks.drop("whole").join(alike, by)
        .select("key", "row", "at", "first", "last", "same"), folder, "judged")
    left = judged.filter("NOT same").groupBy("key", "row", "at").agg(
        F.collect_list(F.struct("first", "last")).alias("blocks"))
    singles = written(mapped(
        spans.join(left, ["key", "row", "at"]).select("key", "row", "at", "span", "blocks"), _singles(units),
        "key offset hash row first"), folder, "singles")
    by = ["key", "offset", "hash"]
    twice = written(
        singles.groupBy(*by).agg(F.count(F.lit(1)).alias("n")).filter("n > 1").select(*by), folder, "twice")

    found = judged.filter("same").select("row", "first", "last").unionByName(
        singles.join(twice, by).select("row", "first", F.col("first").alias("last")))
    for part in done:
        found = found.unionByName(part.selectExpr("row", f"{_FIRST} AS first", f"{_LAST} AS last"))
    return found


def covered(starts: DataFrame) -> DataFrame:
    """(row, ranges): per row the list of its (first, last)."""
    return starts.groupBy("row").agg(F.collect_list(F.struct("first", "last")).alias("ranges"))


def merged(ranges: list[dict] | None, window: int) -> tuple[np.ndarray, np.ndarray]:
    """Maximal runs [start, end) of units that lie in a window that starts in a range."""
    if not ranges:
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    start = np.array([r["first"] for r in ranges], np.int64)
    order = np.argsort(start, kind="stable")
    start = start[order]
    end = np.maximum.accumulate(np.array([r["last"] for r in ranges], np.int64)[order] + window)
    new = np.flatnonzero(np.concatenate(([True], start[1:] > end[:-1])))
    return start[new], end[np.append(new[1:], len(start)) - 1]


def with_ranges(texts: DataFrame, starts: DataFrame) -> DataFrame:
    """(doc_id, packed, ranges) for every row; ranges is null where nothing is repeated."""
    return texts.join(covered(starts), "row", "left").select("doc_id", "packed", "ranges")
