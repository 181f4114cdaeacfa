"""Removal of repeated byte strings (operator 1).

Suffixes of all texts are sorted by radix, most significant digit first, and only to a
depth of ``WINDOW`` bytes: what is equal to that depth is a repeated window, and a suffix
that is alone in its group is out. Neighbouring suffixes share their first digit: the
128 bytes at the least of the windows' hashed positions, which is the same position in
all equal windows, wherever they occur. So the first pass handles about one record for
137 suffixes; the digits after it are the rest of the window (``windows`` has the passes).

Removed is each byte that a repeated window covers, judged on the input; overlapping
occurrences count, within a document too, and no window crosses documents.

A text is read in pieces of ``PIECE`` window starts, so memory is bounded by that and the
text itself. Null text: empty. Texts shorter than a window lose nothing. Repeated rows
are copies of each other. Null ids are kept. Extra columns are ignored; no rows give none.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame, SparkSession

from vaultloom.llm import windows
from vaultloom.llm.common import packed_texts, table, unpacked
from vaultloom.llm.rolling import BYTE_VALUES, Rolling, sliding_least

WINDOW = 400
DIGIT = 128
PIECE = 1 << 20
_PLACE = np.uint64((1 << 21) - 1)


def _anchors(window: int, digit: int):
    def run(text: bytes) -> Iterator[tuple[np.ndarray, ...]]:
        codes = np.frombuffer(text, np.uint8)
        for at in range(0, len(codes) - window + 1, PIECE):
            part = codes[at:at + PIECE + window - 1]
            rolling = Rolling(BYTE_VALUES[part])
            start = np.arange(len(part) - digit + 1)
            digits = rolling.spans(start, start + digit)
            # the least hash of each window, with its position in the low bits: ties go to the first
            least = sliding_least(digits & ~_PLACE | start.astype(np.uint64), window - digit + 1) & _PLACE
            first = np.flatnonzero(np.diff(least, prepend=_PLACE))
            last = np.append(first[1:], len(least)) - 1
            place = least[first].astype(np.int64)
            full = windows.surroundings(rolling, place, first, last, window)
            yield digits[place], full, place + at, first + at, last + at

    return run


def units(window: int = WINDOW, digit: int = DIGIT) -> windows.Units:
    return windows.Units(
        anchors=_anchors(window, digit),
        slices=lambda text, first, end: [text[a:b] for a, b in zip(first.tolist(), end.tolist(), strict=True)],
        values=lambda span: BYTE_VALUES[np.frombuffer(span, np.uint8)],
        window=window, reach=window - digit)


SCHEMA = "doc_id long, n_bytes long, n_removed long, n_spans long, kept_sha256 string, spans array<struct<start: long, end: long>>, kept binary"


def _cut(window: int, keep: bool):
    kind = pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64())]))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        unpack = zstandard.ZstdDecompressor()
        for b in batches:
            out = []
            for doc_id, packed, ranges in zip(*(c.to_pylist() for c in b.columns), strict=True):
                text = unpacked(unpack, packed)
                start, end = windows.merged(ranges, window)
                at, kept = 0, []
                for s, e in zip(start.tolist(), end.tolist(), strict=True):
                    kept.append(text[at:s])
                    at = e
                kept = b"".join([*kept, text[at:]])
                out.append((doc_id, len(text), len(text) - len(kept), len(start), hashlib.sha256(kept).hexdigest(),
                            [{"start": s, "end": e} for s, e in zip(start.tolist(), end.tolist(), strict=True)],
                            kept if keep else None))
            types = [pa.int64(), pa.int64(), pa.int64(), pa.int64(), pa.string(), kind, pa.binary()]
            columns = zip(*out, strict=True) if out else [[]] * len(types)
            yield pa.RecordBatch.from_arrays(
                [pa.array(c, t) for c, t in zip(columns, types, strict=True)],
                ["doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256", "spans", "kept"])

    return run


def deduplicated(docs: DataFrame, window: int = WINDOW, digit: int = DIGIT, keep: bool = True) -> DataFrame:
    """Counts, digest, removed spans and, with ``keep``, the kept bytes of each document."""
    texts = packed_texts(docs)
    starts = windows.repeated_windows(texts, units(window, digit))
    return windows.with_ranges(texts, starts).mapInArrow(_cut(window, keep), SCHEMA)


def op1_suffix_dedup(spark: SparkSession, folder: str) -> DataFrame:
    return deduplicated(table(spark, folder, "documents"), keep=False).select(
        "doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256")
