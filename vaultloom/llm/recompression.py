"""Removal of repeated word sequences (operator 2).

Texts are recompressed in rounds. A round names the runs of equal symbols, then the
pairs of a left and a right symbol (a coin, tossed by the symbol, says which it is). A
name is a hash of what it stands for, so all tasks give equal runs and pairs equal names
without an exchange, and equal substrings get equal symbols but for a margin at either
end. The margin is tracked: each symbol knows the range of words that decided it.

The symbols after ``ROUNDS`` rounds are the anchors of ``windows``: a window's anchor is
the least, by hash, of those decided by words of the window alone. Symbols that occur
only once can't lie in a repeat and are left out by the first pass; shared ones reveal
candidates, which the further passes verify to the whole window. A window without such a
symbol (inside a long run) is its own anchor.

Removed is each word that a repeated window covers, judged on the input; overlapping
occurrences count, within a document too, and no window crosses documents.

Words are what stands between blanks (bytes 32 and 9 to 13), unchanged; sequences are
compared by 64-bit hashes of their words. Texts are read in pieces of ``PIECE`` window
starts. Null text: no words. Texts shorter than a window lose nothing. Repeated rows are
copies of each other. Null ids are kept. Extra columns are ignored; no rows give none.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
import zstandard
from pyspark.sql import DataFrame, SparkSession

from vaultloom.llm import windows
from vaultloom.llm.common import packed_texts, table, unpacked
from vaultloom.llm.rolling import Rolling, mixed

WINDOW = 35
ROUNDS = 2
PIECE = 1 << 18
_PLACE = np.uint64((1 << 20) - 1)
_FAR = 1 << 40


def word_values(words: list[bytes]) -> np.ndarray:
    hashed = xxhash.xxh3_64_intdigest
    return np.array([hashed(w) for w in words], np.uint64)


def _next(x: np.ndarray, last) -> np.ndarray:
    return np.append(x[1:], last)


def _previous(x: np.ndarray, first) -> np.ndarray:
    return np.concatenate((np.array([first], x.dtype), x[:-1]))


def symbols(values: np.ndarray, rounds: int = ROUNDS):
    """(name, start, low, high) after the rounds: words [low, high) decide the symbol; a
    symbol that depends on what lies beyond the text has no bounds."""
    name, start = values, np.arange(len(values))
    low, high = start.copy(), start + 1
    for n in range(rounds):
        # runs: whether a symbol is one depends on its neighbours
        first = np.flatnonzero(np.concatenate(([True], name[1:] != name[:-1])))
        after = np.append(first[1:], len(name))
        length = after - first
        low = np.where(first > 0, low[np.maximum(first - 1, 0)], -_FAR)
        high = np.where(after < len(name), high[np.minimum(after, len(name) - 1)], _FAR)
        name, start = name[first], start[first]
        name = np.where(length > 1, mixed(name + mixed(length.astype(np.uint64))), name)
        # pairs: a left symbol joins a right one that follows it
        right = (mixed(name + np.uint64(2 * n + 1)) & np.uint64(1)).astype(bool)
        joins = ~right & _next(right, False)
        joined = _previous(joins, False)
        pair_name = mixed(name * np.uint64(3) + mixed(_next(name, 0).astype(np.uint64)))
        # a single symbol depends on the neighbour that it might have joined
        left_low, right_high = _previous(low, -_FAR), _next(high, _FAR)
        low = np.where(right & ~joined, left_low, low)
        high = np.where(joins | ~right, right_high, high)
        name = np.where(joins, pair_name, name)
        keep = ~joined
        name, start, low, high = name[keep], start[keep], low[keep], high[keep]
    return name, start, low, high


def _least_symbols(order: np.ndarray, low: np.ndarray, high: np.ndarray, n: int, window: int) -> np.ndarray:
    """For each window the least order of the symbols with bounds inside it; all ones if none."""
    none = np.uint64(0xFFFFFFFFFFFFFFFF)
    start = np.arange(n - window + 1)
    a, b = np.searchsorted(low, start), np.searchsorted(high, start + window, side="right")
    best = np.full(len(start), none)
    for k in range(max(0, int((b - a).max(initial=0)))):
        at = a + k
        inside = at < b
        best = np.where(inside, np.minimum(best, order[np.minimum(at, len(order) - 1)]), best)
    return best


def _anchors(window: int, rounds: int):
    none = np.uint64(0xFFFFFFFFFFFFFFFF)

    def run(text: bytes) -> Iterator[tuple[np.ndarray, ...]]:
        words = text.split()
        for at in range(0, len(words) - window + 1, PIECE):
            values = word_values(words[at:at + PIECE + window - 1])
            rolling = Rolling(values)
            name, start, low, high = symbols(values, rounds)
            bounded = (low >= 0) & (high <= len(values)) & (high - low <= window)
            name, start, low, high = name[bounded], start[bounded], low[bounded], high[bounded]
            key = mixed(name + rolling.spans(low, high) + mixed((start - low).astype(np.uint64)))
            order = key & ~_PLACE | np.arange(len(key)).astype(np.uint64)
            best = _least_symbols(order, low, high, len(values), window)
            first = np.flatnonzero(np.concatenate(([True], (best[1:] != best[:-1]) | (best[1:] == none))))
            last = np.append(first[1:], len(best)) - 1
            chosen = best[first]
            own = chosen == none
            symbol = np.where(own, 0, (chosen & _PLACE).astype(np.int64))
            place = np.where(own, first, start[symbol]) if len(start) else first
            keys = np.where(own, rolling.spans(first, first + window), key[symbol] if len(key) else np.uint64(0))
            full = windows.surroundings(rolling, place, first, last, window)
            yield keys, full, place + at, first + at, last + at

    return run


def _slices(text: bytes, first: np.ndarray, end: np.ndarray) -> list[bytes]:
    words = text.split()
    return [word_values(words[a:b]).tobytes() for a, b in zip(first.tolist(), end.tolist(), strict=True)]


def units(window: int = WINDOW, rounds: int = ROUNDS) -> windows.Units:
    return windows.Units(
        anchors=_anchors(window, rounds), slices=_slices, values=lambda span: np.frombuffer(span, np.uint64),
        window=window, reach=window)


SCHEMA = "doc_id long, n_words long, n_removed long, kept_sha256 string, spans array<struct<start: long, end: long>>, kept string"


def _cut(window: int, keep: bool):
    kind = pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64())]))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        unpack = zstandard.ZstdDecompressor()
        for b in batches:
            out = []
            for doc_id, packed, ranges in zip(*(c.to_pylist() for c in b.columns), strict=True):
                words = unpacked(unpack, packed).split()
                start, end = windows.merged(ranges, window)
                at, left = 0, []
                for s, e in zip(start.tolist(), end.tolist(), strict=True):
                    left += words[at:s]
                    at = e
                left += words[at:]
                kept = b" ".join(left)
                out.append((doc_id, len(words), len(words) - len(left), hashlib.sha256(kept).hexdigest(),
                            [{"start": s, "end": e} for s, e in zip(start.tolist(), end.tolist(), strict=True)],
                            kept.decode() if keep else None))
            types = [pa.int64(), pa.int64(), pa.int64(), pa.string(), kind, pa.string()]
            columns = zip(*out, strict=True) if out else [[]] * len(types)
            yield pa.RecordBatch.from_arrays(
                [pa.array(c, t) for c, t in zip(columns, types, strict=True)],
                ["doc_id", "n_words", "n_removed", "kept_sha256", "spans", "kept"])

    return run


def deduplicated(docs: DataFrame, window: int = WINDOW, rounds: int = ROUNDS, keep: bool = True) -> DataFrame:
    """Counts, digest, removed word spans and, with ``keep``, the kept words of each document."""
    texts = packed_texts(docs)
    starts = windows.repeated_windows(texts, units(window, rounds))
    return windows.with_ranges(texts, starts).mapInArrow(_cut(window, keep), SCHEMA)


def op2_recompression(spark: SparkSession, folder: str) -> DataFrame:
    return deduplicated(table(spark, folder, "documents"), keep=False).select(
        "doc_id", "n_words", "n_removed", "kept_sha256")
