"""Fill-in-the-middle documents over a piece table (operator 11).

A document is a list of descriptors (buffer, start, end) over two buffers that never
change: its text as UTF-8 and the sentinels. Cutting splits the text's descriptor at
two unit ends, an arrangement permutes the descriptors, and the output is what they
point at, in order; no text is copied before that. To restore, an output is described
by the descriptors between its sentinels, and the inverse permutation puts them back.
Hashes stream the descriptors' slices.

A text of n lines (``[^\\n]*\\n|[^\\n]+``) is cut by h1 to h4, the first four 8-digit
groups of the hex sha256 of ``<seed>:<doc_id>``: the prefix ends after the smaller of
h1 % (n + 1) and h2 % (n + 1) units, the middle after the larger. h3 % 100 >= ``rate``
leaves the text plain, h4 % 100 < ``spm`` chooses spm, else psm.

Null or empty text: plain, no units, an empty output. A text that holds a sentinel is
plain, as its output could not be told apart. A null doc_id is the empty text in the
hash, so equal texts with null ids are cut alike. Repeated rows give repeated rows.
A text of one line or with cuts at its ends has empty pieces, which are kept. Very
long texts need a few times their own size in one task. Extra columns are ignored,
whatever their names; no rows give no rows.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from vaultloom.llm.common import python_tasks, table, text_bytes

SENTINELS = (b"<P>", b"<S>", b"<M>")
"""Before prefix, suffix and middle."""
RATE, SPM, SEED = 100, 50, 7
PLAIN = "plain"
OUTPUT_AT_ONCE = 1 << 24
"""Characters of outputs after which a task hands its rows on."""

IN_ORDER = "P prefix M middle S suffix".split()
"""The descriptors of a cut text, in the order that arrangements permute."""
ARRANGED = {"psm": (0, 1, 4, 5, 2, 3), "spm": (4, 5, 0, 1, 2, 3)}
"""Places in ``IN_ORDER`` of the output's first, second, ... descriptor."""


class Piece(NamedTuple):
    buffer: memoryview
    start: int
    end: int

    def view(self) -> memoryview:
        return self.buffer[self.start:self.end]

    def split(self, *places: int) -> list[Piece]:
        """Pieces between the given rising places of the buffer."""
        ends = [self.start, *places, self.end]
        return [Piece(self.buffer, a, b) for a, b in zip(ends, ends[1:], strict=False)]


def streamed_sha256(pieces: list[Piece]) -> str:
    found = hashlib.sha256()
    for p in pieces:
        found.update(p.view())
    return found.hexdigest()


def joined(pieces: list[Piece]) -> bytes:
    return b"".join(p.view() for p in pieces)


def code_points(piece: Piece) -> int:
    codes = np.frombuffer(piece.view(), np.uint8)
    return int(np.count_nonzero((codes & 0xC0) != 0x80))


def line_ends(text: bytes) -> np.ndarray:
    """Byte offsets at which the text's lines end."""
    ends = np.flatnonzero(np.frombuffer(text, np.uint8) == ord("\n")) + 1
    return ends if not text or text.endswith(b"\n") else np.append(ends, len(text))


def sentinel_pieces(sentinels: tuple[bytes, ...]) -> list[Piece]:
    """One descriptor for each sentinel, over one buffer."""
    ends = np.cumsum([len(s) for s in sentinels]).tolist()
    return Piece(memoryview(b"".join(sentinels)), 0, ends[-1]).split(*ends[:-1])


def cut(text: bytes, first: int, second: int, sentinels: tuple[bytes, ...]) -> list[Piece]:
    """The descriptors of ``IN_ORDER``, the text cut at two byte offsets."""
    prefix, middle, suffix = Piece(memoryview(text), 0, len(text)).split(first, second)
    before_prefix, before_suffix, before_middle = sentinel_pieces(sentinels)
    return [before_prefix, prefix, before_middle, middle, before_suffix, suffix]


def arranged(pieces: list[Piece], form: str) -> list[Piece]:
    return [pieces[at] for at in ARRANGED[form]]


def restored(output: bytes, form: str, sentinels: tuple[bytes, ...] = SENTINELS) -> list[Piece]:
    """Descriptors over ``output`` whose join is the text that was arranged."""
    whole = Piece(memoryview(output), 0, len(output))
    if form == PLAIN:
        return [whole]
    names = dict(zip("PSM", sentinels, strict=True))
    order = [names[IN_ORDER[at]] for at in ARRANGED[form][::2]]
    places, at = [], 0
    for s in order:
        at = output.index(s, at)
        places += [at, at + len(s)]
        at += len(s)
    pieces = whole.split(*places)[1:]  # an arrangement begins with a sentinel
    back: list[Piece] = [whole] * len(pieces)
    for piece, place in zip(pieces, ARRANGED[form], strict=True):
        back[place] = piece
    return back[1::2]


def _row(doc_id: str, text: bytes, rate: int, spm: int, seed: int, sentinels: tuple[bytes, ...], texts: bool):
    ends = line_ends(text)
    n = len(ends)
    digest = hashlib.sha256(f"{seed}:{doc_id}".encode()).hexdigest()
    h1, h2, h3, h4 = (int(digest[at:at + 8], 16) for at in range(0, 32, 8))
    if not text or h3 % 100 >= rate or any(s in text for s in sentinels):
        form, pieces = PLAIN, [Piece(memoryview(text), 0, len(text))]
        lengths = (None, None)
    else:
        form = "spm" if h4 % 100 < spm else "psm"
        units = sorted((h1 % (n + 1), h2 % (n + 1)))
        in_order = cut(text, *(int(ends[u - 1]) if u else 0 for u in units), sentinels)
        lengths = (code_points(in_order[1]), code_points(in_order[3]))
        pieces = arranged(in_order, form)
    output = joined(pieces)
    back = restored(output, form, sentinels)
    return (n, form, *lengths, output.decode() if texts else None, streamed_sha256(pieces), streamed_sha256(back))


SCHEMA = pa.schema([
    ("doc_id", pa.int64()), ("n", pa.int64()), ("form", pa.string()), ("prefix_chars", pa.int64()),
    ("middle_chars", pa.int64()), ("output", pa.string()), ("output_sha256", pa.string()), ("restored_sha256", pa.string())])


def _batch(rows: list[tuple]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays(
        [pa.array(values, f.type) for values, f in zip(zip(*rows, strict=True), SCHEMA, strict=True)], schema=SCHEMA)


def _arranger(*how):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            rows, held = [], 0
            for doc_id, text in zip(*b.columns, strict=True):
                doc_id = doc_id.as_py()
                rows.append((doc_id, *_row("" if doc_id is None else str(doc_id), text.as_py(), *how)))
                held += len(rows[-1][5] or "")
                if held > OUTPUT_AT_ONCE:
                    yield _batch(rows)
                    rows, held = [], 0
            if rows:
                yield _batch(rows)

    return run


def rearranged(docs: DataFrame, rate: int = RATE, spm: int = SPM, seed: int = SEED,
               sentinels: tuple[bytes, ...] = SENTINELS, texts: bool = True) -> DataFrame:
    """(doc_id, n, form, prefix_chars, middle_chars, output, output_sha256, restored_sha256).

    ``restored_sha256`` is the hash of the text rebuilt from output and form alone.
    Without ``texts`` the outputs are hashed but not returned (null).
    """
    python_tasks(docs.sparkSession)
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), text_bytes().alias("text"))
    return rows.mapInArrow(
        _arranger(rate, spm, seed, tuple(sentinels), texts),
        "doc_id long, n long, form string, prefix_chars long, middle_chars long, output string,"
        " output_sha256 string, restored_sha256 string")


def _restorer(sentinels: tuple[bytes, ...]):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            texts = [joined(restored(o.as_py(), f.as_py(), sentinels)).decode()
                     for o, f in zip(b.column(1), b.column(2), strict=True)]
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(texts, pa.string())], ["doc_id", "text"])

    return run


def restored_texts(rows: DataFrame, sentinels: tuple[bytes, ...] = SENTINELS) -> DataFrame:
    """(doc_id, text) of rows with ``doc_id``, ``output`` and ``form`` as ``rearranged`` gives them."""
    python_tasks(rows.sparkSession)
    return rows.select("doc_id", text_bytes("output").alias("output"), "form").mapInArrow(
        _restorer(tuple(sentinels)), "doc_id long, text string")


def op11_fill_middle(spark: SparkSession, folder: str) -> DataFrame:
    return rearranged(table(spark, folder, "documents"), texts=False).drop("output")


ORACLE = {"op11_fill_middle": r"""
WITH hashed AS (
  SELECT doc_id, coalesce(text, '') AS t, sha256('7:' || coalesce(CAST(doc_id AS VARCHAR), '')) AS h FROM documents),
units AS (
  SELECT doc_id, t, regexp_extract_all(t, '[^\n]*\n|[^\n]+') AS u,
    ('0x' || substr(h, 1, 8))::BIGINT AS h1, ('0x' || substr(h, 9, 8))::BIGINT AS h2,
    ('0x' || substr(h, 17, 8))::BIGINT AS h3, ('0x' || substr(h, 25, 8))::BIGINT AS h4 FROM hashed),
cuts AS (
  SELECT *, len(u) AS n, least(h1 % (len(u) + 1), h2 % (len(u) + 1)) AS a, greatest(h1 % (len(u) + 1), h2 % (len(u) + 1)) AS b,
    CASE WHEN t = '' OR contains(t, '<P>') OR contains(t, '<S>') OR contains(t, '<M>') OR h3 % 100 >= 100 THEN 'plain'
         WHEN h4 % 100 < 50 THEN 'spm' ELSE 'psm' END AS form FROM units),
parts AS (
  SELECT doc_id, t, n, form, array_to_string(u[1:a], '') AS prefix, array_to_string(u[a + 1:b], '') AS middle,
    array_to_string(u[b + 1:n], '') AS suffix FROM cuts)
SELECT doc_id, n, form, CASE WHEN form <> 'plain' THEN length(prefix) END AS prefix_chars,
  CASE WHEN form <> 'plain' THEN length(middle) END AS middle_chars,
  sha256(CASE form WHEN 'psm' THEN '<P>' || prefix || '<S>' || suffix || '<M>' || middle
                   WHEN 'spm' THEN '<S>' || suffix || '<P>' || prefix || '<M>' || middle ELSE t END) AS output_sha256,
  sha256(t) AS restored_sha256
FROM parts
"""}
