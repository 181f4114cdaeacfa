"""WARC archives compressed with a dictionary (operator 3).

An archive is a sequence of Zstandard frames that any decoder accepts:

    skippable frame (0x184D2A5D) with the archive's dictionary
    one frame per record, each followed by an empty skippable frame

The dictionary is trained on the first records of the archive itself, so an archive
needs nothing but itself to be read, and a record can be read alone once the first
frame is known. Rows are written by Spark's text writer, to any file system that
Spark reaches: its line separator is the empty skippable frame, so the files are
valid Zstandard throughout. They keep the names that Spark gives them.

Nulls and odd rows: a null html is an empty payload; a null url leaves out the
target; a page without an id gets a record without one and can't be referred to.
Of equal payloads, every row with the largest id is a response, so repeated rows of
one page stay responses. No pages give no archives. Extra columns are ignored.
"""

from __future__ import annotations

import hashlib
import struct
from collections.abc import Iterator
from urllib.parse import quote, unquote

import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from vaultloom.llm.common import python_tasks, table
from vaultloom.sources.scratch import scratch_folder, written

# Fixed values of the formats: Zstandard's skippable frames, the archive's dictionary frame.
EMPTY_FRAME = "P*M\x18\0\0\0\0"
DICTIONARY_MAGIC = 0x184D2A5D
REVISIT_PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"

ARCHIVE_BYTES = 16 << 20
SAMPLE_BYTES = 2 << 20
DICTIONARY_BYTES = 64 << 10
LEAST_REVISIT = 1000
LEVEL = 6

READ_SCHEMA = ("page_id long, url string, record_type string, payload_bytes long, "
               "payload_digest string, refers_to long, payload binary")


def with_record_types(pages: DataFrame, least_revisit: int = LEAST_REVISIT) -> DataFrame:
    """(page_id, url, payload, digest, refers_to); refers_to is null for responses.

    Payloads are compared by length and SHA-256. Only digests are grouped, with a
    maximum that is combined in the tasks; only those that occur twice are joined
    back, by a join that the planner broadcasts if small and may split if skewed.
    """
    rows = pages.select(
        F.col("page_id").cast("long").alias("page_id"), F.col("url").cast("string").alias("url"),
        F.coalesce(F.col("html"), F.lit("")).cast("binary").alias("payload")).select(
        "*", F.sha1("payload").alias("digest"),
        F.unhex(F.sha2("payload", 256)).alias("content"))
    copied = written(
        rows.filter(F.length("payload") >= least_revisit).groupBy("content")
        .agg(F.max("page_id").alias("first"), F.count(F.lit(1)).alias("copies"))
        .filter("copies > 1 AND first IS NOT NULL").select("content", "first"),
        scratch_folder(pages.sparkSession), "copied")
    return rows.join(copied, "content", "left").select(
        "page_id", "url", "payload", "digest",
        F.expr("CASE WHEN first <=> page_id THEN NULL ELSE first END").alias("refers_to"))


def _record(page_id, url, payload: bytes, digest: str, refers_to, date: str) -> bytes:
    head = ["WARC/1.1", f"WARC-Type: {'response' if refers_to is None else 'revisit'}",
            f"WARC-Record-ID: <urn:page:{'none' if page_id is None else page_id}>",
            f"WARC-Date: {date}"]
    if url is not None:
        head.append(f"WARC-Target-URI: {quote(url, safe=':/?#[]@!$&()*+,;=~')}")
    head += [f"WARC-Payload-Digest: sha1:{digest}", f"WARC-Payload-Length: {len(payload)}"]
    http = b""
    if refers_to is None:
        http = (b"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\n"
                b"Content-Length: %d\r\n\r\n" % len(payload)) + payload
        head.append("Content-Type: application/http; msgtype=response")
    else:
        head += [f"WARC-Refers-To: <urn:page:{refers_to}>", f"WARC-Profile: {REVISIT_PROFILE}"]
    head.append(f"Content-Length: {len(http)}")
    return "\r\n".join(head).encode() + b"\r\n\r\n" + http + b"\r\n\r\n"


def _dictionary(samples: list[bytes], size: int) -> bytes:
    """Trained on the records; empty where they are too few to train on."""
    if sum(map(len, samples)) < 8 * size or len(samples) < 16:
        size = sum(map(len, samples)) // 8
    try:
        return zstandard.train_dictionary(size, samples).as_bytes() if len(samples) >= 8 else b""
    except zstandard.ZstdError:
        return b""


class _Archive:
    """One archive: holds records until the dictionary is built, then frames them."""

    def __init__(self, sample_bytes: int, dictionary_bytes: int, level: int):
        self.waiting, self.held, self.size, self.packer = [], 0, 0, None
        self.sample_bytes, self.dictionary_bytes, self.level = sample_bytes, dictionary_bytes, level

    def add(self, record: bytes) -> Iterator[bytes]:
        if self.packer:
            yield self._frame(record)
            return
        self.waiting.append(record)
        self.held += len(record)
        if self.held >= self.sample_bytes:
            yield from self.start()

    def start(self) -> Iterator[bytes]:
        if self.packer or not self.waiting:
            return
        raw = _dictionary(self.waiting, self.dictionary_bytes)
        self.packer = zstandard.ZstdCompressor(
            level=self.level, dict_data=zstandard.ZstdCompressionDict(raw) if raw else None)
        yield struct.pack("<II", DICTIONARY_MAGIC, len(raw)) + raw
        for record in self.waiting:
            yield self._frame(record)
        self.waiting = []

    def _frame(self, record: bytes) -> bytes:
        frame = self.packer.compress(record)
        self.size += len(frame)
        return frame


def _frames(archive_bytes: int, sample_bytes: int, dictionary_bytes: int, level: int, date: str):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        number, seq = 0, 0
        archive = _Archive(sample_bytes, dictionary_bytes, level)

        def batch(frames: list[bytes]) -> pa.RecordBatch:
            nonlocal seq
            seq += len(frames)
            return pa.RecordBatch.from_pydict({
                "archive": pa.array([number] * len(frames), pa.int32()),
                "seq": pa.array(range(seq - len(frames), seq), pa.int64()),
                "frame": pa.array(frames, pa.binary())})

        for b in batches:
            for i in range(b.num_rows):
                row = [c[i].as_py() for c in b.columns]
                frames = list(archive.add(_record(*row, date)))
                if frames:
                    yield batch(frames)
                if archive.size >= archive_bytes:
                    number, archive = number + 1, _Archive(sample_bytes, dictionary_bytes, level)
        if frames := list(archive.start()):
            yield batch(frames)

    return run


def write_archives(
    pages: DataFrame, path: str, *, date: str = "2024-01-01T00:00:00Z",
    least_revisit: int = LEAST_REVISIT, archive_bytes: int = ARCHIVE_BYTES,
    sample_bytes: int = SAMPLE_BYTES, dictionary_bytes: int = DICTIONARY_BYTES, level: int = LEVEL,
) -> None:
    """Write a record per page below ``path``, in archives of about ``archive_bytes``.

    A task starts a new archive, with its own dictionary, when one is full. It holds
    at most ``sample_bytes`` of records and the longest record in memory.
    """
    python_tasks(pages.sparkSession)
    framed = with_record_types(pages, least_revisit).mapInArrow(
        _frames(archive_bytes, sample_bytes, dictionary_bytes, level, date),
        "archive int, seq long, frame binary")
    # a cast of bytes to text keeps them as they are
    (framed.sortWithinPartitions("archive", "seq")
     .select("archive", F.col("frame").cast("string").alias("value"))
     .write.partitionBy("archive").option("lineSep", EMPTY_FRAME).text(path))


def records(archive: bytes) -> Iterator[bytes]:
    """The records of one archive."""
    empty, at, unpacker = EMPTY_FRAME.encode(), 0, zstandard.ZstdDecompressor()
    while at < len(archive):
        magic, size = struct.unpack_from("<II", archive, at)
        if magic == DICTIONARY_MAGIC:
            raw = archive[at + 8:at + 8 + size]
            unpacker = zstandard.ZstdDecompressor(
                dict_data=zstandard.ZstdCompressionDict(raw) if raw else None)
            at += 8 + size
        elif 0x184D2A50 <= magic <= 0x184D2A5F:
            at += 8 + size
        else:
            end = at
            while True:  # the separator's bytes may occur in a frame by chance
                end = archive.find(empty, end + 1)
                if end < 0:
                    raise ValueError("an archive ends inside a record")
                one = unpacker.decompressobj()
                record = one.decompress(archive[at:end])
                if one.eof:
                    break
            yield record
            at = end


def _page(urn: str | None) -> int | None:
    found = urn and urn.strip("<>").rpartition(":")[2]
    return int(found) if found and found != "none" else None


def parsed(record: bytes) -> tuple:
    """A row of READ_SCHEMA; raises where a payload doesn't have its digest."""
    head, _, block = record.partition(b"\r\n\r\n")
    lines = head.decode().split("\r\n")
    if lines[0] != "WARC/1.1":
        raise ValueError(f"not a record: {lines[0][:40]!r}")
    fields = dict(x.split(": ", 1) for x in lines[1:])
    block = block[:int(fields["Content-Length"])]
    digest, size = fields["WARC-Payload-Digest"].removeprefix("sha1:"), int(fields["WARC-Payload-Length"])
    payload = None
    if fields["WARC-Type"] == "response":
        payload = block.partition(b"\r\n\r\n")[2]
        if len(payload) != size or hashlib.sha1(payload).hexdigest() != digest:
            raise ValueError(f"{fields['WARC-Record-ID']}: the payload doesn't have its digest")
    url = fields.get("WARC-Target-URI")
    return (_page(fields["WARC-Record-ID"]), None if url is None else unquote(url),
            fields["WARC-Type"], size, digest, _page(fields.get("WARC-Refers-To")), payload)


def read_archives(spark: SparkSession, path: str, payloads: bool = True) -> DataFrame:
    """The records below ``path``; without ``payloads`` these are checked, not returned.

    An archive is read whole by one task; ``archive_bytes`` bounds it.
    """
    python_tasks(spark)
    columns = [c.split(" ")[0] for c in READ_SCHEMA.split(", ")]
    types = [pa.int64(), pa.string(), pa.string(), pa.int64(), pa.string(), pa.int64(), pa.binary()]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def batch(rows):
            return pa.RecordBatch.from_arrays(
                [pa.array(c, t) for c, t in zip(zip(*rows, strict=True), types, strict=True)], columns)

        for b in batches:
            for archive in b.column(0):
                rows, held = [], 0
                for record in records(archive.as_py()):
                    row = parsed(record)
                    rows.append(row if payloads else (*row[:-1], None))
                    held += len(row[-1] or b"") if payloads else 0
                    if len(rows) >= 2000 or held > SAMPLE_BYTES:
                        yield batch(rows)
                        rows, held = [], 0
                if rows:
                    yield batch(rows)

    files = (spark.read.schema("path string, modificationTime timestamp, length long, content binary")
             .format("binaryFile").option("recursiveFileLookup", "true").load(path))
    return files.select("content").mapInArrow(run, READ_SCHEMA)


def op3_warc(spark: SparkSession, folder: str) -> DataFrame:
    """Archive all pages, read the archives back: one row per page."""
    path = f"{scratch_folder(spark)}/archives"
    write_archives(table(spark, folder, "pages"), path)
    return read_archives(spark, path, payloads=False).select(
        "page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")


ORACLE = {
    "op3_warc": """
WITH p AS (
  SELECT page_id, coalesce(html, '') AS html FROM pages
), c AS (
  SELECT html, max(page_id) AS first, count(*) AS copies FROM p
  WHERE strlen(html) >= 1000 GROUP BY html
)
SELECT p.page_id, CAST(strlen(p.html) AS BIGINT) AS payload_bytes, sha1(p.html) AS payload_digest,
       CASE WHEN c.first IS NULL OR c.copies = 1 OR c.first IS NOT DISTINCT FROM p.page_id
            THEN 'response' ELSE 'revisit' END AS record_type,
       CASE WHEN c.copies > 1 AND c.first IS DISTINCT FROM p.page_id THEN c.first END AS refers_to
FROM p LEFT JOIN c ON p.html = c.html""",
}
