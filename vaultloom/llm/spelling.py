"""Spelling variants of the words of all documents (operator 12).

Words are the lower-cased (A-Z) runs of Latin letters of all texts, with the planted
deletions of the contract, of at least ``LEAST_LENGTH`` code points and ``LEAST_COUNT``
occurrences. Two words are near if one inserted, deleted or replaced code point leads
from one to the other.

Bloom-guided neighbourhoods:

- The vocabulary is hashed into blocked Bloom filters, one for each length; a block is
  one 64-bit number. Every block belongs to one task, which sets its bits, so a
  frequent length is built by many tasks. The filters are broadcast.
- Every word probes all its edits that lead to a word of its own length or one shorter:
  each code point deleted, and each replaced by a greater one of the vocabulary's
  alphabet. The other half of the edits is the same pairs seen from the other side.
  Hashes are polynomials in the code points, so the hash of an edit is that of the word
  and a difference; whole arrays of words of one length are probed at once.
- Only edits that the filters hold leave the task. A join with the vocabulary itself
  removes false positives, so the pairs are exact whatever the filters say.

Broadcast: a filter has ``BLOOM_BITS`` bits a word. One pass holds ``PASS_WORDS`` words
at most in expectation (32 MB of filters); a larger vocabulary is dealt by hash into
several passes, each with its own filters, and every edit is probed in the pass that its hash belongs to.
The alphabet has at most 26 + 64 letters, by the pattern.

Null or empty texts have no words. A null doc_id is the empty text in the deletions'
hash. Repeated rows count as often as they occur. Ties of a form go to the least word
in code-point order. Very long texts and frequent words are counted in the tasks before
anything is shuffled; a word with very many near words is a sum, not a list. Extra
columns are ignored, whatever their names; no rows give no rows.
"""

from __future__ import annotations

from collections.abc import Iterator
from contextlib import contextmanager

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from vaultloom.llm.common import python_tasks, table
from vaultloom.sources.scratch import scratch_folder, written

LEAST_LENGTH, LEAST_COUNT, FORM_RATIO, DELETE_EVERY = 7, 2, 10, 31
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
RUN = "[A-Za-z\\u00C0-\\u00FF]+"

BLOOM_BITS = 32
PASS_WORDS = 1 << 23
BUILT_AT_ONCE = 1 << 14
"""Blocks whose bits one task sets."""
BITS_SET = 4
WORD_BATCH = 4096
"""Words whose edits are hashed at once: about 4,096 x 40 x 90 numbers for 40 letters."""
BASE = np.uint64(0x9E3779B97F4A7C15)
BASE_INVERSE = np.uint64(pow(0x9E3779B97F4A7C15, -1, 1 << 64))


def occurrences(docs: DataFrame, delete_every: int = DELETE_EVERY) -> DataFrame:
    """(word, n): all runs of all texts, lower-cased, a code point deleted where the contract says so."""
    doc_id = F.coalesce(F.col("doc_id").cast("long").cast("string"), F.lit(""))
    runs = docs.select(doc_id.alias("doc"), F.explode(F.regexp_extract_all(
        F.col("text").cast("string"), F.lit(RUN), F.lit(0))).alias("run"))
    lowered = runs.select("doc", F.translate("run", UPPER, LOWER).alias("run"))
    hashed = lowered.withColumn("h", F.crc32(F.concat("doc", F.lit(":"), "run").cast("binary")))
    at = F.pmod(F.col("h"), F.length("run")).cast("int")
    cut = F.concat(F.substring("run", F.lit(1), at), F.substring("run", at + 2, F.length("run")))
    words = hashed.select(F.when(F.col("h") % delete_every == 0, cut).otherwise(F.col("run")).alias("word"))
    return words.groupBy("word").agg(F.count(F.lit(1)).alias("n"))


def vocabulary(docs: DataFrame, least_length: int = LEAST_LENGTH, least_count: int = LEAST_COUNT,
               delete_every: int = DELETE_EVERY) -> DataFrame:
    """(word, n) of the words that are compared."""
    long_enough = F.length("word") >= least_length
    return occurrences(docs, delete_every).filter(long_enough).filter(F.col("n") >= least_count)


def _mixed(h: np.ndarray) -> np.ndarray:
    h = (h ^ (h >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    h = (h ^ (h >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return h ^ (h >> np.uint64(31))


def _masks(mixed: np.ndarray) -> np.ndarray:
    """The bits of a block, from the low bits of the hash."""
    found = np.zeros(mixed.shape, np.uint64)
    for i in range(BITS_SET):
        found |= np.uint64(1) << ((mixed >> np.uint64(6 * i)) & np.uint64(63))
    return found


def _blocks(mixed: np.ndarray, blocks: int) -> np.ndarray:
    """The block of the high 32 bits of the hash, dealt evenly over ``blocks``."""
    return ((mixed >> np.uint64(32)) * np.uint64(blocks)) >> np.uint64(32)


def _pass_of(mixed: np.ndarray, passes: int) -> np.ndarray:
    return ((mixed * BASE >> np.uint64(40)) * np.uint64(passes)) >> np.uint64(24)


def _powers(length: int) -> np.ndarray:
    factors = np.full(length + 1, BASE)
    factors[0] = 1
    return np.cumprod(factors, dtype=np.uint64)


def _codes(words: list[str], length: int) -> np.ndarray:
    return np.frombuffer("".join(words).encode("utf-32-le"), np.uint32).reshape(len(words), length).astype(np.uint64)


def word_hashes(words: list[str], length: int) -> np.ndarray:
    """Polynomials of words of one length, mixed."""
    return _mixed((_codes(words, length) * _powers(length)[:length]).sum(axis=1, dtype=np.uint64))


def _by_length(words: list[str]) -> Iterator[tuple[int, list[str]]]:
    found: dict[int, list[str]] = {}
    for w in words:
        found.setdefault(len(w), []).append(w)
    for length, same in found.items():
        for at in range(0, len(same), WORD_BATCH):
            yield length, same[at:at + WORD_BATCH]


def _placer(blocks: dict[int, int], passes: int, now: int):
    """(length, piece, block, mask) of the words of pass ``now``."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for length, words in _by_length(b.column(0).to_pylist()):
                mixed = word_hashes(words, length)
                mixed = mixed[_pass_of(mixed, passes) == now]
                block = _blocks(mixed, blocks[length]).astype(np.int64)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.full(len(block), length, np.int32)), pa.array(block // BUILT_AT_ONCE),
                     pa.array(block), pa.array(_masks(mixed).view(np.int64))], ["length", "piece", "block", "mask"])

    return run


def filters(words: DataFrame, sizes: dict[int, int], passes: int, now: int) -> dict[int, np.ndarray]:
    """The blocks of each length's Bloom filter, for the words of pass ``now``."""
    blocks = {length: max(1, -(-n * BLOOM_BITS // 64 // passes)) for length, n in sizes.items()}
    placed = words.select("word").mapInArrow(
        _placer(blocks, passes, now), "length int, piece long, block long, mask long")
    merged = placed.groupBy("length", "piece", "block").agg(F.bit_or("mask").alias("mask"))
    pieces = merged.groupBy("length", "piece").agg(
        F.array_sort(F.collect_list(F.struct("block", "mask"))).alias("b")).select(
        "length", "b.block", "b.mask")
    found = {length: np.zeros(n, np.uint64) for length, n in blocks.items()}
    for batch in pieces.toArrow().to_batches():  # BLOOM_BITS a word of the pass, and their places
        for length, block, mask in zip(*batch.columns, strict=True):
            found[length.as_py()][block.values.to_numpy()] = mask.values.to_numpy().view(np.uint64)
    return found


def _held(mixed: np.ndarray, blocks: np.ndarray, passes: int, now: int) -> np.ndarray:
    """Whether the filter has the hash; only hashes of pass ``now`` are looked up."""
    masks = _masks(mixed)
    held = (blocks[_blocks(mixed, len(blocks))] & masks) == masks
    return held if passes == 1 else held & (_pass_of(mixed, passes) == now)


def held_edits(words: list[str], length: int, alphabet: np.ndarray, blooms: dict[int, np.ndarray],
               passes: int = 1, now: int = 0) -> tuple[list[int], list[str]]:
    """Places in ``words``, all of one length, and their edits that a filter holds."""
    codes, powers = _codes(words, length), _powers(length)
    terms = codes * powers[:length]
    ends = np.cumsum(terms, axis=1, dtype=np.uint64)
    whole, places, edits = ends[:, -1], [], []
    if length - 1 in blooms:
        before = ends - terms
        shorter = _mixed(before + (whole[:, None] - ends) * BASE_INVERSE)
        held = _held(shorter, blooms[length - 1], passes, now)
        held[:, :-1] &= codes[:, :-1] != codes[:, 1:]  # of a run of equal letters, the last
        for row, at in zip(*(x.tolist() for x in np.nonzero(held)), strict=True):
            places.append(row)
            edits.append(words[row][:at] + words[row][at + 1:])
    for at in range(length):
        replaced = _mixed(whole[:, None] + (alphabet[None, :] - codes[:, at:at + 1]) * powers[at])
        held = _held(replaced, blooms[length], passes, now) & (alphabet[None, :] > codes[:, at:at + 1])
        for row, letter in zip(*(x.tolist() for x in np.nonzero(held)), strict=True):
            places.append(row)
            edits.append(words[row][:at] + chr(int(alphabet[letter])) + words[row][at + 1:])
    return places, edits


def _prober(shared, alphabet: np.ndarray, passes: int, now: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        blooms = shared.value
        for b in batches:
            counts = dict(zip(b.column(0).to_pylist(), b.column(1).to_pylist(), strict=True))
            for length, words in _by_length(list(counts)):
                places, edits = held_edits(words, length, alphabet, blooms, passes, now)
                yield pa.RecordBatch.from_arrays(
                    [pa.array([words[p] for p in places], pa.string()),
                     pa.array([counts[words[p]] for p in places], pa.int64()), pa.array(edits, pa.string())],
                    ["a", "n_a", "b"])

    return run


@contextmanager
def _rows_in_batches(spark: SparkSession):
    """Words are short: hand Python many at a time while the jobs within run."""
    name = "spark.sql.execution.arrow.maxRecordsPerBatch"
    python_tasks(spark)
    before = spark.conf.get(name)
    spark.conf.set(name, "20000")
    try:
        yield
    finally:
        spark.conf.set(name, before)


def near_pairs(words: DataFrame) -> DataFrame:
    """(a, n_a, b, n_b): every two near words of (word, n), once; ``words`` is a written table."""
    spark = words.sparkSession
    folder = scratch_folder(spark)
    letters = words.select(F.explode(F.array_distinct(F.split("word", ""))).alias("c")).filter("c <> ''").distinct()
    alphabet = np.array(sorted(ord(r.c) for r in letters.collect()), np.uint64)  # 90 at most, by the pattern
    sizes = {r.length: r.n for r in words.groupBy(F.length("word").alias("length")).agg(
        F.count(F.lit(1)).alias("n")).collect()}
    passes = max(1, -(-sum(sizes.values()) // PASS_WORDS))
    tasks = int(spark.conf.get("spark.sql.shuffle.partitions"))
    spread = words.repartition(tasks, "word")
    schema = "a string, n_a long, b string"
    with _rows_in_batches(spark):
        for now in range(passes):
            shared = spark.sparkContext.broadcast(filters(words, sizes, passes, now))
            written(spread.mapInArrow(_prober(shared, alphabet, passes, now), schema), folder, f"held{now}")
            shared.destroy()
    found = spark.read.schema(schema).parquet(*(f"{folder}/held{now}" for now in range(passes)))
    return written(found.join(words.selectExpr("word AS b", "n AS n_b"), "b").select("a", "n_a", "b", "n_b"), folder, "pairs")


def forms(words: DataFrame, ratio: int = FORM_RATIO) -> DataFrame:
    """(word, n, n_near, form, form_n): each word's near words, counted, and its form."""
    folder = scratch_folder(words.sparkSession)
    pairs = near_pairs(words)
    both = pairs.unionByName(pairs.selectExpr("b AS a", "n_b AS n_a", "a AS b", "n_a AS n_b"))
    best = both.groupBy("a").agg(
        F.count(F.lit(1)).alias("n_near"), F.min(F.struct((-F.col("n_b")).alias("less"), F.col("b"))).alias("best"))
    best = written(best.selectExpr("a AS word", "n_near", "best.b AS near", "-best.less AS near_n"), folder, "best")
    is_form = F.col("near_n") >= ratio * F.col("n")
    return written(words.join(best, "word", "left").select(
        "word", "n", F.coalesce("n_near", F.lit(0).cast("long")).alias("n_near"),
        F.when(is_form, F.col("near")).alias("form"), F.when(is_form, F.col("near_n")).alias("form_n")), folder, "forms")


def rooted(found: DataFrame) -> DataFrame:
    """``found`` with ``root``, the end of the chain of forms that begins at the word.

    A form occurs ``FORM_RATIO`` times as often as its word, so chains are short; each
    step doubles the distance that is looked ahead.
    """
    folder = scratch_folder(found.sparkSession)
    links = written(found.filter("form IS NOT NULL").selectExpr("word", "form AS root"), folder, "links0")
    step = 0
    while True:
        step += 1
        ahead = links.selectExpr("word AS root", "root AS next")
        moved = links.join(ahead, "root", "left").select("word", F.coalesce("next", "root").alias("root"), "next")
        moved = written(moved, folder, f"links{step}")
        links = moved.select("word", "root")
        if not moved.filter("next IS NOT NULL").count():
            break
    return found.join(links, "word", "left").withColumn("root", F.coalesce("root", "word"))


def variants(docs: DataFrame, least_length: int = LEAST_LENGTH, least_count: int = LEAST_COUNT,
             ratio: int = FORM_RATIO, delete_every: int = DELETE_EVERY) -> DataFrame:
    """(word, n, n_near, form, form_n, root) for each word of the vocabulary."""
    words = written(vocabulary(docs, least_length, least_count, delete_every), scratch_folder(docs.sparkSession), "words")
    return rooted(forms(words, ratio)).select("word", "form", "root", "n", "n_near", "form_n")


def op12_spelling(spark: SparkSession, folder: str) -> DataFrame:
    return variants(table(spark, folder, "documents"))


ORACLE = {"op12_spelling": r"""
WITH RECURSIVE polynomial AS (  -- the table of CRC-32: eight halvings of each byte
  SELECT list(list_reduce(list_prepend(i, range(8)), lambda c, k: CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END) ORDER BY i) AS t
  FROM range(256) AS r(i)),
runs AS (
  SELECT coalesce(CAST(doc_id AS VARCHAR), '') AS doc, translate(run, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS run
  FROM (SELECT doc_id, unnest(regexp_extract_all(text, '[A-Za-z\x{C0}-\x{FF}]+')) AS run FROM documents)),
counted AS (SELECT doc, run, count(*) AS n FROM runs GROUP BY ALL HAVING length(run) >= 7),
hashed AS (
  SELECT run, n, xor(4294967295, list_reduce(list_prepend(4294967295::BIGINT, list_transform(
      string_split(regexp_replace(hex(encode(doc || ':' || run)), '(..)', '\1 ', 'g'), ' ')[1:-2], lambda x: ('0x' || x)::BIGINT)),
      lambda c, b: xor(c >> 8, t[(xor(c, b) & 255) + 1]))) AS h
  FROM counted, polynomial),
words AS (
  SELECT word, CAST(sum(n) AS BIGINT) AS n FROM (
    SELECT n, CASE WHEN h % 31 = 0 THEN left(run, h % length(run)) || substr(run, h % length(run) + 2) ELSE run END AS word FROM hashed)
  WHERE length(word) >= 7 GROUP BY word HAVING sum(n) >= 2),
shorter AS (
  SELECT DISTINCT word, n, k, left(word, k) || substr(word, k + 2) AS rest FROM words, unnest(range(length(word))) AS u(k)),
pairs AS (
  SELECT a.word AS a, b.word AS b, b.n AS n_b FROM shorter a JOIN shorter b ON a.rest = b.rest AND a.k = b.k AND a.word <> b.word
  UNION SELECT a.word, b.word, b.n FROM shorter a JOIN words b ON a.rest = b.word
  UNION SELECT b.word, a.word, a.n FROM shorter a JOIN words b ON a.rest = b.word),
best AS (
  SELECT a, count(DISTINCT b) AS n_near, max(n_b) AS near_n, arg_min(b, (-n_b, encode(b))) AS near FROM pairs GROUP BY a),
found AS (
  SELECT w.word, w.n, coalesce(p.n_near, 0) AS n_near, CASE WHEN p.near_n >= 10 * w.n THEN p.near END AS form,
    CASE WHEN p.near_n >= 10 * w.n THEN p.near_n END AS form_n
  FROM words w LEFT JOIN best p ON w.word = p.a),
chain AS (
  SELECT word, word AS at, form AS next FROM found
  UNION ALL SELECT c.word, c.next, f.form FROM chain c JOIN found f ON f.word = c.next)
SELECT f.word, f.form, c.at AS root, f.n, f.n_near, f.form_n FROM found f JOIN chain c ON c.word = f.word AND c.next IS NULL
"""}
