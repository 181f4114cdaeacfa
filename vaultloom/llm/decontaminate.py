"""Benchmark passages in documents (operator 10). DataFrame functions only.

A document matches an item if one of its windows of as many words as the item has (the
whole document, if shorter) has a weighted-shingle similarity of at least
``SIMILARITY``: the sum of the smaller multiplicities of five-word shingles, divided by
the sum of the larger ones. Words are lower-cased runs of non-blanks.

1. Windows so similar hold at least ``SIMILARITY`` of the item's shingles, at their
   positions, so only windows with that many hits can match; running sums over the
   hits give their starts. Texts without a hit go no further. This loses nothing.
2. Each such window, and each item, gets a 64-bit SimHash of its shingles.
3. The fingerprints are cut in eight blocks of eight bits. Two that differ in at most
   ``RADIUS`` = 23 bits have a block that differs in at most two, so windows meet the
   items of their size under a block and its 37 variants: all within the radius are
   found. At a similarity of 0.8 a bit differs with probability 0.15 at most (mean 9.7
   bits, deviation 2.9), so the radius is over four deviations beyond the mean.
4. The exact similarity decides. The best window of each item is reported, of equally
   good ones the first.

Copies of a text are searched once. The benchmark's shingles are joined by a join that
the planner broadcasts only if they are small. Null or empty texts and items match
nothing. An item of fewer than five words has itself as its one shingle. Repeated rows
of documents, and of items, are all reported. Extra columns are ignored; empty tables
give no rows.
"""

from __future__ import annotations

from itertools import combinations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from vaultloom.llm.common import WORD_BREAK, table
from vaultloom.sources.scratch import scratch_folder, written

SHINGLE_WORDS = 5
SIMILARITY = 0.8
RADIUS = 23
BLOCK_BITS = 8
_FLIPS = RADIUS * BLOCK_BITS // 64


def _words(text):
    return F.filter(F.split(F.lower(text), WORD_BREAK), lambda w: w != "")


def _text_key(text):
    return F.xxhash64(text).alias("h1"), F.xxhash64(F.lit(1), text).alias("h2")


def _shingle_hashes(words, size: int):
    """Hash of each run of ``size`` words; empty where there are too few words."""
    starts = F.when(F.size(words) >= size, F.sequence(F.lit(0), F.size(words) - size)).otherwise(
        F.array().cast("array<int>"))
    return F.transform(starts, lambda i: F.xxhash64(*[F.get(words, i + k) for k in range(size)]))


def _shingles(words, size):
    """Each run of ``size`` (a column) words as text."""
    return F.transform(F.sequence(F.lit(1), F.size(words) - size + 1),
                       lambda i: F.array_join(F.slice(words, i, size), " "))


def _simhash(shingles):
    h = F.transform(shingles, lambda s: F.xxhash64(s))
    bits = F.transform(F.sequence(F.lit(0), F.lit(63)), lambda b: F.when(
        2 * F.aggregate(h, F.lit(0), lambda n, x: n + F.call_function("getbit", x, b)) > F.size(h),
        F.call_function("shiftleft", F.lit(1).cast("long"), b)).otherwise(F.lit(0).cast("long")))
    return F.aggregate(bits, F.lit(0).cast("long"), lambda n, x: n.bitwiseOR(x))


def _blocks(fp: str):
    """(number, value) of each block of a fingerprint."""
    mask = (1 << BLOCK_BITS) - 1
    return F.array(*[F.struct(F.lit(k).alias("k"), F.expr(
        f"cast(shiftright({fp}, {k * BLOCK_BITS}) & {mask} AS int)").alias("v"))
        for k in range(64 // BLOCK_BITS)])


def _near_values(value):
    masks = [0] + [sum(1 << b for b in flips) for n in range(1, _FLIPS + 1)
                   for flips in combinations(range(BLOCK_BITS), n)]
    return F.transform(F.array(*[F.lit(m) for m in masks]), lambda m: value.bitwiseXOR(m))


def _similarity(a, b):
    """Weighted Jaccard similarity of two arrays of shingles, repeats counted."""
    def times(xs, g):
        return F.size(F.filter(xs, lambda x: x == g))

    plain = (F.size(F.array_distinct(a)) == F.size(a)) & (F.size(F.array_distinct(b)) == F.size(b))
    shared = F.when(plain, F.size(F.array_intersect(a, b))).otherwise(F.aggregate(
        F.array_intersect(a, b), F.lit(0), lambda n, g: n + F.least(times(a, g), times(b, g))))
    return shared / (F.size(a) + F.size(b) - shared)


def _items(benchmark: DataFrame) -> DataFrame:
    """(item, item_id, w, size, span): items with words; ``size`` words make a shingle."""
    return benchmark.select(
        F.monotonically_increasing_id().alias("item"), F.col("item_id").cast("long").alias("item_id"),
        _words(F.col("text").cast("string")).alias("w")).filter("size(w) > 0").select(
        "item", "item_id", "w", F.size("w").alias("span"),
        F.least(F.size("w"), F.lit(SHINGLE_WORDS)).alias("size"))


def matches(docs: DataFrame, benchmark: DataFrame, similarity: float = SIMILARITY) -> DataFrame:
    """(h1, h2, item, item_id, start_word, n_words, hamming, similarity) by distinct text.

    h1 and h2 are the text's key, as ``matched_documents`` uses it.
    """
    folder = scratch_folder(docs.sparkSession)
    items = written(_items(benchmark), folder, "items")
    hashed = None
    for size in range(1, SHINGLE_WORDS + 1):
        own = items.filter(F.col("size") == size).select(
            "item", "span", "size", F.posexplode(_shingle_hashes(F.col("w"), size)).alias("at", "h"))
        hashed = own if hashed is None else hashed.unionByName(own)
    hashed = written(hashed, folder, "item_shingles")
    sizes = sorted(r["size"] for r in items.select("size").distinct().collect())  # at most five
    keys = written(hashed.select("size", "h").distinct(), folder, "shingle_keys")

    texts = docs.select(F.col("text").cast("string").alias("text")).filter("text IS NOT NULL").select(
        "text", *_text_key(F.col("text")))

    def shingled(frame, *columns):
        each = [frame.select(*columns, F.lit(size).alias("size"), F.posexplode(
            _shingle_hashes(F.col("w"), size)).alias("pos", "h")) for size in sizes]
        out = each[0] if each else frame.select(
            *columns, F.lit(0).alias("size"), F.lit(0).alias("pos"), F.lit(0).cast("long").alias("h")).limit(0)
        for more in each[1:]:
            out = out.unionByName(more)
        return out

    some = shingled(texts.select("h1", "h2", _words(F.col("text")).alias("w")), "h1", "h2")
    hit = written(some.join(keys, ["size", "h"]).select("h1", "h2").distinct(), folder, "hit")
    found = written(
        texts.join(hit, ["h1", "h2"]).groupBy("h1", "h2").agg(F.first("text").alias("text"))
        .select("h1", "h2", _words(F.col("text")).alias("w")), folder, "found")

    # starts of windows with enough hits: +1 where a window begins to hold a hit, -1 where it ends to
    hits = shingled(found.select("h1", "h2", "w"), "h1", "h2").join(hashed.select(
        "size", "h", "item", "span").distinct(), ["size", "h"])
    edges = hits.select("h1", "h2", "item", "span", "size", F.explode(F.array(
        F.struct((F.col("pos") - F.col("span") + F.col("size")).alias("s"), F.lit(1).alias("d")),
        F.struct((F.col("pos") + 1).alias("s"), F.lit(-1).alias("d")))).alias("e"))
    place = Window.partitionBy("h1", "h2", "item").orderBy("s")
    held = (
        edges.groupBy("h1", "h2", "item", "span", "size", F.col("e.s").alias("s"))
        .agg(F.sum("e.d").alias("d"))
        .select("h1", "h2", "item", "span", "size", "s", F.sum("d").over(place).alias("n"),
                F.lead("s").over(place).alias("until"))
        .filter(F.col("n") > 0))
    # a shorter document has one window: its hits must be the same share of the item's shingles
    windows = (
        held.join(found.select("h1", "h2", "w"), ["h1", "h2"])
        .withColumn("last", F.greatest(F.lit(0), F.size("w") - F.col("span")))
        .filter(F.col("n") >= similarity * (F.col("span") - F.col("size") + 1))
        .select("h1", "h2", "w", "span", "size", F.explode(F.sequence(
            F.least(F.greatest("s", F.lit(0)), F.col("last")),
            F.least(F.greatest(F.col("until") - 1, F.lit(0)), F.col("last")))).alias("start"))
        .select("h1", "h2", "span", "size", "start",
                F.slice("w", F.col("start") + 1, F.col("span")).alias("w")).filter("size(w) >= size")
        .dropDuplicates(["h1", "h2", "span", "start"]))
    windows = written(
        windows.withColumn("shingles", _shingles(F.col("w"), F.col("size")))
        .select("*", _simhash(F.col("shingles")).alias("fp")).drop("w"), folder, "windows")
    targets = written(
        items.withColumn("target", _shingles(F.col("w"), F.col("size")))
        .select("item", "item_id", "span", "target", _simhash(F.col("target")).alias("item_fp")),
        folder, "targets")

    blocked = windows.select("h1", "h2", "span", "start", "fp", F.explode(_blocks("fp")).alias("b")).select(
        "h1", "h2", "span", "start", "fp", "b.k", "b.v")
    index = targets.select("item", "span", "item_fp", F.explode(_blocks("item_fp")).alias("b")).select(
        "item", "span", "item_fp", "b.k", F.explode(_near_values(F.col("b.v"))).alias("v"))
    close = (
        blocked.join(index, ["span", "k", "v"])
        .withColumn("hamming", F.bit_count(F.col("fp").bitwiseXOR(F.col("item_fp"))))
        .filter(F.col("hamming") <= RADIUS)
        .select("h1", "h2", "span", "start", "item", "hamming").distinct())
    verified = (
        close.join(windows.select("h1", "h2", "span", "start", "shingles"), ["h1", "h2", "span", "start"])
        .join(targets.select("item", "item_id", "target"), "item")
        .withColumn("similarity", _similarity(F.col("shingles"), F.col("target")))
        .filter(F.col("similarity") >= similarity))
    best = F.max(F.struct("similarity", (-F.col("start")).alias("from"), "hamming", F.size("shingles").alias("n"),
                          F.col("span"))).alias("b")
    return written(verified.groupBy("h1", "h2", "item", "item_id").agg(best).select(
        "h1", "h2", "item", "item_id", (-F.col("b.from")).alias("start_word"),
        (F.col("b.n") + F.least(F.col("b.span"), F.lit(SHINGLE_WORDS)) - 1).alias("n_words"),
        F.col("b.hamming").cast("int").alias("hamming"), "b.similarity"), folder, "matches")


def matched_documents(docs: DataFrame, benchmark: DataFrame, similarity: float = SIMILARITY) -> DataFrame:
    """(doc_id, item_id, start_word, n_words, hamming, similarity) of each document and item."""
    found = matches(docs, benchmark, similarity)
    keyed = docs.select(F.col("doc_id").cast("long").alias("doc_id"), *_text_key(F.col("text").cast("string")))
    return keyed.join(found, ["h1", "h2"]).select(
        "doc_id", "item_id", "start_word", "n_words", "hamming", "similarity")


def clean_documents(docs: DataFrame, benchmark: DataFrame, similarity: float = SIMILARITY) -> DataFrame:
    """The rows of ``docs`` that match no item."""
    bad = matches(docs, benchmark, similarity).select(
        F.col("h1").alias("_bad1"), F.col("h2").alias("_bad2")).distinct()
    h1, h2 = (c for c in _text_key(F.col("text").cast("string")))
    return docs.join(bad, (h1 == bad["_bad1"]) & (h2 == bad["_bad2"]), "left_anti")


def op10_decontaminate(spark: SparkSession, folder: str) -> DataFrame:
    return matched_documents(table(spark, folder, "documents"), table(spark, folder, "benchmark")).select(
        "doc_id", "item_id", "start_word", "n_words", F.round("similarity", 9).alias("similarity"))


ORACLE = {
    "op10_decontaminate": r"""
WITH d AS (
  SELECT row_number() OVER () AS rid, doc_id,
         list_filter(regexp_split_to_array(lower(text), '[\x20\x09-\x0D]+'), lambda x: x <> '') AS w FROM documents
), b AS (
  SELECT row_number() OVER () AS item, item_id,
         list_filter(regexp_split_to_array(lower(text), '[\x20\x09-\x0D]+'), lambda x: x <> '') AS w FROM benchmark
), i AS (
  SELECT *, len(w) AS span, least(len(w), 5) AS size FROM b WHERE len(w) > 0
), ishin AS (
  SELECT item, span, size, unnest(list_transform(range(1, span - size + 2), lambda p: array_to_string(w[p:p + size - 1], ' '))) AS g
  FROM i
), icount AS (
  SELECT item, g, count(*) AS n FROM ishin GROUP BY ALL
), sizes AS (SELECT DISTINCT size FROM i), dpos AS (
  SELECT rid, size, w, unnest(range(1, len(w) - size + 2)) AS p FROM d, sizes WHERE len(w) >= size
), dshin AS (
  SELECT rid, size, p, array_to_string(w[p:p + size - 1], ' ') AS g FROM dpos
), hits AS (
  SELECT DISTINCT rid, item, span, dshin.size, p FROM dshin JOIN ishin ON dshin.g = ishin.g AND dshin.size = ishin.size
), starts AS (
  SELECT DISTINCT h.rid, item, span, size,
         unnest(range(least(greatest(1, p - span + size), greatest(1, len(d.w) - span + 1)),
                      least(p, greatest(1, len(d.w) - span + 1)) + 1)) AS s
  FROM hits h JOIN d USING (rid)
), wcount AS (
  SELECT s.rid, item, span, s.size, s, g, count(*) AS n
  FROM starts s JOIN dshin x ON x.rid = s.rid AND x.size = s.size AND x.p BETWEEN s AND s + span - s.size
  GROUP BY ALL
), sim AS (
  SELECT w.rid, w.item, w.s, w.span, w.size, sum(w.n) AS wn,
         sum(least(w.n, coalesce(c.n, 0))) AS shared
  FROM wcount w LEFT JOIN icount c ON c.item = w.item AND c.g = w.g GROUP BY ALL
), best AS (
  SELECT *, shared / (wn + span - size + 1 - shared) AS similarity FROM sim
), top AS (
  SELECT *, row_number() OVER (PARTITION BY rid, item ORDER BY similarity DESC, s) AS nth
  FROM best WHERE similarity >= 0.8
)
SELECT doc_id, item_id, CAST(s - 1 AS INTEGER) AS start_word, CAST(wn + top.size - 1 AS INTEGER) AS n_words,
       round(similarity, 9) AS similarity
FROM top JOIN d USING (rid) JOIN i USING (item) WHERE nth = 1""",
}
