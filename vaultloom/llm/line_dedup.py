"""Removal of repeated line windows (operator 4). DataFrame functions only.

A text is cut at line feeds; each three consecutive lines are a window. Of the windows
that are equal anywhere (same document included), the first by (document, position)
stays, and the lines of every later one are removed: a line goes if any removed window
covers it, so overlapping windows merge. Windows are judged on the input. Kept lines
are joined by line feeds again.

Windows are compared by 128 bits of their lines. Counting is a minimum by window,
combined in the tasks; windows that occur twice are joined back by a join that the
planner may split by skew; only row numbers return to the texts.

Documents are ordered by doc_id, nulls first, then by their row in the input, so
repeated rows are copies like others and the earlier row stays. Null text: kept as
null. A text of fewer than three lines has no window. A document whose lines are all
removed has an empty text. Extra columns are kept by ``deduplicated`` as they are
(its own columns have names that the input doesn't have). No rows give no rows.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from vaultloom.llm.common import stored_rows, table
from vaultloom.sources.scratch import scratch_folder, written

WINDOW_LINES = 3


def _windows(rows: DataFrame, lines: int) -> DataFrame:
    """(row, at, doc_id, h1, h2) of each window; ``at`` is its first line."""
    # An empty line has the hash of an empty text; both seeds differ in the first argument.
    hashed = rows.select("row", "doc_id", F.split("text", "\n", -1).alias("l")).filter(
        F.size("l") >= lines).select("row", "doc_id", F.transform(
            "l", lambda x: F.struct(F.xxhash64(x).alias("a"), F.xxhash64(F.lit(1), x).alias("b"))).alias("l"))
    at = [F.element_at("l", F.col("i") + 1 + k) for k in range(lines)]
    exploded = hashed.select(
        "row", "doc_id", "l", F.explode(F.sequence(F.lit(0), F.size("l") - lines)).alias("i"))
    return exploded.select(
        "row", "doc_id", F.col("i").alias("at"),
        F.xxhash64(*[x["a"] for x in at]).alias("h1"), F.xxhash64(*[x["b"] for x in at]).alias("h2"))


def removed_lines(rows: DataFrame, lines: int = WINDOW_LINES) -> DataFrame:
    """(row, starts): first lines of the windows of each stored row that are removed."""
    folder = scratch_folder(rows.sparkSession)
    windows = written(_windows(rows, lines), folder, "windows")
    place = F.struct("doc_id", "row", "at")
    repeated = written(
        windows.groupBy("h1", "h2").agg(F.min(place).alias("first"), F.count(F.lit(1)).alias("n"))
        .filter("n > 1").select("h1", "h2", "first"), folder, "repeated")
    later = windows.join(repeated, ["h1", "h2"]).filter(
        ~(F.col("first.row").eqNullSafe(F.col("row")) & (F.col("first.at") == F.col("at"))))
    return later.select("row", "at").groupBy("row").agg(F.collect_list("at").alias("starts"))


def marked(docs: DataFrame, lines: int = WINDOW_LINES) -> DataFrame:
    """Rows of ``docs`` in a struct ``d``, with ``text``, ``l`` (lines) and ``gone``
    (sorted numbers of the removed lines)."""
    rows = stored_rows(docs)
    gone = removed_lines(rows.select("row", "doc_id", "text"), lines).select("row", F.array_sort(
        F.array_distinct(F.flatten(F.transform("starts", lambda s: F.sequence(s, s + lines - 1))))
    ).alias("gone"))
    return rows.join(gone, "row", "left").select(
        "d", "text", F.split("text", "\n", -1).alias("l"),
        F.coalesce("gone", F.array().cast("array<int>")).alias("gone"))


def _kept(lines, gone):
    """Lines whose number isn't in ``gone``, by one pass over both in order."""
    drop = F.map_from_arrays(gone, F.transform(gone, lambda _: F.lit(True)))
    kept = F.filter(lines, lambda _, i: F.element_at(drop, i).isNull())
    return F.when(F.size(gone) == 0, F.array_join(lines, "\n")).otherwise(F.array_join(kept, "\n"))


def deduplicated(docs: DataFrame, lines: int = WINDOW_LINES) -> DataFrame:
    """``docs`` with the removed lines cut from ``text``."""
    found = marked(docs, lines)
    text = F.when(F.size("gone") == 0, F.col("text")).otherwise(_kept(F.col("l"), F.col("gone")))
    return found.select(*[
        (text if c == "text" else F.col("d")[c]).alias(c) for c in docs.columns])


def op4_line_dedup(spark: SparkSession, folder: str) -> DataFrame:
    """Lines, removed lines and the digest of what is kept, per document."""
    found = marked(table(spark, folder, "documents"))
    return found.select(
        F.col("d.doc_id").alias("doc_id"),
        F.when(F.col("text").isNull(), 0).otherwise(F.size("l")).cast("long").alias("n_lines"),
        F.size("gone").cast("long").alias("n_removed"),
        F.md5(_kept(F.col("l"), F.col("gone"))).alias("kept_md5"))


ORACLE = {
    "op4_line_dedup": """
WITH d AS (
  SELECT doc_id, row_number() OVER (ORDER BY doc_id NULLS FIRST) AS rid,
         string_split(text, chr(10)) AS l FROM documents
), w AS (
  SELECT rid, unnest(range(1, len(l) - 1)) AS pos, l FROM d WHERE len(l) >= 3
), k AS (
  SELECT rid, pos, l[pos] || chr(10) || l[pos + 1] || chr(10) || l[pos + 2] AS three FROM w
), later AS (
  SELECT rid, pos FROM (
    SELECT rid, pos, row_number() OVER (PARTITION BY three ORDER BY rid, pos) AS nth FROM k
  ) WHERE nth > 1
), gone AS (
  SELECT DISTINCT rid, unnest([pos, pos + 1, pos + 2]) AS line FROM later
), lines AS (
  SELECT rid, unnest(range(1, len(l) + 1)) AS line, unnest(l) AS content FROM d
), kept AS (
  SELECT rid, string_agg(content, chr(10) ORDER BY line) AS text
  FROM lines ANTI JOIN gone USING (rid, line) GROUP BY rid
), n AS (
  SELECT rid, count(*) AS n_removed FROM gone GROUP BY rid
)
SELECT d.doc_id, CAST(coalesce(len(d.l), 0) AS BIGINT) AS n_lines,
       coalesce(n.n_removed, 0) AS n_removed,
       CASE WHEN d.l IS NOT NULL THEN md5(coalesce(kept.text, '')) END AS kept_md5
FROM d LEFT JOIN n USING (rid) LEFT JOIN kept USING (rid)""",
}
