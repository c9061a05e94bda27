"""Line deduplication over overlapping windows of three consecutive lines."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from strandline.session import materialise, table

LINES = 3


def _lines(text: Column) -> Column:
    return F.split(text, "\n")


def _windows(docs: DataFrame, size: int) -> DataFrame:
    """``id, version, pos, a, b``: a 128-bit hash of every window that is not blank."""
    parts = docs.select(F.col("doc_id").cast("long").alias("id"), F.xxhash64("text").alias("version"), _lines(F.col("text")).alias("l")).filter(f"id is not null and size(l) >= {size}")
    window = F.transform(F.sequence(F.lit(1), F.size("l") - size + 1), lambda i: F.slice("l", i, size))
    each = parts.select("id", "version", F.posexplode(window).alias("pos", "w"))
    joined = F.array_join("w", "\n")
    return each.filter(F.trim(F.array_join("w", "")) != "").select("id", "version", "pos", F.xxhash64(joined).alias("a"), F.xxhash64(F.lit("second"), joined).alias("b"))


def covered_lines(docs: DataFrame, size: int = LINES) -> DataFrame:
    """``id, version, covered``: the line numbers, from 1, under a window that has occurred before.

    The first occurrence is the one with the smallest (doc_id, position). Counts and first places come from a partial
    aggregate, so a window in a third of all documents is one row per map task; its occurrences join back to a single
    row, which adaptive execution may split.
    """
    # cut here: both sides of the join below read the windows
    windows = materialise(_windows(docs, size), "windows")
    first = windows.groupBy("a", "b").agg(F.count("*").alias("n"), F.min(F.struct("id", "version", "pos")).alias("first")).filter("n > 1").drop("n")
    later = windows.join(first, ["a", "b"]).filter(F.struct("id", "version", "pos") != F.col("first"))
    marks = later.select("id", "version", F.explode(F.sequence(F.col("pos") + 1, F.col("pos") + size)).alias("line"))
    return marks.groupBy("id", "version").agg(F.sort_array(F.collect_set("line")).alias("covered"))


def dedup_lines(docs: DataFrame, size: int = LINES) -> DataFrame:
    """``docs`` with later occurrences of repeated line windows removed from ``text``, plus ``n_lines``, ``n_removed``.

    A window is ``size`` consecutive lines, compared by 128 bits of hashes; windows of blank lines only are no repeats. Lines under any
    window that occurred before, in an earlier doc_id or further up, go; overlapping windows are merged. A text that
    loses all its lines becomes empty. Null stays null, with 0 lines; an empty text is one line. Rows without doc_id are
    left as they are and take no part. Rows that repeat both doc_id and text are one occurrence. Columns named
    ``n_lines`` or ``n_removed`` are replaced; other columns stay.
    """
    docs = docs.drop("n_lines", "n_removed")
    # the caller's row goes along as one struct, so that none of its columns can be taken for one of these
    rows = docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row"))
    out = rows.join(covered_lines(docs, size), (F.col("row.doc_id") == F.col("id")) & (F.xxhash64("row.text") == F.col("version")), "left")
    out = out.select("row", "covered", _lines(F.col("row.text")).alias("lines"))
    kept = F.array_except(F.sequence(F.lit(1), F.size("lines")), F.col("covered"))
    clean = F.array_join(F.transform(kept, lambda i: F.element_at("lines", i)), "\n")
    return out.select(
        *[F.when(F.col("covered").isNull(), F.col("row.text")).otherwise(clean).alias("text") if c == "text" else F.col("row")[c].alias(c) for c in docs.columns],
        F.when(F.col("row.text").isNull(), 0).otherwise(F.size("lines")).cast("long").alias("n_lines"),
        F.coalesce(F.size("covered"), F.lit(0)).cast("long").alias("n_removed"),
    )


def op6_line_windows(spark: SparkSession, sf_dir: str) -> DataFrame:
    return dedup_lines(table(spark, sf_dir, "documents").select("doc_id", "text"))


SQL = r"""
WITH l AS (SELECT doc_id, text, string_split(text, chr(10)) AS l FROM documents),
w AS (
  SELECT doc_id, i AS pos, l[i:i + 2] AS w FROM (SELECT doc_id, l, unnest(range(1, len(l) - 1)) AS i FROM l WHERE len(l) >= 3)),
marked AS (
  SELECT doc_id, pos, row_number() OVER (PARTITION BY w ORDER BY doc_id, pos) AS nth FROM w WHERE trim(array_to_string(w, '')) <> ''),
gone AS (
  SELECT doc_id, list(DISTINCT line) AS covered FROM (SELECT doc_id, unnest(range(pos, pos + 3)) AS line FROM marked WHERE nth > 1) GROUP BY doc_id)
SELECT doc_id,
  CASE WHEN covered IS NULL THEN text
    ELSE array_to_string(list_filter(l, lambda x, i: NOT list_contains(covered, i)), chr(10)) END AS text,
  CASE WHEN text IS NULL THEN 0 ELSE CAST(len(l) AS BIGINT) END AS n_lines,
  CAST(coalesce(len(covered), 0) AS BIGINT) AS n_removed
FROM l LEFT JOIN gone USING (doc_id)
"""
