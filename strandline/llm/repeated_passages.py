"""Repeated passages by a sparse suffix array.

Only suffixes that start at minimiser positions are kept: of every ``window`` consecutive k-word grams the one with the
smallest hash. Two occurrences of a passage of ``least_words >= k + window - 1`` words keep the same suffixes, since the
choice depends on the words alone. The kept suffixes are sorted over the whole corpus by their first k words and what
follows, neighbours are compared, and suffixes that share k words with no neighbour are dropped. The rest are extended to
both sides. Every window of ``least_words`` words has one minimiser, its anchor, so the windows of an anchor are how far
a match can reach left and right of it. Suffixes whose whole reach has equal words are settled at once; only at the ends of
a match are single windows compared. Both compare 128-bit MD5 digests of the words, spelled out; 64-bit hashes only choose
the suffixes. A word is repeated if and only if it lies in a run of ``least_words`` words that occurs at least twice.

Nothing is compared pair by pair: a passage in a third of all documents costs rows in proportion to its occurrences,
reduced by partial counts.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from strandline.llm._tokens import Chunk, chunks, grams, run_hash, runs, words
from strandline.session import materialise, ship_code, table

LEAST_WORDS = 50
GRAM = 20


def anchors(g: np.ndarray, window: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """``(position, first, count)``: each minimiser and the run of windows it is the leftmost smallest gram of."""
    n = len(g) - window + 1
    if n <= 0:
        return (np.zeros(0, np.int64),) * 3
    at = np.argmin(np.lib.stride_tricks.sliding_window_view(g, window), axis=1) + np.arange(n)
    first = np.flatnonzero(np.r_[True, at[1:] != at[:-1]])
    return at[first], first, np.diff(np.r_[first, n])


def _document(chunk: Chunk, hashes: np.ndarray, bounds: np.ndarray, i: int, least: int, k: int) -> tuple:
    h = hashes[bounds[i] : bounds[i + 1]]
    g = grams(h, k)
    return h, g, *anchors(g, least - k + 1)


def _suffixes(least: int, k: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for chunk in chunks(batch.column(1)):
                ids = batch.column(0).slice(chunk.first, chunk.n)
                w = words(chunk)
                row, key, after, first = [], [], [], []
                for i in np.flatnonzero(np.diff(w.bounds) >= least):
                    h, g, at, start, _ = _document(chunk, w.hash, w.bounds, i, least, k)
                    prefix = run_hash(h)
                    row.append(np.full(len(at), i))
                    key.append(g[at])
                    after.append(runs(prefix, at, np.minimum(at + least, len(h))))
                    first.append(start)
                if row:
                    row, key, after, first = (np.concatenate(x) for x in (row, key, after, first))
                    yield pa.RecordBatch.from_arrays([ids.take(pa.array(row)), pa.array(key.view(np.int64)), pa.array((after >> np.uint64(33)).astype(np.int32)), pa.array(first.astype(np.int32))], names=["doc_id", "key", "after", "first"])

    return run


def _neighbours(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Sorted suffixes that share their key with the one before or after; a batch's ends are always kept."""
    for batch in batches:
        key = batch.column("key").to_numpy()
        same = key[1:] == key[:-1]
        keep = np.r_[True, same] | np.r_[same, True]
        yield batch.filter(pa.array(keep)).select(["doc_id", "key", "first"])


def _extend(least: int, k: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            wanted = batch.column(2)
            for chunk in chunks(batch.column(1)):
                ids = batch.column(0).slice(chunk.first, chunk.n)
                w = words(chunk)
                row, key, first, count, spelled = [], [], [], [], []
                for i in range(chunk.n):
                    _, g, at, start, size = _document(chunk, w.hash, w.bounds, i, least, k)
                    chosen = np.isin(start, wanted[chunk.first + i].values.to_numpy())
                    at, start, size = at[chosen], start[chosen], size[chosen]
                    if not len(at):
                        continue
                    own = chunk.data[chunk.offsets[i] : chunk.offsets[i + 1]].tobytes().lower().split()
                    row.append(np.full(len(at), i))
                    key.append(g[at])
                    first.append(start)
                    count.append(size)
                    spelled += [b" ".join(own[x : x + n - 1 + least]) for x, n in zip(start.tolist(), size.tolist(), strict=True)]
                if row:
                    row, key, first, count = (np.concatenate(x) for x in (row, key, first, count))
                    yield pa.RecordBatch.from_arrays([ids.take(pa.array(row)), pa.array(key.view(np.int64)), pa.array(first.astype(np.int32)), pa.array(count.astype(np.int32)), pa.array(spelled, pa.binary()).cast(pa.string())], names=["doc_id", "key", "first", "count", "words"])

    return run


def repeated_windows(docs: DataFrame, least_words: int = LEAST_WORDS, k: int = GRAM) -> DataFrame:
    """``doc_id, start, end``: word runs (end exclusive) covered by windows that occur at least twice; they may overlap."""
    ship_code(docs.sparkSession)
    if least_words < k:
        raise ValueError("least_words must be at least k")
    texts = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text")).filter("doc_id is not null and length(text) >= %d" % (2 * least_words - 1))
    kept = materialise(texts.mapInArrow(_suffixes(least_words, k), "doc_id long, key long, after int, first int"), "suffixes")
    array = kept.repartitionByRange("key", "after", "doc_id", "first").sortWithinPartitions("key", "after")
    near = array.mapInArrow(_neighbours, "doc_id long, key long, first int")
    per_doc = near.groupBy("doc_id").agg(F.collect_list("first").alias("firsts"))
    extended = texts.join(per_doc, "doc_id").select("doc_id", "text", "firsts").mapInArrow(_extend(least_words, k), "doc_id long, key long, first int, count int, words string")
    found = materialise(extended.withColumn("reach", F.unhex(F.md5("words"))), "reach")
    reach = found.groupBy("key", "reach").agg(F.count("*").alias("n"), F.min(F.struct("doc_id", "first")).alias("one"))
    reach = reach.select("key", "reach", "n", F.col("one.doc_id").alias("doc_id"), F.col("one.first").alias("first"))
    reach = materialise(reach, "reaches")
    whole = found.select("doc_id", "key", "reach", "first", "count").join(reach.filter("n > 1").select("key", "reach"), ["key", "reach"])
    whole = whole.select("doc_id", F.col("first").alias("start"), (F.col("first") + F.col("count") - 1 + least_words).alias("end"))
    mixed = reach.groupBy("key").agg(F.count("*").alias("kinds")).filter("kinds > 1").select("key")
    ones = reach.join(mixed, "key").select("key", "reach", "doc_id", "first", "n")
    # the outer transform is over one array, so that a reach is split into its words once and not for every window
    windows = lambda spelled: F.transform(F.sequence(F.lit(0), F.col("count") - 1), lambda at: F.unhex(F.md5(F.array_join(F.slice(spelled, at + 1, least_words), " "))))
    edges = found.join(ones, ["key", "reach", "doc_id", "first"])
    edges = edges.select("doc_id", "first", "n", F.posexplode(F.get(F.transform(F.array(F.split("words", " ")), windows), F.lit(0))).alias("at", "window"))
    edges = materialise(edges.select("doc_id", (F.col("first") + F.col("at")).alias("start"), "n", "window"), "windows")
    twice = edges.groupBy("window").agg(F.sum("n").alias("n")).filter("n > 1").select("window")
    part = edges.filter("n = 1").join(twice, "window").select("doc_id", "start", (F.col("start") + least_words).alias("end"))
    return whole.unionByName(part)


def merged_spans(spans: DataFrame) -> DataFrame:
    """``doc_id, start, end``: the union of overlapping or touching spans of each document."""
    order = Window.partitionBy("doc_id").orderBy("start", "end")
    reach = spans.withColumn("_before", F.max("end").over(order.rowsBetween(Window.unboundedPreceding, -1)))
    island = reach.withColumn("_island", F.sum(F.when(F.col("start") <= F.col("_before"), 0).otherwise(1)).over(order.rowsBetween(Window.unboundedPreceding, 0)))
    return island.groupBy("doc_id", "_island").agg(F.min("start").alias("start"), F.max("end").alias("end")).drop("_island")


def repeated_passages(docs: DataFrame, least_words: int = LEAST_WORDS, k: int = GRAM) -> DataFrame:
    """``doc_id, n_passages, n_repeated_words, spans``: one row per document with a repeated passage.

    A passage is a run of at least ``least_words`` words (between ASCII white space, A-Z lower-cased) that occurs at
    least twice, in other documents or in the same one; ``spans`` lists the merged runs as ``start-end`` in words, end
    exclusive, in order. Null, empty and shorter texts have none. Rows without doc_id are left out; rows that repeat a
    doc_id count as two texts and share one result row. Other columns are ignored.
    """
    spans = merged_spans(repeated_windows(docs, least_words, k))
    each = spans.groupBy("doc_id").agg(F.count("*").alias("n_passages"), F.sum(F.col("end") - F.col("start")).alias("n_repeated_words"), F.sort_array(F.collect_list(F.struct("start", "end"))).alias("s"))
    return each.select("doc_id", "n_passages", "n_repeated_words", F.array_join(F.transform("s", lambda x: F.concat_ws("-", x["start"], x["end"])), ",").alias("spans"))


def op7_repeated_passages(spark: SparkSession, sf_dir: str) -> DataFrame:
    return repeated_passages(table(spark, sf_dir, "documents"))


SQL = r"""
WITH words AS (
  SELECT doc_id, list_filter(string_split_regex(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[\x20\x09-\x0D]+'), lambda x: x <> '') AS w
  FROM documents),
starts AS (SELECT doc_id, w, unnest(range(1, len(w) - 48)) AS i FROM words WHERE len(w) >= 50),
windows AS (SELECT doc_id, i - 1 AS start, md5(array_to_string(w[i:i + 49], ' ')) AS h FROM starts),
hits AS (SELECT doc_id, start FROM (SELECT *, count(*) OVER (PARTITION BY h) AS n FROM windows) WHERE n > 1),
islands AS (
  SELECT doc_id, start, sum(fresh) OVER (PARTITION BY doc_id ORDER BY start) AS island FROM (
    SELECT DISTINCT doc_id, start, CASE WHEN start - lag(start) OVER (PARTITION BY doc_id ORDER BY start) <= 50 THEN 0 ELSE 1 END AS fresh FROM hits)),
spans AS (SELECT doc_id, min(start) AS s, max(start) + 50 AS e FROM islands GROUP BY doc_id, island)
SELECT doc_id, count(*) AS n_passages, CAST(sum(e - s) AS BIGINT) AS n_repeated_words,
  string_agg(s || '-' || e, ',' ORDER BY s) AS spans
FROM spans GROUP BY doc_id
"""
