"""Filter interaction audit: what each of five filters removes, in every order they could be applied in.

A document's failures are a mask of five bits. Four bits depend on the text alone; the fifth, a repeat of an earlier
document's text, needs the smallest doc_id of each text. Counts of the 32 masks by part say all that the 120 orders need, so
the orders are worked out from the counts and no document is read again.
"""

from __future__ import annotations

from itertools import permutations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from strandline.session import table

FILTERS = "ABCDE"
LEAST_WORDS, LEAST_DISTINCT, MOST_CAPITALS, MARKS = 100, 80, 10, "[#$%&*|]"
REPEAT = 1 << FILTERS.index("E")


def _bit(letter: str, failed: Column) -> Column:
    return F.when(failed, 1 << FILTERS.index(letter)).otherwise(0)


def text_masks(docs: DataFrame) -> DataFrame:
    """``doc_id, part, digest, mask`` of every row: the failures A to D, and a SHA-256 of the text to find repeats by."""
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce(F.col("lang").cast("string"), F.lit("")).alias("part"), F.coalesce(F.col("text").cast("string"), F.lit("")).alias("t"))
    # two steps, so that the words are made once; capitals are what is left when long runs of others go
    rows = rows.select("doc_id", "part", "t", F.array_remove(F.split("t", r"[\x20\x09-\x0D]+"), "").alias("w"))
    capitals = F.length(F.regexp_replace("t", "[^A-Z]+", ""))
    mask = (
        _bit("A", F.size("w") < LEAST_WORDS)
        + _bit("B", 100 * F.size(F.array_distinct("w")) < LEAST_DISTINCT * F.size("w"))
        + _bit("C", capitals.cast("long") * 100 > F.length("t").cast("long") * MOST_CAPITALS)
        + _bit("D", F.col("t").rlike(MARKS))
    )
    return rows.select("doc_id", "part", F.unhex(F.sha2("t", 256)).alias("digest"), mask.alias("mask"))


def mask_histogram(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """``part, mask, n, good, toxic``: documents by the filters they fail, 32 cells for each part at most.

    Rows that repeat a doc_id with the same text are counted first, so a text's first document may be several rows. From there
    on a text is one row for each part, mask and label, however many copies it has: no copy group meets in one task.
    """
    # rows without doc_id have no label; a number from the text spreads them over the join
    rows = text_masks(docs).select(F.coalesce("doc_id", F.xxhash64("digest")).alias("key"), F.col("doc_id").isNotNull().alias("known"), "digest", "part", "mask")
    once = rows.groupBy("known", "key", "digest", "part", "mask").agg(F.count("*").alias("n"))
    marks = labels.filter("doc_id is not null").groupBy(F.col("doc_id").cast("long").alias("key")).agg(F.max(F.coalesce(F.col("quality") == 1, F.lit(False))).alias("good"), F.max(F.coalesce(F.col("toxic") == 1, F.lit(False))).alias("bad"))
    marked = once.join(marks.withColumn("known", F.lit(True)), ["known", "key"], "left").withColumns({c: F.coalesce(c, F.lit(False)) for c in ("good", "bad")})
    texts = marked.groupBy("known", "digest", "part", "mask", "good", "bad").agg(F.sum("n").alias("n"), F.min(F.struct("key", "n")).alias("head"))
    least = F.min(F.when(F.col("known"), F.col("head.key"))).over(Window.partitionBy("digest"))
    texts = texts.withColumn("least", least)
    passed = F.when(~F.col("known"), F.col("n")).when(F.col("head.key") == F.col("least"), F.col("head.n")).otherwise(F.lit(0))
    split = F.array(F.struct(F.col("mask").alias("m"), passed.alias("k")), F.struct((F.col("mask") + REPEAT).alias("m"), (F.col("n") - passed).alias("k")))
    cells = texts.select("part", "good", "bad", F.explode(split).alias("c")).select("part", F.col("c.m").alias("mask"), F.col("c.k").alias("k"), "good", "bad")
    return cells.groupBy("part", "mask").agg(F.sum("k").alias("n"), F.sum(F.when(F.col("good"), F.col("k")).otherwise(0)).alias("good"), F.sum(F.when(F.col("bad"), F.col("k")).otherwise(0)).alias("toxic"))


def audit(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """One row for each part, order of the five filters and step, with what that step does to the part's documents.

    Columns ``part, filter_order, step, kept, removed, redundant, unique_fails, good_lost, toxic_lost, shapley``. A null text is
    an empty one and a null language the part ``''``. A document whose text an earlier doc_id has fails E in whatever part
    that one is; rows of one doc_id and text are no repeats of each other. A row without doc_id neither fails E nor makes
    others fail, and has no label. Of repeated labels any with the value 1 counts; null ones do not. Other columns are not
    read. Without documents there are no parts and no rows.

    ``shapley`` is the sum over all orders: where k filters fail a document, each is the first of them in 120 / k orders.
    """
    cells = mask_histogram(docs, labels).groupBy("part").agg(F.collect_list(F.struct("mask", "n", "good", "toxic")).alias("cells"))  # 32 at most
    orders = F.split(F.lit(" ".join(map("".join, permutations(FILTERS)))), " ")
    steps = cells.select("part", "cells", F.explode(orders).alias("filter_order")).select("*", F.explode(F.sequence(F.lit(1), F.lit(len(FILTERS)))).alias("step"))
    bits = f"(x -> cast(pow(2, instr('{FILTERS}', x) - 1) as int))"
    steps = steps.withColumn("before", F.expr(f"aggregate(transform(slice(split(filter_order, ''), 1, step - 1), {bits}), 0, (a, b) -> a + b)"))
    steps = steps.withColumn("bit", F.expr(f"transform(array(substr(filter_order, step, 1)), {bits})[0]"))
    total = lambda value, where: F.expr(f"aggregate(filter(cells, c -> {where}), 0L, (a, c) -> a + {value})")
    here = "c.mask & bit <> 0 and c.mask & before = 0"
    return steps.select(
        "part", "filter_order", F.col("step").cast("int").alias("step"), total("c.n", "c.mask & (before | bit) = 0").alias("kept"), total("c.n", here).alias("removed"),
        total("c.n", "c.mask & bit <> 0 and c.mask & before <> 0").alias("redundant"), total("c.n", "c.mask = bit").alias("unique_fails"), total("c.good", here).alias("good_lost"), total("c.toxic", here).alias("toxic_lost"),
        total("c.n * (120 div bit_count(c.mask))", "c.mask & bit <> 0").alias("shapley"),
    )


def op13_filter_audit(spark: SparkSession, sf_dir: str) -> DataFrame:
    return audit(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def _sql() -> str:
    orders = ", ".join(f"('{''.join(o)}')" for o in permutations(FILTERS))
    return rf"""
WITH w AS (SELECT doc_id, coalesce(lang, '') AS part, coalesce(text, '') AS t, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS w FROM documents),
d AS (SELECT doc_id, part,
  CASE WHEN len(w) < {LEAST_WORDS} THEN 'A' ELSE '' END || CASE WHEN 100 * len(list_distinct(w)) < {LEAST_DISTINCT} * len(w) THEN 'B' ELSE '' END ||
  CASE WHEN 100 * length(regexp_replace(t, '[^A-Z]', '', 'g')) > {MOST_CAPITALS} * length(t) THEN 'C' ELSE '' END || CASE WHEN regexp_matches(t, '{MARKS}') THEN 'D' ELSE '' END ||
  CASE WHEN doc_id > min(doc_id) OVER (PARTITION BY t) THEN 'E' ELSE '' END AS fails FROM w),
l AS (SELECT doc_id, max(quality = 1) AS good, max(toxic = 1) AS bad FROM labels GROUP BY doc_id),
c AS (SELECT part, fails, count(*) AS n, count(*) FILTER (good) AS good, count(*) FILTER (bad) AS bad FROM d LEFT JOIN l USING (doc_id) GROUP BY ALL),
s AS (SELECT filter_order, step, substr(filter_order, step, 1) AS f, substr(filter_order, 1, step - 1) AS earlier
  FROM (SELECT filter_order, unnest([1, 2, 3, 4, 5]) AS step FROM (VALUES {orders}) o(filter_order))),
x AS (SELECT part, filter_order, step, f, fails, n, good, bad, contains(fails, f) AS fits, fails <> '' AND translate(fails, earlier, '') <> fails AS gone FROM c, s),
r AS (SELECT part, filter_order, step, f, coalesce(sum(n) FILTER (NOT gone AND NOT fits), 0) AS kept, coalesce(sum(n) FILTER (fits AND NOT gone), 0) AS removed, coalesce(sum(n) FILTER (fits AND gone), 0) AS redundant,
  coalesce(sum(n) FILTER (fails = f), 0) AS unique_fails, coalesce(sum(good) FILTER (fits AND NOT gone), 0) AS good_lost, coalesce(sum(bad) FILTER (fits AND NOT gone), 0) AS toxic_lost FROM x GROUP BY ALL)
SELECT part, filter_order, CAST(step AS INTEGER) AS step, CAST(kept AS BIGINT) AS kept, CAST(removed AS BIGINT) AS removed, CAST(redundant AS BIGINT) AS redundant, CAST(unique_fails AS BIGINT) AS unique_fails,
  CAST(good_lost AS BIGINT) AS good_lost, CAST(toxic_lost AS BIGINT) AS toxic_lost, CAST(sum(removed) OVER (PARTITION BY part, f) AS BIGINT) AS shapley FROM r"""


SQL = _sql()
