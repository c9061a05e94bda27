"""The engine's inputs made from the driver's tables, in Spark and as SQL text with the same rows."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from strandline.session import table

#: The sites of a whole text; the same expression in both engines.
SITE_SQL = "translate(lower(coalesce(text, '')), 'abcdefghijklmnopqrstuvwxyz ', 'ACGTACGTACGTACGTACGTACGTACN')"
#: Sites of a stretch, the width of the reference row, which has a gap column every 20 sites.
SITES = 200
REFERENCE = "".join("-" if i % 20 == 19 else "ACGT"[i % 4] for i in range(SITES))


def aligned(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``genotype, record_idx, seq_id, aligned`` of every document, over its whole text; a shorter one lacks the last sites."""
    docs = table(spark, sf_dir, "documents")
    return docs.select(F.col("lang").alias("genotype"), F.col("doc_id").alias("record_idx"), F.col("doc_id").cast("string").alias("seq_id"), F.expr(SITE_SQL).alias("aligned"))


ALIGNED_SQL = f"aligned AS (SELECT lang AS genotype, doc_id AS record_idx, CAST(doc_id AS VARCHAR) AS seq_id, {SITE_SQL} AS aligned FROM documents)"


def stretches(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``genotype, seq_id, aligned`` of every stretch of 200 sites of every document, the last one filled up with gaps."""
    rows = aligned(spark, sf_dir).withColumn("no", F.explode(F.expr(f"sequence(0, greatest(0, (length(aligned) - 1) div {SITES}))")))
    return rows.select("genotype", F.concat_ws(".", "seq_id", "no").alias("seq_id"), F.expr(f"rpad(substr(aligned, cast(no * {SITES} + 1 as int), {SITES}), {SITES}, '-')").alias("aligned"))


STRETCHES_SQL = f"""{ALIGNED_SQL},
stretches AS (SELECT genotype, concat(seq_id, '.', no) AS seq_id, rpad(substr(aligned, no * {SITES} + 1, {SITES}), {SITES}, '-') AS aligned
  FROM (SELECT *, unnest(range(0, greatest(0, (length(aligned) - 1) // {SITES}) + 1)) AS no FROM aligned))"""


def _bits(base: str) -> str:
    return f"CAST(regexp_replace(regexp_replace(sites, '[^{base}]', '0', 'g'), '[{base}]', '1', 'g') AS BIT)"


#: Sites are compared in stretches, so that a short text is not filled up to the longest one.
PAIRS_SQL = f"""{ALIGNED_SQL},
cut AS (SELECT genotype, record_idx, seq_id, no, rpad(substr(aligned, no * 1024 + 1, 1024), 1024, '-') AS sites
  FROM (SELECT *, unnest(range(0, greatest(0, (length(aligned) - 1) // 1024) + 1)) AS no FROM aligned)),
bits AS (SELECT genotype, record_idx, seq_id, no, {', '.join(f'{_bits(b)} AS {b.lower()}_' for b in 'ACGT')}, {_bits('ACGT')} AS v_ FROM cut),
counted AS (
  SELECT a.genotype, a.seq_id AS source, b.seq_id AS target, CAST(sum(bit_count(a.v_ & b.v_)) AS INTEGER) AS comparable_sites,
    CAST(sum(bit_count(a.a_ & b.a_) + bit_count(a.c_ & b.c_) + bit_count(a.g_ & b.g_) + bit_count(a.t_ & b.t_)) AS INTEGER) AS same
  FROM bits a JOIN bits b ON a.genotype = b.genotype AND a.no = b.no AND a.record_idx < b.record_idx GROUP BY ALL),
pairs AS (
  SELECT genotype, source, target, CASE WHEN comparable_sites > 0 THEN (comparable_sites - same) / CAST(comparable_sites AS DOUBLE) ELSE 1.0 END AS distance,
    comparable_sites - same AS snp_count, comparable_sites
  FROM counted)"""

#: Alignment hits of orders: one for each line.
HIT_SQL = """SELECT CAST(l_orderkey AS {text}) AS query_id, concat(l_returnflag, '_', CAST(l_suppkey AS {text}), '.', CAST(l_linenumber AS {text})) AS target_id,
 CASE WHEN l_linenumber % 2 = 0 THEN '-' ELSE '+' END AS strand, CAST(1000 AS BIGINT) AS query_length, CAST(1200 AS BIGINT) AS target_length,
 l_partkey % 500 AS query_start, l_partkey % 500 + CAST(l_quantity AS BIGINT) * 8 AS query_end,
 l_suppkey % 300 AS target_start, l_suppkey % 300 + CAST(l_quantity AS BIGINT) * 8 AS target_end,
 CAST(l_quantity AS BIGINT) * 7 AS matching_bases, CAST(l_quantity AS BIGINT) * 8 AS alignment_block_length, CAST(l_linenumber AS BIGINT) * 10 AS mapq,
 CAST(floor(l_extendedprice / 100.0) AS BIGINT) AS alignment_score, l_linestatus = 'O' AS "primary",
 0.6 + l_quantity / 125.0 AS identity, 0.875 AS block_identity, l_linenumber % 3 <> 0 AS has_de,
 CAST(l_quantity AS BIGINT) * 8 AS query_aligned_bases, CAST(l_quantity AS BIGINT) * 8 / 400.0 AS query_coverage
FROM lineitem"""


def hits(spark: SparkSession, sf_dir: str) -> DataFrame:
    lines = table(spark, sf_dir, "lineitem")
    q = F.col("l_quantity").cast("long")
    return lines.select(
        F.col("l_orderkey").cast("string").alias("query_id"), F.concat("l_returnflag", F.lit("_"), "l_suppkey", F.lit("."), "l_linenumber").alias("target_id"),
        F.when(F.col("l_linenumber") % 2 == 0, "-").otherwise("+").alias("strand"), F.lit(1000).cast("long").alias("query_length"), F.lit(1200).cast("long").alias("target_length"),
        (F.col("l_partkey") % 500).alias("query_start"), (F.col("l_partkey") % 500 + q * 8).alias("query_end"), (F.col("l_suppkey") % 300).alias("target_start"), (F.col("l_suppkey") % 300 + q * 8).alias("target_end"),
        (q * 7).alias("matching_bases"), (q * 8).alias("alignment_block_length"), (F.col("l_linenumber").cast("long") * 10).alias("mapq"),
        F.floor(F.col("l_extendedprice") / 100.0).cast("long").alias("alignment_score"), (F.col("l_linestatus") == "O").alias("primary"),
        (0.6 + F.col("l_quantity") / 125.0).alias("identity"), F.lit(0.875).alias("block_identity"), (F.col("l_linenumber") % 3 != 0).alias("has_de"),
        (q * 8).alias("query_aligned_bases"), (q * 8 / 400.0).cast("double").alias("query_coverage"),
    )


HITS_SQL = "hits AS (" + HIT_SQL.format(text="VARCHAR").replace("/ 400.0 AS query_coverage", "/ CAST(400 AS DOUBLE) AS query_coverage") + ")"
