"""Queries that write a table in one of the file formats and read it back, and the SQL that says what must come back."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from strandline.functions import sequence as fn
from strandline.operators import genotyping
from strandline.plans.proxies import hits
from strandline.session import scratch_path, table
from strandline.sources import genbank, readers, writers


def fasta_round_trip(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").filter("text is not null")
    records = docs.select(F.col("doc_id").alias("record_idx"), F.concat("doc_id", F.lit(" lang="), "lang").alias("header"), fn.normalized_input(F.col("text")).alias("sequence"))
    writers.write_fasta(records, path := scratch_path(spark, "fasta"))
    back = readers.read_fasta(spark, path, strict=True, unique="header")
    return back.select("seq_id", "header", F.length("sequence").alias("n_sites"), F.sha2("sequence", 256).alias("sequence_sha256"))


FASTA_SQL = r"""
WITH k AS (SELECT doc_id, lang, translate(translate(regexp_replace(text, '\s+', '', 'g'), 'abcdefghijklmnopqrstuvwxyz', 'ABCDEFGHIJKLMNOPQRSTUVWXYZ'), 'U', 'T') AS k FROM documents WHERE text IS NOT NULL),
s AS (SELECT doc_id, lang, regexp_replace(regexp_replace(k, '[-.]', '', 'g'), '[^ACGTRYSWKMBDHVN]', 'N', 'g') AS s FROM k)
SELECT CAST(doc_id AS VARCHAR) AS seq_id, doc_id || ' lang=' || lang AS header, CAST(length(s) AS INTEGER) AS n_sites, sha256(s) AS sequence_sha256 FROM s"""


def genbank_sequences(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents as records of a flat file, in numbered lines of sixty letters, read back."""
    docs = table(spark, sf_dir, "documents").filter("text is not null").select("doc_id", "lang", fn.normalized_input(F.col("text")).alias("s"))
    letters = F.regexp_replace(F.regexp_replace(F.lower("s"), "(.{10})", "$1 "), "((?:.{10} ){6})", "$1\n       61 ")
    # the text writer ends the record's last line
    text = F.concat(F.lit("LOCUS       L"), "doc_id", F.lit("\nACCESSION   A"), "doc_id", F.when(F.col("lang") == "de", "").otherwise(F.concat(F.lit("\nVERSION     A"), "doc_id", F.lit(".1"))), F.lit("\nORIGIN      \n        1 "), letters, F.lit("\n//"))
    docs.select(text.alias("value")).write.text(path := scratch_path(spark, "genbank"))
    return genbank.read_sequences(spark, path).select("accession", F.length("sequence").alias("n_sites"), F.sha2("sequence", 256).alias("sequence_sha256"))


GENBANK_SEQUENCES_SQL = FASTA_SQL[: FASTA_SQL.rindex("SELECT")] + "SELECT 'A' || doc_id || CASE WHEN lang = 'de' THEN '' ELSE '.1' END AS accession, CAST(length(s) AS INTEGER) AS n_sites, sha256(s) AS sequence_sha256 FROM s"


def genbank_features(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Records with a gene on either strand and a joined peptide, names with quotes and a broken line, read back."""
    key, a = F.concat_ws(".", "l_orderkey", "l_linenumber"), F.col("l_partkey") + 1
    b, back = a + F.col("l_quantity").cast("long") + 2, F.col("l_linenumber") % 2 == 0
    place = lambda *x: F.concat(*[F.lit(y) if isinstance(y, str) else y for y in x])
    gene = place("     CDS             ", F.when(back, place("complement(<", a, "..", b, ")")).otherwise(place(a, "..", b)), '\n                     /gene="g ""', F.col("l_returnflag"), '"" of\n                     ', F.col("l_linestatus"), '"\n')
    peptide = place("     mat_peptide     join(", a, "..", a + 1, ",", b, "..>", b + 5, ')\n                     /product="p', F.col("l_suppkey"), '"\n')
    text = place("LOCUS       L\nVERSION     ", key, "\nFEATURES             Location/Qualifiers\n", gene, peptide, "ORIGIN      \n        1 acgtu\n//")
    table(spark, sf_dir, "lineitem").select(text.alias("value")).write.text(path := scratch_path(spark, "features"))
    return genbank.read_features(spark, path).drop("record_idx")


GENBANK_FEATURES_SQL = """
WITH l AS (SELECT l_orderkey || '.' || l_linenumber AS accession, l_partkey + 1 AS a, l_partkey + 3 + CAST(l_quantity AS BIGINT) AS b, * FROM lineitem)
SELECT accession, 0 AS feature_idx, 'CDS' AS type, CAST(a AS INTEGER) AS start, CAST(b AS INTEGER) AS "end", 1 AS n_parts, l_linenumber % 2 = 0 AS reverse, '' AS product, 'g "' || l_returnflag || '" of ' || l_linestatus AS gene FROM l
UNION ALL SELECT accession, 1, 'mat_peptide', CAST(a AS INTEGER), CAST(b + 5 AS INTEGER), 2, false, 'p' || l_suppkey, '' FROM l"""


def paf_round_trip(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = hits(spark, sf_dir)
    fixed = ["query_id", "query_length", "query_start", "query_end", "strand", "target_id", "target_length", "target_start", "target_end", "matching_bases", "alignment_block_length", "mapq"]
    tags = [F.concat(F.lit("AS:i:"), "alignment_score"), F.when(F.col("primary"), "tp:A:P").otherwise("tp:A:S")]
    line = F.concat_ws("\t", *fixed, *tags, F.when(F.col("has_de"), F.concat(F.lit("de:f:0.0"), F.col("mapq"))))
    rows.select(line.alias("value")).write.text(path := scratch_path(spark, "paf"))
    return readers.read_paf(spark, path).drop("tags")


PAF_SQL = """
SELECT CAST(l_orderkey AS VARCHAR) AS query_id, CAST(1000 AS BIGINT) AS query_length, l_partkey % 500 AS query_start, l_partkey % 500 + CAST(l_quantity AS BIGINT) * 8 AS query_end,
  CASE WHEN l_linenumber % 2 = 0 THEN '-' ELSE '+' END AS strand, concat(l_returnflag, '_', l_suppkey, '.', l_linenumber) AS target_id, CAST(1200 AS BIGINT) AS target_length,
  l_suppkey % 300 AS target_start, l_suppkey % 300 + CAST(l_quantity AS BIGINT) * 8 AS target_end, CAST(l_quantity AS BIGINT) * 7 AS matching_bases, CAST(l_quantity AS BIGINT) * 8 AS alignment_block_length,
  CAST(l_linenumber AS BIGINT) * 10 AS mapq, CAST(floor(l_extendedprice / 100.0) AS BIGINT) AS alignment_score, l_linestatus = 'O' AS "primary", CAST(0.875 AS DOUBLE) AS block_identity,
  CASE WHEN l_linenumber % 3 <> 0 THEN 1 - CAST('0.0' || (l_linenumber * 10) AS DOUBLE) ELSE CAST(0.875 AS DOUBLE) END AS identity, l_linenumber % 3 <> 0 AS has_de
FROM lineitem"""


def _pairs(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = table(spark, sf_dir, "lineitem")
    return rows.select(F.concat(F.lit("o"), "l_orderkey").alias("source"), F.concat(F.lit("p"), "l_partkey", F.lit("."), "l_linenumber").alias("target"), (F.col("l_suppkey") / 1024.0).alias("distance"), F.col("l_linenumber").cast("int").alias("snp_count"))


def links_round_trip(spark: SparkSession, sf_dir: str) -> DataFrame:
    writers.write_distances(_pairs(spark, sf_dir), path := scratch_path(spark, "links"))
    return readers.read_links(spark, path)


LINKS_SQL = "SELECT 'o' || l_orderkey AS source, 'p' || l_partkey || '.' || l_linenumber AS target, l_suppkey / 1024.0::DOUBLE AS distance FROM lineitem"


def distances_round_trip(spark: SparkSession, sf_dir: str) -> DataFrame:
    """As other tools write it: other names, tabs, and an id that is blank in some rows, which then do not count."""
    rows = _pairs(spark, sf_dir)
    named = rows.select(F.when(F.col("snp_count") < 7, F.col("source")).alias("ID1"), F.col("target").alias("ID2"), F.col("distance").alias("TN93"))
    named.write.option("sep", "\t").csv(path := scratch_path(spark, "distances"), header=True)
    return readers.read_distances(spark, path)


DISTANCES_SQL = LINKS_SQL + " WHERE l_linenumber < 7"


def nodes_round_trip(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = table(spark, sf_dir, "conversations").select(F.concat(F.lit("c"), F.col("conv_id").cast("string")).alias("sample_id"), F.col("turn").cast("string").alias("turn"))
    writers.write_table(rows, path := scratch_path(spark, "nodes"))
    return readers.read_nodes(spark, path).filter("node <> 'sample_id'").select("node")


NODES_SQL = "SELECT DISTINCT 'c' || conv_id AS node FROM conversations"


def metadata_round_trip(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Names with commas, quotes and line breaks in quoted cells, blanks, and ages."""
    parts = table(spark, sf_dir, "part")
    cell = lambda c: F.concat(F.lit('"'), F.regexp_replace(c, '"', '""'), F.lit('"'))
    note = F.concat("p_name", F.lit(', "'), "p_brand", F.lit('"\n'), "p_type")
    line = F.concat_ws(",", F.concat(F.lit("P"), "p_partkey"), cell(note), F.when(F.col("p_size") > 10, F.col("p_size").cast("string")).otherwise(""))
    head = spark.createDataFrame([("sample_id,note,age",)], "value string")
    head.unionByName(parts.select(line.alias("value"))).coalesce(1).write.text(path := scratch_path(spark, "metadata"))
    return readers.read_metadata(spark, path)


METADATA_SQL = """
SELECT 'P' || p_partkey AS sample_id, trim(p_name || ', "' || p_brand || '"' || chr(10) || p_type) AS note, CASE WHEN p_size > 10 THEN CAST(p_size AS VARCHAR) ELSE '(missing)' END AS age,
  CASE WHEN p_size <= 10 THEN '(missing)' WHEN p_size <= 30 THEN '0–30' WHEN p_size <= 60 THEN '31–60' ELSE '61+' END AS age_range FROM part"""


def genotype_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All 27 columns of the genotype table, written in their layout and read back."""
    h = hits(spark, sf_dir).withColumns({"query_span_coverage": F.col("query_coverage") / 2, "target_coverage": F.col("query_coverage") / 4, "identity_method": F.lit("block_fallback"), "alignment_segment_count": F.lit(1)})
    orders = table(spark, sf_dir, "orders").select(F.col("o_orderkey").cast("string").alias("seq_id"), F.concat(F.lit("ACGT" * 50), F.repeat(F.lit("N"), (F.col("o_orderkey") % 90).cast("int"))).alias("sequence"))
    writers.write_layout(genotyping.assignments(orders, h), path := scratch_path(spark, "genotypes"), writers.GENOTYPE_LAYOUT)
    return readers.read_table(spark, path, writers.GENOTYPE_LAYOUT)


def genotype_sql(ranked: str) -> str:
    """``ranked`` gives the hits with their rank within each query; six decimals are rounded half to even, as the layout has them."""
    group = lambda x: f"split_part({x}, '_', 1)"
    return f"""WITH {ranked},
best AS (SELECT query_id, target_id AS best_ref, {group('target_id')} AS g, alignment_score AS best_score FROM ranked WHERE hit_rank = 1),
second AS (SELECT query_id, alignment_score AS second_score FROM ranked WHERE hit_rank = 2),
near AS (SELECT r.query_id, string_agg(r.target_id, ';' ORDER BY hit_rank) AS close_hits FROM ranked r JOIN best b USING (query_id) WHERE hit_rank > 1 AND r.alignment_score >= best_score * 0.98 GROUP BY r.query_id),
others AS (SELECT query_id, string_agg(o, ';' ORDER BY first_rank) AS others FROM (SELECT r.query_id, {group('r.target_id')} AS o, min(hit_rank) AS first_rank FROM ranked r JOIN best b USING (query_id)
  WHERE hit_rank > 1 AND r.alignment_score >= best_score * 0.98 AND {group('r.target_id')} <> b.g GROUP BY ALL) GROUP BY query_id),
covered AS (SELECT r.*, row_number() OVER (PARTITION BY r.query_id ORDER BY (query_coverage >= 0.5 AND identity >= 0.75) DESC, query_coverage DESC, alignment_score DESC, identity DESC, matching_bases DESC, mapq DESC, target_id DESC) AS c
  FROM ranked r JOIN best b USING (query_id) WHERE {group('r.target_id')} = b.g),
x AS (SELECT CAST(o_orderkey AS VARCHAR) AS sequence_id, o_orderkey % 90 AS ns, concat_ws(';', CASE WHEN best_ref IS NULL THEN 'no_alignment' END, CASE WHEN c.query_coverage < 0.5 THEN 'low_query_coverage' END, CASE WHEN c.identity < 0.75 THEN 'low_identity' END) AS reason,
  b.*, second_score, close_hits, others, c.target_id AS coverage_ref, c.query_coverage, c.identity, c.block_identity, c.mapq, c.matching_bases, c.alignment_block_length
  FROM orders o LEFT JOIN best b ON b.query_id = CAST(o.o_orderkey AS VARCHAR) LEFT JOIN second USING (query_id) LEFT JOIN near USING (query_id) LEFT JOIN others USING (query_id) LEFT JOIN (SELECT * FROM covered WHERE c = 1) c USING (query_id))
SELECT sequence_id, CASE WHEN reason = '' THEN g END AS assigned_genotype, CASE WHEN reason = '' THEN nullif(regexp_replace(g, '\\D', '', 'g'), '') END AS genotype_group, CASE WHEN reason = '' THEN 'pass' ELSE 'qc_fail' END AS assignment_status, nullif(reason, '') AS qc_fail_reason,
  best_ref, g AS best_ref_genotype, coverage_ref, 200 + ns AS query_length, CAST(200 AS BIGINT) AS non_n_bases, round_even(200 / CAST(200 + ns AS DOUBLE), 6) AS non_n_fraction, coalesce(best_score, 0) AS best_alignment_score, second_score AS second_alignment_score,
  best_score - second_score AS score_margin, round_even((best_score - second_score) / CAST(nullif(best_score, 0) AS DOUBLE), 6) AS score_margin_fraction, round_even(query_coverage, 6) AS query_coverage, round_even(query_coverage / 2, 6) AS query_span_coverage, round_even(query_coverage / 4, 6) AS target_coverage,
  round_even(identity, 6) AS identity, CASE WHEN best_ref IS NOT NULL THEN 'block_fallback' END AS identity_method, CAST(block_identity AS DOUBLE) AS block_identity, mapq, coalesce(matching_bases, 0) AS matching_bases, coalesce(alignment_block_length, 0) AS alignment_block_length,
  CASE WHEN best_ref IS NULL THEN 0 ELSE 1 END AS alignment_segment_count, close_hits, others AS other_potential_genotypes FROM x"""
