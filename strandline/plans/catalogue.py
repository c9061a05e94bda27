"""Registry of the engine's queries over the driver's tables, and the SQL each must agree with."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from strandline.functions import sequence as fn
from strandline.operators import catalog, distance, encodings, genotyping, graph, labels, layouts, metadata, near_links, regions, reuse, variants
from strandline.plans import round_trips
from strandline.plans.proxies import ALIGNED_SQL, HITS_SQL, PAIRS_SQL, REFERENCE, SITE_SQL, STRETCHES_SQL, aligned, hits, stretches
from strandline.session import materialise, release, scratch_path, table
from strandline.sources import readers, writers
from strandline.streaming import incremental

THRESHOLD = 0.03
SNPS = 5

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def query(sql: str | None = None):
    def register(f: Callable[[SparkSession, str], DataFrame]) -> Callable[[SparkSession, str], DataFrame]:
        QUERIES[f.__name__] = f
        if sql:
            ORACLES[f.__name__] = sql
        return f

    return register


# --- scalar functions -------------------------------------------------------------------------------------------------

_CLEAN = "translate(translate(regexp_replace(text, '\\s+', '', 'g'), 'abcdefghijklmnopqrstuvwxyz', 'ABCDEFGHIJKLMNOPQRSTUVWXYZ'), 'U', 'T')"


@query(f"""
WITH s AS (SELECT doc_id, {_CLEAN} AS k, regexp_replace(regexp_replace({_CLEAN}, '[-.]', '', 'g'), '[^ACGTRYSWKMBDHVN]', 'N', 'g') AS n FROM documents WHERE text IS NOT NULL)
SELECT doc_id, sha256(n) AS sequence_sha256, CAST(length(n) AS INTEGER) AS n_sites, CAST(length(regexp_replace(k, '[^ACGT]', '', 'g')) AS INTEGER) AS completeness,
  CAST(length(regexp_replace(n, 'N', '', 'g')) AS INTEGER) AS non_n FROM s""")
def normalize_sequences(spark, sf_dir):
    docs = table(spark, sf_dir, "documents").filter("text is not null")
    rows = docs.select("doc_id", "text", fn.normalized_input(F.col("text")).alias("n"))
    return rows.select("doc_id", fn.fingerprint(F.col("n")).alias("sequence_sha256"), F.length("n").alias("n_sites"), fn.completeness(F.col("text")).alias("completeness"), fn.non_n_bases(F.col("n")).alias("non_n"))


@query(f"""WITH {ALIGNED_SQL} SELECT seq_id, sha256(translate(aligned, 'Nn', '--')) AS masked_sha256,
  CAST(length(aligned) - length(replace(translate(aligned, 'Nn', '--'), '-', '')) AS INTEGER) AS gaps FROM aligned""")
def mask_n(spark, sf_dir):
    rows = aligned(spark, sf_dir).select("seq_id", fn.n_as_gap(F.col("aligned")).alias("m"))
    return rows.select("seq_id", F.sha2("m", 256).alias("masked_sha256"), F.regexp_count("m", F.lit("-")).cast("int").alias("gaps"))


@query("""SELECT l_orderkey, l_linenumber, CASE WHEN n = 0 THEN 0.0 ELSE (len(replace(substr(s, 1, b1), 'N', '')) + CASE WHEN e2 > greatest(s2, b1) THEN len(replace(substr(s, greatest(s2, b1) + 1, e2 - greatest(s2, b1)), 'N', '')) ELSE 0 END) / CAST(n AS DOUBLE) END AS callable
FROM (SELECT *, len(replace(s, 'N', '')) AS n FROM (
  SELECT l_orderkey, l_linenumber, repeat('ACGTN', 20) || repeat('N', l_linenumber) AS s, l_partkey % 60 AS b1, l_suppkey % 80 AS s2, l_suppkey % 80 + CAST(l_quantity AS BIGINT) AS e2 FROM lineitem))""")
def callable_coverage(spark, sf_dir):
    rows = table(spark, sf_dir, "lineitem")
    seq = F.concat(F.lit("ACGTN" * 20), F.repeat(F.lit("N"), F.col("l_linenumber")))
    part = lambda a, b: F.struct(a.cast("long").alias("start"), b.cast("long").alias("end"))
    cut = F.array(part(F.lit(0), F.col("l_partkey") % 60), part(F.col("l_suppkey") % 80, F.col("l_suppkey") % 80 + F.col("l_quantity").cast("long")))
    return rows.select("l_orderkey", "l_linenumber", fn.callable_coverage(seq, cut).alias("callable"))


@query("""SELECT p_partkey, CASE WHEN p_size <= 30 THEN '0–30' WHEN p_size <= 60 THEN '31–60' ELSE '61+' END AS age_range FROM part""")
def age_range(spark, sf_dir):
    return table(spark, sf_dir, "part").select("p_partkey", fn.age_range(F.col("p_size")).alias("age_range"))


@query(r"""SELECT page_id, regexp_replace(url, '[^\p{L}\p{N}\-_.]', '_', 'g') AS safe, split_part(url, '_', 1) AS lead, regexp_replace(url, '\D', '', 'g') AS digits,
  nullif(lower(regexp_extract('sample|genotype=' || chr(CAST(49 + page_id % 8 AS INTEGER)) || 'A|x', '(?i)(?:^|[|;\s,])(?:genotype|subtype|gt|hcv_gt|hcv-genotype)[:= ]+([0-9][a-z]?)', 1)), '') AS tag FROM pages""")
def header_names(spark, sf_dir):
    rows = table(spark, sf_dir, "pages")
    header = F.concat(F.lit("sample|genotype="), (F.col("page_id") % 8 + 1).cast("string"), F.lit("A|x"))
    return rows.select("page_id", fn.safe_name(F.col("url")).alias("safe"), fn.reference_genotype(F.col("url")).alias("lead"), fn.genotype_group(F.col("url")).alias("digits"), fn.header_genotype(header).alias("tag"))


@query(f"""WITH {ALIGNED_SQL} SELECT seq_id, sha256('>' || seq_id || chr(10) || array_to_string(list_transform(range(0, (length(aligned) + 79) // 80), lambda i: substr(aligned, i * 80 + 1, 80)), chr(10))) AS fasta_sha256 FROM aligned""")
def fasta_records(spark, sf_dir):
    rows = aligned(spark, sf_dir).withColumn("header", F.col("seq_id"))
    return writers.fasta_lines(rows, "aligned").select(F.regexp_extract("value", "^>(.*)\n", 1).alias("seq_id"), F.sha2("value", 256).alias("fasta_sha256"))


# --- ids and variants -------------------------------------------------------------------------------------------------


@query("SELECT conv_id, count(*) AS n FROM conversations GROUP BY conv_id HAVING count(*) > 1")
def fasta_ids_unique(spark, sf_dir):
    return readers.duplicate_ids(table(spark, sf_dir, "conversations"), "conv_id")


@query("SELECT role AS node, min(turn) AS first_idx FROM conversations GROUP BY role")
def ordered_nodes(spark, sf_dir):
    return readers.ordered_distinct(table(spark, sf_dir, "conversations").withColumnRenamed("role", "node"), "node", "turn")


def _plan(spark, sf_dir):
    rows = table(spark, sf_dir, "conversations").withColumn("seq_id", F.col("conv_id").cast("string"))
    return variants.resolve_repeats(rows, "turn", "seq_id", "text")


_PLAN = f"""base AS (SELECT CAST(conv_id AS VARCHAR) AS base_sample_id, turn AS input_record, {_CLEAN} AS k FROM conversations),
firsts AS (SELECT *, CAST(length(regexp_replace(k, '[^ACGT]', '', 'g')) AS INTEGER) AS completeness, min(input_record) OVER (PARTITION BY base_sample_id, k) AS f FROM base),
nth AS (SELECT *, dense_rank() OVER (PARTITION BY base_sample_id ORDER BY f) AS v FROM firsts),
counted AS (SELECT *, CAST(max(v) OVER (PARTITION BY base_sample_id) AS INTEGER) AS n_variants FROM nth),
plan AS (SELECT base_sample_id || CASE WHEN n_variants > 1 THEN '__v' || v ELSE '' END AS sequence_id, base_sample_id, CASE WHEN n_variants > 1 THEN 'v' || v ELSE '' END AS variant,
  n_variants, input_record, completeness, CASE WHEN input_record = f THEN 'kept' ELSE 'dropped_identical_repeat' END AS status FROM counted)"""


@query(f"WITH {_PLAN} SELECT * FROM plan")
def duplicate_variants(spark, sf_dir):
    return _plan(spark, sf_dir)


@query(f"""WITH {_PLAN}, typed AS (SELECT *, CASE WHEN input_record % 5 = 4 THEN '' WHEN input_record % 2 = 0 THEN '1a' ELSE '3a' END AS genotype, CAST(input_record % 3 AS DOUBLE) / 4 AS region_coverage FROM plan),
ranked AS (SELECT *, row_number() OVER (PARTITION BY status = 'kept' AND genotype <> '', base_sample_id, genotype ORDER BY region_coverage DESC, completeness DESC, input_record) AS r FROM typed)
SELECT sequence_id, genotype, input_record, CASE WHEN status <> 'kept' THEN status WHEN genotype = '' THEN 'genotype_not_assigned' WHEN r > 1 THEN 'dropped_same_genotype' ELSE 'kept' END AS status FROM ranked""")
def variant_selection(spark, sf_dir):
    rec = F.col("input_record")
    typed = _plan(spark, sf_dir).withColumn("genotype", F.when(rec % 5 == 4, "").when(rec % 2 == 0, "1a").otherwise("3a")).withColumn("region_coverage", (rec % 3).cast("double") / 4)
    return variants.select_variants(typed).select("sequence_id", "genotype", "input_record", "status")


def _assigned_plan(spark, sf_dir):
    """The plan with genotypes and coverages joined from rows of which the second of a sequence counts; every eleventh has none."""
    plan = _plan(spark, sf_dir)
    rec, second = F.col("input_record"), F.col("at") == 1
    rows = plan.filter("status = 'kept'").withColumn("at", F.explode(F.array(F.lit(1), F.lit(0))))
    failed = second & (rec % 5 == 4)
    kind = F.when(~second, "9z").when(failed, "").when(rec % 2 == 0, "1a").otherwise("3a")
    assigned = rows.filter("completeness % 11 <> 0").select(F.concat(F.lit(" "), "sequence_id").alias("sequence_id"), "at", kind.alias("assigned_genotype"), F.when(failed, "qc_fail").otherwise("pass").alias("assignment_status"), F.when(failed, "low_identity").alias("qc_fail_reason"))
    share = F.when(~second, "0.9").when(F.col("completeness") % 7 == 0, "x").otherwise(((rec % 3).cast("double") / 4).cast("string"))
    qc = rows.select(F.col("sequence_id").alias("sample_id"), "at", share.alias("coverage_fraction"))
    return variants.with_region_coverage(variants.record_genotypes(plan, assigned, "at"), qc, "at")


_ASSIGNED_PLAN = f"""{_PLAN}, held AS (SELECT sequence_id, completeness % 11 <> 0 AS listed, CASE WHEN completeness % 7 = 0 THEN 0.0 ELSE CAST(input_record % 3 AS DOUBLE) / 4 END AS region_coverage FROM plan WHERE status = 'kept'),
typed AS (SELECT p.* EXCLUDE (status), region_coverage, CASE WHEN p.status <> 'kept' OR NOT listed OR input_record % 5 = 4 THEN '' WHEN input_record % 2 = 0 THEN '1a' ELSE '3a' END AS genotype,
  CASE WHEN p.status = 'kept' AND listed AND input_record % 5 = 4 THEN 'low_identity' ELSE '' END AS detail, CASE WHEN p.status = 'kept' AND (NOT listed OR input_record % 5 = 4) THEN 'genotype_not_assigned' ELSE p.status END AS status FROM plan p JOIN held USING (sequence_id)),
chosen AS (SELECT *, row_number() OVER (PARTITION BY status = 'kept', base_sample_id, genotype ORDER BY region_coverage DESC, completeness DESC, input_record) AS r,
  row_number() OVER (PARTITION BY status = 'kept', base_sample_id, genotype ORDER BY completeness DESC, input_record) AS r2 FROM typed)"""


@query(f"""WITH {_ASSIGNED_PLAN} SELECT sequence_id, input_record, genotype, detail, region_coverage, CASE WHEN status = 'kept' AND r > 1 THEN 'dropped_same_genotype' ELSE status END AS by_coverage,
  CASE WHEN status = 'kept' AND r2 > 1 THEN 'dropped_same_genotype' ELSE status END AS by_completeness FROM chosen""")
def variant_genotypes(spark, sf_dir):
    both = variants.select_variants(_assigned_plan(spark, sf_dir)).withColumnRenamed("status", "by_coverage")
    other = variants.select_variants(_assigned_plan(spark, sf_dir), "completeness").select("base_sample_id", "input_record", F.col("status").alias("by_completeness"))
    return both.join(other, ["base_sample_id", "input_record"]).select("sequence_id", "input_record", "genotype", "detail", "region_coverage", "by_coverage", "by_completeness")


@query(f"""WITH {_ASSIGNED_PLAN}, kept AS (SELECT sequence_id, base_sample_id FROM chosen WHERE status = 'kept' AND r = 1), mixed AS (SELECT base_sample_id FROM kept GROUP BY ALL HAVING count(*) > 1),
nodes AS (SELECT sequence_id AS sample_id, 'C' || completeness % 50 AS cluster_id FROM plan WHERE status = 'kept' UNION ALL SELECT 'K' || c_custkey, 'K' FROM customer)
SELECT sample_id, coalesce(k.base_sample_id, sample_id) AS base_sample_id, cluster_id, coalesce(k.base_sample_id, sample_id) IN (SELECT base_sample_id FROM mixed) AS mixed_infection FROM nodes LEFT JOIN kept k ON k.sequence_id = sample_id""")
def mixed_samples(spark, sf_dir):
    plan = variants.select_variants(_assigned_plan(spark, sf_dir))
    nodes = _plan(spark, sf_dir).filter("status = 'kept'").select(F.col("sequence_id").alias("sample_id"), F.concat(F.lit("C"), F.col("completeness") % 50).alias("cluster_id"))
    others = table(spark, sf_dir, "customer").select(F.concat(F.lit("K"), "c_custkey").alias("sample_id"), F.lit("K").alias("cluster_id"))
    return variants.annotate_clusters(nodes.unionByName(others), plan)


# --- distances, links, clusters ---------------------------------------------------------------------------------------


def _pairs(spark, sf_dir):
    return distance.snp_pairs(aligned(spark, sf_dir))


def _links(spark, sf_dir):
    return distance.links_by_distance(near_links.near_links(aligned(spark, sf_dir), at_most=THRESHOLD), THRESHOLD)


def _written_links(spark, sf_dir):
    links = materialise(_links(spark, sf_dir), "links")
    release(spark)
    return links


_LINKS = f"{PAIRS_SQL}, links AS (SELECT * FROM pairs WHERE distance <= {THRESHOLD} AND source <> target)"


@query(f"WITH {PAIRS_SQL} SELECT * FROM pairs")
def snp_distance(spark, sf_dir):
    return _pairs(spark, sf_dir)


@query(f"WITH {_LINKS} SELECT * FROM links")
def snp_links(spark, sf_dir):
    return _links(spark, sf_dir)


@query(f"WITH {PAIRS_SQL} SELECT * FROM pairs WHERE snp_count <= {SNPS}")
def snp_count_links(spark, sf_dir):
    return distance.links_by_snps(near_links.near_links(aligned(spark, sf_dir), most_snps=SNPS), SNPS)


@query(f"""WITH {PAIRS_SQL} SELECT genotype, count(*) AS pairs, min(snp_count) AS min_snps, max(snp_count) AS max_snps, list_sort(list(snp_count))[count(*) // 2 + 1] AS median_snps,
  min(comparable_sites) AS min_sites, max(comparable_sites) AS max_sites FROM pairs GROUP BY genotype""")
def snp_summary(spark, sf_dir):
    return distance.summary_of_counts(distance.snp_histogram(aligned(spark, sf_dir)), ["genotype"])


def _tn93_steps(keep: str) -> str:
    """From pairs ``t`` with counts ``nXY`` and their sum ``n`` to ``d`` with a distance."""
    freq = lambda x: f"({' + '.join(f'n{x}{y} + n{y}{x}' for y in 'ACGT')}) / (2 * n)"
    return f"""f AS (SELECT *, {freq('A')} AS fa, {freq('C')} AS fc, {freq('G')} AS fg, {freq('T')} AS ft, (nAG + nGA) / n AS p1, (nCT + nTC) / n AS p2,
  (nAC + nCA + nAT + nTA + nGC + nCG + nGT + nTG) / n AS q FROM t WHERE n > 0),
k AS (SELECT *, fa + fg AS r, fc + ft AS y, coalesce(fa * fg / nullif(fa + fg, 0), 0) AS ag, coalesce(ft * fc / nullif(fc + ft, 0), 0) AS tc FROM f),
x AS (SELECT *, 2 * (r * y - ag * y - tc * r) AS k3, 1 - coalesce(p1 / nullif(2 * ag, 0), 0) - coalesce(q / nullif(2 * r, 0), 0) AS x1,
  1 - coalesce(p2 / nullif(2 * tc, 0), 0) - coalesce(q / nullif(2 * y, 0), 0) AS x2, 1 - coalesce(q / nullif(2 * r * y, 0), 0) AS x3 FROM k),
d AS (SELECT {keep}, CASE WHEN (ag <> 0 AND x1 <= 0) OR (tc <> 0 AND x2 <= 0) OR (k3 <> 0 AND x3 <= 0) THEN 1.0 ELSE abs(greatest(0.0,
  CASE WHEN ag <> 0 THEN -2 * ag * ln(x1) ELSE 0 END + CASE WHEN tc <> 0 THEN -2 * tc * ln(x2) ELSE 0 END + CASE WHEN k3 <> 0 THEN -k3 * ln(x3) ELSE 0 END)) END AS distance FROM x)"""


def _tn93_sql() -> str:
    n = {(x, y): f"CAST(sum(bit_count(a.{x.lower()}_ & b.{y.lower()}_)) AS DOUBLE)" for x in "ACGT" for y in "ACGT"}
    cols = ", ".join(f"{v} AS n{x}{y}" for (x, y), v in n.items())
    bits = PAIRS_SQL.split("counted AS")[0]
    return f"""WITH {bits}c AS (SELECT a.genotype, a.seq_id AS source, b.seq_id AS target, {cols} FROM bits a JOIN bits b ON a.genotype = b.genotype AND a.no = b.no AND a.record_idx < b.record_idx GROUP BY ALL),
t AS (SELECT *, {' + '.join(f'n{x}{y}' for x in 'ACGT' for y in 'ACGT')} AS n FROM c),
{_tn93_steps('genotype, source, target')}
SELECT genotype, source, target, round(distance, 9) AS distance FROM d WHERE distance <= {THRESHOLD}"""


@query(_tn93_sql())
def tn93_links(spark, sf_dir):
    found = distance.links_by_distance(near_links.near_tn93(aligned(spark, sf_dir), THRESHOLD), THRESHOLD)
    return found.withColumn("distance", F.round("distance", 9))


#: Ambiguous sites count as differences in part, so pairs of equal texts are further apart than under ``THRESHOLD``.
FAR = 0.35


def _tn93_modes_sql() -> str:
    """N is any base; in ``gapmm`` so is a gap against a base. Sites beyond a row's end are neither."""
    bits = PAIRS_SQL.split("bits AS")[0].replace("1024, '-')", "1024, '.')")
    bit = lambda x: f"CAST(regexp_replace(regexp_replace(sites, '[^{x}]', '0', 'g'), '[{x}]', '1', 'g') AS BIT)"
    marks = {**{x: x for x in "ACGT"}, "N": "N", "M": "N-", "D": "-"}
    seen = [(x, y) for x in marks for y in marks if not {x, y} & set("D") or x == y]
    cols = ", ".join(f"CAST(sum(bit_count(a.{x}_ & b.{y}_)) AS DOUBLE) AS c{x}{y}" for x, y in seen)
    shared = lambda m, same: {(x, y): f"c{x}{y} + (c{x}{m} + c{m}{y}) / 4 + ({same}) / 16" for x in "ACGT" for y in "ACGT"}
    modes = {
        "average": shared("N", "cNN"),
        "gapmm": shared("M", "cMM - cDD"),
        "resolve": {(x, y): f"cAA * 0 + c{x}{y}" + (f" + c{x}N + cN{x} + cNN / 4" if x == y else "") for x in "ACGT" for y in "ACGT"},
    }
    each = " UNION ALL ".join(f"SELECT genotype, source, target, '{m}' AS mode, {', '.join(f'{v} AS n{x}{y}' for (x, y), v in n.items())} FROM c" for m, n in modes.items())
    return f"""WITH {bits}bits AS (SELECT genotype, record_idx, seq_id, no, {', '.join(f'{bit(v)} AS {k}_' for k, v in marks.items())} FROM cut),
c AS MATERIALIZED (SELECT a.genotype, a.seq_id AS source, b.seq_id AS target, {cols} FROM bits a JOIN bits b ON a.genotype = b.genotype AND a.no = b.no AND a.record_idx < b.record_idx GROUP BY ALL),
t AS (SELECT *, {' + '.join(f'n{x}{y}' for x in 'ACGT' for y in 'ACGT')} AS n FROM ({each})),
{_tn93_steps('mode, genotype, source, target')}
SELECT mode, genotype, source, target, round(distance, 9) AS distance FROM d WHERE distance <= {FAR}"""


@query(_tn93_modes_sql())
def tn93_modes(spark, sf_dir):
    rows = aligned(spark, sf_dir)
    found = [distance.tn93_pairs(rows, m, FAR).withColumn("mode", F.lit(m)) for m in ("average", "gapmm", "resolve")]
    return found[0].unionByName(found[1]).unionByName(found[2]).select("mode", "genotype", "source", "target", F.round("distance", 9).alias("distance"))


def _clusters(spark, sf_dir, links=None):
    """Numbered clusters within each genotype, isolates included."""
    nodes = aligned(spark, sf_dir).select("genotype", F.col("seq_id").alias("sample_id"))
    links = links if links is not None else _written_links(spark, sf_dir)
    found = graph.components(nodes, links).join(nodes, "sample_id")
    return graph.number_clusters(found, ["genotype"])


_CLUSTERS = f"""{_LINKS},
sides AS (SELECT source AS s, target AS t FROM links UNION ALL SELECT target, source FROM links),
reach(node, other) AS (SELECT seq_id, seq_id FROM aligned UNION SELECT r.node, b.t FROM reach r JOIN sides b ON b.s = r.other),
roots AS (SELECT node AS sample_id, min(other) AS root FROM reach GROUP BY node),
sized AS (SELECT a.genotype, r.sample_id, r.root, CAST(count(*) OVER (PARTITION BY r.root) AS INTEGER) AS cluster_size FROM roots r JOIN aligned a ON a.seq_id = r.sample_id),
numbered AS (SELECT *, dense_rank() OVER (PARTITION BY genotype ORDER BY root) AS no FROM sized),
clusters AS (SELECT genotype, sample_id, 'C' || CASE WHEN no < 10000 THEN lpad(CAST(no AS VARCHAR), 4, '0') ELSE CAST(no AS VARCHAR) END AS cluster_id, cluster_size FROM numbered)"""


@query(f"WITH RECURSIVE {_CLUSTERS} SELECT * FROM clusters")
def clusters(spark, sf_dir):
    return _clusters(spark, sf_dir).drop("cluster_no")


@query(f"""WITH RECURSIVE {_CLUSTERS} SELECT genotype, count(*) AS n_nodes, count(DISTINCT cluster_id) AS n_clusters, count(DISTINCT CASE WHEN cluster_size > 1 THEN cluster_id END) AS n_multi,
  count(*) FILTER (cluster_size = 1) AS n_singletons, max(cluster_size) AS largest FROM clusters GROUP BY genotype""")
def cluster_stats(spark, sf_dir):
    return graph.cluster_stats(_clusters(spark, sf_dir), ["genotype"])


@query(f"WITH RECURSIVE {_CLUSTERS} SELECT genotype, sample_id, cluster_id, cluster_size FROM clusters WHERE cluster_size > 1")
def hide_singletons(spark, sf_dir):
    links = _written_links(spark, sf_dir)
    return graph.hide_singletons(_clusters(spark, sf_dir, links).drop("cluster_no"), links)[0]


@query(f"""WITH RECURSIVE {_CLUSTERS} SELECT sample_id, genotype, regexp_replace(genotype, '[^a-z0-9]', '_', 'g') || '_' || cluster_id AS cluster_id, cluster_id AS source_cluster_id, cluster_size FROM clusters""")
def merged_clusters(spark, sf_dir):
    rows = _clusters(spark, sf_dir)
    return rows.select("sample_id", "genotype", F.concat_ws("_", fn.safe_name(F.col("genotype")), "cluster_id").alias("cluster_id"), F.col("cluster_id").alias("source_cluster_id"), "cluster_size")


@query(f"WITH {_LINKS} SELECT source, target, distance, snp_count, comparable_sites FROM links")
def merged_links(spark, sf_dir):
    links = _links(spark, sf_dir)
    english = F.col("genotype").eqNullSafe("en")
    return distance.merged_links([links.filter(english), links.filter(~english)])


@query(f"""WITH {_LINKS} SELECT sha256((SELECT string_agg(seq_id, chr(10) ORDER BY seq_id) FROM aligned) || chr(10) || chr(10) ||
  (SELECT string_agg(least(source, target) || chr(9) || greatest(source, target), chr(10) ORDER BY least(source, target) || chr(9) || greatest(source, target)) FROM links)) AS fingerprint""")
def network_fingerprint(spark, sf_dir):
    return encodings.network_fingerprint(aligned(spark, sf_dir), _links(spark, sf_dir), "seq_id")


_DIGEST = f"""{_LINKS},
items AS (SELECT 'n' AS kind, seq_id AS value FROM aligned UNION ALL SELECT 'e', least(source, target) || chr(9) || greatest(source, target) FROM links),
h AS (SELECT sha256(concat_ws(chr(9), kind, value, CAST(count(*) AS VARCHAR))) AS h FROM items GROUP BY kind, value),
p0 AS (SELECT substr(h, 1, 4) AS piece, sha256(string_agg(h, '' ORDER BY h)) AS h FROM h GROUP BY 1),
p1 AS (SELECT substr(piece, 1, 2) AS piece, sha256(string_agg(h, '' ORDER BY piece)) AS h FROM p0 GROUP BY 1)"""


@query(f"WITH {_DIGEST} SELECT sha256(string_agg(h, '' ORDER BY piece)) AS digest FROM p1")
def network_digest(spark, sf_dir):
    return encodings.network_digest(aligned(spark, sf_dir), _links(spark, sf_dir), "seq_id")


@query()
def component_layout(spark, sf_dir):
    rows = _clusters(spark, sf_dir).withColumn("cluster_id", F.concat_ws("_", "genotype", "cluster_id"))
    return encodings.component_layout(rows.filter("cluster_size > 1"))


@query()
def spring_layout(spark, sf_dir):
    links = _written_links(spark, sf_dir)
    rows = _clusters(spark, sf_dir, links).withColumn("cluster_id", F.concat_ws("_", "genotype", "cluster_id"))
    return layouts.spring_layout(rows.filter("cluster_size > 1"), links)


@query()
def cluster_labels(spark, sf_dir):
    links = _written_links(spark, sf_dir)
    rows = materialise(_clusters(spark, sf_dir, links).withColumn("cluster_id", F.concat_ws("_", "genotype", "cluster_id")).filter("cluster_size > 1"), "clusters")
    places = layouts.spring_layout(rows, links)
    return labels.label_places(rows.join(places, "sample_id"))


@query(f"WITH {_LINKS}, good AS (SELECT CAST(doc_id AS VARCHAR) AS seq_id FROM labels WHERE quality = 1) SELECT * FROM links WHERE source IN (SELECT seq_id FROM good) AND target IN (SELECT seq_id FROM good)")
def listed_links(spark, sf_dir):
    good = table(spark, sf_dir, "labels").filter("quality = 1").select(F.col("doc_id").cast("string").alias("sample_id"))
    return graph.valid_links(good, _links(spark, sf_dir))


def _stored(spark, sf_dir):
    """A store that got all sequences in three batches."""
    store = scratch_path(spark, "store")
    rows = aligned(spark, sf_dir).withColumn("sequence", F.col("aligned")).withColumn("batch", F.pmod(F.xxhash64("seq_id"), F.lit(3)))
    for n in range(3):
        incremental.add_batch(spark, rows.filter(F.col("batch") == n).drop("batch"), store, n, at_most=THRESHOLD)
    return store


@query(f"WITH RECURSIVE {_CLUSTERS} SELECT l.*, c.cluster_id, c.cluster_size FROM links l JOIN clusters c ON c.sample_id = l.source")
def stored_links(spark, sf_dir):
    store = _stored(spark, sf_dir)
    nodes = aligned(spark, sf_dir).select("genotype", F.col("seq_id").alias("sample_id"))
    numbered = graph.number_clusters(incremental.stored_components(spark, store).join(nodes, "sample_id"), ["genotype"])
    return incremental.stored_links(spark, store).join(numbered.select(F.col("sample_id").alias("source"), "cluster_id", "cluster_size"), "source")


# --- metadata ---------------------------------------------------------------------------------------------------------


def _meta(spark, sf_dir):
    labels = table(spark, sf_dir, "labels")
    return labels.select(F.col("doc_id").cast("string").alias("sample_id"), F.col("quality").cast("string").alias("quality"), F.when(F.col("toxic") == 1, "yes").otherwise("").alias("toxic")).withColumn("toxic", fn.blank_as_missing(F.col("toxic")))


_META = "meta AS (SELECT CAST(doc_id AS VARCHAR) AS sample_id, CAST(quality AS VARCHAR) AS quality, CASE WHEN toxic = 1 THEN 'yes' ELSE '(missing)' END AS toxic FROM labels)"


@query(f"WITH {ALIGNED_SQL}, {_META} SELECT a.seq_id AS sample_id, a.genotype, coalesce(quality, '(missing)') AS quality, coalesce(toxic, '(missing)') AS toxic FROM aligned a LEFT JOIN meta m ON m.sample_id = a.seq_id")
def metadata_join(spark, sf_dir):
    nodes = aligned(spark, sf_dir).select(F.col("seq_id").alias("sample_id"), "genotype")
    return metadata.join_metadata(nodes, _meta(spark, sf_dir))


@query(f"WITH {ALIGNED_SQL}, {_META} SELECT seq_id AS sample_id FROM aligned WHERE seq_id NOT IN (SELECT sample_id FROM meta)")
def metadata_missing(spark, sf_dir):
    return metadata.nodes_without_metadata(aligned(spark, sf_dir).withColumnRenamed("seq_id", "sample_id"), _meta(spark, sf_dir))


@query(f"WITH {_META} SELECT sample_id FROM meta WHERE sample_id NOT IN (SELECT CAST(item_id AS VARCHAR) FROM benchmark)")
def metadata_unknown(spark, sf_dir):
    nodes = table(spark, sf_dir, "benchmark").select(F.col("item_id").cast("string").alias("sample_id"))
    return metadata.metadata_without_nodes(nodes, _meta(spark, sf_dir))


@query(f"""WITH RECURSIVE {_CLUSTERS}, {_META} SELECT c.sample_id, c.genotype, c.cluster_id, c.cluster_size, coalesce(quality, '(missing)') AS quality, coalesce(toxic, '(missing)') AS toxic
FROM clusters c LEFT JOIN meta m USING (sample_id)""")
def clusters_with_metadata(spark, sf_dir):
    return metadata.join_metadata(_clusters(spark, sf_dir).drop("cluster_no"), _meta(spark, sf_dir))


# --- genotyping -------------------------------------------------------------------------------------------------------

_RANKED = f"""{HITS_SQL}, ranked AS (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY "primary" DESC, alignment_score DESC, matching_bases DESC, query_aligned_bases DESC, identity DESC, mapq DESC, target_id) AS hit_rank FROM hits)"""


@query(f"WITH {_RANKED} SELECT query_id, target_id, alignment_score FROM ranked WHERE hit_rank = 1")
def best_hit(spark, sf_dir):
    return genotyping.ranked_hits(hits(spark, sf_dir)).filter("hit_rank = 1").select("query_id", "target_id", "alignment_score")


def _assigned(spark, sf_dir):
    h = hits(spark, sf_dir).withColumns({"query_span_coverage": F.col("query_coverage"), "target_coverage": F.col("query_coverage"), "identity_method": F.lit("block_fallback"), "alignment_segment_count": F.lit(1)})
    orders = table(spark, sf_dir, "orders").select(F.col("o_orderkey").cast("string").alias("seq_id"), F.lit("ACGTN" * 200).alias("sequence"))
    return genotyping.assignments(orders, h)


_ASSIGNED = f"""{_RANKED},
best AS (SELECT query_id, target_id AS best_ref, split_part(target_id, '_', 1) AS g, alignment_score AS best_score FROM ranked WHERE hit_rank = 1),
second AS (SELECT query_id, alignment_score AS second_score FROM ranked WHERE hit_rank = 2),
near AS (SELECT r.query_id, string_agg(r.target_id, ';' ORDER BY hit_rank) AS close_hits FROM ranked r JOIN best b USING (query_id) WHERE hit_rank > 1 AND r.alignment_score >= best_score * 0.98 GROUP BY r.query_id),
covered AS (SELECT r.*, row_number() OVER (PARTITION BY r.query_id ORDER BY (query_coverage >= 0.5 AND identity >= 0.75) DESC, query_coverage DESC, alignment_score DESC, identity DESC, matching_bases DESC, mapq DESC, target_id DESC) AS c
  FROM ranked r JOIN best b USING (query_id) WHERE split_part(r.target_id, '_', 1) = b.g),
assigned AS (SELECT CAST(o_orderkey AS VARCHAR) AS sequence_id, concat_ws(';', CASE WHEN best_ref IS NULL THEN 'no_alignment' END, CASE WHEN c.query_coverage < 0.5 THEN 'low_query_coverage' END, CASE WHEN c.identity < 0.75 THEN 'low_identity' END) AS reason,
  g, best_ref, c.target_id AS coverage_ref, best_score, second_score, close_hits, c.query_coverage FROM orders o LEFT JOIN best b ON b.query_id = CAST(o.o_orderkey AS VARCHAR) LEFT JOIN second USING (query_id) LEFT JOIN near USING (query_id)
  LEFT JOIN (SELECT * FROM covered WHERE c = 1) c ON c.query_id = b.query_id)"""


@query(f"""WITH {_ASSIGNED} SELECT sequence_id, CASE WHEN reason = '' THEN g ELSE '' END AS assigned_genotype, CASE WHEN reason = '' THEN 'pass' ELSE 'qc_fail' END AS assignment_status, reason AS qc_fail_reason,
  coalesce(best_ref, '') AS best_ref, coalesce(coverage_ref, '') AS coverage_ref, coalesce(best_score, 0) AS best_alignment_score, second_score AS second_alignment_score, best_score - second_score AS score_margin,
  query_coverage, coalesce(close_hits, '') AS close_hits FROM assigned""")
def genotype_assignment(spark, sf_dir):
    return _assigned(spark, sf_dir).select("sequence_id", "assigned_genotype", "assignment_status", "qc_fail_reason", "best_ref", "coverage_ref", "best_alignment_score", "second_alignment_score", "score_margin", "query_coverage", "close_hits")


@query(f"WITH {_ASSIGNED} SELECT DISTINCT g AS assigned_genotype FROM assigned WHERE reason = ''")
def detected_genotypes(spark, sf_dir):
    return genotyping.detected_genotypes(_assigned(spark, sf_dir))


@query(f"WITH {_ASSIGNED} SELECT CASE WHEN reason = '' THEN g ELSE '' END AS assigned_genotype, count(*) AS n FROM assigned GROUP BY 1")
def genotype_counts(spark, sf_dir):
    return genotyping.genotype_counts(_assigned(spark, sf_dir))


@query(f"WITH {_ASSIGNED} SELECT g AS assigned_genotype, count(*) AS n FROM assigned WHERE reason = '' AND g NOT IN ('1a', '1b', 'A') GROUP BY 1")
def unsupported_genotypes(spark, sf_dir):
    return genotyping.unsupported_genotypes(_assigned(spark, sf_dir), catalog.catalog(spark, {"A": "TEST.1"}))


@query(f"""WITH {_ASSIGNED} SELECT sequence_id, g AS genotype FROM assigned WHERE reason = '' AND g IN ('A', 'R') AND g IN ('1a', '1b', 'A')""")
def supported_sequences(spark, sf_dir):
    known = catalog.catalog(spark, {"A": "TEST.1"})
    return genotyping.supported(_assigned(spark, sf_dir), known, ["A", "R"]).select("sequence_id", F.col("assigned_genotype").alias("genotype"))


@query()
def hit_chains(spark, sf_dir):
    h = hits(spark, sf_dir).withColumn("target_id", F.split_part("target_id", F.lit("."), F.lit(1)))
    return genotyping.hit_chains(h).drop("query_intervals")


_KMERS = f"""q AS (SELECT DISTINCT doc_id, k FROM (SELECT doc_id, substr(s, i, 12) AS k FROM (SELECT *, unnest(range(1, length(s) - 10)) AS i FROM (SELECT doc_id, {SITE_SQL} AS s FROM documents))) WHERE regexp_full_match(k, '[ACGT]{{12}}')),
r AS (SELECT DISTINCT genotype, k FROM (SELECT genotype, substr(s, i, 12) AS k FROM (SELECT *, unnest(range(1, length(s) - 10)) AS i FROM (SELECT item_id % 4 || 'a' AS genotype, {SITE_SQL} AS s FROM benchmark))) WHERE regexp_full_match(k, '[ACGT]{{12}}'))"""


@query(f"""WITH {_KMERS}, n AS (SELECT doc_id, count(*) AS n_kmers FROM q GROUP BY doc_id),
top AS (SELECT *, row_number() OVER (PARTITION BY doc_id ORDER BY common DESC, genotype) AS nth FROM (SELECT doc_id, genotype, count(*) AS common FROM q JOIN r USING (k) GROUP BY ALL))
SELECT d.doc_id, coalesce(n_kmers, 0) AS n_kmers, CASE WHEN n_kmers >= 20 THEN genotype END AS best_genotype, CASE WHEN n_kmers >= 20 THEN coalesce(common, 0) / CAST(n_kmers AS DOUBLE) END AS best_score
FROM documents d LEFT JOIN n USING (doc_id) LEFT JOIN (SELECT * FROM top WHERE nth = 1) USING (doc_id)""")
def kmer_overlap(spark, sf_dir):
    q = table(spark, sf_dir, "documents").select("doc_id", F.expr(SITE_SQL).alias("sequence"))
    r = table(spark, sf_dir, "benchmark").select(F.concat(F.col("item_id") % 4, F.lit("a")).alias("genotype"), F.expr(SITE_SQL).alias("sequence"))
    return genotyping.kmer_overlap(q, r, k=12, key="doc_id")


@query(f"""WITH {_KMERS}, n AS (SELECT doc_id, count(*) AS n_kmers FROM q GROUP BY doc_id), common AS (SELECT doc_id, genotype, count(*) AS common FROM q JOIN r USING (k) GROUP BY ALL),
top AS (SELECT *, row_number() OVER (PARTITION BY doc_id ORDER BY common DESC, genotype) AS nth FROM common),
s AS (SELECT d.doc_id, coalesce(n_kmers, 0) >= 20 AS enough, t.genotype, coalesce(t.common, 0) / CAST(n_kmers AS DOUBLE) AS best, coalesce(c.common, 0) / CAST(n_kmers AS DOUBLE) AS own
  FROM documents d LEFT JOIN n USING (doc_id) LEFT JOIN (SELECT * FROM top WHERE nth = 1) t USING (doc_id) LEFT JOIN (SELECT * FROM common WHERE genotype = '2a') c USING (doc_id))
SELECT doc_id, CASE WHEN enough THEN genotype END AS best_genotype FROM s WHERE NOT enough OR genotype IS NULL OR (genotype <> '2a' AND best - own >= 0.005 AND best >= 0.02)""")
def kmer_failures(spark, sf_dir):
    q = table(spark, sf_dir, "documents").select("doc_id", F.expr(SITE_SQL).alias("sequence"))
    r = table(spark, sf_dir, "benchmark").select(F.concat(F.col("item_id") % 4, F.lit("a")).alias("genotype"), F.expr(SITE_SQL).alias("sequence"))
    own = genotyping.kmer_overlap(q, r.filter("genotype = '2a'"), k=12, key="doc_id").select("doc_id", F.col("best_score").alias("own"))
    scored = genotyping.kmer_overlap(q, r, k=12, key="doc_id").join(own, "doc_id")
    return genotyping.kmer_failures(scored, F.col("own"), "2a").select("doc_id", "best_genotype")


# --- regions and quality ----------------------------------------------------------------------------------------------

_SEGMENTS = [regions.Segment("core", 11, 60), regions.Segment("e1", 81, 150)]


def _columns(s: regions.Segment) -> tuple[int, int]:
    at = regions.position_columns(REFERENCE)
    return at[s.start - 1] + 1, at[s.end - 1] - at[s.start - 1] + 1


_SLICE = " || ".join(f"substr(aligned, {a}, {n})" for a, n in map(_columns, _SEGMENTS))
_WIDTH = sum(s.length for s in _SEGMENTS)
_QC = f"""{STRETCHES_SQL}, sliced AS (SELECT *, {_SLICE} AS region FROM stretches),
qc AS (SELECT seq_id, genotype, region, CAST(len(region) - len(replace(region, '-', '')) AS INTEGER) AS gap_bases, CAST(len(region) - len(replace(region, 'N', '')) AS INTEGER) AS n_bases, len(region) AS l FROM sliced),
scored AS (SELECT *, (l - gap_bases - n_bases) / CAST({_WIDTH} AS DOUBLE) AS coverage_fraction FROM qc)"""


@query(f"WITH {STRETCHES_SQL} SELECT seq_id, {_SLICE} AS region FROM stretches")
def region_slice(spark, sf_dir):
    return regions.slice_region(stretches(spark, sf_dir), REFERENCE, _SEGMENTS).select("seq_id", "region")


def _qc(spark, sf_dir):
    return regions.coverage_qc(regions.slice_region(stretches(spark, sf_dir), REFERENCE, _SEGMENTS), _WIDTH)


@query(f"WITH {_QC} SELECT seq_id, gap_bases, n_bases, coverage_fraction, coverage_fraction >= 0.7 AS passed_qc, CASE WHEN coverage_fraction >= 0.7 THEN '' ELSE 'low_e1_e2_coverage' END AS removal_reason, replace(region, 'N', '-') AS clustering FROM scored")
def coverage_qc(spark, sf_dir):
    return _qc(spark, sf_dir).select("seq_id", "gap_bases", "n_bases", "coverage_fraction", "passed_qc", "removal_reason", "clustering")


@query(f"WITH {_QC} SELECT genotype, count(*) AS total, count(*) FILTER (coverage_fraction >= 0.7) AS passed FROM scored GROUP BY genotype")
def qc_stats(spark, sf_dir):
    return regions.qc_stats(_qc(spark, sf_dir), ["genotype"])


@query("""WITH i AS (SELECT l_orderkey, l_partkey % 200 AS s, l_partkey % 200 + CAST(l_quantity AS BIGINT) AS e FROM lineitem),
b AS (SELECT *, max(e) OVER (PARTITION BY l_orderkey ORDER BY s, e ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS before FROM i),
g AS (SELECT *, sum(CASE WHEN s <= before + 1 THEN 0 ELSE 1 END) OVER (PARTITION BY l_orderkey ORDER BY s, e ROWS UNBOUNDED PRECEDING) AS island FROM b)
SELECT l_orderkey, min(s) AS "start", max(e) AS "end", count(*) AS n_merged FROM g GROUP BY l_orderkey, island""")
def merge_segments(spark, sf_dir):
    rows = table(spark, sf_dir, "lineitem")
    spans = rows.select("l_orderkey", (F.col("l_partkey") % 200).alias("start"), (F.col("l_partkey") % 200 + F.col("l_quantity").cast("long")).alias("end"))
    return regions.merge_intervals(spans, ["l_orderkey"])


_SEARCH = [regions.Segment("cds", 1, 190)]
_WINDOWS = regions.candidate_windows(_SEARCH, 50, 25, 20)
_WINDOW_SQL = ", ".join(f"({i}, {w.start}, {w.end}, {_columns(w)[0]}, {_columns(w)[1]})" for i, w in enumerate(_WINDOWS))


@query(f"""WITH {STRETCHES_SQL}, w(window_no, "start", "end", c, n) AS (VALUES {_WINDOW_SQL}),
u AS (SELECT window_no, "start", "end", len(replace(replace(substr(aligned, c, n), '-', ''), 'N', '')) / CAST("end" - "start" + 1 AS DOUBLE) AS cov FROM stretches, w)
SELECT window_no, "start", "end", count(*) FILTER (cov >= 0.7) AS support_count, round(avg(cov), 9) AS mean_coverage FROM u GROUP BY ALL""")
def window_support(spark, sf_dir):
    return regions.window_support(stretches(spark, sf_dir), REFERENCE, _WINDOWS).withColumn("mean_coverage", F.round("mean_coverage", 9))


_PLACES = f"pos AS (SELECT row_number() OVER (ORDER BY c) AS p, c FROM (SELECT unnest(range(1, {len(REFERENCE)} + 1)) AS c) WHERE substr('{REFERENCE}', c, 1) <> '-')"


@query(f"""WITH {STRETCHES_SQL}, {_PLACES}, w(window_no, "start", "end", c, n) AS (VALUES {_WINDOW_SQL}),
u AS (SELECT window_no, "start", "end", len(replace(replace(substr(aligned, c, n), '-', ''), 'N', '')) / CAST("end" - "start" + 1 AS DOUBLE) AS cov FROM stretches, w),
sup AS (SELECT window_no, "start", "end", count(*) FILTER (cov >= 0.7) AS s FROM u GROUP BY ALL),
need AS (SELECT greatest(1, ceil(count(*) * 0.5)) AS need FROM stretches),
chosen AS (SELECT t, "start", "end", max("end") OVER (PARTITION BY t ORDER BY "start", "end" ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS before
  FROM (SELECT DISTINCT s AS t FROM sup, need WHERE s >= need) JOIN sup ON s >= t),
seg AS (SELECT t, min("start") AS "start", max("end") AS "end" FROM (SELECT *, sum(CASE WHEN "start" <= before + 1 THEN 0 ELSE 1 END) OVER (PARTITION BY t ORDER BY "start", "end" ROWS UNBOUNDED PRECEDING) AS island FROM chosen) GROUP BY t, island),
size AS (SELECT t, sum("end" - "start" + 1) AS length, count(*) AS n_segments FROM seg GROUP BY t),
held AS (SELECT t, seq_id, sum(len(replace(replace(substr(aligned, a.c, b.c - a.c + 1), '-', ''), 'N', ''))) AS usable FROM seg JOIN pos a ON a.p = seg."start" JOIN pos b ON b.p = seg."end", stretches GROUP BY t, seq_id),
score AS (SELECT t, length, n_segments, count(*) FILTER (usable / CAST(length AS DOUBLE) >= 0.7) AS retained FROM held JOIN size USING (t) GROUP BY ALL),
best AS (SELECT t FROM score, need WHERE retained >= need ORDER BY retained * length DESC, retained DESC, length DESC, t DESC, n_segments LIMIT 1)
SELECT 'max' || lpad(CAST(row_number() OVER (ORDER BY "start") AS VARCHAR), 2, '0') AS name, CAST("start" AS INTEGER) AS "start", CAST("end" AS INTEGER) AS "end", CAST("end" - "start" + 1 AS INTEGER) AS length FROM seg WHERE t = (SELECT t FROM best)""")
def max_usable(spark, sf_dir):
    chosen, _ = regions.max_usable(stretches(spark, sf_dir), REFERENCE, _SEARCH, size=50, step=25, least_window=20)
    return spark.createDataFrame([(s.name, s.start, s.end, s.length) for s in chosen], "name string, start int, end int, length int")


@query("""SELECT region, CAST(threshold AS DOUBLE) AS threshold, evidence FROM (VALUES ('e1-e2', 0.03, false), ('core-e2', 0.045, true), ('core+e1+e2', 0.045, true), ('ns5b', 0.015, true), ('structural', 0.03, true), ('cds', 0.03, false)) t(region, threshold, evidence)""")
def region_thresholds(spark, sf_dir):
    names = ("e1-e2", "core-e2", "core+e1+e2", "ns5b", "structural", "cds")
    return spark.createDataFrame([(n, regions.threshold_for(n), regions.threshold_has_evidence(n)) for n in names], "region string, threshold double, evidence boolean")


# --- reuse and encodings ----------------------------------------------------------------------------------------------


def _cache(spark, sf_dir):
    """A cache of two thirds of the sequences, a part of them with another recorded input."""
    rows = aligned(spark, sf_dir).filter("record_idx % 3 <> 0").withColumn("header", F.col("seq_id"))
    changed = F.when(F.col("record_idx") % 5 == 0, F.concat("aligned", F.lit("A"))).otherwise(F.col("aligned"))
    return rows.select("header", fn.fingerprint(changed).alias("fingerprint"), "aligned")


_CACHE = f"{ALIGNED_SQL}, cached AS (SELECT seq_id AS header, sha256(CASE WHEN record_idx % 5 = 0 THEN aligned || 'A' ELSE aligned END) AS fp FROM aligned WHERE record_idx % 3 <> 0)"


@query(f"WITH {_CACHE} SELECT a.seq_id AS header FROM aligned a LEFT JOIN cached c ON c.header = a.seq_id AND c.fp = sha256(a.aligned) WHERE c.header IS NULL")
def alignment_reuse(spark, sf_dir):
    records = aligned(spark, sf_dir).select(F.col("seq_id").alias("header"), F.col("aligned").alias("sequence"))
    return reuse.split_by_cache(records, _cache(spark, sf_dir))[1].select("header")


@query(f"WITH {_CACHE} SELECT header, sha256(a.aligned) AS aligned_sha256 FROM aligned a JOIN cached c ON c.header = a.seq_id AND c.fp = sha256(a.aligned)")
def reused_alignments(spark, sf_dir):
    records = aligned(spark, sf_dir).select(F.col("seq_id").alias("header"), F.col("aligned").alias("sequence"))
    return reuse.split_by_cache(records, _cache(spark, sf_dir))[0].select("header", F.sha2("aligned", 256).alias("aligned_sha256"))


@query(f"WITH {_CACHE} SELECT count(c.header) AS reused, count(*) AS total FROM aligned a LEFT JOIN cached c ON c.header = a.seq_id AND c.fp = sha256(a.aligned)")
def reuse_counts(spark, sf_dir):
    records = aligned(spark, sf_dir).select(F.col("seq_id").alias("header"), F.col("aligned").alias("sequence"))
    return reuse.reuse_counts(records, _cache(spark, sf_dir))


@query("""WITH c AS (SELECT DISTINCT coalesce(nullif(trim(source), ''), '(missing)') AS category FROM documents)
SELECT category, CAST(position AS INTEGER) AS position, CAST(CASE WHEN category = '(missing)' THEN -1 ELSE position % 20 END AS INTEGER) AS slot
FROM (SELECT category, dense_rank() OVER (ORDER BY category = '(missing)', lower(category), category) - 1 AS position FROM c)""")
def category_mapping(spark, sf_dir):
    return encodings.category_mapping(table(spark, sf_dir, "documents"), "source")


@query("SELECT c_custkey AS sample_id, CASE WHEN c_acctbal IS NULL THEN 8.0 ELSE 9.0 + (c_acctbal - lo) / (hi - lo) * 10.0 END AS size FROM customer, (SELECT min(c_acctbal) AS lo, max(c_acctbal) AS hi FROM customer)")
def size_scaling(spark, sf_dir):
    return encodings.numeric_sizes(table(spark, sf_dir, "customer").withColumnRenamed("c_custkey", "sample_id"), "c_acctbal")


_ORDER = ["fr", "en", "xx", "de", "es"]


@query(f"""WITH o AS (SELECT unnest({_ORDER}) AS v, unnest(range(0, {len(_ORDER)})) AS i), p AS (SELECT v, row_number() OVER (ORDER BY i) - 1 AS i, count(*) OVER () AS n FROM o WHERE v IN (SELECT trim(lang) FROM documents))
SELECT doc_id AS sample_id, CASE WHEN p.v IS NULL THEN 8.0 WHEN n = 1 THEN 13.0 ELSE 9.0 + i / CAST(n - 1 AS DOUBLE) * 10.0 END AS size FROM documents LEFT JOIN p ON p.v = trim(lang)""")
def ordered_sizes(spark, sf_dir):
    return encodings.ordered_sizes(table(spark, sf_dir, "documents").withColumnRenamed("doc_id", "sample_id"), "lang", _ORDER)


_FIELDS = ("p_name", "p_brand", "p_type", "p_size", "p_retailprice")


@query(" UNION ALL ".join(
    f"""SELECT {i} AS position, '{c}' AS field, count(DISTINCT v) AS n_categories, coalesce(bool_and(regexp_full_match(v, '[+-]?([0-9]+\\.?[0-9]*|\\.[0-9]+)([eE][+-]?[0-9]{{1,2}})?')), false) AS sizeable FROM (SELECT nullif(nullif(trim(CAST({c} AS VARCHAR)), ''), '(missing)') AS v FROM part)"""
    for i, c in enumerate(_FIELDS)
))
def plot_fields(spark, sf_dir):
    return encodings.plot_fields(table(spark, sf_dir, "part").select(*_FIELDS))


@query("""SELECT l_orderkey, l_linenumber, format('{:.6f}', l_extendedprice / 7) AS fixed, format('{:.10g}', (l_partkey % 300) / CAST(2000 + l_suppkey * pow(10, l_linenumber) AS DOUBLE)) AS general FROM lineitem""")
def number_texts(spark, sf_dir):
    rows = table(spark, sf_dir, "lineitem")
    share = (F.col("l_partkey") % 300) / (2000 + F.col("l_suppkey") * F.pow(F.lit(10.0), "l_linenumber"))
    return rows.select("l_orderkey", "l_linenumber", fn.fixed_number(F.col("l_extendedprice") / 7).alias("fixed"), fn.general_number(share).alias("general"))


def _escaped(column: str) -> str:
    for raw, safe in (("&", "&amp;"), ("<", "&lt;"), (">", "&gt;"), ('"', "&quot;"), ("''", "&#x27;")):
        column = f"replace({column}, '{raw}', '{safe}')"
    return column


@query(f"SELECT page_id, sha256(concat_ws('<br>', 'page id: ' || page_id, 'url &amp; host: ' || {_escaped('url')}, 'html: ' || {_escaped('html')})) AS text_sha256 FROM pages")
def hover_texts(spark, sf_dir):
    rows = table(spark, sf_dir, "pages")
    label = lambda c: c.replace("_", " ")
    return rows.select("page_id", F.sha2(fn.hover_text((label("page_id"), F.col("page_id")), ("url & host", F.col("url")), ("html", F.col("html"))), 256).alias("text_sha256"))


@query("""SELECT p_partkey, lower(trim(p_brand || ' ')) AS genotype, CASE p_size % 4 WHEN 0 THEN '0–30' WHEN 1 THEN '31–60' WHEN 2 THEN '61+' END AS spelled,
  coalesce(nullif(trim(CASE WHEN p_size > 25 THEN p_type ELSE '  ' END), ''), p_name) AS key, replace(p_name || '_' || p_size, '_', ' ') AS label FROM part""")
def plain_names(spark, sf_dir):
    size = F.col("p_size")
    range_ = F.when(size % 4 == 0, " 0-30").when(size % 4 == 1, "31–60").when(size % 4 == 2, "61+ ").otherwise("old")
    return table(spark, sf_dir, "part").select(
        "p_partkey", fn.normalized_genotype(F.concat("p_brand", F.lit(" "))).alias("genotype"), fn.age_range_spelling(range_).alias("spelled"),
        fn.metadata_key(F.when(size > 25, F.col("p_type")).otherwise("  "), F.col("p_name")).alias("key"), fn.field_label(F.concat_ws("_", "p_name", "p_size")).alias("label"),
    )


@query("""SELECT * FROM (SELECT 'shape' AS channel, 'source' AS field, count(DISTINCT source) AS n_categories, 12 AS most FROM documents UNION ALL
SELECT 'centre', 'lang', count(DISTINCT lang), 5 FROM documents) WHERE n_categories > most""")
def encoding_warnings(spark, sf_dir):
    return encodings.encoding_warnings(table(spark, sf_dir, "documents"), {"shape": "source", "centre": "lang"})


# --- files ------------------------------------------------------------------------------------------------------------

for _trip, _trip_sql in (
    (round_trips.fasta_round_trip, round_trips.FASTA_SQL),
    (round_trips.genbank_sequences, round_trips.GENBANK_SEQUENCES_SQL),
    (round_trips.genbank_features, round_trips.GENBANK_FEATURES_SQL),
    (round_trips.paf_round_trip, round_trips.PAF_SQL),
    (round_trips.links_round_trip, round_trips.LINKS_SQL),
    (round_trips.distances_round_trip, round_trips.DISTANCES_SQL),
    (round_trips.nodes_round_trip, round_trips.NODES_SQL),
    (round_trips.metadata_round_trip, round_trips.METADATA_SQL),
    (round_trips.genotype_table, round_trips.genotype_sql(_RANKED)),
):
    query(_trip_sql)(_trip)
