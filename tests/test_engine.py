"""Expected results of the engine's operators on small inputs."""

import itertools
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from strandline.functions import sequence as fn
from strandline.operators import catalog, distance, encodings, genotyping, graph, layouts, metadata, regions, reuse, variants
from strandline.sources import readers, writers
from strandline.streaming import incremental

REGIONS = {n: regions.Segment(n, a, b) for n, a, b in (("core", 342, 914), ("e1", 915, 1490), ("e2", 1491, 2768), ("p7", 2769, 2957), ("ns5b", 7602, 9374))}


def one(spark, **cols):
    return spark.range(1).select(*[c.alias(k) for k, c in cols.items()]).first().asDict()


def aligned(spark, seqs, genotype="1a"):
    return spark.createDataFrame([(genotype, i, n, s) for i, (n, s) in enumerate(seqs)], "genotype string, record_idx long, seq_id string, aligned string")


def test_scalar_functions(spark):
    got = one(
        spark,
        a=fn.normalized_input(F.lit("ACGT--ACGT")), b=fn.normalized_input(F.lit("acgu\n")), c=fn.normalized_input(F.lit("----")), d=fn.n_as_gap(F.lit("ACGTNNNNACGTn")),
        e=fn.header_genotype(F.lit("x|genotype=1A|y")), f=fn.header_genotype(F.lit("x|GT3a")), g=fn.header_genotype(F.lit("plain")), h=fn.safe_name(F.lit("a b/c")),
        i=fn.age_range(F.lit("30")), j=fn.age_range(F.lit("31")), k=fn.age_range(F.lit("61.0")), l=fn.age_range(F.lit("")), m=fn.age_error(F.lit("3.5")), n=fn.age_error(F.lit("-1")), o=fn.age_error(F.lit("inf")),
        p=fn.general_number(F.lit(0.015)), q=fn.general_number(F.lit(1e-5)), r=fn.general_number(F.lit(0.0)), s=fn.kmers(F.lit("ACG"), 4), t=F.size(fn.kmers(F.lit("ACGTACGTN"), 4)), u=fn.wrapped(F.lit("A" * 160)),
    )
    assert (got["a"], got["b"], got["c"], got["d"]) == ("ACGTACGT", "ACGT", "", "ACGT----ACGT-")
    assert (got["e"], got["f"], got["g"], got["h"]) == ("1a", "3a", None, "a_b_c")
    assert (got["i"], got["j"], got["k"], got["l"]) == ("0–30", "31–60", "61+", "(missing)")
    assert got["m"] and got["n"] and got["o"]
    assert (got["p"], got["q"], got["r"], got["s"], got["t"], got["u"]) == ("0.015", "1e-05", "0", [], 4, "A" * 80 + "\n" + "A" * 80)


def test_general_numbers(spark):
    rng = random.Random(4)
    values = [rng.uniform(-10, 10) * 10 ** rng.randint(-12, 14) for _ in range(500)] + [9.9999999999e-5, 9999999999.96, 1e-7, 0.0, 1e120, float("nan"), float("inf"), float("-inf"), None]
    rows = spark.createDataFrame([(x,) for x in values], "x double").select("x", fn.general_number(F.col("x")).alias("t")).collect()
    assert [r.t for r in rows] == [None if r.x is None else f"{r.x:.10g}" for r in rows]


def test_numbers_beside_ties(spark):
    """Doubles just beside a decimal tie, and exact ties, are rounded as C rounds them."""
    values = [k % 300 / (2000 + s * 10.0**n) for k in range(1, 300, 7) for s in range(1, 40, 3) for n in (1, 2, 4)] + [3.2470703125e-05, 5e-7, 2.0000005, 0.0000015, 0.125, -5e-7, float("nan"), None]
    rows = spark.createDataFrame([(x,) for x in values], "x double").select("x", fn.general_number(F.col("x")).alias("g"), fn.fixed_number(F.col("x")).alias("f")).collect()
    assert [(r.g, r.f) for r in rows] == [(None, None) if r.x is None else (f"{r.x:.10g}", f"{r.x:.6f}") for r in rows]


def test_snp_distance_cases_and_brute_force(spark):
    two = distance.snp_pairs(aligned(spark, [("seq1", "ACGT-N"), ("seq2", "ACGG-N")]), 6).collect()
    assert [(r.snp_count, r.comparable_sites, r.distance) for r in two] == [(1, 4, 0.25)]
    none = distance.snp_pairs(aligned(spark, [("a", "NN"), ("b", "--")]), 2).first()
    assert (none.distance, none.comparable_sites) == (1.0, 0)
    rng = random.Random(1)
    seqs = [(f"s{i}", "".join(rng.choice("ACGTN-R") for _ in range(130))) for i in range(23)]
    got = {(r.source, r.target): (r.snp_count, r.comparable_sites) for r in distance.snp_pairs(aligned(spark, seqs), 130).collect()}
    want = {}
    for (a, x), (b, y) in itertools.combinations(seqs, 2):
        sites = [(p, q) for p, q in zip(x, y, strict=True) if p in "ACGT" and q in "ACGT"]
        want[a, b] = (sum(p != q for p, q in sites), len(sites))
    assert got == want
    blocks = distance.snp_pairs(aligned(spark, seqs), block_rows=4).collect()
    assert len(blocks) == len(want) and {(r.source, r.target): (r.snp_count, r.comparable_sites) for r in blocks} == want
    within = distance.snp_pairs(aligned(spark, seqs), at_most=0.7, most_snps=25, block_rows=4).collect()
    assert {(r.source, r.target) for r in within} == {k for k, (n, of) in want.items() if n <= 25 and n / of <= 0.7} != set()


def test_distances_of_unequal_and_long_sequences(spark):
    rng = random.Random(2)
    base = "".join(rng.choice("ACGT") for _ in range(5000))
    seqs = [(f"s{i}", "".join(c if rng.random() > 0.02 else rng.choice("acgtN-Rü漢") for c in base[: rng.choice((0, 1, 2047, 2048, 2049, 4096, 5000))])) for i in range(17)] + [("none", None)]
    got = {(r.source, r.target): (r.snp_count, r.comparable_sites) for r in distance.snp_pairs(aligned(spark, seqs), block_rows=5).collect()}
    plain = {(a, b): [(p, q) for p, q in zip((x or "").upper(), (y or "").upper(), strict=False) if p in "ACGT" and q in "ACGT"] for (a, x), (b, y) in itertools.combinations(seqs, 2)}
    assert got == {k: (sum(p != q for p, q in v), len(v)) for k, v in plain.items()}
    same = {(r.source, r.target) for r in distance.tn93_pairs(aligned(spark, seqs), "skip", 0.0, block_rows=5).collect()}
    assert same == {k for k, v in plain.items() if v and all(p == q for p, q in v)}


def test_links_and_summary(spark):
    pairs = spark.createDataFrame([("a", "b", 0.015, 30, 2000), ("c", "d", 0.06, 30, 500), ("e", "f", 0.0062, 31, 5000), ("g", "g", 0.0, 0, 10)], "source string, target string, distance double, snp_count int, comparable_sites int")
    assert {r.source for r in distance.links_by_distance(pairs, 0.03).collect()} == {"a", "e"}
    assert {r.source for r in distance.links_by_snps(pairs, 30).collect()} == {"a", "c"}
    with pytest.raises(ValueError, match="non-negative"):
        distance.links_by_snps(pairs, -1)
    s = distance.snp_summary(spark.createDataFrame([(5, 2000), (30, 2100), (12, 1900)], "snp_count int, comparable_sites int")).first()
    assert (s.min_snps, s.max_snps, s.median_snps, s.min_sites, s.max_sites) == (5, 30, 12, 1900, 2100)
    assert "snp_count" not in distance.merged_links([pairs, pairs.drop("snp_count")]).columns


def test_tn93(spark):
    same = "ACGT" * 25
    assert distance.tn93_pairs(aligned(spark, [("a", same), ("b", same)])).first().distance == 0.0
    masked = "N" * 20 + same[20:]
    by_mode = {m: distance.tn93_pairs(aligned(spark, [("a", same), ("b", masked)]), m).first().distance for m in distance.MODES}
    assert by_mode["average"] == pytest.approx(0.168, abs=0.002)
    assert by_mode["skip"] == by_mode["resolve"] == 0.0
    n = np.diag([25.0] * 4)
    n[0, 2] = 5
    p = 5 / 105
    assert distance.tn93_from_counts(n) == pytest.approx(p, abs=0.01)
    assert distance.tn93_from_counts(np.zeros((4, 4))) == 1.0


def test_components_against_brute_force(spark):
    rng = random.Random(3)
    nodes = [f"n{i:03d}" for i in range(90)]
    edges = [(rng.choice(nodes), rng.choice(nodes)) for _ in range(60)] + [(nodes[i], nodes[i + 1]) for i in range(30, 60)]
    root = {n: n for n in nodes}
    for _ in nodes:
        for a, b in edges:
            root[a] = root[b] = min(root[a], root[b])
    links = spark.createDataFrame(edges, "source string, target string")
    found = graph.components(spark.createDataFrame([(n,) for n in nodes], "sample_id string"), links)
    assert {r.sample_id: r.root for r in found.collect()} == root
    numbered = graph.number_clusters(found).collect()
    order = sorted(set(root.values()))
    assert all(r.cluster_id == f"C{order.index(root[r.sample_id]) + 1:04d}" for r in numbered)
    empty = graph.components(spark.createDataFrame([("x",)], "sample_id string"), links.limit(0))
    assert [tuple(r) for r in empty.collect()] == [("x", "x")]


def test_regions():
    names = lambda text: [(s.start, s.end) for s in regions.resolve(text, REGIONS)]
    assert names("core-e2-nohvr1") == [(342, 1490), (1572, 2768)]
    assert names("core-e2") == [(342, 2768)]
    assert names("e1-e2-nohvr1") == [(915, 1490), (1572, 2768)]
    assert names("core+e1,ns5b") == [(342, 1490), (7602, 9374)]
    for good in ("ns5b", "e1-e2", "structural", "cds", "core-e2+ns3"):
        regions.validate_expression(good)
    for bad in ("not-a-region", "ns5b-core", "", "ns5b-nohvr1", "core-ns3-nohvr1", "e2-nohvr1", "core-e2-nohvr1+ns3-nohvr1"):
        with pytest.raises(regions.RegionError):
            regions.validate_expression(bad)
    assert [regions.threshold_for(r) for r in ("E1-E2", "core-e2", "ns5b", "cds", "core+e1+e2")] == [0.03, 0.045, 0.015, 0.03, 0.045]
    assert regions.threshold_for("cds", 0.1) == 0.1 and not regions.threshold_has_evidence("e1-e2")
    slugs = {("core-e2", "fixed"): "low_core_e2_coverage", ("ns5b", "max-usable"): "low_max_usable_ns5b_coverage", ("", "max-usable"): "low_max_usable_coverage", ("+", "fixed"): "low_selected_region_coverage"}
    assert {k: regions.reason_slug(*k) for k in slugs} == slugs
    windows = lambda *how: [(w.start, w.end) for w in regions.candidate_windows([regions.Segment("x", 1, 25)], *how)]
    assert windows(10, 10, 5) == [(1, 10), (11, 20), (21, 25)] and windows(10, 10, 6) == [(1, 10), (11, 20)]
    assert windows(10, 5, 5) == [(1, 10), (6, 15), (11, 20), (16, 25)] and windows(30, 5, 5) == [(1, 25)] and windows(5, 12, 1) == [(1, 5), (13, 17), (25, 25)]
    assert len(catalog.references()) == 84 and catalog.references({"9z": "X.1"})["9z"] == "X.1"


def test_slice_qc_and_max_usable(spark):
    sliced = regions.slice_region(aligned(spark, [("a", "ACGTNNGTAC")]), "ACGTACGTAC", [regions.Segment("x", 1, 10)])
    qc = regions.coverage_qc(sliced, 10, 0.5).first()
    assert (qc.n_bases, qc.passed_qc, qc.clustering, qc.aligned) == (2, True, "ACGT--GTAC", "ACGTNNGTAC")
    rows = [(f"s{i}", "ACGTA" * 4 + ("ACGTA" if i < 3 else "-----") * 4) for i in range(5)]
    best, scores = regions.max_usable(aligned(spark, rows), "ACGTA" * 8, [regions.Segment("cds", 1, 40)], size=10, step=10, least_window=5, least_taxa=0.5)
    assert [(s.name, s.start, s.end) for s in best] == [("max01", 1, 40)] or [(s.start, s.end) for s in best] == [(1, 20)]
    assert max(r["retained"] * r["length"] for r in scores.collect()) == max(3 * 40, 5 * 20)
    stale = regions.correct_stale(spark.createDataFrame([("e2", 1489, 2544), ("ns5b", 7580, 9352)], "name string, start int, end int"), spark.createDataFrame([("e2", 1492, 2595), ("ns5b", 7580, 9349)], "name string, start int, end int"))
    assert {tuple(r) for r in stale.collect()} == {("e2", 1489, 2595), ("ns5b", 7580, 9352)}


PAF = "\t".join
SPLIT = [
    PAF(["q", "9453", "4934", "9307", "+", "3a_D17763.1", "9456", "4935", "9308", "3955", "4253", "60", "AS:i:1153", "tp:A:P"]),
    PAF(["q", "9453", "501", "1409", "+", "3a_D17763.1", "9456", "501", "1409", "851", "907", "60", "AS:i:346", "tp:A:P"]),
]


def test_split_hits_are_chained(spark, tmp_path):
    (tmp_path / "hits.paf").write_text("\n".join(SPLIT) + "\n")
    hits = readers.read_paf(spark, str(tmp_path / "hits.paf"))
    chain = genotyping.hit_chains(hits).first()
    assert (chain.alignment_segment_count, chain.query_aligned_bases, chain.alignment_score, chain.identity_method) == (2, 5281, 1499, "block_fallback")
    assert chain.identity == pytest.approx(4806 / 5160)
    sequence = "N" * 501 + "A" * 908 + "N" * (4934 - 1409) + "A" * 4373 + "N" * (9453 - 9307)
    seqs = spark.createDataFrame([("q", sequence), ("z", "ACGT")], "seq_id string, sequence string")
    rows = {r.sequence_id: r for r in genotyping.assignments(seqs, genotyping.with_coverage(genotyping.hit_chains(hits), seqs)).collect()}
    assert (rows["q"].assigned_genotype, rows["q"].non_n_bases, rows["q"].query_coverage) == ("3a", 5281, 1.0)
    assert rows["q"].query_span_coverage == pytest.approx(0.558659, abs=1e-6)
    assert (rows["z"].assignment_status, rows["z"].qc_fail_reason) == ("qc_fail", "no_alignment")
    assert len(rows["q"]) == 27


def test_assignments_read_hits_once(spark):
    """What a row of assignments has of its hits is what ``ranked_hits`` and ``coverage_hits`` say, from one exchange of the hits."""
    draw = random.Random(2)
    pick = lambda *x: draw.choice(x)
    kinds = "query_id string, target_id string, primary boolean, alignment_score long, matching_bases long, query_aligned_bases long, identity double, mapq long, query_coverage double, query_span_coverage double, target_coverage double, identity_method string, block_identity double, alignment_block_length long, alignment_segment_count int"
    made = [(f"q{i % 40}", pick("1a_x", "1a_y", "3a_z", "_w", "") + str(i), pick(True, False), pick(90, 99, 100), pick(1, 2), pick(3, 4), pick(0.7, 0.8, None), pick(5, 60), pick(0.4, 0.6, None, float("nan")), i / 7, i / 9, "m", 0.5, i, i) for i in range(300)]
    hits = spark.createDataFrame(made, kinds)
    found = genotyping.assignments(spark.createDataFrame([(f"q{i}", "ACGTN") for i in range(42)], "seq_id string, sequence string"), hits)
    rows = {r.sequence_id: r for r in found.collect()}
    ranked: dict = {}
    for r in genotyping.ranked_hits(hits).orderBy("query_id", "hit_rank").collect():
        ranked.setdefault(r.query_id, []).append(r)
    covering = {r.query_id: r for r in genotyping.coverage_hits(hits).collect()}
    group = lambda t: t.partition("_")[0]
    for q, row in rows.items():
        h = ranked.get(q, [])
        near = [x.target_id for x in h[1:] if x.alignment_score >= h[0].alignment_score * 0.98]
        others = [group(t) for t in near if group(t) and group(t) != group(h[0].target_id)] if h and group(h[0].target_id) else []
        c = covering.get(q)
        assert row.best_ref == (h[0].target_id if h else "") and row.second_alignment_score == (h[1].alignment_score if len(h) > 1 else None)
        assert (row.close_hits, row.other_potential_genotypes) == (";".join(near), ";".join(dict.fromkeys(others)))
        assert (row.coverage_ref, row.target_coverage, row.alignment_segment_count) == ((c.target_id, c.target_coverage, c.alignment_segment_count) if c else ("", None, 0))
    assert len(rows) == 42 and len(covering) > 20
    assert found._jdf.queryExecution().optimizedPlan().toString().count("Window [row_number()") == 1


def test_chains_refuse_discordant_gaps_and_overlaps():
    hit = lambda qs, qe, ts, te, score: {"query_start": qs, "query_end": qe, "target_start": ts, "target_end": te, "alignment_score": score, "matching_bases": score, "primary": True, "strand": "+"}
    assert len(genotyping.best_chain([hit(0, 3000, 0, 3000, 900), hit(4000, 7000, 7000, 9500, 800)])) == 1
    assert [h["query_end"] for h in genotyping.best_chain([hit(0, 4000, 0, 4000, 900), hit(3500, 7000, 3500, 7000, 800)])] == [4000]


def test_variants(spark):
    recs = spark.createDataFrame([(0, "a", "ACGT"), (1, "b", "ACGT"), (2, "a", "acgt"), (3, "c", "AAAA"), (4, "c", "CCCC")], "record_idx long, seq_id string, sequence string")
    plan = variants.resolve_repeats(recs)
    rows = {r.input_record: r for r in plan.collect()}
    assert [rows[i].sequence_id for i in range(5)] == ["a", "b", "a", "c__v1", "c__v2"] and rows[2].status == "dropped_identical_repeat"
    clash = variants.resolve_repeats(recs.unionByName(spark.createDataFrame([(5, "c__v1", "GG")], recs.schema)))
    assert [r.sequence_id for r in variants.name_collisions(clash).collect()] == ["c__v1"]
    typed = plan.withColumn("genotype", F.lit("1a")).withColumn("region_coverage", F.when(F.col("sequence_id") == "c__v2", 0.9).otherwise(0.8))
    assert {r.sequence_id for r in variants.select_variants(typed).filter("status = 'kept'").collect()} == {"a", "b", "c__v2"}
    marked = variants.annotate_clusters(spark.createDataFrame([("c__v1", "C0001", 1), ("a", "C0002", 1)], "sample_id string, cluster_id string, cluster_size int"), plan)
    assert {(r.sample_id, r.base_sample_id, r.mixed_infection) for r in marked.collect()} == {("c__v1", "c", True), ("a", "a", False)}


def test_metadata(spark, tmp_path):
    (tmp_path / "m.csv").write_text("﻿sample_id,age,location\nA,20,P1\nUNKNOWN,,\n", encoding="utf-8")
    meta = readers.read_metadata(spark, str(tmp_path / "m.csv"))
    assert {r.sample_id: (r.age_range, r.location) for r in meta.collect()} == {"A": ("0–30", "P1"), "UNKNOWN": ("(missing)", "(missing)")}
    nodes = spark.createDataFrame([("A",), ("B",)], "sample_id string")
    assert {r.sample_id: r.location for r in metadata.join_metadata(nodes, meta).collect()} == {"A": "P1", "B": "(missing)"}
    assert [r[0] for r in metadata.nodes_without_metadata(nodes, meta).collect()] == ["B"]
    assert [r[0] for r in metadata.metadata_without_nodes(nodes, meta).collect()] == ["UNKNOWN"]
    with pytest.raises(Exception, match="conflict"):
        metadata.join_metadata(nodes.withColumn("location", F.lit("P2")), meta).collect()
    bad = spark.createDataFrame([("A", "x"), ("A", "5")], "sample_id string, age string")
    with pytest.raises(ValueError, match="repeated sample_id.*|wrong age"):
        metadata.validated(bad)
    for header in (["sample_id", "genotype"], ["sample_id", "a", "a"], ["a"], ["sample_id", ""]):
        with pytest.raises(ValueError):
            metadata.check_header(header)


def test_readers_and_writers(spark, tmp_path):
    (tmp_path / "s.fa").write_text(">a x\nACG\nT\n\n>b\nGG\r\nGG\n>c\nTT\n")
    got = readers.read_fasta(spark, str(tmp_path / "s.fa"), strict=True).orderBy("record_idx").collect()
    assert [(r.header, r.seq_id, r.sequence) for r in got] == [("a x", "a", "ACGT"), ("b", "b", "GGGG"), ("c", "c", "TT")]
    writers.write_fasta(readers.read_fasta(spark, str(tmp_path / "s.fa")), str(tmp_path / "out"))
    assert readers.read_fasta(spark, str(tmp_path / "out") + "/part-*").count() == 3
    (tmp_path / "d.csv").write_text("ID1,ID2,Distance\nA,B,.01\nA,C,.02\n,C,.02\n")
    assert {tuple(r) for r in readers.read_distances(spark, str(tmp_path / "d.csv")).collect()} == {("A", "B", 0.01), ("A", "C", 0.02)}
    (tmp_path / "l.csv").write_text("A,B\nB,C\n")
    assert {tuple(r) for r in readers.read_links(spark, str(tmp_path / "l.csv")).collect()} == {("A", "B", None), ("B", "C", None)}
    (tmp_path / "n.txt").write_text("A\nB\nA\n")
    assert [r.node for r in readers.read_nodes(spark, str(tmp_path / "n.txt")).orderBy("first_idx").collect()] == ["A", "B"]
    assert readers.reference_map('{"1A": "X.1", "2b": {"accession": "Y.1"}}') == {"1a": "X.1", "2b": "Y.1"}


def test_reuse_and_stream(spark, tmp_path):
    records = spark.createDataFrame([("a", "ACGT"), ("b", "CC"), ("c", "GG")], "header string, sequence string")
    cached = reuse.with_fingerprint(spark.createDataFrame([("a", "ACGT"), ("b", "CCC")], "header string, sequence string")).withColumn("aligned", F.col("sequence"))
    hit, miss = reuse.split_by_cache(records, cached)
    assert [r.header for r in hit.collect()] == ["a"] and {r.header for r in miss.collect()} == {"b", "c"}
    assert tuple(reuse.reuse_counts(records, cached).first()) == (1, 3)
    with pytest.raises(ValueError, match="version"):
        reuse.check_cache({"version": 2}, "R", "f", 8)
    (tmp_path / "in").mkdir()
    records.coalesce(1).write.mode("append").parquet(str(tmp_path / "in"))
    for _ in range(2):
        stream = spark.readStream.schema(records.schema).parquet(str(tmp_path / "in"))
        incremental.accumulate(stream, str(tmp_path / "store"), str(tmp_path / "ck")).awaitTermination()
        records.limit(2).coalesce(1).write.mode("append").parquet(str(tmp_path / "in"))
    assert spark.read.parquet(str(tmp_path / "store")).count() == 3


def test_encodings(spark):
    nodes = spark.createDataFrame([("A", "61+", "1"), ("B", "0–30", "3"), ("C", "", "")], "sample_id string, age string, n string")
    assert {r.sample_id: r.size for r in encodings.ordered_sizes(nodes, "age").collect()} == {"A": 19.0, "B": 9.0, "C": 8.0}
    assert {r.sample_id: r.size for r in encodings.numeric_sizes(nodes, "n").collect()} == {"A": 9.0, "B": 19.0, "C": 8.0}
    assert [r.category for r in encodings.category_mapping(nodes, "age").orderBy("position").collect()] == ["0–30", "61+", "(missing)"]
    xy = layouts.separated(np.zeros((6, 2)))
    d = np.sqrt(((xy[:, None] - xy[None]) ** 2).sum(axis=2))[np.triu_indices(6, 1)]
    assert d.min() >= 0.279
