"""Links under a threshold by the window index against all pairs."""

import random
import time

import numpy as np
import pytest
from pyspark.sql import functions as F

from strandline.operators import distance, near_links
from strandline.session import release

SCHEMA = "genotype string, record_idx long, seq_id string, aligned string, g string, i long, r long, n long"


def frame(spark, seqs, genotypes=("1a", "3a")):
    """Rows with columns whose names clash with the operator's own."""
    return spark.createDataFrame([(genotypes[j % len(genotypes)], j, f"s{j}", q, "x", 1, 2, 3) for j, q in enumerate(seqs)], SCHEMA)


def rows(df):
    return sorted((r.genotype, r.source, r.target, round(r.distance, 12), r.snp_count, r.comparable_sites) for r in df.collect())


def families(rng, letters, lengths, families=12, size=6):
    out = []
    for _ in range(families):
        base = [rng.choice(letters) for _ in range(rng.choice(lengths))]
        for _ in range(size):
            new = list(base)
            for _ in range(rng.randint(0, 12)):
                if new:
                    new[rng.randrange(len(new))] = rng.choice("ACGTN-RY")
            out.append("".join(new[: rng.choice([len(new), len(new) - 3])]))
    return out


CASES = {
    "plain": dict(letters="ACGT", lengths=[300, 700, 2000]),
    "unknown sites": dict(letters="ACGT" * 4 + "N-RY", lengths=[150, 400, 1500]),
    "half unknown": dict(letters="ACGTNN--", lengths=[200, 900]),
    "short": dict(letters="ACGT", lengths=[3, 20, 60, 130]),
}


@pytest.mark.parametrize("index", [True, False])
def test_same_as_all_pairs(spark, index):
    aligned = None
    for case, how in CASES.items():
        seqs = families(random.Random(len(case)), **how)
        part = frame(spark, seqs + seqs[:5] + ["", None, "NNNN", "acgu" * 50, "é" * 30], (case,))
        aligned = part if aligned is None else aligned.unionByName(part)
    for how in ({"at_most": 0.03}, {"most_snps": 5}, {"at_most": 0.01, "most_snps": 4}):
        assert rows(near_links.near_links(aligned, **how, index=index)) == rows(distance.snp_pairs(aligned, **how))


def test_large_files_and_blocks(spark):
    """A start that all rows share is compared block by block, and copies are written out."""
    rng = random.Random(4)
    start = "".join(rng.choice("ACGT") for _ in range(400))
    seqs = [start + "".join(rng.choice("ACGT") for _ in range(400)) for _ in range(60)]
    seqs += [s[:-1] + "A" for s in seqs[:20]] + [seqs[0]] * 10
    aligned = frame(spark, seqs, ("1a",))
    for index in (True, False):
        got = rows(near_links.near_links(aligned, at_most=0.02, index=index, hot_rows=8, block_rows=16))
        assert got == rows(distance.snp_pairs(aligned, at_most=0.02)) and len(got) > 60


def test_few_pairs_are_compared(spark):
    """Unrelated rows of known sites hardly meet, whatever the threshold counts."""
    rng = random.Random(9)
    seqs = ["".join(rng.choice("ACGT" * 12 + "N") for _ in range(1500)) for _ in range(400)]
    aligned = frame(spark, seqs).select(F.col("genotype").alias("g"), F.col("record_idx").alias("i"), F.col("seq_id").alias("s"), F.col("aligned").alias("q"))
    for how in ((0.03, None), (None, 5)):
        done = near_links.Index(aligned, *how, index=True).compared().first()
        assert done.pairs == 2 * 200 * 199 // 2 and done.compared < 0.05 * done.pairs


def test_rows_of_few_plain_sites(spark):
    """Rows that share hardly any site of their sketches are told apart over whole rows, so that few pairs are read whole."""
    rng = random.Random(6)
    seqs = ["".join(rng.choice("ACGT" + "N" * 36) for _ in range(4000)) for _ in range(60)] + ["".join(rng.choice("ACGT") for _ in range(900)) for _ in range(60)]
    seqs += [s[:-2] + "AC" for s in seqs[::20]]
    all_rows = frame(spark, seqs, ("1a",))
    aligned = all_rows.select(F.col("genotype").alias("g"), F.col("record_idx").alias("i"), F.col("seq_id").alias("s"), F.col("aligned").alias("q"))
    assert near_links.Index(aligned, 0.03, None).near().count() < 0.05 * len(seqs) * (len(seqs) - 1) / 2
    got = rows(near_links.near_links(all_rows, at_most=0.03, block_rows=16))
    assert got == rows(distance.snp_pairs(all_rows, at_most=0.03)) and len(got) >= 6


def test_edges(spark):
    aligned = frame(spark, ["ACGT" * 30, "ACGT" * 30, "ACGA" * 30], (None,))
    assert near_links.near_links(aligned, at_most=0.03).count() == 0
    assert near_links.near_links(aligned.limit(0), most_snps=3).count() == 0
    same = frame(spark, ["ACGT" * 30] * 3, ("1a",))
    assert rows(near_links.near_links(same, at_most=0.0)) == [("1a", f"s{a}", f"s{b}", 0.0, 0, 120) for a, b in ((0, 1), (0, 2), (1, 2))]
    assert rows(near_links.near_links(same, at_most=0.5)) == rows(distance.snp_pairs(same, at_most=0.5))
    for wrong in ({}, {"at_most": -1.0}, {"most_snps": -1}):
        with pytest.raises(ValueError):
            near_links.near_links(same, **wrong)


def test_sites_meet_once_in_a_group(spark):
    """Rows that are all near each other send their sites to one cell, not to one for each pair; a large group is split."""
    rng = random.Random(3)
    start = "".join(rng.choice("ACGT") for _ in range(500))
    seqs = [start[:j] + "N" + start[j + 1 :] for j in range(80)] + families(rng, "ACGT", [400], 10, 5)
    aligned = frame(spark, seqs, ("1a",))
    index = near_links.Index(aligned.select(F.col("genotype").alias("g"), F.col("record_idx").alias("i"), F.col("seq_id").alias("s"), F.col("aligned").alias("q")), 0.03, None)
    near = index.near().localCheckpoint()
    dealt, sent, cells = near_links.meetings(near)
    assert cells == 1 and dealt.count() == near.count() > 80 * 79 // 2 and sent.count() <= len(seqs)
    dealt, sent, cells = near_links.meetings(near, 16)
    assert dealt.groupBy("c", "a", "b").count().count() > 20 and sent.count() < len(seqs) * 12
    every = lambda one, two: (np.ones(len(one), bool), [])
    pairs = lambda df: sorted((r.x, r.y) for r in df.collect())
    assert pairs(near_links.over_pairs(near, index.seqs, every, (), 16)) == pairs(near)


def test_pairs_are_bounded_before_they_are_counted(spark):
    """TN93 links by the link search, modes by the share of differing sites, and counts summed in the tasks equal those of all pairs."""
    rng = random.Random(8)
    aligned = frame(spark, families(rng, "ACGT" * 6 + "N-RY", [150, 700], 6, 6) + ["", None, "ACGT" * 30, "ACGT" * 30], ("1a",))
    got = lambda df: {(r.source, r.target): pytest.approx(r.distance, abs=1e-9) for r in df.collect()}
    for mode in distance.MODES:
        every = distance.tn93_pairs(aligned, mode, block_rows=16)
        assert got(distance.tn93_pairs(aligned, mode, 0.2, block_rows=16)) == got(every.filter("distance <= 0.2"))
        if mode == "skip":
            assert got(near_links.near_tn93(aligned, 0.05)) == got(every.filter("distance <= 0.05"))
    counts = distance.summary_of_counts(distance.snp_histogram(aligned, block_rows=16), ["genotype"]).collect()
    assert counts == distance.snp_summary(distance.snp_pairs(aligned), ["genotype"]).collect()


def test_a_block_is_sent_once_to_itself_and_finished_shuffles_go(spark):
    wide = spark.range(40).select(F.lit("1a").alias("g"), F.lit(-1).cast("long").alias("file"), F.col("id").alias("r"), F.lit(True).alias("own"))
    for block_rows, copies in ((64, 1), (10, 4)):  # once to each cell of its block
        assert near_links.block_cells(wide, near_links.cell_sizes(wide), block_rows).count() == copies * 40
    held = lambda: spark._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager().getAllFiles().size()
    near_links.materialise(spark.range(1000).repartition(50))
    before, until = held(), time.time() + 20
    assert before
    release(spark)
    while held() and time.time() < until:
        time.sleep(0.1)
    assert held() < before


def test_blocks_meet_without_copies(spark):
    """Blocks of all pairs and of the link search are written once; no copies of rows are shuffled, and each pair is found once."""
    rng = random.Random(12)
    seqs = families(rng, "ACGT" * 5 + "N", [90, 200], 5, 5) + ["", None, "acgu" * 20]
    aligned = frame(spark, seqs, ("1a",))
    plan = lambda df: df._jdf.queryExecution().executedPlan().toString()
    pairs = distance.snp_pairs(aligned, block_rows=6)
    assert rows(pairs) == rows(distance.snp_pairs(aligned)) and pairs.count() == len(seqs) * (len(seqs) - 1) // 2
    for df in (pairs, distance.snp_histogram(aligned, block_rows=6), distance.tn93_pairs(aligned, "average", 0.3, block_rows=6)):
        assert "CartesianProduct" in plan(df) and "hashpartitioning" not in plan(df)
    wide = near_links.sketches(near_links.index_rows(aligned, "genotype", "record_idx", "seq_id", "aligned").select("g", F.col("i").alias("r"), "q"), 0.03, None)
    for own in (F.lit(True), F.col("r") % 4 == 0):
        members = wide.select("g", F.lit(-1).cast("long").alias("file"), "r", own.alias("own"), "k", "bits")
        got = [sorted((p.x, p.y) for p in near_links.near_in_cells(members, n).collect()) for n in (6, 1000)]
        assert got[0] == got[1] and len(got[0]) == len(set(got[0])) > 5


def test_rows_of_equal_bits_are_copies(spark):
    aligned = frame(spark, ["ACGT" * 30 + "N", "acgt" * 30 + "-", "ACGA" * 30], ("1a",))
    assert near_links.Index(near_links.index_rows(aligned, "genotype", "record_idx", "seq_id", "aligned"), 0.03, None).reps.count() == 2
