"""Genotypes from competitive alignment hits: split-hit chains, best hits, assignment rows, k-mer and header checks."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from strandline.functions.sequence import callable_coverage, genotype_group, header_genotype, kmers, non_n_bases, reference_genotype
from strandline.session import ship_code

CHAIN_COLUMNS = (
    "query_id string, target_id string, strand string, query_length long, target_length long, query_start long, query_end long, "
    "target_start long, target_end long, matching_bases long, alignment_block_length long, mapq long, alignment_score long, primary boolean, "
    "identity double, block_identity double, identity_method string, alignment_segment_count int, query_aligned_bases long, target_aligned_bases long, "
    "query_intervals array<struct<start:long,end:long>>"
)


#: Groups of more hits search their predecessors by diagonal.
BY_DIAGONAL = 64
_NUMBERS = ("query_start", "query_end", "target_start", "target_end", "matching_bases", "alignment_block_length", "mapq", "alignment_score")


def chain_of(h: dict[str, np.ndarray], strand: str) -> list[int]:
    """The strongest chain of collinear hits of one query, target and strand, as positions in order of start.

    ``h`` has arrays ``query_start, query_end, target_start, target_end, alignment_score, matching_bases, primary``, sorted by
    the first four. A hit may follow another if they overlap on neither sequence and leave gaps of about one size. Each may
    extend the best chain that ends at an earlier one, and does where that ranks strictly higher: by a primary member, score,
    matches and aligned query bases, then fewer members. Ties keep what came first.

    The difference of two gaps is that of two diagonals, and may be a tenth of the larger gap, so in a large group the hits
    that can go before one lie in a band of the diagonals, found by binary search.
    """
    qs, qe, ts, te = (h[c].astype(np.int64) for c in _NUMBERS[:4])
    n, forward = len(qs), strand == "+"
    begin, end = (qs - ts, qe - te) if forward else (qs + te, qe + ts)
    rank = np.stack([h["primary"].astype(np.int64), h["alignment_score"], h["matching_bases"], qe - qs, np.full(n, -1)])
    before = np.full(n, -1)
    if n > BY_DIAGONAL:
        by_end = np.argsort(end, kind="stable")
        along = end[by_end]
        reach = qs - qe.min() if n else qs
        reach = np.maximum(reach, ts - te.min() if forward else ts.max() - te)
        width = np.maximum(50, np.floor(0.10 * np.maximum(reach, 1)).astype(np.int64))
        low, high = np.searchsorted(along, begin - width, "left"), np.searchsorted(along, begin + width, "right")
    for i in range(1, n):
        if n > BY_DIAGONAL:
            j = by_end[low[i] : high[i]]
            j = np.sort(j[j < i])
        else:
            j = np.arange(i)
        gap_q = qs[i] - qe[j]
        gap_t = ts[i] - te[j] if forward else ts[j] - te[i]
        larger = np.maximum(np.maximum(gap_q, gap_t), 1)
        j = j[(gap_q >= 0) & (gap_t >= 0) & (np.abs(gap_q - gap_t) <= np.maximum(50, (0.10 * larger).astype(np.int64)))]
        if not len(j):
            continue
        joined = rank[:, j] + rank[:, i : i + 1]
        joined[0] = rank[0, j] | rank[0, i]
        at = np.arange(len(j))
        for row in joined:
            at = at[row[at] == row[at].max()]
        if tuple(joined[:, at[0]]) > tuple(rank[:, i]):
            rank[:, i], before[i] = joined[:, at[0]], j[at[0]]
    at = np.arange(n)
    for row in rank:
        at = at[row[at] == row[at].max()]
    chain, i = [], int(at[0])
    while i >= 0:
        chain.append(i)
        i = int(before[i])
    return chain[::-1]


def best_chain(hits: list[dict]) -> list[dict]:
    """``chain_of`` for hits as dictionaries."""
    hits = sorted(hits, key=lambda h: (h["query_start"], h["query_end"], h["target_start"], h["target_end"]))
    names = ("query_start", "query_end", "target_start", "target_end", "alignment_score", "matching_bases", "primary")
    return [hits[i] for i in chain_of({c: np.array([h[c] for h in hits]) for c in names}, hits[0]["strand"])]


def _rolled(t: pa.Table, members: np.ndarray, first: np.ndarray) -> pa.RecordBatch:
    """One row for each chain: ``members`` are rows of ``t``, chain after chain, and ``first`` where each chain begins in them."""
    value = {c: t[c].combine_chunks().to_numpy(zero_copy_only=False)[members] for c in (*_NUMBERS, "identity", "primary", "has_de")}
    at = lambda f, x: f.reduceat(x, first)
    block = at(np.add, value["alignment_block_length"])
    part = np.where(block > 0, block, 1)
    size = np.diff(np.append(first, len(members)))
    aligned = [value[f"{s}_end"] - value[f"{s}_start"] for s in ("query", "target")]
    heads = t.select(["query_id", "target_id", "strand", "query_length", "target_length"]).take(pa.array(members[first]))
    intervals = pa.ListArray.from_arrays(pa.array(np.append(first, len(members)), pa.int32()), pa.StructArray.from_arrays([pa.array(value["query_start"]), pa.array(value["query_end"])], names=["start", "end"]))
    columns = {
        **{c: heads[c].combine_chunks() for c in heads.column_names},
        **{c: pa.array(at(f, value[c])) for c, f in (("query_start", np.minimum), ("query_end", np.maximum), ("target_start", np.minimum), ("target_end", np.maximum), ("mapq", np.minimum))},
        **{c: pa.array(at(np.add, value[c])) for c in ("matching_bases", "alignment_score")},
        "alignment_block_length": pa.array(block),
        "primary": pa.array(at(np.logical_or, value["primary"])),
        "identity": pa.array(np.where(block > 0, at(np.add, value["identity"] * value["alignment_block_length"]) / part, 0.0)),
        "block_identity": pa.array(np.where(block > 0, at(np.add, value["matching_bases"]) / part, 0.0)),
        "identity_method": pa.array(np.where(at(np.logical_and, value["has_de"]), "gap_compressed", "block_fallback").tolist(), pa.string()),
        "alignment_segment_count": pa.array(size.astype(np.int32)),
        "query_aligned_bases": pa.array(at(np.add, aligned[0])),
        "target_aligned_bases": pa.array(at(np.add, aligned[1])),
        "query_intervals": intervals,
    }
    names = [c.strip().split(" ")[0] for c in CHAIN_COLUMNS.split(", ")]
    return pa.RecordBatch.from_arrays([columns[c] for c in names], names=names)


def _chained(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The best chain of every (query, target, strand) of sorted hits; a group that a batch leaves unfinished waits for the next."""
    held: list[pa.Table] = []

    def finished(t: pa.Table) -> pa.RecordBatch:
        keys = [t[c].combine_chunks() for c in ("query_id", "target_id", "strand")]
        new = np.ones(len(t), bool)
        new[1:] = ~np.logical_and.reduce([pc.equal(k[1:], k[:-1]).to_numpy(zero_copy_only=False) for k in keys]) if len(t) > 1 else new[1:]
        first = np.flatnonzero(new)
        size = np.diff(np.append(first, len(t)))
        use = np.ones(len(t), bool)
        value = {c: t[c].combine_chunks().to_numpy(zero_copy_only=False) for c in (*_NUMBERS, "primary")}
        for a, n in zip(first[size > 1].tolist(), size[size > 1].tolist(), strict=True):
            use[a : a + n] = False
            use[[a + i for i in chain_of({c: v[a : a + n] for c, v in value.items()}, keys[2][a].as_py())]] = True
        members = np.flatnonzero(use)
        return _rolled(t, members, np.searchsorted(members, first))

    def last_group(t: pa.Table) -> int:
        """Where the last group begins."""
        same = np.logical_and.reduce([pc.equal(t[c], t[c][-1]).combine_chunks().to_numpy(zero_copy_only=False) for c in ("query_id", "target_id", "strand")])
        return int(np.flatnonzero(~same)[-1]) + 1 if not same.all() else 0

    for batch in batches:
        if not batch.num_rows:
            continue
        t = pa.concat_tables([*held, pa.Table.from_batches([batch])])
        cut = last_group(t)
        if cut:
            yield finished(t.slice(0, cut))
        held = [t.slice(cut)]
    if held:
        yield finished(pa.concat_tables(held))


def hit_chains(hits: DataFrame) -> DataFrame:
    """One row for each query and target: the better strand's best chain of ``read_paf`` hits.

    Hits are sorted by query, target and strand within tasks and gone through in Arrow batches with many groups in each; a
    task holds a batch and one unfinished group. Hits without a query, target or strand are left out.
    """
    ship_code(hits.sparkSession)
    need = ["query_id", "target_id", "strand", "query_length", "target_length", *_NUMBERS, "primary", "identity", "has_de"]
    key = ["query_id", "target_id", "strand"]
    order = [*key, "query_start", "query_end", "target_start", "target_end", F.desc("alignment_score"), F.desc("matching_bases")]
    whole = hits.select(*[F.col(c).cast("long") if c in (*_NUMBERS, "query_length", "target_length") else F.col(c) for c in need]).filter(" and ".join(f"{c} is not null" for c in key))
    chains = whole.repartition(*key).sortWithinPartitions(*order).mapInArrow(_chained, CHAIN_COLUMNS)
    best = Window.partitionBy("query_id", "target_id").orderBy(*[F.col(c).desc() for c in ("primary", "alignment_score", "matching_bases", "query_aligned_bases")], "alignment_segment_count", F.col("strand"))
    return chains.withColumn("_r", F.row_number().over(best)).filter("_r = 1").drop("_r")


def _hit_order() -> list[Column]:
    return [*[F.col(c).desc() for c in ("primary", "alignment_score", "matching_bases", "query_aligned_bases", "identity", "mapq")], F.col("target_id").asc()]


def ranked_hits(hits: DataFrame) -> DataFrame:
    """Adds ``hit_rank`` within the query: primary first, then score, matches, aligned bases, identity, quality, name."""
    return hits.withColumn("hit_rank", F.row_number().over(Window.partitionBy("query_id").orderBy(*_hit_order())))


def coverage_hits(hits: DataFrame, least_coverage: float = 0.5, least_identity: float = 0.75) -> DataFrame:
    """Per query, the hit of the winning genotype whose coverage is reported: a passing one if any, then the largest."""
    ranked = ranked_hits(hits).withColumn("genotype", reference_genotype(F.col("target_id")))
    winner = Window.partitionBy("query_id").orderBy("hit_rank")
    ranked = ranked.withColumn("_g", F.first("genotype").over(winner)).filter("genotype = _g")
    passing = (F.col("query_coverage") >= least_coverage) & (F.col("identity") >= least_identity)
    best = Window.partitionBy("query_id").orderBy(passing.desc(), *[F.col(c).desc() for c in ("query_coverage", "alignment_score", "identity", "matching_bases", "mapq", "target_id")])
    return ranked.withColumn("_r", F.row_number().over(best)).filter("_r = 1").drop("_r", "_g")


def with_coverage(chains: DataFrame, sequences: DataFrame) -> DataFrame:
    """Adds query coverage over callable bases, span coverage and target coverage, from ``seq_id, sequence`` rows."""
    seq = sequences.select(F.col("seq_id").alias("query_id"), "sequence")
    joined = chains.join(seq, "query_id")
    length = F.length("sequence")
    span = F.when(length > 0, (F.col("query_end") - F.col("query_start")) / F.when(length > 0, length)).otherwise(0.0)
    aligned = F.when(length > 0, F.col("query_aligned_bases") / F.when(length > 0, length)).otherwise(0.0)
    target = F.when(F.col("target_length") > 0, F.col("target_aligned_bases") / F.when(F.col("target_length") > 0, F.col("target_length"))).otherwise(0.0)
    return joined.withColumns({"query_coverage": callable_coverage(F.col("sequence"), F.col("query_intervals")), "query_span_coverage": aligned, "query_extent": span, "target_coverage": target}).drop("sequence")


def assignments(sequences: DataFrame, hits: DataFrame, least_coverage: float = 0.5, least_identity: float = 0.75, close: float = 0.98) -> DataFrame:
    """The 27-column genotype table, one row for each sequence, typed; formatting is left to the writer.

    ``hits`` has one row for each query and target with coverages. Sequences without hits fail as ``no_alignment``.
    """
    shown = ["query_coverage", "query_span_coverage", "target_coverage", "identity", "identity_method", "block_identity", "mapq", "matching_bases", "alignment_block_length", "alignment_segment_count"]
    # hits are dealt to their queries and sorted once; the first of each query takes what its row needs of the others
    order = Window.partitionBy("query_id").orderBy(*_hit_order())
    every = order.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    ranked = ranked_hits(hits).withColumn("best_ref_genotype", reference_genotype(F.col("target_id")))
    ranked = ranked.withColumns({"best_g": F.first("best_ref_genotype").over(every), "best_score": F.first("alignment_score").over(every), "second_alignment_score": F.lead("alignment_score").over(order)})
    near = F.when((F.col("hit_rank") > 1) & (F.col("alignment_score") >= F.col("best_score") * close), F.struct("target_id", F.col("best_ref_genotype").alias("g")))
    passing = (F.col("query_coverage") >= least_coverage) & (F.col("identity") >= least_identity)
    by = ["query_coverage", "alignment_score", "identity", "matching_bases", "mapq", "target_id"]
    # the largest in this order is what coverage_hits puts first
    covering = F.when(F.col("best_ref_genotype") == F.col("best_g"), F.struct(passing.alias("passing"), *[F.col(c).alias(f"o_{c}") for c in by], *shown))
    found = ranked.withColumns({"near": F.collect_list(near).over(every), "covering": F.max(covering).over(every)}).filter("hit_rank = 1")
    found = found.select("query_id", F.col("target_id").alias("best_ref"), "best_ref_genotype", F.col("alignment_score").alias("best_alignment_score"), "second_alignment_score", "covering", "near")
    others = F.array_distinct(F.transform(F.filter("near", lambda x: x["g"] != F.col("best_ref_genotype")), lambda x: x["g"]))
    found = found.select(
        "query_id", "best_ref", "best_ref_genotype", "best_alignment_score", "second_alignment_score", F.col("covering.o_target_id").alias("coverage_ref"), *[F.col(f"covering.{c}").alias(c) for c in shown],
        F.array_join("near.target_id", ";").alias("close_hits"), F.array_join(others, ";").alias("other_potential_genotypes"),
    )
    rows = sequences.select(F.col("seq_id").alias("query_id"), F.length("sequence").cast("long").alias("query_length"), non_n_bases(F.col("sequence")).cast("long").alias("non_n_bases"))
    rows = rows.join(found, "query_id", "left")
    none = F.col("best_ref").isNull()
    reasons = F.concat_ws(";", F.when(none, "no_alignment"), F.when(F.col("query_coverage") < least_coverage, "low_query_coverage"), F.when(F.col("identity") < least_identity, "low_identity"))
    margin = F.col("best_alignment_score") - F.col("second_alignment_score")
    passed = reasons == ""
    score = F.col("best_alignment_score")
    blank = lambda c: F.coalesce(c, F.lit(""))
    zero = lambda c: F.coalesce(F.col(c), F.lit(0)).alias(c)
    return rows.select(
        F.col("query_id").alias("sequence_id"),
        F.when(passed, F.col("best_ref_genotype")).otherwise("").alias("assigned_genotype"),
        F.when(passed, genotype_group(F.col("best_ref_genotype"))).otherwise("").alias("genotype_group"),
        F.when(passed, "pass").otherwise("qc_fail").alias("assignment_status"),
        reasons.alias("qc_fail_reason"),
        *[blank(F.col(c)).alias(c) for c in ("best_ref", "best_ref_genotype", "coverage_ref")],
        "query_length", "non_n_bases",
        F.when(F.col("query_length") > 0, F.col("non_n_bases") / F.when(F.col("query_length") > 0, F.col("query_length"))).otherwise(0.0).alias("non_n_fraction"),
        zero("best_alignment_score"), "second_alignment_score", margin.alias("score_margin"),
        F.when(score != 0, margin / F.when(score != 0, score)).alias("score_margin_fraction"),
        *shown[:7], *[zero(c) for c in shown[7:]],
        *[blank(F.col(c)).alias(c) for c in ("close_hits", "other_potential_genotypes")],
    )


def detected_genotypes(assigned: DataFrame) -> DataFrame:
    """Distinct assigned genotypes of passing rows, in order."""
    return assigned.filter("assignment_status = 'pass' and assigned_genotype <> ''").select("assigned_genotype").distinct().orderBy("assigned_genotype")


def genotype_counts(assigned: DataFrame) -> DataFrame:
    return assigned.groupBy("assigned_genotype").agg(F.count("*").alias("n"))


def unsupported_genotypes(assigned: DataFrame, catalog: DataFrame) -> DataFrame:
    """Detected genotypes without a reference, with their counts."""
    found = assigned.filter("assignment_status = 'pass' and assigned_genotype <> ''").groupBy("assigned_genotype").agg(F.count("*").alias("n"))
    return found.join(catalog.select(F.col("genotype").alias("assigned_genotype")), "assigned_genotype", "left_anti")


def supported(assigned: DataFrame, catalog: DataFrame, wanted: list[str] | None = None) -> DataFrame:
    """Passing rows of catalogued genotypes, of the ``wanted`` ones if given."""
    rows = assigned.filter("assignment_status = 'pass'")
    if wanted:
        rows = rows.filter(F.col("assigned_genotype").isin(wanted))
    return rows.join(catalog.select(F.col("genotype").alias("assigned_genotype")), "assigned_genotype", "left_semi")


def kmer_overlap(queries: DataFrame, references: DataFrame, k: int = 15, least: int = 20, key: str = "seq_id", seq: str = "sequence", genotype: str = "genotype") -> DataFrame:
    """``key, n_kmers, best_genotype, best_score``: the genotype that shares most of a query's distinct k-mers.

    k-mers are rows and an equi-join on the k-mer counts the common ones; ties go to the first genotype by name. Queries
    with fewer than ``least`` k-mers have no genotype.
    """
    if k < 8:
        raise ValueError("k is at least 8")
    q = queries.select(key, F.explode(kmers(F.col(seq), k)).alias("kmer"))
    r = references.select(genotype, F.explode(kmers(F.col(seq), k)).alias("kmer")).distinct()
    size = q.groupBy(key).agg(F.count("*").alias("n_kmers"))
    both = q.join(r, "kmer").groupBy(key, genotype).agg(F.count("*").alias("common"))
    best = Window.partitionBy(key).orderBy(F.col("common").desc(), genotype)
    top = both.withColumn("_r", F.row_number().over(best)).filter("_r = 1").select(key, F.col(genotype).alias("best_genotype"), "common")
    out = queries.select(key).join(size, key, "left").join(top, key, "left").withColumn("n_kmers", F.coalesce("n_kmers", F.lit(0).cast("long")))
    enough = F.col("n_kmers") >= least
    return out.select(key, "n_kmers", F.when(enough, F.col("best_genotype")).alias("best_genotype"), F.when(enough, F.coalesce("common", F.lit(0)) / F.when(enough, F.col("n_kmers"))).alias("best_score"))


def kmer_failures(scored: DataFrame, wanted_score: Column, requested: str, margin: float = 0.005, least_score: float = 0.02) -> DataFrame:
    """Queries whose best genotype is another one by a clear margin, and those with too few k-mers."""
    other = (F.col("best_genotype") != requested) & (F.col("best_score") - wanted_score >= margin) & (F.col("best_score") >= least_score)
    return scored.filter(other | F.col("best_genotype").isNull())


def check_headers(records: DataFrame, genotype: str, mode: str = "auto") -> str:
    """``tagged`` if every header names ``genotype``, ``untagged`` if none has a tag and k-mers may be asked; else an error.

    Modes: ``none`` checks nothing, ``headers`` needs tags, ``auto`` and ``kmer`` fall through to k-mers without tags.
    """
    if mode not in ("none", "headers", "auto", "kmer"):
        raise ValueError(f"unknown validation mode: {mode}")
    if mode == "none":
        return "untagged"
    tag = header_genotype(F.col("header"))
    n = records.select(F.count("*").alias("n"), F.count(tag).alias("tagged"), F.count_if(tag != genotype.lower()).alias("other")).first()
    if n["tagged"] == 0:
        if mode == "headers":
            raise ValueError("no header has a genotype tag")
        return "untagged"
    if n["tagged"] < n["n"]:
        raise ValueError("some headers have a genotype tag and some have none")
    if n["other"]:
        raise ValueError(f"{n['other']} headers name another genotype than {genotype}")
    return "tagged"
