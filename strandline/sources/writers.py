"""Writers. Each takes a DataFrame and a folder; numbers are formatted here and nowhere else."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from strandline.functions.sequence import general_number, wrapped


# The columns of the tables that other tools read, in order.
GENOTYPE_LAYOUT = {
    **dict.fromkeys(("sequence_id", "assigned_genotype", "genotype_group", "assignment_status", "qc_fail_reason", "best_ref", "best_ref_genotype", "coverage_ref"), "string"),
    **{"query_length": "long", "non_n_bases": "long", "non_n_fraction": "double"},
    **{"best_alignment_score": "long", "second_alignment_score": "long", "score_margin": "long", "score_margin_fraction": "double"},
    **{"query_coverage": "double", "query_span_coverage": "double", "target_coverage": "double", "identity": "double", "identity_method": "string", "block_identity": "double"},
    **{"mapq": "long", "matching_bases": "long", "alignment_block_length": "long", "alignment_segment_count": "int", "close_hits": "string", "other_potential_genotypes": "string"},
}
QC_LAYOUT = {
    **dict.fromkeys(("sample_id", "genotype", "reference_accession", "selected_region", "region_strategy", "region_segments"), "string"),
    **dict.fromkeys(("region_start", "region_end", "region_length", "core_e2_start", "core_e2_end", "core_e2_length", "extracted_length", "non_gap_bases", "n_bases", "gap_bases"), "int"),
    **{"coverage_fraction": "double", "n_fraction": "double", "gap_fraction": "double", "passed_qc": "boolean", "removal_reason": "string"},
}
CLUSTER_LAYOUT = {"sample_id": "string", "genotype": "string", "cluster_id": "string", "source_cluster_id": "string", "cluster_size": "int", "base_sample_id": "string", "mixed_infection": "boolean"}


def fasta_lines(records: DataFrame, sequence: str = "sequence", width: int = 80) -> DataFrame:
    return records.select(F.concat(F.lit(">"), F.col("header"), F.lit("\n"), wrapped(F.col(sequence), width)).alias("value"))


def write_fasta(records: DataFrame, path: str, sequence: str = "sequence", width: int = 80) -> None:
    """Records in input order, ranged over files, so no single task writes a large result."""
    fasta_lines(records.repartitionByRange("record_idx").sortWithinPartitions("record_idx"), sequence, width).write.text(path)


def write_fasta_by_genotype(records: DataFrame, path: str, genotype: str = "assigned_genotype") -> None:
    """One folder ``assigned_genotype=<g>`` for each genotype."""
    lines = records.select(genotype, F.concat(F.lit(">"), F.col("header"), F.lit("\n"), wrapped(F.col("sequence"))).alias("value"))
    lines.write.partitionBy(genotype).text(path)


def write_genotype_files(records: DataFrame, folder: str, genotypes: list[str], genotype: str = "assigned_genotype") -> None:
    """``hcv_<genotype>.fasta`` under ``folder`` for each of the given genotypes, in the order of the input, empty ones too."""
    for g in genotypes:
        write_fasta(records.filter(F.col(genotype) == g), f"{folder}/hcv_{g}.fasta")


def write_layout(rows: DataFrame, path: str, layout: dict[str, str]) -> None:
    """The layout's columns in order; fractions with six decimals, booleans as ``true`` and ``false``, nulls blank."""
    have = rows.select(*[F.col(c) if c in rows.columns else F.lit(None).cast(kind).alias(c) for c, kind in layout.items()])
    write_table(have, path, tuple(c for c, kind in layout.items() if kind == "double"))


def write_distances(rows: DataFrame, path: str) -> None:
    """source, target, distance as ``%.10g`` or blank, and counts where there are any."""
    extra = [c for c in ("snp_count", "comparable_sites") if c in rows.columns]
    rows.select("source", "target", general_number(F.col("distance")).alias("distance"), *extra).write.csv(path, header=True)


def write_table(rows: DataFrame, path: str, fractions: tuple[str, ...] = ()) -> None:
    """Any result as CSV; the named columns with six decimals, booleans as ``true`` and ``false``."""
    cols = [F.format_string("%.6f", F.bround(F.col(c), 6)).alias(c) if c in fractions else F.col(c) for c in rows.columns]
    rows.select(*cols).write.csv(path, header=True)


def cache_sidecar(aligned: DataFrame, accession: str, reference_fingerprint: str, length: int) -> DataFrame:
    """One row in the layout of the alignment-cache sidecar, from ``header, fingerprint`` rows of one genotype."""
    pairs = aligned.agg(F.map_from_entries(F.collect_list(F.struct("header", "fingerprint"))).alias("sequences"))
    return pairs.select(F.lit(1).alias("version"), F.lit(accession).alias("reference_accession"), F.lit(reference_fingerprint).alias("reference_fingerprint"), F.lit(length).alias("alignment_length"), "sequences")
