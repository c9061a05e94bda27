"""Alignment reuse: inputs whose header and sequence are unchanged keep their cached alignment."""

from __future__ import annotations

import hashlib
import warnings

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from strandline.functions.sequence import fingerprint
from strandline.sources import readers


def with_fingerprint(records: DataFrame, seq: str = "sequence") -> DataFrame:
    return records.withColumn("fingerprint", fingerprint(F.col(seq)))


def check_cache(cache: dict | None, accession: str, reference_fingerprint: str, reference_width: int) -> None:
    """Errors for a cache of another version, reference or width."""
    if cache is None:
        raise ValueError("there is no alignment cache")
    for field, want in (("version", 1), ("reference_accession", accession), ("reference_fingerprint", reference_fingerprint), ("alignment_length", reference_width)):
        if cache.get(field) != want:
            raise ValueError(f"alignment cache has another {field}: {cache.get(field)}")


def read_cache(spark: SparkSession, fasta: str, sidecar: str, accession: str, anchor: str) -> DataFrame | None:
    """``header, fingerprint, aligned`` of an earlier alignment to ``anchor``, the aligned row of the reference ``accession``.

    Errors for a cache without the reference, with another reference or other columns, of rows of several widths, or of a
    sidecar that disagrees (see ``check_cache``). Without a sidecar nothing tells which inputs are unchanged: a warning and None.
    """
    rows = readers.read_fasta(spark, fasta, strict=True, unique="header")
    width = F.length("sequence")
    facts = rows.agg(F.max(F.when(F.col("header") == accession, F.col("sequence"))).alias("reference"), F.min(width).alias("least"), F.max(width).alias("most")).first()
    if facts["reference"] is None:
        raise ValueError(f"the cached alignment lacks the reference {accession}")
    plain = anchor.replace("-", "").upper()
    if facts["reference"].replace("-", "").upper() != plain:
        raise ValueError(f"the cached alignment has another sequence of {accession}")
    if facts["least"] != facts["most"]:
        raise ValueError("the cached alignment has rows of several widths")
    side = readers.read_cache_sidecar(spark, sidecar)
    if side is None:
        warnings.warn(f"{fasta} has no sidecar, so all its sequences are to be aligned again", stacklevel=2)
        return None
    check_cache(side.drop("sequences").first().asDict(), accession, hashlib.sha256(plain.encode()).hexdigest(), facts["most"])
    if facts["reference"].upper() != anchor.upper():
        raise ValueError(f"the cached alignment has other columns for {accession}")
    held = side.select(F.explode("sequences").alias("header", "fingerprint"))
    return rows.filter(F.col("header") != accession).select("header", F.col("sequence").alias("aligned")).join(held, "header")


def split_by_cache(records: DataFrame, cached: DataFrame | None, seq: str = "sequence") -> tuple[DataFrame, DataFrame]:
    """``(reused, to_align)``: records with the cached ``aligned`` row, and those that have none.

    ``cached`` has ``header, fingerprint, aligned``; None means that nothing can be reused.
    """
    marked = with_fingerprint(records, seq)
    if cached is None:
        return marked.withColumn("aligned", F.lit(None).cast("string")).filter(F.lit(False)), marked
    held = cached.select("header", "fingerprint", "aligned")
    return marked.join(held, ["header", "fingerprint"]), marked.join(held, ["header", "fingerprint"], "left_anti")


def reuse_counts(records: DataFrame, cached: DataFrame, seq: str = "sequence") -> DataFrame:
    """One row: ``reused, total``."""
    hit = with_fingerprint(records, seq).join(cached.select("header", "fingerprint").distinct().withColumn("_hit", F.lit(1)), ["header", "fingerprint"], "left")
    return hit.agg(F.count("_hit").alias("reused"), F.count("*").alias("total"))
