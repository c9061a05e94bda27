"""Readers: FASTA, PAF, distance and link tables, node lists, metadata, JSON sidecars. All return DataFrames."""

from __future__ import annotations

import csv
import io
import json
from functools import reduce

from pyspark.sql import DataFrame, Row, SparkSession
from pyspark.sql import functions as F

from strandline.functions.sequence import blank_as_missing, first_token
from strandline.sources.faults import reject

# Accepted column names, compared without regard to case.
SOURCE_NAMES = ("source", "query", "id1", "seq1", "sequence_1", "name1", "sample_id_1")
TARGET_NAMES = ("target", "reference", "id2", "seq2", "sequence_2", "name2", "sample_id_2")
DISTANCE_NAMES = ("distance", "tn93", "tn93_distance", "dist")
LINK_SOURCE_NAMES = ("source", "id1", "seq1", "sample_id_1")
LINK_TARGET_NAMES = ("target", "id2", "seq2", "sample_id_2")
NODE_NAMES = ("node", "sample_id", "sequence_id", "id")
RESERVED_METADATA = ("genotype", "cluster_id", "source_cluster_id", "cluster_size", "source", "target", "distance", "base_sample_id", "mixed_infection")


def read_fasta(spark: SparkSession, path: str, strict: bool = False, unique: str | None = "seq_id") -> DataFrame:
    """``record_idx, header, seq_id, sequence`` of a FASTA file, plain or gzip.

    Records are split at line-initial ``>`` by the reader, so a large file is read by many tasks; ``record_idx`` grows in
    file order without gaps in meaning (it orders, it does not count). Blank lines and white space in sequences go.
    ``strict`` also requires a record, and rejects data before the first header, empty headers and values of ``unique`` that
    repeat: ids, whole headers (``header``), or neither (None) where repeats are resolved later. All of this is asked in one
    pass over the file, and one error names the faults of every kind.
    """
    raw = spark.read.option("lineSep", "\n>").text(path).withColumn("record_idx", F.monotonically_increasing_id())
    text = F.regexp_replace(F.col("value"), r"\r", "")
    # only the first record of a file still has its mark
    begins = F.lit(True) if len(raw.inputFiles()) > 1 else F.col("record_idx") == 0
    body = F.when(begins, F.regexp_replace(F.ltrim(text), r"^>", "")).otherwise(text)
    raw = raw.withColumn("lead", (F.col("record_idx") == 0) & ~F.ltrim(text).startswith(">")).withColumn("body", body)
    rows = raw.select("record_idx", "lead", F.trim(F.split_part("body", F.lit("\n"), F.lit(1))).alias("header"), F.regexp_replace(F.regexp_replace("body", r"^[^\n]*", ""), r"\s+", "").alias("sequence"))
    out = rows.filter("not (header = '' and sequence = '' and lead)").select("record_idx", "header", first_token(F.col("header")).alias("seq_id"), "sequence", "lead")
    if strict:
        wrong = {"sequence data before the first header": F.when(F.col("lead"), F.col("header")), "empty FASTA header at record": F.when(F.col("header") == "", F.col("record_idx"))}
        named = ~F.col("lead") & (F.col("header") != "")
        repeats = {f"repeated {'sequence ids' if unique == 'seq_id' else 'headers'}": F.when(named, F.col(unique))} if unique else {}
        if not reject(out, f"FASTA {path}", wrong, repeats):
            raise ValueError(f"no FASTA records in {path}")
    return out.drop("lead")


def duplicate_ids(records: DataFrame, column: str = "header") -> DataFrame:
    """``column, n`` for every value that occurs more than once."""
    return records.groupBy(column).agg(F.count("*").alias("n")).filter("n > 1")


def read_panel_ids(spark: SparkSession, path: str) -> DataFrame:
    """First tokens of the headers."""
    return spark.read.text(path).filter(F.col("value").startswith(">")).select(first_token(F.substring("value", 2, 1 << 30)).alias("seq_id"))


def read_paf(spark: SparkSession, path: str, identity: str = "gap_compressed") -> DataFrame:
    """Alignment hits: the twelve fixed columns, tags, score, primary flag and identities. A line with fewer fields fails."""
    f = F.split("value", "\t")
    raw = spark.read.text(path).filter(F.trim("value") != "").select(F.when(F.size(f) < 12, F.raise_error(F.concat(F.lit("PAF line with fewer than 12 fields: "), F.col("value")))).otherwise(f).alias("f"))
    names = {"query_id": 0, "query_length": 1, "query_start": 2, "query_end": 3, "strand": 4, "target_id": 5, "target_length": 6, "target_start": 7, "target_end": 8, "matching_bases": 9, "alignment_block_length": 10, "mapq": 11}
    text = {"query_id", "strand", "target_id"}
    tag = F.transform(F.filter(F.slice("f", 13, 1 << 20), lambda x: x.rlike("^[^:]+:[^:]+:")), lambda x: F.struct(F.split_part(x, F.lit(":"), F.lit(1)).alias("k"), F.regexp_replace(x, "^[^:]+:[^:]+:", "").alias("v")))
    hits = raw.select(*[F.col("f")[i].cast("string" if n in text else "long").alias(n) for n, i in names.items()], F.map_from_entries(F.array_distinct(tag)).alias("tags"))
    return with_hit_metrics(hits, identity)


def with_hit_metrics(hits: DataFrame, identity: str = "gap_compressed") -> DataFrame:
    """Adds score (``AS`` or matches), primary (``tp`` other than S), block identity and identity by the named method."""
    tags = F.col("tags")
    block = F.when(F.col("alignment_block_length") > 0, F.col("matching_bases") / F.when(F.col("alignment_block_length") > 0, F.col("alignment_block_length"))).otherwise(0.0)
    de = F.try_element_at(tags, F.lit("de")).try_cast("double")
    gap = F.when(de.isNotNull(), F.greatest(F.lit(0.0), F.least(F.lit(1.0), 1 - de)))
    return hits.select(
        "*",
        F.coalesce(F.try_element_at(tags, F.lit("AS")).try_cast("long"), F.col("matching_bases")).alias("alignment_score"),
        (F.coalesce(F.try_element_at(tags, F.lit("tp")), F.lit("P")) != "S").alias("primary"),
        block.alias("block_identity"),
        (F.coalesce(gap, block) if identity == "gap_compressed" else block).alias("identity"),
        (de.isNotNull() & F.lit(identity == "gap_compressed")).alias("has_de"),
    )


def _delimiter(spark: SparkSession, path: str) -> str:
    head = spark.read.text(path).limit(1).collect()
    return "\t" if head and "\t" in head[0][0] and head[0][0].count("\t") >= head[0][0].count(",") else ","


def _cells(spark: SparkSession, path: str, sep: str) -> tuple[DataFrame, list[str]]:
    """Rows as arrays of trimmed cells, and the first row."""
    lines = spark.read.csv(path, sep=sep, header=False, inferSchema=False)
    names = lines.columns
    first = lines.limit(1).collect()
    return lines, [(first[0][n] or "").strip() for n in names] if first else []


def _aliased(first: list[str], names: tuple[str, ...]) -> int | None:
    low = [x.lower().lstrip("﻿") for x in first]
    return next((low.index(n) for n in names if n in low), None)


def read_distances(spark: SparkSession, path: str) -> DataFrame:
    """``source, target, distance``; the delimiter and the header's spelling are found out, a header is optional."""
    lines, first = _cells(spark, path, _delimiter(spark, path))
    if not first:
        return spark.createDataFrame([], "source string, target string, distance double")
    at = [_aliased(first, n) for n in (SOURCE_NAMES, TARGET_NAMES, DISTANCE_NAMES)]
    if None in at:
        try:
            float(first[2])
        except (IndexError, ValueError):
            raise ValueError(f"distance table without source, target and distance columns: {first}") from None
        at, header = [0, 1, 2], None
    else:
        header = first
    cell = lambda i: F.trim(F.col(lines.columns[i]))
    rows = lines.select(cell(at[0]).alias("source"), cell(at[1]).alias("target"), cell(at[2]).alias("raw"))
    if header:
        rows = rows.filter(~((F.col("source") == header[at[0]]) & (F.col("target") == header[at[1]]) & (F.col("raw") == header[at[2]])))
    rows = rows.filter("coalesce(source, '') <> '' and coalesce(target, '') <> ''")
    number = F.col("raw").try_cast("double")
    return rows.select("source", "target", F.when(number.isNull(), F.raise_error(F.concat(F.lit("not a distance: "), F.coalesce("raw", F.lit("(empty)")))).cast("double")).otherwise(number).alias("distance"))


def read_links(spark: SparkSession, path: str) -> DataFrame:
    """``source, target, distance``: distance is null where the file has none; two bare columns are accepted."""
    lines, first = _cells(spark, path, _delimiter(spark, path))
    if not first:
        return spark.createDataFrame([], "source string, target string, distance double")
    at = [_aliased(first, n) for n in (LINK_SOURCE_NAMES, LINK_TARGET_NAMES)]
    header = None not in at
    at, dist = (at, _aliased(first, DISTANCE_NAMES)) if header else ([0, 1], None)
    cell = lambda i: F.trim(F.col(lines.columns[i]))
    rows = lines.select(cell(at[0]).alias("source"), cell(at[1]).alias("target"), (cell(dist) if dist is not None else F.lit(None)).try_cast("double").alias("distance"))
    if header:
        rows = rows.filter(~((F.col("source") == first[at[0]]) & (F.col("target") == first[at[1]])))
    return rows.filter("coalesce(source, '') <> '' and coalesce(target, '') <> ''")


def read_nodes(spark: SparkSession, path: str) -> DataFrame:
    """``node, first_idx``: ordered distinct nodes of a CSV column, or of each line's first token."""
    lines, first = _cells(spark, path, ",")
    at = _aliased(first, NODE_NAMES)
    idx = F.monotonically_increasing_id().alias("idx")
    if at is None:
        rows = spark.read.text(path).select(first_token(F.split_part("value", F.lit(","), F.lit(1))).alias("node"), idx)
    else:
        rows = lines.select(F.trim(F.col(lines.columns[at])).alias("node"), idx).filter("idx > 0")
    return ordered_distinct(rows.filter("coalesce(node, '') <> ''"), "node", "idx")


def ordered_distinct(rows: DataFrame, value: str, idx: str) -> DataFrame:
    """Each value once, with the index at which it was first seen."""
    return rows.groupBy(value).agg(F.min(idx).alias("first_idx"))


def read_metadata(spark: SparkSession, path: str) -> DataFrame:
    """All columns as trimmed strings, blanks as ``(missing)``, plus ``age_range``; every fault is reported at once.

    Quoted cells may hold commas, doubled quotes and line breaks. ``path`` may be a folder of files with one header. A row with
    more cells than the header is an error, unless those are blank; one with fewer has blanks at its end.
    """
    read = spark.read.option("encoding", "UTF-8").option("multiLine", True).option("escape", '"')
    first = read.csv(path, header=False, inferSchema=False).limit(1).collect()
    width = len(first[0]) if first else 1
    schema = ", ".join(f"_c{i} string" for i in range(width))
    raw = read.schema(schema + ", _record string").option("columnNameOfCorruptRecord", "_record").csv(path, header=False)
    # the reader cuts cells off and keeps the record; cells are counted with what is quoted taken out
    cells = F.split(F.regexp_replace("_record", '"(?:[^"]|"")*"', "x"), ",")
    more = F.exists(F.slice(cells, width + 1, F.greatest(F.size(cells), F.lit(1))), lambda x: F.trim(x) != "")
    return _metadata(raw.withColumn("_more", F.when(more, "more")).drop("_record"), first)


def metadata_from_bytes(spark: SparkSession, data: bytes) -> DataFrame:
    """As ``read_metadata``, from an uploaded file's bytes, which must be UTF-8."""
    try:
        rows = list(csv.reader(io.StringIO(data.decode("utf-8-sig"), newline="")))
    except UnicodeDecodeError as wrong:
        raise ValueError("metadata is not UTF-8 text") from wrong
    width = max(map(len, rows), default=1)
    rows = [[x if x != "" else None for x in r] + [None] * (width - len(r)) for r in rows if any(r)]
    raw = spark.createDataFrame([Row(*r) for r in rows], ", ".join(f"_c{i} string" for i in range(width))).coalesce(1)
    return _metadata(raw, [raw.first()] if rows else [])


def _metadata(raw: DataFrame, first: list[Row]) -> DataFrame:
    from strandline.operators.metadata import check_header, validated

    header = [(x or "").lstrip("\ufeff").strip() for x in first[0]] if first else []
    while header and not header[-1]:
        header.pop()
    check_header(header)
    cell = lambda c: F.trim(F.regexp_replace(F.col(c), "\ufeff", ""))
    is_header = reduce(lambda x, y: x & y, [cell(c).eqNullSafe(n) for c, n in zip(raw.columns, header, strict=False)])
    rows = raw.filter(~is_header)
    wide = [F.col(c).isNotNull() for c in raw.columns[len(header) :]]
    names = [cell(c).alias(n) if n == "sample_id" else blank_as_missing(cell(c)).alias(n) for c, n in zip(raw.columns, header, strict=False)]
    flag = "_wide"
    while flag in header:
        flag += "_"
    named = rows.select(*names, (reduce(lambda x, y: x | y, wide) if wide else F.lit(False)).alias(flag))
    return validated(named, {"row wider than the header": F.when(F.col(flag), F.coalesce("sample_id", F.lit("")))}).drop(flag)


def reference_map(text: str) -> dict[str, str]:
    """Accessions by lower-cased genotype from a JSON object of strings or ``{"accession": ...}`` objects."""
    data = json.loads(text)
    if not isinstance(data, dict):
        raise ValueError("a reference map is a JSON object keyed by genotype")
    out = {}
    for key, value in data.items():
        accession = value.get("accession") if isinstance(value, dict) else value
        if not isinstance(accession, str) or not accession.strip():
            raise ValueError(f"reference map entry without accession: {key}")
        out[key.strip().lower()] = accession.strip()
    return out


def read_cache_sidecar(spark: SparkSession, path: str) -> DataFrame | None:
    """``version, reference_accession, reference_fingerprint, alignment_length, sequences``; None where there is no file."""
    from pyspark.errors import AnalysisException

    schema = "version int, reference_accession string, reference_fingerprint string, alignment_length int, sequences map<string,string>"
    try:
        out = spark.read.schema(schema).option("multiLine", True).option("mode", "FAILFAST").json(path)
    except AnalysisException:
        return None
    version = out.select("version").first()
    if version is None or version[0] != 1:
        raise ValueError("unsupported alignment cache version")
    return out


def read_table(spark: SparkSession, path: str, layout: dict[str, str]) -> DataFrame:
    """A CSV written in one of the fixed layouts of ``writers``: columns by name, typed, blanks as null; others are left out.

    A layout's column that the file lacks, as in tables of an earlier form, is null.
    """
    raw = spark.read.csv(path, header=True, inferSchema=False)
    cell = lambda c: F.trim(F.col(f"`{c}`")) if c in raw.columns else F.lit(None).cast("string")
    return raw.select(*[F.nullif(cell(c), F.lit("")).try_cast(kind).alias(c) for c, kind in layout.items()])
