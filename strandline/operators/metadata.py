"""Sample metadata: validation with all faults in one message, and the join to nodes."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from strandline.functions.sequence import MISSING, age_error, age_range, age_range_spelling, metadata_key
from strandline.sources.faults import reject
from strandline.sources.readers import RESERVED_METADATA


def check_header(header: list[str]) -> None:
    """Blank, repeated and reserved names are errors; ``sample_id`` is required."""
    faults = []
    if any(not h for h in header):
        faults.append("blank column name")
    if repeated := sorted({h for h in header if h and header.count(h) > 1}):
        faults.append(f"repeated columns: {', '.join(repeated)}")
    if reserved := sorted(set(header) & set(RESERVED_METADATA)):
        faults.append(f"reserved columns: {', '.join(reserved)}")
    if "sample_id" not in header:
        faults.append("no sample_id column")
    if faults:
        raise ValueError("metadata header: " + "; ".join(faults))


def row_faults(columns: list[str]) -> tuple[dict[str, Column], dict[str, Column]]:
    """By kind of fault, the sample it is shown for: blank ids, wrong ages and ranges, ages outside their range; and repeated ids."""
    sample = F.coalesce(F.nullif(F.trim("sample_id"), F.lit("")), F.lit("(blank)"))
    with_value = lambda c: F.concat(sample, F.lit(" "), F.coalesce(c, F.lit("")))
    blank = sample == "(blank)"
    wrong = {"blank sample_id": F.when(blank, sample)}
    if "age" in columns:
        wrong["wrong age"] = F.when(age_error(F.col("age")), with_value(F.col("age")))
    if "age_range" in columns:
        given = F.col("age_range") != MISSING
        wrong["unknown age range"] = F.when(given & age_range_spelling(F.col("age_range")).isNull(), with_value(F.col("age_range")))
        if "age" in columns:
            outside = given & ~age_error(F.col("age")) & (F.col("age") != MISSING) & (age_range(F.col("age")) != age_range_spelling(F.col("age_range")))
            wrong["age outside its range"] = F.when(outside, with_value(F.col("age")))
    return wrong, {"repeated sample_id": F.when(~blank, F.col("sample_id"))}


def validated(rows: DataFrame, further: dict[str, Column] | None = None) -> DataFrame:
    """``rows`` with ``age_range`` derived or respelled.

    The rows are checked in one pass, together with what ``further`` asks (see ``find_faults``); one error names each kind of
    fault with its first samples and the number of others.
    """
    wrong, repeated = row_faults(rows.columns)
    reject(rows, "metadata", {**(further or {}), **wrong}, repeated)
    derived = F.lit(MISSING)
    if "age" in rows.columns:
        derived = age_range(F.col("age"))
    if "age_range" in rows.columns:
        derived = F.coalesce(age_range_spelling(F.nullif(F.col("age_range"), F.lit(MISSING))), derived)
    return rows.withColumn("age_range", derived)


def join_metadata(nodes: DataFrame, metadata: DataFrame, node: str = "sample_id") -> DataFrame:
    """Every node with its metadata, ``(missing)`` where there is none; rows match on ``base_sample_id``, else the id.

    A value that contradicts one the node already has fails the query; an equal one, or a missing one, does not.
    """
    key = metadata_key(F.col("base_sample_id"), F.col(node)) if "base_sample_id" in nodes.columns else F.col(node)
    fields = [c for c in metadata.columns if c != "sample_id"]
    named = lambda c: F.col(f"`{c.replace('`', '``')}`")
    meta = metadata.select(F.col("sample_id").alias("_key"), *[named(c).alias(f"_m_{c}") for c in fields])
    out = nodes.withColumn("_key", key).join(meta, "_key", "left")
    for c in fields:
        new = F.coalesce(named(f"_m_{c}").cast("string"), F.lit(MISSING))
        if c in nodes.columns:
            old = F.coalesce(named(c).cast("string"), F.lit(MISSING))
            clash = (old != MISSING) & (new != MISSING) & (old != new)
            new = F.when(clash, F.raise_error(F.concat(F.lit(f"metadata conflict in {c} at "), F.col(node)))).when(old != MISSING, old).otherwise(new)
        out = out.withColumn(c, new)
    return out.drop("_key", *[f"_m_{c}" for c in fields])


def nodes_without_metadata(nodes: DataFrame, metadata: DataFrame, node: str = "sample_id") -> DataFrame:
    return nodes.select(F.col(node).alias("sample_id")).distinct().join(metadata.select("sample_id"), "sample_id", "left_anti")


def metadata_without_nodes(nodes: DataFrame, metadata: DataFrame, node: str = "sample_id") -> DataFrame:
    return metadata.select("sample_id").distinct().join(nodes.select(F.col(node).alias("sample_id")), "sample_id", "left_anti")
