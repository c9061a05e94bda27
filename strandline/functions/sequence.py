"""Column functions over sequences, names and metadata values; all but the number formats stay inside the JVM."""

from __future__ import annotations

import pyarrow as pa
from pyspark.sql import Column
from pyspark.sql import functions as F

MISSING = "(missing)"
# The age bins, in order, and the spellings accepted for them.
AGE_RANGES = ("0–30", "31–60", "61+")
AGE_RANGE_SPELLINGS = {"0-30": "0–30", "0–30": "0–30", "31-60": "31–60", "31–60": "31–60", "61+": "61+"}


def upper_ascii(seq: Column) -> Column:
    """a-z as A-Z and nothing else, so that a sequence keeps its length."""
    return F.translate(seq, "abcdefghijklmnopqrstuvwxyz", "ABCDEFGHIJKLMNOPQRSTUVWXYZ")


def _upper_dna(seq: Column) -> Column:
    return F.translate(upper_ascii(F.regexp_replace(seq, r"\s+", "")), "U", "T")


def normalized_input(seq: Column) -> Column:
    """Upper-case DNA without white space and gaps, U as T, anything outside the IUPAC alphabet as N."""
    return F.regexp_replace(F.regexp_replace(_upper_dna(seq), r"[-.]", ""), "[^ACGTRYSWKMBDHVN]", "N")


def required_input(header: Column, seq: Column) -> Column:
    """``normalized_input``, failing the query on a sequence that normalises to nothing."""
    clean = normalized_input(seq)
    return F.when(clean == "", F.raise_error(F.concat(F.lit("sequence is empty after normalisation: "), header))).otherwise(clean)


def normalized_reference(seq: Column) -> Column:
    """As ``normalized_input``, but gaps and other letters stay."""
    return _upper_dna(seq)


variant_key = normalized_reference


def completeness(seq: Column) -> Column:
    """How many of A, C, G, T a sequence has."""
    return F.length(F.regexp_replace(variant_key(seq), "[^ACGT]", ""))


def n_as_gap(seq: Column) -> Column:
    return F.translate(seq, "Nn", "--")


def coverage_metrics(seq: Column, expected: Column) -> dict[str, Column]:
    """Counts of gap, N and other bases, and their shares of the expected length (0 where that is 0)."""
    gaps = F.regexp_count(seq, F.lit("-")).cast("int")
    ns = F.regexp_count(seq, F.lit("[Nn]")).cast("int")
    share = lambda n: F.when(expected > 0, n / F.when(expected > 0, expected)).otherwise(0.0).cast("double")
    bases = F.length(seq) - gaps - ns
    return {
        "extracted_length": F.length(seq),
        "non_gap_bases": bases,
        "n_bases": ns,
        "gap_bases": gaps,
        "coverage_fraction": share(bases),
        "n_fraction": share(ns),
        "gap_fraction": share(gaps),
    }


def non_n_bases(seq: Column) -> Column:
    return F.length(F.regexp_replace(seq, "[Nn]", ""))


def callable_coverage(seq: Column, intervals: Column) -> Column:
    """Share of non-N bases inside the union of ``array<struct<start,end>>`` (0-based, end exclusive); 0 without bases."""
    start = F.struct(F.lit(0).alias("covered"), F.lit(0).alias("upto"))

    def add(acc: Column, x: Column) -> Column:
        begin = F.greatest(x["start"], acc["upto"])
        inside = F.when(x["end"] > begin, non_n_bases(F.substring(seq, begin + 1, x["end"] - begin))).otherwise(0)
        return F.struct((acc["covered"] + inside).alias("covered"), F.greatest(x["end"], acc["upto"]).alias("upto"))

    ints = F.transform(intervals, lambda x: F.struct(x["start"].cast("int").alias("start"), x["end"].cast("int").alias("end")))
    covered = F.aggregate(F.array_sort(ints), start, add, lambda acc: acc["covered"])
    total = non_n_bases(seq)
    return F.when(total > 0, covered / F.when(total > 0, total)).otherwise(0.0)


def fingerprint(seq: Column) -> Column:
    return F.sha2(seq, 256)


def safe_name(name: Column) -> Column:
    """Letters, digits, ``-``, ``_`` and ``.`` stay; anything else is ``_``."""
    return F.regexp_replace(name, r"[^\p{L}\p{N}\-_.]", "_")


def normalized_genotype(genotype: Column) -> Column:
    return F.lower(F.trim(genotype))


def reference_genotype(target_id: Column) -> Column:
    """The part of a panel id before its first ``_``; null where that is empty."""
    return F.nullif(F.split_part(target_id, F.lit("_"), F.lit(1)), F.lit(""))


def genotype_group(genotype: Column) -> Column:
    return F.regexp_replace(genotype, r"\D", "")


# The two ways a header may name its genotype, in order of preference.
_TAGS = (r"(?i)(?:^|[|;\s,])(?:genotype|subtype|gt|hcv_gt|hcv-genotype)[:= ]+([0-9][a-z]?)", r"(?i)(?:^|[|;\s,])GT([0-9][a-z]?)(?:$|[|;\s,])")


def header_genotype(header: Column) -> Column:
    """The genotype tag of a FASTA header, lower-cased, or null."""
    return F.coalesce(*[F.nullif(F.lower(F.regexp_extract(header, p, 1)), F.lit("")) for p in _TAGS])


def first_token(header: Column) -> Column:
    return F.regexp_extract(header, r"^\s*(\S*)", 1)


def blank_as_missing(value: Column) -> Column:
    return F.coalesce(F.nullif(F.trim(value.cast("string")), F.lit("")), F.lit(MISSING))


def age_error(age: Column) -> Column:
    """True for an age that is neither blank nor a whole number of at least 0."""
    text = blank_as_missing(age)
    n = text.try_cast("double")
    bad = n.isNull() | F.isnan(n) | (n < 0) | (n == float("inf")) | (n != F.floor(n))
    return (text != MISSING) & F.coalesce(bad, F.lit(True))


def age_range(age: Column) -> Column:
    """The plotting bin of an age: up to 30, up to 60, above; ``(missing)`` for a blank, null for a wrong value."""
    n = blank_as_missing(age).try_cast("double")
    return (
        F.when(blank_as_missing(age) == MISSING, MISSING)
        .when(age_error(age), F.lit(None).cast("string"))
        .when(n <= 30, AGE_RANGES[0]).when(n <= 60, AGE_RANGES[1]).otherwise(AGE_RANGES[2])
    )


def age_range_spelling(value: Column) -> Column:
    """The bin that a given range means; null for an unknown one."""
    pairs = [F.lit(x) for kv in AGE_RANGE_SPELLINGS.items() for x in kv]
    return F.element_at(F.create_map(*pairs), F.trim(value))


def category_sort_key(value: Column) -> Column:
    """Age bins in their order, then other values without regard to case, missing last."""
    place = F.element_at(F.create_map(*[F.lit(x) for i, k in enumerate(AGE_RANGES) for x in (k, i)]), value)
    return F.struct(F.when(value == MISSING, 2).when(place.isNotNull(), 0).otherwise(1).alias("kind"), F.coalesce(place, F.lit(0)).alias("place"), F.lower(value).alias("text"), value.alias("value"))


def metadata_key(base_id: Column, sample_id: Column) -> Column:
    return F.coalesce(F.nullif(F.trim(base_id), F.lit("")), sample_id)


def kmers(seq: Column, k: int) -> Column:
    """The distinct k-mers made of A, C, G, T only; none for a shorter sequence."""
    return F.array_distinct(F.regexp_extract_all(seq, F.lit(f"(?=([ACGT]{{{k}}}))"), F.lit(1)))


def wrapped(seq: Column, width: int = 80) -> Column:
    return F.regexp_replace(seq, f"(?s)(.{{{width}}})(?=.)", "$1\n")


def general_number(x: Column, digits: int = 10) -> Column:
    """A double as C's ``%.10g`` writes it: the shorter of fixed and exponent form, without trailing zeros."""
    return _c_format(f"%.{digits}g")(x.cast("double"))


def fixed_number(x: Column, places: int = 6) -> Column:
    """A double as C's ``%.6f`` writes it."""
    return _c_format(f"%.{places}f")(x.cast("double"))


def _c_format(form: str):
    """The double itself is rounded, half to even; Java's formatter rounds the shortest decimal that is the double, half up."""

    @F.arrow_udf("string")
    def text(x: pa.Array) -> pa.Array:
        return pa.array([None if v is None else form % v for v in x.to_pylist()], pa.string())

    return text


def field_label(name: Column) -> Column:
    return F.replace(name, F.lit("_"), F.lit(" "))


def hover_text(*labelled: tuple[str, Column]) -> Column:
    """HTML-escaped ``label: value`` lines joined by ``<br>``."""
    def escaped(c: Column) -> Column:
        for raw, safe in (("&", "&amp;"), ("<", "&lt;"), (">", "&gt;"), ('"', "&quot;"), ("'", "&#x27;")):
            c = F.replace(c, F.lit(raw), F.lit(safe))
        return c

    return F.concat_ws("<br>", *[F.concat(escaped(F.lit(k)), F.lit(": "), escaped(v.cast("string"))) for k, v in labelled])
