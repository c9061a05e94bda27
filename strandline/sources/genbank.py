"""GenBank flat files: features with their qualifiers and the sequence, without further libraries."""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


@dataclass
class Feature:
    """One entry of the feature table; ``parts`` are 1-based inclusive stretches in the order of the location."""

    type: str
    parts: list[tuple[int, int]]
    reverse: bool = False
    qualifiers: dict[str, list[str]] = field(default_factory=dict)

    @property
    def start(self) -> int:
        return min(a for a, _ in self.parts)

    @property
    def end(self) -> int:
        return max(b for _, b in self.parts)

    def first(self, key: str) -> str:
        return self.qualifiers.get(key, [""])[0]


@dataclass
class Record:
    accession: str
    features: list[Feature]
    sequence: str


def _feature(lines: list[str]) -> Feature | None:
    kind, location, entries = lines[0][5:21].strip(), lines[0][21:].strip(), []
    for line in lines[1:]:
        text = line[21:].strip()
        if text.startswith("/"):
            entries.append(text[1:])
        elif entries:
            entries[-1] += ("" if entries[-1].startswith("translation=") else " ") + text
        else:
            location += text
    parts = [(int(a), int(b or a)) for a, b in re.findall(r"<?(\d+)(?:\.\.>?(\d+))?", re.sub(r"[\w.]+:", "", location))]
    qualifiers: dict[str, list[str]] = {}
    for entry in entries:
        key, _, value = entry.partition("=")
        qualifiers.setdefault(key, []).append(value.strip().strip('"').replace('""', '"'))
    return Feature(kind, parts, "complement" in location, qualifiers) if parts else None


def parse_record(text: str) -> Record:
    """The first record of a flat file; a file without LOCUS and ORIGIN is an error."""
    head, found, body = text.partition("\nORIGIN")
    if not found or not head.lstrip().startswith("LOCUS"):
        raise ValueError("not a GenBank flat file with a sequence")
    lines = head.splitlines()
    version = next((x.split()[1] for x in lines if x.startswith("VERSION") and len(x.split()) > 1), "")
    accession = version or next((x.split()[1] for x in lines if x.startswith("ACCESSION") and len(x.split()) > 1), "")
    at = next((i for i, x in enumerate(lines) if x.startswith("FEATURES")), len(lines))
    groups: list[list[str]] = []
    for line in lines[at + 1 :]:
        if not line.startswith("     "):
            break
        if line[5:6].strip():
            groups.append([line])
        elif groups:
            groups[-1].append(line)
    sequence = re.sub(r"[^A-Za-z]", "", body.split("//")[0].partition("\n")[2]).upper().replace("U", "T")
    return Record(accession, [f for f in map(_feature, groups) if f], sequence)


_NAMES, _PARTS = re.compile(r"[\w.]+:"), re.compile(r"<?(\d+)(?:\.\.>?(\d+))?")
#: Columns of a feature beside those of its record.
_COLUMNS = ("feature_idx int", "type string", "start int", "end int", "n_parts int", "reverse boolean", "product string", "gene string")


def features_of(text: str) -> tuple[str, list[tuple]]:
    """The accession of a record and a row ``_COLUMNS`` for each feature: what ``parse_record`` finds, without the sequence, other qualifiers and the parts themselves."""
    head, found, _ = text.partition("\nORIGIN")
    if not found or not head.lstrip().startswith("LOCUS"):
        raise ValueError("not a GenBank flat file with a sequence")
    lines = head.splitlines()
    version = accession = ""
    at = None
    for i, x in enumerate(lines):
        if x.startswith("FEATURES") and at is None:
            at = i
        elif x.startswith("VERSION") and not version:
            version = (x.split() + ["", ""])[1]
        elif x.startswith("ACCESSION") and not accession:
            accession = (x.split() + ["", ""])[1]
    rows: list[tuple] = []
    if at is not None:
        for first, location, entries in _entries(lines, at + 1):
            if ":" in location:
                location = _NAMES.sub("", location)
            parts = _PARTS.findall(location)
            if not parts:
                continue
            if len(parts) == 1:
                a, b = parts[0]
                start, end = int(a), int(b or a)
            else:
                start, end = min([int(a) for a, _ in parts]), max([int(b or a) for a, b in parts])
            product = gene = None
            for entry in entries:
                key, _, value = entry.partition("=")
                if key == "gene" and gene is None:
                    gene = value.strip().strip('"').replace('""', '"')
                elif key == "product" and product is None:
                    product = value.strip().strip('"').replace('""', '"')
            rows.append((len(rows), first[5:21].strip(), start, end, len(parts), "complement" in location, product or "", gene or ""))
    return version or accession, rows


def _entries(lines: list[str], at: int) -> Iterator[tuple[str, str, list[str]]]:
    """The first line, the location and the qualifiers of each feature from line ``at`` on."""
    first, location, entries = "", "", []
    for i in range(at, len(lines)):
        line = lines[i]
        if not line.startswith("     "):
            break
        if line[5:6].strip():
            if first:
                yield first, location, entries
            first, location, entries = line, line[21:].strip(), []
        elif first:
            text = line[21:].strip()
            if text.startswith("/"):
                entries.append(text[1:])
            elif entries:
                entries[-1] += ("" if entries[-1].startswith("translation=") else " ") + text
            else:
                location += text
    if first:
        yield first, location, entries


def _records(spark: SparkSession, path: str) -> DataFrame:
    """``record_idx, value``: the records of all files under ``path``, as text without their end mark.

    The reader splits at lines that begin with ``//``, so a file of many records is read by many tasks, each from the first
    record that begins in its share of the bytes; ``record_idx`` orders them and does not count them.
    """
    raw = spark.read.option("lineSep", "\n//").text(path).select(F.replace("value", F.lit("\r"), F.lit("")).alias("value"), F.monotonically_increasing_id().alias("record_idx"))
    return raw.filter(F.col("value").rlike(r"\S")).select("record_idx", F.regexp_replace("value", r"^\s+", "").alias("value"))


def read_sequences(spark: SparkSession, path: str) -> DataFrame:
    """``record_idx, accession, sequence`` of every record: letters in upper case, U as T. A record without ORIGIN fails the query.

    The accession is that of VERSION, else of ACCESSION, else empty.
    """
    named = lambda key: F.regexp_extract("head", rf"(?m)^{key}[ \t]+(\S+)", 1)
    at = F.locate("\nORIGIN", F.col("value"))
    whole = F.when((at > 0) & F.col("value").startswith("LOCUS"), F.col("value")).otherwise(F.raise_error(F.concat(F.lit("not a GenBank record with a sequence: "), F.substring("value", 1, 60))))
    parts = _records(spark, path).withColumn("value", whole).select("record_idx", F.substring("value", F.lit(1), at).alias("head"), F.substring("value", at + 1, F.length("value")).alias("body"))
    letters = F.regexp_replace(F.regexp_replace("body", r"^[^\n]*", ""), "[^A-Za-z]", "")
    accession = F.coalesce(F.nullif(named("VERSION"), F.lit("")), named("ACCESSION"))
    return parts.select("record_idx", accession.alias("accession"), F.translate(F.upper(letters), "U", "T").alias("sequence"))


def read_features(spark: SparkSession, path: str) -> DataFrame:
    """``record_idx, accession, feature_idx, type, start, end, n_parts, reverse, product, gene`` of every record's features.

    Features are numbered from 0 within their record, in its order; ``start`` and ``end`` are those of the whole location.
    """
    from strandline.session import ship_code

    ship_code(spark)
    schema = ", ".join(("record_idx long", "accession string", *_COLUMNS))

    def run(batches):
        import numpy as np
        import pyarrow as pa

        kinds = [pa.int32(), pa.string(), pa.int32(), pa.int32(), pa.int32(), pa.bool_(), pa.string(), pa.string()]
        names = [x.split()[0] for x in schema.split(", ")]
        for batch in batches:
            found = [features_of(text) for text in batch.column("value").to_pylist()]
            of = pa.array(np.repeat(np.arange(len(found)), [len(rows) for _, rows in found]))
            columns = list(zip(*(r for _, rows in found for r in rows), strict=True)) or [()] * len(kinds)
            accession = pa.array([x for x, _ in found], pa.string())
            yield pa.RecordBatch.from_arrays([batch.column("record_idx").take(of), accession.take(of), *(pa.array(c, k) for c, k in zip(columns, kinds, strict=True))], names=names)

    return _records(spark, path).mapInArrow(run, schema)
