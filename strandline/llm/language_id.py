"""Language identification by language-bitmask n-gram filters.

The Bloom filters of all languages are bit-sliced: slot s of one array holds a bit for each language whose filter has bit
s set. A lookup of an n-gram is the AND of its slots and returns every language that contains it. Per text and language
the hits are counted and corrected for the filter's false positives, and the largest corrected share decides.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from strandline.llm._sampling import drawn_texts
from strandline.llm._tokens import Chunk, chunks, mix, randoms
from strandline.session import discard, ship_code, table

ORDERS = (2, 3, 4)
SLOTS = 1 << 20
PROBES = 3
PER_LANGUAGE = 1500
#: Of a learning text that is longer, a stretch of so many characters is read, to bound the sample's bytes.
LONGEST = 20_000
LEAST_SHARE = 0.01
UNDETERMINED = "und"


def _ngrams(chunk: Chunk, order: int) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of the byte n-grams that lie in one text, and their rows."""
    data, offsets = chunk.data, chunk.offsets
    n = len(data) - order + 1
    if n <= 0:
        return np.zeros(0, np.uint32), np.zeros(chunk.n + 1, np.int64)
    code = data[:n].astype(np.uint32)
    for i in range(1, order):
        code = code << np.uint32(8) | data[i : i + n]
    last = np.maximum(offsets[1:] - order + 1, offsets[:-1])
    keep = np.ones(n, bool)
    for shift in range(order - 1):
        at = offsets[1:] - 1 - shift
        keep[at[(at >= offsets[:-1]) & (at < n)]] = False
    count = np.maximum(last - offsets[:-1], 0)
    return code[keep], np.r_[0, np.cumsum(count)]


def _key(code: np.ndarray, order: int) -> np.ndarray:
    return code.astype(np.uint64) | np.uint64(order << 40)


def _slots(key: np.ndarray, slots: int) -> list[np.ndarray]:
    h = mix(key + randoms(1, 31)[0])
    size = np.uint64(slots)
    return [(mix(h + np.uint64(i)) % size).astype(np.int64) for i in range(PROBES)]


class LanguageFilters:
    """The bit-sliced filters: ``bits`` has, for each 64 languages, one mask for each slot; ``rates`` are false positive rates."""

    def __init__(self, languages: list[str], bits: np.ndarray):
        self.languages, self.bits = languages, bits
        fill = np.array([np.count_nonzero(bits[i // 64] >> np.uint64(i % 64) & np.uint64(1)) / bits.shape[1] for i in range(len(languages))])
        self.rates = fill**PROBES

    def masks(self, key: np.ndarray) -> list[np.ndarray]:
        """The bitmasks of languages that contain each n-gram, 64 languages at a time."""
        slots = _slots(key, self.bits.shape[1])
        return [np.bitwise_and.reduce([word[slot] for slot in slots]) for word in self.bits]

    def shares(self, texts: pa.Array) -> np.ndarray:
        """Rows by languages: the corrected share of a text's n-grams that the language contains."""
        table_of = {o: self.masks(_key(np.arange(1 << 8 * o, dtype=np.uint32), o)) for o in ORDERS if o <= 2}
        out = []
        for chunk in chunks(pc.utf8_lower(texts)):
            hits, total = np.zeros((chunk.n, len(self.languages))), np.zeros(chunk.n)
            for order in ORDERS:
                code, bounds = _ngrams(chunk, order)
                if len(code):
                    masks = [t[code] for t in table_of[order]] if order in table_of else self.masks(_key(code, order))
                    some = np.diff(bounds) > 0
                    for i in range(len(self.languages)):
                        one = (masks[i // 64] >> np.uint64(i % 64) & np.uint64(1)).astype(np.int64)
                        hits[some, i] += np.add.reduceat(one, bounds[:-1][some])
                total += np.diff(bounds)
            n = np.maximum(total, 1)[:, None]
            out.append(np.clip((hits / n - self.rates) / np.maximum(1 - self.rates, 1e-9), 0, 1))
        return np.concatenate(out) if out else np.zeros((0, len(self.languages)))


def frequent_ngrams(texts: pa.Array) -> np.ndarray:
    """Keys of the n-grams that at least ``LEAST_SHARE`` of the texts contain."""
    out = []
    for order in ORDERS:
        found: list[np.ndarray] = []
        for chunk in chunks(pc.utf8_lower(texts)):
            code, bounds = _ngrams(chunk, order)
            row = np.repeat(np.arange(chunk.n, dtype=np.uint64), np.diff(bounds))
            found.append((np.unique(code.astype(np.uint64) | row << np.uint64(32)) & np.uint64(0xFFFFFFFF)).astype(np.uint32))
        code, n = np.unique(np.concatenate(found), return_counts=True) if found else (np.zeros(0, np.uint32), np.zeros(0))
        out.append(_key(code[n >= max(1, LEAST_SHARE * len(texts))], order))
    return np.concatenate(out)


def _window(text: Column, longest: int) -> Column:
    """A text of up to ``longest`` characters whole, of a longer one a stretch of so many, at a place given by its hash."""
    start = F.pmod(F.xxhash64(text), F.greatest(F.length(text) - longest + 1, F.lit(1))).cast("int") + 1
    return F.when(F.length(text) <= longest, text).otherwise(F.substring(text, start, F.lit(longest)))


def fit(samples: DataFrame, per_language: int = PER_LANGUAGE, longest: int = LONGEST, slots: int = SLOTS) -> LanguageFilters:
    """Learn from ``text, lang`` rows: up to ``per_language`` distinct texts of each language, drawn by a hash of the text.

    A text of more than ``longest`` characters gives a stretch of so many. An n-gram enters a language's filter if at least
    ``LEAST_SHARE`` of the language's sampled texts contain it. Each language is one task's work, bounded by the two numbers;
    the driver gets n-grams, not texts. Any number of languages may occur; a language without a text that has characters
    is not learned.
    """
    ship_code(samples.sparkSession)
    usable = samples.filter("lang is not null and length(text) > 0").select(F.col("text").cast("string").alias("text"), F.col("lang").cast("string").alias("lang"))
    drawn = drawn_texts(usable.select(F.xxhash64("text").alias("h"), F.col("lang").alias("label")), per_language)
    rows = usable.withColumn("h", F.xxhash64("text")).join(F.broadcast(drawn.withColumnRenamed("label", "lang")), ["h", "lang"])
    rows = rows.groupBy("h", "lang").agg(F.any_value(_window(F.col("text"), longest)).alias("text"))

    def learn(t: pa.Table) -> pa.Table:
        texts = pa.concat_arrays(t["text"].cast(pa.large_string()).chunks)
        return pa.table({"lang": t["lang"].slice(0, 1).combine_chunks(), "keys": pa.array([frequent_ngrams(texts).view(np.int64).tobytes()], pa.binary())})

    found = {r["lang"]: np.frombuffer(bytes(r["keys"]), np.uint64) for r in rows.select("lang", "text").groupBy("lang").applyInArrow(learn, "lang string, keys binary").collect()}
    discard(drawn)
    languages = sorted(found)
    bits = np.zeros((max(1, -(-len(languages) // 64)), slots), np.uint64)
    for i, language in enumerate(languages):
        for slot in _slots(found[language], slots):
            bits[i // 64][slot] |= np.uint64(1 << i % 64)
    return LanguageFilters(languages, bits)


def predict(docs: DataFrame, filters: LanguageFilters, keep: list[Column] | None = None) -> DataFrame:
    """``doc_id, lang_pred, score`` (and the ``keep`` columns): one row per row of ``docs``, from the whole text alone.

    ``score`` is the winner's part of all languages' shares. A null text, one without a letter, or any text if no
    language was learned, is ``und`` with score 0. Ties go to the language that sorts first.
    """
    spark = docs.sparkSession
    ship_code(spark)
    shared = spark.sparkContext.broadcast((filters.languages, filters.bits))
    extra = [*(keep or [])]
    rows = docs.select(F.col("text").cast("string").alias("text"), F.coalesce(F.col("text").rlike(r"\p{L}"), F.lit(False)).alias("_letter"), F.col("doc_id").cast("long").alias("doc_id"), *extra)
    fields = rows.schema.fields[2:]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = LanguageFilters(*shared.value)
        names = np.array([*model.languages, UNDETERMINED], object)
        for batch in batches:
            if not batch.num_rows:
                continue
            share = model.shares(batch.column(0)) if model.languages else np.zeros((batch.num_rows, 1))
            best, letter = share.argmax(axis=1), batch.column(1).to_numpy(zero_copy_only=False)
            top, total = share.max(axis=1), share.sum(axis=1)
            known = letter & bool(model.languages)
            pred = np.where(known, best, len(names) - 1)
            score = np.where(known & (total > 0), top / np.maximum(total, 1e-12), 0.0)
            yield pa.RecordBatch.from_arrays([*batch.columns[2:], pa.array(names[pred], pa.string()), pa.array(score)], names=[*batch.schema.names[2:], "lang_pred", "score"])

    kinds = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in fields)
    return rows.mapInArrow(run, f"{kinds}, lang_pred string, score double")


def fold(modulus: int) -> Column:
    """crc32 of doc_id as text, modulo ``modulus``; null for a null doc_id."""
    return F.crc32(F.col("doc_id").cast("string").cast("binary")) % modulus


def op10_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    filters = fit(docs.filter(F.coalesce(fold(4) != 2, F.lit(False))).select("text", "lang"))
    held_out = F.coalesce(fold(4) == 2, F.lit(False)).alias("held_out")
    return predict(docs, filters, [held_out]).select("doc_id", "held_out", "lang_pred", "score")
