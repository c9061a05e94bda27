"""Spelling variants: words one letter apart are grouped under the commonest, by a symmetric-delete search.

Every word is filed under itself and under what is left of it when one letter is deleted. Two words are one letter apart
exactly if they share a key that both get by deleting at the same place (a replaced letter), or if one word's key is the
other word (a letter more). Words that share a key in any other way are two letters apart; the place in the key tells, so no
such pair is ever formed. What a word needs of its neighbours, their number and the commonest, comes from the group of a key.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from strandline.session import discard, materialise, ship_code, table

LETTER = r"[A-Za-zÀ-ÿ]"
LEAST_LENGTH, LEAST_COUNT, RATIO = 6, 5, 5
#: Of the words in texts, one in so many has a letter deleted, as its document and spelling decide.
MISSPELT = 199
#: Keys of more letters are hashed, since a word of a million letters has a million of them.
LONG = 48
_PRIME = (1 << 31) - 1
_BASES = (48271, 69621, 16807, 39373)
_PLACE_OF_WORD = -1


def _ascii_lower(word: Column) -> Column:
    """A-Z in lower case; other capitals stay."""
    upper = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
    return F.when(F.octet_length(word) == F.length(word), F.lower(word)).otherwise(F.translate(word, upper, upper.lower()))


def vocabulary(docs: DataFrame) -> DataFrame:
    """``word, n``: the words of all texts and how often they occur.

    A word is a maximal run of letters with A-Z lowered. If the CRC-32 of ``<doc_id>:<word>`` is a multiple of ``MISSPELT``, its
    letter at that number modulo its length is deleted. Results of under ``LEAST_LENGTH`` letters or ``LEAST_COUNT``
    occurrences are left out. A null text has no words; a null doc_id is written as nothing. Counts are partial sums, so a
    word in every text is one row for each task.
    """
    # shorter runs cannot give a word of the least length
    runs = docs.select(F.coalesce(F.col("doc_id").cast("string"), F.lit("")).alias("d"), F.explode(F.regexp_extract_all("text", F.lit(LETTER + f"{{{LEAST_LENGTH},}}"), F.lit(0))).alias("w"))
    runs = runs.select("d", _ascii_lower(F.col("w")).alias("w"))
    runs = runs.select("w", F.crc32(F.concat("d", F.lit(":"), "w").cast("binary")).alias("h"))
    at = (F.col("h") % F.length("w")).cast("int")
    word = F.when(F.col("h") % MISSPELT == 0, F.concat(F.substr("w", F.lit(1), at), F.substr("w", at + 2))).otherwise(F.col("w"))
    return runs.select(word.alias("word")).filter(F.length("word") >= LEAST_LENGTH).groupBy("word").agg(F.count("*").alias("n")).filter(F.col("n") >= LEAST_COUNT)


def _powers(base: int, n: int) -> np.ndarray:
    out = np.ones(1, np.int64)
    while len(out) < n:
        out = np.concatenate([out, out * pow(base, len(out), _PRIME) % _PRIME])
    return out[:n]


def hashed_keys(word: str) -> tuple[np.ndarray, np.ndarray]:
    """Hashes, as two columns of 62 bits, of ``word`` and then of it without each letter; the work follows the length."""
    code = np.frombuffer(word.encode("utf-32-le"), np.uint32).astype(np.int64)
    parts = []
    for base in _BASES:
        sums = np.concatenate([[0], np.cumsum(code * _powers(base, len(code)) % _PRIME)])
        back = pow(base, -1, _PRIME)
        without = (sums[:-1] + (sums[-1] - sums[1:]) % _PRIME * back) % _PRIME
        parts.append(np.concatenate([sums[-1:] % _PRIME, without]))
    return parts[0] << 31 | parts[1], parts[2] << 31 | parts[3]


def _filed_long(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for rank, n, word in zip(*(batch.column(c).to_pylist() for c in ("rank", "n", "word")), strict=True):
            a, b = hashed_keys(word)
            code = np.frombuffer(word.encode("utf-32-le"), np.uint32)
            first = np.concatenate([[True, True], code[1:] != code[:-1]])
            # the word itself if it is too long to be filed as it is; the rest if they are
            keep = slice(0 if len(code) > LONG else 1, None if len(code) > LONG + 1 else 1)
            a, b, first, place = a[keep], b[keep], first[keep], np.arange(-1, len(code))[keep]
            yield pa.RecordBatch.from_arrays([pa.array(np.full(len(a), rank)), pa.array(np.full(len(a), n)), pa.array(place.astype(np.int32)), pa.array(first), pa.array(a), pa.array(b)], names=["rank", "n", "place", "first", "a", "b"])


def filed(words: DataFrame) -> DataFrame:
    """``key, place, first, rank, n``: every word under itself, at place -1, and under itself without the letter at each place.

    ``first`` marks different keys: deleting any of a run of equal letters leaves the same.
    """
    ship_code(words.sparkSession)
    own = words.filter(F.length("word") <= LONG).select(F.col("word").alias("key"), F.lit(_PLACE_OF_WORD).alias("place"), F.lit(True).alias("first"), "rank", "n")
    each = words.filter(F.length("word") <= LONG + 1).select("word", "rank", "n", F.explode(F.sequence(F.lit(0), F.length("word") - 1)).alias("place"))
    cut = each.select(
        F.concat(F.substr("word", F.lit(1), F.col("place")), F.substr("word", F.col("place") + 2)).alias("key"), "place",
        ((F.col("place") == 0) | (F.substr("word", F.col("place") + 1, F.lit(1)) != F.substr("word", F.col("place"), F.lit(1)))).alias("first"), "rank", "n",
    )
    long = words.filter(F.length("word") > LONG).select("rank", "n", "word").mapInArrow(_filed_long, "rank long, n long, place int, first boolean, a long, b long")
    hashed = long.select(F.concat_ws(" ", F.hex("a"), F.hex("b")).alias("key"), "place", "first", "rank", "n")  # no word has a space
    return own.unionByName(cut).unionByName(hashed)


def neighbours(words: DataFrame) -> DataFrame:
    """``rank, n_near, best``: of every word with neighbours their number and the commonest, as ``(n, -rank)``.

    A key's group has one word itself and, at each place, one word for each letter at most, so no group grows with the
    vocabulary. Keys are joined by one shuffle; both kinds of neighbour are read from the sorted group.
    """
    files = filed(words).repartition("key")
    rating = F.struct("n", (-F.col("rank")).alias("r"))
    same = Window.partitionBy("key", "place")
    ranked = same.orderBy(F.desc("n"), "rank")
    key = Window.partitionBy("key")
    is_word, shorter = F.col("place") == _PLACE_OF_WORD, F.col("first") & (F.col("place") != _PLACE_OF_WORD)
    rows = files.select(
        "rank", is_word.alias("is_word"), "first",
        F.count("*").over(same).alias("alike"), F.row_number().over(ranked).alias("nth"), F.max(rating).over(same).alias("top"), F.lead(rating).over(ranked).alias("next"),
        F.max(F.when(is_word, rating)).over(key).alias("word_itself"), F.count_if(shorter).over(key).alias("longer"), F.max(F.when(shorter, rating)).over(key).alias("best_longer"),
    )
    other = F.when(F.col("nth") > 1, F.col("top")).otherwise(F.col("next"))
    met = F.col("first") & F.col("word_itself").isNotNull()
    found = rows.select(
        "rank",
        F.when(F.col("is_word"), F.col("longer")).otherwise(F.col("alike") - 1 + met.cast("long")).alias("k"),
        F.when(F.col("is_word"), F.col("best_longer")).otherwise(F.greatest(other, F.when(met, F.col("word_itself")))).alias("best"),
    )
    return found.filter("k > 0").groupBy("rank").agg(F.sum("k").alias("n_near"), F.max("best").alias("best"))


def roots(forms: DataFrame) -> DataFrame:
    """``rank, root`` of every ``rank, form``: the last one when forms are followed.

    Each round doubles the steps taken, and a form has ``RATIO`` times the count, so a handful of rounds suffice. Each is written.
    """
    links = materialise(forms, "forms")
    at = links.withColumnRenamed("form", "root")
    while True:
        step = at.select(F.col("rank").alias("root"), F.col("root").alias("beyond"))
        new = materialise(at.join(step, "root", "left").select("rank", F.coalesce("beyond", "root").alias("root"), F.col("beyond").isNotNull().alias("moved")), "roots")
        if new.filter("moved").limit(1).count() == 0:
            return new.drop("moved")
        if at is not links:
            discard(at)
        at = new.drop("moved")


def variant_groups(words: DataFrame, ratio: int = RATIO) -> DataFrame:
    """``word, form, root, n, n_near, form_n`` of every ``word, n``.

    ``n_near`` counts the words that differ by one letter inserted, deleted or replaced. ``form`` is the commonest of them, the
    smallest in code-point order among equals, if it has at least ``ratio`` times the word's count, else null. ``root`` is the
    last word when forms are followed, the word itself if it has none. Words of up to 48 letters are compared as they are;
    longer ones by four hashes modulo 2^31 - 1. Null words are left out and counts of a repeated word are summed; an empty
    table gives no rows.
    """
    words = words.filter("word is not null").groupBy("word").agg(F.sum("n").alias("n"))
    # numbered in code-point order, so that numbers stand for words from here on
    words = materialise(words.orderBy("word").withColumn("rank", F.monotonically_increasing_id()), "words")
    near = words.join(neighbours(words), "rank", "left")
    form = F.when(F.col("best.n") >= ratio * F.col("n"), -F.col("best.r"))
    near = materialise(near.select("rank", "word", "n", F.coalesce("n_near", F.lit(0)).cast("long").alias("n_near"), form.alias("form_rank")), "near")
    root = roots(near.filter("form_rank is not null").select("rank", F.col("form_rank").alias("form"))).withColumnRenamed("root", "root_rank")
    forms = words.select(F.col("rank").alias("form_rank"), F.col("word").alias("form"), F.col("n").alias("form_n"))
    tops = words.select(F.col("rank").alias("root_rank"), F.col("word").alias("root"))
    out = near.join(forms, "form_rank", "left").join(root, "rank", "left").join(tops, "root_rank", "left")
    return out.select("word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n")


def op12_spelling_variants(spark: SparkSession, sf_dir: str) -> DataFrame:
    return variant_groups(vocabulary(table(spark, sf_dir, "documents")))
