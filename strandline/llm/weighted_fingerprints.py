"""Document fingerprints by consistent weighted sampling.

A word's weight is its count in the text times its length in code points, so that short function words count little. For
each of ``SAMPLES`` samples a word k of weight S draws, from hashes of the word alone, r and c from Gamma(2, 1) and b uniform;
with t = floor(ln S / r + b) and y = exp(r (t - b)) the word with the smallest c / (y exp(r)) is taken, with its t. Two
texts agree in a sample with a probability equal to their generalised Jaccard similarity: the sum of the smaller weights
over the sum of the larger ones.

Only DataFrame functions are used. Words become rows and are counted; the documents are partitioned once, by blocks of doc_id, and every
grouping below includes the block, so nothing else moves a text or a word.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from strandline.session import materialise, table

SAMPLES = 32
LANE = 4
BLOCK_BITS = 8
_LEVEL_BITS = 20
_UNIT = float(1 << 21)


def _successors(blocks: DataFrame) -> DataFrame:
    """``block, next_block``: the next larger block, and the first one after the last.

    Blocks are compared within groups of 2^20 neighbouring numbers, the first ones of groups within groups of groups; at
    the top at most 2^16 rows remain, whatever the corpus.
    """
    level = blocks.select("block", F.shiftright("block", _LEVEL_BITS).alias("g1")).withColumn("g2", F.shiftright("g1", _LEVEL_BITS))
    one = level.withColumn("n0", F.lead("block").over(Window.partitionBy("g1").orderBy("block")))
    first1 = level.groupBy("g2", "g1").agg(F.min("block").alias("f1"))
    two = first1.withColumn("n1", F.lead("f1").over(Window.partitionBy("g2").orderBy("g1")))
    first2 = first1.groupBy("g2").agg(F.min("f1").alias("f2"))
    top = Window.partitionBy(F.lit(1))
    three = first2.withColumn("n2", F.coalesce(F.lead("f2").over(top.orderBy("g2")), F.min("f2").over(top)))
    up = two.join(three.select("g2", "n2"), "g2").select("g1", F.coalesce("n1", "n2").alias("up"))
    return one.join(up, "g1").select("block", F.coalesce("n0", "up").alias("next_block"))


def with_next(docs: DataFrame) -> DataFrame:
    """``block, pos, doc_id, text, next_block, next_pos, next_text``: each row and the one after it by doc_id.

    The last row is followed by the first. Rows that repeat a doc_id follow in the order of a hash of their text; rows
    without doc_id come first. Blocks hold 2^8 consecutive doc_ids, so no sort sees more than a block.
    """
    text = F.coalesce(F.col("text").cast("string"), F.lit(""))
    base = docs.select(F.col("doc_id").cast("long").alias("doc_id"), text.alias("text"))
    base = base.select(F.coalesce(F.shiftright("doc_id", BLOCK_BITS), F.lit(-(1 << 56))).alias("block"), "doc_id", "text", F.xxhash64("text").alias("h"))
    order = Window.partitionBy("block").orderBy("doc_id", "h")
    rows = base.select("block", "doc_id", "text", F.row_number().over(order).alias("pos"), F.lead("text").over(order).alias("following"))
    blocks = docs.select(F.coalesce(F.shiftright(F.col("doc_id").cast("long"), BLOCK_BITS), F.lit(-(1 << 56))).alias("block")).distinct()
    heads = rows.filter("pos = 1").select(F.col("block").alias("next_block"), F.col("text").alias("head"))
    heads = _successors(blocks).join(heads, "next_block").select("block", "next_block", "head")
    out = rows.join(heads, "block", "left")
    last = F.col("following").isNull()
    return out.select(
        "block", "pos", "doc_id", "text",
        F.when(last, F.col("next_block")).otherwise(F.col("block")).alias("next_block"),
        F.when(last, F.lit(1)).otherwise(F.col("pos") + 1).alias("next_pos"),
        F.coalesce("following", "head").alias("next_text"),
    )


def _spaced(text: Column) -> Column:
    return F.translate(text, "\t\n\u000b\f\r", "     ")


def _draw(words: DataFrame, lanes: int) -> DataFrame:
    """Adds ``k{j}`` and ``e{j}``: for sample ``lane * lanes + j`` the word's rank in the text and in the edited text.

    The logarithms of its weights in the two are ``weight_k`` and ``weight_e``; null where the word is missing. A rank is the logarithm of c / (y exp(r)), in steps of 2^-20, above 32 bits of the word's hash and t.
    """
    low = F.lit((1 << 21) - 1)
    part = lambda h, i: (F.shiftrightunsigned(h, 21 * i).bitwiseAND(low).cast("double") + 0.5) / F.lit(_UNIT)
    sample = lambda j: F.col("lane") * lanes + j
    out = words.withColumns({f"h{j}": F.xxhash64("word", sample(j)) for j in range(lanes)})
    out = out.withColumns({f"g{j}": F.xxhash64(F.col(f"h{j}")) for j in range(lanes)})
    draws = {}
    for j in range(lanes):
        draws[f"r{j}"] = -F.ln(part(f"h{j}", 0) * part(f"h{j}", 1))
        draws[f"b{j}"] = part(f"h{j}", 2)
        draws[f"c{j}"] = F.ln(-F.ln(part(f"g{j}", 0) * part(f"g{j}", 1)))
    out = out.withColumns(draws)
    out = out.withColumns({f"t{w}{j}": F.floor(F.col(f"weight_{w}") / F.col(f"r{j}") + F.col(f"b{j}")) for w in ("k", "e") for j in range(lanes)})

    def rank(w: str, j: int) -> Column:
        size = (F.col(f"c{j}") - F.col(f"r{j}") * (F.col(f"t{w}{j}") - F.col(f"b{j}") + 1.0) + F.lit(96.0)) * F.lit(float(1 << 20))
        tag = F.col("word").bitwiseXOR(F.col(f"t{w}{j}") * F.lit(2654435761)).bitwiseAND(F.lit(0xFFFFFFFF))
        return F.shiftleft(size.cast("long"), 32).bitwiseOR(tag)

    return out.select("block", "pos", "lane", *[rank(w, j).alias(f"{w}{j}") for w in ("k", "e") for j in range(lanes)])


def fingerprints(docs: DataFrame, samples: int = SAMPLES, lanes: int = LANE) -> DataFrame:
    """Per row of ``docs``: ``block, pos, next_block, next_pos, doc_id, n_chars, edited_sha256, signature, edited_signature``.

    A signature is an array of ``samples`` words' ids, empty for a text without words. The text and its edited text share
    the words of the kept half, which are drawn once.
    """
    rows = with_next(docs).withColumn("n_chars", F.length("text").cast("long"))
    rows = rows.withColumn("half", F.floor(F.col("n_chars") / 2).cast("int"))
    rows = rows.withColumn("given", F.substring("next_text", F.lit(1), F.col("half"))).withColumn("shared", F.substring("text", F.lit(1), F.col("n_chars").cast("int") - F.col("half")))
    # the word at the cut may go on differently on either side
    cut = F.substring_index(_spaced(F.col("shared")), " ", -1)
    left = F.substring("shared", F.lit(1), F.length("shared") - F.length(cut))
    tail = F.concat(cut, F.substring("text", F.length("shared") + 1, F.col("half")))
    pieces = F.array(*[F.struct(x.alias("x"), F.lit(i).alias("which")) for i, x in enumerate((left, tail, F.concat(cut, "given")))])
    words = rows.select("block", "pos", F.explode(pieces).alias("p")).select("block", "pos", F.col("p.which").alias("which"), F.explode(F.split(_spaced(F.col("p.x")), " ")).alias("w"))
    words = words.filter("w <> ''").select("block", "pos", "which", F.xxhash64("w").alias("word"), F.length("w").alias("length"))
    # words of the shared half count in both texts
    count = lambda other: F.sum(F.when(F.col("which") != other, 1).otherwise(0))
    words = words.groupBy("block", "pos", "word").agg(F.max("length").alias("length"), count(2).alias("n_k"), count(1).alias("n_e"))
    weight = lambda n: F.when(F.col(n) > 0, F.ln(F.col(n).cast("double") * F.col("length")))
    words = words.select("block", "pos", "word", weight("n_k").alias("weight_k"), weight("n_e").alias("weight_e"))
    drawn = _draw(words.select("*", F.explode(F.sequence(F.lit(0), F.lit(samples // lanes - 1))).alias("lane")), lanes)
    least = drawn.groupBy("block", "pos", "lane").agg(*[F.min(f"{w}{j}").alias(f"{w}{j}") for w in ("k", "e") for j in range(lanes)])
    tag = lambda c: F.col(c).bitwiseAND(F.lit(0xFFFFFFFF))
    lane = F.struct("lane", *[F.array(*[tag(f"{w}{j}") for j in range(lanes)]).alias(w) for w in ("k", "e")])
    signed = least.groupBy("block", "pos").agg(F.array_sort(F.collect_list(lane)).alias("lanes"))
    joined = lambda w: F.filter(F.flatten(F.transform("lanes", lambda x: x[w])), lambda v: v.isNotNull())
    signed = signed.select("block", "pos", joined("k").alias("signature"), joined("e").alias("edited_signature"))
    none = F.array().cast("array<bigint>")
    facts = rows.select("block", "pos", "next_block", "next_pos", "doc_id", "n_chars", F.sha2(F.concat("shared", "given"), 256).alias("edited_sha256"))
    return facts.join(signed, ["block", "pos"], "left").withColumns({c: F.coalesce(c, none) for c in ("signature", "edited_signature")})


def likeness(a: str, b: str) -> Column:
    """The share of equal samples; 1 for two texts without words, 0 if only one has none."""
    same = F.aggregate(F.zip_with(a, b, lambda x, y: F.when(x == y, 1).otherwise(0)), F.lit(0), lambda s, x: s + F.coalesce(x, F.lit(0)))
    return F.when((F.size(a) == 0) & (F.size(b) == 0), 1.0).when((F.size(a) == 0) | (F.size(b) == 0), 0.0).otherwise(same / F.size(a))


def _text(signature: str) -> Column:
    return F.array_join(F.transform(signature, lambda x: F.lpad(F.lower(F.hex(x)), 8, "0")), "")


def compare_fingerprints(docs: DataFrame) -> DataFrame:
    """``doc_id, n_chars, edited_sha256, fingerprint, edited_fingerprint, near_edited, near_next``: one row per row.

    The edited text is the text with its last floor(n_chars / 2) code points replaced by the first as many of the next
    document (by doc_id; after the last, the first). A null text is empty; an empty text, or one of white space only, has
    an empty fingerprint, equal to another empty one and unlike any other. Equal texts have equal fingerprints. A single
    row is its own next document; an empty table gives no rows. Other columns are ignored.
    """
    signed = materialise(fingerprints(docs), "fingerprints")
    other = signed.select(F.col("block").alias("next_block"), F.col("pos").alias("next_pos"), F.col("signature").alias("next_signature"))
    out = signed.join(other, ["next_block", "next_pos"], "left")
    return out.select("doc_id", "n_chars", "edited_sha256", _text("signature").alias("fingerprint"), _text("edited_signature").alias("edited_fingerprint"), likeness("signature", "edited_signature").alias("near_edited"), likeness("signature", "next_signature").alias("near_next"))


def op3_weighted_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    return compare_fingerprints(table(spark, sf_dir, "documents"))
