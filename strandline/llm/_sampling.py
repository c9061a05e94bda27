"""A bounded sample of distinct texts for each label, drawn by hashes alone."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from strandline.session import discard, materialise


def drawn_texts(rows: DataFrame, most: int) -> DataFrame:
    """``h, label``: at most ``most`` distinct texts of each label, in the order of a hash of them.

    ``rows`` has ``h``, a 64-bit hash of the text, and ``label``, of few values. A count by label sets a cut below which a few
    more texts lie than are wanted, so the ordering that follows sees those alone, whatever the input's size and however
    often a text is repeated. A label with no more texts than are wanted gives all of them.
    """
    at = F.shiftrightunsigned(F.xxhash64("h"), 2)
    distinct = materialise(rows.select("h", "label").distinct(), "labelled")
    share = F.lit(most + 8 * most**0.5 + 20) / F.col("n")
    cut = distinct.groupBy("label").agg(F.count("*").alias("n")).select("label", F.when(share >= 1, F.lit(1 << 62)).otherwise(F.floor(share * (1 << 62))).alias("cut"))
    near = distinct.join(F.broadcast(cut), "label").withColumn("at", at).filter("at <= cut")
    nth = F.row_number().over(Window.partitionBy("label").orderBy("at", "h"))
    out = materialise(near.withColumn("nth", nth).filter(f"nth <= {most}").select("h", "label"), "drawn")
    discard(distinct)
    return out
