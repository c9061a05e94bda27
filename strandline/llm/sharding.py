"""Sharding by a minimax contiguous partition: equal texts stay together and the largest shard is as small as can be.

Texts are ordered by a 64-bit hash, so equal ones are neighbours and form one atomic group, and the order is dealt evenly
whatever the texts are. The smallest capacity with which the groups, taken in order, fill the shards is found by binary search
with a greedy check. The check runs on sums over stretches of the order; only stretches in which a cut may still fall are
summed again in finer ones, down to single groups, so the driver holds some thousand sums at any size of the table.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from strandline.session import materialise, table

SHARDS = 24
#: Bytes that a document counts besides its text.
ROW_BYTES = 8
#: The order is first cut into 2^12 stretches; each pass cuts those in question into 2^8.
FIRST_BITS, MORE_BITS = 12, 8
#: Rows of a shard that are numbered in one piece, on average.
PIECE_ROWS = 50_000


def order_key(text: str = "text") -> Column:
    """The place of a text in the order; a null text is an empty one."""
    return F.xxhash64(F.coalesce(F.col(text).cast("string"), F.lit("")))


def size_of(text: str = "text") -> Column:
    return (F.coalesce(F.octet_length(F.col(text).cast("string")), F.lit(0)) + ROW_BYTES).cast("long")


@dataclass
class Atoms:
    """Neighbouring groups that are counted as one: the ends of their keys and their bytes, in order."""

    low: np.ndarray
    high: np.ndarray
    size: np.ndarray

    def __post_init__(self) -> None:
        self.ends = np.concatenate([[0], np.cumsum(self.size)]).astype(np.int64)
        self.single = self.low == self.high

    def fill(self, at: int, capacity: int, split: str) -> int:
        """How far a shard reaches that starts after ``at`` bytes; a stretch of several groups counts as a whole or may be cut anywhere."""
        to = min(at + capacity, int(self.ends[-1]))
        i = int(np.searchsorted(self.ends, to, "right")) - 1
        inside = i < len(self.size) and self.ends[i] < to
        return to if inside and split == "anywhere" and not self.single[i] else int(self.ends[i])

    def reach(self, capacity: int, shards: int, split: str) -> list[int]:
        """Ends of the shards when each is filled in turn."""
        out, at = [], 0
        for _ in range(shards):
            at = self.fill(at, capacity, split)
            out.append(at)
        return out

    def least_capacity(self, shards: int, split: str) -> int:
        low, high = -(-int(self.ends[-1]) // shards), int(self.ends[-1])
        while low < high:
            middle = (low + high) // 2
            if self.reach(middle, shards, split)[-1] == self.ends[-1]:
                high = middle
            else:
                low = middle + 1
        return low


@dataclass
class Plan:
    """``own``: keys of groups that fill a shard each, the first shards; ``cuts``: the first key of each later shard but one."""

    shards: int
    own: list[int]
    cuts: list[int]
    capacity: int

    def shard(self, key: Column) -> Column:
        """The shard of a text by its key; an expression of constants, at most two for each shard."""
        later = F.lit(len(self.own))
        for cut in self.cuts:
            later = later + (key >= F.lit(cut)).cast("int")
        out = later
        for i, own in enumerate(self.own):
            out = F.when(key == F.lit(own), F.lit(i)).otherwise(out)
        return out.cast("int")


def _atoms(groups: DataFrame, bits: int) -> Atoms:
    sums = groups.groupBy(F.shiftright("at", 64 - bits).alias("p")).agg(F.min("at").alias("low"), F.max("at").alias("high"), F.sum("size").alias("size")).drop("p")
    rows = sorted(sums.collect())  # 2^12, or 2^8 for each stretch that a cut may fall in
    return Atoms(*(np.array([r[i] for r in rows], np.int64) for i in range(3)))


def plan_shards(docs: DataFrame, shards: int = SHARDS) -> Plan:
    """Cuts of the order so that the largest shard has as few bytes as possible and no two equal texts are parted.

    A group with more bytes than an equal share of what is left gets a shard of its own, and the others divide the rest: with
    it in their midst they could be filled up to its size and some would stay empty. Shards are then cut where their ends come
    nearest to equal shares, none beyond the capacity found. Two texts with one hash, if there ever are, count as one group.
    """
    if shards < 1:
        raise ValueError("there must be at least one shard")
    groups = materialise(docs.select(order_key().alias("at"), size_of().alias("size")).groupBy("at").agg(F.sum("size").alias("size")), "groups")
    rest = int(groups.agg(F.sum("size")).first()[0] or 0)
    own: list[int] = []
    for at, size in groups.orderBy(F.desc("size"), "at").limit(shards).collect():  # one row for each shard at most
        left = shards - len(own)
        if left == 1 or size * left <= rest:
            break
        own.append(at)
        rest -= size
    left = shards - len(own)
    groups = groups.filter(~F.col("at").isin(own)) if own else groups
    bits = FIRST_BITS
    atoms = _atoms(groups, bits)
    while True:
        enough, needed = atoms.least_capacity(left, "nowhere"), atoms.least_capacity(left, "anywhere")
        if enough == needed:
            break
        # a cut lies between where shards of the needed size end at the latest stretch and where enough room ends
        first, last, at = [], atoms.reach(enough, left, "anywhere"), 0
        for _ in range(left):
            at = atoms.fill(at, needed, "nowhere")
            first.append(at)
        hit = ~atoms.single & np.any([(atoms.ends[1:] > a) & (atoms.ends[:-1] < b) | (atoms.ends[:-1] <= a) & (a < atoms.ends[1:]) for a, b in zip(first, last, strict=True)], axis=0)
        if not hit.any():
            raise RuntimeError("no stretch is left to be cut finer, and the capacity is not settled")
        more = _atoms(groups.filter(F.shiftright("at", 64 - bits).isin([int(x) >> (64 - bits) for x in atoms.low[hit]])), bits + MORE_BITS)
        low, high, size = (np.concatenate([getattr(atoms, f)[~hit], getattr(more, f)]) for f in ("low", "high", "size"))
        order = np.argsort(low)
        atoms, bits = Atoms(low[order], high[order], size[order]), bits + MORE_BITS
    return Plan(shards, own, _cuts(atoms, left, enough), enough)


def _cuts(atoms: Atoms, shards: int, capacity: int) -> list[int]:
    """The first key of each shard after the first: ends near equal shares, no shard over ``capacity``."""
    total = int(atoms.ends[-1])
    back = Atoms(-atoms.high[::-1], -atoms.low[::-1], atoms.size[::-1]).reach(capacity, shards, "nowhere")
    at, out = 0, []
    for i in range(1, shards):
        least, most = max(at, total - back[shards - i - 1]), atoms.fill(at, capacity, "nowhere")
        near = int(np.searchsorted(atoms.ends, i * total / shards))
        near = min((x for x in (near - 1, near) if 0 <= x < len(atoms.ends)), key=lambda x: abs(int(atoms.ends[x]) * shards - i * total), default=0)
        at = min(max(int(atoms.ends[near]), least), most)
        j = int(np.searchsorted(atoms.ends, at, "right")) - 1  # past groups of no bytes; there are none, a row has some
        out.append(int(atoms.low[j]) if j < len(atoms.low) else (1 << 63) - 1)
    return out


def assign(docs: DataFrame, shards: int = SHARDS) -> DataFrame:
    """``doc_id, size, text_crc32, shard, slot`` of every row.

    ``size`` is the text's UTF-8 bytes and 8 more, ``text_crc32`` the unsigned CRC-32 of them; a null text is an empty one.
    Slots count from 0 in each shard without gaps, by a hash of doc_id and text; the same rows get the same slots in every run.
    Rows that repeat doc_id and text are counted and take slots in a row. A null doc_id stays null; other columns are not
    read. An empty table gives no rows; with fewer texts than shards some shards are empty.
    """
    plan = plan_shards(docs, shards)
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), order_key().alias("at"), size_of().alias("size"), F.crc32(F.coalesce(F.col("text").cast("string"), F.lit("")).cast("binary")).alias("text_crc32"))
    items = materialise(rows.groupBy("doc_id", "at", "size", "text_crc32").agg(F.count("*").alias("n")).withColumn("shard", plan.shard(F.col("at"))), "items")
    # a shard is numbered in pieces: one may hold a third of all rows
    pieces = max(64, -(-items.count() // (PIECE_ROWS * shards)))
    items = items.withColumn("piece", F.pmod(F.xxhash64("doc_id", "at"), F.lit(pieces)))
    sums = items.groupBy("shard", "piece").agg(F.sum("n").alias("held"))
    starts = sums.select("shard", "piece", (F.sum("held").over(Window.partitionBy("shard").orderBy("piece")) - F.col("held")).alias("start"))
    place = F.sum("n").over(Window.partitionBy("shard", "piece").orderBy("doc_id", "at", "size", "text_crc32").rowsBetween(Window.unboundedPreceding, 0)) - F.col("n")
    placed = items.withColumn("place", place).join(starts, ["shard", "piece"]).withColumn("slot", F.col("start") + F.col("place"))
    return placed.select("doc_id", "size", "text_crc32", "shard", F.explode(F.sequence(F.col("slot"), F.col("slot") + F.col("n") - 1)).alias("slot"))


def write_shards(docs: DataFrame, path: str, shards: int = SHARDS, files: int = 1) -> Plan:
    """All columns of ``docs`` as Parquet in a folder ``shard=<no>`` for each shard, in ``files`` files each or fewer.

    Rows go to their shard by a constant expression, without a join; a column named ``shard`` is replaced.
    """
    plan = plan_shards(docs, shards)
    out = docs.withColumn("shard", plan.shard(order_key()))
    # by range, not hash: every piece of a shard gets a task, whatever the number of shards
    piece = F.pmod(F.xxhash64("doc_id"), F.lit(files))
    out.repartitionByRange(shards * files, "shard", piece).write.partitionBy("shard").parquet(path)
    return plan


def op11_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = assign(table(spark, sf_dir, "documents"))
    return out.select("doc_id", "size", "text_crc32", F.lit("bytes").alias("law"), "shard", "slot", F.lit(None).cast("int").alias("grown_shard"))
