"""Links under a threshold without comparing all pairs: an exact candidate index over windows of sites.

Two rows with at most k differences have none in one of any k + 1 windows that do not overlap. So rows are filed under their
sites in some more windows than that and only rows that share a file are compared. A site that is no plain base fits any base:
it is filed under both classes of bases (purines, pyrimidines). The windows over k + 1 make up for those a row leaves out
because too many of their sites are unknown; a row that would leave out more is compared with every row of its genotype.
Before whole sequences meet, pairs are compared over their first sites as bits, as many as tell rows that have nothing in
common apart. All steps are exact; how many pairs are compared depends on the data, what is found does not.
"""

from __future__ import annotations

import math
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from strandline.operators.block_pairs import cell_tables, met_blocks, written_blocks
from strandline.operators.distance import snp_pairs, tn93_from_counts, tn93_pairs
from strandline.operators.site_bits import codes, packed, whole_rows
from strandline.session import discard, materialise, release, ship_code

#: Sites compared as bits for k differences: 128 and 3 for each difference.
SKETCH = (128, 3)
#: A window with more unknown sites than this is left out by a row.
MOST_UNKNOWN = 12
#: Windows over k + 1, one for 8 of them but 2 at least and 8 at most; two rows may leave out half of them each.
SPARE = (8, 2, 8)
#: A row of fewer plain sites than this among those of its sketch meets all rows of its genotype over whole rows: two such
#: rows, or one and any other, share too few sites in a sketch to be told apart.
LEAST_PLAIN = 0.7
#: Files of more rows are compared block by block instead of being joined.
HOT_ROWS = 512
#: Rows of a block, and how many of them are compared with how many of the other block at a time.
BLOCK_ROWS, STRIP_ROWS, STRIP_COLUMNS = 8192, 8, 4096
#: Pairs are taken one by one when fewer than one in 2^this is left.
FEW_LEFT = 5
#: Cells are dealt to so many tasks at most.
MOST_TASKS = 4000
#: Rows of a group of near rows that meet in one cell, and pairs of it that are measured at a time.
MEET_ROWS, _BATCH_PAIRS = 2048, 1 << 16
#: Words of a sketch that a cell holds as arrays; pairs that are near over these are compared over the rest one by one.
HELD_WORDS = 16
#: Bytes of one file of a row while it is dealt; a genotype whose files would take more than its sites is compared in blocks.
FILE_BYTES = 24
#: Sites of a window, for n rows with w windows ln(n * w) / this: files hold fewer rows as there are more of them.
GROWTH = 0.65
#: Plain sites of a row for which windows are sized.
TYPICAL_SITES = 2000
#: One file of a row takes about as long as comparing so many pairs as bits; a genotype is indexed where that is less work.
FILE_COST = 60
#: Above this distance nearly all windows may differ, and all pairs are compared.
MOST_DISTANCE = 0.15

_BATCH_FILES = 1 << 20


def _decoded(bits: bytes) -> np.ndarray:
    """The codes of a whole row as bits, up to its last plain site."""
    plain, low, high = np.unpackbits(np.frombuffer(bits, np.uint8).reshape(-1, 3, 8), axis=2).transpose(1, 0, 2).reshape(3, -1)
    code = np.where(plain, low | high << 1, -1).astype(np.int8)
    return code[: int(np.flatnonzero(plain)[-1]) + 1 if plain.any() else 0]


def allowed(plain: int, at_most: float | None, most_snps: int | None) -> int:
    """The most differences that a row with so many plain sites may have in a link."""
    limits = [most_snps] if most_snps is not None else []
    if at_most is not None:
        limits.append(math.floor(at_most * plain + 1e-6))
    return min(limits)


def spare(k: np.ndarray | int) -> np.ndarray | int:
    return np.clip(k // SPARE[0], SPARE[1], SPARE[2]) // 2 * 2


def _windows(code: np.ndarray, k: int, size: int) -> tuple[np.ndarray, np.ndarray]:
    """The first windows of a row, and which of them it files; sites beyond its end are unknown."""
    count = k + 1 + int(spare(k))
    part = code[: size * count]
    part = np.concatenate([part, np.full(size * count - len(part), -1, np.int8)]).reshape(count, size)
    return part, (part < 0).sum(axis=1) <= min(MOST_UNKNOWN, size // 2)


def file_count(code: np.ndarray, k: int, size: int) -> int:
    """How many files a row has; 0 if it leaves out too many windows to be sure to meet every near row in one."""
    part, used = _windows(code, k, size)
    # a pair counts on the windows of its smaller k, so too many must not be left out of those either
    smaller = np.arange(k + 1)
    if (np.cumsum(~used)[smaller + spare(smaller)] > spare(smaller) // 2).any():
        return 0
    return int((1 << (part[used] < 0).sum(axis=1)).sum())


def window_files(code: np.ndarray, k: int, size: int) -> np.ndarray:
    """The files of a row: for each window one for each way to fill in the classes of its unknown sites."""
    part, used = _windows(code, k, size)
    unknown = part < 0
    count = unknown.sum(axis=1)
    base = ((part >> 1) * ~unknown).astype(np.int64) @ (np.int64(1) << np.arange(size, dtype=np.int64))
    base += np.arange(len(part), dtype=np.int64) << size
    out = []
    for w in np.unique(count[used]):
        rows = np.flatnonzero(used & (count == w))
        files = base[rows][:, None]
        slots = np.nonzero(unknown[rows])[1].reshape(len(rows), w)
        for i in range(w):
            files = np.concatenate([files, files + (np.int64(1) << slots[:, i])[:, None]], axis=1)
        out.append(files.ravel())
    return np.concatenate(out)


def is_sparse(code: np.ndarray, k: int) -> bool:
    """Whether a row longer than its sketch has too few plain sites in it."""
    n = SKETCH[0] + SKETCH[1] * k
    return len(code) > n and bool((code[:n] >= 0).sum() < LEAST_PLAIN * n)


def sketch(code: np.ndarray, k: int) -> bytes:
    """The first sites, 64 at a time: which are plain, and the two bits of the base."""
    return packed(code[: SKETCH[0] + SKETCH[1] * k])


def _unpacked(column: list[bytes]) -> np.ndarray:
    """The first words of sketches as an array of words, kinds of bits and rows; shorter ones have no plain sites at the end."""
    words = min(HELD_WORDS, max(map(len, column), default=24) // 24)
    out = np.zeros((len(column), words, 3), np.uint64)
    for i, x in enumerate(column):
        part = np.frombuffer(x, np.uint64, min(words, len(x) // 24) * 3)
        out[i, : len(part) // 3] = part.reshape(-1, 3)
    return np.ascontiguousarray(out.transpose(1, 2, 0))


def _differ(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    return np.bitwise_count(a[..., 0] & b[..., 0] & ((a[..., 1] ^ b[..., 1]) | (a[..., 2] ^ b[..., 2])))


def near_in_blocks(one: list[bytes], two: list[bytes], ka: np.ndarray, kb: np.ndarray, asked, half: bool = False) -> tuple[np.ndarray, np.ndarray]:
    """Index pairs with at most the smaller ``k`` differences over the sketches; most drop out after two or three words.

    ``asked`` tells for index pairs whether they are in question; with ``half`` only later rows of the second block are. A few
    rows of either block meet at a time, word by word until few pairs are left, which are then taken one by one. It is
    least work where rows of like ``k`` stand together.
    """
    a, b = _unpacked(one), _unpacked(two)
    words, found = min(len(a), len(b)), []
    # counts over the words held fit 16 bits, and so does what they are compared with
    full = ka, kb
    ka, kb = (np.minimum(k, 64 * HELD_WORDS).astype(np.uint16) for k in (ka, kb))
    shape = STRIP_ROWS, min(STRIP_COLUMNS, len(two))
    places = [np.empty(shape[0] * shape[1], kind) for kind in (np.uint64, np.uint64, np.uint8, np.uint16)]
    for at in range(0, len(one), STRIP_ROWS):
        rows = slice(at, min(len(one), at + STRIP_ROWS))
        for start in range(at if half else 0, len(two), STRIP_COLUMNS):
            columns = slice(start, min(len(two), start + STRIP_COLUMNS))
            held = np.minimum(ka[rows, None], kb[None, columns])
            bits, more, count, seen = (x[: held.size].reshape(held.shape) for x in places)
            seen.fill(0)
            least = int(held.min())
            for w in range(words):
                (plain, low, high), (plain_b, low_b, high_b) = a[w][:, rows, None], b[w][:, None, columns]
                np.bitwise_xor(low, low_b, out=bits)
                np.bitwise_xor(high, high_b, out=more)
                bits |= more
                bits &= plain_b
                bits &= plain
                np.add(seen, np.bitwise_count(bits, out=count), out=seen)
                if 64 * (w + 1) <= least and w + 1 < words:
                    continue  # not enough sites yet to tell any two rows apart
                left = seen <= held
                if np.count_nonzero(left) < left.size >> FEW_LEFT:
                    break
            x, y = np.divmod(np.flatnonzero(left), left.shape[1])
            if not len(x):
                continue
            held, seen, x, y = held[x, y], seen[x, y].astype(np.int64), x + at, y + start
            for v in range(w + 1, words):
                if not len(x):
                    break
                seen += _differ(a[v][:, x].T, b[v][:, y].T)
                ok = seen <= held
                x, y, held, seen = x[ok], y[ok], held[ok], seen[ok]
            ok = asked(x, y) & ((x < y) | (not half))
            x, y, seen = x[ok], y[ok], seen[ok]
            held = np.minimum(full[0][x], full[1][y])
            ok = np.fromiter((seen[i] + _rest(one[x[i]], two[y[i]]) <= held[i] for i in range(len(x))), bool, len(x))
            found.append((x[ok], y[ok]))
    return tuple(np.concatenate(p) for p in zip(*found, strict=True)) if found else (np.zeros(0, np.int64),) * 2


def _rest(one: bytes, two: bytes) -> int:
    """Differences over the words beyond those a cell holds as arrays."""
    at, n = HELD_WORDS * 24, min(len(one), len(two))
    return int(_differ(np.frombuffer(one[at:n], np.uint64).reshape(-1, 3), np.frombuffer(two[at:n], np.uint64).reshape(-1, 3)).sum(dtype=np.int64)) if n > at else 0


def sketches(rows: DataFrame, at_most: float | None, most_snps: int | None, size: int | None = None) -> DataFrame:
    """``g, r, plain, k, files, bits, sparse`` of ``g, r, q`` or ``g, r, whole``: plain sites, differences allowed, files over windows of ``size`` sites, sketch, and whether that has too few plain sites. ``whole``, all sites as bits, is kept."""
    held = "whole" if "whole" in rows.columns else "q"

    def make(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for t in batches:
            rows = []
            for q in t[held].to_pylist():
                code = _decoded(q) if held == "whole" else codes(q)
                plain = int((code >= 0).sum())
                k = allowed(plain, at_most, most_snps)
                rows.append((plain, k, file_count(code, k, size) if size else 0, sketch(code, k), is_sparse(code, k)))
            kinds = (pa.int32(), pa.int32(), pa.int64(), pa.binary(), pa.bool_())
            made = [t["g"], t["r"], *(pa.array([x[i] for x in rows], kind) for i, kind in enumerate(kinds))]
            yield pa.RecordBatch.from_arrays(made + [t[c] for c in kept], names=["g", "r", "plain", "k", "files", "bits", "sparse", *kept])

    kept = ["whole"] if held == "whole" else []
    return rows.select("g", "r", held).mapInArrow(make, "g string, r long, plain int, k int, files long, bits binary, sparse boolean" + ", whole binary" * len(kept))


class Index:
    """Distinct sequences of each genotype, their facts and files, and the pairs to be compared."""

    def __init__(self, rows: DataFrame, at_most: float | None, most_snps: int | None, index: bool | None = None, size: int | None = None, hot_rows: int = HOT_ROWS, block_rows: int = BLOCK_ROWS) -> None:
        """``rows`` has ``g, i, s, q``: genotype, record index, name and sites. ``index`` forces files, or blocks, on all genotypes."""
        ship_code(rows.sparkSession)
        self.at_most, self.most_snps, self.index, self.hot_rows, self.block_rows = at_most, most_snps, index, hot_rows, block_rows
        # sites are held as bits from here on, which take 3/8 of their text; rows of equal bits are copies in every comparison
        rows = whole_rows(rows.filter("g is not null").select("g", "i", "s", F.monotonically_increasing_id().alias("r"), "q"))
        rows = materialise(rows.withColumn("h", F.sha2("whole", 256)), "rows")
        # one row for each different sequence; its number stands for it from here on, and its sites are read where they are asked for
        first = materialise(rows.groupBy("g", "h").agg(F.min("r").alias("r")), "first")
        self.members = materialise(rows.select("g", "h", "i", "s").join(first, ["g", "h"]).select("r", "g", "i", "s"), "members")
        self.reps = first.select("g", "r")
        if size is None:
            size = round(math.log(max(self.reps.count(), 2) * (1 + allowed(TYPICAL_SITES, at_most, most_snps))) / GROWTH)
            size = max(8, min(size, 30, int(0.75 / at_most) if at_most else 30))
        self.size = size
        facts = sketches(rows.select("g", "r", "whole").join(first.select("r"), "r", "left_semi"), at_most, most_snps, size)
        if at_most is not None and at_most < 1:
            facts = facts.filter("plain > 0")  # without comparable sites the distance is 1
        self.facts = materialise(facts, "facts")
        discard(rows)
        release(self.facts.sparkSession)  # the sites were shuffled once to leave out copies
        self.seqs = self.facts.select("r", "whole")
        work = self.facts.groupBy("g").agg(F.sum("files").alias("f"), F.count("*").alias("n"), F.sum("plain").alias("sites"))
        less = (F.col("f") * FILE_COST < F.col("n") * F.col("n") / 2) & (F.col("f") * FILE_BYTES < F.col("sites")) if index is None else F.lit(index)
        self.indexed = work.select("g", less.alias("indexed"))  # one row for each genotype

    def _files(self):
        size = self.size

        def make(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for t in batches:
                held: list[tuple] = []
                for g, r, k, whole in zip(*(t[c].to_pylist() for c in ("g", "r", "k", "whole")), strict=True):
                    held.append((g, r, window_files(_decoded(whole), k, size)))
                    if sum(len(h[2]) for h in held) > _BATCH_FILES:
                        yield _file_batch(held)
                        held = []
                if held:
                    yield _file_batch(held)

        return make

    def groups(self) -> tuple[DataFrame, DataFrame, DataFrame]:
        """``x, y`` of rows that share a small file, each pair once; and members ``g, file, r, own`` of what is compared in blocks: large files, and with ``k, bits`` genotypes.

        In a group that is compared in blocks every pair with an ``own`` row counts.
        """
        indexed = F.broadcast(self.indexed)  # one row for each genotype
        facts = self.facts.filter("not sparse").join(indexed, "g")
        files = facts.filter("indexed and files > 0").select("g", "r", "k", "whole").mapInArrow(self._files(), "g string, r long, file long")
        # one shuffle: the count, both sides of the join and the large files read it
        files = files.repartition("g", "file").withColumn("n", F.count("*").over(Window.partitionBy("g", "file")))
        small = files.filter(f"n > 1 and n <= {self.hot_rows}")
        a, b = small.alias("a"), small.alias("b")
        met = a.join(b, (F.col("a.g") == F.col("b.g")) & (F.col("a.file") == F.col("b.file")) & (F.col("a.r") < F.col("b.r")))
        pairs = met.select(F.col("a.r").alias("x"), F.col("b.r").alias("y")).distinct()
        hot = files.filter(f"n > {self.hot_rows}").select("g", "file", "r", F.lit(True).alias("own"))
        alone = ~F.col("indexed") | (F.col("files") == 0)
        waiting = F.broadcast(facts.filter(alone).select("g").distinct())
        everyone = facts.join(waiting, "g", "left_semi").select("g", F.lit(-1).cast("long").alias("file"), "r", alone.alias("own"), "k", "bits")
        return pairs, hot, everyone

    def sparse(self) -> DataFrame:
        """Members ``g, file, r, own, k, bits`` of the comparison of sparse rows, the ``own`` ones, with all rows of their genotype over whole rows."""
        held = F.broadcast(self.facts.filter("sparse").select("g").distinct())
        return self.facts.join(held, "g", "left_semi").select("g", F.lit(-2).cast("long").alias("file"), "r", F.col("sparse").alias("own"), "k", F.col("whole").alias("bits"))

    def near(self) -> DataFrame:
        """``x, y`` of all pairs that are near over their first sites: every link and few others."""
        pairs, hot, everyone = self.groups()
        facts = self.facts.select("r", "k", "bits")
        end = lambda e: facts.select(F.col("r").alias(e), F.col("k").alias(f"k{e}"), F.col("bits").alias(f"b{e}"))
        met = pairs.join(end("x"), "x").join(end("y"), "y").select("x", "y", F.least("kx", "ky").alias("k"), "bx", "by").mapInArrow(_near_pairs, "x long, y long")
        for wide in (hot.join(facts, "r"), everyone, self.sparse()):
            met = met.unionByName(near_in_cells(wide, self.block_rows))
        return met.distinct()

    def compared(self) -> DataFrame:
        """``pairs, compared``: pairs of different sequences within genotypes, and how many of them meet in a file or a cell."""
        pairs, hot, everyone = self.groups()
        wide = hot.unionByName(everyone.drop("k", "bits")).unionByName(self.sparse().drop("k", "bits"))
        sides = block_cells(wide, cell_sizes(wide), self.block_rows).groupBy("g", "file", "a", "b", "halved").agg(F.count_if(F.col("side") == 0).alias("m"), F.count_if(F.col("side") == 1).alias("n"))
        of_cell = F.when(F.col("halved") & (F.col("a") == F.col("b")), F.expr("m * (m - 1) div 2")).otherwise(F.col("m") * F.col("n"))
        of_all = self.reps.groupBy("g").agg(F.count("*").alias("n")).agg(F.coalesce(F.sum(F.expr("n * (n - 1) div 2")), F.lit(0)).alias("pairs"))
        met = pairs.agg(F.count("*").alias("c")).unionByName(sides.agg(F.coalesce(F.sum(of_cell), F.lit(0)).alias("c"))).agg(F.sum("c").alias("compared"))
        return of_all.join(met)  # two single rows

    def links(self) -> DataFrame:
        """``x, y, snp_count, comparable_sites`` of the pairs of different sequences within the threshold."""
        return confirmed(self.met(), self.seqs, self.at_most, self.most_snps)

    def met(self) -> DataFrame:
        """``near``, written; what was shuffled to find it goes."""
        near = materialise(self.near(), "near")
        release(near.sparkSession)
        return near


def confirmed(near: DataFrame, seqs: DataFrame, at_most: float | None, most_snps: int | None) -> DataFrame:
    """``x, y, snp_count, comparable_sites`` of the pairs ``x, y`` whose sequences ``r, whole`` are within the threshold."""

    def measure(one: list[np.ndarray], two: list[np.ndarray]) -> tuple[np.ndarray, list[np.ndarray]]:
        counts = np.array([_counted(a, b) for a, b in zip(one, two, strict=True)], np.int64).reshape(-1, 2)
        distance = np.where(counts[:, 1] > 0, counts[:, 0] / np.maximum(counts[:, 1], 1), 1.0)
        keep = np.ones(len(counts), bool)
        if at_most is not None:
            keep &= distance <= at_most
        if most_snps is not None:
            keep &= counts[:, 0] <= most_snps
        return keep, [counts[:, i].astype(np.int32) for i in range(2)]

    return over_pairs(near, seqs, measure, ("snp_count int", "comparable_sites int"))


def over_pairs(near: DataFrame, seqs: DataFrame, measure: Callable, fields: tuple[str, ...], meet_rows: int = MEET_ROWS) -> DataFrame:
    """``x, y`` and ``fields`` of the pairs ``x < y`` of rows ``r, whole`` that ``measure`` keeps, given their sites as bits.

    A pair is dealt by the smallest row that its first one is near to. So a group of rows that are all near each other is in
    one cell, and the sites of each are sent there once, not once for each pair. Small groups share a cell; in a larger one
    parts of at most about ``meet_rows`` rows meet, two at a time.
    """
    dealt, sent, cells = meetings(near, meet_rows)
    bits = seqs.join(sent, "r").withColumnRenamed("whole", "bits")
    key = ["c", "a", "b"]
    both = bits.select(*key, "r", F.lit(None).cast("long").alias("y"), "bits").unionByName(dealt.select(*key, F.col("x").alias("r"), "y", F.lit(None).cast("binary").alias("bits")))

    def meet(t: pa.Table) -> pa.Table:
        r, row, pair = (np.asarray(t[n]) for n in ("r", "row", "pair"))
        held = np.flatnonzero(row)
        held = held[np.argsort(r[held])]
        sites = [np.frombuffer(x, np.uint64).reshape(-1, 3) for x in t["bits"].take(pa.array(held)).to_pylist()]
        x, y = r[pair], np.asarray(t["y"].filter(pa.array(pair)))
        one, two = (np.searchsorted(r[held], e) for e in (x, y))
        outs = []
        for at in range(0, len(x), _BATCH_PAIRS):
            part = slice(at, at + _BATCH_PAIRS)
            keep, values = measure([sites[i] for i in one[part]], [sites[i] for i in two[part]])
            outs.append(pa.table([pa.array(v[keep]) for v in (x[part], y[part], *values)], names=names))
        return pa.concat_tables(outs)

    names = ["x", "y", *(f.split()[0] for f in fields)]
    n = max(8, min(2 * cells, MOST_TASKS))
    marked = both.withColumn("row", F.col("bits").isNotNull()).withColumn("pair", F.col("y").isNotNull())
    return marked.repartition(n, *key).groupBy(*key).applyInArrow(meet, ", ".join(["x long", "y long", *fields]))


def meetings(near: DataFrame, meet_rows: int = MEET_ROWS) -> tuple[DataFrame, DataFrame, int]:
    """Pairs ``c, a, b, x, y`` by cells ``c, a, b``; the rows ``c, a, b, r`` that each cell needs; and about how many cells there are."""
    home = near.groupBy(F.col("y").alias("x")).agg(F.min("x").alias("h"))
    homed = materialise(near.join(home, "x", "left").select("x", "y", F.coalesce("h", "x").alias("h")), "homed")
    sizes = materialise(homed.select("h", F.explode(F.array("x", "y")).alias("r")).distinct().groupBy("h").agg(F.ceil(F.count("*") / meet_rows).cast("int").alias("k"), F.count("*").alias("n")), "sizes")
    small, large = sizes.agg(F.coalesce(F.sum(F.when(F.col("k") == 1, F.col("n"))), F.lit(0)), F.coalesce(F.sum(F.when(F.col("k") > 1, F.col("k") * F.col("k"))), F.lit(0))).first()
    shared = -(-small // meet_rows) or 1
    part = lambda e: F.pmod(F.xxhash64(e), F.col("k")).cast("int")
    cell = F.when(F.col("k") == 1, -1 - F.pmod(F.xxhash64("h"), F.lit(shared))).otherwise(F.col("h"))
    dealt = homed.join(sizes.select("h", "k"), "h").select(cell.alias("c"), part("x").alias("a"), part("y").alias("b"), "x", "y")
    sent = materialise(dealt.select("c", "a", "b", F.explode(F.array("x", "y")).alias("r")).distinct(), "sent")
    return dealt, sent, int(shared + large)


def cell_sizes(wide: DataFrame) -> DataFrame:
    """``g, file, m, n``: own and all members of what is compared in blocks; written, so that a small one is known as such and no sites are shuffled to meet it."""
    return materialise(wide.groupBy("g", "file").agg(F.count_if("own").alias("m"), F.count("*").alias("n")).filter("m > 0"), "sizes")


def block_cells(wide: DataFrame, sizes: DataFrame, block_rows: int = BLOCK_ROWS) -> DataFrame:
    """Members ``g, file, r, own`` and what else they have dealt to cells ``g, file, a, b`` in which a block of own rows meets a block of all rows.

    ``side`` tells which block a row is in. Where all rows are own, each two blocks meet once, and ``halved`` is true; a block
    that meets itself is sent once, as the first.
    """
    blocks = lambda c: F.ceil(F.col(c) / block_rows).cast("int")
    sizes = sizes.select("g", "file", blocks("m").alias("ka"), blocks("n").alias("kb"), (F.col("m") == F.col("n")).alias("halved"))
    rows = wide.join(sizes, ["g", "file"])
    more = [c for c in wide.columns if c not in ("g", "file", "r", "own")]
    block = lambda k: F.pmod(F.xxhash64("r"), F.col(k)).cast("int")
    every = lambda k: F.explode(F.sequence(F.lit(0), F.col(k) - 1))
    left = rows.filter("own").select("g", "file", block("ka").alias("a"), every("kb").alias("b"), "r", "own", "halved", F.lit(0).alias("side"), *more)
    right = rows.select("g", "file", every("ka").alias("a"), block("kb").alias("b"), "r", "own", "halved", F.lit(1).alias("side"), *more)
    return left.filter("not halved or a <= b").unionByName(right.filter("not halved or a < b"))


def near_in_cells(wide: DataFrame, block_rows: int = BLOCK_ROWS) -> DataFrame:
    """``x, y`` of the pairs of members with ``k, bits`` that are near over these.

    What fits one block meets in one cell; cells are few rows for much work, so they are dealt to as many tasks as there are
    cells. The blocks of larger groups are written once and meet where they are read.
    """
    sizes = cell_sizes(wide)
    one, many = sizes.filter(F.col("n") <= block_rows), sizes.filter(F.col("n") > block_rows)
    cells = block_cells(wide, one, block_rows).repartition(max(8, min(2 * cell_count(one, block_rows), MOST_TASKS)), "g", "file", "a", "b")
    near = cells.groupBy("g", "file", "a", "b").applyInArrow(near_in_cell, "x long, y long")
    blocks = lambda c: F.ceil(F.col(c) / block_rows).cast("int")
    left_n, right_n = many.agg(F.coalesce(F.sum(blocks("m")), F.lit(0)), F.coalesce(F.sum(blocks("n")), F.lit(0))).first()
    if not right_n:
        return near
    rows = wide.join(F.broadcast(many.select("g", "file", blocks("m").alias("ka"), blocks("n").alias("kb"), (F.col("m") == F.col("n")).alias("halved"))), ["g", "file"])  # fewer groups than blocks
    keys, own = ["g", "file", "halved", "b"], ["r", "own", "k", "bits"]
    block = lambda k: F.pmod(F.xxhash64("r"), F.col(k)).cast("int").alias("b")
    right = written_blocks(rows.select(*keys[:3], block("kb"), *own), keys, right_n)
    # where all rows are own, the blocks of both sides are the same
    left = right.filter("halved").unionByName(written_blocks(rows.filter("own and not halved").select(*keys[:3], block("ka"), *own), keys, left_n))
    on = (F.col("a.g") == F.col("b.g")) & (F.col("a.file") == F.col("b.file")) & (~F.col("a.halved") | (F.col("a.b") <= F.col("b.b")))
    met = met_blocks(left, right, on, [F.col("a.halved").alias("halved"), (F.col("a.halved") & (F.col("a.b") == F.col("b.b"))).alias("same")])
    return near.unionByName(met.mapInArrow(_near_in_met, "x long, y long"))


def _near_in_met(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for t in batches:
        for j, rows, side in cell_tables(t):
            yield from near_of_rows(rows, side, t["halved"][j].as_py(), t["same"][j].as_py()).to_batches()


def cell_count(sizes: DataFrame, block_rows: int = BLOCK_ROWS) -> int:
    """About how many cells there are."""
    blocks = lambda c: F.ceil(F.col(c) / block_rows)
    cells = F.when(F.col("m") == F.col("n"), F.expr("k * (k + 1) div 2")).otherwise(F.col("k") * F.col("j"))
    return int(sizes.select("m", "n", blocks("n").alias("k"), blocks("m").alias("j")).agg(F.coalesce(F.sum(cells), F.lit(0))).first()[0])


def _file_batch(held: list[tuple]) -> pa.RecordBatch:
    n = [len(h[2]) for h in held]
    g = pa.array([h[0] for h in held], pa.string()).take(pa.array(np.repeat(np.arange(len(held)), n)))
    r = np.repeat(np.array([h[1] for h in held], np.int64), n)
    return pa.RecordBatch.from_arrays([g, pa.array(r), pa.array(np.concatenate([h[2] for h in held]))], names=["g", "r", "file"])


def _near_pairs(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for t in batches:
        k = np.asarray(t["k"])
        keep = np.zeros(t.num_rows, bool)
        for i, (one, two) in enumerate(zip(t["bx"].to_pylist(), t["by"].to_pylist(), strict=True)):
            n = min(len(one), len(two))
            keep[i] = _differ(np.frombuffer(one[:n], np.uint64).reshape(-1, 3), np.frombuffer(two[:n], np.uint64).reshape(-1, 3)).sum(dtype=np.int64) <= k[i]
        at = pa.array(np.flatnonzero(keep))
        yield pa.RecordBatch.from_arrays([t["x"].take(at), t["y"].take(at)], names=["x", "y"])


def near_in_cell(t: pa.Table) -> pa.Table:
    return near_of_rows(t, np.asarray(t["side"]), t["halved"][0].as_py(), t["a"][0].as_py() == t["b"][0].as_py())


def near_of_rows(t: pa.Table, side: np.ndarray, halved: bool, same: bool) -> pa.Table:
    """``x, y`` of the near rows of a cell, or of two blocks."""
    r, own, k = (np.asarray(t[c]) for c in ("r", "own", "k"))
    order = np.lexsort((r, k))
    one = order[side[order] == 0]
    two = one if halved and same else order[side[order] == 1]
    bits = t["bits"].to_pylist()
    ra, rb, once = r[one], r[two], own[two]
    # in a halved cell of a block with itself both sides are the same rows; elsewhere pairs of two own rows that meet twice
    # count once
    once = np.zeros_like(once) if halved else once
    asked = lambda x, y: np.where(once[y], ra[x] < rb[y], ra[x] != rb[y])
    x, y = near_in_blocks([bits[i] for i in one], [bits[i] for i in two], k[one], k[two], asked, halved and same)
    return pa.table({"x": np.minimum(ra[x], rb[y]), "y": np.maximum(ra[x], rb[y])})


def _counted(one: np.ndarray, two: np.ndarray) -> tuple[int, int]:
    """Differing and comparable sites of two whole rows as bits."""
    n = min(len(one), len(two))
    a, b = one[:n], two[:n]
    both = a[:, 0] & b[:, 0]
    return int(np.bitwise_count(both & ((a[:, 1] ^ b[:, 1]) | (a[:, 2] ^ b[:, 2]))).sum(dtype=np.int64)), int(np.bitwise_count(both).sum(dtype=np.int64))


def _base_counts(one: np.ndarray, two: np.ndarray) -> np.ndarray:
    """Sites by the bases A, C, G, T of two whole rows as bits."""
    n = min(len(one), len(two))
    sides = []
    for plain, low, high in (one[:n].T, two[:n].T):
        sides.append(np.stack([plain & ~low & ~high, plain & ~low & high, plain & low & ~high, plain & low & high]))
    return np.bitwise_count(sides[0][:, None] & sides[1][None]).sum(axis=2, dtype=np.int64)


def near_links(aligned: DataFrame, at_most: float | None = None, most_snps: int | None = None, genotype: str = "genotype", idx: str = "record_idx", seq_id: str = "seq_id", seq: str = "aligned", **how) -> DataFrame:
    """The rows of ``snp_pairs`` with at most this distance or so many SNPs, found without comparing all pairs.

    Equal sequences are one in the search; their links are written out at the end, as the result has them. The threshold must
    be given; with a distance above 0.15 all pairs are compared. Rows without a genotype have no links; null sequences have no
    sites. With a limit of SNPs a row with fewer plain sites than that is linked to nearly all, so the result itself grows
    with the pairs of such rows.
    """
    if at_most is None and most_snps is None:
        raise ValueError("a threshold is needed")
    if (at_most is not None and at_most < 0) or (most_snps is not None and most_snps < 0):
        raise ValueError("thresholds must be non-negative")
    if most_snps is None and at_most > MOST_DISTANCE:
        return snp_pairs(aligned, None, at_most, most_snps, genotype, idx, seq_id, seq)
    index = Index(index_rows(aligned, genotype, idx, seq_id, seq), at_most, most_snps, **how)
    same = index.facts.select(F.col("r").alias("x"), F.lit(0).alias("snp_count"), F.col("plain").alias("comparable_sites"))
    return as_links(with_members(index, index.links(), same), genotype)


def near_tn93(aligned: DataFrame, at_most: float, genotype: str = "genotype", idx: str = "record_idx", seq_id: str = "seq_id", seq: str = "aligned", **how) -> DataFrame:
    """The rows of ``tn93_pairs`` in the mode ``skip`` up to this distance, found without comparing all pairs.

    A logarithm is below its tangent, so TN93 is never under the share of differing sites, and every row is a pair within
    ``at_most`` by that share. With a distance above 0.15 all pairs are compared.
    """
    if at_most < 0:
        raise ValueError("the distance is not negative")
    if at_most > MOST_DISTANCE:
        return tn93_pairs(aligned, "skip", at_most, genotype, idx, seq_id, seq)
    index = Index(index_rows(aligned, genotype, idx, seq_id, seq), at_most, None, **how)

    def measure(one: list[np.ndarray], two: list[np.ndarray]) -> tuple[np.ndarray, list[np.ndarray]]:
        counts = np.array([_base_counts(a, b) for a, b in zip(one, two, strict=True)], np.float64).reshape(-1, 4, 4)
        distance = tn93_from_counts(counts)
        return distance <= at_most, [distance]

    found = over_pairs(index.met(), index.seqs, measure, ("distance double",))
    same = index.facts.select(F.col("r").alias("x"), F.lit(0.0).alias("distance"))
    ordered = F.col("ix") < F.col("iy")
    ends = (F.when(ordered, F.col(a)).otherwise(F.col(b)).alias(c) for a, b, c in (("sx", "sy", "source"), ("sy", "sx", "target")))
    return with_members(index, found, same).select(F.col("g").alias(genotype), *ends, "distance")


def index_rows(aligned: DataFrame, genotype: str, idx: str, seq_id: str, seq: str) -> DataFrame:
    return aligned.select(F.col(genotype).cast("string").alias("g"), F.col(idx).cast("long").alias("i"), F.col(seq_id).cast("string").alias("s"), F.coalesce(F.col(seq).cast("string"), F.lit("")).alias("q"))


def with_members(index: Index, found: DataFrame, same: DataFrame) -> DataFrame:
    """``g, ix, sx, iy, sy`` and values of all pairs: those of different sequences ``x, y`` as found, those of copies with the values of ``same``."""
    members = index.members
    end = lambda e: members.select(F.col("r").alias(e), *([F.col("g")] if e == "x" else []), F.col("i").alias(f"i{e}"), F.col("s").alias(f"s{e}"))
    apart = found.join(end("x"), "x").join(end("y"), "y").filter("ix <> iy")
    copies = members.groupBy("r").agg(F.count("*").alias("n")).filter("n > 1").select(F.col("r").alias("x"))
    alike = same.join(copies, "x", "left_semi").join(end("x"), "x").join(end("y").withColumnRenamed("y", "x"), "x").filter("ix < iy")
    columns = ["g", "ix", "sx", "iy", "sy", *(c for c in found.columns if c not in ("x", "y"))]
    return apart.select(columns).unionByName(alike.select(columns))


def as_links(found: DataFrame, genotype: str) -> DataFrame:
    """Pairs with indexes ``ix, iy`` and names ``sx, sy`` in the form of ``snp_pairs``: the first is the one earlier in the input."""
    ordered, sites = F.col("ix") < F.col("iy"), F.col("comparable_sites")
    return found.select(
        F.col("g").alias(genotype), F.when(ordered, F.col("sx")).otherwise(F.col("sy")).alias("source"), F.when(ordered, F.col("sy")).otherwise(F.col("sx")).alias("target"),
        F.when(sites > 0, F.col("snp_count") / F.when(sites > 0, sites)).otherwise(F.lit(1.0)).alias("distance"), F.col("snp_count").cast("int").alias("snp_count"), sites.cast("int").alias("comparable_sites"),
    )
