"""Exact pairwise distances within a genotype, thresholds and links."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from strandline.functions.sequence import upper_ascii
from strandline.operators.block_pairs import cell_tables, met_blocks, written_blocks
from strandline.operators.site_bits import known_sites, strips, whole_rows
from strandline.session import materialise, ship_code

#: Rows of a genotype in one block; a pair of blocks is one unit of work.
BLOCK_ROWS = 2048
#: Sites that are compared at a time.
SITES = 2048

# The bases each IUPAC code stands for.
IUPAC = {"A": "A", "C": "C", "G": "G", "T": "T", "R": "AG", "Y": "CT", "S": "CG", "W": "AT", "K": "GT", "M": "AC", "B": "CGT", "D": "AGT", "H": "ACT", "V": "ACG", "N": "ACGT"}
MODES = ("resolve", "average", "skip", "gapmm")


def in_cells(aligned: DataFrame, genotype: str, idx: str, seq_id: str, seq: Column, block_rows: int, measure: Callable[[pa.Table], Iterator[pa.RecordBatch]], schema: str, bits: bool = False) -> DataFrame:
    """What ``measure`` yields for cells ``g, p, r, b, i, s, q``, with ``bits`` ``whole`` for ``q``, in which every two rows of a genotype meet.

    A genotype of n rows is cut into ceil(n / block_rows) blocks by a hash, and each pair of blocks is one cell, so a large
    genotype spreads over blocks^2 / 2 cells. All pairs are the result asked for; nothing is dropped. ``b`` is a row's block,
    ``p`` and ``r`` are those of the cell. Blocks are written once and read for each other, so that the disk holds no copies.
    """
    rows = aligned.select(F.col(genotype).cast("string").alias("g"), F.col(idx).cast("long").alias("i"), F.col(seq_id).cast("string").alias("s"), (seq if bits else upper_ascii(seq)).alias("q"))
    if bits:
        rows = whole_rows(rows)
    # one row for each genotype
    sizes = materialise(aligned.groupBy(F.col(genotype).cast("string").alias("g")).agg(F.ceil(F.count("*") / block_rows).cast("int").alias("k")), "sizes")
    blocks = sizes.filter("g is not null").agg(F.coalesce(F.sum("k"), F.lit(0))).first()[0]
    cut = rows.join(F.broadcast(sizes), "g").withColumn("b", F.pmod(F.xxhash64("i"), F.col("k")).cast("int")).drop("k")
    blocks = written_blocks(cut, ["g", "b"], blocks)
    columns = [F.col("a.g").alias("g"), F.col("a.b").alias("p"), F.col("b.b").alias("r"), (F.col("a.b") == F.col("b.b")).alias("same")]
    alone = blocks.join(F.broadcast(sizes.filter("k = 1")), "g", "left_semi")
    itself = alone.alias("a").select(F.col("a.g").alias("g"), F.col("a.b").alias("p"), F.col("a.b").alias("r"), F.lit(True).alias("same"), F.col("a.rows").alias("one"), F.col("a.rows").alias("two"))
    larger = blocks.join(F.broadcast(sizes.filter("k > 1")), "g", "left_semi")
    met = met_blocks(larger, larger, (F.col("a.g") == F.col("b.g")) & (F.col("a.b") <= F.col("b.b")), columns)

    def each(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for t in batches:
            for j, rows, side in cell_tables(t):
                p, r = t["p"][j].as_py(), t["r"][j].as_py()
                same = {"g": pa.repeat(t["g"][j], len(rows)), "p": pa.repeat(p, len(rows)), "r": pa.repeat(r, len(rows)), "b": pa.array(np.where(side == 0, p, r))}
                yield from measure(pa.table({**same, **{c: rows[c] for c in rows.column_names}}))

    return itself.unionByName(met).mapInArrow(each, schema)


def site_codes(seqs: list[str | None], codes: str) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """``(rows, code)`` for each stretch of sites: the rows that reach it and, site by site, where ``codes`` lists them or -1.

    Rows may differ in length; a site beyond a row's end is -1. Memory follows the stretch, not the longest row.
    """
    place = np.full(256, -1, np.int8)
    place[np.frombuffer(codes.encode(), np.uint8)] = np.arange(len(codes))
    # one byte for each character; what Latin-1 lacks becomes a mark that no code is
    raw = [np.frombuffer((x or "").encode("latin-1", "replace"), np.uint8) for x in seqs]
    ends = np.array([len(x) for x in raw], np.int64)
    for start in range(0, int(ends.max(initial=0)), SITES):
        rows = np.flatnonzero(ends > start)
        code = np.full((len(rows), min(SITES, int(ends.max()) - start)), -1, np.int8)
        for j, row in enumerate(rows):
            part = raw[row][start : start + SITES]
            code[j, : len(part)] = place[part]
        yield rows, code


def cell_pairs(t: pa.Table, genotype: str, keep: np.ndarray, values: dict[str, np.ndarray]) -> pa.Table:
    """The kept pairs of a cell, each once and the earlier row first, with their values."""
    p, r, b, i = (np.asarray(t[c]) for c in ("p", "r", "b", "i"))
    one, two = np.flatnonzero(b == p[0]), np.flatnonzero(b == r[0])
    first, second = i[one][:, None], i[two][None]
    x, y = np.nonzero(keep & (first < second if p[0] == r[0] else first != second))
    swap = i[one[x]] > i[two[y]]
    s = t["s"].combine_chunks()
    ends = [s.take(pa.array(np.where(swap, m, n))) for m, n in ((two[y], one[x]), (one[x], two[y]))]
    return pa.Table.from_arrays([pa.array([t["g"][0].as_py()] * len(x), pa.string()), *ends, *(pa.array(v[x, y]) for v in values.values())], names=[genotype, "source", "target", *values])


def snp_pairs(aligned: DataFrame, length: int | None = None, at_most: float | None = None, most_snps: int | None = None, genotype: str = "genotype", idx: str = "record_idx", seq_id: str = "seq_id", seq: str = "aligned", block_rows: int = BLOCK_ROWS) -> DataFrame:
    """``genotype, source, target, distance, snp_count, comparable_sites`` of every pair within a genotype.

    A site counts if both sequences have A, C, G or T there; a pair without such sites has distance 1. The first of a pair
    is the one earlier in the input. Sequences may be of any length and may differ in it; a null one has no sites, and with
    ``length`` sites beyond it do not count. Rows without a genotype have no pairs. Two blocks of rows are one task's work:
    their sites are counted as bits, a few rows at a time, which leave the task before the next are met, and pairs beyond
    ``at_most`` or ``most_snps`` never leave it.
    """
    ship_code(aligned.sparkSession)
    sites = F.col(seq) if length is None else F.substring(seq, 1, length)

    def measure(t: pa.Table) -> Iterator[pa.RecordBatch]:
        i, s, g = np.asarray(t["i"]), t["s"].combine_chunks(), t["g"][0]
        for x, y, both, snps in cell_strips(t):
            keep = both >= 0
            if at_most is not None:
                keep &= np.where(both > 0, snps / np.maximum(both, 1), 1.0) <= at_most
            if most_snps is not None:
                keep &= snps <= most_snps
            keep &= met(t, i, x, y)
            u, v = np.nonzero(keep)
            both, snps, first, second = both[u, v], snps[u, v], x[u], y[v]
            swap = i[first] > i[second]
            ends = [s.take(pa.array(np.where(swap, m, n))) for m, n in ((second, first), (first, second))]
            distance = np.where(both > 0, snps / np.maximum(both, 1), 1.0)
            yield pa.RecordBatch.from_arrays([pa.repeat(g, len(u)), *ends, *map(pa.array, (distance, snps, both))], names=[genotype, "source", "target", "distance", "snp_count", "comparable_sites"])

    return in_cells(aligned, genotype, idx, seq_id, sites, block_rows, measure, f"{genotype} string, source string, target string, distance double, snp_count int, comparable_sites int", True)


def cell_strips(t: pa.Table) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]]:
    """Rows of a cell's first block by rows of its second: places in the cell, comparable and differing sites."""
    p, r, b = (np.asarray(t[c]) for c in ("p", "r", "b"))
    one, two = np.flatnonzero(b == p[0]), np.flatnonzero(b == r[0])
    rows = [np.frombuffer(q, np.uint64).reshape(-1, 3)[:, [0, 0, 1, 2]] for q in t["whole"].to_pylist()]
    for x, y, both, snps in strips([rows[j] for j in one], [rows[j] for j in two]):
        yield one[x], two[y], both, snps


def met(t: pa.Table, i: np.ndarray, x: np.ndarray, y: np.ndarray) -> np.ndarray:
    """Which pairs of places are in question: in a block with itself each once."""
    return i[x][:, None] < i[y][None] if t["p"][0] == t["r"][0] else i[x][:, None] != i[y][None]


def snp_histogram(aligned: DataFrame, genotype: str = "genotype", idx: str = "record_idx", seq: str = "aligned", block_rows: int = BLOCK_ROWS) -> DataFrame:
    """``genotype, snp_count, n, lo, hi`` of all pairs of ``snp_pairs``: how many have a count, and the range of their sites.

    Pairs are counted in the task that compares them and never leave it.
    """
    ship_code(aligned.sparkSession)

    def measure(t: pa.Table) -> Iterator[pa.RecordBatch]:
        i = np.asarray(t["i"])
        most = 64 * max(len(x) // 24 for x in t["whole"].to_pylist()) + 1
        n, lo, hi = np.zeros(most, np.int64), np.full(most, np.iinfo(np.int32).max, np.int32), np.zeros(most, np.int32)
        for x, y, both, snps in cell_strips(t):
            keep = met(t, i, x, y)
            both, snps = both[keep], snps[keep]
            n += np.bincount(snps, minlength=most)
            np.minimum.at(lo, snps, both)
            np.maximum.at(hi, snps, both)
        at = np.flatnonzero(n)
        yield pa.RecordBatch.from_arrays([pa.repeat(t["g"][0], len(at)), *map(pa.array, (at.astype(np.int32), n[at], lo[at], hi[at]))], names=[genotype, "snp_count", "n", "lo", "hi"])

    return in_cells(aligned, genotype, idx, idx, F.col(seq), block_rows, measure, f"{genotype} string, snp_count int, n long, lo int, hi int", True)


def tn93_from_counts(n: np.ndarray) -> np.ndarray:
    """Tamura-Nei 1993 of ``(..., 4, 4)`` site counts in the order A, C, G, T.

    Base frequencies come from the pair. Without sites, or where a logarithm has no positive argument, the distance is 1;
    a term whose base frequencies are 0 drops out.
    """
    total = n.sum(axis=(-1, -2))
    some = np.where(total > 0, total, 1.0)
    freq = (n.sum(axis=-1) + n.sum(axis=-2)) / (2 * some[..., None])
    a, c, g, t = (freq[..., i] for i in range(4))
    r, y = a + g, c + t
    both = lambda i, j: (n[..., i, j] + n[..., j, i]) / some
    p1, p2 = both(0, 2), both(1, 3)
    q = both(0, 1) + both(0, 3) + both(2, 1) + both(2, 3)
    over = lambda x, d: np.divide(x, d, out=np.zeros_like(x), where=d > 0)
    ag, tc = over(a * g, r), over(t * c, y)
    k = np.stack([2 * ag, 2 * tc, 2 * (r * y - ag * y - tc * r)])
    x = np.stack([1 - over(p1, 2 * ag) - over(q, 2 * r), 1 - over(p2, 2 * tc) - over(q, 2 * y), 1 - over(q, 2 * r * y)])
    live = k != 0
    bad = (live & (x <= 0)).any(axis=0) | (total <= 0)
    d = -(k * np.log(np.where(live & (x > 0), x, 1.0))).sum(axis=0)
    return np.where(bad, 1.0, np.maximum(d, 0.0))


def tn93_pairs(aligned: DataFrame, mode: str = "average", at_most: float | None = None, genotype: str = "genotype", idx: str = "record_idx", seq_id: str = "seq_id", seq: str = "aligned", block_rows: int | None = None, least_overlap: int = 0, most_ambiguous: float | None = None) -> DataFrame:
    """``genotype, source, target, distance``: TN93 of every pair within a genotype, or of those up to ``at_most``.

    ``skip`` uses sites with two plain bases. The other modes share an ambiguous site out over the bases it may be:
    ``average`` over all pairs, ``resolve`` as a match where one is possible; ``gapmm`` also counts a gap against a base as
    an unknown base. Pairs that share fewer than ``least_overlap`` sites have no row. In ``resolve``, sequences with a larger
    share than ``most_ambiguous`` of ambiguous codes among their bases are averaged instead, since a long run of them would
    match anything. Two blocks of a genotype's rows are one task's work; their sites are counted by matrix products, one
    for each two codes that occur, and pairs beyond the threshold never leave the task. Sequences may differ in length.
    With ``at_most`` below 1 sites are first compared as bits: TN93 is never under the share of differing sites, so the 16
    counts are taken for the few pairs whose plain sites leave that share within the threshold.
    """
    if mode not in MODES:
        raise ValueError(f"mode is one of {MODES}")
    if least_overlap < 0 or (most_ambiguous is not None and not 0 <= most_ambiguous <= 1):
        raise ValueError("the least overlap is not negative, a share between 0 and 1")
    ship_code(aligned.sparkSession)
    codes, shares = site_shares(mode)
    averaged = site_shares("average")[1] if mode == "resolve" and most_ambiguous is not None else None

    def within(t: pa.Table) -> pa.Table:
        p, r, b = (np.asarray(t[c]) for c in ("p", "r", "b"))
        one, two = np.flatnonzero(b == p[0]), np.flatnonzero(b == r[0])
        maybe = np.zeros((len(one), len(two)), bool)
        rows = [np.column_stack([known, bits]) for bits, known in (known_sites(q, codes) for q in t["q"].to_pylist())]
        for u, v, sites, differing in strips([rows[j] for j in one], [rows[j] for j in two]):
            # sites of two different bases differ in every mode, and no mode counts more sites
            maybe[np.ix_(u, v)] = differing <= (at_most + 1e-9) * sites + 1e-6
        if p[0] == r[0]:
            maybe &= np.asarray(t["i"])[one][:, None] < np.asarray(t["i"])[two][None]
        x, y = np.nonzero(maybe)
        whole = {j: one_row_codes(t["q"][int(j)].as_py(), codes) for j in np.unique(np.concatenate([one[x], two[y]]))}
        joint = np.zeros((len(x), len(codes), len(codes)))
        for j, (u, v) in enumerate(zip(one[x], two[y], strict=True)):
            n = min(len(whole[u]), len(whole[v]))
            a, c = whole[u][:n], whole[v][:n]
            known = (a >= 0) & (c >= 0)
            joint[j] = np.bincount(a[known] * len(codes) + c[known], minlength=len(codes) ** 2).reshape(len(codes), len(codes))
        total = np.einsum("pxy,xyij->pij", joint, shares, optimize=True)
        if averaged is not None:
            many = {j: (c >= 4).sum() > most_ambiguous * (c >= 0).sum() for j, c in whole.items()}
            some = np.array([many[u] or many[v] for u, v in zip(one[x], two[y], strict=True)], bool)
            total = np.where(some[:, None, None], np.einsum("pxy,xyij->pij", joint, averaged, optimize=True), total)
        d, keep = np.ones(maybe.shape), np.zeros(maybe.shape, bool)
        d[x, y] = tn93_from_counts(total)
        keep[x, y] = (d[x, y] <= at_most) & (total.sum(axis=(1, 2)) >= least_overlap - 1e-6)
        return cell_pairs(t, genotype, keep, {"distance": d})

    def measure(t: pa.Table) -> pa.Table:
        p, r, b = (np.asarray(t[c]) for c in ("p", "r", "b"))
        left, right = b == p[0], b == r[0]
        total = np.zeros((left.sum(), right.sum(), 4, 4))
        instead = np.zeros_like(total) if averaged is not None else None
        bases, ambiguous = np.zeros(len(b)), np.zeros(len(b))
        row, col = np.cumsum(left) - 1, np.cumsum(right) - 1
        for rows, code in site_codes(t["q"].to_pylist(), codes):
            one, two = left[rows], right[rows]
            at = np.ix_(row[rows[one]], col[rows[two]])
            hot = {c: (code == c).astype(np.float32) for c in range(len(codes)) if (code == c).any()}
            bases[rows] += (code >= 0).sum(axis=1)
            ambiguous[rows] += (code >= 4).sum(axis=1)
            for x, y in ((x, y) for x in hot for y in hot if shares[x, y].any()):
                n = hot[x][one] @ hot[y][two].T
                for into, share in ((total, shares), (instead, averaged)):
                    for i, j in zip(*np.nonzero(share[x, y]), strict=True) if into is not None else ():
                        into[*at, i, j] += n * share[x, y, i, j]
        if instead is not None:
            many = ambiguous > most_ambiguous * bases
            total = np.where((many[left][:, None] | many[right][None])[..., None, None], instead, total)
        d = tn93_from_counts(total)
        keep = total.sum(axis=(2, 3)) >= least_overlap - 1e-6
        return cell_pairs(t, genotype, keep & (d <= at_most) if at_most is not None else keep, {"distance": d})

    every = at_most is None or at_most >= 1
    counted = measure if every else within
    return in_cells(aligned, genotype, idx, seq_id, F.col(seq), block_rows or (256 if every else BLOCK_ROWS), lambda t: iter(counted(t).to_batches()), f"{genotype} string, source string, target string, distance double")


def one_row_codes(seq: str | None, codes: str) -> np.ndarray:
    place = np.full(256, -1, np.int64)
    place[np.frombuffer(codes.encode(), np.uint8)] = np.arange(len(codes))
    return place[np.frombuffer((seq or "").encode("latin-1", "replace"), np.uint8)]


def site_shares(mode: str) -> tuple[str, np.ndarray]:
    """The codes, and for each two codes how their site is shared out over the 16 pairs of bases."""
    codes = "".join(IUPAC) + ("-" if mode == "gapmm" else "")
    held = {**{k: {"ACGT".index(b) for b in v} for k, v in IUPAC.items()}, "-": {0, 1, 2, 3}}
    out = np.zeros((len(codes), len(codes), 4, 4))
    for i, x in enumerate(codes):
        for j, y in enumerate(codes):
            if x == y == "-" or (mode == "skip" and len(held[x]) + len(held[y]) > 2):
                continue
            cells = [(a, b) for a in held[x] for b in held[y]]
            if mode == "resolve" and (len(held[x]) > 1 or len(held[y]) > 1) and held[x] & held[y]:
                cells = [(a, a) for a in held[x] & held[y]]
            for a, b in cells:
                out[i, j, a, b] += 1 / len(cells)
    return codes, out


def links_by_distance(pairs: DataFrame, threshold: float, include_self: bool = False) -> DataFrame:
    """Pairs with ``distance <= threshold``; self pairs only if asked for."""
    if threshold < 0:
        raise ValueError("the distance threshold must be non-negative")
    kept = pairs.filter(F.col("distance") <= threshold)
    return kept if include_self else kept.filter("source <> target")


def links_by_snps(pairs: DataFrame, most: int) -> DataFrame:
    """Pairs with at most ``most`` SNPs; replaces the distance threshold."""
    if most < 0:
        raise ValueError("the SNP count threshold must be non-negative")
    return pairs.filter((F.col("snp_count") <= most) & (F.col("source") != F.col("target")))


def snp_summary(pairs: DataFrame, group: list[str] | None = None) -> DataFrame:
    """Range and upper median of SNP counts, and the range of comparable sites. The median is selected, not interpolated."""
    return summary_of_counts(pairs.select(*(group or []), "snp_count", F.lit(1).cast("long").alias("n"), F.col("comparable_sites").alias("lo"), F.col("comparable_sites").alias("hi")), group)


def summary_of_counts(counts: DataFrame, group: list[str] | None = None) -> DataFrame:
    """``snp_summary`` of rows of ``snp_histogram``."""
    counts = counts.groupBy(*(group or []), "snp_count").agg(F.sum("n").alias("n"), F.min("lo").alias("lo"), F.max("hi").alias("hi"))
    each = F.sort_array(F.collect_list(F.struct("snp_count", "n")))
    rolled = counts.groupBy(*(group or [])).agg(F.sum("n").alias("pairs"), F.min("snp_count").alias("min_snps"), F.max("snp_count").alias("max_snps"), F.min("lo").alias("min_sites"), F.max("hi").alias("max_sites"), each.alias("_h"))
    # walk the histogram, one entry for each distinct count, to the element at n div 2
    walk = F.aggregate("_h", F.struct(F.lit(0).cast("long").alias("seen"), F.lit(None).cast("int").alias("at")), lambda acc, x: F.struct((acc["seen"] + x["n"]).alias("seen"), F.when(acc["at"].isNull() & (acc["seen"] + x["n"] > F.floor(F.col("pairs") / 2)), x["snp_count"]).otherwise(acc["at"]).alias("at")), lambda acc: acc["at"])
    return rolled.select(*(group or []), "pairs", "min_snps", "max_snps", walk.alias("median_snps"), "min_sites", "max_sites")


def merged_links(links: list[DataFrame]) -> DataFrame:
    """All links in one table; a count column stays only if every input has it."""
    if not links:
        raise ValueError("no links to merge")
    extra = [c for c in ("snp_count", "comparable_sites") if all(c in x.columns for x in links)]
    out = links[0].select("source", "target", "distance", *extra)
    for more in links[1:]:
        out = out.unionByName(more.select("source", "target", "distance", *extra))
    return out
