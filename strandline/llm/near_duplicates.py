"""MinHash near-duplicates by a signature-coordinate inverted join.

Documents with one set of shingles are one node. Each node is posted under (coordinate, value) for a prefix of its
signature, the m - t + 1 values that fewest nodes share: two signatures that agree in t of m places agree in one of
both prefixes, so the other coordinates need no postings. A posting carries two bits of every coordinate; pairs found in
a posting list are kept when these bits agree in as many coordinates as the match threshold, which whole signatures that
reach it always do, and then confirmed on the full shingle sets.

A posting list is never expanded into all its pairs. Lists of up to ``small`` nodes are; longer ones link every node to
the list's first node, are split by a second coordinate and handled in the same way. Most lists are then within one
component. For those that are not, a second pass compares each node outside the list's largest component with the
whole list, block by block in numpy, and skips a pair at every coordinate but the first at which it agrees. It does so
on signatures alone at first. The rows that have a candidate pair across components then get their texts, and their
pairs are confirmed or refuted on full sets in one task a cell, which emits only links that join components. The chance that a pair at
exactly the similarity threshold has fewer matches than the match threshold is about 2e-6 (41 of 64 at 0.85).

A shuffle costs a task for each partition however few its rows are, so steps share one where they can: a set's first
document brings its signature along, rare and split lists meet in one join, and a document's partners are gathered
where its pairs are made distinct.
"""

from __future__ import annotations

from collections import namedtuple
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from strandline.llm._tokens import chunks, grams, mix, randoms, run_hash, runs, words
from strandline.operators.graph import star_edges
from strandline.session import materialise, ship_code, table

COORDINATES = 64
SMALL = 16
HOME = 256
BLOCK = 1024
BLOCK_SHINGLES = 2_000_000
FILTER_BITS = 1 << 26
LAST = (1 << 63) - 1
SET = ["set_a", "set_b", "n_shingles"]
LIGHT = ["key", "tb", "qb", "asks", "answers", "node", "label", "before", "outside"]
Row = namedtuple("Row", [*LIGHT, "sig", "payload"], defaults=[None])


def match_threshold(percent: int) -> int:
    """Coordinates in which a pair of this similarity agrees, less 4.6 standard deviations."""
    p = percent / 100
    return max(1, int(COORDINATES * p - 4.6 * (COORDINATES * p * (1 - p)) ** 0.5))


def shingle_sets(column: pa.Array, k: int = 5) -> Iterator[np.ndarray]:
    """The sorted distinct k-word shingle hashes of every text; a shorter text is one shingle, an empty one has none."""
    for chunk in chunks(column):
        w = words(chunk)
        g = grams(w.hash, k)
        for a, b in zip(w.bounds[:-1], w.bounds[1:], strict=True):
            if b - a >= k:
                yield np.unique(g[a : b - k + 1])
            elif b > a:
                yield runs(run_hash(w.hash[a:b]), np.array([0]), np.array([b - a]))
            else:
                yield np.zeros(0, np.uint64)


def _signature(s: np.ndarray, mult: np.ndarray, add: np.ndarray) -> np.ndarray:
    out = np.full(len(mult), 0xFFFFFFFF, np.uint32)
    for i in range(0, len(s), 2048):
        out = np.minimum(out, ((s[i : i + 2048, None] * mult + add) >> np.uint64(32)).astype(np.uint32).min(axis=0))
    return out


def _sign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    mult, add = randoms(COORDINATES, 21) | np.uint64(1), randoms(COORDINATES, 22)
    for batch in batches:
        n, a, b, sig = [], [], [], []
        with np.errstate(over="ignore"):
            for s in shingle_sets(batch.column(1)):
                n.append(len(s))
                a.append(s.sum(dtype=np.uint64))
                b.append(np.bitwise_xor.reduce(mix(s)) if len(s) else np.uint64(0))
                sig.append(_signature(s, mult, add))
        every = np.array(sig, np.uint32).reshape(-1, COORDINATES)
        lists = pa.ListArray.from_arrays(pa.array(np.arange(len(n) + 1, dtype=np.int32) * COORDINATES), pa.array(every.ravel().view(np.int32)))
        bits = [np.packbits((every >> i & 1).astype(np.uint8), axis=1).view(np.int64).ravel() for i in (0, 1)]
        longs = [pa.array(np.array(x, np.uint64).view(np.int64)) for x in (a, b)]
        columns = [batch.column(0), pa.array(np.array(n, np.int64)), *longs, lists, *(pa.array(x) for x in bits)]
        yield pa.RecordBatch.from_arrays(columns, names=["doc_id", "n_shingles", "set_a", "set_b", "sig", "low", "high"])


def signatures(docs: DataFrame) -> DataFrame:
    """``doc_id, n_shingles, set_a, set_b, sig, low, high``.

    set_a and set_b are a 128-bit hash of the shingle set, low and high the last two bits of each value of the signature.
    """
    texts = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    return texts.mapInArrow(_sign, "doc_id long, n_shingles long, set_a long, set_b long, sig array<int>, low long, high long")


def _with_prefix(signed: DataFrame, length: int, small: int) -> DataFrame:
    """A row for each set of ``signed``, with its smallest doc_id as ``node``, and ``prefix``, the ``length`` rarest values
    of its signature, rarest first: ``n`` and coordinate ``at``.

    n is the number of documents that share the value, 0 if at most ``small`` do: these count as equally rare; ties go by
    coordinate. The order is the same for all nodes, so two that agree in enough coordinates agree in one of both prefixes.
    """
    tokens = signed.select(*SET, F.posexplode("sig").alias("at", "value")).select(*SET, "at", F.xxhash64("at", "value").alias("key"))
    common = materialise(tokens.groupBy("key").agg(F.count("*").alias("n")).filter(f"n > {small}"), "common")
    counts = tokens.join(common, "key").groupBy(SET).agg(F.map_from_entries(F.collect_set(F.struct("at", "n"))).alias("counts"))
    ranked = F.sort_array(F.transform(F.sequence(F.lit(0), F.lit(COORDINATES - 1)), lambda i: F.struct(F.coalesce(F.try_element_at("counts", i), F.lit(0).cast("long")).alias("n"), i.alias("at"))))
    first = [F.first(c).alias(c) for c in ("sig", "low", "high")]  # equal sets have equal signatures
    nodes = signed.groupBy(SET).agg(F.min("doc_id").alias("node"), *first)
    return nodes.join(counts, SET, "left").select(*nodes.columns, F.slice(ranked, 1, length).alias("prefix"))


def _partners(posts: DataFrame, small: int, least: int) -> DataFrame:
    """``v, c, us``: the partners before each node in the posting lists ``(key, next, common, node, low, high)``, and the first.

    All pairs of a list of up to ``small`` nodes, a star of a longer one. Only a value that is ``common`` can have a long
    list; its posts are also split by the value ``next``. A node has as many partners as its lists are short and long,
    however long they are. Pairs whose bits agree in fewer than ``least`` coordinates are none.
    """
    own = ["key", "node", "low", "high"]
    many = posts.filter("common").withColumn("key", F.explode(F.array("key", F.xxhash64("key", "next")))).select(own)
    lists = many.groupBy("key").agg(F.count("*").alias("n"), F.min("node").alias("centre")).filter("n > 1")
    lists = materialise(lists, "lists")  # read from files, it is broadcast or lets Spark split a long list's posts in the join
    # a node leads the later ones of its list from its own id on; in a long list only the first does
    lead = F.when((F.col("n") <= small) | (F.col("node") == F.col("centre")), F.col("node")).otherwise(LAST)
    every = posts.filter("not common").select(*own, F.col("node").alias("lead")).unionByName(many.join(lists, "key").select(*own, lead.alias("lead")))
    every = every.filter("node is not null and lead is not null and key is not null")  # both sides of the join are one shuffle then
    pairs = every.alias("a").join(every.alias("b"), F.expr(f"a.key = b.key and a.lead < b.node and bit_count((a.low ^ b.low) | (a.high ^ b.high)) <= {COORDINATES - least}"))
    pairs = pairs.select(F.col("a.lead").alias("u"), F.col("b.node").alias("v"))
    return pairs.groupBy("v").agg(F.min("u").alias("c"), F.collect_set("u").alias("us"))


def _confirmed(partners: DataFrame, texts: DataFrame, percent: int, home: int = HOME) -> DataFrame:
    """The pairs ``(u, v)`` of ``partners`` whose shingle sets overlap enough; ``partners`` is a written table.

    They are dealt out by the first partner of v, in portions of about ``home`` ends, so that a text travels once for
    each portion and not once for each pair, and a centre with any number of partners is spread over many tasks. Only
    centres of more than one portion have a number of portions, fewer than one in ``home`` documents.
    """
    load = partners.groupBy("c").agg(F.ceil(F.count("*") / home).alias("portions")).filter("portions > 1")
    dealt = partners.join(F.broadcast(load), "c", "left").withColumn("salt", F.pmod(F.xxhash64("v"), F.coalesce("portions", F.lit(1))))
    end = lambda doc, us: F.struct(doc.alias("doc"), us.alias("us"))
    given = F.transform("us", lambda u: end(u, F.array().cast("array<long>")))
    ends = dealt.select("c", "salt", F.inline(F.concat(F.array(end(F.col("v"), F.col("us"))), given)))
    ends = ends.groupBy("c", "salt", "doc").agg(F.flatten(F.collect_list("us")).alias("us"))
    ends = materialise(ends, "ends")  # its size is known then, so few ends do not make all texts move
    rows = ends.join(_sifted(texts, ends.select(F.col("doc").alias("node"))).withColumnRenamed("node", "doc"), "doc").select("c", "salt", "doc", "us", "payload")

    def linked(held: dict[int, list], wanted: dict[int, list[int]]) -> pa.RecordBatch:
        def sets(x: int) -> list[np.ndarray]:
            if x in held and isinstance(held[x][0], pa.Scalar):  # several where rows repeat a doc_id
                held[x] = list(shingle_sets(pa.array([t.as_py() for t in held[x]], pa.large_string())))
            return held.get(x, [])

        found = [(u, v) for v, us in wanted.items() for u in us if any(_overlap(a, b, percent) for a in sets(u) for b in sets(v))]
        return pa.RecordBatch.from_arrays([pa.array([x[i] for x in found], pa.int64()) for i in (0, 1)], names=["u", "v"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        cell, held, wanted = None, {}, {}
        for batch in batches:
            for c, salt, doc, us, payload in zip(*(x.to_pylist() if i < 4 else x for i, x in enumerate(batch.columns)), strict=True):
                if (c, salt) != cell:
                    if wanted:
                        yield linked(held, wanted)
                    cell, held, wanted = (c, salt), {}, {}
                held.setdefault(doc, []).append(payload)
                if us:
                    wanted[doc] = us
        if wanted:
            yield linked(held, wanted)

    return rows.repartition("c", "salt").sortWithinPartitions("c", "salt").mapInArrow(run, "u long, v long")


def _overlap(a: np.ndarray, b: np.ndarray, percent: int) -> bool:
    if 100 * min(len(a), len(b)) < percent * max(len(a), len(b)):
        return False
    both = len(np.intersect1d(a, b, assume_unique=True))
    return both > 0 and 100 * both >= percent * (len(a) + len(b) - both)


def _sifted(items: DataFrame, wanted: DataFrame) -> DataFrame:
    """``items`` without most of the rows whose node is not in ``wanted``, so that their payloads need not move.

    A bit map of hashed nodes is broadcast. It has at most ``FILTER_BITS / 64`` rows however many nodes are wanted; when it
    fills up it lets more through, and the exact join that follows removes the rest.
    """
    spot, bit = F.pmod(F.xxhash64("node"), F.lit(FILTER_BITS)), "cast(spot % 64 as int)"
    bits = wanted.select(spot.alias("spot")).groupBy(F.expr("spot div 64").alias("word")).agg(F.bit_or(F.expr(f"shiftleft(1L, {bit})")).alias("bits"))
    marked = items.withColumn("spot", spot).withColumn("word", F.expr("spot div 64")).join(F.broadcast(bits), "word")
    return marked.filter(f"shiftright(bits, {bit}) & 1 = 1").select(items.columns)


def _hits(q: list[tuple], t: list[tuple], part_q: np.ndarray, part_t: np.ndarray, least: int) -> Iterator[tuple[int, np.ndarray]]:
    """For each row of ``q``, the rows of ``t`` in another part that reach the match threshold and agree here first.

    The parts are read as each query is reached, so a caller may join them on the way.
    """
    sig_t, node_t, outside = np.stack([r.sig for r in t]), np.array([r.node for r in t]), np.array([r.outside for r in t])
    for i, row in enumerate(q):
        some = np.flatnonzero((part_t != part_q[i]) & ~(outside & (node_t < row.node)))
        same = sig_t[some] == row.sig
        earlier = np.flatnonzero((np.int64(row.before) >> np.arange(COORDINATES)) & 1)
        some = some[(same.sum(axis=1) >= least) & ~same[:, earlier].any(axis=1)]
        if len(some):
            yield i, some


def _cells(judge: Callable[[list[Row], list[Row]], pa.RecordBatch], heavy: list[str]) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """Hands the queries and the targets of each cell of sorted rows to ``judge``; cells without either are left out."""

    def close(held: list[Row]) -> Iterator[pa.RecordBatch]:
        q, t = [r for r in held if r.asks], [r for r in held if r.answers]
        if q and t:
            yield judge(q, t)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        cell, held = None, []
        for batch in batches:
            cols = [batch.column(c).to_pylist() for c in LIGHT]
            sigs, rest = batch.column("sig"), [batch.column(c) for c in heavy]
            for i, light in enumerate(zip(*cols, strict=True)):
                if light[:3] != cell:
                    yield from close(held)
                    cell, held = light[:3], []
                held.append(Row(*light, sigs[i].values.to_numpy(), *(c[i] for c in rest)))
        yield from close(held)

    return run


def _meeting(least: int) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """The rows of each cell that have a candidate in it, by signatures alone; a cell emits no more rows than it has."""

    def judge(q: list[Row], t: list[Row]) -> pa.RecordBatch:
        part_q, part_t = np.array([r.label for r in q]), np.array([r.label for r in t])
        found: dict[int, Row] = {}
        for i, some in _hits(q, t, part_q, part_t, least):
            found[id(q[i])] = q[i]
            found.update((id(t[j]), t[j]) for j in some)
        kinds = [pa.int64(), pa.int64(), pa.int64(), pa.bool_(), pa.bool_(), pa.int64(), pa.int64(), pa.int64(), pa.bool_()]
        return pa.RecordBatch.from_arrays([pa.array([getattr(r, c) for r in found.values()], k) for c, k in zip(LIGHT, kinds, strict=True)], names=LIGHT)

    return _cells(judge, [])


def _across(least: int, percent: int) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """Links that join different labels within one cell: a block of a list against a block of its queries.

    Candidates agree at this list's coordinate first and reach the match threshold; they are confirmed or refuted here, on
    full sets. A link is given as its two labels. One between labels that the cell has joined already adds nothing, so a
    cell emits fewer links than it has labels, however many pairs it compares.
    """

    def judge(q: list[Row], t: list[Row]) -> pa.RecordBatch:
        part_q, part_t = np.array([r.label for r in q]), np.array([r.label for r in t])
        sets: dict[int, np.ndarray] = {}
        us, vs = [], []

        def shingles(r: Row) -> np.ndarray:
            if id(r) not in sets:  # not by node: rows that repeat a doc_id may differ in text
                sets[id(r)] = next(shingle_sets(pa.array([r.payload.as_py()], pa.large_string())))
            return sets[id(r)]

        for i, some in _hits(q, t, part_q, part_t, least):
            row = q[i]
            some = some[[len(shingles(t[j])) > 0 for j in some]]
            own, others = shingles(row), [shingles(t[j]) for j in some]
            if not len(own) or not others:
                continue
            sizes = np.array([len(o) for o in others])
            flat = np.concatenate(others)
            place = np.minimum(np.searchsorted(own, flat), len(own) - 1)
            both = np.add.reduceat((own[place] == flat).astype(np.int64), np.r_[0, np.cumsum(sizes)[:-1]])
            for j in some[100 * both >= percent * (len(own) + sizes - both)]:
                mine, other = part_q[i], part_t[j]
                if mine != other:
                    us.append(row.label)
                    vs.append(t[j].label)
                    part_t[part_t == other] = mine
                    part_q[part_q == other] = mine
        return pa.RecordBatch.from_arrays([pa.array(us, pa.int64()), pa.array(vs, pa.int64())], names=["u", "v"])

    return _cells(judge, ["payload"])


def _open_cells(labelled: DataFrame, small: int) -> DataFrame | None:
    """The cells of the lists of over ``small`` nodes with several labels, or None if no list has: the columns ``LIGHT``.

    A list's members answer, and those outside its largest label ask; both are dealt into blocks of about ``BLOCK`` rows
    and ``BLOCK_SHINGLES`` shingles, so a task holds two blocks whatever the list's length. In a list of one block a
    member that asks and answers is one row.
    """
    by_label = labelled.groupBy("key", "label").agg(F.count("*").alias("share"), F.sum("size").alias("weight"))
    shares = by_label.groupBy("key").agg(F.max(F.struct("share", "label", "weight")).alias("top"), F.count("*").alias("labels"), F.sum("share").alias("n"), F.sum("weight").alias("w"))
    blocks = lambda n, w: F.greatest(F.ceil(n / BLOCK), F.ceil(w / BLOCK_SHINGLES), F.lit(1)).cast("long")
    several = shares.filter(f"labels > 1 and n > {small}").select("key", F.col("top.label").alias("main"), blocks(F.col("n"), F.col("w")).alias("n_t"), blocks(F.col("n") - F.col("top.share"), F.col("w") - F.col("top.weight")).alias("n_q"))
    several = materialise(several, "open")
    if not several.limit(1).count():
        return None
    rows = labelled.join(several, "key").withColumn("outside", F.col("label") != F.col("main"))
    zero, whole = F.lit(0).cast("long"), F.col("n_t") == 1
    every = lambda n: F.sequence(zero, F.col(n) - 1)
    own = lambda n: F.array(F.pmod(F.xxhash64("node"), F.col(n)))
    role = lambda tb, qb, asks, answers: F.struct(tb.alias("tb"), qb.alias("qb"), asks.alias("asks"), F.lit(answers).alias("answers"))
    target = role(own("n_t"), every("n_q"), whole & F.col("outside"), True)
    query = role(every("n_t"), own("n_q"), F.lit(True), False)
    roles = F.when(F.col("outside") & ~whole, F.array(target, query)).otherwise(F.array(target))
    rows = rows.withColumn("role", F.explode(roles)).withColumn("tb", F.explode("role.tb")).withColumn("qb", F.explode("role.qb"))
    return rows.select("key", "tb", "qb", "role.asks", "role.answers", "node", "label", "before", "outside")


def _in_cells(cells: DataFrame, load: DataFrame) -> DataFrame:
    return cells.join(load, "node").select(*LIGHT, *[c for c in load.columns if c != "node"]).repartition("key", "tb", "qb").sortWithinPartitions("key", "tb", "qb")


def _joining(labelled: DataFrame, nodes: DataFrame, texts: DataFrame, small: int, least: int, percent: int) -> DataFrame | None:
    """Links ``(u, v)`` between the labels of the long lists with several, or None if there is no such list.

    Signatures alone go to the cells first; texts follow only for the rows that have a candidate in their cell.
    """
    cells, sig = _open_cells(labelled, small), nodes.select("node", "sig")
    if cells is None:
        return None
    kinds = "key long, tb long, qb long, asks boolean, answers boolean, node long, label long, before long, outside boolean"
    met = materialise(_in_cells(cells, sig).mapInArrow(_meeting(least), kinds), "met")
    load = _sifted(sig, met).join(_sifted(texts, met), "node")
    return _in_cells(met, load).mapInArrow(_across(least, percent), "u long, v long")


def near_duplicates(docs: DataFrame, percent: int = 85, small: int = SMALL) -> DataFrame:
    """``doc_id, n_shingles, component_id, kept``: one row per row of ``docs``.

    Links documents whose shingle sets have ``100 * intersection >= percent * union``; ``component_id`` is the smallest
    doc_id reachable by links, ``kept`` marks it. A null text is empty; a text without words has no shingles and no
    link; one with fewer than five words is a single shingle. Rows that repeat a doc_id are one document: both are
    returned, and each text's links hold for it. A row without doc_id is in no component and is kept. Ties go to the
    smallest doc_id. Other columns are ignored.
    """
    ship_code(docs.sparkSession)
    least = match_threshold(percent)
    signed = materialise(signatures(docs), "signatures")
    nodes = materialise(_with_prefix(signed.filter("n_shingles > 0 and doc_id is not null"), COORDINATES - least + 1, small), "nodes")
    posts = nodes.select("node", F.col("n_shingles").alias("size"), "sig", "low", "high", "prefix", F.posexplode("prefix").alias("pos", "at")).withColumn("common", F.col("at.n") > 0).withColumn("at", F.col("at.at"))
    value = lambda at: F.element_at("sig", at.cast("int") + 1)
    before = F.expr("aggregate(slice(prefix, 1, pos), 0L, (m, x) -> m | shiftleft(1L, x.at))")
    posts = posts.select("node", "size", "low", "high", "common", before.alias("before"), F.xxhash64("at", value(F.col("at"))).alias("key"), value(F.pmod(F.col("at") + 37, F.lit(COORDINATES))).alias("next"))
    texts = docs.select(F.col("doc_id").cast("long").alias("node"), F.coalesce(F.col("text").cast("string"), F.lit("")).alias("payload"))
    partners = materialise(_partners(posts, small, least), "partners")
    labels = _labels(_confirmed(partners, texts, percent))
    labelled = posts.filter("common").join(labels, "node", "left").select("key", "before", "node", "size", F.coalesce("label", "node").alias("label"))
    more = _joining(labelled, nodes, texts, small, least, percent)
    of_set = nodes.join(labels, "node", "left").select(*SET, F.coalesce("label", "node").alias("label"))
    if more is not None:
        above = _labels(more).select(F.col("node").alias("label"), F.col("label").alias("top"))
        of_set = of_set.join(above, "label", "left").select(*SET, F.coalesce("top", "label").alias("label"))
    out = signed.join(of_set, SET, "left")
    return out.select("doc_id", "n_shingles", F.coalesce("label", "doc_id").alias("component_id"), F.coalesce(F.col("doc_id") == F.coalesce("label", "doc_id"), F.lit(True)).alias("kept"))


def _labels(links: DataFrame) -> DataFrame:
    """``node, label`` of the nodes that can reach a smaller one."""
    return star_edges(links, "u", "v").select(F.col("u").alias("node"), F.col("v").alias("label"))


def deduplicate(docs: DataFrame, percent: int = 80) -> DataFrame:
    """``docs`` with one document, the smallest doc_id, of every group of near-duplicates; the columns stay as they are.

    Empty texts and rows without doc_id stay. Exact repeats of a whole row stay too, where they carry the kept doc_id.
    """
    gone = near_duplicates(docs, percent).filter("not kept").select("doc_id")
    return docs.join(gone, "doc_id", "left_anti").select([F.col(f"`{c}`") for c in docs.columns])


def op8_near_duplicates(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_duplicates(table(spark, sf_dir, "documents"))


SQL = r"""
WITH RECURSIVE words AS (
  SELECT doc_id, list_filter(string_split_regex(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[\x20\x09-\x0D]+'), lambda x: x <> '') AS w
  FROM documents),
shingled AS (
  SELECT doc_id, list_distinct(CASE WHEN len(w) = 0 THEN [] WHEN len(w) < 5 THEN [array_to_string(w, ' ')]
    ELSE list_transform(range(1, len(w) - 3), lambda i: array_to_string(w[i:i + 4], ' ')) END) AS s
  FROM words),
nodes AS (
  SELECT doc_id, len(s) AS n, md5(array_to_string(list_sort(s), chr(10))) AS set_key, s FROM shingled),
copies AS (SELECT set_key, min(doc_id) AS node, any_value(n) AS n FROM nodes WHERE n > 0 GROUP BY set_key),
post AS (SELECT c.node, c.n, unnest(d.s) AS g FROM copies c JOIN nodes d ON d.doc_id = c.node),
pairs AS (
  SELECT a.node AS u, b.node AS v FROM post a JOIN post b ON a.g = b.g AND a.node < b.node
  GROUP BY a.node, b.node, a.n, b.n HAVING 100 * count(*) >= 85 * (a.n + b.n - count(*))),
links AS (SELECT u, v FROM pairs UNION ALL SELECT v, u FROM pairs),
reach(node, other) AS (
  SELECT node, node FROM copies UNION SELECT r.node, l.v FROM reach r JOIN links l ON r.other = l.u),
labels AS (SELECT node, min(other) AS label FROM reach GROUP BY node)
SELECT d.doc_id, CAST(d.n AS BIGINT) AS n_shingles, coalesce(l.label, d.doc_id) AS component_id,
  d.doc_id = coalesce(l.label, d.doc_id) AS kept
FROM nodes d LEFT JOIN copies c ON d.n > 0 AND c.set_key = d.set_key LEFT JOIN labels l ON l.node = c.node
"""
