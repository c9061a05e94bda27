"""Benchmark decontamination by latent semantic retrieval.

Documents are read in blocks of ``BLOCK`` words; a passage is four or two consecutive blocks, so passages overlap and every
word of a whole text is in some. An item of more words than a passage is searched as overlapping parts. Passages are TF-IDF vectors over the benchmark's words, with document frequencies counted
over all documents, projected to the leading right singular vectors of a randomised SVD whose matrix products run in
Spark tasks. Passages near an item by cosine are candidates; the longest common subsequence of words with the item and
the item's answer words decide.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from functools import reduce

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from strandline.llm._tokens import chunks, words
from strandline.session import ship_code, table

BLOCK = 16
SPANS = (4, 2)
RANK = 128
OVERSAMPLE = 16
FEATURES = 1 << 15
#: A task holds one block of the benchmark, of about so many items and characters; a larger benchmark is searched block by block.
BLOCK_ITEMS = 20_000
BLOCK_CHARACTERS = 16_000_000
#: Cosines of so many pairs of passages and item parts are held at a time.
COSINES = 1 << 24
#: Words in more than this share of documents carry no weight, unless an item needs them: its rarest words are taken
#: until they hold ``LEAST_SHARE`` of the weight of all its words. No word of an item weighs less than ``LEAST_WEIGHT``.
COMMON = 0.01
LEAST_SHARE = 0.5
LEAST_WEIGHT = 2.0
LEAST_COSINE = 0.4
LEAST_LCS = 0.6
LEAST_ANSWER = 0.6
#: Without an ``answer`` column a weaker subsequence counts too if the item has so many words and so large a share of its
#: rarest ones is there.
WEAK_LCS, WEAK_WORDS, WEAK_ANSWER = 0.5, 10, 0.8
ANSWER_WORDS = 5
#: A passage with less than this part of an item's weight, or of its part's, is no candidate for it.
LEAST_MASS = 0.4
#: Items longer than a passage are cut into parts of so many words, each starting half a part after the last; a part lies
#: whole in some passage wherever it begins.
PART = (SPANS[0] - 1) * BLOCK
_FLAGS = 1 << 20


@dataclass
class Items:
    """The benchmark: word hashes of each item, the sorted vocabulary and its weights."""

    ids: list
    words: list[np.ndarray]
    answers: list[np.ndarray | None]
    vocabulary: np.ndarray
    idf: np.ndarray | None = None
    df: np.ndarray | None = None

    def parts(self) -> tuple[np.ndarray, list[np.ndarray]]:
        """The item of each part, and the parts' words; an item that fits a passage is its only part."""
        owner, out = [], []
        for i, w in enumerate(self.words):
            starts = [0] if len(w) <= SPANS[0] * BLOCK else [*range(0, len(w) - PART, PART // 2), len(w) - PART]
            owner += [i] * len(starts)
            out += [w[a : a + PART] for a in starts] if len(starts) > 1 else [w]
        return np.array(owner, np.int64), out

    def flags(self) -> np.ndarray:
        out = np.zeros(_FLAGS, bool)
        out[(self.vocabulary % np.uint64(_FLAGS)).astype(np.int64)] = True
        return out

    def find(self, hashes: np.ndarray, flags: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Positions of vocabulary words among ``hashes``, and which words they are."""
        pos = np.flatnonzero(flags[(hashes & np.uint64(_FLAGS - 1)).astype(np.int64)])
        at = np.minimum(np.searchsorted(self.vocabulary, hashes[pos]), len(self.vocabulary) - 1)
        ok = self.vocabulary[at] == hashes[pos]
        return pos[ok], at[ok]


def _hashes(texts: pa.Array) -> list[np.ndarray]:
    out = []
    for chunk in chunks(pc.utf8_lower(texts)):
        w = words(chunk, "alnum")
        out += [w.hash[a:b] for a, b in zip(w.bounds[:-1], w.bounds[1:], strict=True)]
    return out


def item_blocks(benchmark: DataFrame) -> list[DataFrame]:
    """The benchmark dealt by a hash of item_id and text into blocks that a task can hold; one block if it is small."""
    size = benchmark.agg(F.count("*"), F.sum(F.length(F.col("text").cast("string")))).first()
    n = max(1, -(-size[0] // BLOCK_ITEMS), -(-(size[1] or 0) // BLOCK_CHARACTERS))
    at = F.pmod(F.xxhash64("item_id", "text"), F.lit(n))
    return [benchmark.filter(at == i) for i in range(n)] if n > 1 else [benchmark]


def read_items(benchmark: DataFrame) -> Items:
    """The items with at least one word; an ``answer`` column is used where there is one."""
    columns = ["item_id", "text", *(["answer"] if "answer" in benchmark.columns else [])]
    got = benchmark.select(*columns).toArrow().combine_chunks().sort_by([("item_id", "ascending"), ("text", "ascending")])
    text = lambda c: pa.concat_arrays(got[c].chunks).cast(pa.string()) if len(got) else pa.array([], pa.string())
    found = _hashes(text("text"))
    answers = _hashes(text("answer")) if "answer" in columns else [None] * len(found)
    keep = [i for i, w in enumerate(found) if len(w)]
    ids = got["item_id"].to_pylist()
    vocabulary = np.unique(np.concatenate([found[i] for i in keep])) if keep else np.zeros(0, np.uint64)
    return Items([ids[i] for i in keep], [found[i] for i in keep], [answers[i] if answers[i] is not None and len(answers[i]) else None for i in keep], vocabulary)


def _texts(docs: DataFrame) -> DataFrame:
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))


def document_frequencies(docs: DataFrame, items: Items) -> tuple[int, np.ndarray]:
    """How many documents there are, and how many contain each vocabulary word; over all documents."""
    shared = docs.sparkSession.sparkContext.broadcast(items)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = shared.value
        flags, n, count = held.flags(), 0, np.zeros(len(held.vocabulary), np.int64)
        for batch in batches:
            n += batch.num_rows
            for chunk in chunks(pc.utf8_lower(batch.column(1))):
                w = words(chunk, "alnum")
                pos, at = held.find(w.hash, flags)
                row = np.searchsorted(w.bounds, pos, "right") - 1
                one = np.unique(row * len(count) + at) % max(len(count), 1)
                count += np.bincount(one, minlength=len(count))
        some = np.flatnonzero(count)
        yield pa.RecordBatch.from_arrays([pa.array(np.r_[-1, some]), pa.array(np.r_[n, count[some]])], names=["word", "n"])

    rows = _texts(docs).mapInArrow(run, "word long, n long").groupBy("word").agg(F.sum("n").alias("n")).collect()
    out, n = np.zeros(len(items.vocabulary), np.int64), 0
    for word, k in rows:
        if word < 0:
            n = k
        else:
            out[word] = k
    return n, out


def _weights(n: int, items: Items) -> np.ndarray:
    """The weight of each vocabulary word; every part of an item keeps weighted words, however many documents it has leaked into."""
    idf = np.maximum(np.log((n + 1) / (items.df + 1)), LEAST_WEIGHT).astype(np.float32)
    rare = items.df <= max(COMMON * n, 1)
    held = rare.copy()
    for w in items.parts()[1]:
        at = np.searchsorted(items.vocabulary, w)
        lost = at[~rare[at]]
        need = LEAST_SHARE * idf[at].sum() - idf[at[rare[at]]].sum()
        if need > 0:
            lost = lost[np.argsort(items.df[lost], kind="stable")]
            held[lost[: np.searchsorted(np.cumsum(idf[lost]), need) + 1]] = True
    return np.where(held, idf, np.float32(0))


class _Passages:
    """Blocks of a chunk's documents; each document is followed by empty blocks so that no passage spans two."""

    def __init__(self, w, items: Items, flags: np.ndarray):
        pos, at = items.find(w.hash, flags)
        heavy = items.idf[at] > 0
        pos, at = pos[heavy], at[heavy]
        n = np.diff(w.bounds)
        size = -(-n // BLOCK) + SPANS[0] - 1
        self.first = np.r_[0, np.cumsum(size)]
        row = np.searchsorted(w.bounds, pos, "right") - 1
        self.block = self.first[row] + (pos - w.bounds[row]) // BLOCK
        self.word, self.weight = at, items.idf[at]

    def mass(self, span: int) -> np.ndarray:
        """The weight in the passage of ``span`` blocks that starts at each block."""
        total = np.r_[0, np.cumsum(np.bincount(self.block, self.weight, minlength=self.first[-1]))]
        return total[np.minimum(np.arange(self.first[-1]) + span, self.first[-1])] - total[:-1]

    def vectors(self, start: np.ndarray, span: int, basis: np.ndarray) -> np.ndarray:
        """Latent vectors of the passages that start at blocks ``start``."""
        needed = np.unique((start[:, None] + np.arange(span)).ravel())
        needed = needed[needed < self.first[-1]]
        slot = np.full(self.first[-1] + span, len(needed))
        slot[needed] = np.arange(len(needed))
        mine = slot[self.block] < len(needed)
        part = np.zeros((len(needed) + 1, basis.shape[1]), np.float32)
        own = slot[self.block[mine]]
        if len(own):
            head = np.flatnonzero(np.r_[True, own[1:] != own[:-1]])
            part[own[head]] = np.add.reduceat(self.weight[mine, None] * basis[self.word[mine] % len(basis)], head, axis=0)
        return part[slot[start[:, None] + np.arange(span)]].sum(axis=1)


def _masses(items: Items) -> np.ndarray:
    """The weight that a passage needs to be a candidate for each part of an item."""
    return LEAST_MASS * np.array([float(items.idf[np.searchsorted(items.vocabulary, w)].sum()) for w in items.parts()[1]])


def _item_rows(items: Items) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    at = [np.searchsorted(items.vocabulary, w) for w in items.parts()[1]]
    row = np.repeat(np.arange(len(at)), [len(a) for a in at])
    word = np.concatenate(at) if at else np.zeros(0, np.int64)
    return row, word, items.idf[word]


def _apply(row: np.ndarray, word: np.ndarray, weight: np.ndarray, n: int, basis: np.ndarray) -> np.ndarray:
    out = np.zeros((n, basis.shape[1]))
    np.add.at(out, row, weight[:, None] * basis[word % len(basis)])
    return out


def latent_basis(docs: DataFrame, items: Items, rank: int = RANK) -> np.ndarray:
    """``features x rank``: leading right singular vectors of the TF-IDF passages of the items and of all ``docs``.

    Randomised SVD in two distributed products: A'(A G) for a random G gives the range, and (A Q)'(A Q) its rotation.
    Each task returns sums by feature, which are added in Spark; the driver holds ``features x (rank + 16)`` numbers,
    whatever the corpus.
    """
    size = min(FEATURES, max(1, len(items.vocabulary)))
    width = min(size, rank + OVERSAMPLE)
    context = docs.sparkSession.sparkContext
    texts = _texts(docs)
    shared = context.broadcast(items)

    def products(basis: np.ndarray, gram: bool) -> np.ndarray:
        sent = context.broadcast(basis)

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            held, g = shared.value, sent.value
            flags, floor = held.flags(), _masses(held).min()
            out = np.zeros((g.shape[1] if gram else len(g), g.shape[1]))
            for batch in batches:
                for chunk in chunks(pc.utf8_lower(batch.column(1))):
                    p = _Passages(words(chunk, "alnum"), held, flags)
                    if not p.first[-1]:
                        continue
                    start = np.flatnonzero(p.mass(SPANS[0]) >= floor)
                    for i in range(0, len(start), 8192):
                        some = start[i : i + 8192]
                        y = p.vectors(some, SPANS[0], g)
                        if gram:
                            out += y.T @ y
                            continue
                        for shift in range(SPANS[0]):
                            of = np.searchsorted(some + shift, p.block)
                            of = np.minimum(of, len(some) - 1)
                            hit = some[of] + shift == p.block
                            np.add.at(out, p.word[hit] % len(g), p.weight[hit, None] * y[of[hit]])
            some = np.flatnonzero(np.abs(out).sum(axis=1))
            yield pa.RecordBatch.from_arrays([pa.array(some), pa.array([x.tobytes() for x in out[some]], pa.binary())], names=["feature", "sums"])

        def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            held: dict[int, np.ndarray] = {}
            for batch in batches:
                for feature, sums in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                    held[feature] = held.get(feature, 0) + np.frombuffer(sums)
            yield pa.RecordBatch.from_arrays([pa.array(list(held), pa.int64()), pa.array([x.tobytes() for x in held.values()], pa.binary())], names=["feature", "sums"])

        row, word, weight = _item_rows(items)
        y = _apply(row, word, weight, len(items.parts()[1]), basis)
        out = y.T @ y if gram else np.zeros((len(basis), basis.shape[1]))
        if not gram:
            np.add.at(out, word % len(basis), weight[:, None] * y[row])
        parts = texts.mapInArrow(run, "feature long, sums binary").repartition(8, "feature").mapInArrow(add, "feature long, sums binary")
        for feature, sums in parts.collect():
            out[feature] += np.frombuffer(bytes(sums))
        return out

    start = np.random.default_rng(3).standard_normal((size, width)).astype(np.float32)
    q = np.linalg.qr(products(start, gram=False))[0].astype(np.float32)
    values, turn = np.linalg.eigh(products(q, gram=True))
    return (q @ turn[:, np.argsort(-values)[: min(rank, width)]]).astype(np.float32)


def _masks(w: np.ndarray) -> dict[int, int]:
    out: dict[int, int] = {}
    for i, x in enumerate(w.tolist()):
        out[x] = out.get(x, 0) | 1 << i
    return out


def common_subsequence(masks: dict[int, int], n: int, other: list[int]) -> int:
    """Length of the longest common subsequence, bit-parallel over the n words behind ``masks``."""
    full = (1 << n) - 1
    s = full
    for x in other:
        u = s & masks.get(x, 0)
        if u:
            s = ((s + u) | (s - u)) & full
    return n - s.bit_count()


class _Search:
    """Finds the items in the texts of Arrow columns; made once for each task."""

    def __init__(self, items: Items, basis: np.ndarray, least_cosine: float, least_lcs: float, least_answer: float):
        self.items, self.basis = items, basis
        self.cosine, self.lcs, self.answer = least_cosine, least_lcs, least_answer
        self.flags, self.masses, self.owner = items.flags(), _masses(items), items.parts()[0]
        latent = _apply(*_item_rows(items), len(self.owner), basis).astype(np.float32)
        self.latent = latent / np.maximum(np.linalg.norm(latent, axis=1, keepdims=True), 1e-9)
        self.masks: dict[int, dict[int, int]] = {}
        self.answers: dict[int, np.ndarray] = {}

    def _ready(self, item: int) -> None:
        own, given = self.items.words[item], self.items.answers[item]
        if given is None:
            given = np.unique(own)
            df = self.items.df[np.searchsorted(self.items.vocabulary, given)]
            given, df = given[df > 0], df[df > 0]
            given = given[np.argsort(df, kind="stable")[:ANSWER_WORDS]]
        self.masks[item], self.answers[item] = _masks(own), given

    def _near(self, p: _Passages) -> dict[tuple[int, int], list]:
        """Candidate passages ``(-cosine, first word, words)`` of each (row, item)."""
        near: dict[tuple[int, int], list] = {}
        for span in SPANS:
            mass = p.mass(span)
            start = np.flatnonzero(mass >= self.masses.min())
            step = max(1, min(1024, COSINES // len(self.owner)))
            for i in range(0, len(start), step):
                some = start[i : i + step]
                y = p.vectors(some, span, self.basis)
                cos = y @ self.latent.T / np.maximum(np.linalg.norm(y, axis=1, keepdims=True), 1e-9)
                for a, b in zip(*np.nonzero((cos >= self.cosine) & (mass[some][:, None] >= self.masses)), strict=True):
                    row = int(np.searchsorted(p.first, some[a], "right")) - 1
                    near.setdefault((row, int(self.owner[b])), []).append((-float(cos[a, b]), int(some[a] - p.first[row]) * BLOCK, span * BLOCK))
        return near

    def __call__(self, texts: pa.Array) -> Iterator[tuple]:
        for chunk in chunks(pc.utf8_lower(texts)):
            w = words(chunk, "alnum")
            p = _Passages(w, self.items, self.flags)
            if not p.first[-1]:
                continue
            for (row, item), passages in self._near(p).items():
                if item not in self.masks:
                    self._ready(item)
                own, of = self.items.words[item], w.hash[w.bounds[row] : w.bounds[row + 1]]
                for cos, start, size in sorted(passages):
                    a, b = max(0, start - len(own)), min(len(of), start + size + len(own))
                    answer = float(np.isin(self.answers[item], of[a:b]).mean()) if len(self.answers[item]) else 0.0
                    given = self.items.answers[item] is not None
                    if given and answer < self.answer:
                        continue
                    weak = not given and answer >= WEAK_ANSWER and len(own) >= WEAK_WORDS
                    least = min(self.lcs, WEAK_LCS) if weak else self.lcs
                    # no subsequence is longer than the item's words that are there at all
                    if np.isin(own, of[a:b]).mean() < least:
                        continue
                    lcs = common_subsequence(self.masks[item], len(own), of[a:b].tolist()) / len(own)
                    if lcs >= least:
                        yield chunk.first + row, self.items.ids[item], -cos, lcs, answer, start, min(len(of), start + size)
                        break


def _prepared(docs: DataFrame, benchmark: DataFrame) -> tuple[Items, np.ndarray] | None:
    ship_code(docs.sparkSession)
    items = read_items(benchmark)
    if not items.ids:
        return None
    n, items.df = document_frequencies(docs, items)
    items.idf = _weights(n, items)
    return items, latent_basis(docs, items)


def find_leaks(docs: DataFrame, benchmark: DataFrame, least_cosine: float = LEAST_COSINE, least_lcs: float = LEAST_LCS, least_answer: float = LEAST_ANSWER) -> DataFrame:
    """``doc_id, item_id, cosine, lcs, answer, start_word, end_word``: one row per document and item found in it.

    A candidate passage has a latent cosine of ``least_cosine`` with the item, or with a part of an item of over 64 words. It counts as a leak if the longest common
    subsequence of words, over the passage and as many words as the item has on both sides, holds ``least_lcs`` of the
    item's words. If the item has an ``answer``, ``least_answer`` of its words must occur there too. If not, ``answer`` is the
    share of its five rarest words that some document has; a paraphrase may have replaced any of them, so a strong
    subsequence stands alone, and one of 0.5 counts for items of ten words or more if four of the five are there. Of several passages the one with the largest cosine that passes is reported, in
    words (runs of letters and digits, case ignored), end exclusive.

    Null and empty texts have no leaks; items without words are never found. An
    empty benchmark or corpus gives no rows. Repeated rows are reported each. A benchmark of more items than a task can hold
    is searched in blocks, each with a vocabulary and basis of its own. Other columns are ignored.
    """
    parts = [_block_leaks(docs, block, least_cosine, least_lcs, least_answer) for block in item_blocks(benchmark)]
    return reduce(DataFrame.unionByName, parts)


def _block_leaks(docs: DataFrame, benchmark: DataFrame, least_cosine: float, least_lcs: float, least_answer: float) -> DataFrame:
    schema = "doc_id long, item_id long, cosine double, lcs double, answer double, start_word long, end_word long"
    ready = _prepared(docs, benchmark)
    if ready is None:
        return docs.sparkSession.createDataFrame([], schema)
    shared = docs.sparkSession.sparkContext.broadcast(ready)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        search = _Search(*shared.value, least_cosine, least_lcs, least_answer)
        kinds = [pa.int64(), *[pa.float64()] * 3, pa.int64(), pa.int64()]
        for batch in batches:
            found = list(search(batch.column(1)))
            row, *rest = zip(*found, strict=True) if found else [()] * 7
            yield pa.RecordBatch.from_arrays([batch.column(0).take(pa.array(row, pa.int64())), *(pa.array(c, k) for c, k in zip(rest, kinds, strict=True))], names=["doc_id", "item_id", "cosine", "lcs", "answer", "start_word", "end_word"])

    return _texts(docs).mapInArrow(run, schema)


def drop_leaks(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """``docs`` without the rows whose text contains a benchmark item; columns stay. Rows are judged one by one.

    A benchmark of several blocks is searched block by block, each in what the one before has left.
    """
    return reduce(_drop_block, item_blocks(benchmark), docs)


def _drop_block(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    ready = _prepared(docs, benchmark)
    if ready is None:
        return docs
    shared = docs.sparkSession.sparkContext.broadcast(ready)
    at, names = docs.columns.index("text"), docs.columns
    docs = docs.toDF(*[f"c{i}" for i in range(len(names))])  # mapInArrow takes no names with dots

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        search = _Search(*shared.value, LEAST_COSINE, LEAST_LCS, LEAST_ANSWER)
        for batch in batches:
            keep = np.ones(batch.num_rows, bool)
            keep[[row for row, *_ in search(batch.column(at))]] = False
            yield batch.filter(pa.array(keep))

    return docs.mapInArrow(run, docs.schema).toDF(*names)


def op1_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return find_leaks(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))
