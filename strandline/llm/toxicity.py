"""Toxicity by a convolutional text classifier trained in numpy.

A word is the sum of two hashed embeddings, of the word and of its first bytes. Filters one, two and three words wide
slide over the whole text; each keeps its largest response, and a logistic layer weighs them. For scoring, embeddings and
filters are multiplied once into a table, so a text costs gathers and no matrix products. The score's zero point and one
threshold for each language are calibrated on all those learning rows, a fifth by a hash, that are kept from the weights.
"""

from __future__ import annotations

import pickle
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from strandline.llm._sampling import drawn_texts
from strandline.llm._tokens import chunks, mix, words
from strandline.llm.language_id import fold
from strandline.session import discard, ship_code, table

BUCKETS = 1 << 14
DIM = 12
WIDTHS = (1, 2, 3)
FILTERS = 8
PREFIX_BYTES = 5
STEPS = 500
#: Bounds of the learning sample: rows, and the characters of a row.
SAMPLE = 6000
LONGEST = 20_000
#: Calibration counts rows by logit in steps of 1 / BINS; beyond +-LARGEST they share a bin.
BINS = 256
LARGEST = 256.0
#: A language with fewer toxic calibration rows than this uses the common threshold.
LEAST_TOXIC = 8


def word_ids(column: pa.Array) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """``(word buckets, prefix buckets, bounds)`` of each chunk of a column; words are runs of letters and digits."""
    for chunk in chunks(column):
        w = words(chunk, "alnum")
        head = np.zeros(len(w.start), np.uint64)
        if len(w.start):
            lowered = chunk.data | np.uint8(0x20)
            open_ = np.ones(len(w.start), bool)
            from_ = np.r_[w.start, len(chunk.data)]
            for i in range(PREFIX_BYTES):
                at = np.minimum(w.start + i, len(chunk.data) - 1)
                open_ &= (w.start + i) < from_[1:]
                head = head * np.uint64(257) + np.where(open_, lowered[at], 0).astype(np.uint64)
        yield (w.hash % np.uint64(BUCKETS)).astype(np.int32), (mix(head) % np.uint64(BUCKETS)).astype(np.int32), w.bounds


@dataclass
class Toxicity:
    """Trained weights: ``E`` words by dimensions, ``P`` prefixes, ``W`` and ``b`` the filters, ``u`` and ``c`` the output."""

    E: np.ndarray
    P: np.ndarray
    W: list[np.ndarray]
    b: np.ndarray
    u: np.ndarray
    c: float
    shift: float = 0.0
    thresholds: dict[str, float] = field(default_factory=dict)

    def _responses(self, word: np.ndarray, head: np.ndarray, tables: tuple) -> Iterator[tuple[int, np.ndarray]]:
        """Each width's filter responses at every word position; missing words to the right count as zero vectors."""
        by_word, by_head = tables
        n = len(word)
        for width in WIDTHS:
            z = np.zeros((n, FILTERS), np.float32)
            for k in range(min(width, n)):
                z[: n - k] += by_word[k, width][word[k:]]
                z[: n - k] += by_head[k, width][head[k:]]
            yield width, z

    def tables(self) -> tuple[dict, dict]:
        out: tuple[dict, dict] = ({}, {})
        for w, width in zip(self.W, WIDTHS, strict=True):
            for k in range(width):
                out[0][k, width] = np.ascontiguousarray(self.E @ w[k], np.float32)
                out[1][k, width] = np.ascontiguousarray(self.P @ w[k], np.float32)
        return out

    def logits(self, texts: pa.Array, tables: tuple | None = None) -> np.ndarray:
        tables, out = tables or self.tables(), []
        for word, head, bounds in word_ids(texts):
            some = np.diff(bounds) > 0
            pooled = np.zeros((len(bounds) - 1, len(self.u)), np.float32)
            if len(word):
                for j, (_, z) in enumerate(self._responses(word, head, tables)):
                    pooled[some, j * FILTERS : (j + 1) * FILTERS] = np.maximum.reduceat(z, bounds[:-1][some], axis=0)
            out.append(np.maximum(pooled + self.b, 0) @ self.u + self.c)
        return np.concatenate(out) if out else np.zeros(0)

    def scores(self, texts: pa.Array, tables: tuple | None = None) -> np.ndarray:
        return 1 / (1 + np.exp(-np.clip(self.logits(texts, tables) - self.shift, -30, 30)))


def _fresh(rng: np.random.Generator) -> Toxicity:
    small = lambda *shape: (rng.standard_normal(shape) * 0.1).astype(np.float32)
    n = FILTERS * len(WIDTHS)
    return Toxicity(small(BUCKETS, DIM), small(BUCKETS, DIM), [small(w, DIM, FILTERS) * 3 for w in WIDTHS], np.zeros(n, np.float32), small(n) * 3, -1.0)


def _train(texts: pa.Array, y: np.ndarray, steps: int = STEPS, rate: float = 0.03, seed: int = 5, batch: int = 64) -> Toxicity:
    """Adam on the weighted logistic loss; gradients flow through each filter's largest position only."""
    rng = np.random.default_rng(seed)
    model = _fresh(rng)
    docs = [(w[a:b], p[a:b]) for w, p, bounds in word_ids(texts) for a, b in zip(bounds[:-1], bounds[1:], strict=True)]
    weight = np.where(y == 1, 0.5 / max(y.mean(), 1e-6), 0.5 / max(1 - y.mean(), 1e-6))
    state: dict[str, list] = {}

    def adam(name: str, value: np.ndarray, grad: np.ndarray, step: int) -> None:
        m, v = state.setdefault(name, [np.zeros_like(value), np.zeros_like(value)])
        m += 0.1 * (grad - m)
        v += 0.01 * (grad * grad - v)
        value -= rate * (m / (1 - 0.9**step)) / (np.sqrt(v / (1 - 0.99**step)) + 1e-6)

    step = 0
    n_out = len(model.u)
    while step < steps:
        order = rng.permutation(len(docs))
        for at in range(0, len(order), batch):
            step += 1
            some = [i for i in order[at : at + batch] if len(docs[i][0])]
            if not some:
                continue
            word, head = (np.concatenate([docs[i][j] for i in some]) for j in (0, 1))
            starts = np.cumsum([0, *[len(docs[i][0]) for i in some]])[:-1]
            x = model.E[word] + model.P[head]
            pooled, where, n = np.zeros((len(some), n_out), np.float32), [], len(word)
            for j, (w, width) in enumerate(zip(model.W, WIDTHS, strict=True)):
                z = np.zeros((n, FILTERS), np.float32)
                for k in range(min(width, n)):
                    z[: n - k] += x[k:] @ w[k]
                top = np.maximum.reduceat(z, starts, axis=0)
                pooled[:, j * FILTERS : (j + 1) * FILTERS] = top
                ends = np.r_[starts[1:], n]
                where.append(np.stack([a + z[a:b].argmax(axis=0) for a, b in zip(starts, ends, strict=True)]))
            act = np.maximum(pooled + model.b, 0)
            logit = act @ model.u + model.c
            g = (weight[some] * (1 / (1 + np.exp(-np.clip(logit, -30, 30))) - y[some]) / len(some)).astype(np.float32)
            gz = g[:, None] * model.u * (act > 0)
            ge, gp = np.zeros_like(model.E), np.zeros_like(model.P)
            for j, (w, width) in enumerate(zip(model.W, WIDTHS, strict=True)):
                part, gw = gz[:, j * FILTERS : (j + 1) * FILTERS], np.zeros_like(w)
                for k in range(width):
                    pos = where[j] + k
                    inside = pos < n
                    pos = np.minimum(pos, n - 1)
                    live = part * inside
                    gw[k] = np.einsum("df,dfe->ef", live, x[pos])
                    gx = live[:, :, None] * w[k].T[None]
                    np.add.at(ge, word[pos].ravel(), gx.reshape(-1, DIM))
                    np.add.at(gp, head[pos].ravel(), gx.reshape(-1, DIM))
                adam(f"W{j}", w, gw + 1e-4 * w, step)
            adam("E", model.E, ge, step)
            adam("P", model.P, gp, step)
            adam("b", model.b, gz.sum(axis=0), step)
            adam("u", model.u, act.T @ g + 1e-3 * model.u, step)
            model.c -= rate * float(g.sum())
    return model


def _best_cut(bins: list) -> float:
    """The cut with the best F1 from rows of ``bin, n, hits, low, high``, in the middle of the gap at which it is reached."""
    held: dict[int, tuple] = {}
    for r in bins:
        n, hits, low, high = held.get(r.bin, (0, 0, np.inf, -np.inf))
        held[r.bin] = n + r.n, hits + r.hits, min(low, r.low), max(high, r.high)
    n, hits, low, high = (np.array(x) for x in zip(*(held[k] for k in sorted(held, reverse=True)), strict=True))
    f1 = 2 * np.cumsum(hits) / (np.cumsum(n) + hits.sum())
    i = int(f1.argmax())
    return float((low[i] + (high[i + 1] if i + 1 < len(low) else low[i] - 1)) / 2)


def _aside() -> Column:
    """Whether a row is kept from the weights; copies of a text fall on the same side."""
    return F.shiftrightunsigned(F.xxhash64("text"), 7) % 5 == 0


def _trained(data: pa.Table, steps: int) -> tuple[Toxicity, bool | None]:
    """The network fitted on rows ``text, hit, aside``, and whether the rows ``aside`` were kept from it."""
    data = data.sort_by([("hit", "ascending"), ("h", "ascending")])
    y = np.array(data["hit"].to_pylist(), dtype=np.int64)
    if y.sum() in (0, len(y)):
        model = _fresh(np.random.default_rng(0))
        model.u[:] = 0
        model.c = 30.0 if len(y) and y[0] else -30.0
        return model, None
    texts = pa.concat_arrays(data["text"].cast(pa.large_string()).chunks)
    aside = np.array(data["aside"].to_pylist(), bool)
    apart = bool(aside.sum() >= 10 and 0 < y[aside].sum() < aside.sum() and 0 < y[~aside].sum() < (~aside).sum())
    learn = ~aside if apart else np.ones(len(y), bool)
    return _train(texts.filter(pa.array(learn)), y[learn], steps), apart


def fit_weights(texts: DataFrame, labelled: DataFrame, sample: int = SAMPLE, longest: int = LONGEST, steps: int = STEPS) -> tuple[Toxicity, bool | None]:
    """The network without a calibration, and whether the rows ``_aside`` were kept from it; None if there is one label only.

    ``labelled`` has ``h, toxic``, ``texts`` the texts whose ``xxhash64`` is h. The drawn texts, each once, meet in one task that
    trains and returns the weights; ``sample`` and ``longest`` bound what it holds, and it is run again if its executor is lost.
    """
    spark = texts.sparkSession
    ship_code(spark)
    drawn = drawn_texts(labelled.select("h", (F.col("toxic") == 1).alias("label")), sample // 2).withColumnRenamed("label", "hit")
    of = texts.filter(F.length("text") <= longest).select(F.col("text").cast("string").alias("text"), F.xxhash64("text").alias("h"))
    rows = of.join(F.broadcast(drawn), "h").groupBy("h", "hit").agg(F.any_value("text").alias("text")).select("h", "hit", "text", _aside().alias("aside"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = [b for b in batches if b.num_rows]
        if held:
            yield pa.RecordBatch.from_arrays([pa.array([pickle.dumps(_trained(pa.Table.from_batches(held), steps))], pa.binary())], names=["model"])

    got = rows.repartition(1).mapInArrow(run, "model binary").collect()
    discard(drawn)
    if not got:
        return _trained(pa.table({"h": pa.array([], pa.int64()), "hit": pa.array([], pa.bool_()), "text": pa.array([], pa.string()), "aside": pa.array([], pa.bool_())}), steps)
    return pickle.loads(bytes(got[0][0]))


def logits(docs: DataFrame, model: Toxicity) -> DataFrame:
    """``docs`` with ``logit`` in place of ``text``, from the whole text."""
    spark = docs.sparkSession
    ship_code(spark)
    shared = spark.sparkContext.broadcast(model)
    rows = docs.select(F.col("text").cast("string").alias("text"), *[c for c in docs.columns if c != "text"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        net = shared.value
        tables = net.tables()
        for batch in batches:
            if batch.num_rows:
                yield pa.RecordBatch.from_arrays([*batch.columns[1:], pa.array(net.logits(batch.column(0), tables).astype(np.float64))], names=[*batch.schema.names[1:], "logit"])

    kinds = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in rows.schema.fields[1:])
    return rows.mapInArrow(run, f"{kinds}, logit double")


def calibrate(model: Toxicity, scored: DataFrame) -> Toxicity:
    """``model`` with the zero point and thresholds that all rows ``lang, toxic, logit`` set; the driver sees counts by bin."""
    size = F.least(F.lit(LARGEST), F.greatest(F.lit(-LARGEST), F.col("logit")))
    hit = F.when(F.col("toxic") == 1, 1).otherwise(0)
    bins = scored.groupBy("lang", F.floor(size * BINS).alias("bin")).agg(F.count("*").alias("n"), F.sum(hit).alias("hits"), F.min("logit").alias("low"), F.max("logit").alias("high")).collect()
    model.shift = _best_cut(bins)
    for lang in sorted({r.lang for r in bins if r.lang is not None}):
        own = [r for r in bins if r.lang == lang]
        if LEAST_TOXIC <= sum(r.hits for r in own) < sum(r.n for r in own):
            cut = _best_cut(own) - model.shift
            model.thresholds[lang] = float(1 / (1 + np.exp(-cut)))
    return model


def fit(labelled: DataFrame, sample: int = SAMPLE, longest: int = LONGEST, steps: int = STEPS) -> Toxicity:
    """Learn from ``text, toxic, lang`` rows.

    The weights come from at most ``sample`` distinct texts, of at most ``longest`` characters each, in the order of a hash
    and half of the sample at most from either label. A fifth of all rows, by a hash, is kept from the weights; every
    one of them, of any length, counts for the score's zero point and the thresholds by language. Null labels are left
    out. With one label only, every score is the share of that label. Where the fifth is too few, all rows set both.
    """
    rows = labelled.filter("toxic is not null and text is not null")
    model, apart = fit_weights(rows, rows.filter(F.length("text") <= longest).select(F.xxhash64("text").alias("h"), "toxic"), sample, longest, steps)
    if apart is None:
        return model
    return calibrate(model, logits((rows.filter(_aside()) if apart else rows).select("text", "lang", "toxic"), model))


def score(docs: DataFrame, model: Toxicity, keep: list[Column] | None = None) -> DataFrame:
    """``doc_id, score`` (and the ``keep`` columns): one row per row of ``docs``, from the whole text alone.

    Null and empty texts, and texts without a word, score as the network does with all filters silent.
    """
    spark = docs.sparkSession
    ship_code(spark)
    shared = spark.sparkContext.broadcast(model)
    rows = docs.select(F.col("text").cast("string").alias("text"), F.col("doc_id").cast("long").alias("doc_id"), *(keep or []))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        net = shared.value
        tables = net.tables()
        for batch in batches:
            if batch.num_rows:
                yield pa.RecordBatch.from_arrays([*batch.columns[1:], pa.array(net.scores(batch.column(0), tables).astype(np.float64))], names=[*batch.schema.names[1:], "score"])

    kinds = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in rows.schema.fields[1:])
    return rows.mapInArrow(run, f"{kinds}, score double")


def threshold(model: Toxicity) -> Column:
    """The calibrated threshold of a row's ``lang``; 0.5 for languages without their own."""
    out = F.lit(0.5)
    for lang, cut in model.thresholds.items():
        out = F.when(F.col("lang") == lang, F.lit(cut)).otherwise(out)
    return out


def learned(spark: SparkSession, docs: DataFrame, sf_dir: str, rows: Column | None = None) -> Toxicity:
    """The model fitted on the labelled ones among ``docs``, or on those of them that ``rows`` holds for.

    Labels meet numbers only: the hashes of texts for the sample, and the logits of texts for the calibration.
    """
    labels = table(spark, sf_dir, "labels").filter("toxic is not null").select(F.col("doc_id").alias("_id"), "toxic")
    known = docs.select("doc_id", "text", "lang").filter("text is not null")
    if rows is not None:
        known = known.filter(F.coalesce(rows, F.lit(False)))
    hashes = known.filter(F.length("text") <= LONGEST).select("doc_id", F.xxhash64("text").alias("h"))
    model, apart = fit_weights(known, hashes.join(labels, F.col("doc_id") == F.col("_id")).select("h", "toxic"))
    if apart is None:
        return model
    scored = logits(known.filter(_aside()) if apart else known, model)
    return calibrate(model, scored.join(labels, F.col("doc_id") == F.col("_id")))


def drop_toxic(docs: DataFrame, model: Toxicity) -> DataFrame:
    """``docs`` without the rows whose score reaches the threshold of their ``lang``; columns stay, a null text counts as empty."""
    spark = docs.sparkSession
    ship_code(spark)
    shared = spark.sparkContext.broadcast(model)
    text, lang, names = docs.columns.index("text"), docs.columns.index("lang"), docs.columns
    docs = docs.toDF(*[f"c{i}" for i in range(len(names))])  # mapInArrow takes no names with dots

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        net = shared.value
        tables = net.tables()
        for batch in batches:
            if batch.num_rows:
                cut = np.array([net.thresholds.get(x, 0.5) for x in batch.column(lang).to_pylist()])
                yield batch.filter(pa.array(net.scores(batch.column(text), tables) < cut))

    return docs.mapInArrow(run, docs.schema).toDF(*names)


def op9_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    model = learned(spark, docs, sf_dir, fold(5) != 0)
    held_out = F.coalesce(fold(5) == 0, F.lit(False)).alias("held_out")
    out = score(docs, model, [held_out, F.col("lang")])
    return out.select("doc_id", "held_out", "score", (F.col("score") >= 0.5).cast("int").alias("predicted"), (F.col("score") >= threshold(model)).cast("int").alias("predicted_by_language"))
