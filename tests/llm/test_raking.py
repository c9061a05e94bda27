"""Raking: margins, the mix of the documents drawn, and edge cases."""

import collections
import random

import pytest
from pyspark.sql import functions as F

from strandline.llm import raking

SCHEMA = "doc_id long, text string, lang string, source string, weight long, tokens long, factor string"


def corpus(spark, n, seed=1):
    rng = random.Random(seed)
    rows = [(i, " ".join(["word"] * rng.randint(1, 60)), rng.choices(["en", "fr", "de"], [8, 1, 1])[0], rng.choices(["a", "b", "c"], [6, 3, 1])[0], 7, 7, "x") for i in range(n)]
    return spark.createDataFrame(rows, SCHEMA)


def shares(rows, column, weight):
    out = collections.Counter()
    for r in rows:
        out[r[column]] += weight(r)
    return {k: v / sum(out.values()) for k, v in out.items()}


TARGETS = {"lang": {"en": 0.4, "fr": 0.4, "de": 0.2}, "source": {"a": 0.2, "b": 0.3, "c": 0.5}}


def test_factors_meet_every_margin(spark):
    cells = raking.cell_factors(corpus(spark, 400), targets=TARGETS, rounds=60).collect()
    for margin, want in TARGETS.items():
        assert shares(cells, margin, lambda r: r.tokens * r.factor) == pytest.approx(want, abs=1e-6)
    total = sum(r.tokens for r in cells)
    assert sum(r.tokens * r.factor for r in cells) == pytest.approx(total)


def test_many_cells_are_fitted_alike(spark, monkeypatch):
    docs = corpus(spark, 400)
    factors = lambda: {(r.source, r.lang, r.topic): r.factor for r in raking.cell_factors(docs, targets=TARGETS).collect()}
    row = factors()
    monkeypatch.setattr(raking, "FIT_CELLS", 0)
    assert factors() == pytest.approx(row, rel=1e-7)


def test_drawn_documents_have_the_target_mix(spark):
    out = raking.mix(corpus(spark, 20000), targets=TARGETS).collect()
    assert {r.weight for r in out} == {1.0} and len(out) > 300
    for margin, want in TARGETS.items():
        assert shares(out, margin, lambda r: r.tokens) == pytest.approx(want, abs=0.06)
    assert set(out[0].asDict()) == {"doc_id", "text", "lang", "source", "factor", "topic", "tokens", "probability", "weight"}


def test_a_given_rate_leaves_the_rest_to_the_weight(spark):
    out = raking.mix(corpus(spark, 4000), rate=1.0, targets=TARGETS).collect()
    assert max(r.weight for r in out) > 1
    assert shares(out, "lang", lambda r: r.tokens * r.weight) == pytest.approx(TARGETS["lang"], abs=0.06)


def test_a_rare_language_is_read_often(spark):
    docs = corpus(spark, 6000).withColumn("lang", F.when(F.col("doc_id") % 1000 == 0, "es").otherwise("en"))
    targets = {"lang": {"en": 0.85, "es": 0.15}, "source": {"a": 0.4, "b": 0.3, "c": 0.3}}
    report = {(r.margin, r.value): r for r in raking.margin_report(docs, targets=targets).collect()}
    rare = report["lang", "es"]
    assert rare.share < 0.003 and rare.target == pytest.approx(0.15) and rare.raked == pytest.approx(0.15, abs=1e-6) and abs(rare.miss) < 1e-6
    once = raking.mix(docs, targets=targets).count()
    out = raking.mix_epochs(docs, targets=targets).collect()
    tokens = sum(r.tokens for r in docs.withColumn("tokens", F.size(F.split("text", " "))).collect())
    assert once < 600 < len(out)
    assert sum(r.tokens * r.copies for r in out) == pytest.approx(tokens, rel=0.05) and max(r.copies for r in out) > 20
    for margin, want in targets.items():
        assert shares(out, margin, lambda r: r.tokens * r.copies) == pytest.approx(want, abs=0.03)
    assert set(out[0].asDict()) == {"doc_id", "text", "lang", "source", "weight", "factor", "topic", "tokens", "copies"}
    assert raking.mix_epochs(docs.limit(0)).count() == raking.margin_report(docs.limit(0)).count() == 0
    with pytest.raises(ValueError):
        raking.mix_epochs(docs, epochs=0.0)


def test_conflicting_targets_are_reported(spark):
    rows = [(i, "a b", lang, source, 1, 1, "x") for i, (lang, source) in enumerate([("en", "a"), ("fr", "b")])]
    with pytest.warns(UserWarning, match="not met"):
        found = raking.margin_report(spark.createDataFrame(rows, SCHEMA), targets={"lang": {"en": 0.9, "fr": 0.1}, "source": {"a": 0.5, "b": 0.5}}).collect()
    assert max(abs(r.miss) for r in found) > 0.1 and {r.margin for r in found} == {"source", "lang", "topic"}


def test_edges(spark):
    rows = [(None, None, None, None, 1, 1, "x"), (1, "", None, "s", 1, 1, "x"), (2, "one two", "en", None, 1, 1, "x"), (2, "one two", "en", None, 1, 1, "x"), (3, "w " * 50000, "xx", "s", 1, 1, "x")]
    docs = spark.createDataFrame(rows, SCHEMA)
    cells = raking.cell_factors(docs, targets={"lang": {"en": 1.0, "nowhere": 1.0}}, strict=False)
    # a value without a target keeps its share; one that no cell has is left out
    assert {(r.source, r.lang): r.tokens for r in cells.collect()} == {("(none)", "en"): 4, ("s", "xx"): 50000}
    everything = raking.mix(docs, rate=1000.0).collect()
    assert len(everything) == 5 and sorted(r.tokens for r in everything) == [0, 0, 2, 2, 50000]
    assert raking.mix(docs.limit(0)).count() == 0
    twice = collections.Counter(r.doc_id for r in raking.mix(docs.filter("doc_id = 2").withColumn("doc_id", F.explode(F.sequence(F.lit(0), F.lit(50))))).collect())
    assert set(twice.values()) == {2}


@pytest.mark.parametrize("cells", [0, 20_000])
def test_targets_that_no_cells_can_meet_are_an_error(spark, monkeypatch, cells):
    monkeypatch.setattr(raking, "FIT_CELLS", cells)
    rows = [(i, "a b", lang, source, 1, 1, "x") for i, (lang, source) in enumerate([("en", "a"), ("fr", "b")])]
    with pytest.raises(RuntimeError, match="not met"):
        raking.cell_factors(spark.createDataFrame(rows, SCHEMA), targets={"lang": {"en": 0.9, "fr": 0.1}, "source": {"a": 0.5, "b": 0.5}}, rounds=10)
