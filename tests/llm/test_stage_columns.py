"""Stages keep the caller's columns, whatever they are called, and take nulls, empty tables and repeated rows."""

import time

import pytest
from pyspark.sql import functions as F

from strandline.llm import decontamination, line_windows, near_duplicates, personal_data, raking, toxicity

NAMES = ["_key", "_lines", "_id", "_covered", "_topic", "_p", "_factor", "_gone", "_version", "row", "id", "version", "covered", "lines", "source_", "factor", "p", "node", "label", "sig", "a b", "x.y"]
TEXT = "\n".join(f"line {i} of some words that stand here for {i * 7} things" for i in range(12))
TEXTS = [TEXT, TEXT + "\nanother end", None, "", "one short text", "é" * 3000, "alone " * 40]


def frame(spark):
    rows = [(i, t, "en", f"s{i % 2}", len(t or ""), *[f"{n}{i}" for n in NAMES]) for i, t in enumerate(TEXTS)]
    rows += [rows[4], (None, None, None, None, None, *["z"] * len(NAMES))]
    schema = "doc_id long, text string, lang string, source string, n_chars long, " + ", ".join(f"`{n}` string" for n in NAMES)
    return spark.createDataFrame(rows, schema)


def bench(spark):
    return spark.createDataFrame([(1, "nothing of this kind is in any of the texts at all")], "item_id long, text string")


STAGES = {
    "lines": lambda spark, d: line_windows.dedup_lines(d),
    "near": lambda spark, d: near_duplicates.deduplicate(d),
    "mix": lambda spark, d: raking.mix(d, rate=50.0),
    "leaks": lambda spark, d: decontamination.drop_leaks(d, bench(spark)),
    "toxic": lambda spark, d: toxicity.drop_toxic(d, toxicity.fit(d.withColumn("toxic", F.lit(0)))),
}


@pytest.mark.parametrize("name", STAGES)
def test_columns_stay(spark, name):
    docs = frame(spark)
    out = STAGES[name](spark, docs)
    assert out.columns[: len(docs.columns)] == docs.columns or set(docs.columns) <= set(out.columns)
    own = {r.doc_id: r for r in docs.collect()}
    rows = out.collect()
    assert rows and all(r[n] == own[r.doc_id][n] for r in rows for n in [*NAMES, "lang", "source"])
    assert STAGES[name](spark, docs.limit(0)).count() == 0


def test_kept_rows(spark):
    docs = frame(spark)
    near = [r.doc_id for r in near_duplicates.deduplicate(docs).select("doc_id").collect()]
    assert sorted(near, key=str) == sorted([0, 2, 3, 4, 4, 5, 6, None], key=str)
    lines = {r.doc_id: r for r in line_windows.dedup_lines(docs).collect()}
    assert lines[1].text == "another end" and lines[1].n_removed == 12 and lines[0].text == TEXT and lines[2].text is None


@pytest.mark.parametrize("run", ["a", "1", "1.", "%", "+1 ", "a.b-", "0.0.0", "a@", "@", "1-", "+", "(1)"])
def test_long_runs_are_read_once(spark, run):
    text = (run * 1_000_000)[:1_000_000] + "@ me@host.org"
    docs = spark.createDataFrame([(0, text)], "doc_id long, text string")
    began = time.time()
    found = personal_data.find_personal_data(docs, [0.0] * 80).collect()
    # a run without a match takes a second or two; runs of 150,000 addresses take their time, but in proportion
    assert time.time() - began < (90 if "." in run else 15) and found[0].n_email >= 1
