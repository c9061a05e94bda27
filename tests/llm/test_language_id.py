"""Language filters: against plain sets of n-grams, many languages, long texts, ties, repeats and empty tables."""

import random

import numpy as np
import pyarrow as pa

from strandline.llm import language_id

SCHEMA = "doc_id long, text string, lang string, score double, _letter string"


def frame(spark, rows):
    return spark.createDataFrame([(i, t, lang, 0.5, "x") for i, (t, lang) in enumerate(rows)], SCHEMA)


def tongue(seed, n=40, words=30):
    rng = random.Random(seed)
    syllables = ["".join(rng.choice("abcdefghijklmnopqrstuvwxyz") for _ in range(3)) for _ in range(12)]
    return [" ".join(rng.choice(syllables) + rng.choice(syllables) for _ in range(words)) for _ in range(n)]


def test_shares_against_sets(spark):
    rows = [(t, lang) for lang in ("aa", "bb") for t in tongue(lang)]
    model = language_id.fit(frame(spark, rows))
    assert model.languages == ["aa", "bb"]
    grams = lambda t: [t[i : i + o] for o in language_id.ORDERS for i in range(len(t) - o + 1)]
    known = {lang: {g for t, x in rows if x == lang for g in grams(t)} for lang in model.languages}
    texts = tongue("aa", 3) + tongue("bb", 3) + tongue("cc", 3)
    want = np.array([[np.mean([g in known[lang] for g in grams(t)]) for lang in model.languages] for t in texts])
    assert np.abs(model.shares(pa.array(texts)) - want).max() < 0.02


def test_more_than_64_languages_and_long_texts(spark):
    rows = [(t, f"l{k:03d}") for k in range(70) for t in tongue(k, 6)] + [(" ".join(tongue("long", 60, 60)), "zz")] * 3
    model = language_id.fit(frame(spark, rows), longest=2000)
    assert len(model.languages) == 71 and model.bits.shape[0] == 2
    got = language_id.predict(frame(spark, rows), model).collect()
    assert all(r.lang_pred == rows[r.doc_id][1] for r in got)


def test_edges(spark):
    rows = [(t, "aa") for t in tongue("aa", 5)] + [(t, "bb") for t in tongue("aa", 5)] + [(None, "aa"), ("", "aa"), ("12 !", None), ("12 !", "nn")] + [(tongue("aa", 1)[0], "aa")] * 4
    docs = frame(spark, rows)
    model = language_id.fit(docs)
    got = {r.doc_id: r for r in language_id.predict(docs, model).collect()}
    assert all(got[i].lang_pred == "aa" for i in range(10))  # a tie goes to the first
    assert [got[i].lang_pred for i in (10, 11, 12, 13)] == ["und"] * 4 and all(0 <= r.score <= 1 for r in got.values())
    nothing = language_id.fit(docs.limit(0))
    assert nothing.languages == [] and {r.lang_pred for r in language_id.predict(docs, nothing).collect()} == {"und"}
    assert language_id.predict(docs.limit(0), model).count() == 0
    assert language_id.predict(frame(spark, [(" ".join(tongue("aa", 200, 200)), None)]), model).first().lang_pred == "aa"
