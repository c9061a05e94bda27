"""Spelling variants: against a comparison of all words, and edge cases."""

import collections
import random
import re
import zlib

import pytest

from strandline.llm import spelling_variants
from strandline.session import table

SF = "/root/testdata/sf0.001"


def words_of(rows):
    """The counted words of (doc_id, text), by plain Python."""
    n = collections.Counter()
    for i, text in rows:
        for run in re.findall("[A-Za-zÀ-ÿ]+", text or ""):
            w = re.sub("[A-Z]", lambda m: m[0].lower(), run)
            h = zlib.crc32(f"{'' if i is None else i}:{w}".encode())
            if h % 199 == 0:
                w = w[: h % len(w)] + w[h % len(w) + 1 :]
            n[w] += 1
    return {w: k for w, k in n.items() if len(w) >= 6 and k >= 5}


def near(a, b):
    if a == b or abs(len(a) - len(b)) > 1:
        return False
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b, strict=True)) == 1
    if len(a) > len(b):
        a, b = b, a
    i = next((i for i in range(len(a)) if a[i] != b[i]), len(a))
    return a[i:] == b[i + 1 :]


def expected(words):
    """``word: (form, root, n, n_near, form_n)`` by comparing all words."""
    shape = collections.defaultdict(list)
    for w in words:  # words one letter apart share their first or their last half; here all of near length are compared
        shape[len(w)].append(w)
    out, form = {}, {}
    for w, n in words.items():
        found = [x for k in (-1, 0, 1) for x in shape.get(len(w) + k, ()) if near(w, x)]
        top = min(found, key=lambda x: (-words[x], x), default=None)
        form[w] = top if top is not None and words[top] >= 5 * n else None
        out[w] = [len(found)]
    for w in words:
        root = w
        while form[root] is not None:
            root = form[root]
        out[w] = (form[w], root, words[w], out[w][0], words[form[w]] if form[w] is not None else None)
    return out


def result(df):
    rows = df.collect()
    out = {r.word: (r.form, r.root, r.n, r.n_near, r.form_n) for r in rows}
    assert len(out) == len(rows)
    return out


def frame(spark, words):
    return spark.createDataFrame(words, "word string, n long, rank string, key long, place long, form string")


def test_against_all_words(spark):
    rng = random.Random(5)
    words = {}
    for _ in range(60):
        base = "".join(rng.choice("abé") for _ in range(rng.randint(6, 9)))
        for _ in range(12):
            w = list(base)
            for _ in range(rng.randint(0, 2)):
                i = rng.randrange(len(w) + 1)
                w[i : i + rng.randint(0, 1)] = rng.choice(["", "a", "b", "é"])
            words["".join(w)] = rng.choice([5, 6, 30, 40, 200, 1000, 1000])
    got = result(spelling_variants.variant_groups(frame(spark, [(w, n, "x", 1, 2, "f") for w, n in words.items()])))
    assert got == expected(words)
    assert any(v[1] != v[0] and v[0] is not None for v in got.values())  # chains of forms


@pytest.mark.parametrize("length", [47, 48, 49, 50, 51, 3000])
def test_long_words_are_found_alike(spark, length):
    rng = random.Random(length)
    base = "".join(rng.choice("ab") for _ in range(length))
    words = {base: 1000, base[1:]: 100, base[:-1]: 50, base + "a": 20, base[: length // 2] + "z" + base[length // 2 + 1 :]: 7, base[: length // 2] + "y" + base[length // 2 + 1 :]: 7, base[1:] + "z": 5, "a" * length: 9, "a" * (length + 1): 50}
    assert result(spelling_variants.variant_groups(frame(spark, [(w, n, "x", 1, 2, "f") for w, n in words.items()]))) == expected(words)


def test_edges(spark):
    rows = [("abcdef", 3, "x", 1, 2, "f"), ("abcdef", 4, "x", 1, 2, "f"), (None, 9, "x", 1, 2, "f"), ("abcdeg", 35, "x", 1, 2, "f"), ("abcdeh", 35, "x", 1, 2, "f")]
    got = result(spelling_variants.variant_groups(frame(spark, rows)))
    assert got == {"abcdef": ("abcdeg", "abcdeg", 7, 2, 35), "abcdeg": (None, "abcdeg", 35, 2, None), "abcdeh": (None, "abcdeh", 35, 2, None)}
    assert spelling_variants.variant_groups(frame(spark, rows[:1]).limit(0)).count() == 0


def test_vocabulary(spark):
    texts = [None, "", "Straße ÀBCDEF àbcdef short Words-words WORDS1words2wordsss × ÷", "wordss " * 50_000, "a" * 100_000 + " tail"]
    rows = [(i, t) for i, t in enumerate(texts * 6)] + [(None, texts[2])] * 5
    docs = spark.createDataFrame([(i, t, "x", 1) for i, t in rows], "doc_id long, text string, word string, n long")
    got = {r.word: r.n for r in spelling_variants.vocabulary(docs).collect()}
    assert got == words_of(rows)
    assert spelling_variants.vocabulary(docs.limit(0)).count() == 0


def test_query(spark):
    rows = [(r.doc_id, r.text) for r in table(spark, SF, "documents").collect()]
    assert result(spelling_variants.op12_spelling_variants(spark, SF)) == expected(words_of(rows))
