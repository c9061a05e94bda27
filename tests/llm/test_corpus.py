"""Corpus operators against brute force on small inputs, with nulls, empty texts, ties, repeats and clashing columns."""

import collections
import itertools
import math
import random
import re

import pytest
from pyspark.sql import functions as F

from strandline.llm import decontamination, language_id, line_windows, near_duplicates, personal_data, repeated_passages, toxicity, url_filter, weighted_fingerprints

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, key long, n long, label string, block long"
RNG = random.Random(11)


def word():
    return "".join(RNG.choice("abcdefghijklmnop") for _ in range(RNG.randint(3, 8)))


def frame(spark, texts, langs=None):
    """Documents with columns whose names clash with the operators' own."""
    rows = [(i, t, (langs or ["en"] * len(texts))[i], f"s{i % 3}", len(t or ""), 1, 2, "x", 3) for i, t in enumerate(texts)]
    return spark.createDataFrame(rows, SCHEMA)


EDGES = [None, "", " \t\n", "one two", "one two", "a" * 5000, "x y z " * 3000]


def tokens(t):
    return re.findall(r"[^\x20\x09-\x0d]+", re.sub("[A-Z]", lambda m: m[0].lower(), t or ""))


def shingles(t):
    w = tokens(t)
    return {tuple(w[i : i + 5]) for i in range(len(w) - 4)} if len(w) >= 5 else ({tuple(w)} if w else set())


def edited(base, n):
    w = base.split()
    for _ in range(n):
        w[RNG.randrange(len(w))] = word()
    return " ".join(w)


def test_near_duplicates_brute_force(spark):
    bases = [" ".join(word() for _ in range(120)) for _ in range(4)]
    texts = EDGES + [edited(b, k) for b in bases for k in (0, 0, 1, 1, 2, 2, 3)] + [edited(bases[0], 1) for _ in range(40)] + [word() for _ in range(5)]
    sets = [shingles(t) for t in texts]
    label = list(range(len(texts)))
    for _ in texts:
        for a, b in itertools.combinations(range(len(texts)), 2):
            if sets[a] and sets[b] and 100 * len(sets[a] & sets[b]) >= 85 * len(sets[a] | sets[b]):
                label[a] = label[b] = min(label[a], label[b])
    got = {r.doc_id: r for r in near_duplicates.near_duplicates(frame(spark, texts), small=4).collect()}
    assert {i: got[i].component_id for i in got} == dict(enumerate(label))
    assert all(got[i].n_shingles == len(s) and got[i].kept == (label[i] == i) for i, s in enumerate(sets))
    assert near_duplicates.near_duplicates(frame(spark, ["x"]).limit(0)).count() == 0


def test_repeated_passages_brute_force(spark):
    shared = " ".join(word() for _ in range(60))
    fill = lambda n: " ".join(word() for _ in range(n))
    texts = EDGES + [fill(30) + " " + shared + " " + fill(10), shared + " " + fill(70), fill(55) + " " + " ".join(shared.split()[:52]), fill(90), fill(40) + " " + " ".join(shared.split()[5:54])]
    at = collections.defaultdict(list)
    for i, t in enumerate(texts):
        w = tokens(t)
        for p in range(len(w) - 49):
            at[tuple(w[p : p + 50])].append((i, p))
    covered = collections.defaultdict(set)
    for places in at.values():
        if len(places) > 1:
            for i, p in places:
                covered[i] |= set(range(p, p + 50))
    got = {r.doc_id: r.spans for r in repeated_passages.repeated_passages(frame(spark, texts)).collect()}
    want = {}
    for i, c in covered.items():
        runs = []
        for p in sorted(c):
            if runs and p == runs[-1][1]:
                runs[-1][1] = p + 1
            else:
                runs.append([p, p + 1])
        want[i] = ",".join(f"{a}-{b}" for a, b in runs)
    assert got == want
    assert repeated_passages.repeated_passages(frame(spark, ["x"]).limit(0)).count() == 0


def test_repeated_passages_of_repeated_rows(spark):
    rng = random.Random(3)
    fill = lambda n: " ".join(str(rng.random()) for _ in range(n))
    one, two = fill(70), f"\u00c4B\u0130 {fill(60)}"
    rows = [(1, one), (1, one), (None, two), (None, two), (2, two), (3, f"x\v{two.upper()}\f\r\n\ty"), (4, f"{fill(30)} {one.replace(' ', chr(160))}"), (5, f"{fill(9)} {' '.join(one.split()[:49])} {fill(9)}")]
    docs = spark.createDataFrame(rows, "doc_id long, text string").withColumn("words", F.lit("x")).withColumn("key", F.lit(1))
    # a row without doc_id is no occurrence; letters beyond A-Z keep their case, so only what follows them is common
    want = {1: "0-70", 2: "0-61", 3: "1-62"}
    assert {r.doc_id: r.spans for r in repeated_passages.repeated_passages(docs).collect()} == want


def test_line_windows(spark):
    texts = [None, "", "a\nb\nc\nd", "z\na\nb\nc\nd", "a\nb\nc", "\n\n\n\n", "b\nc\nd\na\nb\nc", "a\nb"]
    seen, want = set(), []
    for t in texts:
        lines = t.split("\n") if t is not None else []
        gone = set()
        for i in range(len(lines) - 2):
            w = tuple(lines[i : i + 3])
            if any(x.strip() for x in w):
                if w in seen:
                    gone |= {i, i + 1, i + 2}
                seen.add(w)
        want.append((None if t is None else "\n".join(x for i, x in enumerate(lines) if i not in gone), len(gone)))
    got = {r.doc_id: (r.text, r.n_removed) for r in line_windows.dedup_lines(frame(spark, texts)).collect()}
    assert [got[i] for i in range(len(texts))] == want


def test_fingerprints(spark):
    texts = EDGES[:5] + [" ".join(word() for _ in range(80)) for _ in range(3)]
    texts += [edited(texts[-1], 10), texts[-1]]
    got = sorted(weighted_fingerprints.compare_fingerprints(frame(spark, texts)).collect(), key=lambda r: r.doc_id)
    assert [r.n_chars for r in got] == [len(t or "") for t in texts]
    by_text = collections.defaultdict(set)
    for r in got:
        by_text[texts[r.doc_id] or ""].add(r.fingerprint)
    assert all(len(x) == 1 for x in by_text.values())
    weight = lambda s: sum(map(len, s))
    a, b = set(texts[7].split()), set(texts[8].split())
    assert got[7].near_next == pytest.approx(weight(a & b) / weight(a | b), abs=0.3)
    assert got[5].near_next < 0.2
    alone = weighted_fingerprints.compare_fingerprints(frame(spark, ["just one text"])).first()
    assert alone.near_next == 1.0


def test_personal_data_base_spans(spark):
    texts = [*EDGES[:6], "mail a.b@c.example.com, x@y, 10.0.0.1 and 999.1.1.1", "4111 1111 1111 1111 then +1 (555) 555-1234.", "call +1 (226) 555-7713 or 4465758382889437 4465758382889437 ok", "1 " * 4000]
    got = {r.doc_id: r for r in personal_data.find_personal_data(frame(spark, texts)).collect()}
    assert (got[6].n_email, got[6].n_ip, got[7].n_card, got[7].n_phone) == (1, 1, 1, 1)
    start = texts[7].index("4111")
    assert f"card:{start}:{start + 19}" in got[7].spans
    assert got[8].n_card == 0 and all(got[i].spans == "" for i in range(6))


def test_url_filter(spark):
    urls = [None, "nonsense", "HTTP://WWW.Example.COM/en/1?x", "https://example.com/en", "http://a.example.net/es/#t", "http://notexample.com/en/", "http://example.org/", "http://net"]
    pages = spark.createDataFrame([(i, u, "x", "y") for i, u in enumerate(urls)], "page_id long, url string, rule string, host string")
    got = {r.page_id: (r.rule, r.verdict) for r in url_filter.judge(pages, url_filter.rule_table(spark)).collect()}
    assert got == {0: (None, "allow"), 1: (None, "allow"), 2: ("www.example.com/en/", "allow"), 3: ("com/", "allow"), 4: ("net/es/", "block"), 5: ("com/", "allow"), 6: (None, "allow"), 7: (None, "allow")}
    many = spark.createDataFrame([("block", f"h{i}.example.org", "/") for i in range(3000)], "verdict string, host string, path string")
    assert {r.verdict for r in url_filter.judge(spark.createDataFrame([(1, "http://x.h7.example.org/a")], "page_id long, url string"), many).collect()} == {"block"}


def test_decontamination_finds_paraphrases(spark):
    items = [" ".join(word() for _ in range(40)) for _ in range(6)]
    fill = lambda: " ".join(word() for _ in range(100))
    clean = [fill() for _ in range(300)]
    leaks = [fill() + " " + items[0] + " " + fill(), edited(items[1], 5), fill() + " " + edited(items[2], 8).upper()]
    docs = frame(spark, EDGES + clean + leaks)
    bench = spark.createDataFrame([*enumerate(items), (6, None), (7, "")], "item_id long, text string")
    got = {(r.doc_id, r.item_id) for r in decontamination.find_leaks(docs, bench).collect()}
    first = len(EDGES) + len(clean)
    assert got == {(first, 0), (first + 1, 1), (first + 2, 2)}
    assert decontamination.drop_leaks(docs, bench).count() == first
    assert decontamination.find_leaks(docs, bench.limit(0)).count() == 0
    assert decontamination.common_subsequence(decontamination._masks(__import__("numpy").array([1, 2, 3, 4])), 4, [2, 9, 4]) == 2


def test_language_and_toxicity(spark):
    de = lambda: " ".join("und der sch" + word()[:2] + "ung" for _ in range(30))
    fr = lambda: " ".join("les aux eau" + word()[:2] + "que" for _ in range(30))
    texts = [de() for _ in range(40)] + [fr() for _ in range(40)] + [None, "", "123 !?"]
    docs = frame(spark, texts, ["de"] * 40 + ["fr"] * 40 + [None] * 3)
    model = language_id.fit(docs.filter("doc_id % 2 = 0"))
    got = {r.doc_id: r for r in language_id.predict(docs, model).collect()}
    assert all(got[i].lang_pred == ("de" if i < 40 else "fr") for i in range(80)) and {got[i].lang_pred for i in (80, 81, 82)} == {"und"}
    bad = [f"{de()} vilething {fr()}" for _ in range(60)]
    good = [f"{de()} {fr()}" for _ in range(120)]
    rows = frame(spark, bad + good + [None, ""]).withColumn("toxic", F.when(F.col("doc_id") < 60, 1).otherwise(0))
    net = toxicity.fit(rows.filter("doc_id % 3 <> 0"))
    score = {r.doc_id: r.score for r in toxicity.score(rows, net).collect()}
    wrong = sum((score[i] >= 0.5) != (i < 60) for i in range(0, 180, 3))
    assert wrong <= 4 and all(0 <= s <= 1 for s in score.values())
    assert toxicity.fit(rows.limit(0)).scores(__import__("pyarrow").array(["x"]))[0] < 0.5


def test_decontamination_basis_is_of_all_documents(spark):
    """The basis of one feature direction follows every document, so that more than a drawn part of them counts."""
    items = [f"alpha{i} beta{i} gamma{i} delta{i} common words here" for i in range(6)]
    bench = spark.createDataFrame(list(enumerate(items)), "item_id long, text string")
    rng = __import__("random").Random(3)
    texts = [" ".join(rng.choice(items).split()[::-1]) for _ in range(2500)]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    held = decontamination._prepared(docs, bench)[0]
    basis = decontamination.latent_basis(docs, held, rank=1)[:, 0]
    a = [[float(held.idf[j]) * text.split().count(w) for j, w in enumerate(held_words)] for held_words in [_spelled(held, items)] for text in texts + items]
    first = __import__("numpy").linalg.svd(__import__("numpy").array(a), full_matrices=False)[2][0]
    assert abs(abs(float(first @ basis)) - 1) < 1e-3


def _spelled(held, items):
    """The word behind each place of the vocabulary."""
    pa = __import__("pyarrow")
    word = {int(decontamination._hashes(pa.array([w]))[0][0]): w for text in items for w in text.split()}
    return [word[int(h)] for h in held.vocabulary]


def test_decontamination_finds_items_of_common_words(spark):
    items = [" ".join(word() for _ in range(40)) for _ in range(3)]
    usual = [word() for _ in range(30)]
    items.append(" ".join(RNG.choice(usual) for _ in range(40)))
    fill = lambda: " ".join([*(word() for _ in range(70)), *RNG.sample(usual, 30)])
    clean = [fill() for _ in range(200)]
    leaks = [(i, f"{fill()} {items[i]} {fill()}") for i, n in ((0, 60), (1, 12), (2, 1), (3, 5)) for _ in range(n)]
    bench = spark.createDataFrame([*enumerate(items)], "item_id long, text string")
    found = lambda texts: {(r.doc_id, r.item_id) for r in decontamination.find_leaks(frame(spark, texts), bench).collect()}
    assert found(clean + [t for _, t in leaks]) == {(len(clean) + i, item) for i, (item, _) in enumerate(leaks)}
    assert found([leaks[0][1]] * 2) == {(0, 0), (1, 0)} and found([leaks[0][1]]) == {(0, 0)}


def test_decontamination_finds_long_items(spark):
    items = [" ".join(word() for _ in range(n)) for n in (300, 1000, 65, 30, 300, 1000)]
    fill = lambda n=100: " ".join(word() for _ in range(n))
    clean = [fill() for _ in range(300)]
    leaks = [(i, f"{fill(n)} {items[i]} {fill()}") for i in range(4) for n in (7, 100)]
    leaks += [(i, f"{fill(55)} {edited(items[i], len(items[i].split()) // 5)} {fill()}") for i in (4, 5)]
    bench = spark.createDataFrame([*enumerate(items)], "item_id long, text string")
    got = {(r.doc_id, r.item_id) for r in decontamination.find_leaks(frame(spark, clean + [t for _, t in leaks]), bench).collect()}
    assert got == {(len(clean) + i, item) for i, (item, _) in enumerate(leaks)}


def test_toxicity_calibrates_on_all_rows(spark):
    fill = lambda: " ".join(RNG.choice(["alpha", "beta", "gamma", "delta", "mu", "nu"]) for _ in range(12))
    texts = [f"{fill()} {bad} {fill()} {i}" for i, bad in enumerate(["vile"] * 60 + ["vile foul"] * 60 + ["vile"] * 240 + ["mild"] * 700)]
    rows = frame(spark, texts, [("en", "fr")[i % 2] for i in range(len(texts))]).withColumn("toxic", (F.col("doc_id") < 120).cast("int"))
    net = toxicity.fit(rows, sample=200, steps=80)
    aside = rows.filter(F.shiftrightunsigned(F.xxhash64("text"), 7) % 5 == 0).select("text", "lang", "toxic").toArrow()
    logit, y, lang = net.logits(aside["text"].combine_chunks()), aside["toxic"].to_numpy(), aside["lang"].to_numpy(zero_copy_only=False)

    def f1(cut, own):
        hit = logit[own] >= cut
        return 2 * (hit & (y[own] == 1)).sum() / (hit.sum() + y[own].sum())

    for own, cut in ((lang != "", net.shift), *((lang == x, net.shift + math.log(t / (1 - t))) for x, t in net.thresholds.items())):
        assert f1(cut, own) >= max(f1(c, own) for c in logit[own]) - 0.02
    assert set(net.thresholds) == {"en", "fr"}


def test_fingerprints_count_words(spark):
    base = [word() for _ in range(40)]
    texts = [" ".join(w for w in base for _ in range(RNG.choice([1, 1, 2, 6, 20]))) for _ in range(12)] + [" ".join(base), " ".join(base[:20] * 10 + base[20:])]
    rows = sorted(weighted_fingerprints.compare_fingerprints(frame(spark, texts)).collect())

    def exact(a, b):
        x, y = (collections.Counter(t.split()) for t in (a, b))
        return sum(len(w) * n for w, n in (x & y).items()) / sum(len(w) * n for w, n in (x | y).items())

    wrong = []
    for i, t in enumerate(texts):
        after, half = texts[(i + 1) % len(texts)], len(t) // 2
        wrong += [rows[i].near_next - exact(t, after), rows[i].near_edited - exact(t, t[: len(t) - half] + after[:half])]
    assert max(map(abs, wrong)) < 0.3 and sum(map(abs, wrong)) / len(wrong) < 0.1


def test_cards_of_single_parted_digits(spark):
    cards = [sep.join("4111111111111111") for sep in (" ", "-")]
    got = sorted(personal_data.find_personal_data(frame(spark, [*cards, f"x {cards[0]}, y", "1 2", "no 7"])).collect())
    assert [r.n_card for r in got] == [1, 1, 1, 0, 0]
    assert [r.spans for r in got] == ["card:0:31", "card:0:31", "card:2:33", "", ""]


def test_decontamination_in_blocks_with_answers_and_repeats(spark, monkeypatch):
    items = [" ".join(word() for _ in range(30)) for _ in range(12)]
    fill = lambda: " ".join(word() for _ in range(80))
    leaks = [f"{fill()} {x} {fill()}" for x in items]
    clean = [None, "", *(fill() for _ in range(100))]
    rows = [(i, x, x.split()[0] if i % 2 else None) for i, x in enumerate(items)] + [(0, items[0], None), (50, " ", "x")]
    bench = spark.createDataFrame(rows, "item_id long, text string, answer string")
    docs = frame(spark, clean + leaks)
    want = {(len(clean) + i, i) for i in range(12)}
    for size in (20_000, 5):
        monkeypatch.setattr(decontamination, "BLOCK_ITEMS", size)
        assert {(r.doc_id, r.item_id) for r in decontamination.find_leaks(docs, bench).collect()} == want
        assert decontamination.drop_leaks(docs.unionByName(docs), bench).count() == 2 * len(clean)
    assert decontamination.find_leaks(docs.limit(0), bench).count() == 0 and decontamination.drop_leaks(docs.limit(0), bench).count() == 0
