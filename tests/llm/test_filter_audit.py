"""The filter audit: against filters applied one after the other in plain Python, and edge cases."""

import collections
import itertools
import random
import re

from strandline.llm import filter_audit


def failures(rows):
    """The failed filters of each (doc_id, text, lang)."""
    least = {}
    for i, t, _ in rows:
        if i is not None:
            least[t or ""] = min(least.get(t or "", i), i)
    out = []
    for i, t, _ in rows:
        t = t or ""
        w = re.findall(r"[^\x20\x09-\x0d]+", t)
        out.append("".join(f for f, bad in zip("ABCDE", (len(w) < 100, 100 * len(set(w)) < 80 * len(w), 100 * len(re.findall("[A-Z]", t)) > 10 * len(t), bool(re.search("[#$%&*|]", t)), i is not None and i > least[t]), strict=True) if bad))
    return out


def expected(rows, labels):
    """``(part, order, step): counts`` by walking through every order."""
    good, bad = {i for i, q, _ in labels if q == 1} - {None}, {i for i, _, t in labels if t == 1} - {None}
    fails = failures(rows)
    out, shapley = {}, collections.Counter()
    for part in {r[2] or "" for r in rows}:
        mine = [(r[0], f) for r, f in zip(rows, fails, strict=True) if (r[2] or "") == part]
        for order in map("".join, itertools.permutations("ABCDE")):
            left = mine
            for step, f in enumerate(order, 1):
                gone = [x for x in left if f in x[1]]
                left = [x for x in left if f not in x[1]]
                redundant = sum(f in x[1] for x in mine) - len(gone)
                out[part, order, step] = [len(left), len(gone), redundant, sum(x[1] == f for x in mine), sum(x[0] in good for x in gone), sum(x[0] in bad for x in gone)]
                shapley[part, f] += len(gone)
    return {k: (*v, shapley[k[0], k[1][k[2] - 1]]) for k, v in out.items()}


def result(df):
    rows = df.collect()
    out = {(r.part, r.filter_order, r.step): (r.kept, r.removed, r.redundant, r.unique_fails, r.good_lost, r.toxic_lost, r.shapley) for r in rows}
    assert len(out) == len(rows)
    return out


def frames(spark, rows, labels):
    docs = spark.createDataFrame([(*r, "s", 1, 2, True) for r in rows], "doc_id long, text string, lang string, source string, mask long, n long, known boolean")
    return docs, spark.createDataFrame([(*x, 3) for x in labels], "doc_id long, quality int, toxic int, key long")


def test_every_order(spark):
    rng = random.Random(3)
    make = lambda: " ".join(rng.choice([str(rng.randint(0, 10**6)), "Same", "LOUD", "word"] + ["#x"] * rng.choice([0, 0, 1])) for _ in range(rng.choice([0, 3, 99, 100, 101, 150])))
    texts = [make() for _ in range(60)]
    plain = [" ".join(f"w{i}x{j}" for j in range(100)) for i in range(20)]
    rows = [(i, rng.choice(texts + plain * 2), rng.choice(["en", "de", None, ""])) for i in range(300)]
    labels = [(i, rng.choice([0, 1, None]), rng.choice([0, 1, None])) for i in range(0, 300, 2)]
    assert result(filter_audit.audit(*frames(spark, rows, labels))) == expected(rows, labels)


def test_edges(spark):
    rows = [(5, None, "en"), (1, "", "de"), (5, None, "en"), (None, "", "en"), (None, None, None), (7, "x " * 60_000, "en"), (9, "é É " * 100, "en"), (1, "", "de"), (3, "\t\n\x0b\x0c\r ", "fr")]
    labels = [(5, 1, 0), (5, 0, 1), (None, 1, 1), (1, None, None), (99, 1, 1)]
    got = result(filter_audit.audit(*frames(spark, rows, labels)))
    assert got == expected(rows, labels)
    assert len(got) == 4 * 600
    docs, marks = frames(spark, rows, labels)
    assert filter_audit.audit(docs.limit(0), marks).count() == 0
    assert result(filter_audit.audit(docs, marks.limit(0))) == expected(rows, [])
