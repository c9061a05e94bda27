"""Near-duplicates over many partitions: the same components, by a bounded number of tasks."""

import random
import uuid

from strandline.llm import near_duplicates
from strandline.operators import graph

RNG = random.Random(88)


def word():
    return "".join(RNG.choice("abcdefghijklmnop") for _ in range(6))


def text(n=80):
    return " ".join(word() for _ in range(n))


def edited(base, n):
    w = base.split()
    for at in RNG.sample(range(len(w)), n):
        w[at] = word()
    return " ".join(w)


def shingles(t):
    w = t.lower().split()
    return {tuple(w[i : i + 5]) for i in range(len(w) - 4)} if len(w) >= 5 else ({tuple(w)} if w else set())


def components(rows):
    """The component of every doc_id; rows that repeat one are one document."""
    label = {i: i for i, _ in rows}
    sets = [(i, shingles(t)) for i, t in rows]
    links = [(i, j) for k, (i, a) in enumerate(sets) for j, b in sets[:k] if a and 100 * len(a & b) >= 85 * len(a | b)]
    for _ in rows:
        for i, j in links:
            label[i] = label[j] = min(label[i], label[j])
    return label


def tasks(spark, run):
    sc, group = spark.sparkContext, uuid.uuid4().hex
    sc.setJobGroup(group, "counted")
    try:
        out = run()
    finally:
        sc.setLocalProperty("spark.jobGroup.id", None)
    track = sc.statusTracker()
    stages = {s for j in track.getJobIdsForGroup(group) for s in track.getJobInfo(j).stageIds}
    found = [track.getStageInfo(s) for s in stages]
    return out, sum(s.numCompletedTasks for s in found if s)


def test_tasks_over_many_partitions(spark):
    base, other = text(), text()
    texts = [edited(base, RNG.randrange(3)) for _ in range(60)] + [base] * 30 + [edited(other, k % 2) for k in range(6)] + [text() for _ in range(40)]
    rows = list(enumerate(texts))
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(4)
    conf = {"spark.sql.shuffle.partitions": "61", "spark.sql.adaptive.coalescePartitions.enabled": "false"}
    before = {k: spark.conf.get(k) for k in conf}
    for k, v in conf.items():
        spark.conf.set(k, v)
    try:
        got, n = tasks(spark, lambda: near_duplicates.near_duplicates(docs).collect())
    finally:
        for k, v in before.items():
            spark.conf.set(k, v)
    assert {r.doc_id: r.component_id for r in got} == components(rows)
    assert n < 35 * 61  # 1693 tasks; 3205 when each step had shuffles of its own


def test_repeated_ids_keep_the_links_of_each_text(spark):
    a, b = text(), text()
    rows = [(5, a), (5, b), (7, edited(a, 1)), (8, edited(b, 1)), (9, text())]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    got = {r.doc_id: r.component_id for r in near_duplicates.near_duplicates(docs).collect()}
    assert got == components(rows) == {5: 5, 7: 5, 8: 5, 9: 9}


def test_stars_take_no_round(spark):
    stars = spark.createDataFrame([(3, 1), (1, 2), (9, 8), (4, 4), (None, 1)], "source long, target long")
    assert sorted(map(tuple, graph.star_edges(stars, max_rounds=1).collect())) == [(2, 1), (3, 1), (9, 8)]
    assert sorted(map(tuple, graph.min_labels(stars, max_rounds=1).collect())) == [(1, 1), (2, 1), (3, 1), (8, 8), (9, 8)]
