"""Sharding: against a dynamic programme over the ordered groups, and edge cases."""

import collections
import random
import zlib

import pytest
from pyspark.sql import functions as F

from strandline.llm import sharding
from strandline.session import table

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, at long, size long, shard string, n long, piece long"
SF = "/root/testdata/sf0.001"


def frame(spark, texts, ids=None):
    """Documents with columns whose names clash with the operator's own."""
    return spark.createDataFrame([(i, t, "en", "s", 1, 5, 6, "x", 7, 8) for i, t in zip(ids or range(len(texts)), texts, strict=True)], SCHEMA)


def size(t):
    return len((t or "").encode()) + 8


def best(sizes, shards):
    """The smallest largest sum of ``shards`` stretches, by dynamic programming."""
    ends = [0]
    for s in sizes:
        ends.append(ends[-1] + s)
    row = ends[:]
    for _ in range(shards - 1):
        row = [min(max(row[j], ends[i] - ends[j]) for j in range(i + 1)) for i in range(len(ends))]
    return row[-1]


def ordered_groups(spark, docs):
    """Bytes of each group of equal texts in the operator's order."""
    rows = docs.select(sharding.order_key().alias("k"), F.coalesce("text", F.lit("")).alias("t")).collect()
    held = collections.defaultdict(int)
    for r in rows:
        held[r.k] += size(r.t)
    return [held[k] for k in sorted(held)]


def check_rows(rows, texts, shards):
    """Every row once, with its own values, equal texts together and slots without gaps."""
    assert collections.Counter(r.doc_id for r in rows) == collections.Counter(i for i, _ in texts)
    by_id = collections.defaultdict(list)
    for i, t in texts:
        by_id[i].append((size(t), zlib.crc32((t or "").encode())))
    assert all((r["size"], r.text_crc32) in by_id[r.doc_id] for r in rows)
    slots, home = collections.defaultdict(list), collections.defaultdict(set)
    for r in rows:
        slots[r.shard].append(r.slot)
        home[r["size"], r.text_crc32].add(r.shard)
    assert all(sorted(s) == list(range(len(s))) for s in slots.values())
    assert all(len(h) == 1 for h in home.values())
    assert set(slots) <= set(range(shards))
    loads = collections.Counter()
    for r in rows:
        loads[r.shard] += r["size"]
    return loads


@pytest.mark.parametrize("shards", [1, 2, 5, 24])
@pytest.mark.parametrize("bits", [2, 12])
def test_smallest_capacity(spark, monkeypatch, shards, bits):
    monkeypatch.setattr(sharding, "FIRST_BITS", bits)
    rng = random.Random(shards)
    texts = ["x" * rng.randint(0, 60) + str(i) for i in range(150)]
    texts += rng.choices(texts, k=60)
    docs = frame(spark, texts)
    loads = check_rows(sharding.assign(docs, shards).collect(), list(enumerate(texts)), shards)
    assert max(loads.values()) == best(ordered_groups(spark, docs), shards)
    assert len(loads) == shards and min(loads.values()) > 0


def test_groups_above_a_share_stand_alone(spark):
    texts = ["giant " * 40] * 60 + ["large " * 30] * 12 + [f"text {i}" for i in range(300)]
    docs = frame(spark, texts)
    plan = sharding.plan_shards(docs, 8)
    assert len(plan.own) == 2
    loads = check_rows(sharding.assign(docs, 8).collect(), list(enumerate(texts)), 8)
    assert loads[0] == 60 * size(texts[0]) and loads[1] == 12 * size(texts[60])
    rest = [x for x in ordered_groups(spark, docs) if x not in (loads[0], loads[1])]
    assert max(loads[i] for i in range(2, 8)) == best(rest, 6)


def test_edges(spark):
    texts = [None, "", "same", "same", "é" * 200_000, " ", None]
    ids = [0, 1, 2, 2, None, 5, None]
    docs = frame(spark, texts, ids)
    rows = sharding.assign(docs, 3).collect()
    check_rows(rows, list(zip(ids, texts, strict=True)), 3)
    assert {r.shard for r in rows if r["size"] == 8} == {next(r.shard for r in rows if r.doc_id == 0)}
    assert sharding.assign(docs.limit(0), 3).count() == 0
    assert {r.shard for r in sharding.assign(frame(spark, ["one"] * 5), 4).collect()} <= {0, 1, 2, 3}
    with pytest.raises(ValueError):
        sharding.plan_shards(docs, 0)


def test_written_shards_hold_the_texts(spark, tmp_path):
    docs = frame(spark, [f"text {i} " * (i % 7) for i in range(80)])
    sharding.write_shards(docs, str(tmp_path / "out"), 4, files=2)
    back = spark.read.parquet(str(tmp_path / "out"))
    assert sorted(map(tuple, back.select("doc_id", "text").collect())) == sorted(map(tuple, docs.select("doc_id", "text").collect()))
    assert {(r.doc_id, r.shard) for r in back.collect()} == {(r.doc_id, r.shard) for r in sharding.assign(docs, 4).collect()}


def test_query(spark):
    rows = sharding.op11_sharding(spark, SF).collect()
    docs = table(spark, SF, "documents")
    loads = check_rows(rows, [(r.doc_id, r.text) for r in docs.collect()], 24)
    assert {r.law for r in rows} == {"bytes"} and {r.grown_shard for r in rows} == {None}
    largest = max(ordered_groups(spark, docs))
    assert len(loads) == 24 and max(loads.values()) <= sum(loads.values()) / 24 + largest
