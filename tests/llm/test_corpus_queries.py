"""The registered corpus queries on the smallest tables: against DuckDB where SQL expresses them, and the pipeline end to end."""

import duckdb
import pytest

import corpus_pipeline
from strandline.llm import queries

SF = "/root/testdata/sf0.001"


@pytest.mark.parametrize("name", sorted(queries.ORACLES))
def test_sql(spark, name):
    con = duckdb.connect()
    for t in ("documents", "pages", "benchmark", "labels"):
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{SF}/{t}.parquet'")
    rel = con.sql(queries.ORACLES[name])
    names = sorted(rel.columns)
    want = [dict(zip(rel.columns, r, strict=True)) for r in rel.fetchall()]
    got = [r.asDict() for r in queries.QUERIES[name](spark, SF).collect()]
    rows = lambda data: sorted([tuple(r[n] for n in names) for r in data], key=repr)
    assert rows(got) == rows(want)


def test_pipeline(spark):
    assert [n for n, _ in corpus_pipeline.STAGES] == ["toxicity", "line_dedup", "near_dedup", "decontamination", "mixing"]
    out = corpus_pipeline.run(spark, SF)
    assert {"doc_id", "text", "lang", "source", "n_chars", "weight"} <= set(out.columns)
    assert 0 < out.count() < 200
