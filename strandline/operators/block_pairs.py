"""Blocks of rows that meet two at a time: each is written once and read for every other one, so that no copies are shuffled."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from strandline.session import materialise

#: Blocks are written to so many files at most; two files meet in one task.
MOST_FILES = 32


def written_blocks(rows: DataFrame, keys: list[str], blocks: int) -> DataFrame:
    """``keys`` and ``rows``, the other columns of about so many blocks as one array each."""
    own = [c for c in rows.columns if c not in keys]
    dealt = rows.repartition(max(1, min(blocks, MOST_FILES)), *keys)
    return materialise(dealt.groupBy(*keys).agg(F.collect_list(F.struct(*own)).alias("rows")), "blocks")


def met_blocks(left: DataFrame, right: DataFrame, on: Column, keys: list[Column]) -> DataFrame:
    """``keys, one, two``: the rows of two blocks ``a, b`` that ``on`` lets meet. Spark reads the files of one side for each of the other."""
    return left.alias("a").hint("shuffle_replicate_nl").join(right.alias("b"), on).select(*keys, F.col("a.rows").alias("one"), F.col("b.rows").alias("two"))


def cell_tables(t: pa.RecordBatch) -> Iterator[tuple[int, pa.Table, np.ndarray]]:
    """For each two blocks of ``t``: its place, the rows of both, and which block each is of; if ``same`` is true the block is taken once."""
    for j in range(t.num_rows):
        sides = [t[c][j].values for c in (("one",) if t["same"][j].as_py() else ("one", "two"))]
        parts = [pa.Table.from_arrays(s.flatten(), names=[f.name for f in s.type]) for s in sides]
        yield j, pa.concat_tables(parts), np.repeat(np.arange(len(parts)), [len(s) for s in sides])
