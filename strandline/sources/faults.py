"""Faults of a table, of all kinds at once, in one pass over its rows."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

SHOWN = 5


def find_faults(rows: DataFrame, wrong: dict[str, Column], repeated: dict[str, Column] | None = None, shown: int = SHOWN) -> tuple[int, dict[str, tuple[int, list[str]]]]:
    """The number of rows and, for each kind of fault that occurs, how many values have it and the first ``shown`` of them.

    ``wrong`` gives by kind what to show of a row, null where the row is right. ``repeated`` gives by kind a value that no two
    rows may share, null where a row is not asked. Kinds are in the order given and values sorted; a value that several rows show
    counts once. An empty table has no faults.

    The rows are read once, in one query: every row gives its values, which are counted by partial sums, so a value of very many
    rows is one row for each task. The first of each kind are picked in each task before any are moved, and the driver gets
    ``shown`` values of a kind, however many there are.
    """
    repeated = repeated or {}
    value = lambda kind, c: F.when(c.isNotNull(), F.struct(F.lit(kind).alias("kind"), c.cast("string").alias("value")))
    given = [value(f"{i:03d}", c) for i, c in enumerate([*wrong.values(), *repeated.values()])]
    every = F.struct(F.lit("rows").alias("kind"), F.lit("").alias("value"))
    each = rows.select(F.explode(F.array_compact(F.array(every, *given))).alias("x")).select("x.*")
    once = [f"{i:03d}" for i in range(len(wrong), len(given))]
    counts = each.groupBy("kind", "value").agg(F.count("*").alias("n"))
    faulty = counts.filter((F.col("n") > 1) | ~F.col("kind").isin(once) if once else F.lit(True))
    place = F.row_number().over(Window.partitionBy("kind").orderBy("value"))
    first = faulty.withColumn("place", place).filter(F.col("place") <= shown).select("kind", "value", "n")
    totals = faulty.groupBy("kind").agg(F.count("*").alias("n")).select("kind", F.lit(None).cast("string").alias("value"), "n")
    found = first.unionByName(totals).collect()
    n_rows = next((r["n"] for r in found if r["kind"] == "rows" and r["value"] is not None), 0)
    out = {}
    for i, kind in enumerate([*wrong, *repeated]):
        own = [r for r in found if r["kind"] == f"{i:03d}"]
        if own:
            out[kind] = (next(r["n"] for r in own if r["value"] is None), sorted(r["value"] for r in own if r["value"] is not None))
    return n_rows, out


def described(faults: dict[str, tuple[int, list[str]]]) -> str:
    """One line for a message: each kind with its first values and how many more there are."""
    more = lambda n, values: f" and {n - len(values)} more" if n > len(values) else ""
    return "; ".join(f"{kind}: {', '.join(values)}{more(n, values)}" for kind, (n, values) in faults.items())


def reject(rows: DataFrame, about: str, wrong: dict[str, Column], repeated: dict[str, Column] | None = None) -> int:
    """The number of rows; one ``ValueError`` with all kinds of faults where there are any."""
    n, found = find_faults(rows, wrong, repeated)
    if found:
        raise ValueError(f"{about}: {described(found)}")
    return n
