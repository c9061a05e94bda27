"""Mixing sources to target weights by iterative proportional fitting (raking).

Tokens are summed into cells of source, language and topic; the cells are then scaled in turn to each target marginal until
all three hold. A document's calibrated probability is its cell's factor times a rate, by default the largest rate at which
no probability exceeds 1, so the tokens of the documents drawn meet the targets themselves. Only DataFrame functions are used.
"""

from __future__ import annotations

import warnings

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from strandline.session import discard, materialise, table

MARGINS = ("source", "lang", "topic")
#: Declared shares of ``op2_raking`` and the pipeline; sources and topics are tempered.
TARGETS = {"lang": {"en": 0.45, "de": 0.2, "fr": 0.2, "es": 0.15}}
TEMPER = 0.9
TOLERANCE = 1e-9
MOST_ROUNDS = 60
#: Targets conflict if, after the first rounds, a round brings the marginals less than this share nearer.
FIRST_ROUNDS, LEAST_GAIN = 4, 1e-3
#: Cells of up to this many bytes are joined by broadcast; more are joined by a shuffle.
BROADCAST_BYTES = 32 << 20
#: Up to so many cells are fitted as one row of arrays; more are fitted by sums and joins.
FIT_CELLS = 20_000
SQL_ROUNDS = 30

#: The topic of a text by its composition, read from all of it: mostly figures, marks or capitals, else its extent.
TOPIC = """CASE WHEN coalesce(text, '') = '' THEN '(none)'
 WHEN {count}(text, '[0-9]') > 0.1 * length(text) THEN 'figures'
 WHEN {count}(text, '[!-/:-@\\[-`{{-~]') > 0.1 * length(text) THEN 'marks'
 WHEN {count}(text, '[A-Z]') > 0.2 * length(text) THEN 'capitals'
 WHEN length(text) >= 4000 THEN 'long prose' WHEN length(text) < 300 THEN 'short prose' ELSE 'prose' END"""
SPARK_TOPIC = TOPIC.replace("\\", "\\\\").format(count="regexp_count")


def _labelled(docs: DataFrame, topic: str) -> DataFrame:
    """Each document's ``source, lang, topic, tokens``, and its ``row`` as one struct, so that the caller's columns clash with none."""
    name = lambda c: F.coalesce(F.col(c).cast("string"), F.lit("(none)"))
    return docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row"), name("source").alias("source"), name("lang").alias("lang"), F.coalesce(F.expr(topic), F.lit("(none)")).alias("topic"), _tokens().alias("tokens"))


def _tokens():
    return F.coalesce(F.regexp_count("text", F.lit(r"[^\x20\x09-\x0D]+")), F.lit(0)).cast("long")


def _goals(cells: DataFrame, targets: dict[str, dict[str, float]], temper: float) -> dict[str, DataFrame]:
    """``value, goal`` by margin: the tokens that every value is to have."""
    out = {}
    for m in MARGINS:
        held = cells.groupBy(m).agg(F.sum("w").alias("own"))
        if m in targets:
            pairs = [x for k, v in targets[m].items() for x in (F.lit(k), F.lit(float(v)))]
            held = held.withColumn("given", F.element_at(F.create_map(*pairs), F.col(m)) if pairs else F.lit(None).cast("double"))
            ends = held.agg(F.sum("own").alias("total"), F.coalesce(F.sum(F.when(F.col("given").isNull(), F.col("own"))), F.lit(0.0)).alias("rest"), F.sum("given").alias("given_sum"))
            goal = F.when(F.col("given").isNull(), F.col("own")).otherwise(F.col("given") / F.when(F.col("given_sum") > 0, F.col("given_sum")) * (F.col("total") - F.col("rest")))
        else:
            ends = held.agg(F.sum("own").alias("total"), F.sum(F.pow("own", F.lit(temper))).alias("powers"))
            goal = F.pow("own", F.lit(temper)) / F.col("powers") * F.col("total")
        out[m] = held.join(F.broadcast(ends)).select(m, F.coalesce(goal, F.lit(0.0)).alias("goal"))
    return out


def rake(cells: DataFrame, targets: dict[str, dict[str, float]] | None = None, temper: float = TEMPER, tolerance: float = TOLERANCE, rounds: int = MOST_ROUNDS, strict: bool = True) -> DataFrame:
    """``source, lang, topic, tokens, factor``: factor times tokens meets the target share of every marginal.

    ``targets`` gives shares by value for a marginal. A value without one keeps its own share, and those given divide the
    rest; values that no cell has are left out. A marginal without an entry gets shares in proportion to its tokens to the
    power ``temper``. Cells without tokens are left out, an empty table gives none.

    Rounds go on until no marginal is off by more than ``tolerance``, as a share of its goal. Targets that are not met after
    ``rounds`` of them, or that conflict, as when the cells that would be needed do not exist, are an error; without
    ``strict`` they are a warning, and the last round's factors, which meet the topics' targets, are returned.

    Up to ``FIT_CELLS`` cells, of a size that their count bounds, are fitted as one row; more of them stay distributed.
    """
    at = materialise(cells.filter("tokens > 0").select(*MARGINS, "tokens", F.col("tokens").cast("double").alias("w")), "cells")
    goals = _goals(at, targets or {}, temper)
    few = at.count() <= FIT_CELLS
    at, off, n = _fitted_row(at, goals, tolerance, rounds) if few else _fitted_rounds(at, goals, tolerance, rounds)
    if off > tolerance:
        missed = f"the targets were not met in {n} rounds; a marginal is still off by {off:.3g}"
        if strict:
            raise RuntimeError(missed)
        warnings.warn(missed, stacklevel=2)
    return at.select(*MARGINS, "tokens", (F.col("w") / F.col("tokens")).alias("factor"))


def _fitted_row(at: DataFrame, goals: dict[str, DataFrame], tolerance: float, rounds: int) -> tuple[DataFrame, float, int]:
    """The cells with their weights after the fit, how far a marginal is off, and the rounds taken; all rounds are one expression.

    Each marginal keeps the lists of its values' cells, so a step is a sum over each list and a product for each cell.
    """
    rows = at
    for m in MARGINS:
        rows = rows.join(goals[m].withColumnRenamed("goal", f"goal_{m}"), m)
    rows = rows.withColumn("i", F.row_number().over(Window.orderBy(*MARGINS)))
    rows = rows.withColumns({f"of_{m}": F.dense_rank().over(Window.orderBy(m)) for m in MARGINS})
    rows = materialise(rows, "numbered")
    column = lambda c: F.transform("r", lambda x: x[c])
    whole = rows.groupBy().agg(F.sort_array(F.collect_list(F.struct("i", *MARGINS, "tokens", "w", *[f"{x}_{m}" for m in MARGINS for x in ("goal", "of")]))).alias("r"))
    whole = whole.select(F.lit(1).alias("one"), "r", column("w").alias("w"), *[column(f"{x}_{m}").alias(f"{x}_{m}") for m in MARGINS for x in ("goal", "of")])
    for m in MARGINS:
        lists = rows.groupBy(f"of_{m}").agg(F.collect_list("i").alias("l")).groupBy().agg(F.sort_array(F.collect_list(F.struct(f"of_{m}", F.sort_array("l").alias("l")))).alias("x"))
        whole = whole.join(lists.select(F.lit(1).alias("one"), F.transform("x", lambda x: x["l"]).alias(f"lists_{m}")), "one")
    # transform(array(x), name -> y)[0] computes x once and names it
    held = "transform(lists_{m}, l -> aggregate(l, 0D, (a, i) -> a + w[i - 1]))"
    by = "transform(of_{m}, (o, i) -> if(held[o - 1] > 0, goal_{m}[i] / held[o - 1], 0D))"
    scaled = "struct(zip_with(w, by, (x, y) -> x * y) AS w, array_max(zip_with(w, by, (x, y) -> if(x * y > 0, abs(y - 1), 0D))) AS off)"
    bind = lambda x, name, y: f"transform(array({x}), {name} -> {y})[0]"
    off = f"greatest({', '.join(f'after_{m}.off' for m in MARGINS)})"
    turn = f"struct(after_{MARGINS[-1]}.w AS w, {off} AS off, s.n + 1 AS n, s.n >= {FIRST_ROUNDS} AND {off} > s.off * {1 - LEAST_GAIN!r}D AS stuck)"
    for m, before in reversed([*zip(MARGINS, ["s.w", *(f"after_{m}.w" for m in MARGINS)], strict=False)]):
        turn = bind(bind(before, "w", bind(held.format(m=m), "held", bind(by.format(m=m), "by", scaled))), f"after_{m}", turn)
    loop = f"aggregate(sequence(1, {rounds}), struct(w AS w, double('infinity') AS off, 0 AS n, false AS stuck), (s, k) -> if(s.off <= {tolerance!r}D OR s.stuck, s, {turn}))"
    done = materialise(whole.select("r", F.expr(loop).alias("s")), "fitted")
    off, n = done.select("s.off", "s.n").first()
    each = done.select(F.explode(F.arrays_zip("r", F.col("s.w").alias("w"))).alias("c")).select(*[F.col(f"c.r.{c}").alias(c) for c in (*MARGINS, "tokens")], F.col("c.w").alias("w"))
    return each, off if n and at.limit(1).count() else 0.0, n


def _fitted_rounds(at: DataFrame, goals: dict[str, DataFrame], tolerance: float, rounds: int) -> tuple[DataFrame, float, int]:
    """As ``_fitted_row``, for cells of any number: each round scales them to each marginal by a sum and a join, and is written."""
    goals = {m: materialise(goals[m], "goals") for m in MARGINS}
    off, last = float("inf"), float("inf")
    for n in range(1, rounds + 1):
        new = at.withColumn("off", F.lit(0.0))
        for m in MARGINS:
            held = new.groupBy(m).agg(F.sum("w").alias("held")).join(goals[m], m)
            held = held.select(m, F.when(F.col("held") > 0, F.col("goal") / F.when(F.col("held") > 0, F.col("held"))).otherwise(0.0).alias("by"))
            new = new.join(held, m).select(*MARGINS, "tokens", (F.col("w") * F.col("by")).alias("w"), F.greatest("off", F.abs(F.col("by") - 1)).alias("off"))
        new, old = materialise(new, "cells"), at
        off = new.filter("w > 0").agg(F.max("off")).first()[0] or 0.0
        at = new.drop("off")
        discard(old)
        if off <= tolerance or (n > FIRST_ROUNDS and off > last * (1 - LEAST_GAIN)):
            break
        last = off
    return at, off, n


def cell_factors(docs: DataFrame, topic: str = SPARK_TOPIC, **how) -> DataFrame:
    """The raked cells of ``docs``; token sums cover every document."""
    sums = _labelled(docs, topic).groupBy(*MARGINS).agg(F.sum("tokens").alias("tokens"))
    return rake(sums, **how)


def mix(docs: DataFrame, topic: str = SPARK_TOPIC, rate: float | None = None, targets: dict[str, dict[str, float]] | None = None, **how) -> DataFrame:
    """A sample of ``docs`` with ``topic, tokens, probability, weight`` added.

    A document is kept if a number in [0, 1) made from its doc_id is below ``probability = min(1, rate * factor)`` of its cell;
    ``weight = rate * factor / probability``. ``rate`` is 1 / the largest factor if none is given: no probability is cut then,
    ``weight`` is 1 and the drawn documents' tokens meet the targets but for chance. The draw depends on doc_id alone, so it
    is the same in every run and copies of a row are kept or dropped together. A null doc_id draws like an empty one. A null
    source, language or topic is the value ``(none)``; null and empty texts have no tokens and factor 1 if their cell has
    none. An empty table gives no rows; targets that
    conflict give a warning and the nearest fit (see ``rake``). Columns with the added names are replaced.
    """
    cells = cell_factors(docs, topic, targets=TARGETS if targets is None else targets, **{"strict": False, **how})
    size = cells.agg(F.max("factor"), F.sum(F.length(F.concat(*MARGINS)) * 4 + 64)).first()
    rate = 1.0 / max(size[0] or 1.0, 1.0) if rate is None else float(rate)
    cells = cells.select(*MARGINS, "factor")
    if (size[1] or 0) <= BROADCAST_BYTES:
        cells = F.broadcast(cells)
    keep = [c for c in docs.columns if c not in ("topic", "tokens", "probability", "weight")]
    factor = F.coalesce("factor", F.lit(1.0)) * F.lit(rate)
    draw = F.conv(F.substring(F.md5(F.coalesce(F.col("row.doc_id").cast("string"), F.lit(""))), 1, 8), 16, 10).cast("double") / F.lit(2.0**32)
    out = _labelled(docs, topic).join(cells, [*MARGINS], "left").withColumn("p", F.least(F.lit(1.0), factor)).filter(draw < F.col("p"))
    return out.select(*[F.col("row")[c].alias(c) for c in keep], "topic", "tokens", F.round("p", 6).alias("probability"), F.round(factor / F.col("p"), 6).alias("weight"))


def mix_epochs(docs: DataFrame, topic: str = SPARK_TOPIC, epochs: float = 1.0, targets: dict[str, dict[str, float]] | None = None, **how) -> DataFrame:
    """The documents to read, with ``topic, tokens, copies`` added: a mix that a rare value does not make small.

    ``mix`` draws no document twice, so a value with a thousandth of the tokens and a target of a seventh leaves under a hundredth
    of the corpus. Here a document is read ``epochs * factor`` times: the whole part always, and once more if its number in [0, 1)
    (as in ``mix``) is below the rest. Tokens times copies meet the targets but for chance, and sum to ``epochs`` times the
    corpus. Documents with no copy are left out. Null and empty texts, conflicting targets and columns are handled as in ``mix``.
    """
    if epochs <= 0:
        raise ValueError("the number of epochs is above 0")
    cells = materialise(cell_factors(docs, topic, targets=TARGETS if targets is None else targets, **{"strict": False, **how}).select(*MARGINS, "factor"), "factors")
    size = cells.agg(F.sum(F.length(F.concat(*MARGINS)) * 4 + 64)).first()[0] or 0
    reads = F.coalesce("factor", F.lit(1.0)) * F.lit(float(epochs))
    draw = F.conv(F.substring(F.md5(F.coalesce(F.col("row.doc_id").cast("string"), F.lit(""))), 1, 8), 16, 10).cast("double") / F.lit(2.0**32)
    out = _labelled(docs, topic).join(F.broadcast(cells) if size <= BROADCAST_BYTES else cells, [*MARGINS], "left")
    out = out.withColumn("copies", (F.floor(reads) + F.when(draw < reads - F.floor(reads), 1).otherwise(0)).cast("long")).filter("copies > 0")
    keep = [c for c in docs.columns if c not in ("topic", "tokens", "copies")]
    return out.select(*[F.col("row")[c].alias(c) for c in keep], "topic", "tokens", "copies")


def margin_report(docs: DataFrame, topic: str = SPARK_TOPIC, targets: dict[str, dict[str, float]] | None = None, **how) -> DataFrame:
    """``margin, value, share, target, raked, miss``: one row for each value of each marginal that has tokens.

    Shares of all tokens before raking, as asked for, and after it; ``miss`` is ``raked / target - 1``, null for a target of 0.
    Targets that conflict are no error here: their misses are the answer. An empty table gives no rows.
    """
    targets = TARGETS if targets is None else targets
    cells = materialise(cell_factors(docs, topic, targets=targets, **{"strict": False, **how}), "raked")
    goals = _goals(cells.withColumn("w", F.col("tokens").cast("double")), targets, how.get("temper", TEMPER))
    total = cells.agg(F.sum("tokens").alias("all"), F.sum(F.col("tokens") * F.col("factor")).alias("all_raked"))
    parts = []
    for m in MARGINS:
        held = cells.groupBy(m).agg(F.sum("tokens").alias("own"), F.sum(F.col("tokens") * F.col("factor")).alias("got")).join(goals[m], m)
        share, goal, got = F.col("own") / F.col("all"), F.col("goal") / F.col("all"), F.col("got") / F.col("all_raked")
        facts = {"share": share, "target": goal, "raked": got, "miss": F.when(goal > 0, got / F.when(goal > 0, goal) - 1)}
        parts.append(held.join(F.broadcast(total)).select(F.lit(m).alias("margin"), F.col(m).alias("value"), *[c.alias(n) for n, c in facts.items()]))
    return parts[0].unionByName(parts[1]).unionByName(parts[2])


def op2_raking(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mix(table(spark, sf_dir, "documents")).select("doc_id", "source", "lang", "topic", "tokens", "probability", "weight")


def _sql() -> str:
    topic = TOPIC.replace("{count}(text, ", "len(regexp_extract_all(text, ").replace("') > ", "')) > ").replace("{{", "{")
    given = " ".join(f"WHEN '{k}' THEN {v}" for k, v in TARGETS["lang"].items())
    ctes = [
        rf"""docs AS (SELECT doc_id, source, lang, {topic} AS topic, coalesce(source, '(none)') AS s, coalesce(lang, '(none)') AS l,
  CAST(coalesce(len(regexp_extract_all(text, '[^\x20\x09-\x0D]+')), 0) AS BIGINT) AS tokens FROM documents)""",
        "w0 AS MATERIALIZED (SELECT s AS source, l AS lang, topic, CAST(sum(tokens) AS DOUBLE) AS tokens, CAST(sum(tokens) AS DOUBLE) AS w FROM docs GROUP BY ALL HAVING sum(tokens) > 0)",
        f"l_own AS (SELECT lang, sum(w) AS own, CASE lang {given} END AS given FROM w0 GROUP BY lang)",
        "g_lang AS MATERIALIZED (SELECT lang, CASE WHEN given IS NULL THEN own ELSE given / (SELECT sum(given) FROM l_own) * ((SELECT sum(own) FROM l_own) - (SELECT coalesce(sum(own), 0) FROM l_own WHERE given IS NULL)) END AS goal FROM l_own)",
    ]
    for m in ("source", "topic"):
        ctes.append(f"p_{m} AS (SELECT {m}, sum(w) AS own, pow(sum(w), {TEMPER}) AS power FROM w0 GROUP BY {m})")
        ctes.append(f"g_{m} AS MATERIALIZED (SELECT {m}, power / (SELECT sum(power) FROM p_{m}) * (SELECT sum(own) FROM p_{m}) AS goal FROM p_{m})")
    n = 0
    for _ in range(SQL_ROUNDS):
        for m in MARGINS:
            n += 1
            ctes.append(f"w{n} AS MATERIALIZED (SELECT c.source, c.lang, c.topic, c.tokens, c.w * g.goal / sum(c.w) OVER (PARTITION BY c.{m}) AS w FROM w{n - 1} c JOIN g_{m} g ON g.{m} = c.{m})")
    ctes.append(f"rate AS (SELECT 1.0 / greatest(coalesce(max(w / tokens), 1.0), 1.0) AS rate FROM w{n})")
    ctes.append(f"drawn AS (SELECT d.*, coalesce(c.w / c.tokens, 1.0) * rate AS p, CAST(CAST('0x' || substr(md5(coalesce(CAST(doc_id AS VARCHAR), '')), 1, 8) AS BIGINT) AS DOUBLE) / 4294967296.0 AS u FROM docs d CROSS JOIN rate LEFT JOIN w{n} c ON c.source = d.s AND c.lang = d.l AND c.topic = d.topic)")
    return "WITH " + ",\n".join(ctes) + "\nSELECT doc_id, source, lang, topic, tokens, round(p, 6) AS probability, CAST(1.0 AS DOUBLE) AS weight FROM drawn WHERE u < p"


SQL = _sql()
