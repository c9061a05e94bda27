"""Personal data by weak supervision.

Loose patterns propose candidate spans. Labelers vote on each: strict patterns, gazetteers (top-level domains, card
number prefixes, reserved address blocks, calling codes), context words and the shape of the surroundings; each may abstain.
Expectation-maximisation over the counts of vote patterns estimates how reliable each labeler is for each kind, without
labels. Its posteriors train a logistic span classifier on the votes and on features of its own, the span's length,
separators and neighbours; its positive spans are added to the base spans.

Only DataFrame functions touch texts. The driver sees one row for each distinct pattern of votes and features; there are
at most ``3^5 * 4`` votes by kind and ``4 * 5 * 4`` features, whatever the corpus.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from strandline.session import table

KINDS = ("email", "ip", "card", "phone")

#: What an address may start with. A match begins where a run of these does or where the match before ends: if it fails there it
#: fails at every later character of the run, so a run is gone over once however long it is.
_HEAD = r"(?:\G|(?<![A-Za-z0-9._%+-]))"
#: Base patterns, as given; groups are possessive where that cannot change a match, so that long runs need no stack.
BASE = {
    "email": _HEAD + r"[A-Za-z0-9._%+-]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++",
    "ip": r"(?<![0-9])[0-9]++(?:\.[0-9]++)(?:\.[0-9]++)(?:\.[0-9]++)",
    "card": r"[0-9](?:[\x20-]?[0-9])++",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}
#: A text that fails its gate has no match of the pattern.
GATE = {"email": "@", "ip": ".", "card": None, "phone": "+"}
LOOSE = {
    "email": _HEAD + r"[A-Za-z0-9._%+-]++(?:@|\x20?[\[(]\x20?at\x20?[\])]\x20?)[A-Za-z0-9-]++(?:(?:\.|\x20?[\[(]\x20?dot\x20?[\])]\x20?)[A-Za-z0-9-]++)++",
    "ip": r"(?<![0-9.])[0-9]{1,3}(?:(?:\.|\[\.\])[0-9]{1,3}){3}(?![0-9.])",
    "card": r"(?<![0-9A-Za-z])[0-9]{4}(?:[\x20.-]?[0-9]{4}){2}[\x20.-]?[0-9]{1,7}(?![0-9A-Za-z])",
    "phone": r"(?<![0-9A-Za-z+.-])(?:(?:\+|00)?[0-9]{0,3}[\x20.-]?\([0-9]{2,4}\)[\x20.-]?|(?:(?:\+|00)[0-9]{1,3}[\x20.-]?)?[0-9]{3}[\x20.-])[0-9]{3}[\x20.-]?[0-9]{3,4}(?![0-9A-Za-z])",
}
#: Gazetteers and context words; fixed values.
DOMAINS = "com|org|net|edu|gov|mil|int|info|biz|name|io|ai|app|dev|de|fr|es|it|uk|eu|us|ch|nl|at|be|ca|mx|br|ar|pt|pl|cz|se|no|fi|dk|ru|tr|in|cn|jp|kr|au|nz|za"
CALLING_CODES = "1|7|2[07]|3[0-469]|4[013-9]|5[1-8]|6[0-6]|8[1246]|9[0-58]"
CONTEXT = {
    "email": "e?-?mail|contact|write|reach|send|address|correo|adresse|courriel|kontakt|escrib",
    "ip": "ip|host|server|address|login|logged|connect|client|gateway|router|serveur|servidor|adresse",
    "card": "card|visa|credit|debit|master|amex|payment|paid|pay|carte|tarjeta|karte|kredit",
    "phone": "phone|tel|call|fax|mobile|cell|dial|ring|llam|appel|anruf|telefon|telefono|rufnummer",
}
OTHER = "version|token|isbn|order|sku|id"
LABELERS = 5
#: How many values each feature of a span has: length, separators, and what stands before it.
SHAPES = (4, 5, 4)
STRETCH = 512
ROUNDS = 40
STEPS = 400


def spans(text: Column, pattern: str) -> Column:
    """``array<struct<start, end, value, before, after>>``: leftmost matches that do not overlap, in code points.

    The gaps between matches, from a split by the same pattern, give the positions. Gaps serve as context too.
    """
    found = F.regexp_extract_all(text, F.lit(pattern), F.lit(0))
    none = F.array().cast("array<struct<start:int,end:int,value:string,before:string,after:string>>")
    gaps = F.split(text, pattern, -1)
    def step(acc: Column, x: Column) -> Column:
        start = acc["at"] + F.length(x["g"])
        end = start + F.length(x["m"])
        one = F.struct(start.alias("start"), end.alias("end"), x["m"].alias("value"), F.right(x["g"], F.lit(24)).alias("before"), F.left(x["a"], F.lit(24)).alias("after"))
        return F.struct(end.alias("at"), F.concat(acc["spans"], F.array(one)).alias("spans"))

    def walk(steps: Column) -> Column:
        def stretch(acc: Column, k: Column) -> Column:
            walked = F.aggregate(F.slice(steps, k * STRETCH + 1, F.lit(STRETCH)), F.struct(acc["at"].alias("at"), none.alias("spans")), step)
            return named(walked, lambda w: F.struct(w["at"].alias("at"), F.concat(acc["parts"], F.array(w["spans"])).alias("parts")))

        empty = F.struct(F.lit(0).alias("at"), F.array().cast("array<array<struct<start:int,end:int,value:string,before:string,after:string>>>").alias("parts"))
        several = F.flatten(F.aggregate(F.sequence(F.lit(0), F.floor((F.size(steps) - 1) / STRETCH).cast("int")), empty, stretch)["parts"])
        few = F.aggregate(steps, F.struct(F.lit(0).alias("at"), none.alias("spans")), step)["spans"]
        return F.when(F.size(steps) > STRETCH, several).when(F.size(steps) > 0, few).otherwise(none)

    # the position after the last match goes along, in stretches, so that no array grows by ones for long; what a lambda
    # reads is named before, or it would be computed again for every match
    named = lambda x, then: F.transform(F.array(x), then)[0]
    part = lambda p, i: F.element_at(p["gaps"], i)
    steps = lambda p: F.transform(p["found"], lambda m, i: F.struct(m.alias("m"), part(p, i + 1).alias("g"), part(p, i + 2).alias("a")))
    return named(F.struct(found.alias("found"), gaps.alias("gaps")), lambda p: named(steps(p), walk))


_PART = r"0*(?:25[0-5]|2[0-4][0-9]|1[0-9]{2}|[1-9]?[0-9])"


def valid(kind: str, value: Column) -> Column:
    """The base rule of a kind beyond its pattern."""
    digits = F.regexp_replace(value, "[^0-9]", "")
    if kind == "ip":
        return value.rlike(rf"^{_PART}\.{_PART}\.{_PART}\.{_PART}$")
    if kind == "card":
        return F.length(digits).between(13, 19) & F.call_function("luhn_check", digits)
    if kind == "phone":
        return F.length(digits).between(9, 15)
    return F.lit(True)


def _gated(kind: str, text: Column, pattern: str, loose: bool = False) -> Column:
    gate = text.rlike(r"[0-9][\x20-]?[0-9]") if GATE[kind] is None else text.contains(GATE[kind])
    if loose:
        gate = text.rlike("[0-9]") if kind != "email" else (text.contains("@") | text.contains("at"))
    out = spans(text, pattern)
    return F.when(gate, out).otherwise(F.array().cast("array<struct<start:int,end:int,value:string,before:string,after:string>>"))


def _base(kind: str, text: Column) -> Column:
    return F.filter(_gated(kind, text, BASE[kind]), lambda s: valid(kind, s["value"]))


def _votes(kind: str, s: Column) -> list[Column]:
    """Each labeler's vote on a candidate: 1, 0, or null where it abstains."""
    value = s["value"]
    digits = F.regexp_replace(value, "[^0-9]", "")
    yes, no, abstain = F.lit(1), F.lit(0), F.lit(None).cast("int")
    strict = F.when(value.rlike(f"^(?:{BASE[kind]})$") & valid(kind, F.regexp_replace(value, r"\[|\]", "")), yes).otherwise(no)
    if kind == "email":
        listed = F.when(value.rlike(rf"(?i)[.\])\x20](?:{DOMAINS})$"), yes).otherwise(no)
        shape = F.when(value.rlike(r"^[A-Za-z0-9]") & ~value.rlike(r"\.\."), yes).otherwise(no)
    elif kind == "ip":
        listed = F.when(value.rlike(r"^(?:0|255)\."), no).when(value.rlike(r"^(?:10|127|169|172|192)\."), abstain).otherwise(yes)
        shape = F.when(valid("ip", F.regexp_replace(value, r"\[|\]", "")), yes).otherwise(no)
    elif kind == "card":
        listed = F.when(digits.rlike("^(?:3[47]|4|5[1-5]|2[2-7]|6)"), yes).otherwise(no)
        shape = F.when(F.call_function("luhn_check", digits), yes).otherwise(no)
    else:
        listed = F.when(value.rlike(rf"^(?:\+|00)(?:{CALLING_CODES})"), yes).when(digits.rlike("^1?[2-9][0-9]{2}[2-9][0-9]{6}$"), yes).when(value.rlike(r"^(?:\+|00)"), no).otherwise(abstain)
        shape = F.when(F.length(digits).between(9, 15), yes).otherwise(no)
    near = F.concat(F.coalesce(s["before"], F.lit("")), F.lit(" "), F.coalesce(s["after"], F.lit("")))
    context = F.when(near.rlike(rf"(?i)\b(?:{CONTEXT[kind]})"), yes).when(near.rlike(rf"(?i)\b(?:{OTHER})\b"), no).otherwise(abstain)
    edge = F.when(s["before"].rlike(r"[0-9A-Za-z=\"]$") | s["after"].rlike("^[0-9A-Za-z]"), no).otherwise(yes)
    return [strict, listed, shape, context, edge]


def _shape(s: Column) -> list[Column]:
    """The features of a span: length, separators and the character before, each as a small number."""
    value, before = s["value"], F.right(F.coalesce(s["before"], F.lit("")), F.lit(1))
    length = F.when(F.length(value) < 10, 0).when(F.length(value) < 15, 1).when(F.length(value) < 21, 2).otherwise(3)
    mark = F.when(value.rlike(r"[\[\](]"), 4).when(value.contains("-"), 3).when(value.contains("."), 2).when(value.contains(" "), 1).otherwise(0)
    edge = F.when(before.rlike(r"[\s]") | (before == ""), 0).when(before.rlike("[:;,(<\"']"), 1).when(before.rlike("[0-9A-Za-z]"), 2).otherwise(3)
    return [length, mark, edge]


def _candidates(text: Column) -> Column:
    """``array<struct<kind, start, end, votes, shape>>`` of every kind."""
    def voted(kind: str) -> Column:
        return F.transform(_gated(kind, text, LOOSE[kind], loose=True), lambda s: F.struct(F.lit(kind).alias("kind"), s["start"].alias("start"), s["end"].alias("end"), F.array(*_votes(kind, s)).alias("votes"), F.array(*_shape(s)).alias("shape")))

    return F.concat(*[voted(kind) for kind in KINDS])


def estimate(patterns: list[tuple[str, tuple, int]], rounds: int = ROUNDS) -> dict[tuple[str, tuple], float]:
    """Posterior probability of each (kind, votes) pattern by expectation-maximisation over its count.

    Two classes, labelers independent given the class; each kind has a prior and reliabilities of its own.
    Starts from the share of positive votes, so the classes keep their meaning.
    """
    post = {}
    for kind, votes, _ in patterns:
        cast = [v for v in votes if v is not None]
        post[kind, votes] = 0.1 + 0.8 * (sum(cast) / len(cast) if cast else 0.5)
    for _ in range(rounds):
        prior: dict[str, list[float]] = {}
        hit = {kind: [[[1.0, 1.0] for _ in range(2)] for _ in range(LABELERS)] for kind in KINDS}
        for kind, votes, n in patterns:
            p = post[kind, votes]
            share = prior.setdefault(kind, [1.0, 1.0])
            for c, q in ((1, p), (0, 1 - p)):
                share[c] += n * q
                for j, v in enumerate(votes):
                    if v is not None:
                        hit[kind][j][c][v] += n * q
        for kind, votes, _ in patterns:
            log = [math.log(prior[kind][c] / sum(prior[kind])) for c in (0, 1)]
            for c in (0, 1):
                for j, v in enumerate(votes):
                    if v is not None:
                        log[c] += math.log(hit[kind][j][c][v] / sum(hit[kind][j][c]))
            post[kind, votes] = 1 / (1 + math.exp(max(-60.0, min(60.0, log[0] - log[1]))))
    return post


def _features(kind: str, votes: tuple, shape: tuple) -> list[float]:
    own = [float(kind == k and x == i) for k in KINDS for x, n in zip(shape, SHAPES, strict=True) for i in range(n)]
    return [1.0, *[float(kind == k) for k in KINDS], *[0.0 if v is None or kind != k else 2.0 * v - 1 for k in KINDS for v in votes], *own]


def train(patterns: list[tuple[str, tuple, tuple, int]], steps: int = STEPS, rate: float = 0.5) -> list[float]:
    """Weights of the logistic span classifier, fitted to the posteriors by gradient descent on counts ``kind, votes, shape, n``.

    Every kind weighs the same, however many candidates it has.
    """
    votes: dict[tuple, int] = {}
    of_kind: dict[str, int] = {}
    for kind, v, _, n in patterns:
        votes[kind, v] = votes.get((kind, v), 0) + n
        of_kind[kind] = of_kind.get(kind, 0) + n
    post = estimate([(k, v, n) for (k, v), n in votes.items()])
    rows = [([(i, x) for i, x in enumerate(_features(k, v, h)) if x], post[k, v], n / of_kind[k]) for k, v, h, n in patterns]
    w = [0.0] * len(_features(KINDS[0], (None,) * LABELERS, (0,) * len(SHAPES)))
    for _ in range(steps if rows else 0):
        grad = [1e-3 * x for x in w]
        for x, target, share in rows:
            got = 1 / (1 + math.exp(-max(-60.0, min(60.0, sum(w[i] * v for i, v in x)))))
            for i, v in x:
                grad[i] += share * (got - target) * v
        w = [a - rate * g for a, g in zip(w, grad, strict=True)]
    return w


def learn(docs: DataFrame) -> list[float]:
    """The classifier learned from the votes on all candidates of all of ``docs``."""
    each = docs.select(F.explode(_candidates(F.coalesce(F.col("text").cast("string"), F.lit("")))).alias("c")).select("c.kind", "c.votes", "c.shape")
    counted = each.groupBy("kind", "votes", "shape").agg(F.count("*").alias("n")).collect()
    return train(sorted(((r[0], tuple(r[1]), tuple(r[2]), r[3]) for r in counted), key=repr))


def _positive(c: Column, w: list[float]) -> Column:
    """Whether the classifier accepts a candidate: the sum of its kind's weights."""
    votes_at, shape_at = 1 + len(KINDS), 1 + len(KINDS) + len(KINDS) * LABELERS

    def of(k: int) -> Column:
        z = F.lit(w[0] + w[1 + k])
        for j in range(LABELERS):
            z = z + F.coalesce(F.element_at(c["votes"], j + 1).cast("double") * 2 - 1, F.lit(0.0)) * F.lit(w[votes_at + k * LABELERS + j])
        at = shape_at + k * sum(SHAPES)
        for j, n in enumerate(SHAPES):
            z = z + F.element_at(F.array(*[F.lit(x) for x in w[at : at + n]]), F.element_at(c["shape"], j + 1) + 1)
            at += n
        return z

    z = of(len(KINDS) - 1)
    for k in range(len(KINDS) - 1):
        z = F.when(c["kind"] == KINDS[k], of(k)).otherwise(z)
    return z > 0


def find_personal_data(docs: DataFrame, weights: list[float] | None = None) -> DataFrame:
    """``doc_id, n_email, n_ip, n_card, n_phone, base_sha256, spans, n_added``: one row per row of ``docs``.

    The counts and ``base_sha256`` are of the base spans, ``spans`` has the added ones too; spans are ``kind:start:end`` in
    code points, end exclusive, by kind and start, comma-joined. A span is added if the classifier accepts a candidate that
    overlaps no base span. Null and empty texts have none. Rows stand for themselves, so repeated ones are alike; with
    ``weights`` from ``learn`` new documents are read without learning again. Other columns are ignored.
    """
    weights = weights or learn(docs)
    text = F.coalesce(F.col("text").cast("string"), F.lit(""))
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), text.alias("text"))
    place = lambda k: lambda s: F.struct(F.lit(KINDS.index(k)).alias("k"), s["start"].alias("start"), s["end"].alias("end"))
    rows = rows.select("doc_id", *[F.transform(_base(k, F.col("text")), place(k)).alias(k) for k in KINDS], _candidates(F.col("text")).alias("found"))
    rows = rows.withColumn("base", F.array_sort(F.concat(*KINDS)))
    number = F.create_map(*[F.lit(x) for i, k in enumerate(KINDS) for x in (k, i)])
    free = lambda c: ~F.exists("base", lambda b: (b["start"] < c["end"]) & (c["start"] < b["end"]))
    added = F.transform(F.filter("found", lambda c: _positive(c, weights) & free(c)), lambda c: F.struct(F.element_at(number, c["kind"]).alias("k"), c["start"].alias("start"), c["end"].alias("end")))
    rows = rows.withColumn("added", F.when(F.size("found") > 0, added).otherwise(F.array().cast("array<struct<k:int,start:int,end:int>>")))
    joined = lambda a: F.array_join(F.transform(a, lambda s: F.concat_ws(":", F.element_at(F.array(*[F.lit(k) for k in KINDS]), s["k"] + 1), s["start"], s["end"])), ",")
    counts = [F.size(k).cast("long").alias(f"n_{k}") for k in KINDS]
    return rows.select("doc_id", *counts, F.sha2(joined("base"), 256).alias("base_sha256"), joined(F.array_sort(F.concat("base", "added"))).alias("spans"), F.size("added").cast("long").alias("n_added"))


def op5_personal_data(spark: SparkSession, sf_dir: str) -> DataFrame:
    return find_personal_data(table(spark, sf_dir, "documents"))
