"""Personal data: base spans against plain Python, spans of many matches, and recall by kind on planted spans."""

import hashlib
import random
import re

from strandline.llm import personal_data

SCHEMA = "doc_id long, text string, spans string, n_card string, kind string"
PATTERNS = {
    "email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+",
    "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
    "card": r"[0-9]([\x20-]?[0-9])+",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}


def frame(spark, texts):
    return spark.createDataFrame([(i, t, "x", "y", "z") for i, t in enumerate(texts)], SCHEMA)


def passes(kind, value):
    digits = [int(c) for c in value if c.isdigit() and c.isascii()]
    if kind == "ip":
        return all(int(p) <= 255 for p in value.split("."))
    if kind == "card":
        luhn = sum(d if i % 2 == 0 else d * 2 - 9 * (d > 4) for i, d in enumerate(reversed(digits)))
        return 13 <= len(digits) <= 19 and luhn % 10 == 0
    return kind == "email" or 9 <= len(digits) <= 15


def base(text):
    return {k: [(m.start(), m.end()) for m in re.finditer(p, text or "") if passes(k, m[0])] for k, p in PATTERNS.items()}


def check(rows, texts):
    for r in rows:
        want = base(texts[r.doc_id])
        joined = ",".join(f"{k}:{a}:{b}" for k in PATTERNS for a, b in want[k])
        assert (r.n_email, r.n_ip, r.n_card, r.n_phone) == tuple(len(want[k]) for k in PATTERNS), texts[r.doc_id]
        assert r.base_sha256 == hashlib.sha256(joined.encode()).hexdigest()
        assert set(filter(None, joined.split(","))) <= set(r.spans.split(",")) and len(r.spans.split(",")) == len(set(r.spans.split(",")))


def test_base_spans_of_a_whole_table(spark):
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    texts = {r.doc_id: r.text for r in docs.select("doc_id", "text").collect()}
    rows = personal_data.find_personal_data(docs).collect()
    assert len(rows) == len(texts)
    check(rows, texts)


def test_base_spans_of_generated_texts(spark):
    rng = random.Random(3)
    pieces = ["4111111111111111", "4", "1", " ", "-", ".", "+", "@", "a.b", "x", "(", ")", "10.0.0.1", "999", "é𝒳", "\n", "5500 0000 0000 0004", "+44 20 7946 0958", "me@host.org", "  ", "0", "00"]
    texts = [None, "", *("".join(rng.choice(pieces) for _ in range(rng.randint(1, 25))) for _ in range(600))]
    texts += ["1 " * 4000, "a@b.c " * 2000 + "10.1.1.1 " * 600, "4 1 1 1 1 1 1 1 1 1 1 1 1 1 1 1", "é𝒳 me@host.org", "me@host.org", "me@host.org"]
    check(personal_data.find_personal_data(frame(spark, texts)).collect(), texts)
    assert personal_data.find_personal_data(frame(spark, texts).limit(0)).count() == 0


def test_recall_by_kind_on_planted_spans(spark):
    rng = random.Random(7)
    word = lambda: "".join(rng.choice("abcdefghijklmnoprstuvw") for _ in range(rng.randint(3, 8)))
    digits = lambda n: "".join(rng.choice("0123456789") for _ in range(n))

    def card(sep):
        body = "4" + digits(14)
        luhn = sum(int(c) if i % 2 else int(c) * 2 - 9 * (int(c) > 4) for i, c in enumerate(reversed(body)))
        whole = body + str(-luhn % 10)
        return sep.join(whole[i : i + 4] for i in range(0, 16, 4))

    make = {
        "email": lambda: f"{word()} [at] {word()} [dot] {rng.choice(['com', 'org', 'de'])}",
        "ip": lambda: "[.]".join(str(rng.randint(1, 254)) for _ in range(4)),
        "card": lambda: card("."),
        "phone": lambda: f"({rng.randint(212, 989)}) {rng.randint(200, 999)}-{digits(4)}",
    }
    hint = {"email": "mail", "ip": "server", "card": "card", "phone": "call"}
    texts, planted = [], []
    for i in range(240):
        kind = list(make)[i % 4]
        value = make[kind]()
        lead = f"{word()} {word()} {hint[kind] if i % 3 else word()} "
        texts.append(f"{lead}{value} {word()}")
        planted.append(f"{kind}:{len(lead)}:{len(lead) + len(value)}")
    clean = [" ".join(word() for _ in range(30)) + f" version {digits(1)}.{digits(2)} id {digits(4)}-{digits(3)}" for _ in range(200)]
    rows = {r.doc_id: set(r.spans.split(",")) for r in personal_data.find_personal_data(frame(spark, texts + clean)).collect()}
    for kind in make:
        own = [i for i, x in enumerate(planted) if x.startswith(kind)]
        assert sum(planted[i] in rows[i] for i in own) >= 0.9 * len(own), kind
    assert sum(rows[i] != {""} for i in range(len(texts), len(texts) + len(clean))) <= 4
