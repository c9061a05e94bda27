"""URL filter: a blocked Bloom filter of listed canonical URLs, then an exact hash join.

Every URL stands for the keys ``host suffix + path prefix`` that a list entry could have. Keys that hit the filter go to
the exact join with the list, which removes false positives. Only DataFrame functions are used.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from strandline.session import table

WORDS = 4
BITS_PER_RULE = 16
#: A list up to this size is broadcast with its filter (about 100 bytes a rule); a longer one is joined by a shuffle.
BROADCAST_RULES = 200_000

RULES = [
    ("allow", "com", "/"),
    ("block", "example.com", "/en/"),
    ("allow", "www.example.com", "/en/"),
    ("block", "net", "/es/"),
    ("block", "net", "/fr/"),
]
_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def url_host(url: Column) -> Column:
    """What follows the first ``://`` up to ``/ ? #``, A-Z lower-cased; empty without ``://`` or for null."""
    return F.coalesce(F.translate(F.regexp_extract(url, r"://([^/?#]*)", 1), _UPPER, _LOWER), F.lit(""))


def url_path(url: Column) -> Column:
    """From the host's end up to ``? #``; may be empty."""
    return F.coalesce(F.regexp_extract(url, r"://[^/?#]*([^?#]*)", 1), F.lit(""))


def _probe(key: Column, blocks: int) -> dict[str, Column]:
    """The filter block of a key and its two bits in each of the block's four 64-bit words."""
    bits = F.xxhash64(F.lit("bits"), key)
    one = F.lit(1).cast("long")
    slot = lambda j: F.shiftrightunsigned(bits, 6 * j).bitwiseAND(F.lit(63)).cast("int")
    put = lambda j: F.call_function("shiftleft", one, slot(j))
    return {"_block": F.pmod(F.xxhash64(key), F.lit(blocks))} | {f"_m{i}": put(2 * i).bitwiseOR(put(2 * i + 1)) for i in range(WORDS)}


def rule_table(spark: SparkSession, rules: list[tuple[str, str, str]] | None = None) -> DataFrame:
    """``verdict, host, path`` rows of a list."""
    return spark.createDataFrame(rules or RULES, "verdict string, host string, path string")


def judge(pages: DataFrame, rules: DataFrame) -> DataFrame:
    """``page_id, host, path, rule, verdict``: one row per row of ``pages``.

    A rule fits its host and all its subdomains if the URL's path starts with the rule's path; the longest rule (host and
    path together) wins, a rule listed with both verdicts blocks. Without a rule ``rule`` is null and the verdict
    ``allow``. A null URL, or one without ``://``, has an empty host and path. Repeated rows are judged alike, other
    columns are ignored. An empty list allows everything. The rules' path lengths are held on the driver; there are as
    many as distinct lengths, not rules.
    """
    listed = rules.filter("host is not null and path is not null").groupBy(F.concat("host", "path").alias("rule")).agg(F.max("verdict").alias("listed"), F.max(F.length("path")).alias("path_length"))
    size = listed.agg(F.count("*"), F.collect_set("path_length")).first()
    lengths = F.array(*[F.lit(n) for n in sorted(size[1])]) if size[1] else F.array().cast("array<int>")
    blocks = max(1, size[0] * BITS_PER_RULE // (64 * WORDS))
    filter_rows = listed.select(*[c.alias(k) for k, c in _probe(F.col("rule"), blocks).items()]).groupBy("_block").agg(*[F.bit_or(f"_m{i}").alias(f"_w{i}") for i in range(WORDS)])
    exact = listed.select("rule", "listed")
    if size[0] <= BROADCAST_RULES:
        filter_rows, exact = F.broadcast(filter_rows), F.broadcast(exact)
    seen = pages.select("page_id", "url", url_host(F.col("url")).alias("host"), url_path(F.col("url")).alias("path"))
    suffixes = F.transform(F.sequence(F.lit(1), F.size("parts")), lambda i: F.array_join(F.slice("parts", i, F.size("parts")), "."))
    keys = seen.withColumn("parts", F.split("host", r"\.")).select("url", "path", F.explode(suffixes).alias("suffix"))
    keys = keys.select("url", "suffix", "path", F.explode(F.filter(lengths, lambda n: n <= F.length("path"))).alias("n"))
    keys = keys.select("url", F.concat("suffix", F.expr("substring(path, 1, n)")).alias("rule"))
    probed = keys.select("url", "rule", *[c.alias(k) for k, c in _probe(F.col("rule"), blocks).items()]).join(filter_rows, "_block")
    possible = probed.filter(" and ".join(f"(_w{i} & _m{i}) = _m{i}" for i in range(WORDS))).select("url", "rule")
    best = possible.join(exact, "rule").groupBy("url").agg(F.max(F.struct(F.length("rule").alias("n"), "rule", "listed")).alias("best"))
    # a null URL has no rule; a key of its own keeps such rows from meeting in one task
    key = F.coalesce("url", F.concat(F.lit(" "), F.coalesce(F.col("page_id").cast("string"), F.lit(""))))
    out = seen.withColumn("key", key).join(best.withColumnRenamed("url", "key"), "key", "left")
    return out.select("page_id", "host", "path", F.col("best.rule").alias("rule"), F.coalesce("best.listed", F.lit("allow")).alias("verdict"))


def op4_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    return judge(table(spark, sf_dir, "pages"), rule_table(spark))


SQL = r"""
WITH rules(listed, rule_host, rule_path) AS (VALUES
  ('allow', 'com', '/'), ('block', 'example.com', '/en/'), ('allow', 'www.example.com', '/en/'), ('block', 'net', '/es/'), ('block', 'net', '/fr/')),
parts AS (
  SELECT page_id, row_number() OVER () AS row_no,
    translate(coalesce(regexp_extract(url, '://([^/?#]*)', 1), ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host,
    coalesce(regexp_extract(url, '://[^/?#]*([^?#]*)', 1), '') AS path
  FROM pages),
fits AS (
  SELECT row_no, rule_host || rule_path AS rule, listed,
    row_number() OVER (PARTITION BY row_no ORDER BY length(rule_host || rule_path) DESC) AS nth
  FROM parts JOIN rules ON (host = rule_host OR ends_with(host, '.' || rule_host)) AND starts_with(path, rule_path))
SELECT page_id, host, path, rule, coalesce(listed, 'allow') AS verdict
FROM parts LEFT JOIN (SELECT * FROM fits WHERE nth = 1) USING (row_no)
"""
