"""New samples against a store: each batch is compared with itself and with what is stored, and clusters are updated from labels.

A store is a folder of Parquet tables, each with a folder for every batch:

* ``samples``: the records, by the first two digits of the fingerprint of their header, so that a look-up of seen records
  reads the prefixes that the batch has;
* ``sketches``: what pairs are compared by first, so that stored sequences are read only where a pair is near;
* ``links``: links with at least one sample of the batch;
* ``labels``: the cluster label of every sample after the batch.

A batch writes its own folders only and reads those of batches before it, so one that failed and runs again gives the same.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from strandline.functions.sequence import fingerprint, upper_ascii
from strandline.operators import near_links
from strandline.operators.graph import min_labels
from strandline.operators.reuse import with_fingerprint
from strandline.operators.site_bits import whole_rows
from strandline.session import materialise, ship_code

SAMPLES = "genotype string, record_idx long, seq_id string, sequence string, aligned string, fingerprint string, r long, prefix string"
SKETCHES = "g string, r long, plain int, k int, files long, bits binary, sparse boolean"
LINKS = "genotype string, source string, target string, distance double, snp_count int, comparable_sites int"
LABELS = "node string, label string"


def _path(store: str, name: str, batch: int) -> str:
    return f"{store}/{name}/batch={batch}"


def _exists(spark: SparkSession, path: str) -> bool:
    target = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return target.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).exists(target)


def _before(spark: SparkSession, store: str, name: str, schema: str, batch: int) -> DataFrame:
    """A stored table as it was before ``batch``."""
    if not _exists(spark, f"{store}/{name}"):
        return spark.createDataFrame([], schema + ", batch int")
    return spark.read.schema(schema + ", batch int").parquet(f"{store}/{name}").filter(F.col("batch") < batch)


def add_batch(spark: SparkSession, batch: DataFrame, store: str, number: int, at_most: float | None = None, most_snps: int | None = None, block_rows: int = near_links.BLOCK_ROWS) -> None:
    """Add ``genotype, record_idx, seq_id, sequence, aligned`` rows to a store as its batch ``number``, 0 for the first.

    A row counts as seen if its id and the fingerprint of its ``sequence`` are stored; it is left out, and so are repeats
    within the batch. Links are those of ``near_links`` with the same threshold, which must be the same for every batch.
    Pairs are new rows with all rows of their genotype, never old rows with old ones, and meet in blocks.
    """
    ship_code(spark)
    rows = batch.select(
        F.col("genotype").cast("string").alias("genotype"), F.col("record_idx").cast("long").alias("record_idx"), F.col("seq_id").cast("string").alias("seq_id"), "sequence",
        F.coalesce(upper_ascii(F.col("aligned")), F.lit("")).alias("aligned"), fingerprint(F.col("sequence")).alias("fingerprint"),
    ).withColumn("prefix", F.substr(F.sha2("seq_id", 256), F.lit(1), F.lit(2))).dropDuplicates(["seq_id", "fingerprint"])
    stored = _before(spark, store, "samples", SAMPLES, number)
    prefixes = [r[0] for r in rows.select("prefix").distinct().collect()]  # 256 at most
    seen = stored.filter(F.col("prefix").isin(prefixes)).select("prefix", "seq_id", "fingerprint")
    unseen = rows.join(seen, ["prefix", "seq_id", "fingerprint"], "left_anti").withColumn("r", F.lit(number << 40) + F.monotonically_increasing_id())
    unseen.write.mode("overwrite").partitionBy("prefix").parquet(_path(store, "samples", number))
    new = spark.read.schema(SAMPLES).parquet(_path(store, "samples", number))
    near_links.sketches(new.select(F.col("genotype").alias("g"), "r", F.col("aligned").alias("q")), at_most, most_snps).write.mode("overwrite").parquet(_path(store, "sketches", number))
    new_links(spark, store, number, at_most, most_snps, block_rows).write.mode("overwrite").parquet(_path(store, "links", number))
    new_labels(spark, store, number).write.mode("overwrite").parquet(_path(store, "labels", number))


def new_links(spark: SparkSession, store: str, number: int, at_most: float | None, most_snps: int | None, block_rows: int) -> DataFrame:
    """Links that batch ``number`` adds: of its samples among themselves and with stored ones."""
    fresh = spark.read.schema(SKETCHES).parquet(_path(store, "sketches", number)).withColumn("own", F.lit(True))
    wide = fresh.unionByName(_before(spark, store, "sketches", SKETCHES, number).drop("batch").withColumn("own", F.lit(False)))
    # a store written before rows were told apart so has no value there
    wide = wide.filter("g is not null").withColumn("sparse", F.coalesce("sparse", F.lit(True)))
    if at_most is not None and at_most < 1:
        wide = wide.filter("plain > 0")
    samples = spark.read.schema(SAMPLES).parquet(_path(store, "samples", number)).unionByName(_before(spark, store, "samples", SAMPLES, number).drop("batch"))
    member = lambda file, own: (F.lit(file).cast("long").alias("file"), "r", own.alias("own"))
    plain = wide.filter("not sparse").select("g", *member(-1, F.col("own")))
    # a sparse row meets the others over whole rows: a new one all rows, a stored one the new rows
    new_sparse, old_sparse = F.col("own") & F.col("sparse"), ~F.col("own") & F.col("sparse")
    held = lambda c: wide.filter(c).select("g").distinct()
    few = wide.join(held(new_sparse), "g", "left_semi").select("g", *member(-2, new_sparse))
    few = few.unionByName(wide.filter(F.col("own") | old_sparse).join(held(old_sparse), "g", "left_semi").select("g", *member(-3, old_sparse)))
    bits = whole_rows(samples.select("r", F.col("aligned").alias("q")))
    whole = few.join(wide.select("r", "k"), "r").join(bits.withColumnRenamed("whole", "bits"), "r")
    near = near_links.near_in_cells(plain.join(wide.select("r", "k", "bits"), "r"), block_rows).unionByName(near_links.near_in_cells(whole, block_rows))
    near = near.filter((F.shiftright("x", 40) == number) | (F.shiftright("y", 40) == number)).distinct()
    found = near_links.confirmed(materialise(near, "near"), bits, at_most, most_snps)
    end = lambda e: samples.select(F.col("r").alias(e), *([F.col("genotype")] if e == "x" else []), F.col("record_idx").alias(f"i{e}"), F.col("seq_id").alias(f"s{e}"))
    ends = found.join(end("x"), "x").join(end("y"), "y")
    return near_links.as_links(ends.withColumnRenamed("genotype", "g"), "genotype")


def new_labels(spark: SparkSession, store: str, number: int) -> DataFrame:
    """``node, label`` of every sample after batch ``number``: the smallest id that links lead to.

    Old clusters are nodes of a smaller graph that the new links join; only those that they touch get another label.
    """
    new = spark.read.schema(SAMPLES).parquet(_path(store, "samples", number)).select(F.col("seq_id").alias("node"), F.col("seq_id").alias("label"))
    old = spark.read.parquet(_path(store, "labels", number - 1)) if number else new.limit(0)
    labels = old.unionByName(new.join(old, "node", "left_anti").distinct())
    links = spark.read.schema(LINKS).parquet(_path(store, "links", number)).select("source", "target")
    of = lambda end: labels.select(F.col("node").alias(end), F.col("label").alias(f"of_{end}"))
    joined = links.join(of("source"), "source").join(of("target"), "target").select(F.col("of_source").alias("u"), F.col("of_target").alias("v")).distinct()
    top = min_labels(joined, "u", "v").select(F.col("node").alias("label"), F.col("label").alias("top"))
    return labels.join(top, "label", "left").select("node", F.coalesce("top", "label").alias("label"))


def stored_links(spark: SparkSession, store: str) -> DataFrame:
    """All links of a store."""
    return spark.read.schema(LINKS + ", batch int").parquet(f"{store}/links").drop("batch")


def stored_components(spark: SparkSession, store: str) -> DataFrame:
    """``sample_id, root`` after the last batch, for ``graph.number_clusters``."""
    labels = spark.read.schema(LABELS + ", batch int").parquet(f"{store}/labels")
    last = labels.agg(F.max("batch").alias("batch"))
    return labels.join(F.broadcast(last), "batch").select(F.col("node").alias("sample_id"), F.col("label").alias("root"))  # one row


def accumulate(stream: DataFrame, store: str, checkpoint: str) -> StreamingQuery:
    """Append unseen ``header, sequence`` records of a stream to the Parquet folder ``store``, without comparing them.

    A record counts as seen if its header and the fingerprint of its sequence are stored. A repeated batch adds nothing,
    so a restart from ``checkpoint`` after a failure gives each record once.
    """

    def add(batch: DataFrame, batch_id: int) -> None:
        new = with_fingerprint(batch).dropDuplicates(["header", "fingerprint"])
        if _exists(batch.sparkSession, store):
            new = new.join(batch.sparkSession.read.parquet(store).select("header", "fingerprint"), ["header", "fingerprint"], "left_anti").select(new.columns)
        new.write.mode("append").parquet(store)

    return stream.writeStream.foreachBatch(add).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()


def accumulate_links(stream: DataFrame, store: str, checkpoint: str, at_most: float | None = None, most_snps: int | None = None) -> StreamingQuery:
    """Add each micro-batch of a stream to a store by ``add_batch``; a restart after a failure gives each record once."""

    def add(batch: DataFrame, number: int) -> None:
        add_batch(batch.sparkSession, batch, store, number, at_most, most_snps)

    return stream.writeStream.foreachBatch(add).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
