"""Session helpers: a tuned local session, table reading, and durable cuts of lineage."""

from __future__ import annotations

import atexit
import gc
import re
import tempfile
import uuid
import zipfile
from pathlib import Path

from pyspark.sql import DataFrame, SparkSession


def local_session(cpus: int = 8, app: str = "strandline", **conf: str) -> SparkSession:
    """A session for tests and benchmarks; on a cluster the caller brings its own."""
    base = {
        "spark.sql.shuffle.partitions": str(cpus),
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.session.timeZone": "UTC",
        "spark.driver.memory": "8g",
        "spark.ui.enabled": "false",
        "spark.ui.showConsoleProgress": "false",
    }
    builder = SparkSession.builder.master(f"local[{cpus}]").appName(app)
    for key, value in {**base, **conf}.items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """One of the driver's tables; ``sf_dir`` may be any path that Spark can read."""
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def shared_folder(spark: SparkSession) -> str:
    """The folder all executors share: ``spark.checkpoint.dir``; a temporary one where it is unset and the master is local."""
    known = spark.sparkContext.getConf().get("spark.checkpoint.dir")
    if known:
        return known.rstrip("/")
    current = spark.sparkContext._jsc.sc().getCheckpointDir()
    if current.isEmpty():
        if not re.fullmatch(r"local(\[.*\])?", spark.sparkContext.master):
            raise RuntimeError("set spark.checkpoint.dir to a folder that the driver and all executors share")
        spark.sparkContext.setCheckpointDir(tempfile.mkdtemp(prefix="strandline-"))
        current = spark.sparkContext._jsc.sc().getCheckpointDir()
    return current.get().rstrip("/")


def scratch_path(spark: SparkSession, name: str) -> str:
    """A new path in the shared folder; what is written there is removed when the driver ends."""
    path = f"{shared_folder(spark)}/{name}-{uuid.uuid4().hex}"
    atexit.register(_remove, spark, path)
    return path


def materialise(df: DataFrame, keep_for: str = "cut") -> DataFrame:
    """Write ``df`` once to the shared folder and read it back.

    The written files survive lost executors and later plans start from them, so nothing
    upstream is computed twice. The folder is removed when the driver ends.
    """
    spark = df.sparkSession
    path = scratch_path(spark, keep_for)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def ship_code(spark: SparkSession) -> None:
    """Make this package importable by the Python workers of every executor, once per context."""
    sc = spark.sparkContext
    if getattr(sc, "_strandline_shipped", False):
        return
    root = Path(__file__).resolve().parent
    target = Path(tempfile.mkdtemp(prefix="strandline-code-")) / "strandline.zip"
    with zipfile.ZipFile(target, "w") as z:
        for file in root.rglob("*.py"):
            z.write(file, Path(root.name) / file.relative_to(root))
    sc.addPyFile(str(target))
    sc._strandline_shipped = True


def discard(df: DataFrame) -> None:
    """Remove the files behind a ``materialise`` result that nothing reads any more."""
    for path in {f.rsplit("/", 1)[0] for f in df.inputFiles()}:
        _remove(df.sparkSession, path)


def release(spark: SparkSession) -> None:
    """Let Spark remove the shuffle files of steps that are done.

    It does so once the driver's heap no longer holds their plans, which on a large heap may be long after; until then the
    disk holds what every step before has shuffled.
    """
    gc.collect()
    spark.sparkContext._jvm.System.gc()


def _remove(spark: SparkSession, path: str) -> None:
    try:
        jvm = spark.sparkContext._jvm
        target = jvm.org.apache.hadoop.fs.Path(path)
        target.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(target, True)
    except Exception:  # the JVM has gone; a folder of a finished run is all that remains
        pass
