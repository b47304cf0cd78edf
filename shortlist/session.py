"""Session settings and lineage cuts."""

from __future__ import annotations

import gc
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

# Joins of rows to per-group statistics are left to adaptive execution: it
# broadcasts a side by its measured size and splits a skewed partition. The
# split is kept even where the join output would be reused by its key.
RUNTIME_SETTINGS = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
}
# Whether Spark deletes the shuffle files of an action when it ends, not when the driver next collects its garbage.
SHUFFLE_CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


def configure(spark: SparkSession) -> SparkSession:
    """Apply the runtime settings that the operators rely on."""
    for key, value in RUNTIME_SETTINGS.items():
        spark.conf.set(key, value)
    return spark


def local_session(cores: int | str = 8, name: str = "shortlist") -> SparkSession:
    """A local session for tests and benchmarks."""
    builder = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(name)
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.driver.memory", "8g")
        .config("spark.sql.shuffle.partitions", str(cores))
    )
    spark = configure(builder.getOrCreate())
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def shared_folder(spark: SparkSession) -> str:
    """The folder the cluster names in ``spark.checkpoint.dir``.

    A temporary folder is used only on a local master where none is set.
    """
    folder = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if folder is None:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder shared by all executors")
        folder = tempfile.mkdtemp(prefix="shortlist-")
        spark.sparkContext.setCheckpointDir(folder)
    return folder


def written(df: DataFrame, codec: str = "snappy") -> DataFrame:
    """Write ``df`` to the shared folder, compressed by ``codec``, and read it back.

    Cuts the lineage before a frame is used several times. Unlike a checkpoint
    the table is columnar, so later scans read only what they need, and a lost
    executor costs no recomputation. The shuffle files of the writing go as it ends.
    """
    spark = df.sparkSession
    path = f"{shared_folder(spark).rstrip('/')}/shortlist-{uuid.uuid4().hex}"
    before = spark.conf.get(SHUFFLE_CLEANUP, "false")
    spark.conf.set(SHUFFLE_CLEANUP, "true")
    try:
        df.write.option("compression", codec).parquet(path)
    finally:
        spark.conf.set(SHUFFLE_CLEANUP, before)
    return spark.read.schema(df.schema).parquet(path)


def discard(table: DataFrame) -> None:
    """Delete a table of :func:`written` that nothing reads any more; other tables stay."""
    jvm = table.sparkSession._jvm
    for folder in {file.rsplit("/", 1)[0] for file in table.inputFiles()}:
        path = jvm.org.apache.hadoop.fs.Path(jvm.java.net.URI(folder))
        if path.getName().startswith("shortlist-"):
            path.getFileSystem(table.sparkSession._jsc.hadoopConfiguration()).delete(path, True)


def tidy_driver(spark: SparkSession) -> None:
    """Collect the driver's garbage, so that one stage's does not add to the next one's memory.

    Python goes first, since its objects hold plans in the JVM, whose heap shrinks to what is in use.
    """
    gc.collect()
    spark.sparkContext._jvm.System.gc()
