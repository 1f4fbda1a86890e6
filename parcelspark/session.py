"""Session factory and the folder that driver and executors share."""

from __future__ import annotations

import atexit
import os
import shutil
import tempfile
import uuid
import zipfile
from pathlib import Path

from pyspark.sql import DataFrame, SparkSession


def get_session(master: str = "local[*]", shuffle_partitions: int = 8, **conf: str) -> SparkSession:
    """A session with the settings that the engine relies on; `conf` adds or overrides."""
    builder = SparkSession.builder.master(master).appName("parcelspark")
    settings = {
        "spark.sql.session.timeZone": "UTC",
        "spark.sql.shuffle.partitions": str(shuffle_partitions),
        "spark.sql.adaptive.enabled": "true",
        # geometry kernels take long over few bytes: small partitions are not merged into one task
        "spark.sql.adaptive.coalescePartitions.minPartitionSize": "128k",
        "spark.sql.sources.partitionColumnTypeInference.enabled": "false",
        "spark.sql.parquet.outputTimestampType": "TIMESTAMP_MILLIS",
        "spark.ui.enabled": "false",
    }
    for key, value in {**settings, **conf}.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def shared_dir(spark: SparkSession) -> str:
    """The folder named by ``spark.checkpoint.dir``.

    Only a local session without that setting gets a temporary folder of its own; on a cluster a
    folder of one machine would not be seen by the others, so its absence is an error there.
    """
    found = spark.conf.get("spark.checkpoint.dir", None)
    if found:
        return found
    if not spark.sparkContext.master.startswith("local"):
        raise ValueError("spark.checkpoint.dir must name a folder that driver and executors share")
    path = tempfile.mkdtemp(prefix="parcelspark-")
    atexit.register(shutil.rmtree, path, True)
    spark.conf.set("spark.checkpoint.dir", f"file://{path}")
    return f"file://{path}"


def scratch(spark: SparkSession, name: str) -> str:
    """A path of its own in the shared folder, which drop_tables clears."""
    return f"{shared_dir(spark)}/tables/{spark.sparkContext.applicationId}/{name}-{uuid.uuid4().hex}"


def materialise(df: DataFrame, name: str) -> DataFrame:
    """Write `df` to the shared folder and read it back: lineage ends there, and the table
    survives the loss of any executor (unlike cached blocks). Shuffle files of the write go when it ends."""
    spark = df.sparkSession
    path = scratch(spark, name)
    cleaned = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
    before = spark.conf.get(cleaned)
    spark.conf.set(cleaned, "true")
    try:
        df.write.option("compression", "zstd").parquet(path)
    finally:
        spark.conf.set(cleaned, before)
    return spark.read.schema(df.schema).parquet(path)


def spread(df: DataFrame, *keys: str) -> DataFrame:
    """`df` dealt by `keys` to two tasks a core at least: a file of one row group is one task, however long a kernel takes
    over its rows."""
    n = max(df.rdd.getNumPartitions(), 2 * df.sparkSession.sparkContext.defaultParallelism)
    return df.repartition(n, *keys)


def drop_tables(spark: SparkSession) -> None:
    """Delete what this application has materialised, once its results have been written."""
    jvm = spark.sparkContext._jvm
    path = jvm.org.apache.hadoop.fs.Path(f"{shared_dir(spark)}/tables/{spark.sparkContext.applicationId}")
    path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(path, True)


def ship_package(spark: SparkSession) -> None:
    """Make this package importable by Python workers that would not find it: neither on PYTHONPATH nor
    in the working folder. Spark serves the archive from the driver to every executor."""
    root = Path(__file__).resolve().parent.parent
    reach = [*os.environ.get("PYTHONPATH", "").split(os.pathsep), os.getcwd()]
    if any(p and Path(p).resolve() == root for p in reach) or spark.conf.get("parcelspark.shipped", None):
        return
    folder = tempfile.mkdtemp(prefix="parcelspark-ship-")  # the driver serves it to executors until it ends
    atexit.register(shutil.rmtree, folder, True)
    archive = Path(folder) / "parcelspark.zip"
    with zipfile.ZipFile(archive, "w") as z:
        for p in sorted((root / "parcelspark").rglob("*.py")):
            z.write(p, p.relative_to(root))
    spark.sparkContext.addPyFile(str(archive))
    spark.conf.set("parcelspark.shipped", "true")
