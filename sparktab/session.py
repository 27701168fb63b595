"""Session helpers: a local session for tests, and the shared working folder."""

from __future__ import annotations

import re
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

CHECKPOINT_KEY = "spark.checkpoint.dir"


def local_session(app: str = "sparktab", cores: int | str = 8) -> SparkSession:
    """A local session with the settings the tests and the bench use."""
    spark = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(app)
        .config("spark.sql.shuffle.partitions", "8")
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.driver.memory", "12g")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def shared_dir(spark: SparkSession) -> str:
    """The folder every executor can reach, as named by the cluster.

    Reads ``spark.checkpoint.dir``. Only a local master may go without the
    setting; it then gets a fresh temporary folder, kept for the session.
    """
    configured = spark.conf.get(CHECKPOINT_KEY, None)
    configured = configured or spark.sparkContext.getConf().get(CHECKPOINT_KEY)
    if configured:
        return configured.rstrip("/")
    if not re.match(r"local(\[|$)", spark.sparkContext.master):
        raise RuntimeError(f"set {CHECKPOINT_KEY} to a folder all executors share")
    folder = tempfile.mkdtemp(prefix="sparktab-")
    spark.conf.set(CHECKPOINT_KEY, folder)
    spark.sparkContext.setCheckpointDir(folder)
    return folder


def scratch_path(spark: SparkSession, name: str) -> str:
    """A path under the shared folder that no other run uses."""
    return f"{shared_dir(spark)}/{name}-{uuid.uuid4().hex}"


def materialize(df: DataFrame, name: str) -> DataFrame:
    """Write a table to the shared folder and read it back.

    For results that several jobs read: the table outlives lost executors and
    cuts the lineage. It is removed when the driver's process ends.
    """
    spark = df.sparkSession
    path = scratch_path(spark, name)
    df.write.parquet(path)
    store, folder = _stored(spark, path)
    store.deleteOnExit(folder)
    return spark.read.schema(df.schema).parquet(path)


def _stored(spark: SparkSession, path: str):
    """The file system of a path, and the path as it takes it."""
    folder = spark._jvm.org.apache.hadoop.fs.Path(path)
    return folder.getFileSystem(spark._jsc.hadoopConfiguration()), folder


def path_exists(spark: SparkSession, path: str) -> bool:
    store, folder = _stored(spark, path)
    return store.exists(folder)


def remove_path(spark: SparkSession, path: str) -> None:
    """Remove a folder of results that newer ones replace."""
    store, folder = _stored(spark, path)
    store.delete(folder, True)
