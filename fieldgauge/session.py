"""Session settings and the shared folder used for lineage cuts and staging."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

SETTINGS = {
    # all dates, hours and windows are UTC
    "spark.sql.session.timeZone": "UTC",
    # let the runtime size shuffles, split skewed join partitions and switch to
    # broadcast only after it has measured a side
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
}


def configure(spark: SparkSession) -> SparkSession:
    """Apply the runtime settings the operators rely on; returns the session."""
    for key, value in SETTINGS.items():
        if spark.conf.get(key, None) != value:
            spark.conf.set(key, value)
    return spark


def shared_folder(spark: SparkSession) -> str:
    """The folder all executors can reach, as named by ``spark.checkpoint.dir``.

    Only a local-mode session without the setting gets a folder of its own: a
    machine-local path would not survive the loss of an executor.
    """
    folder = spark.conf.get("spark.checkpoint.dir", None)
    if folder:
        return folder.rstrip("/")
    if not spark.sparkContext.master.startswith("local"):
        raise RuntimeError("set spark.checkpoint.dir to a folder every executor can reach")
    folder = tempfile.mkdtemp(prefix="fieldgauge-")
    spark.conf.set("spark.checkpoint.dir", folder)
    return folder


def staging_path(spark: SparkSession, label: str) -> str:
    """A fresh path below the shared folder; nothing is created or cleared."""
    return f"{shared_folder(spark)}/fieldgauge/{label}-{uuid.uuid4().hex}"


def path_exists(spark: SparkSession, path: str) -> bool:
    """Whether a path exists, on whatever file system it names."""
    target = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return target.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).exists(target)


def folders(spark: SparkSession, path: str) -> list[str]:
    """Names of the folders directly below ``path``; none if it is not there."""
    target = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    files = target.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    if not files.exists(target):
        return []
    return [s.getPath().getName() for s in files.listStatus(target) if s.isDirectory()]


def materialise(df: DataFrame, label: str = "cut") -> DataFrame:
    """Cut lineage through a written table, so a lost executor costs no recomputation."""
    path = staging_path(df.sparkSession, label)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
