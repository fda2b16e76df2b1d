"""The shared folder for stream checkpoints and outputs, and folders that appear whole."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession


def shared_dir(spark: SparkSession) -> str:
    """The folder every executor can reach, as named in ``spark.checkpoint.dir``.

    Only a local master may fall back to a folder of this machine.
    """
    configured = spark.conf.get("spark.checkpoint.dir", None)
    if configured:
        return configured.rstrip("/")
    if spark.sparkContext.master.startswith("local"):
        return tempfile.mkdtemp(prefix="clickpulse-")
    raise ValueError("set spark.checkpoint.dir to a folder shared by the cluster")


def run_dir(spark: SparkSession, name: str) -> str:
    """A path below the shared folder that no other run uses."""
    return f"{shared_dir(spark)}/clickpulse/{name}-{uuid.uuid4().hex}"


def durable(df: DataFrame) -> DataFrame:
    """The frame, computed once and written to the shared folder."""
    context = df.sparkSession.sparkContext
    if context.getCheckpointDir() is None:
        context.setCheckpointDir(shared_dir(df.sparkSession))
    return df.checkpoint()


def _file_system(spark: SparkSession, path: str):
    place = spark._jvm.org.apache.hadoop.fs.Path(path)
    return place.getFileSystem(spark._jsc.hadoopConfiguration()), place


def exists(spark: SparkSession, path: str) -> bool:
    files, place = _file_system(spark, path)
    return files.exists(place)


def remove(spark: SparkSession, path: str) -> None:
    """Remove a folder and all below it."""
    files, place = _file_system(spark, path)
    files.delete(place, True)


def write_whole(
    rows: DataFrame, parent: str, name: str, format: str = "parquet", replace: bool = False
) -> None:
    """Write rows as ``parent/name`` so that readers meet all of its files or none.

    The files are written beside it, under a name that Spark's readers skip, and get
    theirs in one step. Needs a file system with such a step, as HDFS has. What is there
    already stays and is an error, or with ``replace`` goes right before the step.
    """
    spark = rows.sparkSession
    rows.write.mode("overwrite").format(format).save(f"{parent}/_{name}")
    files, staged = _file_system(spark, f"{parent}/_{name}")
    place = spark._jvm.org.apache.hadoop.fs.Path(f"{parent}/{name}")
    if files.exists(place):
        if not replace:
            raise FileExistsError(f"{parent}/{name}")
        files.delete(place, True)
    if not files.rename(staged, place):
        raise OSError(f"{parent}/{name} could not be named")
