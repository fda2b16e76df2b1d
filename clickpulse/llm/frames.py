"""Inputs under names of our own, so that no column can clash, and durable intermediates."""

from __future__ import annotations

import ctypes
from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from clickpulse.storage import remove, run_dir, shared_dir


class Input:
    """A frame whose columns are numbered while an operator works on it.

    `frame` has the columns in0, in1, ...; `self[name]` is the column that the caller knows
    by that name; `results` gives the caller's columns back with new ones at the end, each
    in place of an input column of its name.
    """

    def __init__(self, df: DataFrame) -> None:
        self.names = df.columns
        self.frame = df.toDF(*(f"in{i}" for i in range(len(self.names))))

    def name(self, column: str) -> str:
        lower = [n.lower() for n in self.names]
        if column.lower() not in lower:
            raise ValueError(f"no column {column!r} among {self.names}")
        return f"in{lower.index(column.lower())}"

    def __getitem__(self, column: str) -> Column:
        return F.col(self.name(column))

    def results(self, df: DataFrame, new: dict[str, Column]) -> DataFrame:
        replaced = {n.lower() for n in new}
        kept = [
            F.col(f"in{i}").alias(n) for i, n in enumerate(self.names) if n.lower() not in replaced
        ]
        return df.select(*kept, *(value.alias(n) for n, value in new.items()))


def durable(df: DataFrame) -> DataFrame:
    """Write the frame to the shared checkpoint folder and go on from there."""
    context = df.sparkSession.sparkContext
    if context.getCheckpointDir() is None:
        context.setCheckpointDir(shared_dir(df.sparkSession))
    return df.checkpoint()


class Steps:
    """Frames written as Parquet to the shared folder, to go on from their files.

    Unlike checkpoints they are compressed, and Spark knows their true sizes, which else are
    estimated from all joins before and grow without end in a loop. `remove` takes all of
    them away, once what was made of them is written elsewhere.
    """

    def __init__(self, spark: SparkSession) -> None:
        self.spark, self.folder, self.count = spark, run_dir(spark, "steps"), 0

    def __call__(self, df: DataFrame) -> DataFrame:
        path = f"{self.folder}/{self.count}"
        self.count += 1
        df.write.parquet(path)
        # Executors keep shuffle files of past steps until the driver collects its garbage.
        self.spark._jvm.System.gc()
        return self.spark.read.schema(df.schema).parquet(path)

    def remove(self) -> None:
        remove(self.spark, self.folder)


def tidy(step: Callable[[Iterator], Iterator]) -> Callable[[Iterator], Iterator]:
    """The step of a task, after which the worker gives memory back to the system.

    Workers wait for their next task with all that Arrow and the allocator have kept.
    """

    def run(batches: Iterator) -> Iterator:
        try:
            yield from step(batches)
        finally:
            pa.default_memory_pool().release_unused()
            try:
                ctypes.CDLL(None).malloc_trim(0)
            except (AttributeError, OSError):
                pass  # another C library

    return run
