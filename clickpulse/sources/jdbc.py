"""Relational tables: city dimension, blacklist and task parameters."""

from __future__ import annotations

from collections.abc import Mapping
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, DataFrameReader, SparkSession
from pyspark.sql import functions as F

from clickpulse.params import JobParams


@dataclass(frozen=True)
class Database:
    """Where the relational tables live; ``options`` holds user, password, driver."""

    url: str
    options: Mapping[str, str] = field(default_factory=dict)


@dataclass(frozen=True)
class Slices:
    """How to read a big table in parallel: ranges of a numeric or time column."""

    column: str
    lower: str
    upper: str
    count: int


def read_jdbc(
    spark: SparkSession, database: Database, table: str, slices: Slices | None = None
) -> DataFrame:
    """A table; filters and column choices on the result run in the database.

    Nothing is read before an action runs, and every micro-batch of a stream
    reads the table afresh.
    """
    return _reader(spark, jdbc_options(database, table, slices)).load()


def jdbc_options(database: Database, table: str, slices: Slices | None = None) -> dict[str, str]:
    options = {**database.options, "url": database.url, "dbtable": table}
    if slices:
        options |= {
            "partitionColumn": slices.column,
            "lowerBound": slices.lower,
            "upperBound": slices.upper,
            "numPartitions": str(slices.count),
        }
    return options


def _reader(spark: SparkSession, options: dict[str, str]) -> DataFrameReader:
    return spark.read.format("jdbc").options(**options)


def find_params(tasks: DataFrame, task_id: int) -> JobParams:
    """Parameters of one task; an unknown task is an error."""
    rows = tasks.where(F.col("task_id") == task_id).select("task_param").take(1)
    if not rows:
        raise ValueError(f"unknown task {task_id}")
    return JobParams.from_json(rows[0].task_param)
