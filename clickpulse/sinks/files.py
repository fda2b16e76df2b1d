"""Text, JSON and parquet output."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from clickpulse.functions.text import or_null_text
from clickpulse.storage import write_whole


def as_json(df: DataFrame) -> DataFrame:
    """One JSON object per row in column ``value``; null fields are left out."""
    return df.select(F.to_json(F.struct(*df.columns)).alias("value"))


def as_delimited(df: DataFrame, separator: str = ",") -> DataFrame:
    """One delimited line per row in column ``value``; nulls are spelled out."""
    return df.select(
        F.concat_ws(separator, *(or_null_text(F.col(name)) for name in df.columns)).alias("value")
    )


def write_json_lines(df: DataFrame, path: str) -> None:
    """Replace the files below ``path`` with one JSON object per line."""
    as_json(df).write.mode("overwrite").text(path)


def replace_task(df: DataFrame, path: str, task_id: int, format: str = "parquet") -> None:
    """Write the rows of one task to its folder below ``path``; other tasks keep theirs.

    A task that runs again gets a new folder in place of the old, also if it has no rows any
    more, so however often it runs, its rows are there once. ``format`` may be "text" for
    frames with one text column, such as JSON lines.
    """
    write_whole(df, path, f"task_id={task_id}", format, replace=True)


def replace_tasks(df: DataFrame, path: str) -> None:
    """Write the rows of many tasks, told apart by ``task_id``, in one job.

    Folders of tasks without rows in ``df`` stay as they are.
    """
    writer = df.write.mode("overwrite").partitionBy("task_id")
    writer.option("partitionOverwriteMode", "dynamic").parquet(path)


def write_delimited(df: DataFrame, path: str, separator: str = ",") -> None:
    """Write delimited lines to a new folder."""
    as_delimited(df, separator).write.text(path)


def write_actions(actions: DataFrame, path: str) -> None:
    """Actions as parquet, one folder per date, so that date bounds skip whole folders.

    Rows are gathered by date into files of even size: Spark splits a busy day
    over several writers and merges quiet ones.
    """
    actions.hint("rebalance", "date").write.mode("overwrite").partitionBy("date").parquet(path)
