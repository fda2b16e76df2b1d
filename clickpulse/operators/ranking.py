"""Ranks within groups."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from clickpulse.storage import durable


def top_n(df: DataFrame, by: list[str], count: str, tie: str, n: int) -> DataFrame:
    """The ``n`` rows of each group with the highest count, numbered in ``rn``.

    Equal counts are ordered by ``tie``. Spark limits every partition to its own
    best ``n`` per group before it shuffles, so a hot group does no harm.
    """
    order = Window.partitionBy(*by).orderBy(F.desc(count), F.asc(tie))
    return df.withColumn("rn", F.row_number().over(order)).where(F.col("rn") <= n)


def preview(df: DataFrame, order: list[Column], n: int = 5) -> DataFrame:
    """The first ``n`` rows; each task hands on no more than that."""
    return df.orderBy(*order).limit(n)


def running_ranks(counted: DataFrame, by: list[str], value: str) -> DataFrame:
    """Rows with distinct values per group, numbered from 0 in order of the value: ``rank``.

    The rows are dealt by ranges of group and value and numbered within their range; the
    sizes of a group's ranges before it, one row each, give the start. So a hot group is
    numbered by many tasks. The ranges are written once, as both steps must meet the same.
    """
    ranged = counted.repartitionByRange(*by, value)
    ranged = durable(ranged.withColumn("range", F.spark_partition_id()))
    sizes = ranged.groupBy(*by, "range").agg(F.count(F.lit(1)).alias("size"))
    earlier = Window.partitionBy(*by).orderBy("range").rowsBetween(Window.unboundedPreceding, -1)
    starts = sizes.select(
        *by, "range", F.coalesce(F.sum("size").over(earlier), F.lit(0)).alias("start")
    )
    within = Window.partitionBy(*by, "range").orderBy(value)
    numbered = ranged.withColumn("at", F.row_number().over(within) - 1)
    same = [F.col(f"r.{name}").eqNullSafe(F.col(f"s.{name}")) for name in [*by, "range"]]
    joined = numbered.alias("r").join(starts.alias("s"), same)
    return joined.select("r.*", (F.col("start") + F.col("at")).alias("rank")).drop("at")
