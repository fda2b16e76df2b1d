"""The streaming job over ad clicks."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming import StreamingQuery

from clickpulse.operators.clicks import BLACKLIST_THRESHOLD
from clickpulse.sinks import jdbc as sink
from clickpulse.sources.jdbc import Database, Slices, read_jdbc
from clickpulse.streaming.outputs import ClickStream


def start_click_job(
    spark: SparkSession,
    lines: DataFrame,
    database: Database,
    whitelist: DataFrame,
    output: str,
    slices: Slices | None = None,
    threshold: int = BLACKLIST_THRESHOLD,
    late: str | None = None,
    trigger: dict | None = None,
) -> list[StreamingQuery]:
    """Start the queries that update blacklist, running counts, top ads and trend.

    ``lines`` is a stream with the text column ``value``. ``output`` must be the same
    shared folder at every start, so that counts go on where they ended; it holds
    results and checkpoints, and ``ClickTables(spark, output)`` reads them. ``slices``
    reads a large blacklist in parallel.
    """

    def blacklist() -> DataFrame:
        return read_jdbc(spark, database, sink.BLACKLIST_TABLE, slices)

    def append(users: DataFrame) -> None:
        sink.write_jdbc(users, database, sink.BLACKLIST_TABLE)

    stream = ClickStream(lines, blacklist, append, whitelist, output, threshold, late=late)
    return stream.start(trigger)
