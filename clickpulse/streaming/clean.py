"""The clean clicks of a stream: parsed lines of users who are not on the blacklist."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming import StreamingQuery

from clickpulse.operators import clicks as ops
from clickpulse.operators.joins import look_up
from clickpulse.schemas import AD_CLICK
from clickpulse.storage import exists, write_whole


def start_clean(
    lines: DataFrame,
    read_blacklist: Callable[[], DataFrame],
    folder: str,
    checkpoint: str,
    trigger: dict,
) -> StreamingQuery:
    """Write each micro-batch's clean clicks to ``folder/batch_id=n``.

    The blacklist is read anew in each batch, for the batch's users only. A batch that
    runs again after a failure keeps what its first run wrote, even if the blacklist has
    grown meanwhile, so all that follows sees each click once.
    """

    def update(batch: DataFrame, batch_id: int) -> None:
        name = f"batch_id={batch_id}"
        if exists(batch.sparkSession, f"{folder}/{name}"):
            return
        clicks = ops.parse_clicks(batch).persist()
        try:
            listed = look_up(read_blacklist(), clicks, "user_id")
            write_whole(ops.not_blacklisted(clicks, listed), folder, name)
        finally:
            clicks.unpersist()

    writer = lines.writeStream.foreachBatch(update).option("checkpointLocation", checkpoint)
    return writer.trigger(**trigger).start()


def stream_clicks(spark: SparkSession, folder: str, files_per_batch: int | None = None) -> DataFrame:
    """The clean clicks as a stream, each once."""
    reader = spark.readStream.schema(AD_CLICK)
    if files_per_batch:
        reader = reader.option("maxFilesPerTrigger", files_per_batch)
    return reader.parquet(f"{folder}/batch_id=*")


def read_clicks(spark: SparkSession, folder: str) -> DataFrame:
    """All clean clicks so far."""
    if not exists(spark, folder):
        return spark.createDataFrame([], AD_CLICK)
    return spark.read.schema(AD_CLICK).parquet(folder).select(*AD_CLICK.names)
