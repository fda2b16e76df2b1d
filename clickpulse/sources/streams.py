"""Click streams as a frame with the text column ``value``."""

from __future__ import annotations

import json
from collections.abc import Callable, Mapping

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from clickpulse.storage import exists, write_whole


# Offsets by topic and partition.
Offsets = Mapping[str, Mapping[int, int]]

#: What a ledger of offsets holds, one row per partition and read: ``run`` numbers the
#: reads, ``next_offset`` is the first that the read did not take.
LEDGER = "run bigint, topic string, partition int, next_offset bigint"

# How the Kafka source names the ends of a partition.
EARLIEST, LATEST = -2, -1


def kafka_options(
    servers: str,
    topics: list[str],
    offsets: Offsets | None = None,
    max_per_trigger: int | None = None,
) -> dict[str, str]:
    """Options of the Kafka source as a stream.

    ``offsets`` maps topic and partition to the first offset to read. Every
    partition of a topic must be listed; without offsets reading starts at the end.
    ``max_per_trigger`` bounds the messages of a micro-batch over all partitions.
    """
    options = {
        "kafka.bootstrap.servers": servers,
        "subscribe": ",".join(topics),
        "startingOffsets": _offsets_json(topics, offsets) if offsets else "latest",
    }
    if max_per_trigger:
        options["maxOffsetsPerTrigger"] = str(max_per_trigger)
    return options


def replay_options(servers: str, start: Offsets, end: Offsets) -> dict[str, str]:
    """Options of one bounded read: from the offsets ``start`` up to, not with, ``end``.

    Both must list the same partitions, and no partition may end before it starts.
    """
    topics = sorted(start)
    if {t: set(start[t]) for t in start} != {t: set(end[t]) for t in end}:
        raise ValueError("start and end list different partitions")
    for topic in topics:
        for part, at in start[topic].items():
            if at >= 0 and 0 <= end[topic][part] < at:
                raise ValueError(f"{topic} {part} ends before it starts")
    return {
        "kafka.bootstrap.servers": servers,
        "subscribe": ",".join(topics),
        "startingOffsets": _offsets_json(topics, start),
        "endingOffsets": _offsets_json(topics, end),
    }


def check_partitions(offsets: Offsets, partitions: Mapping[str, int]) -> None:
    """Refuse offsets unless they list each of a topic's ``partitions`` (0 to n - 1) once."""
    for topic, count in partitions.items():
        listed = set(offsets.get(topic, ()))
        if listed != set(range(count)):
            missing, unknown = set(range(count)) - listed, listed - set(range(count))
            raise ValueError(f"{topic}: no offset for {sorted(missing)}, no partition {sorted(unknown)}")


def _offsets_json(topics: list[str], offsets: Offsets) -> str:
    if set(topics) != set(offsets):
        raise ValueError("offsets and topics differ")
    for topic, parts in offsets.items():
        if not parts or any(at < EARLIEST for at in parts.values()):
            raise ValueError(f"{topic} has no partitions, or a bad offset")
    return json.dumps({topic: {str(p): at for p, at in offsets[topic].items()} for topic in topics})


def next_offsets(messages: DataFrame, start: Offsets) -> DataFrame:
    """Where the next read starts: topic, partition, next_offset.

    ``messages`` has the source's columns topic, partition and offset. A partition without
    messages stays where it was; its offsets may have gaps, as after compaction.
    """
    spark = messages.sparkSession
    listed = [(topic, part, at) for topic, parts in start.items() for part, at in parts.items()]
    known = spark.createDataFrame(listed, "topic string, partition int, at bigint")
    read = messages.groupBy("topic", "partition").agg((F.max("offset") + 1).alias("read"))
    joined = known.join(read, ["topic", "partition"], "left")
    return joined.select("topic", "partition", F.coalesce("read", "at").alias("next_offset"))


def last_offsets(ledger: DataFrame) -> dict[str, dict[int, int]]:
    """The offsets of the last run of a ledger, one row per partition; none if it is empty."""
    last = ledger.agg(F.max("run")).first()[0]
    found: dict[str, dict[int, int]] = {}
    for row in ledger.where(F.col("run") == last).collect():
        found.setdefault(row.topic, {})[row.partition] = row.next_offset
    return found


def read_and_note(
    messages: DataFrame, start: Offsets, run: int, ledger: str, take: Callable[[DataFrame], None]
) -> None:
    """Hand a bounded read to ``take``, then note in the ledger's folder how far it went.

    A run that fails before the note reads the same messages again; one that is repeated
    after it replaces its note by the same. So ``take`` should replace what it wrote for
    the run, as ``sinks.files.replace_task`` does.
    """
    ends = next_offsets(messages, start)
    take(messages)
    write_whole(ends.coalesce(1), ledger, f"run={run}", replace=True)


def read_ledger(spark: SparkSession, path: str) -> DataFrame:
    if not exists(spark, path):
        return spark.createDataFrame([], LEDGER)
    return spark.read.schema(LEDGER).parquet(path)


def read_kafka(
    spark: SparkSession,
    servers: str,
    topics: list[str],
    offsets: Offsets | None = None,
    max_per_trigger: int | None = None,
) -> DataFrame:
    """Messages of Kafka topics (needs the Kafka connector on the class path)."""
    options = kafka_options(servers, topics, offsets, max_per_trigger)
    messages = spark.readStream.format("kafka").options(**options).load()
    return messages.select(F.col("value").cast("string").alias("value"))


def replay_kafka(spark: SparkSession, servers: str, start: Offsets, end: Offsets) -> DataFrame:
    """Messages between two sets of offsets, with topic, partition and offset, as a batch."""
    messages = spark.read.format("kafka").options(**replay_options(servers, start, end)).load()
    value = F.col("value").cast("string").alias("value")
    return messages.select("topic", "partition", "offset", value)


def read_text_stream(spark: SparkSession, path: str, files_per_batch: int | None = None) -> DataFrame:
    """Lines of the text files that appear in a folder."""
    reader = spark.readStream.format("text")
    if files_per_batch:
        reader = reader.option("maxFilesPerTrigger", files_per_batch)
    return reader.load(path)
