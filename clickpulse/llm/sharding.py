"""Two-pass external shuffle into shards.

The first pass scatters records by seeded hashes of their ids: a shard is the one whose
hash with the id is highest, so one more shard takes records only into itself, and a
second hash picks one of the shard's buckets, each small enough for memory. The second
pass loads each bucket, shuffles it (Fisher-Yates, as Spark's shuffle() does) and writes
the buckets of a shard one after the other.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from clickpulse.llm.frames import Input

#: Bytes besides the text that a record counts for.
RECORD_BYTES = 8


def pick_shard(key: Column, shards: int, seed: int) -> Column:
    """The shard from 0 whose hash with the key is highest."""
    draws = [
        F.struct(F.xxhash64(key, F.lit(seed), F.lit(n)).alias("h"), F.lit(n).alias("n"))
        for n in range(shards)
    ]
    best = F.greatest(*draws) if shards > 1 else draws[0]
    return best["n"]


def shuffle_into_shards(
    docs: DataFrame,
    shards: int = 24,
    bucket_bytes: int = 8 << 20,
    seed: int = 7,
    id: str = "doc_id",
    text: str = "text",
) -> DataFrame:
    """Give every record a shard, and a slot in the shard's shuffled order.

    Adds size (UTF-8 bytes of the text plus 8; a null text has none), shard, grown_shard
    (the shard if there were one more) and slot (0, 1, ... without gaps in each shard).
    Buckets hold bucket_bytes on average, whatever the size of the table; a single text
    may be longer. Records of one id share a shard; repeated rows are kept and get slots
    of their own. A null id is an id like any other. An empty table gives an empty table.
    A result column replaces an input column of its name.
    """
    given = Input(docs)
    size = F.coalesce(F.octet_length(given[text]), F.lit(0)).cast("long") + RECORD_BYTES
    total = given.frame.agg(F.sum(size)).head()[0] or 0
    each = max(1, math.ceil(total / shards / bucket_bytes))
    key = given[id]
    within = F.pmod(F.xxhash64(key, F.lit(seed), F.lit("bucket")), F.lit(each)).cast("int")
    placed = given.frame.withColumns({"size": size, "shard": pick_shard(key, shards, seed)})
    placed = placed.withColumn("bucket", F.col("shard") * F.lit(each).cast("long") + within)

    # One row per bucket: how many records the shard has before it.
    counts = placed.groupBy("shard", "bucket").agg(F.count("*").alias("n"))
    before = Window.partitionBy("shard").orderBy("bucket").rowsBetween(
        Window.unboundedPreceding, -1
    )
    offset = F.coalesce(F.sum("n").over(before), F.lit(0)).cast("long")
    offsets = counts.select("bucket", offset.alias("before"))

    # A fixed number of partitions: the seed of a bucket's shuffle hangs on its partition.
    parts = shards * each
    record = F.struct(*placed.columns)
    loaded = (
        placed.repartition(parts, "bucket")
        .sortWithinPartitions("bucket", given.name(id), F.xxhash64(given[text]))
        .groupBy("bucket")
        .agg(F.collect_list(record).alias("records"))
    )
    joined = loaded.join(offsets.repartition(parts, "bucket").hint("shuffle_hash"), "bucket")
    shuffled = joined.select(
        "before", F.posexplode(F.shuffle("records", F.lit(seed))).alias("at", "record")
    ).select("record.*", (F.col("before") + F.col("at")).alias("slot"))
    return given.results(
        shuffled,
        {
            "size": F.col("size"),
            "shard": F.col("shard"),
            "grown_shard": pick_shard(key, shards + 1, seed),
            "slot": F.col("slot"),
        },
    )


def write_shards(sharded: DataFrame, path: str) -> None:
    """One folder per shard; a file holds whole buckets, in the order of their slots."""
    sharded.write.mode("overwrite").partitionBy("shard").parquet(path)
