"""Stateful queries over clean clicks.

State lives in Spark's RocksDB store, which saves what a batch changed instead of whole
snapshots. Every query runs in update mode and writes, per micro-batch, only the keys
that changed, with their new totals; a batch that runs again replaces its folder by equal
rows. Totals only grow, so the largest is the current one.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from contextlib import contextmanager
from functools import reduce
from math import gcd
from operator import add

import pandas as pd
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.streaming.state import GroupState, GroupStateTimeout

from clickpulse.functions.times import from_millis
from clickpulse.operators import clicks as ops
from clickpulse.operators.joins import look_up
from clickpulse.storage import exists

# Spark's settings for state in RocksDB, saved as changes. Rows are not counted
# for its metrics, as that takes another read for each key that is written or restored.
STATE_STORE = {
    "spark.sql.streaming.stateStore.providerClass": "org.apache.spark.sql.execution.streaming"
    ".state.RocksDBStateStoreProvider",
    "spark.sql.streaming.stateStore.rocksdb.changelogCheckpointing.enabled": "true",
    "spark.sql.streaming.stateStore.rocksdb.trackTotalNumberOfRows": "false",
}

COUNTS = "date string, province string, city string, ad_id int, click_count bigint"
PROVINCE_COUNTS = "date string, province string, ad_id int, click_count bigint"
TOP_ADS = "date string, province string, ad_id int, click_count bigint, rn int"


def panes_schema(key: str) -> str:
    return f"{key} int, pane bigint, clicks bigint"


@contextmanager
def _state_store(spark: SparkSession) -> Iterator[None]:
    """The settings while a query starts; it keeps them, the session gets its own back."""
    before = {name: spark.conf.get(name, None) for name in STATE_STORE}
    for name, value in STATE_STORE.items():
        spark.conf.set(name, value)
    try:
        yield
    finally:
        for name, value in before.items():
            if value is None:
                spark.conf.unset(name)
            else:
                spark.conf.set(name, value)


def _start(
    changes: DataFrame, update: Callable[[DataFrame, int], None], checkpoint: str, trigger: dict
) -> StreamingQuery:
    writer = changes.writeStream.outputMode("update").foreachBatch(update)
    with _state_store(changes.sparkSession):
        return writer.option("checkpointLocation", checkpoint).trigger(**trigger).start()


def start_changes(
    changes: DataFrame, folder: str, checkpoint: str, trigger: dict
) -> StreamingQuery:
    """Write the changed keys of each micro-batch to ``folder/batch_id=n``."""

    def update(rows: DataFrame, batch_id: int) -> None:
        rows.write.mode("overwrite").parquet(f"{folder}/batch_id={batch_id}")

    return _start(changes, update, checkpoint, trigger)


def read_changes(spark: SparkSession, folder: str, schema: str) -> DataFrame:
    """What all micro-batches wrote, with the column ``batch_id``."""
    schema = f"{schema}, batch_id bigint"
    if not exists(spark, folder):
        return spark.createDataFrame([], schema)
    return spark.read.schema(schema).parquet(folder)


def current_totals(changes: DataFrame, total: str) -> DataFrame:
    """The last total of every key."""
    keys = [name for name in changes.columns if name not in (total, "batch_id")]
    return changes.groupBy(*keys).agg(F.max(total).alias(total))


def stream_totals(spark: SparkSession, folder: str, schema: str) -> DataFrame:
    """Changed keys as a stream; after a failure some may come twice."""
    return spark.readStream.schema(schema).parquet(f"{folder}/batch_id=*")


# Windows


def _timed(clicks: DataFrame, late: str | None) -> DataFrame:
    """Clicks with their time; those later than ``late`` are dropped, none by default."""
    timed = clicks.withColumn("ts", from_millis(F.col("ts_ms")))
    return timed.withWatermark("ts", late) if late else timed


def stream_panes(
    clicks: DataFrame, key: str, size: int, slide: int, late: str | None = None
) -> DataFrame:
    """Clicks per key and pane as state, one row for a click however many windows hold it.

    A late click changes its old pane. With ``late`` (such as "2 hours") panes that no
    click may change any more leave the state.
    """
    pane = F.window("ts", f"{gcd(size, slide)} seconds")
    counted = _timed(clicks, late).groupBy(key, pane).agg(F.count(F.lit(1)).alias("clicks"))
    return counted.select(key, F.unix_millis("window.start").alias("pane"), "clicks")


def over_threshold(
    clicks: DataFrame,
    threshold: int = ops.BLACKLIST_THRESHOLD,
    size: int = ops.BLACKLIST_WINDOW,
    slide: int = ops.BLACKLIST_SLIDE,
    late: str | None = None,
) -> DataFrame:
    """Users of the spans that a micro-batch changed, with their fullest window over the threshold.

    State is a user's clicks per pane of a span, not per window: a span holds as many
    windows as a click lies in and overlaps the next by all but one slide of a window, so
    every window lies whole in one span and a click in one or two. Where the slide does
    not divide the window, a span is a window. With ``late`` a span leaves the state
    when its last window is over.
    """
    windows, pane = (1, size) if size % slide else (size // slide, slide)
    length, held = (windows - 1) * slide + size, size // pane
    span = F.window("ts", f"{length} seconds", f"{windows * slide} seconds").alias("span")
    spans = _timed(clicks, late).select("user_id", "ts_ms", span)
    start = F.unix_millis("span.start")
    place = F.floor((F.col("ts_ms") - start) / (pane * 1000))
    panes = [f"pane_{n}" for n in range(windows - 1 + held)]
    counted = spans.withColumn("place", place).groupBy("user_id", "span").agg(
        *(F.count(F.when(F.col("place") == n, 1)).alias(name) for n, name in enumerate(panes))
    )
    # Most spans have too few clicks in all, which is cheaper to see.
    enough = counted.where(reduce(add, map(F.col, panes)) > threshold)
    counts = [reduce(add, map(F.col, panes[n : n + held])) for n in range(windows)]
    fullest = F.greatest(*counts) if len(counts) > 1 else counts[0]
    return enough.select("user_id", fullest.alias("count")).where(F.col("count") > threshold)


def start_blacklist(
    busy: DataFrame,
    read_blacklist: Callable[[], DataFrame],
    append: Callable[[DataFrame], None],
    whitelist: DataFrame,
    checkpoint: str,
    trigger: dict,
) -> StreamingQuery:
    """Append users over the threshold to the blacklist, each once, with their highest count.

    Who is listed is looked up for these users only, at the time of the append. So a
    batch that runs again after its append, whole or in part, adds only who is missing.
    """

    def update(rows: DataFrame, batch_id: int) -> None:
        found = rows.groupBy("user_id").agg(F.max("count").cast("int").alias("count"))
        users = found.join(whitelist.select("user_id"), "user_id", "left_anti").persist()
        try:
            if users.isEmpty():
                return
            listed = look_up(read_blacklist(), users, "user_id")
            append(users.join(listed.select("user_id"), "user_id", "left_anti"))
        finally:
            users.unpersist()

    return _start(busy, update, checkpoint, trigger)


# The most clicked ads


def stream_top_ads(totals: DataFrame, n: int = ops.TOP_ADS) -> DataFrame:
    """The ``n`` most clicked ads of the days and provinces whose list a micro-batch changed.

    ``totals`` are changed totals per day, province and ad. State is the list itself: as
    totals only grow, an ad that is neither on it nor changed cannot enter. A total that
    comes twice changes nothing.
    """

    def update(
        key: tuple, parts: Iterator[pd.DataFrame], state: GroupState
    ) -> Iterator[pd.DataFrame]:
        ads, counts = state.get if state.exists else ([], [])
        before = best = list(zip(ads, counts))
        for part in parts:
            known = pd.DataFrame(best, columns=["ad_id", "click_count"])
            both = pd.concat([known, part[["ad_id", "click_count"]]]) if best else part
            totals = both.groupby("ad_id")["click_count"].max().items()
            best = sorted(((int(a), int(c)) for a, c in totals), key=lambda x: (-x[1], x[0]))[:n]
        if best != before:
            state.update(([ad for ad, _ in best], [count for _, count in best]))
            yield pd.DataFrame(
                [(*key, ad, count, rn) for rn, (ad, count) in enumerate(best, 1)],
                columns=["date", "province", "ad_id", "click_count", "rn"],
            )

    return totals.groupBy("date", "province").applyInPandasWithState(
        update, TOP_ADS, "ads array<int>, counts array<bigint>", "update", GroupStateTimeout.NoTimeout
    )


def last_lists(changes: DataFrame) -> DataFrame:
    """The rows of the last micro-batch that wrote a day and province."""
    last = F.max("batch_id").over(Window.partitionBy("date", "province"))
    kept = changes.withColumn("_last", last).where("batch_id = _last")
    return kept.drop("batch_id", "_last")
