"""Joins with small or skewed sides."""

from __future__ import annotations

from collections.abc import Mapping
from dataclasses import dataclass, field

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# The most rows and bytes a side may have to be sent to every executor.
BROADCAST_ROWS = 2_000_000
BROADCAST_BYTES = 64 << 20

# The most keys that are sent to a source as a list.
LISTED_KEYS = 10_000

# A key is hot if its rows would fill more than this part of an even task; the rows of a
# hot key are then cut into pieces of this size.
_PIECE = 0.25


def broadcast_bounded(side: DataFrame, rows: int) -> DataFrame:
    """Hint a broadcast for a side that by its making has at most ``rows`` rows."""
    return F.broadcast(side) if rows <= BROADCAST_ROWS else side


def is_small(side: DataFrame, max_rows: int = BROADCAST_ROWS, max_bytes: int = BROADCAST_BYTES) -> bool:
    """Measure a side: one job that counts rows and bytes where they are read."""
    widths = (F.octet_length(F.col(name).cast("string")) for name in side.columns)
    width = sum((F.coalesce(bytes_, F.lit(0)) for bytes_ in widths), F.lit(0))
    size = side.agg(F.count(F.lit(1)).alias("rows"), F.sum(width).alias("bytes")).first()
    return size.rows <= max_rows and (size.bytes or 0) <= max_bytes


def broadcast_if_small(side: DataFrame) -> DataFrame:
    """Hint a broadcast after measuring the side; a larger side stays as it is.

    For database tables, whose size Spark cannot know. For files Spark itself
    compares the size with its limit.
    """
    return F.broadcast(side) if is_small(side) else side


def look_up(table: DataFrame, keys: DataFrame, on: str, most: int = LISTED_KEYS) -> DataFrame:
    """The rows of a table, in files or a database, that have one of the keys of a batch.

    Up to ``most`` keys go to the source as a list, so it reads no other rows. Of more keys
    it gets the bounds, and a semi-join picks the rows.
    """
    wanted = keys.select(on).where(F.col(on).isNotNull()).distinct()
    few = [row[0] for row in wanted.limit(most + 1).collect()]
    if len(few) <= most:
        return table.where(F.col(on).isin(few))
    low, high = wanted.agg(F.min(on), F.max(on)).first()
    return table.where(F.col(on).between(low, high)).join(wanted, on, "left_semi")


@dataclass(frozen=True)
class Members:
    """Keys to keep or drop, measured once for all joins of a job.

    ``pieces`` says into how many pieces the rows of each hot key are cut; it is empty
    for members that are broadcast.
    """

    keys: DataFrame
    on: str
    small: bool
    pieces: Mapping = field(default_factory=dict)


def measured(rows: DataFrame, members: DataFrame, on: str) -> Members:
    """Measure members for joins with ``rows``, or with a selection of them.

    Few members are broadcast, which saves the shuffle of all rows; their filters often
    leave few of a table that Spark takes for large. Otherwise the rows are counted by
    key, combined before the shuffle, to find the hot keys. Of these there can be only a
    few per partition of a shuffle, however many rows there are.
    """
    keys = members.select(on)
    if is_small(keys):
        return Members(keys, on, small=True)
    partitions = int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    counts = rows.where(F.col(on).isNotNull()).groupBy(on).agg(F.count(F.lit(1)).alias("n"))
    total = counts.agg(F.sum("n")).first()[0] or 0
    piece = max(1.0, total / partitions * _PIECE)
    hot = counts.where(F.col("n") > piece).collect()
    return Members(keys, on, False, {row[on]: int(row.n // piece) + 1 for row in hot})


def keep_members(rows: DataFrame, members: DataFrame | Members, on: str) -> DataFrame:
    """Rows whose key occurs in ``members`` (semi-join)."""
    return _member_join(rows, members, on, "left_semi")


def drop_members(rows: DataFrame, members: DataFrame | Members, on: str) -> DataFrame:
    """Rows whose key does not occur in ``members`` (anti-join)."""
    return _member_join(rows, members, on, "left_anti")


def _member_join(rows: DataFrame, members: DataFrame | Members, on: str, how: str) -> DataFrame:
    """Join on the key, and for hot keys on the piece as well.

    Only hot members are copied, once for each piece; any piece gives the same rows.
    Adaptive execution splits hot partitions too, but judges them by compressed bytes,
    which a hot key's similar rows keep low.
    """
    known = members if isinstance(members, Members) else measured(rows, members, on)
    if known.small:
        return rows.join(F.broadcast(known.keys), on, how).select(*rows.columns)
    if not known.pieces:
        return rows.join(known.keys, on, how).select(*rows.columns)
    kind = rows.schema[on].dataType
    hot = rows.sparkSession.createDataFrame(list(known.pieces.items()), ["_key", "_pieces"])
    hot = F.broadcast(hot.select(F.col("_key").cast(kind).alias(on), F.col("_pieces").cast("int")))
    pieces = F.coalesce("_pieces", F.lit(1))
    cut = F.pmod(F.monotonically_increasing_id(), pieces).cast("int")
    salted = rows.join(hot, on, "left").withColumn("_piece", cut)
    copies = known.keys.join(hot, on, "left")
    copies = copies.withColumn("_piece", F.explode(F.sequence(F.lit(0), pieces - 1)))
    return salted.join(copies.drop("_pieces"), [on, "_piece"], how).select(*rows.columns)
