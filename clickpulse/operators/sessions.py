"""Session metrics: lengths, histogram, hourly figures and the summary report.

A session is a grouping key. Its actions are never gathered: minimum and maximum
times are combined before the shuffle, so a hot session costs one row per task.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from clickpulse.functions.text import plain_number
from clickpulse.functions.times import parse_time

# Upper bounds (seconds, exclusive) and names of the length classes.
LENGTH_BUCKETS = {"A": 5, "B": 11, "C": 31, "D": 60, "E": 180, "F": 360}
LONGEST_BUCKET = "G"


def session_lengths(actions: DataFrame) -> DataFrame:
    """Seconds between the first and the last action of each session."""
    seconds = actions.select("session_id", F.unix_timestamp(parse_time(F.col("action_time"))).alias("at"))
    return seconds.groupBy("session_id").agg((F.max("at") - F.min("at")).alias("length_s"))


def session_totals(lengths: DataFrame) -> DataFrame:
    """Number of sessions, their total length and the number shorter than a second."""
    return lengths.agg(
        F.count(F.lit(1)).alias("session_count"),
        F.coalesce(F.sum("length_s"), F.lit(0)).alias("total_length_s"),
        F.count_if(F.col("length_s") < 1).alias("invalid_count"),
    )


def length_bucket(length_s: Column) -> Column:
    """Class A to G of a session length in seconds."""
    cases = (F.when(length_s < bound, F.lit(name)) for name, bound in LENGTH_BUCKETS.items())
    return F.coalesce(*cases, F.lit(LONGEST_BUCKET))


def length_histogram(lengths: DataFrame) -> DataFrame:
    """Number of sessions per length class; empty classes are absent."""
    return lengths.groupBy(length_bucket(F.col("length_s")).alias("bucket")).agg(
        F.count(F.lit(1)).alias("session_count")
    )


def hourly_session_lengths(actions: DataFrame) -> DataFrame:
    """Length of each session within each hour, in milliseconds.

    Day and hour are those of the action time. A session that crosses an hour
    counts in both hours, each time with the span inside that hour.
    """
    return _hourly_spans(actions).select("day", "hour", "session_id", _span_ms().alias("length_ms"))


def hourly_metrics(hourly_lengths: DataFrame) -> DataFrame:
    """Sessions, their length (ms) and the number shorter than a second, per hour."""
    return hourly_lengths.groupBy("day", "hour").agg(
        F.count(F.lit(1)).alias("session_count"),
        F.sum("length_ms").alias("length_ms"),
        F.count_if(F.col("length_ms") < 1000).alias("invalid_count"),
    )


def hourly_session_counts(hourly_lengths: DataFrame) -> DataFrame:
    return hourly_metrics(hourly_lengths).select("day", "hour", "session_count")


def hourly_length_totals(hourly_lengths: DataFrame) -> DataFrame:
    return hourly_metrics(hourly_lengths).select("day", "hour", "length_ms")


def hourly_invalid_sessions(hourly_lengths: DataFrame) -> DataFrame:
    """Hours with sessions shorter than a second; other hours are absent."""
    return (
        hourly_metrics(hourly_lengths)
        .where(F.col("invalid_count") > 0)
        .select("day", "hour", "invalid_count")
    )


def session_report(actions: DataFrame) -> DataFrame:
    """All session metrics as one JSON document in column ``report``.

    The actions are read and shuffled once: sessions are put together from
    their hourly spans. The last step merges at most seven length classes and
    one row per hour of the period.
    """
    spans = _hourly_spans(actions)
    sessions = spans.groupBy("session_id").agg(
        (F.max("last_s") - F.min("first_s")).alias("length_s")
    )
    classes = sessions.groupBy(length_bucket(F.col("length_s")).alias("bucket")).agg(
        F.count(F.lit(1)).alias("session_count"),
        F.sum("length_s").alias("length_s"),
        F.count_if(F.col("length_s") < 1).alias("invalid_count"),
    )
    hours = hourly_metrics(spans.select("day", "hour", _span_ms().alias("length_ms")))
    parts = classes.unionByName(hours, allowMissingColumns=True)

    # A row belongs to a length class or to an hour; collecting skips nulls.
    of_class, of_hour = F.col("bucket").isNotNull(), F.col("hour").isNotNull()
    count, invalid = F.col("session_count"), F.col("invalid_count")
    return parts.agg(
        F.to_json(
            F.struct(
                _total(of_class, count).alias("total_session_count"),
                plain_number(_total(of_class, F.col("length_s"))).alias("total_session_length"),
                _total(of_class, invalid).alias("invalid_session_count"),
                _listed(of_class, F.col("bucket").alias("type"), count.alias("count")).alias(
                    "pre_session_type_of_count"
                ),
                _listed(of_hour, "day", "hour", count.alias("count")).alias(
                    "pre_hour_of_session_count"
                ),
                _listed(of_hour, "day", "hour", F.col("length_ms").alias("length")).alias(
                    "pre_hour_of_session_length"
                ),
                _listed(of_hour & (invalid > 0), "day", "hour", invalid.alias("invalid")).alias(
                    "pre_hour_of_invalid_session_count"
                ),
            )
        ).alias("report")
    )


def _hourly_spans(actions: DataFrame) -> DataFrame:
    """First and last second of each session within each day and hour.

    Maximum before minimum, as in the difference taken of them: the plans of both
    uses in the report then match, and Spark shuffles the spans once.
    """
    moments = actions.select("session_id", parse_time(F.col("action_time")).alias("at"))
    spans = moments.select(
        "session_id",
        F.to_date("at").alias("day"),
        F.hour("at").alias("hour"),
        F.unix_timestamp("at").alias("at_s"),
    )
    return (
        spans.groupBy("day", "hour", "session_id")
        .agg(F.max("at_s").alias("last_s"), F.min("at_s").alias("first_s"))
        .withColumn("day", F.col("day").cast("string"))
    )


def _span_ms() -> Column:
    return (F.col("last_s") - F.col("first_s")) * 1000


def _total(condition: Column, value: Column) -> Column:
    return F.coalesce(F.sum(F.when(condition, value)), F.lit(0))


def _listed(condition: Column, *columns: Column | str) -> Column:
    """The rows that satisfy the condition, in order, as an array of structs."""
    return F.array_sort(F.collect_list(F.when(condition, F.struct(*columns))))
