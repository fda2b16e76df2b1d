"""Ad clicks: parsing, blacklist, running counts, top ads and trend.

Parsing, blacklist filter and running counts work on batch and stream alike.
"""

from __future__ import annotations

from math import gcd

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from clickpulse.functions.text import split_words, strip_blanks
from clickpulse.functions.times import COMPACT_FORMAT, format_millis, from_millis
from clickpulse.operators.joins import drop_members
from clickpulse.operators.ranking import top_n
from clickpulse.schemas import AD_CLICK, CLICK_COLUMNS

# Windows (seconds), blacklist threshold and ads per province.
BLACKLIST_WINDOW, BLACKLIST_SLIDE = 300, 30
BLACKLIST_THRESHOLD = 100
TREND_WINDOW, TREND_SLIDE = 600, 60
TOP_ADS = 5

# Milliseconds of the first and last moment of the years 1 to 9999.
FIRST_MS, LAST_MS = -62_135_596_800_000, 253_402_300_799_999

COUNT_KEYS = ["date", "province", "city", "ad_id"]
PROVINCE_KEYS = ["date", "province", "ad_id"]


def parse_clicks(lines: DataFrame) -> DataFrame:
    """Clicks from lines ``ts_ms province city user_id ad_id`` in column ``value``.

    Lines with a missing field, a bad number or a time outside the years 1 to 9999
    are dropped; further fields are ignored. The fields leave a generator, below which Spark cannot push the null
    check: each line is split once.
    """
    stripped = lines.select(strip_blanks(F.col("value")).alias("line"))
    words = stripped.select(split_words(F.col("line")).alias("words"))
    fields = (
        F.get("words", F.lit(position)).try_cast(field.dataType).alias(field.name)
        for position, field in enumerate(AD_CLICK)
    )
    clicks = words.select(F.inline(F.array(F.struct(*fields)))).dropna(subset=CLICK_COLUMNS)
    return clicks.where(F.col("ts_ms").between(FIRST_MS, LAST_MS))


def not_blacklisted(clicks: DataFrame, blacklist: DataFrame) -> DataFrame:
    """Clicks of users that are not on the blacklist."""
    return drop_members(clicks, blacklist, "user_id")


def sliding_counts(clicks: DataFrame, key: str, size: int, slide: int) -> DataFrame:
    """Clicks per key and window: ``window_end_ms``, every ``slide`` seconds.

    A window holds ``[end - size, end)`` of the click time; windows without
    clicks are absent. The ends of a span are listed last, so neither a shuffle
    nor an aggregation sees the copies of a click in its many windows.
    """
    return pane_windows(pane_counts(clicks, key, size, slide), key, size, slide)


def pane_windows(panes: DataFrame, key: str, size: int, slide: int) -> DataFrame:
    """Clicks per key and window from the clicks per key and pane."""
    spans = window_spans(panes, key, size, slide)
    ends = F.sequence("first_end", "last_end", _millis(slide))
    return spans.select(key, F.explode(ends).alias("window_end_ms"), "click_count")


def window_spans(panes: DataFrame, key: str, size: int, slide: int) -> DataFrame:
    """Spans of windows with the same clicks: first_end, last_end and click_count.

    Clicks of a pane enter the count at the first window that holds the pane and
    leave it after the last. The running sum of these changes is the count of the
    window. A key has at most two rows per pane of the period, however many
    clicks, so a hot key is no burden.
    """
    if size < slide:
        raise ValueError("windows must not leave gaps")
    start, step = F.col("pane"), _millis(slide)
    enter = _round_up(start + _millis(gcd(size, slide)), step)
    leave = _round_down(start + _millis(size), step) + step
    changes = panes.select(
        key,
        F.inline(
            F.array(
                F.struct(enter.alias("first_end"), F.col("clicks").alias("change")),
                F.struct(leave.alias("first_end"), (-F.col("clicks")).alias("change")),
            )
        ),
    )
    # Changes at the same end share one sum; all but the last of them span nothing.
    ends = Window.partitionBy(key).orderBy("first_end")
    return changes.select(
        key,
        "first_end",
        (F.lead("first_end").over(ends) - step).alias("last_end"),
        F.sum("change").over(ends).alias("click_count"),
    ).where("click_count > 0 AND last_end >= first_end")


def blacklist_candidates(
    clicks: DataFrame,
    blacklist: DataFrame,
    whitelist: DataFrame,
    threshold: int = BLACKLIST_THRESHOLD,
    size: int = BLACKLIST_WINDOW,
    slide: int = BLACKLIST_SLIDE,
) -> DataFrame:
    """Users with more than ``threshold`` clicks in a window, and their highest count.

    Users already listed and whitelisted users are left out; clicks are counted
    per user and pane before these joins.
    """
    _whole_slides(size, slide)
    panes = pane_counts(clicks, "user_id", size, slide)
    for excluded in (blacklist, whitelist):
        panes = panes.join(excluded.select("user_id"), "user_id", "left_anti")
    return busy_users(panes, threshold, size, slide)


def busy_users(
    panes: DataFrame,
    threshold: int = BLACKLIST_THRESHOLD,
    size: int = BLACKLIST_WINDOW,
    slide: int = BLACKLIST_SLIDE,
) -> DataFrame:
    """Users with more than ``threshold`` clicks in a window, and their highest count.

    Shifting a user's fullest window to end with its last click loses none, so a moving
    sum over the user's panes finds the count without listing the windows.
    """
    _whole_slides(size, slide)
    window = Window.partitionBy("user_id").orderBy("pane").rangeBetween((slide - size) * 1000, 0)
    return (
        panes.withColumn("count", F.sum("clicks").over(window))
        .where(F.col("count") > threshold)
        .groupBy("user_id")
        .agg(F.max("count").cast("int").alias("count"))
    )


def running_counts(clicks: DataFrame) -> DataFrame:
    """Clicks per day, province, city and ad."""
    return _daily_counts(clicks, COUNT_KEYS)


def province_counts(counts: DataFrame) -> DataFrame:
    """Running counts of cities added up per province."""
    return counts.groupBy(*PROVINCE_KEYS).agg(F.sum("click_count").alias("click_count"))


def province_click_counts(clicks: DataFrame) -> DataFrame:
    """Clicks per day, province and ad, counted directly."""
    return _daily_counts(clicks, PROVINCE_KEYS)


def top_province_ads(counts: DataFrame, n: int = TOP_ADS) -> DataFrame:
    """The ``n`` most clicked ads of each day and province."""
    return top_n(counts, ["date", "province"], "click_count", "ad_id", n)


def click_trend(clicks: DataFrame, size: int = TREND_WINDOW, slide: int = TREND_SLIDE) -> DataFrame:
    """Clicks per ad in sliding windows, stamped with the end of the window."""
    return stamped_trend(sliding_counts(clicks, "ad_id", size, slide))


def stamped_trend(windows: DataFrame) -> DataFrame:
    """Windows of ads with the end as a stamp."""
    return windows.select(
        "ad_id",
        "click_count",
        format_millis(F.col("window_end_ms"), COMPACT_FORMAT).alias("window_end"),
    )


def _daily_counts(clicks: DataFrame, keys: list[str]) -> DataFrame:
    """Clicks per group; the day stays a date until the groups are counted."""
    dated = clicks.withColumn("date", F.to_date(from_millis(F.col("ts_ms"))))
    counts = dated.groupBy(*keys).agg(F.count(F.lit(1)).alias("click_count"))
    return counts.withColumn("date", F.col("date").cast("string"))


def pane_counts(clicks: DataFrame, key: str, size: int, slide: int) -> DataFrame:
    """Clicks per key and pane, the longest span that no window border cuts.

    A pane is named by its start in milliseconds.
    """
    pane = _round_down(F.col("ts_ms"), _millis(gcd(size, slide)))
    return clicks.groupBy(key, pane.alias("pane")).agg(F.count(F.lit(1)).alias("clicks"))


def _whole_slides(size: int, slide: int) -> None:
    if size % slide:
        raise ValueError("the window must be a multiple of its slide")


def _millis(seconds: int) -> Column:
    return F.lit(seconds * 1000).cast("long")


def _round_down(millis: Column, step: Column) -> Column:
    return millis - F.pmod(millis, step)


def _round_up(millis: Column, step: Column) -> Column:
    return millis + F.pmod(-millis, step)
