"""The click stream: clean clicks, and the queries that keep results of them up to date.

One query cleans the lines. The others read the clean clicks, each with its own checkpoint
and state, so one that falls behind or fails holds up no other. All live below one folder.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass
from functools import partial

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming import StreamingQuery

from clickpulse.operators import clicks as ops
from clickpulse.streaming import state
from clickpulse.streaming.clean import read_clicks, start_clean, stream_clicks

# Trigger interval and rows of a preview.
TRIGGER = "10 seconds"
PREVIEW_ROWS = 5

OUTPUTS = frozenset({"blacklist", "counts", "top_ads", "trend", "user_windows"})

_USER_WINDOW = ("user_id", ops.BLACKLIST_WINDOW, ops.BLACKLIST_SLIDE)
_AD_WINDOW = ("ad_id", ops.TREND_WINDOW, ops.TREND_SLIDE)


@dataclass(frozen=True)
class ClickTables:
    """What a click stream has written below its folder, as it stands."""

    spark: SparkSession
    path: str

    def clicks(self) -> DataFrame:
        """Clicks by users who were not listed when they came."""
        return read_clicks(self.spark, f"{self.path}/clicks")

    def counts(self) -> DataFrame:
        """Clicks per day, province, city and ad."""
        return state.current_totals(self._changes("counts", state.COUNTS), "click_count")

    def top_ads(self) -> DataFrame:
        """The most clicked ads per day and province."""
        return state.last_lists(self._changes("top_ads", state.TOP_ADS))

    def user_windows(self) -> DataFrame:
        """Clicks per user in the sliding windows of the blacklist."""
        return ops.pane_windows(self._panes("user_panes", "user_id"), *_USER_WINDOW)

    def trend(self) -> DataFrame:
        """Clicks per ad in the sliding windows of the trend."""
        return ops.stamped_trend(ops.pane_windows(self._panes("ad_panes", "ad_id"), *_AD_WINDOW))

    def _panes(self, name: str, key: str) -> DataFrame:
        return state.current_totals(self._changes(name, state.panes_schema(key)), "clicks")

    def _changes(self, name: str, schema: str) -> DataFrame:
        return state.read_changes(self.spark, f"{self.path}/{name}", schema)


@dataclass(frozen=True)
class ClickStream:
    """A click stream below ``path``, a shared folder that is the same at every start.

    ``read_blacklist`` gives the list as it stands, ``append`` adds rows to it. Users
    over the threshold are listed once, and their clicks left out from the next batch of
    lines on that begins after that. Errors stop the query they occur in.

    Windows follow the time of the click. ``late`` bounds how long after newer ones a
    click may come and still count in windows, and with it the state; by default none
    is too late. Running counts and top ads take every click.
    """

    lines: DataFrame
    read_blacklist: Callable[[], DataFrame]
    append: Callable[[DataFrame], None]
    whitelist: DataFrame
    path: str
    threshold: int = ops.BLACKLIST_THRESHOLD
    top: int = ops.TOP_ADS
    outputs: frozenset[str] = OUTPUTS
    late: str | None = None

    def __post_init__(self) -> None:
        unknown = set(self.outputs) - OUTPUTS
        if unknown:
            raise ValueError(f"no such outputs: {sorted(unknown)}")

    @property
    def tables(self) -> ClickTables:
        return ClickTables(self.lines.sparkSession, self.path)

    def start(self, trigger: dict | None = None) -> list[StreamingQuery]:
        """Start all queries; they run side by side until they are stopped."""
        trigger = trigger or {"processingTime": TRIGGER}
        return [start(trigger) for step in self._steps() for start in step]

    def run_available(self) -> list[StreamingQuery]:
        """Take in all lines that are there, and bring all outputs up to date.

        The queries run one step after the other: clean clicks, then what reads them.
        """
        done = []
        for step in self._steps():
            queries = [start({"availableNow": True}) for start in step]
            for query in queries:
                query.awaitTermination()
            done += queries
        return done

    def _steps(self) -> list[list[Callable[[dict], StreamingQuery]]]:
        spark, folder = self.lines.sparkSession, f"{self.path}/clicks"
        checkpoint = f"{self.path}/checkpoints/{{}}".format
        clean = partial(start_clean, self.lines, self.read_blacklist, folder, checkpoint("clean"))
        clicks = stream_clicks(spark, folder)

        def changes(name: str, rows: DataFrame) -> Callable[[dict], StreamingQuery]:
            return partial(state.start_changes, rows, f"{self.path}/{name}", checkpoint(name))

        second, third = [], []
        if "blacklist" in self.outputs:
            busy = state.over_threshold(clicks, self.threshold, late=self.late)
            listing = (busy, self.read_blacklist, self.append, self.whitelist)
            second.append(partial(state.start_blacklist, *listing, checkpoint("blacklist")))
        if "counts" in self.outputs:
            second.append(changes("counts", ops.running_counts(clicks)))
        if "user_windows" in self.outputs:
            panes = state.stream_panes(clicks, *_USER_WINDOW, self.late)
            second.append(changes("user_panes", panes))
        if "trend" in self.outputs:
            second.append(changes("ad_panes", state.stream_panes(clicks, *_AD_WINDOW, self.late)))
        if "top_ads" in self.outputs:
            second.append(changes("province_counts", ops.province_click_counts(clicks)))
            totals = state.stream_totals(
                spark, f"{self.path}/province_counts", state.PROVINCE_COUNTS
            )
            third.append(changes("top_ads", state.stream_top_ads(totals, self.top)))
        return [step for step in ([clean], second, third) if step]


def start_preview(stream: DataFrame, rows: int = PREVIEW_ROWS, mode: str = "update") -> StreamingQuery:
    """Print the first rows of every micro-batch."""
    writer = stream.writeStream.outputMode(mode).format("console").option("numRows", rows)
    return writer.trigger(processingTime=TRIGGER).start()
