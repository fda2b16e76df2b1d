"""The click stream over several micro-batches, against the batch operators."""

import json
import random
from pathlib import Path

import pytest
from pyspark.sql import functions as F

from clickpulse.operators import clicks as ops
from clickpulse.operators.joins import look_up
from clickpulse.sources.streams import read_text_stream
from clickpulse.storage import write_whole
from clickpulse.streaming import outputs, state

USERS = "user_id int"
BLACK = "user_id int, count int"
TREND = ["ad_id", "window_end", "click_count"]


def lines(count, seed):
    pick = random.Random(seed)
    for _ in range(count):
        city, user = pick.randrange(6), pick.randrange(20)
        ad = "bad" if pick.random() < 0.1 else pick.randrange(8)
        second = 1704067200 + pick.randrange(3 * 86400 // 24)
        yield f"{second}{pick.randrange(1000):03} p{city % 3} c{city} {user} {ad}"


class Feed:
    """A stream over text files, one per batch, with its own folders and blacklist."""

    def __init__(self, spark, path, whitelist, listed=((3, 101), (4, 101)), threshold=10**6):
        self.spark, self.path, self.threshold = spark, path, threshold
        self.lines, self.table = str(path / "lines"), str(path / "black")
        self.out = path / "out"
        Path(self.lines).mkdir(parents=True)
        self.whitelist = whitelist
        spark.createDataFrame(list(listed), BLACK).write.parquet(self.table)
        self.files = 0

    def add(self, *texts):
        (Path(self.lines) / f"part-{self.files}").write_text("\n".join(texts))
        self.files += 1

    def listed(self):
        return self.spark.read.schema(BLACK).parquet(self.table)

    def append(self, users):
        users.write.mode("append").parquet(self.table)

    def stream(self, append=None, **options):
        return outputs.ClickStream(
            read_text_stream(self.spark, self.lines, files_per_batch=1),
            self.listed,
            append or self.append,
            self.whitelist,
            str(self.out),
            self.threshold,
            **options,
        )

    def run(self, **options):
        """Take all files in; each was written before the stream ran last, or is new."""
        stream = self.stream(**options)
        stream.run_available()
        return stream.tables

    def parsed(self):
        return ops.parse_clicks(self.spark.read.text(self.lines))

    def forget_last_commit(self, name):
        """As after a failure behind the last write: the commit of the last batch is missing."""
        commits = self.out / "checkpoints" / name / "commits"
        last = max(int(p.name) for p in commits.iterdir() if p.name.isdigit())
        for file in (str(last), f".{last}.crc"):
            (commits / file).unlink()


@pytest.fixture
def feed(spark, frame, tmp_path):
    return lambda **options: Feed(spark, tmp_path / "feed", frame(USERS, (5,)), **options)


@pytest.fixture
def four(feed):
    made = feed()
    for part in range(4):
        made.add(*lines(300, part))
    return made


def check_all(made, tables, clean, rows):
    counts = ops.running_counts(clean)
    assert rows(tables.counts(), *counts.columns) == rows(counts)
    top = ops.top_province_ads(ops.province_counts(counts))
    assert rows(tables.top_ads(), *top.columns) == rows(top)
    assert rows(tables.trend(), *TREND) == rows(ops.click_trend(clean), *TREND)
    windows = ops.sliding_counts(clean, "user_id", ops.BLACKLIST_WINDOW, ops.BLACKLIST_SLIDE)
    assert rows(tables.user_windows(), *windows.columns) == rows(windows)


def test_outputs_equal_the_batch_operators(four, rows):
    queries = four.stream().run_available()
    assert queries[0].lastProgress["batchId"] == 3
    clean = ops.not_blacklisted(four.parsed(), four.listed())
    assert rows(outputs.ClickTables(four.spark, str(four.out)).clicks()) == rows(clean)
    check_all(four, four.stream().tables, clean, rows)


def test_state_is_restored_after_a_restart(feed, rows):
    """Each part comes to queries that were started anew; the lists change in between."""
    made = feed(threshold=3)
    for part in range(4):
        made.add(*lines(150, part))
        tables = made.run()
        check_all(made, tables, tables.clicks(), rows)
    assert made.listed().count() > 2


def test_state_lives_in_the_store_that_saves_changes(four):
    four.run(outputs=frozenset({"counts"}))
    checkpoint = four.out / "checkpoints" / "counts"
    offsets = (checkpoint / "offsets" / "0").read_text().splitlines()
    conf = json.loads(offsets[1])["conf"]
    assert "RocksDB" in conf["spark.sql.streaming.stateStore.providerClass"]
    assert list((checkpoint / "state" / "0").glob("*/*.changelog"))
    # The session keeps its own settings.
    assert "RocksDB" not in four.spark.conf.get("spark.sql.streaming.stateStore.providerClass")


def test_a_batch_writes_what_it_changed(spark, feed, rows):
    """One click changes one count, one list and ten windows, however many came before."""
    made = feed()
    made.add(*lines(400, 0))
    made.run()
    made.add("1704067200000 p0 c0 1 999")
    tables = made.run()
    second = lambda name, schema: state.read_changes(
        spark, f"{made.out}/{name}", schema
    ).where("batch_id = 1")
    assert rows(second("counts", state.COUNTS)) == [("2024-01-01", "p0", "c0", 999, 1, 1)]
    assert second("user_panes", state.panes_schema("user_id")).count() == 1
    assert second("ad_panes", state.panes_schema("ad_id")).count() == 1
    check_all(made, tables, ops.not_blacklisted(made.parsed(), made.listed()), rows)


def test_an_untouched_group_is_not_rewritten(spark, feed, rows):
    made = feed()
    made.add("1704067200000 p1 c 1 7", "1704067200000 p2 c 1 7", "1704067200000 p2 c 1 8")
    made.run(outputs=frozenset({"top_ads"}))
    made.add("1704067200000 p1 c 1 7", *["1704067200000 p1 c 1 9"] * 3)
    tables = made.run(outputs=frozenset({"top_ads"}))
    written = state.read_changes(spark, f"{made.out}/top_ads", state.TOP_ADS)
    assert rows(written.where("batch_id = 1"), "province", "ad_id", "click_count", "rn") == [
        ("p1", 7, 2, 2),
        ("p1", 9, 3, 1),
    ]
    assert rows(tables.top_ads(), "province", "ad_id", "rn") == [
        ("p1", 7, 2),
        ("p1", 9, 1),
        ("p2", 7, 1),
        ("p2", 8, 2),
    ]


def test_an_ad_that_was_pushed_out_comes_back(feed, rows):
    made = feed()
    click = lambda ad: f"1704067200000 p c 1 {ad}"
    made.add(*(click(ad) for ad in range(5)), click(5))
    made.add(*[click(ad) for ad in range(1, 6)])
    made.add(click(0), click(0))
    tables = made.run(outputs=frozenset({"top_ads"}))
    assert rows(tables.top_ads(), "rn", "ad_id", "click_count") == [
        (1, 0, 3),
        (2, 1, 2),
        (3, 2, 2),
        (4, 3, 2),
        (5, 4, 2),
    ]


def test_listed_in_one_batch_and_absent_in_the_next(feed, rows):
    made = feed(threshold=2)
    click = lambda second, user: f"{1704067200 + second}000 p c {user} 1"
    for part in (
        (click(0, 1), click(10, 1), click(20, 2)),
        (click(30, 1), click(40, 1), click(50, 2), click(60, 5)),
        (click(70, 1), click(80, 2), click(90, 5), click(91, 5)),
        (click(100, 2),),
    ):
        made.add(*part)
        tables = made.run()
    # User 1 crosses in the second batch with four clicks, user 2 in the third with three.
    assert rows(made.listed()) == [(1, 4), (2, 3), (3, 101), (4, 101)]
    assert rows(tables.clicks().groupBy("user_id").count()) == [(1, 4), (2, 3), (5, 3)]


@pytest.mark.parametrize("size,slide", [(300, 30), (60, 60), (120, 40), (300, 70)])
def test_busy_users_by_spans(spark, frame, rows, size, slide):
    """The fullest window of each user, also before 1970; users alone hold each busy pane."""
    pick = random.Random(size + slide)
    made = [(pick.randrange(-3000, 3000) * 400, pick.randrange(8)) for _ in range(400)]
    clicks = frame("ts_ms bigint, user_id int", *made, (0, None), (1, None), (2, None))
    most = {}
    for user in {user for _, user in made} | {None}:
        times = [ts for ts, who in made if who == user] if user is not None else [0, 1, 2]
        starts = range(-(1_300_000 // (slide * 1000)) * slide * 1000, 1_300_000, slide * 1000)
        most[user] = max(sum(0 <= ts - at < size * 1000 for ts in times) for at in starts)
    for threshold in (2, 9):
        busy = state.over_threshold(clicks, threshold, size, slide)
        found = busy.groupBy("user_id").agg(F.max("count"))
        expected = sorted(((u, n) for u, n in most.items() if n > threshold), key=repr)
        assert rows(found) == expected


def test_a_click_is_in_few_rows_of_the_blacklist_state(feed, spark):
    """One click lies in ten windows, but state holds it in one or two spans."""
    made = feed(threshold=1)
    made.add(*(f"{1704067200 + 3600 * n}000 p c 1 {n}" for n in range(50)))
    made.run(outputs=frozenset({"blacklist"}))
    assert made.listed().where("user_id = 1").isEmpty()
    kept = spark.read.format("statestore").load(str(made.out / "checkpoints" / "blacklist"))
    assert 50 <= kept.count() <= 100


def test_busy_over_two_batches_with_a_bound(feed, rows):
    """A later batch fills a window up; with a bound, spans whose windows are over go."""
    made = feed(threshold=3)
    for part in ((0, 20), (270, 280), (40_000,), (40_010,)):
        made.add(*(f"{1704067200 + second}000 p c 1 2" for second in part))
        made.run(outputs=frozenset({"blacklist"}), late="1 hour")
    assert rows(made.listed().where("user_id = 1")) == [(1, 4)]
    kept = made.spark.read.format("statestore").load(str(made.out / "checkpoints" / "blacklist"))
    assert kept.count() <= 2


NAMES = ["counts", "top_ads", "trend", "user_windows", "clicks"]


def test_batches_that_run_again_change_nothing(feed, rows):
    made = feed(threshold=2)
    for part in range(2):
        made.add(*lines(100, part))
        tables = made.run()
    before = [rows(getattr(tables, name)()) for name in NAMES]
    listed = rows(made.listed())
    for name in ("clean", "counts", "user_panes", "ad_panes", "province_counts", "top_ads", "blacklist"):
        made.forget_last_commit(name)
    made.run()
    assert [rows(getattr(tables, name)()) for name in NAMES] == before
    assert rows(made.listed()) == listed


@pytest.mark.parametrize("whole", [True, False])
def test_a_crash_between_append_and_commit_adds_no_user_twice(feed, rows, whole):
    """The append is done, or done for some users only, when the query fails."""
    made = feed(threshold=1)
    made.add(*(f"17040672{n:02}000 p c {user} 1" for n in range(9) for user in (1, 2, 6, 5, 3)))

    def failing(users):
        made.append(users if whole else users.where("user_id = 1"))
        raise RuntimeError("lost the database")

    with pytest.raises(Exception, match="lost the database"):
        made.run(append=failing)
    made.run()
    made.run()
    assert rows(made.listed()) == [(1, 9), (2, 9), (3, 101), (4, 101), (6, 9)]


def test_stream_goes_on_where_it_ended(four, rows):
    first = rows(four.run().counts())
    assert rows(four.run().counts()) == first


def test_lines_out_of_range_and_far_ahead(feed, rows):
    """A time that is no time is dropped; one far ahead hides no later click."""
    made = feed()
    made.add("9223372036854775807 p c 1 2", "-9223372036854775808 p c 1 2", "1704067200000 p c 1 2")
    made.add("4102444800000 p c 1 2")  # the year 2100
    made.add("1704067210000 p c 1 2", "253402300799999 p c 1 2", "-62135596800000 p c 1 2")
    made.add("1704067220000 p c 6 2")
    tables = made.run()
    assert rows(tables.trend(), *TREND) == rows(ops.click_trend(made.parsed()), *TREND)
    assert sum(row[-1] for row in rows(tables.counts())) == 6


def test_clicks_that_come_too_late_for_windows(feed, rows):
    """With a bound, windows leave the state and late clicks count only where days do."""
    made = feed()
    options = {"late": "1 hour", "outputs": frozenset({"trend", "counts"})}
    for part in (
        ("1704067200000 p c 1 2", "1704067800000 p c 1 2"),
        ("1704074400000 p c 1 2",),  # two hours later
        ("1704067201000 p c 1 2", "1704074401000 p c 1 2"),
    ):
        made.add(*part)
        tables = made.run(**options)
    kept = ops.parse_clicks(made.spark.read.text(made.lines)).where("ts_ms != 1704067201000")
    assert rows(tables.trend(), *TREND) == rows(ops.click_trend(kept), *TREND)
    assert rows(tables.counts(), "click_count") == [(5,)]


def test_windows_cross_midnight(feed, rows):
    made = feed(threshold=1)
    made.add("1704153599000 p c 1 2")
    made.add("1704153601000 p c 1 2")
    tables = made.run()
    assert (1, 2) in rows(made.listed())
    assert rows(tables.trend(), *TREND) == rows(ops.click_trend(made.parsed()), *TREND)


def test_stream_without_input(feed):
    made = feed()
    tables = made.run()
    for name in NAMES:
        assert getattr(tables, name)().count() == 0
    made.add("", "no click")
    tables = made.run()
    for name in NAMES:
        assert getattr(tables, name)().count() == 0


def test_queries_side_by_side(feed, rows):
    made = feed()
    made.add(*lines(50, 1))
    queries = made.stream().start({"processingTime": "1 second"})
    try:
        for query in queries:
            query.processAllAvailable()
    finally:
        for query in queries:
            query.stop()
    check_all(made, made.stream().tables, ops.not_blacklisted(made.parsed(), made.listed()), rows)


def test_no_copies_of_clicks_in_panes(four):
    panes = ops.pane_counts(four.parsed(), "ad_id", ops.TREND_WINDOW, ops.TREND_SLIDE)
    stream = state.stream_panes(four.parsed(), "ad_id", ops.TREND_WINDOW, ops.TREND_SLIDE)
    assert "Expand" not in stream._jdf.queryExecution().executedPlan().toString()
    assert sorted(map(tuple, stream.collect())) == sorted(map(tuple, panes.collect()))


@pytest.mark.parametrize("most", [10, 2])
def test_look_up_reads_only_wanted_rows(spark, frame, rows, tmp_path, most):
    spark.range(1000).selectExpr("cast(id as int) AS user_id", "1 AS count").write.parquet(
        str(tmp_path / "black")
    )
    table = spark.read.parquet(str(tmp_path / "black"))
    keys = frame(USERS, (5,), (7,), (7,), (None,), (2000,))
    found = look_up(table, keys, "user_id", most)
    assert rows(found) == [(5, 1), (7, 1)]
    plan = found._jdf.queryExecution().executedPlan().toString()
    assert ("In(user_id" in plan) == (most == 10) and "PushedFilters: []" not in plan
    assert rows(look_up(table, keys.limit(0), "user_id", most)) == []


def test_a_folder_appears_whole_or_not_at_all(spark, frame, tmp_path):
    rows = frame(USERS, (1,))
    write_whole(rows, str(tmp_path), "part=1")
    assert sorted(p.name for p in tmp_path.iterdir() if "crc" not in p.name) == ["part=1"]
    assert spark.read.parquet(str(tmp_path / "part=1")).count() == 1


def test_unknown_output_is_refused(four):
    with pytest.raises(ValueError, match="no such outputs"):
        four.run(outputs=frozenset({"tops"}))


def test_preview(spark, four):
    query = outputs.start_preview(ops.parse_clicks(read_text_stream(spark, four.lines)), mode="append")
    query.stop()
    assert query.exception() is None
