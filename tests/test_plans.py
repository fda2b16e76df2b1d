"""Properties of plans that matter at scale, and the jobs around them."""

import json

import pytest
from pyspark.sql import functions as F

from clickpulse import storage
from clickpulse.operators import areas, categories, clicks, joins, sessions
from clickpulse.operators.filters import filter_actions
from clickpulse.operators.joins import (
    broadcast_bounded,
    broadcast_if_small,
    drop_members,
    keep_members,
)
from clickpulse.params import JobParams
from clickpulse.plans import areas as area_job
from clickpulse.plans import clicks as click_job
from clickpulse.plans import sessions as session_job
from clickpulse.registry import views
from clickpulse.registry.queries import QUERIES
from clickpulse.sources.streams import read_text_stream
from clickpulse.sinks.jdbc import for_connections
from clickpulse.streaming.outputs import ClickTables


def plan(df, run=False):
    if run:
        df.collect()
    return df._jdf.queryExecution().executedPlan().toString()


def final_plan(df):
    return plan(df, run=True).split("Initial Plan")[0]


@pytest.fixture(scope="module")
def actions(spark, sf_dir, tmp_path_factory):
    """The actions as a table, so that scans can be checked."""
    path = str(tmp_path_factory.mktemp("tables") / "actions")
    views.user_visit_actions(spark, sf_dir).write.parquet(path)
    return spark.read.parquet(path)


@pytest.fixture
def settings(spark):
    """Set options of the session for one test."""
    before = {}

    def set_all(options):
        for key, value in options.items():
            before.setdefault(key, spark.conf.get(key))
            spark.conf.set(key, value)

    yield set_all
    for key, value in before.items():
        spark.conf.set(key, value)


@pytest.fixture
def no_broadcast(settings):
    settings({"spark.sql.autoBroadcastJoinThreshold": "-1"})


@pytest.mark.parametrize("name", [name for name in QUERIES if "stream" not in name])
def test_no_python_and_no_cross_join(spark, sf_dir, name):
    text = plan(QUERIES[name](spark, sf_dir))
    for word in ("Python", "Arrow", "Pandas", "CartesianProduct", "NestedLoop"):
        assert word not in text


def test_filters_and_columns_reach_the_scan(actions):
    selected = filter_actions(actions, None, JobParams("2024-01-05", "2024-01-24"))
    text = plan(sessions.session_lengths(selected))
    assert "GreaterThanOrEqual(date,2024-01-05), LessThanOrEqual(date,2024-01-24)" in text
    assert "ReadSchema: struct<date:string,session_id:string,action_time:string>" in text


def test_report_shuffles_the_actions_once(actions):
    text = final_plan(sessions.session_report(actions))
    assert text.count("FileScan") == 1
    assert text.count("ReusedExchange") == 1


def test_ranks_are_limited_before_the_shuffle(actions):
    top = categories.top_categories(categories.category_counts(actions))
    text = plan(categories.top_sessions(categories.category_session_counts(actions, top)))
    assert text.count("10, Partial") == text.count("10, Final") == 2


def test_top_lists_are_broadcast(actions, no_broadcast):
    top = categories.top_categories(categories.category_counts(actions))
    text = plan(categories.category_session_counts(actions, top))
    assert "BroadcastHashJoin [category_id" in text
    wide = plan(categories.category_session_counts(actions, top, n=1_000_000))
    assert "Broadcast" not in wide


def test_actions_are_counted_before_the_city_join(spark, sf_dir, actions, no_broadcast):
    clicks_per_city = areas.city_product_clicks(actions, views.city_info(spark, sf_dir))
    lines = plan(clicks_per_city).splitlines()
    join = next(i for i, line in enumerate(lines) if "SortMergeJoin [city_id" in line)
    assert any("partial_count" in line for line in lines[join:])


def test_candidates_are_counted_before_the_joins(spark, sf_dir, no_broadcast):
    parsed = clicks.parse_clicks(views.ad_click_lines(spark, sf_dir))
    users = views.blacklist(spark, sf_dir)
    lines = plan(clicks.blacklist_candidates(parsed, users, users)).splitlines()
    joins = [i for i, line in enumerate(lines) if "LeftAnti" in line]
    counts = [i for i, line in enumerate(lines) if "partial_count" in line]
    assert len(joins) == 2 and max(joins) < min(counts)


def test_lines_are_split_once(spark, sf_dir):
    assert plan(clicks.parse_clicks(views.ad_click_lines(spark, sf_dir))).count("split(") == 2


def test_hot_cities_are_split(spark, no_broadcast, settings):
    """Adaptive execution splits a hot key of an inner join; rows stay the same."""
    settings({
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "20KB",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": "10KB",
        "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "2",
    })
    city = F.when(F.col("id") % 3 == 0, 0).otherwise(F.col("id")).cast("int")
    rows = spark.range(0, 300_000, 1, 16).select(
        city.alias("city_id"), F.col("id").cast("string").alias("click_product_id")
    )
    cities = spark.range(200_000).select(
        F.col("id").cast("int").alias("city_id"),
        *(F.lit("x").alias(name) for name in ("city_name", "area", "province_name")),
    )
    joined = areas.actions_with_city(rows, cities)
    assert "skew=true" in final_plan(joined)
    assert joined.count() == sum(1 for i in range(300_000) if i % 3 == 0 or i < 200_000)


@pytest.fixture
def many_members(no_broadcast, monkeypatch):
    """As if no side were small."""
    monkeypatch.setattr(joins, "is_small", lambda side: False)


def test_few_members_are_broadcast(spark, frame, no_broadcast):
    rows = frame("user_id bigint, x int", (1, 1), (2, 1), (1, 2), (None, 3))
    members = spark.range(2).select(F.col("id").alias("user_id"))
    assert "BroadcastHashJoin" in plan(keep_members(rows, members, "user_id"))
    assert sorted(r.x for r in keep_members(rows, members, "user_id").collect()) == [1, 2]
    assert sorted(r.x for r in drop_members(rows, members, "user_id").collect()) == [1, 3]


@pytest.mark.parametrize("join, keeps", [(keep_members, True), (drop_members, False)])
def test_rows_of_a_hot_user_are_spread(spark, many_members, settings, join, keeps):
    settings({"spark.sql.adaptive.enabled": "false", "spark.sql.shuffle.partitions": "64"})
    user = F.when(F.col("id") % 3 == 0, 7).otherwise(F.col("id") + 100)
    rows = spark.range(0, 30_000, 1, 32).select(user.alias("user_id"), "id")
    members = spark.range(15_000).select(F.col("id").alias("user_id"))
    if not keeps:
        members = members.where("user_id <> 7")
    result = join(rows, members, "user_id")
    assert result.columns == rows.columns
    hot = result.where("user_id = 7").groupBy(F.spark_partition_id()).count()
    sizes = [row["count"] for row in hot.collect()]
    assert sum(sizes) == 10_000 and max(sizes) < 5_000
    listed = sum(1 for i in range(30_000) if i % 3 and i + 100 < 15_000)
    others = listed if keeps else 20_000 - listed
    assert result.count() == 10_000 + others


def test_measured_broadcast(spark, no_broadcast, monkeypatch):
    rows = spark.range(100).withColumnRenamed("id", "k")
    side = spark.range(50).select(F.col("id").alias("k"), F.lit("text").alias("name"))
    is_broadcast = lambda s: "BroadcastHashJoin" in plan(rows.join(s, "k"))
    assert is_broadcast(broadcast_if_small(side))
    with monkeypatch.context() as patch:
        patch.setattr(joins, "is_small", lambda side: False)
        assert not is_broadcast(broadcast_if_small(side))
    assert is_broadcast(broadcast_bounded(side, 50))
    assert not is_broadcast(broadcast_bounded(side, joins.BROADCAST_ROWS + 1))
    assert joins.is_small(side, 50, 290) and joins.is_small(side.limit(0), 0, 0)
    assert not joins.is_small(side, 49) and not joins.is_small(side, max_bytes=289)


def test_details_meet_the_users_last(spark, sf_dir, actions, many_members):
    users = views.user_info(spark, sf_dir)
    text = plan(session_job.session_results(actions, users, JobParams(sex="male")).details)
    assert text.index("SortMergeJoin [user_id") < text.index("BroadcastHashJoin [session_id")


def test_shared_dir(spark):
    configured = spark.conf.get("spark.checkpoint.dir")
    assert storage.shared_dir(spark) == configured
    assert storage.run_dir(spark, "x").startswith(f"{configured}/clickpulse/x-")


# Jobs. The database is replaced by frames: none is available here.


@pytest.fixture
def database(spark, sf_dir, monkeypatch, frame):
    tasks = frame(
        "task_id bigint, task_param string",
        (1, '{"startDate":"2024-01-05","endDate":"2024-01-24"}'),
        (2, '{"sex":"female"}'),
    )
    tables = {"tb_task": tasks, "city_info": views.city_info(spark, sf_dir)}
    written = {}

    def read(_spark, _database, table, slices=None):
        return tables[table]

    def write(df, _database, table, mode="append"):
        written[table] = sorted((tuple(row) for row in df.collect()), key=repr)

    for job in (session_job, area_job):
        monkeypatch.setattr(job, "read_jdbc", read)
        monkeypatch.setattr(job.sink, "write_jdbc", write)
    return written


@pytest.mark.parametrize("task", [1, 2])
def test_session_job(spark, sf_dir, actions, database, rows, tmp_path, task):
    users = views.user_info(spark, sf_dir)
    session_job.run_session_job(spark, None, task, str(tmp_path), actions, users)
    params = [JobParams("2024-01-05", "2024-01-24"), JobParams(sex="female")][task - 1]
    selected = filter_actions(actions, users, params)
    report = spark.read.text(f"{tmp_path}/session_report/task_{task}").first().value
    assert report == sessions.session_report(selected).first().report
    top = categories.top_categories(categories.category_counts(selected))
    best = categories.top_sessions(categories.category_session_counts(selected, top))
    pivot = rows(categories.category_pivot(top))
    assert database["tb_task_top10_category"] == sorted(((task, *row) for row in pivot), key=repr)
    lists = rows(categories.category_session_lists(best))
    assert database["tb_task_top10_category_session"] == sorted(((task, *row) for row in lists), key=repr)
    details = spark.read.text(f"{tmp_path}/top10_category_session/task_{task}").collect()
    expected = categories.session_details(selected, best)
    assert len(details) == expected.count() > 0
    assert list(json.loads(details[0].value)) == actions.columns


def test_area_job(spark, sf_dir, actions, database):
    products = views.product_info(spark, sf_dir)
    area_job.run_area_job(spark, None, 1, actions, None, products)
    assert len(database["tb_area_top10_product"]) == 50


def test_unknown_task_fails_first(spark, database, tmp_path):
    with pytest.raises(ValueError):
        session_job.run_session_job(spark, None, 3, str(tmp_path))


def test_area_job_with_actions_without_product(spark, sf_dir, actions, database):
    products = views.product_info(spark, sf_dir)
    area_job.run_area_job(spark, None, 1, actions, None, products, clicks_only=False)
    # The empty product takes a place in each of the five areas, and is then unknown.
    assert len(database["tb_area_top10_product"]) == 45


def test_writing_leaves_the_scan_as_wide_as_it_is(spark, actions):
    written = for_connections(spark.range(0, 1000, 1, 40).where("id % 2 = 0"), 4)
    text = plan(written)
    assert "RoundRobinPartitioning(4)" in text and "splits=40" in text
    assert "Coalesce" not in text and written.count() == 500


def test_cities_are_gathered_for_winners_only(spark, sf_dir, actions):
    counted = areas.city_product_clicks(actions, views.city_info(spark, sf_dir))
    lines = plan(areas.top_area_products_with_cities(counted)).splitlines()
    gathered = [i for i, line in enumerate(lines) if "collect_list" in line]
    ranked = [i for i, line in enumerate(lines) if "WindowGroupLimit" in line]
    assert gathered and max(gathered) < min(ranked)


def test_users_are_measured_once_in_a_job(spark, sf_dir, actions, monkeypatch):
    calls = []
    small = joins.is_small
    monkeypatch.setattr(joins, "is_small", lambda side: calls.append(1) or small(side))
    users = views.user_info(spark, sf_dir)
    session_job.session_results(actions, users, JobParams(sex="male"))
    assert len(calls) == 1


def test_tasks_are_even_with_a_third_of_all_rows_on_one_key(spark, many_members, settings):
    settings({"spark.sql.adaptive.enabled": "false", "spark.sql.shuffle.partitions": "200"})
    user = F.when(F.col("id") % 3 == 0, 7).otherwise(F.col("id") + 100)
    rows = spark.range(0, 300_000, 1, 16).select(user.alias("user_id"), "id")
    members = spark.range(400_000).select(F.col("id").alias("user_id"))
    known = joins.measured(rows, members, "user_id")
    assert set(known.pieces) == {7}
    joined = keep_members(rows, known, "user_id")
    sizes = joined.groupBy(F.spark_partition_id()).count().select("count").collect()
    sizes = [size[0] for size in sizes]
    assert sum(sizes) == 300_000 and max(sizes) < 2 * 300_000 / 200


def test_click_job(spark, sf_dir, monkeypatch, rows, tmp_path):
    """The job over the click lines, started twice with the same folders."""
    table = str(tmp_path / "blacklist")
    listed, whitelist = views.blacklist(spark, sf_dir), views.whitelist(spark, sf_dir)
    listed.write.parquet(table)
    asked = []
    monkeypatch.setattr(
        click_job, "read_jdbc", lambda *args: asked.append(args[3]) or spark.read.parquet(table)
    )
    monkeypatch.setattr(
        click_job.sink, "write_jdbc", lambda users, *_: users.write.mode("append").parquet(table)
    )
    lines = tmp_path / "lines"
    views.ad_click_lines(spark, sf_dir).write.text(str(lines))
    out = str(tmp_path / "out")

    def run():
        stream = read_text_stream(spark, str(lines))
        queries = click_job.start_click_job(spark, stream, None, whitelist, out, "slices")
        try:
            for query in queries:
                query.processAllAvailable()
        finally:
            for query in queries:
                query.stop()

    run()
    run()
    assert asked == ["slices"]  # one batch, one read
    clean = clicks.not_blacklisted(clicks.parse_clicks(spark.read.text(str(lines))), listed)
    counts = clicks.running_counts(clean)
    tables = ClickTables(spark, out)
    assert rows(tables.counts(), *counts.columns) == rows(counts)
    top = clicks.top_province_ads(clicks.province_counts(counts))
    assert rows(tables.top_ads(), *top.columns) == rows(top)
    trend = clicks.click_trend(clean)
    assert rows(tables.trend(), *trend.columns) == rows(trend)
    # Nobody clicks more than a hundred times in five minutes.
    assert rows(spark.read.parquet(table)) == rows(listed)


@pytest.mark.parametrize("name", ["actions_from_text", "users_from_text", "products_from_text"])
def test_text_queries_scan_text(spark, sf_dir, name):
    assert "FileScan text" in plan(QUERIES[name](spark, sf_dir))
