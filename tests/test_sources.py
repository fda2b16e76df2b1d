"""Text scans, tables and the options of databases and streams."""

import json

import pytest
from pyspark.errors import PySparkException

from clickpulse import schemas
from clickpulse.operators import filters, sessions
from clickpulse.params import JobParams, task_params
from clickpulse.sinks.files import replace_task
from clickpulse.sources import delimited, jdbc, streams, tables

ACTION = "2024-01-01,1,s1,5,2024-01-01 09:00:00,kw,,,,,,,3"


@pytest.fixture
def folder(tmp_path):
    """Write lines to a new file and return its folder."""

    def write(*lines):
        path = tmp_path / "in"
        path.mkdir()
        (path / "part").write_text("\n".join(lines))
        return str(path)

    return write


def test_actions(spark, folder, rows):
    path = folder(
        ACTION,
        ACTION.replace("kw", "k,w"),  # 14 fields
        ACTION.removesuffix(",3"),  # trailing empty fields do not exist
        ACTION + ",,",  # but extra separators at the end do no harm
        "",
        ",,,,,,,,,,,,",
    )
    df = delimited.read_user_visit_actions(spark, path)
    assert df.dtypes == [(f.name, f.dataType.simpleString()) for f in schemas.USER_VISIT_ACTION]
    expected = ("2024-01-01", 1, "s1", 5, "2024-01-01 09:00:00", "kw", "", "", "", "", "", "", 3)
    assert rows(df) == [expected] * 2


@pytest.mark.parametrize("old, new", [(",1,s1", ",x,s1"), (",3", ",3.5")])
def test_bad_number_fails(spark, folder, old, new):
    df = delimited.read_user_visit_actions(spark, folder(ACTION.replace(old, new)))
    with pytest.raises(PySparkException):
        df.collect()


def test_users(spark, folder, rows):
    path = folder("1,user_1,name,33,doctor,city,male", "2,user_2,name,33,doctor,city", "")
    assert rows(delimited.read_user_info(spark, path)) == [
        (1, "user_1", "name", 33, "doctor", "city", "male")
    ]


def test_products(spark, folder, rows):
    path = folder('7^"quoted, name^{"product_type":"1"}', "8^a^b^c", '9^n^{"a":1}^')
    assert rows(delimited.read_product_info(spark, path)) == [
        (7, '"quoted, name', '{"product_type":"1"}'),
        (9, "n", '{"a":1}'),
    ]


def test_tables_and_views(spark, frame, rows):
    cities = frame("area string, city_id bigint, extra int, city_name string, province_name string",
                   ("a", 1, 0, "n", "p"))
    tables.register_views({"cities_view": cities})
    df = tables.read_table(spark, "cities_view", schemas.CITY_INFO)
    assert df.schema.simpleString() == schemas.CITY_INFO.simpleString()
    assert rows(df) == [(1, "n", "a", "p")]
    assert tables.read_table(spark, "cities_view").columns == cities.columns


def test_jdbc_options():
    database = jdbc.Database("jdbc:x:y", {"user": "u", "password": "p"})
    plain = {"url": "jdbc:x:y", "dbtable": "t", "user": "u", "password": "p"}
    assert jdbc.jdbc_options(database, "t") == plain
    slices = jdbc.Slices("id", "0", "1000", 8)
    assert jdbc.jdbc_options(database, "t", slices) == plain | {
        "partitionColumn": "id",
        "lowerBound": "0",
        "upperBound": "1000",
        "numPartitions": "8",
    }


def test_kafka_options():
    options = streams.kafka_options("h:9092", ["a", "b"])
    assert options == {
        "kafka.bootstrap.servers": "h:9092",
        "subscribe": "a,b",
        "startingOffsets": "latest",
    }
    options = streams.kafka_options("h:9092", ["a"], {"a": {0: 1000, 1: 1000}})
    assert json.loads(options["startingOffsets"]) == {"a": {"0": 1000, "1": 1000}}


def test_kafka_bounds():
    options = streams.kafka_options("h", ["a"], max_per_trigger=500)
    assert options["maxOffsetsPerTrigger"] == "500"
    start, end = {"a": {0: 5, 1: streams.EARLIEST}}, {"a": {0: 9, 1: streams.LATEST}}
    options = streams.replay_options("h", start, end)
    assert json.loads(options["startingOffsets"]) == {"a": {"0": 5, "1": -2}}
    assert json.loads(options["endingOffsets"]) == {"a": {"0": 9, "1": -1}}
    assert options["subscribe"] == "a"


@pytest.mark.parametrize(
    "start, end",
    [
        ({"a": {0: 5}}, {"a": {0: 4}}),
        ({"a": {0: 5}}, {"a": {0: 6, 1: 6}}),
        ({"a": {0: 5}}, {"b": {0: 6}}),
        ({"a": {}}, {"a": {}}),
        ({"a": {0: -3}}, {"a": {0: 6}}),
    ],
)
def test_bad_bounds_are_refused(start, end):
    with pytest.raises(ValueError):
        streams.replay_options("h", start, end)


def test_topics_without_offsets_are_refused():
    with pytest.raises(ValueError):
        streams.kafka_options("h", ["a", "b"], {"a": {0: 1}})


def test_every_partition_needs_an_offset():
    streams.check_partitions({"a": {0: 1, 1: 1}}, {"a": 2})
    for offsets in ({"a": {0: 1}}, {"a": {0: 1, 1: 1, 2: 1}}, {}):
        with pytest.raises(ValueError, match="a: no offset"):
            streams.check_partitions(offsets, {"a": 2})


def test_ledger_of_bounded_reads(spark, frame, rows, tmp_path):
    """Reads go on where the ledger says; one that failed, and one repeated, change nothing."""
    ledger, out = str(tmp_path / "ledger"), str(tmp_path / "out")
    schema = "topic string, partition int, offset bigint, value string"
    everything = [("a", p, o, f"{p}-{o}") for p in (0, 1) for o in range(10) if o != 4]

    def messages(start, end):
        return frame(schema, *(m for m in everything if start["a"][m[1]] <= m[2] < end["a"][m[1]]))

    start = streams.last_offsets(streams.read_ledger(spark, ledger))
    assert start == {}
    start = {"a": {0: 0, 1: 0}}
    ends = [{"a": {0: 5, 1: 0}}, {"a": {0: 7, 1: 10}}]

    def lose(df):
        raise RuntimeError("lost")

    for run, end in enumerate(ends):
        take = lambda df: replace_task(df, out, run)  # noqa: B023, E731
        read = messages(start, end)
        with pytest.raises(RuntimeError):
            streams.read_and_note(read, start, run, ledger, lose)
        for _ in range(2):
            streams.read_and_note(read, start, run, ledger, take)
        start = streams.last_offsets(streams.read_ledger(spark, ledger))
        # Offset 4 was compacted away; partition 1 had nothing to read at first.
        assert start == ({"a": {0: 4, 1: 0}} if run == 0 else {"a": {0: 7, 1: 10}})
    values = rows(spark.read.parquet(out), "value")
    assert values == sorted((v,) for _, p, o, v in everything if o < 7 or p == 1)


def catalog_actions(frame):
    schema = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in schemas.USER_VISIT_ACTION)
    day = lambda n: f"2024-01-{n:02}"
    made = [
        (day(n % 4 + 1), n % 5, f"s{n % 7}", n, f"{day(n % 4 + 1)} 10:00:{n:02}", *[""] * 7, n % 3)
        for n in range(40)
    ]
    return frame(schema, *made)


@pytest.fixture
def catalog(spark, frame, tmp_path):
    name = f"actions_{tmp_path.name}".replace("-", "_")
    tables.save_actions_table(catalog_actions(frame), name, 4, str(tmp_path / "table"))
    yield name
    spark.sql(f"DROP TABLE {name}")


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_sessions_of_the_catalog_table_need_no_shuffle(spark, frame, rows, catalog):
    actions = tables.read_actions_table(spark, catalog)
    assert rows(actions) == rows(catalog_actions(frame))
    for metric in (sessions.session_lengths, sessions.hourly_session_lengths):
        assert rows(metric(actions)) == rows(metric(catalog_actions(frame)))
        assert "Exchange" not in plan(metric(actions)) and "Bucketed: true" in plan(metric(actions))
    chosen = frame("session_id string", ("s1",), ("s3",)).hint("merge")
    kept = actions.join(chosen, "session_id", "left_semi")
    assert plan(kept).count("Exchange") == 1  # that of the few sessions
    assert kept.count() == sum(n % 7 in (1, 3) for n in range(40))


def test_tasks_read_only_their_days(spark, frame, rows, catalog):
    actions = tables.read_actions_table(spark, catalog)
    users = frame("user_id bigint, sex string, professional string", (1, "f", "a"), (2, "f", "b"),
                  (2, "f", "b"), (3, "m", "b"))
    tasks = frame(
        "task_id bigint, task_param string",
        (1, '{"startDate":"2024-01-02","endDate":"2024-01-02"}'),
        (2, '{"endDate":"2024-01-02","sex":"f","professionals":"b,c"}'),
        (3, "{}"),
    )
    found = filters.actions_of_tasks(actions, users, task_params(tasks))
    everything = catalog_actions(frame).collect()
    want = [(1, *a) for a in everything if a.date == "2024-01-02"]
    want += [(2, *a) for a in everything if a.date <= "2024-01-02" and a.user_id == 2]
    assert rows(found) == sorted(want, key=repr)
    assert "dynamicpruning" in plan(found)


def test_tables_of_another_shape_are_refused(spark, frame):
    tables.register_views({"odd_actions": catalog_actions(frame).drop("city_id")})
    with pytest.raises(ValueError, match="city_id"):
        tables.read_actions_table(spark, "odd_actions")


@pytest.mark.parametrize(
    "params",
    [
        JobParams(),
        JobParams(start_date="2024-01-02", end_date="2024-01-03"),
        JobParams(sex="f"),
        JobParams(sex="f' OR '1'='1"),
        JobParams(end_date="2024-01-03", professionals=("b", "it's")),
        JobParams(sex="m", professionals=("a", "b")),
    ],
)
def test_sql_selects_like_the_operators(spark, frame, rows, params):
    users = frame("user_id bigint, sex string, professional string", (1, "f", "a"), (2, "f", "it's"),
                  (2, "f", "b"), (3, "m", "b"))
    actions = catalog_actions(frame)
    tables.register_views({"user_visit_action": actions, "user_info": users})
    found = tables.select_actions_sql(spark, params)
    assert rows(found) == rows(filters.filter_actions(actions, users, params))
