"""The input tables, derived from the test tables (see FIXTURES.md)."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from clickpulse import schemas
from clickpulse.sources.tables import typed

# The columns of the test tables used here.
TABLES = {
    "events": "event_id bigint, ts timestamp_ntz, user_id bigint, event_type string, props string",
    "customer": "c_custkey bigint, c_name string, c_nationkey int, c_acctbal double, c_mktsegment string",
    "nation": "n_nationkey int, n_name string, n_regionkey int",
    "region": "r_regionkey int, r_name string",
    "part": "p_partkey bigint, p_name string, p_size int",
}

_K = "cast(get_json_object(props, '$.k') as int)"
_DAY = "cast(cast(ts as date) as string)"


# A click line; errors carry a bad ad id.
_CLICK_LINE = """concat(
    timestampdiff(MILLISECOND, timestamp_ntz'1970-01-01 00:00:00', ts),
    ' province_', user_id % 5, ' city_', user_id % 25, ' ', user_id, ' ',
    CASE WHEN event_type = 'error' THEN 'bad' ELSE get_json_object(props, '$.k') END
) AS value"""

# Where the parts of the click stream after the first begin.
PART_STARTS = ("2024-01-08 00:00:00", "2024-01-15 12:00:00", "2024-01-23 00:00:00")


def _only(event_type: str, text: str) -> str:
    return f"CASE WHEN event_type = '{event_type}' THEN {text} ELSE '' END"


def user_visit_actions(spark: SparkSession, sf_dir: str) -> DataFrame:
    second = "make_dt_interval(0, 0, 0, 32280 + event_id * 37 % 700)"
    rows = _read(spark, sf_dir, "events").selectExpr(
        f"{_DAY} AS date",
        "user_id",
        f"concat(user_id, '_', {_DAY}) AS session_id",
        f"{_K} AS page_id",
        f"cast(cast(cast(ts as date) as timestamp_ntz) + {second} as string) AS action_time",
        _only("error", f"concat('kw', {_K} % 10)") + " AS search_keyword",
        _only("click", f"cast({_K} % 50 as string)") + " AS click_category_id",
        _only("click", "cast(event_id % 200 as string)") + " AS click_product_id",
        _only("purchase", f"concat({_K} % 50, '|', ({_K} * 3 + 1) % 50, '| |')")
        + " AS order_category_ids",
        _only("purchase", "concat(event_id % 200, '|', (event_id * 3 + 1) % 200)")
        + " AS order_product_ids",
        _only("signup", f"concat({_K} % 50, '|', ({_K} * 7 + 3) % 50)") + " AS pay_category_ids",
        _only("signup", "concat(event_id % 200, '|', (event_id * 7 + 3) % 200)")
        + " AS pay_product_ids",
        "user_id % 25 AS city_id",
    )
    return typed(rows, schemas.USER_VISIT_ACTION)


def user_info(spark: SparkSession, sf_dir: str) -> DataFrame:
    nations = _read(spark, sf_dir, "nation").withColumnRenamed("n_nationkey", "c_nationkey")
    rows = (
        _read(spark, sf_dir, "customer")
        .join(nations, "c_nationkey")
        .selectExpr(
            "c_custkey AS user_id",
            "concat('user_', c_custkey) AS user_name",
            "c_name AS name",
            "15 + c_custkey % 45 AS age",
            "c_mktsegment AS professional",
            "n_name AS city",
            "CASE c_custkey % 3 WHEN 0 THEN 'male' WHEN 1 THEN 'female' ELSE 'unknown' END AS sex",
        )
    )
    return typed(rows, schemas.USER_INFO)


def product_info(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = _read(spark, sf_dir, "part").selectExpr(
        "p_partkey AS product_id",
        "p_name AS product_name",
        """CASE p_size % 4 WHEN 0 THEN '{"product_type":"0"}' WHEN 1 THEN '{"product_type":"1"}'
                           WHEN 2 THEN '{"product_type":""}' ELSE '{}' END AS extend_info""",
    )
    return typed(rows, schemas.PRODUCT_INFO)


def city_info(spark: SparkSession, sf_dir: str) -> DataFrame:
    regions = _read(spark, sf_dir, "region").withColumnRenamed("r_regionkey", "n_regionkey")
    rows = (
        _read(spark, sf_dir, "nation")
        .join(regions, "n_regionkey")
        .selectExpr(
            "n_nationkey AS city_id",
            "n_name AS city_name",
            "r_name AS area",
            "concat('province_', n_regionkey) AS province_name",
        )
    )
    return typed(rows, schemas.CITY_INFO)


def blacklist(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Customers in debt."""
    rows = _read(spark, sf_dir, "customer").where("c_acctbal < 0")
    return typed(rows.selectExpr("c_custkey AS user_id", "101 AS count"), schemas.BLACK_USERS)


def whitelist(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Customers with a large balance."""
    rows = _read(spark, sf_dir, "customer").where("c_acctbal > 9000")
    return rows.selectExpr("cast(c_custkey as int) AS user_id")


# Parameters of the tasks, by the number of a nation; what is not listed has TASK_OF_A_DAY.
TASK_PARAMS = {
    0: '{"startDate":"2024-01-05","endDate":"2024-01-06"}',
    1: '{"startDate":"2024-01-29","sex":"female"}',
    2: '{"endDate":"2024-01-02","startDate":" ","professionals":"MACHINERY,,BUILDING, ,"}',
    3: "{}",
    4: None,
    5: "no object",
    6: "[]",
    7: '{"startDate":"2024-02-01","endDate":"2024-01-01"}',
    8: '{"startDate":"2024-01-10","endDate":"2024-01-10","sex":"male","professionals":","}',
    9: '{"sex":null,"endDate":"","startDate":"2024-01-30","unknown":{"a":1}}',
    10: '{"startDate": 2024, "endDate": "2024-01-01"}',
    11: " ",
    12: '{"startDate":',
}
TASK_OF_A_DAY = "2024-01-%02d"


def tasks(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A task per nation, with the JSON of its parameters."""
    listed = " ".join(
        f"WHEN {n} THEN " + ("NULL" if text is None else f"'{text}'")
        for n, text in TASK_PARAMS.items()
    )
    day = f"format_string('{TASK_OF_A_DAY}', n_nationkey)"
    other = f"""concat('{{"startDate":"', {day}, '","endDate":"', {day}, '"}}')"""
    return _read(spark, sf_dir, "nation").selectExpr(
        "cast(n_nationkey as bigint) AS task_id",
        f"CASE n_nationkey {listed} ELSE {other} END AS task_param",
    )


def ad_click_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _read(spark, sf_dir, "events").selectExpr(_CLICK_LINE)


def ad_click_parts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The click lines with the number of the part in which they arrive, by their time."""
    part = " ".join(
        f"WHEN ts < timestamp_ntz'{start}' THEN {n}" for n, start in enumerate(PART_STARTS)
    )
    cut = f"CASE {part} ELSE {len(PART_STARTS)} END AS part"
    return _read(spark, sf_dir, "events").selectExpr(cut, _CLICK_LINE)


def _read(spark: SparkSession, sf_dir: str, table: str) -> DataFrame:
    return spark.read.schema(TABLES[table]).parquet(f"{sf_dir}/{table}.parquet")
