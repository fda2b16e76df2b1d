import pytest
from pyspark.sql import functions as F

from clickpulse.operators import areas
from clickpulse.operators.ranking import preview, running_ranks
from clickpulse.plans.areas import area_top_products

CITY = "city_id int, city_name string, area string, province_name string"
PRODUCT = "product_id bigint, product_name string, extend_info string"


@pytest.fixture
def actions(frame):
    return lambda *rows: frame("city_id int, click_product_id string", *rows)


@pytest.fixture
def cities(frame):
    return frame(CITY, (1, "上海", "华东", "p1"), (101, "上海", "华东", "p1"), (2, "x,y:z", "东北", "p2"))


def test_unknown_cities_are_dropped(actions, cities, rows):
    df = areas.actions_with_city(actions((1, "5"), (9, "5")), cities)
    assert rows(df) == [(1, "5", "上海", "华东", "p1")]


def test_counts(actions, cities, rows):
    df = actions((1, "5"), (1, "5"), (101, "5"), (2, "5"), (2, " "), (2, None), (9, "5"))
    clicks = areas.city_product_clicks(df, cities)
    assert rows(areas.area_product_clicks(clicks)) == [
        ("东北", "5", 1, "2:x,y:z"),
        ("华东", "5", 3, "101:上海,1:上海"),
    ]
    assert rows(areas.area_city_infos(clicks), "area", "city_infos") == [
        ("东北", "2:x,y:z:1"),
        ("华东", "1:上海:2,101:上海:1"),
    ]


def test_actions_without_product(actions, cities, rows):
    df = actions((1, ""), (1, ""), (1, "5"))
    clicks = areas.city_product_clicks(df, cities, clicks_only=False)
    assert rows(clicks, "click_product_id", "clicks") == [("", 2), ("5", 1)]


def test_group_concat(frame, rows):
    df = frame("k int, v string", (1, "1:上海"), (1, "101:上海"), (1, "101:上海"), (2, None), (3, "a,b"), (3, None))
    assert rows(areas.group_concat_counts(df, ["k"], "v", "s")) == [
        (1, "101:上海:2,1:上海:1"),
        (2, ""),
        (3, "a,b:1"),
    ]


def test_top_products_break_ties_by_product(frame, rows):
    schema = "area string, click_product_id string, click_count bigint"
    counts = frame(schema, *(("a", f"{i:02}", 1) for i in range(12)))
    assert [r[1] for r in rows(areas.top_area_products(counts), "rn", "click_product_id")] == [
        r[1] for r in sorted(((i + 1, f"{i:02}") for i in range(10)), key=repr)
    ]


def test_enriched(actions, cities, frame, rows):
    df = actions((1, "5"), (101, "5"), (2, "6"), (1, "x"), (1, "77"), (1, ""))
    products = frame(PRODUCT, (5, "five", '{"product_type":"1"}'), (6, "six", None))
    result = area_top_products(df, None, cities, products)
    assert result.columns == [
        "area_level",
        "click_product_id",
        "area",
        "click_count",
        "city_infos",
        "product_name",
        "product_type",
    ]
    assert rows(result) == [
        ("A", "5", "华东", 2, "101:上海:1,1:上海:1", "five", "第三方商品"),
        ("C", "6", "东北", 1, "2:x,y:z:1", "six", "未知商品"),
    ]


def test_rank_comes_before_the_product_join(actions, cities, frame, rows):
    df = actions((1, "unknown"), (1, "unknown"), (1, "5"))
    products = frame(PRODUCT, (5, "five", "{}"))
    assert rows(area_top_products(df, None, cities, products, n=1)) == []


def test_chunks_of_a_group(frame, rows):
    values = [("a", v) for v in "edcba" for _ in range("abcde".index(v) + 1)]
    df = frame("g string, v string", *values, ("a", None), ("b", None), (None, "x"), (None, "x"))
    found = areas.group_concat_chunks(df, ["g"], "v", "texts", size=2)
    assert rows(found) == [
        ("a", 0, "a:1,b:2"),
        ("a", 1, "c:3,d:4"),
        ("a", 2, "e:5"),
        (None, 0, "x:2"),
    ]
    assert rows(areas.group_concat_chunks(df.limit(0), ["g"], "v", "texts")) == []


def test_numbers_and_several_groups_in_chunks(frame, rows):
    df = frame("g string, h int, v int", *((g, h, v) for g in "ab" for h in (1, 2) for v in (10, 9, 100)))
    found = rows(areas.group_concat_chunks(df, ["g", "h"], "v", "texts", size=2))
    assert found[:2] == [("a", 1, 0, "9:1,10:1"), ("a", 1, 1, "100:1")] and len(found) == 8


def test_a_hot_group_is_ranked_by_many_tasks(spark):
    group = F.when(F.col("id") % 3 == 0, "hot").otherwise(F.concat(F.lit("g"), F.col("id") % 50))
    df = spark.range(30_000).select(group.alias("g"), F.format_string("v%05d", "id").alias("v"))
    # So few rows would be merged into one range.
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        ranked = running_ranks(df, ["g"], "v")
    finally:
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
    sizes = [row["count"] for row in ranked.groupBy("range").count().collect()]
    assert len(sizes) > 4 and max(sizes) < 2 * 30_000 / len(sizes)
    hot = [row["rank"] for row in ranked.where("g = 'hot'").orderBy("v").collect()]
    assert hot == list(range(10_000))


def test_preview(frame, rows):
    df = frame("g string, n int", *(("x", n) for n in range(20)))
    assert [row.n for row in preview(df, [F.desc("n")], 3).collect()] == [19, 18, 17]
