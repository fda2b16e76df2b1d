"""Most clicked products per sales area, with city and product data.

Actions are counted per city and product before anything is joined, so a hot
product or city shrinks to one row per task, and the list of cities of a product
has at most one entry per city.
"""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from clickpulse.functions.labels import AREA_LEVELS, area_level, city_label, product_type
from clickpulse.functions.text import not_blank
from clickpulse.operators.ranking import running_ranks, top_n

# Fixed value: products per area.
TOP = 10

# Values in a text of a group that is cut into chunks.
CHUNK = 10_000


def actions_with_city(actions: DataFrame, cities: DataFrame) -> DataFrame:
    """City data of each action; actions of unknown cities are dropped."""
    return actions.join(cities, "city_id").select(
        "city_id", "click_product_id", "city_name", "area", "province_name"
    )


def city_product_clicks(
    actions: DataFrame, cities: DataFrame, clicks_only: bool = True
) -> DataFrame:
    """Clicks per city and product: area, click_product_id, city and clicks.

    A city has one row in ``cities``. Actions of unknown cities are dropped.
    Actions without a product are left out; with ``clicks_only=False`` they
    count as a product of their own.
    """
    if clicks_only:
        actions = actions.where(not_blank(F.col("click_product_id")))
    counted = actions.groupBy("city_id", "click_product_id").agg(F.count(F.lit(1)).alias("clicks"))
    city = city_label(F.col("city_id"), F.col("city_name")).alias("city")
    return counted.join(cities, "city_id").select("area", "click_product_id", city, "clicks")


def area_product_clicks(city_clicks: DataFrame) -> DataFrame:
    """Clicks per area and product, and the cities they came from, each named once."""
    return city_clicks.groupBy("area", "click_product_id").agg(
        F.sum("clicks").alias("click_count"),
        F.array_join(F.array_sort(F.collect_set("city")), ",").alias("city_list"),
    )


def group_concat_counts(df: DataFrame, by: list[str], value: str, name: str) -> DataFrame:
    """``value:n`` for each distinct value of a group, as one text per group.

    The text holds every distinct value, so use it where a group's values are few. The
    most frequent value comes first, equal counts in order of the value. A
    group without values gives empty text.
    """
    counted = df.groupBy(*by, value).agg(F.count(F.col(value)).alias("n"))
    lists = counted.groupBy(*by).agg(_entries(F.col(value), F.col("n")).alias(name))
    return _join_entries(lists, name)


def group_concat_chunks(
    df: DataFrame, by: list[str], value: str, name: str, size: int = CHUNK
) -> DataFrame:
    """``value:n`` for each distinct value of a group, in texts of at most ``size`` values.

    Chunk 0 of a group holds its first values in their order, chunk 1 the next, and so on;
    only the last may have fewer than ``size``. No text, and no task, holds a whole group
    however many values it has. Null values do not count; a group without others has no chunk.
    """
    values = df.where(F.col(value).isNotNull())
    counted = values.groupBy(*by, value).agg(F.count(F.lit(1)).alias("n"))
    chunk = (F.col("rank") / size).cast("long").alias("chunk")
    entry = F.struct("rank", F.concat(F.col(value).cast("string"), F.lit(":"), F.col("n")).alias("text"))
    entries = running_ranks(counted, by, value).select(*by, chunk, entry.alias("entry"))
    lists = entries.groupBy(*by, "chunk").agg(F.array_sort(F.collect_list("entry")).alias("entries"))
    return lists.select(*by, "chunk", F.array_join("entries.text", ",").alias(name))


def area_city_infos(city_clicks: DataFrame) -> DataFrame:
    """``id:name:clicks`` of the cities of each area and product."""
    return _join_entries(_area_products(city_clicks), "city_infos").drop("click_count")


def top_area_products(area_clicks: DataFrame, n: int = TOP) -> DataFrame:
    """The ``n`` most clicked products of each area."""
    return top_n(area_clicks, ["area"], "click_count", "click_product_id", n)


def top_area_products_with_cities(city_clicks: DataFrame, n: int = TOP) -> DataFrame:
    """The top products of each area with their ``city_infos``.

    Sums are ranked first; cities are gathered for the winners alone, ``n`` per area.
    """
    keys = ["area", "click_product_id"]
    sums = city_clicks.groupBy(*keys).agg(F.sum("clicks").alias("click_count"))
    top = top_area_products(sums, n)
    same = [F.col(f"c.{key}").eqNullSafe(F.col(f"t.{key}")) for key in keys]
    won = city_clicks.alias("c").join(F.broadcast(top).alias("t"), same)
    lists = won.groupBy(*(F.col(f"t.{column}") for column in top.columns)).agg(
        _entries(F.col("city"), F.col("clicks")).alias("city_infos")
    )
    return _join_entries(lists, "city_infos")


def with_product_info(
    top: DataFrame, products: DataFrame, levels: Mapping[str, str] = AREA_LEVELS
) -> DataFrame:
    """Area level and product data of the top products; unknown products are dropped."""
    labelled = product_types(products).select("product_id", "product_name", "product_type")
    return (
        top.withColumn("product_id", F.col("click_product_id").try_cast("long"))
        .join(labelled, "product_id")
        .select(
            area_level(F.col("area"), levels).alias("area_level"),
            "click_product_id",
            "area",
            "click_count",
            "city_infos",
            "product_name",
            "product_type",
        )
    )


def product_types(products: DataFrame) -> DataFrame:
    """Products with the label of their type."""
    return products.withColumn("product_type", product_type(F.col("extend_info")))


def _area_products(city_clicks: DataFrame) -> DataFrame:
    """Total and counted cities of each area and product, in one aggregation."""
    return city_clicks.groupBy("area", "click_product_id").agg(
        F.sum("clicks").alias("click_count"),
        _entries(F.col("city"), F.col("clicks")).alias("city_infos"),
    )


def _entries(value: Column, count: Column) -> Column:
    """Counted values of a group, as structs that sort by count (falling), then value."""
    return F.collect_list(
        F.when(value.isNotNull(), F.struct((-count).alias("order"), value.alias("value")))
    )


def _join_entries(df: DataFrame, name: str) -> DataFrame:
    """Turn the entries in column ``name`` into text."""
    parts = F.transform(
        F.array_sort(name),
        lambda entry: F.concat(entry["value"], F.lit(":"), (-entry["order"]).cast("string")),
    )
    return df.withColumn(name, F.array_join(parts, ","))
