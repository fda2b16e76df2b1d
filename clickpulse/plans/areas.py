"""Top products per area of one task."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame, SparkSession

from clickpulse.functions.labels import AREA_LEVELS
from clickpulse.operators import areas
from clickpulse.operators.filters import filter_actions
from clickpulse.operators.joins import broadcast_if_small
from clickpulse.params import JobParams
from clickpulse.sinks import jdbc as sink
from clickpulse.sources.jdbc import Database, Slices, find_params, read_jdbc


def area_top_products(
    actions: DataFrame,
    users: DataFrame | None,
    cities: DataFrame,
    products: DataFrame,
    params: JobParams = JobParams(),
    levels: Mapping[str, str] = AREA_LEVELS,
    n: int = areas.TOP,
    clicks_only: bool = True,
) -> DataFrame:
    """The most clicked products of each area, with city and product data.

    With ``clicks_only=False`` actions without a product compete for a place too.
    """
    selected = filter_actions(actions, users, params)
    city_clicks = areas.city_product_clicks(selected, cities, clicks_only)
    top = areas.top_area_products_with_cities(city_clicks, n)
    return areas.with_product_info(top, products, levels)


def run_area_job(
    spark: SparkSession,
    database: Database,
    task_id: int,
    actions: DataFrame | None = None,
    users: DataFrame | None = None,
    products: DataFrame | None = None,
    clicks_only: bool = True,
    mode: str = "append",
    city_slices: Slices | None = None,
) -> None:
    """Run a task of the task table and insert its result into the database.

    Actions, users and products default to the catalog tables. ``mode`` ``overwrite``
    replaces all rows of the result table.
    """
    params = find_params(read_jdbc(spark, database, "tb_task"), task_id)
    if users is None and params.needs_users:
        users = spark.table("user_info")
    result = area_top_products(
        spark.table("user_visit_action") if actions is None else actions,
        users,
        broadcast_if_small(read_jdbc(spark, database, "city_info", city_slices)),
        spark.table("product_info") if products is None else products,
        params,
        clicks_only=clicks_only,
    )
    sink.write_jdbc(sink.area_rows(result, task_id), database, sink.AREA_TABLE, mode)
