"""Every query by name, as a function of the session and the table folder."""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from clickpulse import schemas
from clickpulse.functions import labels, times
from clickpulse.operators import areas, categories, clicks, filters, sessions
from clickpulse.operators.ranking import preview
from clickpulse.params import JobParams, task_params
from clickpulse.plans.areas import area_top_products
from clickpulse.registry import views
from clickpulse.registry.views import PART_STARTS
from clickpulse.sinks.files import as_json, replace_task, replace_tasks, write_delimited
from clickpulse.sinks.jdbc import category_rows
from clickpulse.sources import delimited, tables
from clickpulse.sources.jdbc import find_params
from clickpulse.sources.streams import read_text_stream
from clickpulse.storage import run_dir
from clickpulse.streaming import outputs

Query = Callable[[SparkSession, str], DataFrame]

# Parameters shared with the SQL.
START_DATE, END_DATE = "2024-01-05", "2024-01-24"
SEX, PROFESSIONALS = "female", ("MACHINERY", "BUILDING")
AREA_LEVELS = {"ASIA": "A", "AMERICA": "A", "EUROPE": "B", "AFRICA": "B", "MIDDLE EAST": "C"}
# Layout of the action table, values in a chunk, and the task that SQL selects for.
BUCKETS, CHUNK, SQL_TASK = 8, 100, 2
# Exports in their order: task, first and last day. A later one replaces an earlier one.
EXPORTS = (
    (1, "2024-01-01", "2024-01-03"),
    (2, "2024-01-02", "2024-01-02"),
    (1, "2024-01-04", "2024-01-04"),
    (3, "2024-01-05", "2024-01-05"),
    (3, "2030-01-01", "2030-01-01"),
)
# The busiest window of a user holds three clicks in the test tables.
BLACKLIST_THRESHOLD = 1


class Inputs:
    """The input tables of one folder. The SQL reads all times as UTC; so must the session."""

    def __init__(self, spark: SparkSession, sf_dir: str) -> None:
        self.spark, self.sf_dir = spark, sf_dir

    def __getattr__(self, view: str) -> DataFrame:
        """Each table is built at its first use and then kept."""
        table = getattr(views, view)(self.spark, self.sf_dir)
        setattr(self, view, table)
        return table


def _query(build: Callable[[Inputs], DataFrame]) -> Query:
    return lambda spark, sf_dir: build(Inputs(spark, sf_dir))


# Text


def actions_from_text(i: Inputs) -> DataFrame:
    path = run_dir(i.spark, "actions")
    write_delimited(i.user_visit_actions, path)
    return delimited.read_user_visit_actions(i.spark, path)


def users_from_text(i: Inputs) -> DataFrame:
    path = run_dir(i.spark, "users")
    write_delimited(i.user_info, path)
    return delimited.read_user_info(i.spark, path)


def products_from_text(i: Inputs) -> DataFrame:
    path = run_dir(i.spark, "products")
    write_delimited(i.product_info, path, "^")
    return delimited.read_product_info(i.spark, path)


# Catalog and tasks


def catalog_actions(i: Inputs) -> DataFrame:
    """The actions, written to a table of the catalog and read from it."""
    name = f"actions_{uuid.uuid4().hex}"
    tables.save_actions_table(i.user_visit_actions, name, BUCKETS, run_dir(i.spark, name))
    return tables.read_actions_table(i.spark, name)


def catalog_session_details(i: Inputs) -> DataFrame:
    actions = catalog_actions(i)
    top = categories.top_categories(categories.category_counts(actions))
    chosen = categories.top_sessions(categories.category_session_counts(actions, top))
    return categories.session_details(actions, chosen)


def all_task_params(i: Inputs) -> DataFrame:
    columns = task_params(i.tasks)
    return columns.withColumn("professionals", F.array_join("professionals", "|"))


def actions_by_sql(i: Inputs) -> DataFrame:
    """The actions of one task, its parameters looked up by its id."""
    tables.register_views({"user_visit_action": i.user_visit_actions, "user_info": i.user_info})
    return tables.select_actions_sql(i.spark, find_params(i.tasks, SQL_TASK))


def actions_of_tasks(i: Inputs) -> DataFrame:
    return filters.actions_of_tasks(catalog_actions(i), i.user_info, task_params(i.tasks))


def refused_tasks(i: Inputs) -> DataFrame:
    """Tasks without parameters; a job over one of them ends before it reads any action."""
    refused = task_params(i.tasks).where("refused").select("task_id")
    for row in refused.collect():
        try:
            find_params(i.tasks, row.task_id)
        except ValueError:
            continue
        raise RuntimeError(f"task {row.task_id} was not refused")
    return refused


def details_by_task(i: Inputs) -> DataFrame:
    """JSON lines of three tasks, two of them exported twice, read back."""
    path = run_dir(i.spark, "details")
    for task_id, start, end in EXPORTS:
        chosen = JobParams(start_date=start, end_date=end)
        rows = as_json(filters.filter_actions(i.user_visit_actions, None, chosen))
        replace_task(rows, path, task_id, "text")
    lines = i.spark.read.schema("value string, task_id bigint").text(path)
    return lines.select("task_id", "value")


def results_by_task(i: Inputs) -> DataFrame:
    """The category table of two tasks, the first of them run twice."""
    path = run_dir(i.spark, "categories")
    for task_id, start, end in EXPORTS[:3]:
        chosen = JobParams(start_date=start, end_date=end)
        actions = filters.filter_actions(i.user_visit_actions, None, chosen)
        top = categories.top_categories(categories.category_counts(actions))
        rows = category_rows(categories.category_pivot(top), task_id)
        replace_task(rows.drop("task_id"), path, task_id)
    return i.spark.read.parquet(path).select(
        F.col("task_id").cast("bigint"), "category_id", "click_count", "order_count", "pay_count"
    )


def area_results_of_tasks(i: Inputs) -> DataFrame:
    """Clicks per area and product of all tasks, written in one job, one area's tasks again."""
    path = run_dir(i.spark, "areas")
    actions = actions_of_tasks(i)
    counted = actions.join(i.city_info, "city_id").groupBy("task_id", "area").agg(
        F.count(F.lit(1)).alias("action_count")
    )
    replace_tasks(counted, path)
    replace_tasks(counted.where("task_id < 10"), path)
    return i.spark.read.parquet(path).select(F.col("task_id").cast("bigint"), "area", "action_count")


def actions_until_today(i: Inputs) -> DataFrame:
    dated = i.user_visit_actions.where(F.col("date") <= times.today())
    return dated.groupBy("date").agg(F.count(F.lit(1)).alias("action_count"))


# Session metrics


def session_lengths(i: Inputs) -> DataFrame:
    return sessions.session_lengths(i.user_visit_actions)


def hourly_lengths(i: Inputs) -> DataFrame:
    return sessions.hourly_session_lengths(i.user_visit_actions)


# Categories


def category_counts(i: Inputs) -> DataFrame:
    return categories.category_counts(i.user_visit_actions)


def top_categories(i: Inputs) -> DataFrame:
    return categories.top_categories(category_counts(i))


def category_session_counts(i: Inputs) -> DataFrame:
    return categories.category_session_counts(i.user_visit_actions, top_categories(i))


def top_sessions(i: Inputs) -> DataFrame:
    return categories.top_sessions(category_session_counts(i))


def session_details(i: Inputs) -> DataFrame:
    return categories.session_details(i.user_visit_actions, top_sessions(i))


# Areas


def city_clicks(i: Inputs) -> DataFrame:
    return areas.city_product_clicks(i.user_visit_actions, i.city_info)


def top_area_products(i: Inputs) -> DataFrame:
    products = areas.area_product_clicks(city_clicks(i)).drop("city_list")
    return areas.top_area_products(products)


def unfiltered_area_counts(i: Inputs) -> DataFrame:
    counted = areas.city_product_clicks(i.user_visit_actions, i.city_info, clicks_only=False)
    return areas.area_product_clicks(counted)


def cities_of_areas(i: Inputs) -> DataFrame:
    city = labels.city_label(F.col("city_id"), F.col("city_name"))
    actions = areas.actions_with_city(i.user_visit_actions, i.city_info).withColumn("city", city)
    return areas.group_concat_counts(actions, ["area"], "city", "city_infos")


def sessions_of_areas(i: Inputs) -> DataFrame:
    actions = i.user_visit_actions.join(i.city_info, "city_id")
    return areas.group_concat_chunks(actions, ["area"], "session_id", "sessions", CHUNK)


def enriched_area_products(i: Inputs) -> DataFrame:
    return area_top_products(
        i.user_visit_actions, i.user_info, i.city_info, i.product_info, levels=AREA_LEVELS
    )


# Clicks


def parsed_clicks(i: Inputs) -> DataFrame:
    return clicks.parse_clicks(i.ad_click_lines)


def click_times(i: Inputs) -> DataFrame:
    moment = F.col("ts_ms")
    parts = ("year", "month", "day", "hour", "minute", "second", "millisecond")
    return parsed_clicks(i).select(
        "ts_ms",
        times.format_millis(moment).alias("click_time"),
        times.parse_millis(times.format_millis(moment)).alias("whole_ms"),
        *(times.date_part(moment, part).alias(part) for part in parts),
    )


def clean_clicks(i: Inputs) -> DataFrame:
    return clicks.not_blacklisted(parsed_clicks(i), i.blacklist)


def blacklist_candidates(i: Inputs) -> DataFrame:
    return clicks.blacklist_candidates(
        parsed_clicks(i), i.blacklist, i.whitelist, BLACKLIST_THRESHOLD
    )


def running_counts(i: Inputs) -> DataFrame:
    return clicks.running_counts(clean_clicks(i))


def province_counts(i: Inputs) -> DataFrame:
    return clicks.province_counts(running_counts(i))


# Streams: the click lines arrive in parts, a micro-batch each


def _click_tables(i: Inputs, output: str) -> tuple[outputs.ClickTables, str]:
    """Run the click stream over all parts; its tables, and the path of its blacklist.

    The queries are started anew for each part, as after a stop, and go on where they
    ended. Each batch reads the blacklist that earlier batches appended to.
    """
    folder = run_dir(i.spark, output)
    listed, lines = f"{folder}/blacklist", f"{folder}/lines"
    i.blacklist.write.parquet(listed)
    stream = outputs.ClickStream(
        read_text_stream(i.spark, f"{lines}/part-*"),
        lambda: i.spark.read.schema(schemas.BLACK_USERS).parquet(listed),
        lambda users: users.write.mode("append").parquet(listed),
        i.whitelist,
        f"{folder}/tables",
        BLACKLIST_THRESHOLD,
        outputs=frozenset({"blacklist", output}),
    )
    for part in range(len(PART_STARTS) + 1):
        arrived = i.ad_click_parts.where(F.col("part") == part)
        arrived.select("value").write.text(f"{lines}/part-{part}")
        if stream.run_available()[0].lastProgress["batchId"] != part:
            raise RuntimeError("the stream did not take in a part as one batch")
    return stream.tables, listed


def running_counts_stream(i: Inputs) -> DataFrame:
    return _click_tables(i, "counts")[0].counts()


def user_windows_stream(i: Inputs) -> DataFrame:
    return _click_tables(i, "user_windows")[0].user_windows()


def click_trend_stream(i: Inputs) -> DataFrame:
    return _click_tables(i, "trend")[0].trend()


def province_top5_stream(i: Inputs) -> DataFrame:
    return _click_tables(i, "top_ads")[0].top_ads()


def blacklist_stream(i: Inputs) -> DataFrame:
    """Users the stream adds to a blacklist kept as a table in the shared folder."""
    listed = i.spark.read.schema(schemas.BLACK_USERS).parquet(_click_tables(i, "blacklist")[1])
    return listed.join(i.blacklist.select("user_id"), "user_id", "left_anti")


QUERIES: dict[str, Query] = {
    name: _query(build)
    for name, build in {
        "actions_from_text": actions_from_text,
        "users_from_text": users_from_text,
        "products_from_text": products_from_text,
        "session_lengths_from_catalog": lambda i: sessions.session_lengths(catalog_actions(i)),
        "hourly_lengths_from_catalog": lambda i: sessions.hourly_session_lengths(
            catalog_actions(i)
        ),
        "session_details_from_catalog": catalog_session_details,
        "task_params": all_task_params,
        "refused_tasks": refused_tasks,
        "filter_actions_by_sql": actions_by_sql,
        "filter_actions_of_tasks": actions_of_tasks,
        "details_by_task": details_by_task,
        "top_categories_by_task": results_by_task,
        "area_actions_by_task": area_results_of_tasks,
        "actions_until_today": actions_until_today,
        "first_area_products": lambda i: preview(
            top_area_products(i), [F.desc("click_count"), F.asc("area"), F.asc("rn")]
        ),
        "filter_actions_by_date": lambda i: filters.filter_actions(
            i.user_visit_actions, i.user_info, JobParams(start_date=START_DATE, end_date=END_DATE)
        ),
        "filter_actions_by_user": lambda i: filters.filter_actions(
            i.user_visit_actions, i.user_info, JobParams(sex=SEX, professionals=PROFESSIONALS)
        ),
        "session_lengths": session_lengths,
        "session_totals": lambda i: sessions.session_totals(session_lengths(i)),
        "session_length_histogram": lambda i: sessions.length_histogram(session_lengths(i)),
        "hourly_session_lengths": hourly_lengths,
        "hourly_session_counts": lambda i: sessions.hourly_session_counts(hourly_lengths(i)),
        "hourly_session_length_totals": lambda i: sessions.hourly_length_totals(hourly_lengths(i)),
        "hourly_invalid_sessions": lambda i: sessions.hourly_invalid_sessions(hourly_lengths(i)),
        "session_report_json": lambda i: sessions.session_report(i.user_visit_actions),
        "category_action_counts": category_counts,
        "top10_categories_per_action": top_categories,
        "top10_category_pivot": lambda i: categories.category_pivot(top_categories(i)),
        "category_session_counts": category_session_counts,
        "top10_sessions_per_category": top_sessions,
        "top10_category_session_json": lambda i: categories.category_session_lists(top_sessions(i)),
        "top_session_details": session_details,
        "top_session_details_json": lambda i: as_json(session_details(i)),
        "actions_with_city": lambda i: areas.actions_with_city(i.user_visit_actions, i.city_info),
        "area_product_clicks": lambda i: areas.area_product_clicks(city_clicks(i)),
        "area_product_action_counts": lambda i: unfiltered_area_counts(i).drop("city_list"),
        "area_city_concat": cities_of_areas,
        "area_session_chunks": sessions_of_areas,
        "area_product_city_infos": lambda i: areas.area_city_infos(city_clicks(i)),
        "area_top10_products": top_area_products,
        "area_top10_products_enriched": enriched_area_products,
        "product_type_labels": lambda i: areas.product_types(i.product_info).select(
            "product_id", "product_type"
        ),
        "ad_clicks_parsed": parsed_clicks,
        "ad_click_times": click_times,
        "ad_clicks_not_blacklisted": clean_clicks,
        "ad_user_window_counts": lambda i: clicks.sliding_counts(
            clean_clicks(i), "user_id", clicks.BLACKLIST_WINDOW, clicks.BLACKLIST_SLIDE
        ),
        "ad_user_window_counts_stream": user_windows_stream,
        "ad_blacklist_candidates": blacklist_candidates,
        "ad_blacklist_stream": blacklist_stream,
        "ad_running_counts": running_counts,
        "ad_running_counts_stream": running_counts_stream,
        "ad_province_counts": province_counts,
        "ad_province_top5": lambda i: clicks.top_province_ads(province_counts(i)),
        "ad_province_top5_stream": province_top5_stream,
        "ad_click_trend": lambda i: clicks.click_trend(clean_clicks(i)),
        "ad_click_trend_stream": click_trend_stream,
    }.items()
}
