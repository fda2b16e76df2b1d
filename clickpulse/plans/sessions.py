"""Session analytics of one task: report, top categories, top sessions, details."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession

from clickpulse.operators import categories, sessions
from clickpulse.operators.filters import filter_actions, selected_users
from clickpulse.params import JobParams
from clickpulse.sinks import files
from clickpulse.sinks import jdbc as sink
from clickpulse.sources.jdbc import Database, find_params, read_jdbc


@dataclass(frozen=True)
class SessionResults:
    """Results of the job, all lazy."""

    report: DataFrame
    top_categories: DataFrame
    category_pivot: DataFrame
    top_sessions: DataFrame
    session_lists: DataFrame
    details: DataFrame


def session_results(
    actions: DataFrame, users: DataFrame | None, params: JobParams
) -> SessionResults:
    """All results over the actions selected by the parameters.

    Each result reads only the columns it needs. The details are cut down to the
    sessions of the top lists before users are looked up.
    """
    chosen = selected_users(actions, users, params)
    selected = filter_actions(actions, chosen, params)
    # At most 30 and 900 rows, each used by several results.
    top_categories = categories.top_categories(categories.category_counts(selected)).persist()
    session_counts = categories.category_session_counts(selected, top_categories)
    top_sessions = categories.top_sessions(session_counts).persist()
    return SessionResults(
        report=sessions.session_report(selected),
        top_categories=top_categories,
        category_pivot=categories.category_pivot(top_categories),
        top_sessions=top_sessions,
        session_lists=categories.category_session_lists(top_sessions),
        details=filter_actions(
            categories.session_details(actions, top_sessions), chosen, params
        ),
    )


def run_session_job(
    spark: SparkSession,
    database: Database,
    task_id: int,
    output: str,
    actions: DataFrame | None = None,
    users: DataFrame | None = None,
    mode: str = "append",
) -> None:
    """Run a task of the task table and save its results.

    The report and the details go to folders of ``output``, the top lists to the
    database, where ``mode`` ``overwrite`` replaces all rows. Actions and users default
    to the catalog tables.
    """
    params = find_params(read_jdbc(spark, database, "tb_task"), task_id)
    if users is None and params.needs_users:
        users = spark.table("user_info")
    if actions is None:
        actions = spark.table("user_visit_action")
    results = session_results(actions, users, params)
    try:
        results.report.write.mode("overwrite").text(f"{output}/session_report/task_{task_id}")
        pivot = sink.category_rows(results.category_pivot, task_id)
        sink.write_jdbc(pivot, database, sink.CATEGORY_TABLE, mode)
        lists = sink.category_session_rows(results.session_lists, task_id)
        sink.write_jdbc(lists, database, sink.CATEGORY_SESSION_TABLE, mode)
        files.write_json_lines(results.details, f"{output}/top10_category_session/task_{task_id}")
    finally:
        results.top_sessions.unpersist()
        results.top_categories.unpersist()
