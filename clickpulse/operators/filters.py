"""Selection of actions by the task's parameters."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from clickpulse.operators.joins import Members, broadcast_if_small, keep_members, measured
from clickpulse.params import JobParams


def filter_dates(actions: DataFrame, start: str | None = None, end: str | None = None) -> DataFrame:
    """Actions between two dates, both included; the dates are compared as text."""
    if start is not None:
        actions = actions.where(F.col("date") >= start)
    if end is not None:
        actions = actions.where(F.col("date") <= end)
    return actions


def filter_users(
    users: DataFrame, sex: str | None = None, professionals: tuple[str, ...] = ()
) -> DataFrame:
    """Users of one sex and of the listed professions, as far as given."""
    if sex is not None:
        users = users.where(F.col("sex") == sex)
    if professionals:
        users = users.where(F.col("professional").isin(*professionals))
    return users


def selected_users(
    actions: DataFrame, users: DataFrame | None, params: JobParams
) -> Members | None:
    """The users that the parameters select, measured; None if no parameter names users."""
    if not params.needs_users:
        return None
    chosen = filter_users(users, params.sex, params.professionals)
    dated = filter_dates(actions, params.start_date, params.end_date)
    return measured(dated, chosen, "user_id")


def filter_actions(
    actions: DataFrame, users: DataFrame | Members | None, params: JobParams
) -> DataFrame:
    """Actions that satisfy all parameters.

    Users take part only if a user parameter is given; without one, actions of
    unknown users stay. A user listed twice does not double the actions. A job that
    filters several times passes the users as ``selected_users`` measured them.
    """
    selected = filter_dates(actions, params.start_date, params.end_date)
    if not params.needs_users:
        return selected
    if not isinstance(users, Members):
        users = selected_users(actions, users, params)
    return keep_members(selected, users, "user_id")


def actions_of_tasks(actions: DataFrame, users: DataFrame, params: DataFrame) -> DataFrame:
    """Actions of many tasks at once, each with its ``task_id``; an action may have several.

    ``params`` are the rows of ``task_params``; refused tasks select nothing. Every task
    takes those days of the table that lie within its bounds. They are joined to the
    actions by equality, so of a table with a folder per date Spark reads at run time only
    the folders of some task's days. Users are looked up only for tasks that name them.

    One job lists the days of the table, one value each.
    """
    wanted = params.where("NOT refused").drop("refused")
    days = F.array(*(F.lit(row.date) for row in actions.select("date").distinct().collect()))
    inside = F.filter(
        days.cast("array<string>"),
        lambda day: (F.col("start_date").isNull() | (day >= F.col("start_date")))
        & (F.col("end_date").isNull() | (day <= F.col("end_date"))),
    )
    names_users = F.col("sex").isNotNull() | (F.size("professionals") > 0)
    dated_tasks = wanted.select(
        "task_id", names_users.alias("names_users"), F.explode(inside).alias("date")
    )
    dated = actions.join(broadcast_if_small(dated_tasks), "date")
    columns = ["task_id", *actions.columns]
    by_user = dated.where("names_users").join(
        _users_of_tasks(wanted, users), ["task_id", "user_id"], "left_semi"
    )
    return dated.where("NOT names_users").select(*columns).unionByName(by_user.select(*columns))


def _users_of_tasks(params: DataFrame, users: DataFrame) -> DataFrame:
    """task_id and user_id of the users that tasks name, by professions or else by sex."""
    known = users.select("user_id", F.col("sex").alias("user_sex"), "professional")
    listed = params.withColumn("professional", F.explode(F.array_distinct("professionals")))
    by_profession = listed.join(known, "professional").where("sex IS NULL OR sex = user_sex")
    by_sex = params.where(F.size("professionals") == 0).join(known, F.col("sex") == F.col("user_sex"))
    pairs = (df.select("task_id", "user_id") for df in (by_profession, by_sex))
    return next(pairs).unionByName(next(pairs))
