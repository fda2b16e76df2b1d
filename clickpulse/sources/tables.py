"""Catalog tables, typed frames and temporary views."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from clickpulse.params import JobParams
from clickpulse.schemas import ACTION_COLUMNS, USER_VISIT_ACTION

# Buckets of the action table: as many tasks as read it at least.
BUCKETS = 64


def read_table(spark: SparkSession, name: str, schema: T.StructType | None = None) -> DataFrame:
    """A table or view of the catalog, reduced to ``schema`` where one is given."""
    table = spark.table(name)
    return typed(table, schema) if schema else table


def typed(df: DataFrame, schema: T.StructType) -> DataFrame:
    """The columns of ``schema``, by name, in its order and types."""
    return df.select(*(F.col(field.name).cast(field.dataType).alias(field.name) for field in schema))


def register_views(views: dict[str, DataFrame]) -> None:
    """Make frames available to SQL under the given names."""
    for name, df in views.items():
        df.createOrReplaceTempView(name)


def save_actions_table(
    actions: DataFrame, name: str, buckets: int = BUCKETS, path: str | None = None
) -> None:
    """Actions as a catalog table: a folder per date, in it sorted files per bucket of sessions.

    Date bounds skip whole folders. As a session lies in one bucket on all dates, nothing
    that is grouped or joined by session needs a shuffle of actions. The rows are gathered
    by date and bucket before they are written; Spark splits what is too large for one writer.
    """
    bucket = F.pmod(F.hash("session_id"), F.lit(buckets))
    gathered = actions.withColumn("_bucket", bucket).hint("rebalance", "date", "_bucket")
    gathered = gathered.drop("_bucket")
    writer = gathered.write.partitionBy("date").bucketBy(buckets, "session_id").sortBy("session_id")
    if path:
        writer = writer.option("path", path)
    writer.mode("overwrite").saveAsTable(name)


def read_actions_table(spark: SparkSession, name: str) -> DataFrame:
    """The columns of actions as they lie in the table, so that its layout stays known."""
    table = spark.table(name)
    kinds = dict(table.dtypes)
    wrong = [f.name for f in USER_VISIT_ACTION if kinds.get(f.name) != f.dataType.simpleString()]
    if wrong:
        raise ValueError(f"{name} has no column, or one of another type, for {wrong}")
    return table.select(*ACTION_COLUMNS)


# The selection of actions as SQL over the views user_visit_action and user_info.
_SELECT_ACTIONS = """
    SELECT uva.* FROM user_visit_action uva
    WHERE (:start_date IS NULL OR uva.date >= :start_date)
      AND (:end_date IS NULL OR uva.date <= :end_date)"""
_OF_USERS = "\n      AND uva.user_id IN (SELECT ui.user_id FROM user_info ui WHERE {})"
_OF_SEX = "ui.sex = :sex"
_OF_PROFESSIONS = "array_contains(:professionals, ui.professional)"


def select_actions_sql(spark: SparkSession, params: JobParams) -> DataFrame:
    """Actions of the registered views that satisfy the parameters, by SQL.

    Values are bound to named markers, never written into the text. Users take part only
    if a parameter names them.
    """
    args = {"start_date": params.start_date, "end_date": params.end_date}
    users = []
    if params.sex is not None:
        args["sex"] = params.sex
        users.append(_OF_SEX)
    if params.professionals:
        args["professionals"] = F.array(*map(F.lit, params.professionals))
        users.append(_OF_PROFESSIONS)
    text = _SELECT_ACTIONS + (_OF_USERS.format(" AND ".join(users)) if users else "")
    return spark.sql(text, args=args)
