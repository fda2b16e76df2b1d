"""Results into relational tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from clickpulse.sources.jdbc import Database

# Rows per insert batch, and the result tables with their columns.
BATCH_ROWS = 500
CATEGORY_TABLE = "tb_task_top10_category"
CATEGORY_COLUMNS = ["task_id", "category_id", "click_count", "order_count", "pay_count"]
CATEGORY_SESSION_TABLE = "tb_task_top10_category_session"
CATEGORY_SESSION_COLUMNS = [
    "task_id",
    "category_id",
    "click_sessions",
    "order_sessions",
    "pay_sessions",
]
AREA_TABLE = "tb_area_top10_product"
AREA_COLUMNS = [
    "task_id",
    "area",
    "product_id",
    "area_level",
    "count",
    "city_infos",
    "product_name",
    "product_type",
]
BLACKLIST_TABLE = "tb_black_users"

# Connections open at once.
_CONNECTIONS = 16


def write_options(database: Database, table: str) -> dict[str, str]:
    return {
        **database.options,
        "url": database.url,
        "dbtable": table,
        "batchsize": str(BATCH_ROWS),
    }


def write_jdbc(
    df: DataFrame,
    database: Database,
    table: str,
    mode: str = "append",
    connections: int = _CONNECTIONS,
) -> None:
    """Insert the rows; each partition is one transaction and errors are raised.

    ``overwrite`` empties the table and keeps its definition.
    """
    rows = for_connections(df, connections)
    writer = rows.write.format("jdbc").options(**write_options(database, table))
    writer.option("truncate", "true").mode(mode).save()


def replace_task_rows(df: DataFrame, database: Database, table: str, task_id: int) -> None:
    """Put a task's rows in place of those it inserted before.

    The rows go to a staging table of the task first, over several connections. One
    transaction then removes the old rows and takes the new ones over, so readers see
    either, and a run that fails anywhere can simply be repeated.
    """
    staging = f"{table}_task_{task_id}"
    write_jdbc(df, database, staging, "overwrite")
    connection = _connect(df.sparkSession, database)
    try:
        in_one_transaction(connection, swap_statements(table, staging, df.columns, task_id))
    finally:
        connection.close()


def swap_statements(table: str, staging: str, columns: list[str], task_id: int) -> list[str]:
    names = ", ".join(f'"{name}"' for name in columns)
    return [
        f"DELETE FROM {table} WHERE task_id = {int(task_id)}",
        f"INSERT INTO {table} ({names}) SELECT {names} FROM {staging}",
        f"DELETE FROM {staging}",
    ]


def in_one_transaction(connection, statements: list[str]) -> None:
    """Run statements on a JDBC connection; all of them take effect or none."""
    connection.setAutoCommit(False)
    statement = connection.createStatement()
    try:
        for text in statements:
            statement.executeUpdate(text)
        connection.commit()
    except Exception:
        connection.rollback()
        raise
    finally:
        statement.close()


def _connect(spark: SparkSession, database: Database):
    java = spark._jvm.java
    properties = java.util.Properties()
    for name, value in database.options.items():
        properties.setProperty(name, value)
    return java.sql.DriverManager.getConnection(database.url, properties)


def for_connections(df: DataFrame, connections: int = _CONNECTIONS) -> DataFrame:
    """The rows dealt to as many partitions as may connect.

    Results are small. A shuffle of them leaves the stages before it as wide as they
    are; merging partitions instead would run the last of these in a few tasks.
    """
    return df.repartition(connections)


def category_rows(pivot: DataFrame, task_id: int) -> DataFrame:
    return _for_task(pivot, task_id).select(*CATEGORY_COLUMNS)


def category_session_rows(lists: DataFrame, task_id: int) -> DataFrame:
    return _for_task(lists, task_id).select(*CATEGORY_SESSION_COLUMNS)


def area_rows(products: DataFrame, task_id: int) -> DataFrame:
    renamed = products.withColumnsRenamed({"click_product_id": "product_id", "click_count": "count"})
    return _for_task(renamed, task_id).select(*AREA_COLUMNS)


def _for_task(df: DataFrame, task_id: int) -> DataFrame:
    return df.withColumn("task_id", F.lit(task_id).cast("long"))
