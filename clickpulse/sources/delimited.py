"""Delimited text files of the three input tables."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from clickpulse import schemas
from clickpulse.functions import text


def parse_lines(lines: DataFrame, schema: T.StructType, separator: str) -> DataFrame:
    """Typed rows of the lines in column ``value``.

    Lines with another number of fields are dropped. A line with the right
    number of fields but text where a number belongs fails the query. The fields
    leave a generator, below which Spark cannot push the filter: each line is
    split once.
    """
    split = text.split_line(F.col("value"), separator)
    fields = lines.select(F.explode(F.array(split)).alias("fields"))
    rows = fields.where(F.size("fields") == len(schema))
    return rows.select(*(_field(position, field) for position, field in enumerate(schema)))


def _field(position: int, field: T.StructField) -> Column:
    value = F.col("fields")[position]
    if not isinstance(field.dataType, T.StringType):
        value = text.required_number(value, field.dataType.simpleString())
    return value.alias(field.name)


def read_user_visit_actions(spark: SparkSession, path: str, separator: str = ",") -> DataFrame:
    return parse_lines(spark.read.text(path), schemas.USER_VISIT_ACTION, separator)


def read_user_info(spark: SparkSession, path: str, separator: str = ",") -> DataFrame:
    return parse_lines(spark.read.text(path), schemas.USER_INFO, separator)


def read_product_info(spark: SparkSession, path: str, separator: str = "^") -> DataFrame:
    return parse_lines(spark.read.text(path), schemas.PRODUCT_INFO, separator)
