"""Labels of areas, cities and products."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column
from pyspark.sql import functions as F

from clickpulse.functions.text import or_null_text

# Sales areas and their levels, product types and their labels.
AREA_LEVELS = {"华东": "A", "华南": "A", "华北": "B", "华中": "B", "东北": "C"}
OTHER_LEVEL = "D"
PRODUCT_TYPES = {"0": "自营商品", "1": "第三方商品"}
UNKNOWN_PRODUCT = "未知商品"


def look_up(key: Column, labels: Mapping[str, str], other: str) -> Column:
    """The label of ``key``; ``other`` for unknown and null keys."""
    cases = (F.when(key == value, F.lit(label)) for value, label in labels.items())
    return F.coalesce(*cases, F.lit(other))


def area_level(area: Column, levels: Mapping[str, str] = AREA_LEVELS) -> Column:
    return look_up(area, levels, OTHER_LEVEL)


def product_type(extend_info: Column) -> Column:
    """Label of the ``product_type`` inside a JSON object; bad JSON is unknown."""
    return look_up(F.get_json_object(extend_info, "$.product_type"), PRODUCT_TYPES, UNKNOWN_PRODUCT)


def city_label(city_id: Column, city_name: Column) -> Column:
    """``id:name``, nulls spelled out."""
    return F.concat(or_null_text(city_id), F.lit(":"), or_null_text(city_name))
