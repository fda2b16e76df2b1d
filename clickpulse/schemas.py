"""Column layouts of the input tables and of the click stream."""

from pyspark.sql import types as T


def _struct(**columns: T.DataType) -> T.StructType:
    return T.StructType([T.StructField(name, kind) for name, kind in columns.items()])


_LONG, _INT, _STR = T.LongType(), T.IntegerType(), T.StringType()

# Column names, order and types of the input tables.
USER_VISIT_ACTION = _struct(
    date=_STR,
    user_id=_LONG,
    session_id=_STR,
    page_id=_LONG,
    action_time=_STR,
    search_keyword=_STR,
    click_category_id=_STR,
    click_product_id=_STR,
    order_category_ids=_STR,
    order_product_ids=_STR,
    pay_category_ids=_STR,
    pay_product_ids=_STR,
    city_id=_INT,
)
USER_INFO = _struct(
    user_id=_LONG,
    user_name=_STR,
    name=_STR,
    age=_INT,
    professional=_STR,
    city=_STR,
    sex=_STR,
)
PRODUCT_INFO = _struct(product_id=_LONG, product_name=_STR, extend_info=_STR)
CITY_INFO = _struct(city_id=_INT, city_name=_STR, area=_STR, province_name=_STR)
BLACK_USERS = _struct(user_id=_INT, count=_INT)
AD_CLICK = _struct(ts_ms=_LONG, province=_STR, city=_STR, user_id=_INT, ad_id=_INT)

ACTION_COLUMNS = USER_VISIT_ACTION.fieldNames()
CLICK_COLUMNS = AD_CLICK.fieldNames()
