"""Most used categories per kind of action, and their most active sessions."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from clickpulse.functions.text import is_blank, not_blank, split_ids
from clickpulse.operators.joins import broadcast_bounded
from clickpulse.operators.ranking import top_n

# Numbers of the kinds of action, and the length of the top lists.
CLICK, ORDER, PAY = 0, 1, 2
KINDS = (CLICK, ORDER, PAY)
TOP = 10


def category_uses(actions: DataFrame, *carried: str) -> DataFrame:
    """One row per used category: ``category_id``, ``flag`` and the carried columns.

    An action is a click, else an order, else a payment, by the first of these
    fields that is not blank. A click names one category; orders and payments
    list several, and repeats count.
    """
    clicked, ordered, paid = (
        F.col(name) for name in ("click_category_id", "order_category_ids", "pay_category_ids")
    )
    kind = F.when(not_blank(clicked), CLICK).when(not_blank(ordered), ORDER).when(not_blank(paid), PAY)
    ids = (
        F.when(F.col("flag") == CLICK, F.array(clicked))
        .when(F.col("flag") == ORDER, split_ids(ordered))
        .when(F.col("flag") == PAY, split_ids(paid))
    )
    # Actions of no kind have no ids and vanish here.
    return (
        actions.withColumn("flag", kind)
        .select(*carried, "flag", F.explode(ids).alias("category_id"))
        .where(~is_blank(F.col("category_id")))
    )


def category_counts(actions: DataFrame) -> DataFrame:
    """How often each category was clicked, ordered and paid."""
    return (
        category_uses(actions)
        .groupBy("category_id", "flag")
        .agg(F.count(F.lit(1)).alias("action_count"))
    )


def top_categories(counts: DataFrame, n: int = TOP) -> DataFrame:
    """The ``n`` most used categories of each kind of action."""
    return top_n(counts, ["flag"], "action_count", "category_id", n).select(
        "flag", "category_id", "action_count", "rn"
    )


def category_pivot(top: DataFrame) -> DataFrame:
    """One row per top category; 0 where it is not among the top of that kind."""
    return top.groupBy("category_id").agg(
        _of_kind(CLICK, "action_count", 0).alias("click_count"),
        _of_kind(ORDER, "action_count", 0).alias("order_count"),
        _of_kind(PAY, "action_count", 0).alias("pay_count"),
    )


def category_session_counts(actions: DataFrame, top: DataFrame, n: int = TOP) -> DataFrame:
    """Uses of the top categories per session and kind of action.

    ``top`` holds at most ``n`` categories per kind; a category of any kind's
    list counts for all three kinds.
    """
    chosen = broadcast_bounded(top.select("category_id"), n * len(KINDS))
    return (
        category_uses(actions, "session_id")
        .join(chosen, "category_id", "left_semi")
        .groupBy("category_id", "flag", "session_id")
        .agg(F.count(F.lit(1)).alias("action_count"))
    )


def top_sessions(counts: DataFrame, n: int = TOP) -> DataFrame:
    """The ``n`` most active sessions of each category and kind of action."""
    return top_n(counts, ["category_id", "flag"], "action_count", "session_id", n).select(
        "category_id", "flag", "session_id", "action_count", "rn"
    )


def category_session_lists(top: DataFrame) -> DataFrame:
    """One row per category with its sessions as three JSON lists in rank order."""
    entry = F.struct(F.col("session_id").alias("sessionID"), F.col("action_count").alias("count"))
    ranked = F.array_sort(F.collect_list(F.struct("rn", entry.alias("entry"))))
    lists = top.groupBy("category_id", "flag").agg(
        F.to_json(F.transform(ranked, lambda item: item["entry"])).alias("sessions")
    )
    return lists.groupBy("category_id").agg(
        _of_kind(CLICK, "sessions", "").alias("click_sessions"),
        _of_kind(ORDER, "sessions", "").alias("order_sessions"),
        _of_kind(PAY, "sessions", "").alias("pay_sessions"),
    )


def session_details(
    actions: DataFrame, top: DataFrame, categories: int = TOP, sessions: int = TOP
) -> DataFrame:
    """All actions of the sessions in the top lists.

    The lists hold at most ``sessions`` per kind and per top category, of which
    there are at most ``categories`` per kind.
    """
    bound = sessions * len(KINDS) * categories * len(KINDS)
    chosen = broadcast_bounded(top.select("session_id").distinct(), bound)
    return actions.join(chosen, "session_id", "left_semi").select(*actions.columns)


def _of_kind(flag: int, column: str, missing: int | str) -> Column:
    return F.coalesce(F.max(F.when(F.col("flag") == flag, F.col(column))), F.lit(missing))
