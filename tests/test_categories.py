import json

import pytest

from clickpulse.operators import categories as c

SCHEMA = (
    "session_id string, click_category_id string, order_category_ids string, pay_category_ids string"
)


@pytest.fixture
def actions(frame):
    return lambda *rows: frame(SCHEMA, *rows)


def test_kind_of_action(actions, rows):
    df = actions(
        ("s", "1|2", "3", "4"),  # a click before all else, and not split
        ("s", " ", "3|3", "4"),  # repeats count
        ("s", "", "\t", "5| |6||"),
        ("s", None, "|7", ""),
        ("s", "", "", None),
        ("s", "", "|", "8"),  # an order without ids is still no payment
    )
    assert rows(c.category_counts(df), "category_id", "flag", "action_count") == [
        ("1|2", 0, 1),
        ("3", 1, 2),
        ("5", 2, 1),
        ("6", 2, 1),
        ("7", 1, 1),
    ]


def test_tokens_keep_their_spaces(actions, rows):
    df = actions(("s", " 1", "", ""), ("s", "", " 1|1", ""))
    assert rows(c.category_counts(df)) == [(" 1", 0, 1), (" 1", 1, 1), ("1", 1, 1)]


def test_ties_follow_the_key(frame, rows):
    schema = "category_id string, flag int, action_count bigint"
    counts = frame(schema, *((f"{i:02}", 0, 5) for i in range(11)))
    top = rows(c.top_categories(counts), "rn", "category_id")
    assert top == sorted(((i + 1, f"{i:02}") for i in range(10)), key=repr)


def test_pivot_shows_zero_outside_the_top(actions, rows):
    df = actions(
        *[("s", "a", "", "")] * 3, ("s", "", "a|b|b", ""), ("s", "", "", "c")
    )
    top = c.top_categories(c.category_counts(df), n=1)
    assert rows(c.category_pivot(top)) == [("a", 3, 0, 0), ("b", 0, 2, 0), ("c", 0, 0, 1)]


def test_sessions_of_top_categories(actions, rows):
    df = actions(
        *[("s1", "a", "", "")] * 3,
        ("s2", "a", "", ""),
        ("s1", "", "a|b|b", ""),
        ("s3", "", "b", ""),
        ("s4", "z", "", ""),
    )
    top = c.top_categories(c.category_counts(df), n=1)
    counts = c.category_session_counts(df, top, n=1)
    # a leads the clicks and b the orders, so a's orders count as well.
    assert rows(counts, "category_id", "flag", "session_id", "action_count") == [
        ("a", 0, "s1", 3),
        ("a", 0, "s2", 1),
        ("a", 1, "s1", 1),
        ("b", 1, "s1", 2),
        ("b", 1, "s3", 1),
    ]
    best = c.top_sessions(counts, n=1)
    assert rows(best, "category_id", "flag", "session_id", "rn") == [
        ("a", 0, "s1", 1),
        ("a", 1, "s1", 1),
        ("b", 1, "s1", 1),
    ]
    assert rows(c.session_details(df, best), "session_id") == [("s1",)] * 4


def test_session_lists(frame):
    top = frame(
        "category_id string, flag int, session_id string, action_count bigint, rn int",
        ("a", 0, "z", 5, 1),
        ("a", 0, 'q"', 2, 2),
        ("a", 2, "p", 1, 1),
    )
    row = c.category_session_lists(top).first()
    assert json.loads(row.click_sessions) == [
        {"sessionID": "z", "count": 5},
        {"sessionID": 'q"', "count": 2},
    ]
    assert row.order_sessions == ""
    assert row.pay_sessions == '[{"sessionID":"p","count":1}]'
